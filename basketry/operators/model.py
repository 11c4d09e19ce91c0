"""Repeat-purchase model: logistic regression, its metrics, and batch scoring."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import ratio
from basketry.operators.features import (
    CATEGORY, FILL_CATEGORY, LABEL, NUMBERS, Preparation, learn, split_by_limits, with_label,
)
from basketry.session import materialize

CLASSES = ("not_repeat", "repeat")
# Change of the loss at which the solver stops; its coefficients are then right to about 1e-5.
TOLERANCE = 1e-10


# Where the saved statement of the encoder names the table of categories.
_TABLE = "__CATEGORIES__"
_FOLDER = "categories"


@dataclass
class RepeatModel:
    """Pipeline from raw feature columns to probabilities, and what it was prepared with.

    Coefficients are those of scaled features, the numbers' first and then one per slot of a category.
    """

    pipeline: PipelineModel
    prep: Preparation
    coefficients: np.ndarray

    @property
    def columns(self) -> tuple[str, ...]:
        """Names of all features; not for very many categories."""
        return self.prep.columns

    @property
    def intercept(self) -> float:
        """The constant for centred features; the fitted one is for categories that are not centred."""
        spark = self.prep.dictionary.sparkSession
        moved = (_by_slot(spark, self.coefficients[len(NUMBERS):]).join(self.prep.dictionary, "slot")
                 .agg(F.sum(F.col("coefficient") * F.col("mean") / F.col("deviation"))).first()[0])
        return self.pipeline.stages[-1].intercept + (moved or 0.0)


def _by_slot(spark: SparkSession, values: np.ndarray) -> DataFrame:
    """slot, coefficient: a row per slot, from the array the solver leaves with the driver."""
    return spark.createDataFrame(pa.table({"slot": np.arange(len(values), dtype=np.int32), "coefficient": values}))


def _encoder(prep: Preparation, table: str) -> SQLTransformer:
    """Fill and scale the numbers; a category's vector is looked up in the table of categories.

    An unseen category has the vector of the first one, which is zero.
    """
    def number(value: float) -> str:
        return f"CAST('{value!r}' AS DOUBLE)"

    parts = []
    for c in NUMBERS:
        fill, value = prep.fill[c], f"CAST(t.`{c}` AS DOUBLE)"
        value = value if fill is None else f"COALESCE({value}, {number(fill)})"
        parts.append(f"({value} - {number(prep.means[c])}) / {number(prep.deviations[c])} AS `scaled_{c}`")
    zero = f"(SELECT first(vector) FROM {table} WHERE slot < 0)"
    return SQLTransformer(statement=(
        f"SELECT t.*, {', '.join(parts)}, COALESCE(d.vector, {zero}) AS `scaled_{CATEGORY}` "
        f"FROM __THIS__ t LEFT JOIN {table} d ON COALESCE(t.`{CATEGORY}`, '{FILL_CATEGORY}') = d.`{CATEGORY}`"))


def train(features: DataFrame) -> tuple[RepeatModel, DataFrame]:
    """Fit on the training part of a stratified split; returns the model and the scored test rows.

    L2 penalty with C = 1 and balanced class weights: the mean of weighted losses
    plus |w|²/(2n). `features` is read several times, so pass a stored frame.
    """
    prep = learn(features)
    if len(prep.limits) < 2:
        raise ValueError("no first orders to learn from" if not prep.limits
                         else "all first orders have the same label")
    view = f"basketry_categories_{uuid.uuid4().hex}"
    prep.dictionary.createOrReplaceTempView(view)
    encoder = _encoder(prep, view)
    hint = VectorSizeHint(inputCol=f"scaled_{CATEGORY}", size=prep.n_slots, handleInvalid="optimistic")
    assembler = VectorAssembler(inputCols=[f"scaled_{c}" for c in (*NUMBERS, CATEGORY)],
                                outputCol="features", handleInvalid="error")
    sizes = {v: size for v, size in prep.train_sizes.items() if size}
    n = sum(sizes.values())
    weight = F.lit(None).cast("double")
    for label, size in sizes.items():
        weight = F.when(F.col(LABEL) == label, n / (len(sizes) * size)).otherwise(weight)
    with_split = split_by_limits(with_label(features), prep.limits)
    train_rows = with_split.filter(F.col("split") == "train")
    regression = LogisticRegression(
        labelCol=LABEL, weightCol="class_weight", regParam=1.0 / n, elasticNetParam=0.0,
        standardization=False, maxIter=1000, tol=TOLERANCE)
    vectors = assembler.transform(hint.transform(encoder.transform(train_rows))).select(
        LABEL, "features", weight.alias("class_weight"))
    fitted = regression.fit(vectors)
    pipeline = PipelineModel(stages=[encoder, hint, assembler, fitted])
    model = RepeatModel(pipeline, prep, fitted.coefficients.toArray())
    return model, score(model.pipeline, with_split.filter(F.col("split") == "test"))


def save(model: RepeatModel, path: str) -> None:
    """The pipeline under `path`, with the table of categories in a folder of it."""
    saved = PipelineModel(stages=[_encoder(model.prep, _TABLE), *model.pipeline.stages[1:]])
    saved.write().overwrite().save(path)
    model.prep.dictionary.write.parquet(f"{path.rstrip('/')}/{_FOLDER}")


def load(path: str) -> PipelineModel:
    """A saved pipeline, ready to score; the folder may have moved since."""
    saved = PipelineModel.load(path)
    table = f"{path.rstrip('/')}/{_FOLDER}".replace("`", "``")
    statement = saved.stages[0].getStatement().replace(_TABLE, f"parquet.`{table}`")
    return PipelineModel(stages=[SQLTransformer(statement=statement), *saved.stages[1:]])


@dataclass
class Evaluation:
    matrix: DataFrame
    report: DataFrame
    roc_auc: float


def evaluate(scored: DataFrame) -> Evaluation:
    """Confusion matrix, report per class and ROC-AUC of scored rows, which are stored once."""
    rows = materialize(scored.select(F.coalesce(F.col(LABEL), F.lit(0)).alias(LABEL), "prediction",
                                     "probability_repeat"))
    matrix = confusion_matrix(rows)
    return Evaluation(matrix, classification_report(matrix), roc_auc(rows))


def headline(model: RepeatModel) -> str:
    """The strongest driver of a repeat purchase and its direction, as a sentence."""
    strongest = coefficients(model.prep.dictionary.sparkSession, model).filter("rank = 1").first()
    return (f"{strongest.feature} is the strongest driver: a higher value "
            f"{strongest.direction} the chance of a repeat purchase.")


def score(pipeline: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add prediction (0/1 at one half) and probability_repeat to raw feature rows."""
    scored = pipeline.transform(rows)
    return scored.select(*rows.columns, F.col("prediction").cast("int").alias("prediction"),
                         vector_to_array("probability")[1].alias("probability_repeat"))


def coefficients(spark: SparkSession, model: RepeatModel) -> DataFrame:
    """(rank, feature, coefficient, direction), strongest first, equally strong ones by name.

    The ranks are of the solver's array; names of categories are joined by slot.
    """
    values = np.asarray(model.coefficients, dtype=float)
    # numbers by name around the categories, which are in alphabetical order and share a prefix
    by_name = sorted(range(len(NUMBERS)), key=lambda i: (NUMBERS[i] > f"{CATEGORY}_", NUMBERS[i]))
    after = np.array([n > f"{CATEGORY}_" for n in NUMBERS])
    place = np.empty(len(values))
    place[by_name] = np.where(after[by_name], len(values), 0) + np.arange(len(NUMBERS))
    place[len(NUMBERS):] = len(NUMBERS) + np.arange(len(values) - len(NUMBERS)) / max(1, len(values))
    rank = np.empty(len(values), dtype=np.int32)
    rank[np.lexsort((place, -np.abs(values)))] = np.arange(1, len(values) + 1)
    slots = np.arange(-len(NUMBERS), len(values) - len(NUMBERS), dtype=np.int32)
    ranked = spark.createDataFrame(pa.table({"rank": rank, "slot": slots, "coefficient": values}))
    named = model.prep.dictionary.filter("slot >= 0").select(
        "slot", F.concat(F.lit(f"{CATEGORY}_"), F.col(CATEGORY)).alias("feature"))
    numbers = spark.createDataFrame(list(zip(range(-len(NUMBERS), 0), NUMBERS)), "slot int, feature string")
    return ranked.join(named.unionByName(numbers), "slot").select(
        "rank", "feature", "coefficient",
        F.when(F.col("coefficient") > 0, "increases").otherwise("decreases").alias("direction")).orderBy("rank")


def confusion_matrix(scored: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """One row: tn, fp, fn, tp."""
    def count(actual: int, predicted: int):
        hit = (F.col(label) == actual) & (F.col(prediction) == predicted)
        return F.count(F.when(hit, 1))

    return scored.agg(count(0, 0).alias("tn"), count(0, 1).alias("fp"),
                      count(1, 0).alias("fn"), count(1, 1).alias("tp"))


def classification_report(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, and accuracy, macro and weighted means.

    A quotient with nothing below counts as 0.
    """
    def safe(a, b):
        return F.coalesce(ratio(a, b), F.lit(0.0))

    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    per_class = matrix
    for k, (hit, wrong, missed) in enumerate([(tn, fn, fp), (tp, fp, fn)]):
        per_class = (per_class.withColumn(f"p{k}", safe(hit, hit + wrong))
                     .withColumn(f"r{k}", safe(hit, hit + missed))
                     .withColumn(f"s{k}", hit + missed)
                     .withColumn(f"f{k}", safe(2 * hit, 2 * hit + wrong + missed)))

    def row(name, precision, recall, f1, support):
        return F.struct(F.lit(name).alias("class"), precision.alias("precision"),
                        recall.alias("recall"), f1.alias("f1_score"), support.alias("support"))

    def mean(x):
        return (F.col(f"{x}0") + F.col(f"{x}1")) / 2.0

    def weighted(x):
        return safe(F.col(f"{x}0") * F.col("s0") + F.col(f"{x}1") * F.col("s1"), n)

    accuracy = safe(tn + tp, n)
    rows = [row(CLASSES[k], F.col(f"p{k}"), F.col(f"r{k}"), F.col(f"f{k}"), F.col(f"s{k}"))
            for k in (0, 1)]
    rows.append(row("accuracy", accuracy, accuracy, accuracy, n))
    rows.append(row("macro avg", mean("p"), mean("r"), mean("f"), n))
    rows.append(row("weighted avg", weighted("p"), weighted("r"), weighted("f"), n))
    return per_class.select(F.inline(F.array(*rows)))


def roc_auc(scored: DataFrame, label: str = LABEL, raw_score: str = "probability_repeat") -> float:
    """Exact area under the ROC curve; ties count half. Sorted and summed across executors."""
    evaluator = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="score", metricName="areaUnderROC", numBins=0)
    return evaluator.evaluate(scored.select(
        F.col(label).cast("double").alias("label"), F.col(raw_score).cast("double").alias("score")))
