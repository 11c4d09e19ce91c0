"""Preparation of the first-order features for the repeat-purchase model."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import hash_uniform
from basketry.operators.quantile import RankedValues, long_values, median, middle_ranks
from basketry.session import materialize

NUMBERS = ("order_value", "was_late", "installments", "review_score")
CATEGORY = "payment_type"
LABEL = "is_repeat_customer"
# Fill values where a feature is missing (fixed values); the others get the median.
FILL = {"installments": 1.0, "was_late": 0.0}
MEDIANS = ("review_score", "order_value")
FILL_CATEGORY = "unknown"
TRAIN_SHARE = 0.75
SEED = 42
# Categories that may become columns of a table; the model takes any number, as sparse vectors.
MOST_COLUMNS = 1000


@dataclass(frozen=True)
class Preparation:
    """What is learned from data: fill values, split limits, means and deviations, the categories.

    `dictionary` has a row per category in alphabetical order: slot (-1 for the first, which has no
    feature), mean and deviation of its 0/1 feature, and the sparse vector that stands for it.
    """

    fill: dict[str, float]
    limits: dict[int | None, float]
    means: dict[str, float]
    deviations: dict[str, float]
    train_sizes: dict[int, int]
    n_slots: int
    dictionary: DataFrame

    @cached_property
    def categories(self) -> tuple[str, ...]:
        """Names of all categories; not for very many."""
        return _few_names(self.dictionary.orderBy("slot"), CATEGORY)

    @property
    def columns(self) -> tuple[str, ...]:
        return NUMBERS + tuple(f"{CATEGORY}_{c}" for c in self.categories[1:])


def _few_names(rows: DataFrame, column: str) -> tuple[str, ...]:
    names = tuple(row[0] for row in rows.select(column).limit(MOST_COLUMNS + 1).collect())
    if len(names) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} categories do not become columns")
    return names


def _category() -> Column:
    return F.coalesce(F.col(CATEGORY), F.lit(FILL_CATEGORY))


def fill_values(features: DataFrame) -> dict[str, float]:
    ranked = RankedValues(long_values(features, {c: F.col(c).cast("double") for c in MEDIANS}))
    return FILL | _medians(ranked, ranked.at(_median_ranks(ranked)))


def _median_ranks(ranked: RankedValues) -> list[tuple[str, int]]:
    return [(c, rank) for c in MEDIANS for rank in middle_ranks(ranked.n.get(c, 0))]


def _medians(ranked: RankedValues, found: dict) -> dict[str, float | None]:
    return {c: median(c, ranked, found) for c in MEDIANS}


def impute(features: DataFrame, fill: dict[str, float]) -> DataFrame:
    """Missing numbers get their fill value, a missing payment type is a category."""
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(fill[c])).alias(c)
              if fill[c] is not None else F.col(c).cast("double").alias(c) for c in NUMBERS]
    rest = [c for c in features.columns if c not in (*NUMBERS, CATEGORY, LABEL)]
    label = [F.coalesce(F.col(LABEL), F.lit(0)).alias(LABEL)] if LABEL in features.columns else []
    return features.select(*rest, *filled, _category().alias(CATEGORY), *label)


def with_label(features: DataFrame) -> DataFrame:
    """A missing label counts as 0."""
    return features.withColumn(LABEL, F.coalesce(F.col(LABEL), F.lit(0)))


def categories(imputed: DataFrame) -> tuple[str, ...]:
    """The payment types in alphabetical order, to become columns of a table."""
    return tuple(sorted(_few_names(imputed.select(CATEGORY).distinct(), CATEGORY)))


def one_hot(imputed: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """0/1 columns for all categories but the first; an unseen one is all zeros."""
    dummies = [(F.col(CATEGORY) == c).cast("double").alias(f"{CATEGORY}_{c}") for c in names[1:]]
    return imputed.select(*[c for c in imputed.columns if c != CATEGORY], *dummies)


def split(rows: DataFrame, key: str = "order_id", seed: int = SEED) -> DataFrame:
    """Add `split`: train or test by a hash of the key.

    The hash is independent of the label, so each label has the share in
    expectation, and all rows of an order fall on one side.
    """
    u = hash_uniform(f"{seed}|s|", F.col(key))
    return rows.withColumn("split", F.when(u < TRAIN_SHARE, "train").otherwise("test"))


def _drawn(rows: DataFrame, label: Column, key: str, seed: int) -> DataFrame:
    """what, v, t: the hash of each row's key, by label."""
    return rows.select(F.concat(F.lit("split|"), label.cast("string")).alias("what"),
                       hash_uniform(f"{seed}|s|", F.col(key)).alias("v"), F.lit(None).cast("string").alias("t"))


def _limit_ranks(ranked: RankedValues) -> dict[str, int]:
    """Per label, as in `_drawn`, the rank of the largest hash of the train share; -1 if it has no row."""
    return {what: n - math.ceil((1.0 - TRAIN_SHARE) * n) - 1
            for what, n in ranked.n.items() if what.startswith("split|")}


def _limits(ranks: dict[str, int], found: dict) -> dict[int, float]:
    return {int(what.removeprefix("split|")): found[what, rank] if rank >= 0 else -1.0
            for what, rank in ranks.items()}


def split_limits(rows: DataFrame, label: str = LABEL, key: str = "order_id",
                 seed: int = SEED) -> dict[int | None, float]:
    """Per label the largest hash of the train share: the exact order statistic.

    A label has few values. A label with one row has it in the test part (limit -1). Rows without
    label or key are all for the test.
    """
    ranked = RankedValues(_drawn(rows.filter(F.col(label).isNotNull()), F.col(label), key, seed))
    ranks = _limit_ranks(ranked)
    return _limits(ranks, ranked.at((what, rank) for what, rank in ranks.items() if rank >= 0))


def split_by_limits(rows: DataFrame, limits: dict[int | None, float], label: str = LABEL,
                    key: str = "order_id", seed: int = SEED) -> DataFrame:
    """Add `split`, for limits that `split_limits` found; rows without a key are for the test."""
    limit = F.lit(-1.0)
    for value, largest in limits.items():
        limit = F.when(F.col(label).eqNullSafe(value), largest).otherwise(limit)
    u = hash_uniform(f"{seed}|s|", F.col(key))
    return rows.withColumn("split", F.when(u <= limit, "train").otherwise("test"))


def split_exactly(rows: DataFrame, label: str = LABEL, key: str = "order_id",
                  seed: int = SEED) -> DataFrame:
    """Like `split`, with the train share of each label's rows met exactly.

    Rows with equal keys stay together, so the share is exact for unique keys. `rows` is read
    several times.
    """
    return split_by_limits(rows, split_limits(rows, label, key, seed), label, key, seed)


def standardise(rows: DataFrame, means: dict, deviations: dict) -> DataFrame:
    def scaled(c: str) -> Column:
        if c not in means or means[c] is None:
            return F.col(f"`{c}`")
        return ((F.col(f"`{c}`") - F.lit(means[c])) / F.lit(deviations[c])).alias(c)

    return rows.select(*[scaled(c) for c in rows.columns])


def learn(features: DataFrame) -> Preparation:
    """Everything that is learned from `features`, which is read twice, so pass a stored frame.

    Medians, the limits of the split and the categories are ranks of one table of counted values; one
    aggregate then gives the moments of the training rows and the share of each category.
    """
    label = F.coalesce(F.col(LABEL), F.lit(0))
    ranked = RankedValues(long_values(features, {
        **{c: F.col(c).cast("double") for c in MEDIANS}, CATEGORY: _category()}).unionByName(
        _drawn(features, label, "order_id", SEED)))
    ranks = _limit_ranks(ranked)
    found = ranked.at([*_median_ranks(ranked), *((what, rank) for what, rank in ranks.items() if rank >= 0)])
    fill, limits = FILL | _medians(ranked, found), _limits(ranks, found)
    train = split_by_limits(impute(features, fill), limits).filter(F.col("split") == "train")
    # NULL is the total of all categories, as none is NULL
    sums = materialize(train.rollup(CATEGORY).agg(
        *(F.count(F.when(F.col(LABEL) == v, 1)).alias(f"n_{v}") for v in limits), F.count("*").alias("n"),
        *(F.avg(c).alias(f"m_{c}") for c in NUMBERS), *(F.stddev_pop(c).alias(f"s_{c}") for c in NUMBERS)))
    total = sums.filter(F.col(CATEGORY).isNull()).first()
    n = total.n if total else 0
    different = ranked.different(CATEGORY)
    n_slots = max(0, ranked.distinct.get(CATEGORY, 0) - 1)
    share = F.coalesce(F.col("n"), F.lit(0)) / F.lit(float(max(n, 1)))
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")))
    # the vector of a category: its 0/1 feature over the deviation
    vector = F.udf(lambda slot, deviation: Vectors.sparse(n_slots, [slot] if slot >= 0 else [],
                                                          [1.0 / deviation] if slot >= 0 else []), VectorUDT())
    slots = different.select(F.col("t").alias(CATEGORY), (F.col("place") - 1).cast("int").alias("slot"))
    dictionary = materialize(
        slots.join(sums.select(CATEGORY, "n"), CATEGORY, "left").withColumn("mean", share)
        .withColumn("deviation", F.when(spread > 0, spread).otherwise(1.0))
        .select(CATEGORY, "slot", "mean", "deviation", vector("slot", "deviation").alias("vector")))
    return Preparation(
        fill, limits, {c: total[f"m_{c}"] if total else None for c in NUMBERS},
        {c: (total[f"s_{c}"] or 1.0) if total else 1.0 for c in NUMBERS},
        {v: total[f"n_{v}"] if total else 0 for v in limits}, n_slots, dictionary)


def encode(features: DataFrame, prep: Preparation) -> DataFrame:
    """Filled and encoded rows with their split: a column per category but the first."""
    return split_by_limits(one_hot(impute(features, prep.fill), prep.categories), prep.limits)


def moments(prep: Preparation) -> tuple[dict, dict]:
    """Mean and population deviation on the training rows of each column of `encode`; a constant one has 1."""
    rows = prep.dictionary.filter("slot >= 0").select(CATEGORY, "mean", "deviation").collect()
    names = {r[CATEGORY]: f"{CATEGORY}_{r[CATEGORY]}" for r in rows}
    return (prep.means | {names[r[CATEGORY]]: r["mean"] for r in rows},
            prep.deviations | {names[r[CATEGORY]]: r["deviation"] for r in rows})
