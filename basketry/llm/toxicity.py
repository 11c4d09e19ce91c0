"""Toxicity by a chain of linear classifiers.

Categories are predicted in a fixed order. The model of a category gets the text's features and
the probabilities of the categories before it. In training these are out-of-fold predictions, so
that a later model meets earlier probabilities as they are on texts not seen. Features are the
presence of words and of character sequences within words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import materialize, release_memory, ship

ship(__name__)

# labelled rows to learn from, at most, of each class
SAMPLE = {1: 2000, 0: 4000}
FEATURES = 1500
LEAST_TEXTS = 3
FOLDS = 5
PENALTY = 0.5
THRESHOLD = 0.4
REMEMBERED = 500_000
# Only the whole (toxic or not) is labelled. The first categories are toxic texts with one of these
# words; the last one is the label itself and holds for all languages.
INSULTS = frozenset(("clown", "idiot", "loser", "moron", "scum", "trash"))
CONTEMPT = frozenset(("disgusting", "pathetic", "stupid", "worthless"))
CATEGORIES = ("insult", "contempt", "toxic")
STARTS = (4, 5, 6, 7)
RUN = 5
_WORD = re.compile(r"\w+")


def grams(piece: str) -> set[str]:
    """Words of a lower-case piece of text, in angle brackets, their starts, and runs of 5 characters."""
    out = set()
    for word in _WORD.findall(piece):
        out.add(f"<{word}>")
        out.update(f"<{word[:size]}" for size in STARTS if len(word) >= size)
        out.update(word[i:i + RUN] for i in range(len(word) - RUN + 1))
    return out


def pieces(text: str | None) -> set[str]:
    return set((text or "").lower().split())


def category_labels(text: str | None, toxic: int) -> tuple[int, ...]:
    words = {w for p in pieces(text) for w in _WORD.findall(p)} if toxic else set()
    return int(bool(words & INSULTS)), int(bool(words & CONTEMPT)), int(bool(toxic))


@dataclass
class Chain:
    """features: number of each; weights[c]: of the features, the earlier categories, the constant."""

    features: dict[str, int]
    weights: list[np.ndarray]

    def probabilities(self, found: np.ndarray) -> list[float]:
        """One per category, for a text with the features of these numbers."""
        n, out = len(self.features), []
        for w in self.weights:
            z = w[found].sum() + w[-1] + float(np.dot(w[n:-1], out))
            out.append(float(_sigmoid(z)))
        return out


def _sigmoid(z):
    return 0.5 * (1.0 + np.tanh(0.5 * np.asarray(z, dtype=np.float64)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Weights and, last, the constant of a logistic regression with an L2 penalty (Newton, CG)."""
    w = np.zeros(x.shape[1] + 1)
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-3
    for _ in range(20):
        p = _sigmoid(x @ w[:-1] + w[-1])
        error = p - y
        gradient = np.append(x.T @ error, error.sum()) + ridge * w
        if np.abs(gradient).max() < 1e-3:
            break
        curve = p * (1 - p)

        def hessian(v):
            s = curve * (x @ v[:-1] + v[-1])
            return np.append(x.T @ s, s.sum()) + ridge * v

        step, r = np.zeros(len(w)), -gradient
        d, rr = r.copy(), r @ r
        for _ in range(40):
            h = hessian(d)
            a = rr / (d @ h)
            step += a * d
            r = r - a * h
            new = r @ r
            if new < 1e-4 * (gradient @ gradient):
                break
            d, rr = r + new / rr * d, new
        w = w + step
    return w


def fit_chain(x: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> list[np.ndarray]:
    """Models of the columns of `labels` in order; `folds` has each row's fold."""
    earlier, weights = np.zeros((len(x), 0)), []
    for y in labels.T:
        full = np.hstack([x, earlier])
        held_out = np.zeros(len(x))
        for fold in np.unique(folds):
            inside = folds == fold
            w = fit_logistic(full[~inside], y[~inside])
            held_out[inside] = _sigmoid(full[inside] @ w[:-1] + w[-1])
        weights.append(fit_logistic(full, y))
        del full  # the next one is as large
        earlier = np.hstack([earlier, held_out[:, None]])
    return weights


def train(docs: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE,
          features: int = FEATURES) -> Chain:
    """A chain from the labelled rows with the smallest hashes of ids, `sample` of each class at most.

    Of several labels of a document the largest counts, of several texts the smallest. If the
    labelled texts are of one class, or there are none, there is no model and nothing is toxic.
    The driver gets the best `features` features and the numbers of each sampled text's.
    """
    labelled = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
                .filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
                .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64("doc_id")
    chosen = labelled.filter("toxic = 1").orderBy(order, "doc_id").limit(sample[1]).unionByName(
        labelled.filter("toxic = 0").orderBy(order, "doc_id").limit(sample[0]))
    texts = materialize(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
                        .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))

    def count(batches):
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                for g in set().union(*map(grams, pieces(text.as_py()))):
                    seen.setdefault(g, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()),
                 pa.array([v[1] for v in seen.values()], pa.int64())], ["gram", "clean", "bad"])

    counted = (texts.select("text", "toxic").mapInArrow(count, "gram string, clean bigint, bad bigint")
               .groupBy("gram").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad")))
    sizes = dict(texts.groupBy("toxic").count().collect())
    n_bad, n_clean = sizes.get(1, 0) + 1.0, sizes.get(0, 0) + 1.0
    log_odds = F.log((F.col("bad") + 0.5) / n_bad) - F.log((F.col("clean") + 0.5) / n_clean)
    best = (counted.filter(F.col("bad") + F.col("clean") >= LEAST_TEXTS)
            .select("gram", (F.abs(log_odds) * (F.col("bad") / n_bad + F.col("clean") / n_clean))
                    .alias("value"))
            .orderBy(F.desc("value"), "gram").limit(features))
    number = {row.gram: i for i, row in enumerate(best.collect())}

    def vectors(batches):
        for batch in batches:
            rows = [(text.as_py(), toxic) for text, toxic in zip(batch.column(1), batch.column(2).to_pylist())]
            found = [sorted({number[g] for p in pieces(t) for g in grams(p) if g in number}) for t, _ in rows]
            marks = [list(category_labels(t, toxic)) for t, toxic in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int32())),
                 pa.array(marks, pa.list_(pa.int32()))], ["doc_id", "found", "marks"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    rows = sorted(texts.select("doc_id", "text", "toxic").mapInArrow(
        vectors, f"doc_id {kind}, found array<int>, marks array<int>").collect())
    x = np.zeros((len(rows), len(number)), dtype=np.uint8)
    for i, row in enumerate(rows):
        x[i, row.found] = 1
    marks = np.array([row.marks for row in rows], dtype=np.float64).reshape(len(rows), len(CATEGORIES))
    del rows  # lists of numbers take more than x
    release_memory()
    if len(np.unique(marks[:, -1])) < 2:  # nothing tells toxic texts from others
        return Chain({}, [np.append(np.zeros(c), -20.0) for c in range(len(CATEGORIES))])
    return Chain(number, fit_chain(x, marks, np.arange(len(x)) % FOLDS))


def _scorer(chain: Chain):
    """Probabilities of a text; remembers the features of pieces seen before."""
    known: dict[str, tuple[int, ...]] = {}
    number = chain.features

    def score(text: str | None) -> list[float]:
        found: set[int] = set()
        for piece in pieces(text):
            numbers = known.get(piece)
            if numbers is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                numbers = known[piece] = tuple(number[g] for g in grams(piece) if g in number)
            if numbers:
                found.update(numbers)
        return chain.probabilities(np.array(sorted(found), dtype=np.int64))

    return score


def score(docs: DataFrame, chain: Chain, prefix: str = "p_") -> DataFrame:
    """doc_id and a probability per category of every text.

    NULL and empty texts have no features. Texts are read whole. Repeated rows and NULL ids each
    get their row; no rows give no rows. Columns other than doc_id and text are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(chain))
    names = [prefix + c for c in CATEGORIES]

    def apply(batches):
        probabilities = _scorer(Chain(**shared.value))
        for batch in batches:
            p = np.array([probabilities(t.as_py()) for t in batch.column(1)]).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(p[:, k]) for k in range(len(names)))], ["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        apply, f"doc_id {kind}, " + ", ".join(f"{n} double" for n in names))


def keep_clean(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """Whole rows of `docs` whose text is not toxic, in one pass without a shuffle.

    NULL and empty texts have no features and stay if the chain's base rate is below the threshold.
    Repeated rows, NULL ids and further columns of any name stay as they are. No rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(chain))
    at = docs.columns.index("text")

    def apply(batches):
        probabilities = _scorer(Chain(**shared.value))
        for batch in batches:
            clean = [probabilities(t.as_py())[-1] < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(clean, pa.bool_()))
        del probabilities
        release_memory()

    return docs.mapInArrow(apply, docs.schema)
