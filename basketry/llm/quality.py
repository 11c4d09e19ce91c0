"""Document quality by votes of the nearest labelled texts in a latent-semantic space.

Terms are the surface forms of words (letter case, digits, punctuation, repetition of the word
before) and pairs of neighbouring forms, weighted by log frequency and inverse document frequency.
A truncated singular value decomposition of the labelled texts' term matrix gives the space.
The labelled vectors, a bounded number, are broadcast; every text's cosines with all of them are
products of blocks, and the nearest vote with their cosines as weights.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import materialize, release_memory, ship

ship(__name__)

# labelled rows to learn from, at most, of each class
SAMPLE = 2000
TERMS = 800
DIMENSIONS = 48
NEIGHBOURS = 25
THRESHOLD = 0.3
BLOCK = 512
HELD_OUT = 5
REMEMBERED = 500_000
_RUNS = ((re.compile(r"[^\W\d_]+"), None), (re.compile(r"\d+"), "0"), (re.compile(r"(.)\1+"), r"\1"))


def _letters(match: re.Match) -> str:
    run = match.group()
    return "A" if run.isupper() and len(run) > 1 else "Aa" if run[0].isupper() else "a"


def form(word: str) -> str:
    """Surface form: runs of letters as a, Aa or A, numbers as 0, runs of a sign as the sign."""
    shape = _RUNS[0][0].sub(_letters, word)
    for pattern, sign in _RUNS[1:]:
        shape = pattern.sub(sign, shape)
    return shape


class Terms:
    """Counts terms of texts; remembers the forms of words seen before."""

    def __init__(self):
        self.known: dict[str, str] = {}

    def counts(self, text: str | None) -> Counter:
        known, forms, last = self.known, [], None
        for word in (text or "").split():
            found = known.get(word)
            if found is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                found = known[word] = form(word)
            forms.append("=" if word == last else found)
            last = word
        out = Counter(forms)
        out.update(zip(forms, forms[1:]))
        return out


def _name(term) -> str:
    return term if isinstance(term, str) else "\t".join(term)


@dataclass
class Model:
    terms: dict[str, int]
    idf: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    base: float

    def weights(self, counts: Counter) -> np.ndarray:
        """Weighted term vector, of length 1, or zeros."""
        x = np.zeros(len(self.terms), dtype=np.float32)
        for term, n in counts.items():
            at = self.terms.get(_name(term))
            if at is not None:
                x[at] = np.log1p(n) * self.idf[at]
        size = np.linalg.norm(x)
        return x / size if size else x

    def votes(self, rows: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Score of each row of weighted terms."""
        if not len(self.labels):
            return np.full(len(rows), self.base)
        at = _unit(rows @ self.space)
        cosines = at @ self.vectors.T
        k = min(neighbours, len(self.labels))
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        near = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0).astype(np.float64)
        total = near.sum(axis=1)
        vote = (near * self.labels[nearest]).sum(axis=1)
        return np.where(total > 0, vote / np.where(total > 0, total, 1), self.base)


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, size, out=np.zeros_like(rows), where=size > 1e-6)


def is_held_out():
    """Column: the row's label is kept for tests."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, terms: int = TERMS,
          dimensions: int = DIMENSIONS) -> Model:
    """Learns from labelled rows that are not held out: `sample` of each class, by hash of the id.

    Of several labels of a document the smallest counts, of several texts the smallest. The driver
    gets term counts of the sampled texts, at most `terms` terms.
    """
    labelled = (labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
                .filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(~is_held_out())
                .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    base = labelled.agg(F.avg("quality")).first()[0]
    order = F.xxhash64("doc_id")
    chosen = [labelled.filter(F.col("quality") == q).orderBy(order, "doc_id").limit(sample) for q in (0, 1)]
    texts = materialize(
        docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
        .groupBy("doc_id", "quality").agg(F.min("text").alias("text")))

    def count(batches):
        counter = Terms()
        for batch in batches:
            for doc_id, quality, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                             batch.column(2)):
                found = counter.counts(text.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id] * len(found), batch.column(0).type),
                     pa.array([quality] * len(found), pa.int32()),
                     pa.array([_name(t) for t in found], pa.string()),
                     pa.array(list(found.values()), pa.int64())], ["doc_id", "quality", "term", "n"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    counted = materialize(texts.select("doc_id", "quality", "text").mapInArrow(
        count, f"doc_id {kind}, quality int, term string, n bigint"))
    total = texts.count()
    frequent = (counted.groupBy("term").agg(F.count("*").alias("df"))
                .orderBy(F.desc("df"), "term").limit(terms))
    listed = frequent.collect()
    number = {row.term: i for i, row in enumerate(listed)}
    idf = np.array([np.log((1 + total) / (1 + row.df)) + 1 for row in listed], dtype=np.float32)
    model = Model(number, idf, np.zeros((len(number), 0), np.float32), np.zeros((0, 0), np.float32),
                  np.zeros(0), 0.5 if base is None else float(base))
    per_text = (counted.join(F.broadcast(frequent.select("term")), "term")
                .groupBy("doc_id", "quality").agg(F.collect_list(F.struct("term", "n")).alias("found")))
    rows = sorted(per_text.collect(), key=lambda r: r.doc_id)
    if not rows:
        return model
    x = np.stack([model.weights(Counter({t: n for t, n in r.found})) for r in rows])
    values, axes = np.linalg.eigh(x.T @ x)
    k = min(dimensions, int((values > 1e-6).sum()))
    model.space = np.ascontiguousarray(axes[:, ::-1][:, :k])
    model.vectors = _unit(x @ model.space)
    model.labels = np.array([r.quality for r in rows], dtype=np.float64)
    return model


def _scores(model: Model, texts, counter: Terms) -> np.ndarray:
    out = []
    for at in range(0, len(texts), BLOCK):
        block = [model.weights(counter.counts(t.as_py())) for t in texts[at:at + BLOCK]]
        out.append(model.votes(np.stack(block)))
    return np.concatenate(out) if out else np.zeros(0)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every text.

    Only the text enters the score. A text without words or known terms gets the share of label 1
    among the labelled rows. Repeated rows and NULL ids (never held out) each get their row; no
    rows give no rows. Columns other than doc_id and text are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def apply(batches):
        counter, known = Terms(), Model(**shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_scores(known, batch.column(1), counter), pa.float64())],
                ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(apply, f"doc_id {kind}, score double")
    return scored.select("doc_id", is_held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Whole rows of `docs` with a predicted label 1, in one pass without a shuffle.

    NULL and empty texts score the share of label 1 among the labelled rows. If all labels are of
    one class, nothing tells good texts from poor ones and all stay. Repeated rows, NULL ids and
    further columns of any name stay as they are. No rows give no rows.
    """
    if model.base in (0.0, 1.0):
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    at = docs.columns.index("text")

    def apply(batches):
        counter, known = Terms(), Model(**shared.value)
        for batch in batches:
            scores = _scores(known, batch.column(at), counter)
            yield batch.filter(pa.array(scores >= threshold, pa.bool_()))
        del counter, known
        release_memory()

    return docs.mapInArrow(apply, docs.schema)
