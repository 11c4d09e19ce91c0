"""Nearest neighbours by largest inner product: multiprobe p-stable hashing.

Vectors are scaled by the largest norm and get one more component that makes their length 1;
the nearest of those by distance is the one with the largest inner product. A table hashes a
vector to the cell floor((a·x + b) / w) of PROJECTIONS Gaussian projections. A query visits, in
each table, cells around its own in the order of the squared distance from its projections to the
cell (the estimated success order of perturbations), up to a cutoff. The cutoff is set so that,
for a bounded sample of queries, the cells of RECALL of the true neighbours are visited. Queries that
find too few there go on through all other cells. The candidates of all tables are scored exactly on the original vectors, in blocks, and merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import materialize, salted_join, ship

ship(__name__)

TABLES = 2
PROJECTIONS = 10
WIDTH = 2.5
RECALL = 0.96
# queries whose true neighbours set the cutoff, at most
SAMPLE = 128
# bytes of vectors that a task holds
PART_BYTES = 8_000_000
_QUERIES_AT_ONCE = 128
_EPSILON = 1e-9


def _vectors(column: pa.Array) -> np.ndarray:
    """Binary column of doubles as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(len(column), -1)


def prepare(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, vec (doubles as bytes): without the vectors that take no part.

    These are NULL, empty and zero vectors, vectors with a NULL or non-finite component, and such
    without id. All others must have one length.
    """
    def convert(batches):
        for batch in batches:
            ids, out = [], []
            for key, value in zip(batch.column(0), batch.column(1)):
                if not key.is_valid or not value.is_valid or value.values.null_count or not len(value.values):
                    continue
                x = value.values.to_numpy(zero_copy_only=False).astype("<f8")
                if np.isfinite(x).all() and x.any():
                    ids.append(key)
                    out.append((x + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k.as_py() for k in ids], pa.int64()), pa.array(out, pa.binary())], ["id", "vec"])

    return vectors.select(F.col(id_column).cast("long").alias("id"), vector_column).mapInArrow(
        convert, "id bigint, vec binary")


def distinct_vectors(prepared: DataFrame, keep: int) -> DataFrame:
    """vec, ids: each different vector once, with the `keep` smallest ids that have it.

    More of them can't be among a query's nearest, as ties go to smaller ids.
    """
    order = F.dense_rank().over(Window.partitionBy("vec").orderBy("id"))
    return (prepared.withColumn("place", order).filter(F.col("place") <= keep)
            .groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("ids")))


class Tables:
    """The hash functions, from a fixed seed."""

    def __init__(self, dimensions: int, largest: float, tables: int = TABLES,
                 projections: int = PROJECTIONS, width: float = WIDTH, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.largest, self.width = largest, width
        self.a = rng.normal(size=(tables, dimensions + 1, projections))
        self.b = rng.uniform(0, width, size=(tables, projections))

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Vectors of the index, at unit length by one more component."""
        scaled = x / self.largest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(axis=1, keepdims=True)))
        return np.hstack([scaled, rest])

    @staticmethod
    def queries(q: np.ndarray) -> np.ndarray:
        unit = q / np.linalg.norm(q, axis=1, keepdims=True)
        return np.hstack([unit, np.zeros((len(q), 1))])

    def places(self, table: int, points: np.ndarray) -> np.ndarray:
        return (points @ self.a[table] + self.b[table]) / self.width


def perturbation(places: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance from each place to each box of cells [low, high], in cell widths."""
    below = np.maximum(low[None] - places[:, None], 0)
    above = np.maximum(places[:, None] - high[None] - 1, 0)
    return (below**2 + above**2).sum(axis=2)


def _top(query: np.ndarray, x: np.ndarray, ids: list, near: np.ndarray, k: int) -> tuple[list, list]:
    """ids and exact scores of the k nearest; `near` numbers the rows of x to look at."""
    scores = (x[near] * query).sum(axis=1)
    found = sorted((-s, i) for s, n in zip(scores.tolist(), near) for i in ids[n])[:k]
    return [i for _, i in found], [-s for s, _ in found]


def _nearest(products: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k largest products and of those equal to the last, -inf left out."""
    if len(products) > k:
        least = np.partition(products, len(products) - k)[len(products) - k]
        if least > -math.inf:
            return np.flatnonzero(products >= least - _EPSILON)
    return np.flatnonzero(products > -math.inf)


def _true_neighbours(distinct: DataFrame, sample: np.ndarray, k: int) -> list:
    """(number of the sampled query, neighbour's vector) by brute force over all vectors."""
    shared = distinct.sparkSession.sparkContext.broadcast(sample)

    def scan(batches):
        q = shared.value
        for batch in batches:
            if batch.num_rows:
                x = _vectors(batch.column(0))
                products = q @ x.T
                for i in range(len(q)):
                    near = _nearest(products[i], k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i] * len(near), pa.int32()), batch.column(0).take(pa.array(near)),
                         pa.array(products[i][near])], ["q", "vec", "score"])

    found = distinct.select("vec").mapInArrow(scan, "q int, vec binary, score double")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec"))
    return found.withColumn("place", place).filter(F.col("place") <= k).select("q", "vec").collect()


def set_cutoff(tables: Tables, sample: np.ndarray, truth: list, recall: float = RECALL) -> float:
    """Distance of cells up to which `recall` of the true neighbours lie in a visited cell."""
    if not truth:
        return 0.0
    which = np.array([row[0] for row in truth])
    x = np.stack([np.frombuffer(row[1], dtype="<f8") for row in truth])
    points, queries = tables.rows(x), tables.queries(sample)
    best = np.full(len(x), math.inf)
    for t in range(len(tables.a)):
        cell = np.floor(tables.places(t, points))
        place = tables.places(t, queries)[which]
        gap = np.maximum(cell - place, 0)**2 + np.maximum(place - cell - 1, 0)**2
        best = np.minimum(best, gap.sum(axis=1))
    return float(np.quantile(best, recall)) + _EPSILON


def _search_part(shared, k: int):
    """Function for partitions in which each part's vectors come before its queries."""
    def search(batches):
        settings = shared.value
        tables = Tables(**settings["tables"])
        cutoff = settings["cutoff"]
        part, held, ready = None, [], None
        for batch in batches:
            parts = batch.column(0).to_numpy()
            kinds = batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(parts) != 0) | (np.diff(kinds) != 0)) + 1
            for rows in np.split(np.arange(len(parts)), cuts):
                if not len(rows):
                    continue
                piece = batch.slice(int(rows[0]), len(rows))
                if parts[rows[0]] != part:
                    part, held, ready = parts[rows[0]], [], None
                if kinds[rows[0]] == 0:
                    held.append(piece)
                    continue
                if not held:
                    continue
                ready = ready or _ready(held, tables)
                for at in range(0, piece.num_rows, _QUERIES_AT_ONCE):
                    some = piece.slice(at, _QUERIES_AT_ONCE)
                    yield _answer(some, ready, tables, cutoff, k)

    return search


def _ready(held: list, tables: Tables) -> tuple:
    """Different vectors of a part, their ids, and per table the cells and each vector's cell."""
    number: dict[bytes, int] = {}
    which = np.array([number.setdefault(v, len(number)) for b in held for v in b.column(3).to_pylist()])
    x = np.frombuffer(b"".join(number), dtype="<f8").reshape(len(number), -1)
    listed = [i for b in held for i in b.column(4).to_pylist()]
    ids: list = [None] * len(number)
    for n, i in zip(which, listed):
        ids[n] = i
    table = np.concatenate([b.column(2).to_numpy() for b in held])
    points, cells = tables.rows(x), []
    for t in np.unique(table):
        mine = np.unique(which[table == t])
        found, of = np.unique(np.floor(tables.places(t, points[mine])), axis=0, return_inverse=True)
        cells.append((int(t), mine, found, of.ravel()))
    return x, ids, cells


def _answer(batch: pa.RecordBatch, ready: tuple, tables: Tables, cutoff: float, k: int) -> pa.RecordBatch:
    x, ids, cells = ready
    q = _vectors(batch.column(3))
    points = tables.queries(q)
    candidate = np.zeros((len(q), len(x)), dtype=bool)
    for t, mine, found, of in cells:
        visited = perturbation(tables.places(t, points), found, found) <= cutoff
        candidate[:, mine] |= visited[:, of]
    products = np.where(candidate, q @ x.T, -math.inf)
    answers = [_top(q[i], x, ids, _nearest(products[i], k), k) for i in range(len(q))]
    return pa.RecordBatch.from_arrays(
        [batch.column(3), pa.array([a for a, _ in answers], pa.list_(pa.int64())),
         pa.array([s for _, s in answers], pa.list_(pa.float64()))], ["vec", "ids", "scores"])


def _merge(k: int):
    """Function for partitions sorted by query: one row per query with the k best, ids once."""
    def best(vec, rows):
        score: dict[int, float] = {}
        for ids, scores in rows:
            for i, s in zip(ids, scores):
                score[i] = max(s, score.get(i, -math.inf))
        found = sorted((-s, i) for i, s in score.items())[:k]
        return vec, [i for _, i in found], [-s for s, _ in found]

    def merge(batches):
        last, rows = None, []
        for batch in batches:
            out = []
            for vec, ids, scores in zip(*(c.to_pylist() for c in batch.columns)):
                if vec != last:
                    if rows:
                        out.append(best(last, rows))
                    last, rows = vec, []
                rows.append((ids, scores))
                if len(rows) >= 64:  # keeps what is held small
                    rows = [best(last, rows)[1:]]
            if out:
                yield _merged(out)
        if rows:
            yield _merged([best(last, rows)])

    return merge


def _merged(out: list) -> pa.RecordBatch:
    vec, ids, scores = zip(*out)
    return pa.RecordBatch.from_arrays(
        [pa.array(vec, pa.binary()), pa.array(ids, pa.list_(pa.int64())),
         pa.array(scores, pa.list_(pa.float64()))], ["vec", "ids", "scores"])


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id",
           vector_column: str = "embedding", tables: int = TABLES, projections: int = PROJECTIONS,
           width: float = WIDTH, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row for which is_query (of `id`).

    Candidates are all rows but those with the query's id; ties go to smaller ids. Vectors that
    are NULL, empty, zero or hold NULL or non-finite components, and NULL ids, take no part.
    Equal vectors are looked up once. A query that finds fewer than k + 1 ids, itself included, or than
    there are, up to the cutoff is compared with all vectors, so each gets min(k, all candidates) rows. Rows repeated with one id count once. No rows give no rows.
    Columns other than id and vector are not read.
    """
    spark = vectors.sparkSession
    prepared = materialize(prepare(vectors, id_column, vector_column))
    keep = k + 1
    distinct = materialize(distinct_vectors(prepared, keep))
    n, size, largest = _measure(distinct)
    asked = prepared.filter(is_query).select("id", "vec").distinct()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    queries = materialize(asked)
    wanted = queries.select("vec").distinct()
    sample = [r.vec for r in wanted.orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).collect()]
    sample = np.stack([np.frombuffer(v, dtype="<f8") for v in sample]) if sample else np.ones((1, size))
    settings = {"dimensions": size, "largest": largest, "tables": tables,
                "projections": projections, "width": width}
    hashes = Tables(**settings)
    cutoff = set_cutoff(hashes, sample, _true_neighbours(distinct, sample, k), recall)
    shared = spark.sparkContext.broadcast({"tables": settings})

    def index(batches):
        made = Tables(**shared.value["tables"])
        for batch in batches:
            if not batch.num_rows:
                continue
            points = made.rows(_vectors(batch.column(0)))
            for t in range(len(made.a)):
                cell = np.floor(made.places(t, points)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t] * len(points), pa.int32()), pa.array(cell.tolist(), pa.list_(pa.int32())),
                     *batch.columns], ["table", "cell", "vec", "ids"])

    # Parts are ranges of cells; rows of one cell may lie in several, so none is too large.
    n_parts = math.ceil(n * tables * (8 * size + 100) / PART_BYTES)
    indexed = materialize(
        distinct.select("vec", "ids").mapInArrow(
            index, "table int, cell array<int>, vec binary, ids array<bigint>")
        .repartitionByRange(n_parts, "table", "cell", F.xxhash64("vec"))
        .withColumn("part", F.spark_partition_id()))
    boxes = indexed.groupBy("part", "table").agg(*(
        f(F.col("cell")[i]).alias(f"{name}{i}") for i in range(projections)
        for f, name in ((F.min, "low"), (F.max, "high")))).collect()
    corners = spark.sparkContext.broadcast([
        (r.part, r.table, [r[f"low{i}"] for i in range(projections)],
         [r[f"high{i}"] for i in range(projections)]) for r in boxes])

    none = F.array().cast("array<bigint>")

    def look_up(asked_vectors: DataFrame, cut: float) -> DataFrame:
        """vec, ids, scores: the best of the cells up to distance `cut`."""
        limits = spark.sparkContext.broadcast({"tables": settings, "cutoff": cut})

        def reach(batches):
            """Parts of which a query may visit a cell."""
            made = Tables(**limits.value["tables"])
            for batch in batches:
                if not batch.num_rows:
                    continue
                points = made.queries(_vectors(batch.column(0)))
                to = [set() for _ in range(len(points))]
                for t in range(len(made.a)):
                    mine = [c for c in corners.value if c[1] == t]
                    if not mine:
                        continue
                    near = perturbation(made.places(t, points), np.array([c[2] for c in mine]),
                                        np.array([c[3] for c in mine])) <= cut
                    for i, j in zip(*np.nonzero(near)):
                        to[i].add(mine[j][0])
                rows = [(p, i) for i, parts in enumerate(to) for p in sorted(parts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in rows], pa.int32()),
                     batch.column(0).take(pa.array([i for _, i in rows], pa.int64()))], ["part", "vec"])

        # any one table has all vectors
        indexed_rows = indexed if cut < math.inf else indexed.filter(F.col("table") == 0)
        rows = indexed_rows.select("part", F.lit(0).alias("kind"), "table", "vec", "ids").unionByName(
            asked_vectors.mapInArrow(reach, "part int, vec binary")
            .select("part", F.lit(1).alias("kind"), F.lit(0).alias("table"), "vec", none.alias("ids")))
        answers = (rows.repartition(max(n_parts, 1), "part").sortWithinPartitions("part", "kind")
                   .mapInArrow(_search_part(limits, keep), "vec binary, ids array<bigint>, scores array<double>"))
        return (answers.repartition("vec").sortWithinPartitions("vec")
                .mapInArrow(_merge(keep), "vec binary, ids array<bigint>, scores array<double>"))

    enough = min(keep, prepared.select("id").distinct().count())
    merged = materialize(look_up(wanted, cutoff).filter(F.size("ids") >= enough))
    short = materialize(wanted.join(merged, "vec", "left_anti"))
    if not short.isEmpty():
        merged = merged.unionByName(look_up(short, math.inf))
    ranked = salted_join(queries, merged, ["vec"], F.col("id"), salts=8).filter("ids IS NOT NULL")
    others = F.filter(F.arrays_zip("ids", "scores"), lambda x: x["ids"] != F.col("id"))
    return (ranked.select(F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("rank", "hit"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.ids").alias("vec_id"),
                    F.col("hit.scores").alias("score")))


def _measure(distinct: DataFrame) -> tuple[int, int, float]:
    """Number of vectors, their length, and the largest norm."""
    def measure(batches):
        for batch in batches:
            if batch.num_rows:
                sizes = {len(v.as_buffer()) for v in batch.column(0)}
                if len(sizes) > 1:
                    raise ValueError("vectors differ in length")
                norms = np.linalg.norm(_vectors(batch.column(0)), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(norms)]), pa.array([sizes.pop() // 8]), pa.array([norms.max()])],
                    ["n", "size", "norm"])

    found = distinct.select("vec").mapInArrow(measure, "n bigint, size bigint, norm double").agg(
        F.sum("n"), F.min("size"), F.max("size"), F.max("norm")).first()
    if found[0] and found[1] != found[2]:
        raise ValueError("vectors differ in length")
    return found[0] or 0, found[1] or 0, found[3] or 0.0
