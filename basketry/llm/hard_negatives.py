"""Hard negatives by an inverted multi-index.

Each half of the vectors has a codebook; a pair of codes is a cell. For an anchor, a code's bound is the
half's product with the centre plus the half's length times the code's radius: no row of the code
scores more. A heap merges the two sorted lists of bounds and so gives the cells by falling sum. An
anchor visits cells in that order, in rounds of more and more rows, until what it has found is
certain: its list is full and its last entry scores more than the next cell's bound, or that bound is
below what is asked for. What is found is exact; the codebooks, fitted on a bounded sample, only
decide how many rows are visited.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import materialize, shuffle_partitions, ship

ship(__name__)

# Vectors are counted in steps of 1 / SCALE.
SCALE = 256
POSITIVES = 5
NEGATIVES = 10
# A negative's score lies between these tenths of the positive's.
LOW_TENTHS, HIGH_TENTHS = 3, 9
# rows that fit the codebooks, at most
SAMPLE = 8192
# rows a cell should have, and the most centres a codebook has
CELL_ROWS = 64
MOST_CENTRES = 256
# rows an anchor visits in the first round, and how many times as many in each further one
FIRST_ROWS = 4096
GROWTH = 16
# bytes of vectors that a part has; a task holds one part at a time
PART_BYTES = 8_000_000
_AT_ONCE = 128
_EXACT = 2.0**53
_FAR = 1 << 62


def _vectors(column: pa.Array) -> np.ndarray:
    """Binary column of doubles as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(len(column), -1)


def prepare(vectors: DataFrame, id_column: str, label_column: str, vector_column: str,
            scale: int = SCALE) -> DataFrame:
    """id, label, vec (whole numbers floor(scale · x), as bytes of doubles): rows that take part, each once.

    Not those with a NULL id, label or vector, an empty vector, or a NULL or non-finite component.
    """
    def convert(batches):
        for batch in batches:
            rows = []
            for key, label, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if key is None or label is None or not value.is_valid or value.values.null_count or not len(value.values):
                    continue
                x = value.values.to_numpy(zero_copy_only=False).astype("<f8")
                if np.isfinite(x).all():
                    steps = np.floor(scale * x) + 0.0
                    if np.abs(steps).max() > _FAR:
                        raise ValueError("a component is too large for scores of 64 bits")
                    rows.append((key, label, steps.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.binary())], ["id", "label", "vec"])

    return vectors.select(F.col(id_column).cast("bigint"), F.col(label_column).cast("bigint"), vector_column).mapInArrow(
        convert, "id bigint, label bigint, vec binary").distinct()


def distinct_vectors(prepared: DataFrame, keep: int) -> DataFrame:
    """vec, label, ids: each different vector of a label once, with the `keep` smallest ids that have it.

    Of rows that score alike the smaller ids come first, so no others can be asked for.
    """
    order = F.row_number().over(Window.partitionBy("vec", "label").orderBy("id"))
    return (prepared.withColumn("place", order).filter(F.col("place") <= keep)
            .groupBy("vec", "label").agg(F.sort_array(F.collect_list("id")).alias("ids")))


# ---------------------------------------------------------------------------- index

def fit_codebook(x: np.ndarray, centres: int, steps: int = 8) -> np.ndarray:
    """Centres of a half by k-means from a spread sample of its rows."""
    if not x.shape[1]:
        return np.zeros((1, 0))
    rows = np.unique(x, axis=0)
    chosen = rows[np.linspace(0, len(rows) - 1, min(centres, len(rows))).astype(int)]
    for _ in range(steps):
        code = _codes(x, chosen)[0]
        sums = np.zeros_like(chosen)
        np.add.at(sums, code, x)
        n = np.bincount(code, minlength=len(chosen))
        chosen = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], chosen)
    return chosen


def _codes(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each row, and the distance from it."""
    gaps = (centres**2).sum(axis=1) - 2 * (x @ centres.T)
    code = gaps.argmin(axis=1)
    return code, np.linalg.norm(x - centres[code], axis=1)


@dataclass
class Index:
    """Two codebooks; per cell its rows, the radii of its halves, its first part and number of parts."""

    centres: list[np.ndarray]
    rows: np.ndarray
    radii: np.ndarray
    first_part: np.ndarray
    parts: np.ndarray

    def __post_init__(self):
        k = [len(c) for c in self.centres]
        by_code = self.radii.reshape(2, *k)
        self.code_radii = [by_code[0].max(axis=1), by_code[1].max(axis=0)]
        # no bound may be too low for the rounding of doubles
        self.slack = 1e-9 * (1 + max(float(np.abs(c).max(initial=0)) for c in self.centres))

    def halves(self, x: np.ndarray) -> list[np.ndarray]:
        at = self.centres[0].shape[1]
        return [x[:, :at], x[:, at:]]

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each row, and its distances from both centres."""
        (a, near_a), (b, near_b) = (_codes(h, c) for h, c in zip(self.halves(x), self.centres))
        return a * len(self.centres[1]) + b, np.stack([near_a, near_b])

    def visits(self, query: np.ndarray) -> Iterator[tuple[int, float, float, float]]:
        """All cells as cell, bound, the most and the least its rows can score: by falling bound.

        The bound is the sum of those of both codes; the cell's own radii give the other two.
        """
        halves = [h[0] for h in self.halves(query[None])]
        lengths = [float(np.linalg.norm(h)) for h in halves]
        products = [c @ h for c, h in zip(self.centres, halves)]
        slack = self.slack * (1 + sum(lengths))
        bounds = [p + n * r for p, n, r in zip(products, lengths, self.code_radii)]
        order = [np.argsort(-b, kind="stable").tolist() for b in bounds]
        high = [[float(b[i]) for i in o] for b, o in zip(bounds, order)]
        width = len(self.centres[1])
        heap = [(-(high[0][0] + high[1][0]), 0, 0)]
        while heap:
            minus, i, j = heapq.heappop(heap)
            if j + 1 < len(order[1]):
                heapq.heappush(heap, (-(high[0][i] + high[1][j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(order[0]):
                heapq.heappush(heap, (-(high[0][i + 1] + high[1][0]), i + 1, 0))
            a, b = order[0][i], order[1][j]
            cell = a * width + b
            middle = float(products[0][a] + products[1][b])
            reach = lengths[0] * float(self.radii[0, cell]) + lengths[1] * float(self.radii[1, cell]) + slack
            yield cell, -minus + slack, middle + reach, middle - reach


def build_index(distinct: DataFrame, cell_rows: int = CELL_ROWS, part_bytes: int = PART_BYTES,
                sample: int = SAMPLE) -> tuple[DataFrame, Index, bool] | None:
    """part, cell, label, vec, ids of each vector, the index, and if products of doubles are exact.

    Codebooks are fitted on the `sample` vectors with the smallest hashes, at most; cells, radii and
    counts are of all. The driver gets a row per cell, of which there are at most MOST_CENTRES².
    """
    spark = distinct.sparkSession
    chosen = [r.vec for r in distinct.select("vec").distinct().orderBy(F.xxhash64("vec"), "vec").limit(sample).collect()]
    if not chosen:
        return None
    if len({len(v) for v in chosen}) > 1:
        raise ValueError("vectors differ in length")
    x = np.stack([np.frombuffer(v, dtype="<f8") for v in chosen])
    n, at = distinct.count(), x.shape[1] // 2
    k = min(MOST_CENTRES, max(1, math.ceil(math.sqrt(n / cell_rows))))
    books = [fit_codebook(x[:, :at], k), fit_codebook(x[:, at:], k)]
    size, width = x.shape[1], len(books[1])
    shared = spark.sparkContext.broadcast(books)

    def code(batches):
        empty = np.zeros((2, len(shared.value[0]) * width))
        index = Index(shared.value, empty[0], empty, empty[0], empty[0])
        for batch in batches:
            if not batch.num_rows:
                continue
            if any(len(v.as_buffer()) != 8 * size for v in batch.column(0)):
                raise ValueError("vectors differ in length")
            rows = _vectors(batch.column(0))
            cell, near = index.cells(rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32()), pa.array(near[0]), pa.array(near[1]),
                 pa.array((rows**2).sum(axis=1))], [*batch.schema.names, "cell", "near0", "near1", "square"])

    coded = materialize(distinct.select("vec", "label", "ids").mapInArrow(
        code, "vec binary, label bigint, ids array<bigint>, cell int, near0 double, near1 double, square double"))
    found = coded.groupBy("cell").agg(F.count("*").alias("n"), F.max("near0").alias("r0"), F.max("near1").alias("r1"),
                                      F.max("square").alias("square")).collect()
    cells = len(books[0]) * width
    rows, radii = np.zeros(cells, dtype=np.int64), np.zeros((2, cells))
    for r in found:
        rows[r.cell], radii[:, r.cell] = r.n, (r.r0, r.r1)
    # neighbouring cells share a part, a cell of more rows than a part has several
    part_rows = max(1, part_bytes // (8 * size + 64))
    parts = np.maximum(1, -(-rows // part_rows))
    first, part, held = np.zeros(cells, dtype=np.int64), 0, 0
    for c in range(cells):
        if parts[c] > 1 or held + rows[c] > part_rows:
            part, held = part + bool(held), 0
        first[c] = part
        if parts[c] > 1:
            part += int(parts[c])
        else:
            held += rows[c]
    index = Index(books, rows, radii, first, parts)
    places = spark.sparkContext.broadcast((first, parts))

    def place(batches):
        first_part, n_parts = places.value
        for batch in batches:
            cell = batch.column(0).to_numpy()
            spread = np.array([zlib.crc32(v.as_buffer()) for v in batch.column(1)], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(first_part[cell] + spread % n_parts[cell], pa.int32()), *batch.columns],
                ["part", "cell", "vec", "label", "ids"])

    placed = coded.select("cell", "vec", "label", "ids").mapInArrow(
        place, "part int, cell int, vec binary, label bigint, ids array<bigint>")
    return materialize(placed), index, max(r.square for r in found) < _EXACT


# ---------------------------------------------------------------------------- search

def best(scores: np.ndarray, rows: np.ndarray, ids_of, k: int) -> list[tuple[int, int]]:
    """(score, id) of the k first by falling score and rising id; every row has at least one of ids_of(row)."""
    if len(scores) > k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        near = np.arange(len(scores))
    found = sorted((-int(scores[n]), i) for n in near for i in ids_of(rows[n]))[:k]
    return [(-s, i) for s, i in found]


class _Part:
    """The vectors of a part, by cell."""

    def __init__(self, held: list, exact: bool):
        table = pa.Table.from_batches(held)
        cell = table["cell"].to_numpy()
        order = np.argsort(cell, kind="stable")
        self.x = _vectors(table["vec"].combine_chunks())[order]
        self.label = table["label"].to_numpy()[order]
        ids = table["ids"].to_pylist()
        self.ids = [ids[i] for i in order]
        self.lone: dict[int, list[int]] = {}  # rows that have no other id
        for row, listed in enumerate(self.ids):
            if len(listed) == 1:
                self.lone.setdefault(listed[0], []).append(row)
        found, start = np.unique(cell[order], return_index=True)
        self.range = dict(zip(found.tolist(), zip(start.tolist(), [*start[1:].tolist(), len(order)])))
        self.exact = exact
        if not exact:
            self.x = _whole(self.x)

    def answer(self, batch: pa.RecordBatch, same: bool, k: int) -> pa.RecordBatch:
        """Per anchor and window the k best rows of the cells it visits here."""
        columns = {n: batch.column(n).to_pylist() for n in ("anchor_id", "a", "label", "cells", "lows", "highs")}
        queries = _vectors(batch.column("vec"))
        if not self.exact:
            queries = _whole(queries)
        asked: dict[int, list[int]] = {}
        for i, cells in enumerate(columns["cells"]):
            for c in np.frombuffer(cells, "<i4").tolist():
                asked.setdefault(c, []).append(i)
        scores: list[list] = [[] for _ in queries]
        places: list[list] = [[] for _ in queries]
        for c, who in asked.items():
            if c in self.range:
                low, high = self.range[c]
                for i, row in zip(who, queries[who] @ self.x[low:high].T):
                    scores[i].append(row)
                    places[i].append(np.arange(low, high))
        out = []
        for i in range(len(queries)):
            if not scores[i]:
                continue
            score, place = np.concatenate(scores[i]), np.concatenate(places[i])
            own = columns["anchor_id"][i]
            wanted = self.label[place] == columns["label"][i]
            if same:
                wanted &= ~np.isin(place, self.lone.get(own, []))
            else:
                wanted = ~wanted

            def ids_of(row: int, own=own) -> list[int]:
                return [j for j in self.ids[row] if not same or j != own]

            for w, (low, high) in enumerate(zip(columns["lows"][i], columns["highs"][i])):
                inside = wanted & (score >= low) & (score <= high)
                for s, j in best(score[inside], place[inside], ids_of, k):
                    out.append((own, columns["a"][i], w, s, j))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
            ["anchor_id", "a", "w", "score", "id"])


def _whole(x: np.ndarray) -> np.ndarray:
    """Python's whole numbers, for products beyond what doubles hold exactly."""
    return np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)


def _search_part(exact: bool, same: bool, k: int):
    """Function for partitions in which each part's vectors come before its anchors."""
    def search(batches):
        part, held, ready = None, [], None
        for batch in batches:
            parts, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(parts) != 0) | (np.diff(kinds) != 0)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(parts)]):
                if low == high:
                    continue
                piece = batch.slice(int(low), int(high - low))
                if parts[low] != part:
                    part, held, ready = parts[low], [], None
                if kinds[low] == 0:
                    held.append(piece)
                elif held:
                    ready = ready or _Part(held, exact)
                    for at in range(0, piece.num_rows, _AT_ONCE):
                        yield ready.answer(piece.slice(at, _AT_ONCE), same, k)

    return search


def next_visits(index: Index, query: np.ndarray, done: int, most_rows: int, low: int,
                high: int) -> tuple[list[int], int, float, int]:
    """Cells to visit next, how many were passed in all, the bound of those left (-inf: none), and the rows.

    Cells in which nothing scores between low and high are passed without a visit.
    """
    cells, rows, passed = [], 0, 0
    for cell, bound, most, least in index.visits(query):
        passed += 1
        if passed <= done:
            continue
        if bound < low:
            return cells, passed - 1, -math.inf, rows
        if rows >= most_rows:
            return cells, passed - 1, bound, rows
        if index.rows[cell] and most >= low and least <= high:
            cells.append(cell)
            rows += int(index.rows[cell])
    return cells, passed, -math.inf, rows


_FOUND = "anchor_id bigint, a bigint, w int, score bigint, id bigint"


def search(placed: DataFrame, index: Index, exact: bool, anchors: DataFrame, same: bool, k: int,
           first_rows: int = FIRST_ROWS, growth: int = GROWTH) -> tuple[DataFrame, DataFrame]:
    """Per anchor and window the k first rows that score inside, exactly.

    `anchors` has anchor_id, a (a number of the row), label, vec, lows, highs: windows of scores. With
    `same`, rows of the anchor's label but with another id are sought, else those of other labels. Gives
    (anchor_id, a, w, score, id, place from 1) and (anchor_id, a, seen: rows visited).
    """
    spark = placed.sparkSession
    shared = spark.sparkContext.broadcast(index)
    n_tasks = max(1, min(int(index.first_part.max() + index.parts.max()), 4 * shuffle_partitions(spark)))

    def plan(most_rows: int, with_cells: bool):
        def reach(batches):
            known = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                columns = {n: batch.column(n).to_pylist() for n in ("lows", "highs", "passed")}
                out = []
                for i, query in enumerate(_vectors(batch.column("vec"))):
                    open_windows = [(x, y) for x, y in zip(columns["lows"][i], columns["highs"][i]) if x <= y]
                    low = min((x for x, _ in open_windows), default=_FAR)
                    high = max((y for _, y in open_windows), default=-_FAR)
                    cells, passed, bound, rows = next_visits(known, query, columns["passed"][i], most_rows, low, high)
                    if not with_cells:
                        out.append((i, passed, bound, rows))
                        continue
                    by_part: dict[int, list[int]] = {}
                    for c in cells:
                        first = int(known.first_part[c])
                        for p in range(first, first + int(known.parts[c])):
                            by_part.setdefault(p, []).append(c)
                    out += [(i, p, np.array(c, "<i4").tobytes()) for p, c in by_part.items()]
                which = pa.array([r[0] for r in out], pa.int64())
                if with_cells:
                    kept = batch.select(["anchor_id", "a", "label", "vec", "lows", "highs"]).take(which)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[1] for r in out], pa.int32()), *kept.columns,
                         pa.array([r[2] for r in out], pa.binary())], ["part", *kept.schema.names, "cells"])
                else:
                    kept = batch.select(["anchor_id", "a"]).take(which)
                    yield pa.RecordBatch.from_arrays(
                        [*kept.columns, *(pa.array([r[c] for r in out], t) for c, t in
                                          ((1, pa.int64()), (2, pa.float64()), (3, pa.int64())))],
                        ["anchor_id", "a", "passed", "bound", "rows"])

        return reach

    asked = materialize(anchors.select("anchor_id", "a", "label", "vec", "lows", "highs", F.lit(0).cast("bigint").alias("passed"),
                                       F.lit(0).cast("bigint").alias("seen")))
    found = spark.createDataFrame([], _FOUND)
    seen, most_rows = [], first_rows
    columns = ["part", "kind", "cell", "vec", "label", "ids", "anchor_id", "a", "lows", "highs", "cells"]
    order = Window.partitionBy("anchor_id", "a", "w").orderBy(F.desc("score"), "id")
    while True:
        requests = asked.mapInArrow(plan(most_rows, True), "part int, anchor_id bigint, a bigint, label bigint, "
                                    "vec binary, lows array<bigint>, highs array<bigint>, cells binary")
        rows = placed.withColumn("kind", F.lit(0)).unionByName(
            requests.withColumn("kind", F.lit(1)), allowMissingColumns=True).select(*columns)
        new = (rows.repartition(n_tasks, "part").sortWithinPartitions("part", "kind")
               .mapInArrow(_search_part(exact, same, k), _FOUND))
        found = materialize(found.unionByName(new).withColumn("place", F.row_number().over(order))
                            .filter(F.col("place") <= k).drop("place"))
        ends = materialize(asked.mapInArrow(plan(most_rows, False), "anchor_id bigint, a bigint, passed bigint, "
                                            "bound double, rows bigint"))
        held = (found.groupBy("anchor_id", "a", "w").agg(F.count("*").alias("n"), F.min("score").alias("last"))
                .filter(F.col("n") >= k).groupBy("anchor_id", "a")
                .agg(F.map_from_entries(F.collect_list(F.struct("w", "last"))).alias("full")))
        keys = ["anchor_id", "a"]
        # a window is certain if its list is full and what is left scores less, or what is left is below it
        state = (asked.drop("passed").join(ends, keys).join(held, keys, "left")
                 .withColumn("seen", F.col("seen") + F.col("rows")))
        certain = "bound < lows[i] OR coalesce(full[cast(i AS int)] > bound, false)"
        state = materialize(state.withColumn("highs", F.expr(
            f"transform(highs, (h, i) -> CASE WHEN {certain} THEN lows[i] - 1 ELSE h END)")).withColumn(
            "open", F.expr("exists(arrays_zip(lows, highs), x -> x.lows <= x.highs)")).drop("rows", "bound", "full"))
        seen.append(state.filter(~F.col("open")).select("anchor_id", "a", "seen"))
        asked = materialize(state.filter("open").drop("open"))
        if asked.isEmpty():
            break
        most_rows *= growth
    visited = seen[0]
    for s in seen[1:]:
        visited = visited.unionByName(s)
    return found.withColumn("place", F.row_number().over(order)), visited


def mine(vectors: DataFrame, is_anchor: Column, id_column: str = "vec_id", label_column: str = "label",
         vector_column: str = "embedding", scale: int = SCALE, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low_tenths: int = LOW_TENTHS, high_tenths: int = HIGH_TENTHS,
         **settings) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of each row with is_anchor (of `id`).

    Components are floor(scale · x), scores whole inner products. Positives are the first `positives`
    other rows of the anchor's label, negatives per positive the first `negatives` of other labels
    whose score is between low_tenths and high_tenths of a tenth of the positive's; higher scores come
    first, then smaller ids. Rows with a NULL id or label, or a NULL or empty vector or one with a
    NULL or non-finite component, take no part. Wholly repeated rows count once; rows that share an id
    but differ are rows of their own, and none is a positive of its own id. Vectors must have one
    length; scores beyond 64 bits raise. A positive whose score is negative, or with no row in its
    window, has no rows. No rows give no rows. Columns other than id, label and vector are not read.
    """
    return mine_with_visits(vectors, is_anchor, id_column, label_column, vector_column, scale, positives,
                            negatives, low_tenths, high_tenths, **settings)[0]


def mine_with_visits(vectors: DataFrame, is_anchor: Column, id_column: str, label_column: str, vector_column: str,
                     scale: int, positives: int, negatives: int, low_tenths: int, high_tenths: int,
                     cell_rows: int = CELL_ROWS, part_bytes: int = PART_BYTES, first_rows: int = FIRST_ROWS,
                     growth: int = GROWTH) -> tuple[DataFrame, DataFrame | None]:
    """The result of `mine`, and anchor_id, a, phase, seen: different vectors visited for positives and negatives."""
    spark: SparkSession = vectors.sparkSession
    prepared = materialize(prepare(vectors, id_column, label_column, vector_column, scale))
    built = build_index(distinct_vectors(prepared, max(positives + 1, negatives)), cell_rows, part_bytes)
    if built is None:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                         "positive_score bigint, negative_score bigint"), None
    placed, index, exact = built
    anchors = prepared.filter(is_anchor).select(
        F.col("id").alias("anchor_id"), F.xxhash64("label", "vec").alias("a"), "label", "vec")
    whole = anchors.withColumns({"lows": F.array(F.lit(-_FAR)), "highs": F.array(F.lit(_FAR))})
    near, visits = search(placed, index, exact, whole, True, positives, first_rows, growth)
    near = materialize(near.select("anchor_id", "a", F.col("score").alias("p"), F.col("id").alias("positive_id")))
    # positives that score alike share a window
    windows = (near.filter("p >= 0").groupBy("anchor_id", "a").agg(F.sort_array(F.collect_set("p")).alias("ps"))
               .withColumns({
                   "lows": F.expr(f"transform(ps, p -> p div 10 * {low_tenths} + (p % 10 * {low_tenths} + 9) div 10)"),
                   "highs": F.expr(f"transform(ps, p -> p div 10 * {high_tenths} + p % 10 * {high_tenths} div 10)")}))
    windows = materialize(windows)
    inside, more = search(placed, index, exact, anchors.join(windows.drop("ps"), ["anchor_id", "a"]), False,
                          negatives, first_rows, growth)
    by_score = (inside.join(windows.select("anchor_id", "a", "ps"), ["anchor_id", "a"])
                .select("anchor_id", "a", F.element_at("ps", F.col("w") + 1).alias("p"), F.col("place").alias("rank"),
                        F.col("id").alias("negative_id"), F.col("score").alias("negative_score")))
    mined = near.join(by_score, ["anchor_id", "a", "p"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("p").alias("positive_score"), "negative_score")
    return mined, visits.withColumn("phase", F.lit("positives")).unionByName(more.withColumn("phase", F.lit("negatives")))


def oracle(anchor: str, label: str, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
           low_tenths: int = LOW_TENTHS, high_tenths: int = HIGH_TENTHS) -> str:
    """The same for `embeddings` in DuckDB, where ids are not repeated: all products."""
    return f"""
WITH v AS (
  SELECT vec_id, {label} AS label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE {anchor}),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {positives})
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
  s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND {10 * low_tenths} * p.positive_score <= 100 * s.score AND 100 * s.score <= {10 * high_tenths} * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) <= {negatives}"""
