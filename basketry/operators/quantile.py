"""Exact order statistics of many columns and groups at once."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import materialize

# Different values that one task sums up to find a rank, about; longer ranges are cut again.
RANGE_VALUES = 1_000_000


def long_values(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """what, v, t: a row per row and name of `columns`; a text goes to t, a number to v."""
    entries = []
    for name, column in columns.items():
        is_text = df.select(column).schema[0].dataType.simpleString() == "string"
        entries.append(F.struct(
            F.lit(name).alias("what"), (F.lit(None) if is_text else column).cast("double").alias("v"),
            (column if is_text else F.lit(None)).cast("string").alias("t")))
    return df.select(F.inline(F.array(*entries)))


class RankedValues:
    """Values of several groups by rank: rows (what, v, t), of which v or t has the value.

    Equal values are counted, and the different ones of all groups range-partitioned together and
    stored with their counts. The driver gets the size of each group in each range; any number of
    ranks is then looked up by one query, each in the one range that holds it. `n` and `distinct`
    have the number of values and of different ones per group.
    """

    def __init__(self, values: DataFrame, range_values: int = RANGE_VALUES):
        spark = values.sparkSession
        self._range_values = range_values
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        counted = (values.filter("v IS NOT NULL OR t IS NOT NULL").groupBy("what", "v", "t")
                   .agg(F.count("*").alias("n")))
        self._levels: list[DataFrame] = []
        # (what, level, part): values and different values, in order
        self._sizes = self._cut(counted, parts)
        self.n: dict[str, int] = {}
        self.distinct: dict[str, int] = {}
        for (what, *_), (n, k) in self._sizes:
            self.n[what] = self.n.get(what, 0) + n
            self.distinct[what] = self.distinct.get(what, 0) + k

    def _cut(self, counted: DataFrame, parts: int) -> list[tuple]:
        """Stores ranges of the counted values as a new level; their sizes."""
        level = len(self._levels)
        stored = materialize(counted.repartitionByRange(max(1, parts), "what", "v", "t")
                             .withColumn("part", F.spark_partition_id()))
        self._levels.append(stored)
        sizes = stored.groupBy("what", "part").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()
        return sorted(((r.what, level, r.part), (r.n, r.k)) for r in sizes)

    def _holder(self, what: str, rank: int) -> tuple[int, tuple, int]:
        """Place in the list of sizes of the range with a rank, the range, and the rank in it."""
        for place, (key, (n, _)) in enumerate(self._sizes):
            if key[0] == what:
                if rank < n:
                    return place, key, rank
                rank -= n
        raise ValueError(f"no such rank of {what}")

    def at(self, wanted: Iterable[tuple[str, int]]) -> dict[tuple[str, int], float | str]:
        """The value at each (what, rank), ranks from 0 to n[what] - 1."""
        wanted = sorted(set(wanted))
        # ranges that are long are cut again, until one task can sum up each
        while True:
            held = {w: self._holder(*w) for w in wanted}
            long_ones = {place: key for place, key, _ in held.values() if self._sizes[place][1][1] > self._range_values}
            if not long_ones:
                break
            for place in sorted(long_ones, reverse=True):
                what, level, part = long_ones[place]
                inside = self._levels[level].filter((F.col("part") == part) & (F.col("what") == what)).drop("part")
                parts = -(-2 * self._sizes[place][1][1] // self._range_values)
                self._sizes[place:place + 1] = self._cut(inside, parts)
        out = {}
        for level, stored in enumerate(self._levels):
            mine = {w: (part, rank) for w, (_, (_, at, part), rank) in held.items() if at == level}
            if not mine:
                continue
            asked = stored.sparkSession.createDataFrame(
                [(what, part, rank, at) for (what, rank), (part, at) in mine.items()],
                "what string, part int, rank bigint, at bigint")
            up_to = F.sum("n").over(Window.partitionBy("what", "part").orderBy("v", "t"))
            here = stored.filter(F.col("part").isin(sorted({part for part, _ in mine.values()})))
            # `asked` has one row per rank that the caller names
            rows = (here.withColumn("up_to", up_to).join(F.broadcast(asked), ["what", "part"])
                    .filter((F.col("at") < F.col("up_to")) & (F.col("at") >= F.col("up_to") - F.col("n"))))
            out |= {(r.what, r["rank"]): r.t if r.v is None else r.v for r in rows.collect()}
        return out

    def different(self, what: str) -> DataFrame:
        """v, t, n, place: the different values of a group in order, places from 0."""
        before, rows = 0, []
        for (name, level, part), (_, k) in self._sizes:
            if name == what:
                rows.append((level, part, before))
                before += k
        out = None
        for level, stored in enumerate(self._levels):
            starts = [(part, first) for at, part, first in rows if at == level]
            if not starts:
                continue
            first = F.create_map(*(F.lit(x) for pair in starts for x in pair))[F.col("part")]
            place = F.row_number().over(Window.partitionBy("part").orderBy("v", "t")) - 1
            here = (stored.filter((F.col("what") == what) & F.col("part").isin([p for p, _ in starts]))
                    .withColumn("place", (place + first).cast("long")).select("v", "t", "n", "place"))
            out = here if out is None else out.unionByName(here)
        return self._levels[0].filter("false").select("v", "t", "n", F.lit(0).cast("long").alias("place")) \
            if out is None else out


def middle_ranks(n: int) -> list[int]:
    """Ranks whose mean is the median."""
    return sorted({(n - 1) // 2, n // 2}) if n else []


def median(what: str, ranked: RankedValues, found: dict) -> float | None:
    """Median of a group from the values at its middle ranks; None without values."""
    values = [found[what, rank] for rank in middle_ranks(ranked.n.get(what, 0))]
    return sum(values) / len(values) if values else None


def exact_medians(df: DataFrame, *columns: str) -> dict:
    """Median of each column (mean of the middle two), NULL values aside; None without values."""
    ranked = RankedValues(long_values(df, {c: F.col(c).cast("double") for c in columns}))
    found = ranked.at((c, rank) for c in columns for rank in middle_ranks(ranked.n.get(c, 0)))
    return {c: median(c, ranked, found) for c in columns}
