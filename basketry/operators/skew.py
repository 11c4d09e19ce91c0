"""Joins and sequences that stay spread out when one key holds many rows.

`heavy_keys` measures; the other functions take its result. With no heavy key
each of them is the plain join or window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from basketry.session import materialize

# A key is heavy with at least this many rows and one in HEAVY_SHARE of all rows.
HEAVY_ROWS = 10_000
HEAVY_SHARE = 1000
# Rows that one slice of a heavy group's sequence holds, about.
SLICE_ROWS = 1_000_000


@dataclass(frozen=True)
class Keys:
    """What is measured of a key column: heavy keys by falling count, rows without key, repeats."""

    heavy: list
    without_key: int
    repeated: bool


def measure_keys(tables: Sequence[tuple[DataFrame, dict[str, Column]]], heavy_rows: int = HEAVY_ROWS,
                 different: Sequence[str] = (), only_missing: Sequence[str] = ()) -> dict[str, Keys]:
    """Keys of several columns of several tables, in one query that reads each table once.

    `tables` gives the key columns of each table by a name of theirs. For the names in `different`
    it is found out if a key has rows that differ (copies have equal hashes); for those in
    `only_missing` just rows without key are counted. Keys are counted with a partial aggregate;
    of each name the driver gets the heavy keys, at most HEAVY_SHARE.
    """
    rows, kinds = None, {}
    for table, keys in tables:
        cells = [c for name in table.columns for c in (F.col(name), F.col(name).isNull())]
        entries = []
        for name, key in keys.items():
            kinds[name] = table.select(key).schema[0].dataType
            if not isinstance(kinds[name], (IntegralType, StringType)):
                raise TypeError(f"keys of type {kinds[name].simpleString()} are not measured")
            hashed = F.xxhash64(*cells) if name in different else F.lit(0).cast("long")
            entry = F.struct(F.lit(name).alias("name"), key.cast("string").alias("key"), hashed.alias("h"))
            entries.append(F.when(key.isNull(), entry) if name in only_missing else entry)
        found = table.select(F.inline(F.array_compact(F.array(*entries))))
        rows = found if rows is None else rows.unionByName(found)
    counted = rows.groupBy("name", "key").agg(
        F.count("*").alias("n"), (F.min("h") < F.max("h")).alias("differs"))
    # both uses have all columns of one exchange, so Spark runs it once
    known = F.col("key").isNotNull()
    totals = counted.groupBy("name").agg(
        F.sum("n").alias("n"), F.sum(F.when(~known, F.col("n"))).alias("without_key"),
        F.max(known & F.col("differs")).alias("differs")).select(
        "name", F.lit(None).cast("string").alias("key"), "n", "without_key", "differs", F.lit(0).alias("place"))
    place = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("n"), "key"))
    largest = (counted.filter(F.col("n") >= heavy_rows).withColumn("place", place)
               .filter(F.col("place") <= HEAVY_SHARE).select(
                   "name", "key", "n", F.lit(None).cast("bigint").alias("without_key"), "differs", "place"))
    rows = totals.unionByName(largest).collect()
    total, out = {r.name: r for r in rows if not r.place}, {}
    for name, kind in kinds.items():
        if name not in total:
            out[name] = Keys([], 0, False)
            continue
        found = sorted((r.place, r.key) for r in rows
                       if r.name == name and r.place and r.n >= total[name].n / HEAVY_SHARE)
        convert = int if isinstance(kind, IntegralType) else str
        out[name] = Keys([k if k is None else convert(k) for _, k in found],
                         total[name].without_key or 0, bool(total[name].differs))
    return out


def heavy_keys(df: DataFrame, key: str, heavy_rows: int = HEAVY_ROWS) -> list:
    """Values of `key` with at least `heavy_rows` rows and 1/HEAVY_SHARE of the table.

    There are at most HEAVY_SHARE such keys, and a key left out is a small share of the table or
    has few rows.
    """
    return measure_keys([(df, {"key": F.col(key)})], heavy_rows)["key"].heavy


def is_heavy(key: str, heavy: Sequence) -> Column:
    """True or false (never NULL): is this row's key one of `heavy`?"""
    found = F.col(key).isin([v for v in heavy if v is not None])
    return F.coalesce(found, F.lit(None in heavy))


def expand_join(left: DataFrame, right: DataFrame, key: str, heavy: Sequence,
                left_is_unique: bool, how: str = "left") -> DataFrame:
    """left ⟕ right (or ⋈, with how="inner"), where `heavy` keys have many rows on the right.

    If the left has one row per key, its heavy rows number at most len(heavy), so
    they are broadcast and the right side's heavy rows stay where they are. Else they
    are salted: a heavy row of the right goes to one of as many parts as there are
    shuffle partitions, those of the left to each part. That is less than the join gives.
    """
    heavy = [v for v in heavy if v is not None]  # NULL keys never match
    if not heavy:
        return left.join(right.filter(F.col(key).isNotNull()), key, how)
    few = left.filter(~is_heavy(key, heavy)).join(
        right.filter(~is_heavy(key, heavy) & F.col(key).isNotNull()), key, how)
    left_heavy, right_heavy = (side.filter(is_heavy(key, heavy)) for side in (left, right))
    # every heavy key occurs on the right, so inner and left join agree here
    if left_is_unique:
        return few.unionByName(right_heavy.join(F.broadcast(left_heavy), key))
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # with the number of the input split, so that equal rows do not all meet in one part
    salted = right_heavy.withColumn("part", F.pmod(
        F.xxhash64(*right.columns) + F.spark_partition_id(), F.lit(n)).cast("int"))
    repeated = left_heavy.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return few.unionByName(salted.join(repeated, [key, "part"]).drop("part"))


def lookup_join(left: DataFrame, lookup: DataFrame, key: str, heavy: Sequence) -> DataFrame:
    """left ⟕ lookup, where `heavy` keys have many rows on the left.

    `lookup` has one row per key, so its heavy rows number at most len(heavy).
    """
    if not heavy:
        return left.join(lookup, key, "left")
    few = left.filter(~is_heavy(key, heavy)).join(
        lookup.filter(~is_heavy(key, heavy)), key, "left")
    many = left.filter(is_heavy(key, heavy)).join(
        F.broadcast(lookup.filter(is_heavy(key, heavy))), key, "left")
    return few.unionByName(many)


def number_rows(rows: DataFrame, group: str, time: str, tie: str, heavy: Sequence) -> DataFrame:
    """Add order_seq_num, prev_order_ts and lifetime_order_count per `group`.

    Rows are ordered by `time` (NULL last), then `tie`, then a hash of the row, so that rows without
    group, time and tie have an order too.
    """
    light = _number_by_window(rows.filter(~is_heavy(group, heavy)) if heavy else rows,
                              group, time, tie)
    if not heavy:
        return light
    return light.unionByName(
        _number_by_slices(rows.filter(is_heavy(group, heavy)), group, time, tie))


def _order(rows: DataFrame, time: str, tie: str) -> list[Column]:
    return [F.asc_nulls_last(time), F.asc(tie), F.xxhash64(*rows.columns).asc()]


def _number_by_window(rows: DataFrame, group: str, time: str, tie: str) -> DataFrame:
    whole = Window.partitionBy(group)
    ordered = whole.orderBy(*_order(rows, time, tie))
    return rows.select(
        "*",
        F.row_number().over(ordered).cast("long").alias("order_seq_num"),
        F.lag(time).over(ordered).alias("prev_order_ts"),
        F.count("*").over(whole).alias("lifetime_order_count"),
    )


def _number_by_slices(rows: DataFrame, group: str, time: str, tie: str) -> DataFrame:
    """The same for heavy groups, each cut into ordered slices of equal size.

    The slices are written out, so that their limits are fixed for both uses.
    A slice is one range partition, so there are at most (partitions + groups)
    pairs of group and slice, and the totals per pair are small.
    """
    # equal rows get numbers, so that they can be cut too
    number = "row_number"
    while number in rows.columns:
        number += "_"
    order = [*_order(rows, time, tie), F.asc(number)]
    columns, rows = rows.columns, materialize(rows.withColumn(number, F.monotonically_increasing_id()))
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")),
            rows.count() // SLICE_ROWS)
    cut = materialize(
        rows.repartitionByRange(n, F.col(group), *order)
        .withColumn("slice", F.spark_partition_id()))
    in_order = Window.partitionBy(group).orderBy("slice")
    totals = cut.groupBy(group, "slice").agg(
        F.count("*").alias("slice_rows"),
        F.when(F.count("*") == F.count(time), F.max(time)).alias("slice_last"),
    ).select(
        F.col(group).alias("slice_group"), F.col("slice").alias("slice_no"),
        F.coalesce(F.sum("slice_rows").over(in_order.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("rows_before"),
        F.lag("slice_last").over(in_order).alias("last_before"),
        F.sum("slice_rows").over(Window.partitionBy(group)).alias("lifetime_order_count"),
    )
    within = Window.partitionBy(group, "slice").orderBy(*order)
    numbered = cut.select("*", F.row_number().over(within).alias("slice_row"),
                          F.lag(time).over(within).alias("slice_prev"))
    joined = numbered.join(
        F.broadcast(totals),
        F.col(group).eqNullSafe(F.col("slice_group")) & (F.col("slice") == F.col("slice_no")))
    return joined.select(
        *columns,
        (F.col("rows_before") + F.col("slice_row")).alias("order_seq_num"),
        F.when(F.col("slice_row") == 1, F.col("last_before"))
        .otherwise(F.col("slice_prev")).alias("prev_order_ts"),
        "lifetime_order_count",
    )
