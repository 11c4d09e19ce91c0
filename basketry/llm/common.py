"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.session import materialize, scratch_folder

__all__ = ["count_in_order", "draw", "join_counted", "materialize", "read", "release_memory", "salted_join", "scratch_folder",
           "ship", "shuffle_partitions", "unused", "words_in"]

# This module's functions are used inside tasks too.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ASCII white space; words are what lies between.
WORD = r"[^\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Send the module's functions to the workers with each job; they need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def release_memory() -> None:
    """Give what a task no longer uses back to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # a C library without it
        pass


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(columns: Sequence[str], *stems: str) -> list[str]:
    """A column name for each stem that is not among `columns`, whatever the case of its letters."""
    taken = {c.lower() for c in columns}
    out = []
    for stem in stems:
        while stem.lower() in taken:
            stem += "_"
        taken.add(stem.lower())
        out.append(stem)
    return out


def words_in(text: Column) -> Column:
    """Number of words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(*parts: str) -> str:
    """SQL for a number in [0, 1) that depends on the parts only."""
    return f"pmod(xxhash64({', '.join(parts)}), 9007199254740992) / 9007199254740992D"


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], spread: Column,
                salts: int = 32) -> DataFrame:
    """left ⟕ right where a key may hold a large share of the left and one row of the right.

    Each left row goes to one of `salts` copies of its right row by the hash of `spread`,
    so that a key's rows lie in up to `salts` partitions. NULL keys match NULL keys.
    """
    keys = [f"__key{i}" for i in range(len(on))]
    null_safe = [F.struct(F.col(c).isNull(), F.col(c)) for c in on]
    many = left.withColumns(dict(zip(keys, null_safe)) | {
        "__salt": F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")})
    few = right.select(*(k.alias(n) for k, n in zip(null_safe, keys)),
                       *(c for c in right.columns if c not in on)).withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return many.join(few, [*keys, "__salt"], "left").drop(*keys, "__salt")


# A key with at least one in HEAVY of all rows is joined by broadcast; there are at most HEAVY such.
HEAVY = 1000


def join_counted(left: DataFrame, right: DataFrame, on: Sequence[str], rows: str) -> DataFrame:
    """left ⋈ right, where right has one row per key and in `rows` its number of left rows.

    Keys that hold much of the left, of which there are few, are broadcast; the others meet in a
    plain join. Both sides are read twice, so pass stored frames. Keys must not be NULL.
    """
    total = right.agg(F.sum(rows)).first()[0] or 0
    is_heavy = F.col(rows) * HEAVY >= F.lit(total)
    heavy = F.broadcast(right.filter(is_heavy))
    few = left.join(heavy, list(on))
    others = left.join(heavy.select(*on), list(on), "left_anti").join(
        right.filter(~is_heavy), list(on))
    return few.unionByName(others)


def count_in_order(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Adds the row's place (from 0) in a total order, without one task that sees all rows.

    The rows are range-partitioned and stored; places are counted per partition and moved by
    the sizes of the partitions before it, of which there are as many as shuffle partitions.
    """
    spark = df.sparkSession
    parts = shuffle_partitions(spark)
    stored = materialize(df.repartitionByRange(parts, *order)
                         .withColumn("__part", F.spark_partition_id()))
    sizes = stored.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select("__part", F.coalesce(F.sum("__n").over(
        Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return (stored.withColumn(name, place).join(before, "__part")
            .withColumn(name, (F.col(name) + F.col("__before")).cast("long"))
            .drop("__part", "__before"))
