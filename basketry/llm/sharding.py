"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size: from a
start, in steps, both from hashes of its name. Shards take turns; in its turn a shard claims the
first slot of its order that is free, until the table is full. Shards so hold equal numbers of
slots (they differ by one at most), and a shard that comes or goes moves few slots of the others.
A row's place is a look at the slot of its key's hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 4099
SHARDS = tuple(f"shard-{i:03d}" for i in range(40))
# hex digits of an MD5 that make up a hash: 52 bits
_DIGITS = 13


def _hash(text: str) -> int:
    import hashlib

    return int(hashlib.md5(text.encode()).hexdigest()[:_DIGITS], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """Number of the shard that holds each slot."""
    if not _is_prime(slots) or not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("needs a prime number of slots and 1 to that many different shards")
    at = [_hash("start|" + s) % slots for s in shards]
    step = [_hash("step|" + s) % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    owner, left = [-1] * slots, slots
    while left:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            owner[at[shard]] = shard
            left -= 1
            if not left:
                break
    return owner


def slot(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key, NULL like the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("long") % slots


def lookup(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """slot, shard: one row per slot."""
    return spark.createDataFrame([(i, shards[k]) for i, k in enumerate(fill_table(shards, slots))],
                                 "slot bigint, shard string")


def assign(rows: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS,
           slots: int = SLOTS) -> DataFrame:
    """key, slot, shard: one row per row, without a shuffle.

    The table is broadcast; its size is `slots`, whatever the data. Equal keys (repeated rows
    too) share a shard; NULL keys have the shard of the empty text. No rows give no rows. Columns
    other than the key are not read.
    """
    table = F.broadcast(lookup(rows.sparkSession, shards, slots))
    placed = rows.select(F.col(key)).withColumn("slot", slot(F.col(key), slots))
    return placed.join(table, "slot").select(key, "slot", "shard")


def write_shards(rows: DataFrame, path: str, key: str = "doc_id", shards: Sequence[str] = SHARDS,
                 slots: int = SLOTS, column: str = "shard") -> None:
    """Writes whole rows as Parquet, a folder per shard."""
    if column in rows.columns:
        raise ValueError(f"there is a column {column} already")
    owner = fill_table(shards, slots)
    names = F.array(*map(F.lit, shards))
    held = F.element_at(names, F.get(F.array(*map(F.lit, owner)), slot(F.col(key), slots).cast("int")) + 1)
    rows.withColumn(column, held).write.partitionBy(column).parquet(path)


def oracle(shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> str:
    """The same for `documents` in DuckDB: the turns are a recursive query over the open table."""
    names = ", ".join(f"({i}, '{s}')" for i, s in enumerate(shards))

    def hashed(text: str) -> str:
        return f"CAST(concat('0x', substr(md5({text}), 1, {_DIGITS})) AS BIGINT)"

    n = len(shards)
    return f"""
WITH RECURSIVE shards(k, shard) AS (VALUES {names}),
steps AS (SELECT list({hashed("'start|' || shard")} % {slots} ORDER BY k) AS first,
    list({hashed("'step|' || shard")} % {slots - 1} + 1 ORDER BY k) AS step FROM shards),
turns(turn, open, slot) AS (
  SELECT 0, list_transform(range({slots}), lambda x: true), CAST(NULL AS BIGINT)
  UNION ALL
  SELECT turn + 1,
    list_concat(list_concat(open[1:chosen], [false]), open[chosen + 2:]), chosen
  FROM (SELECT turn, open, list_filter(
            list_transform(range({slots}), lambda j: (f + j * s) % {slots}),
            lambda x: open[x + 1])[1] AS chosen
        FROM (SELECT turn, open, first[turn % {n} + 1] AS f, step[turn % {n} + 1] AS s
              FROM turns, steps WHERE turn < {slots})))
SELECT d.doc_id, t.slot, s.shard
FROM (SELECT doc_id, {hashed("coalesce(CAST(doc_id AS VARCHAR), '')")} % {slots} AS slot FROM documents) d
JOIN turns t ON t.slot = d.slot JOIN shards s ON s.k = (t.turn - 1) % {n}"""
