"""SimHash near-duplicates by pigeonring filtering.

The 64 bits are cut into SEGMENTS pieces on a ring. If two fingerprints differ in at most
`distance` bits, some piece starts a chain around the ring in which the first k pieces together
differ in at most k · distance / SEGMENTS bits, for every k. The budgets of the first pieces are
below 1, so these must be equal and serve as key; candidates with equal keys are checked for the
rest of the chain before the whole distance is counted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import join_counted, materialize, ship, unused

ship(__name__)

SHINGLE = 3
SEED = 42
DISTANCE = 2
SEGMENTS = 5
# Buckets with more fingerprints than this are linked through neighbours instead of pairs.
PAIRS_UP_TO = 96


def simhash(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Fingerprint (unsigned) of a text's word shingles, repeats included; 0 without words.

    A bit is 1 if more than half of the shingles' hashes have it.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(s, seed) for s in shingles], dtype=np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), shingle: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """Columns `carry` and fp (the 64 bits as a signed long) of every text; without words it is 0."""
    def hash_texts(batches):
        for batch in batches:
            texts = batch.column(len(carry))
            fp = np.array([simhash(x.as_py(), shingle, seed) for x in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(carry)], pa.array(fp.view(np.int64))], [*carry, "fp"])

    carried = docs.select(*carry, "text")
    kinds = ", ".join(f"{c} {carried.schema[c].dataType.simpleString()}" for c in carry)
    return carried.mapInArrow(hash_texts, f"{kinds}, fp bigint")


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def segment_masks(segments: int) -> list[int]:
    ends = [round(64 * i / segments) for i in range(segments + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(ends, ends[1:])]


def _budgets(distance: int, segments: int) -> list[int]:
    """Bits in which the first k pieces of a chain may differ, k = 1 … segments."""
    return [k * distance // segments for k in range(1, segments + 1)]


def links(prints: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS,
          pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """a, b: links that connect all fingerprints (distinct, column fp) at most `distance` apart.

    Small buckets give every linked pair. In large ones, which may hold many near copies, a
    fingerprint is listed under each pattern that differs from it in at most distance/2 of the
    bits that are free in the bucket; two that share a pattern are linked to the pattern's
    smallest, which keeps them connected without all pairs. Only distances up to 2 are built
    that way.
    """
    if distance > 2:
        raise ValueError("distance must be at most 2")
    masks, budget = segment_masks(segments), _budgets(distance, segments)
    equal = sum(b == 0 for b in budget)
    if not equal:
        raise ValueError("more segments than differing bits are needed")
    key_masks = [sum(masks[(i + k) % segments] for k in range(equal)) for i in range(segments)]
    keyed = prints.select("fp", F.posexplode(F.array(*(
        F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")) for m in key_masks))).alias("pos", "key"))
    sizes = keyed.groupBy("pos", "key").agg(F.count("*").alias("n")).filter("n > 1")
    keyed = materialize(keyed.join(sizes, ["pos", "key"]))
    small = keyed.filter(F.col("n") <= pairs_up_to).select("pos", "key", "fp")
    pairs = (small.withColumnRenamed("fp", "a").join(small.withColumnRenamed("fp", "b"), ["pos", "key"])
             .filter("a < b").withColumn("x", F.col("a").bitwiseXOR(F.col("b"))))
    chain = F.lit(True)
    for k in range(equal + 1, segments + 1):
        reach = [sum(masks[(i + j) % segments] for j in range(k)) for i in range(segments)]
        mask = F.element_at(F.array(*(F.lit(_signed(m)).cast("long") for m in reach)),
                            F.col("pos") + 1)
        chain &= F.bit_count(F.col("x").bitwiseAND(mask)) <= budget[k - 1]
    close = pairs.filter(chain).filter(F.bit_count("x") <= distance).select("a", "b")

    near = [0] + [1 << i for i in range(64)]
    flips = F.array(*(F.lit(_signed(f)).cast("long") for f in near))
    in_key = F.element_at(F.array(*(F.lit(_signed(m)).cast("long") for m in key_masks)), F.col("pos") + 1)
    free = F.filter(flips, lambda f: f.bitwiseAND(in_key) == 0)
    large = keyed.filter(F.col("n") > pairs_up_to)
    pattern = large.select("fp", "pos", F.explode(F.transform(
        free, lambda f: F.col("fp").bitwiseXOR(f))).alias("pattern"))
    # at most 65 fingerprints have a pattern in common
    stars = (pattern.groupBy("pos", "pattern").agg(F.collect_list("fp").alias("fps"))
             .filter(F.size("fps") > 1)
             .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a < b"))
    if distance < 2:
        stars = stars.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    return close.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) of all nodes in edges (a, b), a ≠ b.

    Large-star and small-star steps in turn until nothing changes; each is a grouping of edges
    whose result is written to the shared folder. A node with very many neighbours is a
    minimum per key and a join, never a list.
    """
    spark = edges.sparkSession
    edges = materialize(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: neighbours above a node move to the smallest of the node and its neighbours
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        large = materialize(large)
        # small star: a node and its smaller neighbours move to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = materialize(joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .unionByName(joined.select("a", F.col("m").alias("b")))
                            .filter("a <> b").distinct())
        same = _checksum(small) == _checksum(edges.select(F.greatest("a", "b").alias("a"),
                                                          F.least("a", "b").alias("b")))
        edges = small
        if same:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()


def _checksum(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first())


def _linked(prints: DataFrame, distance: int, segments: int, pairs_up_to: int) -> DataFrame:
    """The rows of `prints` (doc_id, fp, …) with root, component_id and n_equal of their fp."""
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first"),
                                                   F.count("*").alias("n_equal")))
    joined = components(links(classes.select("fp"), distance, segments, pairs_up_to))
    rooted = materialize(classes.join(joined.withColumnRenamed("node", "fp"), "fp", "left")
                         .withColumn("root", F.coalesce("root", "fp")))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(rooted.join(smallest, "root").select("fp", "root", "component_id", "n_equal"))
    return join_counted(prints, named, ["fp"], "n_equal")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS,
                    pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, n_equal: one row per document row.

    component_id is the smallest doc_id reachable by links, itself included. Texts without words
    have fingerprint 0 and are linked like others; NULL texts are without words. Rows with a NULL
    id take part; their component_id is NULL only if no linked row has an id. Repeated rows have
    equal fingerprints. n_equal counts rows of the same fingerprint. No rows give no rows. Columns
    other than doc_id and text are not read.
    """
    found = _linked(materialize(fingerprints(docs)), distance, segments, pairs_up_to)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id", "n_equal")


def keep_first(docs: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS,
               pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """Whole rows of `docs`: one of each component, that with the smallest doc_id, NULL last.

    Of rows with equal ids the one with the smallest hash of its columns stays, of wholly equal
    rows one. Columns may have any other names. No rows give no rows.
    """
    row, key = unused(docs.columns, "row", "key")
    keyed = docs.withColumns({row: F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)),
                              key: F.coalesce("doc_id", F.lit(-1))})
    prints = materialize(fingerprints(keyed, ("doc_id", key, row)))
    first = (_linked(prints, distance, segments, pairs_up_to).groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row, key)).alias("kept"))
             .select(f"kept.{key}", f"kept.{row}"))
    return (keyed.dropDuplicates([key, row]).join(first, [key, row], "left_semi")
            .select(*(F.col(f"`{c}`") for c in docs.columns)))
