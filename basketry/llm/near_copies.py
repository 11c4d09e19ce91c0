"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

SimHash comes first: texts whose fingerprints of five-word shingles are equal, or that the pigeonring
search links, are compared exactly, and those that are similar are one from then on. No number of
differing SimHash bits finds all pairs of that similarity, so the pairs it leaves apart are searched
through the shingles themselves, and all are found. In any one order of all shingles, two similar sets
share one of their first n - ceil(0.8 n) + 1 shingles (prefix filtering), so these are the keys. The order
puts the shingles that a sample of the texts has often last, which keeps the buckets of keys small but
has no effect on what is found.

A set has parity bits, each the parity of the shingles that fall on it. Sets differ in at
least as many shingles as their parities in bits, so a pair with more differing bits than its
sizes allow is dropped before any text moves. There are BITS of them, and for longer sets as many as
shingles or more: half of the bits of any two long sets differ, which must be more than their sizes allow. Texts of the other pairs are sent once to a block of
candidates that hang together, and compared exactly; links are grouped. Buckets of a key that
hold very many texts are not taken in pairs: all are compared with a few, which connects most. Of what
is left unconnected, texts that by their sizes and the key's places cannot be similar to any other
group's text in the bucket are done; the rest is looked through by parities, chunk by chunk, but for
the chunks of a bucket's largest group among themselves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import simhash
from basketry.llm.common import join_counted, materialize, release_memory, ship, unused
from basketry.llm.simhash import components, majority
from basketry.session import temporary_scratch

ship(__name__)

SHINGLE = 5
SIMILARITY = 0.8
SEED = 42
# texts that set the order of shingles, and how many of them have a shingle that comes late
SAMPLE = 4000
OFTEN = 4
# In buckets with more texts than this, all are compared with a few first, not in pairs.
PAIRS_UP_TO = 32
# bits of a fingerprint, at least and at most
BITS = 1024
MOST_BITS = 1 << 17
# texts that a block of candidates has, about; a task holds one block at a time
BLOCK_TEXTS = 512
ROWS_AT_ONCE = 128
# steps of sizes by which texts are ruled out, as logarithms
SIZE_STEP = 0.02
# words of 64 bits that tell which rows are candidates
MARKS = 1 << 17
_EPSILON = 1e-9


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of a text's different shingles, ascending; a shorter text is one, none without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, SEED) for s in runs], dtype=np.uint64))


def _node(found: np.ndarray) -> int:
    """Hash of a set, as a signed long."""
    bits = xxhash.xxh64_intdigest(found.tobytes(), SEED)
    return bits - (1 << 64) if bits >> 63 else bits


def prefix_length(n: int, similarity: float = SIMILARITY) -> int:
    return n - math.ceil(similarity * n - _EPSILON) + 1 if n else 0


def _often(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that OFTEN or more texts of a sample have, ascending, and their counts."""
    share = min(1.0, SAMPLE / max(1, docs.count()))
    sample = docs.select("text").filter(
        F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.lit(math.ceil(share * (1 << 20)))).distinct()

    def each(batches):
        for batch in batches:
            found = [shingles(x.as_py()) for x in batch.column(0)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["s"])

    counted = sample.mapInArrow(each, "s bigint").groupBy("s").agg(F.count("*").alias("n"))
    table = counted.filter(F.col("n") >= OFTEN).toArrow()
    s, n = (np.array(table.column(i).to_numpy()) for i in (0, 1))
    s = s.astype(np.int64).view(np.uint64)
    order = np.argsort(s)
    return s[order], n[order]


def in_order(found: np.ndarray, often: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles of a set in the order of all sets: rare ones, then by count, each by hash."""
    if not len(often) or not len(found):
        return found
    at = np.minimum(np.searchsorted(often, found), len(often) - 1)
    return found[np.lexsort((found, np.where(often[at] == found, counts[at], 0)))]


def _enough(both, n_a, n_b, similarity: float):
    """`both` common shingles make sets of n_a and n_b similar."""
    return both * (1 + similarity) >= similarity * (n_a + n_b) - _EPSILON


def fingerprint(found: np.ndarray, bits: int = BITS) -> bytes:
    """Parities of the shingles per bit; two differ in at most as many bits as their sets in shingles."""
    return np.packbits((np.bincount(found & np.uint64(bits - 1), minlength=bits) & 1).astype(np.uint8)).tobytes()


def bits_for(n: int) -> int:
    """Bits of the fingerprint of a set of n shingles, a power of two."""
    return min(max(BITS, 1 << max(0, n - 1).bit_length()), MOST_BITS)


def folded(print_: bytes, size: int) -> bytes:
    """The fingerprint of `size` bytes of the set that has this one, which is as long or longer."""
    if len(print_) == size:
        return print_
    return np.bitwise_xor.reduce(np.frombuffer(print_, np.uint64).reshape(-1, size // 8), axis=0).tobytes()


def most_differences(n_a, n_b, similarity: float = SIMILARITY):
    """Shingles that only one of two similar sets has, at most."""
    return (n_a + n_b) * (1 - similarity) / (1 + similarity) + _EPSILON


def _rows(prints: list[bytes], size: int) -> np.ndarray:
    """Fingerprints, folded to `size` bytes, as rows of 64-bit words."""
    return np.frombuffer(b"".join(folded(x, size) for x in prints), np.uint64).reshape(len(prints), -1)


def _differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)


def near_pairs(x: list[bytes], y: list[bytes], n_x: np.ndarray, n_y: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """Whether x[k] and y[k] allow that their sets, of n_x[k] and n_y[k] shingles, are similar."""
    most = most_differences(n_x, n_y, similarity)
    near = _differing(_rows(x, BITS // 8), _rows(y, BITS // 8)) <= most
    # the bits that both have are read only where fewer of them do not rule out the pair
    sizes = np.minimum([len(p) for p in x], [len(p) for p in y])
    for size in np.unique(sizes[near & (sizes > BITS // 8)]).tolist():
        at = np.flatnonzero(near & (sizes == size))
        near[at] = _differing(_rows([x[k] for k in at], size), _rows([y[k] for k in at], size)) <= most[at]
    return near


def close_rows(prints: list[bytes], n: np.ndarray, roots: np.ndarray, similarity: float = SIMILARITY):
    """(i, rows j > i with another root that sizes and fingerprints allow to be similar to i), where there are any."""
    length = np.array([len(p) for p in prints])
    # by size: the fingerprints that have so many bytes or more, and the places of rows among them
    levels = {}
    for size in {BITS // 8, *length.tolist()}:
        long = length >= size
        levels[size] = _rows([prints[k] for k in np.flatnonzero(long)], size), np.cumsum(long) - 1
    for i in range(len(n) - 1):
        rest = slice(i + 1, None)
        near = (roots[rest] != roots[i]) & (np.minimum(n[rest], n[i]) >= similarity * np.maximum(n[rest], n[i]) - _EPSILON)
        at = np.flatnonzero(near) + i + 1
        if not len(at):
            continue
        most = most_differences(n[at], n[i], similarity)
        both = np.minimum(length[at], length[i])
        for size in sorted({BITS // 8, *both.tolist()}):
            bits, place = levels[size]
            asked = np.flatnonzero((both == size) | (size == BITS // 8))
            keep = np.ones(len(at), dtype=bool)
            keep[asked] = _differing(bits[place[at[asked]]], bits[place[i]]) <= most[asked]
            at, most, both = at[keep], most[keep], both[keep]
        if len(at):
            yield i, at


def _open_members(blocks: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Those of block, node, root that may be similar to one of another root in their block."""
    def done(held: list) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        roots = table["root"].to_numpy()
        keep = np.zeros(len(roots), dtype=bool)
        for i, at in close_rows(table["bits"].to_pylist(), table["n"].to_numpy(), roots, similarity):
            keep[i] = keep[at] = True
        kept = table.select(["block", "node", "root"]).filter(pa.array(keep)).combine_chunks().to_batches()
        return kept[0] if kept else pa.RecordBatch.from_pylist([], schema=table.select(["block", "node", "root"]).schema)

    def scan(batches):
        last, held = None, []
        for batch in batches:
            block = batch.column(0).to_numpy()
            for low, high in zip(starts := [0, *np.flatnonzero(np.diff(block)) + 1], [*starts[1:], len(block)]):
                if low == high:
                    continue
                if block[low] != last and held:
                    yield done(held)
                    held = []
                last = block[low]
                held.append(batch.slice(int(low), int(high - low)))
        if held:
            yield done(held)

    rows = blocks.join(classes.select("node", "n", "bits"), "node").select("block", "node", "root", "n", "bits")
    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(scan, "block bigint, node bigint, root bigint")


def _close_fingerprints(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The pairs lo, hi whose fingerprints do not rule out that their sets are similar."""
    def keep(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            prints = [batch.column(c).to_pylist() for c in ("x", "y")]
            near = near_pairs(*prints, *(batch.column(c).to_numpy() for c in ("n_x", "n_y")), similarity)
            yield batch.select(["lo", "hi", "mover_is_hi"]).filter(pa.array(near, pa.bool_()))

    of = classes.select("node", "n", "bits")
    return (pairs.join(of.toDF("lo", "n_x", "x"), "lo").join(of.toDF("hi", "n_y", "y"), "hi")
            .mapInArrow(keep, "lo bigint, hi bigint, mover_is_hi boolean"))


def _texts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """row, packed text of the given rows: read from `docs` (row, text), which are not shuffled whole."""
    shift = 64 - MARKS.bit_length() + 1
    marked = rows.groupBy(F.shiftrightunsigned("row", shift).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(row & 63 as int))")).alias("bits")).toArrow()
    marks = np.zeros(MARKS, dtype=np.uint64)
    marks[marked.column(0).to_numpy()] = np.array(marked.column(1).to_numpy()).astype(np.int64).view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(marks)

    def emit(batches):
        known = shared.value
        for batch in batches:
            row = batch.column(0).to_numpy().view(np.uint64)
            hit = np.flatnonzero(known[(row >> np.uint64(shift)).astype(np.int64)] >> (row & np.uint64(63)) & np.uint64(1))
            found = batch.take(pa.array(hit))
            texts = [(x.as_py() or "").encode() for x in found.column(1)]
            packed = [len(t).to_bytes(4, "little") + pa.compress(t, codec="zstd", asbytes=True) for t in texts]
            yield pa.RecordBatch.from_arrays([found.column(0), pa.array(packed, pa.binary())], ["row", "packed"])
        release_memory()

    return docs.select("row", "text").mapInArrow(emit, "row bigint, packed binary").groupBy("row").agg(
        F.first("packed").alias("packed"))


def _unpack(packed: bytes) -> np.ndarray:
    size = int.from_bytes(packed[:4], "little")
    return shingles((pa.decompress(packed[4:], size, codec="zstd", asbytes=True) if size else b"").decode())


def _compare_blocks(docs: DataFrame, classes: DataFrame, members: DataFrame, pairs: DataFrame | None,
                    similarity: float) -> DataFrame:
    """a, b: similar nodes of a block, enough of them to connect all.

    `members` has block, node and root; `pairs` block, lo and hi, or is None if all members of a block
    are to be compared. A block's texts are held by one task; pairs stream by.
    """
    placed = materialize(members.join(classes.select("node", F.col("first.row").alias("row")), "node"))
    rows = placed.join(_texts(docs, placed.select("row")), "row").select(
        "block", F.lit(0).alias("kind"), F.col("node").alias("x"), F.col("root").alias("y"), "packed")
    if pairs is not None:
        rows = rows.unionByName(pairs.select("block", F.lit(1).alias("kind"), F.col("lo").alias("x"), F.col("hi").alias("y"),
                                             F.lit(None).cast("binary").alias("packed")))
    all_pairs = pairs is None

    def linked(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([int(a) for a, _ in out], pa.int64()),
                                           pa.array([int(b) for _, b in out], pa.int64())], ["a", "b"])

    def compare(batches):
        last, sets, roots, group = None, {}, {}, {}

        def top(n: int) -> int:
            while group.setdefault(n, n) != n:
                group[n] = group[group[n]]
                n = group[n]
            return n

        def connect(x: int, y: int, g: int, h: int, out: list) -> None:
            """Compare nodes x and y unless their groups g and h are connected already."""
            if top(g) != top(h):
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if _enough(both, len(sets[x]), len(sets[y]), similarity):
                    group[top(g)] = top(h)
                    out.append((x, y))

        def all_members() -> pa.RecordBatch:
            nodes, out = list(sets), []
            n = np.array([len(sets[x]) for x in nodes])
            prints = [fingerprint(sets[x], bits_for(len(sets[x]))) for x in nodes]
            for i, at in close_rows(prints, n, np.array([roots[x] for x in nodes]), similarity):
                for k in at:
                    connect(nodes[i], nodes[k], roots[nodes[i]], roots[nodes[k]], out)
            return linked(out)

        for batch in batches:
            out = []
            # few rows at a time: packed texts may be long
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                for block, kind, x, y, packed in zip(*(c.to_pylist() for c in some.columns)):
                    if block != last:
                        if all_pairs and len(sets) > 1:
                            yield all_members()
                        last, sets, roots, group = block, {}, {}, {}
                    if kind == 0:
                        sets[x], roots[x] = _unpack(packed), y
                    else:
                        connect(x, y, x, y, out)
            yield linked(out)
        if all_pairs and len(sets) > 1:
            yield all_members()
        sets = group = None
        release_memory()

    return rows.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(compare, "a bigint, b bigint")


def _in_blocks(pairs: DataFrame, block_texts: int) -> DataFrame:
    """block, lo, hi: pairs that hang together share a block, or several if they are many.

    Of a pair with a node that very many share, the other one chooses the block.
    """
    roots = components(pairs.select(F.col("lo").alias("a"), F.col("hi").alias("b")))
    sizes = materialize(roots.groupBy("root").agg(F.count("*").alias("size")))
    rooted = join_counted(roots, sizes, ["root"], "size")
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / F.lit(float(block_texts))))
    return (pairs.withColumn("node", F.when(F.col("mover_is_hi"), F.col("hi")).otherwise(F.col("lo")))
            .join(rooted, "node").select(F.xxhash64("root", part).alias("block"), "lo", "hi"))


def _confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, similarity: float, block_texts: int) -> DataFrame:
    """a, b: of the pairs lo, hi enough similar ones to connect all that are similar."""
    pairs = pairs.groupBy("lo", "hi").agg(F.max("mover_is_hi").alias("mover_is_hi"))
    pairs = materialize(_close_fingerprints(pairs, classes, similarity))
    work = materialize(_in_blocks(pairs, block_texts))
    members = work.select("block", F.col("lo").alias("node")).unionByName(
        work.select("block", F.col("hi").alias("node"))).distinct().withColumn("root", F.lit(0).cast("bigint"))
    return materialize(_compare_blocks(docs, classes, members, work, similarity))


def _ordered(x: str, y: str):
    """A pair's lo, hi and mover_is_hi, where y is the one that moves."""
    return (F.least(x, y).alias("lo"), F.greatest(x, y).alias("hi"), (F.col(y) > F.col(x)).alias("mover_is_hi"))


def simhash_pairs(classes: DataFrame) -> DataFrame:
    """lo, hi: classes (node, fp) whose SimHash fingerprints are equal or linked by the pigeonring search."""
    prints = materialize(classes.groupBy("fp").agg(F.min("node").alias("least"), F.count("*").alias("n_equal")))
    equal = join_counted(classes.select("fp", "node"), prints.filter("n_equal > 1"), ["fp"], "n_equal")
    of = prints.select("fp", "least")
    linked = simhash.links(prints.select("fp")).join(of.toDF("a", "x"), "a").join(of.toDF("b", "y"), "b")
    return (equal.filter("node <> least").select(*_ordered("least", "node"))
            .unionByName(linked.select(*_ordered("x", "y"))))


def _by_members(large: DataFrame) -> DataFrame:
    """bucket, node, n, root, cap, size: of buckets of keys with the same members one, with their largest caps."""
    of = large.groupBy("key").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"))
    same = of.groupBy("size", "x").agg(F.min("key").alias("bucket"))
    named = materialize(of.join(same, ["size", "x"]).select("key", "bucket", "size"))
    return join_counted(large, named, ["key"], "size").groupBy("bucket", "node").agg(
        F.first("n").alias("n"), F.first("root").alias("root"), F.max("cap").alias("cap"), F.first("size").alias("size"))


def _unsettled(rooted: DataFrame, similarity: float) -> DataFrame:
    """Those of bucket, node, n, cap, root that may be similar to one of another root in their bucket.

    At most `cap` shingles are common, so the other has at most `reach`; texts of about one size are
    taken together.
    """
    rows = rooted.withColumn("reach", F.col("cap") * F.lit((1 + similarity) / similarity) - F.col("n") + F.lit(1e-6))
    step = F.floor(F.log("n") / F.lit(SIZE_STEP))
    steps = rows.groupBy(F.col("bucket").alias("of"), step.alias("step")).agg(
        F.min("n").alias("least_n"), F.max("reach").alias("most_reach"), F.min("root").alias("r1"), F.max("root").alias("r2"))
    possible = ((F.col("bucket") == F.col("of")) & (F.col("least_n") <= F.col("reach")) & (F.col("n") <= F.col("most_reach"))
                & ((F.col("r1") != F.col("root")) | (F.col("r2") != F.col("root"))))
    return rows.join(steps, possible, "left_semi").select("bucket", "node", "root")


def _chunk_pairs(rooted: DataFrame, block_texts: int) -> DataFrame:
    """block, node, root: each two chunks of a bucket meet in a block, unless both are of its largest root."""
    roots = rooted.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    most = materialize(roots.groupBy("bucket").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("size"))
        .filter("size > n_main"))
    half = F.lit(block_texts / 2)
    is_main = F.col("root") == F.col("main")
    h = F.xxhash64("node")
    return (join_counted(rooted, most, ["bucket"], "size")
            .withColumn("others", F.ceil((F.col("size") - F.col("n_main")) / half).cast("int"))
            .withColumn("mains", F.ceil(F.col("n_main") / half).cast("int"))
            .withColumn("mine", F.when(is_main, F.col("others") + F.pmod(h, F.col("mains")))
                        .otherwise(F.pmod(h, F.col("others"))).cast("int"))
            .withColumn("other", F.explode(F.sequence(
                F.lit(0), F.col("others") - 1 + F.when(is_main, F.lit(0)).otherwise(F.col("mains")))))
            .select(F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")).alias("block"),
                    "node", "root"))


def links(docs: DataFrame, classes: DataFrame, similarity: float = SIMILARITY, pairs_up_to: int = PAIRS_UP_TO,
          block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """a, b: links between nodes that connect all similar ones.

    `docs` has row and text; `classes` node, n, prefix, bits, fp, and in `first` the row that has its text.
    """
    by_simhash = _confirmed(docs, classes, simhash_pairs(classes), similarity, block_texts)
    joined = materialize(components(by_simhash))

    def unpack(batches):
        for whole in batches:
            # few at a time, as each has many keys
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                blobs = [np.frombuffer(x, np.int32) for x in batch.column(3).to_pylist()]
                sizes = [len(x) for x in blobs]
                which = pa.array(np.repeat(np.arange(len(blobs)), sizes))
                place = np.concatenate([np.arange(k) for k in sizes]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(blobs)), *(batch.column(i).take(which) for i in range(3)),
                     pa.array(place)], ["key", "node", "root", "n", "place"])
        release_memory()

    keys = (classes.select("node", "n", "prefix").join(joined, "node", "left")
            .select("node", F.coalesce("root", "node").alias("root"), "n", "prefix")
            .mapInArrow(unpack, "key int, node bigint, root bigint, n int, place int"))
    sizes = materialize(keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"))
    # a common shingle and those after it in both sets are all that a pair's first one leaves
    shared = materialize(join_counted(keys, sizes, ["key"], "size").withColumn("cap", F.col("n") - F.col("place")))
    small = shared.filter(F.col("size") <= pairs_up_to).select("key", "node", "root", "n", "cap")
    pairs = (small.join(small.toDF("key", "node2", "root2", "n2", "cap2"), "key")
             .filter("node < node2 and root <> root2")
             .filter(_enough(F.least("cap", "cap2"), F.col("n"), F.col("n2"), similarity))
             .select(F.col("node").alias("lo"), F.col("node2").alias("hi"), F.lit(False).alias("mover_is_hi")))
    # large buckets: all with a few first, which connects most of a group of near copies
    large = materialize(_by_members(materialize(
        shared.filter(F.col("size") > pairs_up_to).groupBy("key", "node").agg(
            F.first("n").alias("n"), F.first("root").alias("root"), F.max("cap").alias("cap")))))
    me = F.struct("node", "root", "n", "cap")
    few = materialize(large.groupBy("bucket").agg(F.array_distinct(F.array(
        F.max_by(me, F.struct(F.col("cap") / F.col("n"), "node")), F.min_by(me, F.struct("n", "node")),
        F.min_by(me, "node"), F.min_by(me, F.struct(F.xxhash64("node"), "node")))).alias("few"),
        F.count("*").alias("size")))
    possible = F.filter("few", lambda f: (f["root"] != F.col("root")) & _enough(
        F.least(F.col("cap"), f["cap"]), F.col("n"), f["n"], similarity))
    stars = (join_counted(large.drop("size"), few, ["bucket"], "size")
             .select("node", F.explode(F.transform(possible, lambda f: f["node"])).alias("other"))
             .select(*_ordered("other", "node")))
    found = _confirmed(docs, classes, pairs.unionByName(stars), similarity, block_texts)

    found = materialize(found.unionByName(by_simhash))
    rooted = materialize(large.drop("root", "size").join(components(found), "node", "left")
                         .withColumn("root", F.coalesce("root", "node")))
    # what is left of the buckets is cut into chunks that meet in blocks
    rest = materialize(_unsettled(rooted, similarity))
    if rest.isEmpty():
        return found
    still_open = materialize(_open_members(_chunk_pairs(rest, block_texts), classes, similarity))
    return materialize(found.unionByName(_compare_blocks(docs, classes, still_open, None, similarity)).distinct())


def keep_first(docs: DataFrame, similarity: float = SIMILARITY, pairs_up_to: int = PAIRS_UP_TO,
               block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """Whole rows of `docs`: one of each group of linked texts, that with the smallest doc_id, NULL last.

    Words lie between ASCII white space and their ASCII letter case does not count. Texts with the
    same set of shingles are one; texts without words, NULL included, are one as well. Of rows with
    equal ids the one with the smallest hash of its columns stays, of wholly equal rows one. Columns
    may have any other names. No rows give no rows.
    """
    key, row = unused(docs.columns, "key", "row")
    keyed = docs.withColumns({row: F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)),
                              key: F.coalesce("doc_id", F.lit(-1))})
    carried = keyed.select("doc_id", F.col(key).alias("key"), F.col(row).alias("row"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(_often(docs))

    def describe(batches):
        often, counts = shared.value
        for batch in batches:
            nodes, sizes, blobs, prints, fps = [], [], [], [], []
            for x in batch.column(3):
                found = shingles(x.as_py())
                nodes.append(_node(found))
                sizes.append(len(found))
                first = in_order(found, often, counts)[:prefix_length(len(found), similarity)]
                # 32 bits are enough for keys: buckets that fall together only give more candidates
                blobs.append((first & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes())
                prints.append(fingerprint(found, bits_for(len(found))))
                fps.append(majority(found))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()),
                 pa.array(blobs, pa.binary()), pa.array(prints, pa.binary()),
                 pa.array(np.array(fps, dtype=np.uint64).view(np.int64))],
                ["doc_id", "key", "row", "node", "n", "prefix", "bits", "fp"])
        release_memory()

    kinds = ", ".join(f"{c} {carried.schema[c].dataType.simpleString()}" for c in carried.columns[:3])
    described = carried.mapInArrow(describe, f"{kinds}, node bigint, n int, prefix binary, bits binary, fp bigint")
    with temporary_scratch(docs.sparkSession):
        classes = materialize(described.groupBy("node").agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row", "key")).alias("first"),
            F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"), F.first("fp").alias("fp")))
        roots = components(links(carried, classes, similarity, pairs_up_to, block_texts))
        first = materialize(
            classes.select("node", "first").join(roots, "node", "left")
            .groupBy(F.coalesce("root", "node")).agg(F.min("first").alias("kept"))
            .select(F.col("kept.key").alias(key), F.col("kept.row").alias(row)), keep=True)
    return (keyed.dropDuplicates([key, row]).join(first, [key, row], "left_semi")
            .select(*(F.col(f"`{c}`") for c in docs.columns)))
