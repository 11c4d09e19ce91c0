"""Alignment of two tokenizers over a corpus by merging the byte offsets where their tokens end.

Both token sequences cover the same bytes, so merging the sorted ends of A and B gives every overlap:
each different end is the last byte of one A and one B token that overlap, and an end of both closes a
group. Ends are merged in pieces of equal work: a binary search along a diagonal of the merge finds how
many A and B ends come first, and each piece is then merged on its own. Short texts are put together to
a piece; a text with more ends than a piece is cut along diagonals into pieces that are spread over
the tasks, and its groups that cross a cut are stitched from both sides.

The id pairs of a piece are listed once with their number of links; Spark sums them over the corpus
and joins the sums back to the pieces, where they are added up per text.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.bpe import pack_numbers, unpack_numbers
from basketry.llm.common import materialize, shuffle_partitions, ship

ship(__name__)

# ends that a piece merges
WORK = 3_000_000
# characters encoded at a time, and texts in a row of a piece
CHARS_AT_ONCE = 400_000
ROW_TEXTS = 256
_PAIR = 1 << 32


# ---------------------------------------------------------------------------- tokenizers

def byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary.

    Printable Latin-1 letters stand for themselves, the other bytes in turn for those from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass
class Tokenizers:
    """Both tokenizers as their files' content, so that workers need no files."""

    a_json: str
    b_model: bytes

    @classmethod
    def read(cls, a_path: str, b_path: str) -> Tokenizers:
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            return cls(a.read(), b.read())

    def open(self) -> tuple[Callable, Callable, list[bytes], list[bytes]]:
        """Functions from texts to lists of ids, and the bytes of all ids."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        a = Tokenizer.from_str(self.a_json)
        a.encode_special_tokens = True
        b = sentencepiece.SentencePieceProcessor(model_proto=self.b_model)
        letters = byte_of_letter()

        def bytes_a(k: int) -> bytes:
            token = a.id_to_token(k) or ""
            return b"".join(bytes([letters[c]]) if c in letters else c.encode() for c in token)

        def bytes_b(k: int) -> bytes:
            piece = b.id_to_piece(k)
            return bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode()

        def encode_a(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

        def encode_b(texts: list[str]) -> list[list[int]]:
            return b.encode(texts, num_threads=1)

        return (encode_a, encode_b, [bytes_a(k) for k in range(a.get_vocab_size())],
                [bytes_b(k) for k in range(b.get_piece_size())])


class _Side:
    """Lengths and bytes of the tokens of one tokenizer."""

    def __init__(self, encode: Callable, tokens: list[bytes]):
        self.encode = encode
        self.tokens = pa.array(tokens, pa.large_binary())
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)

    def ids(self, texts: list[str], wanted: list[bytes]) -> list[np.ndarray | None]:
        """Ids of each text, None where their bytes are not the wanted ones."""
        found = [np.array(x, dtype=np.int32) for x in self.encode(texts)]
        flat = np.concatenate(found)
        joined = self.tokens.take(pa.array(flat)).buffers()[2].to_pybytes() if len(flat) else b""
        ends = np.cumsum([self.lengths[x].sum() for x in found])
        return [x if joined[end - len(w):end] == w and end - begin == len(w) else None
                for x, w, begin, end in zip(found, wanted, [0, *ends[:-1]], ends)]


def encode_both(a: _Side, b: _Side, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A and B ids of each text; none of either where one does not give the text's bytes back."""
    none = np.zeros(0, dtype=np.int32)
    filled = [t for t in texts if t]
    wanted = [b" " + t.encode() for t in filled]
    both = iter(zip(a.ids(filled, wanted), b.ids(filled, wanted)) if filled else ())
    for text in texts:
        x, y = next(both) if text else (None, None)
        yield (none, none) if x is None or y is None else (x, y)


# ---------------------------------------------------------------------------- merging

def diagonal(a: np.ndarray, b: np.ndarray, d: int) -> tuple[int, int]:
    """How many A and B ends are among the first d of both; one more if that parts two equal ends."""
    low, high = max(0, d - len(b)), min(d, len(a))
    while low < high:
        i = (low + high) // 2
        if a[i] <= b[d - i - 1]:
            low = i + 1
        else:
            high = i
    i, j = low, d - low
    return i, j + (0 < i and j < len(b) and a[i - 1] == b[j])


def cut(a: np.ndarray, b: np.ndarray, work: int) -> list[tuple[int, int, int, int]]:
    """Ranges of A and B ends of pieces with about `work` ends each: i0, i1, j0, j1."""
    total = len(a) + len(b)
    n = max(1, -(-total // work))
    cuts = [diagonal(a, b, total * k // n) for k in range(n + 1)]
    return [(i0, i1, j0, j1) for (i0, j0), (i1, j1) in zip(cuts, cuts[1:])]


@dataclass
class Merged:
    """Overlaps of a piece as numbers of its A and B tokens, and which tokens close a group."""

    a: np.ndarray
    b: np.ndarray
    closes_a: np.ndarray
    closes_b: np.ndarray


def merge(ends_a: np.ndarray, ends_b: np.ndarray, n_a: int, n_b: int) -> Merged:
    """Merges the first n_a and n_b ends; a further one of each is what the last ones may overlap."""
    mine_a, mine_b = ends_a[:n_a], ends_b[:n_b]
    at_b, at_a = np.searchsorted(ends_b, mine_a), np.searchsorted(ends_a, mine_b)
    closes_a = np.isin(mine_a, mine_b, assume_unique=True)
    closes_b = np.isin(mine_b, mine_a, assume_unique=True)
    only_b = np.flatnonzero(~closes_b)
    return Merged(np.concatenate([np.arange(n_a), at_a[only_b]]), np.concatenate([at_b, only_b]), closes_a, closes_b)


class _Writer:
    """Text of groups: ids with commas, | after the A ids of a group, ; after its B ids."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a, self.n_b = n_a, n_b
        self.words = pa.array([f"{k}{end}".encode() for n, ends in ((n_a, ",|"), (n_b, ",;"))
                               for end in ends for k in range(n)], pa.large_binary())

    def write(self, a: np.ndarray, b: np.ndarray, merged: Merged) -> tuple[bytes, np.ndarray]:
        """The text of a piece's tokens, and where in it each token starts (and the end)."""
        closes_a, closes_b = merged.closes_a, merged.closes_b
        # each group's A tokens come before its B tokens
        last_a, last_b = np.flatnonzero(closes_a), np.flatnonzero(closes_b)
        group_a = np.cumsum(closes_a) - closes_a
        group_b = np.cumsum(closes_b) - closes_b
        before_b = np.concatenate([[0], last_b + 1])
        until_a = np.concatenate([last_a + 1, [len(a)]])
        code = np.empty(len(a) + len(b), dtype=np.int64)
        code[np.arange(len(a)) + before_b[group_a]] = a + closes_a * self.n_a
        code[np.arange(len(b)) + until_a[group_b]] = b + 2 * self.n_a + closes_b * self.n_b
        if not len(code):
            return b"", np.zeros(1, dtype=np.int64)
        _, starts, data = self.words.take(pa.array(code)).buffers()
        return data.to_pybytes(), np.frombuffer(starts, dtype=np.int64)[:len(code) + 1]


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of values that end before `ends`."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[np.concatenate([[0], ends[:-1]])]


def _listed(a: np.ndarray, b: np.ndarray, merged: Merged) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The id pairs of the links, frequent ones first, their counts, and the number of each link's pair."""
    pairs, which, n = np.unique(a[merged.a].astype(np.int64) * _PAIR + b[merged.b], return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return pairs[order], n[order], place[which.ravel()]


# ---------------------------------------------------------------------------- pieces

_PIECE = {
    "piece": pa.int64(), "text": pa.int64(), "n_pieces": pa.int32(),
    # per text of the row
    "counts": pa.list_(pa.int64()), "shas": pa.list_(pa.string()),
    "sizes": pa.list_(pa.int64()), "codes": pa.binary(), "uses": pa.binary(),
    # groups of a piece of a long text: what it closes first, what lies between, what it leaves open
    "open_a": pa.string(), "open_b": pa.string(), "between": pa.string(), "rest_a": pa.string(), "rest_b": pa.string(),
    # id pairs of the piece
    "pairs": pa.list_(pa.int64()), "n": pa.list_(pa.int64()), "first": pa.int64(),
    # tokens of a piece of a long text that is not merged yet
    "raw_a": pa.binary(), "raw_b": pa.binary(), "starts": pa.list_(pa.int64()), "tokens": pa.list_(pa.int64())}
_SPARK_TYPES = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string",
                pa.list_(pa.int64()): "array<bigint>", pa.list_(pa.string()): "array<string>"}
_PIECE_SCHEMA = "doc_ids array<{0}>, " + ", ".join(f"`{c}` {_SPARK_TYPES[t]}" for c, t in _PIECE.items())
_PAIRS_A_ROW = 50_000


def _row(id_type: pa.DataType, **values) -> pa.RecordBatch:
    types = {"doc_ids": pa.list_(id_type)} | _PIECE
    return pa.RecordBatch.from_arrays([pa.array([values.get(c)], t) for c, t in types.items()], list(types))


def _pair_rows(id_type: pa.DataType, piece: int, pairs: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(pairs), _PAIRS_A_ROW):
        yield _row(id_type, piece=piece, first=at, pairs=pairs[at:at + _PAIRS_A_ROW], n=n[at:at + _PAIRS_A_ROW])


def merge_texts(id_type: pa.DataType, piece: int, doc_ids: list, a_ids: list, b_ids: list,
                sides: tuple[_Side, _Side], writer: _Writer) -> Iterator[pa.RecordBatch]:
    """Rows of a piece of whole texts, which are merged as one sequence: every text ends a group."""
    a, b = np.concatenate(a_ids), np.concatenate(b_ids)
    n_a, n_b = (np.array([len(x) for x in ids]) for ids in (a_ids, b_ids))
    merged = merge(np.cumsum(sides[0].lengths[a]), np.cumsum(sides[1].lengths[b]), len(a), len(b))
    groups = _sums(merged.closes_a, np.cumsum(n_a))
    data, starts = writer.write(a, b, merged)
    ends = np.cumsum(n_a + n_b)
    shas = [hashlib.sha256(data[x:y - 1]).hexdigest() if y > x else ""
            for x, y in zip(starts[np.concatenate([[0], ends[:-1]])], starts[ends])]
    del data
    pairs, n, code = _listed(a, b, merged)
    # per text the different pairs, ascending, and how many links have them
    owner = np.repeat(np.arange(len(doc_ids)), n_a)[merged.a]
    keys, uses = np.unique(owner * max(1, len(pairs)) + code, return_counts=True)
    text, codes = np.divmod(keys, max(1, len(pairs)))
    links = np.bincount(owner, minlength=len(doc_ids))
    sizes = np.bincount(text, minlength=len(doc_ids))
    last = np.concatenate([[0], np.cumsum(sizes)])
    counts = np.stack([n_a, n_b, groups, links], axis=1)
    for at in range(0, len(doc_ids), ROW_TEXTS):
        to = min(at + ROW_TEXTS, len(doc_ids))
        some = codes[last[at]:last[to]]
        # ascending within a text: differences, with the first of each text as it is
        steps = np.diff(some, prepend=0)
        heads = last[at:to][sizes[at:to] > 0] - last[at]
        steps[heads] = some[heads]
        yield _row(id_type, doc_ids=doc_ids[at:to], piece=piece, n_pieces=1, counts=counts[at:to].ravel(),
                   shas=shas[at:to], sizes=sizes[at:to], codes=pack_numbers(steps),
                   uses=pack_numbers(uses[last[at]:last[to]] - 1))
    yield from _pair_rows(id_type, piece, pairs, n)


def _names(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def merge_part(id_type: pa.DataType, row: dict, sides: tuple[_Side, _Side], writer: _Writer) -> Iterator[pa.RecordBatch]:
    """Rows of a piece of a long text, merged by itself."""
    a, b = unpack_numbers(row["raw_a"]), unpack_numbers(row["raw_b"])
    n_a, n_b = row["tokens"]
    merged = merge(row["starts"][0] + np.cumsum(sides[0].lengths[a]), row["starts"][1] + np.cumsum(sides[1].lengths[b]),
                   n_a, n_b)
    pairs, n, code = _listed(a, b, merged)
    codes, uses = np.unique(code, return_counts=True)
    last_a, last_b = np.flatnonzero(merged.closes_a), np.flatnonzero(merged.closes_b)
    groups = {}
    if len(last_a):
        head, tail = (last_a[0] + 1, last_b[0] + 1), (last_a[-1] + 1, last_b[-1] + 1)
        inner = Merged(merged.a, merged.b, merged.closes_a[head[0]:tail[0]], merged.closes_b[head[1]:tail[1]])
        between, _ = writer.write(a[head[0]:tail[0]], b[head[1]:tail[1]], inner)
        groups = {"between": between.decode(), "rest_a": _names(a[tail[0]:n_a]), "rest_b": _names(b[tail[1]:n_b])}
    else:
        head = (n_a, n_b)
    yield _row(id_type, doc_ids=row["doc_ids"], piece=row["piece"], text=row["text"], n_pieces=row["n_pieces"],
               counts=[n_a, n_b, len(last_a), len(code)], sizes=[len(codes)],
               codes=pack_numbers(np.diff(codes, prepend=0)), uses=pack_numbers(uses - 1),
               open_a=_names(a[:head[0]]), open_b=_names(b[:head[1]]), **groups)
    yield from _pair_rows(id_type, row["piece"], pairs, n)


def stitch(parts: list[dict]) -> str:
    """Text of all groups of a long text, from its pieces in order."""
    out, open_a, open_b = [], [], []
    for p in parts:
        open_a.append(p["open_a"])
        open_b.append(p["open_b"])
        if p["between"] is not None:
            out.append(",".join(filter(None, open_a)) + "|" + ",".join(filter(None, open_b)) + ";" + p["between"])
            open_a, open_b = [p["rest_a"]], [p["rest_b"]]
    return "".join(out)[:-1]


def _sides(tokenizers: Tokenizers) -> tuple[tuple[_Side, _Side], _Writer]:
    encode_a, encode_b, tokens_a, tokens_b = tokenizers.open()
    return (_Side(encode_a, tokens_a), _Side(encode_b, tokens_b)), _Writer(len(tokens_a), len(tokens_b))


def _some_texts(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """doc_ids and texts of a batch, about CHARS_AT_ONCE characters at a time."""
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        ids.append(doc_id)
        texts.append(text.as_py() or "")
        held += len(texts[-1])
        if held >= CHARS_AT_ONCE:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def merged_pieces(docs: DataFrame, tokenizers: Tokenizers, work: int = WORK) -> DataFrame:
    """Rows of _PIECE_SCHEMA: texts with their own pairs' numbers and uses, and the pairs of each piece."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizers)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = _PIECE_SCHEMA.format(kind)

    def tokenize(batches):
        sides, writer = _sides(shared.value)
        number = TaskContext.get().partitionId() << 32
        held: tuple[list, list, list] = ([], [], [])
        ends = 0
        for batch in batches:
            id_type = batch.column(0).type
            for doc_ids, texts in _some_texts(batch):
                for doc_id, (a, b) in zip(doc_ids, encode_both(*sides, texts)):
                    size = len(a) + len(b)
                    if held[0] and ends + size > work:
                        yield from merge_texts(id_type, number, *held, sides, writer)
                        number, held, ends = number + 1, ([], [], []), 0
                        pa.default_memory_pool().release_unused()
                    if size > work:
                        ends_a, ends_b = np.cumsum(sides[0].lengths[a]), np.cumsum(sides[1].lengths[b])
                        ranges, text = cut(ends_a, ends_b, work), number
                        for i0, i1, j0, j1 in ranges:
                            yield _row(id_type, doc_ids=[doc_id], piece=number, text=text, n_pieces=len(ranges),
                                       raw_a=pack_numbers(a[i0:i1 + 1]), raw_b=pack_numbers(b[j0:j1 + 1]),
                                       starts=[int(ends_a[i0 - 1]) if i0 else 0, int(ends_b[j0 - 1]) if j0 else 0],
                                       tokens=[i1 - i0, j1 - j0])
                            number += 1
                        continue
                    for store, value in zip(held, (doc_id, a, b)):
                        store.append(value)
                    ends += size
        if held[0]:
            yield from merge_texts(id_type, number, *held, sides, writer)

    def merge_parts(batches):
        sides, writer = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if sides is None:
                    sides, writer = _sides(shared.value)
                yield from merge_part(batch.schema.field("doc_ids").type.value_type, row, sides, writer)

    made = materialize(docs.select("doc_id", "text").mapInArrow(tokenize, schema))
    raw = made.filter("raw_a IS NOT NULL").repartition(shuffle_partitions(docs.sparkSession), "piece")
    return made.filter("raw_a IS NULL").unionByName(raw.mapInArrow(merge_parts, schema))


def _exploded(pieces: DataFrame) -> DataFrame:
    """piece, code, pair, n: the pairs of each piece."""
    return pieces.filter("pairs IS NOT NULL").select(
        "piece", "first", F.posexplode(F.arrays_zip("pairs", "n")).alias("k", "x")).select(
        "piece", (F.col("first") + F.col("k")).cast("int").alias("code"), F.col("x.pairs").alias("pair"),
        F.col("x.n").alias("n"))


def _counted(exploded: DataFrame) -> DataFrame:
    """pair, count, is_best: links of the corpus per id pair, and if no other pair of its B id has more."""
    counts = materialize(exploded.groupBy("pair").agg(F.sum("n").alias("count"))
                         .withColumn("b", F.col("pair") % F.lit(_PAIR)))
    # one row per B id, of which there are as many as B has
    most = F.broadcast(counts.groupBy("b").agg(F.max("count").alias("most")))
    return counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("is_best"))


def pair_counts(docs: DataFrame, tokenizers: Tokenizers, work: int = WORK) -> DataFrame:
    """a_id, b_id, count, is_best: the links of all texts per id pair."""
    return _counted(_exploded(merged_pieces(docs, tokenizers, work))).select(
        F.expr(f"cast(pair div {_PAIR} as int)").alias("a_id"), F.expr(f"cast(pair % {_PAIR} as int)").alias("b_id"),
        "count", "is_best")


def alignments(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """doc_id, a_ids, b_ids, a_ends, b_ends, group_ends, links (numbers of an A and a B token) of each text.

    Ends are byte offsets in space + text. Texts without tokens have empty lists.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizers)
    names = ["a_ids", "b_ids", "a_ends", "b_ends", "group_ends"]
    numbers, pair = pa.list_(pa.int64()), pa.struct([("a", pa.int64()), ("b", pa.int64())])

    def align(batches):
        sides, _ = _sides(shared.value)
        for batch in batches:
            for doc_ids, texts in _some_texts(batch):
                columns: list[list] = [[] for _ in names]
                links = []
                for a, b in encode_both(*sides, texts):
                    ends = [np.cumsum(s.lengths[x]) for s, x in zip(sides, (a, b))]
                    merged = merge(*ends, len(a), len(b))
                    order = np.lexsort((merged.b, merged.a))
                    links.append([{"a": int(i), "b": int(j)} for i, j in zip(merged.a[order], merged.b[order])])
                    for column, value in zip(columns, (a, b, *ends, ends[0][merged.closes_a])):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, batch.column(0).type), *(pa.array(c, numbers) for c in columns),
                     pa.array(links, pa.list_(pair))], ["doc_id", *names, "links"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = ", ".join(f"{n} array<bigint>" for n in names)
    return docs.select("doc_id", "text").mapInArrow(
        align, f"doc_id {kind}, {lists}, links array<struct<a:bigint,b:bigint>>")


_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def summarize(docs: DataFrame, tokenizers: Tokenizers, work: int = WORK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per text.

    Texts that are NULL or empty, or that one tokenizer's bytes do not give back, have no tokens: zeros
    and an empty groups_sha256. Texts are encoded whole, whatever their length. Repeated rows and NULL
    ids each count and get their row. No rows give no rows. Columns other than doc_id and text are
    not read.
    """
    spark: SparkSession = docs.sparkSession
    pieces = merged_pieces(docs, tokenizers, work)
    exploded = _exploded(pieces)
    joined = exploded.join(_counted(exploded), "pair").select(
        F.col("piece").alias("of_piece"), "code", "count", "is_best")
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = ["open_a", "open_b", "between", "rest_a", "rest_b"]
    texts = pieces.filter("codes IS NOT NULL").select(
        "doc_ids", "piece", "text", "n_pieces", "counts", "shas", "sizes", "codes", "uses", *held)
    fields = ", ".join(f"{c} bigint" for c in _COUNTS)

    def put(rows: pa.Table, counted: pa.Table) -> pa.Table:
        code = counted["code"].to_numpy()
        count = np.zeros(len(code), dtype=np.int64)
        best = np.zeros(len(code), dtype=np.int64)
        count[code] = counted["count"].to_numpy()
        best[code] = counted["is_best"].to_numpy(zero_copy_only=False)
        columns: list[list] = [[] for _ in _COUNTS]
        for given, sizes, codes, uses in zip(*(rows[c].to_pylist() for c in ("counts", "sizes", "codes", "uses"))):
            sizes, steps, use = np.array(sizes), unpack_numbers(codes), unpack_numbers(uses) + 1
            ends = np.cumsum(sizes)
            # differences within a text add up to its codes
            total = np.cumsum(steps)
            begin = (ends - sizes)[sizes > 0]
            which = total - np.repeat(total[begin] - steps[begin], sizes[sizes > 0])
            for column, values in zip(columns, np.array(given).reshape(-1, 4).T):
                column.append(values)
            columns[4].append(_sums(use * best[which], ends))
            columns[5].append(_sums(use * count[which], ends))
        n = pc.list_value_length(rows["doc_ids"])
        which = np.repeat(np.arange(len(rows)), n.to_numpy())
        shas = [s for row, k in zip(rows["shas"].to_pylist(), n.to_pylist()) for s in (row or [None] * k)]
        return pa.table({
            "doc_id": pc.list_flatten(rows["doc_ids"]), **dict(zip(_COUNTS, map(np.concatenate, columns))),
            "groups_sha256": pa.array(shas, pa.string()),
            **{c: rows[c].take(pa.array(which)) for c in ("piece", "text", "n_pieces", *held)}})

    summed = texts.groupBy("piece").cogroup(joined.groupBy("of_piece")).applyInArrow(
        put, f"doc_id {kind}, {fields}, groups_sha256 string, piece bigint, text bigint, n_pieces int, "
             + ", ".join(f"{c} string" for c in held))
    final = ["doc_id", *_COUNTS, "groups_sha256"]
    long_texts = pieces.filter("text IS NOT NULL").select("piece").limit(1)
    if long_texts.isEmpty():
        return summed.select(*final)
    summed = materialize(summed)

    def finish(rows: pa.Table) -> pa.Table:
        parts = sorted(rows.to_pylist(), key=lambda r: r["piece"])
        sha = hashlib.sha256(stitch(parts).encode()).hexdigest()
        return pa.table({"doc_id": rows["doc_id"][:1], **{c: [sum(p[c] for p in parts)] for c in _COUNTS},
                         "groups_sha256": [sha]})

    stitched = summed.filter("n_pieces > 1").groupBy("text").applyInArrow(
        finish, f"doc_id {kind}, {fields}, groups_sha256 string")
    return summed.filter("n_pieces = 1").select(*final).unionByName(stitched)
