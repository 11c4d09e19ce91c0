"""Byte-level BPE over a corpus: every distinct word is encoded once.

Texts are cut into blocks of about BLOCK_CHARS characters. A block keeps, per text, the
positions of its pre-tokens as numbers into the block's own list of distinct words; only that
list is exploded and shuffled, by word. Each distinct word of the corpus is then encoded once,
the ids go back to the blocks that hold the word, and each text is put together by position. A
word that is frequent everywhere is sent once per block, not once per use. A block's words go in
at most MOST_PARTS rows, so rows grow with the input and not with its square.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from basketry.llm.common import shuffle_partitions, ship

ship(__name__)

BLOCK_CHARS = 8_000_000
# texts in a row of a block
ROW_TEXTS = 256
# parts of the words per shuffle partition, so that partitions come out even, and in all
PARTS_EACH = 4
MOST_PARTS = 1024
# rows of words handled at a time
ROWS_AT_ONCE = 256
# words whose ids a task remembers at a time
REMEMBERED = 2_000_000
_TWO_SPACES = re.compile(r"\s\s")
_BLOCK_SCHEMA = ("block bigint, doc_ids array<{0}>, sizes array<bigint>, codes binary, "
                 "part int, numbers binary, lengths binary, words binary")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file of base64 and number per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _pack(data: bytes) -> bytes:
    """Compressed bytes after their length."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, codec="zstd", asbytes=True) if size else b""


def _digits(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative numbers in seven bits a byte, low bits first, and how many bytes each takes."""
    rest = values.astype(np.uint64)
    digits, more = [], []
    while True:
        digits.append((rest & np.uint64(127)).astype(np.uint8))
        rest = rest >> np.uint64(7)
        more.append(rest > 0)
        if not more[-1].any():
            break
    table = np.stack([d | (m.astype(np.uint8) << 7) for d, m in zip(digits, more)], axis=1)
    used = np.stack([np.ones(len(values), bool), *more[:-1]], axis=1)
    return table[used], used.sum(axis=1)


def _numbers(digits: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(digits < 128)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    length = last - first + 1
    values = (digits[first] & 127).astype(np.int64)
    for k in range(1, int(length.max(initial=1))):
        has = length > k
        values[has] |= (digits[first[has] + k] & 127).astype(np.int64) << (7 * k)
    return values


def pack_numbers(values: np.ndarray) -> bytes:
    """Non-negative numbers in seven bits a byte, low bits first, compressed."""
    return _pack(_digits(values)[0].tobytes())


def unpack_numbers(data: bytes) -> np.ndarray:
    return _numbers(np.frombuffer(_unpack(data), dtype=np.uint8))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the first counts[0] values, of the counts[1] after them, and so on."""
    before = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return before[ends] - before[ends - counts]


def pack_lists(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """`pack_numbers` of each list of numbers; the lists, of `counts` numbers, lie one after the other."""
    digits, sizes = _digits(values)
    return [_pack(x) for x in _slices(digits.tobytes(), _sums(sizes, counts).tolist())]


def unpack_lists(packed: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all lists, one after the other, and how many each has."""
    lists = [np.frombuffer(_unpack(x), dtype=np.uint8) for x in packed]
    digits = np.concatenate([np.zeros(0, dtype=np.uint8), *lists])
    counts = _sums(digits < 128, np.array([len(x) for x in lists], dtype=np.int64))
    return _numbers(digits), counts


def _slices(data: bytes, sizes: Iterable[int]) -> list[bytes]:
    out, at = [], 0
    for size in sizes:
        out.append(data[at:at + size])
        at += size
    return out


class _Block:
    """Distinct words of some texts, and the texts as numbers of their words."""

    def __init__(self, pattern):
        self.pattern = pattern
        self.words: dict[str, int] = {}
        self.chunks: dict[str, tuple[int, ...]] = {}
        self.ids: list = []
        self.texts: list[np.ndarray] = []
        self.chars = 0

    def _numbers(self, piece: str) -> tuple[int, ...]:
        words = self.words
        return tuple(words.setdefault(w, len(words)) for w in self.pattern.findall(piece))

    def add(self, doc_id, text: str) -> None:
        # Where no two white spaces meet, a pre-token always starts at a space: the pieces
        # between spaces can be looked up one by one. Else the text is matched as a whole.
        if _TWO_SPACES.search(text):
            numbers = self._numbers(text)
        else:
            first, *rest = text.split(" ")
            chunks = self.chunks
            numbers = list(self._numbers(first)) if first else []
            for piece in rest:
                found = chunks.get(piece)
                if found is None:
                    found = chunks[piece] = self._numbers(" " + piece)
                numbers += found
        self.ids.append(doc_id)
        self.texts.append(np.array(numbers, dtype=np.uint32))
        self.chars += len(text) + 64

    def rows(self, block: int, id_type: pa.DataType, parts: int) -> Iterator[pa.RecordBatch]:
        self.chunks.clear()
        # frequent words get small numbers, which take fewer bytes
        uses = np.bincount(np.concatenate(self.texts), minlength=len(self.words))
        by_use = np.argsort(-uses, kind="stable")
        place = np.empty(len(by_use), dtype=np.uint32)
        place[by_use] = np.arange(len(by_use), dtype=np.uint32)
        for at in range(0, len(self.ids), ROW_TEXTS):
            texts = self.texts[at:at + ROW_TEXTS]
            yield self._rows(block, id_type, doc_ids=[self.ids[at:at + ROW_TEXTS]],
                             sizes=[[len(t) for t in texts]],
                             codes=[pack_numbers(place[np.concatenate(texts)])])
        listed = [w.encode() for w in self.words]
        part = np.array([zlib.crc32(w) % parts for w in listed], dtype=np.int64)[by_use]
        order = np.argsort(part, kind="stable")
        found, counts = np.unique(part, return_counts=True)
        ends = np.cumsum(counts)
        for at in range(0, len(found), ROWS_AT_ONCE):
            some = slice(at, at + ROWS_AT_ONCE)
            members = order[ends[at] - counts[at]:ends[some][-1]]
            steps = np.diff(members, prepend=0)
            starts = np.cumsum(counts[some]) - counts[some]
            steps[starts] = members[starts]
            words = [listed[k] for k in by_use[members].tolist()]
            lengths = np.array([len(w) for w in words])
            yield self._rows(block, id_type, part=found[some],
                             numbers=pack_lists(steps, counts[some]),
                             lengths=pack_lists(lengths, counts[some]),
                             words=[_pack(x) for x in _slices(b"".join(words), _sums(lengths, counts[some]).tolist())])
        pa.default_memory_pool().release_unused()

    @staticmethod
    def _rows(block: int, id_type: pa.DataType, **values) -> pa.RecordBatch:
        types = {"block": pa.int64(), "doc_ids": pa.list_(id_type), "sizes": pa.list_(pa.int64()),
                 "codes": pa.binary(), "part": pa.int32(), "numbers": pa.binary(),
                 "lengths": pa.binary(), "words": pa.binary()}
        n = len(next(iter(values.values())))
        rows = {"block": [block] * n} | values
        return pa.RecordBatch.from_arrays(
            [pa.array(rows.get(c, [None] * n), t) for c, t in types.items()], list(types))


def pre_tokens(docs: DataFrame, pattern: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of texts: rows with texts as numbers of words, and rows with words of one part."""
    parts = min(PARTS_EACH * shuffle_partitions(docs.sparkSession), MOST_PARTS)

    def cut(batches):
        compiled = regex.compile(pattern)
        task, n = TaskContext.get().partitionId(), 0
        block, id_type = _Block(compiled), None
        for batch in batches:
            id_type = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(doc_id, text.as_py() or "")
                if block.chars >= block_chars:
                    yield from block.rows((task << 32) + n, id_type, parts)
                    block, n = _Block(compiled), n + 1
        if block.ids:
            yield from block.rows((task << 32) + n, id_type, parts)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, _BLOCK_SCHEMA.format(kind))


def explode_words(blocks: DataFrame) -> DataFrame:
    """block, part, numbers, lengths, words: a block's distinct words, by part."""
    columns = ["block", "part", "numbers", "lengths", "words"]

    def explode(batches):
        for batch in batches:
            kept = pa.Table.from_batches([batch]).select(columns)
            yield from kept.filter(pc.is_valid(kept["part"])).to_batches()

    return blocks.mapInArrow(
        explode, "block bigint, part int, numbers binary, lengths binary, words binary")


def encode_words(words: DataFrame, ranks) -> DataFrame:
    """block, numbers, lengths, ids: the words' ids, joined back to the blocks that hold them.

    All uses of a word are in one part and so in one task, which encodes it when it first comes.
    `ranks` is a broadcast of the vocabulary.
    """
    def encode(batches):
        import tiktoken

        whole = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks.value,
                                  special_tokens={})
        known: dict[bytes, list[int]] = {}
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, ROWS_AT_ONCE):
                batch = whole_batch.slice(at, ROWS_AT_ONCE)
                sizes, counts = unpack_lists(batch.column("lengths").to_pylist())
                found = []
                for word in _slices(b"".join(map(_unpack, batch.column("words").to_pylist())), sizes.tolist()):
                    ids = known.get(word)
                    if ids is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        ids = known[word] = whole.encode_ordinary(word.decode())
                    found.append(ids)
                lengths = np.fromiter(map(len, found), np.int64, len(found))
                ids = np.fromiter(itertools.chain.from_iterable(found), np.int64, int(lengths.sum()))
                yield pa.RecordBatch.from_arrays([
                    batch.column("block"), batch.column("numbers"),
                    pa.array(pack_lists(lengths, counts), pa.binary()),
                    pa.array(pack_lists(ids, _sums(lengths, counts)), pa.binary())],
                    ["block", "numbers", "lengths", "ids"])

    partitions = min(shuffle_partitions(words.sparkSession), MOST_PARTS)
    return (words.repartition(partitions, "part")
            .mapInArrow(encode, "block bigint, numbers binary, lengths binary, ids binary"))


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """values[starts[k]:starts[k]+lengths[k]] for k of `which`, one after the other."""
    sizes = lengths[which]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts[which] - (ends - sizes), sizes)]


def reassemble(blocks: DataFrame, coded: DataFrame, make, columns: str) -> DataFrame:
    """doc_id and `columns`: what make()(ids) gives of each text's ids, by the positions of its words."""
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    names = [c.split()[0] for c in columns.split(", ")]

    def put(texts: pa.Table, words: pa.Table) -> pa.Table:
        finish = make()
        texts = texts.filter(pc.is_valid(texts["doc_ids"]))
        steps, counts = unpack_lists(words["numbers"].to_pylist())
        # numbers are sums of the steps of their list
        totals = _sums(steps, counts)
        numbers = np.cumsum(steps) - np.repeat(np.cumsum(totals) - totals, counts)
        lengths = unpack_lists(words["lengths"].to_pylist())[0]
        ids = unpack_lists(words["ids"].to_pylist())[0].astype("<u4")
        length, start = np.zeros((2, len(numbers)), dtype=np.int64)
        length[numbers] = lengths
        start[numbers] = np.cumsum(lengths) - lengths
        out = []
        for sizes, packed in zip(texts["sizes"].to_pylist(), texts["codes"].to_pylist()):
            for codes in np.split(unpack_numbers(packed), np.cumsum(sizes)[:-1]):
                out.append(finish(_gather(ids, start, length, codes)))
        pa.default_memory_pool().release_unused()
        return pa.table({"doc_id": pc.list_flatten(texts["doc_ids"]), **dict(zip(names, zip(*out)))})

    return blocks.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(
        put, f"doc_id {kind}, {columns}")


def _encoded(docs: DataFrame, ranks_path: str, pattern: str, block_chars: int, make,
             columns: str) -> DataFrame:
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    # both uses below read all columns of one exchange, so Spark runs it once
    blocks = pre_tokens(docs, pattern, block_chars).repartition(shuffle_partitions(spark), "block")
    return reassemble(blocks, encode_words(explode_words(blocks), ranks), make, columns)


def encode(docs: DataFrame, ranks_path: str, pattern: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id and ids (binary, little-endian 32-bit) of each text, in no order.

    NULL and empty texts have no ids. Repeated rows each get their own row, NULL doc_ids too. Texts
    of any length are encoded whole; a longer one than a block is a block of its own. No rows give
    no rows. Columns other than doc_id and text are not read.
    """
    return _encoded(docs, ranks_path, pattern, block_chars,
                    lambda: lambda ids: (ids.tobytes(),), "ids binary")


def _token_table(spark, ranks_path: str):
    """Broadcast of the bytes of each id: one entry per token, whatever the corpus holds."""
    return spark.sparkContext.broadcast({rank: t for t, rank in read_ranks(ranks_path).items()})


def decode_ids(ids: np.ndarray, table: dict[int, bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds `decoded`, the bytes of `ids` (NULL of NULL): a join with the token table, which is broadcast."""
    table = _token_table(encoded.sparkSession, ranks_path)
    columns = encoded.columns

    def join(batches):
        for batch in batches:
            ids = batch.column(columns.index("ids"))
            decoded = [None if x is None else decode_ids(np.frombuffer(x, "<u4"), table.value)
                       for x in (y.as_py() for y in ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())],
                                             [*columns, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(join, f"{fields}, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text: encoded, and decoded again.

    Both digests are made where a text's ids are put together, so ids and bytes go no further.
    """
    table = _token_table(docs.sparkSession, ranks_path)

    def make():
        def digest(ids: np.ndarray) -> tuple[int, str, str]:
            return (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                    hashlib.sha256(decode_ids(ids, table.value)).hexdigest())

        return digest

    return _encoded(docs, ranks_path, pattern, block_chars, make,
                    "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
