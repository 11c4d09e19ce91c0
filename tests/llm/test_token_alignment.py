"""Alignment of two tokenizers against byte-by-byte overlaps."""

import collections
import functools
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketry.llm import token_alignment as ta

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, piece string, n string, pair string"


@pytest.fixture(scope="module")
def tokenizers():
    return ta.Tokenizers.read(A_PATH, B_PATH)


@functools.cache
def opened():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH), ta.byte_of_letter()


def plain_tokens(text):
    """Ids and byte ranges of both, or none."""
    a, b, letters = opened()
    if not text:
        return [], []
    want = (" " + text).encode()
    out = []
    for ids, name in ((a.encode(" " + text, add_special_tokens=False).ids,
                       lambda k: bytes(letters[c] for c in a.id_to_token(k))),
                      (b.encode(text), lambda k: bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k)
                       else b.id_to_piece(k).replace("▁", " ").encode())):
        at, tokens = 0, []
        for k in ids:
            n = len(name(k))
            tokens.append((k, at, at + n))
            at += n
        if b"".join(name(k) for k in ids) != want:
            return [], []
        out.append(tokens)
    return out


def plain(texts):
    """n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each text."""
    found, counts = [], collections.Counter()
    for text in texts:
        a, b = plain_tokens(text)
        links, at = [], 0
        for k, begin, end in a:
            while at and b[at][1] > begin:
                at -= 1
            while b[at][2] <= begin:
                at += 1
            j = at
            while j < len(b) and b[j][1] < end:
                links.append((k, b[j][0]))
                j += 1
        counts.update(links)
        both = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = [",".join(str(k) for k, _, e in a if x < e <= y) + "|" + ",".join(str(k) for k, _, e in b if x < e <= y)
                  for x, y in zip([0, *both], both)] if len(a) < 4000 else None
        found.append((a, b, len(both), links, groups))
    best = collections.Counter()
    for (_, k), n in counts.items():
        best[k] = max(best[k], n)
    return [(len(a), len(b), groups, len(links), sum(counts[x] == best[x[1]] for x in links),
             sum(counts[x] for x in links),
             "" if not a else listed if listed is None else hashlib.sha256(";".join(listed).encode()).hexdigest())
            for a, b, groups, links, listed in found]


def texts(seed=0, n=60):
    rng = random.Random(seed)
    parts = ["the", " quick", "brown\n\n", "\t", "  ", "é", "日本語", "🙂", "▁", "<|endoftext|>", "<s>", "antidisestablish",
             "1234567", "\x00", "​", "ﬁ", "don't", "\r\n", "ÅÅ", "مرحبا", "xyzzyq", "<0x41>"]
    made = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(1, 40))) for _ in range(n)]
    return [None, "", " ", "a", "same text here", "same text here", *made, "word " * 300, "nospaces" * 150]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "p", "n", "q") for i, t in enumerate(rows)], SCHEMA).repartition(3)


@pytest.mark.parametrize("work", [ta.WORK, 500, 40])
def test_equals_brute_force(spark, tokenizers, work):
    rows = texts()
    got = ta.summarize(frame(spark, rows), tokenizers, work)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = {r.doc_id: tuple(r)[1:] for r in got.collect()}
    assert len(found) == len(rows)
    for i, want in enumerate(plain(rows)):
        assert found[i] == want, repr(rows[i])


def test_null_ids_repeated_rows_and_empty_tables(spark, tokenizers):
    docs = spark.createDataFrame([(None, "one text"), (None, "one text"), (3, None)], "doc_id bigint, text string")
    got = sorted(map(tuple, ta.summarize(docs, tokenizers).collect()), key=str)
    want = plain(["one text", "one text", None])
    assert got == sorted([(None, *want[0]), (None, *want[1]), (3, *want[2])], key=str)
    assert ta.summarize(docs.limit(0), tokenizers).collect() == []
    assert ta.summarize(docs.filter("doc_id = 3"), tokenizers).collect() == [(3, 0, 0, 0, 0, 0, 0, "")]


def test_pairs_and_alignments_are_real_outputs(spark, tokenizers):
    rows = texts(3, 15)
    docs = frame(spark, rows)
    aligned = {r.doc_id: r for r in ta.alignments(docs, tokenizers).collect()}
    counts = collections.Counter()
    for i, text in enumerate(rows):
        a, b = plain_tokens(text)
        r = aligned[i]
        assert (r.a_ids, r.a_ends) == ([k for k, _, _ in a], [e for _, _, e in a])
        links = [(x, y) for x, (_, s, e) in enumerate(a) for y, (_, t, f) in enumerate(b) if s < f and t < e]
        assert [tuple(x) for x in r.links] == links
        counts.update((a[x][0], b[y][0]) for x, y in links)
    found = {(r.a_id, r.b_id): r["count"] for r in ta.pair_counts(docs, tokenizers, 200).collect()}
    assert found == counts


def test_diagonals_give_even_pieces():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(rng.integers(1, 60, rng.integers(1, 40)))
        b = np.unique(rng.integers(1, 60, rng.integers(1, 40)))
        a, b = np.append(a, 60), np.append(b, 60)
        work = int(rng.integers(2, 30))
        pieces = ta.cut(a, b, work)
        assert pieces[0][0] == pieces[0][2] == 0 and pieces[-1][1::2] == (len(a), len(b))
        links = []
        for (i0, i1, j0, j1), after in zip(pieces, [*pieces[1:], None]):
            assert i1 - i0 + j1 - j0 <= work + 1
            if after:
                assert after[0] == i1 and after[2] == j1
                # equal ends stay together, and no later end is smaller
                assert max([*a[i0:i1], *b[j0:j1]], default=0) < min(a[i1], b[j1])
            merged = ta.merge(a[i0:i1 + 1], b[j0:j1 + 1], i1 - i0, j1 - j0)
            links += [(i0 + x, j0 + y) for x, y in zip(merged.a, merged.b)]
        starts_a, starts_b = [0, *a[:-1]], [0, *b[:-1]]
        assert sorted(links) == [(x, y) for x in range(len(a)) for y in range(len(b))
                                 if starts_a[x] < b[y] and starts_b[y] < a[x]]


def test_one_text_for_a_third_of_all_rows(spark, tokenizers):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 3 == 0, F.lit("a common text")).otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"))
    got = {r.doc_id: tuple(r)[1:] for r in ta.summarize(docs, tokenizers, 300).collect()}
    want = plain([r.text for r in docs.orderBy("doc_id").collect()])
    assert [got[i] for i in range(900)] == want
