"""Fingerprints, BPE, token counts, SimHash and classifiers against brute force on small texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from basketry.llm import bpe, merkle, quality, simhash, token_counts, toxicity

TEXTS = [
    None, "", " ", "one", "a b", "a  b\n\n c\t\td ", "x\n y", "x \ny", "  lead", "trail   ",
    "Größe 漢字 😀 it's we'll 123 4567 ###!!\n\n\nend", "a\u00a0b \u00a0 c\x1cd\x85e", "\x00 nul",
    "word " * 5000, "é" * 3000, "one", "one two three four", "ONE two THREE four", "one two three four",
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, fp int"


def frame(spark, texts, ids=None):
    """Documents with extra columns whose names clash with those of results."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, None, None, "x", 1) for i, t in zip(ids, texts)], SCHEMA)


@pytest.fixture(scope="module")
def encoder():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n, seed):
    rnd = random.Random(seed)
    signs = ["a", "b", "the", "Z", "7", " ", " ", " ", "\n", "\t", "'s", "'", "é", "漢", "😀", "!", "\u2028", "\u00a0", "\x1f"]
    return ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("block_chars", [50, 8_000_000])
def test_bpe_equals_tiktoken(spark, encoder, block_chars):
    texts = TEXTS + random_texts(300, 3)
    ids = [None, *range(1, len(texts))]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = frame(spark, texts, ids).repartition(3)
    got = {r.doc_id: r for r in bpe.round_trip(docs, path, public_tokenizers.PATTERN, block_chars).collect()}
    assert len(got) == len(texts)
    for i, text in zip(ids, texts):
        want = encoder.encode_ordinary(text or "")
        data = np.array(want, dtype="<u4").tobytes()
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(want), hashlib.sha256(data).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()), repr(text)


def test_bpe_general_interface_and_empty_table(spark, encoder):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = frame(spark, TEXTS)
    rows = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path).collect()
    assert sorted((r.doc_id, bytes(r.decoded).decode()) for r in rows) == [(i, t or "") for i, t in enumerate(TEXTS)]
    assert bpe.round_trip(docs.limit(0), path, public_tokenizers.PATTERN).collect() == []


def test_numbers_are_packed_without_loss():
    for values in ([], [0], [127, 128, 16383, 16384, 2**31, 2**40], list(range(1000))):
        assert bpe.unpack_numbers(bpe.pack_numbers(np.array(values, dtype=np.int64))).tolist() == values


def test_lists_of_numbers_are_packed_without_loss():
    lists = [[], [0, 300], [], [2**40], list(range(500)), []]
    values, counts = bpe.unpack_lists(bpe.pack_lists(
        np.array([x for each in lists for x in each]), np.array([len(each) for each in lists])))
    assert values.tolist() == [x for each in lists for x in each]
    assert counts.tolist() == [len(each) for each in lists]
    assert [x.tolist() for x in bpe.unpack_lists([])] == [[], []]


@pytest.mark.parametrize("partitions", [400, 4000])
def test_rows_of_a_block_do_not_grow_with_the_partitions(spark, partitions):
    """A larger input has more blocks and more partitions; rows for each of both would grow with its square."""
    text = " ".join(f"w{i}" for i in range(9000))
    docs = frame(spark, [text, text]).repartition(1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = bpe.pre_tokens(docs, public_tokenizers.PATTERN).filter("part is not null")
        counted = rows.groupBy("part").count().toPandas()
        words = sum(len(bpe.unpack_numbers(r.lengths)) for r in rows.select("lengths").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert 1000 < len(counted) <= 1024 and counted["count"].max() == 1
    assert words == len(set(__import__("regex").findall(public_tokenizers.PATTERN, text)))


@pytest.mark.parametrize("vocabulary", [
    None,
    [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), ("bb", -2.5), ("▁", -1.0), ("▁a", -2.0)],
    [("a", -1.0), ("a▁b", -1.0), ("▁", -3.0), ("b", -4.0), ("▁▁", -2.0)],
    [("x", -1.0)],
])
def test_token_counts_equal_the_library(spark, vocabulary):
    from tokenizers import Tokenizer, models

    vocabulary = vocabulary or token_counts.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary], 0, False))
    rnd = random.Random(5)
    texts = TEXTS + random_texts(300, 9) + ["".join(rnd.choice("aabb c") for _ in range(12)) for _ in range(300)]
    got = dict(token_counts.count_tokens(frame(spark, texts), vocabulary).select("doc_id", "n_tokens").collect())
    for i, text in enumerate(texts):
        marked = "▁" + (text or "").replace(" ", "▁") if text else ""
        assert got[i] == (len(library.encode(marked).ids) if marked else 0), repr(text)


def plain_simhash(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, distance=2):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("pairs_up_to", [96, 1])
def test_simhash_components_equal_brute_force(spark, pairs_up_to):
    rnd = random.Random(2)
    base = [rnd.choice(["red", "Green", "blue", "cat", "dog", "é"]) + str(rnd.randint(0, 30)) for _ in range(400)]
    near = [" ".join(base[:rnd.randint(390, 400)]) for _ in range(40)]
    texts = TEXTS + near + [" ".join(rnd.choices(base, k=rnd.randint(1, 8))) for _ in range(60)]
    got = {r.doc_id: r for r in simhash.near_duplicates(frame(spark, texts), pairs_up_to=pairs_up_to).collect()}
    fps = [plain_simhash(t) for t in texts]
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{f:016x}" for f in fps]
    assert [got[i].component_id for i in range(len(texts))] == brute_components(fps)


@pytest.mark.parametrize("pairs_up_to", [96, 2])
def test_links_of_random_near_fingerprints(spark, pairs_up_to):
    rnd = random.Random(8)
    centres = [rnd.getrandbits(64) for _ in range(4)]
    fps = sorted({c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for c in centres for _ in range(60)})
    signed = [simhash._signed(f) for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), pairs_up_to=pairs_up_to)
    assert all((a ^ b).bit_count() <= 2 or ((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in edges.collect())
    root = {r.node: r.root for r in simhash.components(edges).collect()}
    want = brute_components(fps)
    groups = {}
    for f, w in zip(signed, want):
        groups.setdefault(w, set()).add(root.get(f, f))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({next(iter(g)) for g in groups.values()})


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)]
    got = dict(simhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {i: 100 for i in range(100, 161)} | {7: 7} | {i: 7 for i in range(200, 260)}
    assert simhash.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_keep_first_keeps_one_row_per_group(spark):
    texts = ["same words in this text", "same words in this text", "another text altogether here", None, "",
             "same words in this text", "another text altogether here"]
    docs = frame(spark, texts, [5, 3, 4, 9, None, 3, None])
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [
        (3, "same words in this text"), (4, "another text altogether here"), (9, None)]
    lone = simhash.keep_first(frame(spark, ["only text without id", "only text without id"], [None, None]))
    assert [r.doc_id for r in lone.collect()] == [None]
    assert simhash.keep_first(docs.limit(0)).collect() == []


def edit(texts, i):
    text, follow = texts[i] or "", texts[(i + 1) % len(texts)] or ""
    half = len(text) // 2
    return text[:len(text) - half] + follow[:half]


def test_fingerprints_of_edited_texts(spark):
    texts = TEXTS + ["a b c d e f g h i j\nsecond paragraph\n\nnext section " * 9]
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    docs = frame(spark, [texts[i] for i in order], order)
    got = {r.doc_id: r for r in merkle.compare_with_edits(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        new = edit(texts, i)
        assert got[i].n_chars == len(text or "")
        assert got[i].edited_sha256 == hashlib.sha256(new.encode()).hexdigest(), repr(text)
        assert (got[i].fingerprint == got[i].edited_fingerprint) == ((text or "") == new)
        assert (got[i].near_edited == 1.0) or got[i].fingerprint != got[i].edited_fingerprint
        assert 0 <= got[i].near_next <= 1 and got[i].near_edited >= 0
        assert (got[i].edit_section is None) == ((text or "") == new)
    by_text = {}
    for i, text in enumerate(texts):
        by_text.setdefault(text or "", set()).add(got[i].fingerprint)
    assert all(len(f) == 1 for f in by_text.values()) and len(set.union(*by_text.values())) == len(by_text)


def test_merkle_tree_locates_the_edit(spark):
    a = "p1 is here\np2 is here\n\ns2 p1\ns2 p2\ns2 p3"
    b = "p1 is here\np2 is here\n\ns2 p1\ns2 px\ns2 p3"
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        merkle.first_edit(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("e"),
        merkle.likeness(merkle.fingerprint(merkle.tree(F.col("a"))),
                        merkle.fingerprint(merkle.tree(F.col("b")))).alias("l")).first()
    assert (row.e.section, row.e.paragraph) == (2, 2) and row.l == pytest.approx(4 / 6)


def test_fingerprints_without_ids_and_of_one_row(spark):
    assert merkle.compare_with_edits(frame(spark, [])).collect() == []
    one = merkle.compare_with_edits(frame(spark, ["abcd"], [7])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    rows = merkle.compare_with_edits(frame(spark, ["abcd", "abcd", "xyz"], [None, 1, 1])).collect()
    assert {r.doc_id: r.edited_sha256 for r in rows if r.doc_id is None} == {
        None: hashlib.sha256(b"ab").hexdigest()}
    assert {r.edited_sha256 for r in rows if r.doc_id == 1} == {
        hashlib.sha256(b"abxy").hexdigest(), hashlib.sha256(b"xya").hexdigest()}


# ------------------------------------------------------------------- classifiers

@pytest.fixture(scope="module")
def labelled(spark):
    folder = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_toxicity_on_labels_not_seen(spark, labelled):
    docs, labels = labelled
    part = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    chain = toxicity.train(docs, labels.filter(part == 0))
    scored = toxicity.score(docs.join(labels.select("doc_id", F.col("toxic").alias("y")), "doc_id").filter(part == 1), chain)
    rows = scored.join(labels, "doc_id").collect()
    flagged = [r.p_toxic >= toxicity.THRESHOLD for r in rows]
    toxic = [r.toxic for r in rows]
    assert sum(f and t for f, t in zip(flagged, toxic)) >= 0.75 * sum(toxic)
    assert sum(f and not t for f, t in zip(flagged, toxic)) <= 0.01 * (len(toxic) - sum(toxic))
    kept = toxicity.keep_clean(docs, chain)
    assert kept.columns == docs.columns
    assert kept.count() == toxicity.score(docs, chain).filter(F.col("p_toxic") < toxicity.THRESHOLD).count()


def test_toxicity_without_labels_rejects_nothing(spark):
    docs = frame(spark, TEXTS, [None, *range(1, len(TEXTS))])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    chain = toxicity.train(docs, none)
    assert toxicity.keep_clean(docs, chain).count() == len(TEXTS)
    assert toxicity.score(docs.limit(0), chain).collect() == []


def test_chain_learns_from_out_of_fold_predictions():
    rng = np.random.default_rng(0)
    x = (rng.random((400, 6)) < 0.4).astype(np.float32)
    first = x[:, 0]
    labels = np.stack([first, np.maximum(first, x[:, 1])], axis=1)
    weights = toxicity.fit_chain(x, labels, np.arange(400) % 5)
    assert [len(w) for w in weights] == [7, 8]
    chain = toxicity.Chain({str(i): i for i in range(6)}, weights)
    p = np.array([chain.probabilities(np.flatnonzero(row)) for row in x])
    assert ((p >= 0.5) == labels).mean() > 0.98
    # the same optimum as plain gradient descent on the same loss
    w, y = np.zeros(7), labels[:, 0]
    full = np.hstack([x, np.ones((400, 1))]).astype(float)
    ridge = np.append(np.full(6, toxicity.PENALTY), 1e-3)
    for _ in range(60_000):
        w -= 0.01 * (full.T @ (1 / (1 + np.exp(-full @ w)) - y) + ridge * w)
    assert np.abs(w - weights[0]).max() < 0.02


def test_quality_on_held_out_labels(spark, labelled):
    docs, labels = labelled
    rows = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    good = [r.predicted for r in rows if r.quality == 1]
    bad = [r.predicted for r in rows if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1
    scores = sorted((r.score, r.quality) for r in rows)
    ranks = [i for i, (_, q) in enumerate(scores) if q]
    auc = (sum(ranks) - len(good) * (len(good) - 1) / 2) / (len(good) * len(bad))
    assert auc > 0.98


def test_long_forms_that_differ_late_are_different_terms():
    assert quality.form("a1/b2/c3/d4/e5/f6?x") != quality.form("a1/b2/c3/d4/e5/f6#x")


def test_quality_votes_equal_brute_force():
    rng = np.random.default_rng(1)
    space = np.eye(5, dtype=np.float32)
    vectors = quality._unit(rng.normal(size=(40, 5)).astype(np.float32))
    labels = (rng.random(40) < 0.5).astype(float)
    model = quality.Model({}, np.ones(5), space, vectors, labels, 0.7)
    rows = np.vstack([rng.normal(size=(9, 5)), np.zeros((1, 5))]).astype(np.float32)
    for row, got in zip(rows, model.votes(rows, 7)):
        cosines = vectors @ (row / np.linalg.norm(row)) if row.any() else np.zeros(40)
        near = np.argsort(-cosines)[:7]
        weight = np.maximum(cosines[near], 0)
        want = (weight * labels[near]).sum() / weight.sum() if row.any() else 0.7
        assert got == pytest.approx(want, abs=1e-5)


def test_quality_of_empty_texts_and_without_labels(spark):
    docs = frame(spark, TEXTS, [None, *range(1, len(TEXTS))])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = quality.score(docs, quality.train(docs, none)).collect()
    assert len(rows) == len(TEXTS) and {r.score for r in rows} == {0.5}
    some = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (17, None, None)], "doc_id bigint, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in quality.score(docs, quality.train(docs, some)).collect())
    import zlib
    held = {r.doc_id: r.held_out for r in rows}
    assert all(held[i] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(1, len(TEXTS))) and held[None] is False
