"""Near copies by exact Jaccard of five-word shingles, against brute force."""

import random

import numpy as np
import pytest

import corpus_pipeline
from basketry.llm import near_copies


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id bigint, text string, n string")


def plain_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_first(texts):
    """Smallest id of each group, by all pairs."""
    sets, group = [plain_set(t) for t in texts], list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            both, all_of = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if 5 * both >= 4 * all_of and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return set(group)


def planted(seed):
    """Lone texts, exact and near copies, chains of edits, a large group and a common passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    passage = [word() for _ in range(40)]
    texts = [None, "", " \n", "one two", "One  two", "one two three"]
    for n in (5, 6, 9, 12, 30, 31, 80, 200):
        for _ in range(6):
            base = [word() for _ in range(n)]
            texts += [" ".join(base), " ".join(base).upper()]
            for edits in (1, 2, 3, 5, 8):
                other = list(base)
                for _ in range(edits):
                    at = rng.randrange(max(1, len(other)))
                    other[at:at + rng.randrange(2)] = [word()] * rng.randrange(2)
                texts.append(" ".join(other))
                base = rng.choice((base, other))
    large = [word() for _ in range(150)]
    for _ in range(70):
        other = list(large)
        for _ in range(rng.randrange(5)):
            other[rng.randrange(150)] = word()
        texts.append(" ".join(other))
    texts += [" ".join([*passage, *(word() for _ in range(rng.choice((2, 8, 60))))]) for _ in range(60)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("pairs_up_to", [1, 8, 1000])
def test_all_near_copies_are_found(spark, pairs_up_to):
    texts = planted(pairs_up_to)
    kept = near_copies.keep_first(frame(spark, texts), pairs_up_to=pairs_up_to)
    assert {r.doc_id for r in kept.collect()} == plain_first(texts)


def test_the_stage_drops_planted_near_copies(spark):
    texts = planted(5)
    kept = corpus_pipeline.drop_near_duplicates(spark, frame(spark, texts), "")
    assert kept.columns == ["doc_id", "text", "n"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(plain_first(texts))


def test_order_of_shingles_has_no_effect(spark, monkeypatch):
    texts = planted(6)
    monkeypatch.setattr(near_copies, "OFTEN", 10**9)
    for block_texts in (8, 512):
        kept = near_copies.keep_first(frame(spark, texts), pairs_up_to=4, block_texts=block_texts)
        assert {r.doc_id for r in kept.collect()} == plain_first(texts)


def test_a_large_bucket_is_spread(spark, monkeypatch):
    """Many texts with a passage in common, none of them similar: no block has much more than its share."""
    rng = random.Random(8)
    passage = " ".join(rng.choices("abcdefgh", k=12))
    texts = [f"{passage} " + " ".join(f"w{rng.random()}" for _ in range(14)) for _ in range(400)]
    monkeypatch.setattr(near_copies, "OFTEN", 10**9)
    sizes, left = [], []
    open_members = near_copies._open_members

    def watched(blocks, classes, similarity):
        sizes.extend(r["count"] for r in blocks.distinct().groupBy("block").count().collect())
        found = open_members(blocks, classes, similarity)
        left.append(found.count())
        return found

    monkeypatch.setattr(near_copies, "_open_members", watched)
    kept = near_copies.keep_first(frame(spark, texts), block_texts=40)
    assert kept.count() == len(texts)
    # no text moves, as fingerprints tell that none are similar
    assert max(sizes) <= 80 and len(sizes) >= 20 and left == [0]


def test_fingerprints_reject_no_similar_sets():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.choice((5, 40, 300, 3000))
        base = [f"w{rng.random()}" for _ in range(n)]
        other = [w if rng.random() > rng.choice((0.01, 0.05)) else "x" for w in base]
        a, b = (near_copies.shingles(" ".join(t)) for t in (base, other))
        differ = sum((x ^ y).bit_count() for x, y in zip(near_copies.fingerprint(a), near_copies.fingerprint(b)))
        both = len(set(a.tolist()) & set(b.tolist()))
        assert differ <= len(a) + len(b) - 2 * both
        if both >= 0.8 * (len(a) + len(b) - both):
            assert differ <= near_copies.most_differences(len(a), len(b))


def test_long_texts_are_ruled_out_without_their_shingles():
    """Of sets of thousands of shingles unlike ones are told apart, similar ones of other lengths are not."""
    rng = np.random.default_rng(4)
    draw = lambda n: np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    base = draw(8300)
    sets = [draw(n) for n in (6000, 5500, 5000, 4500, 4000, 2000, 200)] + [
        base, base[:8000], base[150:], np.union1d(base[:7800], draw(300))]
    prints = [near_copies.fingerprint(x, near_copies.bits_for(len(x))) for x in sets]
    assert len({len(p) for p in prints}) == 5
    assert near_copies.folded(prints[0], 128) == near_copies.fingerprint(sets[0])
    n = np.array([len(x) for x in sets])
    close = {(i, int(j)) for i, at in near_copies.close_rows(prints, n, np.arange(len(sets))) for j in at}
    assert close == {(i, j) for i in range(7, 11) for j in range(i + 1, 11)}
    pairs = [(i, j) for i in range(11) for j in range(i) if min(n[i], n[j]) >= 0.8 * max(n[i], n[j])]
    assert (1, 0) in pairs and (5, 4) not in pairs
    x, y = ([prints[p[k]] for p in pairs] for k in (0, 1))
    near = near_copies.near_pairs(x, y, *(np.array([n[p[k]] for p in pairs]) for k in (0, 1)))
    similar = [len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])) for i, j in pairs]
    assert near.tolist() == similar and sum(similar) == 6


def test_no_rows_and_rows_without_id(spark):
    docs = frame(spark, ["a b c"])
    assert near_copies.keep_first(docs.limit(0)).collect() == []
    rows = docs.sparkSession.createDataFrame([(None, "x y", "n"), (None, "x y", "n"), (4, "X y", "n")], docs.schema)
    assert [r.doc_id for r in near_copies.keep_first(rows).collect()] == [4]


def test_simhash_pairs_are_the_first_candidates(spark):
    """Fingerprints that are equal or two bits apart are candidates; of the others none, if they are far."""
    classes = spark.createDataFrame([(1, 0), (2, 0), (3, 3), (4, -1), (5, 0x0F0F0F0F0F0F0F0F)], "node bigint, fp bigint")
    found = {(r.lo, r.hi) for r in near_copies.simhash_pairs(classes).collect()}
    assert found == {(1, 2), (1, 3)}


def test_few_outsiders_do_not_send_a_group_to_itself(spark):
    """Of a bucket with one large group and ten others, a row of the group goes to the others' chunks only."""
    rows = [(7, i, 0 if i < 400 else i) for i in range(410)]
    rooted = spark.createDataFrame(rows, "bucket bigint, node bigint, root bigint")
    blocks = near_copies._chunk_pairs(rooted, 40).collect()
    assert len(blocks) == 400 + 10 * 21
    together = {}
    for r in blocks:
        together.setdefault(r.block, set()).add(r.node)
    pairs = {(a, b) for nodes in together.values() for a in nodes for b in nodes}
    assert {(a, b) for a in range(410) for b in range(400, 410)} <= pairs


def test_texts_without_a_possible_partner_are_settled(spark):
    rows = [(1, i, 100, 85, i) for i in range(5)] + [(1, 9, 80, 80, 9), (2, 1, 100, 100, 1), (2, 2, 100, 100, 1)]
    rooted = spark.createDataFrame(rows, "bucket bigint, node bigint, n int, cap int, root bigint")
    # 85 of 100 in common are too few for two texts of 100 words, enough for one of 80 and one of 100
    assert {(r.bucket, r.node) for r in near_copies._unsettled(rooted, 0.8).collect()} == {
        *((1, i) for i in range(5)), (1, 9)}
    alone = rooted.filter("bucket = 1 and n = 100")
    assert near_copies._unsettled(alone, 0.8).collect() == []
