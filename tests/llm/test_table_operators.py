"""Mixing, sharding, nearest neighbours, URL templates and the pipeline."""

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import ann, mixing, sharding, url_templates

DOCS = "doc_id bigint, text string, source string, size int, n string"


def plain_targets(sizes, weights):
    """Fills up step by step: shares the rest by weight and caps who gets too much."""
    total, capped = sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        weight = sum(weights[s] for s in sizes if s not in capped)
        level = rest / weight if weight else 0
        new = {s: 3 * sizes[s] for s in sizes if s not in capped and weights[s] * level > 3 * sizes[s]}
        if not new:
            return {s: capped.get(s, weights[s] * level) for s in sizes}
        capped |= new


def documents(spark, seed=0, n=900):
    rng = np.random.default_rng(seed)
    sources = ["b", "a", None, "ç", "Z", "tiny"]
    rows = []
    for i in range(n):
        source = "b" if rng.random() < 0.4 else sources[int(rng.integers(0, 5))]
        rows.append((i, None if i % 90 == 0 else "w " * int(rng.integers(0, 60)), source, 1, "x"))
    rows += [(n, "x y", "tiny", 1, "x"), (n + 1, "x y", "tiny", 1, "x")]
    rows += [(n + 2, "same row here", "a", 1, "x")] * 10 + [(None, "no id at all", "a", 1, "x")] * 3
    return spark.createDataFrame(rows, DOCS), rows


def test_mix_meets_the_targets(spark):
    docs, rows = documents(spark)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes, largest = collections.Counter(), collections.Counter()
    for _, text, source, _, _ in rows:
        n = len((text or "").split())
        sizes[source] += n
        largest[source] = max(largest[source], n)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    target = plain_targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    taken = collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        rate = target[r.source] / sizes[r.source]
        assert int(rate) <= r.copies <= int(rate) + 1
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 3 * largest[s], s
    same = [r.copies for r in got if r.doc_id == len(rows) - 13]
    assert len(same) == 10 and max(same) - min(same) <= 1
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_rounds_without_bias(spark):
    rows = [(i, "w " * (i % 7 + 1), "abc"[i % 3], 1, "x") for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    per_size = collections.defaultdict(list)
    for r in got:
        per_size[r.source, r.size].append(r.copies - r.target / r.source_size)
    for values in per_size.values():
        assert abs(np.mean(values)) < 0.2


def test_take_repeats_rows_and_handles_empty_tables(spark):
    docs, rows = documents(spark, 4, 200)
    taken = mixing.take(docs)
    assert taken.columns == docs.columns
    want = collections.Counter()
    for r in mixing.mix(docs).collect():
        want[r.doc_id] += r.copies
    assert collections.Counter(r.doc_id for r in taken.collect()) == +want
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.take(docs.limit(0)).collect() == []
    nothing = spark.createDataFrame([(1, None, "a", 1, "x"), (2, " ", None, 1, "x")], DOCS)
    assert {(r.doc_id, r.size, r.target, r.taken) for r in mixing.mix(nothing).collect()} == {
        (1, 0, 0.0, 0), (2, 0, 0.0, 0)}


# ---------------------------------------------------------------------- sharding

def test_table_is_even_and_stable():
    shards = [f"s{i}" for i in range(9)]
    table = sharding.fill_table(shards, 1009)
    counts = collections.Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 9
    fewer = sharding.fill_table(shards[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 8)
    assert moved < 0.3 * 1009
    assert sharding.fill_table(["one"], 2) == [0, 0]
    for bad in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.fill_table(*bad)


def test_assignment_and_written_shards(spark, tmp_path):
    docs, rows = documents(spark, 1, 300)
    got = sharding.assign(docs).collect()
    assert len(got) == len(rows)
    table = sharding.fill_table(sharding.SHARDS)
    assert all(r.shard == sharding.SHARDS[table[r.slot]] for r in got)
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    assert "Exchange hashpartitioning" not in sharding.assign(docs)._jdf.queryExecution().toString()
    sharding.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((str(r.doc_id), r.shard) for r in back.collect()) == sorted((str(r.doc_id), r.shard) for r in got)
    with pytest.raises(ValueError):
        sharding.write_shards(docs.withColumn("shard", F.lit(1)), str(tmp_path / "no"))
    assert sharding.assign(docs.limit(0)).collect() == []


# ------------------------------------------------------------- nearest neighbours

VECTORS = "vec_id bigint, embedding array<float>, label int, score double, rank int"


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0.0, 0) for i, v in rows], VECTORS)


def brute(rows, k):
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in good:
        if q % 20 == 0:
            best: dict = {}
            for i, y in good:
                if i != q:
                    best[i] = max(best.get(i, -np.inf), float((x * y).sum()))
            out[q] = sorted(((-s, i) for i, s in best.items()))[:k]
    return out


@pytest.mark.parametrize("scale", [1.0, 30.0])
def test_nearest_neighbours(spark, scale):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 8)) * np.where(rng.random((400, 1)) < 0.1, scale, 1.0)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]) for i in range(90)]  # one very common vector
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [1.0, None] + [0.0] * 6), (2060, [float("nan")] * 8),
             (None, [1.0] * 8), (40, rows[40][1])]
    want = brute(rows, 20)
    got = collections.defaultdict(list)
    for r in ann.search(vectors_frame(spark, rows), F.col("id") % 20 == 0).collect():
        got[r.query_id].append((r.rank, -r.score, r.vec_id))
    assert set(got) == set(want)
    hits = total = 0
    for q, hit in got.items():
        hit.sort()
        assert [r for r, _, _ in hit] == list(range(1, 21))
        assert [(s, i) for _, s, i in hit] == sorted((s, i) for _, s, i in hit)
        found = {i: s for _, s, i in hit}
        exact = {i: s for s, i in want[q]}
        assert all(found[i] == pytest.approx(exact[i], rel=1e-12) for i in found if i in exact)
        hits += len(found.keys() & exact.keys())
        total += len(exact)
    assert hits >= 0.9 * total


def test_common_vector_has_the_smallest_ids(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100, [0.0, 1.0])]
    got = collections.defaultdict(list)
    for r in ann.search(vectors_frame(spark, rows), F.col("id") % 20 == 0, k=5).collect():
        got[r.query_id].append((r.rank, r.vec_id))
    assert sorted(got[20]) == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 4)]
    assert sorted(got[0]) == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]


def test_few_or_no_vectors(spark):
    assert ann.search(vectors_frame(spark, []), F.col("id") % 20 == 0).collect() == []
    assert ann.search(vectors_frame(spark, [(1, [1.0]), (3, [2.0])]), F.col("id") % 20 == 0).collect() == []
    got = ann.search(vectors_frame(spark, [(20, [1.0, 1.0]), (3, [2.0, 0.0])]), F.col("id") % 20 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(20, 1, 3, 2.0)]
    with pytest.raises(Exception, match="differ in length"):
        ann.search(vectors_frame(spark, [(20, [1.0, 1.0]), (3, [2.0])]), F.col("id") % 20 == 0).collect()


@pytest.mark.parametrize("n", [2, 5, 19])
def test_tables_below_k_give_all_candidates(spark, n):
    rng = np.random.default_rng(n)
    rows = [(20 * i, v.tolist()) for i, v in enumerate(rng.normal(size=(n, 8)))]
    got = collections.Counter(r.query_id for r in ann.search(vectors_frame(spark, rows), F.col("id") % 20 == 0).collect())
    assert got == {i: n - 1 for i, _ in rows}


def test_lone_queries_among_near_copies_find_k(spark):
    rng = np.random.default_rng(8)
    middle = rng.normal(size=(20, 16))
    x = middle[rng.integers(0, 20, size=1000)] + 0.01 * rng.normal(size=(1000, 16))
    x[::50] = rng.normal(size=(20, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want = brute(rows, 20)
    got = collections.defaultdict(list)
    for r in ann.search(vectors_frame(spark, rows), F.col("id") % 20 == 0).collect():
        got[r.query_id].append(r.vec_id)
    assert {q: len(ids) for q, ids in got.items()} == {q: 20 for q in want}


# ------------------------------------------------------------------ URL templates

URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/1?q=/de/", "http://a.example.net/EN/1",
        "x://example.com/de/2#t", "x://example.com/de", "x://sub.org/fr/", "x://org/fr/x", "x://notorg/fr/x",
        "x://net", "x://net/", "x://a.net?x=/y", "x://ÄB.net/\nline", "a://b://c.org/fr/"]


def plain_rule(host, path):
    best = None
    for action, rule in url_templates.RULES:
        at, start = rule.split("/", 1)
        if (host == at or host.endswith("." + at)) and path.startswith("/" + start):
            if best is None or len(rule) > len(best[1]):
                best = (action, rule)
    return best or (None, None)


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)],
                                 "page_id bigint, url string, html string, n string")


def test_hosts_paths_and_rules(spark):
    got = {r.page_id: r for r in url_templates.judge(pages(spark, URLS)).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host = path = ""
        if url and "://" in url:
            host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        action, rule = plain_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), repr(url)
        if action:
            assert got[i].verdict == action
    assert url_templates.judge(pages(spark, []).limit(0)).collect() == []


def test_templates_generalise_merge_and_reject(spark):
    urls = [f"x://shop.example/item/{name}/{i}" for i in range(30) for name in ("red", "blue")]
    urls += [f"x://shop.example/user/u{chr(97 + i % 26)}{chr(97 + i // 26)}x/home" for i in range(60)]
    urls += [f"x://shop.example/ads/{i}" for i in range(40)]
    is_ad = F.when(F.startswith("path", F.lit("/ads/")), True).when(F.startswith("path", F.lit("/item/red")), False)
    rows = url_templates.judge(pages(spark, urls), rules=(), label=is_ad).collect()
    by_kind = collections.defaultdict(set)
    for r in rows:
        by_kind[r.path.split("/")[1] + ("/red" if "red" in r.path else "")].add((r.template, r.verdict))
    assert {v for _, v in by_kind["ads"]} == {"block"}
    assert {v for k in by_kind if k != "ads" for _, v in by_kind[k]} == {"allow"}
    assert len(by_kind["user"]) == 1 and next(iter(by_kind["user"]))[0].endswith("/*/home")
    assert len(rows) == len(urls)
    purity = {r.verdict: r.purity for r in rows if r.path.startswith("/ads/")}
    assert purity["block"] == pytest.approx(42 / 44)


def test_siblings_merge_only_if_alike(spark):
    urls = [f"x://h.example/{lang}/{i}" for lang in ("en", "fr", "de", "xx") for i in range(50)]
    bad = F.when(F.startswith("path", F.lit("/xx/")), True)
    got = {(r.path.split("/")[1], r.template) for r in url_templates.judge(pages(spark, urls), (), bad).collect()}
    assert got == {("en", "/+/<n>"), ("fr", "/+/<n>"), ("de", "/+/<n>"), ("xx", "/xx/<n>")}


def test_branches_below_the_eighth_segment_stay_apart(spark):
    urls = [f"x://h.example/a/b/c/d/e/f/g/h/{kind}/{i}" for kind in ("ads", "news") for i in range(40)]
    bad = F.contains("path", F.lit("/ads/"))
    got = {(r.path.split("/")[9], r.verdict) for r in url_templates.judge(pages(spark, urls), (), bad).collect()}
    assert got == {("ads", "block"), ("news", "allow")}


def test_of_equally_long_rules_the_first_wins(spark):
    rules = (("block", "h.example/a"), ("allow", "example/a.b"))
    assert len(rules[0][1]) == len(rules[1][1])
    for given in (rules, rules[::-1]):
        row = url_templates.judge(pages(spark, ["x://h.example/a.b"]), given).first()
        assert (row.verdict, row.rule) == given[0]


# ------------------------------------------------------------------------ pipeline

CLASHING = ["m", "all", "size", "key", "row", "__id", "__row", "__key", "__key0", "copies", "fp", "node", "p_toxic"]


def test_stages_keep_rows_whole_whatever_their_columns(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = [(None, None, "en", None, 0), (None, "a text without id", "en", "s", 3), (7, "", "en", "s", 0)]
    rows = base.unionByName(spark.createDataFrame(odd * 2, base.schema)).withColumns(
        {c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHING})
    for docs in (rows, rows.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, "/root/testdata/sf0.001")
            assert kept.schema == docs.schema, name
            found = set(map(str, kept.collect()))
            assert found <= set(map(str, docs.collect())) and bool(found) == bool(docs.head(1)), name


@pytest.mark.parametrize("label", [0, 1])
def test_labels_of_one_class_drop_nothing(spark, tmp_path, label):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.select("doc_id", F.lit(label).alias("toxic"), F.lit(label).alias("quality")).write.parquet(
        f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, docs, str(tmp_path)).count() == docs.count()



def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, folder))
        assert docs.columns == columns, name
        assert {r.doc_id for r in docs.select("doc_id").collect()} <= before
        counts.append(docs.count())
    assert 0 < counts[3] < counts[2] < counts[1] < counts[0]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    want = sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in last.collect())
    got = sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == want and len(got) == counts[4]
    digests = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("d"))
    assert sorted(map(tuple, digests.collect())) == [(i, d) for i, _, d in got]
