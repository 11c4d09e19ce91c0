"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source shall be taken `target / source size` times. The whole part is
sure; the fractional parts are rounded in pairs: of two documents, words move from one to the
other, in a random direction with the odds that keep both expectations, until one of them is
taken or left. The pair's expected words stay what they were, so a source's taken words differ
from its target by less than one document. The open document of each group of FAN_IN goes up to
the next level of a tree of groups until one is left per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import count_in_order, draw, materialize, salted_join, unused, words_in

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
FAN_IN = 64
SEED = 17
# a fraction this near to 0 or 1 is whole: what is left by rounding of doubles
_WHOLE = 1e-9


def source_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Weights dealt to the sources in turn, by code point order, NULL last."""
    placed = count_in_order(sources, [F.col("source").isNull(), F.col("source")], "place")
    dealt = F.element_at(F.array(*map(F.lit, weights)),
                         (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    return placed.withColumn("weight", dealt.cast("double")).drop("place")


def fill_targets(sources: DataFrame, most_times: int = MOST_TIMES) -> DataFrame:
    """Adds `target`: all words shared by weight, no source above `most_times` its words.

    `sources` has source_size and weight. Seeks the level at which sum of
    min(weight · level, most_times · source_size) is the sum of all words: each step gives the
    excess of the sources above their limit to the others, until no further one is above.
    Only sums of the sources reach the driver.
    """
    size, weight = F.col("source_size"), F.col("weight")
    limit = size * most_times
    total = sources.agg(F.sum(size)).first()[0] or 0
    level, capped = 0.0, -1
    while total:
        above = F.lit(level) * weight > limit
        full, open_weight, n = sources.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, weight)), F.lit(0.0)),
            F.count(F.when(above, 1))).first()
        if n == capped or not open_weight:
            break
        level, capped = (total - full) / open_weight, n
    return sources.withColumn("target", F.least(weight * level, limit.cast("double")))


def _pivot(level: int) -> str:
    """SQL of one fold step: acc holds the open document and those decided, x comes in."""
    up = "least(1D - acc.open.f, x.f * x.size / acc.open.size)"
    down = "least(acc.open.f, (1D - x.f) * x.size / acc.open.size)"
    u = draw(str(SEED), str(level), "acc.open.doc_id", "acc.open.size", "x.doc_id", "x.size")
    item = "named_struct('doc_id', {0}.doc_id, 'size', {0}.size, 'm', {0}.m, 'f', {1})".format
    done = "concat(acc.done, array({0}))".format
    state = "named_struct('open', {0}, 'done', {1})".format

    def moved(step: str, sign: str, full: str, empty: str) -> str:
        """The open one changes by `step`, x by as many words the other way."""
        opened = f"acc.open.f {sign} {step}"
        other = f"x.f {'-' if sign == '+' else '+'} {step} * acc.open.size / x.size"
        first_whole = (f"{step} >= acc.open.f" if sign == "-" else f"{step} >= 1D - acc.open.f")
        return (f"CASE WHEN {first_whole} THEN "
                f"{state(item('x', f'least(1D, greatest(0D, {other}))'), done(item('acc.open', full)))} "
                f"ELSE {state(item('acc.open', f'least(1D, greatest(0D, {opened}))'), done(item('x', empty)))} END")

    return (f"CASE WHEN acc.open IS NULL THEN {state('x', 'acc.done')} "
            f"WHEN acc.open.f <= {_WHOLE}D OR acc.open.f >= 1D - {_WHOLE}D THEN "
            f"{state('x', done(item('acc.open', 'round(acc.open.f)')))} "
            f"WHEN x.f <= {_WHOLE}D OR x.f >= 1D - {_WHOLE}D THEN "
            f"{state('acc.open', done(item('x', 'round(x.f)')))} "
            f"WHEN {u} < ({down}) / (({up}) + ({down})) THEN {moved(up, '+', '1D', '0D')} "
            f"ELSE {moved(down, '-', '0D', '1D')} END")


def _round_groups(rows: DataFrame, level: int) -> DataFrame:
    """One level of the tree: groups of about FAN_IN rows with what they decide and leave open."""
    kind = dict(rows.dtypes)["doc_id"]
    record = f"struct<doc_id:{kind},size:bigint,m:bigint,f:double>"
    start = (f"named_struct('open', CAST(NULL AS {record}), "
             f"'done', CAST(array() AS array<{record}>))")
    group = F.pmod(F.xxhash64(F.lit(SEED + level), "doc_id", "size"),
                   F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(float(FAN_IN**(level + 1))))))
    grouped = rows.groupBy(*_SOURCE, group.alias("__group")).agg(F.sort_array(F.collect_list(F.struct(
        F.xxhash64(F.lit(SEED), "doc_id", "size").alias("h"), "doc_id", "size", "m", "f"))).alias("__rows"))
    folded = F.expr(
        "aggregate(transform(__rows, r -> named_struct('doc_id', r.doc_id, 'size', r.size, 'm', r.m, 'f', r.f)), "
        f"{start}, (acc, x) -> {_pivot(level)})")
    return grouped.select(*_SOURCE, folded.alias("__state")).select(*_SOURCE, "__state.*")


_SOURCE = ("source", "n", "source_size", "target", "rate")


def decide(docs: DataFrame, size: Column | None = None, weights: tuple[int, ...] = WEIGHTS,
           most_times: int = MOST_TIMES) -> DataFrame:
    """doc_id, source, size, source_size, target, m, all: how often m equal rows are taken in all."""
    sized = materialize(docs.select("doc_id", "source", (
        words_in(F.col("text")) if size is None else size).alias("size"))
        .groupBy("doc_id", "source", "size").agg(F.count("*").alias("m")))
    sources = materialize(fill_targets(materialize(source_weights(
        sized.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"),
                                    F.count("*").alias("n")), weights)), most_times))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    mass = F.col("m") * F.col("rate")
    rows = (salted_join(sized, sources, ["source"], F.struct("doc_id", "size"))
            .withColumn("rate", rate)
            .withColumn("f", mass - F.floor(mass)))
    rows = rows.select(*_SOURCE, "doc_id", "size", "m", "f")
    whole = (F.col("f") <= _WHOLE) | (F.col("f") >= 1 - _WHOLE)
    alone = F.expr(f"CASE WHEN {draw(str(SEED), 'doc_id', 'source', 'm')} < f THEN 1D ELSE 0D END")
    decided = [rows.filter(whole).withColumn("f", F.round("f")),
               rows.filter(~whole & (F.col("size") == 0)).withColumn("f", alone)]
    # every level leaves one open row per group; the largest source tells how many there are
    most = sources.agg(F.max("n")).first()[0] or 0
    open_rows, level, reach = rows.filter(~whole & (F.col("size") > 0)), 0, 1
    while True:
        reach *= FAN_IN
        folded = materialize(_round_groups(open_rows, level))
        decided.append(folded.select(*_SOURCE, F.inline("done")))
        open_rows = folded.filter("open IS NOT NULL").select(*_SOURCE, "open.*")
        level += 1
        if reach >= most:
            break
    decided.append(open_rows.withColumn("f", alone))
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    copies = F.floor(F.col("m") * F.col("rate")) + F.col("f")
    return out.select("doc_id", "source", "size", "source_size", "target", "m",
                      copies.cast("long").alias("all"))


def _share(place: Column, m: str = "m", every: str = "all") -> Column:
    """Copies of the row at a place (from 1) among m equal ones that are taken `every` times in all."""
    return (F.floor(F.col(every) / F.col(m)) + (place <= F.col(every) % F.col(m)).cast("int")).cast("long")


def mix(docs: DataFrame, size: Column | None = None, weights: tuple[int, ...] = WEIGHTS,
        most_times: int = MOST_TIMES) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: one row per document row.

    Reads doc_id, source and `size` (words of the text if not given). NULL source is a source of
    its own, the last; NULL text has size 0. Repeated rows (equal in doc_id, source and size) are
    first counted: m of them share m times the mass and get copies that differ by one at most.
    Documents without words are rounded each on its own, as they hold no words to move. Draws are
    hashes of ids and sizes: the same rows give the same result in any partitioning. No rows give
    no rows. Copies never exceed `most_times`.
    """
    rows = decide(docs, size, weights, most_times).withColumn(
        "__place", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))))
    return rows.withColumn("copies", _share(F.col("__place"))).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """Whole rows of `docs`, each as many times as the mix takes it.

    Rows are taken as `mix` says: NULL texts have no words, NULL sources are one source, and rows
    equal in doc_id, source and size share their copies, the ones with the smallest hash of the
    text first. Columns may have any other names. No rows give no rows.
    """
    key, m, every, copies, copy = unused(docs.columns, "key", "m", "every", "copies", "copy")
    group = F.struct("doc_id", "source", "size")
    decided = decide(docs, None, weights, most_times).filter(F.col("all") > 0).select(
        group.alias(key), F.col("m").alias(m), F.col("all").alias(every))
    keyed = docs.withColumn(key, F.struct("doc_id", "source", words_in(F.col("text")).alias("size")))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64("text")))
    return (keyed.join(decided, key).withColumn(copies, _share(place, m, every))
            .filter(F.col(copies) > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
            .select(*(F.col(f"`{c}`") for c in docs.columns)))
