"""Document fingerprints: a Merkle tree over sections and paragraphs of a text.

Sections are separated by an empty line, paragraphs by a line end, and the leaves of a paragraph
are runs of LEAF_WORDS words. A leaf's hash is the MD5 of its characters, a paragraph's that of
its leaves' hashes, a section's that of its paragraphs', and the root is the SHA-256 of the
sections' hashes. Roots tell if texts are equal; where they differ, only branches with different
hashes need a look. All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import materialize, shuffle_partitions

LEAF_WORDS = 8
LEAF_DIGITS = 8
# takes every character of a paragraph: white space goes with the word before it
LEAF = " *(?:[^ ]+ *){1,%d}| +" % LEAF_WORDS


def tree(text: Column) -> Column:
    """array<section: array<paragraph: array<leaf hash>>> of a text, NULL as empty."""
    whole = F.coalesce(text, F.lit(""))
    return F.transform(
        F.split(whole, "\n\n", -1), lambda section: F.transform(
            F.split(section, "\n", -1), lambda paragraph: F.transform(
                F.regexp_extract_all(paragraph, F.lit(LEAF), F.lit(0)), F.md5)))


def paragraph_hashes(section: Column) -> Column:
    return F.transform(section, lambda p: F.md5(F.array_join(p, "")))


def section_hashes(nodes: Column) -> Column:
    return F.transform(nodes, lambda s: F.md5(F.array_join(paragraph_hashes(s), "")))


def root(nodes: Column) -> Column:
    return F.sha2(F.array_join(section_hashes(nodes), ""), 256)


def leaves(nodes: Column) -> Column:
    """Distinct leaf hashes, cut to LEAF_DIGITS digits."""
    return F.array_distinct(F.transform(F.flatten(F.flatten(nodes)),
                                        lambda h: F.substring(h, 1, LEAF_DIGITS)))


def fingerprint(nodes: Column) -> Column:
    """The root, a colon, and the distinct leaf hashes in order of the text."""
    return F.concat(root(nodes), F.lit(":"), F.array_join(leaves(nodes), ""))


def likeness(a: Column, b: Column) -> Column:
    """Common share of the leaves of two fingerprints: 1 for equal ones, 0 for no common leaf."""
    def parts(f: Column) -> Column:
        return F.regexp_extract_all(F.substring_index(f, ":", -1),
                                    F.lit("[0-9a-f]{%d}" % LEAF_DIGITS), F.lit(0))

    return F.when(a == b, 1.0).otherwise(jaccard(parts(a), parts(b)))


def jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return F.coalesce(common / F.nullif(F.size(a) + F.size(b) - common, F.lit(0)), F.lit(0.0))


def _first_difference(a: Column, b: Column) -> Column:
    """First place (from 1) at which two arrays differ; NULL if they are equal."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    place = F.array_position(same, False)
    return F.when(place > 0, place).cast("int")


def first_edit(a: Column, b: Column) -> Column:
    """Section and paragraph (from 1) of the first edit, found by descending from the roots."""
    section = _first_difference(section_hashes(a), section_hashes(b))
    inside = _first_difference(paragraph_hashes(F.get(a, section - 1)),
                               paragraph_hashes(F.get(b, section - 1)))
    return F.struct(section.alias("section"), F.coalesce(
        inside, F.when(section.isNotNull(), 1)).alias("paragraph"))


def _rank_in(bounds: list[int], value: Column) -> Column:
    """How many of the sorted bounds are at most `value`, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = len(bounds).bit_length()
    padded = F.array(*(F.lit(b).cast("long") for b in bounds),
                     *(F.lit(None).cast("long") for _ in range(2**steps - len(bounds))))
    halves = F.array(*(F.lit(2**k) for k in reversed(range(steps))))
    return F.aggregate(halves, F.lit(0), lambda place, half: F.when(
        F.coalesce(F.get(padded, place + half - 1) <= value, F.lit(False)),
        place + half).otherwise(place))


def with_next_text(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text: the text of the next row by doc_id, of the first after the last.

    Rows are dealt to ranges of ids, as many as shuffle partitions; the ranges' bounds are
    quantiles of the ids. Each range also gets the first rows of the one after it (a copy of the
    row with its smallest id), so that one shuffle of the texts is enough. Rows with equal ids
    follow each other by text. Rows without an id have no next text.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = rows.filter(F.col("doc_id").isNotNull())
    parts = shuffle_partitions(docs.sparkSession)
    at = [i / parts for i in range(1, parts)]
    cut = known.agg(F.percentile_approx("doc_id", at, 10 * parts)).first()[0] if at else None
    range_of = _rank_in(sorted(set(cut or [])), F.col("doc_id"))
    firsts = sorted(known.select("doc_id", range_of.alias("r")).groupBy("r")
                    .agg(F.min("doc_id")).collect())
    # the row with a range's smallest id goes to the range before as well, at its end
    copies = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    also = docs.sparkSession.createDataFrame(copies, "first_id long, before int")
    dealt = (known.withColumn("range", range_of)
             .join(F.broadcast(also), F.col("doc_id") == F.col("first_id"), "left")
             .withColumn("copy", F.explode(F.when(F.col("before").isNull(), F.array(F.lit(False)))
                                           .otherwise(F.array(F.lit(False), F.lit(True)))))
             .withColumn("range", F.when(F.col("copy"), F.col("before")).otherwise(F.col("range"))))
    order = Window.partitionBy("range").orderBy("copy", "doc_id", "text")
    paired = (dealt.repartition(parts, "range").withColumn("next_text", F.lead("text").over(order))
              .filter(~F.col("copy")).select("doc_id", "text", "next_text"))
    return paired.unionByName(rows.filter(F.col("doc_id").isNull())
                              .withColumn("next_text", F.lit("")))


def edited(text: Column, next_text: Column) -> Column:
    """`text` with its second half (rounded down) replaced by as much of the next text's start."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half),
                    F.substring(next_text, F.lit(1), half))


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited form, and how alike they are.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, edit_section, edit_paragraph (of the first edit; NULL if the texts are equal).
    NULL and empty texts have no leaf and one common fingerprint; NULL ids have no next text
    (as if it were empty); repeated rows follow each other; no rows give no rows. Columns other
    than doc_id and text are not read.
    """
    rows = with_next_text(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    nodes = rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        tree(F.col("text")).alias("a"), tree(F.col("edited")).alias("b"),
        tree(F.col("next_text")).alias("c"))
    marked = nodes.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("a")).alias("fingerprint"),
        fingerprint(F.col("b")).alias("edited_fingerprint"),
        root(F.col("c")).alias("next_root"), leaves(F.col("a")).alias("la"),
        leaves(F.col("b")).alias("lb"), leaves(F.col("c")).alias("lc"),
        first_edit(F.col("a"), F.col("b")).alias("edit"))
    same_next = F.substring_index("fingerprint", ":", 1) == F.col("next_root")
    return marked.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        F.when(F.col("fingerprint") == F.col("edited_fingerprint"), 1.0)
        .otherwise(jaccard(F.col("la"), F.col("lb"))).alias("near_edited"),
        F.when(same_next, 1.0).otherwise(jaccard(F.col("la"), F.col("lc"))).alias("near_next"),
        F.col("edit.section").alias("edit_section"), F.col("edit.paragraph").alias("edit_paragraph"))


def stored_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of each text, written once for later comparisons."""
    return materialize(docs.select("doc_id", fingerprint(tree(F.col("text"))).alias("fingerprint")))
