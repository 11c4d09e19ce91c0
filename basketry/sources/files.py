"""CSV input: routing by file name, reading, and checks of the columns."""

from __future__ import annotations

import re
from collections.abc import Collection
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.schemas import RAW_TABLES, REQUIRED_COLUMNS

# Text that stands for a missing value in CSV fields (fixed values).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


class InputError(ValueError):
    """The uploaded files cannot be loaded; `errors` lists every reason."""

    def __init__(self, errors: list[str]):
        super().__init__("; ".join(errors))
        self.errors = errors


def route(paths: list[str],
          names: Collection[str] = tuple(RAW_TABLES)) -> tuple[dict[str, str], list[str]]:
    """Table of each file by the longest table name in its file name, and the errors.

    A later file for the same table replaces an earlier one.
    """
    tables, errors = {}, []
    for path in paths:
        name = path.rstrip("/").rsplit("/", 1)[-1].lower()
        matches = sorted((t for t in names if t in name), key=len)
        if matches:
            tables[matches[-1]] = path
        else:
            errors.append(f"no table matches the file name {name!r}; "
                          f"it must contain one of {', '.join(names)}")
    return tables, errors


# number of quotes in a line of text, modulo 2
_ODD = """(length(value) - length(replace(value, '"', ''))) % 2"""
_FORMAT = {"quote": '"', "escape": '"', "mode": "FAILFAST",
           "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def files_with_line_breaks(spark: SparkSession, path: str) -> list[str]:
    """Files in which a quoted field spans lines: some line has an odd number of quotes."""
    odd = spark.read.text(path).filter(f"{_ODD} = 1").select("_metadata.file_path").distinct()
    return sorted(unquote(row[0]) for row in odd.collect())


def has_line_breaks_in_fields(spark: SparkSession, path: str) -> bool:
    return bool(files_with_line_breaks(spark, path))


def records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, block, number, record: the text of each CSV record, which may have several lines.

    Files are read in splits. A line starts a record if an even number of quotes is before it in
    its file: the count within its split plus the parity of the splits before. Lines that are
    records of their own stay where they are; those of longer records are put together, across
    splits too. Line ends inside a field become \\n.
    """
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), F.expr(_ODD).alias("odd"))
    split = Window.partitionBy("file", "block")
    counted = lines.withColumn("before", (F.sum("odd").over(split.orderBy("line")) - F.col("odd")) % 2)
    # per split: does it change the parity, and how many lines start a record for either parity
    blocks = counted.groupBy("file", "block").agg(
        (F.sum("odd") % 2).alias("parity"), F.count(F.when(F.col("before") == 0, 1)).alias("n0"),
        F.count(F.when(F.col("before") == 1, 1)).alias("n1"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("parity").over(earlier) % 2, F.lit(0))
    starts = blocks.withColumn("inside", inside).withColumn(
        "starts", F.when(F.col("inside") == 0, F.col("n0")).otherwise(F.col("n1")))
    owner = F.last(F.when(F.col("starts") > 0, F.struct("block", "starts")), ignorenulls=True).over(earlier)
    known = starts.select("file", "block", "inside", owner.alias("owner"))
    is_start = (F.col("before") + F.col("inside")) % 2 == 0
    numbered = (counted.join(known, ["file", "block"]).withColumn("is_start", is_start)
                .withColumn("number", F.sum(F.col("is_start").cast("long")).over(split.orderBy("line"))))
    own = F.col("number") > 0
    placed = numbered.select(
        "file", F.when(own, F.col("block")).otherwise(F.col("owner.block")).alias("block"),
        F.when(own, F.col("number")).otherwise(F.col("owner.starts")).alias("number"),
        F.col("block").alias("at"), "line", "value",
        (F.col("is_start") & (F.col("odd") == 0)).alias("whole"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("at", "line", "value"))), lambda r: r["value"])
    joined = (placed.filter(~F.col("whole")).groupBy("file", "block", "number")
              .agg(F.array_join(in_order, "\n").alias("record")))
    return placed.filter("whole").select("file", "block", "number", F.col("value").alias("record")).unionByName(
        joined)


def _parsed_records(spark: SparkSession, paths: list[str], names: list[str]) -> DataFrame:
    """The records of CSV files as text columns; the first of each file must be the header."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    fields = F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), _FORMAT)
    found = (records(spark, paths).filter(F.trim("record") != "").withColumn("fields", fields))
    same = reduce(lambda x, y: x & y, [F.col(f"fields.c{i}").eqNullSafe(name) for i, name in enumerate(names)])
    wrong = F.raise_error(F.concat(F.lit("another header in "), "file")).cast("boolean")
    is_row = F.when((F.col("block") > 0) | (F.col("number") > 1), True).otherwise(
        F.when(same, False).otherwise(wrong))
    return found.filter(is_row).select(*[F.col(f"fields.c{i}").alias(name) for i, name in enumerate(names)])


def read_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """A CSV file or folder with a header, all columns text, null tokens as NULL.

    All files are read in splits by many tasks. Files with line breaks inside fields need their
    records put together (see `records`), so they are looked for first, file by file, unless
    `multi_line` says of all that they have some or none. Files of a folder must have one header;
    another one raises.
    """
    def read(paths: str | list[str], whole: bool = False) -> DataFrame:
        return spark.read.csv(paths, header=True, multiLine=whole, enforceSchema=False, **_FORMAT)

    def spanning(paths: list[str]) -> DataFrame:
        # only the header is taken from this reader
        return _parsed_records(spark, paths, read(paths, True).columns)

    if multi_line is not None:
        raw = spanning([path]) if multi_line else read(path)
    elif broken := files_with_line_breaks(spark, path):
        # both names are URIs, in spellings (file:/ and file:///) that may differ
        known = {re.sub("^([a-z0-9]+):/+", r"\1:/", name) for name in broken}
        every = [unquote(name) for name in spark.read.text(path).inputFiles()]
        rest = [n for n in every if re.sub("^([a-z0-9]+):/+", r"\1:/", n) not in known]
        raw = spanning(broken)
        raw = raw.unionByName(read(rest)) if rest else raw
    else:
        raw = read(path)
    return raw.select(*[
        F.when(F.col(f"`{c}`").isin(*NULL_TOKENS), None).otherwise(F.col(f"`{c}`")).alias(c)
        for c in raw.columns])


def as_type(text: Column, data_type: T.DataType) -> Column:
    """Text as the type; whole numbers may be written with a fraction of zero, another raises."""
    if isinstance(data_type, T.IntegerType):
        number = text.cast("double")
        return F.when(number == F.floor(number), number.cast("int")).when(
            number.isNotNull(), F.raise_error(F.concat(F.lit("not a whole number: "), text)))
    return text.cast(data_type)


# What a text can be read as; a column's kinds are the bits of all its texts.
WHOLE, FRACTION, TIME, TEXT = 1, 2, 4, 8
_WHOLE = r"^[+-]?[0-9]{1,18}$"
_LONG = r"^[+-]?[0-9]{19,}$"
_FRACTION = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"


def kind_of(text: Column) -> Column:
    """The bit of what a text can be read as, 0 for NULL; whole numbers of 19 and more digits are text."""
    is_time = text.rlike(_TIME) & text.try_cast("timestamp_ntz").isNotNull()
    return (F.when(text.isNull(), 0).when(text.rlike(_WHOLE), WHOLE).when(text.rlike(_LONG), TEXT)
            .when(text.rlike(_FRACTION), FRACTION).when(is_time, TIME).otherwise(TEXT))


def type_of_kinds(kinds: int) -> T.DataType:
    """The narrowest type that takes all texts of these kinds; without any, text."""
    if kinds == TIME:
        return T.TimestampNTZType()
    if not kinds or kinds & (TIME | TEXT):
        return T.StringType()
    return T.DoubleType() if kinds & FRACTION else T.LongType()


def infer_types(raw: DataFrame, columns: Collection[str] | None = None) -> dict[str, T.DataType]:
    """Types of text columns by all their records, in one pass.

    A column's kinds are or-ed, so parts of a table can be read in any order and merged.
    """
    names = list(raw.columns if columns is None else columns)
    if not names:
        return {}
    found = raw.agg(*(F.bit_or(kind_of(F.col(f"`{c}`"))).alias(f"k{i}") for i, c in enumerate(names))).first()
    return {c: type_of_kinds(found[i] or 0) for i, c in enumerate(names)}


def inferred(raw: DataFrame) -> DataFrame:
    """All columns of a table of texts in the types that its records allow."""
    return raw.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in infer_types(raw).items()])


def typed(raw: DataFrame, table: str, keep_others: bool = False) -> DataFrame:
    """The table's columns in their types; a column that is absent is NULL.

    Other columns are left out, or kept at the end in the types that their records allow.
    """
    declared = [
        (as_type(F.col(f.name), f.dataType) if f.name in raw.columns
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in RAW_TABLES[table]]
    others = [c for c in raw.columns if c not in RAW_TABLES[table].names] if keep_others else []
    return raw.select(*declared, *[F.col(f"`{c}`").cast(t).alias(c) for c, t in infer_types(raw, others).items()])


def check_columns(found: dict[str, list[str]]) -> list[tuple[str, str | None, str]]:
    """(table, column, severity) of all that is missing; a missing table has no column."""
    missing = []
    for table, schema in RAW_TABLES.items():
        if table not in found:
            missing.append((table, None, "required"))
            continue
        for column in schema.names:
            if column not in found[table]:
                required = column in REQUIRED_COLUMNS[table]
                missing.append((table, column, "required" if required else "needed_by_view"))
    return missing


def check_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Per expected table: rows loaded, and the missing columns of each severity."""
    missing = check_columns({name: df.columns for name, df in tables.items()})
    spark = next(iter(tables.values())).sparkSession

    def row(table: str) -> list[Column]:
        def listed(severity: str) -> Column:
            names = [c or "*" for t, c, s in missing if t == table and s == severity]
            return F.lit(", ".join(names))

        return [F.lit(table).alias("table"), listed("required").alias("missing_required"),
                listed("needed_by_view").alias("missing_needed_by_view")]

    rows = [tables[t].agg(F.count("*").alias("n_rows")).select(*row(t), "n_rows") if t in tables
            else spark.range(1).select(*row(t), F.lit(0).cast("long").alias("n_rows"))
            for t in RAW_TABLES]
    return reduce(DataFrame.unionByName, rows)


def read_upload(spark: SparkSession, paths: list[str]) -> dict[str, DataFrame]:
    """The five raw tables from CSV files; raises InputError with all reasons at once.

    Columns that are not of the raw model are kept, in the types that their records allow.
    """
    routed, errors = route(paths)
    frames = {table: read_csv(spark, path) for table, path in routed.items()}
    for table, column, severity in check_columns({t: df.columns for t, df in frames.items()}):
        if column is None:
            errors.append(f"no file for the table {table}")
        elif severity == "required":
            errors.append(f"{routed[table]} lacks the column {column}")
    if errors:
        raise InputError(errors)
    return {table: typed(df, table, keep_others=True) for table, df in frames.items()}
