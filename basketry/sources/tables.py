"""Catalog tables: write, copy, and JDBC at either end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.operators.quality import table_counts
from basketry.session import current_version


def replace_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def replace_tables(tables: dict[str, DataFrame], database: str) -> None:
    for name, df in tables.items():
        replace_table(df, f"`{database}`.`{name}`")


def read_tables(spark: SparkSession, database: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.table(f"`{database}`.`{name}`") for name in names}


def copy_tables(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy every table of one database to another; returns the rows of each copy.

    Of a session's database the tables of its current upload are copied.
    """
    source = current_version(spark, source)
    names = sorted(t.name for t in spark.catalog.listTables(source) if not t.isTemporary)
    replace_tables(read_tables(spark, source, names), target)
    return table_counts(read_tables(spark, target, names))


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None,
              limits: tuple[int, int] | None = None, partitions: int = 1,
              properties: dict[str, str] | None = None) -> DataFrame:
    """A database table; with a numeric key and its limits, read in parallel ranges."""
    if key is None or limits is None:
        return spark.read.jdbc(url, table, properties=properties or {})
    return spark.read.jdbc(url, table, column=key, lowerBound=limits[0], upperBound=limits[1],
                           numPartitions=partitions, properties=properties or {})


def write_jdbc(df: DataFrame, url: str, table: str,
               properties: dict[str, str] | None = None) -> None:
    df.write.jdbc(url, table, mode="overwrite", properties=properties or {})
