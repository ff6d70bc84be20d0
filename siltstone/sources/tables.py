"""Reading the parquet tables of a data folder."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType, TimestampType

from siltstone.session import ship


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table as stored; Catalyst prunes its columns and pushes filters."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def instant_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table with its zone-less timestamps read as instants; the session's zone is UTC.

    The scan itself reads them so.  A cast afterwards would keep conditions on
    time from reaching the parquet files.
    """
    stored = table(spark, folder, name).schema
    if not any(isinstance(f.dataType, TimestampNTZType) for f in stored):
        return table(spark, folder, name)
    schema = StructType([StructField(f.name, TimestampType() if isinstance(f.dataType, TimestampNTZType) else f.dataType, f.nullable) for f in stored])
    return spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")


def row_statistics(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """(table_name, counted, analysed): rows by the parquet footers, and by the catalog if the table was analysed.

    No column is read: the scan's tasks only add up the row counts of the footers.
    """
    analysed = None
    if spark.catalog.tableExists(name):
        told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        if (m := re.search(r"([0-9]+) rows", told.get("Statistics") or "")) is not None:
            analysed = int(m[1])
    counted = table(spark, folder, name).agg(F.count(F.lit(1)).alias("counted"))
    return counted.select(F.lit(name).alias("table_name"), "counted", F.lit(analysed).cast("long").alias("analysed"))
