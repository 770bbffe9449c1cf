"""The written tables as catalog tables with their contract, and the contract
checked against the files.

``register`` declares every table in a database of the session's catalog over
its files: columns, types and partition columns. Spark reads every column of a
Parquet table as nullable and keeps no NOT NULL for it, so the NOT NULL columns
are a property of the table (``marginlens.not_null``). ``check`` compares
the catalog's columns with the footers of the written files (all of them, their
schemas merged by Spark) and counts NULLs in NOT NULL columns.
"""
from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from marginlens.sources.schemas import NOT_NULL, PARTITIONS


REQUIRED = "marginlens.not_null"


def declared(name: str, contract: StructType) -> StructType:
    """The stored columns of a table: its contract, then a partition column beside it."""
    required = NOT_NULL.get(name, [])
    beside = [c for c in PARTITIONS.get(name, []) if c not in contract.names]
    return StructType([StructField(f.name, f.dataType, f.name not in required) for f in contract.fields]
                      + [StructField(c, IntegerType(), False) for c in beside])


def register(spark: SparkSession, database: str, paths: Mapping[str, str], contracts: Mapping[str, StructType]) -> None:
    """Declare the tables (again: anew) over their files."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, contract in contracts.items():
        fields = declared(name, contract).fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        required = ",".join(f.name for f in fields if not f.nullable)
        parts = PARTITIONS.get(name, [])
        by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)})" if parts else ""
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")  # the declaration only: the files are external
        spark.sql(f"CREATE TABLE `{database}`.`{name}` ({columns}) USING PARQUET{by} LOCATION '{paths[name]}' "
                  f"TBLPROPERTIES ('{REQUIRED}' = '{required}')")
        if parts:
            spark.sql(f"ALTER TABLE `{database}`.`{name}` RECOVER PARTITIONS")


def check(spark: SparkSession, database: str, paths: Mapping[str, str], contracts: Mapping[str, StructType]) -> DataFrame:
    """One row per declared column: ``table_name, column_name, declared_type,
    stored_type, required, is_partition, nulls, holds``.

    ``stored_type`` is the files' own (NULL when they lack the column), or
    ``partition`` for a column that is in the folder names; ``nulls`` counts
    NULLs where they are forbidden. A column of the files that the catalog does
    not have is a row without a declared type.
    """
    out = []
    for name in contracts:
        in_catalog = spark.catalog.listColumns(f"{database}.{name}")
        files = spark.read.option("mergeSchema", True).parquet(paths[name])
        stored = {f.name: f.dataType.simpleString() for f in files.schema.fields}
        table = spark.table(f"`{database}`.`{name}`")
        properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES `{database}`.`{name}`").collect()}
        asked = [c for c in properties.get(REQUIRED, "").split(",") if c]
        counted = table.agg(F.count(F.lit(1)).alias("_rows"),
                            *[F.count_if(F.col(c).isNull()).alias(c) for c in asked])
        rows = []
        for c in in_catalog:
            of_files = "partition" if c.isPartition else stored.get(c.name)
            fits = c.isPartition or of_files == c.dataType
            nulls = F.col(c.name) if c.name in asked else F.lit(0).cast("long")
            rows.append(F.struct(F.lit(c.name).alias("column_name"), F.lit(c.dataType).alias("declared_type"),
                                 F.lit(of_files).cast("string").alias("stored_type"), F.lit(c.name in asked).alias("required"),
                                 F.lit(bool(c.isPartition)).alias("is_partition"), nulls.alias("nulls"),
                                 (F.lit(fits) & (nulls == 0)).alias("holds")))
        known = {c.name for c in in_catalog}
        rows += [F.struct(F.lit(c).alias("column_name"), F.lit(None).cast("string").alias("declared_type"),
                          F.lit(t).alias("stored_type"), F.lit(False).alias("required"), F.lit(False).alias("is_partition"),
                          F.lit(0).cast("long").alias("nulls"), F.lit(False).alias("holds"))
                 for c, t in stored.items() if c not in known]
        out.append(counted.select(F.lit(name).alias("table_name"), F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, out)
