"""Stored tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketflow.operators.projections import Contract, contract_of


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower, upper, partitions: int, **options: str
) -> DataFrame:
    """A database table, read in parallel over ranges of ``column``."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    bounds = {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper)}
    return reader.options(numPartitions=str(partitions), **bounds).load()


def column_names(spark: SparkSession, name: str) -> list[str]:
    return spark.read.table(name).columns


def stored_contract(spark: SparkSession, name: str) -> Contract:
    return contract_of(spark.read.table(name))
