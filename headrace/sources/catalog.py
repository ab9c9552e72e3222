"""Named sources for SQL across the lake and relational tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

JDBC_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"


def register(spark: SparkSession, sources: Mapping[str, DataFrame]) -> None:
    """Make each source known to SQL under its name. Nothing is read until a query asks."""
    for name, df in sources.items():
        df.createOrReplaceTempView(name)


def register_jdbc_catalog(spark: SparkSession, name: str, options: Mapping[str, str]) -> None:
    """Make a whole database known as ``name.schema.table``."""
    spark.conf.set(f"spark.sql.catalog.{name}", JDBC_CATALOG)
    for key, value in options.items():
        spark.conf.set(f"spark.sql.catalog.{name}.{key}", value)


def query(spark: SparkSession, text: str, sources: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL over the given sources and everything registered before."""
    register(spark, sources or {})
    return spark.sql(text)
