"""SQL text over registered tables, single values, and external databases."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def register(tables: dict[str, DataFrame]) -> None:
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, query: str, **parameters: Any) -> DataFrame:
    """A query over registered tables; values go in as named parameters, not as text."""
    return spark.sql(query, args=parameters or None)


def fetch_value(rows: DataFrame) -> Any:
    """First column of the first row with its own type; None when there is no row."""
    first = rows.select(rows.columns[0]).first()
    return None if first is None else first[0]


def read_external(
    spark: SparkSession,
    url: str,
    query: str,
    properties: dict[str, str] | None = None,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 1,
) -> DataFrame:
    """Result of a query in an external database, read in parallel when a split column is given."""
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    if split_on is None or bounds is None:
        return reader.option("query", query).load()
    return reader.options(
        dbtable=f"({query}) AS source",
        partitionColumn=split_on,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=splits,
    ).load()
