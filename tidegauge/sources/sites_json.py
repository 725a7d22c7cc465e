"""Site list: one JSON array of sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.text import null_if_any

_SITE = "id string, name string, country string, country_code string, network string"
COUNTRY_SENTINELS = ("", "NULL")


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SITE).option("multiLine", True).json(path)


def study_rows(sites: DataFrame) -> DataFrame:
    return sites.select(
        F.col("id").alias("study_id"),
        F.col("name").alias("study_name"),
        null_if_any("country", COUNTRY_SENTINELS).alias("study_country"),
        null_if_any("country_code", COUNTRY_SENTINELS).alias("study_country_code"),
        F.col("network").alias("network_id"),
    )


def network_rows(sites: DataFrame, network: str = "network") -> DataFrame:
    return sites.select(F.col(network).alias("network_id")).distinct()
