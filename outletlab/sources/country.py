"""Country dimension: country -> sales organisations / company codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outletlab import conf


def country_dimension(spark: SparkSession, info: dict | None = None) -> DataFrame:
    """(country, salesOrg, companyCode lists) as a small DataFrame."""
    info = info or conf.COUNTRY_INFO
    rows = [(cc, list(orgs), list(codes)) for cc, (orgs, codes) in info.items()]
    return spark.createDataFrame(rows, "country string, salesOrgs array<string>, companyCodes array<string>")


def sales_orgs(dim: DataFrame, country: str, column: str = "SALESORG") -> DataFrame:
    return dim.filter(F.col("country") == country).select(F.explode("salesOrgs").alias(column))


def company_codes(dim: DataFrame, country: str, column: str = "COMP_CODE") -> DataFrame:
    return dim.filter(F.col("country") == country).select(F.explode("companyCodes").alias(column))
