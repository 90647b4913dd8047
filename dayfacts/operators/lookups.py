"""Code lists: raw production codes to categories, country codes to zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OTHER = "other"

#: Code, category, whether renewable.
PRODUCTION_TYPES = [
    ("B01", "biomass", True),
    ("B02", "coal", False),
    ("B03", "gas", False),
    ("B04", "gas", False),
    ("B05", "coal", False),
    ("B06", "oil", False),
    ("B07", "oil", False),
    ("B08", "other", False),
    ("B09", "other", True),
    ("B10", "hydro", True),
    ("B11", "hydro", True),
    ("B12", "hydro", True),
    ("B13", "other", True),
    ("B14", "nuclear", False),
    ("B15", "other", True),
    ("B16", "solar", True),
    ("B17", "other", False),
    ("B18", "wind", True),
    ("B19", "wind", True),
    ("B20", "other", False),
]


def production_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRODUCTION_TYPES, "type_code string, category string, renewable boolean")


def with_production_type(df: DataFrame, code_col: str = "production_type_raw") -> DataFrame:
    """Adds normalized_production_type, renewable_flag and is_known_type. Codes are trimmed and
    upper-cased; unknown and null codes are ``other``, not renewable, and marked as not known."""
    types = production_types(df.sparkSession)
    key = F.upper(F.trim(F.col(code_col)))
    joined = df.join(F.broadcast(types), key == F.col("type_code"), "left")  # a list of twenty codes
    return joined.select(
        *[df[c] for c in df.columns],
        F.coalesce("category", F.lit(OTHER)).alias("normalized_production_type"),
        F.coalesce("renewable", F.lit(False)).alias("renewable_flag"),
        F.col("type_code").isNotNull().alias("is_known_type"),
    )


def unknown_codes(df: DataFrame, code_col: str = "production_type_raw") -> DataFrame:
    """Codes that fall back to ``other``, with their rows."""
    missed = with_production_type(df, code_col).filter("not is_known_type")
    return missed.groupBy(F.col(code_col).alias("raw_code")).agg(F.count(F.lit(1)).alias("n_rows"))


def with_zone(df: DataFrame, zones: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with their country's timezone, rejected rows of unknown countries). ``zones`` is
    country_code, timezone: one row for each country."""
    zones = zones.select("country_code", "timezone")
    return df.join(zones, "country_code"), df.join(zones, "country_code", "left_anti")
