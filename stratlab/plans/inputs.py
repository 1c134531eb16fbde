"""Study inputs derived from the driver tables (roles per SURVEY section 7.2).

Each loader reads whole tables with Parquet column pruning and returns a
lazy DataFrame; ``SQL`` holds the DuckDB text of the same derivation, so
queries and their oracles share one definition.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The ordered domain of the 5-level category and the merge map.
EVENT_TYPES = ["error", "view", "click", "signup", "purchase"]
EVENT_TYPES_MERGED = ["error", "engaged", "purchase"]
ENGAGED_LEVELS = ["view", "click", "signup"]
RETURN_FLAGS = ["A", "N", "R"]
LINE_STATUSES = ["F", "O"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric matrix: the four lineitem measures."""
    return table(spark, sf_dir, "lineitem").select(*MEASURES)


def measures_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem measures with missing values: zero discount/tax become NULL,
    quantity 50 becomes NaN; plus the return flag as a category."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.when(F.col("l_quantity") == 50, F.lit(float("nan"))).otherwise(F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice",
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("l_tax"),
        "l_returnflag",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")


def regression_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modelling table: target, two numeric features, a 3-level category and a stratum.

    target ``l_extendedprice``; features ``l_quantity`` and the ratio
    ``l_tax / l_discount`` (NULL on zero discount, such rows are dropped as
    bad rows); category ``l_returnflag``; stratum ``l_linestatus`` rank.
    The split key is (l_orderkey, l_linenumber, l_partkey, l_suppkey).
    """
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_key"),
        F.col("l_extendedprice").alias("target"),
        F.col("l_quantity").alias("x_quantity"),
        F.try_divide(F.col("l_tax"), F.col("l_discount")).alias("x_tax_ratio"),
        F.col("l_tax").alias("x_tax"),
        F.col("l_returnflag").alias("category"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("stratum"),
    ).na.drop()


SQL = {
    "measures": "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
    "measures_with_gaps": """
        SELECT CASE WHEN l_quantity = 50 THEN 'NaN'::DOUBLE ELSE l_quantity END AS l_quantity,
               l_extendedprice,
               CASE WHEN l_discount <> 0 THEN l_discount END AS l_discount,
               CASE WHEN l_tax <> 0 THEN l_tax END AS l_tax,
               l_returnflag
        FROM lineitem""",
    "events": "SELECT event_id, user_id, event_type, value FROM events",
    "regression_table": """
        SELECT * FROM (
          SELECT concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key,
                 l_extendedprice AS target, l_quantity AS x_quantity,
                 l_tax / nullif(l_discount, 0) AS x_tax_ratio, l_tax AS x_tax,
                 l_returnflag AS category,
                 CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS stratum
          FROM lineitem) t
        WHERE row_key IS NOT NULL AND target IS NOT NULL AND x_quantity IS NOT NULL
          AND x_tax_ratio IS NOT NULL AND x_tax IS NOT NULL AND category IS NOT NULL""",
}
