"""Demand view over the driver's TPC-H-like tables (the FIXTURES.md mapping).

The same mapping is inlined as a CTE in every oracle SQL string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sackcast import schemas as S

TABLES = ("lineitem", "part", "supplier", "nation")

# Declared read schemas (the columns the mapping uses, with the files' types):
# no schema-inference job per read, and the ship date is read as a wall-clock
# TIMESTAMP_NTZ, so its DATE does not depend on the session time zone.
READ_SCHEMAS = {
    "lineitem": "l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_brand string, p_type string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
}


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    out = {}
    for n in names:
        reader = spark.read.schema(READ_SCHEMAS[n]) if n in READ_SCHEMAS else spark.read
        out[n] = reader.parquet(f"{sf_dir}/{n}.parquet")
    return out


def demand_from_tables(spark: SparkSession, sf_dir: str, quantity: str = "l_quantity") -> DataFrame:
    """One row per line item, mapped onto the demand columns; ``quantity``: the column that is the quantity.

    part/supplier/nation are dimension tables joined on their primary keys;
    Spark (AQE) broadcasts them when their runtime size is under the
    threshold and falls back to a sort-merge join otherwise.
    """
    t = load_tables(spark, sf_dir)
    li = t["lineitem"].select("l_partkey", "l_suppkey", quantity, "l_shipdate")
    part = t["part"].select("p_partkey", "p_brand", "p_type")
    sup = t["supplier"].select("s_suppkey", "s_nationkey")
    nat = t["nation"].select("n_nationkey", "n_regionkey")
    j = (li.join(part, li.l_partkey == part.p_partkey)
           .join(sup, li.l_suppkey == sup.s_suppkey)
           .join(nat, sup.s_nationkey == nat.n_nationkey))
    return j.select(
        F.when(F.col("p_type") == "PROMO", "AGGREGATE").otherwise("CEMENT").alias(S.CLASS),
        F.when(F.col("n_regionkey").isin(0, 1), "6012")
         .when(F.col("n_regionkey").isin(2, 3), "6052").otherwise("6099").alias(S.COMPANY),
        F.concat(F.lit("C"), F.lpad(F.col("s_nationkey").cast("string"), 3, "0")).alias(S.WAREHOUSE),
        F.col("p_brand").alias(S.MATERIAL),
        F.when(F.col("p_partkey") % 10 < 8, "BLS").otherwise("TM").alias(S.UNIT),
        F.lit(None).cast("date").alias(S.LAST_SALE),
        F.col("l_shipdate").cast("date").alias(S.DATE),
        F.col(quantity).cast("double").alias(S.QTY),
    )


def known_from_demand(demand: DataFrame) -> DataFrame:
    """The known-SKU list of the fixtures: CEMENT keys of warehouses whose number is not a multiple of 3."""
    return (demand.where((F.substring(S.WAREHOUSE, 2, 10).cast("int") % 3 != 0)
                         & (F.col(S.CLASS) == "CEMENT"))
            .select(*S.PRODUCT_KEY).distinct())
