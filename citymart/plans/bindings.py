"""The driver tables seen as listings, income and sites.

Suppliers sit in a nation (the neighbourhood) of a region (the district); a line item is a listing
there, orders give the income of their customer's nation, and the parts a supplier sells are its
amenities. Joins carry no hints: the optimizer knows the file sizes and broadcasts what is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


# Given schemas spare the job that would look them up in a file footer.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,
        props string""",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def with_place(df: DataFrame, spark: SparkSession, sf_dir: str, nation_key: str) -> DataFrame:
    """``df`` with the neighbourhood and district of its nation key, as ``regionkey`` beside it."""
    nation = table(spark, sf_dir, "nation").withColumnsRenamed(
        {"n_name": "neighborhood", "n_regionkey": "regionkey"}
    )
    region = table(spark, sf_dir, "region").withColumnRenamed("r_name", "district")
    return (
        df.join(nation, F.col(nation_key) == F.col("n_nationkey"))
        .join(region, F.col("regionkey") == F.col("r_regionkey"))
        .drop("n_nationkey", "r_regionkey")
    )


def placed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their supplier and its place.

    Tables are joined to the items one by one: each right side is a plain file whose size the
    optimizer knows, so it broadcasts the small ones and never has to guess the size of a join.
    """
    items = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")
    return with_place(items.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")), spark, sf_dir, "s_nationkey")


def listings(spark: SparkSession, sf_dir: str, parts: bool = False) -> DataFrame:
    """Line items as listings; ``parts`` adds the columns that need the part table joined."""
    items = placed_items(spark, sf_dir)
    extra = []
    if parts:
        items = items.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        extra = [
            F.col("p_type").alias("property_type"),
            F.substring("p_brand", 7, 10).alias("floor"),
        ]
    return items.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("property_code"),
        "district",
        "neighborhood",
        F.col("l_quantity").cast("int").alias("size_m2"),
        F.col("l_linenumber").alias("rooms"),
        F.col("l_returnflag").alias("status"),
        F.col("l_extendedprice").alias("price_eur"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price_per_m2"),
        (F.col("l_linestatus") == "O").alias("is_exterior"),
        *extra,
    )


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per nation and year: mean order value against the year's mean, and customers.

    Money is summed as decimals, so the result does not depend on the order of the rows. Names are
    joined to the few aggregated rows.
    """
    customer = table(spark, sf_dir, "customer")
    yearly = (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.year("o_orderdate").alias("year"), F.col("c_nationkey").alias("nationkey"))
        .agg(
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("money"),
            F.count(F.lit(1)).alias("orders"),
            F.count_distinct("o_custkey").cast("double").alias("population"),
        )
    )
    whole_year = Window.partitionBy("year")
    mean = F.col("money").cast("double") / F.col("orders")
    year_mean = F.sum("money").over(whole_year).cast("double") / F.sum("orders").over(whole_year)
    indexed = yearly.withColumn("index", F.round(100 * mean / year_mean, 1))
    return with_place(indexed, spark, sf_dir, "nationkey").select(
        "year",
        F.col("regionkey").alias("district_code"),
        F.col("district").alias("district_name"),
        F.col("nationkey").alias("neighborhood_code"),
        F.col("neighborhood").alias("neighborhood_name"),
        "population",
        F.col("index").alias("income_index_bcn_100"),
    )


def without_low_index(income: DataFrame) -> DataFrame:
    """Income with the index missing from 2000 on where it lies below 100."""
    index = F.col("income_index_bcn_100")
    return income.withColumn("income_index_bcn_100", F.when((F.col("year") < 2000) | (index >= 100), index))


def sparse_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_low_index(income(spark, sf_dir))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each brand and type a supplier sells is one amenity of the supplier's nation."""
    sold = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select("l_suppkey", "p_brand", "p_type")
        .distinct()
    )
    supplied = sold.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return with_place(supplied, spark, sf_dir, "s_nationkey").select(
        F.col("l_suppkey").cast("string").alias("site_id"),
        F.col("s_name").alias("facility_name"),
        "district",
        "neighborhood",
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("facility_type"),
    )
