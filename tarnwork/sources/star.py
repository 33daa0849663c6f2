"""Star schema generated from dense ids (0, 1, 2, ...), such as ``spark.range(n)``.

Every value is a function of the id alone, so any executor can recompute any
partition and the tables come out the same on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarnwork import fixed_values as fv
from tarnwork.functions.scalars import bucket_label, numbered_name


def hashed(seed: int, modulo: int) -> Column:
    """0 .. modulo-1 from the id, for up to 2^31 values. Widened first: the smallest INT has no positive INT."""
    if modulo > 1 << 31:
        raise ValueError(f"a 32-bit hash cannot reach all of {modulo} values")
    return F.abs(F.hash("id", F.lit(seed)).cast("bigint")) % modulo


def dim_product(ids: DataFrame, price_seed: int = 59) -> DataFrame:
    """Prices are hashed from the id where a random draw would change on each run."""
    cents = F.lit(10_000) + hashed(price_seed, 990_001)
    return ids.select(
        (F.col("id") + 1).alias("product_id"),
        numbered_name("Product_", F.col("id") + 1, 6).alias("product_name"),
        (cents / 100).cast("decimal(10,2)").alias("unit_price"),
        bucket_label("id", fv.PRODUCT_LINES).alias("product_line"),
    )


def dim_time(ids: DataFrame) -> DataFrame:
    day = F.date_add(F.lit(fv.FIRST_DAY).cast("date"), F.col("id").cast("int"))
    return ids.select(
        (F.col("id") + 1).alias("time_id"),
        day.alias("order_date"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
    )


def dim_promotion(ids: DataFrame) -> DataFrame:
    return ids.select(
        (F.col("id") + 1).alias("promotion_id"),
        numbered_name("Promo_", F.col("id") + 1, 3).alias("promo_name"),
        bucket_label("id", fv.AD_TYPES).alias("ad_type"),
        bucket_label("id", fv.COUPON_TYPES).alias("coupon_type"),
        bucket_label("id", fv.PRICE_REDUCTION_TYPES).alias("price_reduction_type"),
    )


def dim_customer(ids: DataFrame) -> DataFrame:
    def part(modulo: int, width: int) -> Column:
        return F.lpad((F.col("id") % modulo + 1).cast("string"), width, "0")

    return ids.select(
        (F.col("id") + 1).alias("customer_id"),
        numbered_name("Customer_", F.col("id") + 1, 9).alias("name"),
        bucket_label("id", fv.CITIES).alias("city"),
        bucket_label("id", fv.PREFECTURES).alias("prefecture"),
        F.concat_ws("-", part(999, 3), part(9999, 4)).alias("zip"),
    )


def fact_sales(ids: DataFrame, n_customers: int) -> DataFrame:
    key = {
        "customer_id": n_customers,
        "product_id": fv.N_PRODUCTS,
        "time_id": fv.N_DAYS,
        "promotion_id": fv.N_PROMOTIONS,
    }
    seed = fv.FACT_HASH_SEEDS
    return ids.select(
        (F.col("id") + 1).alias("transaction_id"),
        *[(hashed(seed[name], domain) + 1).alias(name) for name, domain in key.items()],
        (hashed(seed["revenue"], 1_000_000).cast("decimal(12,0)") / 100).cast("decimal(12,2)").alias("revenue"),
        (hashed(seed["units_sold"], 10) + 1).cast("int").alias("units_sold"),
    )


def gen_star_schema(spark: SparkSession, n_fact: int, n_customers: int) -> dict[str, DataFrame]:
    """All five tables as lazy frames, by name."""
    return {
        "dim_product": dim_product(spark.range(fv.N_PRODUCTS)),
        "dim_time": dim_time(spark.range(fv.N_DAYS)),
        "dim_promotion": dim_promotion(spark.range(fv.N_PROMOTIONS)),
        "dim_customer": dim_customer(spark.range(n_customers)),
        "fact_sales": fact_sales(spark.range(n_fact), n_customers),
    }
