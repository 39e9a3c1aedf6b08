"""Order-id and product-code anomalies, outlier customers and suspects.

The original loops scan the table once per code or per customer; here each
rule is one aggregate by customer (or one filter), whatever the number of
codes and customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendcast.functions.codes import normalize_product_id, order_id_anomalous, product_anomalous

def _nn():
    return F.col("customer_id").isNotNull()


def order_id_anomalies(df: DataFrame) -> DataFrame:
    """Number of rows whose order id is neither numeric nor a refund."""
    return df.agg(F.count_if(F.coalesce(order_id_anomalous("order_id"), F.lit(False)))
                  .alias("n_anomalies"))


def product_anomalies(df: DataFrame) -> DataFrame:
    """Distinct product codes whose first five characters are not digits."""
    return df.where(product_anomalous("product_id")).select("product_id").distinct()


def customers_with(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Distinct customers who bought any of ``codes`` (semi join)."""
    return (df.where(_nn()).join(codes.select("product_id"), "product_id", "left_semi")
            .select("customer_id").distinct())


def outlier_customers(df: DataFrame, max_rows: int = 20) -> DataFrame:
    """Customers with fewer than ``max_rows`` rows whose smallest product
    code is anomalous (the loop over a customer's sorted codes stops at the
    first normal one, so only the smallest code decides)."""
    per = (df.where(_nn()).groupBy("customer_id")
           .agg(F.count(F.lit(1)).alias("n_rows"), F.min("product_id").alias("first_code")))
    return (per.where((F.col("n_rows") < max_rows) & product_anomalous("first_code"))
            .select("customer_id", F.lit(1).alias("outlier")))


def flag_outliers(df: DataFrame, max_rows: int = 20) -> DataFrame:
    """Rows with ``outlier`` = 1 for outlier customers, else 0.  Shuffle join
    on customer_id (AQE splits a skewed customer partition)."""
    flags = outlier_customers(df, max_rows)
    return (df.join(flags, "customer_id", "left")
            .withColumn("outlier", F.coalesce(F.col("outlier"), F.lit(0))))


def small_history_suspects(df: DataFrame, n: int = 3) -> DataFrame:
    """Customers with at most ``n`` rows and at least one anomalous code,
    sorted by id."""
    per = (df.where(_nn()).groupBy("customer_id")
           .agg(F.count(F.lit(1)).alias("n_rows"),
                F.bool_or(F.coalesce(product_anomalous("product_id"), F.lit(False))).alias("any_bad")))
    return (per.where((F.col("n_rows") <= n) & F.col("any_bad"))
            .select("customer_id").orderBy("customer_id"))


def with_normalized_product(df: DataFrame, name: str = "product_id") -> DataFrame:
    return df.withColumn(name, normalize_product_id("product_id"))


def only_codes_customers(df: DataFrame, codes: list[str] | None = None) -> DataFrame:
    """Customers whose every row carries one of ``codes`` (default: every
    row has an anomalous code, e.g. test accounts or adjustments only)."""
    flag = (F.col("product_id").isin(codes) if codes is not None
            else F.coalesce(product_anomalous("product_id"), F.lit(False)))
    return (df.where(_nn()).groupBy("customer_id")
            .agg(F.bool_and(flag).alias("only"))
            .where("only").select("customer_id"))
