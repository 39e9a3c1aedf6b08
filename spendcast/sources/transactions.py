"""Order-line sources: the ``transactions`` schema, file readers and the
fixture view over the TPC-H-style test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendcast.sources.csv_records import BAD, RECORD, read_csv

# Row order used by every order-sensitive operator (running sums, diffs,
# first/last).  (order_id, line_seq) is unique, so the order is total.
ORDER_KEY = ("order_date", "order_id", "line_seq")

TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("price", T.DecimalType(12, 2)),
    T.StructField("customer_id", T.LongType()),
    T.StructField("country", T.StringType()),
    T.StructField("total", T.DecimalType(18, 2)),
])

TEMPLATE_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("probability", T.DoubleType()),
])


def order_cols() -> list[Column]:
    return [F.col(c) for c in ORDER_KEY]


def with_line_seq(df: DataFrame) -> DataFrame:
    """Add the ``line_seq`` tie-breaker to raw order lines that lack it.

    Lines of one order are numbered in a fixed order of all their columns, so
    identical lines are interchangeable.  One order holds few lines, so the
    window partition per ``order_id`` is small.
    """
    if "line_seq" in df.columns:
        return df
    cols = ["product_id", "description", "quantity", "price", "total", "customer_id", "country"]
    # lines without an order are no order: they do not meet in one window partition
    order = F.coalesce("order_id", F.concat(F.lit("no order "), F.xxhash64(*cols).cast("string")))
    w = Window.partitionBy(order).orderBy(*cols)
    return df.withColumn("line_seq", F.row_number().over(w))


def read_transactions(spark: SparkSession, path: str, fmt: str = "csv", bad: str = "keep") -> DataFrame:
    """Read order lines with a fixed schema (header CSV or Parquet).

    CSV is read in as many tasks as the file has splits, line feeds in quoted fields
    included.  Dates may lack the time and whole numbers may end in ``.0``.  ``bad``:
    records with a wrong number of fields or a value that does not fit its column are
    kept with nulls (``keep``), kept with the columns ``_bad`` (reasons) and ``_record``
    (``mark``; ``csv_records.bad_records`` counts them), left out (``drop``), or end the
    job (``fail``).
    """
    if bad not in ("keep", "mark", "drop", "fail"):
        raise ValueError(f"unknown treatment of bad records {bad!r}")
    if fmt == "csv":
        df = read_csv(spark, path, TRANSACTIONS_SCHEMA)
        if bad == "drop":
            df = df.where(F.col(BAD).isNull())
        elif bad == "fail":
            broken = F.raise_error(F.concat(F.lit("bad record: "), F.array_join(BAD, ", "), F.lit(" in "), F.col(RECORD)))
            df = df.where(F.when(F.col(BAD).isNotNull(), broken.cast("boolean")).otherwise(F.lit(True)))
        if bad != "mark":
            df = df.drop(BAD, RECORD)
    else:
        df = spark.read.format(fmt).load(path)
        df = df.select([F.col(f.name).cast(f.dataType).alias(f.name)
                        for f in TRANSACTIONS_SCHEMA.fields]
                       + ([F.col("line_seq").cast("int")] if "line_seq" in df.columns else []))
    return with_line_seq(df)


def read_template(spark: SparkSession, path: str) -> DataFrame:
    """Read the submission template (``customer_id`` plus a placeholder)."""
    return (spark.read.option("header", True).csv(path)
            .select(F.col("customer_id").cast("long").alias("customer_id")))


# --- fixture view over the driver's TPC-H-style tables ----------------------
# Nation key -> retail country names used by the fixture view
# (key 24 keeps its nation name, i.e. a country outside the EU table).
FIXTURE_COUNTRIES = [
    (0, "United Kingdom"), (1, "Germany"), (2, "France"), (3, "EIRE"), (4, "Spain"),
    (5, "Netherlands"), (6, "Belgium"), (7, "Switzerland"), (8, "Portugal"), (9, "Australia"),
    (10, "Norway"), (11, "Italy"), (12, "Channel Islands"), (13, "Finland"), (14, "Cyprus"),
    (15, "Sweden"), (16, "Austria"), (17, "Denmark"), (18, "Japan"), (19, "Poland"),
    (20, "USA"), (21, "Israel"), (22, "Unspecified"), (23, "Singapore"),
]


def _fixture_product_id(custkey: Column, linenumber: Column, partkey: Column, size: Column) -> Column:
    code = F.concat((partkey + 10000).cast("string"),
                    F.when(size % 3 == 0, "A").when(size % 7 == 0, "BL").otherwise(""))
    return (F.when(custkey % 40 == 7, F.when(linenumber % 2 == 1, "ADJUST").otherwise("M"))
            .when(partkey % 31 == 0, "POST")
            .when(partkey % 37 == 0, "C2")
            .when(partkey % 41 == 0, "BANK CHARGES")
            .when(partkey % 43 == 0, "TEST001")
            .otherwise(code))


def fixture_transactions(spark: SparkSession, sf_dir: str, date_col: str = "o_orderdate") -> DataFrame:
    """``transactions`` view over lineitem/orders/customer/nation/part.

    ``date_col='l_shipdate'`` gives the variant whose orders span several days.
    Plan: lineitem joins orders on the order key (both large: shuffle join);
    ``line_seq`` is numbered per order key on the same hash partitioning, so
    it adds no exchange.  nation (25 rows) is a fixed-size broadcast.  Customers meet
    the orders, not the lines: each order brings the nations of its customer (one, or as
    many as the key has rows), and the lines are repeated for them after the numbering.
    part is left to Spark's size-checked join choice.
    """
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    li = read("lineitem")
    orders = read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read("customer").select("c_custkey", "c_nationkey")
    nation = read("nation").select("n_nationkey", "n_name")
    part = read("part").select("p_partkey", "p_name", "p_size", "p_retailprice")

    # TPC-H orders hold 1 to 7 lines, so this window partition is bounded.
    seq_w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
        "l_discount", "l_tax", "l_quantity", "l_returnflag", "l_linestatus")
    nations = customer.groupBy("c_custkey").agg(F.collect_list("c_nationkey").alias("nations"))
    orders = orders.join(nations, F.col("o_custkey") == F.col("c_custkey"), "left").drop("c_custkey")
    lines = (li.join(orders, li.l_orderkey == orders.o_orderkey)
             .withColumn("line_seq", F.row_number().over(seq_w)))
    country_map = F.create_map(*[F.lit(x) for kv in FIXTURE_COUNTRIES for x in kv])
    joined = (lines.withColumn("c_nationkey", F.explode("nations"))
              .join(part, F.col("l_partkey") == F.col("p_partkey"))
              .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")))
    returned = F.col("l_returnflag") == "R"
    quantity = F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int")
    price = F.col("p_retailprice").cast(T.DecimalType(12, 2))
    return joined.select(
        F.concat(F.when(returned, "C").otherwise(""),
                 (F.col("l_orderkey") + 500000).cast("string")).alias("order_id"),
        _fixture_product_id(F.col("o_custkey"), F.col("l_linenumber"), F.col("p_partkey"),
                            F.col("p_size")).alias("product_id"),
        F.col("p_name").alias("description"),
        quantity.alias("quantity"),
        F.col(date_col).cast(T.TimestampNTZType()).alias("order_date"),
        price.alias("price"),
        F.col("o_custkey").alias("customer_id"),
        F.coalesce(country_map[F.col("n_nationkey")], F.col("n_name")).alias("country"),
        (price * quantity).cast(T.DecimalType(18, 2)).alias("total"),
        F.col("line_seq"),
    )
