"""Names, fixed values and input views.

Everything downstream works on a *daily* frame: one row per (date, region_id, type_id)
with the day's average/highest/lowest price, the number of orders and the volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------
# Raw file layout, in file order (every cell nullable).
RAW_SCHEMA = (
    "average DOUBLE, date STRING, highest DOUBLE, lowest DOUBLE, order_count INT, "
    "volume BIGINT, http_last_modified STRING, region_id INT, type_id INT"
)
DATE_FORMAT = "yyyy-MM-dd"

# Logical key of a daily row, and of the time series it belongs to.
KEY = ("date", "region_id", "type_id")
SERIES = ("region_id", "type_id")

# Columns that must not be negative in a clean row.
NON_NEGATIVE = ("average", "highest", "lowest", "volume")

# Feature table: id and base columns, then features in order, then the label.
FEATURE_IDS = ("date", "year", "month", "region_id", "type_id", "average")
FEATURES = (
    "price_lag_1", "price_lag_3", "price_lag_7",
    "price_mean_7", "price_mean_14", "price_std_7",
    "volume_lag_1", "volume_mean_7",
    "spread", "spread_mean_7", "dow",
)
LABEL = "target_next_price"

# Inputs of the segmentation and of the regression, in vector order.
SEGMENT_INPUTS = (
    "log_price_med", "log_price_std", "log_vol_med", "log_vol_std", "spread_rel_med", "n_regions",
)
REGRESSION_NUMERICS = FEATURES + ("month",)
REGRESSION_CATEGORIES = ("region_id", "type_id")

# Defaults.
TOP_ITEMS = 20
TREND_ITEMS = 5
MIN_ITEM_ROWS = 200
SEGMENTS = 8
SEED = 42
TEST_DAYS = 60
EPSILON = 1e-6
# ----------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the region of their supplier and the item (brand) of their part.

    No broadcast hint: part and supplier grow with the data, so the join strategy is left to
    Spark, which broadcasts below ``autoBroadcastJoinThreshold`` and otherwise shuffles on the
    join key, where adaptive execution splits a hot key's partition.
    """
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.regexp_replace("p_brand", "Brand#", "").cast("int").alias("type_id")
    )
    region = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("n_regionkey").alias("region_id"))
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(region, F.col("l_suppkey") == F.col("s_suppkey"))
    )


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily view over the star schema.

    The distinct count makes Spark aggregate by (key, order) first and by key second, so no
    single key, however hot, is gathered in one task before it has been reduced.
    """
    return (
        _line_rows(spark, sf_dir)
        .groupBy(F.col("l_shipdate").cast("date").alias("date"), "region_id", "type_id")
        .agg(
            F.avg("l_extendedprice").alias("average"),
            F.max("l_extendedprice").alias("highest"),
            F.min("l_extendedprice").alias("lowest"),
            F.countDistinct("l_orderkey").cast("int").alias("order_count"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
    )


def raw_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as an uncleaned daily row in the raw file layout.

    The source tables are spotless, so some cells are spoiled on purpose (by order number; no
    row is left out) to give the cleaning rules something to reject.
    """
    order, price = F.col("l_orderkey"), F.col("l_extendedprice")
    shipped = F.col("l_shipdate").cast("date").cast("string")
    moment = (F.col("l_shipdate") + F.make_dt_interval(secs=order % 86_400)).cast("string")
    modified = F.concat(F.translate(moment, " ", "T"), F.lit("Z"))
    return _line_rows(spark, sf_dir).select(
        F.when(order % 97 == 0, F.lit(None)).when(order % 89 == 0, -price).otherwise(price).alias("average"),
        F.when(order % 103 == 0, F.concat(F.substring(shipped, 1, 4), F.lit("-13-01")))
        .otherwise(shipped).alias("date"),
        F.when(order % 83 == 0, price - 1).otherwise(price + 1).alias("highest"),
        price.alias("lowest"),
        F.lit(1).alias("order_count"),
        F.when(order % 79 == 0, -1).otherwise(F.col("l_quantity").cast("bigint")).alias("volume"),
        F.when(order % 73 == 0, "never").otherwise(modified).alias("http_last_modified"),
        "region_id",
        F.when(order % 101 == 0, F.lit(None)).otherwise(F.col("type_id")).cast("int").alias("type_id"),
    )
