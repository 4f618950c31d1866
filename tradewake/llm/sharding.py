"""Shards that all hold the mixture of sources: proportional stratified interleaving.

Within each source the rows are shuffled by a seeded hash of their id and ranked; a row's fractional rank
is (rank - 1/2) / rows of the source. All rows are then ordered by fractional rank, which spreads every source
evenly over the order, and the order is cut into shards whose row counts differ by one at most.

Scale: text is read once, for its size and checksum; only narrow rows are moved. Both orders are taken by
range partitioning and numbered from the rows within each partition and the totals of the partitions
before it, so no source, however large, is ranked in one task, and nothing but one row per partition is
gathered. Equal keys are ordered by all columns; rows that are alike in all of them can trade places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.workspace import stored
from .common import with_lookup

SHARDS = 16
SEED = 17
_ROW_BITS = 33  # of monotonically_increasing_id, below the partition's number


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows with their place, from 0, in the given order over the whole frame; written to the shared folder."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = stored(
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "ordered",
    )
    part = F.shiftright("_at", _ROW_BITS)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    # One row per partition of the range partitioning.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + row)
        .drop("_at", "_part", "_before")
    )


def shard_of(place: Column, rows: Column, shards: int) -> Column:
    """The shard of a place, with the first rows % shards shards one row larger."""
    small = F.floor(rows / shards)
    large = rows % shards
    border = large * (small + 1)
    return F.when(place < border, F.floor(place / (small + 1))).otherwise(
        large + F.floor((place - border) / F.greatest(small, F.lit(1)))
    ).cast("int")


def _first_of(shard: Column, rows: Column, shards: int) -> Column:
    return shard * F.floor(rows / shards) + F.least(shard, rows % shards)


def interleaved(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """(id, source, size, text_crc32, shard, slot): shard 0 to shards - 1, slot from 0 without gaps in each.

    A null source is a source of its own, a null text has size 1 and the checksum of an empty text, and a null id is
    shuffled like any other; repeated rows are rows. Fewer rows than shards leave the last shards empty. Other
    columns have no effect; no rows give no rows. Copies of a text are not kept together.
    """
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")).alias("key"),
    )
    placed = stored(
        numbered(rows, [F.col(c) for c in ("source", "key", "id", "size", "text_crc32")], "place"), "within-sources"
    )
    # A flag beside the source lets null be a source of its own in an ordinary join.
    named = {"name": F.coalesce(F.col("source").cast("string"), F.lit("")), "none": F.col("source").isNull()}
    placed = placed.withColumns(named)
    sources = stored(
        placed.groupBy("name", "none").agg(F.min("place").alias("first"), F.count("*").alias("n")), "sources"
    )
    ranked = with_lookup(placed, sources, ["name", "none"], F.col("place")).select(
        "id", "source", "size", "text_crc32", "key",
        ((F.col("place") - F.col("first") + 0.5) / F.col("n")).alias("fraction"),
    )
    placed = numbered(ranked, [F.col(c) for c in ("fraction", "key", "source", "id", "size", "text_crc32")], "place")
    total = F.lit(sources.agg(F.sum("n")).first()[0] or 0)
    shard = shard_of(F.col("place"), total, shards)
    return placed.withColumn("shard", shard).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "text_crc32", "shard",
        (F.col("place") - _first_of(F.col("shard"), total, shards)).cast("long").alias("slot"),
    )
