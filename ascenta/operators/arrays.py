"""Helpers that several operators share: arrays, numbers in order, and rows that a join can't use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

#: Bits of a filter for each key, about, and the binary logarithm of the bits of one bitmap and of the most in all (8 MB).
KEY_BITS, MAP_LOG, MOST_LOG = 16, 15, 26


def indices(n: Column) -> Column:
    """0 to n - 1; empty where n is 0 or less."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def collapse_repeats(values: Column) -> Column:
    """Neighbouring equal elements as one."""
    return F.filter(values, lambda x, i: (i == 0) | (x != F.get(values, i - 1)))


def numbered(df: DataFrame, name: str, lead: str, *order: str, width: int = 1024) -> DataFrame:
    """*df* with *name*, each row's place (from 0) in the order of the whole number *lead*, then *order*.

    Rows are counted in ranges of *lead* first; then rows are placed within a range
    and ranges by running sum, so no task sorts the table. The range table is 1/width
    of the distinct leads; where it's large it is itself summed by ranges.
    """
    rows = df.withColumn("__range", F.floor(F.col(lead) / width).cast("long"))
    counts = rows.groupBy("__range").agg(F.count("*").alias("__n")).withColumn("__far", F.floor(F.col("__range") / width).cast("long"))
    within = Window.partitionBy("__far").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    far = counts.groupBy("__far").agg(F.sum("__n").alias("__m"))
    before = Window.orderBy("__far").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("__a", F.coalesce(F.sum("__n").over(within), F.lit(0))).join(far.select("__far", F.coalesce(F.sum("__m").over(before), F.lit(0)).alias("__b")), "__far")
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(lead, *order)) - 1
    placed = rows.withColumn("__i", inside).join(starts.select("__range", (F.col("__a") + F.col("__b")).alias("__first")), "__range")
    return placed.withColumn(name, (F.col("__first") + F.col("__i")).cast("long")).drop("__range", "__i", "__first")


def likely(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """*rows* without most of those whose *key* is not among that of *keys*, so that a join that follows sends fewer; none of the others goes.

    A row stays if the bit of its key's hash is set, so about one in KEY_BITS of the rest stay
    too, and more where *keys* has over 4 million rows: the bits, which are collected and broadcast, are at most 8 MB.
    *keys* is read twice.
    """
    spark = rows.sparkSession
    log = min(MOST_LOG, max(MAP_LOG, (KEY_BITS * keys.count()).bit_length()))
    hashed = F.pmod(F.xxhash64(key), F.lit(1 << log))
    place = keys.select(hashed.alias("h"))
    maps = place.groupBy(F.shiftright("h", MAP_LOG).alias("b")).agg(F.bitmap_construct_agg(F.col("h").bitwiseAND((1 << MAP_LOG) - 1)).alias("m")).collect()
    width = 1 << MAP_LOG - 3
    bits = bytearray(1 << log - 3)
    for b, m in maps:
        bits[b * width : (b + 1) * width] = m
    held = spark.sparkContext.broadcast(bytes(bits))

    @arrow_udf("boolean")
    def seen(h):
        import numpy as np
        import pyarrow as pa

        at = h.to_numpy(zero_copy_only=False)
        return pa.array(np.frombuffer(held.value, np.uint8)[at >> 3] >> (at & 7) & 1 == 1)

    return rows.where(seen(hashed))
