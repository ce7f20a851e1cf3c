"""Exact dedup: a tree merge of sorted digest runs, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import BLANKS, whole_text

_KEY = ["__sha", "__check", "__bytes"]


def _digests(df: DataFrame, id_col: str, text_col: str) -> list[Column]:
    text = whole_text(text_col)
    bare = F.regexp_replace(text, f"[{BLANKS}]", "")
    return [
        F.col(id_col).alias("__id"),
        F.char_length(text).cast("long").alias("__points"),
        F.sha2(bare.cast("binary"), 256).alias("__sha"),
        F.xxhash64(bare).alias("__check"),
        F.octet_length(bare).alias("__bytes"),
    ]


#: Runs that the binomial rounds begin with at most: with more partitions than this, several fill one run.
MOST_RUNS = 256
#: Hex digits of a digest that name its range: a run is exchanged in ranges, each of which moves whole.
RANGE_DIGITS = 3


def _merge(runs: DataFrame, run: Column, keep: str, count: Column) -> DataFrame:
    """One round: every range of the runs that become one goes to one task, which merges them in the order of their digests.

    Each run arrives as sorted stretches, one from each task that held a part of it, and
    leaves sorted. Equal digests are neighbours there and become one row.
    """
    dealt = runs.withColumns({"__run": run, "__range": F.substring("__sha", 1, RANGE_DIGITS)})
    merged = dealt.repartition("__run", "__range").sortWithinPartitions("__run", "__range", *_KEY)
    return merged.groupBy("__run", "__range", *_KEY).agg(F.min(keep).alias("__keep"), F.sum(count).alias("__n"))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_runs: int = MOST_RUNS) -> DataFrame:
    """One row per input row with the row of its duplicate group that stays.

    Texts are equal when identical after deleting ASCII white space. Of equal
    texts the one with the most code points in the original stays, then the one
    with the smallest id (a null id comes last), then the first row read.

    Each input partition is a run: its digests are merged into one row each where
    they are read. Then runs are exchanged in binomial rounds: in each,
    neighbours (run ids that differ in the last bit) become one run, range of
    digests by range, until one is left, so there are as many rounds as the number of
    runs has binary digits; over *most_runs* partitions, several begin as one run.
    Every level keeps one row per digest and run, hence a digest that a
    third of the table shares sends two rows to any task of a round. A digest is
    verified at each level by an independent 64-bit check and the byte length,
    which are part of the merge key. The answer travels back by the digests of
    the first level, so no join key holds more rows than a run does.

    Null text counts as empty; empty and very long texts are texts like any other;
    an empty table gives an empty result; other columns are not read, whatever
    their names. Repeated rows are duplicates of which one stays. The digests are written when this is called.

    Returns: *id_col*, keep_id, group_size, kept, text_sha256, n_points.
    """
    if most_runs < 1:
        raise ValueError("most_runs must be at least 1")
    rows = materialize(
        df.select(*_digests(df, id_col, text_col), F.spark_partition_id().alias("__run"), F.monotonically_increasing_id().alias("__row")),
        "digests",
    )
    order = F.struct((-F.col("__points")).alias("less"), F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__row").alias("row"))
    local = rows.groupBy("__run", *_KEY).agg(F.min(order).alias("__keep"), F.count("*").alias("__n"))
    left = 1 + (rows.agg(F.max("__run")).first()[0] or 0)
    together = -(-left // most_runs)
    top, left = local.withColumn("__run", F.floor(F.col("__run") / together).cast("int")), -(-left // together)
    while True:
        top = _merge(top, F.shiftright("__run", 1), "__keep", F.col("__n"))
        left = -(-left // 2)
        if left <= 1:
            break
    known = local.select("__run", *_KEY).join(top.select(*_KEY, "__keep", "__n"), _KEY)
    return rows.join(known, ["__run", *_KEY]).select(
        F.col("__id").alias(id_col),
        F.col("__keep.id").alias("keep_id"),
        F.col("__n").alias("group_size"),
        (F.col("__row") == F.col("__keep.row")).alias("kept"),
        F.col("__sha").alias("text_sha256"),
        F.col("__points").alias("n_points"),
    )


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_runs: int = MOST_RUNS) -> DataFrame:
    """The rows of *df* that :func:`exact_duplicates` keeps, with all their columns.

    Of rows that repeat both id and text, one stays.
    """
    kept = exact_duplicates(df.select(id_col, text_col), id_col, text_col, most_runs).where("kept")
    on = ["__id", "__sha", "__points"]
    stay = kept.select(F.col(id_col).alias("k_id"), F.col("text_sha256").alias("k_sha"), F.col("n_points").alias("k_points"))
    rows = df.select("*", *_digests(df, id_col, text_col)).drop("__check", "__bytes")
    same = rows["__id"].eqNullSafe(stay["k_id"]) & (rows["__sha"] == stay["k_sha"]) & (rows["__points"] == stay["k_points"])
    return rows.join(stay, same, "left_semi").dropDuplicates(on).drop(*on)
