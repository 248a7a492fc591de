"""Shared storage and small helpers for the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import delete, materialize, new_path, scratch, shared_dir  # noqa: F401  the operators take them from here

#: The ASCII white space of the line and word contracts: space and U+0009 to U+000D.
ASCII_SPACE = " \t\n\x0b\x0c\r"

#: Bytes of rows that a Python worker gets at a time; it and Spark hold several copies of them.
BATCH_BYTES = 8 << 20
ARROW_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` in batches of at most BATCH_BYTES (or one row).

    Spark reads the bound when a query runs, so it stays set for the session's later queries, which
    it only gives smaller batches.
    """
    df.sparkSession.conf.set(ARROW_BOUND, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


#: A key with at least one HOT_KEYS-th of all counted rows is hot, so there are at most this many.
HOT_KEYS = 2048


def join_counted(rows: DataFrame, keyed: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of ``rows`` with ``keyed``, which has each key once and in ``n`` its number of rows.

    Hot keys, at most HOT_KEYS of them whatever the input, are broadcast, so that their rows stay
    where they are; all others are shuffled, and no task gets more than a small share of one key.
    ``keyed`` is read three times and must be stored.
    """
    total = keyed.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(keyed.where(F.col("n") * HOT_KEYS >= total).drop("n"))
    cold = keyed.where(F.col("n") * HOT_KEYS < total).drop("n")
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return rows.join(hot, keys).unionByName(rest)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z alone; all other letters stay."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def chunks(texts: list[str], most_chars: int = 4_000_000):
    """Runs of neighbouring list positions that hold about ``most_chars`` characters together."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= most_chars:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)
