"""Order of the published tables, page ranges and image lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col, trim_u
from .ranks import ranked


def book_order(streets: DataFrame, stages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Streets by page, then order of arrival; stages by the first place of their street, orphans last.

    ``seq`` is the order of arrival. Ranks are the sort columns themselves, so no global numbering is
    needed.
    """
    ordered = streets.orderBy(F.col("buchseite").cast("int"), "seq")
    place = streets.groupBy("schl_nr").agg(F.min(F.struct(F.col("buchseite").cast("int").alias("page"), F.col("seq").alias("at"))).alias("_place"))
    joined = stages.join(place, "schl_nr", "left")
    stage_order = joined.orderBy(F.col("_place").isNull(), "_place", F.when(F.col("_place").isNull(), F.lit("")).otherwise(F.col("schl_nr")), F.col("stadium").cast("int"), "seq")
    return ordered, stage_order.drop("_place")


def book_places(streets: DataFrame, name: str = "platz") -> DataFrame:
    """``streets`` with ``name``: their place in the book, from 0, by page and order of arrival."""
    return ranked(streets, [F.col("buchseite").cast("int"), F.col("seq")], name=name)


def page_ranges(text: Column | str, first: int = 2, last: int = 388) -> Column:
    """Array of pages of a text like "23-30,45"; all pages for an empty text."""
    pieces = F.filter(F.transform(F.split(col(text), ","), trim_u), lambda p: p != "")

    def pages(p: Column) -> Column:
        ends = F.transform(F.split(p, "-"), lambda x: trim_u(x).cast("int"))
        return F.sequence(F.element_at(ends, 1), F.element_at(ends, -1))

    return F.when(trim_u(col(text)) == "", F.sequence(F.lit(first), F.lit(last))).otherwise(F.flatten(F.transform(pieces, pages)))


def image_list(review: DataFrame, classes: tuple[str, ...] = ("beide",), order: tuple[str, ...] = ("beide", "eines", "unlesbar", "keines")) -> DataFrame:
    """schl_nr, buchseite, felder (sorted, distinct) and the best class of review rows in ``classes``."""
    ranks = F.array(*map(F.lit, order))
    rows = review.where(F.col("einig").isin(*classes)).withColumn("_r", F.array_position(ranks, F.col("einig")))
    grouped = rows.groupBy("schl_nr", F.col("buchseite").cast("int").alias("buchseite")).agg(F.array_sort(F.collect_set("feld")).alias("felder"), F.min("_r").alias("_r"))
    return grouped.orderBy("_r", "schl_nr").select("schl_nr", "buchseite", "felder", F.element_at(ranks, F.col("_r").cast("int")).alias("einig"))
