"""Parse run: numbered page files to streets, stages and the review log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import overlay as O
from ..operators.entries import tables
from ..operators.ordering import book_order
from ..operators.segment import segment_volumes
from ..schemas import LOG, STAGES, STREETS
from ..sources.files import clean_pages, pages, read_overlay, write_csv


class NothingParsed(RuntimeError):
    """No street came out of the pages: a wrong folder, or pages of another kind."""


def parse(df: DataFrame, running_title: str = "") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(streets, stages, log) of pages (volume, page, text); only segmentation looks across pages."""
    return tables(segment_volumes(clean_pages(df, running_title)))


def run(spark: SparkSession, folder: str, out: str, corrections: str = "", running_title: str = "") -> dict[str, int]:
    """Parse, correct, order and write; figures of the run. Duplicate keys are logged before corrections."""
    streets, stages, log = found = [df.persist() for df in parse(pages(spark, folder), running_title)]
    if corrections:
        listed = read_overlay(spark, corrections)
        new_streets, new_stages = O.apply(streets, stages.drop("volume"), listed)
        new_stages = new_stages.withColumn("seq", F.col("stadium").cast("long"))
    else:
        listed, new_streets, new_stages = None, streets, stages
    ordered, in_order = book_order(new_streets, new_stages)
    write_csv(ordered, f"{out}/streets", STREETS)
    write_csv(in_order, f"{out}/stages", STAGES)
    write_csv(log, f"{out}/log", LOG, ["volume", "buchseite", "seq"])
    figures = {"strassen": new_streets.count(), "namensstadien": new_stages.count(), "pruefung": log.count(), "korrekturen": listed.count() if listed else 0}
    for df in found:
        df.unpersist()
    if not figures["strassen"]:
        raise NothingParsed(f"no street in {folder}")
    return figures
