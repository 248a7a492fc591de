"""Review run: compare readers with the tables, and turn filled cells into corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import overlay, readers, review
from ..schemas import UNCERTAIN
from ..sources.files import append_corrections, exists, open_corrections, read_csv, write_csv
from . import reports


class OpenCorrections(RuntimeError):
    """A review list holds filled cells that a new list would overwrite."""


def build(streets: DataFrame, stages: DataFrame, answers: DataFrame, names: list[str], previous: DataFrame | None = None) -> DataFrame:
    """The review list; refused while ``previous`` has filled cells."""
    if previous is not None and open_corrections(previous):
        raise OpenCorrections("take over or clear the filled cells first")
    return review.review_list(streets, stages, answers, names)


def write_list(rows: DataFrame, path: str, one_file: bool = True) -> int:
    """Write a review list in its order, as one file or one for each partition, and give its number of rows; refused while the list at ``path`` has filled cells."""
    spark = rows.sparkSession
    if exists(spark, path) and open_corrections(read_csv(spark, path)):
        raise OpenCorrections(f"take over or clear the filled cells of {path} first")
    kept = rows.persist()
    try:
        write_csv(kept, path, kept.schema, one_file=one_file)
        return kept.count()
    finally:
        kept.unpersist()


def uncertain(streets: DataFrame, stages: DataFrame, answers: DataFrame, names: list[str], log: DataFrame) -> DataFrame:
    """All fields of the uncertain entries, with the reasons that ``log`` (with ``seq``) has for them."""
    keys = streets.where(F.col("status") == UNCERTAIN)
    return review.full_review_list(streets, stages, answers, names, keys, review.reasons_by_key(streets, log))


def figures(streets: DataFrame, stages: DataFrame, answers: DataFrame, names: list[str]) -> str:
    """Markdown: what each reader has read, and how often it has the values of the tables."""
    parts = ["# Readers"]
    for name in names:
        compared = review.Comparison(streets, stages, answers, name)
        read, same = review.reader_figures(compared).first().asDict(), review.agreement(compared).orderBy("status", "feldtyp").collect()
        compared.release()
        parts += [f"## {name}", reports.table(["figure", "rows"], read.items()), reports.table(["status", "field", "compared", "same"], same)]
    return "\n\n".join(parts) + "\n"


def mixed_prompts(answers: DataFrame) -> list[str]:
    """Readers whose answers come from more than one prompt."""
    return [r["reader"] for r in readers.prompt_hashes(answers).where("prompts > 1").orderBy("reader").collect()]


def measure(sample: DataFrame, answers: DataFrame, reader: str) -> DataFrame:
    """Error rates of a reader against checked fields; an error if a key is ambiguous or prompts are mixed."""
    own = answers.where(F.col("reader") == reader)
    own = own.join(sample.select(F.col("buchseite").cast("int").alias("buchseite")).distinct(), "buchseite", "left_semi")
    streets = readers.streets(own)
    twice = [r["schl_nr"] for r in review.ambiguous_keys(streets, sample).orderBy("schl_nr").limit(20).collect()]
    if twice or mixed_prompts(own):
        raise ValueError(f"answers can't be measured: keys {twice}, prompts {mixed_prompts(own)}")
    return review.reader_error_rates(sample, streets, readers.stages(own))


def take_over(filled: DataFrame, streets: DataFrame, stages: DataFrame, present: DataFrame, date: str, path: str) -> int:
    """Append the corrections of a filled review list to the overlay; an error if any wouldn't fit."""
    wrong = overlay.dry_run(filled, streets, stages, present).limit(20).collect()
    if wrong:
        raise overlay.OverlayError("; ".join(f"{r['schl_nr']} {r['feld']}: {r['meldung']}" for r in wrong))
    new = overlay.from_review(filled, present, date)[0].persist()
    try:
        append_corrections(new, path, ["order"])
        return new.count()
    finally:
        new.unpersist()
