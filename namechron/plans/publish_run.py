"""Publish run: self-checks, concordance and its review list, attested renames, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import asof, checks
from ..schemas import CONCORDANCE, CONCORDANCE_REVIEW, UNCERTAIN, USABLE, VALIDATION_REVIEW
from ..sources.files import write_csv
from . import reports

#: Cutoff and months of the address book that the concordance serves.
CUTOFF, FIRST_MONTH, LAST_MONTH = "1936-06-30", "1935-01", "1937-12"


def run(streets: DataFrame, stages: DataFrame, register: DataFrame, address_names: DataFrame, out: str, cutoff: str = CUTOFF, source: str = "") -> dict[str, str]:
    """Write concordance, review lists and return the reports as Markdown by name.

    ``streets`` and ``stages`` carry ``seq``. Only usable streets go into the concordance, all into
    checks and measurements.
    """
    usable = streets.where(F.col("status").isin(USABLE))
    table = asof.concordance(usable, stages, cutoff, source).persist()
    review = asof.concordance_review(usable, stages, cutoff).persist()
    dips = checks.alphabet_dips(streets).persist()
    write_csv(table, f"{out}/concordance", CONCORDANCE, ["schl_nr"])
    write_csv(review, f"{out}/concordance_review", CONCORDANCE_REVIEW, ["buchseite", "lemma"])
    write_csv(checks.validation_review(streets, register), f"{out}/validation_review", VALIDATION_REVIEW, ["grund", "schl_nr"])
    keys = checks.key_stats(streets).first()
    total, unknown = streets.count(), checks.not_in_register(streets, register).count()
    quality = reports.quality(keys.asDict(), dips.count(), dips.where(F.col("status") == UNCERTAIN).count(), total - unknown, unknown)
    years = asof.attested_renames(stages, address_names).orderBy("period").collect()  # one row a year
    months = asof.attested_renames(stages, address_names, "month", FIRST_MONTH, LAST_MONTH).orderBy("period").collect()
    figures = table.agg(F.count(F.lit(1)), F.count(F.when(F.col("eindeutig") == "ja", 1)), F.count(F.when(F.col("zusatz") != "", 1))).first()
    survey = reports.survey(years, months, cutoff, total, usable.count(), tuple(figures), review.count())
    for df in (table, review, dips):
        df.unpersist()
    return {"quality": quality, "survey": survey}
