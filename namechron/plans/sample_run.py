"""Gold sample: draw the fields to check, and evaluate the checked ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import sampling
from . import reports


def draw(streets: DataFrame, stages: DataFrame, seed: int = 1936) -> DataFrame:
    return sampling.fields_to_check(sampling.draw(streets, seed), stages).orderBy(F.col("schl_nr").cast("long"), "feld")


def evaluate(sample: DataFrame, most_open: float = 0.1) -> str:
    """Markdown of the error rates; an error if more than ``most_open`` of the rows are unchecked."""
    total, done = sample.count(), sampling.checked(sample).count()
    if total and (total - done) / total > most_open:
        raise sampling.SampleError(f"{total - done} of {total} rows are not checked")
    return reports.error_rates(total, done, sampling.error_rates(sample).orderBy("ebene", "gruppe").collect(), sampling.errors(sample).orderBy("schl_nr", "feld").collect())
