"""Validity chains: the state at a cutoff, renames, and the concordance of earlier and present names.

Stages carry ``seq``, their order in the source, which decides between equal dates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import comparable
from ..functions.text import address_key, compare_key, is_partial_suffix, split_suffix, text_or_empty, trim_u
from ..schemas import Reason


def _state() -> Column:
    return F.struct("name", "datum_praezision", "gueltig_ab")


def states(stages: DataFrame, cutoff: str, key: str = "schl_nr") -> DataFrame:
    """Key with two structs of its dated stages: ``valid`` and ``final``.

    ``valid`` is the latest on or before ``cutoff`` (of equal dates the last in order), ``final`` the
    latest of all (of equal dates the first). One aggregate that combines before its shuffle.
    """
    dated = stages.withColumn("_date", comparable("gueltig_ab")).where("_date is not null")
    return dated.groupBy(key).agg(
        F.max_by(F.when(F.col("_date") <= cutoff, _state()), F.when(F.col("_date") <= cutoff, F.struct("_date", "seq"))).alias("valid"),
        F.max_by(_state(), F.struct(F.col("_date"), -F.col("seq"))).alias("final"),
    )


def state_at(stages: DataFrame, cutoff: str, key: str = "schl_nr") -> DataFrame:
    """The stage valid at ``cutoff`` for each key that has one."""
    return states(stages, cutoff, key).where("valid is not null").select(key, "valid.*")


def last_state(stages: DataFrame, key: str = "schl_nr") -> DataFrame:
    """The last dated stage of each key."""
    return states(stages, "", key).select(key, "final.*")


def judged(streets: DataFrame, stages: DataFrame, cutoff: str) -> DataFrame:
    """Streets with ``verdict``: candidate, review or null, and the parts that both outputs need.

    No verdict without a valid stage, or if the names agree without their suffixes and no suffix says
    "in part". Review if the last dated stage isn't the present name, candidate otherwise.
    """
    own = streets.join(states(stages, cutoff), "schl_nr", "left")
    old, new, last = split_suffix(F.trim("valid.name")), split_suffix(F.trim("lemma")), split_suffix(F.trim("final.name"))
    s = own.withColumns({"old": old, "new": new, "last": last})
    unchanged = (F.col("old.base") == F.col("new.base")) & ~is_partial_suffix("old.suffix") & ~is_partial_suffix("new.suffix")
    broken = F.col("final").isNull() | (compare_key("last.base") != compare_key("lemma"))
    return s.withColumn("verdict", F.when(F.col("valid").isNull() | unchanged, F.lit(None)).when(broken, "review").otherwise("candidate"))


def concordance(streets: DataFrame, stages: DataFrame, cutoff: str, source: str = "") -> DataFrame:
    """Earlier and present names of streets renamed since ``cutoff``.

    ``eindeutig`` says whether a district has one row alone for the earlier name. ``source`` fills
    the column ``quelle``.
    """
    suffix = F.concat_ws(
        " / ",
        F.when(F.col("old.suffix") != "", F.col("old.suffix")),
        F.when(F.col("new.suffix") != "", F.concat(F.lit("heutig:"), F.col("new.suffix"))),
    )
    rows = judged(streets, stages, cutoff).where("verdict = 'candidate'").select(
        trim_u(F.element_at(F.split(text_or_empty("stadtteile"), ";"), 1)).alias("stadtteil"),
        F.col("old.base").alias("ehemalig"),
        F.col("new.base").alias("heutig"),
        "schl_nr",
        text_or_empty("valid.datum_praezision").alias("datum_praezision"),
        F.lit(source).alias("quelle"),
        suffix.alias("zusatz"),
    )
    same = F.count(F.lit(1)).over(Window.partitionBy("stadtteil", "ehemalig"))
    return rows.withColumn("eindeutig", F.when(same == 1, "ja").otherwise("nein"))


def concordance_review(streets: DataFrame, stages: DataFrame, cutoff: str) -> DataFrame:
    """Streets that :func:`concordance` leaves out because the chain doesn't end in the present name."""
    found = F.when(F.col("final").isNull(), F.lit("kein datiertes Stadium")).otherwise(F.concat(F.lit("letztes Stadium '"), trim_u("final.name"), F.lit("'")))
    text = F.concat(found, F.lit(" ≠ Lemma '"), trim_u("lemma"), F.lit("' (schl_nr "), F.col("schl_nr").cast("string"), F.lit(")"))
    return judged(streets, stages, cutoff).where("verdict = 'review'").select("buchseite", trim_u("lemma").alias("lemma"), F.lit(Reason.CHAIN_INCOMPLETE).alias("grund"), text.alias("befund"))


def attested_renames(stages: DataFrame, address_names: DataFrame, period: str = "year", first: str = "", last: str = "9999-99", key: str = "schl_nr") -> DataFrame:
    """period, alt and neu: renames for which an address book has only the earlier or only the later name.

    ``address_names`` has one column, ``name``. By year (int) all dated renames count, by month
    (text) those dated to the day between ``first`` and ``last``.
    """
    order = Window.partitionBy(key).orderBy("_date", "seq")
    dated = stages.withColumn("_date", comparable("gueltig_ab")).where("_date is not null")
    pairs = dated.withColumn("_before", F.lag("name").over(order)).where("_before is not null")
    if period == "month":
        pairs = pairs.where(F.col("datum_praezision") == "tag").withColumn("period", F.substring("_date", 1, 7)).where(F.col("period").between(first, last))
    else:
        pairs = pairs.withColumn("period", F.substring("_date", 1, 4).cast("int"))
    known = address_names.select(address_key("name").alias("_known")).distinct()
    pairs = pairs.select("period", address_key("_before").alias("_old"), address_key("name").alias("_new"))
    both = pairs.join(known.withColumn("has_old", F.lit(True)), F.col("_old") == F.col("_known"), "left").drop("_known")
    both = both.join(known.withColumn("has_new", F.lit(True)), F.col("_new") == F.col("_known"), "left")
    decided = both.where(F.col("has_old").isNotNull() != F.col("has_new").isNotNull())
    return decided.groupBy("period").agg(F.count("has_old").alias("alt"), F.count("has_new").alias("neu"))
