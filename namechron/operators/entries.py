"""From segmented entries to streets, stages and the review log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.predicates import field_long, group_odd, lemma_long, lemma_odd_form, name_odd
from ..functions.text import extract, matches, strip_edge, trim_u
from ..schemas import AUTOMATIC, UNCERTAIN, Reason
from ..sources.storage import materialize
from .chains import parse_chains
from .checks import flag_duplicates
from .heads import parse_heads

#: Characters of a body in which a cross-reference stands for a missing chain.
REFERENCE_WINDOW = 120


def _no(c: Column | str) -> Column:
    return F.size(c) == 0


def read_entries(segments: DataFrame) -> DataFrame:
    """Segments of :func:`segment.segment_volumes`, entries with head, chain, cross-reference and clean lemma."""
    is_entry = F.col("kind") == "entry"
    read = parse_chains(parse_heads(segments.withColumn("_body", F.when(is_entry, F.col("rumpf"))), "_body"))
    return read.withColumns(
        {
            "_lemma": strip_edge("lemma_roh"),
            "verweis_auf": trim_u(extract("rumpf", P.CROSS_REFERENCE)),
            "_near": matches(F.substring("rumpf", 1, REFERENCE_WINDOW), P.CROSS_REFERENCE),
            "_odd": F.filter(F.transform("stadien", lambda s: s["name"]), name_odd),
        }
    ).drop("_body")


def reasons(entries: DataFrame) -> DataFrame:
    """``entries`` with ``gruende``: ordered distinct reasons to look at each entry, if it has a key."""
    pure = F.col("_near") & _no("stadien")
    classes = F.array_join("strassenklassen", "; ")
    stage_hints = F.flatten(F.transform("stadien", lambda s: F.split(s["hinweis"], "; ")))

    def when(condition: Column, reason: str) -> Column:
        return F.array(F.when(condition, F.lit(reason)))

    found = F.concat(
        F.col("hinweise"),
        F.array(F.when(F.col("_lemma.hint") != "", F.col("_lemma.hint"))),
        when(lemma_long("_lemma.value"), Reason.LEMMA_LENGTH),
        when(lemma_odd_form("_lemma.value"), Reason.LEMMA_FORM),
        when(_no("stadien") & ~F.col("_near"), Reason.NO_STAGE),
        when(~_no("_odd"), Reason.STAGE_ODD),
        when(field_long(classes) | group_odd("namensgruppe"), Reason.FIELD_LENGTH),
        F.col("kopf_hinweise"),
        F.filter(stage_hints, lambda h: h != ""),
        when(_no("stadtteile") & ~pure, Reason.NO_DISTRICT),
        when(_no("strassenklassen") & ~pure, Reason.NO_CLASS),
        when(matches("residuum", r"\d"), Reason.CHAIN_LEFTOVER),
    )
    return entries.withColumn("gruende", F.array_distinct(F.array_compact(found)))


def _logged() -> Column:
    """An array of what the log says about a segment: structs (lemma_roh, grund, rohtext)."""

    def line(reason: Column, raw: Column, lemma: str = "lemma_roh") -> Column:
        return F.struct(F.col(lemma).alias("lemma_roh"), reason.alias("grund"), F.substring(raw, 1, 200).alias("rohtext"))

    def found(reason: Column) -> Column:
        raw = F.when(reason == Reason.STAGE_ODD, F.array_join("_odd", "; ")).when(reason == Reason.CHAIN_LEFTOVER, F.col("residuum")).otherwise(F.col("rumpf"))
        return line(reason, raw)

    def alone(reason: str) -> Column:
        return F.array(line(F.lit(reason), F.col("rumpf")))

    twice = F.when(F.col("mehrfach"), line(F.lit(Reason.KEY_TWICE), F.lit(""), "_lemma.value"))
    keyed = F.array_compact(F.concat(F.transform("gruende", found), F.array(twice)))
    return F.when(F.col("kind") == "rejected", alone(Reason.ANCHOR_WITHOUT_LEMMA)).when(F.col("schl_nr").isNull(), alone(Reason.NO_KEY)).otherwise(keyed)


def tables(segments: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(streets, stages, log) of segments; streets and stages carry volume and seq.

    Segments are read once and stored; the log is what each of them has to say, as an array that is written out.
    """
    read = materialize(reasons(read_entries(segments)), "entries")
    # segments without a key are nobody's twin and meet nowhere
    own_key = F.coalesce("schl_nr", F.concat_ws("/", F.lit(""), "volume", "kind", "seq"))
    marked = flag_duplicates(read.withColumn("_key", own_key), "_key")
    streets = marked.where("schl_nr is not null").select(
        "volume", "seq", "schl_nr", F.col("_lemma.value").alias("lemma"), F.array_join("stadtteile", "; ").alias("stadtteile"), F.array_join("strassenklassen", "; ").alias("strassenklasse"),
        "namensgruppe", "verweis_auf", "buchseite", F.when(_no("gruende") & ~F.col("mehrfach"), AUTOMATIC).otherwise(UNCERTAIN).alias("status"),
    )
    stages = read.where("schl_nr is not null").select("volume", "seq", "schl_nr", F.explode("stadien").alias("s")).select("volume", "seq", "schl_nr", "s.stadium", "s.gueltig_ab", "s.datum_praezision", "s.name", "s.ist_urspruenglich")
    log = marked.select("volume", "seq", "buchseite", F.explode(_logged()).alias("x")).select("volume", "seq", "buchseite", "x.lemma_roh", "x.grund", "x.rohtext")
    return streets, stages, log
