"""Stratified samples, the fields to check in them, and error rates of checked fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import display
from ..functions.predicates import is_yes
from ..functions.text import col, field_type, text_or_empty, trim_u
from ..schemas import AUTOMATIC, SAMPLE_FIELDS, UNCERTAIN


class SampleError(ValueError):
    """A stratum has fewer rows than the sample needs."""


def stratified(df: DataFrame, sizes: dict[str, int], seed: int = 1936, stratum: str = "status", key: str = "schl_nr") -> DataFrame:
    """So many rows of each stratum as ``sizes`` says, the same for the same seed.

    Order within a stratum is md5(seed, key). A sampling operator: its limits are its purpose.
    """
    order = Window.partitionBy(stratum).orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key)
    most = F.element_at(F.create_map(*[x for k, v in sizes.items() for x in (F.lit(k), F.lit(v))]), F.col(stratum))
    ranked = df.where(F.col(stratum).isin(*sizes)).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= max(sizes.values()))
    return ranked.where(F.col("_n") <= most).drop("_n")


def draw(streets: DataFrame, seed: int = 1936, automatic: int = 40, uncertain: int = 10) -> DataFrame:
    """The usual sample, sorted by number; an error if a stratum is too small."""
    sizes = {AUTOMATIC: automatic, UNCERTAIN: uncertain}
    found = {r["status"]: r["count"] for r in streets.where(F.col("status").isin(*sizes)).groupBy("status").count().collect()}
    for status, n in sizes.items():
        if found.get(status, 0) < n:
            raise SampleError(f"{found.get(status, 0)} rows with status {status}, {n} needed")
    return stratified(streets, sizes, seed).orderBy(F.col("schl_nr").cast("long"), "schl_nr")


def scan_place(page: Column | str) -> Column:
    """Struct (band, pdf_seite, haelfte) of the scan that shows a page."""
    page = col(page).cast("int")
    first = page <= 201
    base = F.when(first, 2).otherwise(202)
    return F.struct(
        F.when(first, 1).otherwise(2).alias("band"),
        (F.floor((page - base) / 2) + 1).cast("int").alias("pdf_seite"),
        F.when(page % 2 == 0, "links").otherwise("rechts").alias("haelfte"),
    )


def scan_name(key: Column | str, page: Column | str) -> Column:
    return F.format_string("schlnr_%s_s%03d.png", col(key), col(page).cast("int"))


def page_name(page: Column | str) -> Column:
    return F.format_string("s%03d.png", col(page).cast("int"))


def fields_to_check(streets: DataFrame, stages: DataFrame) -> DataFrame:
    """A row for each head field, and for date and name of each stage, of every street."""
    base = streets.select("schl_nr", "lemma", F.col("status"), "buchseite", scan_place("buchseite").alias("_scan"), *[c for c in SAMPLE_FIELDS if c not in ("schl_nr", "lemma")])
    heads = F.array(*[F.struct(F.lit(f).alias("feld"), text_or_empty(F.col(f).cast("string")).alias("wert")) for f in SAMPLE_FIELDS])
    common = ["schl_nr", "lemma", "status", "buchseite", "_scan.*"]
    head_rows = base.select(*common, F.explode(heads).alias("c"))
    number = F.concat(F.lit("stadium_"), F.col("stadium").cast("string"))
    cells = F.array(F.struct(F.concat(number, F.lit("_datum")).alias("feld"), display("datum_praezision", "gueltig_ab").alias("wert")), F.struct(F.concat(number, F.lit("_name")).alias("feld"), F.col("name").alias("wert")))
    stage_rows = base.select("schl_nr", "lemma", "status", "buchseite", "_scan").join(stages.select("schl_nr", cells.alias("cells")), "schl_nr").select(*common, F.explode("cells").alias("c"))
    return head_rows.unionByName(stage_rows).select(*[c for c in head_rows.columns if c != "c"], "c.*", F.lit("").alias("korrekt"), F.lit("").alias("korrektur"))


def checked(sample: DataFrame) -> DataFrame:
    return sample.where(trim_u(text_or_empty("korrekt")) != "")


def _rate(done: Column, right: Column) -> Column:
    return F.when(done > 0, (done - right) / done * 100).otherwise(F.lit(0.0))


def error_rates(sample: DataFrame) -> DataFrame:
    """ebene (feldtyp, status, gesamt), gruppe, geprueft, korrekt and fehlerquote of checked rows.

    One pass over grouping sets. Only "ja" counts as right.
    """
    rows = checked(sample).select(field_type("feld", any_part=False).alias("typ"), text_or_empty("status").alias("status"), is_yes("korrekt").cast("int").alias("ok"))
    sets = rows.groupingSets([["typ"], ["status"], []], "typ", "status").agg(F.count(F.lit(1)).alias("geprueft"), F.coalesce(F.sum("ok"), F.lit(0)).alias("korrekt"), F.grouping_id().alias("_g"))
    level = F.when(F.col("_g") == 1, "feldtyp").when(F.col("_g") == 2, "status").otherwise("gesamt")
    return sets.select(level.alias("ebene"), F.coalesce("typ", "status", F.lit("")).alias("gruppe"), "geprueft", "korrekt", _rate(F.col("geprueft"), F.col("korrekt")).alias("fehlerquote"))


def entries_with_errors(sample: DataFrame) -> DataFrame:
    """status, eintraege and mit_fehler: entries that were checked and those with any error."""
    wrong = F.when(~is_yes("korrekt"), F.col("schl_nr"))
    return checked(sample).groupBy(text_or_empty("status").alias("status")).agg(F.countDistinct("schl_nr").alias("eintraege"), F.countDistinct(wrong).alias("mit_fehler"))


def errors(sample: DataFrame) -> DataFrame:
    """Checked rows that aren't right; ``fehlt`` marks those for which the tables had no value."""
    missing = trim_u(text_or_empty("wert")) == ""
    return checked(sample).where(~is_yes("korrekt")).select("schl_nr", "lemma", "status", "feld", "wert", "korrektur", missing.alias("fehlt"))
