"""Review lists: fields in which independent readers and the tables differ, and how often they do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.dates import display
from ..functions.text import cap_value, extract, field_rank, field_type, matches, text_or_empty, trim_u
from ..schemas import FALSE, HEAD_FIELDS, Reason
from . import readers as R
from .diff import changes, deviations, last_wins
from .sampling import checked


def field_values(streets: DataFrame, stages: DataFrame) -> DataFrame:
    """schl_nr, feld and wert of every field of every entry; stages are named by their place.

    Keys that occur twice count with their last row.
    """
    heads = {"eintrag": "lemma"} | {f: f for f in [*HEAD_FIELDS, "buchseite", "status"]}
    cells = F.array(*[F.struct(F.lit(k).alias("feld"), F.col(v).cast("string").alias("wert")) for k, v in heads.items()])
    head_rows = last_wins(streets).select("schl_nr", F.explode(cells).alias("c")).select("schl_nr", "c.*")
    n = F.row_number().over(Window.partitionBy("schl_nr").orderBy("stadium", "seq"))
    date = display("datum_praezision", "gueltig_ab")
    parts = {"": F.trim(F.concat_ws(" ", date, "name")), "_datum": date, "_name": F.col("name"), "_urspruenglich": F.col("ist_urspruenglich")}
    cells = F.array(*[F.struct(F.concat(F.lit("stadium_"), F.col("_n").cast("string"), F.lit(k)).alias("feld"), v.alias("wert")) for k, v in parts.items()])
    stage_rows = stages.join(streets.select("schl_nr").distinct(), "schl_nr", "left_semi").withColumn("_n", n).select("schl_nr", F.explode(cells).alias("c")).select("schl_nr", "c.*")
    return head_rows.unionByName(stage_rows)


def last_per_page(streets: DataFrame) -> DataFrame:
    """Keys of the last entry of each page, whose chain may go on overleaf."""
    return streets.groupBy("buchseite").agg(F.max_by("schl_nr", "seq").alias("schl_nr")).select("schl_nr").distinct()


def reasons_by_key(streets: DataFrame, log: DataFrame) -> DataFrame:
    """schl_nr and its distinct reasons in order; a log row finds its key by page and lemma, the first one counts."""
    keys = streets.groupBy(F.col("buchseite").cast("int").alias("buchseite"), F.col("lemma").alias("lemma_roh")).agg(F.min_by("schl_nr", "seq").alias("schl_nr"))
    rows = log.select(F.col("buchseite").cast("int").alias("buchseite"), "lemma_roh", "grund", "seq").join(keys, ["buchseite", "lemma_roh"])
    first = rows.groupBy("schl_nr", "grund").agg(F.min("seq").alias("seq"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("seq", "grund"))), lambda x: x["grund"])
    return first.groupBy("schl_nr").agg(F.array_join(ordered, "; ").alias("grund"))


class Comparison:
    """A reader's answers set against the tables, on the pages that it has read."""

    def __init__(self, streets: DataFrame, stages: DataFrame, answers: DataFrame, reader: str):
        own = answers.where(F.col("reader") == reader).persist()  # parsed once; every list and figure reads it several times
        self.reader = reader
        parsed = R.entries(own).persist()
        self.streets, self.stages, self.problems = R.streets(own, parsed), R.stages(own, parsed).persist(), R.problems(own, parsed).persist()
        self.pages = own.where("coalesce(fehler, '') <> 'unlesbar' and eintraege is not null").select(F.col("buchseite").cast("int").alias("buchseite")).distinct()
        self.unread = own.where("coalesce(fehler, '') = 'unlesbar' or eintraege is null")
        self.tables = last_wins(streets).withColumn("buchseite", F.col("buchseite").cast("int")).join(self.pages, "buchseite", "left_semi")
        # chains that the reader couldn't see whole are left out on both sides
        self.last = last_per_page(streets)
        self.cut = self.streets.where("unvollstaendig").select("schl_nr").union(self.last).distinct()
        self.table_stages = stages.join(self.tables.select("schl_nr"), "schl_nr", "left_semi")
        shown = self.table_stages.join(self.cut, "schl_nr", "left_anti")
        read = self.stages.join(self.cut, "schl_nr", "left_anti")
        found = changes(self.tables, shown, self.streets, read).persist()
        fields = deviations(found, shown, read)
        self.deviations = fields.unionByName(self.problems.select("schl_nr", "feld")).distinct().persist()

        self._kept = [own, parsed, self.stages, self.problems, found, self.deviations]

    def release(self) -> None:
        """Give up the tables that are held in memory."""
        for df in self._kept:
            df.unpersist()

    def problem_values(self) -> DataFrame:
        kind = F.when(F.col("grund") == Reason.DATE_UNREADABLE, "nicht normalisierbar").when(F.col("grund") == Reason.DATE_LIMITED, "eingeschränkt lesbar").otherwise("nicht als Liste")
        return self.problems.groupBy("schl_nr", "feld").agg(F.max(F.concat("text", F.lit(" ("), kind, F.lit(")"))).alias("problem"))


def _rows(fields: DataFrame, streets: DataFrame, stages: DataFrame, compared: list[Comparison]) -> DataFrame:
    """Values of all sides for (schl_nr, feld), with their agreement."""
    own = field_values(streets, stages).withColumnRenamed("wert", "wert_parser")
    page = last_wins(streets).select("schl_nr", F.col("buchseite").cast("int").alias("_page"), F.col("status").alias("status_parser"))
    rows = fields.join(own, ["schl_nr", "feld"], "left").join(page, "schl_nr", "left")
    for c in compared:
        rows = rows.join(last_wins(c.streets).select("schl_nr", F.col("buchseite").alias(f"_page_{c.reader}")), "schl_nr", "left")
    rows = rows.withColumn("buchseite", F.coalesce("_page", *[f"_page_{c.reader}" for c in compared]))
    for c in compared:
        values = field_values(c.streets, c.stages).withColumnRenamed("wert", f"_value_{c.reader}")
        rows = rows.join(values, ["schl_nr", "feld"], "left").join(c.problem_values().withColumnRenamed("problem", f"_problem_{c.reader}"), ["schl_nr", "feld"], "left")
        rows = rows.join(c.pages.withColumn(f"_read_{c.reader}", F.lit(True)), "buchseite", "left")
        value = F.when(F.col(f"_read_{c.reader}"), F.coalesce(f"_problem_{c.reader}", f"_value_{c.reader}", F.lit(""))).otherwise("")
        rows = rows.withColumn(f"_full_{c.reader}", value)
    full = [F.col(f"_full_{c.reader}") for c in compared]
    readable = reduce(lambda a, b: a & b, [F.coalesce(f"_read_{c.reader}", F.lit(False)) for c in compared])
    same = reduce(lambda a, b: a & b, [x == full[0] for x in full])
    parser = text_or_empty("wert_parser")
    agreement = F.when(~readable, "unlesbar").when(same & (full[0] != parser), "beide").otherwise("eines")
    return rows.select(
        "schl_nr", "buchseite", "feld", parser.alias("wert_parser"), *[cap_value(f"_full_{c.reader}").alias(f"wert_{c.reader}") for c in compared], text_or_empty("status_parser").alias("status_parser"), agreement.alias("einig"),
        F.lit("").alias("korrektur"), F.lit("").alias("beleg"),
    )


def review_list(streets: DataFrame, stages: DataFrame, answers: DataFrame, readers: list[str]) -> DataFrame:
    """A row for each field in which any reader differs, by agreement, key and field.

    ``einig``: beide (all readers agree against the tables), eines, or unlesbar (a reader lacks the page).
    """
    compared = [Comparison(streets, stages, answers, r) for r in readers]
    fields = reduce(DataFrame.unionByName, [c.deviations for c in compared]).distinct()
    rows = _rows(fields, streets, stages, compared)
    return rows.orderBy(*list_order())


def list_order() -> list[Column]:
    """The order of review lists: by agreement, key and field."""
    return [F.array_position(F.array(*map(F.lit, ("beide", "eines", "unlesbar"))), F.col("einig")), F.col("schl_nr"), F.col("feld")]


def full_review_list(streets: DataFrame, stages: DataFrame, answers: DataFrame, readers: list[str], keys: DataFrame, reasons: DataFrame | None = None) -> DataFrame:
    """All fields of the entries in ``keys``; readers that agree with the tables give ``keines``.

    An origin of "falsch" that nobody contradicts is left out. ``reasons`` (schl_nr, grund) fill the last column.
    """
    compared = [Comparison(streets, stages, answers, r) for r in readers]
    own = field_values(streets, stages).join(keys.select("schl_nr").distinct(), "schl_nr", "left_semi")
    fields = own.where(F.col("feld").isin(*HEAD_FIELDS) | matches("feld", r"^stadium_\d+_")).select("schl_nr", "feld")
    rows = _rows(fields, streets, stages, compared)
    values = [F.col(f"wert_{r}") for r in readers]
    default = F.col("feld").endswith("_urspruenglich") & (F.col("wert_parser") == FALSE) & (F.col("einig") != "beide") & reduce(lambda a, b: a & b, [v.isin("", FALSE) for v in values])
    equal = reduce(lambda a, b: a & b, [v == F.col("wert_parser") for v in values])
    rows = rows.where(~default).withColumn("einig", F.when((F.col("einig") == "eines") & equal, "keines").otherwise(F.col("einig")))
    grund = F.lit("").alias("grund")
    if reasons is not None:
        rows = rows.join(reasons.withColumnRenamed("grund", "_grund"), "schl_nr", "left")
        grund = text_or_empty("_grund").alias("grund")
    return rows.orderBy("buchseite", "schl_nr", field_rank("feld")).select(*[c for c in rows.columns if c != "_grund"], grund)


def agreement(c: Comparison) -> DataFrame:
    """status, feldtyp, verglichen and gleich: how often a reader has the value of the tables."""
    common = c.tables.join(c.streets.select("schl_nr").distinct(), "schl_nr", "left_semi")
    heads = common.select("schl_nr", "status", F.explode(F.array(*map(F.lit, HEAD_FIELDS))).alias("feld"))
    parts = F.array(*[F.concat(F.lit("stadium_"), F.col("stadium").cast("string"), F.lit(p)) for p in ("_datum", "_name", "_urspruenglich")])
    chains = c.table_stages.join(c.cut, "schl_nr", "left_anti").join(common.select("schl_nr", "status"), "schl_nr").select("schl_nr", "status", F.explode(parts).alias("feld"))
    fields = heads.unionByName(chains)
    whole = F.when(matches("feld", P.STAGE_FIELD) & (extract("feld", P.STAGE_FIELD, 2) != ""), F.concat(F.lit("stadium_"), extract("feld", P.STAGE_FIELD, 1)))
    wrong = c.deviations.select("schl_nr", F.col("feld").alias("_wrong"))
    hits = fields.withColumn("_try", F.explode(F.array_compact(F.array(F.col("feld"), whole)))).join(wrong, (fields["schl_nr"] == wrong["schl_nr"]) & (F.col("_try") == F.col("_wrong")), "left_semi").select("schl_nr", "feld").distinct()
    marked = fields.join(hits.withColumn("_off", F.lit(True)), ["schl_nr", "feld"], "left")
    return marked.groupBy("status", field_type("feld").alias("feldtyp")).agg(F.count(F.lit(1)).alias("verglichen"), F.count(F.when(F.col("_off").isNull(), 1)).alias("gleich"))


def reader_figures(c: Comparison) -> DataFrame:
    """One row: pages read and unread, entries, missing and extra entries, unreadable values, entries at page ends."""

    def one(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name))

    keys, own = c.tables.select("schl_nr").distinct(), c.streets.select("schl_nr").distinct()
    figures = [
        one(c.pages, "seiten_gelesen"), one(c.unread, "seiten_unlesbar"), one(own, "eintraege_modell"), one(keys.join(own, "schl_nr", "left_anti"), "eintraege_fehlend"),
        one(own.join(keys, "schl_nr", "left_anti"), "eintraege_nur_modell"), one(c.problems, "datum_nicht_normalisierbar"), one(c.last.join(keys, "schl_nr", "left_semi"), "seitenende_ausgelassen"),
    ]
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), figures)  # single rows


def _against_sample(sample: DataFrame, streets: DataFrame, stages: DataFrame) -> DataFrame:
    no = F.lower(trim_u("korrekt")) == "nein"
    truth = F.when(no, F.col("korrektur")).otherwise(F.col("wert"))
    rows = checked(sample).withColumns({"soll": truth, "fehlte": no & (trim_u(text_or_empty("wert")) == "")})
    values = field_values(streets, stages).withColumnRenamed("wert", "ist")
    return rows.join(values, ["schl_nr", "feld"], "left").withColumn("treffer", F.col("ist").eqNullSafe(F.col("soll")))


def reader_error_rates(sample: DataFrame, streets: DataFrame, stages: DataFrame) -> DataFrame:
    """ebene, gruppe, geprueft, korrekt, fehlerquote, fehlend and gefunden of a reader against checked fields.

    The truth is the correction where the verdict is "nein", else the value.
    """
    rows = _against_sample(sample, streets, stages).select(field_type("feld").alias("typ"), text_or_empty("status").alias("status"), F.col("treffer").cast("int").alias("ok"), F.col("fehlte").cast("int").alias("m"))
    sets = rows.groupingSets([["typ"], ["status"], []], "typ", "status").agg(
        F.count(F.lit(1)).alias("geprueft"), F.coalesce(F.sum("ok"), F.lit(0)).alias("korrekt"), F.coalesce(F.sum("m"), F.lit(0)).alias("fehlend"), F.coalesce(F.sum(F.col("m") * F.col("ok")), F.lit(0)).alias("gefunden"), F.grouping_id().alias("_g")
    )
    level = F.when(F.col("_g") == 1, "feldtyp").when(F.col("_g") == 2, "status").otherwise("gesamt")
    rate: Column = F.when(F.col("geprueft") > 0, (F.col("geprueft") - F.col("korrekt")) / F.col("geprueft") * 100).otherwise(0.0)
    return sets.select(level.alias("ebene"), F.coalesce("typ", "status", F.lit("")).alias("gruppe"), "geprueft", "korrekt", rate.alias("fehlerquote"), "fehlend", "gefunden")


def reader_errors(sample: DataFrame, streets: DataFrame, stages: DataFrame) -> DataFrame:
    return _against_sample(sample, streets, stages).where("not treffer").select("schl_nr", "lemma", "status", "feld", "soll", cap_value("ist").alias("ist"))


def ambiguous_keys(streets: DataFrame, sample: DataFrame) -> DataFrame:
    """Keys that a reader has more than once on the pages of a sample: no measurement against them is sound."""
    pages = sample.select(F.col("buchseite").cast("int").alias("buchseite")).distinct()
    return streets.join(pages, "buchseite", "left_semi").groupBy("schl_nr").count().where("count > 1").select("schl_nr")
