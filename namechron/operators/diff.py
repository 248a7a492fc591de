"""Comparison of two versions of streets and their stages, as one table of changes.

Columns of a change: kategorie, schl_nr, lemma, feld, stadium, alt, neu. Keys that a version holds
twice count with their last row (by ``seq``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import AUTOMATIC, DIFF_FIELDS, UNCERTAIN

KEYS = ["eintrag_neu", "eintrag_entfallen", "stadium_gewonnen", "stadium_verloren", "datum_veraendert", "name_veraendert", "kopffeld_veraendert", "status_zu_unsicher", "status_zu_automatisch"]
SIGNATURE = ["gueltig_ab", "datum_praezision", "name", "ist_urspruenglich"]


def last_wins(df: DataFrame, key: str = "schl_nr", seq: str = "seq") -> DataFrame:
    """One row for each key: the one with the largest ``seq``. An aggregate, so it combines before its shuffle."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), seq).alias("_row")).select(key, *[F.col("_row")[c].alias(c) for c in rest])


def key_changes(old: DataFrame, new: DataFrame, key: str = "schl_nr") -> DataFrame:
    """Keys with ``seite``: neu, entfallen or beide."""
    a, b = old.select(key, F.lit(1).alias("_a")).distinct(), new.select(key, F.lit(1).alias("_b")).distinct()
    side = F.when(F.col("_a").isNull(), "neu").when(F.col("_b").isNull(), "entfallen").otherwise("beide")
    return a.join(b, key, "full_outer").select(key, side.alias("seite"))


def field_changes(old: DataFrame, new: DataFrame, fields: list[str], key: str = "schl_nr") -> DataFrame:
    """key, feld, alt and neu of each field that differs in rows with the same key (unique on both sides)."""
    a = old.select(key, *[F.col(f).cast("string").alias(f"a_{f}") for f in fields])
    b = new.select(key, *[F.col(f).cast("string").alias(f"b_{f}") for f in fields])
    cells = F.array(*[F.struct(F.lit(f).alias("feld"), F.col(f"a_{f}").alias("alt"), F.col(f"b_{f}").alias("neu")) for f in fields])
    changed = F.filter(cells, lambda c: ~c["alt"].eqNullSafe(c["neu"]))
    return a.join(b, key).select(key, F.explode(changed).alias("c")).select(key, "c.*")


def unmatched(old: DataFrame, new: DataFrame, signature: list[str], order: str, keep: list[str], key: str = "schl_nr") -> DataFrame:
    """Bag difference within each key, leftovers paired in order: key, n and structs ``a``, ``b`` of ``keep``.

    Of rows with one signature as many are taken off on both sides as both have, the first ones first.
    Both sides lie in one table; a window of a signature tells a row's place on its side and how
    many the other side has, and only what is left over meets again by key. No column goes through a shuffle twice.
    """

    own = {c: f"_own_{c}" for c in [*signature, order, *keep]}
    kept = list(dict.fromkeys(own[c] for c in [order, *keep]))

    def side(df: DataFrame, is_old: bool) -> DataFrame:
        return df.select(key, *(F.col(c).alias(name) for c, name in own.items()), F.lit(is_old).alias("_old"))

    def placed(rows: DataFrame, within: list[str]) -> DataFrame:
        """``n``, the place on the own side in ``order``, and ``_others``, the rows of the other side."""
        group = Window.partitionBy(*within)
        news = F.sum((~F.col("_old")).cast("int")).over(group)
        place = F.row_number().over(group.orderBy("_old", own[order]))  # the new side comes first
        n = F.when(F.col("_old"), place - news).otherwise(place).cast("int")
        return rows.withColumns({"n": n, "_others": F.when(F.col("_old"), news).otherwise(F.count(F.lit(1)).over(group) - news)})

    left = placed(side(old, True).unionByName(side(new, False)), [key, *(own[c] for c in signature)]).where("n > _others").select(key, *kept, "_old")
    row = F.struct(*(F.col(own[c]).alias(c) for c in keep))
    a, b = (F.first(F.when(F.col("_old") == is_old, row), ignorenulls=True).alias(name) for is_old, name in ((True, "a"), (False, "b")))
    return placed(left, [key]).groupBy(key, "n").agg(a, b)


def _stage_text(s: str) -> Column:
    return F.trim(F.concat_ws(" ", f"{s}.gueltig_ab", f"{s}.name"))


def _date_text(s: str) -> Column:
    return F.concat(F.col(f"{s}.gueltig_ab"), F.lit(" ("), F.col(f"{s}.datum_praezision"), F.when(F.col(f"{s}.ist_urspruenglich") == "wahr", ", urspr.").otherwise(""), F.lit(")"))


def changes(old_streets: DataFrame, old_stages: DataFrame, new_streets: DataFrame, new_stages: DataFrame) -> DataFrame:
    """All changes from the old to the new version, in nine categories.

    The last rows of a key's two versions meet in one aggregate, stages as :func:`unmatched` pairs
    them; each pair then says all its changes as an array.
    """
    fields = F.struct(*[F.col(f).cast("string").alias(f) for f in (*DIFF_FIELDS, "status")])
    a, b = (df.select("schl_nr", fields.alias(f"_{side}"), F.col("seq").alias(f"_seq_{side}")) for df, side in ((old_streets, "a"), (new_streets, "b")))
    both = a.unionByName(b, allowMissingColumns=True).groupBy("schl_nr").agg(F.max_by("_a", "_seq_a").alias("a"), F.max_by("_b", "_seq_b").alias("b"))
    null = F.lit(None).cast("string")

    def change(when: Column, kind: str, lemma: str = "a.lemma", feld: Column = null, stadium: Column = F.lit(None), alt: Column = null, neu: Column = null) -> Column:
        row = F.struct(F.lit(kind).alias("kategorie"), F.col(lemma).alias("lemma"), feld.alias("feld"), stadium.cast("int").alias("stadium"), alt.alias("alt"), neu.alias("neu"))
        return F.when(when, row)

    def written(df: DataFrame, *cells: Column) -> DataFrame:
        return df.select("schl_nr", F.explode(F.array_compact(F.array(*cells))).alias("c")).select("c.kategorie", "schl_nr", "c.lemma", "c.feld", "c.stadium", "c.alt", "c.neu")

    paired = F.col("a").isNotNull() & F.col("b").isNotNull()

    def moved(x: str, y: str) -> Column:
        return paired & (F.col("a.status") == x) & (F.col("b.status") == y)

    entries = written(
        both,
        change(F.col("a").isNull(), "eintrag_neu", "b.lemma"),
        change(F.col("b").isNull(), "eintrag_entfallen"),
        *[change(paired & ~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), "kopffeld_veraendert", feld=F.lit(f), alt=F.col(f"a.{f}"), neu=F.col(f"b.{f}")) for f in DIFF_FIELDS],
        change(moved(AUTOMATIC, UNCERTAIN), "status_zu_unsicher"),
        change(moved(UNCERTAIN, AUTOMATIC), "status_zu_automatisch"),
    )
    common = both.where(paired).select("schl_nr", F.col("a.lemma").alias("lemma"))
    rest = unmatched(old_stages, new_stages, SIGNATURE, "stadium", ["stadium", *SIGNATURE]).join(common, "schl_nr")
    dated = [F.struct(*[F.col(f"{s}.{c}").alias(c) for c in ("gueltig_ab", "datum_praezision", "ist_urspruenglich")]) for s in "ab"]
    at = F.col("a.stadium")
    stages = written(
        rest,
        change(F.col("a").isNull(), "stadium_gewonnen", "lemma", neu=_stage_text("b")),
        change(F.col("b").isNull(), "stadium_verloren", "lemma", alt=_stage_text("a")),
        change(paired & ~dated[0].eqNullSafe(dated[1]), "datum_veraendert", "lemma", stadium=at, alt=_date_text("a"), neu=_date_text("b")),
        change(paired & ~F.col("a.name").eqNullSafe(F.col("b.name")), "name_veraendert", "lemma", stadium=at, alt=F.col("a.name"), neu=F.col("b.name")),
    )
    return entries.unionByName(stages)


def report_lines(found: DataFrame) -> DataFrame:
    """The list of a report on ``found``: a heading for each category that has changes, and a line for each change.

    rang (a category's place), kategorie, schl_nr (null for headings) and zeile; sorted by rang, schl_nr (nulls first) and zeile they are the report.
    """
    rank = F.array_position(F.array(*map(F.lit, KEYS)), F.col("kategorie")).cast("int").alias("rang")
    rest = F.concat_ws("; ", *[F.concat(F.lit(f"{c}: "), F.col(c).cast("string")) for c in ("feld", "stadium", "alt", "neu")])
    line = F.concat(F.lit("- "), "schl_nr", F.lit(" "), F.coalesce("lemma", F.lit("")), F.when(rest != "", F.concat(F.lit(" — "), rest)).otherwise(""))
    heads = found.select("kategorie").distinct().select(rank, "kategorie", F.lit(None).cast("string").alias("schl_nr"), F.concat(F.lit("## "), "kategorie").alias("zeile"))
    return heads.unionByName(found.select(rank, "kategorie", "schl_nr", line.alias("zeile")))


def deviations(found: DataFrame, old_stages: DataFrame, new_stages: DataFrame) -> DataFrame:
    """Distinct (schl_nr, feld) that :func:`changes` touch, in the field names of review lists.

    A stage that was lost or won is named by its number, or ``stadium_?`` where its text isn't found.
    """
    prefix = F.concat(F.lit("stadium_"), F.col("stadium").cast("string"))
    core = [F.replace(F.col(c), F.lit(", urspr."), F.lit("")) for c in ("alt", "neu")]
    origin = [F.contains(F.col(c), F.lit(", urspr.")) for c in ("alt", "neu")]
    kind = F.col("kategorie")
    named = F.array(
        F.when(kind.isin("eintrag_neu", "eintrag_entfallen"), "eintrag"),
        F.when((kind == "kopffeld_veraendert") & (F.col("feld") != "buchseite"), F.col("feld")),
        F.when(kind == "name_veraendert", F.concat(prefix, F.lit("_name"))),
        F.when((kind == "datum_veraendert") & (core[0] != core[1]), F.concat(prefix, F.lit("_datum"))),
        F.when((kind == "datum_veraendert") & (origin[0] != origin[1]), F.concat(prefix, F.lit("_urspruenglich"))),
    )
    out = found.select("schl_nr", F.explode(F.array_compact(named)).alias("feld"))

    def whole(kind: str, text: str, stages: DataFrame) -> DataFrame:
        places = stages.groupBy("schl_nr", F.trim(F.concat_ws(" ", "gueltig_ab", "name")).alias(text)).agg(F.min_by("stadium", F.col("stadium").cast("int")).alias("n"))
        own = found.where(F.col("kategorie") == kind).select("schl_nr", text)
        return own.join(places, ["schl_nr", text], "left").select("schl_nr", F.concat(F.lit("stadium_"), F.coalesce(F.col("n").cast("string"), F.lit("?"))).alias("feld"))

    lost, won = whole("stadium_verloren", "alt", old_stages), whole("stadium_gewonnen", "neu", new_stages)
    return out.unionByName(lost).unionByName(won).distinct()
