"""Correction overlay: an ordered list of guarded edits on streets and their stages.

Every guard runs before anything changes: violations of the whole list come first, and the edited
tables only if there are none. Streets and stages of a key are small; keys are independent of each
other but for renames, which come before all else.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import display, iso_to_printed, partial_date
from ..functions.text import extract, matches, replace, text_or_empty
from ..schemas import CHECKED, HEAD_FIELDS, Reason

#: What stands for the date of an added stage without one.
UNDATED = ("vorm.", "urspr.", "zuvor")
STAGE_EDIT = r"^stadium_(\d+)_(datum|name|urspruenglich)$"
#: Streets that a task sorts or holds at a time, about.
TASK_ROWS = 1 << 19


class OverlayError(ValueError):
    """Corrections that don't fit the tables; nothing was changed."""


def _dealt(streets: DataFrame) -> DataFrame:
    """``streets`` dealt by key to as many tasks as their number asks for: sizes in bytes say little of rows that are much alike."""
    parts = int(streets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return streets.repartition(max(parts, streets.count() // TASK_ROWS + 1), "schl_nr")


def _say(df: DataFrame, message: Column | str, feld: Column | str = "feld") -> DataFrame:
    message = F.lit(message) if isinstance(message, str) else message
    return df.select("schl_nr", (F.col(feld) if isinstance(feld, str) else feld).alias("feld"), message.alias("meldung"))


def renamed(streets: DataFrame, stages: DataFrame, overlay: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(streets, stages, violations) after the key changes of ``overlay``.

    A key change names its entry by lemma. Stages follow only if the old key had one entry.
    """
    asked = overlay.where("feld = 'schl_nr'").select("schl_nr", F.col("wert_alt").alias("lemma"), F.col("wert_neu").alias("_new"), "feld")
    entries = streets.groupBy("schl_nr").agg(F.count(F.lit(1)).alias("_entries"))
    hits = streets.groupBy("schl_nr", "lemma").agg(F.count(F.lit(1)).alias("_hits"))
    judged = asked.join(hits, ["schl_nr", "lemma"], "left").join(entries.select(F.col("schl_nr").alias("_new"), F.lit(True).alias("_taken")), "_new", "left")
    again = asked.groupBy("_new").agg(F.count(F.lit(1)).alias("_times"))
    judged = judged.join(again, "_new")
    wrong = (
        _say(judged.where("coalesce(_hits, 0) <> 1"), "wert_alt muss das Lemma genau eines Eintrags sein")
        .unionByName(_say(judged.where(~F.coalesce(matches("_new", r"^\d+$"), F.lit(False))), "wert_neu ist keine Schlüsselnummer"))
        .unionByName(_say(judged.where("_taken or _times > 1"), "Schlüsselnummer bereits vergeben"))
    )
    moves = asked.dropDuplicates(["schl_nr", "lemma"]).select("schl_nr", "lemma", "_new")
    own = streets.join(moves, ["schl_nr", "lemma"], "left")
    status = F.when(F.col("_new").isNotNull(), F.lit(CHECKED)).otherwise(F.col("status"))
    new_streets = own.withColumns({"schl_nr": F.coalesce("_new", "schl_nr"), "status": status}).select(*streets.columns)
    whole = moves.join(entries.where("_entries = 1"), "schl_nr").select("schl_nr", "_new")
    new_stages = stages.join(whole, "schl_nr", "left").withColumn("schl_nr", F.coalesce("_new", "schl_nr")).select(*stages.columns)
    return new_streets, new_stages, wrong


def head_values(streets: DataFrame, overlay: DataFrame) -> DataFrame:
    """Streets with the overlay's head fields and pages; one pivoted row of new values joins each street."""
    fields = [*HEAD_FIELDS, "buchseite"]
    last = [F.max_by("wert_neu", F.when(F.col("feld") == f, F.col("seq"))).alias(f"_{f}") for f in fields]
    touched = [F.max(F.col("feld") == f).alias(f"_has_{f}") for f in fields]
    new = overlay.where("feld <> 'schl_nr'").groupBy("schl_nr").agg(*last, *touched, F.lit(True).alias("_checked"))
    joined = _dealt(streets).join(new, "schl_nr", "left")
    values = {f: F.when(F.col(f"_has_{f}"), F.col(f"_{f}").cast(streets.schema[f].dataType)).otherwise(F.col(f)) for f in fields}
    values["status"] = F.when(F.col("_checked"), F.lit(CHECKED)).otherwise(F.col("status"))
    return joined.withColumns(values).select(*streets.columns)


def _added(streets: DataFrame, overlay: DataFrame) -> DataFrame:
    """Rows of new entries (field ``eintrag`` with a lemma), still without other values."""
    new = overlay.where("feld = 'eintrag' and coalesce(wert_alt, '') = '' and coalesce(wert_neu, '') <> ''").groupBy("schl_nr").agg(F.min_by("wert_neu", "seq").alias("lemma"), F.min("seq").alias("_at"))
    blanks = [F.lit("").alias(f) if f != "lemma" else F.col("lemma") for f in HEAD_FIELDS]
    row = new.select("schl_nr", *blanks, F.lit(None).cast("int").alias("buchseite"), F.lit(CHECKED).alias("status"), (F.lit(1 << 40) + F.col("_at")).alias("seq"))
    return row.select(*[F.col(c).cast(streets.schema[c].dataType) if c in row.columns else F.lit(None).cast(streets.schema[c].dataType).alias(c) for c in streets.columns])


def head_edits(streets: DataFrame, overlay: DataFrame) -> DataFrame:
    """Edits on entries, head fields and pages, after renames, with what they meet.

    ``jetzt`` is the value that an edit has to name as its old one: what the edit of this field before it
    (by ``seq``) wrote, be that one valid or not, and the table's for the first one. New entries start from an
    empty row with their lemma, wherever in the list they are made. ``eintraege`` counts the table's rows
    with the key (null: none), ``neu`` tells whether the list makes the entry, ``anlagen`` how often up to here.
    """
    present = _dealt(streets).groupBy("schl_nr").agg(F.count(F.lit(1)).alias("eintraege"), F.first("buchseite").cast("string").alias("_buchseite"), *[F.first(f).alias(f"_{f}") for f in HEAD_FIELDS])
    edits = overlay.where("feld <> 'schl_nr'").withColumns({"wert_alt": text_or_empty("wert_alt"), "wert_neu": text_or_empty("wert_neu")})
    makes = (F.col("feld") == "eintrag") & (F.col("wert_alt") == "") & (F.col("wert_neu") != "")
    made = edits.where(makes).groupBy("schl_nr").agg(F.min_by("wert_neu", "seq").alias("_made"))
    rows = edits.join(present, "schl_nr", "left").join(made, "schl_nr", "left")
    order = Window.partitionBy("schl_nr", "feld").orderBy("seq")
    written = F.when((F.col("feld") == "buchseite") & matches("wert_neu", r"^\d+$"), replace("wert_neu", r"^0+(?=\d)", "")).otherwise(F.col("wert_neu"))
    first = F.coalesce(*[F.when(F.col("feld") == f, text_or_empty(f"_{f}")) for f in (*HEAD_FIELDS, "buchseite")])
    first = F.when((F.col("feld") == "lemma") & F.col("_made").isNotNull(), F.col("_made")).otherwise(text_or_empty(first))
    columns = {"neu": F.col("_made").isNotNull(), "jetzt": F.coalesce(F.lag(written).over(order), first), "anlagen": F.sum(makes.cast("int")).over(order)}
    return rows.withColumns(columns).drop("_made", "_buchseite", *[f"_{f}" for f in HEAD_FIELDS])


def head_violations(streets: DataFrame, overlay: DataFrame) -> DataFrame:
    """Violations (schl_nr, feld, meldung) of edits on entries and head fields, after renames; see :func:`head_edits`."""
    rows = head_edits(streets, overlay)
    is_head = F.col("feld").isin(*HEAD_FIELDS, "buchseite")
    known = is_head | (F.col("feld") == "eintrag") | matches("feld", STAGE_EDIT)
    found = {
        "Schlüsselnummer nicht im Datensatz": F.col("eintraege").isNull() & ~F.col("neu"),
        "Schlüsselnummer mehrdeutig (Dublette) — nicht korrigierbar": F.col("eintraege") > 1,
        "Schlüsselnummer vorhanden — Neuanlage nicht möglich": F.expr("feld = 'eintrag' and wert_neu <> '' and wert_alt = '' and (eintraege is not null or anlagen > 1)"),
        "Bestätigung braucht leere wert_alt/wert_neu": F.expr("feld = 'eintrag' and wert_alt <> ''"),
        "unbekanntes Feld": ~known,
        "wert_alt passt nicht zum Wert der Tabelle": is_head & (F.col("jetzt") != F.col("wert_alt")),
        "wert_neu ist keine Seitenzahl": (F.col("feld") == "buchseite") & ~matches("wert_neu", r"^\d+$"),
    }
    # one pass over the edits says all of an edit's violations
    said = F.explode(F.array_compact(F.array(*[F.when(wrong, F.lit(message)) for message, wrong in found.items()])))
    edits = overlay.where("feld <> 'schl_nr'")
    makes = (F.col("feld") == "eintrag") & (text_or_empty("wert_alt") == "") & (text_or_empty("wert_neu") != "")
    pages = edits.where("schl_nr is not null").groupBy("schl_nr").agg(F.max(F.when(makes, F.col("seq"))).isNotNull().alias("_made"), F.max(F.col("feld") == "buchseite").alias("_page"))
    lacking = pages.where("_made and not _page").select("schl_nr", F.lit("eintrag").alias("feld"), F.lit("Neuanlage braucht eine buchseite-Zeile").alias("meldung"))
    return rows.select("schl_nr", "feld", said.alias("meldung")).unionByName(lacking)


def _stage_edits(overlay: DataFrame) -> DataFrame:
    """Edits on stages with their number (the largest int for what is beyond), part and the reading of a new date."""
    rows = overlay.where(matches("feld", STAGE_EDIT)).withColumns({"wert_alt": text_or_empty("wert_alt"), "wert_neu": text_or_empty("wert_neu")})
    rows = rows.withColumns({"n": F.coalesce(extract("feld", STAGE_EDIT, 1).try_cast("int"), F.lit((1 << 31) - 1)), "part": extract("feld", STAGE_EDIT, 2)})
    rows = rows.withColumn("date", F.when(F.col("part") == "datum", partial_date(iso_to_printed("wert_neu"))))
    return rows.withColumn("shown", display("date.praezision", "date.gueltig_ab"))


_STAGE_COLUMNS = ["stadium", "gueltig_ab", "datum_praezision", "name", "ist_urspruenglich"]
_EDITED = "schl_nr string, stadium int, gueltig_ab string, datum_praezision string, name string, ist_urspruenglich string, meldung string, feld string"


def edit_chain(stages: list[dict], edits: list[dict]) -> tuple[list[dict], list[tuple[str, str]]]:
    """(new stages, violations) of one key.

    Edits and deletions name places of the old list, additions places of the new one, in ascending
    order after the deletions. A later edit of a place is checked against what the earlier ones made
    of it.
    """
    wrong: list[tuple[str, str]] = []
    chain = [dict(s) for s in stages]
    dropped: dict[int, set[str]] = {}
    added: dict[int, dict[str, dict]] = {}

    def date_of(e: dict) -> tuple[str, str] | None:
        d = e["date"]
        if d is None:
            wrong.append((e["feld"], "Datum nicht normalisierbar"))
        elif any(h and h != Reason.NO_COLON for h in d["hinweis"].split("; ")):
            wrong.append((e["feld"], f"Datum nicht sauber lesbar ({d['hinweis']})"))
        else:
            return d["gueltig_ab"], d["praezision"]
        return None

    for e in edits:
        n, part, old, new = e["n"], e["part"], e["wert_alt"], e["wert_neu"]
        if n < 1:
            wrong.append((e["feld"], "Stadiumsnummer muss ≥ 1 sein"))
        elif part != "urspruenglich" and not old:
            added.setdefault(n, {})[part] = e
        elif part == "datum" and new in UNDATED:
            wrong.append((e["feld"], "nur beim Nachtragen eines undatierten Stadiums zulässig"))
        elif n > len(chain):
            wrong.append((e["feld"], "Stadium existiert nicht"))
        elif old != {"datum": chain[n - 1]["_shown"], "name": chain[n - 1]["name"], "urspruenglich": chain[n - 1]["ist_urspruenglich"]}[part]:
            wrong.append((e["feld"], "wert_alt passt nicht zum Wert der Tabelle"))
        elif part == "urspruenglich":
            if new in ("wahr", "falsch"):
                chain[n - 1]["ist_urspruenglich"] = new
            else:
                wrong.append((e["feld"], "erwartet 'wahr' oder 'falsch'"))
        elif not new:
            dropped.setdefault(n, set()).add(part)
        elif part == "name":
            chain[n - 1]["name"] = new
        elif found := date_of(e):
            chain[n - 1]["gueltig_ab"], chain[n - 1]["datum_praezision"] = found
            chain[n - 1]["_shown"] = e["shown"]
    wrong += [(f"stadium_{n}", "Streichen braucht datum UND name mit leerem wert_neu") for n, parts in dropped.items() if len(parts) < 2]
    chain = [s for n, s in enumerate(chain, 1) if n not in dropped]
    for n in sorted(added):
        parts = added[n]
        if set(parts) != {"datum", "name"} or not all(e["wert_neu"] for e in parts.values()):
            wrong.append((f"stadium_{n}", "Nachtragen braucht datum UND name mit Wert"))
            continue
        if n > len(chain) + 1:
            wrong.append((f"stadium_{n}", f"Nachtragen nur bis Position {len(chain) + 1} möglich"))
            continue
        date = parts["datum"]["wert_neu"]
        found = ("", "unbekannt") if date in UNDATED else date_of(parts["datum"])
        if found:
            chain.insert(n - 1, {"gueltig_ab": found[0], "datum_praezision": found[1], "name": parts["name"]["wert_neu"], "ist_urspruenglich": "wahr" if date == "urspr." else "falsch"})
    return [s | {"stadium": n} for n, s in enumerate(chain, 1)], wrong


def edited_stages(stages: DataFrame, overlay: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stages, violations) after the stage edits; only keys with edits leave the JVM."""
    edits = _stage_edits(overlay).select("schl_nr", "seq", "feld", "n", "part", "wert_alt", "wert_neu", "date", "shown")
    keys = edits.select("schl_nr").distinct()
    shown = stages.join(keys, "schl_nr", "left_semi").withColumn("_shown", display("datum_praezision", "gueltig_ab")).select("schl_nr", *_STAGE_COLUMNS, "_shown")

    def run(key, own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        rows = own.sort_values("stadium").to_dict("records")
        new, wrong = edit_chain(rows, asked.sort_values("seq").to_dict("records"))
        out = [(key[0], *[s[c] for c in _STAGE_COLUMNS], None, None) for s in new] + [(key[0], None, None, None, None, None, text, feld) for feld, text in wrong]
        return pd.DataFrame(out, columns=[c.split()[0] for c in _EDITED.split(", ")]).astype({"stadium": "Int32"})

    result = shown.groupBy("schl_nr").cogroup(edits.withColumnRenamed("schl_nr", "_key").groupBy("_key")).applyInPandas(run, _EDITED)
    fresh = result.where("meldung is null").select("schl_nr", *_STAGE_COLUMNS)
    rest = stages.join(keys, "schl_nr", "left_anti").select("schl_nr", F.col("stadium").cast("int").alias("stadium"), *_STAGE_COLUMNS[1:])
    return rest.unionByName(fresh), result.where("meldung is not null").select("schl_nr", "feld", "meldung")


def violations(streets: DataFrame, stages: DataFrame, overlay: DataFrame) -> DataFrame:
    """All reasons why ``overlay`` can't be applied: schl_nr, feld, meldung. Changes nothing."""
    new_streets, new_stages, wrong = renamed(streets, stages, overlay)
    return wrong.unionByName(head_violations(new_streets, overlay)).unionByName(edited_stages(new_stages, overlay)[1])


def apply(streets: DataFrame, stages: DataFrame, overlay: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(streets, stages) with all corrections; :class:`OverlayError` if any doesn't fit.

    ``streets`` and ``overlay`` carry ``seq``. Guards run first, as one small job, so nothing is
    half applied.
    """
    first = violations(streets, stages, overlay).limit(20).collect()
    if first:
        raise OverlayError("; ".join(f"{r['schl_nr']} {r['feld']}: {r['meldung']}" for r in first))
    new_streets, new_stages, _ = renamed(streets, stages, overlay)
    new_streets = head_values(new_streets.unionByName(_added(streets, overlay)), overlay)
    return new_streets, edited_stages(new_stages, overlay)[0]


def from_review(review: DataFrame, present: DataFrame, date: str, source: str = "llm-lauf") -> tuple[DataFrame, DataFrame]:
    """(new overlay rows, violations) from the filled cells of a review list.

    A whole stage takes "DATE | NAME" and becomes two rows. Rows that the overlay has already, by key,
    field and new value, are left out; of equal rows the first stays. ``review`` carries ``seq``.
    """
    rows = review.withColumns({"_value": F.trim(text_or_empty("korrektur")), "_old": text_or_empty("wert_parser")}).where("_value <> ''")
    whole = matches("feld", r"^stadium_\d+$")
    unclear = F.col("feld").startswith("stadium_?")
    message = (
        F.when((F.col("feld") == "eintrag") & (F.col("_old") == ""), "Eintrag fehlt beim Parser — nicht per Overlay behebbar")
        .when(F.col("feld") == "eintrag", "'eintrag' korrigiert man über die einzelnen Felder")
        .when(unclear, "Stadium konnte nicht eindeutig zugeordnet werden")
        .when(whole & (F.col("_old") != ""), "Parser hat das Stadium — bei Bestätigung keine Korrektur eintragen")
        .when(whole & ~F.contains("_value", F.lit("|")), "erwartet 'DATUM | NAME'")
    )
    judged = rows.withColumn("_message", message)
    both = F.split("_value", r"\|", 2)

    def cell(feld: Column, old: Column, new: Column, n: int) -> Column:
        return F.struct(feld.alias("feld"), old.alias("wert_alt"), new.alias("wert_neu"), F.lit(n).alias("n"))

    def part(name: str, n: int) -> Column:
        return cell(F.concat("feld", F.lit(f"_{name}")), F.lit(""), F.trim(F.get(both, F.lit(n))), n)

    cells = F.when(whole, F.array(part("datum", 0), part("name", 1))).otherwise(F.array(cell(F.col("feld"), F.col("_old"), F.col("_value"), 0)))
    fresh = judged.where("_message is null").select("schl_nr", "seq", text_or_empty("beleg").alias("beleg"), F.explode(cells).alias("c")).select("schl_nr", "c.*", "beleg", "seq")
    fresh = fresh.groupBy("schl_nr", "feld", "wert_neu").agg(F.min_by(F.struct("wert_alt", "beleg"), F.struct("seq", "n")).alias("x"), F.min(F.struct("seq", "n")).alias("order"))
    fresh = fresh.join(present.select("schl_nr", "feld", "wert_neu").distinct(), ["schl_nr", "feld", "wert_neu"], "left_anti")
    out = fresh.select("schl_nr", "feld", "x.wert_alt", "wert_neu", "x.beleg", F.lit(source).alias("quelle"), F.lit(date).alias("datum"), "order")
    return out, judged.where("_message is not null").select("schl_nr", "feld", F.col("_message").alias("meldung"))


def dry_run(review: DataFrame, streets: DataFrame, stages: DataFrame, present: DataFrame) -> DataFrame:
    """Violations that applying a review list's filled cells would meet; changes nothing."""
    new, wrong = from_review(review, present, "0000-00-00")
    keys = new.select("schl_nr").distinct()
    offset = 1 << 40
    listed = present.join(keys, "schl_nr", "left_semi").select("schl_nr", "feld", "wert_alt", "wert_neu", F.col("seq").cast("long").alias("seq"))
    both = listed.unionByName(new.select("schl_nr", "feld", "wert_alt", "wert_neu", (F.lit(offset) + F.col("order.seq") * 2 + F.col("order.n")).alias("seq")))
    return wrong.unionByName(violations(streets, stages, both))
