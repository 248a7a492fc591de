"""Answers of independent readers: JSON lists in free text, and their rows in the form of the tables.

Answers have columns reader, buchseite, prompt_hash, fehler and eintraege (the JSON list as text,
null if unreadable).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.dates import partial_date
from ..functions.text import cap_value, col, extract, joined_list, matches, reader_key, reader_text, text_or_empty, trim_u
from ..schemas import FALSE, FROM_READER, TRUE, Reason

_ENTRY = "array<struct<schl_nr string, lemma string, stadtteile string, strassenklasse string, namensgruppe string, verweis_auf string, stadien string, unvollstaendig string>>"


def json_list(answer: Column | str) -> Column:
    """The JSON list of objects in an answer, as text; null if there is none.

    What stands in a code fence comes first, then what lies between the first and last bracket.
    """
    answer = text_or_empty(answer)
    core = F.when(matches(answer, P.CODE_FENCE, "s"), extract(answer, P.CODE_FENCE, 1, "s")).otherwise(answer)
    found = extract(core, r"(\[.*\])", 1, "s")
    valid = F.try_parse_json(found)
    items = F.from_json(found, "array<string>")
    objects = F.forall(items, lambda x: F.coalesce(x.rlike(r"^\s*\{"), F.lit(False)))
    return F.when((found != "") & valid.isNotNull() & (F.coalesce(objects, F.lit(False)) | matches(found, r"^\[\s*\]$")), found)


def json_fields(c: Column | str) -> Column:
    """The fields of a JSON object with their values as text; null if the text is no such object."""
    return F.when(F.try_parse_json(col(c)).isNotNull(), F.from_json(col(c), "map<string,string>"))


def _text(c: Column) -> Column:
    """A value, or the items of a list, as one text."""
    return F.when(c.startswith("["), joined_list(F.from_json(c, "array<string>"))).otherwise(reader_text(c))


def _true(c: Column) -> Column:
    return F.coalesce(~c.isin("", "false", "0", "null", "[]", "{}"), F.lit(False))


def entries(answers: DataFrame) -> DataFrame:
    """A row for each entry of each readable page; ``seq`` follows page and place."""
    rows = answers.where("coalesce(fehler, '') <> 'unlesbar' and eintraege is not null")
    rows = rows.select("reader", F.col("buchseite").cast("int").alias("buchseite"), F.posexplode(F.from_json("eintraege", _ENTRY)).alias("pos", "e"))
    heads = [_text(F.col(f"e.{f}")).alias(f) for f in ("lemma", "stadtteile", "strassenklasse", "namensgruppe", "verweis_auf")]
    seq = F.col("buchseite").cast("long") * 1_000_000 + F.col("pos")
    key = _text(F.col("e.schl_nr"))
    return rows.select("reader", "buchseite", seq.alias("seq"), reader_key(key).alias("schl_nr"), *heads, F.lit(FROM_READER).alias("status"), _true(F.col("e.unvollstaendig")).alias("unvollstaendig"), text_or_empty("e.stadien").alias("stadien"))


def streets(answers: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    """Entries without their stages. ``parsed`` is what :func:`entries` gives, where it is there already (also below)."""
    return (parsed or entries(answers)).drop("stadien")


def _items(parsed: DataFrame) -> DataFrame:
    """A row for each item of a list of stages; numbers count items of any kind."""
    rows = parsed.where(F.col("stadien").startswith("[")).select("reader", "buchseite", "seq", "schl_nr", F.posexplode(F.from_json("stadien", "array<string>")).alias("pos", "item"))
    item = F.from_json("item", "struct<datum string, name string, urspruenglich string>")
    rows = rows.withColumns({"stadium": (F.col("pos") + 1).cast("int"), "is_object": F.coalesce(F.col("item").startswith("{"), F.lit(False)), "s": F.when(F.col("item").startswith("{"), item)})
    text = _text(F.col("s.datum"))
    rows = rows.withColumn("text", F.when(matches(text, P.ONLY_ORIGINAL, "i"), "").otherwise(text))
    return rows.withColumn("d", partial_date("text"))


def stages(answers: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    """Stages of all entries; a date that can't be read is unknown."""
    return _items(parsed or entries(answers)).where("is_object").select(
        "reader", "seq", "schl_nr", "stadium", F.coalesce("d.gueltig_ab", F.lit("")).alias("gueltig_ab"), F.coalesce("d.praezision", F.lit("unbekannt")).alias("datum_praezision"), _text(F.col("s.name")).alias("name"),
        F.when(_true(F.col("s.urspruenglich")), TRUE).otherwise(FALSE).alias("ist_urspruenglich"),
    )


def problems(answers: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    """What doesn't fit the tables: reader, schl_nr, buchseite, feld, text, grund."""
    parsed = parsed or entries(answers)
    no_list = parsed.where((F.col("stadien") != "") & ~F.col("stadien").startswith("[") & _true(F.col("stadien")))
    no_list = no_list.select("reader", "schl_nr", "buchseite", F.lit("stadien").alias("feld"), cap_value("stadien").alias("text"), F.lit(Reason.STAGES_NO_LIST).alias("grund"))
    items = _items(parsed)
    number = F.concat(F.lit("stadium_"), F.col("stadium").cast("string"))
    no_object = items.where("not is_object").select("reader", "schl_nr", "buchseite", number.alias("feld"), cap_value(text_or_empty("item")).alias("text"), F.lit(Reason.STAGES_NO_LIST).alias("grund"))
    hints = F.filter(F.split("d.hinweis", "; "), lambda h: (h != "") & (h != Reason.NO_COLON))
    reason = F.when(F.col("d").isNull(), Reason.DATE_UNREADABLE).when(F.size(hints) > 0, Reason.DATE_LIMITED)
    dates = items.where("is_object").select("reader", "schl_nr", "buchseite", F.concat(number, F.lit("_datum")).alias("feld"), cap_value("text").alias("text"), reason.alias("grund")).where("grund is not null")
    return no_list.unionByName(no_object).unionByName(dates)


def prompt_hashes(answers: DataFrame) -> DataFrame:
    """How many different prompts the answers of each reader come from."""
    own = trim_u(text_or_empty("prompt_hash"))
    return answers.groupBy("reader").agg(F.countDistinct(F.when(own != "", own)).alias("prompts"))


def missing_answers(pages: DataFrame, answers: DataFrame, reader: str, prompt_hash: str) -> DataFrame:
    """Pages without an answer of ``reader`` to the prompt with this hash."""
    done = answers.where((F.col("reader") == reader) & (F.col("prompt_hash") == prompt_hash)).select(col("buchseite"))
    return pages.join(done, "buchseite", "left_anti")
