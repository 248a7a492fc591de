"""Entries of a volume: key anchors with the lemma before and the body after them, across pages.

A volume's text is its pages in order, with a space between them; a place in it is an offset. Only
rows of places cross pages: anchors are found page by page, running values over blocks of them say
where each one's lead and body begin and end, and the texts of these spans come from the pages they lie on, by an
equi-join on blocks of offsets. So the pages of one volume are read and cut by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import extract, matches, replace, text_or_empty, trim_u
from ..schemas import Reason
from ..sources.storage import materialize
from .ranks import added, running

#: Following pages that an anchor can reach into, and characters of them that are looked at.
SEAM_PAGES, SEAM = 3, 64
#: Characters before an anchor that hold its lemma (60 at most, with its separators), and those that a rejected one shows.
LEAD, SHOWN = 160, 80
#: Offsets of a block, and pages of one.
BLOCK, PAGES = 1 << 16, 1 << 10


def located_pages(pages: DataFrame) -> DataFrame:
    """volume, page, text, start (its offset), length and seam (what follows it) of each page.

    A null text is empty. Rows that repeat a page of a volume are one page, with the largest text.
    Offsets are running sums over blocks of pages; each page hands its first characters to those before it.
    """
    texts = pages.groupBy("volume", "page").agg(F.max(text_or_empty("text")).alias("text"))
    light = texts.select("volume", "page", F.char_length("text").alias("length"), F.substring("text", 1, SEAM).alias("head"))
    sums = {"start": (F.sum, (F.col("length") + 1).cast("long"), added), "place": (F.sum, F.lit(1).cast("long"), added)}
    placed = running(light, ["volume"], [F.floor(F.col("page") / PAGES)], ["page"], sums)
    handed = placed.select("volume", F.explode(F.sequence(F.col("place") - SEAM_PAGES, F.col("place") - 1)).alias("to"), F.struct("place", "head").alias("h"))
    seams = handed.groupBy(F.col("volume").alias("_volume"), "to").agg(F.substring(F.array_join(F.array_sort(F.collect_list("h"))["head"], " "), 1, SEAM).alias("seam"))
    sewn = placed.join(seams, F.col("volume").eqNullSafe(F.col("_volume")) & (F.col("place") == F.col("to")), "left")
    here = sewn.select(F.col("volume").alias("_volume"), F.col("page").alias("_page"), "start", "length", F.coalesce("seam", F.lit("")).alias("seam"))
    same = F.col("volume").eqNullSafe(F.col("_volume")) & F.col("page").eqNullSafe(F.col("_page"))
    return texts.join(here, same).select("volume", "page", "text", "start", "length", "seam")


def _blocks(begin: Column, end: Column, name: str = "block") -> Column:
    return F.explode(F.sequence(F.floor(begin / BLOCK), F.floor(F.greatest(begin, end - 1) / BLOCK))).alias(name)


def span_texts(spans: DataFrame, located: DataFrame) -> DataFrame:
    """``spans`` (volume, id, begin, end, ...; id is unique in a volume) with ``text``: what stands from begin up to end; empty for an empty span.

    The other columns travel with the spans, so that these are derived once.
    """
    size = F.col("length") + 1
    on_pages = located.select(F.col("volume").alias("_volume"), F.col("start").alias("_start"), (F.col("start") + size).alias("_stop"), F.concat("text", F.lit(" ")).alias("_text"), _blocks(F.col("start"), F.col("start") + size, "_at"))
    wanted = spans.select("*", _blocks(F.col("begin"), F.col("end"), "_block"))
    first, last = F.greatest("begin", "_start"), F.least("end", "_stop")
    here = F.col("volume").eqNullSafe(F.col("_volume")) & (F.col("_block") == F.col("_at")) & (first < last) & (F.floor(first / BLOCK) == F.col("_block"))
    piece = F.substring(F.col("_text"), (first - F.col("_start") + 1).cast("int"), (last - first).cast("int"))
    pieces = F.collect_list(F.when(F.col("_start").isNotNull(), F.struct("_start", piece.alias("piece"))))
    rest = [F.first(c).alias(c) for c in spans.columns if c not in ("volume", "id")]
    found = wanted.join(on_pages, here, "left").groupBy("volume", "id").agg(*rest, F.sort_array(pieces).alias("_pieces"))
    return found.withColumn("text", F.array_join(F.col("_pieces.piece"), "")).drop("_pieces")


def pages_at(points: DataFrame, located: DataFrame) -> DataFrame:
    """``points`` (volume, id, place) with the page that each place lies on; the space after a page belongs to it."""
    size = F.col("length") + 1
    on_pages = located.select(F.col("volume").alias("_volume"), "page", "start", (F.col("start") + size).alias("stop"), _blocks(F.col("start"), F.col("start") + size, "_block"))
    here = F.col("volume").eqNullSafe(F.col("_volume")) & (F.floor(F.col("place") / BLOCK) == F.col("_block")) & (F.col("place") >= F.col("start")) & (F.col("place") < F.col("stop"))
    return points.join(on_pages, here).drop("_volume", "start", "stop", "_block")


def _before(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (volume, begin, end, ...) with ``name``: the end of the row before in its volume, null for the first one."""
    last = {name: (F.max, F.struct("begin", "end"), F.greatest)}
    return running(rows, ["volume"], [F.floor(F.col("begin") / BLOCK)], ["begin", "end"], last).withColumn(name, F.col(name)["end"])


def anchors(located: DataFrame) -> DataFrame:
    """volume, begin, end and mark of each key anchor, with ``after``, the end of the one before.

    The lengths of a page's marks and of what lies between them are summed up once, in a window of narrow rows.
    """
    seen = F.concat_ws(" ", "text", F.when(F.col("seam") != "", F.col("seam")))
    gaps, marks = F.transform(F.split(seen, P.java(P.ANCHOR), -1), F.char_length), F.regexp_extract_all(seen, F.lit(P.java(P.ANCHOR)), F.lit(0))
    pieces = located.select("volume", "page", "start", "length", F.posexplode(F.arrays_zip(gaps.alias("gap"), marks.alias("mark"))).alias("n", "x")).select("*", "x.gap", "x.mark").where("mark is not null")
    before = Window.partitionBy("volume", "page").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(F.col("gap") + F.char_length("mark")).over(before), F.lit(0)) + F.col("gap")
    placed = pieces.withColumn("inside", inside).where(F.col("inside") <= F.col("length"))  # others belong to a later page
    rows = placed.select("volume", (F.col("start") + F.col("inside")).alias("begin"), (F.col("start") + F.col("inside") + F.char_length("mark")).alias("end"), "mark")
    # a page's scan can find the rest of an anchor that begins on the page before
    alone = _before(materialize(rows, "marks"), "_last").where("_last is null or begin >= _last").drop("_last")
    return _before(alone, "after").withColumn("after", F.coalesce("after", F.lit(0)))


def segment_volumes(pages: DataFrame) -> DataFrame:
    """Rows of kind entry or rejected from (volume, page, text): volume, seq, lemma_roh, rumpf, buchseite, hinweise.

    An anchor with a lemma before it begins an entry, whose body ends where the next one's lemma
    begins; other anchors are rejected and show what stands before them. Entries come first. Located pages and anchors are stored; everything that crosses pages
    is counted on rows of places, before bodies are read.
    """
    located = materialize(located_pages(pages), "pages")
    found = anchors(located).withColumns({"id": F.col("begin"), "body_begin": F.col("end")})
    before = found.withColumns({"begin": F.greatest("after", F.col("begin") - LEAD), "end": F.col("begin")})
    read = span_texts(before, located).withColumnRenamed("text", "lead").withColumns({"raw": extract("lead", P.LEMMA), "at": F.regexp_instr(F.col("lead"), F.lit(P.java(P.LEMMA)))})
    blank = F.char_length("raw") - F.char_length(replace("raw", r"^\s+", ""))
    is_entry = F.col("at") > 0
    read = read.select("volume", "id", F.when(is_entry, "entry").otherwise("rejected").alias("kind"), F.when(is_entry, F.col("begin") + F.col("at") - 1 + blank).otherwise(F.col("id")).alias("place"), "lead", "raw", "mark", "body_begin")
    read = materialize(read, "anchors")
    # the volume's end stands for an entry after the last one
    ends = located.groupBy("volume").agg(F.max(F.col("start") + F.col("length")).alias("place")).select("volume", F.lit(None).cast("long").alias("id"), F.lit("entry").alias("kind"), "place")
    block = F.floor(F.col("place") / BLOCK)
    following = {"next": (F.min, F.when(F.col("kind") == "entry", F.col("place")), F.least)}
    ended = running(read.unionByName(ends, allowMissingColumns=True).withColumn("_id", F.coalesce("id", F.lit((1 << 63) - 1))), ["volume"], [block], ["place", "_id"], following, falling=True).where("id is not null")
    numbered = running(ended, ["volume"], [F.col("kind"), block], ["kind", "place", "id"], {"seq": (F.sum, F.lit(1).cast("long"), added)})
    bodies = pages_at(numbered, located).withColumns({"begin": F.col("body_begin"), "end": F.when(F.col("kind") == "entry", F.col("next")).otherwise(F.col("body_begin"))})
    whole, is_entry = span_texts(bodies, located), F.col("kind") == "entry"
    none = F.array().cast("array<string>")
    hints = F.when(~is_entry | matches(replace("mark", r"\s+", ""), P.ANCHOR_KNOWN), none).otherwise(F.array(F.lit(Reason.ANCHOR_CORRECTED)))
    shown = F.concat(F.substring("lead", -SHOWN, SHOWN), "mark")
    body = trim_u(F.when(is_entry, F.col("text")).otherwise(shown)).alias("rumpf")
    return whole.select("volume", F.col("seq").cast("int").alias("seq"), "kind", F.when(is_entry, trim_u("raw")).otherwise("").alias("lemma_roh"), body, F.col("page").cast("int").alias("buchseite"), hints.alias("hinweise"))
