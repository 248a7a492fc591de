"""Heads of entries: key, districts, street classes, name group, and the text of the name chain.

Column expressions throughout: each marker is looked for once in a body, and what the rules need
from there on are lists of values and lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import bound, extract, fuzzy_unique, parts, replace, strip_edge, text_or_empty, trim_u, unmarked
from ..schemas import STREET_CLASSES, Reason
from .chains import chain_text

_TEXTS = "array<string>"


def _marked_values(found: Column) -> Column:
    return parts(replace(text_or_empty(found), P.FIELD_REST, ""))


def _first(body: Column, pattern: str) -> Column:
    """Struct (before, end, value) of the first match: the lengths up to its begin and end, and its group; null without one."""
    at = F.regexp_instr(body, F.lit(P.java(pattern)))
    return F.when(at > 0, F.struct((at - 1).alias("before"), (at - 1 + F.length(extract(body, pattern, 0))).alias("end"), extract(body, pattern).alias("value")))


def _found(body: Column) -> Column:
    """What the markers of a body lead to; ``marked`` and ``group`` are null without their marker."""
    return F.struct(
        body.alias("body"),
        F.replace(extract(body, P.KEY), F.lit(" "), F.lit("")).alias("digits"),
        F.length(extract(body, P.KEY, 0)).alias("key_end"),
        _marked_values(extract(body, P.DISTRICT)).alias("listed"),
        _first(body, P.CLASS).alias("marked"),
        _first(body, P.GROUP).alias("group"),
    )


def _lists(h: Column) -> Column:
    """Struct (districts, classes, bare): class values, ``bare`` if they had no marker of their own.

    Before a name group classes without a marker are the class words that the district list ends
    with, or all class words if there is no such list.
    """
    own = _marked_values(h["marked"]["value"])
    words = [F.lit(c) for c in STREET_CLASSES]
    others = F.transform(h["listed"], lambda v, i: F.when(~v.isin(STREET_CLASSES), i + 1))
    n = F.coalesce(F.array_max(others), F.lit(0))
    before_group = F.substring(h["body"], h["key_end"] + 1, h["group"]["before"] - h["key_end"])
    anywhere = F.regexp_extract_all(before_group, F.lit(P.java(r"\b(" + "|".join(STREET_CLASSES) + r")\b")), F.lit(1))
    at_end = F.filter(F.slice(h["listed"], n + 1, F.size(h["listed"])), lambda v: F.array_contains(F.array(*words), v))
    unmarked_ones = F.when(F.size(h["listed"]) == 0, anywhere).otherwise(at_end)
    bare = h["group"].isNotNull() & (F.size(own) == 0)

    def lists(classes: Column) -> Column:
        districts = F.when(bare, F.slice(h["listed"], F.lit(1), n)).otherwise(h["listed"])
        return F.struct(districts.alias("districts"), classes.alias("classes"), (bare & (F.size(classes) > 0)).alias("bare"))

    return bound(F.when(bare, unmarked_ones).otherwise(own), lists)


def _named(value: Column) -> Column:
    """Struct (name, edge, corrected): a class value without scan noise, misread by one letter at most."""

    def known(v: Column) -> Column:
        near = F.when(~v["value"].isin(STREET_CLASSES), fuzzy_unique(v["value"], STREET_CLASSES))
        return bound(near, lambda x: F.struct(F.coalesce(x, v["value"]).alias("name"), v["hint"].alias("edge"), x.isNotNull().alias("corrected")))

    return bound(strip_edge(value), known)


def _row(h: Column) -> Column:
    group = h["group"]["value"]
    tail = F.substring(h["body"], F.coalesce(h["group"]["end"], h["marked"]["end"], h["key_end"]) + 1, F.length(h["body"]))

    def row(x: Column) -> Column:
        corrected = F.when(F.exists(x["named"], lambda c: c["corrected"]), F.lit(Reason.CLASS_CORRECTED))
        hints = F.concat(F.array(F.when(x["bare"], F.lit(Reason.CLASS_NO_MARKER))), F.filter(F.transform(x["named"], lambda c: c["edge"]), lambda e: e != ""), F.array(corrected))
        return F.struct(
            F.lpad(h["digits"], 5, "0").alias("schl_nr"),
            x["districts"].cast(_TEXTS).alias("stadtteile"),
            F.transform(x["named"], lambda c: c["name"]).cast(_TEXTS).alias("strassenklassen"),
            text_or_empty(replace(trim_u(group), ",+$", "")).alias("namensgruppe"),
            bound(tail, lambda t: trim_u(chain_text(t))).alias("rest"),
            F.array_distinct(F.array_compact(hints)).alias("kopf_hinweise"),
        )

    return bound(_lists(h), lambda x: bound(F.struct(x["districts"].alias("districts"), x["bare"].alias("bare"), F.transform(x["classes"], _named).alias("named")), row))


def head(body: Column | str) -> Column:
    """Struct of the head's fields of an entry's body; null without a key of one to five digits."""
    return bound(unmarked(body), lambda b: bound(_found(b), lambda h: F.when(F.length(h["digits"]).between(1, 5), _row(h))))


def parse_heads(df: DataFrame, column: str = "rumpf") -> DataFrame:
    """``df`` with the head's fields; all null where a body has no readable key."""
    return df.withColumn("_head", head(column)).select(*df.columns, "_head.*")
