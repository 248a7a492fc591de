"""Partial dates: days, years, centuries and directed years as printed, all kept as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONTHS, Reason
from . import patterns as P
from .text import bound, captured, col, fuzzy_unique, matches, replace, text_or_empty, trim_u, unmarked


def comparable(valid_from: Column | str) -> Column:
    """A date that can be compared as text: a year stands for its last day, null for no date."""
    value = trim_u(text_or_empty(valid_from))
    return F.when(F.length(value) == 4, F.concat(value, F.lit("-12-31"))).when(value != "", value)


def display(precision: Column | str, valid_from: Column | str) -> Column:
    """The form in which a date is checked against the print."""
    precision, valid_from = col(precision), col(valid_from)
    return (
        F.when(precision == "unbekannt", F.lit("(urspr., kein Datum)"))
        .when(precision.isin("vor", "nach"), F.concat_ws(" ", precision, valid_from))
        .otherwise(valid_from)
    )


def _two(c: Column) -> Column:
    return F.lpad(c.cast("int").cast("string"), 2, "0")


def read_stamp(match: Column) -> Column:
    """Struct (gueltig_ab, praezision, hinweis, trenner) of one match of the stamp pattern, as ``captured`` gives it.

    A day or month that can't be is not guessed: the year remains, with a hint.
    """
    century, day_n, month_n, year_n, day, mark, word, year_d, directed, year_q, second_q, year_b, second_b, separator = (F.get(match, F.lit(n)) for n in range(2, 16))
    exact = F.array_position(F.array(*map(F.lit, MONTHS)), word).cast("int")
    near = F.array_position(F.array(*map(F.lit, MONTHS)), fuzzy_unique(word, MONTHS)).cast("int")

    def between(c: Column, most: int) -> Column:
        return F.coalesce(c.try_cast("int").between(1, most), F.lit(False))

    fine_n, fine_d = between(day_n, 31) & between(month_n, 12), between(day, 31)

    def read(month: Column) -> Column:
        dated = year_d != ""
        value = (
            F.when(century != "", F.lpad(((century.try_cast("int") - 1) * 100 + 1).cast("string"), 4, "0"))
            .when(year_n != "", F.when(fine_n, F.concat_ws("-", year_n, month_n, day_n)).otherwise(year_n))
            .when(dated, F.when(month.isNotNull() & fine_d, F.concat_ws("-", year_d, _two(month), _two(day.try_cast("int")))).otherwise(year_d))
            .when(directed != "", year_q)
            .otherwise(year_b)
        )
        precision = (
            F.when(century != "", "jahrhundert")
            .when((year_n != "") & fine_n | dated & month.isNotNull() & fine_d, "tag")
            .when(directed.isin("vor", "nach"), directed)
            .otherwise("jahr")
        )
        hints = F.array_compact(
            F.array(
                F.when(separator != ":", Reason.NO_COLON),
                F.when((year_n != "") & ~fine_n, Reason.DAY_INVALID),
                F.when(dated & (mark == ","), Reason.COMMA_AFTER_DAY),
                F.when(dated & (exact == 0), F.when(month.isNotNull(), Reason.MONTH_CORRECTED).otherwise(Reason.MONTH_UNREADABLE)),
                F.when(dated & month.isNotNull() & ~fine_d, Reason.DAY_INVALID),
                F.when((second_q != "") | (second_b != ""), Reason.DOUBLE_YEAR),
            )
        )
        return _stamp(value, precision, F.array_join(hints, "; "), separator)

    return bound(F.when(exact > 0, exact).when(year_d != "", near), read)


def _stamp(*values: Column) -> Column:
    return F.struct(*[v.alias(n) for v, n in zip(values, ("gueltig_ab", "praezision", "hinweis", "trenner"), strict=True)])


def partial_date(text: Column | str) -> Column:
    """:func:`read_stamp` of a whole printed date; null if it is none. An empty text is an unknown date."""
    text = trim_u(unmarked(text))
    unknown = _stamp(F.lit(""), F.lit("unbekannt"), F.lit(""), F.lit(""))
    whole = F.get(captured(text, f"^(?:{P.STAMP})$", 14), F.lit(0))
    return F.when(text == "", unknown).otherwise(bound(whole, lambda m: F.when(m.isNotNull(), read_stamp(m))))


def weak_match(match: Column, stamp: Column) -> Column:
    """As :func:`weak` for a match of the stamp pattern and what :func:`read_stamp` made of it."""
    return (stamp["trenner"] != ":") | ((stamp["praezision"] == "jahr") & (F.get(match, F.lit(10)) == ""))


def weak(stamp: Column, text: Column | str) -> Column:
    """Whether a stamp (of :func:`partial_date` on ``text``) may come from noise: no colon, or a bare year."""
    return (stamp["trenner"] != ":") | ((stamp["praezision"] == "jahr") & ~matches(trim_u(text), "^(?:vor|nach|um|etwa|gegen)"))


def place_allowed(before: Column | str) -> Column:
    """Whether a weak stamp may go on with a chain: at its start, or right after a comma or semicolon."""
    return matches(before, r"^\s*$|[,;]\s*$")


def iso_to_printed(c: Column | str) -> Column:
    return replace(c, P.ISO_DAY, "$3.$2.$1")
