"""Plausibility of lemmas, names and fields as column predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import col, matches, trim_u


def lemma_long(c: Column | str) -> Column:
    c = col(c)
    words = F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")
    return (F.length(c) > 40) | (F.size(words) > 4)


def only_name_chars(c: Column | str) -> Column:
    return col(c).rlike(P.NAME_CHARS)


def lemma_odd_form(c: Column | str) -> Column:
    return ~col(c).rlike(r"^\p{IsUppercase}") | ~only_name_chars(c)


def sentence_end_inside(c: Column | str) -> Column:
    """A sentence that ends within a name, with a capital letter after it."""
    return matches(c, P.SENTENCE_END + r"\s*\p{IsUppercase}")


def name_odd(c: Column | str) -> Column:
    c = col(c)
    return (
        ~F.length(c).between(3, 60)
        | ~only_name_chars(c)
        | c.rlike(r"\d{5,}")
        | matches(c, P.LONE_NUMBER)
        | matches(c, P.BARE_ABBREVIATION)
        | sentence_end_inside(c)
    )


def field_long(c: Column | str) -> Column:
    return F.length(col(c)) > 60


def group_odd(c: Column | str) -> Column:
    c = col(c)
    return (F.length(c) > 150) | ~c.rlike(P.GROUP_CHARS) | c.rlike(r"\d{3,}")


def is_yes(c: Column | str) -> Column:
    return F.lower(trim_u(F.coalesce(col(c), F.lit("")))) == "ja"
