"""Lookup of misread words in a vocabulary that is a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound

#: Words up to this length are found by what is left of them without one letter, longer ones by their halves too.
SHORT = 64


def _neighbours(word: Column) -> Column:
    """Hashes that a word shares with every word one edit away: of itself and of what is left without each of its letters.

    In longer words an edit lies behind a beginning or before an end of half of SHORT letters, which both then share;
    words of SHORT letters have both kinds of hashes.
    """

    def hashes(w: Column) -> Column:
        length = F.length(w)
        without = F.transform(F.sequence(F.lit(1), length), lambda i: F.xxhash64(F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, length))))
        short = F.when(length.between(1, SHORT), F.concat(F.array(F.xxhash64(w)), without)).when(length == 0, F.array(F.xxhash64(w)))
        ends = F.when(length >= SHORT, F.array(F.xxhash64(F.lit("begin"), F.substring(w, 1, SHORT // 2)), F.xxhash64(F.lit("end"), F.substring(w, -(SHORT // 2), SHORT // 2))))
        none = F.array().cast("array<long>")
        return F.array_distinct(F.concat(F.coalesce(short, none), F.coalesce(ends, none)))

    return bound(word, hashes)


def fuzzy_lookup(words: DataFrame, vocabulary: DataFrame, word: str, entry: str, found: str = "found") -> DataFrame:
    """``words`` with ``found``: the one entry of ``vocabulary`` at edit distance exactly 1 from ``word``, whatever the case.

    Null where none or several (distinct) entries are, and for null words. Candidates share the hash of a
    deletion neighbour and are then compared in full; nothing is collected, and each distinct word is looked up once.
    """
    asked = words.select(F.lower(word).alias("_word")).where("_word is not null").distinct()
    known = vocabulary.select(F.col(entry).alias("_entry")).where("_entry is not null").distinct()
    left = asked.select("_word", F.explode(_neighbours(F.col("_word"))).alias("_hash"))
    right = known.select("_entry", F.explode(_neighbours(F.lower("_entry"))).alias("_hash"))
    near = left.join(right, "_hash").where(F.levenshtein("_word", F.lower("_entry"), 1) == 1).select("_word", "_entry").distinct()
    one = near.groupBy("_word").agg(F.count(F.lit(1)).alias("_n"), F.min("_entry").alias(found)).where("_n = 1").select("_word", found)
    own = words.drop(found)
    return own.join(one, F.lower(own[word]) == F.col("_word"), "left").drop("_word")
