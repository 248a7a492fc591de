"""Line deduplication with DataFrame functions alone.

Line hashes are range-partitioned by (hash, document) and sorted within by position, so a hash
that a third of all documents share still spreads over many partitions. A window streams the first
occurrence of each hash in each document; counts and the keeping document come from a grouped
aggregate that combines before its shuffle. Lines meet the repeated hashes where they lie if these
are frequent, else by a shuffle. The result is one small keep bitmap per document that
loses a line; texts only meet the bitmaps at the very end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import ASCII_SPACE, ascii_lower, join_counted, materialize, shuffle_partitions

#: Bits in one word of a bitmap.
WORD = 64


def line_key(line: Column) -> Column:
    """A line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _text_id(text: Column) -> Column:
    """Tells apart rows that share a doc_id but not a text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row (doc_id, text_id, keep) for each document row that loses lines.

    ``keep`` maps a word number (line position div 64) to 64 keep bits; words that are absent keep
    all their lines, so documents that lose nothing have no row. Keys of fewer than ``min_chars``
    code points, or found in fewer than ``min_docs`` distinct doc_ids, lose no line; other keys lose
    all lines except those in the largest doc_id. Rows that repeat a doc_id count as one document;
    null doc_ids count as one document that is never the largest. Null and empty texts are one
    empty line. Columns other than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    key = line_key(F.col("line"))
    lines = materialize(
        docs.select("doc_id", _text_id(F.col("text")).alias("text_id"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
        .where(F.char_length(F.btrim("line", F.lit(ASCII_SPACE))) >= min_chars)
        .select(F.xxhash64(F.lit(0), key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), "doc_id", "text_id", "pos"),
        "line-hashes",
    )
    in_doc = Window.partitionBy("h1", "h2", "doc_id").orderBy("pos")
    ranked = (
        lines.select("h1", "h2", "doc_id", "pos")
        .repartitionByRange(shuffle_partitions(spark), "h1", "h2", "doc_id")
        .withColumn("rank", F.row_number().over(in_doc))
    )
    repeated = (
        ranked.groupBy("h1", "h2")
        .agg(F.count_if(F.col("rank") == 1).alias("n_docs"), F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "n", "keeper")
    )
    dropped = join_counted(lines, materialize(repeated, "repeated-lines"), ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    words = dropped.groupBy("doc_id", "text_id", F.expr(f"cast(pos div {WORD} as int)").alias("word")).agg(
        F.expr(f"~bit_or(shiftleft(1L, pos % {WORD}))").alias("bits")
    )
    return words.groupBy("doc_id", "text_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with kept_text, n_lines (before dropping) and n_dropped; columns of these names are replaced, others stay.

    Null and empty texts are one empty line and keep it. Rows that share doc_id and text lose the same
    lines; a null doc_id is a document's id like any other. An empty table gives an empty result.
    """
    marks = bitmaps.select(F.col("doc_id").alias("_mark_doc"), F.col("text_id").alias("_mark_text"), F.col("keep").alias("_keep"))
    joined = docs.join(
        marks.hint("shuffle_hash"),
        docs["doc_id"].eqNullSafe(F.col("_mark_doc")) & (_text_id(docs["text"]) == F.col("_mark_text")),
        "left",
    )
    lines = _lines(docs["text"])

    def kept(_line: Column, i: Column) -> Column:
        bits = F.coalesce(F.element_at(F.col("_keep"), F.floor(i / WORD).cast("int")), F.lit(-1).cast("long"))
        return F.getbit(bits, i % WORD) == 1

    lost = F.aggregate(F.map_values("_keep"), F.lit(0).cast("long"), lambda n, bits: n + F.bit_count(F.bitwise_not(bits)))
    return joined.select(
        *[docs[c] for c in docs.columns if c not in ("kept_text", "n_lines", "n_dropped")],
        F.when(F.col("_keep").isNull(), F.coalesce(docs["text"], F.lit(""))).otherwise(F.array_join(F.filter(lines, kept), "\n")).alias("kept_text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.when(F.col("_keep").isNull(), F.lit(0).cast("long")).otherwise(lost).alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """doc_id, kept_text, n_lines and n_dropped of each row of ``docs`` (doc_id, text); other columns are ignored.

    Nulls, repeated rows and empty tables as in :func:`apply_bitmaps`; rows of one doc_id count as one document.
    """
    own = docs.select("doc_id", "text")
    return apply_bitmaps(own, keep_bitmaps(own, min_chars, min_docs)).drop("text")
