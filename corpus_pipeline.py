"""Corpus pipeline: language ID, line dedup, near-dedup, benchmark decontamination, tokenization.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; its result is
written as Parquet and read again as the next stage's ``docs``. All stages but the last return the
columns of documents; other columns of ``docs`` are left out. Null texts hold no letter, so the first stage drops them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namechron.llm._common import delete, materialize, scratch, table
from namechron.llm.byte_bpe import bpe_digests
from namechron.llm.decontamination import with_items
from namechron.llm.language_id import UNDETERMINED, fit, predict
from namechron.llm.line_dedup import apply_bitmaps, keep_bitmaps
from namechron.llm.near_dedup import near_duplicates
from namechron.llm.queries import BPE_RANKS

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text whose best language is less likely than this is in none of the learned languages.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; texts without a letter (null and empty ones too) go, and those of no clear language.

    Where nothing can be learned, as no row with a language may be learned from, no language can be told
    from another: then every text with a letter stays. Repeated rows stay or go alike; an empty table stays empty.
    """
    net = fit(docs)
    if net is None:
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    kept = predict(docs, net).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that other documents repeat; a document that loses all its lines goes.

    n_chars follows the new text.
    """
    kept = apply_bitmaps(docs, keep_bitmaps(docs))
    whole = kept.where(F.col("n_dropped") < F.col("n_lines"))
    return whole.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.char_length("kept_text").cast("long").alias("n_chars"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity of 0.8): the smallest doc_id.

    Rows that repeat a doc_id stay if it is kept for any of their texts; equal rows leave one row.
    """
    kept = near_duplicates(docs, words=5, percent=80).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    own = docs.select(*COLUMNS)
    met = own.join(kept.hint("shuffle_hash"), own["doc_id"].eqNullSafe(F.col("kept_id")), "left_semi")
    return met.dropDuplicates(["doc_id", "text"])


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark table within its edit budget.

    Null and empty texts hold none and stay; repeated rows stay or go alike; null items are never found.
    """
    return with_items(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")).where("size(contaminated_by) = 0").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text of every document that is left.

    Null and empty texts have no tokens; repeated rows give repeated results; a null doc_id stays null.
    """
    return bpe_digests(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("benchmark", benchmark), ("tokens", tokens)]

#: Neither the network nor the tokenizer can be put as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again.

    What a stage stored for itself goes when its result is written, and that when the next one is.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with scratch(spark) as made:
            docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
            result = made.pop()  # the path made last
        delete(spark, before)
        before = [result]
    return docs
