"""Removal of repeated word windows by level-wise doubling.

Short runs of words come first: half the window, half of that and so on down to SHORTEST. At each
level every window that is still open is stood for by one run within it, the one with the smallest
hash, so equal windows are stood for by equal runs. Windows whose run occurs at one place alone
are closed; only the others are looked at again at twice the length. At the last level the run is
the window itself, and what repeats there is removed.

Texts lie once in a table bucketed by fingerprint, one row for all exact copies; each level only
shuffles hashes and places and meets the texts where they lie.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import HOT_KEYS, join_counted, map_batches, materialize, new_path, shuffle_partitions
from ._words import WordHashes, mixed, runs, words_of

#: Runs of fewer words than this are common in any text.
SHORTEST = 8
#: Tasks among which the rows of a text with very many copies are dealt.
SALTS = 64
#: Two hashes of a run: at the last level both must agree.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def levels(window: int) -> list[int]:
    """Run lengths, each at most twice the one before it, up to ``window``."""
    out = [window]
    while out[0] > 2 * SHORTEST - 1:
        out.insert(0, -(-out[0] // 2))
    return out


def stand_ins(hashes: np.ndarray, length: int, window: int) -> np.ndarray:
    """For each window's first word the place of its run of ``length`` words with the smallest hash."""
    order = mixed(runs(hashes, length, BASES[0]))
    inside = window - length + 1
    if inside == 1 or not len(order):
        return np.arange(len(order))
    out = [np.zeros(0, np.int64)]
    for a in range(0, len(order) - inside + 1, 65536):
        part = order[a : a + 65536 + inside - 1]
        views = np.lib.stride_tricks.sliding_window_view(part, inside)
        out.append(views.argmin(axis=1) + np.arange(a, a + len(views)))
    return np.concatenate(out)


def _text_table(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of each row, and a bucketed table (node, copies, text) of the distinct word sequences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [hashlib.blake2b(b" ".join(words_of(t)), digest_size=16).digest() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(nodes, pa.binary()), batch.column("text").cast(pa.string())], names=["doc_id", "node", "text"])

    spark = docs.sparkSession
    marked = map_batches(docs.select("doc_id", "text"), run, "doc_id long, node binary, text string")
    owners = materialize(marked.select("doc_id", "node"), "nodes")
    name = f"namechron_texts_{uuid.uuid4().hex}"
    texts = marked.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
    texts.write.bucketBy(shuffle_partitions(spark), "node").option("compression", "zstd").option("path", new_path(spark, "texts")).saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the plan of ``stored`` knows files and buckets; these stay
    return owners, stored


def _with_places(texts: DataFrame, places: DataFrame | None) -> DataFrame:
    """Rows of the text table that have places, with these as an array."""
    if places is None:
        return texts.withColumn("places", F.lit(None).cast("array<int>"))
    own = places.groupBy("node").agg(F.collect_list("place").alias("places"))
    return texts.join(own.hint("shuffle_hash"), "node")


def _open_starts(hashes: np.ndarray, places: list[int] | None, length: int | None, window: int) -> np.ndarray:
    """First words of the windows whose stand-in of the level before lies at one of ``places``."""
    if length is None:
        return np.arange(max(0, len(hashes) - window + 1))
    at = stand_ins(hashes, length, window)
    hit = np.zeros(len(hashes) + 1, bool)
    hit[places] = True
    return np.flatnonzero(hit[at])


def _repeated_places(texts: DataFrame, places: DataFrame | None, before: int | None, length: int, window: int) -> DataFrame:
    """node and place of each run of ``length`` words that stands for an open window and occurs elsewhere too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows, at, first, second = [], [], [], []
            for i, (text, own) in enumerate(zip(batch.column("text").to_pylist(), batch.column("places").to_pylist(), strict=True)):
                words = hashes.of(words_of(text))
                starts = _open_starts(words, own, before, window)
                if not len(starts):
                    continue
                found = np.unique(stand_ins(words, length, window)[starts])
                rows.append(np.full(len(found), i))
                at.append(found.astype(np.int32))
                first.append(runs(words, length, BASES[0])[found])
                second.append(runs(words, length, BASES[1])[found] if length == window else np.zeros(len(found), np.uint64))
            if not rows:
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(first).view(np.int64)), pa.array(np.concatenate(second).view(np.int64)), batch.column("node").take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(at))],
                names=["h1", "h2", "node", "place"],
            )

    found = materialize(map_batches(_with_places(texts, places).select("node", "text", "places"), run, "h1 long, h2 long, node binary, place int"), f"runs-{length}")
    repeated = found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = join_counted(found, materialize(repeated, f"repeated-{length}"), ["h1", "h2"])
    return materialize(met.select("node", "place"), f"places-{length}")


def repeated_windows(texts: DataFrame, window: int) -> DataFrame:
    """node and place (first word) of each window of the text table that occurs at another place too."""
    places, before = None, None
    for length in levels(window):
        places = _repeated_places(texts, places, before, length, window)
        before = length
    return places


def kept_words(text: str | None, places: list[int], window: int, copied: bool) -> tuple[int, list[bytes]]:
    """Number of words, and the words that no window at ``places`` covers; a copied text repeats all its windows."""
    words = words_of(text)
    if copied and len(words) >= window:
        return len(words), []
    if not places:
        return len(words), words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, places, 1)
    np.add.at(edge, np.asarray(places) + window, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return len(words), [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]


def dedup_substrings(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text and kept_sha256 of each row of ``docs`` (doc_id, text).

    A word goes if a window of ``window`` words that covers it also starts anywhere else, in the
    same document or another row. Null and empty texts, and texts of fewer words, lose nothing.
    Rows that repeat a text are copies of each other, whatever their doc_id; other columns are
    ignored. Kept words are joined by one space.
    """
    owners, texts = _text_table(docs)
    found = repeated_windows(texts, window).groupBy("node").agg(F.collect_list("place").alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, hashes, kept_texts = [], [], [], []
            for text, copies, places in zip(*(batch.column(c).to_pylist() for c in ("text", "copies", "places")), strict=True):
                n, kept = kept_words(text, places or [], window, copies > 1)
                joined = b" ".join(kept)
                counts.append(n)
                removed.append(n - len(kept))
                hashes.append(hashlib.sha256(joined).hexdigest())
                kept_texts.append(joined.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept_texts, pa.string()), pa.array(hashes, pa.string())],
                names=["node", "n_words", "n_removed", "kept_text", "kept_sha256"],
            )

    marked = texts.join(found.hint("shuffle_hash"), "node", "left")
    results = map_batches(marked.select("node", "text", "copies", "places"), run, "node binary, n_words long, n_removed long, kept_text string, kept_sha256 string")
    return _to_owners(owners, results, texts.select("node", "copies"))


def _to_owners(owners: DataFrame, results: DataFrame, copies: DataFrame) -> DataFrame:
    """The result of each row's text. Results of texts with a HOT_KEYS-th of all rows are dealt to SALTS tasks."""
    total = copies.agg(F.sum("copies")).first()[0] or 0
    hot = F.broadcast(copies.where(F.col("copies") * HOT_KEYS >= total).select("node", F.lit(True).alias("hot")))  # at most HOT_KEYS rows
    salted = owners.join(hot, "node", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.spark_partition_id(), F.lit(SALTS))).otherwise(0)).drop("hot")
    every = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = results.join(hot, "node", "left").withColumn("salt", F.explode(every)).drop("hot")
    return salted.join(dealt, ["node", "salt"]).drop("node", "salt")
