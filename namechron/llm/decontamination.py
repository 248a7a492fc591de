"""Benchmark decontamination by pigeonhole edit matching.

A test item with an error budget of e edits falls into e + 1 pieces: wherever it stands with at
most e edits, one piece stands there unchanged. An Aho-Corasick automaton finds all pieces in a
document in one pass; around each hit Myers's bit-parallel algorithm gives the exact distance.
Items lie in the shared folder in blocks; a task loads one block, and the driver holds none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import map_batches, new_path

#: Characters of test items that one pass over the documents looks for; more items take more passes.
BLOCK_CHARS = 4_000_000
_NOT_WORD = re.compile(r"[\W_]+")


def normalized(text: str | None) -> str:
    """Lower case, with one space for each run of characters other than letters and digits."""
    return _NOT_WORD.sub(" ", (text or "").lower()).strip()


def budget(item: str, error_rate: float, shortest: int = 0) -> int:
    """Edits that an item is allowed: ``error_rate`` of its length; none for items of fewer than ``shortest`` characters."""
    return int(len(item) * error_rate) if len(item) >= shortest else 0


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece) of ``edits`` + 1 pieces whose lengths differ by one at most."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(item: str) -> dict[str, int]:
    """For each character the bits of its places in ``item``."""
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def distance_within(item_masks: dict[str, int], length: int, text: str) -> int:
    """Smallest edit distance between the item and any part of ``text``, the empty one included."""
    full, last = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score, best = full, 0, length, length
    for c in text:
        equal = item_masks.get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up, down = (minus | ~(horizontal | plus)) & full, plus & horizontal
        if up & last:
            score += 1
        elif down & last:
            score -= 1
            best = min(best, score)
        up, down = up << 1 & full, down << 1 & full
        plus, minus = (down | ~(vertical | up)) & full, up & vertical
    return best


class Matcher:
    """Finds which of ``items`` (id, normalized text) a document holds."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float, shortest: int):
        import ahocorasick

        self.items = [(i, f" {t} " if not budget(t, error_rate, shortest) else t) for i, t in items if t]
        self.edits = [budget(t, error_rate, shortest) if not t.startswith(" ") else 0 for _, t in self.items]
        self.masks: dict[int, dict[str, int]] = {}
        at: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text) in enumerate(self.items):
            for offset, piece in pieces(text, self.edits[n]):
                at.setdefault(piece, []).append((n, offset + len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, places in at.items():
            self.automaton.add_word(piece, places)
        if at:
            self.automaton.make_automaton()
        self.empty = not at

    def find(self, text: str | None) -> list[tuple[int, int]]:
        """(item id, smallest distance) of each item within its budget, by item id."""
        if not text or self.empty:
            return []
        text = f" {normalized(text)} "
        spans: dict[int, list[tuple[int, int]]] = {}
        for end, places in self.automaton.iter(text):
            for n, offset in places:
                begin, edits = end + 1 - offset, self.edits[n]
                span = (begin - edits, begin + len(self.items[n][1]) + edits)
                own = spans.setdefault(n, [])
                if own and span[0] <= own[-1][1] and span[0] >= own[-1][0] - 2 * edits:
                    own[-1] = (min(own[-1][0], span[0]), max(own[-1][1], span[1]))
                else:
                    own.append(span)
        best: dict[int, int] = {}
        for n, own in spans.items():
            item_id, item = self.items[n]
            for a, b in own:
                part = text[max(0, a) : b]
                if item in part:
                    found = 0
                elif not self.edits[n]:
                    continue
                else:
                    found = distance_within(self.masks.setdefault(n, masks(item)), len(item), part)
                if found <= self.edits[n]:
                    best[item_id] = min(best.get(item_id, found), found)
        return sorted(best.items())


def _stored_items(benchmark: DataFrame) -> tuple[str, int]:
    """A folder of the shared storage with items in blocks of about BLOCK_CHARS characters, and the number of blocks."""
    held = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    total = held.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_CHARS)
    path = new_path(benchmark.sparkSession, "items")
    if blocks:
        block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block")
        held.select(F.col("item_id").cast("long").alias("item_id"), "text", block).repartition("block").write.partitionBy("block").option("compression", "zstd").parquet(path)
    return path, blocks


def _load_items(path: str, block: int) -> list[tuple[int, str]]:
    """A block's distinct items, normalized; read by the task that looks for them."""
    store, inside = fs.FileSystem.from_uri(f"{path}/block={block}")
    if store.get_file_info(inside).type == fs.FileType.NotFound:
        return []
    rows = pq.read_table(inside, filesystem=store, columns=["item_id", "text"], partitioning=None).to_pylist()
    return sorted({(r["item_id"], normalized(r["text"])) for r in rows})


def with_items(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.05, shortest: int = 0, column: str = "contaminated_by") -> DataFrame:
    """``docs`` with an array of (item_id, n_edits) of the items found in each whole text.

    An item of ``benchmark`` (item_id, text) is found if some part of the text is within
    ``error_rate`` of its length in edits, both normalized; items too short for an edit, and those of
    fewer than ``shortest`` characters, must stand there exactly, as whole words. Items that are null, or hold no letter or
    digit, are never found; null and empty texts hold none. Items with one id count as one, with
    the smaller distance. A column of ``docs`` that is named ``column`` is replaced.
    """
    kind = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("n_edits", T.IntegerType())]))
    out = docs.withColumn(column, F.array().cast(kind))
    path, blocks = _stored_items(benchmark)
    for block in range(blocks):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(_load_items(path, block), error_rate, shortest)
            for batch in batches:
                at = batch.schema.get_field_index(column)
                found = []
                for text, before in zip(batch.column("text").to_pylist(), batch.column(column).to_pylist(), strict=True):
                    best = {x["item_id"]: x["n_edits"] for x in before}
                    for item_id, edits in matcher.find(text):
                        best[item_id] = min(best.get(item_id, edits), edits)
                    found.append([{"item_id": i, "n_edits": n} for i, n in sorted(best.items())])
                yield batch.set_column(at, batch.schema.field(at), pa.array(found, batch.schema.field(at).type))

        out = map_batches(out, run, out.schema)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.05, shortest: int = 0) -> DataFrame:
    """doc_id, item_id and n_edits: a row for each document and item found in it; see :func:`with_items`."""
    found = with_items(docs.select("doc_id", "text"), benchmark, error_rate, shortest, "found").select("doc_id", F.explode("found").alias("x"))
    return found.select("doc_id", F.col("x.item_id").alias("item_id"), F.col("x.n_edits").alias("n_edits"))
