"""Ranked lexical search by block-max pruning.

An index row is a block: a range of documents as they lie in the table, with its forward index
(the impact of each of a document's terms, as compressed rows over the block's own terms) and, for
each term, the largest impact in the block and the number of documents that hold it. Impacts
depend on the corpus's size and mean length, so these are counted first; weights of terms belong to
the query. The bound of a block for an item is the sum of weight times largest impact.

1. Document frequencies of the items' terms are summed over the blocks.
2. Every task reports each item's SEEDS blocks of the largest bounds; the best of all tasks are
   scored, and the k-th score is the item's threshold.
3. Every task takes the blocks of a batch by falling bound and scores those whose bound isn't below
   the threshold, which rises with the task's own scores. At most k documents for an item and
   task go on.

Nothing is shuffled but these reports. Items are taken in blocks of bounded size, so what is
broadcast (their terms, weights and thresholds) is bounded too.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import map_batches, materialize

#: Documents of a block, and terms of its documents from which on it is closed.
BLOCK_DOCS, BLOCK_ENTRIES = 64, 1 << 16
#: Blocks of a file of the index; a task that reads or writes one holds them all.
FILE_BLOCKS = 64
#: Characters of the items that are searched for at a time, on average.
ITEM_CHARS = 2_000_000
#: Blocks of each item that are scored for its first threshold.
SEEDS = 8
#: Bytes that belong to terms, A-Z lower-cased; all others become spaces. Bytes beyond ASCII stay.
_TABLE = bytes(ord(chr(b).lower()) if chr(b).isalnum() and b < 128 else b if b >= 128 else 32 for b in range(256))

INDEX = "block long, doc_ids array<long>, terms array<string>, best array<long>, df array<int>, starts array<int>, idx array<int>, impact array<long>"


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, in order."""
    return (text or "").encode().translate(_TABLE).split()


@dataclass(frozen=True)
class LexicalIndex:
    """A stored index: its blocks, its documents with a term, and these documents' terms."""

    blocks: DataFrame
    n_docs: int
    n_terms: int


class _Block:
    def __init__(self, most: int):
        self.most = most
        self.ids: list[int] = []
        self.own: dict[bytes, int] = {}
        self.starts, self.idx, self.tf, self.norms = [0], [], [], []

    def add(self, doc_id: int, words: list[bytes], norm: int) -> None:
        counts, own = Counter(words), self.own
        self.ids.append(doc_id)
        self.idx += [own.setdefault(t, len(own)) for t in counts]
        self.tf += counts.values()
        self.starts.append(len(self.idx))
        self.norms.append(norm)

    @property
    def full(self) -> bool:
        return len(self.ids) >= self.most or len(self.idx) >= BLOCK_ENTRIES

    def row(self) -> tuple:
        idx, tf = np.array(self.idx, np.int32), np.array(self.tf, np.int64)
        norms = np.repeat(np.array(self.norms, np.int64), np.diff(self.starts))
        impact = 1_000_000_000 * tf // (1000 * tf + 20 * norms)
        best = np.zeros(len(self.own), np.int64)
        np.maximum.at(best, idx, impact)
        return self.ids, [t.decode() for t in self.own], best, np.bincount(idx, minlength=len(self.own)), self.starts, idx, impact


def build_index(docs: DataFrame, block_docs: int = BLOCK_DOCS) -> LexicalIndex:
    """The index of all rows of ``docs`` (doc_id, text), each a document of its own, at most ``block_docs`` in a block.

    Rows without a doc_id take no part; null and empty texts, and texts without a term, aren't
    counted and never found; other columns are ignored.
    """
    own = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = total = 0
        for batch in batches:
            sizes = [len(terms_of(t)) for t in batch.column("text").to_pylist()]
            n, total = n + sum(s > 0 for s in sizes), total + sum(sizes)
        yield pa.RecordBatch.from_pydict({"n": [n], "total": [total]})

    n_docs, n_terms = map_batches(own.select("text"), count, "n long, total long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        block = _Block(block_docs)
        names = [f.split()[0] for f in INDEX.split(", ")]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64())]

        def out() -> pa.RecordBatch:
            nonlocal number, block
            row, block, number = (number, *block.row()), _Block(block_docs), number + 1
            return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if words := terms_of(text):
                    block.add(doc_id, words, 50 + 50 * len(words) * n_docs // n_terms)
                    if block.full:
                        yield out()
        if block.ids:
            yield out()

    return LexicalIndex(materialize(map_batches(own, build, INDEX), "lexical-index", FILE_BLOCKS), n_docs, n_terms)


class Queries:
    """Items of one block as arrays over their own vocabulary."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.ids = np.array([i for i, _ in items], np.int64)
        self.terms = sorted({t for _, ts in items for t in ts})
        number = {t: n for n, t in enumerate(self.terms)}
        self.starts = np.cumsum([0, *(len(ts) for _, ts in items)])
        self.held = np.array([number[t] for _, ts in items for t in ts], np.int64)
        self.weights = np.zeros(len(self.terms), np.int64)
        self.least = np.ones(len(items), np.int64)  # scores above 0 alone count
        self.vocabulary = None

    def weigh(self, df: dict[int, int], n_docs: int) -> None:
        for t, n in df.items():
            self.weights[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))

    def places(self, terms: pa.Array) -> np.ndarray:
        """Number of each term in the vocabulary, -1 for others."""
        if self.vocabulary is None:
            self.vocabulary = pa.array(self.terms, pa.string())
        return pc.fill_null(pc.index_in(terms, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def weighted(self, best: np.ndarray) -> np.ndarray:
        """The bound of each item, given the largest impact of each vocabulary term."""
        sums = np.concatenate([[0], np.cumsum((self.weights * best)[self.held])])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def matrix(self, items: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Weights of ``columns`` (terms) for ``items``: a column for each item."""
        at = np.full(len(self.terms), -1, np.int64)
        at[columns] = np.arange(len(columns))
        sizes = (self.starts[1:] - self.starts[:-1])[items]
        place = np.repeat(self.starts[items] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        row, column = at[self.held[place]], np.repeat(np.arange(len(items)), sizes)
        # Sums below 2^53 are exact in doubles, whose products are much faster.
        kind = np.float64 if len(columns) * float(self.weights.max(initial=0)) * 1e6 < 2**53 else np.int64
        out = np.zeros((len(columns), len(items)), kind)
        out[row[row >= 0], column[row >= 0]] = self.weights[self.held[place]][row >= 0]
        return out


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and where each row's begin and the last one's end."""
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


class _Blocks:
    """The blocks of a batch with their bounds for each item."""

    def __init__(self, batch: pa.RecordBatch, queries: Queries):
        self.queries = queries
        terms = batch.column("terms")
        self.ends = terms.offsets.to_numpy() - terms.offsets.to_numpy()[0]
        self.places = queries.places(terms.flatten())
        self.best, _ = _lists(batch.column("best"))
        self.bounds = np.zeros((batch.num_rows, len(queries.ids)), np.int64)
        for b in range(batch.num_rows):
            at, held = self.places[self.ends[b] : self.ends[b + 1]], self.best[self.ends[b] : self.ends[b + 1]]
            best = np.zeros(len(queries.terms), np.int64)
            best[at[at >= 0]] = held[at >= 0]
            self.bounds[b] = queries.weighted(best)

    def forward(self, batch: pa.RecordBatch) -> _Blocks:
        self.ids, self.id_ends = _lists(batch.column("doc_ids"))
        self.starts, self.start_ends = _lists(batch.column("starts"))
        self.idx, self.idx_ends = _lists(batch.column("idx"))
        self.impact, _ = _lists(batch.column("impact"))
        return self

    def scores(self, b: int, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """doc_ids of block ``b`` and their scores for ``items``."""
        at = self.places[self.ends[b] : self.ends[b + 1]]
        columns = np.full(len(at), -1, np.int64)
        columns[at >= 0] = np.arange((at >= 0).sum())
        span = slice(self.idx_ends[b], self.idx_ends[b + 1])
        column, impact = columns[self.idx[span]], self.impact[span]
        ids = self.ids[self.id_ends[b] : self.id_ends[b + 1]]
        doc = np.repeat(np.arange(len(ids)), np.diff(self.starts[self.start_ends[b] : self.start_ends[b + 1]]))
        weights = self.queries.matrix(items, at[at >= 0])
        impacts = np.zeros((len(ids), len(weights)), weights.dtype)
        impacts[doc[column >= 0], column[column >= 0]] = impact[column >= 0]
        return ids, (impacts @ weights).astype(np.int64)


class _Best:
    """The k best documents of each item so far, equal scores by doc_id."""

    def __init__(self, least: np.ndarray, k: int):
        self.least, self.k = least.copy(), k
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, item: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if item in self.held:
            ids, scores = np.concatenate([self.held[item][0], ids]), np.concatenate([self.held[item][1], scores])
        order = np.lexsort((ids, -scores))[: self.k]
        self.held[item] = ids[order], scores[order]
        if len(order) == self.k:
            self.least[item] = max(self.least[item], self.held[item][1][-1])

    def take(self, blocks: _Blocks, b: int, items: np.ndarray) -> None:
        ids, scores = blocks.scores(b, items)
        good = scores >= self.least[items]
        for j in np.flatnonzero(good.any(axis=0)).tolist():
            self.add(int(items[j]), ids[good[:, j]], scores[good[:, j], j])

    def rows(self, item_ids: np.ndarray) -> pa.RecordBatch:
        held = sorted(self.held.items())
        sizes = [len(ids) for _, (ids, _) in held]
        columns = [np.repeat(item_ids[[i for i, _ in held]], sizes) if held else [], *(np.concatenate([x[c] for _, x in held]) if held else [] for c in range(2))]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])


def _best_of_tasks(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _search_block(index: LexicalIndex, items: list[tuple[int, list[str]]], k: int) -> DataFrame:
    spark, queries = index.blocks.sparkSession, Queries(items)
    terms = spark.sparkContext.broadcast(queries)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = terms.value
        sums = np.zeros(len(own.terms), np.int64)
        for batch in batches:
            at = own.places(batch.column("terms").flatten())
            np.add.at(sums, at[at >= 0], batch.column("df").flatten().to_numpy()[at >= 0])
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(sums)), pa.array(sums[sums > 0])], names=["term", "df"])

    df = map_batches(index.blocks.select("terms", "df"), count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    queries.weigh({r["term"]: r["df"] for r in df.toLocalIterator()}, index.n_docs)  # at most a row for each of the items' terms
    weighted = spark.sparkContext.broadcast(queries)

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = weighted.value
        best = _Best(own.least, SEEDS)
        for batch in batches:
            bounds, numbers = _Blocks(batch, own).bounds, batch.column("block").to_numpy()
            for i in np.flatnonzero((bounds >= best.least).any(axis=0)).tolist():
                good = bounds[:, i] >= best.least[i]
                best.add(i, numbers[good], bounds[good, i])
        yield best.rows(own.ids)

    found = map_batches(index.blocks.select("block", "terms", "best"), seeds, "item_id long, doc_id long, score long")
    first = materialize(_best_of_tasks(found, SEEDS).select("item_id", F.col("doc_id").alias("block")), "seed-blocks")

    def score(rows: DataFrame, known) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = known.value
            best = _Best(own.least, k)
            for batch in batches:
                blocks = _Blocks(batch, own).forward(batch)
                for b in np.argsort(-blocks.bounds.max(axis=1, initial=0), kind="stable").tolist():
                    items = np.flatnonzero(blocks.bounds[b] >= best.least)
                    if len(items):
                        best.take(blocks, b, items)
            yield best.rows(own.ids)

        return _best_of_tasks(map_batches(rows, run, "item_id long, doc_id long, score long"), k)

    # At most SEEDS blocks for each item.
    some = score(index.blocks.join(F.broadcast(first.select("block").distinct()), "block", "left_semi"), weighted)
    place = {i: n for n, i in enumerate(queries.ids.tolist())}
    for r in some.where(F.col("rank") == k).select("item_id", "score").toLocalIterator():  # at most a row for each item
        queries.least[place[r["item_id"]]] = r["score"]
    return score(index.blocks, spark.sparkContext.broadcast(queries))


def _stored_items(items: DataFrame) -> tuple[DataFrame, int]:
    """block, item_id and its distinct terms, in blocks of about ITEM_CHARS characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted({t.decode() for t in terms_of(text)}) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(terms, pa.list_(pa.string()))], names=["item_id", "terms"])

    own = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = own.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = -(-total // ITEM_CHARS)
    if not blocks:
        return own, 0
    each = map_batches(own, run, "item_id long, terms array<string>").groupBy("item_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))).alias("terms"))
    number = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).alias("block")
    return materialize(each.where(F.size("terms") > 0).select(number, "item_id", "terms"), "item-terms"), blocks


def search(index: LexicalIndex, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank (from 1), doc_id and score: the ``k`` best documents of each item, scores above 0 alone.

    Scores are exact. Equal scores rank by ascending doc_id; rows that repeat a doc_id are documents
    of their own. Rows of ``items`` (item_id, text) with one id are one item with all their terms;
    items without an id or a term have no rows; other columns are ignored.
    """
    stored, blocks = _stored_items(items)
    out = index.blocks.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not index.n_docs:
        return out
    for block in range(blocks):
        rows = stored.where(F.col("block") == block).select("item_id", "terms").toLocalIterator()
        if own := [(r["item_id"], r["terms"]) for r in rows]:
            out = out.unionByName(_search_block(index, own, k))
    return out
