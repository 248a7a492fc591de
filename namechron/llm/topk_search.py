"""Exact top-k inner-product search by a three-phase uniform threshold.

The components of all vectors fall into segments that are stored apart, each cut into cells of
bounded size; equal vectors are one entry. For each block of queries:

1. Every segment's cells give the heads of their local score lists; all heads of a
   query are scored by all segments, and the K-th best total is a safe cutoff.
2. The cutoffs are broadcast. A total at or above the cutoff must reach the uniform share
   cutoff / SEGMENTS in some segment (pigeonhole), so each segment gives the entries that do, and
   skips rows whose length there rules that out. Only these entries' places travel.
3. Entries meet all segments of their cell, where their remaining scores are resolved exactly.

Blocks of queries, cells and all that the driver holds are of bounded size whatever the input.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import map_batches, materialize, new_path

#: Queries of a block, and bytes of a cell's vectors as 64-bit numbers.
BLOCK_QUERIES, CELL_BYTES = 4_096, 32 << 20
#: Rows and queries that are scored at once.
SCORE_ROWS, SCORE_QUERIES = 8_192, 256
#: Heads of each local list that are scored for the cutoff, for each of the k asked for at least one.
HEADS = 16
#: Least number of cells, so that small inputs use all cores too.
LEAST_CELLS = 32
SEGMENTS = 2
#: From this share of a cell's rows on a query's entries are written as "all".
MOST_SHARE = 0.25
_LONG = 1 << 63


def quantized(vectors: DataFrame, id_column: str, vector_column: str, scale: float = 256.0) -> DataFrame:
    """vec_id, dim and q: floor(scale * x) of each component, as little-endian 64-bit floats, which hold it exactly.

    Rows whose id or vector is null, or whose vector holds a null or non-finite component, are left
    out. A component whose scaled value is beyond the range of a double is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, packed = [], [], []
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = x.values
                if i is None or values is None or values.null_count:
                    continue
                v = np.asarray(values.to_numpy(zero_copy_only=False), np.float64)
                if not np.isfinite(v).all():
                    continue
                scaled = np.floor(v * scale) + 0.0  # no negative zero: equal vectors have equal bytes
                if not np.isfinite(scaled).all():
                    raise OverflowError(f"a component of vector {i} is too large to be scaled")
                ids.append(i)
                dims.append(len(v))
                packed.append(scaled.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(packed, pa.binary())], names=["vec_id", "dim", "q"])

    return map_batches(vectors.select(id_column, vector_column), run, "vec_id long, dim int, q binary")


def _matrix(packed: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<f8").reshape(len(packed), dim)


def _whole(values: np.ndarray) -> np.ndarray:
    """Python integers, for products beyond 64 bits."""
    return np.array([int(v) for v in values.ravel().tolist()], object).reshape(values.shape)


def _kind(y: np.ndarray, x: np.ndarray) -> type:
    """The fastest number type in which all inner products of rows of ``y`` and ``x`` are exact."""
    most = max(1, y.shape[1]) * int(np.abs(y).max(initial=0)) * int(np.abs(x).max(initial=0))
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64 if most < _LONG else object


def _as(values: np.ndarray, kind: type) -> np.ndarray:
    return _whole(values) if kind is object else values.astype(kind)


def products(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products (rows of ``y`` by rows of ``x``), in floats only where these hold them."""
    kind = _kind(y, x)
    if kind is not object:
        return _as(y, kind) @ _as(x, kind).T
    # only rows that need it go through Python integers
    limit = max(1, y.shape[1]) * np.abs(y).max(initial=0)
    small = np.abs(x).max(axis=1, initial=0) * limit < 2.0**52
    out = np.zeros((len(y), len(x)), object)
    if small.any():
        out[:, small] = (y @ x[small].T).astype(np.int64)
    out[:, ~small] = _whole(y) @ _whole(x[~small]).T
    return out


def pair_products(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner product of each row of ``y`` with the same row of ``x``, as integers."""
    kind = _kind(y, x)
    if kind is object:
        return (_whole(y) * _whole(x)).sum(axis=1) if y.shape[1] else np.zeros(len(y), object)
    return np.einsum("ij,ij->i", *(_as(v, np.int64 if kind is np.int64 else np.float64) for v in (y, x))).astype(np.int64)


def _edges(dim: int) -> list[int]:
    return [dim * s // SEGMENTS for s in range(SEGMENTS + 1)]


def _cells(rows: DataFrame, most_ids: int) -> DataFrame:
    """dim, cell, segment, q (its part of the cell's distinct vectors), and in segment 0 their ids and numbers of ids.

    Of the rows of equal vectors the ``most_ids`` smallest ids are kept, before the shuffle already.
    """
    same = Window.partitionBy("dim", "q").orderBy("vec_id")
    few = rows.withColumn("n", F.row_number().over(same)).where(F.col("n") <= most_ids).drop("n")
    size = rows.agg(F.sum(F.octet_length("q") + 8)).first()[0] or 0
    cells = max(LEAST_CELLS, -(-size // CELL_BYTES))

    def run(cell: pa.Table) -> pa.Table:
        owners: dict[bytes, list[int]] = defaultdict(list)
        for i, q in zip(cell["vec_id"].to_pylist(), cell["q"].to_pylist(), strict=True):
            owners[q].append(i)
        dim = cell["dim"][0].as_py()
        order = sorted(owners, key=lambda q: min(owners[q]))
        x, edges = _matrix(order, dim), _edges(dim)
        ids = np.array([i for q in order for i in sorted(owners[q])], "<i8").tobytes()
        counts = np.array([len(owners[q]) for q in order], "<i4").tobytes()
        none = [b""] * (SEGMENTS - 1)
        return pa.table({
            "dim": pa.array([dim] * SEGMENTS, pa.int32()), "cell": pa.array([cell["cell"][0].as_py()] * SEGMENTS, pa.int32()), "segment": pa.array(range(SEGMENTS), pa.int32()),
            "n": pa.array([len(order)] * SEGMENTS, pa.int32()), "q": pa.array([x[:, a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary()),
            "ids": pa.array([ids, *none], pa.binary()), "counts": pa.array([counts, *none], pa.binary()),
        })

    placed = few.withColumn("cell", F.pmod(F.xxhash64("q"), F.lit(cells)).cast("int"))
    return materialize(placed.groupBy("dim", "cell").applyInArrow(run, "dim int, cell int, segment int, n int, q binary, ids binary, counts binary"), "cells")


def _parts(batches: Iterator[pa.RecordBatch], block: dict[int, np.ndarray]) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """Each stored part of a cell whose length some query has: the row, its vectors and the queries' part."""
    for batch in batches:
        for at in range(len(batch)):
            row = {name: batch.column(name)[at].as_py() for name in ("dim", "cell", "segment", "n")}
            if row["dim"] not in block:
                continue
            a, b = _edges(row["dim"])[row["segment"] : row["segment"] + 2]
            for name in ("ids", "counts"):
                row[name] = batch.column(name)[at].as_py()
            yield row, np.frombuffer(batch.column("q")[at].as_py(), "<f8").reshape(row["n"], b - a), block[row["dim"]][:, a:b]


def _slices(n: int, size: int) -> list[slice]:
    return [slice(a, min(n, a + size)) for a in range(0, n, size)]


def _local_heads(stored: DataFrame, block, k: int) -> DataFrame:
    """Phase 1: dim, query, segment, cell and place of the k heads of each segment's score list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, x, y in _parts(batches, block.value):
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for own in _slices(len(y), SCORE_QUERIES):
                for part in _slices(len(x), SCORE_ROWS):
                    # heads may be any rows: floats will do to choose them
                    p = (y[own].astype(np.float32) @ x[part].astype(np.float32).T) if np.abs(x[part]).max(initial=0) < 2.0**40 else y[own] @ x[part].T
                    head = min(k, p.shape[1])
                    listed = np.argpartition(-p, head - 1, axis=1)[:, :head]
                    out.append((np.repeat(np.arange(own.start, own.stop), head), (listed + part.start).ravel(), np.take_along_axis(p, listed, 1).ravel().astype(np.float64)))
            if not out:
                continue
            query, place, score = (np.concatenate(c) for c in zip(*out, strict=True))
            same = [np.full(len(query), row[name], np.int32) for name in ("dim", "segment", "cell")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (same[0], query.astype(np.int32), same[1], same[2], place.astype(np.int32), score)], names=["dim", "query", "segment", "cell", "place", "score"])

    found = map_batches(stored, run, "dim int, query int, segment int, cell int, place int, score double")
    heads = Window.partitionBy("dim", "query", "segment").orderBy(F.desc("score"), "cell", "place")
    return found.withColumn("rank", F.row_number().over(heads)).where(F.col("rank") <= k).select("dim", "query", "cell", "place").distinct()


def _cutoffs(stored: DataFrame, block, heads: DataFrame, k: int) -> dict[int, list[int | None]]:
    """For each dim and query the k-th best total of the heads; None if they hold fewer rows."""
    spark = stored.sparkSession
    wanted: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    for h in heads.collect():  # at most SEGMENTS x HEADS (or k) for each query of the block
        wanted[h["dim"], h["cell"]].append((h["query"], h["place"]))
    asked = spark.sparkContext.broadcast(dict(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, x, y in _parts(batches, block.value):
            own = np.array(asked.value.get((row["dim"], row["cell"]), []), np.int64).reshape(-1, 2)
            if not len(own):
                continue
            copies = np.frombuffer(row["counts"], "<i4")[own[:, 1]] if row["counts"] else np.zeros(len(own), np.int32)
            score = [str(s) for s in pair_products(y[own[:, 0]], x[own[:, 1]]).tolist()]
            same = [np.full(len(own), row[name], np.int32) for name in ("dim", "cell")]
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in (*same, *own.astype(np.int32).T, copies.astype(np.int32))), pa.array(score, pa.string())], names=["dim", "cell", "query", "place", "copies", "score"])

    totals: dict[tuple, list[int]] = defaultdict(lambda: [0, 0])
    for r in map_batches(stored, run, "dim int, cell int, query int, place int, copies int, score string").collect():
        held = totals[r["dim"], r["query"], r["cell"], r["place"]]
        held[0] += int(r["score"])
        held[1] += r["copies"]
    rows: dict[tuple[int, int], list[int]] = defaultdict(list)
    for (dim, query, _, _), (score, copies) in totals.items():
        rows[dim, query] += [score] * copies
    asked.unpersist()
    return {dim: [sorted(rows[dim, i], reverse=True)[k - 1] if len(rows[dim, i]) >= k else None for i in range(len(y))] for dim, y in block.value.items()}


def _sufficient_entries(stored: DataFrame, block, cutoffs) -> DataFrame:
    """Phase 2: dim, cell, query and places of the entries that reach the uniform share in a segment; null places are all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, x, y in _parts(batches, block.value):
            limits = cutoffs.value[row["dim"]]
            shares = [None if c is None else -(-c // SEGMENTS) for c in limits]
            reach = np.sqrt((x * x).sum(axis=1)) * (1 + 1e-9)  # Cauchy-Schwarz, with room for rounding
            lengths = np.sqrt((y * y).sum(axis=1)) * (1 + 1e-9)
            queries: list[int] = [i for i, share in enumerate(shares) if share is None or share <= 0]
            places: list[bytes | None] = [None] * len(queries)
            bounded = np.array([i for i, share in enumerate(shares) if share is not None and share > 0], np.int64)
            for own in _slices(len(bounded), SCORE_QUERIES):
                some = bounded[own]
                least = np.array([float(min(shares[i], 1 << 1000)) for i in some])
                with np.errstate(divide="ignore", over="ignore"):
                    rows = np.flatnonzero(reach >= (least / lengths[some]).min())
                if not len(rows):
                    continue
                hit = np.zeros((len(some), len(rows)), bool)
                exact = [shares[i] for i in some]
                for part in _slices(len(rows), SCORE_ROWS):
                    p = products(y[some], x[rows[part]])
                    bound = least.astype(p.dtype)[:, None] if p.dtype in (np.float32, np.float64) else np.array(exact, object)[:, None]
                    hit[:, part] = p >= bound
                for i, own_hit in zip(some.tolist(), hit, strict=True):
                    n = int(own_hit.sum())
                    if n:
                        queries.append(i)
                        places.append(None if n > MOST_SHARE * len(x) else rows[own_hit].astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(queries), row["dim"], np.int32)), pa.array(np.full(len(queries), row["cell"], np.int32)), pa.array(queries, pa.int32()), pa.array(places, pa.binary())],
                names=["dim", "cell", "query", "places"],
            )

    return map_batches(stored, run, "dim int, cell int, query int, places binary")


def _resolved(stored: DataFrame, block, cutoffs, entries: DataFrame, k: int) -> DataFrame:
    """Phase 3: dim, query, vec_id, score and beyond (64 bits) of the k best rows of each cell among the entries."""

    def best(ids: np.ndarray, score: np.ndarray) -> np.ndarray:
        return np.array(sorted(range(len(ids)), key=lambda n: (-int(score[n]), ids[n]))[:k], np.int64) if score.dtype == object else np.lexsort((ids, -score))[:k]

    def run(own: pa.Table, parts: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if len(own) and len(parts):
            dim = own["dim"][0].as_py()
            y, by_segment = block.value[dim], sorted(parts.to_pylist(), key=lambda r: r["segment"])
            x = np.concatenate([np.frombuffer(r["q"], "<f8").reshape(r["n"], -1) for r in by_segment], axis=1) if dim else np.zeros((by_segment[0]["n"], 0))
            counts = np.frombuffer(by_segment[0]["counts"], "<i4")
            ids, ends = np.frombuffer(by_segment[0]["ids"], "<i8"), np.cumsum(counts)
            wanted: dict[int, np.ndarray | None] = {}
            for query, places in zip(own["query"].to_pylist(), own["places"].to_pylist(), strict=True):
                if places is None or wanted.get(query, b"") is None:
                    wanted[query] = None
                else:
                    more = np.frombuffer(places, "<i4")
                    wanted[query] = np.union1d(wanted[query], more) if query in wanted else more
            for query, places in wanted.items():
                at = np.arange(len(x)) if places is None else places
                score = np.concatenate([pair_products(np.broadcast_to(y[query], (s.stop - s.start, dim)), x[at[s]]) for s in _slices(len(at), SCORE_ROWS)])
                cutoff = cutoffs.value[dim][query]
                if cutoff is not None:
                    enough = score >= cutoff
                    at, score = at[enough], score[enough]
                first = best(ids[ends[at] - counts[at]], score)
                rows = [(i, int(s)) for p, s in zip(at[first].tolist(), score[first].tolist(), strict=True) for i in ids[ends[p] - counts[p] : ends[p]].tolist()]
                out += [(query, i, s) for i, s in sorted(rows, key=lambda r: (-r[1], r[0]))[:k]]
        return pa.table({
            "dim": pa.array([dim] * len(out) if out else [], pa.int32()), "query": pa.array([q for q, _, _ in out], pa.int32()), "vec_id": pa.array([i for _, i, _ in out], pa.int64()),
            "score": pa.array([min(_LONG - 1, max(-_LONG, s)) for _, _, s in out], pa.int64()), "beyond": pa.array([not -_LONG <= s < _LONG for _, _, s in out], pa.bool_()),
        })

    return entries.groupBy("dim", "cell").cogroup(stored.groupBy("dim", "cell")).applyInArrow(run, "dim int, query int, vec_id long, score long, beyond boolean")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best rows of ``vectors`` for each query.

    Both inputs have an id and a vector column; other columns are ignored. A row is no answer to the
    query of its own id. Ties go to the smaller vec_id; queries with fewer candidates return them
    all. Only vectors of equal length meet. Of rows that share an id and length, the largest
    quantized vector (by bytes) stands for all. Scores are exact whatever the size of components; a
    score to be returned that doesn't fit a long is an error. Nulls: see :func:`quantized`.
    """
    spark, most = vectors.sparkSession, k + 1  # one more, as the query's own row may be among them

    def one_each(df: DataFrame) -> DataFrame:
        return df.groupBy("vec_id", "dim").agg(F.max("q").alias("q"))

    stored = _cells(materialize(one_each(quantized(vectors, id_column, vector_column)), "vectors"), most)
    asked = materialize(one_each(quantized(queries, id_column, vector_column)).withColumnRenamed("vec_id", "query_id"), "queries")
    distinct = materialize(asked.select("dim", "q").distinct(), "query-vectors")
    blocks = -(-distinct.count() // BLOCK_QUERIES)
    block_of = F.pmod(F.xxhash64("q"), F.lit(max(1, blocks)))
    path, schema = new_path(spark, "best"), "query_id long, rank int, vec_id long, score long"
    for n in range(blocks):
        listed: dict[int, list[bytes]] = defaultdict(list)
        for r in distinct.where(block_of == n).collect():
            listed[r["dim"]].append(bytes(r["q"]))
        block = spark.sparkContext.broadcast({dim: _matrix(own, dim) for dim, own in listed.items()})
        cutoffs = spark.sparkContext.broadcast(_cutoffs(stored, block, _local_heads(stored, block, max(most, HEADS)), most))
        found = _resolved(stored, block, cutoffs, _sufficient_entries(stored, block, cutoffs), most)
        of_query = Window.partitionBy("dim", "query").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
        best = found.withColumn("rank", F.row_number().over(of_query)).where(F.col("rank") <= most).drop("rank")
        names = spark.createDataFrame([(dim, i, q) for dim, own in listed.items() for i, q in enumerate(own)], "dim int, query int, q binary")
        answers = F.broadcast(best.join(F.broadcast(names), ["dim", "query"]).drop("query"))  # at most (k + 1) x BLOCK_QUERIES
        met = asked.where(block_of == n).join(answers, ["dim", "q"]).where("query_id <> vec_id")
        own = Window.partitionBy("query_id", "dim").orderBy(F.desc("score"), "vec_id")
        ranked = met.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
        score = F.when(F.col("beyond"), F.raise_error(F.lit("a score to be returned doesn't fit 64 bits")).cast("long")).otherwise(F.col("score"))
        ranked.select("query_id", "rank", "vec_id", score.alias("score")).write.mode("append").option("compression", "zstd").parquet(path)
        block.unpersist()
        cutoffs.unpersist()
    return spark.read.schema(schema).parquet(path) if blocks else spark.createDataFrame([], schema)
