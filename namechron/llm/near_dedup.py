"""Near-duplicate components by a signature-coordinate inverted join.

1. Each document's set of word shingles gives a fingerprint and a MinHash signature. Documents of
   one fingerprint are one node from here on, so exact copies, however many, cost one row.
2. Nodes are posted under each pair of coordinate and value. Two sets at the threshold agree in far
   more than MATCHES of COORDINATES (a pair exactly at 0.8 falls short with probability 3e-8, at
   0.85 with 1e-9). A node with fewer than MATCHES postings shared with anyone has no partner; of
   the others only the prefix counts: the rarest postings, all but MATCHES - 1. A pair with enough
   matches must meet within both prefixes, so frequent values are skipped.
3. Each posting list names its most central member, and each node joins the group of the member
   that most of its lists name. A group falls into blocks; each block is a task that also gets the
   group's central member. There the postings of the block's members are merged: a member's prefix
   lists are counted, its MATCHES - 1 longest lists are skipped and only looked up for those it met,
   and pairs with MATCHES collisions or more are compared on full sets.
4. Members that are by then in no part with most of their group meet its other blocks in the same
   way, but first by long signatures alone (a byte for each of LONG coordinates), in cells of many blocks:
   texts only go to the pairs of blocks where a member agrees with one of another part as often as
   a pair at the threshold does but with a probability of MISS. Then each posting list that still holds several parts and lies in several groups is taken
   like a group.

No pairs are written out but links that join parts, and no list, component or fingerprint is
collected on the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import join_counted, map_batches, materialize
from ._words import WordHashes, mixed, runs, words_of

COORDINATES, MATCHES = 32, 12
#: Members of a group that are compared as one block.
BLOCK = 256
BASE = 0x9E3779B97F4A7C15

_random = np.random.default_rng(8)
SEEDS = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
FACTORS = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
#: Coordinates of the long signatures, and the probability that a pair exactly at the threshold agrees too seldom.
LONG, MISS = 512, 1e-9
LONG_SEEDS = _random.integers(0, 1 << 63, LONG, dtype=np.uint64)
LONG_FACTORS = _random.integers(0, 1 << 63, LONG, dtype=np.uint64) | np.uint64(1)


def shingles(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a shorter sequence is one shingle, no word none."""
    own = hashes.of(words_of(text, lower=True))
    if not len(own):
        return np.zeros(0, np.uint64)
    length = min(words, len(own))
    return np.unique(mixed(runs(own, length, BASE) + np.uint64(length)))


def signature(found: np.ndarray) -> np.ndarray:
    """Smallest value of each coordinate's permutation over a non-empty set."""
    best = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(found), 4096):
        np.minimum(best, ((found[a : a + 4096, None] ^ SEEDS) * FACTORS).min(axis=0), out=best)
    return best


def long_signature(found: np.ndarray) -> bytes:
    """A byte of the smallest value of each of LONG permutations over a non-empty set."""
    best = np.full(LONG, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(found), 1024):
        np.minimum(best, ((found[a : a + 1024, None] ^ LONG_SEEDS) * LONG_FACTORS).min(axis=0), out=best)
    return (mixed(best) >> np.uint64(56)).astype(np.uint8).tobytes()


def least_agreement(percent: int) -> int:
    """Coordinates of LONG in which all but a share of MISS of the pairs at ``percent`` agree."""
    p, tail = percent / 100, 0.0
    for k in range(LONG + 1):
        tail += comb(LONG, k) * p**k * (1 - p) ** (LONG - k)
        if tail > MISS:
            return k
    return LONG


def fingerprint(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_id, n_shingles, node (fingerprint; null for an empty set) and signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, nodes, signatures = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, words, hashes)
                sizes.append(len(found))
                nodes.append(fingerprint(found) if len(found) else None)
                signatures.append(signature(found).view(np.int64) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("text_id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(signatures, pa.list_(pa.int64()))],
                names=["doc_id", "text_id", "n_shingles", "node", "signature"],
            )

    return map_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("text_id")), run, "doc_id long, text_id long, n_shingles long, node binary, signature array<long>")


def _prefixes(nodes: DataFrame) -> DataFrame:
    """node, token and score of each posting in a prefix: the rarest shared postings, all but MATCHES - 1.

    A node's score is the total length of its shared posting lists: high for what others are copies of.
    """
    postings = nodes.select("node", F.posexplode("signature").alias("i", "value")).select("node", F.xxhash64("i", "value").alias("token"))
    shared = materialize(postings.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    met = join_counted(postings, shared.withColumn("length", F.col("n")), ["token"])
    ranked = met.withColumnRenamed("length", "n").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("own"), F.sum("n").alias("score"))  # at most COORDINATES
    prefix = F.slice("own", F.lit(1), F.size("own") - (MATCHES - 1))
    return ranked.where(F.size("own") >= MATCHES).select("node", "score", F.explode(prefix).alias("p")).select("node", "score", F.col("p.token").alias("token"))


def _texts(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node, signature and one text of each row (node, signature, text_id, n) of ``wanted``; n is the text's number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            # texts can share a text_id
            kept = [i for i, t in enumerate(batch.column("text").to_pylist()) if fingerprint(shingles(t, words, hashes)) == nodes[i]]
            yield batch.take(pa.array(kept, pa.int64()))

    met = join_counted(docs.select(F.xxhash64("text").alias("text_id"), "text"), wanted, ["text_id"]).select("node", "signature", "text")
    return map_batches(met, run, "node binary, signature array<long>, text string").dropDuplicates(["node"])


def colliding(tokens: np.ndarray, lists: list[np.ndarray], lengths: np.ndarray, i: int) -> np.ndarray:
    """Later members that collide with member ``i`` in MATCHES coordinates or more.

    ``tokens`` has a row of list numbers for each member. The short lists of ``i`` are merged and
    counted; its MATCHES - 1 longest are skipped and looked up for the members met in the others,
    as who is in none of these can't have MATCHES collisions.
    """
    own = tokens[i]
    order = np.argsort(lengths[own], kind="stable")
    prefix, skipped = own[order[: COORDINATES - MATCHES + 1]], order[COORDINATES - MATCHES + 1 :]
    met = np.concatenate([lists[t] for t in prefix.tolist()])
    count = np.bincount(met[met > i], minlength=i + 1)
    found = np.flatnonzero(count)
    both = count[found] + (tokens[found][:, skipped] == own[skipped]).sum(axis=1)
    return found[both >= MATCHES]


def joining_links(signatures: np.ndarray, sets: list[np.ndarray], parts: list[bytes], sides: list[int] | None, percent: int) -> list[tuple[int, int]]:
    """Index pairs of sets at the threshold that join parts, in one pass over the members.

    Each member meets the later members that collide with it often enough and aren't in its part by
    then; with ``sides`` only those of the other side.
    """
    n = len(sets)
    names = {p: i for i, p in enumerate(dict.fromkeys(parts))}
    part = np.array([names[p] for p in parts])
    sizes = np.array([len(s) for s in sets])
    tokens, lists = np.empty((n, COORDINATES), np.int64), []
    for c in range(COORDINATES):
        _, found = np.unique(signatures[:, c], return_inverse=True)
        tokens[:, c] = found + len(lists)
        lists += np.split(np.argsort(found, kind="stable"), np.cumsum(np.bincount(found))[:-1])
    lengths = np.array([len(x) for x in lists])
    side = None if sides is None else np.array(sides)
    out = []
    for i in range(n - 1):
        others = colliding(tokens, lists, lengths, i)
        fits = (part[others] != part[i]) & (100 * np.minimum(sizes[others], sizes[i]) >= percent * np.maximum(sizes[others], sizes[i]))
        if side is not None:
            fits &= side[others] != side[i]
        others = others[fits]
        if not len(others):
            continue
        for j in others.tolist():
            if part[j] != part[i]:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                    out.append((i, j))
                    part[part == part[j]] = part[i]
    return out


#: Columns that name a cell.
CELL = ["group", "i", "j"]
#: Cells of one member that meet a copy of its text in one place.
SPREAD = 64


#: Blocks that meet as one while only signatures are compared: 2 MB of these for each side of a cell.
COARSE = 16


def _meeting(signatures: np.ndarray, parts: list[bytes], sides: list[int], least: int) -> list[tuple[int, int]]:
    """Index pairs of a cell (a member of side 0, one of side 1) that agree often enough and lie in different parts."""
    names = {p: i for i, p in enumerate(dict.fromkeys(parts))}
    part, side = np.array([names[p] for p in parts]), np.array(sides)
    others, out = np.flatnonzero(side == 1), []
    for i in np.flatnonzero(side == 0).tolist():
        later = others[part[others] != part[i]]
        out += [(i, j) for j in later[np.count_nonzero(signatures[later] == signatures[i], axis=1) >= least].tolist()]
    return out


def _long_signatures(texts: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """node and long signature of each node of ``members``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [long_signature(shingles(t, words, hashes)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], names=["node", "signature"])

    wanted = texts.select("node", "text").join(members.select("node").distinct(), "node", "left_semi")
    return materialize(map_batches(wanted, run, "node binary, signature binary"), "long-signatures")


def _sifted(cells: DataFrame, signatures: DataFrame, least: int) -> DataFrame:
    """Members of the cells of blocks in which they have a partner to be compared with: group, node, part, i, j, side, spread.

    ``cells`` has the members (and their ``block``) of cells of COARSE x COARSE blocks; only ``signatures`` (node, signature) are shuffled.
    """

    def run(cell: pa.Table) -> pa.Table:
        rows = np.frombuffer(b"".join(cell["signature"].to_pylist()), np.uint8).reshape(-1, LONG)
        block = cell["block"].to_pylist()
        met = {(x, block[a], block[b]) for a, b in _meeting(rows, cell["part"].to_pylist(), cell["side"].to_pylist(), least) for x in (a, b)}
        places = sorted(met)
        out = cell.select(["group", "node", "part", "side"]).take(pa.array([x for x, _, _ in places], pa.int64()))
        for name, values in (("i", [i for _, i, _ in places]), ("j", [j for _, _, j in places])):
            out = out.append_column(name, pa.array(values, pa.int32()))
        return out

    kinds = {c: t for c, t in cells.dtypes}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ("group", "node", "part", "side")) + ", i int, j int"
    met = _spread_join(cells, signatures).select("group", "i", "j", "node", "part", "side", "block", "signature").groupBy(*CELL).applyInArrow(run, schema)
    return materialize(met.withColumn("spread", F.floor(F.when(F.col("side") == 0, F.col("j")).otherwise(F.col("i")) / SPREAD).cast("int")), "sifted")


def _spread_join(cells: DataFrame, texts: DataFrame) -> DataFrame:
    """``cells`` with what ``texts`` has of their members; a member of very many cells has copies there, one for SPREAD cells."""
    most = cells.groupBy("node").agg(F.max("spread").alias("most"))
    copies = texts.join(most, "node").withColumn("spread", F.explode(F.sequence(F.lit(0), F.col("most")))).drop("most")
    return cells.join(copies, ["node", "spread"])


def _cell_links(cells: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """a_part and b_part of links that join parts within each cell (group, i, j) of rows (node, part, side, spread)."""

    def run(cell: pa.Table) -> pa.Table:
        hashes = WordHashes()
        parts = cell["part"].to_pylist()
        links = []
        if len(set(parts)) > 1:
            own = [shingles(t, words, hashes) for t in cell["text"].to_pylist()]
            sides = cell["side"].to_pylist()
            links = joining_links(np.array(cell["signature"].to_pylist(), np.int64), own, parts, sides if len(set(sides)) > 1 else None, percent)
        return pa.table({"a_part": pa.array([parts[i] for i, _ in links], pa.binary()), "b_part": pa.array([parts[j] for _, j in links], pa.binary())})

    return materialize(_spread_join(cells, texts).groupBy(*CELL).applyInArrow(run, "a_part binary, b_part binary"), "links")


def _compared(groups: DataFrame, labels: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``labels`` (node, part) after all links between members of each group of ``groups`` (group, node, score) have joined parts."""
    members = materialize(groups.join(labels, "node"), "members")
    top = F.max(F.struct("score", "node")).alias("top")
    several = members.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("low"), F.max("part").alias("high"), top).where("low <> high")
    blocks = materialize(several.select("group", "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.col("top.node").alias("center")), "blocks")
    # every block is a cell, and each has the group's central member
    placed = join_counted(members, blocks, ["group"]).select("group", "node", "part", "center", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("i"))
    centers = placed.where("node = center").withColumn("own", F.col("i")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("i <> own")
    cells = placed.drop("center", "blocks").withColumn("spread", F.lit(0)).unionByName(centers.select("group", "node", "part", "i", F.floor(F.col("i") / SPREAD).cast("int").alias("spread")))
    labels = _relabelled(labels, _cell_links(cells.withColumn("j", F.col("i")).withColumn("side", F.lit(0)), texts, words, percent))

    large = blocks.where("blocks > 1").select("group", "n", "blocks")
    if large.isEmpty():
        return labels
    members = materialize(join_counted(groups.select("group", "node"), large, ["group"]).join(labels, "node"), "members")
    shares = members.groupBy("group", "part").agg(F.count(F.lit(1)).alias("n"))
    most = shares.groupBy("group").agg(F.max(F.struct("n", "part")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    rest = F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("rest_blocks")
    still = materialize(most.select("group", "n", F.col("top.part").alias("most"), rest), "open-groups")
    placed = materialize(join_counted(members, still, ["group"]), "open-members")
    of_rest, of_all = F.pmod(F.xxhash64("node"), F.col("rest_blocks")).cast("int"), F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")

    def in_cells(rows: DataFrame, side: int, block: Column, own: str, others: str, blocks: str) -> DataFrame:
        """Members of one side in every cell of COARSE x COARSE blocks that they belong to."""
        across = F.explode(F.sequence(F.lit(0), F.floor((F.col(blocks) - 1) / COARSE).cast("int")))
        met = rows.select("group", "node", "part", block.alias("block"), F.lit(side).alias("side"), across.alias(others))
        return met.withColumns({own: F.floor(F.col("block") / COARSE).cast("int"), "spread": F.floor(F.col(others) / SPREAD).cast("int")})

    cells = in_cells(placed.where("part <> most"), 0, of_rest, "i", "j", "blocks").unionByName(in_cells(placed, 1, of_all, "j", "i", "rest_blocks"))
    sifted = _sifted(cells, _long_signatures(texts, placed, words), least_agreement(percent))
    return _relabelled(labels, _cell_links(sifted, texts, words, percent))


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) for all nodes of edges (u, v) but roots.

    Large-star and small-star steps in turn until the edges rest; each step is a grouped minimum
    and a join by counted keys, so the edges of a node that very many have lie in no single task.
    """

    def largest_first(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def least(df: DataFrame) -> DataFrame:
        return materialize(df.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "least")

    edges = materialize(largest_first(edges), "edges")
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = join_counted(both, least(both), ["u"]).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = materialize(largest_first(large), "large-star")
        smallest = least(large)
        small = join_counted(large, smallest, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(smallest.select("u", F.col("m").alias("v")))
        edges = materialize(largest_first(small), "small-star")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, part) after parts that ``links`` (a_part, b_part) join have become one."""
    if links.isEmpty():
        return labels
    roots = components(links.select(F.col("a_part").alias("u"), F.col("b_part").alias("v")))
    sizes = labels.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    moves = sizes.join(roots.select(F.col("node").alias("part"), "root"), "part", "left").select("part", "n", F.coalesce("root", "part").alias("root"))
    moved = join_counted(labels, materialize(moves, "moves"), ["part"])
    return materialize(moved.select("node", F.col("root").alias("part")), "labels")


def _open_lists(members: DataFrame) -> DataFrame:
    """Postings of ``members`` (token, node, part, ...) in lists of several parts."""
    several = members.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
    return join_counted(members, materialize(several.select("token", "n"), "open-lists"), ["token"])


def _groups(lists: DataFrame) -> DataFrame:
    """node and group: the most central member of a list, as most lists of the node name it."""
    centers = lists.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("score", "node")).alias("top"))
    centers = materialize(centers.select("token", "n", F.col("top.node").alias("group"), F.col("top.score").alias("weight")), "centers")
    votes = join_counted(lists.select("token", "node"), centers, ["token"]).groupBy("node", "group").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight"))
    return votes.groupBy("node").agg(F.max(F.struct("n", "weight", "group")).alias("best")).select("node", F.col("best.group").alias("group"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text).

    Two documents are linked if 100 x intersection >= ``percent`` x union of their sets of distinct
    ``words``-word shingles; ``percent`` is 80 or more. component_id is the smallest doc_id of the
    component, kept whether it is the row's own. Texts that are null or without a word are linked
    with nothing. Rows that share a doc_id are compared as separate documents; a null doc_id is
    never a component's id unless it has no other. Other columns are ignored.
    """
    if percent < 80:
        raise ValueError("MATCHES is chosen for thresholds of 80 percent or more")
    marked = materialize(sketches(docs, words), "sketches")
    grouped = marked.where("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first"), F.min("text_id").alias("text_id"), F.first("signature").alias("signature")
    )
    nodes = materialize(grouped, "nodes")
    prefixes = materialize(_prefixes(nodes), "prefixes")
    scores = materialize(prefixes.groupBy("node").agg(F.first("score").alias("score")), "scores")
    labels = materialize(scores.select("node", F.col("node").alias("part")), "labels")
    lists = materialize(_open_lists(prefixes.withColumn("part", F.col("node"))), "lists")
    groups = materialize(_groups(lists).join(scores, "node"), "groups")
    candidates = nodes.join(groups, "node", "left_semi").select("node", "signature", "text_id")
    wanted = candidates.join(marked.groupBy("text_id").agg(F.count(F.lit(1)).alias("n")), "text_id")
    texts = materialize(_texts(docs, materialize(wanted, "candidates"), words), "texts")
    labels = _compared(groups, labels, texts, words, percent)
    members = materialize(prefixes.join(labels, "node").join(groups.select("node", "group"), "node"), "postings")
    lists = materialize(_open_lists(members), "lists")
    uncovered = lists.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high").select("token", "n")
    rest = join_counted(lists.drop("group"), materialize(uncovered, "uncovered"), ["token"]).select(F.col("token").alias("group"), "node", "score")
    labels = _compared(materialize(rest, "rest"), labels, texts, words, percent)
    firsts = materialize(labels.join(nodes.select("node", "first"), "node"), "firsts")
    smallest = materialize(firsts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("component_id")), "components")
    linked = join_counted(firsts.select("node", "part"), smallest, ["part"]).select("node", "component_id")
    of_node = nodes.select("node", "copies", "first").join(linked, "node", "left").select("node", F.col("copies").alias("n"), F.coalesce("component_id", "first").alias("component_id"))
    rows = marked.select("doc_id", "n_shingles", "node")
    met = join_counted(rows.where("node is not null"), materialize(of_node, "node-components"), ["node"]).select("doc_id", "n_shingles", "component_id")
    out = met.unionByName(rows.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
