"""The prefix trie of conversations: which share their first turns, and what they share.

Turns get digests (role, text); a prefix's digest is the exclusive-or of hashes of its turns with
their depths, so it can be put together from blocks of a conversation of any length. One
aggregate over the digests gives each prefix's smallest member (its owner) and its number of
members. A conversation that owns a prefix owns all that go on from it, so its first owned
depth is found by binary search, all conversations at once, one join against these minima a round.
What a conversation owns is a chain; chains hang below the chain that owns the prefix before
theirs. Sums over subtrees double their reach over the chains' ancestors in each round, and a
running sum along each chain gives every node its own.

Hot keys (a first turn that a third of all conversations share) are pre-aggregated or broadcast as a
bounded number of rows; positions and running sums of long conversations go over blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranks import ranked
from ._common import HOT_KEYS, join_counted, map_batches, materialize

#: Depths of a conversation that one running sum takes, as a power of two.
BLOCK_BITS = 12
#: Ids that are joined to one piece of a node's list.
PIECE = 8192
_WORD = r"[^\x20\x09-\x0D]+"


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, rank (from 0), key and n_words of every turn of ``conversations`` (conv_id, turn, role, text).

    Turns are ordered by ``turn``, null first; those of one turn number by the digest of role and text.
    Null role or text count as empty; rows without a conv_id take no part; repeated rows are turns of
    their own; other columns are ignored.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)).alias("key")
    own = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", key, F.regexp_count(text, F.lit(_WORD)).cast("long").alias("n_words"))
    return ranked(own, [F.col("turn"), F.col("key")], ["conv_id"], "rank").select("conv_id", "rank", "key", "n_words")


def with_shared_heads(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the first turns of another: (turns by depth, conversations with their lengths).

    With h = crc32(conv_id as text) % ``most``, conversation c gets the first h turns of conversation
    c - c % ``every`` (all if it has fewer, none if there is none), then its own after its first h.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select("conv_id", "n", h, (F.col("conv_id") - F.col("conv_id") % every).alias("parent"))
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("rank") < most - 1))
    heads = heads.groupBy(F.col("conv_id").alias("parent")).agg(F.array_sort(F.collect_list(F.struct("rank", "key", "n_words"))).alias("head"))
    head = F.slice(F.coalesce("head", F.array().cast("array<struct<rank:long,key:string,n_words:long>>")), F.lit(1), F.col("h").cast("int"))
    own = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    all_ = materialize(sizes.join(heads, "parent", "left").select("conv_id", "n", "h", head.alias("head"), (F.size(head) + own).cast("long").alias("length")), "conversations")
    given = all_.select("conv_id", "length", F.explode("head").alias("t")).select("conv_id", (F.col("t.rank") + 1).alias("depth"), "t.key", "t.n_words", "length")
    kept = join_counted(turns, all_.select("conv_id", "n", "h", F.size("head").alias("m"), "length"), ["conv_id"]).where("rank >= h")
    kept = kept.select("conv_id", (F.col("rank") - F.col("h") + F.col("m") + 1).alias("depth"), "key", "n_words", "length")
    return given.unionByName(kept), all_.select("conv_id", "length")


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns by depth and conversations with their lengths, without any change."""
    sizes = materialize(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("length", F.col("n")), "conversations")
    return join_counted(turns, sizes, ["conv_id"]).select("conv_id", (F.col("rank") + 1).alias("depth"), "key", "n_words", "length"), sizes.select("conv_id", "length")


def _block() -> Column:
    return F.shiftright(F.col("depth"), BLOCK_BITS).alias("block")


def _running(rows: DataFrame, values: list[str], add, put, falling: bool = False) -> DataFrame:
    """``rows`` (conv_id, depth, ...) with ``values`` aggregated by ``add`` (and ``put`` for two of them) along each conversation, from either end."""
    ends = (Window.unboundedPreceding, Window.currentRow)
    order = F.desc if falling else F.asc
    inside = Window.partitionBy("conv_id", "block").orderBy(order("depth")).rowsBetween(*ends)
    blocks = rows.withColumn("block", _block())
    totals = blocks.groupBy("conv_id", "block").agg(*(add(v).alias(f"_{v}") for v in values))
    before = Window.partitionBy("conv_id").orderBy(order("block")).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv_id", "block", *(add(f"_{v}").over(before).alias(f"_{v}") for v in values)).where(F.col(f"_{values[0]}").isNotNull())  # blocks after a first one
    local = blocks.select(*(c for c in blocks.columns if c not in values), *(add(v).over(inside).alias(v) for v in values))
    both = local.join(carried, ["conv_id", "block"], "left")
    return both.select(*(c for c in rows.columns if c not in values), *(put(F.col(v), F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values))


def _prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, n_words, length and two halves of the digest of the first ``depth`` turns."""
    hashed = turns.select("conv_id", "depth", "n_words", "length", F.xxhash64("key", "depth").alias("p"), F.xxhash64("depth", "key", F.lit(1)).alias("q"))
    return materialize(_running(hashed, ["p", "q"], F.bit_xor, Column.bitwiseXOR), "prefixes")


def _first_owned(conversations: DataFrame, prefixes: DataFrame, nodes: DataFrame, root: int) -> DataFrame:
    """conv_id, length, first (its first owned depth, length + 1 if it owns none) and above (the owner of the prefix before)."""
    digest = ["depth", "p", "q"]
    shared = materialize(nodes.where("n > 1").select(*digest, F.col("conv_id").alias("owner"), "n"), "minima")
    total = shared.agg(F.sum("n")).first()[0] or 0
    hot, cold = (shared.where(test).drop("n") for test in (F.col("n") * HOT_KEYS >= total, F.col("n") * HOT_KEYS < total))
    open_, done = conversations.where(F.col("conv_id") != root).select("conv_id", "length", F.lit(0).cast("long").alias("low"), (F.col("length") + 1).alias("high"), F.lit(root).cast("long").alias("above")), []
    while True:
        done.append(open_.where("high - low = 1"))
        probes = open_.where("high - low > 1").withColumn("depth", F.floor((F.col("low") + F.col("high")) / 2).cast("long")).join(prefixes.select("conv_id", *digest), ["conv_id", "depth"])
        # Few prefixes have many members: their probes stay where they are.
        met = probes.join(F.broadcast(hot), digest)
        rest = probes.join(F.broadcast(hot.select(*digest)), digest, "left_anti").join(cold, digest, "left")
        owned = F.col("owner").isNull() | (F.col("owner") == F.col("conv_id"))
        found = met.unionByName(rest).select(
            "conv_id", "length", F.when(owned, F.col("low")).otherwise(F.col("depth")).alias("low"), F.when(owned, F.col("depth")).otherwise(F.col("high")).alias("high"), F.when(owned, F.col("above")).otherwise(F.col("owner")).alias("above")
        )
        open_ = materialize(found, "search")
        if open_.isEmpty():
            break
    out = conversations.where(F.col("conv_id") == root).select("conv_id", "length", F.lit(0).cast("long").alias("first"), F.lit(None).cast("long").alias("above"))
    for d in done:
        out = out.unionByName(d.select("conv_id", "length", F.col("high").alias("first"), "above"))
    return materialize(out, "chains")


def _subtree_totals(chains: DataFrame) -> DataFrame:
    """``chains`` (conv_id, first, above, leaves, saved) with sums over all chains below each one too.

    After round r sums reach 2^r generations down, and ``up`` names the ancestor that far above.
    """
    state = chains.withColumn("up", F.col("above"))
    while True:
        below = materialize(state.where("up is not null").groupBy("up").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"), F.count(F.lit(1)).alias("n")), "below")
        if below.isEmpty():
            return state
        further = materialize(state.where("up is not null").select(F.col("conv_id").alias("up"), F.col("up").alias("next")).join(below.select("up", "n"), "up"), "further")
        moved = join_counted(state.where("up is not null").select("conv_id", "up"), further, ["up"]).select("conv_id", "next")
        grown = state.join(below.select(F.col("up").alias("conv_id"), "l", "s"), "conv_id", "left").join(moved, "conv_id", "left")
        state = materialize(
            grown.select("conv_id", "first", "above", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), F.col("next").alias("up")), "totals"
        )


def _listed(ends: DataFrame) -> DataFrame:
    """conv_id, depth and ends_sha256 of the nodes where conversations end (node, depth, ended), ids ascending.

    A list may hold a third of all ids and SHA-256 takes its bytes in order, so tasks that share a
    node by ranges of ids join these to pieces, and one task hashes a node's pieces as they stream by.
    """
    names = ["node", "depth", "ended", "ids"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now, ids = None, []

        def close() -> None:
            if ids:
                held.append((*now, ids[0], ",".join(map(str, ids))))
                ids.clear()

        for batch in batches:
            for node, depth, ended in zip(*(batch.column(c).to_pylist() for c in names[:3]), strict=True):
                if (node, depth) != now or len(ids) == PIECE:
                    close()
                    now = node, depth
                ids.append(ended)
            if len(held) >= 65536:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held, strict=True)], names=names)
                held = []
        close()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held, strict=True)], names=names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, out = None, None, []
        for batch in batches:
            for node, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("node", "depth", "ids")), strict=True):
                if (node, depth) == now:
                    sha.update(b"," + ids.encode())
                    continue
                if now:
                    out.append((*now, sha.hexdigest()))
                now, sha = (node, depth), hashlib.sha256(ids.encode())
            if len(out) >= 65536:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["conv_id", "depth", "ends_sha256"])
                out = []
        if now:
            out.append((*now, sha.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["conv_id", "depth", "ends_sha256"])

    sort = ["node", "depth", "ended"]
    packed = map_batches(ends.repartitionByRange(*sort).sortWithinPartitions(*sort), pieces, "node long, depth long, ended long, ids string")
    return map_batches(packed.repartition("node", "depth").sortWithinPartitions(*sort), digests, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """A row for each distinct prefix of the conversations, from the empty one: conv_id (its smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    ``turns`` (conv_id, depth from 1 without gaps, key, n_words, length) and ``conversations`` (conv_id once, length; those
    without a turn too) come from :func:`as_they_are` or :func:`with_shared_heads`. saved_tokens sums, over a node's subtree, the
    words of each node's last turn for every member but one. Without conversations there is no node.
    """
    n_all, root, root_length = conversations.agg(F.count(F.lit(1)), F.min("conv_id"), F.min_by("length", "conv_id")).first()
    prefixes = _prefixes(turns)
    top = prefixes.groupBy("depth", "p", "q").agg(F.min(F.struct("conv_id", "length")).alias("o"), F.count(F.lit(1)).alias("n"), F.max("n_words").alias("n_words"))
    nodes = materialize(top.select("depth", "p", "q", "o.conv_id", "o.length", "n", "n_words"), "nodes")
    chains = _first_owned(conversations, prefixes, nodes, root if n_all else 0)
    owning = chains.where("first <= length or above is null")
    at = [F.col("above").alias("conv_id"), (F.col("first") - 1).alias("depth")]
    hung = owning.where("above is not null").select(*at).distinct().withColumn("is_hung", F.lit(True))
    own = nodes.groupBy("conv_id").agg(F.sum((F.col("n") - 1) * F.col("n_words")).alias("saved"))
    single = owning.select("conv_id", F.col("length").alias("depth"), "first", "above").join(hung, ["conv_id", "depth"], "left").join(own, "conv_id", "left")
    totals = _subtree_totals(materialize(single.select("conv_id", "first", "above", F.when(F.col("is_hung"), 0).otherwise(1).cast("long").alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved")), "chain-sums"))
    below = totals.where("above is not null").groupBy(*at).agg(F.count(F.lit(1)).alias("c"), F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    heads = owning.where("above is not null").select("conv_id", F.col("first").alias("depth"), "above")
    ends = _listed(chains.select(F.when(F.expr("first <= length or above is null"), F.col("conv_id")).otherwise(F.col("above")).alias("node"), F.col("length").alias("depth"), F.col("conv_id").alias("ended")))
    kinds = "depth long, conv_id long, length long, n long, n_words long"
    start = conversations.sparkSession.createDataFrame([(0, root, root_length, n_all, 0)] if n_all else [], kinds)
    each = start.unionByName(nodes.select(*start.columns)).join(below, ["conv_id", "depth"], "left").join(heads, ["conv_id", "depth"], "left").join(ends, ["conv_id", "depth"], "left")
    children = ((F.col("depth") < F.col("length")).cast("long") + F.coalesce("c", F.lit(0))).alias("n_children")
    each = each.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"), F.col("n").alias("n_convs"), children,
        (F.coalesce("l", F.lit(0)) + (children == 0).cast("long")).alias("n_leaves"), ((F.col("n") - 1) * F.col("n_words") + F.coalesce("s", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
    return _running(each, ["n_leaves", "saved_tokens"], F.sum, Column.__add__, falling=True)
