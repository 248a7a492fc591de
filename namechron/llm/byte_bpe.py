"""Byte-level BPE by corpus-level merge replay.

1. Every task counts the chunks of its texts (the parts between spaces) and reports the frequent
   ones; the corpus's most frequent chunks are split by the pattern, replayed once and broadcast
   as a table of bounded size.
2. The index of the replay leads from the rank of a pair to the place in each word where it
   stands. Merges in different words never touch, so every word takes its next merge in rank order
   at one step, and only the pairs beside that place are looked up again. Long words go through
   the same index rank by rank.
3. Documents are put together from the table. Chunks beyond its bound are replayed by the worker
   that meets them, all new ones of a batch together, and kept for its later tasks.

No pre-token is shuffled, and no result depends on the table's choice.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._common import chunks, map_batches
from ._frequent import frequent

#: Entries of the broadcast table, and the most bytes of an entry: 4 million ids and 8 MiB of names at most.
FREQUENT, LONGEST = 131_072, 64
#: Most chunks, and pre-tokens, whose ids one Python worker keeps beside the table; beyond it the cache starts anew.
CACHE = 600_000
#: Characters whose new chunks one merge replay takes.
REPLAY_CHARS = 2_000_000
#: Pairs of tokens whose rank one Python worker keeps for long words.
PAIRS = 200_000
#: Characters of one document that are split at a time.
PIECE = 1 << 20
#: Bytes of a word from which on it goes rank by rank, and bytes of the words that are replayed at one step.
LONG, STEP_BYTES = 64, 1 << 21
#: The rank of two tokens that make none.
NO_RANK = 1 << 30
_SPACE_PAIR = re.compile(r" (?:\s|$)")


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a rank file: base64 of the token's bytes, a space, the rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class MergeReplay:
    """Applies the merges of ``ranks`` to many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.first = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        #: Rank of the token that two bytes make; row and column 256 stand for a word's end.
        self.of_bytes = np.full((257, 257), NO_RANK, np.int64)
        self.of_bytes[:256, :256] = [[ranks.get(bytes([a, b]), NO_RANK) for b in range(256)] for a in range(256)]
        halves = ((ranks.get(token[:i]), ranks.get(token[i:]), rank) for token, rank in ranks.items() for i in range(1, len(token)))
        made = np.array([(a << 32 | b, rank) for a, b, rank in halves if a is not None and b is not None] + [(1 << 62, NO_RANK)], np.int64)
        made = made[made[:, 0].argsort()]
        self.pairs, self.pair_ranks = made[:, 0].copy(), made[:, 1].copy()
        self.joined: dict[int, int] = {}

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        both = a << 32 | b
        at = np.searchsorted(self.pairs, both)
        return np.where(self.pairs[at] == both, self.pair_ranks[at], NO_RANK)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each word as little-endian unsigned 32-bit integers; an empty word has none."""
        out = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            rank = self.ranks.get(word)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif word:
                by_length.setdefault(min(len(word), LONG), []).append(i)
        long_words = by_length.pop(LONG, [])
        for length, places in by_length.items():
            for a in range(0, len(places), STEP_BYTES // length):
                some = places[a : a + STEP_BYTES // length]
                self._replay(np.frombuffer(b"".join([words[i] for i in some]), np.uint8).reshape(len(some), length), some, out)
        if long_words:
            for i, ids in zip(long_words, self._replay_long([words[i] for i in long_words]), strict=True):
                out[i] = np.array(ids, "<u4").tobytes()
        return out

    def _replay(self, data: np.ndarray, places: list[int], out: list[bytes]) -> None:
        """Words of one length (a row each); every step takes one merge of each word that has one left."""
        own = np.array(places)
        symbols, ranks = self.first[data], self.of_bytes[data[:, :-1], data[:, 1:]]
        while True:
            each, length = np.arange(len(symbols)), symbols.shape[1]
            at = ranks.argmin(axis=1) if length > 1 else each
            least = ranks[each, at] if length > 1 else np.full(len(symbols), NO_RANK)
            going = least < NO_RANK
            if not going.all():
                packed, size = symbols[~going].astype("<u4").tobytes(), 4 * length
                for n, i in enumerate(own[~going].tolist()):
                    out[i] = packed[n * size : (n + 1) * size]
                own, symbols, ranks, at, least = own[going], symbols[going], ranks[going], at[going], least[going]
                each = np.arange(len(symbols))
            if not len(own):
                return
            column = np.arange(length - 1)
            symbols = np.where(column > at[:, None], symbols[:, 1:], symbols[:, :-1])
            symbols[each, at] = least
            ranks = np.where(column[:-1] >= at[:, None], ranks[:, 1:], ranks[:, :-1])
            for side in (at - 1, at):
                inside = np.flatnonzero((side >= 0) & (side < length - 2))
                i, j = each[inside], side[inside]
                ranks[i, j] = self._rank(symbols[i, j], symbols[i, j + 1])

    def _start(self, words: list[bytes]) -> tuple[list[int], list[int], dict[int, list[int]]]:
        """Symbols (-1 ends a word), the rank of each place's pair, and the index from rank to places in order."""
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        inside = np.ones(ends[-1] + 1, bool)
        inside[ends] = False
        data = np.full(len(inside), 256)
        data[inside] = np.frombuffer(b"".join(words), np.uint8)
        symbols = np.where(inside, self.first[data.clip(max=255)], -1)
        pair = np.append(self.of_bytes[data[:-1], data[1:]], NO_RANK)
        pair[pair == NO_RANK] = -1
        places = np.flatnonzero(pair >= 0)
        places = places[np.argsort(pair[places], kind="stable")]
        found, starts = np.unique(pair[places], return_index=True)
        lists = np.split(places, starts[1:])
        return symbols.tolist(), pair.tolist(), {r: p.tolist() for r, p in zip(found.tolist(), lists, strict=False)}

    def _replay_long(self, words: list[bytes]) -> list[list[int]]:
        """One index over all words, from the rank of a pair to the places where it stands; ranks in order."""
        if len(self.joined) > PAIRS:
            self.joined.clear()
        joined, tokens, ranks = self.joined, self.tokens, self.ranks
        symbols, pair, index = self._start(words)
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        queue = sorted(index)
        push, pop = heapq.heappush, heapq.heappop
        while queue:
            r = pop(queue)
            places = index.pop(r, None)
            if places is None:
                continue
            places.sort()
            for n, i in enumerate(places):
                if pair[i] != r:
                    continue
                j = after[i]
                k = after[j]
                symbols[i], after[i], before[k], pair[j] = r, k, i, -1
                lower = False
                for at, a, b in ((i, r, symbols[k]), (before[i], symbols[before[i]], r)):
                    if at < 0 or a < 0 or b < 0:
                        if at == i:
                            pair[i] = -1
                        continue
                    both = a << 20 | b
                    x = joined.get(both)
                    if x is None:
                        x = joined[both] = ranks.get(tokens[a] + tokens[b], -1)
                    pair[at] = x
                    if x >= 0:
                        own = index.get(x)
                        if own is None:
                            index[x] = [at]
                            push(queue, x)
                        else:
                            own.append(at)
                        if x < r:
                            lower = True
                if lower and n + 1 < len(places):  # an earlier rank has come up: it goes first
                    if r not in index:
                        index[r] = []
                        push(queue, r)
                    index[r].extend(places[n + 1 :])
                    break
        out, i = [], 0
        for word in words:
            ids, at = [], i
            while symbols[at] >= 0:
                ids.append(symbols[at])
                at = after[at]
            out.append(ids)
            i += len(word) + 1
        return out

def _pieces(text: str) -> Iterator[str]:
    """``text`` cut before spaces that follow a character other than white space: no pre-token is cut."""
    begin = 0
    while len(text) - begin > PIECE:
        cut = text.find(" ", begin + PIECE)
        while cut > 0 and text[cut - 1].isspace():
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[begin:cut]
        begin = cut
    yield text[begin:]


class Encoder:
    """Whole texts to token ids, from the ids of their chunks and pre-tokens.

    A text falls at its spaces into chunks that can be split by the pattern alone; where white
    space stands beside a space, the whole piece goes through the pattern instead.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.replay = MergeReplay(ranks)
        self.pattern = regex.compile(pattern)
        self.table: dict[str, bytes] = {}  # the broadcast table
        self.chunk_ids: dict[str, bytes] = {}
        self.token_ids: dict[str, bytes] = {}

    def units(self, text: str) -> Iterator[tuple[list[str], list[str]]]:
        """(chunks, pre-tokens) of each piece of ``text``; a piece without chunks is all pre-tokens."""
        for piece in _pieces(text):
            if _SPACE_PAIR.search(piece):
                yield [], self.pattern.findall(piece)
            else:
                # a piece either begins a text or with a space; then its first part is empty
                first, *rest = piece.split(" ")
                yield rest, self.pattern.findall(first) if first else []

    def learn(self, new_chunks: set[str], new_words: set[str]) -> None:
        """Bring all of both sets into the caches by one merge replay."""
        fresh = [c for c in new_chunks if c not in self.chunk_ids]
        if len(self.chunk_ids) + len(fresh) > CACHE + len(self.table):
            self.chunk_ids = dict(self.table)
            fresh = [c for c in new_chunks if c not in self.chunk_ids]
        split = [self.pattern.findall(" " + c) for c in fresh]
        words = list({w for parts in split for w in parts} | new_words)
        ids = dict(zip(words, self.replay.encode([w.encode() for w in words]), strict=True))
        self.chunk_ids.update((c, b"".join([ids[w] for w in parts])) for c, parts in zip(fresh, split, strict=True))
        if len(self.token_ids) > CACHE:
            self.token_ids = {}
        self.token_ids.update((w, ids[w]) for w in new_words)

    def _joined(self, units: list[tuple[list[str], list[str]]]) -> Iterator[bytes]:
        for own, words in units:
            yield b"".join([self.token_ids[w] for w in words]) + b"".join(map(self.chunk_ids.__getitem__, own))

    def _learned(self, units: list[tuple[list[str], list[str]]]) -> None:
        seen: set[str] = set()
        words: set[str] = set()
        for own, first in units:
            seen.update(own)
            words.update(first)
        self.learn(seen, words)

    def _long(self, text: str) -> Iterator[bytes]:
        for unit in self.units(text):
            self._learned([unit])
            yield from self._joined([unit])

    def encode_many(self, texts: list[str]) -> Iterator[Iterator[bytes]]:
        """For each text the ids, as little-endian unsigned 32-bit integers, piece by piece; each must be read before the next."""
        short = [list(self.units(t)) if len(t) <= PIECE else None for t in texts]
        self._learned([u for units in short if units for u in units])
        at_hand = [None if units is None else list(self._joined(units)) for units in short]
        for text, parts in zip(texts, at_hand, strict=True):
            yield self._long(text) if parts is None else iter(parts)


@lru_cache(maxsize=1)
def _worker_encoder(ranks_path: str, pattern: str) -> Encoder:
    """The encoder that a Python worker keeps from task to task."""
    return Encoder(load_ranks(ranks_path), pattern)


def _ids_of(part: bytes) -> list[int]:
    return memoryview(part).cast("I").tolist()


def _chunks_of(text: str) -> list[str]:
    """Chunks of a text; parts that can't be split by themselves name nothing and are never looked up."""
    return [part for part in text.split(" ")[1:] if part and not part[0].isspace()]


def frequent_table(docs: DataFrame, ranks_path: str, pattern: str) -> tuple[str, bytes, bytes]:
    """The corpus's most frequent chunks after one replay: names joined by spaces, numbers of ids, ids."""
    names = frequent(docs, _chunks_of, FREQUENT, LONGEST)
    encoder = Encoder(load_ranks(ranks_path), pattern)
    encoder.learn(set(names), set())
    ids = [encoder.chunk_ids[n] for n in names]
    return " ".join(names), np.array([len(x) for x in ids], np.int32).tobytes(), b"".join(ids)


def _unpacked(table: tuple[str, bytes, bytes]) -> dict[str, bytes]:
    names, sizes, ids = table
    ends = np.cumsum(np.frombuffer(sizes, np.int32)).tolist()
    return {name: ids[a:b] for name, a, b in zip(names.split(" "), [0, *ends], ends, strict=False)} if ends else {}


def _encoded(docs: DataFrame, ranks_path: str, pattern: str, finish: Callable, names: list[str], kinds: list[pa.DataType], schema: str) -> DataFrame:
    """doc_id and the results of ``finish`` (tokens, parts of ids) for each row of ``docs``."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_table(docs, ranks_path, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(ranks_path, pattern)
        encoder.table = _unpacked(table.value)
        encoder.chunk_ids.update(encoder.table)
        for batch in batches:
            ids, texts = batch.column("doc_id").cast(pa.int64()), [t or "" for t in batch.column("text").to_pylist()]
            for a, b in chunks(texts, REPLAY_CHARS):
                found = [finish(encoder.replay.tokens, parts) for parts in encoder.encode_many(texts[a:b])]
                columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), *columns], names=["doc_id", *names])

    return map_batches(docs.select("doc_id", "text"), run, schema)


def bpe_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode and decode every whole text: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Each match of ``pattern`` is encoded by itself, without special tokens. Null texts count as
    empty: no tokens, digests of nothing. Repeated rows give repeated results; a null doc_id stays
    null; other columns are ignored.
    """

    def finish(tokens: dict[int, bytes], parts: Iterator[bytes]) -> tuple[int, str, str]:
        n, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
        for part in parts:
            n += len(part) // 4
            of_ids.update(part)
            of_bytes.update(b"".join(map(tokens.__getitem__, _ids_of(part))))
        return n, of_ids.hexdigest(), of_bytes.hexdigest()

    kinds = [pa.int64(), pa.string(), pa.string()]
    return _encoded(docs, ranks_path, pattern, finish, ["n_tokens", "ids_sha256", "decoded_sha256"], kinds, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and token_ids (array of int) of every whole text; null texts have an empty array.

    Repeated rows give repeated results; a null doc_id stays null; other columns are ignored.
    """

    def finish(_tokens: dict[int, bytes], parts: Iterator[bytes]) -> tuple[list[int]]:
        return ([i for part in parts for i in _ids_of(part)],)

    return _encoded(docs, ranks_path, pattern, finish, ["token_ids"], [pa.list_(pa.int32())], "doc_id long, token_ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id and the decoded text of rows (doc_id, token_ids); a null array gives an empty text.

    Repeated rows give repeated results; a null doc_id stays null; other columns are ignored; an id
    that the ranks lack is an error; bytes that aren't UTF-8 read as U+FFFD.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in load_ranks(ranks_path).items()}
        for batch in batches:
            texts = [b"".join(map(tokens.__getitem__, ids or [])).decode("utf-8", "replace") for ids in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "token_ids"), run, "doc_id long, text string")
