"""SentencePiece encoding and decoding by vectorised merge rounds.

A text becomes words, each with the spaces before it; no piece of such a model has a space behind
another character, so no merge crosses words. The new words of a batch are laid out as one flat
array of symbols. In every round each word takes its smallest pair rank (a segmented minimum),
all words merge the leftmost pairs of that rank at the same time, the ranks beside them are looked
up again, and the array is compacted; words without a pair are done and leave it.

A pair that a merge makes and that isn't worse than the merge itself must come before the word's
other pairs of that rank. Words where this happens (long runs of spaces, whose pieces all have one
score) are encoded by a queue of pairs instead, in the same order as the library takes them.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import chunks, map_batches
from .token_counts import SPACE_MARK, pre_tokens

#: Types of pieces in the model's file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Words whose ids one Python worker keeps; beyond it the cache starts anew.
CACHE = 600_000
#: Characters whose new words one run of merge rounds takes.
ROUND_CHARS = 2_000_000
#: The rank of two symbols that make no piece, and the id of a character that is no piece.
NO_RANK, NO_ID = 1 << 30, -1
#: What the library writes for an unknown piece.
UNKNOWN_SURFACE = " ⁇ "


def _fields(data: bytes) -> Iterator[tuple[int, int | float | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        elif key & 7 == 2:
            size = number()
            yield key >> 3, data[at : at + size]
            at += size
        else:
            size, form = {5: (4, "<f"), 1: (8, "<d")}[key & 7]
            yield key >> 3, struct.unpack(form, data[at : at + size])[0]
            at += size


def _read_pieces(path: str) -> tuple[list[str], list[float], list[int]]:
    """Pieces, scores and types in the order of ids; refuses what the rounds don't cover."""
    with open(path, "rb") as f:
        model = list(_fields(f.read()))
    rows = [dict(_fields(v)) for k, v in model if k == 1]
    pieces, scores, types = [r[1].decode() for r in rows], [r.get(2, 0.0) for r in rows], [r.get(3, NORMAL) for r in rows]
    trainer, normalizer = (dict(next((list(_fields(v)) for k, v in model if k == n), [])) for n in (2, 3))
    if trainer.get(3) != 2 or normalizer.get(2) or normalizer.get(3, 1) != 1 or normalizer.get(4, 1) != 0 or types.count(BYTE) != 256 or not {*types} <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError(f"not a BPE model with byte fallback, a space before each text and no other normalization: {path}")
    if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p, t in zip(pieces, types, strict=True) if t == NORMAL):
        raise ValueError(f"pieces hold a space behind another character: {path}")
    return pieces, scores, types


class PieceModel:
    """A model's tables as arrays, and the ids of words that were met lately."""

    def __init__(self, path: str):
        pieces, scores, types = _read_pieces(path)
        ids = {p: i for i, (p, t) in enumerate(zip(pieces, types, strict=True)) if t == NORMAL}
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in ids.values()}, reverse=True))}  # equal scores share a rank
        self.begin, self.end = (next((i for i, p in enumerate(pieces) if p == name and types[i] == CONTROL), None) for name in ("<s>", "</s>"))
        self.bytes = np.zeros(256, np.int64)
        self.raw = [b""] * len(pieces)  # what an id decodes to
        for i, (piece, kind) in enumerate(zip(pieces, types, strict=True)):
            if kind == BYTE:
                self.bytes[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif kind != CONTROL:
                self.raw[i] = (piece.replace(SPACE_MARK, " ") if kind == NORMAL else UNKNOWN_SURFACE).encode()
        self.is_byte = np.zeros(len(pieces), bool)
        self.is_byte[self.bytes] = True
        self.is_control = np.array([t == CONTROL for t in types])
        singles = sorted((ord(p), i) for p, i in ids.items() if len(p) == 1)
        self.points, self.point_ids = np.array([c for c, _ in singles], np.int64), np.array([i for _, i in singles], np.int64)
        pairs = sorted((ids[p[:k]] << 32 | ids[p[k:]], order[scores[i]], i) for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids)
        self.keys, self.ranks, self.made = (np.array([x[c] for x in pairs], np.int64) for c in range(3))
        # Open addressing: a slot holds the place of a key; collisions go to the next slot.
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.slots = np.full((1 << self.bits) + 64, -1, np.int64)
        for place, slot in enumerate(self._slot(self.keys).tolist()):
            while self.slots[slot] >= 0:
                slot += 1
            self.slots[slot] = place
        self.by_pair = {k: (r, i) for k, r, i in pairs}
        self.cache: dict[str, bytes] = {}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair of ids, NO_RANK where it makes no piece."""
        rank, made = np.full(len(left), NO_RANK, np.int64), np.full(len(left), NO_ID, np.int64)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left[open_] << 32 | right[open_]
        slot = self._slot(keys)
        while len(open_):
            place = self.slots[slot]
            hit = (place >= 0) & (self.keys[place] == keys)
            rank[open_[hit]], made[open_[hit]] = self.ranks[place[hit]], self.made[place[hit]]
            more = (place >= 0) & ~hit
            open_, keys, slot = open_[more], keys[more], slot[more] + 1
        return rank, made

    def _symbols(self, points: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        return np.where(self.points[place] == points, self.point_ids[place], NO_ID)

    def _by_queue(self, symbols: list[int]) -> list[tuple[int, int]]:
        """(id, place of its first character) of one word, merged pair by pair: best rank, then leftmost."""
        n = len(symbols)
        before, after, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
        queue: list[tuple[int, int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j >= 0 and (found := self.by_pair.get(symbols[i] << 32 | symbols[j])) and symbols[i] >= 0 and symbols[j] >= 0:
                heapq.heappush(queue, (found[0], i, symbols[i], symbols[j], found[1]))

        for i in range(n):
            push(i)
        while queue:
            _, i, left, right, made = heapq.heappop(queue)
            j = after[i]
            if not alive[i] or j < 0 or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i], alive[j], after[i] = made, False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            push(before[i])
            push(i)
        return [(symbols[i], i) for i in range(n) if alive[i]]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word (without its first space) as little-endian unsigned 32-bit integers."""
        words = [SPACE_MARK + w.replace(" ", SPACE_MARK) for w in words]
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        begins = np.cumsum(sizes) - sizes
        first = self._symbols(points)
        ids, word, at = first.copy(), np.repeat(np.arange(len(words)), sizes), np.arange(len(points))
        rank, made = self._beside(ids, word, np.arange(len(ids)))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(ids):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            spans = np.diff(np.r_[starts, len(ids)])
            least = np.minimum.reduceat(rank, starts)
            over = np.repeat(least == NO_RANK, spans)
            if over.any():
                done.append((word[over], ids[over], at[over]))
                keep = ~over
                ids, word, at, rank, made = ids[keep], word[keep], at[keep], rank[keep], made[keep]
                open_ = least != NO_RANK
                least, spans = least[open_], spans[open_]
                if not len(ids):
                    break
            least = np.repeat(least, spans)
            place = np.flatnonzero(rank == least)
            # Pairs of a rank that overlap lie side by side: take every second one from the left.
            run = np.flatnonzero(np.r_[True, np.diff(place) != 1])
            place = place[(np.arange(len(place)) - np.repeat(run, np.diff(np.r_[run, len(place)]))) % 2 == 0]
            ids[place] = made[place]
            keep = np.ones(len(ids), bool)
            keep[place + 1] = False
            moved = np.cumsum(keep) - 1
            ids, word, at, rank, made, least = ids[keep], word[keep], at[keep], rank[keep], made[keep], least[keep]
            now = moved[place]
            flags = np.zeros(len(ids), bool)
            flags[now] = flags[now[now > 0] - 1] = True
            touched = np.flatnonzero(flags)
            rank[touched], made[touched] = self._beside(ids, word, touched)
            early = touched[rank[touched] <= least[touched]]
            if len(early):
                odd = np.unique(word[early])
                for w in odd.tolist():
                    a = int(begins[w])
                    found = self._by_queue(first[a : a + int(sizes[w])].tolist())
                    done.append((np.full(len(found), w), np.array([i for i, _ in found]), np.array([a + p for _, p in found])))
                keep = ~np.isin(word, odd)
                ids, word, at, rank, made = ids[keep], word[keep], at[keep], rank[keep], made[keep]
        return self._with_bytes(points, len(words), *(np.concatenate([d[c] for d in done]) if done else np.zeros(0, np.int64) for c in range(3)))

    def _beside(self, ids: np.ndarray, word: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of the symbol at each place with the one after it in its word."""
        after = np.minimum(places + 1, len(ids) - 1)
        same = (after > places) & (word[after] == word[places])
        return self.pairs(ids[places], np.where(same, ids[after], NO_ID))

    def _with_bytes(self, points: np.ndarray, n_words: int, word: np.ndarray, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        order = np.argsort(word, kind="stable")
        word, ids, at = word[order], ids[order], at[order]
        lost = np.flatnonzero(ids == NO_ID)
        if len(lost):  # characters that are no piece become their bytes
            c = points[at[lost]]
            width = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
            raw = np.frombuffer("".join(map(chr, c.tolist())).encode(), np.uint8)
            times = np.ones(len(ids), np.int64)
            times[lost] = width
            is_byte = np.repeat(ids == NO_ID, times)
            word, ids = np.repeat(word, times), np.repeat(ids, times)
            ids[is_byte] = self.bytes[raw]
        packed, ends = ids.astype("<u4").tobytes(), np.searchsorted(word, np.arange(n_words + 1)) * 4
        return [packed[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, without begin and end, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for a, b in chunks(texts, ROUND_CHARS):
            split = [pre_tokens(t) if t else [] for t in texts[a:b]]
            new = list(dict.fromkeys(w for words in split for w in words if w not in self.cache))
            known = self.cache
            if new:
                fresh = dict(zip(new, self.encode_words(new), strict=True))
                if len(known) + len(fresh) > CACHE:
                    known = {w: known[w] for words in split for w in words if w in known} | fresh
                    self.cache = fresh if len(fresh) <= CACHE else {}
                else:
                    known.update(fresh)
            out += [b"".join(map(known.__getitem__, words)) for words in split]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces as they are, runs of byte pieces as UTF-8 (U+FFFD for each byte that isn't), without the space put before the text."""
        cut, ids = self.is_control[ids[1:-1]].any(), ids.tolist()
        try:
            text = None if cut else b"".join(map(self.raw.__getitem__, ids)).decode()
        except UnicodeDecodeError:  # a run of byte pieces that isn't UTF-8
            text = None
        if text is None:
            parts, held = [], bytearray()
            for i in [*ids, None]:
                if i is not None and self.is_byte[i]:
                    held += self.raw[i]
                    continue
                if held:
                    parts.append(_utf8(bytes(held)))
                    held.clear()
                if i is not None:
                    parts.append(self.raw[i].decode())
            text = "".join(parts)
        first = next((i for i in ids if self.raw[i]), None)
        return text[1:] if first is not None and not self.is_byte[first] and self.raw[first].startswith(b" ") and self.raw[first] != UNKNOWN_SURFACE.encode() else text


def _utf8(data: bytes) -> str:
    try:
        return data.decode()
    except UnicodeDecodeError as e:
        return data[: e.start].decode() + "�" + _utf8(data[e.start + 1 :])


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


def piece_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text, with begin and end ids.

    Ids equal those of the library's ``encode`` with begin and end; decoded texts those of its
    ``decode``. Null texts count as empty: begin and end alone. Repeated rows give repeated results;
    a null doc_id stays null; an empty table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        begin, end = (np.array([i], "<u4").tobytes() for i in (model.begin, model.end))
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for ids in model.encode([t or "" for t in batch.column("text").to_pylist()]):
                ids = begin + ids + end
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(model.decode(np.frombuffer(ids, "<u4")).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with the column ids (array<long>, begin and end included) in place of one of that name; nulls as in :func:`piece_digests`."""
    own = docs.drop("ids")
    schema = f"{', '.join(f'`{c}` {t}' for c, t in own.dtypes)}{', ' if own.columns else ''}ids array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            ids = [[model.begin, *np.frombuffer(i, "<u4").tolist(), model.end] for i in model.encode([t or "" for t in batch.column("text").to_pylist()])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int64()))], names=[*batch.schema.names, "ids"])

    return map_batches(own, run, schema)
