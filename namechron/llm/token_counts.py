"""Token counts by a map-side two-tier lookup, without any shuffle of pre-tokens.

First tier: a compact table of the corpus's frequent pre-tokens and their token counts, small by
construction and broadcast; it comes from bounded per-task reports that are merged as a tree. Second tier: each worker's cache; its misses go to the
tokenizer in batches. A pre-token is a run of spaces with the run of other characters after it;
the model has no piece with a space behind another character, so no piece crosses pre-tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import chunks, map_batches
from ._frequent import frequent

#: Entries of the broadcast table, and the most bytes of one entry: together at most 1 MiB.
FREQUENT, LONGEST = 16_384, 64
#: Entries of a worker's own cache.
CACHE = 400_000
#: Stands for a space inside the model; in a text it reads like one.
SPACE_MARK = "▁"

_PRE_TOKEN = re.compile(" +[^ ]*")


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of ``text``, each without its first space (the model puts one before every text)."""
    if SPACE_MARK in text:
        text = text.replace(SPACE_MARK, " ")
    parts = text.split(" ")
    if "" in parts:
        return [] if not text else [p[1:] for p in _PRE_TOKEN.findall(" " + text)]
    return parts


def _load(model_path: str):
    if model_path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        # The library puts no space before an empty text, but a trailing space is a piece of its own.
        alone = 1 if model.piece_to_id(SPACE_MARK) != model.unk_id() else len(SPACE_MARK.encode())
        return lambda words: [len(ids) if w else alone for w, ids in zip(words, model.encode(words, num_threads=1), strict=True)]
    raise ValueError(f"not a model file with space-bound pieces: {model_path}")


def pack_table(words: list[str], model_path: str) -> tuple[bytes, bytes]:
    """The compact table: pre-tokens joined by NUL, and a byte for the token count of each."""
    kept = [w for w in words if "\0" not in w and len(w.encode()) <= LONGEST]
    lengths = _load(model_path)(kept) if kept else []
    return "\0".join(kept).encode(), bytes(lengths)  # at most LONGEST + 1 tokens each


def _unpack(packed: tuple[bytes, bytes]) -> dict[str, int]:
    names, lengths = packed
    return dict(zip(names.decode().split("\0"), lengths, strict=True)) if lengths else {}


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text.

    Counts equal those of the library's ``encode`` without begin, end or special tokens. Null texts
    count as empty: no bytes, no tokens. Repeated rows give repeated results; a null doc_id stays
    null; other columns are ignored.
    """
    table = docs.sparkSession.sparkContext.broadcast(pack_table(frequent(docs, pre_tokens, FREQUENT, LONGEST), model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, common, cache = _load(model_path), _unpack(table.value), {}
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            sizes, counts = [], []
            for a, b in chunks(texts):
                words = [pre_tokens(t) if t else [] for t in texts[a:b]]
                seen: set[str] = set()
                for w in words:
                    seen.update(w)
                known = {w: n for w in seen if (n := common.get(w, cache.get(w))) is not None}
                new = [w for w in seen if w not in known]
                fresh = dict(zip(new, encode(new), strict=True)) if new else {}
                if len(cache) + len(fresh) > CACHE:
                    cache = {}
                cache.update(fresh) if len(fresh) <= CACHE else None
                known.update(fresh)
                counts += [sum(map(known.__getitem__, w)) for w in words]
                sizes += [len(t.encode()) for t in texts[a:b]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
