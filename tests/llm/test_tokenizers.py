"""Tokenizer operators against the public libraries, on texts with every kind of white space."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece

from namechron.llm import byte_bpe, token_counts
from namechron.llm._frequent import frequent
from namechron.llm.queries import BPE_RANKS, PIECE_MODEL

RANKS = P.path(BPE_RANKS)
MODEL = P.path(PIECE_MODEL)

TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\n\n b", "a\n \nb", "a \n b", "a\t b   c", "Straße, don't! 12½ x²", "<s>x</s> <|endoftext|>",
    "▁a ▁b", "　日本語 テキスト🎉👩‍👩‍👧 é", "x" * 3000, "aaaa aaaaa aaa", "  indented\n    code()\n\treturn  1 ", "\x00 \x00a", "a\x1c b", "word " * 2000,
]


def _random_texts(n):
    random.seed(4)
    parts = ["the", "The", "ing", "é", "ß", " ", "  ", "\n", "\t", " ", "12", "'s", "'ll", "!?", "日", "🎉", "▁", "\r\n"]
    return ["".join(random.choice(parts) for _ in range(random.randrange(60))) for _ in range(n)]


@pytest.fixture(scope="module")
def bpe():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})


def _docs(spark, texts):
    return spark.createDataFrame([(i, t, "junk") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")


def test_bpe_equals_library(spark, bpe):
    texts = TEXTS + _random_texts(300)
    rows = {r["doc_id"]: r for r in byte_bpe.bpe_digests(_docs(spark, texts), RANKS, P.PATTERN).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        ids = bpe.encode_ordinary(text or "")
        assert rows[i]["n_tokens"] == len(ids), text
        assert rows[i]["ids_sha256"] == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), text
        assert rows[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_round_trip(spark):
    docs = _docs(spark, TEXTS)
    back = {r["doc_id"]: r["text"] for r in byte_bpe.decode_documents(byte_bpe.encode_documents(docs, RANKS, P.PATTERN), RANKS).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}


def test_merge_order_when_a_lower_rank_comes_up():
    single = {bytes([b]): b for b in range(256)}
    replay = byte_bpe.MergeReplay({**single, b"ab": 300, b"aba": 256, b"bb": 301})
    # merging the first ab makes aba, whose rank is lower than that of the second ab
    for word in (b"abab", b"ab" * 40 + b"c"):
        ids = byte_bpe._ids_of(replay.encode([word])[0])
        assert [replay.tokens[i] for i in ids][:2] == [b"aba", b"b"] and b"".join(replay.tokens[i] for i in ids) == word
    assert [byte_bpe._ids_of(x) for x in replay.encode([b"", b"bbb"])] == [[], [301, 98]]


def test_long_and_short_words_merge_alike(bpe, monkeypatch):
    random.seed(9)
    words = ["".join(random.choices("etaoinshrdlu\u00e9\u65e5_-", k=random.randrange(1, 60))).encode() for _ in range(400)] + [b"x" * 63, b"x" * 64, b"x" * 5000]
    want = [bpe._encode_single_piece(w) for w in words]
    for at in (2, 64, 10_000):
        monkeypatch.setattr(byte_bpe, "LONG", at)
        assert [byte_bpe._ids_of(x) for x in byte_bpe.MergeReplay(byte_bpe.load_ranks(RANKS)).encode(words)] == want


def test_bpe_cuts_long_texts(spark, bpe, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PIECE", 50)
    monkeypatch.setattr(byte_bpe, "CACHE", 20)
    encoder = byte_bpe.Encoder(byte_bpe.load_ranks(RANKS), P.PATTERN)
    texts = ["one two  three\n four " * 30, *_random_texts(50), " ".join(_random_texts(20))]
    for text, parts in zip(texts, encoder.encode_many(texts), strict=True):
        assert [i for p in parts for i in byte_bpe._ids_of(p)] == bpe.encode_ordinary(text)


def test_bpe_with_a_small_table(spark, bpe, monkeypatch):
    monkeypatch.setattr(byte_bpe, "FREQUENT", 5)
    monkeypatch.setattr(byte_bpe, "REPLAY_CHARS", 100)
    texts = TEXTS[:-1] + _random_texts(60) + ["the same words again and again " * 50] * 5
    docs = _docs(spark, texts).repartition(12)
    assert len(byte_bpe.frequent_table(docs, RANKS, P.PATTERN)[0].split(" ")) == 5
    rows = byte_bpe.encode_documents(docs, RANKS, P.PATTERN).collect()
    assert {r["doc_id"]: r["token_ids"] for r in rows} == {i: bpe.encode_ordinary(t or "") for i, t in enumerate(texts)}


def test_frequent_strings_of_many_partitions(spark):
    texts = ["a a a a a b b b c c d"] * 40 + [None, "", "e " * 1000]
    docs = _docs(spark, texts).repartition(30)
    assert frequent(docs, str.split, 4, 10) == ["e", "a", "b", "c"]
    assert frequent(docs.limit(0), str.split, 4, 10) == []


def test_empty_tables(spark):
    none = _docs(spark, TEXTS).limit(0)
    assert byte_bpe.bpe_digests(none, RANKS, P.PATTERN).count() == 0
    assert token_counts.count_tokens(none, MODEL).count() == 0


def test_counts_equal_library(spark, monkeypatch):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = TEXTS + _random_texts(300)
    rows = {r["doc_id"]: r for r in token_counts.count_tokens(_docs(spark, texts), MODEL, limit=100).collect()}
    for i, text in enumerate(texts):
        n = len(model.encode(text or ""))
        assert (rows[i]["n_tokens"], rows[i]["n_bytes"], rows[i]["over_limit"]) == (n, len((text or "").encode()), n > 100), text


def test_pieces_equal_the_library(spark):
    from namechron.llm.piece_bpe import encode_texts, load, piece_digests

    path = MODEL
    library, model = sentencepiece.SentencePieceProcessor(model_file=path), load(path)
    random.seed(11)
    parts = [*"abcdeéöß 日本語🙂\t\n\0▁ﬁ<s>/", "  ", " " * 7, "<s>", "the ", "ing", "aaaa", "==", "\n\n", "　", "\xa0", "⁇", " ⁇ ", "ab" * 9]
    texts = ["", " ", "  ", " " * 40, "▁", "a" * 3000, "ab" * 2000, " " * 999 + "x", "= " * 5000, "語" * 4000] + ["".join(random.choices(parts, k=random.randint(1, 60))) for _ in range(3000)]
    got = [np.frombuffer(x, "<u4") for x in model.encode(texts)]
    assert [g.tolist() for g in got] == library.encode(texts, num_threads=1)
    assert [model.decode(np.r_[model.begin, g, model.end].astype("u4")) for g in got] == [library.decode([1, *g.tolist(), 2]) for g in got]
    # Any ids, also byte pieces that are no UTF-8 and control ids between them
    odd = [[random.choice([0, 1, 2, 259, 28705, 264, *range(3, 259), *random.sample(range(32000), 9)]) for _ in range(random.randint(1, 9))] for _ in range(3000)]
    assert [model.decode(np.array(ids, "u4")) for ids in odd] == [library.decode(ids) for ids in odd]

    docs = spark.createDataFrame([(1, None, 7), (None, "", 8), (2, "a  b", 9), (2, "a  b", 9), (3, "語 " * 3, None)], "doc_id long, text string, ids int")
    for r in piece_digests(docs, path).collect():
        text = {2: "a  b", 3: "語 " * 3}.get(r["doc_id"], "")
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
    assert {r["doc_id"]: r["ids"] for r in encode_texts(docs, path).collect()}[2] == library.encode("a  b", add_bos=True, add_eos=True)
    assert piece_digests(docs.limit(0), path).count() == 0
