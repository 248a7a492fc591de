"""Ranked lexical search and the conversation trie against brute force, with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from namechron.llm import conversation_trie, lexical_search
from namechron.llm.conversation_trie import as_they_are, numbered, prefix_trie, with_shared_heads
from namechron.llm.lexical_search import build_index, search

DOCS = "doc_id long, text string, terms int"
ITEMS = "item_id long, text string, block int"


def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _ranked(docs, items, k):
    docs = [(i, Counter(_terms(t))) for i, t, _ in docs if i is not None]
    n_docs, n_terms = sum(bool(c) for _, c in docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = defaultdict(set)
    for i, t, _ in items:
        if i is not None:
            asked[i] |= set(_terms(t))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc_id, c in docs:
            m = c and 50 + 50 * c.total() * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            scores += [(-score, doc_id)] * (score > 0)
        out += [(item, rank, doc_id, -s) for rank, (s, doc_id) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("item_chars, docs_in_block", [(2_000_000, 64), (300, 3)])
def test_search_ranks_like_brute_force(spark, monkeypatch, item_chars, docs_in_block):
    monkeypatch.setattr(lexical_search, "ITEM_CHARS", item_chars)
    random.seed(12)
    words = ["the", "The", "of", *(f"w{i}" for i in range(60)), "Straße", "日本", "É", "x1", "a'b", "c-d"]
    weights = [40, 20, 30] + [1] * (len(words) - 3)
    docs = [(i, " ".join(random.choices(words, weights, k=random.choice([1, 3, 20, 60]))), i) for i in range(150)]
    docs += [(None, "the w1 w2", 0), (200, None, 0), (201, "", 1), (202, "--- \n", 2), (7, "w1 w1 w1", 3), (7, "w1 w1 w1", 3), (203, "the " * 30000, 4), (204, "\x7f\x00é", 5)]
    items = [(i, " ".join(random.choices(words, k=12)), i) for i in range(25)] + [(30, None, 0), (31, "?!", 0), (None, "the", 0), (32, "w1", 1), (32, "W2 w2", 1), (32, "w1", 1), (33, "unseen", 2), (34, "the", 1)]
    index = build_index(spark.createDataFrame(docs, DOCS).repartition(3), docs_in_block)
    found = search(index, spark.createDataFrame(items, ITEMS), k=5)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect())) == _ranked(docs, items, 5)


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", 0)], DOCS), spark.createDataFrame([(1, "a", 0)], ITEMS)
    assert search(build_index(docs.limit(0)), items).count() == 0
    assert search(build_index(docs), items.limit(0)).count() == 0
    assert search(build_index(docs.withColumn("text", docs.text.substr(1, 0))), items).count() == 0
    assert [tuple(r)[:3] for r in search(build_index(docs), items).collect()] == [(1, 1, 1)]


def _words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def _trie(rebuilt):
    nodes = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    children = defaultdict(list)
    for path in nodes:
        if path:
            children[path[:-1]].append(path)

    sums = {}
    for path in sorted(nodes, key=len, reverse=True):
        saved = (len(nodes[path]) - 1) * _words(path[-1][1] if path else "")
        below = [sums[p] for p in children[path]]
        sums[path] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    out = []
    for path, members in nodes.items():
        ends = sorted(c for c in members if len(rebuilt[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(children[path]), *sums[path], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out)


def _ordered(rows):
    own = defaultdict(list)
    for c, turn, role, text, _ in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, key, role, text))
    return {c: tuple((r[3], r[4]) for r in sorted(rs)) for c, rs in own.items()}


def _rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(math.fmod(c, 20)), ())[:h] + turns[h:]
    return out


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _conversations():
    random.seed(13)
    rows = []
    for c in range(-45, 130):
        for turn in range(random.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, turn, random.choice(["user", "assistant", None]), random.choice(["hi", "hi", "hi there you", "", None, "a\nb", f"own {c}"]), "x"))
    for c in range(200, 230):  # copies, and copies that go on
        rows += [(c, t, "user", f"turn {t}", "x") for t in range(6 + (c % 3) * 2)]
    for c in range(300, 309):  # a staircase: each leaves the one before a turn later
        rows += [(c, t, "user", f"step {t}" if t < c - 299 else f"off {c}", "x") for t in range(12)]
    rows += [(400, t, "user", f"long {t % 7}", "x") for t in range(70)] + [(401, t, "user", f"long {t % 7}", "x") for t in range(65)]
    rows += [(None, 0, "user", "lost", "x"), (402, None, "user", "late", "x"), (402, None, "user", "late", "x"), (402, None, "a", "b", "x"), (402, 3, None, None, None), (403, 0, "ab", "c", "x"), (404, 0, "a", "bc", "x")]
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("bits, piece, rebuild", [(12, 8192, True), (2, 3, False)])
def test_trie_equals_brute_force(spark, monkeypatch, bits, piece, rebuild):
    monkeypatch.setattr(conversation_trie, "BLOCK_BITS", bits)
    monkeypatch.setattr(conversation_trie, "PIECE", piece)
    monkeypatch.setattr("namechron.llm._common.HOT_KEYS", 8)
    monkeypatch.setattr(conversation_trie, "HOT_KEYS", 8)
    rows = _conversations()
    turns = numbered(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, rank string").repartition(5))
    found = prefix_trie(*(with_shared_heads(turns) if rebuild else as_they_are(turns))).select(*NODE)
    own = _ordered(rows)
    assert sorted(map(tuple, found.collect()), key=lambda r: (r[0], r[1])) == _trie(_rebuilt(own) if rebuild else own)


def test_trie_of_small_tables(spark):
    kinds = "conv_id long, turn int, role string, text string"
    for rows in ([], [(None, 1, "a", "b")], [(3, 0, "a", "b")], [(41, None, None, None)]):
        df = spark.createDataFrame(rows, kinds)
        found = prefix_trie(*with_shared_heads(numbered(df))).select(*NODE)
        assert sorted(map(tuple, found.collect()), key=lambda r: (r[0], r[1])) == _trie(_rebuilt(_ordered([(*r, None) for r in rows])))
