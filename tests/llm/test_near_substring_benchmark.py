"""Near duplicates, repeated windows and benchmark items against brute force."""

import hashlib
import random

import numpy as np
import pytest

from namechron.llm import decontamination, near_dedup, substring_dedup
from namechron.llm._words import runs

WORDS = [f"w{i}" for i in range(400)]


def _edited(words, n):
    words = list(words)
    for _ in range(n):
        words[random.randrange(len(words))] = random.choice(WORDS)
    return words


def _corpus():
    random.seed(11)
    docs = [" ".join(random.choices(WORDS, k=random.randrange(1, 200))) for _ in range(60)]
    for size, edits in ((40, 2), (25, 4), (12, 7)):
        base = random.choices(WORDS, k=150)
        docs += [" ".join(_edited(base, random.randrange(edits + 1))) for _ in range(size)]
    chain = random.choices(WORDS, k=150)
    for _ in range(15):
        chain = _edited(chain, 2)
        docs.append(" ".join(chain))
    docs += [docs[0]] * 5 + [docs[1].upper(), docs[1].replace(" ", "\n\t "), "", " \n", None, None, "one", "One", "one two", "ONE two", "two one", "é É", "é é", "x " * 5000]
    random.shuffle(docs)
    return list(enumerate(docs, 100))


def _shingles(text, n):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


@pytest.mark.parametrize(("n", "percent", "block"), [(3, 85, 512), (5, 80, 7)])
def test_near_duplicates(spark, n, percent, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "SPREAD", block // 3)
    monkeypatch.setattr(near_dedup, "COARSE", 2)
    docs = _corpus()
    sets = {i: _shingles(t, n) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    df = spark.createDataFrame([(*d, "junk", b"x") for d in docs], "doc_id long, text string, component_id string, node binary")
    got = {r["doc_id"]: r.asDict() for r in near_dedup.near_duplicates(df, n, percent).collect()}
    assert len(got) == len(docs)
    for i, s in sets.items():
        assert got[i] == {"doc_id": i, "n_shingles": len(s), "component_id": find(i), "kept": find(i) == i}


def test_near_duplicates_odd_rows(spark):
    rows = [(None, "a b c d"), (7, "a b c d"), (7, "q r s t"), (3, "q r s t"), (None, "alone in null"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((repr(r["doc_id"]), r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(df, 3, 85).collect())
    assert got == [("3", 2, 3, True), ("7", 2, 3, False), ("7", 2, 7, True), ("9", 0, 9, True), ("None", 1, None, True), ("None", 2, 7, False)]
    assert near_dedup.near_duplicates(df.limit(0), 3, 85).count() == 0
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(df, 3, 70)


def test_long_signatures_tell_pairs_apart():
    random.seed(9)
    for percent in (80, 85):
        least = near_dedup.least_agreement(percent)
        for share, fits in ((percent / 100, True), (0.6, False)):
            both = [random.getrandbits(64) for _ in range(int(1000 * share))]
            own = [[random.getrandbits(64) for _ in range((1000 - len(both)) // 2)] for _ in range(2)]
            a, b = (np.frombuffer(near_dedup.long_signature(np.array(both + x, np.uint64)), np.uint8) for x in own)
            assert (np.count_nonzero(a == b) >= least) == fits


def test_collisions_are_counted():
    random = np.random.default_rng(4)
    signatures = random.integers(0, 4, (80, near_dedup.COORDINATES))
    signatures[20:40] = np.where(random.random((20, near_dedup.COORDINATES)) < 0.6, signatures[0], signatures[20:40])
    tokens, lists = np.empty(signatures.shape, np.int64), []
    for c in range(near_dedup.COORDINATES):
        for value in range(4):
            tokens[signatures[:, c] == value, c] = len(lists)
            lists.append(np.flatnonzero(signatures[:, c] == value))
    lengths = np.array([len(x) for x in lists])
    for i in range(80):
        want = [j for j in range(i + 1, 80) if (signatures[i] == signatures[j]).sum() >= near_dedup.MATCHES]
        assert near_dedup.colliding(tokens, lists, lengths, i).tolist() == want


def test_a_text_that_most_rows_share(spark):
    base = " ".join(WORDS[:100])
    rows = [(None if i % 2 else i, base) for i in range(4000)] + [(5000, base + " more"), (5001, "other words here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = near_dedup.near_duplicates(df, 3, 85).groupBy("component_id", "kept").count().collect()
    assert sorted(tuple(r) for r in got) == [(0, False, 4000), (0, True, 1), (5001, True, 1)]


def test_components(spark):
    random.seed(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(random.randrange(200, 260), random.randrange(200, 260)) for _ in range(40)]
    root = {v: v for e in edges for v in e}
    for _ in root:
        for u, v in edges:
            root[u] = root[v] = min(root[u], root[v])
    df = spark.createDataFrame([(bytes([u // 256, u % 256]), bytes([v // 256, v % 256])) for u, v in edges], "u binary, v binary")
    got = {int.from_bytes(r["node"], "big"): int.from_bytes(r["root"], "big") for r in near_dedup.components(df).collect()}
    assert got == {v: r for v, r in root.items() if v != r}


def test_run_hashes():
    h = np.random.default_rng(1).integers(0, 1 << 63, 50, dtype=np.uint64)
    for length in (1, 2, 3, 7, 18, 35, 50):
        by_hand = [sum(int(x) * pow(5, length - 1 - k, 1 << 64) for k, x in enumerate(h[i : i + length])) % (1 << 64) for i in range(51 - length)]
        assert runs(h, length, 5).tolist() == by_hand
    assert len(runs(h, 51, 5)) == 0


def _windows_by_hand(docs, window):
    words = [(t or "").encode().split() for _, t in docs]
    seen = {}
    for d, own in enumerate(words):
        for i in range(len(own) - window + 1):
            seen.setdefault(tuple(own[i : i + window]), []).append((d, i))
    gone = [set() for _ in docs]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + window))
    out = []
    for (doc_id, _), own, lost in zip(docs, words, gone, strict=True):
        kept = b" ".join(w for i, w in enumerate(own) if i not in lost)
        out.append((doc_id, len(own), len(lost), kept.decode(), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [35, 9])
def test_repeated_windows(spark, window):
    random.seed(6)
    passage = random.choices(WORDS, k=80)
    docs = []
    for i in range(60):
        words = random.choices(WORDS, k=random.randrange(0, 150))
        a = random.randrange(40)
        at = random.randrange(len(words) + 1)
        words[at:at] = passage[a : a + random.choice([0, 20, window - 1, window, window + 1, 40])]
        docs.append((i, random.choice([" ", "\n", " \t"]).join(words)))
    docs += [(70, "same word " * 60), (71, "z " * 500), (72, docs[3][1]), (3, docs[3][1]), (None, None), (73, ""), (74, " ".join(passage[:window])), (75, "Z " * window), (76, "only " * (window - 1))]
    df = spark.createDataFrame([(*d, 1, b"") for d in docs], "doc_id long, text string, copies int, node binary")
    got = sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_text", "kept_sha256")) for r in substring_dedup.dedup_substrings(df, window).collect()), key=repr)
    assert got == _windows_by_hand(docs, window)
    assert substring_dedup.dedup_substrings(df.limit(0), window).count() == 0


def test_levels():
    assert substring_dedup.levels(35) == [9, 18, 35]
    assert substring_dedup.levels(5) == [5]


def _edit_distance_within(item, text):
    row = list(range(len(item) + 1))
    best = len(item)
    for c in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_bit_parallel_distance():
    random.seed(7)
    for _ in range(300):
        item = "".join(random.choices("abcé ", k=random.randrange(1, 90)))
        text = "".join(random.choices("abcé ", k=random.randrange(0, 120)))
        assert decontamination.distance_within(decontamination.masks(item), len(item), text) == _edit_distance_within(item, text)


def test_benchmark_items(spark):
    random.seed(8)
    items = [(i, " ".join(random.choices(WORDS, k=30)).capitalize()) for i in range(20)] + [(20, "Tiny item!"), (21, None), (22, "?!"), (23, "w1 w2 " * 20), (1, "Another text, which has number one too, and is long enough.")]
    docs = []
    for i in range(150):
        own = " ".join(random.choices(WORDS, k=60))
        if i % 3 == 0:
            item = list(random.choice(items[:20])[1])
            for _ in range(random.randrange(12)):
                at = random.randrange(len(item))
                item[at : at + random.randrange(2)] = random.choice(["", "x", "q"])
            own = f"{own} {''.join(item)}, {own}"
        docs.append((i, own))
    docs += [(200, "a TINY, item."), (201, "tiny itemized"), (202, None), (203, ""), (204, items[3][1] + "\n" + items[4][1].upper()), (204, items[3][1]), (None, items[5][1]), (205, "another text which has number one too and is long enough"), (206, "w1 w2 " * 400)]
    df = spark.createDataFrame([(*d, "junk") for d in docs], "doc_id long, text string, found string")
    bench = spark.createDataFrame([(*x, "junk") for x in items], "item_id long, text string, n_edits string")
    got = sorted(((r["doc_id"], r["item_id"], r["n_edits"]) for r in decontamination.contaminated(df, bench).collect()), key=repr)
    want = []
    for doc_id, text in docs:
        text, best = decontamination.normalized(text), {}
        for item_id, item in items:
            item = decontamination.normalized(item)
            if not item:
                continue
            edits = decontamination.budget(item, 0.05, 32)
            found = _edit_distance_within(item, text) if edits else 0 if f" {item} " in f" {text} " else 99
            if found <= edits:
                best[item_id] = min(best.get(item_id, found), found)
        want += [(doc_id, i, n) for i, n in best.items()]
    assert got == sorted(want, key=repr)
    assert len({r[0] for r in got}) > 30
    clean = decontamination.with_items(df, bench).where("size(contaminated_by) = 0")
    assert {r["doc_id"] for r in clean.collect()}.isdisjoint({r[0] for r in got} - {204})
    assert decontamination.contaminated(df, bench.limit(0)).count() == 0 and decontamination.contaminated(df.limit(0), bench).count() == 0


def test_items_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 60)
    bench = spark.createDataFrame([(i, f"{w} is the test item of number {i} {w}") for i, w in enumerate("abcdefgh")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "see A is the test item of number 0 a and h is the tst item of number 7 h.")], "doc_id long, text string")
    assert sorted((r["item_id"], r["n_edits"]) for r in decontamination.contaminated(docs, bench, error_rate=0.1).collect())[0] == (0, 0)


def test_short_items_have_their_edits(spark):
    bench = spark.createDataFrame([(1, "twenty letters here!"), (2, "river banks of the old town"), (3, "short item")], "item_id long, text string")
    docs = [(1, "see river bamks of the old town there"), (2, "see short itemized lists"), (3, "a short itme"), (4, "river bamks of the old twn"), (5, "a Short Item.")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["n_edits"]) for r in decontamination.contaminated(df, bench).collect())
    assert got == [(1, 2, 1), (5, 3, 0)]


def test_windows_of_a_text_that_most_rows_share(spark):
    docs = [(i, "same text again") for i in range(3000)] + [(i, "long copied text " * 20) for i in range(3000, 5000)] + [(5000, "own words only")]
    df = spark.createDataFrame([(*d, 1, b"") for d in docs], "doc_id long, text string, salt int, hot binary").repartition(5)
    got = sorted(tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_text", "kept_sha256")) for r in substring_dedup.dedup_substrings(df).collect())
    assert got == sorted(_windows_by_hand(docs, 35))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("namechron_texts")]
