"""Line dedup, top-k search and language ID against brute force."""

import hashlib
import random

import numpy as np
import pytest

from namechron.llm import language_id, line_dedup, topk_search


def _lines_by_hand(docs, min_chars=20, min_docs=3):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            held.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        lost = [len(key(x)) >= min_chars and len(held[key(x)]) >= min_docs and doc_id != max((d for d in held[key(x)] if d is not None), default=None) for x in lines]
        out.append((doc_id, len(lines), sum(lost), "\n".join(x for x, gone in zip(lines, lost, strict=True) if not gone)))
    return sorted(out, key=repr)


def test_lines(spark):
    random.seed(1)
    pool = [f"common line number {i} of this set" for i in range(12)] + ["ÄÖ" * 10, "short", "", "x" * 20, "y" * 19]
    docs = [(i, "\n".join(random.choice([x, f" \t{x.upper()}\x0b"]) for x in random.choices(pool, k=random.randrange(90)))) for i in range(40)]
    docs += [(5, docs[5][1]), (6, "common line number 1 of this set\nown"), (None, pool[0]), (None, pool[0]), (90, None), (91, ""), (92, " " + pool[0]), (93, "\n".join(pool * 30))]
    df = spark.createDataFrame([(*d, "junk", 1) for d in docs], "doc_id long, text string, keep string, word int")
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in line_dedup.dedup_lines(df).collect()), key=repr)
    assert got == _lines_by_hand(docs)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_columns_named_like_results_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a line that is long enough\nb", "x", 7), (2, "a line that is long enough", "y", 8), (3, "a line that is long enough", "z", 9), (None, None, None, None)], "doc_id long, text string, kept_text string, n_lines int")
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    assert out.columns == ["doc_id", "text", "kept_text", "n_lines", "n_dropped"]
    assert sorted((str(r["doc_id"]), r["kept_text"], r["n_lines"], r["n_dropped"]) for r in out.collect()) == [("1", "b", 2, 1), ("2", "", 1, 1), ("3", "a line that is long enough", 1, 0), ("None", "", 1, 0)]



def test_top_k(spark):
    random = np.random.default_rng(2)
    rows = [(i, [float(x) for x in random.normal(0, 0.2, 10)]) for i in range(300)]
    rows += [(400, rows[50][1]), (401, rows[50][1]), (402, None), (403, [0.1] * 9 + [None]), (404, [0.1] * 9 + [float("nan")]), (500, [0.5, 0.5]), (None, rows[0][1]), (501, [0.1, 0.2]), (7, rows[7][1]), (550, [])]
    df = spark.createDataFrame([(i, v, "junk") for i, v in rows], "vec_id long, embedding array<float>, score string")
    asked = df.where("vec_id % 50 = 0")
    got = {}
    for r in topk_search.top_k(df, asked, k=5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    valid = {i: [int(np.floor(256 * np.float64(np.float32(x)))) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    for q, y in valid.items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(y, x, strict=True)), i) for i, x in valid.items() if i != q and len(x) == len(y))[:5]
            assert sorted(got.get(q, [])) == [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert set(got) == {0, 50, 100, 150, 200, 250, 400, 500}
    assert topk_search.top_k(df.limit(0), asked.limit(0)).count() == 0


def _search(df, k=5):
    got = {}
    for r in topk_search.top_k(df, df.where("vec_id % 50 = 0"), k=k).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: [x[1:] for x in sorted(rows)] for q, rows in got.items()}


def _search_by_hand(rows, k=5):
    whole = {i: [int(np.floor(256 * np.float64(x))) for x in v] for i, v in rows}
    out = {}
    for q, y in whole.items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(y, x, strict=True)), i) for i, x in whole.items() if i != q)[:k]
            out[q] = [(i, -s) for s, i in scores]
    return out


def test_top_k_is_exact_for_large_components(spark):
    rows = [(0, [2.0**22, 1.0]), (1, [2.0**21, 0.0]), (2, [3 * 2.0**20, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _search(df) == {0: [(2, 864691128455135232), (1, 576460752303423488)]}
    random = np.random.default_rng(5)
    rows = [(i, [float(x) for x in random.normal(0, 1, 6) * 10.0 ** random.integers(-3, 6)]) for i in range(160)]
    rows += [(200, [1e30, 0.0, 0.0, 0.0, 0.0, 0.0]), (201, [0.0] * 6), (250, [0.0, 0.1, 0.0, 0.0, 0.0, 0.0]), (202, [-1e200, 0.5, 0.0, 0.0, 0.0, 1.0])]
    rows = [(i, [0.0, *v[1:]] if i < 200 else v) for i, v in rows]
    df = spark.createDataFrame([r for r in rows if r[0] != 200], "vec_id long, embedding array<double>")
    assert _search(df) == _search_by_hand([r for r in rows if r[0] != 200])
    with pytest.raises(Exception, match="64 bits"):
        _search(spark.createDataFrame([*rows, (300, [1e20] + [0.0] * 5)], "vec_id long, embedding array<double>"))


def test_top_k_of_copies_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(topk_search, "CELL_BYTES", 500)
    random = np.random.default_rng(6)
    vectors = [[float(x) for x in random.normal(0, 0.3, 5)] for _ in range(120)]
    rows = [(i, vectors[0] if i % 3 == 0 else vectors[random.integers(120)]) for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _search(df) == _search_by_hand(rows)
    assert _search(df, k=1) == _search_by_hand(rows, k=1)


def test_top_k_of_clusters(spark):
    random = np.random.default_rng(7)
    centers = random.normal(0, 0.2, (9, 16))
    rows = [(i, [float(x) for x in centers[i % 9] + random.normal(0, 0.02, 16)]) for i in range(900)] + [(1000, [-0.1] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _search(df) == _search_by_hand(rows)


def test_few_entries_reach_the_uniform_share(spark):
    random = np.random.default_rng(8)
    y = random.normal(0, 50, (20, 32)).round()
    x = random.normal(0, 50, (4000, 32)).round()
    stored = topk_search._cells(spark.createDataFrame([(i, 32, v.astype("<f8").tobytes()) for i, v in enumerate(x)], "vec_id long, dim int, q binary"), 6)
    block = spark.sparkContext.broadcast({32: y})
    cutoffs = topk_search._cutoffs(stored, block, topk_search._local_heads(stored, block, topk_search.HEADS), 6)
    entries = topk_search._sufficient_entries(stored, block, spark.sparkContext.broadcast(cutoffs)).collect()
    assert all(r["places"] is not None for r in entries)
    assert sum(len(r["places"]) // 4 for r in entries) < 0.09 * 20 * 4000


def test_language(spark):
    words = {"en": "the and of with thing", "de": "der und nicht über keit", "fr": "les été où leçon qui"}
    random.seed(3)
    docs = [(i, " ".join(random.choices(words[lang].split(), k=random.randrange(5, 300))), lang) for i in range(240) for lang in [random.choice(list(words))]]
    docs += [(900, None, "en"), (901, "12 !? 34", "en"), (902, "", None), (None, "the and of", "en"), (903, "der und nicht " * 20000, None)]
    df = spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, lang string, score double")
    settings = language_id.Settings(steps=120)
    rows = {r["doc_id"]: r for r in language_id.predict(df, language_id.fit(df, settings)).collect()}
    assert len(rows) == len(docs)
    held = [d for d in docs[:240] if rows[d[0]]["held_out"]]
    assert len(held) > 40 and sum(rows[i]["lang_pred"] == lang for i, _, lang in held) / len(held) > 0.95
    assert {(rows[i]["lang_pred"], rows[i]["score"]) for i in (900, 901, 902)} == {("und", 0.0)}
    assert rows[903]["lang_pred"] == "de" and not rows[None]["held_out"] and all(0 <= r["score"] <= 1 for r in rows.values())
    unlabelled = df.withColumn("lang", df["lang"].substr(100, 1)).where("false")
    assert language_id.fit(unlabelled) is None and language_id.predict(df, None).where("lang_pred <> 'und'").count() == 0


def test_prediction_does_not_read_the_label(spark):
    df = spark.createDataFrame([(1, "the and", "en"), (2, "the and", "de")], "doc_id long, text string, lang string")
    net = language_id.ByteNet(["a", "b"], language_id.Settings())
    net.start(np.random.default_rng(1))
    a, b = language_id.predict(df, net).collect()
    assert (a["lang_pred"], a["score"]) == (b["lang_pred"], b["score"])


def test_digest_of_kept_text(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "é\nb")], "doc_id long, text string")
    assert line_dedup.dedup_lines(df).select(F.sha2("kept_text", 256)).collect()[0][0] == hashlib.sha256("é\nb".encode()).hexdigest()


def test_training_reads_whole_texts(spark):
    docs = [(i, "shared opening text " * 300 + word * 2000, lang) for i in range(60) for lang, word in [[("en", "the and "), ("de", "der und ")][i % 2]]]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    sample = language_id.training_sample(df, language_id.Settings())
    assert sample and all(len(x) == 6 * 256 for _, x in sample)
    bodies = sum({"en": b"the and ", "de": b"der und "}[lang] in x for lang, x in sample)
    assert bodies == len(sample)


def test_every_language_is_sampled(spark):
    settings = language_id.Settings(languages=2, docs_per_language=3)
    docs = [(i, f"text {i} of language {i % 9}", f"l{i % 9}") for i in range(360)]
    docs += [(7, "always the same text", "one text")] * 3000 + [(7, f"text {i} of one id", "one id") for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    langs = [lang for lang, _ in language_id.training_sample(df, settings)]
    assert sorted(langs) == sorted([*(f"l{i}" for i in range(9)), "one text", "one id"])
    langs = [lang for lang, _ in language_id.training_sample(df, language_id.Settings(docs_per_language=5))]
    assert {x: langs.count(x) for x in langs} == {"one text": 1} | dict.fromkeys([*(f"l{i}" for i in range(9)), "one id"], 5)
