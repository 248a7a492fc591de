"""The corpus pipeline as a whole and stage by stage, on planted documents and odd tables."""

import hashlib
import os
import random
import zlib

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from namechron.llm import _common, byte_bpe, language_id
from namechron.llm.queries import BPE_RANKS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, text_id string, found int, keep string"
VOCABULARY = {"en": "the and of with that thing which would there from have this were been their time".split(), "de": "der und nicht über keit dass werden einer auch schon zwischen immer noch gegen wieder durch".split()}


def _prose(lang, n):
    return " ".join(random.choice(VOCABULARY[lang]) + random.choice(["", "", "x", "ing", "en"]) for _ in range(n))


def _write(spark, folder, docs, items):
    rows = [(i, t, lang, "s", None if t is None else len(t), "x", "y", 1, "z") for i, t, lang in docs]
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{folder}/benchmark.parquet")


def test_planted_documents(spark, tmp_path):
    random.seed(13)
    clean = [(i, _prose(lang, 80), lang) for i in range(120) for lang in [random.choice(["en", "de"])]]
    item = _prose("en", 25)
    line = "a line that very many of the documents repeat"
    copies = [(200 + i, clean[i][1] + " " + word, "en") for i, word in enumerate(["once", "twice"])]
    docs = clean + copies + [(300, f"{_prose('de', 30)} {item[:40]}q{item[41:]} {_prose('de', 30)}", "de")]
    docs += [(400 + i, f"{_prose('en', 60)}\n{line}", "en") for i in range(4)] + [(500, line, "en"), (501, None, "en"), (502, "", None), (503, "12 34 !?", "en"), (7, clean[7][1], "en"), (None, _prose("en", 50), None)]
    _write(spark, tmp_path, docs, [(1, item), (2, None), (3, "?")])
    with _common.scratch(spark) as made:
        got = {}
        for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
            assert r["doc_id"] not in got
            got[r["doc_id"]] = r
        left = [path for path in made if os.path.exists(path.removeprefix("file://"))]
    assert len([path for path in left if "/stage-" in path]) == 1
    texts = {i: t for i, t, _ in docs}
    assert set(got) == {i for i, _, _ in clean} | {400, 401, 402, 403, 500, None}  # 500 is the largest that holds the line
    import tiktoken

    bpe = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(P.path(BPE_RANKS)), special_tokens={})
    for i, r in got.items():
        text = texts[i].replace("\n" + line, "") if i in (400, 401, 402, 403) else texts[i]
        assert (r["n_tokens"], r["decoded_sha256"]) == (len(bpe.encode_ordinary(text)), hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_of_odd_tables(spark, tmp_path, name):
    random.seed(14)
    docs = [(1, None, None), (None, None, "en"), (2, "", "en"), (3, "the and of " * 30, "en"), (3, "the and of " * 30, "en"), (4, "\n\n", None), (5, "der und nicht " * 30, "de")]
    _write(spark, tmp_path, docs, [(None, "x"), (1, None)])
    stage = dict(corpus_pipeline.STAGES)[name]
    full = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = stage(spark, full, str(tmp_path))
    assert tuple(out.columns) == (corpus_pipeline.COLUMNS if name != "tokens" else ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))
    want = {"language": [3, 3, 5], "lines": [1, 2, 3, 3, 4, 5, None], "near_copies": [1, 2, 3, 4, 5, None], "benchmark": [1, 2, 3, 3, 4, 5, None], "tokens": [1, 2, 3, 3, 4, 5, None]}[name]
    assert sorted((r["doc_id"] for r in out.collect()), key=lambda i: (i is None, i)) == want
    assert stage(spark, full.limit(0), str(tmp_path)).count() == 0


def test_language_stage_with_and_without_labels(spark, tmp_path):
    random.seed(15)
    learned = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = [(i, _prose(lang, 60), lang) for i in learned for lang in [random.choice(["en", "de"])]]
    odd = [(200, "日本語のテキスト" * 40, None), (201, None, "en"), (202, "12 !", "de"), (None, _prose("de", 50), None), (203, _prose("en", 50), "de")]
    _write(spark, tmp_path, docs + odd, [])
    full = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, full, str(tmp_path)).collect()}
    assert {*learned, None, 203} <= kept and not kept & {201, 202}
    unlabelled = full.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.fit(unlabelled) is None
    assert {r["doc_id"] for r in corpus_pipeline.language(spark, unlabelled, str(tmp_path)).collect()} == {*learned, 200, None, 203}


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.exists(SF), reason="the driver's tables are absent")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language_id.predict(docs, language_id.fit(docs)).where("held_out and lang is not null and lang_pred <> 'und'").select("lang", "lang_pred").collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) >= 0.95
