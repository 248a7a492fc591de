"""What the findings of round 3 named: bounds of tasks, and keys of more than five digits."""

from pyspark.sql import functions as F

from namechron.llm.lexical_search import FILE_BLOCKS, build_index
from namechron.operators import checks, diff, overlay, readers
from namechron.schemas import HEAD_FIELDS


def test_a_file_of_the_lexical_index_holds_few_blocks(spark):
    """A task holds a file's rows at once, and a block is as wide as its documents' terms."""
    docs = spark.range(0, 3 * FILE_BLOCKS, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text"))
    index = build_index(docs, block_docs=1)
    files = index.blocks.groupBy("_metadata.file_path").count().collect()
    assert sum(r["count"] for r in files) == 3 * FILE_BLOCKS
    assert max(r["count"] for r in files) <= FILE_BLOCKS


def _as_sql(spark, tmp_path, name, **tables):
    """Rows of a query and of its SQL, both sorted, over small tables."""
    import duckdb

    import __spark_entry__

    with duckdb.connect() as con:
        for table, rows in tables.items():
            rows.coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
            con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
        expected = con.sql(__spark_entry__.oracle_sql()[name])
        names, rows = expected.columns, expected.fetchall()
    found = __spark_entry__.queries()[name](spark, str(tmp_path))
    return sorted(map(tuple, found.select(*names).collect()), key=repr), sorted(rows, key=repr)


def _wide_keys(spark):
    """Customers on both sides of 100,000, so that some numbers have more than five digits and share their first five."""
    n = F.col("id") + F.when(F.col("id") < 60, 0).otherwise(100_000 - 60)
    return spark.range(120).select(n.alias("c_custkey"), F.lit("Customer").alias("c_name"), (n % 2).cast("int").alias("c_nationkey"))


def test_segments_with_keys_of_six_digits_are_as_the_sql_has_them(spark, tmp_path):
    found, expected = _as_sql(spark, tmp_path, "segment_anchors", customer=_wide_keys(spark))
    assert found == expected


def test_the_log_with_keys_of_six_digits_is_as_the_sql_has_it(spark, tmp_path):
    found, expected = _as_sql(spark, tmp_path, "reason_log", customer=_wide_keys(spark))
    assert found == expected


def test_repeats_of_one_unknown_lemma_are_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(checks, "TASK_ROWS", 2_000, raising=False)
    monkeypatch.setattr(checks, "REPEATS", 50, raising=False)
    n = F.col("id")
    streets = spark.range(0, 230, 1, 1).select(n.alias("seq"), F.when(n < 200, "Zett").when(n < 220, "Bekannt").when(n < 229, F.concat(F.lit("Y"), n)).alias("lemma"), n.cast("string").alias("schl_nr"))
    found = checks.validation_review(streets, spark.createDataFrame([("BEKANNT",), (" ",)], "strasse string")).where("grund <> 'Alphabet'")
    rows = found.groupBy("lemma", "schl_nr").count().collect()
    assert {(r["lemma"], r["schl_nr"], r["count"]) for r in rows} == {("Zett", str(i), 200) for i in range(200)} | {(f"Y{i}", str(i), 1) for i in range(220, 229)}
    assert max(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()) < 5_000


def test_versions_shuffle_no_column_twice(spark):
    """What windows deal by signature holds each column once, not also within a struct of what is kept."""
    stages = spark.createDataFrame([("1", 1, "1900", "jahr", "A", "falsch"), ("1", 2, "1910", "jahr", "B", "falsch"), ("1", 3, "1910", "jahr", "B", "falsch")], "schl_nr string, stadium int, gueltig_ab string, datum_praezision string, name string, ist_urspruenglich string")
    new = stages.where("stadium <> 2").withColumn("name", F.when(F.col("stadium") == 1, "C").otherwise(F.col("name")))
    rest = diff.unmatched(stages, new, diff.SIGNATURE, "stadium", ["stadium", *diff.SIGNATURE])
    assert sorted((r["n"], r["a"] and r["a"]["stadium"], r["b"] and r["b"]["name"]) for r in rest.collect()) == [(1, 1, "C"), (2, 3, None)]
    plan = rest._jdf.queryExecution().optimizedPlan().toString()
    assert "_row" not in plan


def test_overlays_deal_streets_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(overlay, "TASK_ROWS", 100, raising=False)
    n = F.col("id").cast("string")
    streets = spark.range(1000).select(n.alias("schl_nr"), *[F.lit("a").alias(f) for f in HEAD_FIELDS], F.lit(1).alias("buchseite"), F.lit("automatisch").alias("status"), F.col("id").alias("seq"))
    edits = spark.range(1000).select(n.alias("schl_nr"), F.lit("lemma").alias("feld"), F.lit("a").alias("wert_alt"), F.lit("b").alias("wert_neu"), F.col("id").alias("seq"))
    changed = overlay.head_values(streets, edits)
    assert changed.where("lemma = 'b'").count() == 1000
    assert max(r["count"] for r in changed.groupBy(F.spark_partition_id()).count().collect()) < 200
    wrong = overlay.head_violations(streets, edits.withColumn("wert_alt", F.when(F.col("seq") < 10, "x").otherwise("a")))
    assert wrong.count() == 10
    assert wrong._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1  # one pass for all guards


def test_entries_of_a_reader_are_parsed_once(spark):
    rows = [("a", page, "", f'[{{"schl_nr": "{page}", "lemma": "L", "stadien": [{{"datum": "1900", "name": "N"}}, "x"]}}]') for page in range(3)]
    answers = spark.createDataFrame(rows, "reader string, buchseite int, fehler string, eintraege string")
    parsed = readers.entries(answers).persist()
    for f in (readers.streets, readers.stages, readers.problems):
        assert sorted(map(tuple, f(answers, parsed).collect())) == sorted(map(tuple, f(answers).collect()))
    parsed.unpersist()
