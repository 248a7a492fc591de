"""Chains in time, checks, versions, overlay, samples and readers on small tables."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from namechron import schemas
from namechron.operators import asof, checks, diff, images, ordering, overlay, readers, review, sampling
from namechron.plans import publish_run, review_run, sample_run
from namechron.schemas import Reason
from namechron.sources import client, files
from namechron.sources.config import SettingsError, reader_settings

STREETS = "schl_nr string, lemma string, stadtteile string, strassenklasse string, namensgruppe string, verweis_auf string, buchseite int, status string, seq long"
STAGES = "schl_nr string, stadium int, gueltig_ab string, datum_praezision string, name string, ist_urspruenglich string, seq long"


def streets(spark, *rows):
    return spark.createDataFrame([(k, lemma, "Mitte; Ost", "Gemeindestraße", "", "", page, status, i) for i, (k, lemma, page, status) in enumerate(rows)], STREETS)


def stages(spark, **chains):
    rows = [(k.strip("_"), n, d, "jahr" if len(d) == 4 else "tag" if d else "unbekannt", name, "falsch") for k, chain in chains.items() for n, (d, name) in enumerate(chain, 1)]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], STAGES)


CHAIN = [("1904-11-18", "Kirchstraße"), ("1926-06-01", "Klosterstraße"), ("1937-11-20", "Kütings Garten")]


def test_state_at_cutoff(spark):
    st = stages(spark, a=CHAIN, b=[("1955-03-31", "X")], c=[("", "Y"), ("1908-02-07", "Kronenstraße")], d=[("1936", "Z")], e=[("1900-01-01", "P"), ("1900-01-01", "Q")])
    at = {r["schl_nr"]: r["name"] for r in asof.state_at(st, "1936-06-30").collect()}
    assert at == {"a": "Klosterstraße", "c": "Kronenstraße", "e": "Q"}  # of equal dates the last
    last = {r["schl_nr"]: r["name"] for r in asof.last_state(st).collect()}
    assert last["e"] == "P" and last["d"] == "Z"  # of equal dates the first


def test_concordance_halves(spark):
    s = streets(spark, ("a", "Kütings Garten", 1, "automatisch"), ("b", "Kütings Garten", 1, "automatisch"), ("c", "Neu", 2, "automatisch"), ("d", "Weg", 3, "automatisch"), ("e", "Hof", 3, "automatisch"), ("f", "Fern", 3, "automatisch"))
    st = stages(spark, a=CHAIN, b=CHAIN, c=[("1900-01-01", "Alt"), ("1950-01-01", "Anders")], d=[("1900-01-01", "Weg (Verl.)")], e=[("1900-01-01", "Hof (tlw.)")], f=[("1950-01-01", "Fern")])
    rows = {r["schl_nr"]: r for r in asof.concordance(s, st, "1936-06-30", "q").collect()}
    assert set(rows) == {"a", "b", "e"} and rows["a"]["eindeutig"] == "nein" and rows["e"]["eindeutig"] == "ja"
    assert (rows["e"]["ehemalig"], rows["e"]["heutig"], rows["e"]["zusatz"], rows["e"]["stadtteil"]) == ("Hof", "Hof", "(tlw.)", "Mitte")
    review_rows = asof.concordance_review(s, st, "1936-06-30").collect()
    assert [(r["lemma"], r["befund"]) for r in review_rows] == [("Neu", "letztes Stadium 'Anders' ≠ Lemma 'Neu' (schl_nr c)")]


def test_attested_renames(spark):
    st = stages(spark, a=CHAIN, b=[("1930", "Altstr."), ("1937-05-01", "Neuweg")])
    book = spark.createDataFrame([("Klosterstr.",), ("Altstraße",), ("Kirchstr",)], "name string")
    years = {r["period"]: (r["alt"], r["neu"]) for r in asof.attested_renames(st, book).collect()}
    assert years == {1937: (2, 0)}
    months = {r["period"]: (r["alt"], r["neu"]) for r in asof.attested_renames(st, book, "month", "1937-01", "1937-06").collect()}
    assert months == {"1937-05": (1, 0)}


def test_checks(spark):
    s = streets(spark, ("00001", "Kronenstraße", 1, "a"), ("00002", "Aaaafalsch", 1, "a"), ("00004", "Kruppstraße", 1, "a"), ("00004", "Lünink", 2, "a"), ("00009", "Luftschacht", 2, "a"))
    assert checks.key_stats(s).first().asDict() == {"kleinste": 1, "groesste": 9, "anzahl": 5, "luecken": 5, "dubletten": 1}
    assert sorted(r["luecke"] for r in checks.key_gaps(s).collect()) == [3, 5, 6, 7, 8]
    for block in (2, 100):
        assert [r["lemma"] for r in checks.alphabet_dips(s, rows_in_block=block).collect()] == ["Aaaafalsch"]
    register = spark.createDataFrame([("kronenstrasse",), ("Kruppstraße",), (" ",)], "strasse string")
    assert {r["lemma"] for r in checks.not_in_register(s, register).collect()} == {"Aaaafalsch", "Lünink", "Luftschacht"}
    twin = streets(spark, ("1", "X", 1, "a"), ("2", "X", 1, "a"))
    assert checks.validation_review(twin, register).where(F.col("grund") == Reason.NOT_IN_REGISTER).count() == 4


def test_versions(spark):
    old, new = streets(spark, ("1", "A", 1, "automatisch"), ("2", "B", 1, "unsicher"), ("2", "C", 1, "unsicher"), ("3", "D", 1, "a")), streets(spark, ("1", "A", 2, "unsicher"), ("2", "C", 1, "automatisch"), ("4", "E", 1, "a"))
    a = stages(spark, _1=CHAIN, _2=[("1920", "II"), ("1920", "II")])
    b = stages(spark, _1=[CHAIN[0], ("1910-01-01", "Mitten"), *CHAIN[1:]], _2=[("1920-10-01", "II. Weberstraße"), ("1920", "II")])
    found = sorted((r["kategorie"], r["schl_nr"], r["feld"] or "", r["alt"] or "", r["neu"] or "") for r in diff.changes(old, a, new, b).collect())
    assert found == sorted(
        [
            ("eintrag_neu", "4", "", "", ""), ("eintrag_entfallen", "3", "", "", ""), ("kopffeld_veraendert", "1", "buchseite", "1", "2"), ("status_zu_unsicher", "1", "", "", ""), ("status_zu_automatisch", "2", "", "", ""),
            ("stadium_gewonnen", "1", "", "", "1910-01-01 Mitten"), ("datum_veraendert", "2", "", "1920 (jahr)", "1920-10-01 (tag)"), ("name_veraendert", "2", "", "II", "II. Weberstraße"),
        ]
    )
    assert diff.changes(old, a, old, a).count() == 0
    fields = {tuple(r) for r in diff.deviations(diff.changes(old, a, new, b), a, b).collect()}
    assert {("1", "stadium_2"), ("2", "stadium_2_datum"), ("4", "eintrag")} <= fields


def corrections(spark, *rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "schl_nr string, feld string, wert_alt string, wert_neu string, seq long")


def test_overlay(spark):
    s = streets(spark, ("1", "A", 1, "automatisch"), ("2", "B", 1, "unsicher"), ("2", "C", 1, "unsicher"))
    st = stages(spark, _1=CHAIN, _2=[("1920", "X")])
    good = corrections(
        spark, ("2", "schl_nr", "C", "00077"), ("1", "lemma", "A", "Neu"), ("1", "buchseite", "1", "9"), ("1", "stadium_1_datum", "1904-11-18", ""), ("1", "stadium_1_name", "Kirchstraße", ""),
        ("1", "stadium_3_name", "Kütings Garten", "Garten"), ("1", "stadium_1_datum", "", "urspr."), ("1", "stadium_1_name", "", "Ursprung"), ("00099", "eintrag", "", "Ganz neu"), ("00099", "buchseite", "", "5"),
    )
    assert overlay.violations(s, st, good).collect() == []
    new_streets, new_stages = overlay.apply(s, st, good)
    assert {(r["schl_nr"], r["lemma"], r["buchseite"], r["status"]) for r in new_streets.collect()} == {("1", "Neu", 9, "geprueft"), ("2", "B", 1, "unsicher"), ("00077", "C", 1, "geprueft"), ("00099", "Ganz neu", 5, "geprueft")}
    assert [(r["stadium"], r["name"], r["ist_urspruenglich"]) for r in new_stages.where("schl_nr = '1'").orderBy("stadium").collect()] == [(1, "Ursprung", "wahr"), (2, "Klosterstraße", "falsch"), (3, "Garten", "falsch")]
    assert new_stages.where("schl_nr = '00077'").count() == 0 and new_stages.where("schl_nr = '2'").count() == 1


@pytest.mark.parametrize(
    ("row", "part"),
    [
        (("9", "lemma", "", "x"), "nicht im Datensatz"), (("2", "lemma", "B", "x"), "mehrdeutig"), (("1", "lemma", "Z", "x"), "wert_alt"), (("1", "buchseite", "1", "x"), "keine Seitenzahl"), (("1", "farbe", "", "x"), "unbekanntes Feld"),
        (("1", "stadium_9_name", "a", "b"), "existiert nicht"), (("1", "stadium_0_name", "a", "b"), "≥ 1"), (("1", "stadium_1_datum", "1904-11-18", "3. Novemner 1900:"), "nicht sauber"), (("1", "stadium_1_datum", "1904-11-18", "bald"), "nicht normalisierbar"),
        (("1", "stadium_1_datum", "1904-11-18", "vorm."), "nur beim Nachtragen"), (("1", "stadium_1_urspruenglich", "falsch", "ja"), "'wahr' oder"), (("1", "stadium_1_name", "Kirchstraße", ""), "Streichen braucht"), (("1", "stadium_4_name", "", "x"), "Nachtragen braucht"),
        (("1", "schl_nr", "Z", "5"), "Lemma genau eines"), (("1", "schl_nr", "A", "2"), "bereits vergeben"), (("1", "schl_nr", "A", "x5"), "keine Schlüsselnummer"), (("1", "eintrag", "a", ""), "Bestätigung"), (("5", "eintrag", "", "x"), "buchseite-Zeile"),
    ],
)
def test_overlay_edit_guards(spark, row, part):
    s, st = streets(spark, ("1", "A", 1, "automatisch"), ("2", "B", 1, "unsicher"), ("2", "C", 1, "unsicher")), stages(spark, _1=CHAIN)
    with pytest.raises(overlay.OverlayError, match=part):
        overlay.apply(s, st, corrections(spark, row))


def test_sample_and_rates(spark):
    s = streets(spark, *[(f"{i:05d}", f"L{i}", i + 2, "unsicher" if i % 5 == 0 else "automatisch") for i in range(60)])
    drawn = sampling.draw(s, automatic=10, uncertain=4)
    assert [r["schl_nr"] for r in drawn.collect()] == [r["schl_nr"] for r in sampling.draw(s.repartition(7), automatic=10, uncertain=4).collect()]
    with pytest.raises(sampling.SampleError):
        sampling.draw(s, automatic=500)
    fields = sampling.fields_to_check(s.limit(1), stages(spark, _00000=CHAIN[:1]))
    assert sorted(r["feld"] for r in fields.collect())[-2:] == ["stadium_1_name", "strassenklasse"] or fields.count() == 8
    verdicts = [("lemma", "ja"), ("lemma", "ja"), ("lemma", "nein"), ("stadium_1_datum", "ja"), ("stadium_2_datum", "nein"), ("lemma", "")]
    sample = spark.createDataFrame([(str(i), "L", "automatisch", f, "", v, "k") for i, (f, v) in enumerate(verdicts)], "schl_nr string, lemma string, status string, feld string, wert string, korrekt string, korrektur string")
    rates = {r["gruppe"]: (r["geprueft"], r["korrekt"]) for r in sampling.error_rates(sample).collect()}
    assert rates == {"lemma": (3, 2), "stadium_datum": (2, 1), "automatisch": (5, 3), "": (5, 3)}
    assert "40.0 %" in sample_run.evaluate(sample, most_open=0.5)
    with pytest.raises(sampling.SampleError):
        sample_run.evaluate(sample)
    places = spark.createDataFrame([(201,), (202,), (388,)], "p int").select(sampling.scan_place("p").alias("s")).select("s.*").collect()
    assert [tuple(r) for r in places] == [(1, 100, "rechts"), (2, 1, "links"), (2, 94, "links")]


def answer(spark, *rows):
    return spark.createDataFrame([(r, p, "h", "" if e is not None else "unlesbar", None if e is None else json.dumps(e)) for r, p, e in rows], "reader string, buchseite int, prompt_hash string, fehler string, eintraege string")


def test_reader_answers(spark):
    entry = {"schl_nr": 7, "lemma": "Kriegs­weg ", "stadtteile": ["A", "", "B"], "stadien": [{"datum": "16. Jh.", "name": "X"}, "text", {"datum": "urspr.:", "name": "Y", "urspruenglich": True}, {"datum": "99. Mai 1900:", "name": "Z"}]}
    got = answer(spark, ("a", 1, [entry, {"schl_nr": "8", "stadien": "keine"}]), ("a", 2, None))
    assert [(r["schl_nr"], r["lemma"], r["stadtteile"]) for r in readers.streets(got).orderBy("seq").collect()] == [("00007", "Kriegsweg", "A; B"), ("00008", "", "")]
    assert [(r["stadium"], r["gueltig_ab"], r["datum_praezision"], r["ist_urspruenglich"]) for r in readers.stages(got).orderBy("stadium").collect()] == [(1, "", "unbekannt", "falsch"), (3, "", "unbekannt", "wahr"), (4, "1900", "jahr", "falsch")]
    assert sorted((r["feld"], r["grund"]) for r in readers.problems(got).collect()) == [("stadien", Reason.STAGES_NO_LIST), ("stadium_1_datum", Reason.DATE_UNREADABLE), ("stadium_2", Reason.STAGES_NO_LIST), ("stadium_4_datum", Reason.DATE_LIMITED)]
    texts = spark.createDataFrame([("x [1] ```json\n[{}]\n```",), ("[1]",), ("no",), ("a [{\"b\": 1}] c",), (None,), ("[]",)], "t string").select(readers.json_list("t")).collect()
    assert [r[0] for r in texts] == ["[{}]", None, None, '[{"b": 1}]', None, "[]"]


def test_review_list(spark):
    s = streets(spark, ("00001", "Aachener Str", 1, "automatisch"), ("00002", "Ende", 1, "automatisch"), ("00003", "Drei", 2, "unsicher"), ("00004", "Vier", 2, "unsicher"))
    st = stages(spark, _00001=CHAIN[:2], _00003=[("1920", "X")])
    same = {"stadtteile": "Mitte; Ost", "strassenklasse": "Gemeindestraße"}
    one = {"schl_nr": "1", "lemma": "Aachenerstraße", **same, "stadien": [{"datum": "18.11.1904:", "name": "Kirchstraße"}, {"datum": "bald", "name": "Klosterstraße"}]}
    rest = [{"schl_nr": "2", "lemma": "Ende", **same}]
    got = answer(spark, ("a", 1, [one, *rest]), ("b", 1, [one | {"stadien": one["stadien"][:1]}, *rest]), ("a", 2, [{"schl_nr": "3", "lemma": "Drey", **same}, {"schl_nr": "4", "lemma": "Vier", **same}]), ("b", 2, None))
    rows = [(r["einig"], r["schl_nr"], r["feld"], r["wert_a"], r["wert_b"]) for r in review.review_list(s, st, got, ["a", "b"]).collect()]
    assert rows[0] == ("beide", "00001", "lemma", "Aachenerstraße", "Aachenerstraße")
    assert ("eines", "00001", "stadium_2_datum", "bald (nicht normalisierbar)", "") in rows
    assert ("unlesbar", "00003", "lemma", "Drey", "") in rows
    full = review.full_review_list(s, st, got, ["a", "b"], s.where("schl_nr = '00001'")).collect()
    assert [r["feld"] for r in full][:2] == ["lemma", "stadtteile"] and {r["einig"] for r in full if r["feld"] == "stadtteile"} == {"keines"}


def test_cells_become_corrections(spark):
    rows = [("1", "lemma", "A", "B "), ("1", "lemma", "A", "B"), ("1", "stadium_2", "", "29.08.1927 | Weg"), ("1", "eintrag", "A", "x"), ("1", "stadium_?", "", "x"), ("1", "stadium_1", "da", "x"), ("1", "stadium_3", "", "x"), ("1", "verweis_auf", "", " ")]
    filled = spark.createDataFrame([(*r, "", i) for i, r in enumerate(rows)], "schl_nr string, feld string, wert_parser string, korrektur string, beleg string, seq long")
    present = corrections(spark, ("1", "stadium_2_name", "", "Weg"))
    new, wrong = overlay.from_review(filled, present, "2026-01-01")
    assert sorted((r["feld"], r["wert_neu"]) for r in new.collect()) == [("lemma", "B"), ("stadium_2_datum", "29.08.1927")]
    assert wrong.count() == 4
    with pytest.raises(review_run.OpenCorrections):
        review_run.build(None, None, None, [], previous=filled)


def test_measure_against_sample(spark):
    sample = spark.createDataFrame([("00001", "L", "a", "lemma", "x", "ja", "", 1), ("00001", "L", "a", "stadtteile", "", "nein", "S", 1), ("00001", "L", "a", "verweis_auf", "v", "nein", "w", 1)], "schl_nr string, lemma string, status string, feld string, wert string, korrekt string, korrektur string, buchseite int")
    got = answer(spark, ("a", 1, [{"schl_nr": "1", "lemma": "x", "stadtteile": "S"}]), ("a", 9, [{"schl_nr": "1"}]))
    total = next(r for r in review_run.measure(sample, got, "a").collect() if r["ebene"] == "gesamt")
    assert (total["geprueft"], total["korrekt"], total["fehlend"], total["gefunden"]) == (3, 2, 1, 1)
    with pytest.raises(ValueError, match="keys"):
        review_run.measure(sample, answer(spark, ("a", 1, [{"schl_nr": "1"}, {"schl_nr": "1"}])), "a")


def test_order_and_lists(spark):
    s = streets(spark, ("b", "B", 2, "x"), ("a", "A", 1, "x"), ("c", "C", 2, "x"))
    st = stages(spark, b=[("1", "b1"), ("2", "b2")], z=[("1", "z1")], a=[("1", "a1")])
    ordered, in_order = ordering.book_order(s, st)
    assert [r["schl_nr"] for r in ordered.collect()] == ["a", "b", "c"] and [r["name"] for r in in_order.collect()] == ["a1", "b1", "b2", "z1"]
    pages = spark.createDataFrame([("23-25, 45",), ("",)], "t string").select(ordering.page_ranges("t").alias("p")).collect()
    assert pages[0]["p"] == [23, 24, 25, 45] and (pages[1]["p"][0], pages[1]["p"][-1]) == (2, 388)
    rows = spark.createDataFrame([("1", 5, "lemma", "eines"), ("1", 5, "lemma", "beide"), ("2", 6, "x", "keines")], "schl_nr string, buchseite int, feld string, einig string")
    assert [tuple(r) for r in ordering.image_list(rows, ("beide", "eines")).collect()] == [("1", 5, ["lemma"], "beide")]
    log = spark.createDataFrame([(1, "A", "zwei", 1), (1, "A", "eins", 2), (1, "A", "zwei", 3), (9, "Q", "weg", 4)], "buchseite int, lemma_roh string, grund string, seq int")
    assert [tuple(r) for r in review.reasons_by_key(s, log).collect()] == [("a", "zwei; eins")]


def test_files(spark, tmp_path):
    (tmp_path / "reg.csv").write_text('strasse,x\n" A ",1\n,2\n"B ""q""\nC",3\n', encoding="utf-8")
    assert sorted(r[0] for r in files.register_names(files.read_csv(spark, f"file://{tmp_path}/reg.csv")).collect()) == ["A", 'B "q"\nC']
    (tmp_path / "book.tsv").write_text("Adresse\ty\nGrenzstr. 25\t1\nMarkt\t2\n\t3\n", encoding="utf-8")
    assert sorted(r[0] for r in files.address_book_names(files.read_csv(spark, f"file://{tmp_path}/book.tsv", sep="\t")).collect()) == ["Grenzstr.", "Markt"]
    assert files.read_overlay(spark, f"file://{tmp_path}/none.csv").count() == 0
    (tmp_path / "bad.csv").write_text("schl_nr,feld\n1,2\n")
    with pytest.raises(overlay.OverlayError):
        files.read_overlay(spark, f"file://{tmp_path}/bad.csv")
    (tmp_path / "ans" / "model-alpha").mkdir(parents=True)
    (tmp_path / "ans" / "model-alpha" / "s012.json").write_text(json.dumps({"prompt_hash": "h", "fehler": "", "eintraege": [{"schl_nr": "1"}]}))
    found = files.find_readers(spark, f"file://{tmp_path}/ans", ["alpha", "beta"])
    assert found == {"alpha": "model-alpha"}
    assert readers.streets(files.read_answers(spark, f"file://{tmp_path}/ans", found)).first()["schl_nr"] == "00001"
    (tmp_path / "ans" / "model-alpha" / "s013.json").write_text('{"a": ')
    with pytest.raises(Exception, match="s013.json"):
        files.read_answers(spark, f"file://{tmp_path}/ans", found).collect()


def test_publish_is_repeatable(spark, tmp_path):
    s = streets(spark, ("00001", "Kütings Garten", 1, "automatisch"), ("00002", "Weg", 1, "geprueft"), ("00003", "X", 1, "unsicher"))
    st = stages(spark, _00001=CHAIN, _00002=[("1900", "Hof"), ("1950", "Weg")], _00003=[("1900", "Y"), ("1950", "X")])
    names = spark.createDataFrame([("Klosterstr.",)], "name string")
    register = spark.createDataFrame([("Weg",)], "strasse string")
    texts = [publish_run.run(s, st, register, names, f"file://{tmp_path}/{i}") for i in range(2)]
    assert texts[0] == texts[1]
    files_of = [sorted(p.read_bytes() for p in (tmp_path / str(i)).rglob("part*.csv")) for i in range(2)]
    assert files_of[0] == files_of[1] and b"Klosterstra" in b"".join(files_of[0]) and b",00003," not in files_of[0][0]


def test_client(spark, monkeypatch):
    slept, calls = [], []

    def busy(body):
        calls.append(body)
        if len(calls) < 3:
            raise client.HttpError(503)
        return "no list" if len(calls) < 4 else '[{"schl_nr": "1"}]'

    assert client.ask({}, busy, slept.append) == ('[{"schl_nr": "1"}]', False) and slept == [1, 2]
    with pytest.raises(client.HttpError):
        client.ask({}, lambda b: (_ for _ in ()).throw(client.HttpError(404)))
    assert client.ask({}, lambda b: (_ for _ in ()).throw(client.HttpError(500)), lambda s: None) == ("", True)
    scans = spark.createDataFrame([(1, b"x"), (2, b"y")], "buchseite int, content binary")
    known = answer(spark, ("r", 1, []))
    read = client.read_pages(scans, known, "r", "prompt", "h", lambda body: '[{"schl_nr": "1"}]').collect()
    assert [(r["buchseite"], r["fehler"]) for r in read] == [(2, "")]
    monkeypatch.delenv("READER_BASE_URL", raising=False)
    with pytest.raises(SettingsError):
        reader_settings("m", "/none")
    monkeypatch.setenv("READER_BASE_URL", "http://h/v1/chat/completions")
    monkeypatch.setenv("READER_API_KEY", "k")
    assert reader_settings("m", "/none").base_url == "http://h/v1"


def test_gutter():
    grey = np.full((100, 400), 0, np.uint8)
    grey[:, 190:215] = 255
    assert images.gutter(grey) == (202, 25, True)
    grey[:, 190:215] = 0
    grey[:, 200:203] = 255
    assert images.gutter(grey) == (200, 3, False)
    assert images.gutter(np.zeros((50, 100), np.uint8)) == (50, 0, False)


def test_page_stream(spark, tmp_path):
    from namechron.streaming.pages import page_stream

    (tmp_path / "s007.txt").write_text("7\nAlter\nPlatz\n")
    q = page_stream(spark, f"file://{tmp_path}").writeStream.format("memory").queryName("pages_seen").start()
    q.processAllAvailable()
    q.stop()
    assert [tuple(r) for r in spark.sql("select page, text from pages_seen").collect()] == [(7, "Alter Platz")]


def test_registry():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and "concordance" in entry.queries()


def test_corrections_keep_their_order_in_copies(spark, tmp_path):
    import os
    import shutil

    path, rows = f"file://{tmp_path}/overlay", [(f"{i:05d}", "lemma", "a", "b" * (i + 1) * 50, "", "q", "d") for i in range(14)]
    for part in (rows[:1], rows[1:4], *[[r] for r in rows[4:]]):
        files.append_corrections(spark.createDataFrame(part, schemas.OVERLAY), path)
    shutil.copytree(tmp_path / "overlay", tmp_path / "copy")
    for n, f in enumerate(sorted((tmp_path / "copy").rglob("*.csv"), reverse=True)):
        os.utime(f, (1_000_000 + n, 1_000_000 + n))  # file times say nothing
    for place in (path, f"file://{tmp_path}/copy"):
        got = files.read_overlay(spark, place)
        assert [r["schl_nr"] for r in got.orderBy("seq").collect()] == [r[0] for r in rows]
        assert got.select("seq").distinct().count() == 14 and set(got.columns) == {*schemas.OVERLAY.names, "seq"}
    # corrections that were there as a file come before those that are appended
    files.write_csv(spark.createDataFrame(rows[:2], schemas.OVERLAY), f"file://{tmp_path}/old", schemas.OVERLAY)
    files.append_corrections(spark.createDataFrame(rows[5:6], schemas.OVERLAY), f"file://{tmp_path}/old")
    assert [r["schl_nr"] for r in files.read_overlay(spark, f"file://{tmp_path}/old").orderBy("seq").collect()] == ["00000", "00001", "00005"]


def test_a_date_that_is_corrected_twice(spark):
    from namechron.operators import overlay

    one = spark.createDataFrame([("00001", 1, "1900", "jahr", "Weg", "falsch")], "schl_nr string, stadium int, gueltig_ab string, datum_praezision string, name string, ist_urspruenglich string")
    edits = [("00001", "stadium_1_datum", "1900", "1901", 1), ("00001", "stadium_1_datum", "1901", "vor 1902", 2), ("00001", "stadium_1_datum", "vor 1902", "1903-05-06", 3), ("00001", "stadium_1_name", "Weg", "Pfad", 4), ("00001", "stadium_1_name", "Pfad", "Hof", 5)]
    listed = spark.createDataFrame(edits, "schl_nr string, feld string, wert_alt string, wert_neu string, seq int")
    new, wrong = overlay.edited_stages(one, listed)
    assert wrong.count() == 0 and [tuple(r)[2:5] for r in new.collect()] == [("1903-05-06", "tag", "Hof")]
    _, wrong = overlay.edited_stages(one, listed.where("seq <> 1"))
    assert {r["meldung"] for r in wrong.collect()} == {"wert_alt passt nicht zum Wert der Tabelle"}


def test_answers_of_the_service():
    from namechron.sources import client
    from namechron.sources.config import ReaderSettings

    good = b'{"choices": [{"message": {"content": "[]"}}]}'
    settings = ReaderSettings(*["http://localhost"] * len(ReaderSettings.__dataclass_fields__))
    assert client.send({}, settings, lambda call: (200, good)) == "[]"
    assert client.content(b'{"choices": [{"message": {"content": null}}]}') == ""
    for status, answer, want in ((200, b"{", 502), (200, b'{"choices": []}', 502), (200, b'{"choices": [{"message": []}]}', 502), (404, good, 404), (503, b"", 503)):
        with pytest.raises(client.HttpError) as e:
            client.send({}, settings, lambda call, status=status, answer=answer: (status, answer))
        assert e.value.status == want
    assert client.holds_list('x [1] ```json [{}]```') and not client.holds_list("x [1]") and client.holds_list("so: [] ") and not client.holds_list("none")


def test_cleaning_is_linear(spark):
    import time

    from namechron.functions.text import clean_lines

    text = "\n".join(["a bc", *[f"A line of the text with number {i}" for i in range(4000)], "", "x yz"])
    df = spark.createDataFrame([(text,)], "text string").select(clean_lines("text", "Title").alias("t"))
    df.collect()
    start = time.perf_counter()
    lines = df.collect()[0]["t"].split("\n")
    assert time.perf_counter() - start < 5 and (lines[0], lines[-1], len(lines)) == ("", "", 4003)


def test_version_sources(spark, tmp_path, capsys):
    from namechron.__main__ import main

    place = f"file://{tmp_path}"
    row = {"schl_nr": "00001", "lemma": "Weg", "buchseite": 3, "status": "automatisch"}
    named = {"schl_nr": "00001", "gueltig_ab": "1920", "datum_praezision": "jahr", "ist_urspruenglich": "falsch"}
    listed = [row | {"lemma": "first of the key"}, row], [named | {"stadium": 2, "name": "B"}, named | {"stadium": "1", "name": "A"}]
    mapped = {"00001": row | {"lemma": "Gasse"}, "00002": {"schl_nr": "00002", "lemma": None, "buchseite": "x"}}, {"00001": [named | {"stadium": 1, "name": "A"}]}
    old, new = files.load_version(spark, listed), files.load_version(spark, mapped)
    assert [(r["schl_nr"], r["lemma"], r["buchseite"], r["stadtteile"]) for r in new[0].orderBy("seq").collect()] == [("00001", "Gasse", 3, ""), ("00002", "", None, "")]
    for name, (s, t) in (("old", old), ("new", new)):
        files.write_csv(s, f"{place}/{name}/streets", schemas.STREETS, ["seq"])
        files.write_csv(t, f"{place}/{name}/stages", schemas.STAGES, ["seq"])
    want = {("eintrag_neu", "00002", None, None), ("kopffeld_veraendert", "00001", "Weg", "Gasse"), ("stadium_verloren", "00001", "1920 B", None)}
    for a in (old, files.load_version(spark, f"{place}/old")):
        for b in (new, files.load_version(spark, f"{place}/new")):
            assert {(r["kategorie"], r["schl_nr"], r["alt"], r["neu"]) for r in diff.changes(*a, *b).collect()} == want
    empty = files.load_version(spark, ([], {}))
    assert diff.report_lines(diff.changes(*empty, *empty)).count() == 0 and empty[0].count() == empty[1].count() == 0
    with pytest.raises(ValueError, match="seq"):
        files.load_version(spark, (old[0].drop("seq"), old[1]))
    assert main(["diff", f"{place}/old", f"{place}/new", "--out", f"{place}/report"]) == 0 and "| eintrag_neu | 1 |" in capsys.readouterr().out
    lines = [r["value"] for r in spark.read.text(f"{place}/report").collect()]
    assert sorted(lines) == sorted(
        ["## eintrag_neu", "- 00002 ", "## stadium_verloren", "- 00001 Weg — alt: 1920 B", "## kopffeld_veraendert", "- 00001 Weg — feld: lemma; alt: Weg; neu: Gasse"]
    )


def test_review_commands(spark, tmp_path, capsys):
    from namechron.__main__ import main

    place = f"file://{tmp_path}"
    s = streets(spark, ("00001", "Alter Weg", 1, "unsicher"), ("00002", "Ende", 1, "automatisch"))
    files.write_csv(s, f"{place}/t/streets", schemas.STREETS, ["seq"])
    files.write_csv(stages(spark, _00001=[("1920", "X")]), f"{place}/t/stages", schemas.STAGES, ["seq"])
    files.write_csv(spark.createDataFrame([(1, "Alter Weg", Reason.NO_CLASS, "")], schemas.LOG), f"{place}/t/log", schemas.LOG)
    same = {"stadtteile": "Mitte; Ost", "strassenklasse": "Gemeindestraße"}
    read = [{"schl_nr": "1", "lemma": "Alterweg", **same, "stadien": [{"datum": "1920:", "name": "X"}]}, {"schl_nr": "2", "lemma": "Ende", **same}]
    (tmp_path / "a" / "my-one").mkdir(parents=True)
    (tmp_path / "a" / "my-one" / "s001.json").write_text(json.dumps({"buchseite": 1, "prompt_hash": "h", "fehler": "", "eintraege": read}))
    review_args = ["review", f"{place}/t", f"{place}/a", "one", f"{place}/list"]
    assert main(review_args) == 0 and main(review_args) == 0 and "## one" in capsys.readouterr().out
    rows = [r.asDict() for r in files.read_csv(spark, f"{place}/list").collect()]
    assert [(r["schl_nr"], r["feld"], r["wert_parser"], r["wert_one"], r["einig"]) for r in rows] == [("00001", "lemma", "Alter Weg", "Alterweg", "beide")]
    assert main(["uncertain", f"{place}/t", f"{place}/a", "one", f"{place}/all"]) == 0
    full = files.read_csv(spark, f"{place}/all").collect()
    assert {r["schl_nr"] for r in full} == {"00001"} and {r["grund"] for r in full} == {Reason.NO_CLASS}
    filled = spark.createDataFrame([rows[0] | {"korrektur": "Alterweg"}]).select(*rows[0])
    files.write_csv(filled, f"{place}/list", filled.schema)
    assert main(review_args) == 1 and "filled" in capsys.readouterr().err
    list_args = [f"{place}/t", f"{place}/list", f"{place}/overlay"]
    assert main(["check", *list_args]) == 0 and main(["takeover", *list_args, "--date", "2026-01-01"]) == 0
    assert [(r["feld"], r["wert_neu"], r["datum"]) for r in files.read_overlay(spark, f"{place}/overlay").collect()] == [("lemma", "Alterweg", "2026-01-01")]
    wrong = spark.createDataFrame([rows[0] | {"wert_parser": "Anders", "korrektur": "Weg"}]).select(*rows[0])
    files.write_csv(wrong, f"{place}/list", wrong.schema)
    assert main(["check", *list_args]) == 1 and main(["takeover", *list_args]) == 1


def test_head_field_that_is_edited_twice(spark):
    s, none = streets(spark, ("1", "A", 4, "automatisch"), ("2", "X", 1, "a")), stages(spark)
    two = corrections(spark, ("1", "lemma", "A", "B"), ("1", "buchseite", "4", "009"), ("1", "lemma", "B", "C"), ("1", "buchseite", "9", "12"), ("2", "lemma", "X", "Y"), ("7", "lemma", "Neu", "Neuer"), ("7", "stadtteile", "", "Ost"), ("7", "eintrag", "", "Neu"), ("7", "buchseite", "", "3"))
    assert overlay.violations(s, none, two).collect() == []
    assert {(r["schl_nr"], r["lemma"], r["stadtteile"], r["buchseite"]) for r in overlay.apply(s, none, two)[0].collect()} == {("1", "C", "Mitte; Ost", 12), ("2", "Y", "Mitte; Ost", 1), ("7", "Neuer", "Ost", 3)}
    for row in (("1", "lemma", "A", "D"), ("1", "lemma", "B", "D"), ("1", "buchseite", "009", "1"), ("7", "lemma", "Neu", "N"), ("7", "stadtteile", "", "West")):
        stale = two.unionByName(corrections(spark, row).withColumn("seq", F.lit(99).cast("long")))
        with pytest.raises(overlay.OverlayError, match="wert_alt passt nicht"):
            overlay.apply(s, none, stale)
    again = two.unionByName(corrections(spark, ("7", "eintrag", "", "Nochmal")).withColumn("seq", F.lit(99).cast("long")))
    assert [r["meldung"] for r in overlay.head_violations(s, again).collect()] == ["Schlüsselnummer vorhanden — Neuanlage nicht möglich"]


def test_gaps_to_a_key_far_away(spark):
    far = streets(spark, ("1", "A", 1, "a"), ("2000000000", "B", 1, "a"), ("32769", "C", 1, "a"), ("32769", "C", 1, "a"), ("32771", "C", 1, "a"), ("x", "D", 1, "a"))
    assert checks.key_stats(far).first().asDict() == {"kleinste": 1, "groesste": 2_000_000_000, "anzahl": 5, "luecken": 1_999_999_996, "dubletten": 1}
    assert sorted(map(tuple, checks.key_gap_intervals(far).collect())) == [(2, 32768), (32770, 32770), (32772, 1_999_999_999)]
    assert checks.key_gaps(far.where("schl_nr <> '2000000000'")).agg(F.count("luecke"), F.min("luecke"), F.max("luecke"), F.countDistinct("luecke")).first() == (32768, 2, 32770, 32768)
    assert checks.key_gaps(far.where("schl_nr in ('1', '2000000000')")).limit(3).count() == 3
    dense = spark.range(0, 200_000).where("id % 65536 <> 5 and id <> 32768").select(F.col("id").cast("string").alias("schl_nr"))
    assert sorted(r["luecke"] for r in checks.key_gaps(dense).collect()) == [5, 32768, 65541, 131077, 196613]
    assert checks.key_gap_intervals(far.limit(0)).count() == 0 and checks.key_gaps(far.limit(1)).count() == 0


def test_bag_difference_plan_and_nulls(spark):
    kinds = "schl_nr string, n int, x string"
    a = spark.createDataFrame([("1", 1, "p"), ("1", 2, "p"), ("1", 3, None), ("1", 4, "q"), ("2", 1, "r")], kinds)
    b = spark.createDataFrame([("1", 1, None), ("1", 2, None), ("1", 3, "p"), ("3", 1, "s")], kinds)
    rest = diff.unmatched(a, b, ["x"], "n", ["n"])
    assert sorted((r["schl_nr"], r["n"], r["a"] and r["a"]["n"], r["b"] and r["b"]["n"]) for r in rest.collect()) == [("1", 1, 2, 2), ("1", 2, 4, None), ("2", 1, 1, None), ("3", 1, None, 1)]
    assert "Join" not in rest._jdf.queryExecution().executedPlan().toString()


def test_lookup_in_a_table(spark):
    from namechron.operators.lookup import fuzzy_lookup

    long = "lang" * 40
    vocabulary = spark.createDataFrame([("Straße",), ("Strase",), ("Übung",), ("Übung",), ("a",), (None,), ("",), (long + "x",), ("x" * 64,)], "entry string")
    asked = ["strasse", "strae", "Ubung", "ÜBUNG", "b", "", None, long, "y" + long[1:] + "x", long + "yy", "x" * 63, "x" * 65, "x" * 66, "Strafe"]
    words = spark.createDataFrame([(i, w, "old") for i, w in enumerate(asked)], "i int, word string, found string")
    got = {r["i"]: r["found"] for r in fuzzy_lookup(words, vocabulary, "word", "entry").collect()}
    near = {w: [v for v in {"Straße", "Strase", "Übung", "a", "", long + "x", "x" * 64} if w is not None and _distance(w.lower(), v.lower()) == 1] for w in asked}
    assert got == {i: near[w][0] if len(near[w]) == 1 else None for i, w in enumerate(asked)} and got[7] == long + "x" and got[13] is None
    assert fuzzy_lookup(words.limit(0), vocabulary, "word", "entry").count() == 0 and fuzzy_lookup(words, vocabulary.limit(0), "word", "entry").where("found is not null").count() == 0


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_reading_run_goes_on_where_it_broke(spark, tmp_path):
    from functools import partial

    scans = spark.createDataFrame([(p, bytes([p])) for p in range(1, 13)] + [(1, b"x"), (None, b"x"), (13, None)], "buchseite int, content binary").coalesce(1)
    (tmp_path / "log").mkdir()

    def service(log, most, body):
        import base64
        import os

        page = base64.b64decode(body["messages"][0]["content"][1]["image_url"]["url"].split(",")[1])[0]
        if len(os.listdir(log)) >= most:
            raise client.HttpError(503)
        open(f"{log}/{page}-{os.urandom(4).hex()}", "w").close()
        return "no list" if page == 4 else '[{"schl_nr": "%d"}]' % page

    def go(most, **more):
        return client.read_run(scans, f"file://{tmp_path}/answers", "r", "prompt", "h1", partial(service, str(tmp_path / "log"), most), sleep=lambda s: None, **more).collect()

    first = go(5, threads=1, patience=2)  # page 4 takes three tries
    assert len(first) == 12 and {s: sum(r["stand"] == s for r in first) for s in ("neu", "abgebrochen", "offen")} in ({"neu": 3, "abgebrochen": 2, "offen": 7}, {"neu": 5, "abgebrochen": 2, "offen": 5})
    kept = {p.name for p in (tmp_path / "answers" / "r").glob("s*.json")}
    second = go(99, threads=3)
    assert {r["buchseite"] for r in second if r["stand"] == "neu"} == {r["buchseite"] for r in first if r["stand"] != "neu"} and all(r["stand"] in ("neu", "bekannt") for r in second)
    assert {p.name for p in (tmp_path / "answers" / "r").glob("*")} == {f"s{p:03d}.json" for p in range(1, 13)} >= kept
    asked = [int(p.name.split("-")[0]) for p in (tmp_path / "log").iterdir()]
    assert sorted(p for p in asked if p != 4) == [1, 2, 3, *range(5, 13)] and asked.count(4) in (3, 4, 5)  # none twice but the one without a list
    read = {r["buchseite"]: (r["fehler"], r["eintraege"]) for r in files.read_answers(spark, f"file://{tmp_path}/answers", {"r": "r"}).collect()}
    assert read[4] == ("unlesbar", None) and read[5][0] == "" and len(read) == 12
    assert {r["stand"] for r in go(99)} == {"bekannt"} and {r["stand"] for r in go(99, again=True)} == {"neu"}


def test_read_command(spark, tmp_path, capsys, monkeypatch):
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
    from threading import Thread

    from namechron.__main__ import main

    seen = []

    class Service(BaseHTTPRequestHandler):
        def do_POST(self):
            seen.append(self.rfile.read(int(self.headers["Content-Length"])))
            answer = json.dumps({"choices": [{"message": {"content": '```json\n[{"schl_nr": "1"}]\n```'}}]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(answer)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    Thread(target=server.serve_forever, daemon=True).start()
    for n in (7, 8, 9):
        (tmp_path / f"s{n:03d}.png").write_bytes(b"image")
    (tmp_path / "prompt.txt").write_text("Lies die Seite.")
    monkeypatch.setenv("READER_BASE_URL", f"http://127.0.0.1:{server.server_port}/v1")
    monkeypatch.setenv("READER_API_KEY", "k")
    args = ["read", f"file://{tmp_path}", f"file://{tmp_path}/answers", "my-model", f"file://{tmp_path}/prompt.txt"]
    assert main([*args, "--pages", "7-8"]) == 0 and "'neu': 2" in capsys.readouterr().out
    assert main([*args, "--threads", "2"]) == 0 and "'neu': 1, 'bekannt': 2" in capsys.readouterr().out and len(seen) == 3
    assert files.read_answers(spark, f"file://{tmp_path}/answers", files.find_readers(spark, f"file://{tmp_path}/answers", ["my"])).count() == 3
    server.shutdown()
    monkeypatch.delenv("READER_BASE_URL")
    assert main(args) == 1


def test_ranks_and_running_values(spark):
    from namechron.operators.ranks import added, ranked, running

    rows = [(g, i % 7 if i % 5 else None, f"r{i}") for i in range(300) for g in ("a", None)] + [("b", 1, "same")] * 50
    df = spark.createDataFrame(rows, "g string, x int, v string").repartition(6)
    whole = [tuple(r) for r in ranked(df.withColumn("position", F.lit("old")), [F.col("x"), F.col("v")]).orderBy("position").collect()]
    assert [r[3] for r in whole] == list(range(650)) and [r[1:3] for r in whole] == sorted([r[1:3] for r in whole], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    inside = ranked(df, [F.col("x"), F.col("v")], ["g"], falling=(0,)).collect()
    for g in ("a", "b", None):
        own = sorted((r for r in inside if r["g"] == g), key=lambda r: r["position"])
        assert [r["position"] for r in own] == list(range(len(own))) and [r["x"] for r in own] == sorted((r["x"] for r in own), key=lambda x: (x is None, -(x or 0)))
    numbers = spark.range(1, 1000).select("id", (F.col("id") % 3).cast("string").alias("g"))
    sums = running(numbers, ["g"], [F.floor(F.col("id") / 10)], ["id"], {"s": (F.sum, F.col("id"), added), "m": (F.max, F.col("id"), F.greatest)})
    assert all(r["s"] == sum(i for i in range(1, r["id"]) if i % 3 == r["id"] % 3) and r["m"] == (r["id"] - 3 if r["id"] > 3 else None) for r in sums.collect())
    back = running(numbers, [], [F.floor(F.col("id") / 10)], ["id"], {"next": (F.min, F.col("id"), F.least)}, falling=True)
    assert all(r["next"] == (r["id"] + 1 if r["id"] < 999 else None) for r in back.collect())
    assert ranked(df.limit(0), [F.col("x")]).count() == 0
