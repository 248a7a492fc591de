"""Segmentation, heads, chains and whole pages."""

import pytest
from pyspark.sql import functions as F

from namechron.operators import chains, entries, heads, segment
from namechron.plans import parse_run
from namechron.schemas import Reason


def read(spark, column, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r["x"] for r in rows.select("i", column(F.col("c")).alias("x")).orderBy("i").collect()]


def test_chain_stages(spark):
    rest = "urspr. Alter Weg, 18.11.1904: Kirchstraße (tiw.), 1926, Klosterstraße; vor 1930: Hof, Am 25. Juli 1516 wurde"
    found = read(spark, chains.chain, rest, "18.11.1904: Weg, 19377 Rest.", "", None, "a\x01\x02, 1900: Weg \x01x.")
    assert [tuple(s) for s in found[0]["stadien"]] == [
        (1, "", "unbekannt", "Alter Weg", "wahr", Reason.ORIGINAL_NO_COLON),
        (2, "1904-11-18", "tag", "Kirchstraße (tlw.)", "falsch", ""),
        (3, "1926", "jahr", "Klosterstraße", "falsch", Reason.NO_COLON),
        (4, "1930", "vor", "Hof", "falsch", ""),
    ]
    assert [r["residuum"] for r in found[1:]] == ["19377 Rest", "", "", "a"]
    assert [[s["name"] for s in r["stadien"]] for r in found[1:]] == [["Weg"], [], [], ["Weg  x"]]


def test_long_chain(spark):
    stage = [f"{1 + n % 28:02d}.03.{1000 + n % 900}: Weg {chr(65 + n % 26)}x" for n in range(3000)]
    (found,) = read(spark, chains.chain, ", ".join(stage) + ".")
    assert len(found["stadien"]) == 3000 and found["stadien"][-1]["stadium"] == 3000 and set(found["residuum"]) <= set(", ")


def test_chain_text(spark):
    two = "29.08.1927: Weg (Verl.). 17. März 1971: Hof. Ende"
    far = "x" * 101 + " 29.08.1927: Weg. Mehr"
    got = read(spark, chains.chain_text, "29.08.1927: Weg. Mehr im Jahre 1930 hier.", "Nichts davon. 1930", far, two, "", "ohne Ende", "29.08.1927: Weg ohne Ende 17")
    assert got == ["29.08.1927: Weg.", "Nichts davon.", far.removesuffix(" Mehr"), "29.08.1927: Weg (Verl.). 17. März 1971: Hof.", "", "ohne Ende", "29.08.1927: Weg ohne Ende 17"]


@pytest.mark.parametrize(
    ("body", "key", "districts", "classes", "group", "rest", "hints"),
    [
        ("01 544, Stadtteil Mitte, Str.-Kl.: Gemeindestraße, Str.-Gr.: Berufe, 29.08.1927: Weg. Text.", "01544", ["Mitte"], ["Gemeindestraße"], "Berufe", ", 29.08.1927: Weg.", []),
        ("7, Stadtteile Ost und West, Landstraße, Str.-Gr.: Orte, alte, 1900: Weg. X", "00007", ["Ost", "West"], ["Landstraße"], "Orte, alte", ", 1900: Weg.", [Reason.CLASS_NO_MARKER]),
        ("7, Stadtteil Ost, Sl.-KI;: ia Gemeindstraße; _, Str.-G.; Orte. 14. Mai 1900: Weg.", "00007", ["Ost"], ["Gemeindestraße"], "Orte", ". 14. Mai 1900: Weg.", [Reason.EDGE_REMOVED, Reason.CLASS_CORRECTED]),
        ("12, ohne alles. Und mehr", "00012", [], [], "", ", ohne alles.", []),
    ],
)
def test_heads(spark, body, key, districts, classes, group, rest, hints):
    assert tuple(read(spark, heads.head, body)[0]) == (key, districts, classes, group, rest, hints)


def test_no_key(spark):
    assert read(spark, heads.head, "keine Nummer", "123456, x", "", None) == [None] * 4


def test_segments_across_pages(spark):
    pages = [("v", 210, "Vorwort. Alter Weg: Schl.-Nr.: 1, Text der weiter"), ("v", 211, "geht. St. Annental:; Schi,-N.; 2, mehr. Schl.-Nr.: 3, ohne Lemma")]
    pages += [("w", 1, "Hofweg: Schl.-"), ("w", 2, "Nr.: 9, Sch"), ("w", 3, "luss"), ("w", 4, None), ("w", 5, "hier. Am Ende: A"), ("w", 6, "Schl.-Nr.: 8, zuletzt"), ("x", 1, ""), ("w", 5, "")]
    rows = [r.asDict() for r in segment.segment_volumes(spark.createDataFrame(pages, "volume string, page int, text string")).orderBy("volume", "seq").collect()]
    assert [r["seq"] for r in rows] == [0, 1, 2, 0, 1]  # volume x has no anchor
    assert [(r["lemma_roh"], r["rumpf"], r["buchseite"]) for r in rows if r["volume"] == "w"] == [("Hofweg", "9, Sch luss  hier.", 1), ("Am Ende", "8, zuletzt", 5)]
    found = [r for r in rows if r["kind"] == "entry" and r["volume"] == "v"]
    rejected = [{"buchseite": r["buchseite"], "rohtext": r["rumpf"]} for r in rows if r["kind"] == "rejected" and r["volume"] == "v"]
    assert [(e["lemma_roh"], e["buchseite"], e["hinweise"]) for e in found] == [("Alter Weg", 210, []), ("St. Annental", 211, [Reason.ANCHOR_CORRECTED])]
    assert found[0]["rumpf"] == "1, Text der weiter geht." and "ohne Lemma" in found[1]["rumpf"]
    assert rejected == [{"buchseite": 211, "rohtext": "2, mehr. Schl.-Nr.:"}]
    assert segment.segment_volumes(spark.createDataFrame([], "volume string, page int, text string")).count() == 0


PAGES = [
    ("v", 1, "Lexikon\n\nKronenstraße: Schl.-\nNr.: 00100, Stadtteil Mitte, Str.-\nKl.: Gemeindestraße, Str.-\nGr.: Adel, 29.08.1927: Alter Weg, 20.11.1937: Kronenstraße. Nach der Krone."),
    ("v", 2, "2\nZielweg: Schl.-Nr.: 00200, Stadtteil Ost, Str.-Kl.: Gemeindestraße, Str.-Gr.: Orte, Siehe Kronenstraße. Mehr dazu.\nSchl.-Nr.: 5 nichts. Doppel: Schl.-Nr.: 00100, kaputt."),
]


def test_tables_of_pages(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "volume string, page int, text string")
    streets, stages, log = parse_run.parse(df, "Lexikon")
    rows = {(r["lemma"]): r for r in streets.collect()}
    assert {k: (r["schl_nr"], r["status"], r["verweis_auf"], r["buchseite"]) for k, r in rows.items()} == {
        "Kronenstraße": ("00100", "unsicher", "", 1), "Zielweg": ("00200", "automatisch", "Kronenstraße", 2), "Doppel": ("00100", "unsicher", "", 2),
    }
    assert [(r["stadium"], r["gueltig_ab"], r["name"]) for r in stages.orderBy("stadium").collect()] == [(1, "1927-08-29", "Alter Weg"), (2, "1937-11-20", "Kronenstraße")]
    reasons = sorted((r["lemma_roh"], r["grund"]) for r in log.collect())
    assert reasons == sorted([("", Reason.ANCHOR_WITHOUT_LEMMA), ("Doppel", Reason.NO_STAGE), ("Doppel", Reason.NO_DISTRICT), ("Doppel", Reason.NO_CLASS), ("Doppel", Reason.KEY_TWICE), ("Kronenstraße", Reason.KEY_TWICE)])
    assert entries.REFERENCE_WINDOW == 120


def test_run_writes_files(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    for _, page, text in PAGES:
        (folder / f"s{page:03d}.txt").write_bytes(text.encode() + b"\xff")
    figures = parse_run.run(spark, f"file://{folder}", f"file://{tmp_path}/out", running_title="Lexikon")
    assert figures["strassen"] == 3 and figures["namensstadien"] == 2
    written = next((tmp_path / "out" / "streets").glob("part*.csv")).read_text()
    assert written.startswith("schl_nr,lemma,stadtteile") and written.count("\n") == 4
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "s001.txt").write_text("nichts")
    with pytest.raises(parse_run.NothingParsed):
        parse_run.run(spark, f"file://{tmp_path}/none", f"file://{tmp_path}/out2")


def test_many_anchors_on_a_page(spark):
    import time

    one = spark.createDataFrame([("v", 1, " ".join(f"Weg {i}: Schl.-Nr.: {i}, Text." for i in range(4000))), ("w", 1, "Hof: Schl.-Nr.: 7, Ende.")], "volume string, page int, text string")
    segment.segment_volumes(one.where("volume = 'w'")).count()
    start = time.perf_counter()
    found = segment.anchors(segment.located_pages(one).persist()).where("volume = 'v'").agg({"begin": "count"}).first()[0]
    assert found == 4000 and time.perf_counter() - start < 10
    rows = segment.segment_volumes(one).where("volume = 'v'").orderBy("seq").collect()
    assert [(r["seq"], r["lemma_roh"], r["rumpf"]) for r in rows] == [(i, f"Weg {i}", f"{i}, Text.") for i in range(4000)]


def test_volume_of_many_pages(spark, monkeypatch):
    monkeypatch.setattr(segment, "PAGES", 3)
    monkeypatch.setattr(segment, "BLOCK", 32)
    pages = spark.createDataFrame([("v", n, f"Rest {n - 1}. Weg {n}: Schl.-Nr.: {n}, Text") for n in range(1, 60) if n % 10], "volume string, page int, text string")
    rows = segment.segment_volumes(pages).orderBy("seq").collect()
    numbers = [n for n in range(1, 60) if n % 10]
    assert [(r["seq"], r["lemma_roh"], r["buchseite"]) for r in rows] == [(i, f"Weg {n}", n) for i, n in enumerate(numbers)]
    assert [r["rumpf"] for r in rows] == [f"{n}, Text Rest {m - 1}." for n, m in zip(numbers, numbers[1:], strict=False)] + ["59, Text"]
