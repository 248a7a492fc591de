"""Column functions: cleaning, keys, suffixes, dates, plausibility."""

import unicodedata

from pyspark.sql import functions as F

from namechron.functions import dates, patterns, predicates, text
from namechron.schemas import STREET_CLASSES, Reason


def values(spark, inputs, f):
    df = spark.createDataFrame(list(enumerate(inputs)), "i int, x string")
    return [r["y"] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


STAMPS = {
    "26. Mai 1939:": ("1939-05-26", "tag", "", ":"),
    "29.08.1927:": ("1927-08-29", "tag", "", ":"),
    " 29.08.1927 ": ("1927-08-29", "tag", Reason.NO_COLON, ""),
    "32.08.1927:": ("1927", "jahr", Reason.DAY_INVALID, ":"),
    "03, März 1900:": ("1900-03-03", "tag", Reason.COMMA_AFTER_DAY, ":"),
    "3. Novemner 1900;": ("1900-11-03", "tag", f"{Reason.NO_COLON}; {Reason.MONTH_CORRECTED}", ";"),
    "3. Xyz 1900:": ("1900", "jahr", Reason.MONTH_UNREADABLE, ":"),
    "99. Mai 1900:": ("1900", "jahr", Reason.DAY_INVALID, ":"),
    "31.02.1936:": ("1936-02-31", "tag", "", ":"),
    "im 16. Jahrhundert:": ("1501", "jahrhundert", "", ":"),
    "16. Jahrh.:": ("1501", "jahrhundert", "", ":"),
    "vor 1898": ("1898", "vor", Reason.NO_COLON, ""),
    "nach 1910/11:": ("1910", "nach", Reason.DOUBLE_YEAR, ":"),
    "um 1900,": ("1900", "jahr", Reason.NO_COLON, ","),
    "1910/11:": ("1910", "jahr", Reason.DOUBLE_YEAR, ":"),
    "": ("", "unbekannt", "", ""),
    "16. Jh.": None,
    "früher": None,
}


def test_dates_in_columns(spark):
    got = values(spark, STAMPS, dates.partial_date)
    assert [r and tuple(r) for r in got] == list(STAMPS.values())


def test_dates_in_running_text_read_alike(spark):
    printed = [k for k, v in STAMPS.items() if v and k]
    got = values(spark, [f"Im Text {k} weiter" for k in printed], lambda c: dates.read_stamp(F.get(text.captured(text.unmarked(c), patterns.STAMP, 14), F.lit(0))))
    assert [tuple(r) for r in got] == [STAMPS[k] for k in printed]


def test_comparable_and_display(spark):
    assert values(spark, ["1936", " 1936-05-01 ", "", None], dates.comparable) == ["1936-12-31", "1936-05-01", None, None]
    df = spark.createDataFrame([("vor", "1898"), ("unbekannt", ""), ("tag", "1900-01-01"), ("jahrhundert", "1501")], "p string, d string")
    assert [r[0] for r in df.select(dates.display("p", "d")).collect()] == ["vor 1898", "(urspr., kein Datum)", "1900-01-01", "1501"]


def test_weak_stamps_and_places(spark):
    weak = values(spark, ["1900:", "um 1900:", "1.5.1900:", "29.08.1927", "29.08.1927:"], lambda c: dates.weak(dates.partial_date(c), c))
    assert weak == [True, False, None, True, False]
    assert values(spark, ["", "x, ", "x;", "Am "], dates.place_allowed) == [True, True, True, False]


def test_keys(spark):
    assert values(spark, ["Lünink", "Öße", "Crème ﬁn"], text.sort_key) == ["luenink", "oesse", "creme fin"]
    assert values(spark, [" Adolf- Rath-Str. ", "Große  Straße", None], text.compare_key) == ["adolf-rath-strasse", "grosse strasse", ""]
    assert values(spark, ["Grenzstr.", "Grenzstr"], text.address_key) == ["grenzstraße", "grenzstraße"]
    assert values(spark, ["12", "001321", ""], text.zero_filled) == ["00012", "001321", "00000"]
    assert values(spark, ["stadium_12_datum", "stadium_3_urspruenglich", "lemma"], text.field_type) == ["stadium_datum", "stadium_urspruenglich", "lemma"]
    assert values(spark, ["stadium_3_urspruenglich", "stadium_3_name"], lambda c: text.field_type(c, any_part=False)) == ["stadium_3_urspruenglich", "stadium_name"]
    ranked = spark.createDataFrame([(f,) for f in ("stadium_10_name", "stadium_2_urspruenglich", "stadium_2_datum", "namensgruppe", "lemma")], "f string").orderBy(text.field_rank("f"))
    assert [r[0] for r in ranked.collect()] == ["lemma", "namensgruppe", "stadium_2_datum", "stadium_2_urspruenglich", "stadium_10_name"]


def test_exact_sort_key_agrees_on_latin(spark):
    names = ["Ärger", "Ǆ", "é à ñ", "ﬃ", "x"]

    def key(x):
        x = x.lower().replace("ä", "ae").replace("ö", "oe").replace("ü", "ue").replace("ß", "ss")
        return "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))

    assert values(spark, names, text.sort_key) == [key(x) for x in names]


def test_fuzzy_word_needs_one_candidate_at_distance_one(spark):
    assert values(spark, ["Gemeindstraße", "Gemeindestraße", "Gemndstraße", "gemeindestraße"], lambda c: text.fuzzy_unique(c, STREET_CLASSES)) == ["Gemeindestraße", None, None, None]
    assert values(spark, ["ab", "b", "xab", "ba", "", "axc"], lambda c: text.fuzzy_unique(c, ["ab"])) == [None, "ab", "ab", None, None, None]


def test_suffixes(spark):
    names = ["Weg (tiw.)", "Weg {verl", "Weg [Umb]", "Weg (am Ort)", "Weg ()", "Weg", "Weg (tlw. Verl"]
    got = [tuple(r) for r in values(spark, names, text.normalize_suffix)]
    assert got == [("Weg (tlw.)", ""), ("Weg (Verl.)", Reason.SUFFIX_CLOSED), ("Weg (Umb.)", ""), ("Weg (am Ort)", ""), ("Weg ()", ""), ("Weg", ""), ("Weg (tlw. Verl.)", Reason.SUFFIX_CLOSED)]
    assert [tuple(r) for r in values(spark, ["Hochstraße (tiw.)", "A {B} ", "A"], text.split_suffix)] == [("Hochstraße", "(tiw.)"), ("A", "{B}"), ("A", "")]
    assert values(spark, ["(tiw.)", "(t!w.)", "(Verl.)", "(Antwerpen)", "(Teil 2)"], text.is_partial_suffix) == [True, True, False, True, True]


def test_edges_parts_and_values(spark):
    assert [tuple(r) for r in values(spark, ["} Am Weg", "nn Am Weg", "Am Weg", "am weg"], text.strip_edge)] == [("Am Weg", Reason.EDGE_REMOVED)] * 2 + [("Am Weg", ""), ("am weg", "")]
    assert values(spark, ["Ost und West, Süd", "Str.-Kl Ost, "], text.parts) == [["Ost", "West", "Süd"], []]
    assert values(spark, ["x" * 121, "kurz"], text.cap_value) == ["(Fließtext, 121 Zeichen, verworfen)", "kurz"]
    assert values(spark, ["7", "x7", " 001321"], text.reader_key) == ["00007", "x7", "001321"]
    assert values(spark, ["a"], text.prompt_hash) == ["ca978112ca1b"]


PAGE = "mm nm\nLexikon\n12\nA\nAlte Stra-\nBe und Adolf-\nRath-Weg, Str.-\nKl.: x Stadttei! Mitte, OstundWest, Abtissin in der Stra-\nßen\nQ,R\nVs u\n\n"


def test_pages(spark):
    cleaned = values(spark, [PAGE, "", "\n \n"], lambda c: text.clean_lines(c, "Lexikon"))
    assert cleaned[0].replace("\n", "|").strip("|").startswith("Alte Stra-|Be") and "Q,R" not in cleaned[0] and "Vs" not in cleaned[0] and "12" not in cleaned[0]
    assert cleaned[1:] == ["", "\n \n"] or cleaned[1] == ""
    joined = values(spark, [PAGE], lambda c: text.join_lines(text.clean_lines(c, "Lexikon")))[0]
    assert joined == "Alte Straße und Adolf-Rath-Weg, Str.-Kl.: x Stadtteil Mitte, Ost und West, Äbtissin in der Straßen"


def test_predicates(spark):
    assert values(spark, ["Am Weg", "am Weg", "A§", ""], predicates.lemma_odd_form) == [False, True, True, True]
    assert values(spark, ["a b c d e", "x" * 41, "kurz"], predicates.lemma_long) == [True, True, False]
    odd = ["ab", "Ill", "IV.", "Weg 5 Hof", "Obere Aue. Folge", "Weg 12345"]
    fine = ["St. Annental", "II. Weberstraße", "1. Schockenhecke", "Weg (tlw. 2. Hälfte)", "Weg."]
    assert values(spark, odd, predicates.name_odd) == [True] * len(odd)
    assert values(spark, fine, predicates.name_odd) == [False] * len(fine)
    assert values(spark, ["Berufe, alte", "1921: x", "y" * 151], predicates.group_odd) == [False, True, True]
