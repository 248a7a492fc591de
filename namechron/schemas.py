"""Schemas, enumerations and reason texts of the tables."""

from pyspark.sql import types as T


def _struct(names: str) -> T.StructType:
    out = T.StructType()
    for name in names.split():
        name, _, kind = name.partition(":")
        out = out.add(name, {"": T.StringType(), "int": T.IntegerType()}[kind])
    return out


#: Columns of the published tables, in file order.
STREETS = _struct("schl_nr lemma stadtteile strassenklasse namensgruppe verweis_auf buchseite:int status")
STAGES = _struct("schl_nr stadium:int gueltig_ab datum_praezision name ist_urspruenglich")
LOG = _struct("buchseite:int lemma_roh grund rohtext")
CONCORDANCE = _struct("stadtteil ehemalig heutig schl_nr datum_praezision eindeutig quelle zusatz")
CONCORDANCE_REVIEW = _struct("buchseite:int lemma grund befund")
VALIDATION_REVIEW = _struct("lemma schl_nr grund")
OVERLAY = _struct("schl_nr feld wert_alt wert_neu beleg quelle datum")
SAMPLE = _struct("schl_nr lemma status buchseite:int band:int pdf_seite:int haelfte feld wert korrekt korrektur")

HEAD_FIELDS = ["lemma", "stadtteile", "strassenklasse", "namensgruppe", "verweis_auf"]
DIFF_FIELDS = [*HEAD_FIELDS, "buchseite"]
SAMPLE_FIELDS = ["schl_nr", *HEAD_FIELDS]

#: Enumerations.
PRECISIONS = ["tag", "monat", "jahr", "jahrhundert", "vor", "nach", "unbekannt"]
AUTOMATIC, CHECKED, UNCERTAIN, FROM_READER = "automatisch", "geprueft", "unsicher", "modell"
USABLE = [AUTOMATIC, CHECKED]
TRUE, FALSE = "wahr", "falsch"
AGREEMENT = ["beide", "eines", "unlesbar", "keines"]
STREET_CLASSES = ["Gemeindestraße", "Kreisstraße", "Landstraße", "Hauptstraße", "Bundesstraße"]
MONTHS = ["Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember"]


class Reason:
    """Texts of review reasons and hints."""

    ANCHOR_WITHOUT_LEMMA = "Anker ohne Lemma"
    ANCHOR_CORRECTED = "Anker OCR-korrigiert"
    NO_KEY = "keine Schlüsselnummer lesbar"
    LEMMA_LENGTH = "Lemma auffällig (Länge)"
    LEMMA_FORM = "Lemma auffällig (Form)"
    NO_STAGE = "kein Namensstadium erkannt"
    STAGE_ODD = "Namensstadium auffällig"
    FIELD_LENGTH = "Feld auffällig (Länge)"
    NO_DISTRICT = "Stadtteil fehlt"
    NO_CLASS = "Straßenklasse fehlt"
    CHAIN_LEFTOVER = "Namenskette unvollständig gelesen"
    KEY_TWICE = "Schlüsselnummer mehrfach"
    COMMA_AFTER_DAY = "Datum: Komma nach Tag"
    NO_COLON = "Datum ohne Doppelpunkt"
    MONTH_CORRECTED = "Monatsname OCR-korrigiert"
    DOUBLE_YEAR = "Datum: Doppeljahr"
    DAY_INVALID = "Datum: Tag ungültig"
    MONTH_UNREADABLE = "Datum: Monat unlesbar"
    ORIGINAL_NO_COLON = "urspr. ohne Doppelpunkt"
    SUFFIX_CLOSED = "Klammerzusatz ergänzt"
    CLASS_NO_MARKER = "Straßenklasse ohne Marker"
    CLASS_CORRECTED = "Straßenklasse OCR-korrigiert"
    EDGE_REMOVED = "Randzeichen entfernt"
    CHAIN_INCOMPLETE = "Namenskette unvollständig (letztes Stadium ≠ Lemma)"
    ALPHABET = "Alphabet"
    NOT_IN_REGISTER = "nicht im amtlichen Verzeichnis"
    DATE_UNREADABLE = "Datum nicht normalisierbar"
    DATE_LIMITED = "Datum nur eingeschränkt lesbar"
    STAGES_NO_LIST = "Stadien nicht als Liste"
