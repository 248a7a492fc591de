"""Patterns of the printed text.

All of this is fixed: the patterns decide which readings are right, so they are stated as they
must match. ``java`` turns one into the JVM's dialect.
"""

import re

#: Where a full stop ends a sentence: not after a digit, "St" or a Roman numeral up to IV ("Ill" is a misread III).
NO_ABBREVIATION = r"(?<!\d)(?<!\bSt)(?<!\bI)(?<!\bII)(?<!\bIII)(?<!\bIV)(?<!\bIll)"
SENTENCE_END = NO_ABBREVIATION + r"\.(?=\s+[0-9A-ZÄÖÜ]|\s*$)"

#: A date stamp; groups: 1 century, 2-4 numeric day, month, year, 5-8 day, its mark, month word, year,
#: 9-11 qualifier, year, second year, 12-13 bare year, second year, 14 separator.
STAMP = (
    r"(?<![\d/])(?:"
    r"(?:im\s+)?(\d{1,2})\.\s*Jahrh(?:undert|\.)"
    r"|(\d{2})\.(\d{2})\.(\d{4})"
    r"|(\d{1,3})([.,])\s*([A-Za-zÄÖÜäöü]{3,9})\s+(\d{4})"
    r"|(vor|nach|um|etwa|gegen)\s+(\d{4})(?:/(\d{2}))?"
    r"|(\d{4})(?:/(\d{2}))?"
    r")(?!\d)\s*(:|;|,|)"
)
#: The same without groups, for use within look-aheads.
STAMP_PLAIN = re.sub(r"\((?!\?)", "(?:", STAMP)
ISO_DAY = r"^(\d{4})-(\d{2})-(\d{2})$"

#: Page furniture, one line each.
PAGE_NUMBER = r"^\s*\d{1,3}\s*$"
SECTION_LETTER = r"^[ \t]*[A-ZÄÖÜ](?:[ \t]*,[ \t]*[A-ZÄÖÜ])?[ \t]*$|(?<!-\n)^[ \t]*[a-zäöü][ \t]*$"
MARGIN_NOISE = r"^\s*(?:[A-Za-zÄÖÜäöüß]{1,3}\s+)*[A-Za-zÄÖÜäöüß]{1,3}\s*$"

#: Joining of lines, in this order: (pattern, JVM replacement).
JOINING = [
    (r"(Str)\.-\s*\n\s*(Kl)\.?:", "$1.-$2.:"),
    (r"(Str)\.-\s*\n\s*(Gr)\.?:", "$1.-$2.:"),
    (r"(Schl)\.-\s*\n\s*(Nr)\.?:", "$1.-$2.:"),
    (r"Stadt-\s*\n\s*teil", "Stadtteil"),
    (r"([Ss]tra)-\n\s*B(?=e)", "$1ß"),
    (r"(?<=\w)-\n\s*(?=[A-ZÄÖÜ])", "-"),
    (r"-\n(?=[a-zäöüß])", ""),
    (r"\n", " "),
    (r"Stadt-?t{0,2}ei[l!t](e?)-?(?=[ \tA-ZÄÖÜ])", "Stadtteil$1 "),
    (r"([a-zäöüß])und([A-ZÄÖÜ])", "$1 und $2"),
]
#: Words whose first letter lost or gained its dots.
DOTTED_WORDS = {
    "Ortlichkeit": "Örtlichkeit", "Abtissin": "Äbtissin", "Agyptologe": "Ägyptologe", "Agirstraße": "Ägirstraße", "Uckendorfer": "Ückendorfer", "Östviertel": "Ostviertel",
}

#: Key anchors of entries, and the forms of one that are no news.
ANCHOR = r"(?:[A-Z]\s+)?-?\s*Sch[a-zA-Z!|}\)]{0,3}[.,]?\s*-?\s*N(?:r)?\.?\s*[:;]"
ANCHOR_KNOWN = r"^Sch[a-zA-Z!|]{0,3}[.,]?-?Nr\.?:$"
LEMMA = r"((?:(?!,|;|:|(?<!\bSt)(?<!\bI)(?<!\bII)(?<!\bIII)(?<!\bIV)(?<!\bIll)\.(?!-|[A-Za-zÄÖÜäöüß]))[^\n]){2,60}?)\s*(?::;?|;)\s*$"

#: Head of an entry.
KEY = r"^\s*(\d(?:[ ]?\d){0,5})\b"
STREET_MARK = r"S[tl]r?[.:]?\s*-?\s*"
CLASS_MARK = STREET_MARK + r"K[lILt]?\.?\s*[:;]+"
GROUP_MARK = STREET_MARK + r"Gr?\.?\s*[:;]"
FIELD_END = r"(?<!\d)\.(?=\s|$)"
DAY_DIGITS = r",?\s*\*?\d{1,3}[.,]\s"
DISTRICT = r"Stadtteile?\s+(.+?)(?=,?\s*" + CLASS_MARK + r"|,?\s*" + GROUP_MARK + "|" + FIELD_END + "|$)"
CLASS = CLASS_MARK + r"\s*(.+?)(?=,?\s*" + GROUP_MARK + "|" + FIELD_END + "|$)"
GROUP = GROUP_MARK + r"\s*(.+?)(?=,?\s*(?:urspr\.|" + STAMP_PLAIN + ")|" + DAY_DIGITS + "|" + FIELD_END + "|$)"
MARK_FRAGMENT = "^" + STREET_MARK + "[KG]"
FIELD_REST = r"\s*;\s*[_\s]*$"
EDGE = r"^(?:[„”\"')\]\}|]+\s*|[a-zäöü]{1,3}\s+)(?=[A-ZÄÖÜ])"
CROSS_REFERENCE = r"Siehe\s+([A-ZÄÖÜ][^.,;]{2,60})"

#: Stages of a name chain.
STRICT_STAGE = STAMP + r"\s*((?:(?!" + SENTENCE_END + r")[^\d\n]){1,80})(?:" + SENTENCE_END + r"|[,;](?=\s*(?:urspr\.|" + STAMP_PLAIN + ")))"
STAGE_NAME = r"((?:(?!,|;|" + SENTENCE_END + r")[^\n]){1,80})"
ORIGINAL = r"urspr\.(:?)\s*" + STAGE_NAME
STAGE = STAMP + r"\s*" + STAGE_NAME

#: Suffixes of names: words of the three usual ones, a bracket at the end, a sign of "in part".
SUFFIX_WORDS = {
    "tlw": "tlw.", "tiw": "tlw.", "tIw": "tlw.", "t!w": "tlw.", "tw": "tlw.", "tl": "tlw.", "tlw.": "tlw.",
    "Verl": "Verl.", "verl": "Verl.", "Verl.": "Verl.", "verl.": "Verl.", "Ver1": "Verl.", "Umb": "Umb.", "Umb.": "Umb.",
}
SUFFIX = r"^(.*?)\s*([\(\{\[])([^\(\)\{\}\[\]]*?)([\)\}\]]*)\s*$"
SUFFIX_AT_END = r"\s*[\(\{][^)}]*[\)\}]\s*$"
PARTIAL = r"t[il]{0,3}w|teil"

#: Plausibility of values.
NAME_CHARS = r"^[\p{L}\p{N} .\-()'’/&„\"]*$"
GROUP_CHARS = r"^[\p{L}\p{N} ,.\-()'’/&„\"]*$"
LONE_NUMBER = r"(?<![\w.])\d{1,2}(?![\w.])"
BARE_ABBREVIATION = r"^(?:St|I{1,3}|IV|Ill|\d{1,2})\.?$"

#: Field names and answers of readers.
STAGE_FIELD = r"^stadium_(\d+)(?:_(datum|name|urspruenglich))?$"
ONLY_ORIGINAL = r"^(?:urspr\.?|ursprünglich)\s*:?$"
CODE_FENCE = r"```(?:json)?\s*(.*?)```"
STREET_OF_ADDRESS = r"^(.*?)\s+\d"


def java(pattern: str, flags: str = "") -> str:
    """``pattern`` with Unicode classes in the JVM, and its other flags."""
    return f"(?U{flags})" + pattern
