"""Cleaning, normal forms and keys as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import HEAD_FIELDS, Reason
from . import patterns as P


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace(c: Column | str, pattern: str, new: str, flags: str = "") -> Column:
    return F.regexp_replace(col(c), F.lit(P.java(pattern, flags)), F.lit(new))


def extract(c: Column | str, pattern: str, group: int = 1, flags: str = "") -> Column:
    return F.regexp_extract(col(c), P.java(pattern, flags), group)


def matches(c: Column | str, pattern: str, flags: str = "") -> Column:
    return col(c).rlike(P.java(pattern, flags))


def trim_u(c: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return replace(c, r"^\s+|\s+$", "")


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` as a lambda's variable: it is computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def one_space(c: Column | str) -> Column:
    return trim_u(replace(c, r"\s+", " "))


def zero_filled(c: Column | str, width: int = 5) -> Column:
    """Zeros in front up to ``width``; longer values stay whole."""
    c = col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def _folding() -> tuple[str, str, list[tuple[str, str]]]:
    """Letters that decompose to one letter, what they become, and those that become several."""
    one, base, several = [], [], []
    for n in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0xFB00, 0xFB07)]:
        c = chr(n)
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if plain != c and len(plain) == 1:
            one.append(c)
            base.append(plain)
        elif plain != c and plain:
            several.append((c, plain))
    return "".join(one), "".join(base), several


_ONE, _BASE, _SEVERAL = _folding()


def sort_key(c: Column | str) -> Column:
    """Dictionary order: lower case, umlauts written out, other marks dropped (Latin letters)."""
    c = F.lower(col(c))
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        c = F.replace(c, F.lit(a), F.lit(b))
    ligatures = "".join(a for a, _ in _SEVERAL)
    spelled = reduce(lambda x, ab: F.replace(x, F.lit(ab[0]), F.lit(ab[1])), _SEVERAL, c)
    c = F.when(c.rlike(f"[{ligatures}]"), spelled).otherwise(c)
    return F.regexp_replace(F.translate(c, _ONE, _BASE), r"\p{M}+", "")


def compare_key(c: Column | str) -> Column:
    """Form in which a chain's last name and the present name are compared."""
    c = one_space(F.lower(text_or_empty(c)))
    c = F.replace(replace(c, r"\s*-\s*", "-"), F.lit("ß"), F.lit("ss"))
    return replace(c, r"str\.?$", "strasse")


def address_key(c: Column | str) -> Column:
    """Form in which names are looked up in an address book."""
    return replace(F.lower(trim_u(text_or_empty(c))), r"str\.?$", "straße")


def field_type(c: Column | str, any_part: bool = True) -> Column:
    """A field name without its stage number; with ``any_part`` off only dates and names lose it."""
    return replace(c, r"^stadium_\d+_" if any_part else r"^stadium_\d+_(?=(?:datum|name)$)", "stadium_")


def field_rank(c: Column | str) -> Column:
    """Order of the fields of an entry: heads first, then stages by number, date, name, origin."""
    c = col(c)
    head = F.array_position(F.array(*map(F.lit, HEAD_FIELDS)), c)
    part = F.array_position(F.array(*map(F.lit, ("datum", "name", "urspruenglich"))), extract(c, P.STAGE_FIELD, 2))
    number = F.try_to_number(extract(c, P.STAGE_FIELD, 1), F.lit("999999")).cast("int")
    return F.struct((head == 0).cast("int").alias("stage"), F.when(head > 0, head.cast("int")).otherwise(F.coalesce(number, F.lit(0))).alias("n"), part.cast("int").alias("part"))


def prompt_hash(c: Column | str) -> Column:
    return F.substring(F.sha2(col(c), 256), 1, 12)


def cap_value(c: Column | str, most: int = 120) -> Column:
    """Longer values are running text, not a field's value, and only leave their length."""
    c = col(c)
    return F.when(F.length(c) > most, F.format_string("(Fließtext, %d Zeichen, verworfen)", F.length(c))).otherwise(c)


def reader_text(c: Column | str) -> Column:
    """A reader's value without soft hyphens and outer white space."""
    return trim_u(F.replace(text_or_empty(c), F.lit("\u00ad"), F.lit("")))


def reader_key(c: Column | str) -> Column:
    text = reader_text(c)
    return F.when(matches(text, r"^\d+$"), zero_filled(text)).otherwise(text)


def joined_list(c: Column | str) -> Column:
    """Items of an array as one text, blanks left out."""
    return F.array_join(F.filter(F.transform(col(c), reader_text), lambda x: x != ""), "; ")


#: Marks that :func:`captured` sets between groups and between matches; :func:`unmarked` texts have none.
_GROUP_MARK, _MATCH_MARK = "\x01", "\x02"


def unmarked(c: Column | str) -> Column:
    """A text, null as empty, with U+0001 and U+0002 as spaces; no place in it moves."""
    return F.translate(text_or_empty(c), _GROUP_MARK + _MATCH_MARK, "  ")


def captured(c: Column, pattern: str, groups: int) -> Column:
    """All matches of ``pattern`` in an unmarked text, found in one pass.

    Each is an array: the text between it and the match before, the match, and its groups, empty where unset.
    """
    marked = replace(c, pattern, "".join(f"{_GROUP_MARK}${n}" for n in range(groups + 1)) + _MATCH_MARK)
    matched = bound(F.split(marked, _MATCH_MARK, -1), lambda pieces: F.slice(pieces, F.lit(1), F.size(pieces) - 1))
    return F.transform(matched, lambda m: F.split(m, _GROUP_MARK, -1))


def fuzzy_unique(word: Column | str, vocabulary: list[str]) -> Column:
    """The one entry at edit distance exactly 1, whatever the case; null if none or several are."""
    word = F.lower(col(word))
    near = F.array_compact(F.array(*[F.when(F.levenshtein(word, F.lit(v.lower())) == 1, F.lit(v)) for v in vocabulary]))
    return F.when(F.size(near) == 1, F.element_at(near, 1))


def strip_edge(c: Column | str) -> Column:
    """Struct (value, hint): scan noise before a capital letter taken off."""
    c = col(c)
    new = replace(c, P.EDGE, "")
    return F.struct(new.alias("value"), F.when(new != c, F.lit(Reason.EDGE_REMOVED)).otherwise("").alias("hint"))


def normalize_suffix(c: Column | str) -> Column:
    """Struct (value, hint): a bracket at a name's end in its usual form; hint if it had to be closed."""
    c = col(c)
    words = F.create_map(*[F.lit(x) for pair in P.SUFFIX_WORDS.items() for x in pair])
    inside = extract(c, P.SUFFIX, 3)

    def word(w: Column) -> Column:
        return F.coalesce(F.try_element_at(words, w), F.try_element_at(words, replace(w, r"\.$", "")), w)

    content = F.array_join(F.transform(F.split(trim_u(inside), r"(?U)\s+"), word), " ")
    fits = matches(c, P.SUFFIX, "s") & (trim_u(inside) != "")
    value = F.when(fits, trim_u(F.concat(extract(c, P.SUFFIX, 1), F.lit(" ("), content, F.lit(")")))).otherwise(c)
    return F.struct(value.alias("value"), F.when(fits & (extract(c, P.SUFFIX, 4) == ""), F.lit(Reason.SUFFIX_CLOSED)).otherwise("").alias("hint"))


def split_suffix(c: Column | str) -> Column:
    """Struct (base, suffix): a bracket at a name's end taken off."""
    c = col(c)
    found = extract(c, f"({P.SUFFIX_AT_END})", 1)
    return F.struct(trim_u(replace(c, P.SUFFIX_AT_END, "")).alias("base"), trim_u(found).alias("suffix"))


def is_partial_suffix(c: Column | str) -> Column:
    """Whether a suffix says that only a part of a street had the name."""
    core = replace(replace(trim_u(c), r"^[(){}]+|[(){}]+$", ""), r"[.!\s]", "")
    return matches(core, P.PARTIAL, "i")


def parts(c: Column | str) -> Column:
    """Values of a list field; fragments of markers are no values."""
    split = F.transform(F.split(replace(c, r"\s+und\s+", ", "), ","), trim_u)
    return F.filter(split, lambda x: (x != "") & ~matches(x, P.MARK_FRAGMENT))


def clean_lines(c: Column | str, running_title: str = "") -> Column:
    """A page without running title, page number, section letters and margin noise."""
    c = col(c)
    if running_title:
        c = replace(c, rf"^\s*\Q{running_title}\E\s*$", "", "m")
    c = replace(replace(c, P.PAGE_NUMBER, "", "m"), P.SECTION_LETTER, "", "m")
    lines = F.split(c, "\n", -1)
    filled = F.filter(F.transform(lines, lambda x, i: F.when(trim_u(x) != "", i)), lambda i: i.isNotNull())
    ends = F.array_compact(F.array(F.try_element_at(filled, F.lit(1)), F.try_element_at(filled, F.lit(-1))))

    def cleaned(page: Column) -> Column:
        return F.array_join(F.transform(page["lines"], lambda x, i: F.when(F.array_contains(page["ends"], i) & matches(x, P.MARGIN_NOISE), "").otherwise(x)), "\n")

    return bound(F.struct(lines.alias("lines"), ends.alias("ends")), cleaned)


def join_lines(c: Column | str) -> Column:
    """A page's lines as one: markers and words that a line end split are whole again."""
    c = col(c)
    for pattern, new in P.JOINING:
        c = replace(c, pattern, new)
    for wrong, right in P.DOTTED_WORDS.items():
        c = replace(c, rf"\b{wrong}\b", right)
    return one_space(c)
