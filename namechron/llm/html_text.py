"""Main text of web pages by text-to-tag ratios.

Events of the standard library's streaming parser build a line for each block and the tree that the
lines lie in. A line's ratio of characters to tags is smoothed by a Gaussian over its neighbours; a
threshold that splits the smoothed ratios into two clusters marks content lines. These lines decide
what is kept:

- Names that are typical of menus, notices and the like are a vote against an element, if they say
  nothing else (cookie-notice, comment-list). On a page
  whose articles have no text it fails if the element holds most of the content lines' text; votes
  by elements such as aside, and for readers' comments, fail only if next to no other text is left.
  A name never leaves out an article with content lines within it.
- Names that also hold other words (notice-board, comments-in-python, has-sidebar) only tip elements
  without any content line; where there is one, the ratios have decided.
- The content lines that are left choose the region: the articles or main parts that hold most of
  their text, else the deepest element of several lines that holds nearly all of it, with headings
  beside it. The whole region is the text.
- Lists of links between content lines go: neighbouring lines below the threshold that are links
  alone, unless a heading leads to them that isn't itself about menus, related pages and the like.

Markup that the page's end cuts off, such as an open comment, is no text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import map_batches

#: Fixed values of HTML: elements that stand alone, that begin a line, that hold no text of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
SILENT = frozenset("script style head title noscript template iframe object svg canvas math audio video map select textarea button dialog datalist".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: Fixed values of HTML: start tags that end an open element, which elements, and where the search for these stops.
IMPLIED_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: Votes: elements, roles and words of class or id that are typical of what isn't the article.
OUTSIDE = frozenset("nav footer aside menu".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs consent cookie cookies footer masthead menu modal nav navbar navigation "
    "newsletter notice pagination popup promo promoted related share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
READER_WORDS = frozenset("comment commentlist comments disqus replies reply respond".split())
#: Words that leave such a name's meaning as it is.
COMPANIONS = frozenset(
    "all area article articles bar block body bottom box button buttons by container content count entry feed field first form global group header icon icons inner item items label last layout left "
    "link links list main mini mobile module news outer overlay page panel pane post posts primary reader readers right row second secondary section side signup site slot small sticky story text thread "
    "title top unit user users view wrap wrapper".split()
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
REGIONS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NEVER_VOTED = HEADINGS | REGIONS | {"html", "body"}
_WORDS = re.compile(r"[a-z]+")
#: Lines on each side that the Gaussian reaches, and its width.
REACH, WIDTH = 2, 1.0
#: Share of the content lines' text that the region of a page without articles holds at least.
NEARLY_ALL = 0.95
#: Share of an element's text below which the text outside all voted elements counts as next to none.
LITTLE = 0.05
#: Strength of a vote: a name that says more; a name, role or form; an element of that meaning, or readers' comments.
HINT, WEAK, STRONG = 1, 2, 3


def vote(tag: str, attrs: list[tuple[str, str | None]], in_region: bool) -> int:
    """The strength of an element's vote to be left out, or 0."""
    if tag in OUTSIDE or tag == "header" and not in_region:
        return STRONG
    if tag in _NEVER_VOTED:
        return 0
    strength = 0
    for name, value in attrs:
        value = (value or "").lower()
        if name in ("class", "id"):
            strength = max([strength, *map(_name_vote, value.split())])
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in OUTSIDE_ROLES or name == "style" and _HIDDEN.search(value):
            strength = max(strength, WEAK)
    if tag == "form":
        strength = max(strength, WEAK)
    return 0 if strength == HINT and tag not in BLOCK else strength


def _name_vote(name: str) -> int:
    words = set(_WORDS.findall(name))
    outside, readers = words & OUTSIDE_WORDS, words & READER_WORDS
    if not outside and not readers:
        return 0
    if not words <= OUTSIDE_WORDS | READER_WORDS | COMPANIONS:
        return HINT
    return STRONG if readers else WEAK


@dataclass(slots=True)
class Line:
    text: str
    tags: int
    element: int
    #: Whether all its text stands in links.
    linked: bool


class LineParser(HTMLParser):
    """Turns events into lines and the tree of elements: parent, tag and vote of each, the page itself first."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parents, self.names, self.votes = [-1], [""], [0]
        self.open = [0]
        self.counts: Counter[str] = Counter()  # of open elements by name
        self.silent = self.links = self.regions = 0
        self.parts: list[str] = []
        self.tags, self.plain, self.ending = 0, False, False

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text or self.tags:
            self.lines.append(Line(text, self.tags, self.open[-1], not self.plain))
        self.parts, self.tags, self.plain = [], 0, False

    def _pop(self) -> str:
        element = self.open.pop()
        name = self.names[element]
        self.counts[name] -= 1
        self.silent -= name in SILENT
        self.links -= name == "a"
        self.regions -= name in REGIONS
        return name

    def _end_implied(self, tag: str) -> None:
        """End what the start of ``tag`` ends: a head, a paragraph, an element of the same list or table."""
        if self.counts["head"] and tag in BLOCK and tag not in IN_HEAD:
            while self._pop() != "head":
                pass
        ended, stops = IMPLIED_ENDS.get(tag, ((), ()))
        if any(self.counts[name] for name in ended):
            for n, element in enumerate(reversed(self.open)):
                name = self.names[element]
                if name in ended:
                    for _ in range(n + 1):
                        self._pop()
                if name in ended or name in stops:
                    break
        if self.counts["p"] and tag in BLOCK and tag not in VOID:
            for n, element in enumerate(reversed(self.open)):
                name = self.names[element]
                if name == "p":
                    for _ in range(n + 1):
                        self._pop()
                if name in BLOCK:
                    break

    def handle_starttag(self, tag, attrs):
        against = 0 if self.silent else vote(tag, attrs, self.regions > 0)
        if tag in BLOCK or against:
            self.flush()
        self._end_implied(tag)
        self.tags += 1
        if tag in VOID:
            return
        self.parents.append(self.open[-1])
        self.names.append(tag)
        self.votes.append(against)
        self.open.append(len(self.names) - 1)
        self.counts[tag] += 1
        self.silent += tag in SILENT
        self.links += tag == "a"
        self.regions += tag in REGIONS

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        if not self.counts[tag]:
            self.tags += 1
            return
        while True:
            if self.votes[self.open[-1]]:
                self.flush()
            if self._pop() == tag:
                break
        self.tags += 1

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)
            if not self.links and not data.isspace():
                self.plain = True

    def finish(self) -> list[Line]:
        self.ending = True
        self.close()
        self.flush()
        return self.lines

    def _cut_off(self, end: int) -> int:
        """``end`` of a piece of markup; what the page's end cuts off reaches up to it."""
        return len(self.rawdata) if end < 0 and self.ending else end

    def parse_comment(self, i, report=1):
        return self._cut_off(super().parse_comment(i, report))

    def parse_starttag(self, i):
        return self._cut_off(super().parse_starttag(i))

    def parse_endtag(self, i):
        return self._cut_off(super().parse_endtag(i))

    def parse_html_declaration(self, i):
        return self._cut_off(super().parse_html_declaration(i))

    def parse_pi(self, i):
        return self._cut_off(super().parse_pi(i))


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """``ratios`` under a Gaussian that is cut and scaled anew at both ends."""
    kernel = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / WIDTH) ** 2)
    full = np.convolve(ratios, kernel)[REACH : REACH + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), kernel)[REACH : REACH + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """The cut between two clusters of values: half-way between their means, moved until it rests."""
    cut = float(values.mean())
    for _ in range(50):
        low, high = values[values <= cut], values[values > cut]
        if not len(low) or not len(high):
            return cut
        new = (float(low.mean()) + float(high.mean())) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def content_lines(lines: list[Line]) -> list[bool]:
    """For each line whether it has text and its smoothed ratio lies in the upper cluster."""
    smooth = smoothed(np.array([len(line.text) / max(1, line.tags) for line in lines]))
    cut = threshold(smooth)
    found = [v >= cut and bool(line.text) for v, line in zip(smooth.tolist(), lines, strict=True)]
    return found if any(found) else [bool(line.text) for line in lines]


class _Tree:
    """Sums over the subtrees of a page; an element's parent always comes before it."""

    def __init__(self, parser: LineParser):
        self.parents, self.names, self.votes = parser.parents, parser.names, parser.votes

    def sums(self, lines: list[Line], wanted: list[bool]) -> list[int]:
        """Characters of the wanted lines within each element."""
        total = [0] * len(self.parents)
        for line, yes in zip(lines, wanted, strict=True):
            if yes:
                total[line.element] += len(line.text)
        for e in range(len(total) - 1, 0, -1):
            total[self.parents[e]] += total[e]
        return total

    def below(self, chosen: set[int]) -> list[bool]:
        """Whether each element is chosen or lies within a chosen one."""
        out = [e in chosen for e in range(len(self.parents))]
        for e in range(1, len(out)):
            out[e] = out[e] or out[self.parents[e]]
        return out

    def regions(self, total: list[int]) -> set[int]:
        """Articles and main parts with text, the outermost ones."""
        found = {e for e, name in enumerate(self.names) if name in REGIONS and total[e]}
        inside = self.below(found)
        return {e for e in found if not inside[self.parents[e]]}

    def container(self, element: int, lines: list[Line]) -> int:
        """``element``, or the first one around it that has several lines and no more than headings beside it."""
        total, headings = [0] * len(self.parents), [0] * len(self.parents)
        inside = self.below({e for e, name in enumerate(self.names) if name in HEADINGS})
        for line in lines:
            total[line.element] += bool(line.text)
            headings[line.element] += bool(line.text) and inside[line.element]
        for e in range(len(total) - 1, 0, -1):
            total[self.parents[e]] += total[e]
            headings[self.parents[e]] += headings[e]
        while element and (total[element] < 2 or total[self.parents[element]] - total[element] == headings[self.parents[element]] - headings[element]):
            element = self.parents[element]
        return element

    def left_out(self, lines: list[Line], content: list[bool]) -> list[bool]:
        """Whether the votes leave an element out."""
        total = self.sums(lines, content)
        text = self.sums(lines, [True] * len(lines))
        voted = self.below({e for e, v in enumerate(self.votes) if v > HINT})
        unvoted = sum(len(line.text) for line in lines if not voted[line.element])
        region = any(self.names[e] in REGIONS and text[e] and not voted[e] for e in range(len(text)))
        holds_region = [name in REGIONS and n > 0 for name, n in zip(self.names, total, strict=True)]
        for e in range(len(total) - 1, 0, -1):
            holds_region[self.parents[e]] |= holds_region[e]
        chosen = set()
        for e, strength in enumerate(self.votes):
            most = 2 * total[e] > total[0] and not region
            fails = strength == HINT and total[e] or strength == WEAK and (holds_region[e] or most) or most and unvoted < LITTLE * text[e]
            if strength and not fails:
                chosen.add(e)
        return self.below(chosen)


def extract(html: str | None) -> str:
    """Main text of one page; empty for null or empty html, or where no text is left."""
    if not html:
        return ""
    parser = LineParser()
    parser.feed(html)
    lines = parser.finish()
    if not any(line.text for line in lines):
        return ""
    tree = _Tree(parser)
    out = tree.left_out(lines, content_lines(lines))
    lines = [line for line in lines if not out[line.element]]
    if not any(line.text for line in lines):
        return ""
    content = content_lines(lines)
    total = tree.sums(lines, content)
    chosen = tree.regions(total)
    if 2 * sum(total[e] for e in chosen) < total[0]:
        chosen = {tree.container(max(e for e, n in enumerate(total) if n >= NEARLY_ALL * total[0]), lines)}
    inside = tree.below(chosen)
    headed = tree.below({e for e, name in enumerate(tree.names) if name in HEADINGS})
    kept = [(line.text, line.linked and not yes, headed[line.element]) for line, yes in zip(lines, content, strict=True) if line.text and inside[line.element]]
    out_texts, i = [], 0
    while i < len(kept):
        end = i
        while end < len(kept) and kept[end][1] and not kept[end][2]:
            end += 1
        led = i > 0 and kept[i - 1][2] and OUTSIDE_WORDS.isdisjoint(_WORDS.findall(kept[i - 1][0].lower()))
        if end - i > 1 and not led:
            i = end  # a list of links
            continue
        out_texts += [text for text, _, _ in kept[i : max(end, i + 1)]]
        i = max(end, i + 1)
    return " ".join(out_texts)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of the main text of every page.

    Null or empty html gives an empty text. Repeated rows give repeated results; nulls in page_id
    and url stay; other columns are ignored. The whole html is parsed, whatever its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return map_batches(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")
