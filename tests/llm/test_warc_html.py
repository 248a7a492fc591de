"""Archives by round trip and damage; main text of pages."""

import gzip
import io
import random

import pytest

from namechron.llm import html_text, warc

PAGES = [(3, "u3", "same"), (1, "u1", "same"), (2, "u2", None), (5, None, ""), (4, "u4\r\nX: y", "ü" * 100_000), (None, "n", "same"), (7, "u7", "same"), (7, "u7", "same"), (8, "u8", "other")]


def _pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "junk") for r in rows], "page_id long, url string, html string, refers_to string")


def test_round_trip(spark):
    rows = warc.archive_round_trip(spark, _pages(spark)).collect()
    found = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in rows)
    same, empty = warc.digest(b"same"), warc.digest(b"")
    assert found == [
        (0, "response", None, 4, same), (1, "response", None, 4, same), (2, "response", None, 0, empty), (3, "revisit", 1, 4, same), (4, "response", None, 200_000, warc.digest("ü".encode() * 100_000)),
        (5, "revisit", 2, 0, empty), (7, "revisit", 1, 4, same), (7, "revisit", 1, 4, same), (8, "response", None, 5, warc.digest(b"other")),
    ]
    assert {r["page_id"]: bytes(r["payload"]) for r in rows if r["payload"]}[4] == "ü".encode() * 100_000


def test_small_payloads_stay_responses(spark):
    rows = warc.archive_round_trip(spark, _pages(spark), least_bytes=5).collect()
    assert {r["record_type"] for r in rows} == {"response"}
    assert warc.archive_round_trip(spark, _pages(spark).limit(0)).count() == 0


def test_record_ids_are_unique(spark, tmp_path):
    pages = spark.createDataFrame([(7, "u", "same", None)] * 5 + [(None, None, "x", None)] * 3, "page_id long, url string, html string, refers_to long").repartition(2)
    ids = []
    for f in warc.write_archives(pages, f"file://{tmp_path}").collect():
        with open(f["path"].removeprefix("file://"), "rb") as stream:
            ids += [r["fields"]["warc-record-id"] for r in warc.read_records(stream)]
    assert len(ids) == len(set(ids)) == 8


def test_each_record_is_a_member_and_damage_is_found():
    data = warc.record(1, "u", b"x" * 1000, None) + warc.record(2, "u", b"x" * 1000, 1)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 2
    assert [r["payload_bytes"] for r in warc.read_records(io.BytesIO(data))] == [1000, 1000]
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(data[:-20])))
    plain = gzip.decompress(warc.record(1, "u", b"x" * 1000, None))
    for wrong in (plain.replace(b"xxx", b"xyx", 1), plain + b"z", plain[:-8]):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(gzip.compress(wrong))))


def test_archives_roll_over(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i}", None) for i in range(50)], "page_id long, url string, html string, refers_to long").coalesce(1)
    files = warc.write_archives(pages, f"file://{tmp_path}", file_bytes=2000).cache()
    assert files.count() > 3 and sum(r["records"] for r in files.collect()) == 50
    assert sorted(r["page_id"] for r in warc.read_archives(files).collect()) == list(range(50))


ARTICLE = "A long first paragraph of the article with many words in it, so that it counts."
PAGE = f"""<!DOCTYPE html><html><head><title>Site</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header><a href=/>Logo</a></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- x --><div class="ad">Buy this now or never and pay later.</div>
<article><h1>Head &amp; tail</h1><p>{ARTICLE}<br>Second&nbsp;line <b>bo</b>ld.<p>Short.</p><div class="comments"><p>I disagree with all of this, says a reader.</p></div></article>
<aside>More</aside><form><p>Your name</p></form><div id="cookie-notice">We use cookies to track you.</div><footer>&copy; all</footer></body></html>"""


def test_article_alone():
    assert html_text.extract(PAGE) == f"Head & tail {ARTICLE} Second line bold. Short."
    assert html_text.extract(PAGE[: PAGE.index("Short")]) == f"Head & tail {ARTICLE} Second line bold."


def test_page_without_article():
    body = f"<body><ul><li><a href=a>A</a></li><li><a href=b>B</a></li><li><a href=b>B</a></li></ul><div><p>{ARTICLE}</p><p>{ARTICLE}</p></div><ul><li><a href=a>A</a></li><li><a href=a>A</a></li></ul>"
    assert html_text.extract(body) == f"{ARTICLE} {ARTICLE}"


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain <b text"), (4, "u", "<p>x" * 3000), (4, "u", "<p>x" * 3000), (None, "u", "</div></p><p>y")]
    got = html_text.extract_pages(_pages(spark, rows)).collect()
    assert len(got) == 6 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] in (1, 2)] == ["", ""]
    assert {r["n_chars"] for r in got if r["page_id"] == 4} == {5999}


def test_a_payload_that_most_pages_share(spark):
    rows = [(i, "u", None if i % 3 else f"page {i % 9}") for i in range(3000)] + [(0, "u", "page 0")] * 2000 + [(None, "u", "")] * 1000
    got = warc.archive_round_trip(spark, _pages(spark, rows)).collect()
    assert len(got) == len(rows)
    first = {None: 1, "page 0": 0, "page 3": 3, "page 6": 6, "": 1}
    want = sorted(((i, None if i is None or i == first[html] else first[html]) for i, _, html in rows), key=repr)
    assert sorted(((r["page_id"], r["refers_to"]) for r in got), key=repr) == want


LINKS = "<ul><li><a href=a>A link<li><a href=b>Another link<li><a href=c>The third link</ul>"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f'<div class="layout has-sidebar"><article><h1>Head</h1><p>{ARTICLE}</p></article><div class="sidebar">{LINKS}</div></div>', f"Head {ARTICLE}"),
        (f'<header>Site</header><div class="market-share-report"><p>{ARTICLE}</p><p>{ARTICLE}</p></div>', f"{ARTICLE} {ARTICLE}"),
        (f'<article><p class="ad">Buy now<p>{ARTICLE}<p>More', f"{ARTICLE} More"),
        (f'<body><form id="aspnetForm"><nav>{LINKS}</nav><p>{ARTICLE}</p><p>End.</p></form></body>', f"{ARTICLE} End."),
        (f"<div><p>{ARTICLE}</p><p>{ARTICLE}</p></div><main><p>Tiny</p></main>", f"{ARTICLE} {ARTICLE}"),
        (f"<body>{LINKS}<div><p>First.</p><p>{ARTICLE}</p><p>{ARTICLE}</p><p>Last.</p></div>{LINKS}", f"First. {ARTICLE} {ARTICLE} Last."),
        (f'<article><p>{ARTICLE}</p><h2 id="related-work">Related work</h2><p>{ARTICLE}</p></article>', f"{ARTICLE} Related work {ARTICLE}"),
        (f"<article><p>{ARTICLE}</p>{LINKS}<p>{ARTICLE} See <a href=x>this</a>.</p><p><a href=y>One link alone</a></p><p>{ARTICLE}</p></article>", f"{ARTICLE} {ARTICLE} See this. One link alone {ARTICLE}"),
        (f'<p>{ARTICLE}</p><section class="comments">' + f"<p>{ARTICLE} says a reader.</p>" * 9 + "</section>", ARTICLE),
        (f"<html><head><title>T</title><meta x><body><table><tr><td>{ARTICLE}<td>Cell<tr><td>{ARTICLE}</table>", f"{ARTICLE} Cell {ARTICLE}"),
        ("<article><p>One.</p></article><nav>Home</nav>", "One."),
        (f"<article><h1>Short.</h1></article><footer>{ARTICLE}</footer>", "Short."),
        (f"<div><h1>Head</h1><div><p>{ARTICLE}</p><p>{ARTICLE}</p></div></div>", f"Head {ARTICLE} {ARTICLE}"),
        (f"<aside><p>{ARTICLE}</p></aside>", ARTICLE),
        (f'<article><p>{ARTICLE}</p><section id="related-work"><h2>Related work</h2><p>{ARTICLE}</p></section></article>', f"{ARTICLE} Related work {ARTICLE}"),
        (f'<article><p>{ARTICLE}</p><div class="notice-board"><p>{ARTICLE}</p></div></article>', f"{ARTICLE} {ARTICLE}"),
        (f'<article><p>{ARTICLE}</p><section id="comments-in-python"><p>{ARTICLE}</p></section></article>', f"{ARTICLE} {ARTICLE}"),
        (f"<article><p>{ARTICLE}</p><h2>References</h2><ul><li><a href=a>Smith 2001</a><li><a href=b>Jones 1999</a></ul></article>", f"{ARTICLE} References Smith 2001 Jones 1999"),
        (f"<article><p>{ARTICLE}</p><h3>Related articles</h3>{LINKS}</article>", f"{ARTICLE} Related articles"),
        (f'<article><p>{ARTICLE}</p><div id="respond-list"><p>Bob: first!</p></div></article>', ARTICLE),
        (f'<article><p>{ARTICLE}</p><p style="color: red; display:none">Not to be seen</p></article>', ARTICLE),
        (f'<article><p>{ARTICLE}</p><ul class="share-this-now"><li><a href=a>x</a><li><a href=b>y</a></ul></article>', ARTICLE),
        (f"<article><p>{ARTICLE}<!-- oops <p>{ARTICLE}", ARTICLE),
        (f"<article><p>{ARTICLE} 1 < 2 <a href='x", f"{ARTICLE} 1 < 2"),
        (f"<article><p>{ARTICLE}</p><script>var a = '<!--';</script><p>End.</p></article>", f"{ARTICLE} End."),
        ("<div>" * 20_000 + ARTICLE, ARTICLE),
    ],
)
def test_ratios_decide(html, text):
    assert html_text.extract(html) == text


def test_generated_pages():
    random.seed(12)
    for _ in range(150):
        own = [" ".join(random.choices(["word", "of", "the", "article"], k=random.choice([1, 3, 20, 60, 120]))) + str(i) for i in range(random.randrange(2, 12))]
        own.insert(random.randrange(len(own) + 1), ARTICLE * 3)
        body = "".join(random.choice(["<p>{}</p>", "<p>{}", "<div>{}</div>", "<h2>{}</h2>", "<ul><li>{}</ul>"]).format(t) for t in own)
        marked = random.choice(["<article>{}</article>", "<main>{}</main>", "<div id=content>{}</div>", '<div class="page"><div class="body-text">{}</div></div>'])
        noise = [f"<nav>{LINKS}</nav>", '<div class="cookie-notice">We use cookies, as all do. Accept them all.</div>', f"<aside><p>{ARTICLE}</p></aside>", "<footer><p>All rights reserved by us.</p></footer>", f'<div id="comments"><p>{ARTICLE}</p></div>', "<form><p>Your name</p><input></form>", "<script>var a = '<p>';</script>"]
        random.shuffle(noise)
        at = random.randrange(len(noise))
        page = "<html><head><title>T</title></head><body>" + "".join(noise[:at]) + marked.format(body) + "".join(noise[at:]) + "</body></html>"
        assert html_text.extract(page) == " ".join(own)


def test_a_very_long_page_and_an_empty_table(spark):
    long = "<article>" + f"<p>{ARTICLE}</p>" * 30_000 + "</article>"
    got = html_text.extract_pages(_pages(spark, [(1, "u", long), (1, "u", long)])).collect()
    assert [r["n_chars"] for r in got] == [len(ARTICLE) * 30_000 + 29_999] * 2
    assert html_text.extract_pages(_pages(spark).limit(0)).count() == 0
