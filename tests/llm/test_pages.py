import gzip
import hashlib

import pytest

from snapwright.llm import html_text, warc

PAGES = [
    ("<html><body><nav><a href=x>Menu</a></nav><article><h1>Title</h1><p>Text &amp; more\n text.</p><p>Et.</p></article><footer>f</footer></body></html>", "Title Text & more text. Et."),
    ('<div id="wrap"><div class="sidebar"><p>side side side</p></div><div class="content"><p>Some words that are the content.</p><p>Et.</p></div><div class="comments"><p>I like it very very much indeed</p></div><form><p>Sign</p></form></div>', "Some words that are the content. Et."),
    ("<body><header><h1>Site</h1></header><div><h2>Heading</h2><p>Long text long text long text</p><p>Second paragraph here too</p></div><div class='cookie-notice'>We use cookies on this page</div></body>", "Heading Long text long text long text Second paragraph here too"),
    ("<article><p>Art<p>icle<section class='reader-comments'><article><p>A comment of some length</p></article></section></article>", "Art icle"),
    ("<nav><a href=x>never closed<article><p>Text</p></article>", "Text"),
    ("<p>a <b>bold</b> wo<i>r</i>d<br>next &lt;tag&gt; &#233;&nbsp;x", "a bold word next <tag> é x"),
    ("<script>var t='<p>no</p>'</script><style>p{}</style><p>yes</p>", "yes"),
    ("plain text", "plain text"), ("", ""), ("<p></p><!-- only -->", ""), ("<p>cut off <a href='x", "cut off"),
]


@pytest.mark.parametrize("html, text", PAGES)
def test_main_text(html, text):
    assert html_text.main_text(html) == text


def test_extract_takes_awkward_pages(spark):
    rows = [(1, "u", "<article><p>t</p></article>", 5), (1, "u", "<article><p>t</p></article>", 5), (None, None, None, 5), (2, None, "<div>" * 3000 + "deep", 5), (3, "u", "<p>" + "word " * 200_000, 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = sorted(html_text.extract(df).collect(), key=str)
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["text"][:4] for r in got} == {"t", "", "deep", "word"}
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def pages(spark):
    big, shared = "é" * 3_000_000, "s" * 200
    rows = [
        (0, "http://a/%41 b\r\nX: y", big), (1, None, shared), (2, "u", shared), (3, "u", shared), (3, "u", shared), (4, "u", "short"), (5, "u", "short"),
        (6, "u", None), (7, "u", ""), (None, "u", shared), (None, None, "n" * 150), (9, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"),
    ]
    return spark.createDataFrame([(*r, "x", 0) for r in rows], "page_id long, url string, html string, payload string, `first` int").coalesce(1)


def test_archive_round_trip(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/warc"
    files = warc.write_archives(warc.chunk_table(warc.typed_records(pages), chunk_bytes=100_000), folder, file_bytes=1000)
    assert files.count() > 1
    back = warc.read_archives(spark, folder, chunk_bytes=70_001)
    ends = back.filter("last").collect()
    source = pages.collect()
    first = {}
    for r in source:
        body = (r["html"] or "").encode()
        if r["page_id"] is not None and len(body) >= 100:
            first[body] = min(first.get(body, r["page_id"]), r["page_id"])
    want = []
    for r in source:
        body = (r["html"] or "").encode()
        to = first.get(body) if len(body) >= 100 and sum((o["html"] or "").encode() == body for o in source) > 1 else None
        to = None if to == r["page_id"] else to
        want.append((r["page_id"], r["url"], len(body), hashlib.sha256(body).hexdigest(), "response" if to is None else "revisit", to))
    got = [(r["page_id"], r["url"], r["bytes_so_far"], r["digest_so_far"], r["record_type"], r["refers_to"]) for r in ends]
    assert sorted(map(str, got)) == sorted(map(str, want))
    parts = sorted((r["chunk_no"], r["chunk"], r["digest_so_far"]) for r in back.filter("page_id = 0").collect())
    assert len(parts) == -(-6_000_000 // 70_001) and b"".join(c for _, c, _ in parts).decode() == "é" * 3_000_000
    running = hashlib.sha256()
    for _, chunk, digest in parts:
        running.update(chunk)
        assert digest == running.hexdigest()
    for path in (tmp_path / "warc").glob("*.warc.gz"):
        assert gzip.decompress(path.read_bytes()).startswith(b"WARC/1.1\r\n")


def test_archive_of_nothing(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/none"
    assert warc.archive(pages.limit(0), folder).count() == 0
    assert warc.read_archives(spark, folder).count() == 0


def test_damaged_archive_is_refused(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/bad"
    warc.archive(pages.filter("page_id = 4"), folder)
    path = next((tmp_path / "bad").glob("*.warc.gz"))
    path.write_bytes(gzip.compress(gzip.decompress(path.read_bytes()).replace(b"short", b"shirt")))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archives(spark, folder).collect()


ARTICLES = [
    # A linked heading, a reference list and a paragraph that is one link belong to the article.
    ("<article><h1><a href=a>Linked heading</a></h1><p>" + "Some words of the text. " * 5 + "</p><p><a href=b>All of this is a link</a></p><ul><li><a href=c>Reference one</a></li><li><a href=d>Reference two</a></li></ul></article>",
     "Linked heading " + "Some words of the text. " * 5 + "All of this is a link Reference one Reference two"),
    ("<nav><a href=x>Menu</a></nav><main><p><a href=a>All of the page is a link</a></p></main>", "All of the page is a link"),
    # The marked text lies outside the articles, which are cards of links.
    ("<div><h2>Heading</h2><p>" + "Some words of the text. " * 5 + "</p><p>Et.</p></div><article><a href=a>A card</a></article><article><a href=b>Other card</a></article>", "Heading " + "Some words of the text. " * 5 + "Et."),
    # A short article beside longer text is not lost to it.
    ("<article><h1>Title</h1><p>Short.</p></article><div><p>" + "Some words of the text. " * 9 + "</p></div>", "Title Short. " + "Some words of the text. " * 9),
]


@pytest.mark.parametrize("html, text", ARTICLES)
def test_clusters_choose_on_article_pages_and_links_stay(html, text):
    assert html_text.main_text(html) == text.strip()


LONG, MORE = ("Some words of the text. " * 8).strip(), ("Other words of another part. " * 9).strip()
LAID_OUT = [
    # An article laid out as rows: a heading of its own, a short section, a section of links.
    (f"<div id=top><div><h2>Heading</h2></div><div><p>{LONG}</p></div><section><p>Et.</p></section><div><a href=a>Reference</a></div><div><p>{MORE}</p></div></div><div class='cookie-notice'>We use cookies</div>", f"Heading {LONG} Et. Reference {MORE}"),
    (f"<table><tr><td>Heading</td></tr><tr><td>{LONG}</td></tr><tr><td>Et.</td></tr><tr><td>{MORE}</td></tr></table>", f"Heading {LONG} Et. {MORE}"),
    # The menu that no name tells bounds the region.
    (f"<div><ul><li><a href=a>Home page</a></li><li><a href=b>Contact us</a></li></ul><div><div><h2>Heading</h2></div><div><p>{LONG}</p></div></div></div>", f"Heading {LONG}"),
    # Words that name content win over those of what surrounds it; states are no names.
    *((f"<div {names}><p>{LONG}</p></div>", LONG) for names in ("class='content has-sidebar'", "id='main-content' class='no-comments'", "class='sidebar-right content-area'", "class='post comments-open'", "role=main class='sidebar-left'")),
    (f"<div><div class='post-header'><h1>Title</h1></div><p>{LONG}</p></div>", f"Title {LONG}"),
    # Comment areas and surrounding parts stay out, whatever else they are called.
    *((f"<div><div><p>{LONG}</p></div><div class='{name}'><p>{MORE}</p></div></div>", LONG) for name in ("comment-content", "content comments", "footer text-center", "main-nav", "sidebar-content")),
    # An article in a wrapper that is named as surrounding is the content; cards in a sidebar are not.
    (f"<div id='social-page'><article><h1>Title</h1><p>{LONG}</p></article></div><p>Et.</p>", f"Title {LONG}"),
    (f"<div><p>{LONG}</p></div><div class='related'><article><p>A card</p></article></div>", LONG),
    (f"<article><p>{LONG}</p></article><div id='comments'><article><p>{MORE} {MORE}</p></article></div>", LONG),
]


@pytest.mark.parametrize("html, text", LAID_OUT)
def test_region_is_whole_and_names_are_read_one_by_one(html, text):
    assert html_text.main_text(html) == text


PROSE = "".join(f"<p>Paragraph {i} has a good many words in it, as the main text of a page would have them.</p>" for i in range(5))
WANTED = " ".join(f"Paragraph {i} has a good many words in it, as the main text of a page would have them." for i in range(5))


@pytest.mark.parametrize(
    "body",
    [
        f"<div><ul><li><a href=/>Home</a><li><a href=/a>About us</a><li><a href=/c>Contact</a></ul>{PROSE}</div>",
        f"<div>{PROSE}</div><div id=right><p>Some sidebar text, quite long, so that it may be taken for content, alas.</p></div>",
        f"<div>{PROSE}<p>Copyright 2024 The Company. All rights reserved.</p></div>",
        f"<div>{PROSE}<div class=bottom>Imprint of this page</div></div>",
        f"<article>{PROSE}<div role=dialog>We use cookies, please accept them all.</div></article>",
        f"<article>{PROSE}<p>© 2024 Somebody</p></article>",
    ],
)
def test_what_stands_around_goes(body):
    assert html_text.main_text(f"<html><body>{body}</body></html>") == WANTED


def test_formulas_stay():
    assert html_text.main_text(f"<article>{PROSE}<p>The sum <math><mi>x</mi></math> is it.</p></article>").endswith("The sum x is it.")


@pytest.mark.parametrize("page", ["<p>t</p>" + "</i>" * 100_000, "<p>t</p>" + "<b>" * 20_000 + "</i>" * 20_000, "<i><div>" + "<b>" * 20_000 + "</i>" * 20_000 + "t", "<nav>" + "<article><p>t</p>" * 20_000])
def test_broken_markup_takes_linear_time(page):
    import time

    start = time.process_time()
    assert html_text.main_text(page)[0] == "t"
    assert time.process_time() - start < 3
