import random
import time
from html.parser import HTMLParser

from tidemill.llm.html import Page, extract, host_paths, op8_html_extraction


def text(page, path=None):
    return Page(page).text(path)[0].split("\n")


LONG = "words of the article " * 20


def test_text_next_to_the_heaviest_container_stays():
    for body in (f"<div class=body><p>{LONG}</p></div>", f"<ul><li>{LONG}</li></ul>", f"<blockquote>{LONG}</blockquote>", f"<table><tr><td>{LONG}</td></tr></table>", f"<section><div><p>{LONG}</p></div></section>"):
        for a, b in (("<article>", "</article>"), ("<main><div>", "</div></main>"), ("<div class=post>", "</div>"), ("", "")):
            for c, d in (("<html><body>", "</body></html>"), ("", "")):
                got = text(f"{c}<nav>menu</nav>{a}<h1>Title</h1><p class=lead>Lead</p>{body}<p>End</p>{b}{d}")
                assert got == ["Title", "Lead", LONG.strip(), "End"], (a, c, body)


def test_nested_sections_equal_brute_force():
    rnd = random.Random(3)
    for _ in range(200):
        want = []

        def part(depth):
            out = ""
            for _ in range(rnd.randint(1, 3)):
                if depth and rnd.random() < 0.5:
                    tag = rnd.choice(["section", "div", "blockquote"])
                    out += f"<{tag}>{part(depth - 1)}</{tag}>"
                else:
                    want.append(" ".join(["word"] * rnd.randint(1, 60)))
                    out += f"<p>{want[-1]}</p>"
            return out

        assert text(f"<body><nav>menu</nav><article>{part(3)}</article></body>") == want
    assert text(f"<p>{LONG}</p><p>short</p>") == [LONG.strip(), "short"]


def test_only_whole_classes_and_hidden_as_a_name_leave_out():
    for open_, close in (("<div class='content has-sidebar'>", "</div>"), ("<div class='no-comments'>", "</div>"), ("<section id=search>", "</section>"), ("<div class='entry-header'>", "</div>"), ("<div title='a hidden gem'>", "</div>"), ("<article data-title='The hidden one'>", "</article>"), ("<div class=widget>", "</div>")):
        assert text(f"<body>{open_}<h2 id='related-work'>Head</h2><p>{LONG}</p>{close}</body>") == ["Head", LONG.strip()], open_
    for open_ in ("<div class='box sidebar'>", "<div id=comments>", "<div hidden>", "<p hidden=''>", "<div class='site-footer'>"):
        assert text(f"<body><article><p>{LONG}</p>{open_}out</article></body>") == [LONG.strip()], open_


def test_values_hold_brackets_and_quotes():
    for inner, want in (
        ('<a title="x < y">hello</a>', "hello"),
        ("<a title='a > b' href=/x/>hello</a>", "hello"),
        ('<b data-t=it\'s>hello</b> <i class=a"b>you</i>', "hello you"),
        ('<a title="open>hello</a>', "hello"),
        ("<span data-x1='class=ad'>hello</span>", "hello"),
        ("1 < 2 <b>and</b> 3>2 &lt;p&gt; &amp; &#233;&nbsp;x", "1 < 2 and 3>2 <p> & é x"),
        ("a<br/>b <img alt='>'> c<!-- <p>no</p> -->d", "a b cd"),
    ):
        assert text(f"<body><nav>menu</nav><article><p>{LONG}</p><p>{inner}</p><div>tail</div></article><footer>f</footer>") == [LONG.strip(), want, "tail"], inner


def test_tags_that_never_end_are_read_once():
    began = time.time()
    for page in ('<a b="' * 200_000 + "x", "<a b='" * 100_000 + ">" * 3, "<p " * 300_000, "<" * 500_000, "<!--" * 200_000, "<script>" * 50_000, "</p>" * 200_000, "<div>" * 20_000 + LONG, '<a ="' * 100_000 + "<p>" * 9):
        Page(page).text(None)
    assert time.time() - began < 30


class Reader(HTMLParser):
    """A plain reading of pages with one article of headings and paragraphs."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        if tag in ("p", "h1", "li", "div", "article"):
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "article"
        if tag in ("p", "h1", "li", "div"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_query_equals_a_plain_reading(spark, sf):
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    want = {}
    for r in rows:
        x = Reader()
        x.feed(r.html or "")
        x.close()
        t = "\n".join(b for b in (" ".join(b.split()) for b in x.blocks) if b)
        want[r.page_id] = (r.url, t, len(t))
    assert {r.page_id: (r.url, r.text, r.n_chars) for r in op8_html_extraction(spark, sf).collect()} == want


def test_odd_rows(spark):
    page = f"<html><body><div class=menu>m</div><div class='post p12'><p>{LONG}</p></div></body></html>"
    rows = [(1, "http://a.example/1", page), (1, "http://a.example/1", page), (2, None, page), (None, "nonsense", page), (3, "http://a.example/3", None), (4, "http://a.example/4", ""), (5, "http://c.example/5", "no markup"), (6, "http://b.example/", "<p>" + "long " * 300_000), (7, "https://u@A.EXAMPLE:80/x", "<body><div class='post p7'><p>short</p></div><div class=x><p>" + LONG + "</p></div>")]
    df = spark.createDataFrame([(*r, "x", "y", 1, [0]) for r in rows], "page_id long, url string, html string, host string, path string, id int, u array<int>").repartition(3)
    for few in (0, 100):
        got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in extract(df, broadcast_hosts=few).collect()), key=str)
        want = [LONG.strip()] * 4 + ["", "", "no markup", ("long " * 300_000).strip(), "short"]  # the host's path counts
        assert got == sorted(((a, b, t, len(t)) for (a, b, _), t in zip(rows, want)), key=str)  # noqa: B905
    assert extract(df.limit(0)).count() == 0


def test_ties_go_to_the_path_that_sorts_first(spark):
    page = f"<body><div class=b><p>{LONG}</p></div><hr><div class=a><p>{LONG[:-1]}.</p></div></body>"
    assert Page(page).text(None)[1] == Page(page.replace("class=b", "class=c")).text(None)[1]
    got = host_paths(spark.createDataFrame([(1, "http://h.example/", page)], "page_id long, url string, html string")).first()
    assert got.path == min(Page(page).votes(), key=lambda x: (-x[1], x[0]))[0]
