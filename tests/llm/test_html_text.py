from __future__ import annotations

import random
from collections import Counter
from html.parser import HTMLParser
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tastes.llm.common import Scratch
from tastes.llm.html_text import MIN_PAGES, _hash, blocks_of, deduce_templates, extract, main_text, region_of

PAGES = "page_id long, url string, html string"


def texts(spark, rows):
    df = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit(1) for c in ("host", "template", "t", "tag", "_host", "_token", "_vector", "_page", "_template", "token", "page", "vector")})
    found = extract(df.repartition(3)).collect()
    moved = extract(df.repartition(3), broadcast_tokens=-1).collect()
    assert len(found) == len(rows) and Counter(found) == Counter(moved)
    return {r.page_id: r.main_text for r in found}


ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head>
<body><header><a href="/">Home</a></header><nav><ul><li>One<li>Two</ul></nav><!-- ad --><div class="ad">Buy</div>
<aside>Side</aside><div class="cookie-notice">We use cookies</div>
<article><h1>Head {0}</h1><p><b>First&nbsp;line &amp; more<br><p>Second   line
 goes on</p><form><input><button>Send</button></form><ul><li>x<li>y</ul>
<section id="comments"><p>Nice!</p></section></article>
<footer>&copy; me</footer></body></html>"""


def test_article_page(spark):
    found = texts(spark, [(i, "http://h/", ARTICLE.format(i)) for i in range(5)])
    assert found[3] == "Head 3\nFirst line & more\nSecond line goes on\nx\ny"


def test_template_text_of_a_host_without_article(spark):
    page = "<html><body><div class=x1>Welcome to the site</div><div><p>Body {0}</p><p>Rest {0}</p></div><p>Made by us</p></body>"
    rows = [(i, "http://a/", page.format(i)) for i in range(6)] + [(9, "http://b/", page.format(9))]
    found = texts(spark, rows)
    assert found[2] == "Body 2\nRest 2"
    assert found[9] == "Welcome to the site\nBody 9\nRest 9\nMade by us"  # one page tells no template


def test_text_missing_from_two_copies_is_not_the_templates(spark):
    page = "<body><div><p>{0}</p><p>Often here</p></div></body>"
    rows = [(i, "http://a/", page.format(f"Body {i}")) for i in range(6)]
    rows += [(6 + i, "http://a/", page.format("Twice").replace("<p>Often here</p>", "<p>Other</p>")) for i in range(2)]
    found = texts(spark, rows)
    assert found[1] == "Body 1\nOften here" and found[7] == "Twice\nOther"


def test_copies_do_not_void_each_other(spark):
    page = "<body><article><p>The same</p></article></body>"
    other = "<body><div><p>Also the same</p></div></body>"
    rows = [(i, "http://h/", page) for i in range(5)] + [(10 + i, "http://g/", other) for i in range(5)]
    assert set(texts(spark, rows).values()) == {"The same", "Also the same"}


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>cut <b", "cut <b"), ("<p>a<script>x", "a"),
        ("<article><p>a&ampb &#65;&#x42;</article>", "a&b AB"), ("<p>a</div></p><p>b", "a\nb"), ("a < b", "a < b"),
        ("<main>m</main><p>o</p>", "m"), ("<div role=navigation>n</div>t", "t"), ("<p hidden>h</p>t", "t"),
        ("<article class=comment>c</article><article>a</article>", "a"), ("<!-- open", ""), ("<textarea>t", ""),
        ("<article><header><h1>H</h1></header>a</article>", "H\na"), ("<p>1<p>2<td>3<td>4", "1\n2\n3\n4"),
    ],
)
def test_markup(page, text):
    assert main_text(page, set()) == text


def test_edges(spark):
    rows = [(1, None, None), (2, None, ""), (3, "no url", "<p>x</p>"), (None, "http://h/", "<p>y</p>"),
            (3, "no url", "<p>x</p>"), (4, "http://h/", "<p>" + "word " * 200_000 + "</p>")]
    found = texts(spark, rows)
    assert found[1] == found[2] == "" and found[3] == "x" and found[None] == "y"
    assert len(found[4]) == 200_000 * 5 - 1
    assert texts(spark, [])  == {}


def test_text_repeated_inside_every_article_is_the_templates(spark):
    page = """<body><article><h1>Head {0}</h1><div class="zq"><p>Pass this on to all of your friends</p></div>
<p>{1}</p><p>{1} too</p><div class="zr">Made for you by the house with a long, long line of words</div></article></body>"""
    rows = [(i, "http://h/", page.format(i, f"Body {i} " * 5)) for i in range(6)]
    rows += [(10 + i, "http://g/", page.format(i, "The same body " * 5)) for i in range(6)]  # copies but for the head
    found = texts(spark, rows)
    body = ("Body 2 " * 5).strip()
    assert found[2] == f"Head 2\n{body}\n{body} too"
    assert "Pass this on" in found[12] and "The same body" in found[12]


def test_text_of_a_class_that_does_not_enclose_it_stays(spark):
    # The text comes where the other element does, but no element around it comes as often.
    note = "<p>A quoted line</p>"
    page = "<body><p>Body {0} a</p><p>Body {0} b</p>{1}</body>"
    rows = [(i, "http://h/", page.format(i, note + "<hr class=k>" if i < 4 else "")) for i in range(8)]
    assert texts(spark, rows)[1] == "Body 1 a\nBody 1 b\nA quoted line"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<p>a <a href="/hidden-valley">b</a> c</p>', "a b c"), ('<div title="The hidden door"><p>x</p></div>', "x"),
        ('<p>a <a href="/x?id=comment&n=2">b</a> <a href=/view?id=ad-12>c</a></p>', "a b c"), ("<p data-id=ad>x", "x"),
        ("<p HIDDEN>x</p>y", "y"), ('<p aria-hidden="true">x</p>y', "y"), ("<p title='a' class='ad'>x</p>y", "y"),
        ("<article><div class=menu>soup</div><div class='share notice'>s</div><p class=ad>a</article>", "soup"),
        ("<article><div role=search>s</div>t</article>", "t"), ("<div class=menu>m</div>t", "t"),
    ],
)
def test_attributes_are_names_with_whole_values(page, text):
    assert main_text(page, {}) == text


def test_stray_pages_and_second_layouts_do_not_void_a_template(spark):
    one = "<html><body><div class=x>Welcome to the site</div><div class=y><p>Body {0}</p><p>Rest {0}</p></div></body>"
    two = "<html><body><section><b>Our shop</b></section><ul><li>Thing {0}<li>Price {0}</ul></body>"
    rows = [(i, "http://h/", one.format(i)) for i in range(6)] + [(10 + i, "http://h/", two.format(i)) for i in range(4)]
    found = texts(spark, [*rows, (99, "http://h/", "<html><body>Not found")])
    assert found[2] == "Body 2\nRest 2" and found[12] == "Thing 2\nPrice 2" and found[99] == "Not found"


def test_more_text_beside_teasers_than_in_them():
    page = "<main><h1>Title</h1><p>Lead of the story</p><article>Related</article></main><p>Out</p>"
    assert main_text(page, {}) == "Title\nLead of the story\nRelated"
    page = "<main><p>By me</p><article><p>The whole story</p></article></main>"
    assert main_text(page, {}) == "The whole story"


def test_template_equals_brute_force(spark):
    """Occurrence vectors as whole vectors, supports as sets; text left out by the rules counts too."""
    rng = random.Random(5)
    frame = "<nav><a>Home</a><a>Shop</a></nav><div class=q><p>Written by us</p></div>"
    rows = []
    for i in range(60):
        some = "<div class=k><p>Seen on some pages</p></div>" if rng.random() < 0.5 else ""
        rare = "<div class=r><p>Seen on few pages</p></div>" if i % 25 == 0 else ""
        rows.append((i, f"http://h{i % 3}/", f"<body>{frame}{some}{rare}<div><p>Body {i}</p></div><footer>Us {i % 2}</footer>"))
    vectors, contents = {}, {}
    for i, url, page in rows:
        blocks, tags = blocks_of(page)
        kept = "\n".join(b[0] for b in blocks if not b[4])
        for key, n in Counter((b[1], b[0]) for b in blocks).items():
            vectors.setdefault((url[7:-1], key), {})[i] = n
            contents.setdefault((url[7:-1], key), set()).add(kept)
        for key, n in tags.items():
            vectors.setdefault((url[7:-1], key), {})[i] = n
            contents.setdefault((url[7:-1], key), set()).add(i)
    classes = {}
    for (host, key), v in vectors.items():
        if len(contents[host, key]) >= MIN_PAGES:
            classes.setdefault((host, tuple(sorted(v.items()))), []).append(key)
    want = {}
    for (host, _), keys in classes.items():
        if any(isinstance(k, str) for k in keys) and len(keys) >= 2:
            want.setdefault(host, set()).update(_hash(k) if isinstance(k, str) else _hash(*k) for k in keys)
    found = deduce_templates(spark.createDataFrame(rows, PAGES).repartition(4), Scratch(spark, "t")).collect()
    got = {}
    for r in found:
        got.setdefault(r.host, set()).add(r.token)
    assert got == want and len(want) == 3
    sizes = {(r.host, r.token): r.size for r in found if r.size is not None}
    kept = {}
    for _, url, page in rows:
        lengths = sum(len(b[0]) for b in blocks_of(page)[0] if not b[4])
        kept.setdefault(url[7:-1], []).append(lengths)
    assert all(sizes[h, _hash(">body")] == sum(v) / len(v) for h, v in kept.items())
    assert all(_hash(">body>nav", "Home Shop") in t or _hash(">body>nav", "HomeShop") in t for t in want.values())


LAYOUT = """<body><div class=l1><p>Links of {0}, of all days and of all houses</p></div>
<div class=box><div class=t>{1}</div><div class=x><p>{0} is news</p></div></div><div class=l2><p>Bye {0}</p></div></body>"""


def test_region_is_the_slot_with_the_hosts_text(spark):
    """No element is named or marked as content; text differs on every page."""
    rows = [(i, "http://h/", LAYOUT.format(i, f"<p>Story {i} goes on and on</p>" * 9)) for i in range(6)]
    rows.append((9, "http://h/", LAYOUT.format(9, "<p>A short story</p>")))  # the host's lengths decide, not its own
    rows.append((10, "http://h/", None))
    found = texts(spark, rows)
    assert found[2] == "\n".join(["Story 2 goes on and on"] * 9)
    assert found[9] == "A short story" and found[10] == ""


def test_region_keeps_its_headline(spark):
    rows = [(i, "http://h/", f"<body><div class=a><p>Menu {i}</p></div><div class=b><h1>Head {i}</h1><div class=c>"
             f"<p>{f'Story {i} is long. ' * 9}</p></div></div></body>") for i in range(6)]  # fmt: skip
    story = "Story 3 is long. " * 9
    assert texts(spark, rows)[3] == f"Head 3\n{story.strip()}"


def test_region_divides_no_article(spark):
    rows = [(i, "http://h/", f"<body><div class=a><p>Menu {i}</p></div><article><p>By {i}</p><div class=c>"
             f"<p>{f'Story {i} is long. ' * 9}</p></div></article></body>") for i in range(6)]  # fmt: skip
    story = "Story 3 is long. " * 9
    assert texts(spark, rows)[3] == f"By 3\n{story.strip()}"


class Articles(HTMLParser):
    """Blocks of the text in `article` elements, read by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.out, self.blocks, self.part = 0, 0, [], ""

    def end_block(self):
        text = " ".join(self.part.split())
        self.blocks += [text] if text else []
        self.part = ""

    def handle_starttag(self, tag, attrs):
        if tag not in ("a", "b", "i", "em", "strong", "span", "img"):
            self.end_block()
        self.depth += tag == "article"
        self.out += tag in ("script", "style", "nav", "form", "aside", "footer")

    def handle_endtag(self, tag):
        if tag not in ("a", "b", "i", "em", "strong", "span"):
            self.end_block()
        self.depth -= tag == "article"
        self.out -= tag in ("script", "style", "nav", "form", "aside", "footer")

    def handle_data(self, data):
        if self.depth > 0 and self.out <= 0:
            self.part += data


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not Path(SF).is_dir(), reason="test data not available")
def test_query_equals_another_reader(spark):
    """Every page of the given table, read without the operator's code."""
    import __spark_entry__ as entry

    want = {}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        reader = Articles()
        reader.feed(r.html or "")
        reader.close()
        reader.end_block()
        text = "\n".join(reader.blocks)
        want[r.page_id] = (r.url, text, len(text))
    found = entry.queries()["op2_html_extraction"](spark, SF).collect()
    assert {r.page_id: (r.url, r.text, r.n_chars) for r in found} == want and len(found) == len(want)


def test_region_follows_the_lengths_of_unnamed_slots():
    """The region is the element with over half of the text, else what holds them all."""
    rng = random.Random(11)
    for _ in range(50):
        lengths = [rng.randint(1, 99) for _ in range(4)]
        page = "<body>" + "".join(f"<div class={c}><p>x</p></div>" for c in "abcd") + "</body>"
        sizes = {_hash(f">body>div.{c}"): n for c, n in zip("abcd", lengths, strict=True)}
        sizes[_hash(">body")] = sum(lengths)
        blocks, tags = blocks_of(page)
        big = [c for c, n in zip("abcd", lengths, strict=True) if 2 * n > sum(lengths)]
        want = f">body>div.{big[0]}" if big else ">body"
        assert region_of(blocks, tags, {}, sizes) == want
