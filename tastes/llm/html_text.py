"""Main text of web pages by template deduction over pages of one host.

A page is a sequence of tokens: a tag token is an element's path (names with
their class and id, digits levelled), a text token a block of text with the
path that holds it. A token's occurrence vector says how often it comes on
each page of the host; it is kept as a fingerprint (an XOR of hashed page
and count pairs), so that it is a partial aggregation however many pages a
host has. Tokens of a host with one vector form an equivalence class. A
class is valid by its support: `MIN_PAGES` different pages at least, whatever
the host's other pages hold, and two tokens, one of them a tag. A page's
template are the valid classes that occur on it, nested by their elements.

Two things follow. A text token is the template's own when it nests in a tag
token of its class, that is, when an element around it comes as often on every
page; such text goes. And the template's elements divide the page into slots:
the host's mean length of text in an element, less the template's own text
there, says which of them holds the content. From the root on the region goes down to the element of the template
with most text, as long as that element comes once on the page, holds more
than half of its parent's text and every headline of first order in it, and is
a container, not a paragraph, list or table; an article is never divided.

The template is deduced over all text, also what the rules below leave out.
Text in articles is deduced like any other, but over contents instead of
pages: the content beside a text is the longest block of the article's path
with most text, that text left out. Copies of an article, with another
headline or another frame, are one content and cannot void each other.

Element names, roles, classes and ids label slots: text in elements marked as
menu, header, footer, sidebar, notice, advert, form, script, style or comments
is no content and has no part in the lengths. What is left in the region is the
main text: in its `article` elements (unless the main element holds more text
outside of them, as where articles are only teasers), else in its main element,
else in all of it. Labels decide alone where a host has too few pages for a
template, or where the template would leave nothing.

Character references are decoded, white space in a block becomes one blank,
blocks are joined by a line feed. A line break element ends a block. Null
and empty pages, and pages without text, give an empty text. Rows without a
usable URL count as one host. Truncated and wrongly nested markup is read as
far as it goes.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastes.llm.common import Scratch, free_name

MIN_PAGES = 3
# Templates of at most this many tokens of 24 bytes, in all and for one host, go to
# the pages by broadcast, so that no page moves; others meet a page's own tokens.
BROADCAST_TOKENS = 1_000_000
HOST_TOKENS = 256

# Names of HTML elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt "
    "rp s samp small span strike strong sub sup time tt u var wbr img".split()
)
LEFT_OUT = set(
    "nav footer aside form script style noscript template iframe button select textarea option "
    "svg dialog menu object audio video canvas head title math".split()
)
# Words in class, id and role that mark what is not content.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments "
    "disqus replies respond cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe signup login share sharing social related recommended widget toolbar "
    "pagination pager copyright contentinfo complementary search alert alertdialog dialog".split()
)
# Marks that name real blocks too: inside an article one of them is not enough.
GENERIC = set(
    "alert banner copyright dialog login menu notice notices overlay promotion related search "
    "share sharing signup social subscribe toolbar widget".split()
)
CONTENT = {"main", "content", "post", "entry", "story", "article"}
# Elements that hold a text's parts, so that none of them is a region.
PARTS = set(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote figure figcaption address details summary "
    "table caption thead tbody tfoot tr td th hgroup header".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL,
)
# One attribute after the other from the tag's name on, with its whole value.
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORDS = re.compile(r"[a-z]+")

# (text, path, in an article, in a main element, left out by the tag rules)
Block = tuple[str, str, bool, bool, bool]


def _attributes(raw: str) -> tuple[str, set[str], set[str], bool]:
    """(label for the path, words of class and id, words of role, whether hidden)."""
    label, words, roles, hidden = "", set(), set(), False
    for name, value in _ATTRIBUTE.findall(raw) if raw.strip() else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role"):
            label += f".{value}"
            (roles if name == "role" else words).update(_WORDS.findall(value))
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "")
        elif name == "hidden":
            hidden |= value != "false"
        elif name == "aria-hidden":
            hidden |= value == "true"
    return re.sub(r"\d+", "0", label), words, roles, hidden


def _marked(words: set[str], roles: set[str], article: bool) -> bool:
    """Whether class, id and role mark what is not content."""
    marks = words & MARKS
    return bool(roles & MARKS) or bool(marks - GENERIC if article else marks) or len(marks) > 1


def blocks_of(page: str | None) -> tuple[list[Block], Counter]:
    """Blocks of text, and counts of element paths."""
    blocks: list[Block] = []
    tags: Counter = Counter()
    # Open elements: (name, path, left out, in an article, in a main element)
    stack: list[tuple[str, str, bool, bool, bool]] = [("", "", False, False, False)]
    # Text of the block at hand: what the rules keep, and what they leave out.
    held: tuple[list[str], list[str]] = ([], [])

    def flush() -> None:
        for out, parts in enumerate(held):
            text = " ".join(references.unescape("".join(parts)).split()) if parts else ""
            parts.clear()
            if text:
                _, path, _, article, main = stack[-1]
                blocks.append((text, path, article, main, bool(out)))

    at, end = 0, len(page or "")
    while at < end:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            held[stack[-1][2]].append(page[at:stop])
        if not m:
            break
        at = m.end()
        closing, name, raw = m.group(1), (m.group(2) or "").lower(), m.group(3)
        if not name:
            continue
        if name not in INLINE:
            flush()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name not in INLINE and stack[-1][0] == "p":
            stack.pop()
        if name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack[-1][0] == name:
            stack.pop()
        _, path, out, article, main = stack[-1]
        label, words, roles, hidden = _attributes(raw)
        if name not in INLINE:
            path = f"{path}>{name}{label}"
            tags[path] += 1
        if name in VOID or raw.endswith("/"):
            continue
        mark = _marked(words, roles, article) and name not in ("html", "body", "article", "main")
        words |= roles
        mark |= name == "article" and bool(words & {"comment", "comments", "related"})
        head = name == "header" or "header" in words
        out = out or name in LEFT_OUT or hidden or mark or (head and not article)
        article = article or name == "article"
        main = main or name == "main" or bool(words & CONTENT) and name not in ("html", "body")
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
            at = close.start() if close else end
            if not close:
                break
        stack.append((name, path, out, article, main))
    flush()
    return blocks, tags


def _hash(path: str, text: str | None = None) -> int:
    key = path if text is None else f"{path}\0{text}"
    return xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass")) - (1 << 63)


def _own(block: Block, template: dict[int, int]) -> bool:
    """Whether the block is the template's: nested in a tag token of its class."""
    text, path = block[:2]
    vector = template.get(_hash(path, text))
    while vector is not None and path:
        if template.get(_hash(path)) == vector:
            return True
        path = path[: path.rindex(">")]
    return False


def _around(path: str) -> Iterator[str]:
    """The element of a path and all elements around it, innermost first."""
    while path:
        yield path
        path = path[: path.rindex(">")]


def _name(path: str) -> str:
    return path[path.rindex(">") + 1 :].split(".", 1)[0]


def _sizes(blocks: list[Block]) -> Counter:
    """Length of the text that the labels keep, by element."""
    sizes: Counter = Counter()
    for text, path, _, _, out in blocks:
        if not out:
            for p in _around(path):
                sizes[p] += len(text)
    return sizes


def region_of(
    blocks: list[Block], tags: Counter, template: dict[int, int], sizes: dict[int, float]
) -> str:
    """Path of the template's element whose slots hold the content, "" for the page.

    `sizes` has the host's mean length of text in each element of the template.
    """
    fixed = _sizes([b for b in blocks if _own(b, template)])
    mean, heads = {}, []
    for path in dict.fromkeys(b[1] for b in blocks if not b[4]):
        around = list(_around(path))
        heads += [path] if any(_name(p) == "h1" for p in around) else []
        for p in around:
            if tags[p] == 1 and p not in mean and _name(p) not in PARTS:
                size = sizes.get(_hash(p))
                if size is not None:
                    mean[p] = size - fixed[p]
    region, held = "", 0.0
    while _name(region or ">") != "article":
        inside = [p for p in mean if p.startswith(f"{region}>")]
        # The nearest ones: no other element of the template lies between.
        near = [p for p in inside if not any(o in mean for o in _between(p, region))]
        best = min(near, key=lambda p: (-mean[p], p), default=None)
        if best is None or 2 * mean[best] <= held:
            break
        if any(h.startswith(f"{region}>") and not f"{h}>".startswith(f"{best}>") for h in heads):
            break
        region, held = best, mean[best]
    return region


def _between(path: str, region: str) -> list[str]:
    return [p for p in _around(path) if p != path and len(p) > len(region)]


def main_text(
    page: str | None, template: dict[int, int], sizes: dict[int, float] | None = None
) -> str:
    """The main text: the content's blocks that are not the template's own.

    `template` has the vectors of the host's template, by text and tag token,
    `sizes` the mean lengths of text in its elements.
    """
    found, tags = blocks_of(page)
    region = region_of(found, tags, template, sizes) if sizes else ""
    blocks = [b for b in found if not b[4] and f"{b[1]}>".startswith(f"{region}>")]
    article, main = (sum(len(b[0]) for b in blocks if b[k]) for k in (2, 3))
    beside = sum(len(b[0]) for b in blocks if b[3] and not b[2])
    area = 2 if article and article >= beside else 3
    if article or main:
        blocks = [b for b in blocks if b[area]]
    kept = [b for b in blocks if not _own(b, template)] if template else blocks
    return "\n".join(b[0] for b in kept or blocks)


def _contents(blocks: list[Block]) -> dict[tuple[str, str], int | None]:
    """By (path, text): a hash of the content beside it, none where it is alone."""
    beside = _hash("", "\n".join(b[0] for b in blocks if not b[4]))
    found: dict[tuple[str, str], int | None] = {
        (b[1], b[0]): beside for b in blocks if b[4] or not b[2]
    }
    paths: dict[str, Counter] = {}
    for text, path, article, _, out in blocks:
        if article and not out:
            paths.setdefault(path, Counter())[text] += 1
    # Per path: length of all texts, and its two longest texts.
    sizes = {p: sum(len(t) * n for t, n in c.items()) for p, c in paths.items()}
    longest = {p: sorted(c, key=lambda t: (-len(t), t))[:2] for p, c in paths.items()}
    order = sorted(sizes, key=lambda p: (-sizes[p], p))
    for path, texts in paths.items():
        other = next((p for p in order if p != path), None)
        for text, n in texts.items():
            rest = sizes[path] - len(text) * n
            if rest and (other is None or (-rest, path) < (-sizes[other], other)):
                content = next(t for t in longest[path] if t != text)
            else:
                content = longest[other][0] if other is not None else None
            found[path, text] = None if content is None else _hash("", content)
    return found


def host_of(url):
    """The host of a URL column, lower case, empty where there is none."""
    pattern = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
    return F.lower(F.coalesce(F.regexp_extract(url, pattern, 1), F.lit("")))


def _tokens():
    @F.pandas_udf("array<struct<token:long,tag:boolean,n:int,size:long,content:long>>")
    def run(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            out = []
            for page in batch:
                blocks, tags = blocks_of(page)
                texts = Counter((b[1], b[0]) for b in blocks)
                beside, sizes = _contents(blocks), _sizes(blocks)
                found = [
                    {"token": _hash(p), "tag": True, "n": n, "size": sizes[p], "content": None}
                    for p, n in tags.items()
                ]
                found += [
                    {"token": _hash(*t), "tag": False, "n": n, "size": None, "content": beside[t]}
                    for t, n in texts.items()
                ]
                out.append(found)
            yield pd.Series(out, dtype=object)

    return run


def _keys():
    """The different tokens of a page."""

    @F.pandas_udf("array<long>")
    def run(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            out = []
            for page in batch:
                blocks, tags = blocks_of(page)
                out.append(list({_hash(p) for p in tags} | {_hash(b[1], b[0]) for b in blocks}))
            yield pd.Series(out, dtype=object)

    return run


def deduce_templates(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, token, vector, size): a row for each token of a host's template.

    `vector` stands for the token's class; `size` is the mean length of kept text
    in a tag token's element over the different pages that have it, null for texts.
    """
    one = pages.where("html is not null").select(
        host_of(F.col("url")).alias("host"),
        F.xxhash64("html").alias("page"),
        F.explode(_tokens()("html")).alias("t"),
    )
    # The vector over pages; support counts different pages or contents, exactly:
    # rows of one of them are put together first.
    token = (
        one.select("host", "page", "t.*")
        .withColumn("content", F.when(F.col("tag"), F.col("page")).otherwise(F.col("content")))
        .groupBy("host", "token", "tag", "content")
        .agg(
            F.bit_xor(F.xxhash64("page", "n")).alias("vector"),
            F.count(F.lit(1)).alias("rows"),
            F.max("size").alias("size"),
        )
        .groupBy("host", "token", "tag")
        .agg(
            F.bit_xor("vector").alias("vector"),
            F.sum("rows").alias("rows"),
            F.count("content").alias("different"),
            F.avg("size").alias("size"),
        )
        .where(F.col("different") >= MIN_PAGES)
    )
    token = scratch.save(token, "tokens")
    # Copies cancel in the XOR, so the number of rows is part of the vector.
    keys = ["host", "vector", "rows"]
    valid = (
        token.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("members"), F.bool_or("tag").alias("tagged"))
        .where("tagged and members >= 2")
    )
    return scratch.save(
        token.join(valid.select(*keys), keys, "left_semi").select(
            "host", "token", F.xxhash64("vector", "rows").alias("vector"), "size"
        ),
        "templates",
    )


def page_templates(pages: DataFrame, templates: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, page, template): for each different page its tokens in its host's template.

    No row holds a host's template: a page's tokens meet it by (host, token), so an
    array has no more members than its own page has tokens.
    """
    tokens = pages.where("html is not null").select(
        host_of(F.col("url")).alias("host"),
        F.xxhash64("html").alias("page"),
        F.explode(_keys()("html")).alias("token"),
    )
    own = tokens.join(templates, ["host", "token"])
    return scratch.save(
        own.groupBy("host", "page").agg(F.collect_set(_member()).alias("template")), "pages"
    )


def _member():
    return F.struct("token", "vector", "size")


def extract(
    pages: DataFrame,
    scratch: Scratch | None = None,
    broadcast_tokens: int = BROADCAST_TOKENS,
    host_tokens: int = HOST_TOKENS,
) -> DataFrame:
    """`pages`, all columns, with `main_text`.

    A column of its own called `main_text` stays; the text is then `_main_text`.
    Templates of at most `broadcast_tokens` tokens, at most `host_tokens` a host, are
    broadcast; the texts do not depend on it.
    """
    scratch = scratch or Scratch(pages.sparkSession, "html")
    known = pages.select(
        F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    templates = deduce_templates(known, scratch)
    counts = templates.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    total, most = counts.agg(F.sum("n"), F.max("n")).first()

    @F.pandas_udf("string")
    def run(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.Series]:
        for columns in batches:
            out = []
            for html, token, vector, size in zip(*columns, strict=True):
                if token is None:
                    out.append(main_text(html, {}))
                    continue
                tokens = token.tolist()
                sizes = {t: s for t, s in zip(tokens, size.tolist(), strict=True) if s == s}
                out.append(main_text(html, dict(zip(tokens, vector.tolist(), strict=True)), sizes))
            yield pd.Series(out, dtype=object)

    names = pages.columns
    host, key, template = (free_name(n, names) for n in ("_host", "_page", "_template"))
    hosted = pages.withColumn(host, host_of(F.col("url")))
    if (total or 0) <= broadcast_tokens and (most or 0) <= host_tokens:
        named = templates.groupBy("host").agg(F.collect_list(_member()).alias("template"))
        joined = hosted.join(F.broadcast(named.toDF(host, template)), host, "left")
    else:
        # Both sides are bare scans, so that copies of one page can be split.
        named = page_templates(known, templates, scratch).toDF(host, key, template)
        keyed = hosted.withColumn(key, F.xxhash64(F.col("html").cast("string")))
        joined = keyed.join(named, [host, key], "left")
    parts = (F.col(f"{template}.{n}") for n in ("token", "vector", "size"))
    return joined.select(
        *(F.col(f"`{n}`") for n in names),
        run(F.col("html"), *parts).alias(free_name("main_text", names)),
    )
