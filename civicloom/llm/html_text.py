"""Main text of web pages, with each site's template removed.

Every element outside a page's paragraphs is hashed with its whole subtree. Spark counts
on how many different pages of a host each subtree is found; those on many of them are its
template and are deleted, together with what its tag or names mark as no article: menus,
adverts, notices, forms and so on. How many pages are many grows with the square root of
the host, so that the sidebars of one section among many are found on a large host as
well. The subtrees of each page are joined to the counts, so a page carries only the
templates it holds. A page counts by its article, so copies of a page don't make its text a template. Where a page marks its
article, that is kept, and its paragraphs, headings and lists are never a template.

Defined results. Null or empty html is an empty text. A page whose address has no host
has no template. Rows that repeat are each returned. An unclosed element ends where its
parent does; an unfinished tag or comment ends with the page. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from civicloom.llm.markup import BLOCKS, RAW, Element, parse
from civicloom.session import stage_table

#: A template subtree is on so many different pages of its host, and on this share of them or so many times their square root.
MIN_PAGES, MIN_SHARE, MIN_ROOTS = 5, 0.3, 2.0
DROP_TAGS = RAW | frozenset(
    "head nav footer aside form button input select datalist option label svg math canvas object embed audio video "
    "dialog menu map".split()
)
#: Words of class, id or role that mark what is no article.
DROP_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe signup login search searchbox sidebar aside "
    "complementary menu nav navbar navigation breadcrumb breadcrumbs footer contentinfo comment comments disqus respond "
    "replies share sharing social related recommended widget widgets pagination pager toolbar skip dialog form".split()
)
COMMENTS = frozenset("comment comments reply replies".split())
#: Text that recurs in these inside an article is the article's own.
OWN = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody thead tr td th figure figcaption".split())
FRAME = frozenset(("html", "body", "main"))
_WORD = re.compile(r"[a-z0-9]+")


def _marked(element: Element, outside: bool) -> bool:
    """No article, by its tag or names."""
    if element.tag in DROP_TAGS or outside and element.tag == "header":
        return True
    if not element.names or element.tag in FRAME:
        return False
    if re.search(r"(?:^| )hidden=|aria-hidden=true", element.names):
        return True
    words = set(_WORD.findall(re.sub(r"(?:^| )[a-z-]+=", " ", element.names)))
    if element.tag == "article":
        return not words.isdisjoint(COMMENTS)
    return not words.isdisjoint(DROP_NAMES) or outside and not words.isdisjoint({"header", "masthead"})


def _unmarked(elements: list[Element]) -> list[bool]:
    """Whether neither the element nor one it is in is marked."""
    stays: list[bool] = []
    for e in elements:
        stays.append((e.parent < 0 or stays[e.parent]) and not _marked(e, False))
    return stays


def _roots(elements: list[Element]) -> set[int]:
    """The outermost articles, else the main part, else nothing."""
    stays = _unmarked(elements)
    for wanted in (lambda e: e.tag == "article", lambda e: e.tag == "main" or "role=main" in e.names):
        found = {i for i, e in enumerate(elements) if stays[i] and wanted(e)}
        inner = {i for i in found if _within(elements, i, found)}
        if found:
            return found - inner
    return set()


def _within(elements: list[Element], i: int, others: set[int]) -> bool:
    up = elements[i].parent
    while up >= 0:
        if up in others:
            return True
        up = elements[up].parent
    return False


def _in_roots(elements: list[Element], roots: set[int]) -> list[bool]:
    inside: list[bool] = []
    for i, e in enumerate(elements):
        inside.append(i in roots or e.parent >= 0 and inside[e.parent])
    return inside


def _may_recur(element: Element, i: int, inside: bool, roots: set[int]) -> bool:
    if element.tag not in BLOCKS or element.tag in FRAME or element.tag == "head" or i in roots:
        return False
    return not inside or element.tag not in OWN


def subtrees(page: str) -> tuple[int, list[int]]:
    """What the page counts as, and the hashes of its subtrees that may be a template."""
    tokens, elements = parse(page)
    roots = _roots(elements)
    inside = _in_roots(elements, roots)
    found = {e.digest for i, e in enumerate(elements) if _may_recur(e, i, inside[i], roots)}
    own = "".join(str(elements[i].digest) for i in sorted(roots)) or page
    return _signed(xxhash.xxh64_intdigest(own.encode(errors="replace"))), [_signed(h) for h in found]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def main_text(page: str, templates: frozenset[int] = frozenset()) -> str:
    """The page's blocks of article text, without subtrees whose hashes are in ``templates``."""
    tokens, elements = parse(page)
    roots = _roots(elements)
    inside = _in_roots(elements, roots)
    blocks: list[str] = []
    line: list[str] = []
    i = 0
    keep_until = len(tokens) if not roots else -1
    while i < len(tokens):
        token = tokens[i]
        i += 1
        if isinstance(token, int):
            e = elements[token]
            if token in roots:
                keep_until = e.end
            template = _signed(e.digest) in templates and _may_recur(e, token, inside[token], roots)
            if template or _marked(e, not roots):
                i = max(e.end, i)
                token = None if e.tag in BLOCKS else ""
        if token is None:
            blocks.append(" ".join("".join(line).split()))
            line = []
        elif isinstance(token, str) and i <= keep_until:
            line.append(token)
    blocks.append(" ".join("".join(line).split()))
    return "\n".join(filter(None, blocks))


def _hosted(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, host, k1, k2``; the keys stand for a host's page as it is written."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    return rows.withColumns({"k1": F.xxhash64("host", "html"), "k2": F.xxhash64(F.lit(1), "html", "host")})


def page_subtrees(hosted: DataFrame) -> DataFrame:
    """``host, k1, k2, page, subtree``: the subtrees of each page that may be a template, and a null one for the page itself.

    ``page`` is what the page counts as.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, k1, k2, html in zip(*(c.to_pylist() for c in batch.columns)):
                page, hashes = subtrees(html)
                rows += [(host, k1, k2, page, h) for h in [None, *hashes]]
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "k1", "k2", "page", "subtree"])

    rows = hosted.filter("host <> ''").select("host", "k1", "k2", "html")
    return rows.mapInArrow(run, "host string, k1 bigint, k2 bigint, page bigint, subtree bigint")


def site_templates(
    found: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, min_roots: float = MIN_ROOTS
) -> DataFrame:
    """``host, subtree``: the subtrees found on many different pages of their host."""
    # The null subtree stands for the page itself, so its count is the host's number of pages.
    counts = found.select("host", "page", "subtree").distinct().groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n"))
    counts = stage_table(counts.filter(F.col("subtree").isNull() | (F.col("n") >= min_pages)), "subtree_counts")
    sizes = counts.filter("subtree IS NULL").select("host", F.col("n").alias("pages"))
    many = F.least(min_share * F.col("pages"), min_roots * F.sqrt("pages"))
    return counts.filter("subtree IS NOT NULL").join(sizes, "host").filter(F.col("n") >= many).select("host", "subtree")


def page_templates(
    hosted: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, min_roots: float = MIN_ROOTS
) -> DataFrame:
    """``k1, k2, templates``: the templates that each page holds, at most as many as it has elements."""
    found = stage_table(page_subtrees(hosted), "page_subtrees")
    templates = stage_table(site_templates(found, min_pages, min_share, min_roots), "site_templates")
    held = found.filter("subtree IS NOT NULL").join(templates, ["host", "subtree"], "left_semi")
    return stage_table(held.groupBy("k1", "k2").agg(F.collect_set("subtree").alias("templates")), "page_templates")


def extract(
    pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, min_roots: float = MIN_ROOTS
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, frozenset(t or ())) for page, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    hosted = _hosted(pages)
    templates = page_templates(hosted, min_pages, min_share, min_roots)
    rows = hosted.join(templates, ["k1", "k2"], "left").select("page_id", "url", "html", "templates")
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url string, text string, n_chars bigint")
