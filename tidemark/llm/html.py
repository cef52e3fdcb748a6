"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped first: comments, scripts and styles go; block elements end a line; lines inside
menus, headers, footers, side bars, notices, adverts, forms and reader comments (by element, role,
class or id) count as having no text; an element that holds the page's marked article (``article``,
``main``) is never one of these, nor one with most of the text if nothing else were left. Where the page marks an article, every other line inside it is kept. Where it
marks none, lines that are mostly links count as having no text too, and over windows of ``WINDOW``
lines the text lengths are summed. A stretch starts at the surge where the sum passes ``SURGE`` (or,
if none does, where it leaves zero) and ends at the dive where it is zero again. The article reaches
from the first stretch that is not much smaller than the largest to the last.

Defined cases: null, empty and text-free pages give an empty text; unclosed elements reach to the
end of the page; repeated pages are each extracted.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import pieces

WINDOW, SURGE, SMALL = 3, 60, 0.1

# Element names and words of class, id and role attributes.
SKIPPED = "nav header footer aside form button select textarea noscript template iframe svg dialog menu".split()
BLOCKS = ("address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li "
          "main nav ol option p pre section summary table tbody td tfoot th thead title tr ul").split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
BOILERPLATE = ("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments comment-list consent cookie cookies disqus "
               "footer header masthead menu nav navbar navigation newsletter notice pagination popup promo promoted related reply respond share sharing "
               "sidebar signup social sponsor sponsored subscribe toolbar").split()
PLACES = "site main page top bottom left right primary secondary global".split()

_RAW = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|head)\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>", re.S | re.I)
_UNSEEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_OPEN_HEAD = re.compile(r"<head\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?=<(?:body|" + "|".join(b for b in BLOCKS if b not in ("head", "html", "title")) + r")(?=[\s/>])|\Z)", re.S | re.I)
_MARKED = re.compile(r"<(article|main)(?=[\s/>])", re.I)
_OPENED = re.compile(r"</?[a-zA-Z]")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_skipped, _blocks, _void, _words, _places = map(frozenset, (SKIPPED, BLOCKS, VOID, BOILERPLATE, PLACES))


def _boilerplate(name: str, attributes: str, exempt: bool) -> bool:
    if name in _skipped:
        return True
    if exempt or name in ("html", "body"):
        return False
    for _, a, b, c in _ATTRIBUTE.findall(attributes):
        value = (a or b or c).lower()
        if any(word in _words or _compound(re.split(r"[-_]+", word)) for word in value.split()):
            return True
    return False


def _compound(parts: list[str]) -> bool:
    """cookie-notice, comments-area, main-nav or site-footer, but not content-with-sidebar, no-header or has-comments."""
    return parts[0] in _words or (parts[-1] in _words and all(p in _places for p in parts[:-1]))


def _wrappers(page: str, tags: list[re.Match], fallback: bool) -> set[int]:
    """Positions in ``tags`` of the elements that may not be excluded since they hold the article.

    Such an element holds the first article or main and most of the marked text; with ``fallback``
    most of the marked text (of all text, if none is marked) is enough.
    """
    marks = [k for k, tag in enumerate(tags) if not tag.group(1) and tag.group(2).lower() in ("article", "main")]
    seen = [tags[k].group(2).lower() for k in marks]
    first = [marks[seen.index(name)] for name in ("article", "main") if name in seen]
    total, close, opened, depth, at = [], [len(tags)] * len(tags), {}, 0, 0
    for k, tag in enumerate(tags):  # total: letters of the text before each tag
        size = len("".join(page[at:tag.start()].split())) if depth or not marks else 0
        total.append((total[-1] if total else 0) + size)
        at, name = tag.end(), tag.group(2).lower()
        if name in ("article", "main"):
            depth = max(0, depth + (-1 if tag.group(1) else 1))
        if not tag.group(1):
            if name not in _void:
                opened.setdefault(name, []).append(k)
        elif opened.get(name):
            close[opened[name].pop()] = k
    total.append((total[-1] if total else 0) + (len("".join(page[at:].split())) if depth or not marks else 0))
    return {k for k, tag in enumerate(tags) if not tag.group(1) and (fallback or any(k < f < close[k] for f in first)) and 2 * (total[close[k]] - total[k]) > total[-1]}


def lines_of(page: str, fallback: bool = False) -> list[tuple[str, int]]:
    """(text, weight) of every line: its length, 0 where no article is marked and it is mostly links, -1 where excluded."""
    if "</head" not in page.lower():  # its end tag may be left out: the first element of the body ends it
        page = _OPEN_HEAD.sub(" ", _UNSEEN.sub(" ", page), count=1)
    page = _RAW.sub(" ", page)
    marked = _MARKED.search(page)
    container, lines, buffer = None, [], []
    if marked:  # an article before main may be a teaser, so main counts as well
        container = ("main",) if marked.group(1).lower() == "main" else ("article", "main")
    depth_in, skip_name, skip_depth, linked, in_link, at = 0, None, 0, 0, 0, 0

    tags, wrappers, met = list(_TAG.finditer(page)), None, set()

    def end() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(buffer)).split())
        if text:
            if skip_name is not None or (container is not None and depth_in == 0):
                lines.append((text, -1))
            else:
                lines.append((text, 0 if container is None and linked > 0.6 * len(text) else len(text)))
        buffer.clear()
        linked = 0

    for k, tag in enumerate(tags):
        run = page[at:tag.start()]
        at = tag.end()
        if run:
            buffer.append(run)
            linked += len(run) if in_link else 0
        closing, name, attributes = tag.group(1), tag.group(2).lower(), tag.group(3)
        if name == "br":
            buffer.append(" ")
        elif name in _blocks or name in _skipped:
            end()
        if name == "a":
            in_link = 0 if closing else 1
        if container is not None and name in container:
            depth_in = max(0, depth_in + (-1 if closing else 1))
        # the first article and the first main are never boilerplate; later ones, such as comments, may be
        exempt = name in ("article", "main") and not closing and name not in met
        if exempt:
            met.add(name)
        if skip_name is not None:
            if name == skip_name:
                skip_depth += -1 if closing else 1
                if skip_depth == 0:
                    end()
                    skip_name = None
        elif not closing and name not in _void and not attributes.rstrip().endswith("/") and _boilerplate(name, attributes, exempt):
            if wrappers is None:
                wrappers = _wrappers(page, tags, fallback)
            if k not in wrappers:
                end()
                skip_name, skip_depth = name, 1
    cut = _OPENED.search(page, at)
    buffer.append(page[at:cut.start()] if cut else page[at:])
    end()
    return lines


def main_text(page: str | None) -> str:
    page = page or ""
    lines = lines_of(page)
    if lines and all(weight < 0 for _, weight in lines):
        lines = lines_of(page, fallback=True)
    if _MARKED.search(_RAW.sub(" ", page)):
        return "\n".join(text for text, weight in lines if weight >= 0)
    n = len(lines)
    total = [0]
    for _, weight in lines:
        total.append(total[-1] + max(0, weight))
    window = [total[min(n, i + WINDOW)] - total[i] for i in range(n)]
    least = SURGE if any(w >= SURGE for w in window) else 1
    stretches, i = [], 0
    while i < n:
        if window[i] >= least:
            dive = i
            while dive < n and window[dive] > 0:
                dive += 1
            begin = i
            while begin > 0 and window[begin - 1] > 0 and lines[begin - 1][1] > 0:  # short lines before the surge
                begin -= 1
            stretches.append((begin, dive))
            i = dive
        else:
            i += 1
    if not stretches:
        return ""
    size = [total[b] - total[a] for a, b in stretches]
    large = [k for k, x in enumerate(size) if x >= SMALL * max(size)]
    begin, dive = stretches[large[0]][0], stretches[large[-1]][1]
    while lines[begin][1] <= 0:  # a stretch starts up to WINDOW lines before its text
        begin += 1
    while lines[dive - 1][1] <= 0:
        dive -= 1
    return "\n".join(text for text, weight in lines[begin:dive] if weight >= 0)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            texts = [main_text(p) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.select("page_id", "url", F.col("html").cast("string").alias("html")).mapInArrow(extract, schema)
