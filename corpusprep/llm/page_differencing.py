"""Main text of web pages, by nearest-URL page differencing.

A page is read into text lines, one per block of its markup, and the lines that a
page's own markup names as something else than the article (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) are
left out, wherever they stand. Names are read by whole words: a class or id names
chrome if a word of it does and only container words follow ("cookie-notice",
"comment-section", "ad-wrapper"; not "legal-history", "share-price", "has-sidebar",
"content-header"). Inside an article the words that articles use themselves do not
count, and ids only where they name comments, adverts, newsletters or cookies. An
``article`` that its class calls a teaser, card or comment is chrome beside another one.

Pages are then paired by URL path within each host: sorted by path, a page's partner is
the neighbour that shares more leading path segments (then more characters; ties: the
one before). Pages without text lines are passed over as neighbours. The two pages'
lines are aligned by longest common subsequence and the shared lines are deleted: what
repeats on the nearest page is template. A partner that shares every line is a copy of
the page and says nothing about the template: the other neighbour is taken, and if that
is a copy too the page keeps its lines. Lines inside an ``article`` element, or inside
``main`` where no article has any, are the page's own claim to be the article; they are
the whole result and kept even when shared, because copies of an article often sit side
by side on a host. Differencing therefore decides the pages that mark no article.

On Spark: the sorted order is cut into ranges by a bounded sample of the rows (the
smallest hashes), so a host or a URL that holds a third of all pages is many ranges, the
same ones on every run. A first pass finds, on narrow columns, each range's first and
last page with text per host that goes on in another range; these (two per border) are
also sent to the ranges beside them. Then one shuffle brings neighbours together, and a
range is read as a stream that holds three pages at a time. So a page's partner does not
depend on where the ranges are cut.

Defined results: null or empty html gives an empty text; a page whose URL is null
or has no host has no partner; equal rows give equal rows; extra columns are
ignored; an empty table gives no row. Two pages with the same URL are neighbours
(by id, then by content) like any others.
"""

from __future__ import annotations

import html as html_lib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..operators.splits import smallest_hashes
from ..session import materialize

SAMPLE_URLS, RANGE_SAMPLES = 32768, 16  # at most 2,048 ranges, each of 16 sampled rows or more

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>", re.S)
_RAW = {"script", "style", "textarea", "title", "noscript", "xmp", "iframe", "noembed", "noframes", "template", "svg",
        "math", "object", "canvas", "audio", "video"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir",
          "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "optgroup", "p",
          "pre", "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
_CHROME = {"head", "nav", "header", "footer", "aside", "form", "menu", "button", "select", "search", "dialog", "label",
           "fieldset", "datalist"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert",
          "alertdialog", "toolbar", "tablist"}
# Words that name chrome in a class or id, those of them that articles use themselves, words of containers,
# words before "header" that make it the article's own, first words that make a name a modifier, and kinds of side articles.
_CHROME_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertisements", "advertising", "aside", "banner", "banners", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr", "header", "legal", "login", "masthead", "menu",
    "menus", "modal", "nav", "navbar", "navigation", "newsletter", "newsletters", "notice", "notices", "overlay", "pager", "pagination", "popup",
    "promo", "promos", "promotion", "recommended", "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "sidebars", "signup",
    "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "widgets"}
_ARTICLE_WORDS = {"aside", "copyright", "header", "legal", "masthead", "skip"}
_SURE_IDS = {"ad", "ads", "advert", "adverts", "advertisement", "comment", "comments", "cookie", "cookies", "disqus", "newsletter", "respond"}
_CONTAINER_WORDS = {
    "area", "bar", "block", "body", "box", "button", "buttons", "col", "column", "container", "content", "footer", "form", "group", "holder", "icons",
    "inner", "item", "items", "label", "link", "links", "list", "media", "module", "outer", "panel", "region", "row", "section", "slot", "thread", "top",
    "unit", "wrap", "wrapper", "zone"}
_OWN_HEADER = {"article", "content", "entry", "page", "post", "section", "story"}
_MODIFIERS = {"has", "hide", "is", "no", "not", "with", "without"}
_SIDE_ARTICLES = {"card", "comment", "preview", "promo", "promoted", "recommended", "related", "reply", "sponsored", "summary", "teaser"}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
_HIDDEN, _QUOTED = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.I), re.compile(r"\"[^\"]*\"|'[^']*'")
_ARTICLES = re.compile(r"<article(?=[\s/>])([^>]*)>", re.I)
_ATTR = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")


def _names_chrome(token: str, known: set[str]) -> bool:
    """Whether a class token or id has a word of ``known`` that only container words, numbers or more of them follow."""
    words = [w.lower() for w in _WORD.findall(token)]
    if not words or words[0] in _MODIFIERS:
        return False
    for k in range(len(words) - 1, -1, -1):
        w = words[k]
        if w in known and not (w == "header" and k and words[k - 1] in _OWN_HEADER) and not (w == "footer" and words[-1] != "footer"):
            return True
        if w not in _CONTAINER_WORDS and w not in _CHROME_WORDS and not w.isdigit():
            return False
    return False


def _named(attrs: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)}


def _is_side_article(attrs: str) -> bool:
    return any(not _SIDE_ARTICLES.isdisjoint(w.lower() for w in _WORD.findall(t)) for t in _named(attrs).get("class", "").split())


def _is_chrome(name: str, attrs: str, in_article: bool, page: str, pos: int) -> bool:
    """Whether the element opened before ``pos`` is chrome, by its name, role, class or id; never one that holds the article."""
    if name == "form" and not in_article:
        return not _holds_article(page, pos, name)  # some sites wrap the whole page in a form
    if name in _CHROME:
        return not (name == "header" and in_article)  # an article's own header holds its title
    if name == "article":  # beside an article that is none itself
        return _is_side_article(attrs) and any(not _is_side_article(m[1]) for m in _ARTICLES.finditer(page))
    if name in ("html", "body", "main") or not attrs or name not in _BLOCK and name not in ("span", "a"):
        return False
    named = _named(attrs)
    if named.get("role", "").lower() in _ROLES or _HIDDEN.search(_QUOTED.sub("", attrs)) or named.get("aria-hidden") == "true":
        return True
    words = _CHROME_WORDS - _ARTICLE_WORDS if in_article else _CHROME_WORDS
    hint = any(_names_chrome(t, words) for t in named.get("class", "").split())
    if not hint and name not in _HEADINGS:
        hint = _names_chrome(named.get("id", ""), _SURE_IDS if in_article else words)
    return hint and (in_article or not _holds_article(page, pos, name))


def _holds_article(page: str, pos: int, name: str) -> bool:
    """Whether an article or main element opens before the element called ``name`` that was opened before ``pos`` is closed."""
    depth = 1
    tag = re.compile(rf"<!--.*?(?:-->|\Z)|<(script|style)(?=[\s/>]).*?(?:</\1(?=[\s/>])|\Z)"
                     rf"|<(/?)({re.escape(name)}|article|main)(?=[\s/>])([^>]*)", re.I | re.S)
    for m in tag.finditer(page, pos):
        found = (m[3] or "").lower()
        if found in ("article", "main") and not m[2] and not _is_side_article(m[4]):
            return True
        if found == name:
            depth += -1 if m[2] else 1
            if depth == 0:
                return False
    return False


NOWHERE, IN_MAIN, IN_ARTICLE = 0, 1, 2


def page_lines(page: str) -> tuple[list[str], list[int]]:
    """The page's text lines outside its marked chrome, in page order, and what each stands in."""
    lines, inside, text = [], [], []
    article = main = 0
    skip, depth = "", 0
    resume = False

    def flush() -> None:
        if text:
            line = " ".join(html_lib.unescape("".join(text)).split())
            text.clear()
            if line:
                lines.append(line)
                inside.append(IN_ARTICLE if article else IN_MAIN if main else NOWHERE)

    pos, n = 0, len(page)
    while pos < n:
        m = _TOKEN.search(page, pos)
        if not skip:
            text.append(page[pos:m.start() if m else n])
        if not m:
            break
        pos = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing = bool(m["end"] or m["end2"])
        attrs = m["attrs"] or m["attrs2"] or ""
        if name in _RAW and not closing:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, pos)
            if close or name not in ("svg", "math", "object", "audio", "video", "canvas", "template", "noscript"):
                pos = close.end() if close else n
            continue
        if skip:
            resume = name in ("article", "main") and not closing and not _closes(page, pos, skip, depth)
            if not resume:
                if name == skip and not attrs.endswith("/"):
                    depth += -1 if closing else 1
                    if depth == 0:
                        skip = ""
                continue
            skip, depth = "", 0  # the skipped element is never closed: it does not hold the article
        if name in _BLOCK:
            flush()
        if name == "main":
            main = max(0, main + (-1 if closing else 1))
        elif name == "article" and (closing or not _is_chrome(name, attrs, article > 0, page, pos)):
            article = max(0, article + (-1 if closing else 1))
        elif not closing and name not in _VOID and _is_chrome(name, attrs, article > 0, page, pos):
            flush()
            skip, depth = name, 1
    flush()
    return lines, inside


def main_lines(page: str) -> tuple[list[str], bool]:
    """The page's lines, and whether it marks them itself: those of its articles, else of its main part, else all."""
    lines, inside = page_lines(page)
    most = max(inside, default=NOWHERE)
    return [t for t, i in zip(lines, inside) if i == most], most > NOWHERE


def _closes(page: str, pos: int, name: str, depth: int) -> bool:
    """Whether the open elements called ``name`` are closed again after ``pos``."""
    for m in re.finditer(rf"<(/?){re.escape(name)}(?=[\s/>])", page[pos:], re.I):
        depth += -1 if m[1] else 1
        if depth == 0:
            return True
    return False


def shared_lines(a: list[str], b: list[str]) -> list[bool]:
    """Which lines of ``a`` a longest common subsequence with ``b`` holds (bit-parallel, exact)."""
    places: dict[str, int] = {}
    for j, line in enumerate(b):
        places[line] = places.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows, v = [], full
    for line in a:
        u = v & places.get(line, 0)
        v = (v + u | v - u) & full
        rows.append(v)
    # bit j of ~rows[i] is set where the common length of a[:i+1] and b[:j+1] steps up at j
    out = [False] * len(a)
    j = len(b)
    length = (~v & full).bit_count()
    for i in range(len(a) - 1, -1, -1):
        if not length:
            break
        before = rows[i - 1] if i else full
        upto = (1 << j) - 1
        if (~before & full & upto).bit_count() == length:
            continue
        out[i] = True
        hits = places[a[i]] & upto
        # the match's place in b: the last one that still leaves length - 1 before it
        while hits:
            k = hits.bit_length() - 1
            if (~before & full & ((1 << k) - 1)).bit_count() == length - 1:
                j = k
                break
            hits ^= 1 << k
        length -= 1
    return out


def url_key(url: str | None) -> tuple[str, str]:
    """(host, path); both empty for a URL without a host."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").rstrip(".")
    except ValueError:
        return "", ""
    return (host, parts.path or "/") if host else ("", "")


def _closeness(a: str, b: str) -> tuple[int, int]:
    segments = chars = 0
    for x, y in zip(a.strip("/").split("/"), b.strip("/").split("/")):
        if x != y:
            break
        segments += 1
    for x, y in zip(a, b):
        if x != y:
            break
        chars += 1
    return segments, chars


def _range_key(url: str | None, page_id) -> tuple[str, str, int]:
    """What ranges are cut by: the id's hash splits a URL that many rows share."""
    return (*url_key(url), zlib.crc32(str(page_id).encode()))


def _range_bounds(pages: DataFrame, id_col: str, url_col: str) -> list[tuple[str, str, int]]:
    """Keys that cut the sorted order; a bounded sample by hash, so the same for the same table."""
    got = smallest_hashes(pages.select(id_col, url_col), SAMPLE_URLS, F.xxhash64(id_col, url_col), id_col, url_col).collect()
    keys = sorted(_range_key(r[1], r[0]) for r in got)
    return sorted(set(keys[RANGE_SAMPLES::RANGE_SAMPLES]))


def _parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str, bounds: list, with_lines: bool) -> DataFrame:
    """(id, url, range, host, path, hash, full, and with lines: lines, marked); ``full`` tells whether there are lines."""

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                keys = [_range_key(u, i) for i, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
                parsed = [main_lines(h or "") for h in b.column(2).to_pylist()]
                cols = [b.column(0), b.column(1), pa.array([bisect_right(bounds, k) for k in keys], pa.int32()),
                        pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]),
                        pa.array([xxhash.xxh3_64_intdigest("\0".join(t)) >> 1 for t, _ in parsed], pa.int64()), pa.array([bool(t) for t, _ in parsed])]
                names = ["id", "url", "range", "host", "path", "hash", "full"]
                if with_lines:
                    cols += [pa.array([t for t, _ in parsed], pa.list_(pa.string())), pa.array([m for _, m in parsed])]
                    names += ["lines", "marked"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    fields = [T.StructField("id", pages.schema[id_col].dataType), T.StructField("url", T.StringType()), T.StructField("range", T.IntegerType()),
              T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("hash", T.LongType()),
              T.StructField("full", T.BooleanType())]
    if with_lines:
        fields += [T.StructField("lines", T.ArrayType(T.StringType())), T.StructField("marked", T.BooleanType())]
    return pages.select(id_col, url_col, html_col).mapInArrow(parse, T.StructType(fields))


def _guests(narrow: DataFrame) -> DataFrame:
    """(range, host, path, url, id, hash, to, side): the last page with text before a range, and the first behind it, per host that goes on.

    At most two rows per range: a host that lies in two ranges holds all that is between them.
    """
    key = F.struct("path", "url", "id", "hash")
    ends = narrow.where("full AND host <> ''").groupBy("range", "host").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    seen = narrow.where("host <> ''").select("range", "host").distinct().join(ends, ["range", "host"], "left")
    w = Window.partitionBy("host").orderBy("range")
    with_range = lambda c: F.when(F.col(c).isNotNull(), F.struct("range", F.col(c).alias("row")))
    before = F.last(with_range("last"), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    behind = F.first(with_range("first"), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    beside = seen.select("host", F.col("range").alias("to"), before.alias("before"), behind.alias("behind"))
    both = beside.select("host", "to", F.explode(F.array(F.struct(F.lit(-1).alias("side"), F.col("before").alias("at")),
                                                         F.struct(F.lit(1).alias("side"), F.col("behind").alias("at")))).alias("g"))
    return both.where("g.at IS NOT NULL").select("g.at.range", "host", "g.at.row.*", "to", "g.side")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) per page."""
    spark = pages.sparkSession
    bounds = _range_bounds(pages, id_col, url_col)

    def difference(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(prev, row, nxt):
            kept = row["lines"]
            near = [p for p in (prev, nxt) if p is not None and p["host"] and (p["range"], p["host"]) == (row["range"], row["host"])]
            if not row["marked"]:
                for partner in sorted(near, key=lambda p: _closeness(row["path"], p["path"]), reverse=True):
                    shared = shared_lines(kept, partner["lines"])
                    if not all(shared):
                        kept = [t for t, s in zip(kept, shared) if not s]
                        break
            return row["id"], row["url"], "\n".join(kept)

        def results():
            prev = row = None
            for batch in batches:
                for lo in range(0, batch.num_rows, 256):
                    for nxt in batch.slice(lo, 256).to_pylist():
                        if not nxt["full"]:
                            yield nxt["id"], nxt["url"], ""
                            continue
                        if row is not None and not row["side"]:
                            yield emit(prev, row, nxt)
                        prev, row = row, nxt
            if row is not None and not row["side"]:
                yield emit(prev, row, None)

        def done(out):
            ids, urls, texts = zip(*out)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, types[0]), pa.array(urls, pa.string()), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

        out: list = []
        for r in results():
            out.append(r)
            if len(out) >= 256:
                yield done(out)
                out = []
        if out:
            yield done(out)

    id_type = pages.schema[id_col].dataType
    types = [to_arrow_type(id_type)]
    guests = None
    if bounds:
        guests = materialize(_guests(_parsed(pages, id_col, url_col, html_col, bounds, False)), "border-pages")
    parsed = _parsed(pages, id_col, url_col, html_col, bounds, True).withColumn("side", F.lit(0))
    if guests is not None:
        # two rows per range at most, of which there are at most SAMPLE_URLS / RANGE_SAMPLES
        g = guests.groupBy("range", "host", "path", "url", "id", "hash").agg(F.collect_set(F.struct("to", "side")).alias("also"))
        g = F.broadcast(g.select(*[F.col(c).alias(f"g_{c}") for c in ("range", "host", "path", "url", "id", "hash")], "also"))
        met = parsed.join(g, F.expr("range = g_range AND host = g_host AND path = g_path AND url <=> g_url AND id <=> g_id AND hash = g_hash"), "left")
        places = F.concat(F.array(F.struct(F.col("range").alias("to"), F.col("side"))), F.coalesce("also", F.expr("array()")))
        parsed = met.withColumn("at", F.explode(places)).select("id", "url", F.col("at.to").alias("range"), F.col("at.side").alias("side"),
                                                                "host", "path", "hash", "full", "lines", "marked")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["range", "host", "side", "path", "url", "id", "hash"]
    near = parsed.repartition(n, "range").sortWithinPartitions(*order)
    texts = near.mapInArrow(difference, T.StructType([
        T.StructField("id", id_type), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType())]))
    return texts.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
