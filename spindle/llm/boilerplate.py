"""Main text of pages: by markup, and by repetition on the host for what the markup leaves open.

A page is cut into blocks at block-level tags. Elements that are never the
article (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles, comments of readers, hidden ones) are told by tag, role and class or id.
If the page names its article by a tag (``article``, else ``main``), the blocks
inside are the text. They are not searched for repeats: articles quote and copy
each other, and a repeated passage of an article is still its text (see the
README). If only a class or id such as ``content`` names it, blocks inside are
text, and so are unique runs of ``RUN`` tokens or more outside.

For all other blocks repetition decides. Windows of ``RUN`` tokens are hashed
together with their host and counted over distinct pages (pages of equal html
count as one): each task sends one entry per host and window. Every substring of
RUN tokens or more that stands on two pages is covered by its windows, so
removing the windows that do removes all repeated substrings whole; the unique
runs stay, in page order. These are the substrings that a suffix array over the
host's token streams would give, without gathering a host's pages anywhere.

The merged table of repeated windows is sent to all tasks only if it has at most
``SENT_WINDOWS`` rows (8 bytes each); beyond that it is joined to the pages'
windows and only the pages that need it are dealt anew. Both ways give the same text.

Defined cases: null and empty html give an empty text; null urls share the empty
host; unclosed tags end with their parent; a comment, script or style without an
end runs to the page's end; repeated rows get equal texts; an empty table gives
no rows; columns other than the given three are not looked at.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrowtext as at
from .runtime import on_workers, written

RUN = 8
SENT_WINDOWS = 2_000_000
EMIT_BYTES = 8 << 20

# HTML element groups and the class, id and role words of page furniture.
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
            "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
NEVER = set("head nav header footer aside form menu dialog button select option template noscript svg math object audio video canvas search script style textarea "
            "title iframe noembed noframes".split())
FURNITURE = set("ad ads advert adverts advertisement advertisements adsense sponsor sponsored promo promotion sidebar aside widget related recommended nav navbar "
                "navigation menu breadcrumb breadcrumbs header masthead footer comment comments reply replies discussion disqus notice notices cookie cookies consent "
                "gdpr banner alert popup modal overlay newsletter subscribe subscription signup login share sharing social pagination pager toolbar search hidden".split())
ROLES = set("navigation banner contentinfo complementary search menu menubar dialog alert form toolbar".split())
# A class or id is furniture if its words are all of FURNITURE or NEUTRAL (and not all of the latter), or it begins with a word of PREFIX. One with a
# word of STATE tells how the page is laid out. Elements of WHOLE hold the page or the article, so their class and id never count.
NEUTRAL = set("site global top bottom left right primary secondary box bar wrapper container list unit slot area".split())
PREFIX = set("ad ads advert adverts advertisement adsense sponsor sponsored promo promotion related recommended breadcrumb breadcrumbs cookie cookies gdpr newsletter disqus".split())
STATE = set("no has with without is open opened closed enabled disabled active visible free on off accepted loaded".split())
WHOLE = set("html body main article".split())
ARTICLE_HINTS = set("content article post entry story main".split())
# A class or id names the article if its words are all hints or of HINT_PARTS, one of them a hint. Furniture may bear a hint too (``main-menu``), but a
# heading of the article does (``article-header``).
HINT_PARTS = set("body text inner area column page blog single full".split())
HEADING = set("header masthead".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[a-z0-9]+")


def _furniture(token: str) -> bool:
    words = _WORD.findall(token)
    if not words or STATE & set(words):
        return False
    mine = FURNITURE & set(words)
    rest = [w for w in words if w not in FURNITURE and w not in NEUTRAL and not w.isdigit()]
    return words[0] in PREFIX or bool(mine) and (not rest or ARTICLE_HINTS.issuperset(rest) and not mine <= HEADING)


def _hint(token: str) -> bool:
    words = _WORD.findall(token)
    return bool(ARTICLE_HINTS & set(words)) and all(w in ARTICLE_HINTS or w in HINT_PARTS or w.isdigit() for w in words)


def _element(name: str, attributes: str) -> tuple[bool, int]:
    """(never the article, rank as the article's container)."""
    never = name in NEVER
    rank = 3 if name == "article" else 2 if name == "main" else 0
    if attributes.strip() and not never:
        found = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)}
        tokens = f"{found.get('class', '')} {found.get('id', '')}".split()
        role = found.get("role", "")
        never = name not in WHOLE and any(map(_furniture, tokens)) or role in ROLES or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
        if role == "main":
            rank = max(rank, 2)
        elif not rank and any(map(_hint, tokens)):
            rank = 1
    return never, rank


def blocks(html: str) -> list[tuple[bool, int, str]]:
    """(never the article, container rank, text) of the page's blocks in order."""
    out: list[tuple[bool, int, str]] = []
    stack: list[tuple[str, bool, int]] = []
    open_names: dict[str, int] = {}            # how often each name stands open
    solid: list[int] = []                      # places of open paragraphs and block elements
    never, rank = False, 0
    held: list[str] = []

    def close(depth: int) -> None:
        """Ends the open elements from place ``depth`` on."""
        nonlocal never, rank
        for name, _, _ in stack[depth:]:
            open_names[name] -= 1
        del stack[depth:]
        while solid and solid[-1] >= depth:
            solid.pop()
        never, rank = (stack[-1][1], stack[-1][2]) if stack else (False, 0)

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        if text:
            out.append((never, rank, text))
        held.clear()

    place, size = 0, len(html)
    while place < size:
        tag = _TAG.search(html, place)
        if tag is None:
            held.append(html[place:])
            break
        held.append(html[place:tag.start()])
        place = tag.end()
        if tag[2] is None:
            if tag[0].startswith("<![CDATA["):
                held.append(entities.escape(tag[0][9:-3]))
            continue
        name = tag[2].lower()
        if tag[1]:
            if open_names.get(name):
                depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name)
                if any(x[0] in BLOCK or x[1] for x in stack[depth:]):
                    flush()
                close(depth)
            continue
        if name == "br":
            held.append(" ")
            continue
        if name in BLOCK:
            flush()
            if name == "body":
                close(0)
            # an open paragraph ends where another block begins, and what stands open in it
            if solid and stack[solid[-1]][0] == "p":
                close(solid[-1])
        if name in VOID:
            continue
        mine, own = _element(name, tag[3])
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}[^>]*>", re.I).search(html, place)
            place = end.end() if end else size
            continue
        if mine and not never:
            flush()
        if not tag[3].endswith("/") or name in BLOCK:
            if name in BLOCK:
                solid.append(len(stack))
            open_names[name] = open_names.get(name, 0) + 1
            stack.append((name, never or mine, max(rank, own)))
            never, rank = stack[-1][1], stack[-1][2]
    flush()
    return out


def _split(html: str | None) -> tuple[list[str], list[str], list[bool], list[bool] | None]:
    """(blocks of the named article, other blocks, which of those may be text, and
    where both may be: for each block that may, whether it is one of the article)."""
    found = blocks(html or "")
    best = max((r for n, r, _ in found if not n), default=0)
    article = [t for n, r, t in found if best and r == best and not n]
    other = [(n or best > 1, t) for n, r, t in found if n or not best or r != best]
    both = [r == best for n, r, _ in found if not n] if best == 1 else None
    return article, [t for _, t in other], [not n for n, _ in other], both


def _in_order(article: list[str], unique: list[str], both: list[bool] | None) -> list[str]:
    """The page's text: the article; or, where a class names it, with the long unique runs around it; or the unique runs."""
    if both is None:
        return article or [u for u in unique if u]
    inside, outside = iter(article), iter(unique)
    out = [next(inside) if mine else next(outside) for mine in both]
    return [t for t, mine in zip(out, both) if mine or len(t.split()) >= RUN]


def _windows(hosts: list[str], streams: list[list[str]]):
    """For the token streams of pages: (page, window hash) of every RUN-token
    window, and per page the tokens' number. A window's hash tells its host."""
    text = ["\n".join(s).encode() for s in streams]
    offsets = np.cumsum([0, *map(len, text)])
    data = np.frombuffer(b"".join(text), np.uint8)
    spaces = np.zeros(256, bool)
    spaces[[9, 10, 11, 12, 13, 32]] = True
    start, end = at.runs(~spaces[data], offsets)
    first = np.searchsorted(start, offsets)
    token = at.hash_ranges(data, start, end)
    host = at.word_hashes([h or "-" for h in hosts])
    count = np.diff(first)
    per = np.maximum(count - RUN + 1, 0)
    page = np.repeat(np.arange(len(streams)), per)
    begin = np.arange(len(page)) - np.repeat(np.cumsum(per) - per, per) + first[:-1][page]
    key = host[page]
    for j in range(RUN):
        key = at.mix(key * np.uint64(0xD6E8FEB86659FD93) + token[begin + j])
    return page, key, begin - first[:-1][page], count


def _host(url: str | None) -> str:
    rest = (url or "").partition("://")[2]
    return re.split("[/?#]", rest, maxsplit=1)[0].lower()


def _shard(batches):
    """One entry per host and RUN-token window of a batch's pages, with the least and greatest page that holds it."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 2000):
            urls, pages = (batch.column(k).slice(lo, 2000).to_pylist() for k in (0, 1))
            page, key, _, _ = _windows([_host(u) for u in urls], [_split(h)[1] for h in pages])
            if not len(page):
                continue
            who = at.mix(at.word_hashes([(h or "") + "-" for h in pages])).view(np.int64)[page]
            order = np.argsort(key, kind="stable")             # equal windows of a host become neighbours
            k, w = key[order], who[order]
            new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            yield pa.RecordBatch.from_arrays([pa.array(k[new].view(np.int64)), pa.array(np.minimum.reduceat(w, new)), pa.array(np.maximum.reduceat(w, new))],
                                             names=["window", "least", "most"])


def repeated_windows(spark: SparkSession, pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(window) of every host's RUN-token windows that stand on two distinct pages."""
    on_workers(spark)
    entries = pages.select(F.col(url).cast("string").alias("u"), F.col(html).alias("h")).mapInArrow(_shard, "window long, least long, most long")
    return entries.groupBy("window").agg(F.min("least").alias("least"), F.max("most").alias("most")).where("least != most").select("window")


def _unique_runs(other: list[str], allowed: list[bool], covered: np.ndarray) -> tuple[list[str], int]:
    """Of each block that may be text, the tokens that no repeated window covers."""
    out, k = [], 0
    for text, ok in zip(other, allowed):
        tokens = text.split()
        kept = [t for t, c in zip(tokens, covered[k:k + len(tokens)]) if not c]
        k += len(tokens)
        if ok:
            out.append(" ".join(kept))
    return out, int(covered.sum())


def _texts(batches, known):
    """Final texts; ``known(batch, lo, hi)`` gives the sorted repeated windows to look up."""
    for batch in batches:
        lo, held, texts, repeated = 0, 0, [], []
        for at_ in range(0, batch.num_rows, 500):
            urls, pages = (batch.column(k).slice(at_, 500).to_pylist() for k in (1, 2))
            cut = [_split(h) for h in pages]
            page, key, begin, count = _windows([_host(u) for u in urls], [c[1] for c in cut])
            windows = known(batch, at_, at_ + len(urls))
            hit = np.zeros(len(key), bool)
            if len(windows):
                hit = windows[np.minimum(np.searchsorted(windows, key.view(np.int64)), len(windows) - 1)] == key.view(np.int64)
            edge = np.searchsorted(page, np.arange(len(urls) + 1))
            for i, (article, other, allowed, both) in enumerate(cut):
                covered = np.zeros(int(count[i]), bool)
                for b in begin[edge[i]:edge[i + 1]][hit[edge[i]:edge[i + 1]]]:
                    covered[b:b + RUN] = True
                unique, n = _unique_runs(other, allowed, covered)
                texts.append("\n".join(_in_order(article, unique, both)))
                repeated.append(n)
                held += len(texts[-1])
                if held >= EMIT_BYTES or at_ + i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(lo, len(texts)) for k in (0, 1)), pa.array(texts, pa.string()), pa.array(repeated, pa.int64())],
                                                     names=["row_key", "url", "text", "n_repeated"])
                    lo, held, texts, repeated = lo + len(texts), 0, [], []


def _page_windows(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            ids, urls, pages = (batch.column(k).slice(lo, 500).to_pylist() for k in range(3))
            page, key, _, _ = _windows([_host(u) for u in urls], [_split(h)[1] for h in pages])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(ids, np.int64)[page]), pa.array(key.view(np.int64))], names=["row", "window"])


def extract(spark: SparkSession, pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", sent_windows: int = SENT_WINDOWS) -> DataFrame:
    """row_key, url, text and n_repeated (tokens outside the named article that
    stand in repeated substrings) of every page."""
    on_workers(spark)
    schema = T.StructType([T.StructField("row_key", pages.schema[key].dataType), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_repeated", T.LongType())])
    source = pages.select(F.col(key).alias("row_key"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    repeated, _ = written(spark, repeated_windows(spark, pages, url, html), "windows")
    if repeated.count() <= sent_windows:
        windows = np.sort(np.array(repeated.toArrow().column(0), np.int64))
        sent = spark.sparkContext.broadcast(windows)
        return source.mapInArrow(lambda b: _texts(b, lambda batch, lo, hi: sent.value), schema)
    # equal rows have equal texts, so a row is known by its hash
    source = source.withColumn("row", F.xxhash64("row_key", "url", "html"))
    mine = source.select("row", "url", "html").mapInArrow(_page_windows, "row long, window long").distinct().join(repeated, "window", "left_semi")
    mine = mine.groupBy("row").agg(F.collect_list("window").alias("windows"))
    both = source.join(mine, "row", "left").select("row_key", "url", "html", "windows")

    def own(batch, lo, hi):
        flat = batch.column(3).slice(lo, hi - lo).drop_null().flatten()
        return np.unique(np.array(flat, np.int64))

    return both.mapInArrow(lambda b: _texts(b, own), schema)
