"""Main text of web pages: passages that a host repeats are found first, page structure checks the rest.

A parser splits a page into blocks and tells which stand in an article, which in an element that is
boilerplate by its name, class or role, and which are open. The streams of words outside articles are
concatenated per host, and a suffix array over the concatenation, sorted to LONG words, brings equal
passages together. Each task sorts the suffixes of the pages it reads and hands on one row per distinct
passage of LONG words with its first and last page; these rows merge by host, so a host of any size is
split over tasks. Longer repeats cover the same words as the passages of LONG words in them. Marked
phrases within an article are suffixes that end with their element, so they repeat at any length.

Every page then gets the places where its passages repeat, and its text by them: words of open blocks that
a repeated passage covers go, and so does a phrase of an article that is marked by a word of two meanings
(share, related) if another page of the host has it; it stays if the host has other pages and none has it.
Structure confirms: a page with an article (or a main element) keeps its unmarked blocks whole.
"""

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm import common

LONG = 8  # words of a passage that counts as repeated

# Elements and attribute words that mark boilerplate.
DROPPED = frozenset("nav header footer aside form button select menu dialog head title script style noscript template svg math iframe object canvas audio video textarea xmp noembed noframes".split())
SILENT = frozenset("head title script style noscript template svg math iframe object canvas audio video textarea xmp noembed noframes select button".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation sidebar footer header masthead comment comments reply replies "
    "notice notices cookie cookies consent gdpr popup modal newsletter subscribe signup share sharing social related breadcrumb breadcrumbs widget pagination disqus respond".split()
)
# Of these, words that writers use for parts of a text as well.
DOUBTFUL = frozenset("banner header footer comment comments reply replies notice notices share sharing social related respond subscribe signup promotion menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar note".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "option p pre section summary table tbody tfoot thead tr ul dialog".split()
)
SPACED = frozenset("br td th".split())
_TAG = re.compile(r"<(?:!--(?:.*?-->|.*)|[!?][^>]*+(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+)(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[a-z0-9]+")
ARTICLE, BOILERPLATE, OPEN, MAIN = 0, 1, 2, 3
SURE, MAYBE = 1, 2
SHOWN, KEPT, HIDDEN = 0, 1, 2


def _marked(name, attributes):
    """Whether name or attributes mark boilerplate: SURE, MAYBE or nothing (0)."""
    if name in DROPPED:
        return SURE
    if not attributes or name in ("html", "body", "main"):
        return 0
    found = set()
    for m in _ATTRIBUTE.finditer(attributes):
        words = set(_WORDS.findall((m[2] or m[3] or m[4] or "").lower()))
        if m[1].lower() == "role":
            if words & ROLES:
                return SURE
        else:
            found |= words & MARKS
    return 0 if not found else MAYBE if found <= DOUBTFUL else SURE


def blocks(page: str, phrases: dict | None = None, kept=frozenset()) -> list:
    """(state, text) of the blocks of a page in order; text is decoded, white space collapsed.

    phrases: receives the text of each doubtful phrase of an article, by its place in the page.
    kept: places of the phrases to leave in the text; the others are not shown.
    """
    out, buffer, stack = [], [], []  # stack: name, state, silent (KEPT: all of it is shown; a list: texts of a phrase)

    def flush():
        text = " ".join(html.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            out.append((stack[-1][1] if stack else OPEN, text))

    def pop_to(i):
        if any(s[0] in BLOCKS for s in stack[i:]) or stack[i][1] != (stack[i - 1][1] if i else OPEN):
            flush()
        del stack[i:]

    at, found = 0, {}
    while True:
        m = _TAG.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            to = stack[-1][2] if stack else SHOWN
            if to in (SHOWN, KEPT):
                buffer.append(text)
            elif to != HIDDEN:
                to.append(text)
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:  # an end tag
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    pop_to(i)
                    break
                if name not in BLOCKS and name not in DROPPED and stack[i][0] in BLOCKS:
                    break  # an inline end tag does not reach out of its block
            if name in SPACED:
                buffer.append(" ")
            continue
        if name in SPACED:
            buffer.append(" ")
        if name in BLOCKS and name not in ("html", "body"):
            close = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "option": ("option",)}.get(name, ())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or stack[i][0] in close:
                    pop_to(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
            flush()
        if name in VOID:
            continue
        attributes = m[3] or m[6] or ""
        above = stack[-1][1] if stack else OPEN
        nested = name == "article" and above != OPEN and above != MAIN
        marked = (name != "article" or nested) and _marked(name, attributes)
        silent = stack[-1][2] if stack else SHOWN
        if name in SILENT:
            silent = HIDDEN
        elif marked and name not in BLOCKS and silent == SHOWN:
            silent = HIDDEN
            if marked == MAYBE and above in (ARTICLE, MAIN):
                silent = KEPT if m.start() in kept else found.setdefault(m.start(), [])
        if silent == KEPT and name not in BLOCKS:
            marked = 0
        if silent not in (SHOWN, KEPT):  # what is not shown, or dropped within a block, does not end the block
            state = above
        elif above == BOILERPLATE or marked:
            state = BOILERPLATE
        elif name == "article":
            state = ARTICLE
        elif above == OPEN and (name == "main" or "main" in re.findall(r"role\s*=\s*[\"']?(\w+)", attributes)):
            state = MAIN
        else:
            state = above
        if state != above:
            flush()
        stack.append((name, state, silent))
        if name in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
    flush()
    if phrases is not None:
        phrases.update((place, " ".join(html.unescape("".join(texts)).split())) for place, texts in found.items())
    return out


def settled(found) -> str | None:
    """The text where the structure gives it: of articles, else of main; '' if nothing is open; else None."""
    for state in (ARTICLE, MAIN):
        if texts := [t for s, t in found if s == state]:
            return "\n".join(texts)
    return None if any(s == OPEN for s, _ in found) else ""


def _stream(found) -> list:
    """Words outside articles, in page order."""
    return [w for s, t in found if s in (BOILERPLATE, OPEN) for w in t.encode("utf-8", "surrogatepass").split()]


def suffix_array(tokens: np.ndarray, long: int) -> tuple:
    """(order, rank) of suffixes by their first `long` values (a power of two), by prefix doubling.

    Suffixes that agree in so many values share a rank; values past the end rank lowest.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while step < long:
        after = np.r_[rank[step:], np.zeros(min(step, len(rank)), np.int64)][: len(rank)]
        rank = np.unique(rank * (len(rank) + 2) + after, return_inverse=True)[1].astype(np.int64) + 1
        step *= 2
    return np.argsort(rank, kind="stable"), rank


_HOST = np.uint64(1)  # key of what every page of a host has
REPEATED_HOST, PHRASE = -2, -3  # at: the host has another page; PHRASE - p: the phrase at place p. -1 is a passage of the task
_SCHEMA = "row bigint, key bigint, low bigint, high bigint, at bigint"


def _of_host(key, host):
    return common.mixed(np.asarray(key, np.uint64) + np.asarray(host, np.int64).view(np.uint64) * common.ODD2).view(np.int64)


def _passages(long):
    """Distinct passages of LONG words of the pages of a block, by host, with their pages; and all places of passages by page."""

    def run(batches):
        for b in common.blocks(batches, "html"):
            streams, of, wanted = [], [], []  # wanted: page, keys, places
            hosts, pages = (b.column(c).to_numpy(zero_copy_only=False) for c in ("host", "page"))
            single = []  # page, key: phrases, and the host itself
            for i, page in enumerate(common.strings(b.column("html"))):
                phrases = {}
                h = common.word_hashes(_stream(blocks(page, phrases)))
                if len(h) >= long:
                    streams.append(h)
                    of.append(np.full(len(h), i))
                    wanted.append((i, common.window_hashes(h, long), np.arange(len(h) - long + 1)))
                keys = common.word_hashes([t.encode("utf-8", "surrogatepass") for t in phrases.values()], 1)
                single += [(i, _HOST), *((i, k) for k in keys)]
                if phrases:
                    wanted.append((i, np.r_[_HOST, keys], np.r_[REPEATED_HOST, PHRASE - np.array(list(phrases))]))
            rows, keys = np.array([i for i, _ in single], np.int64), np.array([k for _, k in single], np.uint64)
            lows = highs = pages[rows]
            if streams:
                page_of, text = np.concatenate(of), np.concatenate(streams)
                host_of = np.unique(hosts, return_inverse=True)[1][page_of]
                order, rank = suffix_array(text, long)
                size = np.bincount(page_of)[page_of]
                first = np.r_[0, np.flatnonzero(np.diff(page_of)) + 1]
                place = np.arange(len(text)) - np.repeat(first, np.diff(np.r_[first, len(text)]))
                order = order[(place + long <= size)[order]]  # passages do not run over the end of a page
                order = order[np.lexsort((host_of[order], rank[order]))]
                edge = np.flatnonzero(np.r_[True, (np.diff(rank[order]) != 0) | (np.diff(host_of[order]) != 0)])
                ids = pages[page_of[order]]
                rows, keys = np.r_[rows, page_of[order[edge]]], np.r_[keys, common.window_hashes(text, long)[order[edge]]]
                lows, highs = np.r_[lows, np.minimum.reduceat(ids, edge)], np.r_[highs, np.maximum.reduceat(ids, edge)]
            n = len(rows)
            owner = np.concatenate([rows, *(np.full(len(k), i) for i, k, _ in wanted)])
            key = _of_host(np.concatenate([keys, *(k for _, k, _ in wanted)]), hosts[owner])
            at = np.concatenate([np.full(n, -1), *(a for _, _, a in wanted)])
            none = pa.nulls(len(owner) - n, pa.int64())
            low, high = (pa.concat_arrays([pa.array(x, pa.int64()), none]) for x in (lows, highs))
            yield pa.RecordBatch.from_arrays([b.column("row").take(pa.array(owner)), pa.array(key), low, high, pa.array(at, pa.int64())], ["row", "key", "low", "high", "at"])

    return run


def _texts(long):
    """The text of each page by the places of its repeated passages."""

    def run(batches):
        for b in common.blocks(batches, "html"):
            texts, repeated = [], []
            for page, places in zip(common.strings(b.column("html")), b.column("starts").to_pylist(), strict=True):
                places, phrases = set(places or ()), {}
                found, at, left = blocks(page, phrases), 0, []
                if phrases and REPEATED_HOST in places and (own := {p for p in phrases if PHRASE - p not in places}):
                    found = blocks(page, None, own)
                covered = {i + k for i in places if i >= 0 for k in range(long)}
                for state, text in found:
                    if state in (BOILERPLATE, OPEN):
                        words = text.split()
                        unique = " ".join(w for k, w in enumerate(words, at) if k not in covered)
                        at += len(words)
                        if state == OPEN and unique:
                            left.append(unique)
                structure = settled(found)
                texts.append("\n".join(left) if structure is None else structure)
                repeated.append(len(covered))
            yield _result(b, texts, repeated)

    return run


def _result(b, texts, repeated):
    return pa.RecordBatch.from_arrays(
        [b.column("page_id"), b.column("url"), pa.array([t.encode("utf-8", "replace").decode() for t in texts], pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(repeated, pa.int64())],
        ["page_id", "url", "text", "n_chars", "n_repeated"])


def host_text(pages: DataFrame, long=LONG, hub_rows=common.HUB_ROWS) -> DataFrame:
    """One row per row of `pages` (page_id, url, html): page_id, url, text, n_chars, n_repeated.

    n_repeated: words outside articles within passages that another page of the host has.
    Null and empty html give an empty text. Pages are told apart by their html, so copies of a page, under
    one address or several, do not make its own text boilerplate. A null url is a host of its own. Unmarked text
    of an article is never removed, even if other pages repeat it. An empty table gives an empty one.
    hub_rows: places of one passage that may meet in a task.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = common.columns(pages, page_id="page_id", url="url", html="html")
    kind = dict(rows.dtypes)["page_id"]
    rows = rows.select("*", F.xxhash64(host).alias("host"), F.xxhash64("html").alias("page"), F.xxhash64("page_id", "url", "html").alias("row"))
    found = common.cut(rows.select("host", "page", "row", "html").mapInArrow(_passages(long), _SCHEMA))
    merged = found.groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count_if(F.col("at") != -1).alias("count"))
    repeated = common.cut(merged.filter("low <> high and count > 0").select("key", "count"))
    starts = common.spread_join(found.filter("at <> -1").select("key", "row", "at"), repeated.select("key"), "key", hub_rows, counts=repeated)
    starts = starts.groupBy("row").agg(F.collect_set("at").alias("starts"))
    placed = rows.select("page_id", "url", "html", F.col("row").alias("_row")).join(starts, F.col("_row") == F.col("row"), "left")
    return placed.select("page_id", "url", "html", "starts").mapInArrow(_texts(long), f"page_id {kind}, url string, text string, n_chars bigint, n_repeated bigint")


def main_text(pages: DataFrame, long=LONG) -> DataFrame:
    """page_id, url, text and n_chars of `host_text`."""
    return host_text(pages, long).drop("n_repeated")
