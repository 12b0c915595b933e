"""Main text of web pages: markup marks the article, a suffix array over each host's pages finds what repeats."""

from __future__ import annotations

import hashlib
import html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phaseloom.llm.common import join_spread, stored
from phaseloom.llm.tokens import blocks, tidy

# Elements of HTML.
_RAW = ("script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "select", "canvas", "audio", "video", "xmp")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt rtc ruby s samp small span strike strong sub sup td th time tt u var wbr br img".split())
_MAIN = frozenset(["article", "main"])
_FURNITURE = frozenset("nav aside form footer dialog menu button head fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
#: Words in a class or id that name page furniture.
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead footer "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "toolbar pagination pager search replies respond disqus skip".split()
)
#: Elements that end an open element of the same kind.
_ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-zA-Z]+")
_WHITE = re.compile(r"\s+")
_HEADING = re.compile(r"h[1-6]\Z")
#: What a text is to the page.
MAIN, OPEN, DROPPED = 0, 1, 2


@dataclass(frozen=True)
class Extraction:
    """Runs of min_run tokens (words, and one token for each text's place in the markup) that distinct pages of a host share count as repeated."""

    min_run: int = 6


def _furniture(name: str, attributes: str, in_main: bool) -> bool:
    if name in _FURNITURE or (name == "header" and not in_main) or (name in _MAIN and in_main and name == "article"):
        return True
    if not attributes:
        return False
    for kind, *values in _NAMED.findall(attributes):
        value = next((v for v in values if v), "").lower()
        if kind.lower() == "role":
            if value in _ROLES:
                return True
        elif name not in _MAIN and name not in ("html", "body"):
            words = _WORD.findall(value)
            if any(w in _NAMES or w.startswith("comment") for w in words) or (not in_main and "header" in words):
                return True
    return False


def page_texts(page: str) -> list[tuple[int, str, str]]:
    """(kind, place, text) of each block of a page in order: MAIN within article or main, DROPPED within furniture, else OPEN.

    place names the block's elements. Scripts, styles and the like have no text, comments and tags neither. An article
    inside another one is a reader's comment, as HTML has it. Tags need not be closed: a closing tag ends what was
    opened within its element, article and main end open furniture, and the end of the page ends all.
    """
    out: list[tuple[int, str, str]] = []
    stack: list[tuple[str, bool, bool]] = []  # element, within furniture, within the main element
    pieces: list[str] = []
    state = [False, False]  # furniture, main

    def flush() -> None:
        if pieces:
            text = _WHITE.sub(" ", html.unescape("".join(pieces))).strip()
            pieces.clear()
            if text:
                kind = DROPPED if state[0] else MAIN if state[1] else OPEN
                out.append((kind, ">".join(s[0] for s in stack if s[0] not in _INLINE), text))

    def settle() -> None:
        state[0], state[1] = stack[-1][1:] if stack else (False, False)

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            pieces.append(page[at:])
            break
        if m.start() > at:
            pieces.append(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                pieces.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        inline = name in _INLINE
        if (m[1] or m[4]) == "/":
            if inline:
                pieces.append(" " if name in ("td", "th") else "")
            else:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    settle()
                    break
                if stack[k][0] in _MAIN and name not in _MAIN and name not in ("body", "html"):
                    break  # nothing within the article ends it
            continue
        if name in _RAW:
            close = re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            if name != "noscript" or close:
                at = close.end() if close else end
            continue
        if name in ("br", "hr", "img") or name in ("td", "th"):
            pieces.append(" ")
        if name in _VOID:
            if name == "hr":
                flush()
            continue
        if not inline:
            flush()
        if name in _MAIN and not state[1]:
            while stack and stack[-1][1]:  # furniture that was never closed
                stack.pop()
            settle()
        if name in _ENDS:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in _ENDS[name]:
                    del stack[k:]
                    settle()
                    break
                if stack[k][0] not in _INLINE:
                    break
        attributes = m[3] or ""
        if attributes.rstrip().endswith("/") and name not in _INLINE and ":" in name:
            continue
        furniture = state[0] or _furniture(name, attributes, state[1])
        stack.append((name, furniture, state[1] or (name in _MAIN and not furniture)))
        settle()
    flush()
    return out


def _hashed(token: str) -> int:
    return int.from_bytes(hashlib.blake2b(token.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") >> 1


def stream(texts: list[tuple[int, str, str]], known: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of what stands outside the article, and the number of each token's text: its place, then its words.

    Where the article stands there is a token that is like no other, so no run goes across it.
    """
    ids: list[int] = []
    owner: list[int] = []
    for k, (kind, place, text) in enumerate(texts):
        if kind == MAIN:
            if ids and ids[-1] != -1:
                ids.append(-1)
                owner.append(-1)
            continue
        for token in ("\0" + place, *text.split()):
            if (own := known.get(token)) is None:
                own = known[token] = _hashed(token)
            ids.append(own)
            owner.append(k)
    return np.array(ids, np.int64), np.array(owner, np.int64)


def suffix_array(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first `depth` tokens, by prefix doubling, and each place's rank; equal ranks share these tokens."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < depth:
        step = min(width, depth - width)
        after = np.full(len(rank), -1, np.int64)
        after[:-step] = rank[step:] if step < len(rank) else -1
        pairs = rank * (len(rank) + 1) + after + 1
        rank = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        width += step
    return np.argsort(rank, kind="stable"), rank


_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def run_keys(tokens: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit key for the n tokens from each place on."""
    t = tokens.astype(np.uint64)
    out = np.zeros(max(0, len(t) - n + 1), np.uint64)
    for k in range(n):
        out = (out ^ t[k : len(t) - n + 1 + k]) * _MULTIPLY
        out ^= out >> np.uint64(29)
    return out.astype(np.int64)


def _hosts(urls: list[str | None]) -> list[str]:
    return [re.split("[/?#]", u.split("://", 1)[1], maxsplit=1)[0].lower() if u and "://" in u else "" for u in urls]


def _intervals(pages: list[tuple[int, bytes, np.ndarray]], n: int):
    """Of some pages (page, row, tokens) of one host: each run of n tokens with the least and greatest page and the places that have it.

    The runs are the intervals of a suffix array in which suffixes share their first n tokens.
    """
    kept = [p for p in pages if len(p[2]) >= n]
    if not kept:
        return
    tokens = np.concatenate([np.concatenate([ids, [-2]]) for _, _, ids in kept])
    cut = np.flatnonzero(tokens < 0)  # ends of pages, and articles, are like no other token
    lengths = np.array([len(ids) + 1 for _, _, ids in kept])
    owner = np.repeat(np.arange(len(kept)), lengths)
    begin = np.cumsum(lengths) - lengths
    keys = run_keys(tokens, n)
    tokens[cut] = -1 - np.arange(len(cut))
    order, rank = suffix_array(tokens, n)
    cuts = np.concatenate([[0], np.cumsum(tokens < 0)])
    order = order[order < len(keys)]
    order = order[cuts[order + n] == cuts[order]]  # no run goes across a cut
    if not len(order):
        return
    page = np.array([p for p, _, _ in kept], np.int64)[owner[order]]
    first = np.flatnonzero(np.diff(rank[order], prepend=-1))
    low, high = np.minimum.reduceat(page, first), np.maximum.reduceat(page, first)
    for a, b, least, most in zip(first.tolist(), [*first[1:].tolist(), len(order)], low.tolist(), high.tolist(), strict=True):
        places = order[a:b]
        yield int(keys[places[0]]), least, most, [(kept[o][1], int(p - begin[o])) for o, p in zip(owner[places].tolist(), places.tolist(), strict=True)]


_RUNS = "run binary, low long, high long, places array<struct<row:binary,at:int>>"
_RUN_TYPES = pa.schema([("run", pa.binary()), ("low", pa.int64()), ("high", pa.int64()), ("places", pa.list_(pa.struct([("row", pa.binary()), ("at", pa.int32())])))])
BLOCK = 8 << 20  # bytes of pages whose suffix arrays are built at a time


def host_runs(rows: DataFrame, e: Extraction) -> DataFrame:
    """The runs of min_run tokens outside articles, once for each host and block of pages, with their places: run, low, high, places."""

    def search(batches):
        for b in blocks(batches, "html", BLOCK):
            by_host: dict[str, list] = {}
            known: dict[str, int] = {}
            for row, page, host, text in zip(b.column("row").to_pylist(), b.column("page").to_pylist(), _hosts(b.column("url").to_pylist()), b.column("html").to_pylist(), strict=True):
                by_host.setdefault(host, []).append((page, row, stream(page_texts(text), known)[0]))
            out: list[dict] = []
            for host, own in by_host.items():
                mark = _hashed(host).to_bytes(8, "little")
                for key, low, high, places in _intervals(own, e.min_run):
                    out.append({"run": mark + key.to_bytes(8, "little", signed=True), "low": low, "high": high, "places": [{"row": r, "at": at} for r, at in places]})
            yield pa.RecordBatch.from_pylist(out, _RUN_TYPES)
        tidy()

    return rows.mapInArrow(search, _RUNS)


def repeated(runs: DataFrame) -> DataFrame:
    """The runs that two or more distinct pages of a host have. Blocks' runs meet with map-side combining, one row a block for the commonest."""
    both = runs.groupBy("run").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return both.where("low < high").select("run")


def extract(pages: DataFrame, e: Extraction = Extraction()) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars, n_covered, n_marked.

    What stands outside article and main elements is searched: each block of pages has suffix arrays by host, and runs
    of tokens that distinct pages of the host share cover what they run over. A block outside the article is dropped
    if at least half of its words are covered (n_covered of them), or if its markup names it furniture (n_marked are
    dropped for that alone); the others, unique runs, stay. Blocks are in page order, joined by a line feed, with
    character references decoded and white space of all kinds made one space.

    What repeats inside an article stays: articles that are copies or quote each other would go otherwise. A null or
    empty html has an empty text; a null url, or one without a host, belongs to the host without name. Rows that repeat a page_id
    and url each have their result and are one page to the search. An empty table gives no rows; other columns are
    ignored. No host's pages meet in one task: only runs do, by host and run.
    """
    url, text = F.col("url").cast("string"), F.col("html").cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), F.coalesce(text, F.lit("")).alias("html"))
    row = F.concat(F.to_binary(F.lpad(F.hex(F.xxhash64("page_id", "url", "html")), 16, "0"), F.lit("hex")), F.to_binary(F.lpad(F.hex(F.xxhash64(F.lit(1), "html", "url", "page_id")), 16, "0"), F.lit("hex")))
    full = rows.where("html <> ''").withColumn("row", row)
    runs = stored(host_runs(full.withColumn("page", F.xxhash64("page_id", "url")), e), "html-runs")
    again = stored(repeated(runs), "html-repeated")
    places = join_spread(runs, again, "run").select(F.explode("places").alias("p"))
    covered = places.groupBy("p.row").agg(F.collect_list("p.at").alias("covered"))

    def pack(batches):
        """Pages are shuffled once, compressed by pages' own bytes better than shuffles are."""
        for b in batches:
            raw = [x.encode("utf-8", "surrogatepass") for x in b.column("html").to_pylist()]
            packed = [pa.compress(x, codec="zstd", asbytes=True) for x in raw]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("page_id"), b.column("url"), pa.array(packed, pa.binary()), pa.array([len(x) for x in raw], pa.int64())], ["row", "page_id", "url", "packed", "size"])

    def decide(batches):
        for b in blocks(batches, "packed", 1 << 20):
            out, n_covered, n_marked = [], [], []
            for packed, size, at in zip(*(b.column(c).to_pylist() for c in ("packed", "size", "covered")), strict=True):
                texts = page_texts(pa.decompress(packed, size, codec="zstd", asbytes=True).decode("utf-8", "surrogatepass"))
                ids, owner = stream(texts, {}) if at else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                hit = np.zeros(len(ids) + 1, np.int64)
                for k in set(at or []):
                    hit[k] += 1
                    hit[k + e.min_run] -= 1
                words = np.cumsum(hit)[:-1] > 0
                places_of = {k: words[owner == k][1:] for k in set(owner.tolist())}
                gone = {k for k, own in places_of.items() if k >= 0 and 2 * own.sum() >= len(own)}
                out.append("\n".join(t for k, (kind, _, t) in enumerate(texts) if kind == MAIN or (kind == OPEN and k not in gone)))
                n_covered.append(len(gone))
                n_marked.append(sum(kind == DROPPED and k not in gone for k, (kind, _, _) in enumerate(texts)))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string()), pa.array(n_covered, pa.int64()), pa.array(n_marked, pa.int64())], ["page_id", "url", "text", "n_covered", "n_marked"])
        tidy()

    thin = full.mapInArrow(pack, "row binary, page_id long, url string, packed binary, size long")
    joined = thin.join(covered, "row", "left").select("page_id", "url", "packed", "size", "covered")
    found = joined.mapInArrow(decide, "page_id long, url string, text string, n_covered long, n_marked long")
    none = F.lit(0).cast("long")
    empty = rows.where("html = ''").select("page_id", "url", F.lit("").alias("text"), none.alias("n_covered"), none.alias("n_marked"))
    return found.unionByName(empty).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_covered", "n_marked")
