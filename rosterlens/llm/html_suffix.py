"""Main text of web pages: marked articles, and a host-wide suffix array elsewhere.

A page is cut into blocks of text at block-level tags, and every block lies in one of
three regions: inside the page's article, inside something that names itself as not the
article (menus, headers, footers, sidebars, notices, adverts, forms, comments, hidden
parts), or unmarked. The article is what parsed ``article`` elements hold that don't lie
apart, or ``main`` where none holds text. All else that doesn't lie apart is
unmarked, however much or little it is: a headline in ``main`` before the article, a teaser,
a page without marks; so is what has a weak name (banner, legal, search) inside the article,
which may be one of its own parts.

The words of everything outside articles form one token stream per host, its pages laid
end to end, pages with the same host and content once, so that mirrors don't cover each
other. The host's suffix array is built in shards: a suffix is kept by its first ``depth``
tokens, equal ones of a batch of pages are one row with the pages counted (two kept by
name), rows are dealt by host and first three tokens, and each shard is sorted. Walking
down a shard, suffixes that share at least l tokens with their neighbours are a run, and
the largest l from ``tokens`` to ``depth`` whose run has ``least`` distinct pages is the
length of the longest repeat that a suffix starts. A bound on ``depth`` changes no result:
pages that share a longer stretch share those of its suffixes that lie in it, each of
``tokens`` or more, and these cover the stretch to its end. The union of a page's repeats covers its tokens:
unmarked blocks that are covered are the site's boilerplate and go, unique runs stay.

Other text inside a marked article always stays, also where it recurs on other pages: shared
passages and quotations are article text, and repeats alone would drop them.

Null html gives an empty text, a null url lies on the host without a name. Repeated rows
get a row each and count as one page. Truncated pages end where the text ends: open parts
run to the end of the page. Pages of any length take time and memory in proportion to it.
Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrowtext import Words, slices
from .store import materialise, table

TOKENS = 6  # of a repeat that counts as long
DEPTH = 8  # tokens of a suffix that are compared
LEAST = 3  # distinct pages: 2 or 3
COVERED = 0.8  # share of a block

ARTICLE, CHROME, PLAIN = 0, 1, 2

# Elements by their part in a page.
_RAW = "script|style|noscript|template|title|textarea|svg|iframe|select"
_APART = {"nav", "header", "footer", "aside", "form", "button", "dialog", "menu", "fieldset", "head"}
_BLOCK = {
    "p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "table", "tr", "thead", "tbody", "caption",
    "blockquote", "pre", "section", "article", "main", "hr", "figure", "figcaption", "address", "details", "summary", "body", "html",
} | _APART
_SPACE = {"br", "td", "th", "img", "wbr"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "source", "area", "base", "col", "embed", "track", "param"}
_NAMED = re.compile(
    r"ads?|ad(?:box|slot|unit|wrap|wrapper|container|banner)|adsbygoogle|adverts?|advertisements?|advertising|sponsors?|sponsored|promos?|promotions?|promoted|banner|sidebars?|side|menus?|menubar|nav|navs|navbar|navigation|navmenu|breadcrumbs?|footer|masthead"
    r"|comments?|commentlist|commentform|commenters?|disqus|repl(?:y|ies)|responses|discussion|cookies?|cookie(?:bar|banner|notice|consent)|consent|gdpr|notices?|alerts?|legal|copyright|disclaimer|newsletter|subscribe|signup|popup|modal|overlay"
    r"|share|sharing|social|related|recommended|widgets?|toolbar|pagination|pager|login|search|skip"
)
#: Names that may also be those of an article's own parts: inside it, the suffix array decides about what they hold.
_WEAK = re.compile("banner|side|legal|copyright|disclaimer|consent|gdpr|overlay|search|skip|pager|toolbar")
_HEADER = re.compile(r"(?:(?:site|page|top|main|global)[_-])?header")
#: Parts of a name that don't change what it names; others (has-, with-, no-, -layout) do.
_NEUTRAL = re.compile(
    r"\d*|site|page|top|main|global|local|primary|secondary|left|right|bottom|sticky|fixed|bar|box|slot|unit|wrap|wrapper|container|section|area|block|panel|row|column|col|inner|outer|header|heading|title|body|content|text|message"
    r"|list|item|items|link|links|button|buttons|btn|icons?|form|field|input|post|posts|entry|article|articles|stories|media|user|reader|blog|the|to|us|my|js"
)
_READERS = re.compile(r"comments?|commentlist|commentform|commenters?|disqus|repl(?:y|ies)|responses|discussion|related|recommended")
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}

_MARK = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


_UNSURE = 4


def _names(token: str, inside: bool) -> int:
    """Whether a class or id as a whole names something apart (1), or something that ``inside`` an article may be a part of it (``_UNSURE``)."""
    token = token.lower()
    if _HEADER.fullmatch(token):
        return 1
    parts = re.split("[-_]+", token)
    found = [x for x in parts if _NAMED.fullmatch(x)]
    if not found or not all(_NAMED.fullmatch(x) or _NEUTRAL.fullmatch(x) for x in parts):
        return 0
    return _UNSURE if inside and all(map(_WEAK.fullmatch, found)) else 1


@lru_cache(maxsize=4096)
def _named_apart(name: str, attributes: str, inside: bool) -> int:
    """0: no, 1: by a class or id, 2: by one of readers' or other articles, 3: by a role or as hidden, _UNSURE: by weak names alone."""
    if not attributes or name in ("body", "html"):
        return 0
    found, unsure = 0, False
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key in ("class", "id"):
            for token in value.split():
                kind = _names(token, inside)
                unsure |= kind == _UNSURE
                if kind == 1:
                    found = max(found, 2 if any(map(_READERS.fullmatch, re.split("[-_]+", token.lower()))) else 1)
        if (key == "role" and value.lower() in _ROLES) or key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return 3
        if key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return 3
    return found or _UNSURE * unsure


def _parse(page: str, spared: frozenset[int] = frozenset()) -> tuple[list[tuple[bool, bool, bool, str, bool]], dict[int, list[int]]]:
    """(apart, in an article, in main, text, weakly named) of a page's blocks; and of elements apart by class or id that are or hold an article or main: the place -> [characters in it, whether main, whether readers'].

    ``spared``: places of elements whose names don't count.
    """
    out: list[tuple[bool, bool, bool, str, bool]] = []
    parts: list[str] = []
    article = main = 0  # depths outside what lies apart
    held = 0  # depth of article and main elements in what lies apart
    apart: list[str] = []  # the open element that lies apart
    unsure, within = "", 0  # the open element of a weak name, and how many of its kind are open
    kind, place = 0, -1
    holders: dict[int, list[int]] = {}
    closes = 0
    end = 0

    def cut() -> None:
        nonlocal parts
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((bool(apart), article > 0, main > 0, text, within > 0))
                if held and kind in (1, 2):
                    holders[place][0] += len(text)
            parts = []

    def hold(name: str) -> None:
        nonlocal held
        if name in ("article", "main"):
            held += 1
            holders.setdefault(place, [0, 0, int(kind == 2)])[1] |= name == "main"

    for m in _MARK.finditer(page):
        if m.start() > end:
            parts.append(page[end : m.start()])
        end = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            continue
        closing, attributes = (m[2], m[4]) if m[3] else (m[5], m[7])
        if name in _BLOCK:
            cut()
        elif name in _SPACE:
            parts.append(" ")
        if within and not apart and name == unsure and (closing or not attributes.endswith("/")):
            if closing or name == "p":  # a paragraph ends where the next begins
                if within == 1:
                    cut()
                within -= 1
            else:
                within += 1
        if closing:
            if apart:
                held -= held > 0 and name in ("article", "main")
                if name == apart[0]:
                    closes -= 1
                    if not closes:
                        cut()
                        apart.clear()
            elif name in ("article", "main"):
                article -= name == "article" and article > 0
                main -= name == "main" and main > 0
                within *= article > 0 or main > 0
            continue
        if name in _VOID or attributes.endswith("/"):
            continue
        if apart:
            if name == apart[0]:
                closes += 1
            elif name == "p" and apart[0] == "p" or apart[0] == "head" and name == "body":
                apart.clear()
            if apart:
                hold(name)
            continue
        named = 0 if m.start() in spared else _named_apart(name, attributes, article > 0 or main > 0)
        if named == _UNSURE:
            if not within and name not in _VOID:
                cut()
                unsure, within = name, 1
            named = 0
        if name in _APART and not (name == "header" and (article or main)) or named:
            cut()
            apart.append(name)
            closes, held, place = 1, 0, m.start()
            kind = 3 if name in _APART else named
            hold(name)
        elif name == "article":
            article += 1
        elif name == "main":
            main += 1
    if end < len(page):
        parts.append(page[end:])
    cut()
    return out, holders


def blocks(page: str) -> list[tuple[int, str]]:
    """(region, text) of a page's blocks that hold text, in page order."""
    found, holders = _parse(page)
    free = sum(len(t) for apart, _, _, t, _ in found if not apart)
    marked = any((a or m) and not apart for apart, a, m, _, _ in found)
    spared = frozenset(p for p, (n, main, readers) in holders.items() if n and (main or not free or not (marked or readers) and n > free))
    if spared:
        found, _ = _parse(page, spared)
    holder = next((h for h in (1, 2) if any(b[h] and not b[0] for b in found)), 0)  # an article, else main
    return [(CHROME if b[0] else ARTICLE if holder and b[holder] and not b[4] else PLAIN, b[3]) for b in found]


_STREAM = "page long, content long, tokens binary, owners binary, page_id long, url string, html string"


def _tokens(texts: list[str]) -> list[np.ndarray]:
    """Hashes of 32 bits, never 0, of each text's words."""
    out = []
    for i, j, data, off in slices(pa.array(texts, pa.large_string())):
        w = Words(data, off)
        h = np.maximum(w.hash >> np.uint64(32), 1).astype(np.uint32)
        out += [h[w.first[d] : w.first[d + 1]] for d in range(j - i)]
    return out


def _streams(pages: DataFrame) -> DataFrame:
    """Tokens of everything outside a page's article; owners: the unmarked block of each, else -1, and the html, of pages that have unmarked blocks."""

    def run(batches):
        for batch in batches:
            outside, counts, contents, html = [], [], [], []
            for page in batch.column(2):
                page = page.as_py()
                found = blocks(page or "")
                html.append(page if any(r == PLAIN for r, _ in found) else None)
                outside += [(r, t) for r, t in found if r != ARTICLE]
                counts.append(len(outside))
                contents.append("\n".join(t for r, t in found if r != CHROME))
            words = _tokens([t for _, t in outside])
            content = np.concatenate([Words(x, o).content()[0] for _, _, x, o in slices(pa.array(contents, pa.large_string()))]) if contents else np.zeros(0, np.uint64)
            tokens, owners = [], []
            for start, end, open_ in zip([0, *counts], counts, html):
                own = words[start:end]
                tokens.append(np.concatenate([np.zeros(0, np.uint32), *own]).tobytes())
                plain = [r == PLAIN for r, _ in outside[start:end]]
                numbers = np.where(plain, np.cumsum(plain) - 1, -1).astype(np.int32) if plain else np.zeros(0, np.int32)
                owners.append(None if open_ is None else np.repeat(numbers, [len(x) for x in own]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(content.view(np.int64)), pa.array(tokens, pa.binary()), pa.array(owners, pa.binary()), batch.column(3), batch.column(4), pa.array(html, pa.string())],
                names=[f.split()[0] for f in _STREAM.split(", ")],
            )

    parsed = pages.select("page", "host", "html", "page_id", "url")
    kinds = _STREAM.replace("content long", "host long, content long")

    def with_host(batches):
        for batch in batches:
            for out in run([batch]):
                columns = list(out.columns)
                yield pa.RecordBatch.from_arrays([columns[0], batch.column(1), *columns[1:]], names=[f.split()[0] for f in kinds.split(", ")])

    return parsed.mapInArrow(with_host, kinds)


def _suffixes(tokens: np.ndarray, host: int, k: int, depth: int) -> np.ndarray:
    """Sort keys of the suffixes of at least ``k`` tokens, in text order: the host, then ``depth`` tokens in big-endian bytes, zeros behind the text's end."""
    n = max(0, len(tokens) - k + 1)
    out = np.zeros((n, depth + 2), ">u4")
    out[:, :2] = np.frombuffer(np.array([host], ">i8").tobytes(), ">u4")
    padded = np.concatenate([tokens, np.zeros(depth, np.uint32)])
    for d in range(depth):
        out[:, 2 + d] = padded[d : d + n]
    return np.ascontiguousarray(out).view(f"V{4 * depth + 8}")[:, 0] if n else np.zeros(0, f"V{4 * depth + 8}")


def _binary(keys: np.ndarray) -> pa.Array:
    """Keys of one size as an Arrow column."""
    size = keys.dtype.itemsize
    offsets = pa.py_buffer((np.arange(len(keys) + 1) * size).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, offsets, pa.py_buffer(keys.tobytes())])


_SUFFIX = "key binary, n long, lo long, hi long"


def _counted(streams: DataFrame, k: int, depth: int) -> DataFrame:
    """(key, n, lo, hi): distinct suffixes of some pages of a host, in how many they occur, and the first and last page by number."""

    def run(batches):
        for batch in batches:
            for a in range(0, len(batch), 2048):
                keys, owner = [np.zeros(0, f"V{4 * depth + 8}")], [np.zeros(0, np.int64)]
                for host, content, tokens in zip(*(batch.column(i).slice(a, 2048).to_pylist() for i in range(3)), strict=True):
                    own = _suffixes(np.frombuffer(tokens, np.uint32), host, k, depth)
                    keys.append(own)
                    owner.append(np.full(len(own), content))
                keys, owner = np.concatenate(keys), np.concatenate(owner)
                if not len(keys):
                    continue
                code = keys.view(">u8").reshape(len(keys), -1).astype(np.uint64)
                order = np.lexsort((owner, *code.T[::-1]))
                keys, owner, code = keys[order], owner[order], code[order]
                new = np.ones(len(keys), bool)
                new[1:] = (code[1:] != code[:-1]).any(axis=1)
                page = new.copy()
                page[1:] |= owner[1:] != owner[:-1]
                start = np.flatnonzero(new)
                last = np.append(start[1:], len(keys)) - 1
                yield pa.RecordBatch.from_arrays([_binary(keys[start]), pa.array(np.add.reduceat(page.astype(np.int64), start)), pa.array(owner[start]), pa.array(owner[last])], names=["key", "n", "lo", "hi"])

    return streams.select("host", "content", "tokens").mapInArrow(run, _SUFFIX)


def longest(rows: np.ndarray, n: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int, least: int, sure: int) -> tuple[np.ndarray, int, int]:
    """For sorted suffixes (host and tokens a row) the length of the longest repeat each starts, 0 for none; the first row from which the last runs are open, and the length up to which they are settled.

    ``sure``: the runs of the first row, up to this length, are known to have enough pages.
    """
    depth = rows.shape[1] - 2
    same = np.ones((len(rows), depth + 1), bool)
    same[1:, 0] = (rows[1:, :2] == rows[:-1, :2]).all(axis=1)
    same[1:, 1:] = (rows[1:, 2:] == rows[:-1, 2:]) & (rows[1:, 2:] != 0)
    common = np.logical_and.accumulate(same, axis=1)
    best, hold, settled = np.zeros(len(rows), np.int64), len(rows), depth
    for length in range(k, depth + 1):
        new = ~common[:, length]
        new[0] = True
        start = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        low, high = np.minimum.reduceat(lo, start)[run], np.maximum.reduceat(hi, start)[run]
        many = n >= least
        many |= ((lo != low) & (lo != high)) | ((hi != low) & (hi != high)) if least > 2 else low != high
        enough = np.logical_or.reduceat(many, start)
        enough[0] |= length <= sure
        best[enough[run] & (rows[:, 1 + length] != 0)] = length
        if settled == depth and hold == len(rows) and not enough[-1]:
            hold, settled = int(start[-1]), length - 1
    return best, hold, settled


def suffix_array(streams: DataFrame, k: int = TOKENS, depth: int = DEPTH, least: int = LEAST) -> DataFrame:
    """(key, length) of the suffixes that start a repeat: those of ``streams(host, content, tokens)`` sorted in shards, and runs of common prefixes walked."""
    if least not in (2, 3) or not 3 <= k <= depth or depth % 2:
        raise ValueError("least must be 2 or 3, tokens 3 to depth, and depth even")
    width = 4 * depth + 8

    def walk(batches):
        held = None  # rows whose runs may go on, whether they have been given out, settled length
        for batch in batches:
            given = np.frombuffer(b"".join(batch.column(0).to_pylist()), ">u4").reshape(len(batch), -1)
            n, lo, hi = (np.asarray(batch.column(i)) for i in (1, 2, 3))
            done, sure = np.zeros(len(given), bool), 0
            if held is not None:
                given, n, lo, hi, done = (np.concatenate(x) for x in zip(held[0], (given, n, lo, hi, done), strict=True))
                sure = held[1]
            if not len(given):
                continue
            best, hold, settled = longest(given, n, lo, hi, k, least, sure)
            give = (best > 0) & ~done
            give[hold:] = False
            yield out(given[give], best[give])
            if hold == len(given):  # every run has its pages: the last row stays for comparison
                hold = len(given) - 1
                done[hold] = True
            held = tuple(x[hold:].copy() for x in (given, n, lo, hi, done)), settled
        if held is not None:
            best, _, _ = longest(*held[0][:4], k, least, held[1])
            give = (best > 0) & ~held[0][4]
            yield out(held[0][0][give], best[give])

    def out(rows, best):
        return pa.RecordBatch.from_arrays([_binary(np.ascontiguousarray(rows, ">u4").view(f"V{width}")[:, 0] if len(rows) else np.zeros(0, f"V{width}")), pa.array(best.astype(np.int32))], names=["key", "length"])

    shard = F.expr("xxhash64(substring(key, 1, 20))")
    dealt = _counted(streams, k, depth).withColumn("shard", shard).repartition("shard")
    distinct = dealt.groupBy("shard", "key").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return distinct.sortWithinPartitions("shard", "key").select("key", "n", "lo", "hi").mapInArrow(walk, "key binary, length int")


def _covered(streams: DataFrame, k: int, depth: int, least: int, share: float) -> DataFrame:
    """(page, dropped): the unmarked blocks of a page that the host's repeats cover."""
    once = streams.groupBy("host", "content").agg(F.min(F.struct("page", "tokens")).alias("page")).select("host", "content", "page.tokens")
    repeats = materialise(suffix_array(once, k, depth, least))
    open_ = streams.filter("html is not null").select("page", "host", "tokens", "owners").dropDuplicates(["page"])

    def ask(batches):
        for batch in batches:
            for page, host, tokens in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                keys = _suffixes(np.frombuffer(tokens, np.uint32), host, k, depth)
                for a in range(0, len(keys), 8192):
                    own = keys[a : a + 8192]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), page)), pa.array(np.arange(a, a + len(own), dtype=np.int32)), _binary(own)], names=["page", "at", "key"])

    def drop(batches):
        for batch in batches:
            gone = []
            for owners, hits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                owners = np.frombuffer(owners, np.int32)
                marks = np.zeros(len(owners) + 1, np.int64)
                at = np.array([h["at"] for h in hits], np.int64)
                np.add.at(marks, at, 1)
                np.add.at(marks, np.minimum(at + [h["length"] for h in hits], len(owners)), -1)
                inside = np.cumsum(marks[:-1]) > 0
                some = owners >= 0
                size, hit = np.bincount(owners[some]), np.bincount(owners[some], inside[some])
                gone.append(np.flatnonzero((size > 0) & (hit >= share * size)).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gone, pa.list_(pa.int32()))], names=["page", "dropped"])

    asked = open_.select("page", "host", "tokens").mapInArrow(ask, "page long, at int, key binary")
    hits = asked.join(repeats, "key").groupBy("page").agg(F.collect_list(F.struct("at", "length")).alias("hits"))
    return open_.select("page", "owners").join(hits, "page").mapInArrow(drop, "page long, dropped array<int>")


_TEXT = "page_id long, url string, text string, n_chars long"


def _texts(pages: DataFrame, open_: bool) -> DataFrame:
    """Texts of the pages (page_id, url, html) without unmarked blocks, or of those with some (and ``dropped``), whose other unmarked blocks stay."""

    def run(batches):
        for batch in batches:
            dropped = batch.column(3).to_pylist() if open_ else [None] * len(batch)
            rows, out = [], []
            for i, (page, gone) in enumerate(zip(batch.column(2), dropped, strict=True)):
                found = blocks(page.as_py() or "")
                if any(r == PLAIN for r, _ in found) != open_:
                    continue
                kept, number = [], 0
                for region, text in found:
                    if region == ARTICLE or region == PLAIN and number not in (gone or ()):
                        kept.append(text)
                    number += region == PLAIN
                rows.append(i)
                out.append("\n\n".join(kept))
            own = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, _TEXT)


def main_text(pages: DataFrame, tokens: int = TOKENS, least: int = LEAST, share: float = COVERED, depth: int = DEPTH) -> DataFrame:
    """One row per row of ``pages(page_id, url, html)``: page_id, url, text, n_chars."""
    given = pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html")
    keyed = given.selectExpr("*", "xxhash64(page_id, url, html) page", "xxhash64(coalesce(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)), '')) host")
    streams = materialise(_streams(keyed))
    plain = streams.filter("html is not null").join(_covered(streams, tokens, depth, least, share), "page", "left")
    return _texts(given, False).unionByName(_texts(plain.select("page_id", "url", "html", "dropped"), True))


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
