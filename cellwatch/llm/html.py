"""Main text of web pages with suffix arrays of hosts.

All tokens of a page are searched, its articles too; they are streams, broken where an article stands. First
each run of ``RUN`` tokens is known by an anchor, the least hash of the ``ANCHOR``-grams inside it: equal runs have equal
anchors, and a third of the tokens are one. An anchor that no second page has rules its runs out; a bit set of the
others, bounded in size, leaves the stretches of each page that may repeat, and lets some more through, which
changes no result. Pages are read in shares of bounded size; the stretches of a share are one
sequence with words that are told apart by host, its suffix array (prefix doubling, vectorized) puts equal substrings next to
each other, and the common prefixes of neighbours from different pages are the substrings that repeat. Each
different run leaves a share as one packed hash that says whether it stands on two pages there; met with those of all
shares, a run that stands on two pages of a host is repeated, wherever they are, and a bit for each goes back to
the share. Tokens inside repeated
runs are covered, and a stretch of them is a long substring repeated across pages (``repeats``). Pages
with equal blocks are one page. Runs, hosts and pages have 64-bit hashes.

Cover gives the text of every page by one rule, after which structure checks it:

* a page's articles (its own, and cards that tell of others) stay but for those that are covered whole, if another at
  least as long is not. So the only article of a page stays whole, and copies of one article on many pages
  are articles, not boilerplate;
* on a page without an article its tokens that are not covered, the unique runs, stay;
* inside menus, headers, footers, asides, forms, adverts, notices or comments tokens go, covered or not:
  such blocks also stand on one page only.

Defined results: null, empty and textless pages give an empty text; rows repeat as they come; a
null URL is a host of its own; a very long page is a share of its own; other columns are dropped; an
empty table gives an empty one.
"""

from __future__ import annotations

import bz2
import hashlib
import json
import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch.sources.scratch import materialize

from .common import mix, utf8, word_hashes

#: Tokens of a run that count as repeated, and tokens of a share.
RUN, SHARE = 8, 1 << 18
#: Tokens of an anchor; anchors that are sorted at once; bits a bucket of them has at most (all: 64 MB); buckets of anchors
#: and of runs, as powers of two.
ANCHOR, ANCHORS, BITS, BUCKETS, RUN_BUCKETS = 3, 1 << 20, 1 << 17, 12, 8
_SPACES = np.arange(256) == 0x20

MARK = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
                  r"|<[!?][^>]*>|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "canvas", "title"}
CHROME = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "head"}
MAIN = {"article", "main"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub",
          "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Opening one of these ends an open element of the second kind.
CLOSES = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
BOILER = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|banner|footer|sidebar|aside|widgets?|"
    r"ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed)?|promo(?:tion)?|cookies?|consent|gdpr|notices?|"
    r"alert|newsletter|subscribe|signup|login|popup|modal|overlay|share|sharing|social|related|recommended|"
    r"comments?|commentlist|disqus|replies|respond|pagination|pager|skip|toolbar|search|form)(?:$|[\s_-])", re.I)
LAYOUT = re.compile(r"(?:with|has|no|layout|page|content|site|main|is)[-_]", re.I)
HEADING = re.compile(r"(?:^|[_-])header$", re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar",
         "alertdialog"}
SPACE = re.compile(r"\s+")


def _zone(tag: str, attributes: str, zone: str) -> str:
    """Where the children of an element stand: once in chrome, always in chrome."""
    if zone == "chrome" or tag in CHROME or tag == "header" and zone != "main":
        return "chrome"
    if attributes:
        own = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
        # a wrapper that only tells the page's layout is none of what it names
        names = " ".join(n for n in f"{own.get('class', '')} {own.get('id', '')}".split() if not LAYOUT.match(n)
                         and not (zone == "main" and HEADING.search(n)))
        if (own.get("role", "").lower() in ROLES or "hidden" in own or own.get("aria-hidden") == "true"
                or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", own.get("style", "")))\
                or tag not in ("body", "html", "article", "main") and BOILER.search(names):
            return "chrome"
        if own.get("role") == "main" or own.get("itemprop") == "articleBody":
            return "main"
    return "main" if tag in MAIN else zone


def blocks(html: str) -> list[tuple[str, str]]:
    """(text, zone) of a page's blocks in order; zone is main, open or chrome. Where a page has several
    articles, they are main1, main2 and so on; a main element is one apart from the articles inside."""
    out: list[tuple[str, str, int]] = []
    parts: list[str] = []
    # tag, zone and, in main, which article
    stack: list[tuple[str, str, int]] = [("", "open", 0)]
    open_tags: Counter[str] = Counter()
    at, size, articles = 0, len(html), 0

    def end() -> None:
        if parts:
            text = SPACE.sub(" ", unescape("".join(parts))).strip()
            parts.clear()
            if text:
                out.append((text, *stack[-1][1:]))

    while at < size:
        found = MARK.match(html, at)
        at = found.end()
        tag = found[3]
        if tag is None:
            piece = found[0]
            if piece[0] != "<" or piece == "<":
                parts.append(piece)
            elif found[1]:
                parts.append(found[1])
            continue
        tag = tag.lower()
        if found[2]:
            if tag not in INLINE:
                end()
            if not open_tags[tag]:
                continue
            depth = len(stack) - 1
            while stack[depth][0] != tag:
                depth -= 1
            if stack[depth][1] != stack[depth - 1][1]:
                end()
            open_tags.subtract(t for t, _, _ in stack[depth:])
            del stack[depth:]
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            if not found[4].rstrip().endswith("/") or tag in ("script", "style", "title"):
                at = close.end() if close else size
            continue
        if tag not in INLINE:
            end()
        if tag in VOID or found[4].rstrip().endswith("/"):
            continue
        while len(stack) > 1 and stack[-1][0] in CLOSES.get(tag, ()):
            open_tags[stack.pop()[0]] -= 1
        if tag not in INLINE and stack[-1][0] == "p":
            open_tags[stack.pop()[0]] -= 1
        zone = _zone(tag, found[4], stack[-1][1])
        if zone != stack[-1][1]:
            end()
        article = stack[-1][2]
        if zone == "main" and (stack[-1][1] != "main" or tag == "article" and not open_tags[tag]):
            articles += 1
            article = articles
        stack.append((tag, zone, article))
        open_tags[tag] += 1
    end()
    several = len({article for _, zone, article in out if zone == "main"}) > 1
    return [(text, f"main{article}" if several and zone == "main" else zone) for text, zone, article in out]


def suffix_array(tokens: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of all suffixes, and for each power of two the class of every position: equal classes are
    equal substrings of so many tokens. Doubling ends when all classes differ."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    ranks, step = [rank], 1
    order = np.argsort(rank, kind="stable")
    while len(rank) and rank.max() < len(rank) - 1:
        after = np.zeros(len(rank), np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (len(rank) + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(len(rank), np.int64)
        new[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        rank, step = new, step * 2
        ranks.append(rank)
    return order, ranks


def common_prefixes(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """How many tokens each suffix shares with the one before it in the array (0 for the first)."""
    n = len(order)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    a, b, long_ = order[:-1].copy(), order[1:].copy(), np.zeros(n - 1, np.int64)
    for height in range(len(ranks) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = inside & (ranks[height][np.minimum(a, n - 1)] == ranks[height][np.minimum(b, n - 1)])
        step = same * (1 << height)
        a, b, long_ = a + step, b + step, long_ + step
    out[1:] = long_
    return out


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def page_hash(some: list[tuple[str, str]]) -> int:
    return _hash("\n".join(f"{zone} {text}" for text, zone in some))


def _run_hashes(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of the runs of ``RUN`` word hashes that begin at ``at``."""
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(RUN):
            out = mix(out + words[at + k], k)
    return out.view(np.int64)


def streams(some: list[tuple[str, str]]) -> list[list[str]]:
    """The tokens of a page, broken where an article begins or ends."""
    out: list[list[str]] = [[]]
    last = ""
    for text, zone in some:
        if zone != last and (zone.startswith("main") or last.startswith("main")):
            out.append([])
        last = zone
        out[-1] += text.split(" ")
    return [s for s in out if s]


def joined(share: list[tuple[int, list[list[str]]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (host, streams) of some pages: their tokens as numbers in one sequence, with a different negative
    number after each stream, the page each belongs to, and the hash of each number's word. Words of
    different hosts differ."""
    words: dict[tuple[int, str], int] = {}
    tokens, page, breaks = [], [], 0
    for i, (host, some) in enumerate(share):
        for stream in some:
            breaks += 1
            tokens += [words.setdefault((host, w), len(words)) for w in stream]
            tokens.append(-breaks)
        page += [i] * (len(tokens) - len(page))
    return np.array(tokens, np.int64), np.array(page, np.int64), np.array([_hash(w) for _, w in words], np.uint64)


def share_runs(share: list[tuple[int, int, list[list[str]]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of (host, page, streams) of some pages: host, hash, least and greatest page of every different run."""
    tokens, of, hashes = joined([(host, some) for host, _, some in share])
    ends = np.concatenate([[0], np.cumsum(tokens < 0)])
    at = np.arange(max(len(tokens) - RUN + 1, 0))
    at = at[ends[at + RUN] == ends[at]]
    if not len(at):
        return (np.empty(0, np.int64),) * 4
    # neighbours in the suffix array with a common prefix of a run or more hold the same run
    order, ranks = suffix_array(tokens)
    runs = np.empty(len(tokens), np.int64)
    runs[order] = np.cumsum(common_prefixes(order, ranks) < RUN)
    by = np.argsort(runs[at], kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(runs[at][by]) != 0]))
    hosts, pages = (np.array([x[i] for x in share], np.int64) for i in (0, 1))
    names, first = pages[of[at[by]]], at[by[starts]]
    return (hosts[of[first]], _run_hashes(hashes[np.maximum(tokens, 0)], first),
            np.minimum.reduceat(names, starts), np.maximum.reduceat(names, starts))


def covered(some: list[list[str]], repeated: np.ndarray) -> list[np.ndarray]:
    """Which tokens of each stream of a page lie in a repeated run."""
    out = []
    for stream, runs in zip(some, streams_runs(some)):
        if not len(repeated):
            out.append(np.zeros(len(stream), bool))
            continue
        at = np.flatnonzero(np.isin(runs, repeated))
        marks = np.zeros(len(stream) + 1, np.int64)
        np.add.at(marks, at, 1)
        np.add.at(marks, at + RUN, -1)
        out.append(np.cumsum(marks[:-1]) > 0)
    return out


def _run_keys(hosts: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """One hash of host and run."""
    with np.errstate(over="ignore"):
        return mix(runs.astype(np.int64).view(np.uint64) + mix(hosts.astype(np.int64).view(np.uint64), 1))


def streams_runs(some: list[list[str]]) -> list[np.ndarray]:
    """The hash of the run at each place of each stream. All at once: short streams would cost more in calls."""
    known = {w: _hash(w) for w in {w for stream in some for w in stream}}
    words = np.fromiter((known[w] for stream in some for w in stream), np.uint64)
    sizes = np.array([len(stream) for stream in some], np.int64)
    ends, places = np.cumsum(sizes), np.maximum(sizes - RUN + 1, 0)
    at = np.repeat(ends - sizes - np.cumsum(places) + places, places) + np.arange(places.sum())
    return np.split(_run_hashes(words, at), np.cumsum(places)[:-1])


def _kept(zones: list[str], sizes: list[int], again: np.ndarray) -> np.ndarray:
    """Which tokens of a page cover leaves; ``zones`` and ``sizes`` are those of its parts. Without an article: open tokens that are
    not covered. Of articles: all but those that are covered whole and no longer than one that is not."""
    spans = list(zip(zones, np.cumsum([0, *sizes[:-1]]).tolist(), sizes))
    out = np.zeros(sum(sizes), bool)
    articles = Counter()
    for zone, _, size in spans:
        if zone.startswith("main"):
            articles[zone] += size
    if not articles:
        for zone, at, size in spans:
            if zone == "open":
                out[at:at + size] = ~again[at:at + size]
        return out
    own = {zone for zone, at, size in spans if zone in articles and not again[at:at + size].all()}
    longest = max((articles[z] for z in own), default=0)
    for zone, at, size in spans:
        out[at:at + size] = zone in articles and (zone in own or articles[zone] > longest)
    return out


def parts(some: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The blocks of a page, neighbours of one zone joined."""
    return [(" ".join(text for text, _ in group), zone) for zone, group in groupby(some, lambda x: x[1])]


def main_texts(pages: list[str]) -> list[str]:
    """Main text of each page of one host."""
    read = [blocks(p) for p in pages]
    _, run, lo, hi = share_runs([(0, _signed(page_hash(some)), streams(some)) for some in read])
    repeated, out = run[lo != hi], []
    for some in read:
        words = [w for stream in streams(some) for w in stream]
        again = np.concatenate([np.empty(0, bool), *covered(streams(some), repeated)])
        kept = _kept([zone for _, zone in some], [text.count(" ") + 1 for text, _ in some], again)
        out.append(" ".join(w for w, k in zip(words, kept) if k))
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _hashed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of pages (host, zones and texts of parts): the stream and the page of each token, where each run begins, and
    the run's anchor. Both are numbered within the batch."""
    texts, zones = batch.column("texts"), batch.column("zones")
    page = np.repeat(np.arange(batch.num_rows), np.diff(texts.offsets.to_numpy()))
    data, offsets = utf8(texts.flatten())
    main = np.array([z.startswith("main") for z in zones.flatten().to_pylist()], bool)
    names = np.unique(np.array(zones.flatten().to_pylist(), str), return_inverse=True)[1] if len(main) else np.empty(0, np.int64)
    new = np.ones(len(main), bool)
    new[1:] = (page[1:] != page[:-1]) | (names[1:] != names[:-1]) & (main[1:] | main[:-1])
    words, part = word_hashes(data, offsets, _SPACES)
    stream, page = np.cumsum(new)[part], page[part]
    at = np.arange(max(len(words) - RUN + 1, 0))
    at = at[stream[at] == stream[at + RUN - 1]]
    if not len(at):
        return stream, page, at, np.empty(0, np.uint64)
    hosts = batch.column("host").to_numpy(zero_copy_only=False).view(np.uint64)
    with np.errstate(over="ignore"):
        grams = np.zeros(len(words) - ANCHOR + 1, np.uint64)
        for k in range(ANCHOR):
            grams = mix(grams + words[k:len(words) - ANCHOR + 1 + k], k)
        least = grams[at]
        for k in range(1, RUN - ANCHOR + 1):
            least = np.minimum(least, grams[at + k])
        return stream, page, at, mix(least + hosts[page[at]])


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few pages, so that work arrays stay small."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            yield batch.slice(at, 200)


def _inside(at: np.ndarray, border: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the stretches begin and end that runs at ``at`` cover; ``border`` says before which tokens a stream begins."""
    steps = np.bincount(at, minlength=len(border)) - np.bincount(at + RUN, minlength=len(border))
    inside = np.concatenate([[False], np.cumsum(steps) > 0])
    return np.flatnonzero(inside[1:] & (~inside[:-1] | border)), np.flatnonzero(inside[:-1] & (~inside[1:] | border))


def _bucket(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of anchors: the bucket, their first bits, and the next 24."""
    return (keys >> np.uint64(64 - BUCKETS)).astype(np.int64), (keys >> np.uint64(40 - BUCKETS)) & np.uint64((1 << 24) - 1)


def _run_ends(keys: np.ndarray) -> np.ndarray:
    """Where the buckets of sorted runs end, from 0."""
    return np.searchsorted(keys >> np.uint64(64 - RUN_BUCKETS), np.arange((1 << RUN_BUCKETS) + 1, dtype=np.uint64))


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` lower bytes of each value, a row each."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def _unpacked(some: list[bytes], width: int) -> np.ndarray:
    wide = np.zeros((sum(map(len, some)) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(b"".join(some), np.uint8).reshape(-1, width)
    return wide.view("<u8").ravel()


def _shared_anchors(pages: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A bit set of the anchors that stand on two pages: its bytes, and where each bucket begins and its bits less one.
    Anchors travel as three bytes in their bucket; equal ones only set a bit too many."""
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def done() -> pa.RecordBatch:
            keys = np.sort(np.concatenate(held))
            # two of each tell as much as more
            thrice = np.zeros(len(keys), bool)
            thrice[2:] = keys[2:] == keys[:-2]
            bucket, rest = _bucket(keys[~thrice])
            ends = np.searchsorted(bucket, np.arange((1 << BUCKETS) + 1))
            full = np.flatnonzero(np.diff(ends))
            bytes_ = _packed(rest, 3).tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([bytes_[3 * ends[b]:3 * ends[b + 1]] for b in full], pa.binary())],
                ["bucket", "anchors"])

        for batch in _few(batches):
            _, page, at, keys = _hashed(batch)
            if len(keys):
                # neighbouring runs mostly have the same anchor
                new = np.ones(len(keys), bool)
                new[1:] = (keys[1:] != keys[:-1]) | (page[at[1:]] != page[at[:-1]])
                held.append(keys[new])
            if sum(map(len, held)) > ANCHORS:
                yield done()
                held.clear()
        if held:
            yield done()

    def shared(table: pa.Table) -> pa.Table:
        rest = np.sort(_unpacked(table.column("anchors").to_pylist(), 3))
        rest = np.unique(rest[1:][rest[1:] == rest[:-1]])
        size = min(BITS, 1 << max(6, (64 * len(rest)).bit_length()))
        bits = np.zeros(size, bool)
        bits[rest & np.uint64(size - 1)] = True
        return pa.table({"bucket": table.column("bucket")[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]},
                        pa.schema([("bucket", pa.int32()), ("bits", pa.binary())]))

    rows = pages.select("host", "zones", "texts").mapInArrow(dealt, "bucket int, anchors binary")
    sets = {r.bucket: bytes(r.bits) for r in rows.groupBy("bucket").applyInArrow(shared, "bucket int, bits binary").collect()}
    # a bucket without anchors has the first eight bits, which are zero
    first, last, at = np.zeros(1 << BUCKETS, np.int64), np.full(1 << BUCKETS, 7, np.uint64), 1
    for bucket, bits in sets.items():
        first[bucket], last[bucket] = at, 8 * len(bits) - 1
        at += len(bits)
    return np.frombuffer(b"\0" + b"".join(sets.values()), np.uint8), first, last


def searched(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All pages read, and the different ones that have a repeated run. A page: page_id, url, host, page (hash
    of its blocks), zones and texts of its parts. A different one: host, page, zones and sizes of its parts, ``starts`` and
    ``streams``, the place and the text of its stretches, and ``cover``, where tokens in repeated runs begin
    and end."""
    kind = pages.schema["page_id"].dataType.simpleString()
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?([^/?#]*)", 1))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.xxhash64(host).alias("host"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 32
        for some in _few(batches):
            parsed = [blocks(h) for h in some.column(2).to_pylist()]
            joined_ = [parts(p) for p in parsed]
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), pa.array(np.arange(row, row + len(parsed))), some.column(3),
                 pa.array([_signed(page_hash(p)) for p in parsed], pa.int64()),
                 pa.array([[zone for _, zone in p] for p in joined_], pa.list_(pa.string())),
                 pa.array([[text for text, _ in p] for p in joined_], pa.list_(pa.string()))],
                ["page_id", "url", "row", "host", "page", "zones", "texts"])
            row += len(parsed)

    known = materialize(rows.mapInArrow(
        read, f"page_id {kind}, url string, row bigint, host bigint, page bigint, zones array<string>, texts array<string>"), "pages")
    # equal pages are one; a thin table tells which, so that pages are shuffled only where copies are many
    copies = materialize(known.groupBy("host", "page").agg(F.count("*").alias("n"), F.min("row").alias("first")).where("n > 1")
                         .select("host", "page", "first"), "copies")
    different = known.join(copies, ["host", "page"], "left").where("first IS NULL OR row = first").select(
        "host", "page", "zones", "texts")
    bits, first, last = _shared_anchors(different)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, share = TaskContext.get().partitionId() << 32, 0, []

        def done() -> pa.RecordBatch:
            data = bz2.compress(json.dumps(share, ensure_ascii=False).encode())
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([data], pa.binary())], ["share", "pages"])

        for batch in _few(batches):
            stream, page, at, keys = _hashed(batch)
            bucket, rest = _bucket(keys)
            bit = rest & last[bucket]
            at = at[(bits[first[bucket] + (bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            border = np.zeros(len(stream) + 1, bool)
            border[1:-1] = stream[1:] != stream[:-1]
            starts, ends = _inside(at, border)
            some, cuts = np.unique(page[starts], return_index=True)
            origin = np.searchsorted(page, some)
            for i, x, y, zero in zip(some.tolist(), cuts, [*cuts[1:], len(starts)], origin):
                texts = batch.column("texts")[i].as_py()
                words = " ".join(texts).split(" ")
                a, b = (starts[x:y] - zero).tolist(), (ends[x:y] - zero).tolist()
                size = sum(b) - sum(a) + len(a)
                if share and held + size > SHARE:
                    yield done()
                    number, held, share = number + 1, 0, []
                held += size
                share.append({"host": batch.column("host")[i].as_py(), "page": batch.column("page")[i].as_py(),
                              "zones": batch.column("zones")[i].as_py(), "sizes": [t.count(" ") + 1 for t in texts],
                              "starts": a, "streams": [" ".join(words[c:d]) for c, d in zip(a, b)]})
        if share:
            yield done()

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, data in (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))):
            share = json.loads(bz2.decompress(data))
            of, run, lo, hi = share_runs([(p["host"], p["page"], [s.split(" ") for s in p["streams"]]) for p in share])
            keys = _run_keys(of, run)
            order = np.argsort(keys)
            keys, twice = keys[order], (lo != hi)[order]
            ends = _run_ends(keys)
            full, bytes_ = np.flatnonzero(np.diff(ends)), _packed(keys, 8 - RUN_BUCKETS // 8)
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array(np.full(len(full), number)),
                 pa.array([bytes_[ends[b]:ends[b + 1]].tobytes() for b in full], pa.binary()),
                 pa.array([np.packbits(twice[ends[b]:ends[b + 1]]).tobytes() for b in full], pa.binary())],
                ["bucket", "share", "runs", "twice"])

    def met(table: pa.Table) -> pa.Table:
        some = table.column("runs").to_pylist()
        width = 8 - RUN_BUCKETS // 8
        sizes = [len(x) // width for x in some]
        again = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=n) for t, n in
                                zip(table.column("twice").to_pylist(), sizes)])
        _, of, times = np.unique(_unpacked(some, width), return_inverse=True, return_counts=True)
        again = (times + np.bincount(of, again) > 1)[of]
        back = [np.packbits(x).tobytes() if x.any() else None for x in np.split(again, np.cumsum(sizes)[:-1])]
        return pa.table({"share": table.column("share"), "bucket": table.column("bucket"), "again": pa.array(back, pa.binary())})

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, bits_ in (row for batch in batches for row in zip(*(batch.column(n).to_pylist() for n in ("pages", "told")))):
            share = json.loads(bz2.decompress(data))
            streams_ = [s.split(" ") for p in share for s in p["streams"]]
            page = np.repeat(np.arange(len(share)), [len(p["streams"]) for p in share])
            hashes, sizes = streams_runs(streams_), np.array([len(s) for s in streams_])
            places, begins = sizes - RUN + 1, np.cumsum(sizes) - sizes
            hosts = np.array([p["host"] for p in share])[np.repeat(page, places)]
            keys, of = np.unique(_run_keys(hosts, np.concatenate(hashes)), return_inverse=True)
            ends = _run_ends(keys)
            again = np.zeros(len(keys), bool)
            for x in bits_:
                a, b = ends[x["bucket"]], ends[x["bucket"] + 1]
                again[a:b] = np.unpackbits(np.frombuffer(x["again"], np.uint8), count=b - a)
            at = np.repeat(begins - np.cumsum(places) + places, places) + np.arange(places.sum())
            border = np.zeros(sizes.sum() + 1, bool)
            border[begins] = True
            a, b = _inside(at[again[of]], border)
            stream = np.searchsorted(begins, a, "right") - 1
            shift = np.array([x for p in share for x in p["starts"]])[stream] - begins[stream]
            cover = np.stack([a + shift, b + shift], 1)
            some, cuts = np.unique(page[stream], return_index=True)
            rows_ = [share[i] for i in some]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([p[name] for p in rows_], kind_) for name, kind_ in page_columns.items()),
                 pa.array([x.ravel() for x in np.split(cover, cuts[1:])], pa.list_(pa.int32()))], [*page_columns, "cover"])

    page_columns = {"host": pa.int64(), "page": pa.int64(), "zones": pa.list_(pa.string()), "sizes": pa.list_(pa.int32()),
                    "starts": pa.list_(pa.int32()), "streams": pa.list_(pa.string())}
    shares = materialize(different.mapInArrow(stretches, "share bigint, pages binary"), "stretches")
    again = shares.mapInArrow(runs, "bucket int, share bigint, runs binary, twice binary").groupBy("bucket").applyInArrow(
        met, "share bigint, bucket int, again binary").where("again IS NOT NULL")
    answers = materialize(again.groupBy("share").agg(F.collect_list(F.struct("bucket", "again")).alias("told")), "repeated")
    return known, shares.join(answers, "share").select("pages", "told").mapInArrow(
        told, "host bigint, page bigint, zones array<string>, sizes array<int>, starts array<int>, streams array<string>, "
              "cover array<int>")


def repeats(pages: DataFrame) -> DataFrame:
    """(host, text, n_tokens, n_pages): the long substrings of the streams that cover makes of each host, and on
    how many of its different pages each stands."""
    found = searched(pages)[1].select("host", "starts", "streams", "cover")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for of, starts, some, cover in zip(*(c.to_pylist() for c in batch.columns)):
                texts = set()
                for a, b in zip(cover[::2], cover[1::2]):
                    k = bisect(starts, a) - 1
                    texts.add(" ".join(some[k].split(" ")[a - starts[k]:b - starts[k]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([of] * len(texts), pa.int64()), pa.array(sorted(texts), pa.string())], ["host", "text"])

    return found.mapInArrow(run, "host bigint, text string").groupBy("host", "text").agg(F.count("*").alias("n_pages")).select(
        "host", "text", F.size(F.split("text", " ")).cast("long").alias("n_tokens"), "n_pages")


def extract(pages: DataFrame) -> DataFrame:
    """The digest of the contract: page_id, url, text, n_chars."""
    kind = pages.schema["page_id"].dataType.simpleString()
    known, different = searched(pages)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            out: list[list] = [[], [], []]
            for of, page, zones, sizes, cover in zip(*(c.to_pylist() for c in batch.columns)):
                again = np.zeros(sum(sizes), bool)
                for a, b in zip(cover[::2], cover[1::2]):
                    again[a:b] = True
                kept = _kept(zones, sizes, again)
                if not np.array_equal(kept, _kept(zones, sizes, np.zeros(len(again), bool))):
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], kept, [False]])))
                    for column, value in zip(out, (of, page, edges.tolist())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.list_(pa.int32())))],
                                             ["host", "page", "kept"])

    def text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            texts = []
            for zones, some, edges in zip(*(batch.column(n).to_pylist() for n in ("zones", "texts", "kept"))):
                if edges is None:
                    articles = any(z.startswith("main") for z in zones)
                    texts.append(" ".join(t for t, z in zip(some, zones) if (z.startswith("main") if articles else z == "open")))
                else:
                    words = " ".join(some).split(" ")
                    texts.append(" ".join(w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    # what cover takes away is written first: where that is little, pages meet it by a broadcast and are not shuffled
    left = materialize(different.select("host", "page", "zones", "sizes", "cover").mapInArrow(cut, "host bigint, page bigint, kept array<int>"), "left")
    return known.join(left, ["host", "page"], "left").select("page_id", "url", "zones", "texts", "kept").mapInArrow(
        text, f"page_id {kind}, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
