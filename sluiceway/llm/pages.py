"""Main text of web pages: the declared article, and for pages without one all text, less what the host repeats.

Which blocks are chrome is read from the markup. What the markup does not say is judged by suffix arrays of the
host's token streams: runs of tokens that other pages of the host have too are boilerplate. Articles have streams of
their own, in which it takes more pages.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.arrow import saved, slices
from sluiceway.llm.files import opened
from sluiceway.session import fresh_dir

#: Tokens of a repeated substring (a power of two: suffixes are sorted to this depth).
REPEATED = 8
#: Distinct articles of a host (by buckets of their hashes, of which there are 64) that make a run boilerplate in articles.
ARTICLES = 10
#: Tokens of an article's anchors: single words stand in too many articles.
GRAM = 4
SHARD_TOKENS = 1 << 18
GROUP_LIMIT = 4_096

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|math|iframe|object|select|textarea|button|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-z][a-z0-9:-]*)([^>]*)>|<[!?/][^>]*>",
    re.I | re.S,
)
_RAW = re.compile(r"<(script|style|noscript|template|svg|math|iframe|object|select|textarea|button|title)\b", re.I)
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without end tags in much of the web.
_LOOSE = frozenset("p li dt dd tr td th thead tbody tfoot option rp rt html body head".split()) | _INLINE | _VOID
#: Of these, what a start tag ends in the same block; every tag that is not inline ends a paragraph.
_CELLS, _ROWS = ("td", "th"), ("thead", "tbody", "tfoot")
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", *_CELLS), "option": ("option",), "rp": ("rp", "rt"), "rt": ("rp", "rt")}
_ENDS |= {k: _CELLS for k in _CELLS} | {k: (*_ROWS, "tr", *_CELLS) for k in _ROWS}
_NEVER_OPEN = _VOID | frozenset("html body head".split())
_CHROME = frozenset("nav header footer aside form dialog menu head fieldset".split())
_MAIN = frozenset("article main".split())
#: A class, id or role is chrome as a whole word, alone or with words that say where or in what form it stands.
_FORM = r"(?:site|page|main|post|entry|article|blog|global|top|bottom|left|right|inner|outer|primary|secondary|block|box|bar|area|container|wrap|wrapper|section|list|links?|buttons?|icons?|items?|posts|form|unit|slot|text|message|\d+)"
_WORD = (
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|"
    r"sidebar|menu|nav|navbar|navigation|breadcrumbs?|header|masthead|footer|comments?|disqus|replies|share|sharing|social|related|"
    r"recommended|widget|toolbar|pagination|pager|login|signup|search|complementary|contentinfo|hidden)"
)
#: Paragraphs, items, cells and inline elements use these for what they say: a table's header, a comment in code.
_SAID = "alert|comments?|footer|header|masthead|search".split("|")


def _names(words: str) -> re.Pattern:
    return re.compile(rf"(?<!\S)(?:{_FORM}[_-]+)*{words}(?:[_-]+(?:{_FORM}|{words}))*(?!\S)", re.I)


_NAMED = _names(_WORD)
_NAMED_LOOSE = _names("(?:" + "|".join(w for w in _WORD[3:-1].split("|") if w not in _SAID) + ")")
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
ARTICLE, CHROME, OPEN = 0, 1, 2


def _chromes(elements: list[tuple[int, str, bool, bool, bool]]) -> list[bool]:
    """Of each element, whether what it holds is chrome: by elements, and by names that don't take the article away.

    ``elements``: parent, element, whether it is chrome by itself, by name, and whether it makes the article. A name counts
    on what holds an article only if another one without chrome around it stays: one beside it, or an ``article`` around it.
    On an article itself it counts inside another ``article`` only, which is a comment or a teaser there.
    """
    n = len(elements)
    hard, clear, nested, inside = [False] * n, [False] * n, [False] * n, [0] * n
    mains = [i for i, e in enumerate(elements) if e[4]]
    if mains and any(e[3] for e in elements):
        for i, (up, _, tag, named, is_main) in enumerate(elements):
            hard[i] = tag or (up >= 0 and hard[up])
            clear[i] = not (hard[i] or named and not is_main) and (up < 0 or clear[up])
            nested[i] = up >= 0 and (nested[up] or (elements[up][1] == "article" and clear[up]))
        kept = [i for i in mains if clear[i]]
        inside = [0] * n
        for i in mains:
            at = i
            while at >= 0:
                inside[at] += 1
                at = elements[at][0]
    out: list[bool] = []
    for i, (up, _, tag, named, is_main) in enumerate(elements):
        if named and inside[i]:
            if is_main:
                named = nested[i]
            elif not nested[i]:
                around, at = set(), up
                while at >= 0:
                    around.add(at)
                    at = elements[at][0]
                named = any(k not in around for k in kept)
        out.append(tag or named or (up >= 0 and out[up]))
    return out


def _closed(page: str) -> str:
    """The page with its markup ended: without a ``>`` behind it a ``<`` opens nothing, and the search for one from every
    ``<`` there would be quadratic. A comment or script that is open at the last ``>`` goes on to the end of the page."""
    last = page.rfind(">") + 1
    rest = page[last:]
    if "<" not in rest:
        return page
    open_at = last
    for m in _MARKUP.finditer(page, 0, last):
        open_at = m.start() if m.end() == last else last
    final = page[open_at:last]
    raw = _RAW.match(final)
    if final.startswith("<!--") and not final.endswith("-->") or raw and not re.search(rf"</{raw[1]}\s*>\Z", final, re.I):
        return page[:open_at]
    comment = rest.find("<!--")
    return page[:last] + rest[: comment if comment >= 0 else len(rest)].replace("<", "&lt;")


def blocks(page: str) -> list[tuple[int, str]]:
    """Text blocks in page order with what the markup says of them; character references decoded, white space single."""
    found: list[tuple[int, bool, str]] = []  # innermost element, whether in the article, text
    elements: list[tuple[int, str, bool, bool, bool]] = []
    stack: list[int] = []
    main = 0
    parts: list[str] = []

    def end_block() -> None:
        if parts:
            if text := " ".join(html.unescape("".join(parts)).split()):
                found.append((stack[-1] if stack else -1, main > 0, text))
            parts.clear()

    def close(names: tuple[str, ...], outermost: bool = True, beyond: bool = False) -> None:
        """Ends the innermost or outermost open element of these names that is in the innermost block, or beyond it."""
        nonlocal main
        depth = 0
        for n, i in enumerate(reversed(stack), 1):
            if elements[i][1] in names:
                depth = n
                if not outermost:
                    break
            if not beyond and elements[i][1] not in _LOOSE:
                break
        if depth:
            if any(elements[i][3] for i in stack[-depth:]):
                end_block()
            main -= sum(elements[i][4] for i in stack[-depth:])
            del stack[-depth:]

    at, page = 0, _closed(page)
    for m in _MARKUP.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            continue
        closing, attributes = m[2] or m[5], m[4] or m[7] or ""
        if name not in _INLINE:
            if name in ("br", "hr"):
                parts.append(" ")
            else:
                end_block()
        if closing:
            if name in _LOOSE:
                close((name,), outermost=False)
            elif any(elements[i][1] == name for i in stack):
                close((name,), outermost=False, beyond=True)
            continue
        if name in _NEVER_OPEN or attributes.endswith("/"):
            if name == "hr":
                close(("p",))
            continue
        if name not in _INLINE:
            close(("p", *_ENDS.get(name, ())))
        named = " ".join(filter(None, (x for a in _ATTRIBUTE.findall(attributes) for x in a))) if attributes else ""
        loose = name in _LOOSE
        is_main = not loose and (name in _MAIN or named == "main")
        is_named = bool(named and (_NAMED_LOOSE if loose else _NAMED).search(named))
        if is_named:
            end_block()
        elements.append((stack[-1] if stack else -1, name, name in _CHROME, is_named, is_main))
        stack.append(len(elements) - 1)
        main += is_main
    if at < len(page):
        parts.append(page[at:])
    end_block()
    chrome = _chromes(elements)
    return [(CHROME if i >= 0 and chrome[i] else ARTICLE if in_main else OPEN, text) for i, in_main, text in found]


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "", re.I)
    return m[1].lower() if m else ""


def _streams(texts: pa.Array, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts as numbers, which differ by seed, and where each text begins in them; null texts have none."""
    cut = pc.split_pattern(texts, " ")
    sizes = pc.fill_null(pc.list_value_length(cut), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = cut.flatten().dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(word) for word in coded.dictionary.to_pylist()], np.uint64)
    mixed = hashes[coded.indices.to_numpy()] ^ np.repeat(seeds.astype(np.uint64), sizes)
    mixed *= np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xC4CEB9FE1A85EC53)
    mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64), np.concatenate([[0], np.cumsum(sizes)])


def _listed(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(values))


_PAGE = "struct<host:long,text:string,stream:array<long>,tokens:array<string>,places:array<int>>"


def _read(urls: pa.Array, pages: pa.Array) -> pa.Array:
    """The article if the page declares one, else its open tokens; and the stream of all tokens outside the article."""
    texts, outside, tokens, places = [], [], [], []
    for page in pages:
        found = blocks(page.as_py() or "")
        article = any(kind == ARTICLE for kind, _ in found)
        rest, own, at, n = [], [], [], 0
        for kind, text in found:
            if kind != ARTICLE:
                rest.append(text)
                if not article:
                    more = text.split(" ")
                    if kind == OPEN:
                        own.extend(more)
                        at.extend(range(n, n + len(more)))
                    n += len(more)
        texts.append(" ".join(text for kind, text in found if kind == ARTICLE) if article else None)
        outside.append(" ".join(rest) if rest else None)
        tokens.append(own)
        places.append(at)
    hosts = np.array([xxhash.xxh64_intdigest(host_of(u.as_py())) for u in urls], np.uint64)
    columns = [
        pa.array((hosts ^ np.uint64(1 << 63)).view(np.int64)), pa.array(texts, pa.string()), _listed(*_streams(pa.array(outside, pa.string()), hosts)),
        pa.array(tokens, pa.list_(pa.string())), pa.array(places, pa.list_(pa.int32())),
    ]
    return pa.StructArray.from_arrays(columns, ["host", "text", "stream", "tokens", "places"])


_read.__annotations__ = {"urls": pa.Array, "pages": pa.Array, "return": pa.Array}


def read_page(url: str | None, page: str | None) -> dict:
    """What is read of one page."""
    return _read(pa.array([url], pa.string()), pa.array([page], pa.string()))[0].as_py()


def stream_runs(values: np.ndarray, begin: np.ndarray, length: int, gram: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of ``length`` tokens in runs that share their anchor, the first least ``gram`` tokens: anchor, first start, number.

    Stream i has the values ``begin[i]`` to ``begin[i + 1]``; starts are places in ``values``.
    """
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = values
    for i in range(1, gram):
        keys = keys[:-1] * np.int64(-7046029254386353131) + values[i:]
    least, anchor = keys[:n].copy(), np.arange(n)
    for i in range(1, length - gram + 1):
        less = np.flatnonzero(keys[i : i + n] < least)
        least[less] = keys[i + less]
        anchor[less] = i + less
    sizes = np.diff(begin)
    owner = np.repeat(np.arange(len(sizes)), sizes)[:n]
    starts = np.flatnonzero(np.arange(n) + length <= begin[1:][owner])
    anchor, owner = anchor[starts], owner[starts]
    heads = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])) if len(starts) else starts
    return keys[anchor[heads]], starts[heads], np.diff(np.append(heads, len(starts)))


#: Anchors of articles are told apart by bits: so many of a group's number, of its place in the filter, and in a group.
_GROUP, _PLACE, _KEY = 10, 17, 24
#: Anchors that a task packs at once, and bytes that it cuts into runs at once.
_PACKED, _TEXT = 1 << 20, 2 << 20


def _some(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pages, tokens and where each page's begin, of successive rows with not too many tokens: pages with their streams,
    or with host and text, whose tokens hash differently on every host."""
    pages = batch.column(0).to_numpy(zero_copy_only=False)
    if batch.num_columns == 3:
        hosts = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        for lo, hi in slices(batch.column(2), _TEXT):
            yield pages[lo:hi], *_streams(batch.column(2).slice(lo, hi - lo), hosts[lo:hi])
        return
    streams = batch.column(1)
    ends = np.cumsum(pc.fill_null(pc.list_value_length(streams), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(ends):
        done = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + _TEXT // 8, "right")))
        yield pages[lo:hi], streams.slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False), np.concatenate([[done], ends[lo:hi]]) - done
        lo = hi


def _contexts(length: int, gram: int, often=None):
    """Runs with their tokens; with ``often``, only those whose anchors may be frequent."""
    schema = pa.schema([("page", pa.int64()), ("anchor", pa.int64()), ("ctx", pa.int64()), ("first", pa.int32()), ("tokens", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pages, values, begin in _some(batch):
                anchors, starts, counts = stream_runs(values, begin, length, gram)
                if often is not None:
                    kept = may_be_frequent(often.value, anchors)
                    anchors, starts, counts = anchors[kept], starts[kept], counts[kept]
                owner = np.searchsorted(begin, starts, "right") - 1
                sizes = counts + length - 1
                ends = np.concatenate([[0], np.cumsum(sizes)])
                tokens = values[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)]
                raw = memoryview(np.ascontiguousarray(tokens)).cast("B")
                said = [xxhash.xxh64_intdigest(raw[8 * a : 8 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                columns = [pages[owner], anchors, np.array(said, np.uint64).view(np.int64), (starts - begin[owner]).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), _listed(tokens, ends)], schema=schema)

    return run


def _packed_anchors(length: int, gram: int):
    """Anchors of pages in groups: bits of the anchor and the bucket of the page in one number, in order, each as its
    distance from the one before; all lowest bytes come first, so that those that are zero pack well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def packed() -> pa.RecordBatch:
            each = np.unique(np.concatenate(waiting))
            group, low = each >> np.uint64(_KEY + 6), (each & np.uint64((1 << _KEY + 6) - 1)).astype(np.uint32)
            heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            away = np.diff(low, prepend=np.uint32(0))
            away[heads] = low[heads]
            raw = away.astype("<u4").view(np.uint8).reshape(-1, 4)
            keys = [raw[a:b].T.tobytes() for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(each)])]
            return pa.RecordBatch.from_arrays([pa.array(group[heads].astype(np.int32)), pa.array(keys)], names=["bucket", "keys"])

        for batch in batches:
            for pages, values, begin in _some(batch):
                anchors, starts, _ = stream_runs(values, begin, length, gram)
                own = pages[np.searchsorted(begin, starts, "right") - 1].view(np.uint64) & np.uint64(63)
                waiting.append((anchors.view(np.uint64) >> np.uint64(64 - _GROUP - _KEY)) << np.uint64(6) | own)
                size += len(anchors)
                if size > _PACKED:
                    yield packed()
                    waiting, size = [], 0
        if size:
            yield packed()

    return run


def _frequent(least: int):
    """Of a group's anchors, a bit for each that stands in pages of ``least`` buckets or more."""
    schema = pa.schema([("bucket", pa.int32()), ("bits", pa.binary())])

    def run(rows: pa.Table) -> pa.Table:
        planes = [np.frombuffer(x.as_py(), np.uint8).reshape(4, -1) for x in rows["keys"]]
        each = np.unique(np.concatenate([np.cumsum(np.ascontiguousarray(x.T).view("<u4").ravel(), dtype=np.uint32) for x in planes]))
        key, n = np.unique(each >> np.uint32(6), return_counts=True)
        key = key[n >= least]
        if not len(key):
            return pa.table([[], []], schema=schema)
        bits = np.zeros(1 << _PLACE, bool)
        bits[key >> np.uint32(_KEY - _PLACE)] = True
        return pa.table([pa.array([rows["bucket"][0].as_py()], pa.int32()), pa.array([np.packbits(bits).tobytes()])], schema=schema)

    return run


def anchor_filter(groups: list[tuple[int, bytes]]) -> np.ndarray:
    """The bits of all groups, one group a row."""
    out = np.zeros((1 << _GROUP, 1 << _PLACE - 3), np.uint8)
    for group, bits in groups:
        out[group] = np.frombuffer(bits, np.uint8)
    return out


def may_be_frequent(often: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Which anchors have their bit in the filter: all that are frequent, and some that share the bit of one."""
    place = (anchors.view(np.uint64) >> np.uint64(64 - _GROUP - _PLACE)).astype(np.int64)
    return often.reshape(-1)[place >> 3] >> (7 - (place & 7)) & 1 > 0


def suffix_ranks(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``depth`` tokens (a power of two): the suffix array, equal prefixes tied."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step < depth:
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-step] = rank[step:] + 1
        rank = np.unique(rank * (len(rank) + 2) + ahead, return_inverse=True)[1].astype(np.int64)
        step *= 2
    return rank


def shard_repeats(contexts: list[np.ndarray], pages: list[tuple[int, int, int]], length: int, least: int = 2) -> list[list[int]]:
    """Per context the window starts whose tokens stand on distinct pages. pages: least and greatest page of a context, buckets."""
    text = np.concatenate(contexts)
    rank = suffix_ranks(text, length)
    sizes = np.array([len(c) for c in contexts])
    begin = np.cumsum(sizes) - sizes
    inside = np.concatenate([b + np.arange(n - length + 1) for b, n in zip(begin, sizes)])
    owner = np.repeat(np.arange(len(sizes)), sizes - length + 1)
    low, high = np.full(len(rank), np.iinfo(np.int64).max), np.full(len(rank), np.iinfo(np.int64).min)
    spans = np.array(pages, np.int64)
    np.minimum.at(low, rank[inside], spans[owner, 0])
    np.maximum.at(high, rank[inside], spans[owner, 1])
    again = low[rank[inside]] != high[rank[inside]]
    if least > 2:
        bits = np.zeros(len(rank), np.int64)
        np.bitwise_or.at(bits, rank[inside], spans[owner, 2])
        again &= np.bitwise_count(bits.view(np.uint64))[rank[inside]] >= least
    cuts = np.cumsum(sizes - length + 1)[:-1]
    return [np.flatnonzero(part).tolist() for part in np.split(again, cuts)]


_MARK = pa.schema([("anchor", pa.int64()), ("ctx", pa.int64()), ("starts", pa.list_(pa.int32()))])


def _shards(length: int, shard_tokens: int, least: int):
    def marks(rows: list[tuple]) -> pa.RecordBatch:
        found = shard_repeats([np.array(r[4], np.int64) for r in rows], [(r[2], r[3], r[5]) for r in rows], length, least)
        kept = [(r[0], r[1], s) for r, s in zip(rows, found) if s]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*kept), _MARK.types)] if kept else [pa.array([], t) for t in _MARK.types], schema=_MARK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held >= shard_tokens and row[0] != rows[-1][0]:
                    yield marks(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[4])
        if rows:
            yield marks(rows)

    return run


def boilerplate(streams: DataFrame, length: int = REPEATED, shard_tokens: int = SHARD_TOKENS, group_limit: int = GROUP_LIMIT, least: int = 2, gram: int = 1) -> DataFrame:
    """``(page, starts)``: where in the stream of ``page`` stand ``length`` tokens that another page of its host has.

    ``streams`` has ``page`` (a hash of the stream) and ``stream``, or ``host`` and ``text`` instead; tokens hash differently on every host. Runs of windows with
    one anchor (``gram`` tokens) go to one shard of the host's suffix array, equal runs counted before; an anchor of a host
    with more than ``group_limit`` different runs does not fit one, of it windows are counted by hash. If ``least`` is over
    two, the tokens must stand on pages of so many of 64 buckets, so on as many distinct pages or more; most anchors that
    don't are left out first, by a filter of at most 16 MB whatever the table's size.
    """
    bits = F.expr("bit_or(shiftleft(1L, cast(pmod(page, 64) as int)))")
    streams, kinds_of = streams.select(*(c for c in ("page", "host", "text", "stream") if c in streams.columns)), "page long, anchor long, ctx long, first int, tokens array<long>"
    if least > 2:
        anchors = streams.mapInArrow(_packed_anchors(length, gram), "bucket int, keys binary")
        often = anchors.groupBy("bucket").applyInArrow(_frequent(least), "bucket int, bits binary").collect()  # 16 MB at most
        often = streams.sparkSession.sparkContext.broadcast(anchor_filter([(r.bucket, bytes(r.bits)) for r in often]))
        runs = streams.mapInArrow(_contexts(length, gram, often), kinds_of).dropDuplicates(["page", "anchor", "ctx", "first"])
    else:
        runs = streams.mapInArrow(_contexts(length, gram), kinds_of)
    runs = saved(runs, "runs")
    kinds = runs.groupBy("anchor", "ctx").agg(F.min("page").alias("low"), F.max("page").alias("high"), bits.alias("bits"), F.any_value("tokens").alias("tokens"))
    kinds = saved(kinds, "contexts")
    sizes = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("low").alias("least"), F.max("high").alias("most")).where("least <> most").drop("least", "most")
    sized = kinds.join(sizes, "anchor")
    fits = sized.where(F.col("kinds") <= group_limit).select("anchor", "ctx", "low", "high", "tokens", "bits")
    # By a hash of its own: after the join the anchor's partitioning is there already, so Spark would leave this shuffle
    # out, and adaptive execution, which does not know that a task needs an anchor whole, may deal that one otherwise.
    shard = fits.repartition(F.xxhash64("anchor")).sortWithinPartitions("anchor", "ctx").mapInArrow(_shards(length, shard_tokens, least), "anchor long, ctx long, starts array<int>")
    at = F.explode(F.sequence(F.lit(0), F.size("tokens") - length))
    each = sized.where(F.col("kinds") > group_limit).select("anchor", "ctx", "low", "high", "bits", "tokens", at.alias("at"))
    each = each.select("anchor", "ctx", "at", "low", "high", "bits", F.xxhash64(F.slice("tokens", F.col("at") + 1, length)).alias("said"))
    again = each.groupBy("anchor", "said").agg(F.min("low").alias("a"), F.max("high").alias("b"), F.bit_or("bits").alias("c")).where("a <> b")
    again = again.where(F.bit_count("c") >= least) if least > 2 else again
    counted = each.join(again.select("anchor", "said"), ["anchor", "said"]).groupBy("anchor", "ctx").agg(F.collect_set("at").alias("starts"))
    marks = saved(shard.unionByName(counted), "marks")
    found = runs.select("page", "anchor", "ctx", "first").join(marks, ["anchor", "ctx"])
    moved = F.transform("starts", lambda s: s + F.col("first"))
    return found.groupBy("page").agg(F.array_sort(F.flatten(F.collect_list(moved))).alias("starts"))


def _marks(folder: str, part: int) -> dict[int, np.ndarray]:
    """The marks of the rows of one part of the table, by row."""
    fs, base = opened(folder)
    found = fs.get_file_info(pafs.FileSelector(f"{base}/part={part}", allow_not_found=True))
    tables = [pq.read_table(f.path, columns=["row", "starts"], filesystem=fs, partitioning=None) for f in found if f.path.endswith(".parquet")]
    return {row.as_py(): starts.values.to_numpy(zero_copy_only=False) for t in tables for row, starts in zip(t["row"], t["starts"])}


def _left(length: int, folder: str):
    """The text of a row without what is marked: an article's as a whole or, if over half is marked, uncut."""

    def each(rows: pa.Array, texts: pa.Array, tokens: pa.Array, places: pa.Array) -> pa.Array:
        out, part, marks = [], None, {}
        for i, row in enumerate(rows.to_pylist()):
            if row >> 33 != part:
                part = row >> 33
                marks = _marks(folder, part)
            starts, text = marks.get(row), texts[i].as_py()
            if starts is None:
                out.append(text if text is not None else " ".join(tokens[i].as_py()))
                continue
            gone = np.unique(starts[:, None] + np.arange(length))
            if text is None:
                there = ~np.isin(places[i].values.to_numpy(zero_copy_only=False), gone)
                out.append(" ".join(compress(tokens[i].as_py(), there.tolist())))
                continue
            words = text.split(" ")
            if 2 * len(gone) <= len(words):  # else it is a near copy of other articles
                there = np.ones(len(words), bool)
                there[gone] = False
                text = " ".join(compress(words, there.tolist()))
            out.append(text)
        return pa.array(out, pa.string())

    each.__annotations__ = {"rows": pa.Array, "texts": pa.Array, "tokens": pa.Array, "places": pa.Array, "return": pa.Array}
    return F.arrow_udf(each, "string").asNondeterministic()


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", length: int = REPEATED, articles: int = ARTICLES) -> DataFrame:
    """Per row: id, url, ``text``, ``n_chars``.

    The text is the page's ``article`` or ``main`` without navigation, headers, footers, asides, forms, adverts,
    notices, comments and scripts, which elements and class, id and role names tell. A page that declares no article
    has its other text, less what the host's suffix array finds on distinct pages of the host; of pages with the same
    stream one counts, so copies of a page don't erase each other. An article loses what stands in ``articles`` distinct
    articles of the host, unless that is over half of it: then they are near copies, and it stays whole. Character
    references are decoded, white space is one blank, blocks are in page order. Null html has no text, a null url no
    host (such pages are one host); repeated rows stay repeated rows; other columns are not read; an empty table gives
    no rows.
    """
    spark = pages.sparkSession
    read = F.arrow_udf(_read, _PAGE).asNondeterministic()
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), read(F.col(url_col), F.col(html_col)).alias("p"))
    rows = rows.select("id", "url", "p.*", F.xxhash64("p.stream").alias("page"), F.xxhash64("p.host", "p.text").alias("body"), F.monotonically_increasing_id().alias("row"))
    rows = saved(rows, "pages", **{"compression": "zstd", "parquet.compression.codec.zstd.level": "9"})
    streams = rows.where(F.size("stream") >= length).groupBy("page").agg(F.any_value("stream").alias("stream"))
    marks = boilerplate(streams.select("page", "stream"), length)
    marks = rows.where("text is null").select("row", "page").join(marks, "page")
    bodies = rows.where("text is not null").select(F.col("body").alias("page"), "host", "text")
    cuts = boilerplate(bodies, length, least=articles, gram=min(GRAM, length))
    cuts = rows.where("text is not null").select("row", F.col("body").alias("page")).join(cuts, "page")
    # The marks go to the texts: each task reads those of its own part of the table, so no text is shuffled.
    folder = fresh_dir(spark, "cuts")
    each = marks.unionByName(cuts).select("row", "starts", F.shiftright("row", 33).alias("part"))
    each.repartition("part").write.partitionBy("part").parquet(folder)
    out = rows.select("id", "url", _left(length, folder)("row", "text", "tokens", "places").alias("text"))
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
