"""Main text of HTML pages: blocks, then the long repeats in each host's token streams for what the markup leaves open.

1. A page becomes blocks of text, each of one kind. CONTENT lies in an `article`, or in a `main` if the page has no article. CHROME lies in an
   element that is no main text by its tag (menus, page headers and footers, asides, forms, ...) or by a whole token of its class, id or role
   (ad, cookie-notice, sidebar, comments, ...; has-sidebar or no-ads are none). Around an article or main only menus, page headers and footers,
   asides and dialogs make its text chrome; labels, forms and the like count where they lie inside it. All other blocks are OPEN. Where all of a
   page would be chrome, what no such tag holds is OPEN, or else all of it. Scripts, styles, titles and markup comments give no text.
2. All blocks of each host's pages, marked or not, are joined to token streams. A long repeat is a whole block, or a run of `run` tokens,
   found on `pages` distinct page contents of the host or more and on a `share` of them or more. Pages with equal text count once,
   whatever their page_id or URL. Runs are the intervals of a suffix array over the joined streams of each shard whose suffixes share `run` tokens;
   an interval is known by a 64-bit value of these tokens, as a whole block is by one of its text.
3. A page with an article keeps the article's blocks, repeated or not: an article that quotes another is still an article. Of any other page the blocks
   of its main, or else its open blocks, are decided: those stay that have a token outside of all repeats.
   Repeated text stays in one place: the first content (by key) that has it keeps it, if the block has `run` tokens or more, or if the page
   is for the most part repeated; so copies leave one whole page, while a short notice on pages with text of their own goes everywhere.
   A page whose decided blocks are all repeated keeps them: no page is emptied.

Rows without blocks get their empty text at once, and equal contents of a host are decided once and joined back.
A host is cut into shards of about `shard` tokens by page content. As a content lies in one shard, the contents of a value are added up over shards, so the
result is that of one array over the whole host, and no task holds a hot host. A value on a share of all contents is on that share of a shard's contents
in one shard at least. So where a host's shards have `dense` contents or more on average, a shard names only such values, and the contents that have one of them are counted by a
second look at the stored blocks, without another shuffle of texts unless the values named are many. Where contents are so large that shards have few, a shard gives all its values with their counts.

Defined cases: null or empty html gives an empty text. A null URL, or one without a host, belongs to the host ''. Every row gives a row. Unclosed tags, comments and scripts follow the HTML rules: an unclosed comment, script or
style runs to the end. Extra columns are not carried along. An empty table gives an empty table. White space inside a block becomes
one space; blocks are joined by a line feed.
"""

import html
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from admetrics.llm.url_filters import host_of
from admetrics.session import materialize

RUN = 24
PAGES = 3
SHARE = 0.5
SHARD = 500_000
DENSE = 64
CONTENT, CHROME, OPEN = 0, 1, 2

#: Chrome whatever they hold, and chrome unless they hold an article or main.
_OUTER_TAGS = frozenset("nav footer aside dialog menu".split())
_CHROME_TAGS = _OUTER_TAGS | frozenset("form button select input label fieldset legend datalist output canvas object embed applet".split())
_SILENT_TAGS = frozenset("script style title template noscript iframe textarea svg math noframes xmp".split())
_RAW_TAGS = frozenset("script style title textarea iframe noframes xmp noscript".split())
_VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE_TAGS = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
_CHROME_WORDS = frozenset(
    (
        "ad ads adv advert adverts advertisement advertisements advertising adbox adsense sponsor sponsored sponsors promo promotion banner banners "
        "cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup "
        "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside widget widgets footer masthead toolbar topbar pagination pager "
        "comment comments commentlist respond reply replies disqus social share sharing related recommended recommendations login search "
        "skip copyright disclaimer contentinfo complementary"
    ).split()
)
_PAGE_HEADER_WORDS = frozenset("header siteheader".split())
#: Parts that leave a token what its other parts make of it, as in sidebar-left, site-footer or ad-2.
_PLAIN_PARTS = frozenset("site left right top bottom box bar block button buttons list links link slot unit".split())
#: Readers' comments under any other name, unless a part says that the token is a state or a number; one comment with parts that only place it.
_COMMENTS = frozenset("comments commentlist disqus".split())
_STATES = frozenset("no has with without open closed off on disabled enabled hide hidden show count number".split())
_COMMENT_PARTS = frozenset(
    "body content text list thread section area item entry meta author user reader wrapper wrap container inner outer form children parent head header footer depth".split()
)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NAMED = re.compile(r"""(?:^|[\s"'])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")


def _is_chrome_token(token: str, inside_article: bool) -> bool:
    """Whether a whole token of a class, id or role names chrome: each of its parts does, but for plain ones."""
    parts = {token.lower()}
    for words in (_CHROME_WORDS, _PAGE_HEADER_WORDS):
        if words is _PAGE_HEADER_WORDS and inside_article:
            break
        if parts & words:
            return True
        parts = {p.lower() for p in _PART.findall(token)}
        if parts & words and parts <= words | _CHROME_WORDS | _PLAIN_PARTS:
            return True
    if parts & _COMMENTS and not parts & _STATES:
        return True
    return "comment" in parts and parts <= _COMMENT_PARTS | _CHROME_WORDS | _PLAIN_PARTS


def _labelled(attributes: str, inside_article: bool) -> bool:
    if "=" not in attributes:
        return False
    return any(_is_chrome_token(t, inside_article) for m in _NAMED.finditer(attributes) for t in (m[1] or m[2] or m[3] or "").split())


class _Open:
    """The open elements of a page and what they make of its text."""

    def __init__(self):
        self.stack, self.counts, self.chrome, self.articles, self.mains = [], {}, 0, 0, 0
        #: Open elements that are chrome by an outer tag, by a label, and those around the content that do not speak against it.
        self.outer, self.labels, self.around_article, self.around_main = 0, 0, 0, 0
        self.seen_article = self.seen_main = False

    def _around(self, place, first) -> int:
        """The chrome that is open where an article or main begins and may lie around content: forms and the like, and labels around the page's first."""
        for element in self.stack:
            element[place] = element[place] or element[1] and not element[3] and (first or not element[6])
        return sum(element[place] for element in self.stack)

    def push(self, tag, attributes):
        inside = self.articles > 0
        outer = tag in _OUTER_TAGS or tag == "header" and not inside
        label = not outer and tag not in _CHROME_TAGS and _labelled(attributes, inside)
        chrome = outer or tag in _CHROME_TAGS or label
        main = tag == "main" or tag != "article" and "main" in attributes and re.search(r"""role\s*=\s*["']?main\b""", attributes) is not None
        chrome = chrome and tag not in ("html", "body") and (not main or outer)
        if tag == "article" and not inside:
            self.around_article, self.seen_article = self._around(4, not self.seen_article), True
        if main and not self.mains:
            self.around_main, self.seen_main = self._around(5, not self.seen_main), True
        label = label and chrome
        self.stack.append([tag, chrome, main, outer, False, False, label])
        self.labels += label
        self.counts[tag] = self.counts.get(tag, 0) + 1
        self.chrome += chrome
        self.outer += outer
        self.articles += tag == "article"
        self.mains += main

    def pop(self):
        tag, chrome, main, outer, of_article, of_main, label = self.stack.pop()
        self.labels -= label
        self.counts[tag] -= 1
        self.chrome -= chrome
        self.outer -= outer
        self.articles -= tag == "article"
        self.mains -= main
        self.around_article -= of_article
        self.around_main -= of_main

    def close(self, tag):
        if self.counts.get(tag):
            while self.stack[-1][0] != tag:
                self.pop()
            self.pop()

    def start_block(self, tag):
        """A paragraph ends where a block starts, and an item where its like starts."""
        if self.counts.get("p"):
            self.close("p")
        while self.stack and self.stack[-1][0] == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            self.pop()


def blocks(page: str | None) -> list[tuple[bool, bool, bool, bool, str]]:
    """Text blocks in page order: content of an article, content of a main, in chrome, in chrome by an outer tag, text."""
    page = page or ""
    out, parts, state, at, tag_pattern = [], [], _Open(), 0, _TAG
    silent = []

    def flush():
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            of_article = state.articles > 0 and state.chrome <= state.around_article
            of_main = state.mains > 0 and state.chrome <= state.around_main
            out.append((of_article, of_main, state.chrome > 0, state.outer > 0, text, state.labels > 0))

    def say(text):
        if text and not silent:
            parts.append(html.unescape(text) if "&" in text else text)

    while True:
        mark = page.find("<", at)
        if mark < 0:
            say(page[at:])
            break
        say(page[at:mark])
        follow = page[mark + 1 : mark + 2]
        if follow in ("!", "?"):
            if page.startswith("<!--", mark):
                end = page.find("-->", mark + 4)
                at = len(page) if end < 0 else end + 3
            else:
                end = page.find(">", mark)
                at = len(page) if end < 0 else end + 1
            continue
        m = tag_pattern.match(page, mark) if follow == "/" or follow.isalpha() else None
        if m is None and tag_pattern is _TAG and (follow == "/" or follow.isalpha()):
            m = _LOOSE_TAG.match(page, mark)
            if m:
                tag_pattern = _LOOSE_TAG
        if m is None and page.find(">", mark) < 0:
            say(page[mark:])
            break
        if m is None:
            say("<")
            at = mark + 1
            continue
        at, tag = m.end(), m[2].lower()
        if m[1]:
            if silent:
                if tag == silent[-1]:
                    silent.pop()
                continue
            if tag not in _INLINE_TAGS:
                flush()
            elif state.counts.get(tag) and state.chrome:
                flush()
            state.close(tag)
            continue
        if tag in _RAW_TAGS:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            close = page.find(">", end.end() - 1) if end else -1
            at = close + 1 if close >= 0 else len(page)
            continue
        closed = m[3].endswith("/")
        if tag in _SILENT_TAGS:
            if not closed:
                silent.append(tag)
            continue
        if silent:
            continue
        if tag in _INLINE_TAGS:
            if tag in ("br", "wbr"):
                parts.append(" " if tag == "br" else "")
            if tag not in _VOID_TAGS:
                if _labelled(m[3], state.articles > 0):
                    flush()
                state.push(tag, m[3])
            continue
        flush()
        state.start_block(tag)
        if tag not in _VOID_TAGS and not closed:
            state.push(tag, m[3])
    flush()
    # A label around an article or main is overlooked only on pages that have none outside labels.
    plain = [any(b[k] and not b[5] for b in out) for k in (0, 1)]
    return [(a and not (plain[0] and label), m and not (plain[1] and label), c, o, t) for a, m, c, o, t, label in out]


def judged(page: str | None) -> tuple[list[int], list[str]]:
    """Kinds and texts of all blocks of a page in order. On a page with an article its blocks are CONTENT, on one with a main those of the main are OPEN,
    and what lies outside is CHROME."""
    found = blocks(page)
    texts = [b[4] for b in found]
    for k, kind in ((0, CONTENT), (1, OPEN)):
        if any(b[k] for b in found):
            return [kind if b[k] else CHROME for b in found], texts
    # Where all would be chrome, what no outer tag holds is open, or else all.
    alone = 2 if not all(b[2] for b in found) else 3
    every = all(b[alone] for b in found)
    return [CHROME if b[alone] and not every else OPEN for b in found], texts


def parse(page: str | None) -> tuple[str | None, list[int], list[str]]:
    """What the markup alone says: the content of a page that marks it (else None), and kinds and texts of its other blocks."""
    found = blocks(page)
    for k in (0, 1):
        content = [b[4] for b in found if b[k]]
        if content:
            rest = [(CHROME if b[2] else OPEN, b[4]) for b in found if not b[k]]
            return "\n".join(content), [r[0] for r in rest], [r[1] for r in rest]
    return None, *judged(page)


def _codes(tokens: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t, 7) for t in tokens], np.uint64)


def _mixed(codes) -> np.ndarray:
    """The 64-bit values of runs, from the arrays of their first, second, ... codes."""
    value = np.zeros(len(codes[0]), np.uint64)
    for code in codes:
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + code
    return value


def _windows(tokens: list[str], least: int) -> np.ndarray:
    """A 64-bit value of the first `least` tokens of each suffix that has as many; suffixes with equal values share that prefix."""
    codes = _codes(tokens)
    n = max(0, len(codes) - least + 1)
    return _mixed([codes[k : k + n] for k in range(least)])


def suffix_array(symbols: np.ndarray, least: int):
    """Starts of all suffixes in order, and which of them share their first `least` symbols with the one before.

    Suffixes are ordered by their first 1, 2, 4, ... symbols until no two are equal, and only those that are equal so far are ordered again. A rank is the first
    place of the suffixes that are equal. A prefix of `least` symbols is known by the ranks of its first and last 2^k symbols, the most that fit, so
    nothing is compared by hash.
    """
    n = len(symbols)
    array, rank, known = np.arange(n), np.zeros(n, np.int64), 0
    place, key, ends = np.arange(n), symbols, []
    while True:
        # `place` holds the places of the suffixes that `key` orders further.
        order = np.argsort(key)
        found, key = array[place][order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        array[place] = found
        rank[found] = place[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        known = 2 * known or 1
        if known <= least < 2 * known:
            # Where a rank reaches over the end, the end is smaller than any symbol.
            tail = np.full(n, -1)
            tail[: max(0, n - (least - known))] = rank[least - known :]
            ends = [rank.copy(), tail]
        place = place[~(new & np.append(new[1:], True))]
        if known > least and not len(place):
            break
        after = np.zeros(n, np.int64)
        after[: max(0, n - known)] = rank[known:] + 1
        key = rank[array[place]] * (n + 1) + after[array[place]]
    shared = np.zeros(n, bool)
    shared[1:] = np.all([r[array[1:]] == r[array[:-1]] for r in ends], axis=0) & (ends[1][array[1:]] >= 0)
    return array, shared


def suffix_intervals(streams: list[list[str]], least: int, keys=None, at_least=1):
    """Intervals of the suffix array of joined token streams, one for each prefix of `least` tokens inside `at_least` streams or more.

    Arrays: the prefix's 64-bit value, the number of distinct streams that have it and, with `keys` of the streams, their smallest key.
    """
    stream = np.repeat(np.arange(len(streams)), [len(t) + 1 for t in streams])
    # Each stream ends with a symbol of its own, so no prefix runs over it.
    numbers = {None: 0}
    symbols = np.array([numbers.setdefault(t, len(numbers)) for tokens in streams for t in [*tokens, None]], np.int64)
    codes = _codes([t for t in numbers if t is not None])
    last = symbols == 0
    tokens = symbols - 1
    symbols[last] = len(numbers) + np.arange(len(streams))
    array, shared = suffix_array(symbols, least)
    stop = np.cumsum([len(t) + 1 for t in streams]) - 1
    inside = array + least <= stop[stream[array]] if len(streams) else np.zeros(0, bool)
    interval = np.cumsum(~shared)[inside]
    array = array[inside]
    # No more streams than suffixes have a prefix.
    enough = np.bincount(interval)[interval] >= at_least if len(interval) else inside[:0]
    interval, array = interval[enough], array[enough]
    owner = stream[array]
    order = np.lexsort([owner, interval])
    interval, owner, array = interval[order], owner[order], array[order]
    new = np.diff(interval, prepend=0) > 0
    at = np.flatnonzero(new)
    fresh = new | (np.diff(owner, prepend=-1) != 0)
    if not len(at):
        nothing = np.zeros(0, np.int64)
        return (nothing.view(np.uint64), nothing) if keys is None else (nothing.view(np.uint64), nothing, nothing)
    n = np.add.reduceat(fresh.astype(np.int64), at)
    first = None if keys is None else np.minimum.reduceat(keys[owner], at)
    kept = n >= at_least
    # The same value in every shard, by which intervals are added up.
    starts = array[at[kept]]
    values = _mixed([codes[tokens[starts + k]] for k in range(least)])
    return (values, n[kept]) if keys is None else (values, n[kept], first[kept])


def _wholes(texts: list[str]) -> np.ndarray:
    """A 64-bit value of each whole block."""
    return np.array([xxhash.xxh64_intdigest(t, 11) for t in texts], np.uint64)


def _covered(texts, repeated: np.ndarray, run: int) -> list[np.ndarray]:
    """For each block, which of its tokens lie in a repeated block or run."""
    sizes = [t.count(" ") + 1 for t in texts]
    ends = np.cumsum(sizes)
    steps = np.zeros(ends[-1] + 1, np.int64)
    at = np.flatnonzero(np.isin(_windows(" ".join(texts).split(" "), run), repeated))
    np.add.at(steps, at, 1)
    np.add.at(steps, at + run, -1)
    whole = np.isin(_wholes(texts), repeated)
    np.add.at(steps, (ends - sizes)[whole], 1)
    np.add.at(steps, ends[whole], -1)
    return np.split(np.cumsum(steps)[:-1] > 0, ends[:-1])


def unique_blocks(kinds, texts, repeated: np.ndarray, elsewhere: np.ndarray, run: int) -> list[str]:
    """The open blocks that a page keeps, from the repeated values and those of them that another content has first."""
    is_open = [k == OPEN for k in kinds]
    gone = [o and bool(c.all()) for o, c in zip(is_open, _covered(texts, repeated, run))]
    sizes = [t.count(" ") + 1 for t in texts]
    copied = sum(n for n, g in zip(sizes, gone) if g) * 2 > sum(n for n, o in zip(sizes, is_open) if o)
    later = [bool(c.all()) for c in _covered(texts, elsewhere, run)]
    kept = [t for t, o, g, l, n in zip(texts, is_open, gone, later, sizes) if o and (not g or not l and (copied or n >= run))]
    return kept or [t for t, o in zip(texts, is_open) if o]


def open_contents(parsed: DataFrame) -> DataFrame:
    """One of the rows of each distinct content with blocks, however many rows have it; texts stay where they are unless contents with copies are many."""
    if "row" not in parsed.columns:
        parsed = materialize(parsed.withColumn("row", F.monotonically_increasing_id()), "numbered-pages")
    filled = parsed.where(F.size("texts") > 0)
    copies = filled.groupBy("host", "key").agg(F.min("row").alias("first_row"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    copies = materialize(copies, "copied-contents")
    return filled.join(copies, ["host", "key"], "left").where("first_row IS NULL OR row = first_row").select("host", "key", "kinds", "texts")


def host_sizes(contents: DataFrame, shard: int) -> DataFrame:
    """host, contents and shards; a block counts as a token at least, and a page as eight."""
    tokens = F.aggregate(F.transform("texts", lambda t: F.greatest(F.length(t) / 6, F.lit(1.0))), F.lit(0.0), lambda a, b: a + b)
    sizes = contents.groupBy("host").agg(F.sum(F.greatest(tokens, F.lit(8.0))).alias("size"), F.count("*").alias("contents"))
    return sizes.select("host", "contents", F.ceil(F.col("size") / shard).cast("int").alias("shards"))


def _values(texts: list[str], run: int) -> np.ndarray:
    """The distinct values of a content: its runs and its whole blocks."""
    return np.unique(np.concatenate([_windows(" ".join(texts).split(" "), run), _wholes(texts)]))


def _summed(values: list[np.ndarray], keys):
    """Distinct values, the number of contents that have each of them, and the smallest key of these."""
    owner = np.repeat(np.asarray(keys, np.int64), [len(v) for v in values])
    value = np.concatenate([*values, np.zeros(0, np.uint64)])
    order = np.lexsort([owner, value])
    found, at = np.unique(value[order], return_index=True)
    return found, np.diff(np.append(at, len(order))), owner[order][at]


def repeats(contents: DataFrame, sizes: DataFrame, run: int, min_pages: int, share: float, dense: float) -> DataFrame:
    """host, value and first: the long repeats of each host, and the smallest key of a content that has it."""
    sizes = sizes.withColumn("mode", F.expr(f"CASE WHEN shards = 1 THEN 0 WHEN contents >= {dense} * shards THEN 1 ELSE 2 END"))
    streams = contents.join(sizes, "host").withColumn("shard", F.pmod("key", F.col("shards")).cast("int"))

    def intervals(table: pa.Table) -> pa.Table:
        key = table.column("key").to_numpy()
        texts = [zlib.decompress(t).decode().split("\n") for t in table.column("packed").to_pylist()]
        mode = table.column("mode")[0].as_py()
        at_least = 1 if mode == 2 else math.ceil(share * len(key))
        runs, n_runs, first_runs = suffix_intervals([" ".join(t).split(" ") for t in texts], run, key, at_least)
        whole, n_whole, first_whole = _summed([np.unique(_wholes(t)) for t in texts], key)
        enough = n_whole >= at_least
        value = np.concatenate([runs, whole[enough]])
        host = table.column("host")[0].as_py()
        return pa.table(
            {
                "host": pa.array([host] * len(value), pa.string()),
                "value": value.view(np.int64),
                "n": np.concatenate([n_runs, n_whole[enough]]),
                "first": np.concatenate([first_runs, first_whole[enough]]),
                "named": pa.array([mode == 1] * len(value), pa.bool_()),
            }
        )

    def pack(batches):
        for batch in batches:
            texts = [zlib.compress("\n".join(t).encode(), 1) for t in batch.column("texts").to_pylist()]
            columns = ("host", "shard", "mode", "key")
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(texts, pa.binary())], [*columns, "packed"])

    packed = streams.select("host", "shard", "mode", "key", "texts").mapInArrow(pack, "host string, shard int, mode int, key bigint, packed binary")
    counted = "host string, value bigint, n bigint, first bigint"
    found = materialize(packed.groupBy("host", "shard").applyInArrow(intervals, f"{counted}, named boolean"), "repeats")

    def count(batches):
        for batch in batches:
            keys, hosts = batch.column("key").to_pylist(), batch.column("host").to_pylist()
            hits = {}
            for host, key, texts, names in zip(hosts, keys, batch.column("texts").to_pylist(), batch.column("names")):
                values = _values(texts, run)
                held, of = hits.setdefault(host, ([], []))
                held.append(values[np.isin(values, names.values.to_numpy().view(np.uint64))])
                of.append(key)
            for host, (held, of) in hits.items():
                value, n, first = _summed(held, of)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([host] * len(value), pa.string()), pa.array(value.view(np.int64)), pa.array(n, pa.int64()), pa.array(first, pa.int64())],
                    ["host", "value", "n", "first"],
                )

    names = materialize(found.where("named").groupBy("host").agg(F.collect_set("value").alias("names")), "named-repeats")
    again = contents.join(names, "host").select("host", "key", "texts", "names").mapInArrow(count, counted)
    total = found.where("NOT named").drop("named").union(again).groupBy("host", "value").agg(F.sum("n").alias("pages"), F.min("first").alias("first"))
    total = total.where(F.col("pages") >= min_pages).join(sizes.select("host", "contents"), "host")
    return total.where(F.col("pages") >= share * F.col("contents")).select("host", "value", "first")


def extract(pages: DataFrame, run=RUN, min_pages=PAGES, share=SHARE, shard=SHARD, dense=DENSE) -> DataFrame:
    """page_id, url and text of every page."""

    def read(batches):
        for batch in batches:
            kinds, texts = zip(*map(judged, batch.column("html").to_pylist()))
            given = ("page_id", "url", "host")
            arrays = [*[batch.column(c) for c in given], pa.array(kinds, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, [*given, "kinds", "texts"])

    given = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    parsed = given.mapInArrow(read, "page_id bigint, url string, host string, kinds array<int>, texts array<string>")
    parsed = materialize(parsed.withColumns({"key": F.xxhash64("kinds", "texts"), "row": F.monotonically_increasing_id()}), "parsed-pages")
    contents = open_contents(parsed)
    sizes = materialize(host_sizes(contents, shard), "host-sizes")
    repeated = materialize(repeats(contents, sizes, run, min_pages, share, dense), "long-repeats")

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        value, first = (right.column(c).to_numpy() if right.num_rows else np.zeros(0, np.int64) for c in ("value", "first"))
        value, texts = value.view(np.uint64), []
        for key, kinds, blocks_ in zip(left.column("key").to_pylist(), left.column("kinds").to_pylist(), left.column("texts").to_pylist()):
            texts.append("\n".join(unique_blocks(kinds, blocks_, value, value[first != key], run)) if blocks_ else "")
        return pa.table({"host": left.column("host"), "key": left.column("key"), "text": pa.array(texts, pa.string())})

    # An article's blocks have passed through the array like all others; the markup then overrules it. The rest is decided by the repeats.
    marked = F.array_contains("kinds", CONTENT)
    article = F.array_join(F.filter("texts", lambda _, i: F.get("kinds", i) == CONTENT), "\n")
    ready = parsed.where(marked | (F.size("texts") == 0)).select("page_id", "url", article.alias("text"))
    undecided = contents.where(~marked).join(sizes.select("host", "shards"), "host")
    streams = undecided.select("host", F.pmod("key", F.col("shards")).cast("int").alias("shard"), "key", "kinds", "texts")
    needed = repeated.join(materialize(streams.select("host", "shard").distinct(), "open-shards"), "host")
    chosen = streams.groupBy("host", "shard").cogroup(needed.groupBy("host", "shard")).applyInArrow(choose, "host string, key bigint, text string")
    rest = parsed.where(~marked & (F.size("texts") > 0)).select("page_id", "url", "host", "key")
    return ready.union(rest.join(chosen, ["host", "key"]).select("page_id", "url", "text"))
