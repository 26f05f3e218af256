"""Main text of web pages: markup to text lines, and differencing against the page with the
nearest URL.

Pages of a host stand in order of their paths, and neighbours are paired. The longest common
subsequence of their lines is what the template of the site repeats, and is deleted. Copies of
an article share lines too, so lines inside an article or main element are not deleted for
being shared; marked menus, adverts, comments and the like are left out also where no
neighbour shares them.

Pages are parsed before anything is shuffled. What neighbours exchange are hashes of lines; what
comes back to a page are flags, one for each of its lines.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Hashable, Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.positions import with_position
from ..sources.scratch import write_once

COPY_SHARE = 0.8  # a page that shares so much of its text with its neighbour is its copy

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|</?([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|</?([a-zA-Z][^\s/>]*+)([^>]*+)>?""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_RAW = ("script", "style", "title", "textarea", "noscript", "template", "iframe", "svg")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in _RAW}
_VOID = frozenset(
    "area base br col embed hr img input link meta source track wbr".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu "
    "nav ol optgroup option p pre search section select summary table tbody tfoot thead tr "
    "ul".split()
)
_CELL = frozenset(["td", "th"])
_MAIN = frozenset(["article", "main"])
_LEFT_OUT = frozenset(
    "head nav footer aside form menu button select dialog search label input object".split()
)
_LEFT_OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu "
    "menubar".split()
)
_LEFT_OUT_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination popup promo "
    "promotion related respond share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription toolbar widget".split()
)
OUTSIDE, INSIDE, LEFT_OUT = 0, 1, 2


def _left_out(name: str, attributes: str, inside: bool) -> bool:
    if name in _LEFT_OUT:
        return True
    if name == "header":
        return not inside
    if not attributes or name in _MAIN or name in ("html", "body"):
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        key = key.lower()
        if key in ("class", "id"):
            words = re.split(r"[^a-z0-9]+", value)
            if not _LEFT_OUT_WORDS.isdisjoint(words) or "header" in words and not inside:
                return True
        elif key == "role" and value in _LEFT_OUT_ROLES:
            return True
        elif key == "aria-hidden" and value == "true":
            return True
        elif key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def page_lines(page: str) -> list[tuple[str, int]]:
    """The blocks of a page in order as ``(text, zone)``: character references decoded, white
    space joined, empty ones dropped. Zones tell lines inside an article or main element from
    those outside, and from those of left-out elements. Unclosed tags, comments and quotes do
    no harm beyond their parent."""
    lines: list[tuple[str, int]] = []
    words: list[str] = []
    opened: list[tuple[str, int]] = []  # name and zone of each open element
    names: Counter[str] = Counter()  # of open elements, so that stray ends cost no search
    zone, at, end = OUTSIDE, 0, len(page)

    def close_block() -> None:
        if words:
            text = " ".join("".join(words).split())
            if text:
                lines.append((text, zone))
            words.clear()

    while at < end:
        begin = page.find("<", at)
        if begin < 0:
            words.append(html.unescape(page[at:]))
            break
        if begin > at:
            words.append(html.unescape(page[at:begin]))
        tag = _TAG.match(page, begin)
        if tag is None:
            words.append("<")
            at = begin + 1
            continue
        at = tag.end()
        name = (tag[1] or tag[3] or "").lower()
        if not name:
            continue
        closing = page[begin + 1] == "/"
        if name in _RAW and not closing:
            last = _RAW_END[name].search(page, at)
            at = last.end() if last else end
            continue
        if name in _BLOCK:
            close_block()
        elif name in _CELL:
            words.append(" ")
        if closing:
            if names[name]:
                place = len(opened) - 1
                while opened[place][0] != name:
                    place -= 1
                before = opened[place - 1][1] if place else OUTSIDE
                if before != zone:
                    close_block()
                names.subtract(n for n, _ in opened[place:])
                del opened[place:]
                zone = before
            continue
        if name in _VOID:
            continue
        if name in _BLOCK and opened and opened[-1][0] == "p":
            names[opened.pop()[0]] -= 1  # a paragraph ends where the next block begins
            before = opened[-1][1] if opened else OUTSIDE
            zone = before
        new = zone
        if zone != LEFT_OUT:
            if _left_out(name, tag[2] or tag[4] or "", zone == INSIDE):
                new = LEFT_OUT
            elif name in _MAIN:
                new = INSIDE
        if new != zone:
            close_block()
        # Inline elements matter only where they are left out; many are never closed.
        if name in _BLOCK or new != zone:
            opened.append((name, new))
            names[name] += 1
            zone = new
    close_block()
    return lines


def shared_lines(a: Sequence[Hashable], b: Sequence[Hashable]) -> tuple[np.ndarray, np.ndarray]:
    """Which lines of ``a`` and of ``b`` belong to their longest common subsequence; rows of
    the table are held as bit strings."""
    in_a, in_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    tail = 0
    while tail < min(len(a), len(b)) - start and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    in_a[:start] = in_b[:start] = True
    if tail:
        in_a[-tail:] = in_b[-tail:] = True
    rest_a, rest_b = a[start:len(a) - tail], b[start:len(b) - tail]
    places: dict[Hashable, int] = {}
    for n, line in enumerate(rest_b):
        places[line] = places.get(line, 0) | 1 << n
    full = (1 << len(rest_b)) - 1
    row, rows = full, []
    for line in rest_a:
        hits = row & places.get(line, 0)
        row = ((row + hits) | (row - hits)) & full
        rows.append(row)
    i, j = len(rest_a), len(rest_b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                in_a[start + i] = in_b[start + j] = True
    return in_a, in_b


def kept_lines(sizes: np.ndarray, zones: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Which lines of a page stay: those inside its article if it has one; else its lines
    outside left-out elements that its neighbour does not share. A page without an article that
    shares nearly all of its text is a copy of its neighbour and keeps it."""
    inside, own = zones == INSIDE, zones == OUTSIDE
    if inside.any():
        # The template's lines stand outside the article, so its own lines all stay.
        return inside
    kept = own & ~shared
    return own if sizes[kept].sum() < (1 - COPY_SHARE) * sizes[own].sum() else kept


_LISTS = "page {}, url string, mark long, hashes binary, sizes binary, zones binary"


def _listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hash, size and zone of every line of each page."""
    for batch in batches:
        rows = []
        for row in batch.itertuples(index=False):
            lines = page_lines(row.html)
            hashes = [xxhash.xxh3_64_intdigest(text) for text, _ in lines]
            rows.append((row.page, row.url, row.mark, np.array(hashes, np.uint64).tobytes(),
                         np.array([len(t) for t, _ in lines], np.int32).tobytes(),
                         np.array([z for _, z in lines], np.int8).tobytes()))
        yield pd.DataFrame(rows, columns=["page", "url", "mark", "hashes", "sizes", "zones"])


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({
            "page": batch["page"], "url": batch["url"], "mark": batch["mark"],
            "lines": [[text for text, _ in page_lines(page)] for page in batch["html"]]})


def _difference(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Flags of kept lines; pages of a pair come one after the other."""
    held: list[tuple] = []  # pages of the group that the next batch may go on with

    def settle(group: list[tuple]) -> list[tuple]:
        lines = [np.frombuffer(row.hashes, np.uint64).tolist() for row in group]
        first: dict[int, int] = {}
        for n, row in enumerate(group):
            first.setdefault(row.place, n)
        results = []
        for row, own in zip(group, lines):
            near = first.get(row.place - 1) if row.place % 2 else first.get(row.place + 1)
            near = first.get(row.place - 1) if near is None else near
            shared = np.zeros(len(own), bool)
            if near is not None and row.host:
                shared, _ = shared_lines(own, lines[near])
            flags = kept_lines(np.frombuffer(row.sizes, np.int32),
                               np.frombuffer(row.zones, np.int8), shared)
            results.append((row.page, row.url, row.mark, flags.tolist()))
        return results

    for batch in batches:
        done: list[tuple] = []
        for row in batch.itertuples(index=False):
            if held and (held[0].host, held[0].pair) != (row.host, row.pair):
                done += settle(held)
                held = []
            held.append(row)
        yield pd.DataFrame(done, columns=["page", "url", "mark", "kept"])
    if held:
        yield pd.DataFrame(settle(held), columns=["page", "url", "mark", "kept"])


def extract_main_text(
    df: DataFrame, key: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """``(key, url, text, n_chars)`` for every row: its main text, blocks joined by line ends.

    Null and empty pages give an empty text with 0 characters. Pages without a host are
    compared with none. Rows that repeat key and URL share a neighbour and get a row each. Other
    columns of ``df`` are not read; an empty table gives an empty result. Pages are read whole.

    A pair is two neighbours in order of path, URL and key within a host, the last one of an
    odd number joins the pair before; so a host of any size spreads over many small groups.
    Pages themselves are not shuffled; their text is, once, when it meets its flags.
    """
    host = F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    path = F.regexp_extract("url", r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)
    whole = F.coalesce(F.col(page), F.lit(""))
    pages = df.select(F.col(key).alias("page"), F.col(url).alias("url"),
                      F.xxhash64(whole).alias("mark"), whole.alias("html"))
    kind = dict(pages.dtypes)["page"]
    listed = pages.mapInPandas(_listed, _LISTS.format(kind))
    lists = write_once(listed.dropDuplicates(["page", "url", "mark"]), "lines")
    keys = lists.select("page", "url").distinct().select(
        "page", "url", F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(path, F.lit("")).alias("path"),
    )
    ordered = write_once(
        with_position(keys, ["host", "path", "url", "page"]).drop("path"), "ordered"
    )
    hosts = write_once(
        ordered.groupBy("host").agg(F.min("position").alias("first"), F.count("*").alias("n")),
        "hosts",
    )
    place = F.col("position") - F.col("first")
    pair = F.least(F.floor(place / 2), F.greatest(F.floor(F.col("n") / 2) - 1, F.lit(0)))
    paired = write_once(
        ordered.join(hosts, "host").select(
            F.col("page").alias("_page"), F.col("url").alias("_url"), "host",
            place.alias("place"), pair.cast("long").alias("pair"),
        ),
        "paired",
    )
    same = F.col("page").eqNullSafe(F.col("_page")) & F.col("url").eqNullSafe(F.col("_url"))
    placed = lists.join(paired, same).drop("_page", "_url")
    grouped = placed.repartition("host", "pair").sortWithinPartitions(
        "host", "pair", "place", "mark")
    decided = grouped.mapInPandas(
        _difference, f"page {kind}, url string, mark long, kept array<boolean>")
    decided = write_once(decided, "decided").select(
        F.col("page").alias("_page"), F.col("url").alias("_url"), F.col("mark").alias("_mark"),
        "kept")
    texts = pages.mapInPandas(_texts, f"page {kind}, url string, mark long, lines array<string>")
    flagged = texts.join(decided, same & (F.col("mark") == F.col("_mark")))
    chosen = F.filter("lines", lambda line, n: F.get("kept", n))
    return flagged.select("page", "url", F.array_join(chosen, "\n").alias("text")).select(
        F.col("page").alias(key), F.col("url").alias(url), "text",
        F.char_length("text").cast("long").alias("n_chars"),
    )
