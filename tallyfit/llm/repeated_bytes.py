"""Bytes that repeated strings cover, found by sorting sparse suffixes.

Of every window of ``LENGTH`` bytes the gram of ``GRAM`` bytes with the smallest hash is its
anchor, so equal windows have their anchors at the same place. Neighbouring windows with one
anchor form a run. Grams that occur once in all documents settle their windows; so do runs that
are repeated whole. What is left are runs whose gram recurs in other surroundings, the edges of
repeated passages. Their suffixes from the anchor on, and their prefixes read backwards, are
sorted deep and shallow: multikey quicksort over eight bytes at a time to a shallow depth, then a
blind trie for every group that still shares a prefix. Longest common prefixes of neighbours in
the two orders tell for every place of the anchor which windows are equal.

Only anchors are shuffled, one for about 64 bytes, and texts that have repeated grams.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import write_once

LENGTH = 200
GRAM = 50
PIECE = 1 << 20  # bytes hashed at once
SHALLOW = 64  # bytes that quicksort looks at
GROUP = 2_000  # runs of one gram that are compared in one task; larger groups are split
SORTED = 20_000  # runs that are sorted at once
_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 24) - 1)


@cache
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base of the rolling hash and of its inverse modulo 2**64."""
    found = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        row = np.full(count, base, np.uint64)
        row[0] = 1
        found.append(np.multiply.accumulate(row))
    return found[0], found[1]


def _smallest_in(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys, by running minima of blocks."""
    padded = np.concatenate([key, np.full(-len(key) % width, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, 1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    count = len(key) - width + 1
    return np.minimum(behind[:count], ahead[width - 1:width - 1 + count])


def runs_of(content: bytes, ends: np.ndarray, length: int, gram: int):
    """Runs of windows in texts that end at ``ends``: the anchor's hash, its place, and the first
    and last window of the run."""
    nothing = np.zeros(0, np.int64)
    if len(content) < length:
        return nothing.astype(np.uint64), nothing, nothing, nothing
    power, inverse = _powers(1 << max(20, len(content).bit_length()))
    total = np.zeros(len(content) + 1, np.uint64)
    np.cumsum((np.frombuffer(content, np.uint8) + np.uint64(1)) * power[:len(content)],
              out=total[1:])
    hashes = (total[gram:] - total[:-gram]) * inverse[:len(content) - gram + 1]
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    key = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    # Of equal grams in a window the first one counts.
    chosen = (_smallest_in(key, length - gram + 1) & _PLACE).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(len(chosen) + 1, np.int64)
    long = ends - starts >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    # Windows of two texts never share an anchor unless one window lies in both.
    change = np.concatenate([[True], chosen[1:] != chosen[:-1], [True]])
    text_start = np.zeros(len(chosen) + 1, bool)
    text_start[starts[starts < len(chosen)]] = True
    outside = np.concatenate([[True], ~inside, [True]])
    first = np.flatnonzero(inside & (change[:-1] | outside[:-2] | text_start[:-1]))
    last = np.flatnonzero(inside & (change[1:] | outside[2:] | text_start[1:]))
    return hashes[chosen[first]], chosen[first], first, last


def _pieces(texts: Sequence[bytes], length: int) -> Iterator[tuple[bytes, np.ndarray, list]]:
    """Texts, long ones in overlapping parts, joined to pieces of a bounded size: content, ends
    of its parts, and ``(text, offset)`` of each part."""
    held, size, origin = [], 0, []
    for number, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[offset:offset + PIECE + length - 1]
            if len(part) < length:
                continue
            held.append(part)
            origin.append((number, offset))
            size += len(part)
            if size >= PIECE:
                yield b"".join(held), np.cumsum([len(h) for h in held]), origin
                held, size, origin = [], 0, []
    if held:
        yield b"".join(held), np.cumsum([len(h) for h in held]), origin


def _signed(hashes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(hashes).view(np.int64)


def _gram_counts(length: int, gram: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [runs_of(c, e, length, gram)[0]
                     for c, e, _ in _pieces(batch.column("text").to_pylist(), length)]
            if found:
                hashes, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(hashes)), pa.array(np.minimum(n, 2).astype(np.int8))],
                    names=["gram", "n"])

    return count


def _runs(length: int, gram: int):
    digest = xxhash.xxh3_64_intdigest

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, marks = batch.column("key"), batch.column("mark")
            for content, ends, origin in _pieces(batch.column("text").to_pylist(), length):
                hashes, anchor, first, last = runs_of(content, ends, length, gram)
                part = np.searchsorted(ends, first, "right")
                starts = np.concatenate([[0], ends[:-1]])[part]
                text, offset = np.array(origin).T[:, part]
                least, most = anchor - last, anchor - first
                whole = np.fromiter(
                    (digest(content[a:b], s) for a, b, s in zip(
                        first.tolist(), (last + length).tolist(),
                        (least * 65536 + most).tolist())), np.uint64, len(first))
                row = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(hashes)), pa.array(_signed(whole)), keys.take(row),
                     marks.take(row), pa.array(anchor - starts + offset),
                     pa.array(least.astype(np.int16)), pa.array(most.astype(np.int16))],
                    names=["gram", "whole", "key", "mark", "anchor", "least", "most"])

    return cut


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one, in order."""
    found: list[list[int]] = []
    for start, end in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1][1] = max(found[-1][1], end)
        else:
            found.append([start, end])
    return [(s, e) for s, e in found]


def without(text: bytes, spans: Sequence[tuple[int, int]]) -> bytes:
    """What is left of a text when the given spans, in order and apart, are removed."""
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]])


_RESULT = "n_bytes long, spans array<struct<start: long, `end`: long>>, kept_sha256 string"
_MET = "key {}, mark long, " + _RESULT + ", text binary, open array<struct<gram: long, " \
    "anchor: long, least: int, most: int, alone: boolean, context: binary>>"


def _met(length: int):
    """Texts with the runs that repeat: whole runs are settled here; open ones hand on their
    bytes, and texts whose open runs may cover more are kept for later."""
    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for key, mark, text, runs in zip(frame["key"], frame["mark"], frame["text"],
                                             frame["runs"]):
                spans, contexts, alone = [], [], set()
                runs = [] if runs is None else [
                    (r["anchor"], r["least"], r["most"], r["gram"], r["state"]) for r in runs]
                for anchor, least, most, gram, state in runs:
                    if state:
                        contexts.append((gram, anchor, least, most, state == 1, text[
                            anchor - most:anchor - least + length]))
                    if state == 1:
                        alone.add((anchor, least, most))
                spans = merged([(a - most, a - least + length) for a, least, most, *_ in runs
                                if (a, least, most) not in alone])
                rest = without(text, spans)
                rows.append((key, mark, len(text), spans,
                             None if alone else sha256(rest).hexdigest(),
                             text if alone else None, contexts))
            yield pd.DataFrame(rows, columns=["key", "mark", "n_bytes", "spans", "kept_sha256",
                                              "text", "open"])

    return meet


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class BlindTrie:
    """Strings in a compact trie whose nodes know only where their strings first differ: a
    string goes down by single bytes without looking at what lies between, is compared once
    with the string it arrives at, and is put in where the two part."""

    def __init__(self, strings: Sequence[bytes], first: int):
        self.strings = strings
        self.root: list = [None, [first]]  # leaf: [None, numbers]; node: [depth, {byte: child}]

    def _byte(self, text: bytes, depth: int) -> int:
        return text[depth] if depth < len(text) else -1

    def add(self, number: int) -> None:
        text = self.strings[number]
        node = self.root
        while node[0] is not None:
            children = node[1]
            node = children.get(self._byte(text, node[0])) or next(iter(children.values()))
        other = self.strings[node[1][0]]
        depth = common_prefix(text, other)
        if depth == len(text) == len(other):
            node[1].append(number)
            return
        node = self.root
        while node[0] is not None and node[0] < depth:
            node = node[1][self._byte(text, node[0])]
        byte = self._byte(text, depth)
        if node[0] == depth:
            node[1][byte] = [None, [number]]
        else:
            below = list(node)
            node[:] = [depth, {self._byte(other, depth): below, byte: [None, [number]]}]

    def ordered(self) -> list[int]:
        found, waiting = [], [self.root]
        while waiting:
            depth, content = waiting.pop()
            if depth is None:
                found += content
            else:
                waiting += [content[b] for b in sorted(content, reverse=True)]
        return found


def shallow_order(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of all groups at once: the order of the rows, and for each place the
    segment of rows that agree in all words. Every step parts each open segment into words
    below, at and above a pivot; the middle part goes on with the next word."""
    order = np.argsort(group, kind="stable")
    start = np.concatenate([[True], group[order][1:] != group[order][:-1]]) if len(order) \
        else np.zeros(0, bool)
    segment = np.cumsum(start) - 1
    depth = np.zeros(segment[-1] + 1 if len(segment) else 0, np.int64)
    while True:
        size = np.bincount(segment, minlength=len(depth))
        is_open = (size > 1) & (depth < words.shape[1])
        at = np.flatnonzero(is_open[segment])
        if not len(at):
            return order, segment
        own, row = segment[at], order[at]
        word = words[row, depth[own]]
        edge = np.concatenate([[True], own[1:] != own[:-1]])
        begin = np.flatnonzero(edge)
        count = np.diff(np.append(begin, len(at)))
        pivot = np.repeat(word[begin + count // 2], count)
        side = 1 + (word > pivot).astype(np.int64) - (word < pivot)
        new = np.argsort(own * 3 + side, kind="stable")
        order[at] = row[new]
        kind = np.zeros(len(order), np.int64)
        kind[at] = side[new]
        parted = segment * 3 + kind
        start = np.concatenate([[True], parted[1:] != parted[:-1]])
        depth = depth[segment[start]] + (is_open[segment[start]] & (kind[start] == 1))
        segment = np.cumsum(start) - 1


def deep_shallow(strings: Sequence[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of strings inside their groups, and the longest common prefix of each with the
    one before it, -1 where a group begins."""
    width = -(-max(SHALLOW, max(map(len, strings), default=0)) // 8) * 8
    padded = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8)
    padded = padded.reshape(len(strings), width)
    words = np.ascontiguousarray(padded[:, :SHALLOW]).view(">u8").astype(np.uint64)
    order, segment = shallow_order(words, group)
    size = np.bincount(segment) if len(segment) else np.zeros(0, np.int64)
    ends = np.cumsum(size)
    for number in np.flatnonzero(size > 1):
        start, end = ends[number] - size[number], ends[number]
        rows = order[start:end].tolist()
        trie = BlindTrie(strings, rows[0])
        for row in rows[1:]:
            trie.add(row)
        order[start:end] = trie.ordered()
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))[order]
    common = np.full(len(strings), -1, np.int64)
    if len(strings) > 1:
        sorted_rows = padded[order]
        differ = sorted_rows[1:] != sorted_rows[:-1]
        agree = np.where(differ.any(1), differ.argmax(1), width)
        common[1:] = np.minimum(agree, np.minimum(lengths[1:], lengths[:-1]))
        common[1:][group[order][1:] != group[order][:-1]] = -1
    return order, common


def repeated_offsets(contexts: Sequence[bytes], group: np.ndarray, least: np.ndarray,
                     most: np.ndarray, length: int) -> np.ndarray:
    """Per run a row of flags, one for each distance from window to anchor: whether another run
    of its group has an equal window at that distance."""
    after = [c[m:] for c, m in zip(contexts, most.tolist())]
    before = [c[:m][::-1] for c, m in zip(contexts, most.tolist())]
    classes = []
    for strings in (after, before):
        order, common = deep_shallow(strings, group)
        classes.append((np.argsort(order), common))
    flags = np.zeros((len(contexts), int(most.max(initial=0)) + 1), bool)
    for distance in range(int(least.min(initial=0)), flags.shape[1]):
        own = np.flatnonzero((least <= distance) & (distance <= most))
        (place, common), (back, common_back) = classes
        right = np.cumsum(common < length - distance)[place[own]]
        left = np.cumsum(common_back < distance)[back[own]]
        pair = right * (len(contexts) + 1) + left
        by = np.argsort(pair, kind="stable")
        same = pair[by][1:] == pair[by][:-1]
        flags[own[by[1:][same]], distance] = True
        flags[own[by[:-1][same]], distance] = True
    return flags


_FOUND = "key {}, mark long, start long, `end` long"


def _compared(length: int):
    """Windows that open runs share with others of their gram, as spans of their texts; groups
    come sorted, and many small ones are sorted together."""
    def settle(rows: list[tuple]) -> pd.DataFrame:
        group, key, mark, anchor, least, most, alone, contexts = zip(*rows)
        names, number = np.unique(np.array(group, np.int64), return_inverse=True)
        flags = repeated_offsets(contexts, number, np.array(least, np.int64),
                                 np.array(most, np.int64), length)
        spans = []
        for row in np.flatnonzero(flags.any(1) & np.array(alone, bool)):
            own = np.flatnonzero(flags[row])
            for part in np.split(own, np.flatnonzero(np.diff(own) > 1) + 1):
                spans.append((key[row], mark[row], anchor[row] - int(part[-1]),
                              anchor[row] - int(part[0]) + length))
        return pd.DataFrame(spans, columns=["key", "mark", "start", "end"])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        last = None
        for frame in batches:
            for row in frame.itertuples(index=False, name=None):
                if row[0] != last and len(held) >= SORTED:
                    yield settle(held)
                    held = []
                last = row[0]
                held.append(row)
        if held:
            yield settle(held)

    return compare


def _split(rows: DataFrame, length: int) -> DataFrame:
    """Runs of large groups parted by the distance of their windows: each half of the distances
    has more bytes in common, which tell the new groups apart."""
    low, high = F.col("low"), F.col("high")
    middle = F.floor((low + high) / 2).cast("int")
    halves = F.array(F.struct(low.alias("low"), middle.alias("high")),
                     F.struct((middle + 1).alias("low"), high.alias("high")))
    parted = rows.withColumn("half", F.explode(F.filter(
        halves, lambda h: (h["low"] <= h["high"]) & (h["low"] <= F.col("most"))
        & (h["high"] >= F.col("least")))))
    least, most = F.greatest("least", "half.low"), F.least("most", "half.high")
    cut = F.substring("context", F.col("most") - most + 1,
                      most - least + length)
    parted = parted.withColumns({"context": cut, "least": least, "most": most})
    core = F.substring("context", F.col("most") - F.col("half.low") + 1,
                       length - (F.col("half.high") - F.col("half.low")))
    return parted.withColumn("group", F.xxhash64("group", "half", core)).withColumns(
        {"low": F.col("half.low"), "high": F.col("half.high")}).drop("half")


def _small_groups(rows: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """Runs in groups of a bounded size, and the spans that splitting found on the way.

    A larger group is split until it is small, or its runs are one window each. Runs of a
    split group that are equal are settled by their number, and one stays for the others.
    """
    small, settled = [], []
    columns = ["group", "key", "mark", "anchor", "least", "most", "alone", "context"]
    while True:
        # Counts of groups with many members, far fewer rows than the runs.
        large = write_once(rows.groupBy("group").count().where(F.col("count") > GROUP)
                           .select("group"), "large")
        if not large.take(1):
            small.append(rows.select(*columns))
            break
        small.append(rows.join(large, "group", "left_anti").select(*columns))
        parts = _split(rows.join(large, "group", "left_semi"), length)
        parts = write_once(parts.withColumn(
            "own", F.xxhash64("context", "least", "most")), "parts")
        one = F.struct("key", "mark", "anchor", "alone")
        texts = write_once(parts.groupBy("group", "own").agg(
            F.count("*").alias("n"), F.min(one).alias("one"), F.min("context").alias("context"),
            *[F.first(c).alias(c) for c in ("least", "most", "low", "high")]), "texts")
        again = parts.join(texts.where("n > 1").select("group", "own"), ["group", "own"])
        settled.append(again.where("alone").select(
            "key", "mark", (F.col("anchor") - F.col("most")).alias("start"),
            (F.col("anchor") - F.col("least") + length).alias("end")))
        rows = texts.where("low < high").select(
            "group", "one.key", "one.mark", "one.anchor", "least", "most",
            (F.col("one.alone") & (F.col("n") == 1)).alias("alone"), "context", "low", "high")
    found = small[0]
    for more in small[1:]:
        found = found.unionByName(more)
    return found, settled


def _finished(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        rows = []
        for key, text, spans, more in zip(frame["key"], frame["text"], frame["spans"],
                                          frame["more"]):
            pairs = [(s["start"], s["end"]) for part in (spans, more) if part is not None
                     for s in part]
            all_spans = merged(pairs)
            rest = sha256(without(text, all_spans)).hexdigest()
            rows.append((key, len(text), all_spans, rest))
        yield pd.DataFrame(rows, columns=["key", "n_bytes", "spans", "kept_sha256"])


def repeated_bytes(df: DataFrame, key: str = "doc_id", text: str = "text",
                   length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``(key, n_bytes, spans, kept_sha256)`` for every row: the spans of its bytes, in order and
    apart, that strings of ``length`` bytes cover which start more than once in all texts; and
    the digest of the bytes that are left.

    A null text is empty; texts shorter than ``length`` have no span. Rows that repeat are texts
    each, so they repeat each other. Keys may be null or repeat: rows are told apart by key and
    a 64-bit hash of the text. Other columns are not read. An empty table gives an empty
    result. Texts are read whole, in overlapping pieces of about one megabyte.

    Copies of a text meet as counts of their runs' digests, not as pairs.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(key).alias("key"), F.xxhash64(whole).alias("mark"),
                     whole.cast("binary").alias("text"))
    kind = dict(rows.dtypes)["key"]
    counted = rows.select("text").mapInArrow(_gram_counts(length, gram), "gram long, n byte")
    often = write_once(counted.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1")
                       .select("gram"), "grams")
    runs = rows.mapInArrow(_runs(length, gram), f"gram long, whole long, key {kind}, mark long, "
                           "anchor long, least short, most short")
    runs = write_once(runs.join(often, "gram", "left_semi"), "runs")
    place = ["key", "mark", "anchor", "least", "most"]
    texts = write_once(runs.groupBy("gram", "whole").agg(
        F.count("*").alias("n"), F.min(F.struct(*place)).alias("one")), "texts")
    several = write_once(texts.groupBy("gram").count().where("count > 1").select("gram"),
                         "several")
    # Runs to compare: those that occur once, and one of each text that those may share with.
    asked = texts.join(several, "gram", "left_semi").select(
        "gram", "one.*", F.when(F.col("n") == 1, 1).otherwise(2).alias("state"))
    told = runs.select(F.lit(0).cast("long").alias("gram"), *place, F.lit(0).alias("state"))
    by_text = told.unionByName(asked).groupBy("key", "mark").agg(F.collect_set(
        F.struct("anchor", "least", "most", "gram", "state")).alias("runs"))
    by_text = by_text.select(F.col("key").alias("_key"), F.col("mark").alias("_mark"), "runs")
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("mark") == F.col("_mark"))
    met = write_once(
        rows.join(by_text, same, "left").select("key", "mark", "text", "runs")
        .mapInPandas(_met(length), _MET.format(kind)), "met")
    contexts = met.where(F.size("open") > 0).select(
        "key", "mark", F.explode("open").alias("o")).select(
        F.col("o.gram").alias("group"), "key", "mark", "o.anchor", "o.least", "o.most",
        "o.alone", "o.context", F.lit(0).alias("low"), F.lit(length - gram).alias("high"))
    small, settled = _small_groups(contexts, length)
    found = small.repartition("group").sortWithinPartitions("group").mapInPandas(
        _compared(length), _FOUND.format(kind))
    for more in settled:
        found = found.unionByName(more)
    spans = write_once(found, "found").groupBy("key", "mark").agg(
        F.collect_set(F.struct("start", "end")).alias("more"))
    spans = spans.select(F.col("key").alias("_key"), F.col("mark").alias("_mark"), "more")
    late = met.where("text IS NOT NULL").join(spans, same, "left").select(
        "key", "text", "spans", "more").mapInPandas(_finished, f"key {kind}, " + _RESULT)
    done = met.where("text IS NULL").select("key", "n_bytes", "spans", "kept_sha256")
    return done.unionByName(late).withColumnRenamed("key", key)
