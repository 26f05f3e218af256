"""Repeated bytes against plain sets of all strings."""

import random
from hashlib import sha256

import numpy as np
import pytest

from tallyfit.llm import repeated_bytes as module
from tallyfit.llm.catalog import QUERIES
from tallyfit.llm.repeated_bytes import (
    BlindTrie, deep_shallow, merged, repeated_bytes, repeated_offsets, runs_of, without,
)

FOLDER = "/root/testdata/sf0.001"


def expected(rows, length):
    texts = [(text or "").encode() for _, text in rows]
    seen = {}
    for text in texts:
        for n in range(len(text) - length + 1):
            seen[text[n:n + length]] = seen.get(text[n:n + length], 0) + 1
    found = []
    for (key, _), text in zip(rows, texts):
        spans = merged([(n, n + length) for n in range(len(text) - length + 1)
                        if seen[text[n:n + length]] > 1])
        kept = bytes(b for n, b in enumerate(text) if not any(s <= n < e for s, e in spans))
        assert kept == without(text, spans)
        found.append((key, len(text), tuple(spans), sha256(kept).hexdigest()))
    return sorted(found, key=str)


def rows_of(df, key="doc_id"):
    return sorted([(r[key], r.n_bytes, tuple((s.start, s.end) for s in r.spans), r.kept_sha256)
                   for r in df.collect()], key=str)


def test_deep_shallow_equals_sorting():
    pick = random.Random(1)
    for top in (1, 3, 255):
        strings = [bytes(pick.randint(0, top) for _ in range(pick.randint(0, 150)))
                   for _ in range(300)]
        strings += [b"a" * 70 + bytes([pick.randint(0, 2)]) * pick.randint(0, 40)
                    for _ in range(300)]
        group = np.array([pick.randint(0, 3) for _ in strings])
        order, common = deep_shallow(strings, group)
        assert [(group[n], strings[n]) for n in order] == sorted(zip(group, strings))
        for at in range(1, len(order)):
            a, b = strings[order[at - 1]], strings[order[at]]
            same = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[at] == (same if group[order[at]] == group[order[at - 1]] else -1)
        trie = BlindTrie(strings, 0)
        for number in range(1, len(strings)):
            trie.add(number)
        assert [strings[n] for n in trie.ordered()] == sorted(strings)


def test_equal_windows_have_equal_anchors():
    pick = random.Random(2)
    text = bytes(pick.choice(b"ab") for _ in range(3000))
    content = text[:900] + text[300:900] + text
    ends = np.array([900, 1500, 4500])
    hashes, anchor, first, last = runs_of(content, ends, 60, 20)
    seen, covered = {}, 0
    for h, a, f, l in zip(hashes.tolist(), anchor.tolist(), first.tolist(), last.tolist()):
        for start in range(f, l + 1):
            assert start <= a <= start + 40
            covered += 1
            assert seen.setdefault(content[start:start + 60], (h, a - start)) == (h, a - start)
    assert covered == sum(n - 59 for n in (900, 600, 3000))


def test_offsets_equal_all_pairs():
    pick = random.Random(3)
    runs = []
    for _ in range(150):
        least = pick.randint(0, 10)
        most = pick.randint(least, 10)
        left = bytes(pick.choice(b"ab") for _ in range(most))
        right = b"gramgramgr" + bytes(pick.choice(b"aaaaaaaab") for _ in range(10 - least))
        runs.append((pick.randint(0, 1), least, most, left + right))
    group, least, most, contexts = (list(c) for c in zip(*runs))
    flags = repeated_offsets(contexts, *map(np.array, (group, least, most)), 20)
    for n, (g, a, b, c) in enumerate(runs):
        for o in range(11):
            own = c[b - o:b - o + 20] if a <= o <= b else None
            other = any(m != n and g2 == g and a2 <= o <= b2 and c2[b2 - o:b2 - o + 20] == own
                        for m, (g2, a2, b2, c2) in enumerate(runs))
            assert (flags[n, o] if o < flags.shape[1] else False) == (own is not None and other)


def texts(pick, alphabet="abcde", count=120):
    passages = ["".join(pick.choice(alphabet) for _ in range(pick.randint(30, 120)))
                for _ in range(12)]
    made = []
    for n in range(count):
        parts = []
        for _ in range(pick.randint(0, 6)):
            parts.append(pick.choice(passages)[pick.randint(0, 20):])
            parts.append("".join(pick.choice(alphabet) for _ in range(pick.randint(0, 60))))
        made.append((n, "".join(parts)))
    return made


SCHEMA = "doc_id long, text string, gram string, runs int"


@pytest.mark.parametrize("group,piece", [(2000, 1 << 20), (3, 1 << 20), (2000, 90)])
def test_equals_plain_sets(spark, monkeypatch, group, piece):
    monkeypatch.setattr(module, "GROUP", group)
    monkeypatch.setattr(module, "PIECE", piece)
    pick = random.Random(group + piece)
    rows = texts(pick) + texts(pick, "ab", 20)
    common = "the common line that all of these have"
    rows += [(1000 + n, "".join(pick.choice("xyz") for _ in range(30)) + common + "".join(
        pick.choice("xyz") for _ in range(n % 30))) for n in range(60)]
    rows += [(n, rows[n][1]) for n in range(5)] + [(7, "other"), (None, rows[9][1]), (None, None)]
    rows += [(2000, ""), (2001, None), (2002, "z" * 500), (2003, "é" * 30 + "\0" * 50),
             (2004, "\0" * 45), (2005, rows[3][1] * 3)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert rows_of(repeated_bytes(df, length=40, gram=10)) == expected(rows, 40)


def test_empty(spark):
    assert repeated_bytes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    found = {r.doc_id: r for r in QUERIES["op12_deep_shallow_repeats"](spark, FOLDER).collect()}
    rows = expected([tuple(r) for r in documents.collect()], 200)
    assert len(rows) == len(found)
    for key, size, spans, digest in rows:
        row = found[key]
        assert (row.n_bytes, row.n_spans, row.kept_sha256) == (size, len(spans), digest)
        assert row.n_removed == sum(e - s for s, e in spans)
    assert any(r.n_removed for r in found.values())
