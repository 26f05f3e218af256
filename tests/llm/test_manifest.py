"""The Merkle manifest against a tree built in plain Python."""

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest

from tallyfit.llm import merkle_manifest
from tallyfit.llm.catalog import QUERIES
from tallyfit.llm.merkle_manifest import (
    Subtree, address, audited, folded, height_of, nodes_of, read_steps, written_steps,
)

FOLDER = "/root/testdata/sf0.001"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves):
    """All levels from the leaves up, and each leaf's siblings per level."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([H(*row[n:n + 3]) for n in range(0, len(row), 3)])
    paths = []
    for leaf in range(len(leaves)):
        path, at = [], leaf
        for row in levels[:-1]:
            start = at - at % 3
            path.append((row[start:at], row[at + 1:start + 3]))
            at //= 3
        paths.append(path)
    return levels[-1][0], paths


def expected(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    parts = {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0,
                                                  H(*map(field, r))))
        parts[name] = own, *tree([H(*map(field, r)) for r in own])
    root, above = tree([parts[n][1] for n in names])
    found = []
    for name, upper in zip(names, above):
        own, subroot, paths = parts[name]
        for row, path in zip(own, paths):
            leaf = H(*map(field, row))
            shown, steps = row, path + upper
            key = "" if row[0] is None else str(row[0])
            if zlib.crc32(key.encode()) % 2 == 0 and row[4] is not None:
                shown = (*row[:4], row[4].replace("\n", ""))
            digest = H(*map(field, shown))
            for before, after in steps:
                digest = H(*before, digest, *after)
            proof = H(*[d for b, a in steps for d in b + a])
            found.append((row[0], leaf, subroot, root, proof, digest, digest == root))
    return sorted(found, key=str)


def rows_of(df):
    return sorted(map(tuple, df.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    ).collect()), key=str)


def test_order_is_van_emde_boas():
    for levels in range(1, 8):
        places = np.concatenate([address(levels, d, np.arange(3 ** d)) for d in range(levels)])
        assert sorted(places) == list(range(nodes_of(levels)))
    # Four levels: the top two, then nine bottom trees of two levels, each in one stretch.
    assert address(4, 1, np.arange(3)).tolist() == [1, 2, 3]
    assert address(4, 2, np.arange(3)).tolist() == [4, 8, 12]
    assert address(4, 3, np.arange(4)).tolist() == [5, 6, 7, 9]


@pytest.mark.parametrize("count", [1, 2, 3, 4, 9, 10, 28, 100])
def test_subtree(count):
    leaves = [H(str(n)) for n in range(count)]
    root, paths = tree(leaves)
    made = Subtree.built(leaves, height_of(count))
    assert made.root == root
    for n, leaf in enumerate(leaves):
        steps = made.siblings(n)
        assert steps == paths[n] and folded(leaf, steps) == root
        assert read_steps(written_steps(steps)) == steps


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp int, leaf int"


@pytest.mark.parametrize("height", [2, 7])
def test_equals_plain_python(spark, monkeypatch, height):
    monkeypatch.setattr(merkle_manifest, "HEIGHT", height)
    pick = random.Random(height)
    rows = [(n, pick.choice(["a", "a", "a", "a", "b", "é", "z" * 40, None]), "en", n % 7,
             f"line {n}\nand more\n" * (n % 3)) for n in range(200)]
    rows += [(n, f"only {n}", None, None, None) for n in range(400, 415)]
    rows += [(7, "a", "en", 0, "x\n"), (7, "a", "en", 0, "x\n"), (None, "a", None, 1, "y\n"),
             (None, None, None, None, None), (2 ** 60 + 1, "", "", 0, ""),
             (9, "b", "en", 5, "é\n" * 200_000)]
    pick.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    assert rows_of(audited(df)) == expected(rows)


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert audited(empty).count() == 0
    row = (1, None, None, None, None)
    found = rows_of(audited(spark.createDataFrame([(*row, 1, 2)], SCHEMA)))
    assert found == expected([row])
    assert found[0][1] == found[0][2] == found[0][3] and found[0][4] == H()


def test_query(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select(
        "doc_id", "source", "lang", "n_chars", "text")
    found = QUERIES["op11_veb_merkle_manifest"](spark, FOLDER)
    assert rows_of(found) == expected([tuple(r) for r in documents.collect()])
    assert {True, False} == {r.verified for r in found.select("verified").collect()}
