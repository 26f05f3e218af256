"""Near-copy operators against brute force over all pairs."""

import numpy as np
import pytest
import xxhash

from tallyfit.llm.graphs import components, smallest_labels
from tallyfit.llm.simhash_links import (
    fingerprint, near_copy_survivors, simhash_components, trie_pairs,
)
from tallyfit.llm.vector_links import cosine_links


def reached(linked, keys):
    labels = np.arange(len(keys))
    while True:
        new = np.array([labels[row].min() for row in linked])
        if (new == labels).all():
            return [min(k for k, m in zip(keys, labels) if m == n) for n in labels]
        labels = new


def plain_fingerprint(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [words[i:i + size] for i in range(len(words) - size + 1)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


def test_fingerprint_equals_its_definition():
    for text in (None, "", " \t", "One", "a b c", "A b\x0bC d", "é A b c D e f é", "x " * 50):
        assert fingerprint(text) == plain_fingerprint(text)


def test_trie_pairs_find_every_pair():
    random = np.random.default_rng(1)
    base = random.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = base ^ (np.uint64(1) << random.integers(0, 64, 40).astype(np.uint64))
    values = np.unique(np.concatenate([base, near, base ^ np.uint64(0b1111)]))
    expected = np.triu(np.bitwise_count(values[:, None] ^ values) <= 4, 1)
    i, j = trie_pairs(values, values, True, 0, 0, 4)
    found = np.zeros_like(expected)
    found[i, j] = True
    assert (found == expected).all() and len(i) == expected.sum()
    a, b = values[::2], values[1::2]
    i, j = trie_pairs(a, b, False, 0, 0, 4)
    assert len(i) == (np.bitwise_count(a[:, None] ^ b) <= 4).sum()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert dict(found) == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert smallest_labels(4, np.array([3, 2]), np.array([1, 3])).tolist() == [0, 1, 1, 1]


def test_simhash_components_equal_brute_force(spark):
    random = np.random.default_rng(3)
    words = [f"w{n}" for n in range(300)]
    texts = []
    for _ in range(40):
        text = random.choice(words, 300).tolist()
        texts += [" ".join(text), " ".join(text), " ".join(text[:-1] + ["other"])]
    texts += ["", None, " ", "one", "ONE"]
    rows = [(i + 5, t, 1) for i, t in enumerate(texts)] + [(None, "", 2), (5, texts[0], 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    prints = np.array([plain_fingerprint(r[1]) for r in rows]).astype(np.int64).view(np.uint64)
    linked = np.bitwise_count(prints[:, None] ^ prints) <= 4
    keys = [r[0] if r[0] is not None else 10**9 for r in rows]
    expected = sorted(zip(keys, reached(linked, keys)))
    found = simhash_components(df).collect()
    assert sorted((10**9 if r[0] is None else r[0], r.component_id) for r in found) == expected
    kept = near_copy_survivors(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in expected})
    assert simhash_components(df.limit(0)).count() == near_copy_survivors(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["float", "double"])
def test_cosine_links_equal_brute_force(spark, kind):
    random = np.random.default_rng(4)
    rows, key = [], 0
    for _ in range(25):
        centre = random.standard_normal(16)
        for _ in range(8):
            vector = centre + random.standard_normal(16) * 0.08
            rows.append((key, vector.astype("f4").astype(float).tolist(), int(key % 2)))
            key += 1
    rows += [(900, rows[0][1], 0), (901, rows[0][1], 0), (902, rows[0][1], None)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15,
           [None] + [1.0] * 15, [1.0, 2.0], [1.0, 2.0]]
    rows += [(1000 + n, v, 0) for n, v in enumerate(odd)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    found = {r.vec_id: (r.n_links, r.component_id) for r in cosine_links(df).collect()}
    good = [r for r in rows if r[2] is not None and r[0] < 1000]
    x = np.array([r[1] for r in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in good])
    linked = (x @ x.T >= 0.93) & (label[:, None] == label)
    keys = [r[0] for r in good]
    assert [found[k] for k in keys] == list(zip((linked.sum(1) - 1).tolist(),
                                                reached(linked, keys)))
    assert all(found[k] == (0, k) for k in (902, *range(1000, 1006)))
    assert found[1006] == found[1007] == (1, 1006)
    assert cosine_links(df.limit(0)).count() == 0
