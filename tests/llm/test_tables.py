"""Operators on whole tables: leaks, shards, mixes, and the pipeline over them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyfit.llm import decontamination
from tallyfit.llm.catalog import QUERIES
from tallyfit.llm.decontamination import find_leaks, without_leaks
from tallyfit.llm.resharding import cheapest_transfers, equal_fill, reshard, rewrite_affected
from tallyfit.llm.source_mixing import (
    capped_targets, deal_blocks, mix_sources, mixed_rows, split_quotas,
)

FOLDER = "/root/testdata/sf0.001"


def test_transfers_are_cheapest():
    random = np.random.default_rng(1)
    for _ in range(20):
        supply = random.integers(0, 5, 3)
        demand = np.bincount(random.integers(0, 3, supply.sum()), minlength=3)
        cost = random.integers(1, 9, (3, 3)).astype(float)
        flow = np.array(cheapest_transfers(supply, demand, cost))
        assert (flow.sum(1) == supply).all() and (flow.sum(0) == demand).all()
        units = [i for i, n in enumerate(supply) for _ in range(n)]
        places = {tuple(demand): 0.0}
        for i in units:  # all ways of placing the units one by one
            ways = {}
            for left, paid in places.items():
                for j in range(3):
                    if left[j]:
                        key = left[:j] + (left[j] - 1,) + left[j + 1:]
                        ways[key] = min(ways.get(key, 1e9), paid + cost[i, j])
            places = ways
        assert (flow * cost).sum() == pytest.approx(min(places.values()))
    assert equal_fill([5, 0, 2], 12) == [0, 4, 1] and equal_fill([0, 0], 0) == [0, 0]


def test_reshard(spark, tmp_path):
    rows = [(i, f"t{i}", 10 + i % 7, i % 3) for i in range(3000)]
    rows += [(7, "t7", 10, 1), (7, "t7", 10, 1), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, old int")
    df = df.withColumn("shard", F.lit("taken"))
    found = reshard(df, "doc_id", "n", "old", shards=4)
    table = found.toPandas()
    assert len(table) == len(rows) and set(table["shard"]) == {0, 1, 2, 3}
    sizes = table.groupby("shard")["n"].sum()
    assert sizes.max() - sizes.min() <= 40
    for _, slots in table.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))
    moved = table[table["shard"] != table["old"].fillna(0)]["n"].sum()
    assert moved <= table["n"].sum() / 4 + 60  # what the new shard needs, and no more
    again = found.toPandas().sort_values(["shard", "slot"]).reset_index(drop=True)
    assert again.equals(table.sort_values(["shard", "slot"]).reset_index(drop=True))
    affected = rewrite_affected(found, f"{tmp_path}/new", "old")
    assert affected == [0, 1, 2, 3]
    assert spark.read.parquet(f"{tmp_path}/new").count() == len(rows)
    assert reshard(df.limit(0), "doc_id", "n", "old").count() == 0


def test_equal_texts_share_a_shard(spark):
    pick = np.random.default_rng(4)
    rows = [(i, f"{'x' * 40}{n % 100:03d}", n % 100) for i, n in enumerate(
        pick.permutation(1000).tolist())]
    rows += [(2000 + i, "one large group of copies" * 3, 7) for i in range(500)]
    names = "place size inside row runs position minus begun _old _size _place _runs".split()
    df = spark.createDataFrame(rows, "doc_id long, text string, old int")
    df = df.withColumn("n", F.length("text").cast("long"))
    df = df.withColumns({name: F.lit(name) for name in names})
    found = reshard(df, "doc_id", "n", "old", shards=5)
    assert found.columns == [*df.columns, "shard", "slot"]
    table = found.toPandas()
    assert len(table) == len(rows) and all((table[name] == name).all() for name in names)
    for _, slots in table.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))
    groups = table.groupby("text")
    assert groups["shard"].nunique().max() == 1 and len(groups) == 101
    sizes = table.groupby("shard")["n"].sum()
    total, largest = table["n"].sum(), 500 * 75
    assert len(sizes) == 5 and sizes.max() <= max(largest + 10 * 43, total / 5 + 10 * 43)
    assert sizes.drop(table[table["doc_id"] >= 2000]["shard"].iloc[0]).max() < largest


def test_fewest_bytes_move(spark):
    rows = [(i, f"t{i:04d}", 1, i % 2) for i in range(1200)] + [
        (2000 + i, f"u{i:04d}", 1, 2) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long, old int")
    table = reshard(df, "doc_id", "n", "old", shards=4).toPandas()
    # 600, 600 and 300 units become 375 each: 450 have to leave the first two, and no more.
    assert table.groupby("shard")["n"].sum().tolist() == [375] * 4
    assert table[table["shard"] != table["old"]]["n"].sum() == 450


def test_dear_transfers_are_avoided(spark):
    rows = [(i, f"t{i:04d}", 1, i % 2) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long, old int")
    cost = [[0, 1, 1, 9], [1, 0, 9, 1]]  # shard 0 is far from 3 and shard 1 from 2
    table = reshard(df, "doc_id", "n", "old", shards=4, cost=cost).toPandas()
    assert table.groupby(["old", "shard"])["n"].sum().to_dict() == {
        (0, 0): 300, (0, 2): 300, (1, 1): 300, (1, 3): 300}


def test_targets_and_quotas():
    assert capped_targets([100, 100, 1], [1, 2, 3]) == pytest.approx([66, 132, 3])
    quotas = [50, 3, 0, 17]
    share = split_quotas(quotas, 5)
    assert share.sum(0).tolist() == quotas and set(share.sum(1)) == {14}
    dealt = deal_blocks(quotas, 5)
    assert [len(d) for d in dealt] == quotas
    assert [d.count(2) for d in dealt] == share[2].tolist()
    mean = np.mean([split_quotas([40, 10], 5, s)[0] for s in range(400)], axis=0)
    assert np.allclose(mean, [8, 2], atol=0.3)


def test_mix(spark):
    random = np.random.default_rng(2)
    rows = [(i, f"s{i % 4}" if i % 9 else None, "w " * int(random.integers(1, 60)), 5)
            for i in range(1500)]
    rows += [(2000, "s0", None, 1), (2001, "zero", "", 1), (2002, None, " ", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, size int")
    mixed = mix_sources(df)
    table = mixed.withColumn("turns", F.size("draws")).toPandas()
    assert len(table) == len(rows)
    table["source"] = table["source"].fillna("~")
    total = table["size"].sum()
    by = table.groupby("source").agg(s=("size", "sum"), z=("source_size", "first"),
                                     t=("target", "first"))
    taken = (table["turns"] * table["size"]).groupby(table["source"]).sum()
    names = sorted(by.index)  # "~" stands for null, which comes last
    weights = [(1, 2, 3)[n % 3] for n in range(len(names))]
    expected = capped_targets([int(by.z[n]) for n in names], weights)
    assert (by.s == by.z).all() and by.t[names].tolist() == pytest.approx(expected)
    assert by.t.sum() == pytest.approx(total)
    assert (abs(taken - by.t) <= 15).all() and table["turns"].max() <= 3
    out = mixed_rows(mixed)
    assert out.count() == table["turns"].sum()
    shards = out.groupBy("shard").agg(F.sum("size")).toPandas()
    assert shards["shard"].between(0, 15).all() and len(shards) == 16
    again = mix_sources(df.repartition(5)).withColumn("turns", F.size("draws")).toPandas()
    assert dict(zip(again.doc_id, again.turns)) == dict(zip(table.doc_id, table.turns))
    assert mix_sources(df.limit(0)).count() == 0
    names = "_place _source _passes _end _extra _blocks _shards row turn draw shard".split()
    other = mix_sources(df.withColumns({n: F.lit(n) for n in names}))
    found = other.withColumn("turns", F.size("draws")).toPandas()
    assert all((found[n] == n).all() for n in names)
    assert dict(zip(found.doc_id, found.turns)) == dict(zip(table.doc_id, table.turns))
    assert mixed_rows(other).where("row <> 'row' OR turn <> 'turn'").count() == 0


def test_closest_fill():
    from tallyfit.llm.source_mixing import closest_fill

    assert closest_fill(10.0, {11: 1, 4: 1, 3: 1}) == {11: 1}
    assert closest_fill(100.5, {60: 1, 30: 5, 7: 2}) == {60: 1, 30: 1, 7: 1}
    assert closest_fill(100.0, {40: 9}) == {40: 3 - 1}
    assert closest_fill(0.4, {1: 3}) == {} and closest_fill(0.6, {1: 3}) == {1: 1}
    pick = np.random.default_rng(6)
    for _ in range(300):
        gap = float(pick.integers(1, 500)) + 0.25
        sizes, numbers = np.unique(pick.integers(1, 2 * int(gap) + 1, 12), return_counts=True)
        counts = dict(zip(sizes.tolist(), numbers.tolist()))
        fill = closest_fill(gap, counts)
        assert all(1 <= n <= counts[s] for s, n in fill.items())
        off = abs(gap - sum(s * n for s, n in fill.items()))
        assert off <= min([gap] + [abs(gap - s) for s in counts])  # no document, or one
        left = [s for s in counts if counts[s] > fill.get(s, 0)]
        assert not left or off <= max(left) / 2


def test_mix_fills_what_a_long_document_leaves(spark):
    random = np.random.default_rng(9)
    words = (random.pareto(0.8, 1200) * 5 + 1).clip(max=4000).astype(int).tolist()
    rows = [(i, f"s{i % 6}" if i % 6 else None, "w " * n) for i, n in enumerate(words)]
    rows += rows[:60] + rows[:60]  # these are drawn three at a time
    table = mix_sources(spark.createDataFrame(
        rows, "doc_id long, source string, text string").repartition(3)).toPandas()
    assert len(table) == 1320
    table["turns"], table["source"] = table["draws"].map(len), table["source"].fillna("~")
    for _, own in table.groupby("source"):
        units = own.groupby("doc_id").agg(size=("size", "sum"), turns=("turns", "first"))
        left = units[units["turns"] == units["turns"].min()]["size"]
        off = (own["turns"] * own["size"]).sum() - own["target"].iloc[0]
        assert units["turns"].max() - units["turns"].min() <= 1
        assert abs(off) <= left.min() / 2
        shards = own[own["turns"] > 0]["draws"].map(lambda d: [x["shard"] for x in d])
        assert all(0 <= s < 16 for own_shards in shards for s in own_shards)


def test_leaks(spark):
    words = [f"Word{n}" for n in range(60)]
    passage = " ".join(words[:30])
    swapped = [w if n % 8 else "other" for n, w in enumerate(words[:30])]
    short = "alpha beta gamma delta epsilon zeta eta theta"
    bench = spark.createDataFrame(
        [(1, passage), (2, short), (3, "too short"), (4, None), (None, " ".join(words[40:]))],
        "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, f"x y {passage} z", 0), (2, ", ".join(swapped).upper(), 0), (3, f"so {short}, so", 0),
         (4, "too short", 0), (5, None, 0), (6, "", 0), (7, " ".join(words[:6]) + " and then on",
         0), (8, "a " * 5000 + " ".join(words[5:28]), 0), (None, " ".join(words[40:]), 0),
         (9, " ".join(reversed(words)), 0), (1, f"x y {passage} z", 0)],
        "doc_id long, text string, item int")
    found = find_leaks(docs, bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {
        (1, 1), (2, 1), (3, 2), (8, 1), (None, None)}
    assert found.count() == 5
    clean = without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [4, 5, 6, 7, 9]
    assert find_leaks(docs.limit(0), bench).count() == 0
    assert find_leaks(docs, bench.limit(0)).count() == 0
    assert without_leaks(docs, bench.limit(0)).count() == 11


def test_leaks_equal_brute_force(spark):
    import re
    found = QUERIES["op3_spaced_seed_leaks"](spark, FOLDER)
    assert "Python" not in found._jdf.queryExecution().toString()
    cut = re.compile(r"[\W_]+")
    bench = {r.item_id: f" {cut.sub(' ', r.text.lower()).strip()} "
             for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    whole = {(r.doc_id, i) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
             for i, t in bench.items() if t in f" {cut.sub(' ', r.text.lower()).strip()} "}
    assert whole <= {(r.doc_id, r.item_id) for r in found.collect()}


@pytest.mark.parametrize("marked", [1 << 23, 100])
def test_large_benchmark_finds_the_same(spark, monkeypatch, marked):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    # An item that stands there a hundred times shares each of its windows a hundred times.
    copies = bench.orderBy("item_id").limit(1).withColumn(
        "item_id", F.explode(F.expr("sequence(100001L, 100100L)")))
    bench = bench.unionByName(copies)
    whole = {tuple(r) for r in find_leaks(documents, bench).collect()}
    monkeypatch.setattr(decontamination, "WINDOWS", 10)
    monkeypatch.setattr(decontamination, "MARKED", marked)
    found = find_leaks(documents, bench)
    assert "Python" not in found._jdf.queryExecution().toString()
    assert {tuple(r) for r in found.collect()} == whole and whole
    assert find_leaks(documents.limit(0), bench).count() == 0


def test_pipeline(spark):
    from tallyfit.sources import load

    documents = load(spark, FOLDER, "documents").withColumn("size", F.lit("extra"))
    sharded = corpus_pipeline.sharding_stage(spark, documents, FOLDER)
    assert sharded.where("size <> 'extra'").count() == 0 and sharded.columns == [
        *documents.columns, "old_shard", "shard", "slot"]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_copies", "decontamination", "mixing", "sharding"]
    before = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, FOLDER)
        assert after.dtypes == documents.dtypes
        assert after.where("size <> 'extra'").count() == 0
        assert after.join(before, "doc_id", "left_anti").count() == 0
        before = after.cache()
    final = corpus_pipeline.STAGES[-1][1](spark, before, FOLDER)
    assert final.count() == before.count() > 0
    empty = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0
    assert corpus_pipeline.run(spark, FOLDER).where("slot IS NULL").count() == 0
