import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import DOCUMENTS, linked_components, prose, table
from waybill.llm import graphs, ngram_join


def near(text, seed, edits):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus():
    shared = prose("passage", 60)
    rows = [(k, prose(k, 80)) for k in range(40)]
    rows += [(100 + k, near(prose(1, 80), k, 1)) for k in range(5)] + [(110 + k, near(prose(2, 120), k, 3)) for k in range(6)]
    rows += [(200 + k, prose(1000 + k, 90) + " " + shared) for k in range(30)]
    rows += [(300 + k, near(prose("base", 150), k, 2)) for k in range(60)]
    rows += [(400, "one two three"), (401, "One  two\tTHREE"), (402, "one two"), (403, None), (404, ""), (405, " \n ")]
    rows += [(500 + k, shared + " " + prose(2000 + k, 12)) for k in range(12)]
    rows += [(600, prose("long", 20_000)), (601, near(prose("long", 20_000), 1, 300))]
    return rows


@pytest.mark.parametrize("frequent", [3, 48])
def test_equals_all_pairs(spark, monkeypatch, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    rows = corpus()
    expected = linked_components(rows)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(table(spark, rows)).collect()}
    assert found == expected
    assert found[401][1] == 400 and found[402][1] == 402


def test_joins_by_shuffle_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    rows = corpus()[:150]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(table(spark, rows)).collect()}
    assert found == linked_components(rows)


def parted(spark, *parts):
    """One partition, and so one Arrow batch, of each list of rows: a union of single partitions would be one."""
    rows = [[(i, text, "en", "s", len(text)) for i, text in part] for part in parts]
    out = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)).flatMap(lambda part: part), DOCUMENTS)
    assert out.rdd.getNumPartitions() == len(parts)
    return out


def copies(base, count):
    """Texts with one own word at the end, whose shingle is among the first: all have the same others, and no two are one group."""
    texts = [base] + [f"{base} own{k}" for k in range(40 * count)]
    sets = [own for _, own in ngram_join.shingle_sets(pa.array(texts), 5)]
    low = [text for text, own in zip(texts[1:], sets[1:]) if np.setdiff1d(own, sets[0])[0] < sets[0][20]]
    return low[:count]


def test_held_back_in_one_batch_only(spark):
    many, few = [], []
    for others in (1, 10, 30):
        texts = copies(prose(f"family{others}", 150, 5000), 120 + others)
        few += [(1000 * others + k, text) for k, text in enumerate(texts[:others])]
        many += [(1000 * others + 100 + k, text) for k, text in enumerate(texts[others:])]
    assert len(many) == 360
    found = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(parted(spark, many, few)).collect()}
    assert found == {i: i // 1000 * 1000 for i, _ in many + few}


def test_passage_held_back_in_one_batch(spark):
    passage = prose("passage", 20, 5000)
    many = [(100 + k, f"{passage} {prose(f'body{k}', 70, 5000)}") for k in range(40)]
    few = [(k, f"{text} {prose(f'end{k}', 8, 5000)}") for k, (_, text) in enumerate(many[:12])]
    found = ngram_join.near_duplicates(parted(spark, many, few)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == linked_components(many + few)


def random_sets(rng, count):
    base = rng.integers(-(2**63), 2**63, 6000)
    out = []
    for _ in range(count):
        own = base[: rng.choice([1, 40, 90, 100, 300, 700, 5900])].copy()
        at = rng.random(len(own)) < rng.choice([0, 0.05, 0.14, 0.4])
        own[at] = rng.integers(-(2**63), 2**63, int(at.sum()))
        out.append(np.unique(own))
    return out


def test_sketches_rule_out_no_link():
    rng = np.random.default_rng(3)
    sets = random_sets(rng, 60)
    sketches = ngram_join.Sketches(pa.array([ngram_join.parity(s) for s in sets] + [None], pa.binary()))
    i, j = (x.ravel() for x in np.meshgrid(np.arange(60), np.arange(60)))
    apart = ngram_join.differing(sketches, sketches, i, j)
    truth = np.array([len(np.setxor1d(sets[a], sets[b])) for a, b in zip(i, j)])
    assert (apart <= truth).all() and ((truth - apart) % 2 == 0).all() and apart.max() > 100
    sizes = np.array([len(s) for s in sets])
    may = ngram_join.may_link(sizes[i], sizes[j], apart, 75)
    both = (sizes[i] + sizes[j] - truth) // 2
    linked = 100 * both >= 75 * (sizes[i] + sizes[j] - both)
    assert not (linked & ~may).any() and may.sum() < 2 * linked.sum()
    assert (ngram_join.differing(sketches, sketches, np.array([60, 3]), np.array([2, 60])) == 0).all()


@pytest.mark.parametrize("cross", [False, True])
def test_cells_give_each_pair_once(monkeypatch, cross):
    monkeypatch.setattr(ngram_join, "TILE", 50)
    rng = np.random.default_rng(5)
    n = 40
    sets = [s for s in random_sets(rng, n)]
    cell = pa.table({
        "item": np.arange(n) // 2, "comp": rng.integers(0, 4, n), "n": [len(s) for s in sets], "place": rng.integers(0, 90, n) * (rng.random(n) < 0.5),
        "part": rng.integers(0, 2, n), "low": np.zeros(n, int), "high": np.full(n, int(cross)), "sketch": [ngram_join.parity(s) if k % 7 else None for k, s in enumerate(sets)],
    })
    rows = cell.to_pylist()
    expected = set()
    for a in range(n):
        for b in range(a):
            x, y = rows[a], rows[b]
            most = (x["n"] + y["n"]) // 2
            if x["sketch"] and y["sketch"]:
                small, large = sorted((x["sketch"], y["sketch"]), key=len)
                bits = [int.from_bytes(large[k : k + len(small)], "little") for k in range(0, len(large), len(small))]
                for other in bits[1:]:
                    bits[0] ^= other
                most = (x["n"] + y["n"] - (bits[0] ^ int.from_bytes(small, "little")).bit_count()) // 2
            most = min(most, x["n"], y["n"])
            overlap = -(-75 * (x["n"] + y["n"]) // 175)
            near = not (x["place"] and y["place"]) or (x["place"] <= x["n"] + 1 - overlap and y["place"] <= y["n"] + 1 - overlap)
            apart = x["comp"] != y["comp"] and x["item"] != y["item"] and (not cross or x["part"] != y["part"])
            if near and apart and 100 * min(x["n"], y["n"]) >= 75 * max(x["n"], y["n"]) and 100 * most >= 75 * (x["n"] + y["n"] - most):
                expected.add((b, a))
    found = [tuple(sorted(pair)) for pair in zip(*(x.tolist() for x in ngram_join.block_pairs(cell, 75)))]
    assert len(found) == len(set(found)) and set(found) == expected and expected


def test_blocks_of_large_buckets(spark, monkeypatch):
    """A family whose members nearly link, in blocks of five rows."""
    monkeypatch.setattr(ngram_join, "BLOCK", 5)
    monkeypatch.setattr(ngram_join, "HUBS", 1)
    rows = [(k, near(prose("family", 160, 5000), k, 4 + k % 9)) for k in range(90)] + corpus()[:80]
    rows = [(k, text) for k, (_, text) in enumerate(rows)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(table(spark, rows)).collect()}
    assert found == linked_components(rows)


def test_null_and_repeated_ids(spark):
    text = prose("n", 50)
    rows = [(None, text), (7, text), (7, text), (9, near(text, 1, 1)), (None, prose("m", 50)), (None, near(prose("m", 50), 2, 1))]
    found = ngram_join.near_duplicates(table(spark, rows)).collect()
    assert len(found) == 6
    assert sorted((r.component_id or -1) for r in found) == [-1, -1, 7, 7, 7, 7]
    kept = ngram_join.one_of_each(table(spark, rows)).collect()
    assert sum(r.doc_id == 7 for r in kept) == 1 and not any(r.doc_id == 9 for r in kept)


def test_empty_table(spark):
    assert ngram_join.near_duplicates(table(spark, [])).count() == 0
    assert ngram_join.near_duplicates(table(spark, [(1, None)])).collect()[0].component_id == 1


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(500, 501), (501, 500), (7, 7)]
    found = dict(map(tuple, graphs.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert {found[k] for k in range(100, 161)} == {100} and {found[k] for k in range(1, 40)} == {1} and found[501] == 500


def test_components_stay_small_tables(spark):
    """Neither tasks for hundreds of empty partitions nor an estimated size whose digits triple with each round."""
    links = spark.createDataFrame([(k, k + 1) for k in range(200)], "a long, b long").repartition(64)
    found = graphs.components(links)
    assert len(str(found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 12
    assert found.rdd.getNumPartitions() <= 8 and {r.component for r in found.collect()} == {0}


def test_classes_of_one_group_meet_with_their_sketches(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HUBS", 1)
    rows = [(3 * k + v, f"{near(prose('family', 160, 5000), k, 4 + k % 9)} end{v}") for k in range(60) for v in range(3)]
    seen, meetings = [], ngram_join.Join.meetings

    def watched(self, rows, sketched):
        seen.append((rows.count(), rows.join(sketched, "item", "left_anti").count()))
        return meetings(self, rows, sketched)

    monkeypatch.setattr(ngram_join.Join, "meetings", watched)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(table(spark, rows)).collect()}
    assert found == linked_components(rows)
    assert seen[0][0] > 0 and all(bare == 0 for _, bare in seen)


def test_components_join_a_link_in_one_round(spark, monkeypatch):
    """Families that one node holds together, and chains: after the first round few links are left to join."""
    links = [(1000 * k, 1000 * k + j) for k in range(20) for j in range(1, 60)] + [(90_000 + k, 90_001 + k) for k in range(300)]
    links += [(70_000 + j, 79_999) for j in range(50)]
    joined, write = [], graphs.written

    def watched(df):
        out = write(df)
        if out.columns == ["a", "b"]:
            joined.append(out.count())
        return out

    monkeypatch.setattr(graphs, "written", watched)
    found = dict(map(tuple, graphs.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert joined[0] == len(links) and sum(joined[1:]) < 60
    assert all(found[a] == found[b] for a, b in links) and set(found.values()) == {*range(0, 20_000, 1000), 70_000, 90_000}


def test_further_links_rename_components(spark):
    """Links that come later join components by their names, and nothing else is joined anew."""
    rows = [(k, near(prose("family", 160, 5000), k // 2, 4 + k % 9)) for k in range(40)]
    join = ngram_join.Join(table(spark, rows))
    placed = join.classes.withColumn("comp", F.col("cls")).select("cls", "grp", "n", "comp")
    cls = sorted(r.cls for r in placed.collect())
    links = [(cls[5], cls[3]), (cls[3], cls[9]), (cls[0], cls[1]), (cls[2], cls[2])]
    after, renamed = join.merged(placed, spark.createDataFrame(links, "a long, b long"))
    found = {r.cls: r.comp for r in after.collect()}
    assert {c: found[c] for c in cls} == {c: {cls[5]: cls[3], cls[9]: cls[3], cls[1]: cls[0]}.get(c, c) for c in cls}
    assert sorted((r.comp, r.new) for r in renamed.collect()) == [(cls[1], cls[0]), (cls[5], cls[3]), (cls[9], cls[3])]
    again, _ = join.merged(after, spark.createDataFrame([(cls[9], cls[1])], "a long, b long"))
    assert {r.comp for r in again.collect() if r.cls in (cls[0], cls[1], cls[3], cls[5], cls[9])} == {cls[0]}


def test_heavy_sides_give_the_same(spark, monkeypatch):
    """Sketches and sets that are too many bytes to broadcast stay dealt out by class."""
    monkeypatch.setattr(ngram_join, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(ngram_join, "BROADCAST_MEMBERS", 0)
    rows = corpus()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(table(spark, rows)).collect()}
    assert found == linked_components(rows)


def test_sketches_are_dealt_out_once(spark, monkeypatch):
    """Lists that meet the classes asked for by shuffle are not dealt out by class again."""
    monkeypatch.setattr(ngram_join, "BROADCAST_MEMBERS", 0)
    join = ngram_join.Join(table(spark, corpus()[:60]))
    found = join.sketches(join.classes.select("cls"))
    plan = found._jdf.queryExecution().sparkPlan().toString() + found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == join.classes.count()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning(cls") == 2


def test_buckets_of_one_checked_pair_are_settled(spark, monkeypatch):
    """Documents that share half their text with one other: the pivots have met them, and no bucket is made again."""
    seen, meetings = [], ngram_join.Join.meetings

    def watched(self, rows, sketched):
        seen.append(rows.count())
        return meetings(self, rows, sketched)

    monkeypatch.setattr(ngram_join.Join, "meetings", watched)
    rows = [(2 * k + v, f"{prose(f'half{k}', 60, 5000)} {prose(f'own{k}{v}', 60 + 9 * v, 5000)}") for k in range(30) for v in range(2)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(table(spark, rows)).collect()}
    assert found == linked_components(rows) and seen == [0]


def test_unsettled_buckets(spark):
    join = ngram_join.Join(table(spark, corpus()[:4]), percent=10)
    rows = [
        (1, 10, 50, 1, 1), (1, 11, 60, 2, 1),  # a checked pair
        (2, 10, 50, 1, 1), (2, 11, 60, 2, 2),  # a group of two classes
        (3, 10, 50, 1, 1), (3, 11, 60, 2, 1), (3, 12, 60, 2, 1),  # three groups
        (4, 10, 50, 1, 1), (4, 11, 60, 1, 1), (4, 12, 60, 1, 1),  # one component
        (5, 13, 1000, 3, 1), (5, 14, 10_000, 4, 1),  # they fit, but by rounding they are two bands apart
        (6, 13, 1000, 3, 1), (6, 15, 10_001, 4, 1),  # they don't fit
    ]
    given = spark.createDataFrame(rows, "tok long, grp long, n long, comp long, members long")
    bands = {r.n: r.band for r in given.withColumn("band", join.band("n")).collect()}
    assert bands[10_000] - bands[1000] == 2
    left = join.unsettled(given)
    assert "members" not in left.columns and {r.tok for r in left.collect()} == {2, 3, 5}


def test_slim_sketches_rule_out_no_link(spark):
    rng = np.random.default_rng(3)
    sets = random_sets(rng, 40)
    raw = pa.RecordBatch.from_pydict({"cls": list(range(40)), "n": [len(s) for s in sets], "sketch": pa.array([ngram_join.parity(s) for s in sets], pa.binary())})
    (slim,) = ngram_join._slim(iter([raw]))
    sizes = [(len(x), len(y)) for x, y in zip(raw.column("sketch").to_pylist(), slim.column("sketch").to_pylist())]
    assert all(y == max(8, x // 4) for x, y in sizes)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(40), np.arange(40)))
    sketches = ngram_join.Sketches(slim.column("sketch"))
    truth = np.array([len(np.setxor1d(sets[a], sets[b])) for a, b in zip(i, j)])
    assert (ngram_join.differing(sketches, sketches, i, j) <= truth).all()


def test_a_task_writes_a_pair_once():
    sketch = ngram_join.parity(np.arange(100, dtype=np.int64))
    rows = {"bucket": [1, 1, 2, 2, 3, 3], "low": [0] * 6, "high": [0] * 6, "item": [5, 6, 5, 6, 5, 7], "comp": [5, 6, 5, 6, 5, 7], "n": [100] * 6, "place": [0] * 6, "part": [0] * 6}
    batch = pa.RecordBatch.from_pydict(rows | {"sketch": pa.array([sketch] * 6, pa.binary())})
    found = [tuple(r.values()) for b in ngram_join._met(75)(iter([batch.slice(0, 3), batch.slice(3)])) for r in b.to_pylist()]
    assert found == [(5, 5, 6, 6), (5, 5, 7, 7)]
