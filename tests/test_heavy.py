"""Most frequent keys against full counts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from waybill.operators import heavy


def rows_of(seed, n, keys, even=False):
    rng = random.Random(seed)
    draw = (lambda: rng.randrange(keys)) if even else (lambda: min(int(rng.paretovariate(0.9)), keys))
    return [(rng.choice(["a", "b", None]), None if rng.random() < 0.02 else draw()) for _ in range(n)]


def plain(rows, n):
    out = set()
    for group in {g for g, _ in rows}:
        counts = Counter(k for g, k in rows if g == group and k is not None)
        out |= {(group, k, c, place) for place, (k, c) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:n], 1)}
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "g string, k long").repartition(4)


@pytest.mark.parametrize("tracked,even", [(10_000, False), (60, False), (60, True)])
def test_top_keys_are_exact(spark, tracked, even):
    """Also with summaries much smaller than the number of keys, proven or not."""
    rows = rows_of(tracked, 8000, 3000, even)
    found = heavy.top(table(spark, rows), ["g"], "k", 5, tracked).select("g", "k", "count", "place").collect()
    assert set(map(tuple, found)) == plain(rows, 5)


def test_stored_summaries_of_finer_groups(spark):
    rows = [(g, k, day) for day in range(5) for g, k in rows_of(day, 1500, 2000)]
    df = spark.createDataFrame(rows, "g string, k long, day int")
    daily = heavy.summaries(df, ["g", "day"], "k", 300)
    found = heavy.top(df, ["g"], "k", 7, 300, parts=daily).collect()
    assert {(r.g, r.k, r["count"], r.place) for r in found} == plain([(g, k) for g, k, _ in rows], 7)


def test_lost_keys_stay_below_the_stated_bound(spark):
    rows = [(g, k) for g, k in rows_of(9, 20_000, 10**6, True) if k is not None] + [("a", -1)] * 900
    for tracked in (30, 200):
        kept = {(r.g, r.k) for r in heavy.candidates(heavy.summaries(table(spark, rows), ["g"], "k", tracked), ["g"], "k", tracked).collect()}
        sizes = Counter(g for g, _ in rows)
        for (g, k), c in Counter(rows).items():
            if c > 3.5 / heavy.counters(tracked) * sizes[g]:
                assert (g, k) in kept


def test_edges(spark):
    assert heavy.top(table(spark, []), ["g"], "k", 3).count() == 0
    assert heavy.top(table(spark, [("a", None)]), ["g"], "k", 3).count() == 0
    whole = heavy.top(table(spark, [("a", 1), ("b", 1), ("b", 2)]), [], "k", 3).collect()
    assert [(r.k, r["count"]) for r in sorted(whole, key=lambda r: r.place)] == [(1, 2), (2, 1)]
    with pytest.raises(ValueError):
        heavy.top(table(spark, []), ["g"], "k", 100, 100)
