import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import prose, table
from waybill.llm import quality_rules
from waybill.llm.quality_rules import Rule

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def tail(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a b c a b c"), (5, "one"), (6, "x y z"), (7, "a b c d\n a b c d\na b c d\n\n \n"),
    (8, "é # |x| <b>\x0b\x0cü"), (9, "w " * 30_000), (9, "w " * 30_000), (10, prose(3, 40_000)), (None, prose(4, 90)), (12, "\x01 \x02\n\x01 \x02"),
    (13, "ab c\na bc\nab c"), (14, "x" * 300_000),
]


def test_counts_equal_plain_ones(spark):
    rng = random.Random(5)
    rows = EDGES + [(k, "".join(rng.choice("ab  \n|#") for _ in range(rng.randrange(200)))) for k in range(100, 300)]
    docs = table(spark, rows).withColumn("words", F.lit("clash")).withColumn("levels", F.lit(1)).withColumn("id", F.lit(2))
    found = quality_rules.measured(docs).collect()
    assert Counter((r.id, *(r[c] for c in quality_rules.COUNTS), r.base_failed) for r in found) == Counter(
        (i, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]) for i, t in rows for c in [plain_counts(t)]
    )


@pytest.mark.parametrize("risk", [0.01, 0.3])
def test_bound_is_the_exact_binomial_tail(spark, risk):
    cases = [(k, n) for n in (1, 7, 40, 300, 1000) for k in range(0, min(n, 12))]
    rows = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality_rules.at_most(F.col("k"), F.col("n"), risk).alias("p")).collect()
    for r in rows:
        assert r.p == 1.0 if r.k >= r.n * risk else math.isclose(r.p, tail(r.k, r.n, risk), rel_tol=1e-9)
    # No overflow or underflow with very many labels.
    large = spark.createDataFrame([(99_000, 10_000_000), (0, 10_000_000)], "k long, n long").select(quality_rules.at_most(F.col("k"), F.col("n"), 0.01).alias("p"))
    values = [r.p for r in large.collect()]
    assert 0 < values[0] < 1e-3 and values[1] == 0.0


RULES = (Rule("symbols", "n_symbols * 10000 div n_words", (100, 1000, 5000)),)


def held(spark, rows):
    return spark.createDataFrame([(s, [lv], g, n) for s, lv, g, n in rows], "stratum string, levels array<int>, good boolean, n long")


def test_cutoffs_keep_the_guarantee(spark):
    # en: the first cutoff rejects 40 of 1,000 good documents, the second 2, the third none. fr has too few labels.
    rows = [("en", 0, True, 960), ("en", 1, True, 38), ("en", 2, True, 2), ("en", 1, False, 500), ("en", 2, False, 30), ("en", 3, False, 5), ("fr", 0, True, 50), ("fr", 3, False, 50)]
    tests = {(r.stratum, r.step): r for r in quality_rules.tested(held(spark, rows), 0.01, 0.05, RULES).collect()}
    assert [tests["en", s].k for s in (1, 2, 3)] == [40, 2, 0] and [tests["en", s].rejected_bad for s in (1, 2, 3)] == [535, 35, 5]
    for r in tests.values():
        expected = tail(r.k, r.n, 0.01) <= 0.05 / 2 if r.k < r.n * 0.01 else False
        assert r.certified == expected
    chosen = quality_rules.chosen(quality_rules.tested(held(spark, rows), 0.01, 0.05, RULES), price=5, rules=RULES).collect()
    assert [tuple(r) for r in chosen] == [("en", 2)]
    # With a high price the cutoff without any false rejection wins; without a gain the rule stays unused.
    chosen = quality_rules.chosen(quality_rules.tested(held(spark, rows), 0.01, 0.05, RULES), price=20, rules=RULES).collect()
    assert [tuple(r) for r in chosen] == [("en", 3)]
    none = held(spark, [("en", 0, True, 5000), ("en", 0, False, 10)])
    assert quality_rules.chosen(quality_rules.tested(none, 0.01, 0.05, RULES), rules=RULES).count() == 0


def test_false_rejection_stays_below_its_limit_in_repeated_draws(spark):
    """100 holdouts whose first cutoff rejects 2 % and whose second one 1.5 % of good documents: both must be refused."""
    rng = random.Random(9)
    rows = []
    for draw in range(100):
        hits = [rng.random() for _ in range(600)]
        high, low = sum(h < 0.015 for h in hits), sum(0.015 <= h < 0.02 for h in hits)
        rows += [(f"s{draw}", 2, True, high), (f"s{draw}", 1, True, low), (f"s{draw}", 0, True, 600 - high - low), (f"s{draw}", 2, False, 100)]
    wrong = quality_rules.tested(held(spark, rows), 0.01, 0.05, (Rule("r", "0", (1, 2)),)).where("certified").count()
    assert wrong == 0


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_verdicts_by_language_and_at_the_edges(spark):
    good = [(k, prose(k, 60), "en") for k in range(700)]
    junk = [(1000 + k, prose(k, 60).replace(" ", " |# "), "en") for k in range(60)]
    # de has no certified cutoff, so its junk stays; null languages are a stratum of their own.
    other = [(2000, prose(1, 60).replace(" ", " |# "), "de", "s"), (2001, prose(2, 60), None, "s"), (None, prose(3, 60), "en", "s"), (2002, None, None, None), (2003, "", "en", "s")]
    docs = table(spark, [(*r, "s") for r in good + junk] + other).withColumn("kept", F.lit("clash")).withColumn("symbols", F.lit(0))
    marks = [(k, 1, 0) for k in range(700)] + [(1000 + k, 0, 0) for k in range(60)] + [(None, 1, 0), (2001, None, 0), (5, 1, 1), (1000, 1, 0)]
    found = {r.doc_id: r for r in quality_rules.verdicts(docs, labels(spark, marks), risk=0.02, delta=0.1).collect()}
    assert len(found) == 700 + 60 + 5 and found[None].kept
    assert all(found[k].kept for k in range(700)) and not any(found[1000 + k].kept for k in range(60))
    assert found[2000].kept and found[2001].kept and not found[2002].kept and not found[2003].kept and found[2003].base_failed
    bare = quality_rules.verdicts(docs, labels(spark, [])).collect()
    assert all(r.kept != r.base_failed for r in bare)
    assert quality_rules.verdicts(table(spark, []), labels(spark, marks)).count() == 0
