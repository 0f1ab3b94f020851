"""Quality rules whose cutoffs are chosen under a guarantee on falsely rejected documents.

Each rule is a number of the text and a fixed list of cutoffs; a text is rejected if its number reaches the rule's cutoff.
Which cutoff a stratum (language) uses is decided on labelled documents, the holdout, on which nothing else is fitted:

* Of the good documents of a stratum that pass the base rules, n are labelled and k of them would be rejected by a cutoff.
  The hypothesis "this cutoff rejects more than ``risk`` of the good documents" has the exact p-value P(Bin(n, risk) <= k).
* Cutoffs of a rule are tested from the one that rejects least, until one fails (fixed sequence, so no correction is needed
  inside a rule). All (stratum, rule) pairs share the error ``delta`` evenly (Bonferroni). So with probability 1 - ``delta``
  no rule in use rejects more than ``risk`` of the good documents of any stratum, all rules together not more than the
  number of rules times ``risk``.
* Of the certified cutoffs the one with the most rejected bad documents, less ``price`` for each rejected good one, is
  used; ties go to the one that rejects least. Without a gain, or with too few labels to certify, the rule stays unused.

All is made of built-in functions. Documents are not shuffled: their counts are taken row by row, and only counts of
(stratum, rule, level) and labelled ids travel.

Equal windows of three words are found by 64-bit hashes within one text.

Null and empty texts have no words, so they fail the base rules. A null stratum is the stratum ``und``. A document whose
label rows disagree, or whose id is null, is not in the holdout. Rows that repeat count as often as they occur. Empty
tables of documents give empty tables, empty labels leave the base rules alone. Columns besides the id, the text and the
stratum are not read, so none can clash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.sizes import if_small
from waybill.session import cut_lineage

SYMBOLS = "[#*$%&|<>]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Strata of which cutoffs may be broadcast: one row of a few numbers each.
BROADCAST_STRATA = 100_000
#: Labelled ids that may be broadcast.
BROADCAST_LABELS = 1_000_000
STEP_SHIFT = 8


@dataclass(frozen=True)
class Rule:
    """``value``: SQL text over the counts, a whole number. ``cutoffs`` ascend; the last one rejects least."""

    name: str
    value: str
    cutoffs: tuple[int, ...]


RULES = (
    Rule("symbols", "n_symbols * 10000 div n_words", (500, 1000, 2000, 4000, 8000, 16000)),
    Rule("dup_lines", "n_dup_lines * 10000 div n_lines", (1000, 2000, 3000, 4000, 6000, 8000)),
    Rule("repeats", "n_repeat_words * 10000 div n_words", (500, 1000, 1500, 2000, 3000, 4000)),
    Rule("long_words", "word_chars * 100 div n_words", (700, 800, 900, 1000, 1200, 1500)),
    Rule("short_words", "-(word_chars * 100 div n_words)", (-350, -300, -275, -250, -225, -200)),
)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """id, stratum, the counts, n_lines (lines with a word) and base_failed of each row."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    bare = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(stratum_col).cast("string"), F.lit("und")).alias("stratum"),
        body.alias("body"),
        F.array_remove(F.split(body, r"[\x20\x09-\x0D]+"), "").alias("words"),
        # A line that begins with a visible character has a word; only others are searched.
        F.filter(F.split(body, "\n"), lambda line: (F.ascii(line) > 32) | line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    windows = F.size("words") - 2
    zipped = F.arrays_zip(
        F.slice("words", F.lit(1), windows).alias("a"), F.slice("words", F.lit(2), windows).alias("b"), F.slice("words", F.lit(3), windows).alias("c")
    )
    hashes = F.transform(zipped, lambda w: F.xxhash64(w["a"], w["b"], w["c"]))
    bare = bare.withColumn("hashes", F.when(windows > 1, hashes))
    # Windows with their places, in order of the hash, so that equal ones are neighbours.
    ordered = F.sort_array(F.arrays_zip(F.col("hashes").alias("hash"), F.sequence(F.lit(0), F.size("hashes") - 1).alias("at")))
    bare = bare.withColumn("ordered", F.when(F.col("hashes").isNotNull(), ordered))
    counted = bare.select(
        "id",
        "stratum",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("body") - F.length(F.regexp_replace("body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(_repeated(F.col("ordered")), F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return counted.select("id", "stratum", *COUNTS, "n_lines", failed.alias("base_failed"))


def _repeated(ordered: Column) -> Column:
    """Words inside windows that occur twice or more. ``ordered``: sorted structs of the hash of three words and a place."""
    pairs = F.arrays_zip(ordered.alias("x"), F.slice(ordered, F.lit(2), F.size(ordered)).alias("y"))
    equal = F.filter(pairs, lambda p: p["x"]["hash"] == p["y"]["hash"])
    covered = F.transform(equal, lambda p: F.array(*[p[side]["at"] + k for side in ("x", "y") for k in range(3)]))
    return F.size(F.array_distinct(F.flatten(covered)))


def levels(rows: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows with ``levels``: for each rule, how many of its cutoffs reject the row."""
    each = []
    for rule in rules:
        value = F.coalesce(F.expr(f"CASE WHEN n_words > 0 THEN {rule.value} END"), F.lit(-(2**62)))
        each.append(sum(((value >= c).cast("int") for c in rule.cutoffs), F.lit(0)))
    return rows.withColumn("levels", F.array(*each))


def holdout(rows: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id") -> DataFrame:
    """stratum, levels, good, n: how many labelled rows that pass the base rules are alike."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.min(label).alias("low"), F.max(label).alias("high")).where("low = high")
    # Rows of one id are counted first, so an id with a great many rows is a few rows in the join.
    alike = rows.where("not base_failed").groupBy("id", "stratum", "levels").agg(F.count("*").alias("n"))
    joined = alike.join(if_small(known.select("id", (F.col("low") == 1).alias("good")), BROADCAST_LABELS), "id")
    return joined.groupBy("stratum", "levels", "good").agg(F.sum("n").alias("n"))


def ln_factorial(x: Column) -> Column:
    """ln(x!) by Stirling's series, taken 8 places further up, where it is exact to the last digits of a double."""
    x = x.cast("double")
    z = x + F.lit(STEP_SHIFT + 1.0)
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    up = F.lit(0.0)
    for k in range(1, STEP_SHIFT + 1):
        up = up + F.ln(x + F.lit(float(k)))
    return (z - 0.5) * F.ln(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series - up


def at_most(k: Column, n: Column, risk: float) -> Column:
    """P(Bin(n, risk) <= k) for k < n * risk, else 1 (such counts never speak against a risk above ``risk``).

    Summed from k down, each term from the one above. Below the mean the terms fall as a normal density does, so what
    lies 60 roots of n further down is less than the smallest double.
    """
    odds = F.lit((1 - risk) / risk)
    top = F.exp(ln_factorial(n) - ln_factorial(k) - ln_factorial(n - k) + k * math.log(risk) + (n - k) * math.log1p(-risk))
    reach = F.least(k, F.ceil(F.sqrt(n.cast("double")) * 60) + 60).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def down(acc: Column, t: Column) -> Column:
        term = acc["term"] * (k - t) / (n - k + t + 1) * odds
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    total = F.when(k > 0, F.aggregate(F.sequence(F.lit(0), F.greatest(reach - 1, F.lit(0))), start, down, lambda acc: acc["total"])).otherwise(F.lit(1.0))
    return F.when(k < n * risk, F.least(top * total, F.lit(1.0))).otherwise(F.lit(1.0))


def tested(held: DataFrame, risk: float = 0.01, delta: float = 0.05, rules: Sequence[Rule] = RULES) -> DataFrame:
    """stratum, rule, step, n, k, rejected_bad, p_value, certified for each cutoff of each rule and stratum.

    ``step`` counts cutoffs from 1. ``held`` is a table of counts from ``holdout``.
    """
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(len(r.cutoffs)).alias("steps"), F.col("levels")[k].alias("level")) for k, r in enumerate(rules)]))
    steps = held.select("stratum", "good", "n", each.alias("r")).select("stratum", "good", "n", "r.*")
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(1), "steps")))
    hit = F.col("level") >= F.col("step")
    counts = steps.groupBy("stratum", "rule", "step").agg(
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("n"),
        F.sum(F.when(F.col("good") & hit, F.col("n")).otherwise(0)).alias("k"),
        F.sum(F.when(~F.col("good") & hit, F.col("n")).otherwise(0)).alias("rejected_bad"),
    )
    tests = held.agg((F.countDistinct("stratum") * len(rules)).alias("tests"))  # one row
    valued = counts.crossJoin(F.broadcast(tests)).withColumn("p_value", at_most(F.col("k"), F.col("n"), risk))
    # The cutoffs of one (stratum, rule) are as many as the rule has, however large the holdout.
    sequence = Window.partitionBy("stratum", "rule").orderBy(F.desc("step"))
    passed = F.min((F.col("p_value") <= F.lit(delta) / F.col("tests")).cast("int")).over(sequence) == 1
    return valued.withColumn("certified", passed).drop("tests")


def chosen(tests: DataFrame, price: int = 20, rules: Sequence[Rule] = RULES) -> DataFrame:
    """stratum, and for each rule in use the step of its cutoff (null if it is not in use)."""
    gain = F.col("rejected_bad") - F.col("k") * price
    best = tests.where(F.col("certified") & (gain > 0)).groupBy("stratum", "rule").agg(F.max(F.struct(gain.alias("gain"), "step")).alias("best"))
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r.name, F.col("best.step"))).alias(r.name) for r in rules])


def judged(rows: DataFrame, cutoffs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``levels`` with ``kept``: the base rules and the rules in use in the row's stratum hold."""
    joined = rows.join(if_small(cutoffs, BROADCAST_STRATA), "stratum", "left")
    reached = F.lit(False)
    for k, rule in enumerate(rules):
        reached = reached | F.coalesce(F.col("levels")[k] >= F.col(rule.name), F.lit(False))
    return joined.withColumn("kept", ~(F.col("base_failed") | reached)).drop(*[r.name for r in rules])


def verdicts(
    docs: DataFrame, labels: DataFrame, risk: float = 0.01, delta: float = 0.05, price: int = 20,
    id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
) -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every row."""
    rows = levels(cut_lineage(measured(docs, id_col, text_col, stratum_col)))
    cutoffs = chosen(tested(holdout(rows, labels, id_col=id_col), risk, delta), price)
    return judged(rows, cutoffs).select(F.col("id").alias(id_col), *COUNTS, "base_failed", "kept")
