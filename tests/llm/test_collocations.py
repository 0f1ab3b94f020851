import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import prose, table
from waybill.llm import collocations, queries

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, threshold=10, first=2000, percent=50):
    """rows: (text, lang)."""
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(FOLD)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in (1, 2, 3):
                counts[lang].update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    out = set()
    for lang, found in counts.items():
        kept = []
        for phrase, a in found.items():
            if len(phrase) == 1 or a < threshold:
                continue
            longer = [f for p, f in found.items() if len(p) == 3 and len(phrase) == 2 and phrase in (p[:2], p[1:]) and f >= threshold]
            if any(100 * f >= percent * a for f in longer):
                continue
            score, _, l, r = min((10**6 * a * a // (found[phrase[:k]] * found[phrase[k:]]), k, found[phrase[:k]], found[phrase[k:]]) for k in range(1, len(phrase)))
            kept.append((-score, -a, " ".join(phrase).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:first], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return out


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_query_equals_its_sql(spark, folder):
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    found = base.execute(queries.ORACLE["op11_collocations"])
    columns = [d[0] for d in found.description]
    rows = queries.QUERIES["op11_collocations"](spark, folder).select(*columns).collect()
    assert Counter(map(tuple, rows)) == Counter(found.fetchall())


@pytest.mark.parametrize("threshold,chunk", [(10, 1 << 20), (3, 40)])
def test_equals_the_plain_version(spark, monkeypatch, threshold, chunk):
    rng = random.Random(threshold)
    words = ["New", "york", "CITY", "é", "of", "the", "x#y", "\x01", "日本"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "! ", " ; "]
    rows = [("".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(60))), rng.choice(["en", "fr", None, "und", ""])) for _ in range(120)]
    rows += [(None, "en"), ("", "xx"), (" .. , ", "yy"), ("a b c " * 5000, "de"), ("long " * 3 + "text " * 2000, "fr")] + [("same text here", "en")] * 12
    docs = table(spark, [(k, t, lang, "s") for k, (t, lang) in enumerate(rows)]).withColumn("phrase", F.lit("clash")).withColumn("body", F.lit("clash")).withColumn("n", F.lit(1))
    if chunk < 100:  # many chunks, texts longer than one
        real = collocations.chunks
        monkeypatch.setattr(collocations, "chunks", lambda batches, most=2000: real(batches, most))
    assert set(map(tuple, collocations.collocations(docs, threshold).select(*COLUMNS).collect())) == plain(rows, threshold)
    assert set(map(tuple, collocations.collocations(docs, threshold, first=3, percent=90).select(*COLUMNS).collect())) == plain(rows, threshold, 3, 90)


def test_a_crowded_bit_table_changes_nothing(spark):
    rows = [(k, prose(k, 80, 30), "en", "s") for k in range(60)]
    docs = table(spark, rows)
    whole = collocations.frequent(docs, 10).collect()
    crowded = collocations.frequent(docs, 10, parts=40, bits=640).collect()
    assert Counter(map(tuple, whole)) == Counter(map(tuple, crowded))


def test_summaries_keep_every_frequent_key_within_their_capacity():
    rng = np.random.default_rng(3)
    for threshold in (2, 5, 10):
        blobs, truth = [], Counter()
        for _ in range(40):
            keys, counts = np.unique((rng.zipf(1.3, 3000) % 50_000).astype(np.uint32), return_counts=True)
            blobs.append((keys, counts))
            truth.update(dict(zip(keys.tolist(), counts.tolist())))
        mass = sum(truth.values())
        summary = collocations.Summary(mass // threshold + 1)
        small = collocations.Summary(max(mass // threshold // 20, 1))  # a summary that must drop entries
        for keys, counts in blobs:
            summary.add(keys, counts)
            small.add(keys, counts)
            small._merge()
        kept = set(summary.survivors(threshold).tolist())
        assert {k for k, n in truth.items() if n >= threshold} <= kept and summary.taken < threshold and len(summary.keys) <= summary.capacity
        small._merge()
        assert len(small.keys) <= small.capacity and small.taken <= mass / (small.capacity + 1)
        assert {k for k, n in truth.items() if n > small.taken} <= set(small.keys.tolist())


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_000_000
    counts = spark.createDataFrame(
        [("en", 1, "a", big + 1), ("en", 1, "b", big + 7), ("en", 2, "a b", big - 5), ("en", 1, "c", big), ("en", 2, "b c", 11), ("en", 3, "a b c", 10)], "lang string, k int, phrase string, n long"
    )
    rows = {r.phrase: r for r in collocations.scored(counts).collect()}
    assert rows["a b"].score == 10**6 * (big - 5) ** 2 // ((big + 1) * (big + 7)) and (rows["a b"].l, rows["a b"].r) == (big + 1, big + 7)
    # Both cuts of the longer phrase give 0 after flooring: the first one counts.
    assert (rows["a b c"].score, rows["a b c"].l, rows["a b c"].r) == (0, big + 1, 11)
    assert {r.phrase for r in collocations.maximal(collocations.scored(counts)).collect()} == {"a b", "a b c"}


def test_empty_table(spark):
    assert collocations.collocations(table(spark, [])).count() == 0
    assert collocations.collocations(table(spark, [(1, None), (2, "")])).count() == 0
