import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import prose, table, words_of
from waybill.llm import elias_fano, language, language_model, levels, quality, queries, toxicity
from waybill.llm.elias_fano import EliasFano
from waybill.llm.tokens import WHITE, pieces, word_hashes

EDGES = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "123 ... !!"), (None, "no id"), (10**6 + 3, "word " * 40_000)]


def test_words_do_not_hang_on_pieces():
    import pyarrow as pa

    texts = ["Ab cd", None, "", "x" * 5000 + " y", "  lead and trail \n", "é É e", "z" * 3000]
    for most in (7, 64, 1 << 20):
        for low, high, data, offsets in pieces(pa.array(texts), most=1 << 20):
            hashes, bounds = word_hashes(data, offsets, WHITE, most)
            assert np.diff(bounds).tolist() == [len(words_of(t)) for t in texts]
            if most == 7:
                first = hashes
            assert (hashes == first).all()


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (1, 2**40), (5, 7), (700, 700), (700, 2**20), (20_000, 2**45), (300, 2**62)])
def test_elias_fano_finds_what_it_holds(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(np.array(list({int(x) for x in rng.integers(0, universe, n)}), np.uint64)) if universe > n else np.arange(n, dtype=np.uint64)
    header, arrays = EliasFano.arrays(values, universe)
    held = EliasFano(*header, *arrays)
    assert (held.find(values) == np.arange(len(values))).all()
    if len(values):
        assert (held.get(np.arange(len(values))) == values).all()
    asked = rng.integers(0, universe, 500).astype(np.uint64)
    known = set(values.tolist())
    assert [(x >= 0) for x in held.find(asked)] == [(int(x) in known) for x in asked]


@pytest.mark.parametrize("gap", [1, 900, 2**20])
def test_elias_fano_does_not_walk_long_runs(monkeypatch, gap):
    """Runs of 100,000 set or unset bits, or as many numbers with one high part, take a few reads."""
    near, far = np.arange(100_000, dtype=np.uint64), np.uint64(2**38) + np.arange(100_000, dtype=np.uint64) * np.uint64(gap)
    values = np.concatenate([near, far])
    header, arrays = EliasFano.arrays(values, 2**40)
    held = EliasFano(*header, *arrays)
    reads, read = [], elias_fano._read
    monkeypatch.setattr(elias_fano, "_read", lambda *x: reads.append(1) or read(*x))
    assert (held.find(values) == np.arange(len(values))).all() and (held.get(np.arange(len(values))) == values).all()
    assert (held.find(values + np.uint64(2**39)) == -1).all() and len(reads) < 60
    numbers, steps = held.step(np.arange(len(values) - 1))
    assert (numbers == values[:-1]).all() and (steps == np.diff(values)).all()


def test_level_files_round_trip(tmp_path):
    values = np.arange(0, 5000, 7, dtype=np.uint64)
    levels.write(f"file://{tmp_path}/a/b", {"s": (values, 5000, "find")}, {"c": np.arange(9, dtype=np.uint8)}, {"k": 2.5})
    level = levels.Level(f"file://{tmp_path}/a/b")
    assert level.k == 2.5 and level.c.tolist() == list(range(9)) and (level.s.find(values) == np.arange(len(values))).all()


def test_packed_trigrams_round_trip():
    rng = np.random.default_rng(1)
    rows = language_model._merge(*(rng.integers(0, high, 4000).astype(np.uint64) for high in (50, 3000, 10**9)), np.ones(4000, np.int64))
    back = language_model.unpacked_rows(language_model.packed_rows(*rows))
    assert all((a.astype(np.int64) == b.astype(np.int64)).all() for a, b in zip(rows, back))


def brute_scores(rows, trained):
    one, two, three, n = Counter(), Counter(), Counter(), 0
    texts = {i: words_of(t) + [b"\n"] for i, t in rows}
    for i in trained:
        w = texts[i]
        n += 1
        one.update(w), two.update(zip([None, *w], w)), three.update(zip([None, None, *w], [None, *w], w))
    total, types, out = sum(one.values()), len(one), {}
    for i, w in texts.items():
        base = full = 0.0
        for a, b, c in zip([None, None, *w], [None, *w], w):
            p1 = (one[c] + 1) / (total + types + 1)
            p2 = (two[b, c] + 4 * p1) / ((n if b is None else one[b]) + 4)
            base, full = base + math.log10(p1), full + math.log10((three[a, b, c] + 4 * p2) / ((n if b is None else two[a, b]) + 4))
        out[i] = (len(w), sum(one[c] > 0 for c in w), total, base, full)
    return out


def test_trie_scores_equal_counts(spark, monkeypatch):
    monkeypatch.setattr(language_model, "FILE_WORDS", 64)
    monkeypatch.setattr(language_model, "FILE_NGRAMS", 500)
    rows = [(k, prose(k, 20 + k, 60 + k)) for k in range(120)] + [r for r in EDGES if r[0] is not None]
    trained = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    expected = brute_scores(rows, trained)
    allowed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    found = language_model.trained_and_scored(table(spark, rows), allowed).collect()
    assert len(found) == len(rows)
    for r in found:
        n, known, total, base, full = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert abs(r.base_score - base) < 1e-6 * n and abs(r.score - full) < 0.02 * n


def test_tries_are_even_with_frequent_words(spark):
    """One word before and behind thousands of others: few numbers share a high part, and scores equal counts."""
    rows = [(k, " ".join(f"the w{k}x{j} of" for j in range(60))) for k in range(100)]
    expected = brute_scores(rows, [i for i, _ in rows])
    model = language_model.train(table(spark, rows))
    trie = levels.Level(f"{model.folder}/ngrams-0")
    for level in (trie.next, trie.last):
        assert level.n > 10_000
        unset = np.flatnonzero(np.unpackbits(level.high.view(np.uint8), bitorder="little")[: level.n + level.buckets] == 0)
        assert np.diff(unset).max() < 20
    for r in language_model.scored(table(spark, rows), model).collect():
        n, known, _, base, full = expected[r.doc_id]
        assert (r.n_tokens, r.n_known) == (n, known) and abs(r.base_score - base) < 1e-6 * n and abs(r.score - full) < 0.02 * n


def test_language_model_without_training(spark):
    found = language_model.trained_and_scored(table(spark, [(1, "a b"), (None, None)]), F.lit(False)).collect()
    assert [(r.n_known, r.train_tokens, r.score) for r in found] == [(0, 0, 0.0)] * 2
    assert language_model.trained_and_scored(table(spark, []), F.lit(True)).count() == 0


def quality_tables(spark):
    good = [(k, prose(k, 120)) for k in range(120)]
    bad = [(1000 + k, " ".join(f"{w}%%%" for w in prose(k, 100).split()) + " !!!!" * 20) for k in range(120)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    return table(spark, good + bad + EDGES), labels


def test_quality_tells_good_from_bad(spark):
    docs, labels = quality_tables(spark)
    model = quality.fit(docs, labels, F.col("doc_id") % 2 == 0)
    rows = quality.scored(docs, model).collect()
    held = [r for r in rows if r.doc_id is not None and r.doc_id % 2 and r.doc_id < 10**6]
    assert len(rows) == 245 and np.mean([(r.score >= 0.7) == (r.doc_id < 1000) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    assert quality.fit(docs, labels.where("false"), F.lit(True)).weights == (0.0, 0.0)


def toxic_tables(spark):
    rng = np.random.default_rng(5)
    words = ["zorgle", "blemtig", "blemtix", "quaffen"]
    rows, labels = [], []
    for k in range(400):
        text = prose(k, 60).split()
        toxic = int(k % 4 == 0)
        if toxic:
            for _ in range(4):
                text.insert(int(rng.integers(0, 60)), words[int(rng.integers(0, 4))])
        rows.append((k, " ".join(text)))
        labels.append((k, 1, toxic))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxic_documents_are_found_and_clean_ones_left(spark):
    rows, labels = toxic_tables(spark)
    docs = table(spark, rows + EDGES)
    model = toxicity.fit(docs, labels, F.col("doc_id") % 5 != 0)
    found = {r.doc_id: r.score for r in toxicity.measured(docs, model).collect()}
    held = [k for k in range(400) if k % 5 == 0]
    assert np.mean([(found[k] >= 0.5) == (k % 4 == 0) for k in held]) > 0.95
    assert found[10**6] < 0.5 and found[10**6 + 1] < 0.5 and found[None] < 0.5
    kept = {r.doc_id for r in toxicity.accepted(docs, model).collect()}
    assert kept == {i for i, s in found.items() if s < 0.5}
    nothing = toxicity.fit(docs, labels.where("false"), F.lit(True))
    assert nothing.lengths == {} and all(r.score < 0.5 for r in toxicity.measured(docs, nothing).collect())


def clause(text):
    """Best weight of a clause in which insults weigh 4."""
    known = np.array(sorted(int.from_bytes(w.encode().ljust(8, b"\0"), "big") for w in ("idiot", "scum")), np.uint64)
    model = toxicity.Model({8: (known, np.array([4.0, 4.0]))}, 0.0, 1.0, 0.0)
    data = np.frombuffer(text.encode(), np.uint8)
    return toxicity.evidence(data, np.array([0, len(data)]), model)[0][0]


def test_clauses_decide_and_not_words():
    plain, aimed = clause("what an idiot there"), clause("you are an idiot")
    assert aimed > plain == 4.0
    assert clause("they are not an idiot") < 0.5 * plain and clause("they said an idiot came") < plain
    assert clause("said nothing. an idiot came") == plain  # the verb is in another clause
    assert clause("kill the process") == 0 and clause("kill you") > 0 and clause("you die, they kill") > 0
    assert clause("never kill you") < clause("kill you")
    assert clause("idiot scum") == 8.0


LETTERS = {"en": "the and of that with house", "de": "der und nicht schön straße über", "fr": "le et être où garçon très", "es": "el y señor año está niño"}


def test_languages_by_family_and_pair(spark):
    rng = np.random.default_rng(2)
    rows = [(100 * j + k, " ".join(rng.choice(words.split(), 30)), lang) for j, (lang, words) in enumerate(LETTERS.items()) for k in range(60)]
    docs = table(spark, rows + [(r[0], r[1], None) for r in EDGES[:3]] + [(None, "the and of", "en")])
    model = language.fit(docs, F.col("doc_id") % 4 != 2)
    assert model.members == {"Germanic": ["de", "en"], "Romance": ["es", "fr"]}
    found = {r.doc_id: r for r in language.detected(docs, model).collect()}
    assert all(found[i].lang_pred == lang for i, _, lang in rows)
    assert [found[10**6 + k].lang_pred for k in range(3)] == ["und"] * 3 and found[None].lang_pred == "en"
    nothing = language.fit(docs, F.lit(False))
    assert {r.lang_pred for r in language.detected(docs, nothing).collect()} == {"und"}


@pytest.mark.parametrize("name,column", [("op3_compression_quality", "quality"), ("op6_toxic_grammar", "toxic")])
def test_held_out_accuracy(spark, name, column):
    folder = "/root/testdata/sf0.01"
    found = queries.QUERIES[name](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet").where(f"{column} is not null"), "doc_id").collect()
    right = np.mean([r.predicted == r[column] for r in found])
    assert right > 0.9


def test_held_out_languages(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op8_language(spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.97
