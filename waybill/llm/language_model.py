"""N-gram scoring with Elias-Fano tries: monotone pointers, quantised smoothed probabilities, memory-mapped levels.

Model. Tokens are the words of a text, lower-cased A-Z, and one end. Trigrams are smoothed towards bigrams and those
towards single words, each by a Dirichlet prior: p(c | a b) = (n(abc) + m p(c | b)) / (n(ab) + m), with p(c) = (n(c) + 1) /
(N + V + 1). All counts are over all training documents.

Files. The vocabulary is a sorted sequence of word hashes with counts, cut by the top bits of the hash. N-grams are cut
by a hash of their last two words (b, c), so a trigram lies with the bigram it falls back to, and a frequent word is
spread over all files. A file is a trie with three levels, the forerunner last:

    head      the words b                                   Elias-Fano
    next      their followers c here, under each b          Elias-Fano; ``start`` points from b to its first follower
    last      the forerunners a of each pair (b, c)         Elias-Fano; ``range`` points from the pair to its first forerunner

A query finds b, then c in the range of b, then a in the range of (b, c). What lies in a range is stretched over a share of the
universe in proportion to the range's length: word numbers follow their hashes, so high parts are even however frequent a
word is, and a look-up compares about one number.
Probabilities of ``next`` and ``last`` and back-off weights have 8-bit codes with a code book per file.

Building is three jobs: words are counted with partial sums; each batch of documents sends each file its distinct
trigrams with counts, sorted and compressed; each file is built from what came for it. Scoring maps the files of the
shared folder, so a task's memory is its batch and the pages in use. The number of files follows the number of tokens.

Null text counts as empty and has one token, the end. Ids only decide what is trained on. Without training documents all
tokens are unknown and have probability 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm import levels
from waybill.llm.tokens import WHITE, pieces, splitmix, word_hashes
from waybill.session import scratch_path

U = np.uint64
#: The end of a text, as a word hash.
END = U(0x656E64206F662074)
#: Strengths of the priors of bigrams and trigrams.
PRIOR_2, PRIOR_3 = 4.0, 4.0
#: Words of a vocabulary file and distinct n-grams of a trie file, on average.
FILE_WORDS, FILE_NGRAMS = 1_000_000, 2_000_000
PIECE = 3 << 20


@dataclass(frozen=True)
class Model:
    folder: str
    bits: int  # of a word hash that number its vocabulary file
    offsets: tuple[int, ...]  # number of the first word of each vocabulary file
    files: int  # of tries
    tokens: int
    words: int
    documents: int


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, ends included, and each text's first place (one more at the end)."""
    words, bounds = word_hashes(data, offsets, WHITE, PIECE)
    shift = np.arange(len(bounds))
    out = np.full(len(words) + len(bounds) - 1, END, U)
    out[np.arange(len(words)) + np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))] = words
    return out, bounds + shift


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offsets in pieces(batch.column("text"), most=PIECE, rows=1 << 16):
            words, times = np.unique(token_hashes(data, offsets)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(times)], names=["word", "n"])


class Vocabulary:
    """Numbers and counts of words, from the mapped files."""

    def __init__(self, model: Model):
        self.model, self.open = model, {}

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (V + 1 for unknown ones) and count of each of some distinct words."""
        m = self.model
        numbers, counts = np.full(len(hashes), m.words + 1, U), np.zeros(len(hashes), np.int64)
        where = (hashes >> U(64 - m.bits)).astype(np.int64) if m.bits else np.zeros(len(hashes), np.int64)
        order = np.argsort(where, kind="stable")
        edges = np.searchsorted(where[order], np.arange(2**m.bits + 1))
        for part in np.flatnonzero(np.diff(edges)):
            if part + 1 < len(m.offsets) and m.offsets[part] == m.offsets[part + 1]:
                continue
            rows = order[edges[part] : edges[part + 1]]
            if part not in self.open:
                self.open[part] = levels.Level(f"{m.folder}/words-{part}")
            level = self.open[part]
            at = level.words.find(hashes[rows] - (U(int(part)) << U(64 - m.bits) if m.bits else U(0)))
            hit = at >= 0
            numbers[rows[hit]] = at[hit].astype(U) + U(m.offsets[part])
            counts[rows[hit]] = level.counts[at[hit]]
        return numbers, counts

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distinct, back = np.unique(hashes, return_inverse=True)
        numbers, counts = self.look_up(distinct)
        return numbers[back], counts[back]


def contexts(tokens: np.ndarray, bounds: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """The two forerunners of each token; ``begin`` stands before a text."""
    one, two = np.full(len(tokens), begin, U), np.full(len(tokens), begin, U)
    one[1:], two[2:] = tokens[:-1], tokens[:-2]
    first = bounds[:-1]
    one[first], two[first] = begin, begin
    second = first + 1
    two[second[second < bounds[1:]]] = begin
    return two, one


def file_of(one: np.ndarray, word: np.ndarray, files: int) -> np.ndarray:
    """The file of each pair, in the smallest type: short numbers are sorted faster."""
    return (splitmix(one * U(0x9E3779B97F4A7C15) ^ splitmix(word)) % U(files)).astype(np.min_scalar_type(files))


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that sorts the keys, where in it each distinct key begins, and how often it comes."""
    order = np.argsort(keys)
    held = keys[order]
    first = np.flatnonzero(np.append(np.ones(min(len(keys), 1), bool), held[1:] != held[:-1]))
    return order, first, np.diff(np.append(first, len(keys)))


def packed_rows(one: np.ndarray, word: np.ndarray, two: np.ndarray, n: np.ndarray) -> bytes:
    """Trigrams sorted by (one, word, two), as differences, compressed."""
    step = np.diff(one, prepend=one[:1])
    columns = [one[:1].astype(np.uint64), step.astype(np.uint32), word.astype(np.uint32), two.astype(np.uint32), n.astype(np.uint32)]
    columns[2] = np.where(step == 0, np.diff(word, prepend=word[:1]), word).astype(np.uint32)
    if len(word):
        columns[2][0] = word[0]
    planes = [columns[0].tobytes()] + [c.view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns[1:]]
    return len(word).to_bytes(8, "little") + zstandard.compress(b"".join(planes), 3)


def unpacked_rows(blob: bytes) -> tuple[np.ndarray, ...]:
    n = int.from_bytes(blob[:8], "little")
    raw = np.frombuffer(zstandard.decompress(blob[8:]), np.uint8)
    first = raw[:8].view(np.uint64)
    step, word, two, times = (np.ascontiguousarray(p.reshape(4, n).T).view(np.uint32).reshape(n).astype(np.int64) for p in raw[8:].reshape(4, 4 * n))
    one = np.cumsum(step) + int(first[0])
    # Within one "one" the words are differences: a running sum that starts anew at each change.
    change = step != 0
    change[0] = True
    total = np.cumsum(word)
    starts = np.flatnonzero(change)
    word = total - np.repeat(total[starts] - word[starts], np.diff(np.append(starts, n)))
    return one.astype(U), word.astype(U), two.astype(U), times


def _merge(one: np.ndarray, word: np.ndarray, two: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted by (one, word, two); equal rows summed."""
    by_pair, first, times = runs(one << U(32) | word)
    pair = np.repeat(np.arange(len(first), dtype=U), times) << U(32) | two[by_pair]
    order, first, _ = runs(pair)
    order = by_pair[order]
    at = order[first]
    return one[at], word[at], two[at], np.add.reduceat(n[order], first) if len(at) else n[:0]


def _trigrams(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model)
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column("text"), most=PIECE, rows=1 << 16):
                hashes, bounds = token_hashes(data, offsets)
                tokens = vocabulary.of(hashes)[0]
                two, one = contexts(tokens, bounds, model.words)
                one, word, two, n = _merge(one, tokens, two, np.ones(len(tokens), np.int64))
                file = file_of(one, word, model.files)
                order = np.argsort(file, kind="stable")
                edges = np.searchsorted(file[order], np.arange(model.files + 1, dtype=file.dtype))
                used = np.flatnonzero(np.diff(edges))
                blobs = [packed_rows(*(c[order[edges[f] : edges[f + 1]]] for c in (one, word, two, n))) for f in used]
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(blobs, pa.binary())], names=["file", "rows"])

    return run


def coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-bit codes of logarithms and their book: 256 bins of equal width, each with the mean of what it holds."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1)
    low, high = values.min(), values.max()
    codes = np.minimum((values - low) * (256 / max(high - low, 1e-12)), 255).astype(np.int64)
    sizes = np.bincount(codes, minlength=256)
    return codes.astype(np.uint8), np.bincount(codes, values, 256) / np.maximum(sizes, 1)


def stretched(first: np.ndarray, length: np.ndarray, word: np.ndarray, width: np.uint64) -> np.ndarray:
    """The number of a word (below ``width``) in a range of so many words, which begins behind ``first`` others."""
    return first.astype(U) * width + length.astype(U) * word


def build_trie(model: Model, file: int, blobs: list[bytes]) -> int:
    """Write a trie file from what the batches sent for it; the number of its trigrams."""
    vocabulary = VocabularyByNumber(model)
    parts = [unpacked_rows(b) for b in blobs]
    one, word, two, n = _merge(*(np.concatenate(c) for c in zip(*parts)))
    width = U(model.words + 2)
    pair = np.ones(len(one), bool)
    pair[1:] = (one[1:] != one[:-1]) | (word[1:] != word[:-1])
    pairs = np.flatnonzero(pair)
    bigram_n = np.add.reduceat(n, pairs)
    b, c = one[pairs], word[pairs]
    heads, start, node = np.unique(b, return_index=True, return_inverse=True)
    start, pairs = np.append(start, len(pairs)), np.append(pairs, len(one))
    p1 = (vocabulary.counts(c) + 1.0) / (model.tokens + model.words + 1)
    n1 = np.where(b == U(model.words), model.documents, vocabulary.counts(b))
    p2 = (bigram_n + PRIOR_2 * p1) / (n1 + PRIOR_2)
    which = np.cumsum(pair) - 1
    # Without the total of the context (a, b), which lies in its own file as back-off weight: n / m + p2.
    scaled = np.log10(n / PRIOR_3 + p2[which])
    next_codes, next_book = coded(np.log10(p2))
    weight_codes, weight_book = coded(np.log10(PRIOR_3 / (bigram_n + PRIOR_3)))
    last_codes, last_book = coded(scaled)
    levels.write(
        f"{model.folder}/ngrams-{file}",
        {
            "head": (heads, model.words + 2, "find"),
            "start": (start.astype(U), len(c) + 1, "get"),
            "next": (stretched(start[node], np.diff(start)[node], c, width), len(c) * (model.words + 2) + 1, "find"),
            "range": (pairs.astype(U), len(n) + 1, "get"),
            "last": (stretched(pairs[which], np.diff(pairs)[which], two, width), len(n) * (model.words + 2) + 1, "find"),
        },
        {"next_codes": next_codes, "next_book": next_book, "weight_codes": weight_codes, "weight_book": weight_book, "last_codes": last_codes, "last_book": last_book},
        {},
    )
    return len(n)


class VocabularyByNumber:
    """Counts of words by their numbers."""

    def __init__(self, model: Model):
        self.model, self.open = model, {}

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros(len(numbers), np.int64)
        part = np.searchsorted(np.asarray(self.model.offsets[1:], U), numbers, side="right")
        for p in np.unique(part):
            rows = np.flatnonzero((part == p) & (numbers < U(self.model.words)))
            if len(rows):
                if p not in self.open:
                    self.open[p] = levels.Level(f"{self.model.folder}/words-{p}").counts
                out[rows] = self.open[p][(numbers[rows] - U(self.model.offsets[p])).astype(np.int64)]
        return out


def train(docs: DataFrame) -> Model:
    """Count and write the files; ``docs`` are the training documents."""
    spark = docs.sparkSession
    texts = docs.select("text")
    folder = scratch_path(spark, "ngrams")
    counted = f"{folder}/counted"
    texts.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).write.parquet(counted)
    vocabulary = spark.read.parquet(counted)
    words, tokens = vocabulary.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    ends = vocabulary.where(F.col("word") == int(END.astype(np.int64))).select("n").first()
    bits = max(0, int(words // FILE_WORDS).bit_length())
    part = (F.shiftrightunsigned("word", 64 - bits) if bits else F.lit(0)).cast("int")
    draft = Model(folder, bits, (), max(1, int(tokens // FILE_NGRAMS)), int(tokens), int(words), int(ends.n) if ends else 0)

    def write_words(table: pa.Table) -> pa.Table:
        file = table.column("part")[0].as_py()
        hashes = table.column("word").to_numpy().astype(np.int64).view(U)
        counts = table.column("n").to_numpy()
        order = np.argsort(hashes)
        low = U(file) << U(64 - bits) if bits else U(0)
        levels.write(f"{folder}/words-{file}", {"words": (hashes[order] - low, 1 << (64 - bits), "find")}, {"counts": counts[order]}, {})
        return pa.table({"part": pa.array([file], pa.int32()), "n": pa.array([len(order)], pa.int64())})

    sizes = {r.part: r.n for r in vocabulary.withColumn("part", part).groupBy("part").applyInArrow(write_words, "part int, n long").collect()}
    offsets = np.concatenate([[0], np.cumsum([sizes.get(p, 0) for p in range(2**bits)])])
    model = Model(folder, bits, tuple(int(x) for x in offsets), draft.files, draft.tokens, draft.words, draft.documents)

    def write_trie(table: pa.Table) -> pa.Table:
        file = table.column("file")[0].as_py()
        n = build_trie(model, file, table.column("rows").to_pylist())
        return pa.table({"file": pa.array([file], pa.int32()), "n": pa.array([n], pa.int64())})

    if words:
        texts.mapInArrow(_trigrams(model), "file int, rows binary").groupBy("file").applyInArrow(write_trie, "file int, n long").agg(F.sum("n")).collect()
    return model


class Tries:
    """Log10 probabilities of tokens, from the mapped files."""

    def __init__(self, model: Model):
        self.model, self.open, self.vocabulary = model, {}, Vocabulary(model)

    def level(self, file: int):
        if file not in self.open:
            self.open[file] = levels.Level(f"{self.model.folder}/ngrams-{file}")
        return self.open[file]

    def score(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log10 probability by the model, log10 probability by counts of words, and whether the word is known."""
        m = self.model
        tokens, counts = self.vocabulary.of(hashes)
        single = np.log10((counts + 1.0) / (m.tokens + m.words + 1)) if m.words else np.zeros(len(tokens))
        if not m.words:
            return single.copy(), single, counts > 0
        two, one = contexts(tokens, bounds, m.words)
        forerunner = np.full(len(tokens), m.documents, np.int64)
        forerunner[1:] = counts[:-1]
        forerunner[bounds[:-1]] = m.documents
        bigram = np.log10(PRIOR_2 / (forerunner + PRIOR_2)) + single
        # Of the pair (one, token), as the context of what follows: log10 of m / (n + m).
        weight = np.zeros(len(tokens))
        trigram = np.full(len(tokens), np.nan)
        # Distinct pairs (one, token), by file and in order, so that look-ups run through the levels from front to back.
        order, first, times = runs(one << U(32) | tokens)
        b, c = one[order[first]], tokens[order[first]]
        file = file_of(b, c, m.files)
        by_file = np.argsort(file, kind="stable")
        b, c, file, first, times = (x[by_file] for x in (b, c, file, first, times))
        ends = np.cumsum(times)
        # Tokens by file and pair, and the pair of each.
        rows = order[np.repeat(first - ends + times, times) + np.arange(len(tokens))]
        pair_of = np.repeat(np.arange(len(b)), times)
        edges = np.searchsorted(file, np.arange(m.files + 1, dtype=file.dtype))
        row_edges = np.concatenate([[0], ends])[edges]
        width = U(m.words + 2)
        for f in np.flatnonzero(np.diff(edges)):
            level = self.level(int(f))
            low, high = edges[f], edges[f + 1]
            heads, again = np.unique(b[low:high], return_inverse=True)
            node = level.head.find(heads)
            first, length = np.zeros(len(heads), U), np.zeros(len(heads), U)
            first[node >= 0], length[node >= 0] = level.start.step(node[node >= 0])
            seen = np.flatnonzero(length[again])
            again = again[seen]
            found = level.next.find(stretched(first[again], length[again], c[low:high][seen], width))
            place, number = np.full(high - low, -1, np.int64), np.zeros(high - low, np.int64)
            place[seen] = found
            # Of each pair that is in the file: its codes and its range.
            there = np.flatnonzero(place >= 0)
            place = place[there]
            number[there] = np.arange(len(there)) + 1
            p2, back_off = level.next_book[level.next_codes[place]], level.weight_book[level.weight_codes[place]]
            first, length = level.range.step(place)
            # From here on by token: those whose pair is in the file.
            own = rows[row_edges[f] : row_edges[f + 1]]
            pair = number[pair_of[row_edges[f] : row_edges[f + 1]] - low] - 1
            own, pair = own[pair >= 0], pair[pair >= 0]
            bigram[own], weight[own] = p2[pair], back_off[pair]
            found = level.last.find(stretched(first[pair], length[pair], two[own], width))
            hit = found >= 0
            trigram[own[hit]] = level.last_book[level.last_codes[found[hit]]]
        before = np.full(len(tokens), np.log10(PRIOR_3 / (m.documents + PRIOR_3)))
        before[1:] = weight[:-1]
        before[bounds[:-1]] = np.log10(PRIOR_3 / (m.documents + PRIOR_3))
        return before + np.where(np.isnan(trigram), bigram, trigram), single, counts > 0


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = Tries(model)
        for batch in batches:
            out = [np.zeros(batch.num_rows, np.int64) for _ in range(2)] + [np.zeros(batch.num_rows) for _ in range(2)]
            for low, high, data, offsets in pieces(batch.column("text"), most=PIECE, rows=1 << 16):
                hashes, bounds = token_hashes(data, offsets)
                full, single, known = tries.score(hashes, bounds)
                out[0][low:high] = np.diff(bounds)
                out[1][low:high] = np.add.reduceat(known.astype(np.int64), bounds[:-1])
                out[2][low:high] = np.add.reduceat(single, bounds[:-1])
                out[3][low:high] = np.add.reduceat(full, bounds[:-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c) for c in out]], names=["doc_id", "n_tokens", "n_known", "base_score", "score"]
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), "text")
    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)[id_col]}, n_tokens long, n_known long, base_score double, score double")


def trained_and_scored(docs: DataFrame, allowed: Column) -> DataFrame:
    """Train on the allowed documents and score all of them; ``train_tokens`` is the number of training tokens."""
    model = train(docs.where(allowed))
    return scored(docs, model).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
