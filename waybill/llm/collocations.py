"""Phrases whose words go together: all frequent n-grams by mergeable Misra-Gries summaries, counted exactly afterwards.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces into words; phrases lie inside one
piece and belong to one language. Two passes over the texts:

1. Each chunk of a task's words becomes, for every hash partition of the n-grams of 1 to 3 words, a small summary: the
   hashes of its n-grams with their counts. The summaries of a partition are merged one after the other into one of at
   most ``capacity`` entries: when there are more, the (capacity + 1)-th largest count is taken off all of them. Capacity
   is more than the partition's mass (all its n-gram occurrences) over the threshold, so less than the threshold is taken
   off any n-gram in all, and each n-gram that occurs so often is still there. Entries whose count and what was
   taken off don't reach the threshold together are dropped. Hashes that collide can only add to a count.
2. Survivors set bits of a table of fixed size; n-grams whose bit is set are counted as text, exactly. A bit set by
   another n-gram lets some through in vain, which the exact count then drops.

Scores come from exact counts in decimal numbers. A hot n-gram is one entry of each summary, so it meets in no task as
more than one entry a chunk. Number and size of the partitions follow the size of the texts.

Null text counts as empty, a null language is ``und``. Empty texts and pieces have no phrases; ties are ordered by the
phrase's bytes; repeated rows count each time. Memory follows the chunk, or the longest text without punctuation if that
is longer. An empty table gives an empty table. Columns besides the text and the language are not read, so none can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.tokens import BASE, BYTE_VALUES, FOLD, borders, pieces, splitmix
from waybill.plans.skew import join_per_key
from waybill.session import cut_lineage

WORDS_END, PIECE_END = b" \t", b".,;:!?\n\x0b\x0c\r"
#: Words of one chunk: its n-grams are counted together. Word numbers inside a chunk fit 21 bits, three of them 63.
CHUNK_WORDS = 1 << 20
#: Text bytes whose n-grams share a hash partition: few for small inputs, up to the larger number where there would be
#: more than ``MANY`` partitions, so that a summary's memory stays bounded and its rows don't get too thin.
PARTITION_BYTES, LARGE_PARTITION_BYTES, LEAST_PARTITIONS, MANY = 1 << 23, 1 << 26, 32, 4096
#: Bits of the table of survivors (16 MB), whatever the input.
TABLE_BITS = 1 << 27
#: Rows of one part of a phrase in a join by shuffle; parts of more phrases are joined by broadcast.
HOT_ROWS = 1_000_000
UNDEFINED = "und"


def _marks(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


BREAK = _marks(PIECE_END)
SEPARATOR = BREAK | _marks(WORDS_END)


class Chunk:
    """Words of consecutive texts: where they are, their hashes, and which of them go on in the next word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray) -> None:
        self.data = FOLD[data]
        self.starts, self.ends = borders(self.data, offsets, SEPARATOR)
        # A word's piece: how many breaks and texts begin before it.
        breaks = np.flatnonzero(BREAK[self.data])
        text = np.searchsorted(offsets, self.starts, "right") - 1
        piece = np.searchsorted(breaks, self.starts) + text
        self.follows = piece[1:] == piece[:-1] if len(piece) else np.zeros(0, bool)
        self.lang = langs[text] if len(text) else np.zeros(0, np.int64)

    def hashes(self, most: int = 1 << 21) -> np.ndarray:
        """64-bit hashes of the words, made in runs of about ``most`` bytes."""
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.zeros(0, np.uint64)
        out, total = np.empty(len(lengths), np.uint64), np.cumsum(lengths)
        low = 0
        while low < len(lengths):
            high = max(int(np.searchsorted(total, (total[low - 1] if low else 0) + most, "right")), low + 1)
            sizes = lengths[low:high]
            first = np.cumsum(sizes) - sizes
            place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
            powers = np.full(int(sizes.max()), BASE, np.uint64)
            powers[0] = 1
            powers = np.cumprod(powers, dtype=np.uint64)
            values = BYTE_VALUES[self.data[np.repeat(self.starts[low:high], sizes) + place]] * powers[place]
            out[low:high] = splitmix(np.add.reduceat(values, first) + sizes.astype(np.uint64))
            low = high
        return out

    def ngrams(self, lang_seeds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For n-grams of 1, 2 and 3 words: n, hash, count and first word of each distinct one (per language).

        Inside the chunk n-grams are told apart by the numbers of their words, not by a hash of the whole.
        """
        if not len(self.starts):
            return
        words, number = np.unique(splitmix(self.hashes() ^ lang_seeds[self.lang]), return_inverse=True)
        if len(words) >= 1 << 21:
            raise ValueError("a chunk has more distinct words than 21 bits can number")
        key, at = number.astype(np.int64), np.arange(len(number))
        for n in (1, 2, 3):
            if n > 1:
                going = self.follows[at + n - 2] if len(self.follows) else np.zeros(0, bool)
                at, key = at[: len(going)][going], key[: len(going)][going]
                key = (key << 21) | number[at + n - 1]
                fit = at + n - 1 < len(self.follows)
            else:
                fit = at < len(self.follows)
            _, first, counts = np.unique(key, return_index=True, return_counts=True)
            place = at[first]
            value = words[number[place]]
            for k in range(1, n):
                value = splitmix(value * BASE + words[number[place + k]])
            yield n, value, counts, place
            at, key = at[fit], key[fit]

    def phrases(self, n: int, place: np.ndarray) -> pa.Array:
        """The texts of n-grams that begin at the given words, one space between words."""
        k = (place[:, None] + np.arange(n)).ravel()
        sizes = self.ends[k] - self.starts[k] + 1
        first = np.cumsum(sizes) - sizes
        inside = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        source = np.repeat(self.starts[k], sizes) + inside
        out = self.data[np.minimum(source, len(self.data) - 1)]
        out[first + sizes - 1] = 32  # behind each word; the last one of a phrase is cut off with a slice of the view
        ends = (first + sizes)[n - 1 :: n]
        keep = np.ones(len(out), bool)
        keep[ends - 1] = False
        offsets = np.append(0, ends - np.arange(1, len(ends) + 1)).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(place), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(out[keep]))).cast(pa.string())


def language_seeds(langs: list[str]) -> np.ndarray:
    """A number for each language, from its name."""
    out = np.zeros(len(langs), np.uint64)
    with np.errstate(over="ignore"):
        for k, lang in enumerate(langs):
            for byte in lang.encode():
                out[k] = splitmix(out[k : k + 1] * BASE + BYTE_VALUES[byte])[0]
    return out


def chunks(batches: Iterator[pa.RecordBatch], most: int = CHUNK_WORDS * 6) -> Iterator[tuple[Chunk, list[str]]]:
    """Chunks of about ``most`` bytes of whole texts. A longer text is cut behind marks that end pieces."""
    for batch in batches:
        names = pc.fill_null(batch.column("lang"), UNDEFINED).dictionary_encode()
        langs, codes = names.dictionary.to_pylist(), names.indices.to_numpy(zero_copy_only=False)
        for low, high, data, offsets in pieces(batch.column("body"), most=most, rows=1 << 20):
            if len(data) <= most:
                yield Chunk(data, offsets, codes[low:high]), langs
                continue
            start = 0
            while start < len(data):  # one text
                end = min(start + most, len(data))
                if end < len(data):
                    marks = np.flatnonzero(BREAK[data[start:end]])
                    later = np.flatnonzero(BREAK[data[end:]]) if not len(marks) else marks
                    end = start + int(marks[-1]) + 1 if len(marks) else (end + int(later[0]) + 1 if len(later) else len(data))
                yield Chunk(data[start:end], np.array([0, end - start]), codes[low:high]), langs
                start = end


SUMMARY = "part int, kind int, mass long, hashes binary, counts binary"


def summaries(texts: DataFrame, parts: int) -> DataFrame:
    """part, kind 0, mass and part, kind 1, hashes, counts: one summary for each chunk and hash partition."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, langs in chunks(batches):
            found = [(value, counts) for _, value, counts, _ in chunk.ngrams(language_seeds(langs))]
            if not found:
                continue
            value, counts = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            part, low = split_hash(value, parts)
            order = np.lexsort((low, part))
            part, low, counts = part[order], low[order], counts[order].astype(np.uint32)
            bounds = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
            mass = np.add.reduceat(counts.astype(np.int64), bounds[:-1])
            numbers, spans = part[bounds[:-1]], list(zip(bounds, bounds[1:]))
            # Counts of one are most of all counts: those entries stand first, and only the others' counts are kept.
            blobs = [_packed(low[x:y], counts[x:y]) for x, y in spans]
            n = len(spans)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(numbers, 2).astype(np.int32)), pa.array(np.repeat([0, 1], n).astype(np.int32)), pa.array(np.concatenate([mass, np.zeros(n, np.int64)])),
                    pa.array([None] * n + [b[0] for b in blobs], pa.binary()), pa.array([None] * n + [b[1] for b in blobs], pa.binary()),
                ],
                names=["part", "kind", "mass", "hashes", "counts"],
            )

    return texts.mapInArrow(work, SUMMARY)


def split_hash(value: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash partition, and the 32 bits that name an n-gram inside it. The two use different bits."""
    return ((value >> np.uint64(32)) % np.uint64(parts)).astype(np.int64), (value & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _packed(low: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    one = counts == 1
    return np.concatenate([low[one], low[~one]]).tobytes(), counts[~one].tobytes()


class Summary:
    """A Misra-Gries summary that takes in others. ``taken``: what was taken off every count so far."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Entries are put together when as many wait as the summary may hold, so each is sorted a few times only."""
        self.waiting.append((keys, counts))
        self.rows += len(keys)
        if self.rows > max(self.capacity, 1 << 16):
            self._merge()

    def _merge(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.waiting]])
        counts = np.concatenate([self.counts, *[c for _, c in self.waiting]])
        self.waiting, self.rows = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(keys) > self.capacity:
            off = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            self.taken += off
            stays = counts > off
            keys, counts = keys[stays], counts[stays] - off
        self.keys, self.counts = keys, counts

    def survivors(self, threshold: int) -> np.ndarray:
        self._merge()
        return self.keys[self.counts + self.taken >= threshold]


def merged(found: DataFrame, parts: int, threshold: int, bits: int = TABLE_BITS) -> DataFrame:
    """part, n (survivors), bits: the part's piece of the table of survivors, ``bits / parts`` bits."""
    piece = max(bits // parts // 8, 1)

    def table(part: int, summary: Summary | None) -> dict:
        keys = summary.survivors(threshold)
        out = np.zeros(piece, np.uint8)
        place = keys.astype(np.int64) % (piece * 8)
        np.bitwise_or.at(out, place >> 3, (1 << (place & 7)).astype(np.uint8))
        return {"part": part, "n": len(keys), "taken": summary.taken, "bits": out.tobytes()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None
        out: list[dict] = []
        for batch in batches:
            for row in range(len(batch)):
                number, kind = batch.column("part")[row].as_py(), batch.column("kind")[row].as_py()
                if number != part:
                    if part is not None:
                        out.append(table(part, summary))
                        yield pa.RecordBatch.from_pylist(out, schema=TABLE)
                        out = []
                    part, mass, summary = number, 0, None
                if kind == 0:  # all masses of a part come before its entries
                    mass += batch.column("mass")[row].as_py()
                    continue
                summary = summary or Summary(mass // threshold + 1)
                keys = np.frombuffer(batch.column("hashes")[row].as_py(), np.uint32)
                more = np.frombuffer(batch.column("counts")[row].as_py(), np.uint32)
                counts = np.ones(len(keys), np.int64)
                counts[len(keys) - len(more) :] = more
                summary.add(keys, counts)
        if part is not None:
            yield pa.RecordBatch.from_pylist([table(part, summary)], schema=TABLE)

    dealt = found.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind")
    return dealt.mapInArrow(work, "part int, n long, taken long, bits binary")


TABLE = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("taken", pa.int64()), ("bits", pa.binary())])


def counted(texts: DataFrame, parts: int, tables: list, bits: int = TABLE_BITS) -> DataFrame:
    """lang, k (words), phrase, n: counts of n-grams whose bit is set, per chunk; k = 0 has all words of a language."""
    piece = max(bits // parts // 8, 1)
    whole = np.zeros(parts * piece, np.uint8)
    for row in tables:
        whole[row["part"] * piece : (row["part"] + 1) * piece] = np.frombuffer(row["bits"], np.uint8)
    shared = texts.sparkSession.sparkContext.broadcast(whole)  # of fixed size

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for chunk, langs in chunks(batches):
            totals = np.bincount(chunk.lang, minlength=len(langs))
            yield _rows(langs, np.flatnonzero(totals), 0, pa.array([""] * int((totals > 0).sum()), pa.string()), totals[totals > 0])
            for n, value, counts, place in chunk.ngrams(language_seeds(langs)):
                part, low = split_hash(value, parts)
                at = low.astype(np.int64) % (piece * 8)
                hit = (table[part * piece + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1 == 1
                for x in range(0, int(hit.sum()), 1 << 18):
                    rows = np.flatnonzero(hit)[x : x + (1 << 18)]
                    yield _rows(langs, chunk.lang[place[rows]], n, chunk.phrases(n, place[rows]), counts[rows])

    return texts.mapInArrow(work, "lang string, k int, phrase string, n long")


def _rows(langs: list[str], codes: np.ndarray, n: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    names = pa.DictionaryArray.from_arrays(pa.array(codes.astype(np.int32)), pa.array(langs, pa.string())).cast(pa.string())
    return pa.RecordBatch.from_arrays([names, pa.array(np.full(len(codes), n, np.int32)), phrases, pa.array(counts.astype(np.int64))], names=["lang", "k", "phrase", "n"])


def frequent(docs: DataFrame, threshold: int = 10, text_col: str = "text", lang_col: str = "lang", parts: int | None = None, bits: int = TABLE_BITS) -> DataFrame:
    """lang, k, phrase, n of every n-gram of 1 to 3 words that occurs ``threshold`` times or more in its language, exactly
    counted; and a row with k = 0 and phrase '' for each language, whose n is the number of all its words."""
    texts = docs.select(F.col(text_col).alias("body"), F.col(lang_col).cast("string").alias("lang"))
    if parts is None:
        size = texts.agg(F.sum(F.octet_length("body"))).first()[0] or 0
        parts = max(LEAST_PARTITIONS, min(-(-size // PARTITION_BYTES), MANY), -(-size // LARGE_PARTITION_BYTES))
    tables = merged(summaries(texts, parts), parts, threshold, bits).select("part", "bits").collect()  # ``bits`` in all
    rows = counted(texts, parts, tables, bits).groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))
    return rows.where((F.col("k") == 0) | (F.col("n") >= threshold))


def _words(phrase: str, first: int, number: int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, number), " ")


def scored(counts: DataFrame) -> DataFrame:
    """lang, k, phrase, a, l, r, score of every phrase of two or three words in a table of exact counts.

    Each cut's two parts are looked up by a join that takes the parts of very many phrases by broadcast.
    """
    longer = counts.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"))
    cuts = longer.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    sides = cuts.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    part = F.when(F.col("side") == 0, _words("phrase", F.lit(1), F.col("cut"))).otherwise(_words("phrase", F.col("cut") + 1, F.col("k") - F.col("cut")))
    sides = sides.withColumn("part", part)
    needed = sides.groupBy("lang", "part").agg(F.count("*").alias("uses"))
    known = needed.join(counts.where("k > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f")), ["lang", "part"])
    found = join_per_key(sides, known, ["lang", "part"], "uses", "phrase", HOT_ROWS)
    pairs = found.groupBy("lang", "k", "phrase", "a", "cut").agg(
        F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r")
    )
    # Counts up to 10^15 stay exact: 10^6 * a * a and l * r fit 38 digits. The quotient is 10^6 at most, as a <= l, r.
    score = F.expr("(CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0))) div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))")
    valued = pairs.withColumn("score", score.cast("long"))
    best = F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut"))
    return valued.groupBy("lang", "k", "phrase", "a").agg(best.alias("x")).select("lang", "k", "phrase", "a", "x.l", "x.r", "x.score")


def maximal(phrases: DataFrame, percent: int = 50) -> DataFrame:
    """The phrases without those inside a longer one that has at least ``percent`` of their occurrences."""
    inner = phrases.where("k = 3").select("lang", "a", F.explode(F.array(_words("phrase", F.lit(1), F.lit(2)), _words("phrase", F.lit(2), F.lit(2)))).alias("phrase"))
    longest = inner.groupBy("lang", "phrase").agg(F.max("a").alias("outer"))
    covered = F.col("outer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * percent
    return phrases.join(longest, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False))).drop("outer")


def collocations(docs: DataFrame, threshold: int = 10, first: int = 2000, percent: int = 50, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``first`` phrases by score, occurrences and phrase."""
    counts = cut_lineage(frequent(docs, threshold, text_col, lang_col))
    kept = maximal(scored(counts), percent)
    # Spark keeps the first rows of each task's part of a language before it shuffles them.
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).where(F.col("rank") <= first)
    words = counts.where("k = 0").select("lang", "n")
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
