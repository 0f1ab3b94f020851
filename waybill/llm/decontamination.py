"""Benchmark decontamination by spaced-seed hashing.

Fixed masks select some of the positions of a short window of words and ignore the others, so a substituted word under an
ignored position doesn't hide a hit. Windows of test items and of documents are hashed under each mask; equal hashes are
hits. Each hit's diagonal (place in the document less place in the item) is then verified: along it, the best-scoring run of
equal words is found with substitutions allowed at a cost, and the item counts as leaked if the run is long enough.

Documents send nothing for windows whose hash is not in a bit table of the test windows; the table has a fixed size. A
false bit costs a row in the join and changes no result. The join of test and document hashes is an equi-join of
any size. Words are runs of letters and digits of the whole lower-cased text; items below ``LEAST_ITEM`` words can't
be told from chance and are left out.

Null texts have no words. Documents are told apart by id and text, so null or repeated ids are fine; rows that repeat
give one result. Without items or documents the result is empty. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.columns import free_names
from waybill.llm.sizes import batch_rows, if_small
from waybill.llm.tokens import pieces, splitmix, word_hashes
from waybill.session import cut_lineage

# Positions that each mask looks at. Each has weight 5; the spans are 5 to 9 words.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 4, 6), (0, 2, 3, 5, 8), (0, 1, 4, 6, 7))
LEAST_ITEM = 5
#: Bits of the table of test windows: 2 MB, whatever the number of items. Each window sets a bit for each shift. It rules
#: out nearly all other windows up to about a million test windows; more of them only let more rows into the join.
TABLE_BITS, SHIFTS = 1 << 24, (0, 20, 40)
#: Cost of a substitution against a gain of 1 for an equal word: runs keep three quarters equal words at least.
SUBSTITUTION = 3.0
#: Equal words that a leaked run needs: this share of the item, or this many words.
SHARE, WORDS = 0.6, 24

#: Rows of id tables that may be broadcast.
BROADCAST_IDS = 2_000_000
#: Texts of an Arrow batch.
BATCH_ROWS = 1000

NO_WORD = np.ones(256, dtype=bool)
NO_WORD[48:58] = NO_WORD[65:91] = NO_WORD[97:123] = NO_WORD[128:] = False
FACTORS = splitmix(np.arange(11, 11 + len(MASKS) * 8, dtype=np.uint64)) | np.uint64(1)


def seeds(words: np.ndarray, mask: int) -> np.ndarray:
    """The hash of each window of a word sequence under a mask."""
    places = MASKS[mask]
    n = len(words) - places[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, splitmix(np.array([mask + 1], np.uint64))[0], np.uint64)
    for k, place in enumerate(places):
        total += words[place : place + n] * FACTORS[mask * 8 + k]
    return splitmix(total)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, masks, hashes, places, lengths, bodies = [], [], [], [], [], []
        for low, _, data, offsets in pieces(batch.column("text"), lower=True):
            found, bounds = word_hashes(data, offsets, NO_WORD)
            for k in range(len(bounds) - 1):
                own = found[bounds[k] : bounds[k + 1]]
                if len(own) < LEAST_ITEM:
                    continue
                body = own.tobytes()
                for mask in range(len(MASKS)):
                    for place, value in enumerate(seeds(own, mask)):
                        rows.append(low + k), masks.append(mask), hashes.append(value), places.append(place), lengths.append(len(own)), bodies.append(body if not place and not mask else None)
        ids = batch.column("item_id").take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(masks, pa.int32()), pa.array(np.array(hashes, np.uint64).astype(np.int64)), pa.array(places, pa.int32()), pa.array(lengths, pa.int32()), pa.array(bodies, pa.binary())],
            names=["item_id", "mask", "seed", "item_at", "item_words", "body"],
        )


def test_windows(items: DataFrame) -> DataFrame:
    """item_id, mask, seed, item_at, item_words, body (the item's word hashes, at one row of each item)."""
    kind = dict(items.dtypes)["item_id"]
    return items.select("item_id", "text").mapInArrow(_items, f"item_id {kind}, mask int, seed long, item_at int, item_words int, body binary")


def bits_of(seed, shift: int):
    """One of the numbers below TABLE_BITS that stand for a seed: works on a column and on an array."""
    if isinstance(seed, np.ndarray):
        return (seed >> np.uint64(shift)) & np.uint64(TABLE_BITS - 1)
    return F.shiftrightunsigned(seed, shift).bitwiseAND(F.lit(TABLE_BITS - 1))


def bit_table(windows: DataFrame) -> np.ndarray:
    """The bits of all seeds: at most TABLE_BITS / 64 rows come to the driver."""
    bits = windows.select(F.explode(F.array(*[bits_of(F.col("seed"), shift) for shift in SHIFTS])).alias("bit"))
    words = (
        bits.groupBy(F.floor(F.col("bit") / 64).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("mask")).collect()
    )
    table = np.zeros(TABLE_BITS // 64, np.int64)
    for row in words:
        table[row.word] = row.mask
    return table.view(np.uint64)


def in_table(seeds_here: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Places of the seeds of which all bits are set."""
    at = np.arange(len(seeds_here))
    for shift in SHIFTS:
        bit = bits_of(seeds_here[at], shift)
        at = at[((table[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)]
    return at


def document_hits(spark: SparkSession, docs: DataFrame, table: np.ndarray, id_col: str = "doc_id") -> DataFrame:
    """doc_id, text_key, words, hits (mask, seed, doc_at) of the documents that have a window in the table."""
    shared = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows, keys, bodies, hits = [], [], [], []
            for low, _, data, offsets in pieces(batch.column("text"), lower=True):
                words, bounds = word_hashes(data, offsets, NO_WORD)
                found: dict[int, list] = {}
                for mask in range(len(MASKS)):
                    values = seeds(words, mask)
                    at = in_table(values, known)
                    owner = np.searchsorted(bounds, at, side="right") - 1
                    inside = at + MASKS[mask][-1] < bounds[owner + 1]
                    for k, row in zip(at[inside].tolist(), owner[inside].tolist()):
                        found.setdefault(row, []).append({"mask": mask, "seed": int(values[k].astype(np.int64)), "doc_at": k - int(bounds[row])})
                for row, own in found.items():
                    body = words[bounds[row] : bounds[row + 1]]
                    rows.append(low + row), bodies.append(body.tobytes()), hits.append(own)
                    keys.append(int(splitmix(body + splitmix(np.arange(len(body), dtype=np.uint64))).sum(dtype=np.uint64).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(keys, pa.int64()), pa.array(bodies, pa.binary()),
                    pa.array(hits, pa.list_(pa.struct([("mask", pa.int32()), ("seed", pa.int64()), ("doc_at", pa.int32())]))),
                ],
                names=["doc_id", "text_key", "words", "hits"],
            )

    kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {kind}, text_key long, words binary, hits array<struct<mask:int,seed:long,doc_at:int>>"
    return docs.select(F.col(id_col).alias("doc_id"), "text").mapInArrow(run, schema)


def best_run(equal: np.ndarray) -> tuple[int, int, int]:
    """Start, end and equal words of the best-scoring run: 1 for an equal word, -SUBSTITUTION for another."""
    if not len(equal):
        return 0, 0, 0
    total = np.concatenate([[0.0], np.cumsum(np.where(equal, 1.0, -SUBSTITUTION))])
    least = np.minimum.accumulate(total)
    end = int(np.argmax(total - least))
    start = int(np.flatnonzero(total[: end + 1] == least[end])[-1])
    return start, end, int(equal[start:end].sum())


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list = [[], [], [], []]
        for row, (own, item, diagonal) in enumerate(zip(batch.column("words").to_pylist(), batch.column("body").to_pylist(), batch.column("diagonal").to_pylist())):
            a, b = np.frombuffer(own, np.uint64), np.frombuffer(item, np.uint64)
            low, high = max(0, -diagonal), min(len(b), len(a) - diagonal)
            start, end, equal = best_run(a[low + diagonal : high + diagonal] == b[low:high])
            if equal >= min(WORDS, int(np.ceil(SHARE * len(b)))):
                for column, x in zip(out, (row, low + diagonal + start, end - start, equal)):
                    column.append(x)
        pick = pa.array(out[0], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pick), batch.column("text_key").take(pick), batch.column("item_id").take(pick), *[pa.array(c, pa.int32()) for c in out[1:]]],
            names=["doc_id", "text_key", "item_id", "doc_at", "run_words", "equal_words"],
        )


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, text_key, item_id, and the best run of the item in the document: doc_at, run_words, equal_words."""
    spark = docs.sparkSession
    windows = cut_lineage(test_windows(items))
    with batch_rows(spark, BATCH_ROWS):
        hits = cut_lineage(document_hits(spark, docs, bit_table(windows), id_col))
    single = hits.select("doc_id", "text_key", F.explode("hits").alias("hit")).select("doc_id", "text_key", "hit.*")
    joined = single.join(windows.drop("body"), ["mask", "seed"])
    along = joined.groupBy("doc_id", "text_key", "item_id", (F.col("doc_at") - F.col("item_at")).alias("diagonal")).agg(F.count("*").alias("n"))
    bodies = windows.where("body is not null").groupBy("item_id", "body").agg(F.count("*").alias("_n")).drop("_n")
    own = hits.groupBy("doc_id", "text_key").agg(F.first("words").alias("words"))
    found = along.join(bodies, "item_id")
    keys = [found["doc_id"].eqNullSafe(own["doc_id"]), found["text_key"] == own["text_key"]]
    pairs = found.join(own, keys).select(found["doc_id"], found["text_key"], "item_id", "diagonal", "words", "body")
    kinds = dict(pairs.dtypes)
    runs = pairs.mapInArrow(_verified, f"doc_id {kinds['doc_id']}, text_key long, item_id {kinds['item_id']}, doc_at int, run_words int, equal_words int")
    best = runs.groupBy("doc_id", "text_key", "item_id").agg(F.max(F.struct("equal_words", "run_words", (-F.col("doc_at")).alias("minus"))).alias("best"))
    return best.select("doc_id", "text_key", "item_id", (-F.col("best.minus")).alias("doc_at"), "best.run_words", "best.equal_words")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_ids, n_items, equal_words (of the longest run) of every document with a leak."""
    return (
        leaks(docs, items).groupBy("doc_id")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("equal_words").alias("equal_words"))
        .select("doc_id", "item_ids", F.size("item_ids").alias("n_items"), "equal_words")
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a leak; all columns, whatever their names. If one without an id leaks, all without an id go."""
    (leak,) = free_names(docs, "_leak")
    found = cut_lineage(leaks(docs, items).select(F.col("doc_id").alias(leak)).distinct())
    return docs.join(if_small(found, BROADCAST_IDS), F.col("doc_id").eqNullSafe(F.col(leak)), "left_anti")
