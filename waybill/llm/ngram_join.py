"""Similarity join on word shingles with grouped prefixes, and the components of its links.

A document's set are the hashes of its distinct five-word shingles. Documents with one set are one class. In a global
order of shingles, two sets that link must share one of the first ``prefix_size`` shingles of either. The order is by
hash, with frequent shingles last. Classes with identical prefixes and size are one group; groups meet by prefix
shingles, pairs are filtered by size, by their places in the order and by parity sketches, then expanded to member classes
and verified on the whole sets.

A parity sketch tells of each of some thousand bits whether an odd number of a set's shingles fall on it. Two sets differ
in at least as many shingles as their sketches differ in bits, so the sketch rules out pairs and never a link. Large
buckets are cut into blocks; rows of two blocks meet in a task, which compares sketches and writes only the pairs that are
left. So a family of thousands that all nearly link is compared, but its pairs are never written.

Only components are asked for, so pairs that already hang together need no check. First each class meets one pivot of each of
its buckets; after that only pairs across components are made, and none is left out. The result has all links'
components, and no group of copies is expanded into its pairs.

Frequent shingles: one that more than ``FREQUENT`` groups have in their first shingles goes to the end of the order. A class that then has too few shingles
left gets its exact prefix from its whole set. Tasks that see a shingle very often report it once instead of sending
each of its rows, so a shingle of a third of all documents is no hot key. A shingle that one task reports is frequent for
all groups, also for those of tasks that have sent it.

Null and empty texts have no set and link with nothing. Null ids are linked by their texts; the component's id is the
smallest id that is not null. Rows that repeat are one class. Hashes have 64 bits, which is where exactness ends.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.columns import free_names
from waybill.llm.graphs import components
from waybill.llm.sizes import LEAST_PARTS, batch_rows, few, if_small
from waybill.llm.tokens import WHITE, pieces, splitmix, word_hashes
from waybill.session import cut_lineage

#: Groups that may share a shingle before it counts as frequent.
FREQUENT = 32
#: Members of a large family that all others meet.
HUBS = 8
#: Rows of id tables that may be broadcast.
BROADCAST_IDS = 500_000
#: Rows of the table of classes and their groups that may be broadcast.
BROADCAST_MEMBERS = 100_000
#: Bytes of lists or sets that may be broadcast to the pairs that need them.
BROADCAST_BYTES = 2 << 20
#: Rows of an Arrow batch: texts, or pairs of sets.
BATCH_ROWS = 1000
#: Rows of a partition of prefixes and of pairs; rows of buckets for each document, to choose partitions.
PART_PREFIXES, PART_PAIRS, ENTRIES = 2_000, 20_000, 8
#: Shingles of prefixes in a partition: the more of a group's shingles go to one, the better its number compresses there.
PART_SHINGLES = 2_000_000
#: Rows of a block of a bucket; two blocks meet in one task.
BLOCK = 2048
#: Bits of a sketch per shingle at least, and the least and most bits (as powers of two) of one; of those most in buckets.
BITS_PER_SHINGLE, LEAST_BITS, MOST_BITS, BUCKET_BITS = 3, 8, 13, 11
#: Pairs of buckets that a task remembers about.
SEEN_PAIRS = 100_000
#: Pairs of a block whose sketches are compared at once.
TILE = 1 << 15


def prefix_size(n: int, percent: int) -> int:
    """Of two linked sets, each has one of the other's shingles among its first so many."""
    return n - -(-percent * n // 100) + 1


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text that has words."""
    factors = splitmix(np.arange(101, 101 + width, dtype=np.uint64)) | np.uint64(1)
    for low, _, data, offsets in pieces(column):
        words, bounds = word_hashes(data, offsets, WHITE)
        n = len(words) - width + 1
        all_windows = np.zeros(max(n, 0), np.uint64)
        for k in range(width if n > 0 else 0):
            all_windows += words[k : k + n] * factors[k]
        all_windows = splitmix(all_windows).view(np.int64)
        for row in range(len(bounds) - 1):
            first, count = int(bounds[row]), int(bounds[row + 1] - bounds[row])
            if count >= width:
                yield low + row, np.unique(all_windows[first : first + count - width + 1])
            elif count:
                whole = (words[first : first + count] * factors[:count]).sum(dtype=np.uint64) + np.uint64(count)
                yield low + row, splitmix(np.array([whole], np.uint64)).view(np.int64)


def class_of(own: np.ndarray) -> int:
    """One number for a set (a sorted array)."""
    mixed = splitmix(own.view(np.uint64) + splitmix(np.arange(len(own), dtype=np.uint64)))
    return int(splitmix(mixed.sum(dtype=np.uint64)[None] + np.uint64(len(own))).view(np.int64)[0])


def parity(own: np.ndarray) -> bytes:
    """The sketch of a set. Its two halves, one upon the other, are the sketch of half the size."""
    bits = 1 << min(MOST_BITS, max(LEAST_BITS, (BITS_PER_SHINGLE * len(own) - 1).bit_length()))
    times = np.bincount((own & (bits - 1)), minlength=bits) & 1
    return np.packbits(times.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (rows of 64-bit words) of at most so many words."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


class Sketches:
    """Sketches of several sizes, null ones included, compared by row numbers."""

    def __init__(self, column: pa.Array):
        self.column = column
        self.words = np.array([len(x) // 8 if x is not None else 0 for x in column.to_pylist()], np.int64)
        self.levels: dict[int, np.ndarray] = {}

    def level(self, words: int) -> np.ndarray:
        """The sketches of that size and, folded, of larger ones."""
        if words not in self.levels:
            out = np.zeros((len(self.words), words), np.uint64)
            for size in np.unique(self.words[self.words >= words]):
                rows = np.flatnonzero(self.words == size)
                raw = b"".join(self.column.take(pa.array(rows)).to_pylist())
                out[rows] = folded(np.frombuffer(raw, np.uint64).reshape(len(rows), size), words)
            self.levels[words] = out
        return self.levels[words]


def differing(a: Sketches, b: Sketches, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """In how many shingles row ``i`` of one and row ``j`` of the other differ at least; 0 where a sketch is null."""
    out = np.zeros(len(i), np.int64)
    words = np.minimum(a.words[i], b.words[j])
    for size in np.unique(words[words > 0]):
        at = np.flatnonzero(words == size)
        out[at] = np.bitwise_count(a.level(size)[i[at]] ^ b.level(size)[j[at]]).sum(axis=1)
    return out


def may_link(na: np.ndarray, nb: np.ndarray, apart: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can link that differ in at least so many shingles."""
    most = np.minimum((na + nb - apart) // 2, np.minimum(na, nb))
    return 100 * most >= percent * (na + nb - most)


def signatures(docs: DataFrame, width: int, percent: int, id_col: str) -> DataFrame:
    """doc_id, n, cls, grp, first (the first shingles by hash), often (those of them that this task has seen very often),
    sketch (which rules out most pairs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            n, cls, grp = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            first: list = [None] * rows
            sketch: list = [None] * rows
            for row, own in shingle_sets(batch.column("text"), width):
                p = prefix_size(len(own), percent)
                n[row], cls[row], grp[row] = len(own), class_of(own), class_of(own[:p]) ^ len(own)
                # An eighth more than the prefix, to make up for frequent ones.
                first[row] = own[: p + p // 8 + 4].copy()
                sketch[row] = parity(own)
            filled = [k for k in range(rows) if first[k] is not None]
            often: list = [None] * rows
            if filled:
                # Copies inside the batch count once.
                _, once = np.unique(cls[filled], return_index=True)
                shingles, times = np.unique(np.concatenate([first[filled[k]] for k in once]), return_counts=True)
                many = shingles[times > FREQUENT]
                if len(many):
                    for k in filled:
                        hit = first[k][np.isin(first[k], many, assume_unique=True)]
                        often[k] = hit if len(hit) else None
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n), pa.array(cls, mask=n == 0), pa.array(grp, mask=n == 0),
                    pa.array(first, pa.list_(pa.int64())), pa.array(often, pa.list_(pa.int64())), pa.array(sketch, pa.binary()),
                ],
                names=["doc_id", "n", "cls", "grp", "first", "often", "sketch"],
            )

    schema = f"doc_id {dict(docs.dtypes)[id_col]}, n long, cls long, grp long, first array<long>, often array<long>, sketch binary"
    return docs.select(F.col(id_col).alias("doc_id"), "text").mapInArrow(run, schema)


def whole_sets(docs: DataFrame, ids: DataFrame, width: int, id_col: str, about: int) -> DataFrame:
    """cls, shingles of the documents whose id is in ``ids`` (doc_id, about so many) or null: texts are read again, only those are hashed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets(batch.column("text"), width))
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_of(own) for _, own in found], pa.int64()), pa.array([own for _, own in found], pa.list_(pa.int64()))],
                names=["cls", "shingles"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), "text")
    asked = if_small(ids.select("doc_id").distinct().withColumn("asked", F.lit(1)), BROADCAST_IDS, about)
    wanted = rows.join(asked, "doc_id", "left").where("asked = 1 or doc_id is null")
    return wanted.select("text").mapInArrow(run, "cls long, shingles array<long>").dropDuplicates(["cls"])


def size_fits(a: Column, b: Column, percent: int) -> Column:
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many numbers of one sorted array the other holds."""
    if not len(a) or not len(b):
        return 0
    at = np.minimum(b.searchsorted(a), len(b) - 1)
    return int((b[at] == a).sum())


def _bounded(percent: int):
    """Keeps pairs that their sketches don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            rows = np.arange(batch.num_rows)
            apart = differing(Sketches(batch.column("sketch_a")), Sketches(batch.column("sketch_b")), rows, rows)
            yield batch.select(["a", "b"]).filter(pa.array(may_link(na, nb, apart, percent)))

    return run


def block_pairs(cell: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a cell that may link, from different components and, where two blocks meet, from both of them."""
    item, comp, n, place, part, low, high = (cell.column(c).to_numpy() for c in ("item", "comp", "n", "place", "part", "low", "high"))
    rows = np.arange(len(n))
    # Each pair has a member outside the largest component.
    names, where, times = np.unique(comp, return_inverse=True, return_counts=True)
    mover = where != times.argmax()
    movers = np.flatnonzero(mover)
    sketches = Sketches(cell.column("sketch").combine_chunks())
    found: tuple[list, list] = ([], [])
    step = max(1, TILE // len(n))
    for first in range(0, len(movers), step):
        own = movers[first : first + step]
        fits = (where[own][:, None] != where[None, :]) & (~mover[None, :] | (rows[None, :] > own[:, None])) & (item[own][:, None] != item[None, :])
        if low[0] != high[0]:
            fits &= part[own][:, None] != part[None, :]
        na, nb = n[own][:, None], n[None, :]
        fits &= 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
        # Two linked sets share this many shingles, so one of the first n + 1 - overlap of either: where both places in
        # exact prefixes are known, the rest of the prefixes is for partners of other sizes.
        overlap = -(-percent * (na + nb) // (100 + percent))
        known = (place[own][:, None] > 0) & (place[None, :] > 0)
        fits &= ~known | ((place[own][:, None] <= na + 1 - overlap) & (place[None, :] <= nb + 1 - overlap))
        i, j = np.nonzero(fits)
        i = own[i]
        keep = may_link(n[i], n[j], differing(sketches, sketches, i, j), percent)
        found[0].append(i[keep]), found[1].append(j[keep])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)


def _met(percent: int):
    """Pairs of each cell; rows come cell by cell, and a cell has two blocks at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        #: Buckets of a family give the same pairs: those that the task still remembers are not written again.
        seen: set = set()

        def cells(last: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            keys = [table.column(c).to_numpy() for c in ("bucket", "low", "high")]
            starts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            bounds = [0, *starts.tolist(), table.num_rows] if last else [0, *starts.tolist()]
            sides: tuple[list, list] = ([], [])
            for start, end in zip(bounds, bounds[1:]):
                if end - start > 1:
                    for side, rows in zip(sides, block_pairs(table.slice(start, end - start), percent)):
                        side.append(rows + start)
            held[:] = [] if last else table.slice(bounds[-1]).combine_chunks().to_batches()
            i, j = (np.concatenate(side) if side else np.zeros(0, np.int64) for side in sides)
            item, comp = table.column("item").to_numpy(), table.column("comp").to_numpy()
            swap = (comp[i] > comp[j]) | ((comp[i] == comp[j]) & (item[i] > item[j]))
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            found = dict.fromkeys(zip(*(x.tolist() for x in (item[i], comp[i], item[j], comp[j]))))
            fresh = [pair for pair in found if pair not in seen]
            if len(seen) > SEEN_PAIRS:
                seen.clear()
            seen.update(fresh)
            columns = [pa.array([pair[k] for pair in fresh], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names=["g", "comp_g", "h", "comp_h"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                yield from cells(False)
        if held:
            yield from cells(True)

    return run


def _narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketches of the size that buckets hold."""
    for batch in batches:
        words = (1 << BUCKET_BITS) // 64
        raw = [folded(np.frombuffer(x, np.uint64)[None], words).tobytes() for x in batch.column("sketch").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(raw, pa.binary())], names=["cls", "sketch"])


def _slim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketches of a quarter of their size, which still rule out sets that have little in common."""
    for batch in batches:
        own = [np.frombuffer(x, np.uint64)[None] for x in batch.column("sketch").to_pylist()]
        raw = [folded(x, max(1, x.shape[1] // 4)).tobytes() for x in own]
        yield pa.RecordBatch.from_arrays([batch.column("cls"), batch.column("n"), pa.array(raw, pa.binary())], names=["cls", "n", "sketch"])


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            parts = []
            for name in ("set_a", "set_b"):
                column = batch.column(name)
                parts.append((column.offsets.to_numpy(), column.values.to_numpy()))
            for k in range(batch.num_rows):
                a, b = (values[offsets[k] : offsets[k + 1]] for offsets, values in parts)
                both = common(a, b)
                keep[k] = 100 * both >= percent * (len(a) + len(b) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


class Join:
    """The steps of one join; each step's small result is saved before the next uses it."""

    def __init__(self, docs: DataFrame, width: int = 5, percent: int = 75, id_col: str = "doc_id"):
        self.docs, self.width, self.percent, self.id_col = docs, width, percent, id_col
        self.base = cut_lineage(signatures(docs, width, percent, id_col))
        self.rows, prefixes = self.base.agg(F.count("*"), F.coalesce(F.sum(F.size("first")), F.lit(0))).first()
        self.shingle_parts = max(LEAST_PARTS, -(-prefixes // PART_SHINGLES))
        self.base = few(self.base, self.rows, PART_PREFIXES)
        filled = self.base.where("n > 0")
        #: cls, n, grp, doc_id (a document that has this set; its text can be read again).
        self.classes = self.saved(filled.groupBy("cls", "n", "grp").agg(F.min("doc_id").alias("doc_id")))
        self.lists = filled.select("cls", "n", "sketch")

    def saved(self, df: DataFrame, each: int = 1) -> DataFrame:
        """Saved, in partitions for about ``each`` rows a document."""
        return cut_lineage(few(df, each * self.rows))

    def entries(self) -> DataFrame:
        """tok, grp, n, place: buckets of groups that share shingles of their prefixes, frequent shingles last in the order.

        Shingles with the same groups are one bucket: a family of near copies shares hundreds of shingles and has a few
        buckets. A group whose first shingles are too often frequent is given its exact prefix, in which ``place`` is the
        shingle's number.
        """
        filled = self.base.where("n > 0")
        rest = F.when(F.col("often").isNull(), F.col("first")).otherwise(F.array_except("first", "often"))
        rows = filled.select("grp", "n", F.explode(rest).alias("tok"))
        kept_back = filled.where("often is not null").select("grp", F.explode("often").alias("tok"))
        # What one task holds back is frequent in all: a row without a group tells the rows that others have sent.
        held = kept_back.select("tok").distinct().select(F.lit(None).cast("long").alias("grp"), F.lit(None).cast("long").alias("n"), "tok")
        # One exchange: copies fall out, and shingles are counted where they meet.
        met = rows.union(held).repartition(self.shingle_parts, "tok").distinct()
        here = Window.partitionBy("tok")
        counted = met.withColumn("c", F.count("grp").over(here)).withColumn("held", F.count("*").over(here) > F.count("grp").over(here))
        counted = counted.withColumn("alike", F.expr("bit_xor(xxhash64(grp))").over(here)).where("grp is not null and (held or c > 1)")
        # The groups of a bucket decide its number; frequent shingles stay by themselves.
        frequent_here = F.col("held") | (F.col("c") > FREQUENT)
        shared = counted.select(F.when(frequent_here, F.col("tok")).alias("often"), F.when(~frequent_here, F.col("alike")).alias("tok"), "grp", "n")
        shared = self.saved(shared.distinct(), ENTRIES)
        sent = shared.where("often is not null").select("grp", F.col("often").alias("tok"))
        lost_rows = self.saved(sent.union(kept_back).distinct(), ENTRIES)
        frequent = lost_rows.select("tok").distinct()
        buckets = shared.where("often is null").select("tok", "grp", "n", F.lit(None).cast("int").alias("place"))
        # Groups whose first shingles don't hold a whole prefix without the frequent ones.
        lost = lost_rows.groupBy("grp").agg(F.count("*").alias("lost"))
        need = F.col("n") - F.ceil(F.lit(self.percent) * F.col("n") / 100) + 1
        sizes = filled.select("grp", "n", F.size("first").alias("size")).distinct()
        lost_too_many = F.col("size") - F.col("lost") < need
        short = self.saved(sizes.join(lost, "grp").where(lost_too_many).select("grp", "n"))
        if short.isEmpty():
            return buckets
        # Their exact prefixes, from whole sets: shingles that are not frequent first, by hash.
        members = self.classes.join(short.select("grp"), "grp")
        sets = whole_sets(self.docs, members, self.width, self.id_col, self.rows).join(members.select("cls", "grp", "n"), "cls")
        tokens = sets.select("cls", "grp", "n", F.explode("shingles").alias("tok"))
        frequent = if_small(frequent.withColumn("late", F.lit(1)), BROADCAST_IDS, self.rows)
        flagged = tokens.join(frequent, "tok", "left")
        # Of each class, as the new order may part the classes of a group; the group stands for all of them.
        place = F.row_number().over(Window.partitionBy("cls").orderBy(F.coalesce("late", F.lit(0)), "tok"))
        ranked = flagged.withColumn("place", place).where(F.col("place") <= need)
        exact = self.saved(ranked.groupBy("tok", "grp", "n").agg(F.min("place").alias("place")), ENTRIES)
        # The other groups that have one of these shingles, unless it is frequent and so behind their own prefixes.
        again = rows.join(if_small(exact.select("tok").distinct(), BROADCAST_IDS, ENTRIES * self.rows), "tok", "left_semi")
        again = again.join(frequent, "tok", "left_anti").join(short.select("grp"), "grp", "left_anti")
        more = exact.union(again.select("tok", "grp", "n", F.lit(None).cast("int")).distinct())
        return buckets.union(more)

    def sketches(self, asked: DataFrame, lists: DataFrame | None = None) -> DataFrame:
        """cls, n, sketch of some classes, each asked for once, or these columns of ``lists``.

        No semi-join: Spark moves it below the coalescing of the lists, whose rows would then be dealt out by class twice.
        """
        asked = if_small(asked.select("cls"), BROADCAST_MEMBERS, self.rows)
        return (self.lists if lists is None else lists).join(asked, "cls").dropDuplicates(["cls"])

    def narrow(self, items: DataFrame) -> DataFrame:
        """item, sketch as buckets hold it, of some classes (item), for a join on item."""
        asked = cut_lineage(few(items.select(F.col("item").alias("cls")).distinct(), self.rows))
        lists = self.lists.select("cls", "sketch").mapInArrow(_narrow, "cls long, sketch binary")
        found = self.sketches(asked, lists).select(F.col("cls").alias("item"), "sketch")
        return self.beside(found, asked, F.least("n", F.lit(1 << BUCKET_BITS - 3)))

    def beside(self, side: DataFrame, asked: DataFrame, each: Column) -> DataFrame:
        """What some classes hold, one row of at most ``each`` bytes for a class: broadcast if all are small. Else it stays
        dealt out by class as it is, so that joins need not deal it again."""
        total = self.classes.join(asked, "cls", "left_semi").agg(F.coalesce(F.sum(each + 32), F.lit(0))).first()[0]
        return F.broadcast(cut_lineage(side)) if total <= BROADCAST_BYTES else side.hint("merge")

    def meetings(self, rows: DataFrame, sketched: DataFrame) -> DataFrame:
        """g, comp_g, h, comp_h: items of a bucket that may link across components.

        ``rows`` are bucket, item, comp, n, place (in an exact prefix, or null), ``sketched`` are item, sketch, marked for
        their join; an item without a sketch may link whatever it holds.
        """
        large = rows.groupBy("bucket").agg(F.count("*").alias("c")).where(F.col("c") > BLOCK)
        blocks = large.select("bucket", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks"))
        blocks = self.saved(blocks)
        if blocks.isEmpty():
            cut = rows.withColumn("blocks", F.lit(1))
        else:
            cut = rows.join(if_small(blocks, BROADCAST_IDS), "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        cut = cut.withColumn("part", F.pmod(F.xxhash64("item", "comp"), "blocks").cast("int")).withColumn("place", F.coalesce("place", F.lit(0)))
        cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        cut = cut.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other")).drop("other", "blocks")
        full = cut.join(sketched, "item", "left")
        cells = full.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
        found = cells.select("bucket", "low", "high", "item", "comp", "n", "place", "part", "sketch")
        return found.mapInArrow(_met(self.percent), "g long, comp_g long, h long, comp_h long").distinct()

    def bounded(self, pairs: DataFrame, count: int, lists: DataFrame | None = None, most_bits: int = MOST_BITS) -> DataFrame:
        """The pairs of classes, about so many, that their sketches don't rule out; or those of ``lists``, of so many bits."""
        asked = cut_lineage(few(pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct(), self.rows))
        lists = self.beside(self.sketches(asked, lists), asked, F.least("n", F.lit(1 << most_bits - 3)))
        a, b = (lists.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}")) for x in "ab")
        listed = pairs.join(a, "a").join(b, "b").where(size_fits(F.col("n_a"), F.col("n_b"), self.percent))
        return cut_lineage(few(listed, count, PART_PAIRS).mapInArrow(_bounded(self.percent), "a long, b long"))

    def verified(self, pairs: DataFrame, fresh: bool = False) -> DataFrame:
        """The links among pairs of classes: bounded by their sketches, then on whole sets.

        Most ``fresh`` pairs have little in common, so slim sketches go with them first.
        """
        pairs = self.saved(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), ENTRIES)
        count = pairs.count()
        if fresh:
            pairs = self.bounded(pairs, count, self.lists.mapInArrow(_slim, "cls long, n long, sketch binary"), MOST_BITS - 2)
            count = pairs.count()
        left = self.bounded(pairs, count)
        needed = left.select(F.col("a").alias("cls")).union(left.select(F.col("b").alias("cls"))).distinct()
        needed = if_small(needed, BROADCAST_IDS, min(2 * count, self.rows))
        sets = whole_sets(self.docs, self.classes.join(needed, "cls"), self.width, self.id_col, self.rows)
        sets = self.beside(sets.join(needed, "cls", "left_semi"), needed, 8 * F.col("n"))
        one = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("set_a"))
        two = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("set_b"))
        both = few(left.join(one, "a").join(two, "b"), count, PART_PAIRS)
        return cut_lineage(both.mapInArrow(_linked(self.percent), "a long, b long"))

    def linked(self) -> DataFrame:
        """cls, grp, n, comp of every class: the components of all links."""
        entries = self.saved(self.entries(), ENTRIES)
        banded = entries.withColumn("band", self.band("n"))
        # Pivots: the first group of each bucket and size band, for its own band and the one below.
        pivots = banded.groupBy("tok", "band").agg(F.min(F.struct("grp", "n")).alias("pivot"))
        near = banded.withColumn("band", F.explode(F.array("band", F.col("band") + 1)))
        met = near.join(pivots, ["tok", "band"]).where(size_fits(F.col("n"), F.col("pivot.n"), self.percent))
        met = met.select(F.col("grp").alias("g"), F.col("pivot.grp").alias("h")).where("g <> h").distinct()
        heads = self.classes.groupBy("grp").agg(F.min("cls").alias("head"))
        inside = self.classes.join(heads, "grp").select(F.col("cls").alias("a"), F.col("head").alias("b")).where("a <> b")
        to_head = met.join(heads.withColumnRenamed("grp", "h"), "h").join(self.classes.select(F.col("grp").alias("g"), "cls"), "g")
        first = self.verified(inside.union(to_head.select(F.col("cls").alias("a"), F.col("head").alias("b"))), fresh=True)
        placed, open_rows = self.between(first, entries)
        # Large families that one pivot did not hold together meet a few more members, the same in all their buckets.
        hubs = [F.min(F.struct(F.xxhash64(F.lit(k), "grp").alias("order"), "grp", "n")).alias(f"hub{k}") for k in range(HUBS)]
        large = open_rows.groupBy("tok").agg(F.count("*").alias("c"), *hubs).where(F.col("c") > FREQUENT)
        large = large.select("tok", F.explode(F.array_distinct(F.array(*[f"hub{k}" for k in range(HUBS)]))).alias("hub"))
        met = open_rows.join(large, "tok").where(size_fits(F.col("n"), F.col("hub.n"), self.percent))
        met = met.select(F.col("grp").alias("g"), F.col("hub.grp").alias("h")).where("g <> h").distinct()
        to_hub = met.join(heads.withColumnRenamed("grp", "h"), "h").join(self.classes.select(F.col("grp").alias("g"), "cls"), "g")
        to_hub = self.saved(to_hub.select(F.col("cls").alias("a"), F.col("head").alias("b")), ENTRIES)
        if not to_hub.isEmpty():
            placed, renamed = self.merged(placed, self.verified(to_hub))
            now = open_rows.join(renamed, "comp", "left").select("tok", "grp", "n", "place", F.coalesce("new", "comp").alias("comp"))
            open_rows = self.saved(self.several(now.distinct()), ENTRIES)
        # Pairs across components. Classes meet, not groups: each has its sketch, and what sketches rule out is not written.
        met = open_rows.join(placed.select("grp", "comp", "cls"), ["grp", "comp"])
        rows = self.saved(met.select(F.col("tok").alias("bucket"), F.col("cls").alias("item"), "comp", "n", "place"), ENTRIES)
        expanded = self.meetings(rows, self.narrow(rows)).select(F.col("g").alias("a"), F.col("h").alias("b"))
        # Classes of one group that its head did not link meet in it.
        parted = placed.groupBy("grp").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least <> most").select("grp")
        loose = self.saved(placed.join(parted, "grp"))
        if not loose.isEmpty():
            rows = loose.select(F.col("grp").alias("bucket"), F.col("cls").alias("item"), "comp", "n", F.lit(None).cast("int").alias("place"))
            expanded = expanded.union(self.meetings(rows, self.narrow(rows)).select(F.col("g").alias("a"), F.col("h").alias("b")))
        return self.merged(placed, self.verified(expanded))[0]

    def merged(self, placed: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The classes with their components after more links, and comp, new of the components that are part of others now."""
        of = [placed.select(F.col("cls").alias(x), F.col("comp").alias(f"comp_{x}")) for x in "ab"]
        few_links = F.broadcast(links) if links.count() <= BROADCAST_IDS else links
        across = few_links.join(of[0], "a").join(of[1], "b").where("comp_a <> comp_b").select("comp_a", "comp_b").distinct()
        found = components(self.saved(across), "comp_a", "comp_b").where("node <> component")
        renamed = if_small(found.select(F.col("node").alias("comp"), F.col("component").alias("new")), BROADCAST_IDS, self.rows)
        after = placed.join(renamed, "comp", "left").select("cls", "grp", "n", F.coalesce("new", "comp").alias("comp"))
        return self.saved(after), renamed

    def band(self, n: str) -> Column:
        """The size band of a set; sets that link are of one band or of two adjacent ones."""
        return F.floor(F.log(n) / math.log(100 / self.percent))

    def several(self, rows: DataFrame) -> DataFrame:
        """The rows of the buckets in which components meet."""
        found = rows.groupBy("tok").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        return rows.join(found.where("low <> high").select("tok"), "tok")

    def unsettled(self, rows: DataFrame) -> DataFrame:
        """The rows (with ``members``, the classes of a group in the component) of the buckets in which components meet and
        pairs are left to check.

        A bucket of two groups of one class each holds one pair. If their sizes fit, one of them was the other's pivot,
        so the pair is checked: it links, or it is none. Bands are compared too, in case rounding puts two sizes that fit
        two bands apart.
        """
        sides = [F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("n").alias("least"), F.max("n").alias("most")]
        found = rows.groupBy("tok").agg(*sides, F.count("*").alias("c"), F.max("members").alias("members"))
        paired = (F.col("c") == 2) & (F.col("members") == 1)
        checked = (self.band("most") - self.band("least") <= 1) | ~size_fits(F.col("least"), F.col("most"), self.percent)
        left = found.where((F.col("low") != F.col("high")) & ~(paired & checked))
        return rows.drop("members").join(left.select("tok"), "tok")

    def between(self, links: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The component of each class, and the rows of the buckets in which components meet and pairs are left to check.

        A group with classes in several components counts in each of them.
        """
        found = components(links).select(F.col("node").alias("cls"), "component")
        placed = self.saved(self.classes.join(found, "cls", "left").select("cls", "grp", "n", F.coalesce("component", "cls").alias("comp")))
        mixed = entries.join(placed.groupBy("grp", "comp").agg(F.count("*").alias("members")), "grp")
        return placed, self.saved(self.unsettled(mixed), ENTRIES)

    def documents(self) -> DataFrame:
        """doc_id, n_shingles, component_id of every row, and class_size, the number of documents with the same set."""
        found = self.linked().select("cls", F.col("comp").alias("component"))
        sizes = self.base.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"), F.count("*").alias("class_size"))
        named = sizes.join(found, "cls")
        least = named.groupBy("component").agg(F.min("least").alias("component_id"))
        by_class = named.join(least, "component").select("cls", "component_id", "class_size")
        rows = self.base.select("doc_id", F.col("n").alias("n_shingles"), "cls").join(by_class, "cls", "left")
        own = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return rows.select(F.col("doc_id").alias(self.id_col), "n_shingles", own.alias("component_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id, class_size of every document."""
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        return Join(docs, width, percent, id_col).documents()


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """The documents without those that link to one with a smaller id; all columns, whatever their names.

    Documents without words stay. Texts under one id share its fate; rows with no id, or that repeat one, stay once for each text.
    """
    found = near_duplicates(docs, width, percent).select("doc_id", "component_id")
    found = cut_lineage(found)
    dropped = found.where("doc_id <> component_id").select("doc_id").distinct()
    out = docs.join(if_small(dropped, BROADCAST_IDS), "doc_id", "left_anti").select(*docs.columns)
    (repeated,) = free_names(out, "_again")
    again = cut_lineage(found.groupBy("doc_id").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("doc_id").alias(repeated)))
    if again.isEmpty():
        return out
    same = F.col("doc_id").eqNullSafe(F.col(repeated))
    again = if_small(again, BROADCAST_IDS)
    return out.join(again, same, "left_anti").union(out.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
