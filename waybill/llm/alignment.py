"""Alignment of two tokenizers' tokens on the same bytes, by merging all documents of a batch in lockstep.

A (byte-level BPE) encodes space + text, B (sentencepiece, which adds the space itself) encodes text, both without special
tokens: their strings in a text are plain text. Where a token of A and one of B end at the same byte, the pair is linked
and the text is cut; the tokens between two cuts form a group.

* Tokens of whole texts: a text is cut at single spaces between two visible characters. Neither tokenizer joins tokens
  across such a space (the pre-tokenizer of A starts a piece there; B has no piece with a space behind another character,
  which is checked when it is loaded), so units between them are encoded alone, and a task keeps the tokens of the units it has met.
* Lockstep: one vector of positions holds the next token of A and of B for every document. Each step compares their ends,
  emits links and cuts where they agree, advances the side that ends first, or both, and drops finished documents from the
  vector. A document of more than ``STRETCH`` bytes enters as several stretches, because ends alone decide, so the number
  of steps does not follow the longest document.
* Counts of linked id pairs: two tokens that end together are suffix of one another, so there are at most as many pairs as
  the two vocabularies have suffixes in common (``most_pairs``), whatever the corpus. That bounds the table which is sent
  back to the documents. The documents' pairs are saved once between the two passes, in the shared folder.

Null and empty texts, and texts whose joined token bytes of A or B differ from space + text, have no tokens: zeros and ''.
Rows are treated one by one: repeated rows and ids come out as often as they came in, a null id stays null. An empty table
gives an empty table. Columns besides the id and the text are not read, so none can clash.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.tokens import pieces
from waybill.session import scratch_path

#: Bytes of text that are encoded together, and of one stretch of the lockstep merge.
PIECE_BYTES, STRETCH = 1 << 20, 4096
#: Bytes of distinct units whose tokens a task keeps, about 20 times as much memory.
KEPT_BYTES = 1 << 22
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
BETWEEN = f"doc_id %s, {', '.join(f'{c} long' for c in COUNTS)}, groups_sha256 string, pairs array<int>, times array<int>"


@dataclass(frozen=True)
class Vocabulary:
    """Bytes of each token id, and how to encode many units that begin with a space."""

    bytes_of: list[bytes]
    encode: object

    @property
    def size(self) -> int:
        return len(self.bytes_of)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: visible Latin-1 letters stand for themselves, the
    others, in order, for the letters from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=4)
def byte_level(path: str) -> Vocabulary:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    letters = byte_letters()
    special = {token.content for token in tokenizer.get_added_tokens_decoder().values()}
    entries = [b""] * tokenizer.get_vocab_size()
    for token, number in tokenizer.get_vocab().items():
        entries[number] = token.encode() if token in special else bytes(letters[c] for c in token)

    def encode(units: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    return Vocabulary(entries, encode)


@lru_cache(maxsize=4)
def sentence_piece(path: str) -> Vocabulary:
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    entries = []
    for number in range(processor.get_piece_size()):
        piece = processor.id_to_piece(number)
        if re.search("[^▁]▁", piece):
            raise ValueError(f"piece {piece!r} crosses a space: units can't be encoded alone")
        single = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        entries.append(bytes([int(single[1], 16)]) if single else piece.replace("▁", " ").encode())

    def encode(units: list[str]) -> list[list[int]]:
        return processor.encode([u[1:] for u in units], num_threads=1)

    return Vocabulary(entries, encode)


def most_pairs(a: list[bytes], b: list[bytes]) -> int:
    """How many (id of A, id of B) can end together: one's bytes are a suffix of the other's."""
    def counted(entries: list[bytes]) -> dict[bytes, int]:
        out: dict[bytes, int] = {}
        for e in entries:
            out[e] = out.get(e, 0) + 1
        return out

    shorter_or_equal = counted(b)
    total = sum(shorter_or_equal.get(x[k:], 0) for x in a for k in range(len(x)))
    strictly = counted(a)
    return total + sum(strictly.get(x[k:], 0) for x in b for k in range(1, len(x)))


def unit_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places where units begin: the texts' starts, and single spaces between visible ASCII characters or letters of two
    bytes from U+00C0 on. ``data``: texts, each with a space put before it. All ``starts`` are places of such a space."""
    n = len(data)
    inside = np.flatnonzero(data[2 : n - 1] == 32) + 2 if n > 3 else np.zeros(0, np.int64)
    last, lead = data[inside - 1], data[inside - 2]
    after = data[inside + 1]
    plain = lambda byte: (byte > 32) & (byte < 127)
    wide = lambda byte: (byte >= 0xC3) & (byte <= 0xDF)
    good = (plain(last) | ((last >= 128) & wide(lead))) & (plain(after) | wide(after))
    return np.union1d(starts, inside[good])


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of A and B that end together, in order. Ends ascend; lane k merges those in (low, high]."""
    a, a_stop = np.searchsorted(a_ends, low, "right"), np.searchsorted(a_ends, high, "right")
    b, b_stop = np.searchsorted(b_ends, low, "right"), np.searchsorted(b_ends, high, "right")
    partner = np.full(len(a_ends), -1, np.int64)
    live = (a < a_stop) & (b < b_stop)
    while True:
        if not live.all():  # finished lanes leave the vector
            a, b, a_stop, b_stop = a[live], b[live], a_stop[live], b_stop[live]
        if not len(a):
            break
        end_a, end_b = a_ends[a], b_ends[b]
        same = end_a == end_b
        partner[a[same]] = b[same]
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        live = (a < a_stop) & (b < b_stop)
    linked = np.flatnonzero(partner >= 0)
    return linked, partner[linked]


def ragged(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (sizes[0] numbers), first[1], ..."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(first - before, sizes) + np.arange(int(sizes.sum()))


class Encoder:
    """Token ids of many units. Each distinct unit is encoded once and kept, until ``most`` bytes of units are kept."""

    def __init__(self, a: Vocabulary, b: Vocabulary, most: int = KEPT_BYTES) -> None:
        self.sides, self.most = (a, b), most
        self.lengths = [np.array([len(e) for e in v.bytes_of], np.int64) for v in self.sides]
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.held = 0
        self.good = np.zeros(0, bool)
        self.ids = [np.zeros(0, np.int32) for _ in self.sides]
        self.first = [np.zeros(1, np.int64) for _ in self.sides]

    def __call__(self, units: list[bytes]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Whether each unit's tokens give its bytes on both sides, and for A and B the ids and their number per unit."""
        if self.held > self.most:
            self._forget()
        numbers, known = self.numbers, len(self.numbers)
        which = np.fromiter((numbers.setdefault(u, len(numbers)) for u in units), np.int64, len(units))
        if len(numbers) > known:
            self._learn(list(islice(numbers, known, None)))
        out = []
        for ids, first in zip(self.ids, self.first):
            sizes = first[which + 1] - first[which]
            out.append((ids[ragged(first[which], sizes)], sizes))
        return self.good[which], out

    def _learn(self, fresh: list[bytes]) -> None:
        texts, raw = [u.decode() for u in fresh], b"".join(fresh)
        ends = np.cumsum([len(u) for u in fresh])
        self.held += len(raw)
        good = np.ones(len(fresh), bool)
        for side, vocabulary in enumerate(self.sides):
            found = vocabulary.encode(texts)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
            entries = vocabulary.bytes_of
            if b"".join([entries[i] for i in ids.tolist()]) != raw:
                good &= np.fromiter((b"".join([entries[i] for i in mine]) == u for mine, u in zip(found, fresh)), bool, len(fresh))
            else:  # all bytes agree; then units agree where their lengths do
                reached = np.append(0, np.cumsum(self.lengths[side][ids]))[np.cumsum(sizes)]
                good &= reached == ends
            self.ids[side] = np.concatenate([self.ids[side], ids])
            self.first[side] = np.concatenate([self.first[side], self.first[side][-1] + np.cumsum(sizes)])
        self.good = np.concatenate([self.good, good])


def decimal_table(size: int) -> np.ndarray:
    """Decimal text of each id, followed by the sign of its place: , | ; or nothing (rows 0 to 3)."""
    plain = [str(k) for k in range(size)]
    return np.array([[p + sign for p in plain] for sign in (",", "|", ";", "")], dtype=object)


def aligned(texts: list[tuple[np.ndarray, np.ndarray]], encoder: Encoder, decimals: np.ndarray) -> dict[str, np.ndarray]:
    """The columns between the passes, for bytes and offsets of one piece of texts."""
    data, offsets = texts
    rows = len(offsets) - 1
    sizes = np.diff(offsets)
    # A space before each text.
    starts = offsets[:-1] + np.arange(rows)
    spaced = np.full(len(data) + rows, 32, np.uint8)
    keep = np.ones(len(spaced), bool)
    keep[starts] = False
    spaced[keep] = data
    filled = sizes > 0
    units_at = unit_starts(spaced, starts)
    raw = spaced.tobytes()
    bounds = np.append(units_at, len(spaced)).tolist()
    good, sides = encoder([raw[x:y] for x, y in zip(bounds, bounds[1:])])
    unit_row = np.searchsorted(starts, units_at, "right") - 1
    fine = filled.copy()
    fine[unit_row[~good]] = False

    used = fine[unit_row]  # units of texts that have tokens
    ids, rows_of, ends = [], [], []
    text_end = np.cumsum(np.where(fine, sizes + 1, 0))
    for (flat, per_unit), lengths in zip(sides, encoder.lengths):
        kept = flat[np.repeat(used, per_unit)]
        ids.append(kept)
        rows_of.append(np.repeat(unit_row[used], per_unit[used]))
        ends.append(np.cumsum(lengths[kept]))
    text_start = text_end - np.where(fine, sizes + 1, 0)
    per_text = np.where(fine, -(-(sizes + 1) // STRETCH), 0)
    low = np.repeat(text_start, per_text) + STRETCH * ragged(np.zeros(rows, np.int64), per_text)
    high = np.minimum(low + STRETCH, np.repeat(text_end, per_text))
    link_a, link_b = lockstep(*ends, low, high)

    counts = [np.bincount(r, minlength=rows) for r in rows_of]
    link_row = rows_of[0][link_a]
    n_links = np.bincount(link_row, minlength=rows)
    digests = _digests(ids, link_a, link_b, rows_of, n_links, decimals)

    pair = ids[0][link_a].astype(np.int64) * encoder.sides[1].size + ids[1][link_b]
    unique, times = np.unique((link_row.astype(np.int64) << 32) | pair, return_counts=True)
    return {
        "n_a": counts[0], "n_b": counts[1], "n_groups": n_links, "n_links": n_links, "groups_sha256": digests,
        "pairs": (unique & 0xFFFFFFFF).astype(np.int32), "times": times.astype(np.int32), "pair_rows": np.bincount(unique >> 32, minlength=rows),
    }


def _digests(ids, link_a, link_b, rows_of, n_links, decimals) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` for each text, '' for texts without tokens."""
    cut = [np.zeros(len(i), bool) for i in ids]
    cut[0][link_a], cut[1][link_b] = True, True
    # Tokens of one group stand together, those of A first: a token's place is its own number and that of the others before it.
    group = [np.cumsum(c) - c for c in cut]
    ends_a, ends_b = np.append(0, link_a + 1), np.append(0, link_b + 1)
    place_a = np.arange(len(ids[0])) + ends_b[group[0]]
    place_b = np.arange(len(ids[1])) + ends_a[group[1] + 1]
    sign_b = np.where(cut[1], 2, 0)
    last = np.flatnonzero(np.diff(rows_of[1], append=-1) != 0)  # the last token of B of each text
    sign_b[last] = 3
    words = np.empty(len(ids[0]) + len(ids[1]), object)
    words[place_a] = decimals[cut[0].astype(np.int64), ids[0]]
    words[place_b] = decimals[sign_b, ids[1]]
    sizes = np.bincount(rows_of[0], minlength=len(n_links)) + np.bincount(rows_of[1], minlength=len(n_links))
    flat, out, at = words.tolist(), [], 0
    for size in sizes.tolist():
        out.append(hashlib.sha256("".join(flat[at : at + size]).encode()).hexdigest() if size else "")
        at += size
    return out


def token_counts(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """First pass: per row doc_id, the counts, groups_sha256, and its linked pairs (id of A * size of B + id of B) with
    how often each occurs."""
    names = ["doc_id", *COUNTS, "groups_sha256", "pairs", "times"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(byte_level(a_path), sentence_piece(b_path))
        decimals = decimal_table(max(v.size for v in encoder.sides))
        for batch in batches:
            for low, high, data, offsets in pieces(batch.column("text"), most=PIECE_BYTES):
                found = aligned((data, offsets), encoder, decimals)
                bounds = pa.array(np.append(0, np.cumsum(found["pair_rows"])).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low), *[pa.array(found[c].astype(np.int64)) for c in COUNTS],
                        pa.array(found["groups_sha256"], pa.string()),
                        *[pa.ListArray.from_arrays(bounds, pa.array(found[c])) for c in ("pairs", "times")],
                    ],
                    names=names,
                )

    thin = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return thin.mapInArrow(encode, BETWEEN % dict(thin.dtypes)["doc_id"])


def pair_table(rows: DataFrame, b_size: int) -> DataFrame:
    """pair, n, best: how many links of all rows hold the pair, and whether no pair of its id of B has more."""
    linked = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum(F.col("x.times").cast("long")).alias("n"))
    top = linked.groupBy((F.col("pair") % b_size).alias("b")).agg(F.max("n").alias("top"))
    return linked.join(top, F.col("pair") % b_size == F.col("b")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def alignment_report(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    saved = scratch_path(spark, "alignment")
    token_counts(docs, a_path, b_path, id_col, text_col).write.option("compression", "zstd").parquet(saved)
    rows = spark.read.parquet(saved)
    # Bounded by the vocabularies (``most_pairs``), not by the corpus.
    table = pair_table(rows, sentence_piece(b_path).size).toArrow()
    order = np.argsort(table.column("pair").to_numpy())
    shared = spark.sparkContext.broadcast([table.column(c).to_numpy()[order] for c in ("pair", "n", "best")])
    kind = dict(rows.dtypes)["doc_id"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy(zero_copy_only=False))
            at = np.searchsorted(pair, lists.flatten().to_numpy(zero_copy_only=False))
            sums = []
            for weight in (best[at], n[at]):
                out = np.zeros(len(batch), np.int64)
                np.add.at(out, row, times * weight.astype(np.int64))
                sums.append(pa.array(out))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[batch.column(c) for c in COUNTS], *sums, batch.column("groups_sha256")], names=names)

    names = ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"]
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names[1:-1]) + ", groups_sha256 string"
    return rows.mapInArrow(weigh, schema).withColumnRenamed("doc_id", id_col)
