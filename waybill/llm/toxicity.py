"""Toxicity by a weighted finite-state pattern grammar.

Word transducers write a tag for each word: insult, threat, target, negation, reported speech, other. The insult acceptor
is a weighted prefix trie learned from labelled documents: a node is a word or a word beginning that is far more frequent
in toxic documents than elsewhere, weighted by its log ratio. Clause transducers for negation, reported speech, target
and matched words are composed into one weighted transducer, and the best path over the tags of a clause is the clause's
score: a negated or reported insult counts less, an aimed one more, and threats count with a target only.

A document's evidence is the sum over its clauses less what its length alone would bring, which is the log ratio of two
Poisson processes; a logistic curve fitted to labelled documents makes it a score. Whole texts are read.

Learning takes at most ``toxic`` and ``clean`` labelled documents in hash order, one for each family of near copies. Null
text counts as empty; an empty text has no evidence. Without toxic labels nothing is learned and threats alone count.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.samples import labelled, logistic, sigmoid
from waybill.llm.tokens import NO_LETTER, borders, pack_text, packed, pieces, splitmix, word_hashes

# Closed word classes of the grammar, by tag, in English, German, French and Spanish.
WORDS = {
    "Y": "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer sie ihnen tu toi te vous votre vos ton ta tes usted ustedes vosotros tú ti vuestro",
    "N": "not no never neither nor without isn aren wasn nicht nie kein keine keinen niemals ohne ne pas jamais sans aucun aucune ni nunca jamás sin",
    "R": "said says saying told wrote writes called quoted reported claimed sagte sagt schrieb nannte behauptete zitierte dit disait écrit appelé cité dijo dice escribió llamó citó",
    "T": "kill murder hurt destroy shoot stab umbringen töten erschießen verprügeln tuer frapper détruire massacrer matar golpear destruir disparar",
}
#: Words after a negation that it reaches; words between a target and an insult or threat.
NEGATION_REACH, TARGET_REACH = 3, 6
#: Additions to a matched word's weight.
NEGATED, REPORTED, AIMED = -3.0, -1.5, 0.5
THREAT_WEIGHT = 3.0
#: A clause without punctuation is cut at so many words on either side of a match.
CLAUSE_REACH = 24
LENGTHS = range(3, 9)
CLAUSE_ENDS = np.zeros(256, np.uint32)
CLAUSE_ENDS[[ord(c) for c in ".!?;\n"]] = 1


class Transducer:
    """Weighted arcs over tags. ``arcs[state][tag]`` is a list of (next state, weight, tag written); state 0 starts.

    A path ends in any state but the ``unfinished`` ones.
    """

    def __init__(self) -> None:
        self.arcs: dict = defaultdict(lambda: defaultdict(list))
        self.unfinished: set = set()

    def arc(self, state, tags: Iterable[str], to, weight: float = 0.0, out: str | None = None) -> Transducer:
        for tag in tags:
            self.arcs[state][tag].append((to, weight, out or tag))
        return self

    def then(self, other: Transducer) -> Transducer:
        """The composition: what this one writes is read by the other."""
        out, todo, seen = Transducer(), [(0, 0)], {(0, 0)}
        name = lambda pair: 0 if pair == (0, 0) else pair
        while todo:
            a, b = todo.pop()
            if a in self.unfinished or b in other.unfinished:
                out.unfinished.add(name((a, b)))
            for tag, steps in list(self.arcs[a].items()):
                for to_a, weight_a, written in steps:
                    for to_b, weight_b, last in other.arcs[b].get(written, ()):
                        pair = (to_a, to_b)
                        out.arcs[name((a, b))][tag].append((name(pair), weight_a + weight_b, last))
                        if pair not in seen:
                            seen.add(pair)
                            todo.append(pair)
        return out

    def best(self, tags: str, weights: Iterable[float]) -> float:
        """Weight of the best path over the tags; written "i" and "t" add the word's own weight, never below 0."""
        front = {0: 0.0}
        for tag, own in zip(tags, weights):
            after: dict = {}
            for state, total in front.items():
                for to, weight, out in self.arcs[state].get(tag, ()):
                    value = total + (max(0.0, own + weight) if out in "it" else weight)
                    if value > after.get(to, -1e18):
                        after[to] = value
            front = after
        return max((total for state, total in front.items() if state not in self.unfinished), default=0.0)


def negation() -> Transducer:
    """Insults and threats behind a negation become J and U for a few words."""
    t = Transducer().arc(0, "IYRTO", 0).arc(0, "N", NEGATION_REACH)
    for left in range(1, NEGATION_REACH + 1):
        t.arc(left, "N", NEGATION_REACH).arc(left, "YRO", left - 1).arc(left, "I", left - 1, NEGATED, "J").arc(left, "T", left - 1, NEGATED, "U")
    return t


def reported() -> Transducer:
    """Behind a verb of speech, insults and threats of the clause are reported ones."""
    return (
        Transducer().arc(0, "IJYTUNO", 0).arc(0, "R", 1)
        .arc(1, "YNOR", 1).arc(1, "IJ", 1, REPORTED, "J").arc(1, "TU", 1, REPORTED, "U")
    )


def target() -> Transducer:
    """A target before makes an insult an aimed one (A, or B if weakened). A threat needs a target on either side."""
    t = Transducer().arc(0, "IJNRO", 0).arc(0, "Y", TARGET_REACH, 0.0, "O").arc(0, "TU", 0, 0.0, "O")
    for left in range(1, TARGET_REACH + 1):
        t.arc(left, "NRO", left - 1).arc(left, "Y", TARGET_REACH, 0.0, "O")
        t.arc(left, "I", left - 1, AIMED, "A").arc(left, "J", left - 1, AIMED, "B").arc(left, "T", left - 1, 0.0, "D").arc(left, "U", left - 1, 0.0, "D")
    # The guess that a target follows a threat ends well only if it does.
    t.arc(0, "TU", ("wait", TARGET_REACH), 0.0, "D")
    for left in range(1, TARGET_REACH + 1):
        t.unfinished |= {("wait", left), ("wait", left - 1)}
        t.arc(("wait", left), "NROIJTU", ("wait", left - 1), 0.0, "O").arc(("wait", left), "Y", TARGET_REACH, 0.0, "O")
    return t


def matched() -> Transducer:
    """Insults in any state are written i, threats t: the words whose own weights count."""
    return Transducer().arc(0, "NRO", 0).arc(0, "IJAB", 0, 0.0, "i").arc(0, "D", 0, 0.0, "t")


@lru_cache(maxsize=1)
def grammar() -> Transducer:
    return negation().then(reported()).then(target()).then(matched())


@lru_cache(maxsize=1)
def closed_words() -> dict[str, np.ndarray]:
    return {tag: np.unique(np.array([pack_text(w) for w in words.split()], np.uint64)) for tag, words in WORDS.items()}


@dataclass(frozen=True)
class Model:
    #: For each prefix length in bytes: sorted prefixes and their weights.
    lengths: dict[int, tuple[np.ndarray, np.ndarray]]
    #: Expected evidence of one word of any text, to be taken off.
    per_word: float
    slope: float
    intercept: float


def head(words: np.ndarray, length: int) -> np.ndarray:
    return words & np.uint64((0xFFFFFFFFFFFFFFFF << (8 * (8 - length))) & 0xFFFFFFFFFFFFFFFF)


def member(words: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The place of each word in the sorted ``known``, or -1."""
    if not len(known) or not len(words):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    return np.where(known[at] == words, at, -1)


def tagged(words: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Tag (as a byte) and own weight of each word."""
    tags, own = np.full(len(words), ord("O"), np.uint8), np.zeros(len(words))
    for tag, known in closed_words().items():
        at = member(words, known) >= 0
        tags[at] = ord(tag)
        own[at] = THREAT_WEIGHT * (tag == "T")
    for length, (known, weights) in model.lengths.items():
        at = member(head(words, length), known)
        hit = at >= 0
        tags[hit] = ord("I")
        own[hit] = np.maximum(own[hit], weights[at[hit]])
    return tags, own


def evidence(data: np.ndarray, offsets: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Evidence and number of matched clauses of each text. Only clauses with an insult or a threat are walked."""
    starts, ends = borders(data, offsets, NO_LETTER)
    bounds = np.searchsorted(starts, offsets)
    tags, own = tagged(packed(data, starts, ends), model)
    total = -model.per_word * np.diff(bounds).astype(float)
    clauses = np.zeros(len(total), np.int64)
    hits = np.flatnonzero((tags == ord("I")) | (tags == ord("T")))
    if not len(hits):
        return total, clauses
    ended = np.cumsum(CLAUSE_ENDS[data], dtype=np.int64)[starts]
    text = tags.tobytes().decode("ascii")
    owner = np.searchsorted(bounds, hits, side="right") - 1
    k = 0
    while k < len(hits):
        first, row = int(hits[k]), int(owner[k])
        last = first
        while k + 1 < len(hits) and owner[k + 1] == row and ended[hits[k + 1]] == ended[first] and hits[k + 1] - last <= CLAUSE_REACH:
            k += 1
            last = int(hits[k])
        low, high = max(int(bounds[row]), first - CLAUSE_REACH), min(int(bounds[row + 1]), last + CLAUSE_REACH + 1)
        while ended[low] != ended[first]:
            low += 1
        while ended[high - 1] != ended[first]:
            high -= 1
        value = grammar().best(text[low:high], own[low:high].tolist())
        total[row] += value
        clauses[row] += value > 0
        k += 1
    return total, clauses


def curve(values: np.ndarray, model: Model) -> np.ndarray:
    return sigmoid(model.slope * damped(values) + model.intercept)


def damped(values: np.ndarray) -> np.ndarray:
    return np.sign(values) * np.log1p(np.abs(values))


def measured(docs: DataFrame, model: Model, more: str = "") -> DataFrame:
    """doc_id, evidence, clauses, score, and the columns named in ``more``."""
    extra = [part.split()[0] for part in more.split(",") if part.strip()]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by ``nodes``

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            values, counts = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for low, high, data, offsets in pieces(batch.column("text"), lower=True):
                values[low:high], counts[low:high] = evidence(data, offsets, m)
            score = curve(values, m)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values), pa.array(counts), pa.array(score), *[batch.column(c) for c in extra]],
                names=["doc_id", "evidence", "clauses", "score", *extra],
            )

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, evidence double, clauses long, score double" + (f", {more}" if more else "")
    return docs.select("doc_id", "text", *extra).mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents scored below the threshold, with all their columns, in one pass over the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            values = np.zeros(batch.num_rows)
            for low, high, data, offsets in pieces(batch.column("text"), lower=True):
                values[low:high] = evidence(data, offsets, m)[0]
            yield batch.filter(pa.array(curve(values, m) < threshold))

    return docs.mapInArrow(run, docs.schema)


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least hash of two neighbouring words of each text: near copies mostly share it."""
    for batch in batches:
        least = np.zeros(batch.num_rows, np.int64)
        for low, _, data, offsets in pieces(batch.column("text"), lower=True):
            hashes, bounds = word_hashes(data, offsets, NO_LETTER)
            pairs = splitmix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])
            for k in range(len(bounds) - 1):
                own = pairs[bounds[k] : max(bounds[k], bounds[k + 1] - 1)]
                if len(own):
                    least[low + k] = own.min().astype(np.int64)
                elif bounds[k + 1] > bounds[k]:
                    least[low + k] = hashes[bounds[k]].astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(least)], names=["doc_id", "label", "family"])


def _beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """length, key, label, documents, words: how often each word beginning occurs in the texts of a batch."""
    for batch in batches:
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        gathered: dict = defaultdict(list)
        total = {0: 0, 1: 0}
        for row0, _, data, offsets in pieces(batch.column("text"), lower=True):
            starts, ends = borders(data, offsets, NO_LETTER)
            bounds, words = np.searchsorted(starts, offsets), packed(data, starts, ends)
            for k in range(len(bounds) - 1):
                label = int(labels[row0 + k])
                own, times = np.unique(words[bounds[k] : bounds[k + 1]], return_counts=True)
                total[label] += int(times.sum())
                for length in LENGTHS:
                    keys, first = np.unique(head(own, length), return_index=True)
                    if len(keys):
                        gathered[length, label].append((keys, np.add.reduceat(times, first)))
        out: list = [[], [], [], [], []]
        for (length, label), parts in gathered.items():
            keys, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            out[0].append(np.full(len(keys), length)), out[1].append(keys.astype(np.int64)), out[2].append(np.full(len(keys), label))
            out[3].append(np.bincount(back)), out[4].append(np.bincount(back, weights=np.concatenate([p[1] for p in parts])).astype(np.int64))
        for label, words_seen in total.items():  # length 0: all words
            for column, value in zip(out, (0, 0, label, int((labels == label).sum()), words_seen)):
                column.append(np.array([value]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], names=["length", "key", "label", "documents", "words"])


def choose(rows: Iterable, nodes: int, least_documents: int = 4, least_evidence: float = 25.0) -> tuple[dict, float]:
    """Trie nodes by their counts, and the expected evidence of a word.

    A node is taken if the G statistic of its documents is high; of nodes on one path the shortest that is pure enough,
    and from there as deep as all its occurrences go, so that a learned word doesn't stand for its first letters.
    """
    rows = [(r.length, r.key & 0xFFFFFFFFFFFFFFFF, r.toxic, r.clean, r.toxic_words, r.clean_words) for r in rows]
    every = next((r for r in rows if r[0] == 0), None)
    if not every or not every[2]:
        return {}, 0.0
    docs1, docs0, words1, words0 = every[2], max(every[3], 1), max(every[4], 1), max(every[5], 1)
    by_length = {n: {r[1]: r for r in rows if r[0] == n} for n in LENGTHS}
    share = docs1 / (docs1 + docs0)

    def strength(r) -> float:
        n1, n0 = r[2], r[3]
        n = n1 + n0
        return 2 * sum(x * np.log(x / (n * p)) for x, p in ((n1, share), (n0, 1 - share)) if x)

    taken: dict[int, dict[int, float]] = {n: {} for n in LENGTHS}
    good = []
    for length in LENGTHS:
        for key, r in by_length[length].items():
            if r[2] >= least_documents and r[2] / docs1 > 12 * r[3] / docs0 and strength(r) >= least_evidence:
                good.append((length, key, r))
    cut = lambda key, length: key >> (8 * (8 - length)) << (8 * (8 - length))
    accepted = set()
    per_word = 0.0
    for length, key, r in sorted(good, key=lambda g: (g[0], -strength(g[2]))):
        if any((n, cut(key, n)) in accepted for n in range(LENGTHS.start, length)):
            continue
        accepted.add((length, key))
        while length < 8:
            deeper = next((c for c in by_length[length + 1].values() if c[4] == r[4] and c[5] == r[5] and cut(c[1], length) == key), None)
            if deeper is None:
                break
            length, key, r = length + 1, deeper[1], deeper
        rate1, rate0 = (r[4] + 0.5) / words1, (r[5] + 0.5) / words0
        weight = float(np.log(rate1 / rate0))
        if weight > 0 and sum(map(len, taken.values())) < nodes:
            taken[length][key] = weight
            per_word += rate1 - rate0
    table = {}
    for length, found in taken.items():
        if found:
            keys = np.array(sorted(found), np.uint64)
            table[length] = (keys, np.array([found[int(k)] for k in keys]))
    return table, per_word


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, toxic: int = 4000, clean: int = 12_000, nodes: int = 5000) -> Model:
    """Learn from at most ``toxic`` + ``clean`` documents; ``nodes`` bounds the trie."""
    picked = labelled(labels, "toxic", allowed, {0: clean, 1: toxic})
    # A broadcast of a bounded sample of ids.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    seen = rows.select("doc_id", "text", "label").mapInArrow(_families, f"doc_id {dict(docs.dtypes)['doc_id']}, label int, family long")
    one = seen.groupBy("family").agg(F.min_by("label", "doc_id").alias("label"), F.min("doc_id").alias("doc_id")).select("doc_id", "label")
    one = docs.sparkSession.createDataFrame(one.collect(), one.schema)  # bounded by the sample
    rows = docs.select("doc_id", "text").join(F.broadcast(one), "doc_id")
    counts = rows.select("text", "label").mapInArrow(_beginnings, "length long, key long, label long, documents long, words long")

    def of(column: str, label: int) -> Column:
        return F.sum(F.when(F.col("label") == label, F.col(column)).otherwise(0))

    sums = counts.groupBy("length", "key").agg(
        of("documents", 1).alias("toxic"), of("documents", 0).alias("clean"), of("words", 1).alias("toxic_words"), of("words", 0).alias("clean_words")
    )
    # Children of a chosen node have at least its counts; what is rarer than 4 toxic documents is never chosen.
    table, per_word = choose(sums.where("length = 0 or toxic >= 4").collect(), nodes)
    draft = Model(table, per_word, 1.0, 0.0)
    points = measured(rows.select("doc_id", "text", "label"), draft, "label int").select("evidence", "label").collect()
    x, y = np.array([p.evidence for p in points]), np.array([p.label for p in points], float)
    if not len(points) or not table:
        return Model(table, per_word, 1.0, -2.0)
    weights, intercept = logistic(damped(x), y)
    return Model(table, per_word, float(weights[0]), intercept)
