"""Language by hierarchical discrimination: a family first, then one-versus-one linear support vector machines inside it.

Features are the square roots of hashed counts of byte pairs and triples inside words of the whole lower-cased text,
scaled to length 1. Learning takes at most ``per_language`` documents of each language value, in hash order of the ids.

A text that is null or has no letter gets ``und`` with score 0. A language of one document still is a class. Without any
learned language all texts get ``und``. Rows with null ids are predicted like others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.samples import sigmoid
from waybill.llm.sizes import if_small
from waybill.llm.tokens import NO_LETTER, pieces
from waybill.session import cut_lineage

DIMENSIONS = 2048
#: Rows of the table of languages that may be broadcast.
BROADCAST_LANGUAGES = 100_000

# Families of common language codes; a code that is not here is a family of its own.
FAMILIES = {
    "Germanic": "en de nl sv da no nb nn is af fy lb",
    "Romance": "fr es it pt ro ca gl oc",
    "Slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "Uralic": "fi et hu",
    "Turkic": "tr az kk uz ky tk",
    "Indic": "hi bn mr gu pa ne ur",
    "Sinitic": "zh yue wuu",
}


def family(code: str) -> str:
    base = code.lower().replace("_", "-").split("-")[0]
    return next((name for name, codes in FAMILIES.items() if base in codes.split()), code)


@dataclass(frozen=True)
class Machine:
    """A separating plane: positive on the side of ``upper``."""

    upper: str
    lower: str
    weights: np.ndarray
    bias: float


@dataclass(frozen=True)
class Model:
    families: list[Machine]
    inside: dict[str, list[Machine]]
    members: dict[str, list[str]]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row for each text."""
    rows = len(offsets) - 1
    text = data.copy()
    text[NO_LETTER[text]] = 32
    b = text.astype(np.uint32)
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    out = np.zeros((rows, DIMENSIONS), np.float32)
    for width in (2, 3):
        n = len(b) - width + 1
        if n <= 0:
            continue
        code, blank = b[:n].copy(), (b[:n] == 32).astype(np.uint8)
        for k in range(1, width):
            code = code * np.uint32(256) + b[k : n + k]
            blank += b[k : n + k] == 32
        use = (owner[:n] == owner[width - 1 :]) & (blank < width - 1)
        code = (code * np.uint32(2654435761)) >> np.uint32(21)
        out += np.bincount(owner[:n][use] * DIMENSIONS + code[use], minlength=rows * DIMENSIONS).reshape(rows, DIMENSIONS)
    out = np.sqrt(out)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def separate(x: np.ndarray, y: np.ndarray, penalty: float = 50.0, rounds: int = 200) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss; accelerated gradient steps. y is -1 or 1."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    step = 1 / (1 + 2 * penalty * 2)
    w = ahead = np.zeros(x.shape[1])
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        gradient = ahead - 2 * penalty * (x.T @ (weight * y * slack))
        new = ahead - step * gradient
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return w[:-1].astype(np.float32), float(w[-1])


def machines(x: np.ndarray, names: np.ndarray) -> list[Machine]:
    out = []
    for upper, lower in combinations(sorted(set(names)), 2):
        use = (names == upper) | (names == lower)
        out.append(Machine(upper, lower, *separate(x[use], np.where(names[use] == upper, 1.0, -1.0))))
    return out


def fit(docs: DataFrame, allowed: Column, per_language: int = 600, total: int = 12_000) -> Model:
    """At most ``per_language`` documents of each language, and ``total`` altogether (at least one of each)."""
    known = docs.where(allowed & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).withColumnRenamed("lang", "_lang")
    sizes = cut_lineage(sizes)
    most = max(1, min(per_language, total // max(sizes.count(), 1)))
    # In hash order, the first of a language lie below a bound that its size tells; so ranks are given to few rows,
    # however many there are. Ids only; texts follow by a broadcast of the bounded sample.
    place = (F.xxhash64("doc_id").cast("double") + 2.0**63) / 2.0**64
    near = known.select("doc_id", "lang", place.alias("place")).join(if_small(sizes, BROADCAST_LANGUAGES), F.col("lang") == F.col("_lang"))
    near = near.where(F.col("place") < F.greatest(F.lit(100.0), F.lit(3.0 * most)) / F.col("n"))
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    picked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select("doc_id", "lang")
    rows = docs.select("doc_id", "text").join(F.broadcast(picked.dropDuplicates(["doc_id"])), "doc_id")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(data, offsets).astype(np.float16) for _, _, data, offsets in pieces(batch.column("text"), lower=True)]
            blobs = [row.tobytes() for part in found for row in part]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(blobs, pa.binary())], names=["lang", "vector"])

    found = rows.select("lang", "text").mapInArrow(vectors, "lang string, vector binary").collect()
    if not found:
        return Model([], {}, {})
    names = np.array([r.lang for r in found], dtype=object)
    x = np.stack([np.frombuffer(r.vector, np.float16) for r in found]).astype(np.float32)
    groups = np.array([family(n) for n in names], dtype=object)
    members = {g: sorted(set(names[groups == g])) for g in sorted(set(groups))}
    inside = {g: machines(x[groups == g], names[groups == g]) for g in members}
    return Model(machines(x, groups), inside, members)


def vote(x: np.ndarray, found: list[Machine], names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The name with most pairs won (the sum of margins decides ties), and its weakest pair's logistic value."""
    if len(names) == 1:
        return np.zeros(len(x), int), np.ones(len(x))
    at = {n: k for k, n in enumerate(names)}
    points = np.zeros((len(x), len(names)))
    weakest = np.ones((len(x), len(names)))
    for m in found:
        margin = x @ m.weights + m.bias
        up, low = at[m.upper], at[m.lower]
        p = sigmoid(3 * margin)
        points[:, up] += (margin > 0) + 0.01 * np.tanh(margin)
        points[:, low] += (margin <= 0) - 0.01 * np.tanh(margin)
        weakest[:, up] = np.minimum(weakest[:, up], p)
        weakest[:, low] = np.minimum(weakest[:, low], 1 - p)
    best = points.argmax(1)
    return best, weakest[np.arange(len(x)), best]


def predict(x: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    names = list(model.members)
    group, score = vote(x, model.families, names)
    out = np.empty(len(x), dtype=object)
    for k, name in enumerate(names):
        rows = np.flatnonzero(group == k)
        if len(rows):
            best, inner = vote(x[rows], model.inside[name], model.members[name])
            out[rows] = [model.members[name][b] for b in best]
            score[rows] *= inner
    return out, score


def detected(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # planes: languages times a fixed number of dimensions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            column = batch.column("text")
            letter = pc.fill_null(pc.match_substring_regex(column, r"\pL"), False).to_numpy(zero_copy_only=False)
            names, scores = np.full(len(column), "und", dtype=object), np.zeros(len(column))
            for low, high, data, offsets in pieces(column, lower=True) if m.members else ():
                names[low:high], scores[low:high] = predict(features(data, offsets), m)
            names[~letter], scores[~letter] = "und", 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")
