"""Quality by compression: zstandard dictionaries of good and of bad labelled text.

A text is cut into blocks; each block is compressed with either dictionary. Blocks like the good text get smaller with the
good dictionary. The difference of the compressed sizes over the raw size, of all blocks of the whole text, goes through
a logistic curve that is fitted to labelled documents outside the dictionaries' halves.

The curve has the shortness of the text, 1 / (1 + bytes / 100), as a second input: short texts are weaker evidence.
Learning takes at most ``windows`` windows and ``calibration`` documents of each class, in hash order of the ids. A null
text counts as empty; empty texts have difference 0 and shortness 1. Nothing but the text is scored.
Without labels of both classes the curve is fixed and the score of every text is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.samples import labelled, logistic, sigmoid

WINDOW_CHARS, BLOCK_BYTES, LEVEL = 2048, 2048, 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    #: Of the curve: for the difference and for the shortness.
    weights: tuple[float, float]
    intercept: float


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    plain = dict(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    if not content:
        return zstandard.ZstdCompressor(**plain)
    trained = zstandard.ZstdCompressionDict(content)
    trained.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=trained, **plain)


def differences(column: pa.Array, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> np.ndarray:
    """(bad size - good size) / raw size of each text; 0 for empty ones."""
    out = np.zeros(len(column))
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    for row, value in enumerate(column):
        raw = value.as_buffer()
        view = memoryview(raw)
        total = 0
        for low in range(0, len(view), BLOCK_BYTES):
            block = view[low : low + BLOCK_BYTES]
            total += len(bad.compress(block)) - len(good.compress(block))
        out[row] = total / len(view) if len(view) else 0.0
    return out


def curve(difference: np.ndarray, n_bytes: np.ndarray, model: Model) -> np.ndarray:
    return sigmoid(model.weights[0] * difference + model.weights[1] * shortness(n_bytes) + model.intercept)


def shortness(n_bytes: np.ndarray) -> np.ndarray:
    return 1 / (1 + n_bytes / 100)


def dictionary(windows: list[str], size: int) -> bytes:
    """A trained dictionary; too few samples to train from are taken as the content themselves."""
    raw = [w.encode() for w in windows if w]
    try:
        return zstandard.train_dictionary(size, raw).as_bytes()
    except zstandard.ZstdError:
        return b"".join(raw)[-size:]


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, windows: int = 1500, calibration: int = 1500, size: int = 112_640) -> Model:
    """Windows of one half of the sampled documents make the dictionaries, the other half the curve."""
    picked = labelled(labels, "quality", allowed, {0: 2 * calibration, 1: 2 * calibration})
    # At most four times ``calibration`` rows.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)))
    places = F.sequence(F.lit(0), F.greatest(F.ceil(F.length("text") / WINDOW_CHARS).cast("int") - 1, F.lit(0)))
    cut = rows.where("half = 0 and text is not null").select("doc_id", "label", "text", F.explode(places).alias("at"))
    cut = cut.select("label", F.substring("text", F.col("at") * WINDOW_CHARS + 1, F.lit(WINDOW_CHARS)).alias("window"), F.xxhash64("doc_id", "at").alias("order"))
    content = {}
    for label in (0, 1):
        found = cut.where(F.col("label") == label).orderBy("order").limit(windows).select("window").collect()
        content[label] = dictionary([r.window for r in found], size)
    if not content[0] or not content[1]:
        return Model(content[1], content[0], (0.0, 0.0), 0.0)
    draft = Model(content[1], content[0], (1.0, 0.0), 0.0)
    points = scored(rows.where("half = 1").select("doc_id", "text", "label"), draft, "label int").select("difference", "n_bytes", "label").collect()
    difference, n_bytes, y = (np.array([p[k] for p in points], float) for k in range(3))
    weights, intercept = logistic(np.stack([difference, shortness(n_bytes)], 1), y)
    return Model(draft.good, draft.bad, (float(weights[0]), float(weights[1])), intercept)


def scored(docs: DataFrame, model: Model, more: str = "") -> DataFrame:
    """doc_id, difference, n_bytes, score of each row, and the columns named in ``more`` (as schema text)."""
    extra = [part.split()[0] for part in more.split(",") if part.strip()]
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        good, bad = _compressor(m.good), _compressor(m.bad)
        for batch in batches:
            difference = differences(batch.column("text"), good, bad)
            n_bytes = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            value = curve(difference, n_bytes.to_numpy(zero_copy_only=False), m)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(difference), n_bytes, pa.array(value), *[batch.column(c) for c in extra]],
                names=["doc_id", "difference", "n_bytes", "score", *extra],
            )

    schema = f"doc_id {kind}, difference double, n_bytes long, score double" + (f", {more}" if more else "")
    return docs.select("doc_id", "text", *extra).mapInArrow(score, schema)
