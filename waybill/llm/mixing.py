"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate: its target share of the epoch over what it has. A document's count is the
inverse of a Poisson distribution with that mean at a number that the seed and the document decide, so the expected share of each source
is its target and the mix can be repeated. Documents are exploded by their counts and shuffled over all partitions.

A rate above ``PART`` is split into equal parts whose counts add up, which is again Poisson with the whole rate; so any
rate is inverted exactly, with short loops. The inverse runs to ``STEPS`` counts, where the tail of a part is below
the resolution of the 52-bit number.

A source without a weight gets ``default_weight``; null is a source like others. A null text has size 1. Rows with equal
id and text get equal counts. An empty table gives an empty table.
Columns named repeats, copy or shuffle_key are replaced; all others stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.columns import free_names, md5_number, unit
from waybill.llm.sizes import if_small

PART, STEPS = 4.0, 48
#: Rows of the rate table that may be broadcast.
BROADCAST_SOURCES = 100_000


def source_rates(docs: DataFrame, weights: Mapping[str, float], epochs: float = 1.0, default_weight: float = 1.0, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """source, rate: target bytes of the source over its bytes. The epoch has ``epochs`` times the bytes of the input."""
    size = (F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + 1).cast("double")
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size).alias("bytes"))
    weight = F.lit(float(default_weight))
    for name, value in weights.items():
        weight = F.when(F.col("source") == name, F.lit(float(value))).otherwise(weight)
    sizes = sizes.withColumn("weight", weight)
    total = sizes.agg(F.sum("bytes").alias("all_bytes"), F.sum("weight").alias("all_weight"))
    # total is one row, the result of a global aggregate.
    rate = F.when(F.col("all_weight") > 0, F.lit(float(epochs)) * F.col("all_bytes") * F.col("weight") / F.col("all_weight") / F.col("bytes"))
    return sizes.join(F.broadcast(total), F.lit(True)).select("source", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def poisson_count(rate: Column, key: Column) -> Column:
    """The inverse Poisson distribution with mean ``rate`` at the number that ``key`` decides."""
    parts = F.greatest(F.ceil(rate / PART), F.lit(1)).cast("int")
    mean = rate / parts

    def inverse(u: Column) -> Column:
        # u: the number to invert at, p: probability of k, c: of less than k, n: how many k have a distribution value <= u.
        start = F.struct(u.alias("u"), F.exp(-mean).alias("p"), F.lit(0.0).alias("c"), F.lit(0).alias("n"))

        def step(s: Column, k: Column) -> Column:
            c = s["c"] + s["p"]
            return F.struct(s["u"].alias("u"), (s["p"] * mean / k).alias("p"), c.alias("c"), (s["n"] + F.when(c <= s["u"], 1).otherwise(0)).alias("n"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step, lambda s: s["n"])

    def add(total: Column, part: Column) -> Column:
        return total + inverse(unit(F.concat_ws("|", key, part.cast("string"))))

    return F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), add)


def record_key(seed: int, id_col: str, text_col: str) -> Column:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.crc32(text.cast("binary")).cast("string"))


def mixed(docs: DataFrame, weights: Mapping[str, float], epochs: float = 1.0, seed: int = 0, default_weight: float = 1.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """All columns of each document, once for each of its ``repeats``, with ``copy`` from 0 and ``shuffle_key``.

    Rows are dealt over all partitions by ``shuffle_key`` and lie in its order, so any run of a file is a random sample.
    """
    mix_source, rate, salt, key = free_names(docs, "_mix_source", "_rate", "_salt", "_key")
    rates = source_rates(docs, weights, epochs, default_weight, source_col, text_col).toDF(mix_source, rate)
    # A few sources go to all tasks; many are joined by shuffle, where adaptive execution splits a hot source.
    # The row's input partition spreads rows that repeat; it moves rows between files only. Taken before the join and not
    # from the row's place, as a task that runs again may meet its rows in another order and must deal them the same.
    placed = docs.withColumn(salt, F.spark_partition_id())
    rated = placed.join(if_small(rates, BROADCAST_SOURCES), F.col(source_col).eqNullSafe(F.col(mix_source))).drop(mix_source)
    counted = rated.withColumn(key, record_key(seed, id_col, text_col)).withColumn("repeats", poisson_count(F.col(rate), F.col(key)))
    copies = counted.where("repeats > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("repeats") - 1)))
    keyed = copies.withColumn("shuffle_key", md5_number(F.concat_ws("|", F.lit("shuffle"), F.col(key), F.col("copy").cast("string"))))
    return keyed.repartition("shuffle_key", salt).sortWithinPartitions("shuffle_key").drop(key, salt, rate)
