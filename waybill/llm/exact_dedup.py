"""Exact dedup by progressive refinement: length, then hash of the head, then hash of the whole text.

Two texts are equal when they are identical after lower-casing A-Z. Only rows whose (length, head) occurs more than once
can have an equal, so only they are hashed whole for grouping. No text is shuffled: what decides whether a row is a
survivor is a bit table of fixed size, filled from the surviving (length, head) keys. A bit set by another key lets a row
through in vain, which costs one hash and changes no result.

Null text counts as empty. A null id is smaller than any other. Of rows with one id and one text exactly one stays.
An empty table gives an empty table. Columns besides the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.columns import ascii_lower
from waybill.llm.sizes import if_small
from waybill.session import cut_lineage

#: Bits of the table of survivors; 64 of them are one row, so it has 2^20 rows at most, whatever the input.
SURVIVOR_BITS = 2**26
#: Rows of the table of lengths that may be broadcast. L different lengths take L^2 / 2 bytes of text at least.
BROADCAST_SIZES = 1_000_000


def heads(docs: DataFrame, text: Column, head_chars: int) -> DataFrame:
    """(length, head hash) that occur more than once. Lengths that occur once are dropped before heads are hashed."""
    rows = docs.select(F.octet_length(text).alias("size"), F.substring(text, 1, head_chars).alias("start"))
    sizes = rows.groupBy("size").agg(F.count("*").alias("n")).where("n > 1").select("size")
    keyed = rows.join(if_small(sizes, BROADCAST_SIZES), "size", "left_semi").select("size", F.xxhash64(ascii_lower(F.col("start"))).alias("head"))
    return keyed.groupBy("size", "head").agg(F.count("*").alias("n")).where("n > 1").select("size", "head")


def survivor_table(keys: DataFrame, bits: int = SURVIVOR_BITS) -> DataFrame:
    """word, mask: a bit for each surviving key, 64 to a row."""
    bit = F.pmod(F.xxhash64("size", "head"), F.lit(bits))
    return (
        keys.select(bit.alias("bit"))
        .groupBy(F.floor(F.col("bit") / 64).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("mask"))
    )


def equal_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head_chars: int = 64, digest_all: bool = False) -> DataFrame:
    """One row per document: its id, keep_id, group_size, kept, text_sha256 (null for rows that are no survivors).

    ``digest_all`` fills text_sha256 for all rows, for callers who want the digest besides the grouping.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = heads(docs, text, head_chars)
    bit = F.pmod(F.xxhash64("size", "head"), F.lit(SURVIVOR_BITS))
    rows = docs.select(
        F.col(id_col).alias("id"),
        text.alias("body"),
        F.octet_length(text).alias("size"),
        F.xxhash64(ascii_lower(F.substring(text, 1, head_chars))).alias("head"),
    ).withColumn("word", F.floor(bit / 64)).withColumn("at", (bit % 64).cast("int"))
    marked = rows.join(F.broadcast(survivor_table(keys)), "word", "left").withColumn(
        "survives", F.coalesce(F.expr("shiftright(mask, at) & 1L") == 1, F.lit(False))
    )
    wanted = F.lit(True) if digest_all else F.col("survives")
    thin = marked.select(
        "id", "size", "head", "survives",
        F.when(wanted, F.sha2(ascii_lower(F.col("body")), 256)).alias("sha"),
        F.monotonically_increasing_id().alias("row"),
    )
    thin = cut_lineage(thin)
    groups = (
        thin.where("survives")
        .groupBy("size", "head", "sha")
        .agg(F.max(F.struct("id", "row")).alias("last"), F.count("*").alias("n"))
        .where("n > 1")
    )
    joined = thin.join(groups, ["size", "head", "sha"], "left")
    return joined.select(
        F.col("id").alias(id_col),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("last.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("last.row") == F.col("row"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
