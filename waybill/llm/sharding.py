"""Sharding by rendezvous hashing of record keys over weighted shards.

A key goes to the shard with the least -ln(u) / weight, where u in (0, 1) is a hash of key and shard. One more shard
takes rows only into itself, and each shard gets rows in proportion to its weight. The key alone decides, so nothing is
shuffled to place a record.

Slots number the rows of a shard from 0 without gaps. A shard is cut into cells by another hash of key and text. Rows
that are alike in all that is returned are counted first, cells are summed, and only rows of one cell are put in order
together, so a shard, a key or a group of copies of any size is spread over many tasks.

A null key is the key of its own text form "" (all null keys share a shard), a null text has no bytes. Rows that repeat
get neighbouring slots. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.columns import md5_number, unit

#: Cells of a shard: the sums that are put in order for one shard are this many rows at most.
CELLS = 4096


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key. Shards that come later in the list never change what earlier shards offer."""
    offers = [
        F.struct((-F.ln(unit(F.concat_ws("|", key, F.lit(str(shard))))) / F.lit(float(weight))).alias("cost"), F.lit(shard).alias("shard"))
        for shard, weight in enumerate(weights)
        if weight > 0
    ]
    return (F.least(*offers) if len(offers) > 1 else offers[0])["shard"].cast("int")


def placed(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, id_col: str = "doc_id") -> DataFrame:
    """All rows and columns with ``shard`` and, with the weights after growth, ``grown_shard``."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    out = docs.withColumn("shard", rendezvous(key, weights))
    return out.withColumn("grown_shard", rendezvous(key, grown) if grown else F.lit(None).cast("int"))


def slots(docs: DataFrame, columns: Sequence[str], id_col: str = "doc_id", crc_col: str = "text_crc32", cells: int = CELLS) -> DataFrame:
    """``columns`` of each row of a table with ``shard``, and its slot inside the shard."""
    columns = list(dict.fromkeys(["shard", id_col, crc_col, *columns]))
    cell = F.pmod(md5_number(F.concat_ws("|", F.lit("cell"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(crc_col).cast("string"))), F.lit(cells))
    alike = docs.select(*columns, cell.alias("_cell")).groupBy(*columns, "_cell").agg(F.count("*").alias("_n"))
    inside = Window.partitionBy("shard", "_cell").orderBy(F.col(id_col), F.col(crc_col), *[c for c in columns if c not in ("shard", id_col, crc_col)])
    before = F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    sums = alike.groupBy("shard", "_cell").agg(F.sum("_n").alias("_sum"))
    ahead = F.sum("_sum").over(Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("shard", "_cell", F.coalesce(ahead, F.lit(0)).alias("_start"))
    rows = alike.withColumn("_before", F.coalesce(before, F.lit(0))).join(starts, ["shard", "_cell"])
    copies = rows.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    return copies.select(*columns, (F.col("_start") + F.col("_before") + F.col("_k")).alias("slot"))


def shard_sheet(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size (bytes of the text plus 1), text_crc32, law, shard, slot, grown_shard of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    thin = docs.select(
        F.col(id_col),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    out = slots(placed(thin, weights, grown, id_col), ["size", "grown_shard"], id_col)
    return out.select(id_col, "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
