"""Range-sorted runs: rows in global key and time order, cut into partitions of even size whatever the keys hold.

``repartitionByRange`` on (key, order) splits a hot key over as many partitions as it needs. The result is
checkpointed, because its boundaries come from a sample and both passes over the runs must see the same ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.session import cut_lineage

RUN = "__run"


def sorted_runs(df: DataFrame, key: str, order: list[str], partitions: int | None = None) -> DataFrame:
    # Without a number, adaptive execution merges small runs up to its partition size.
    ranged = df.repartitionByRange(partitions, key, *order) if partitions else df.repartitionByRange(key, *order)
    return cut_lineage(ranged.sortWithinPartitions(key, *order).withColumn(RUN, F.spark_partition_id()))
