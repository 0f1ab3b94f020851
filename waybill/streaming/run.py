"""Starting streams and waiting for what is available."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from waybill.session import ROCKSDB, scratch_path
from waybill.streaming.state import OWNER


#: State in RocksDB. All stores of an executor share one bound of memory, a join keeps its sides in one store, and a batch
#: saves its changes instead of whole files, of which those of the last batches are kept.
ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "5",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, whatever the session has. State with timers is only kept there."""
    before = {name: spark.conf.get(name, None) for name in ON_DISK}
    for name, value in ON_DISK.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def output_mode(stream: DataFrame) -> str:
    """Owners of keys come again with each batch that has their key."""
    return "update" if OWNER in stream.columns else "append"


def drain(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str, mode: str | None = None) -> None:
    """Run a ``foreachBatch`` stream over everything that is available now."""

    def run(batch: DataFrame, number: int) -> None:
        # The shuffle files of the batches before lie on the executors' disks until the driver happens to collect its garbage.
        # Python's garbage, all generations of it, holds some of the JVM's.
        gc.collect(2)
        batch.sparkSession.sparkContext._jvm.System.gc()
        handler(batch, number)

    stream.writeStream.foreachBatch(run).outputMode(mode or output_mode(stream)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def start(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str, every_ms: int):
    """Run a ``foreachBatch`` stream for good. Batch sizes are bounded by the source's options."""
    writer = stream.writeStream.foreachBatch(handler).outputMode(output_mode(stream)).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=f"{every_ms} milliseconds").start()


def drain_to_table(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Append a stream to a parquet table in the shared folder and return the table."""
    root = scratch_path(spark, name)
    writer = stream.writeStream.format("parquet").option("path", f"{root}/data").option("checkpointLocation", f"{root}/checkpoint")
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/data")
