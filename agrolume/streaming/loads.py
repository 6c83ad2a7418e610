"""Bounded streams: new files since the last run, in micro-batches, each an upsert.

The batch number is stored in the same commit as the rows, so a batch that is
replayed after a failure is skipped.  A later batch wins on equal keys.

``stream_chunks`` takes files of any packing and layout and upserts a bounded number of
rows at a time: a file is unpacked once, its chunks are numbered in the order of its
rows, and a run that stops inside a file goes on with the chunk after the last stored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from agrolume.operators.dedupe import SEQ
from agrolume.operators.table import StoredTable, weekly_reset_due
from agrolume.sources import conab, readers, zarc


def file_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "csv", **options) -> DataFrame:
    """New files below ``path``, with what is needed to tell their line order."""
    files = spark.readStream.schema(schema).format(fmt).options(**options).load(path)
    return files.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    )


def _with_order(batch: DataFrame) -> DataFrame:
    if "_file" not in batch.columns:
        return batch
    place = F.struct(
        F.col("_file").alias("file"), F.col("_block").alias("block"), F.monotonically_increasing_id().alias("row")
    )
    return batch.withColumn(SEQ, place).drop("_file", "_block")


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gives its query, through every restart."""
    line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0]
    return json.loads(line)["id"]


class Run:
    """A started query.  Once it has ended well, its run is closed in the table.

    An interrupted run, or one nobody waited for, stays open: the next start
    takes it up.
    """

    def __init__(self, query: StreamingQuery, close: Callable[[], None]):
        self.query, self._close = query, close

    def awaitTermination(self, timeout: int | None = None) -> bool | None:  # noqa: N802
        ended = self.query.awaitTermination(timeout)
        if ended is not False and self.query.exception() is None:
            self._close()
        return ended

    def __getattr__(self, name: str):
        return getattr(self.query, name)


def stream_upsert(
    source: DataFrame,
    table: StoredTable,
    to_rows: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    name: str,
    fresh: Callable[[], bool] | None = None,
) -> Run:
    """Run ``to_rows`` on each micro-batch of ``source`` and upsert the result.

    A batch is known by the id of the streaming query, which belongs to the
    checkpoint: a new checkpoint numbers its batches anew and skips nothing.
    ``fresh()`` is asked with the first batch of a run whether the table is to be
    emptied; the answer takes effect in the commit that opens the run, so batches
    after it, also after a restart, only add.
    """
    spark = source.sparkSession

    def apply(batch: DataFrame, batch_id: int) -> None:
        stream = query_id(spark, checkpoint)
        opened = fresh is not None and stream not in table.commit().runs
        table.upsert(
            to_rows(_with_order(batch)),
            stream=stream,
            batch_id=batch_id,
            replace=opened and fresh(),
            run=uuid.uuid4().hex if opened else None,
        )

    query = (
        source.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(availableNow=True)
        .start()
    )
    return Run(query, lambda: table.end_run(query_id(spark, checkpoint)))


#: Chunk numbers of one micro-batch.
MOST_CHUNKS = 1 << 20
_FILE = "path string, modificationTime timestamp, length long, content binary"


def _chunked(raw: DataFrame, rows: int, folder: str) -> int:
    """Land rows in ``folder`` by chunk of about ``rows``, in file order; the number of chunks.

    What is landed stays as it is when the micro-batch is replayed.
    """
    spark = raw.sparkSession
    if not readers.exists(spark, f"{folder}/raw/_SUCCESS"):
        raw.write.mode("overwrite").parquet(f"{folder}/raw")
    landed = spark.read.parquet(f"{folder}/raw")
    chunks = max(1, -(-landed.count() // rows))
    if not readers.exists(spark, f"{folder}/chunks/_SUCCESS"):
        dealt = landed.repartitionByRange(chunks, SEQ).withColumn("_chunk", F.spark_partition_id())
        dealt.write.mode("overwrite").partitionBy("_chunk").parquet(f"{folder}/chunks")
    return chunks


def stream_chunks(
    spark: SparkSession,
    path: str,
    table: StoredTable,
    read: Callable[[SparkSession, list[str]], DataFrame],
    to_rows: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    name: str,
    rows: int = 1_000_000,
    files: int = 1,
) -> StreamingQuery:
    """Upsert new files below ``path``, ``files`` per micro-batch, about ``rows`` raw rows at a time.

    The stream itself carries names only; ``read`` opens the files of a micro-batch, each
    by its own header.  Chunks land beside the checkpoint until their batch is done.
    """
    names = (
        spark.readStream.schema(_FILE).format("binaryFile").option("maxFilesPerTrigger", files)
        .option("recursiveFileLookup", "true").load(path).select("path")
    )

    def apply(batch: DataFrame, batch_id: int) -> None:
        stream, first = query_id(spark, checkpoint), batch_id * MOST_CHUNKS
        folder = f"{checkpoint.rstrip('/')}-landed/{batch_id}"
        paths = sorted(r["path"] for r in batch.collect())  # ``files`` at most
        if not paths or table.commit().streams.get(stream, -1) >= first + MOST_CHUNKS - 1:
            return
        chunks = _chunked(read(spark, paths), rows, folder)
        landed = spark.read.parquet(f"{folder}/chunks")
        for chunk in range(chunks):
            number = first + (chunk if chunk + 1 < chunks else MOST_CHUNKS - 1)
            if table.commit().streams.get(stream, -1) < number:
                part = landed.where(F.col("_chunk") == chunk).drop("_chunk")
                table.upsert(to_rows(part), stream=stream, batch_id=number)
        readers.remove(spark, folder)

    return (
        names.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).queryName(name)
        .trigger(availableNow=True).start()
    )


def stream_zarc_files(spark: SparkSession, path: str, tables: dict, checkpoint: str, name: str = "zarc-files", **size) -> StreamingQuery:
    """Climate risk files, gzip or plain, each by its own header, in chunks of rows (``stream_chunks``)."""
    culturas, municipios = tables["dim_cultura"].read(), tables["dim_municipio"].read()

    def to_rows(batch: DataFrame) -> DataFrame:
        return zarc.fact(zarc.clean(batch), culturas, municipios)

    return stream_chunks(spark, path, tables["fato_risco_zarc"], readers.read_zarc_files, to_rows, checkpoint, name, **size)


def stream_zarc(source: DataFrame, tables: dict, checkpoint: str, name: str = "zarc") -> Run:
    """Climate risk files: clean, resolve, unpivot, upsert.  The size of a batch is
    the source's ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``."""
    culturas, municipios = tables["dim_cultura"].read(), tables["dim_municipio"].read()

    def to_rows(batch: DataFrame) -> DataFrame:
        return zarc.fact(zarc.clean(batch), culturas, municipios)

    return stream_upsert(source, tables["fato_risco_zarc"], to_rows, checkpoint, name)


def stream_prices(source: DataFrame, tables: dict, checkpoint: str, name: str = "precos_semanal") -> Run:
    """Weekly prices.  The four-week reset is decided once, with the first batch of
    the run, so later batches of the run never wipe earlier ones, nor does a restart."""
    culturas, municipios = tables["dim_cultura"].read(), tables["dim_municipio"].read()
    table = tables["fato_precos_conab_semanal"]
    def to_rows(batch: DataFrame) -> DataFrame:
        return conab.fact(conab.clean_prices(batch, weekly=True), culturas, municipios)

    return stream_upsert(source, table, to_rows, checkpoint, name, fresh=lambda: weekly_reset_due(table))
