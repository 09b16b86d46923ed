"""De-duplication and repeatable loads on streams of review files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from reviewloom.plans.warehouse import ingest_rows, loaded_before


def dedupe_stream(
    stream: DataFrame, key: str = "review_id", order: Sequence[str] = (),
    event_time: str | None = None, lateness: str | None = None,
) -> DataFrame:
    """First record per id over all pages that arrive, whole.

    A record of an earlier micro-batch is before one of a later; inside a micro-batch the least
    ``order`` is first. Records of one id pass through its group one Arrow batch at a time, and
    only its least is held. All that is remembered of an id is that it has been seen. Without a
    lateness every id ever seen stays in the state store (see ``SESSION_CONF`` for the one that
    keeps it on disk). With one, records older than the watermark are dropped and an id is
    forgotten once the watermark has passed its first record by the lateness; a later repeat then
    counts as new. Rows without an id are one id. Order columns hold no nulls.
    """
    if lateness is not None and event_time is None:
        raise ValueError("a lateness needs the event time column")
    names, places = stream.columns, [*order]
    forget_ms = None
    if lateness is not None:
        stream = stream.withWatermark(event_time, lateness)
        interval = stream.sparkSession.range(1).select(
            (F.unix_millis(F.lit("1970-01-01").cast("timestamp") + F.expr(f"INTERVAL {lateness}"))
             - F.unix_millis(F.lit("1970-01-01").cast("timestamp"))).alias("ms"))
        forget_ms = max(interval.first()["ms"], 1)

    def first(_key: tuple, pages: Iterator, state) -> Iterator:
        if state.hasTimedOut:
            state.remove()
            return
        if state.exists:
            return
        best = None
        for page in pages:
            least = page.sort_values(places, kind="stable").head(1) if places else page.head(1)
            if best is None or (places and tuple(least[places].iloc[0]) < tuple(best[places].iloc[0])):
                best = least
        state.update((True,))
        if forget_ms is not None:
            seen = int(best[event_time].iloc[0].timestamp() * 1000)
            state.setTimeoutTimestamp(max(seen, state.getCurrentWatermarkMs()) + forget_ms)
        yield best[names]

    timeout = GroupStateTimeout.EventTimeTimeout if lateness else GroupStateTimeout.NoTimeout
    return stream.groupBy(key).applyInPandasWithState(
        first, stream.schema, "seen boolean", "append", timeout)


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet what has arrived, then stop."""
    return (
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )


def with_file(stream: DataFrame) -> DataFrame:
    """Adds ``_file``, the file a record came from, '' for a stream that is not of files."""
    try:
        return stream.withColumn("_file", F.col("_metadata.file_path"))
    except AnalysisException:
        return stream.withColumn("_file", F.lit(""))


def ingest_stream(
    stream: DataFrame, root: str, platform: str, checkpoint: str, source: str = "stream"
) -> StreamingQuery:
    """Load each micro-batch into the warehouse.

    ``stream`` has the cleaned review columns as text. Records are in the order of their files'
    names and of their places there. A batch is one load, published by its run row, which names
    the query and the batch. If the batch is replayed, a load that was published is found by that
    name and not repeated; one that was not is invisible, and is made again.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        name = f"{source}/{query}#{batch_id}"
        if loaded_before(spark, root, name):
            return
        rows = batch.withColumns(
            {
                "platform_key": F.lit(platform),
                "_source": F.lit(0),
                "_row": F.monotonically_increasing_id(),
            }
        )
        ingest_rows(spark, rows, root, [name], [platform])

    return (
        with_file(stream).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
