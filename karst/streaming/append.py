"""Incremental append: micro-batches of a stream become commits of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from karst.plans.store import Table


def append_stream(stream: DataFrame, table: Table, name: str, checkpoint: str | None = None,
                  available_now: bool = True) -> StreamingQuery:
    """Append each micro-batch as one commit.

    A batch that is delivered again after a failure is recognised by its
    number in the commit record and skipped.  ``name`` identifies the writer.
    Numbers count within one stream: its own id, which Spark keeps in the
    checkpoint, is part of the token, so a stream that begins anew is never
    taken for a repeat.  The default checkpoint lies with the table and
    survives the application, so the same writer goes on where it ended.
    """
    location = checkpoint or f"{table.path}/_streams/{name}"
    spark = table.spark

    def commit(batch: DataFrame, number: int) -> None:
        stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream_id:
            raise RuntimeError("the stream's id is not known, so repeats could not be told from new batches")
        table.add(batch, token=(f"{name}:{stream_id}", number))

    writer = stream.writeStream.foreachBatch(commit).option("checkpointLocation", location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
