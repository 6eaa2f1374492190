"""Routing of a message stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from hiremill.operators.routing import route_messages


def route_stream(messages: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append routed messages to Parquet files under ``out``; stateless, so nothing is kept between batches."""
    writer = route_messages(messages).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", out).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
