"""Start a stream once or for good."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


#: Files are read however old they are; the file stream would otherwise pass over those of a week ago.
NO_AGE_LIMIT = "36500d"


def started(writer: DataStreamWriter, every: str | None) -> StreamingQuery:
    """Work off what is there and stop, or keep running at an interval."""
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
