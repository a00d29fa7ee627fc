"""Extraction of arriving chunks, micro-batch by micro-batch, with the functions of the batch plan.

A folder is replaced as a whole, so a micro-batch that is delivered twice leaves the same tables; state lies in those
tables, none in the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from ..config import Settings
from ..plans.extraction import extract
from ..sources.sinks import replace_folders


def extract_stream(chunks: DataFrame, out: str, checkpoint: str, settings: Settings | None = None, **trigger) -> StreamingQuery:
    """Write entities and edges of each folder of a stream of chunks below ``out``.

    A folder must come whole in one micro-batch, as it does if its chunks are one file. A folder in which nothing is
    found any more loses what it had.
    """

    def each(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        done, folders = extract(batch, settings), batch.select("folder_id").distinct()
        replace_folders(done.entities, f"{out}/entities", folders)
        replace_folders(done.edges, f"{out}/edges", folders)

    return chunks.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
