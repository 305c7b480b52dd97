"""A stream of rows with repeats and late arrivals merged into a keyed table (EXT-1).

``dropDuplicatesWithinWatermark`` drops what the source sends again, holding an id only
until its time is ``delay`` behind the newest one; what is left is merged by key into a
table of a ``TableStore`` by ``foreachBatch``. The batch number is committed with the
batch's rows, so a micro-batch that Spark repeats after a failure changes nothing, and
readers see whole batches. Rows later than ``delay`` are dropped by Spark's state operator:
their number is reported, and choosing ``delay`` longer than any lateness keeps all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.sources.versions import TableStore


class StreamReport(NamedTuple):
    batches: int
    rows_in: int
    too_late: int


def merge_batch(store: TableStore, table: str, batch: DataFrame, number: int, keys: Sequence[str],
                time_col: str, buckets: int) -> bool:
    """Merge one micro-batch unless it was committed before; whether it was merged."""
    run, mark = store.begin(), f"{table}.batch"
    if int(run.marks.get(mark, -1)) >= number:
        return False
    run.upsert(table, batch, keys, time_col, buckets, newest=True)
    run.marks[mark] = str(number)
    run.commit()
    return True


def merge_stream(spark: SparkSession, source_dir: str, schema: StructType, store: TableStore, table: str,
                 id_cols: Sequence[str], keys: Sequence[str], time_col: str, delay: str, checkpoint: str,
                 buckets: int = 64, files_per_batch: int | None = None) -> StreamReport:
    """Take the files that ``source_dir`` has gained since the last call: rows not seen
    before (by ``id_cols``) are merged into ``table``, the latest by ``time_col`` for each
    of ``keys``."""
    reader = spark.readStream.schema(schema).format(store.fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    # Spark's watermarks want a time with a zone; the rows keep their own column
    timed = reader.load(source_dir).withColumn("_event_time", F.col(time_col).cast("timestamp"))
    once = timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(list(id_cols)).drop("_event_time")

    def merge(batch: DataFrame, number: int) -> None:
        merge_batch(store, table, batch, number, keys, time_col, buckets)

    query = once.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    late = sum(o.get("numRowsDroppedByWatermark", 0) for p in progress for o in p["stateOperators"])
    return StreamReport(len(progress), sum(p["numInputRows"] for p in progress), late)
