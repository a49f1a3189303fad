"""Quarantine across uploads: state by id on a stream of verdicts.

Within one upload an invalid or unknown row takes all rows of its id along.
Here that goes on over uploads: once an id was found at fault, its rows in later
uploads are held, until an upload that is marked as a fix brings the id without
fault.  That releases what was held; rows at fault themselves stay out.

Rows never enter the state.  An upload is reduced to one verdict for each id
(``verdicts``, a partial aggregation, so an id with a third of all rows is one
verdict), and verdicts are a stream.  Its state is Spark's own: a deduplication
that drops a verdict seen before, and an aggregation that keeps each id's
verdicts with the time of their micro-batch (fixed in the stream's log, so the
same when a micro-batch runs again).  Of the ids that a micro-batch changes,
``decided`` works out by windows what is new, and that is appended;
``settled`` joins the last decision of each (id, upload) to the rows.

Verdicts of an id count in arrival order (``seq``, then upload) within a
micro-batch, and as they come across micro-batches.  The first one of an
(id, upload) counts, so a replayed upload adds nothing.

The decision on (id, upload): ``quarantined`` (at fault itself), ``held`` (an
earlier upload's fault, named in ``by``), ``clean``, ``released`` (held before;
``by`` is the fix).  Rows without an id, which is equal to nothing, or without an
upload have no verdict: they stand for themselves.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from upcheck.operators.skew import keyed_join
from upcheck.sources.storage import materialize

VERDICT = T.StructType([T.StructField("id", T.StringType()), T.StructField("upload", T.StringType()), T.StructField("seq", T.LongType()),
                        T.StructField("fault", T.BooleanType()), T.StructField("fix", T.BooleanType())])
DECISION = T.StructType([T.StructField("id", T.StringType()), T.StructField("upload", T.StringType()), T.StructField("status", T.StringType()),
                         T.StructField("by", T.StringType()), T.StructField("seq", T.LongType())])
QUARANTINED, HELD, CLEAN, RELEASED = "quarantined", "held", "clean", "released"

#: The state store that keeps state outside the heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def verdicts(rows: DataFrame, id_col: str, upload_col: str, seq: Column, fault: Column, fix: Column) -> DataFrame:
    """One row for each (id, upload): at fault if one of its rows is."""
    flagged = rows.select(F.col(id_col).cast("string").alias("id"), F.col(upload_col).alias("upload"), seq.cast("bigint").alias("seq"),
                          F.coalesce(fault, F.lit(True)).alias("fault"), fix.alias("fix")).where("id is not null and upload is not null")
    return flagged.groupBy("id", "upload").agg(F.min("seq").alias("seq"), F.bool_or("fault").alias("fault"), F.bool_or("fix").alias("fix"))


def decided(known: DataFrame) -> DataFrame:
    """The decisions that came with the last micro-batch.

    ``known`` has ``id``, all its verdicts as ``told`` (``arrived``, ``seq``, ``upload``, ``fault``, ``fix``) and the
    micro-batch's time as ``now``.  Every window is a running one, so an id's uploads take linear time after sorting.
    """
    order = [F.col("arrived"), F.col("seq").asc_nulls_last(), F.col("upload")]
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    every = known.select("id", "now", F.inline("told")).select("id", "now", "arrived", "seq", "upload", flag("fault"), flag("fix"))
    first = F.row_number().over(Window.partitionBy("id", "upload").orderBy(*order, "fault", "fix"))
    told = every.withColumn("first", first).where("first = 1").withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy(*order)))
    earlier = Window.partitionBy("id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("id").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = Window.partitionBy("id").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    fault, fixes = F.col("fault"), F.col("fix") & ~F.col("fault")
    told = told.withColumns({
        "bad": F.last(F.when(fault, F.struct("n", "upload")), ignorenulls=True).over(earlier),
        "good": F.last(F.when(fixes, F.col("n")), ignorenulls=True).over(so_far),
        "release": F.last(F.when(fixes, F.struct("upload", "seq", "arrived")), ignorenulls=True).over(later)})
    free = F.col("bad").isNull() | F.coalesce(F.col("good") > F.col("bad.n"), F.lit(False))
    status = F.when(fault, F.lit(QUARANTINED)).when(free, F.lit(CLEAN)).otherwise(F.lit(HELD))
    by = F.when(fault, F.col("upload")).when(~free, F.col("bad.upload"))
    own = F.when(F.col("arrived") == F.col("now"), F.struct("upload", status.alias("status"), by.alias("by"), "seq"))
    released = F.when(~fault & ~free & (F.col("release.arrived") == F.col("now")),
                      F.struct("upload", F.lit(RELEASED).alias("status"), F.col("release.upload").alias("by"), F.col("release.seq").alias("seq")))
    return told.select("id", F.inline(F.array_compact(F.array(own, released)))).select(*DECISION.names)


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in ``STATE_STORE``; the session's setting comes back."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, STATE_STORE)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def start_holds(spark: SparkSession, verdict_path: str, decision_path: str, checkpoint: str,
                available_now: bool = True, processing_time: str | None = None, max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Follow the verdict files below ``verdict_path`` and append decisions, those of a micro-batch at once.

    The session must keep state in ``STATE_STORE`` (see ``state_store``).
    """
    told = (spark.readStream.schema(VERDICT).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", str(max_files_per_trigger)).parquet(verdict_path))
    fresh = told.dropDuplicates().withColumn("arrived", F.current_timestamp())
    known = (fresh.groupBy("id").agg(F.collect_list(F.struct("arrived", "seq", "upload", "fault", "fix")).alias("told"))
             .withColumn("now", F.current_timestamp()))

    def append(changed: DataFrame, batch_id: int) -> None:
        # one folder a micro-batch, hidden until it is whole; one that runs again writes the same
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        hidden, folder = path(f"{decision_path}/_batch_{batch_id}"), path(f"{decision_path}/batch={batch_id}")
        decided(changed).write.mode("overwrite").parquet(hidden.toString())
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(folder, True)
        if not fs.rename(hidden, folder):
            raise RuntimeError(f"cannot rename {hidden.toString()} to {folder.toString()}")

    writer = known.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def latest(decisions: DataFrame) -> DataFrame:
    """The last decision on each (id, upload): a release comes after the hold."""
    last = F.max_by(F.struct("status", "by"), F.struct((F.col("status") == RELEASED).alias("r"), "seq")).alias("last")
    return decisions.groupBy("id", "upload").agg(last).select("id", "upload", "last.status", "last.by")


def settled(rows: DataFrame, decisions: DataFrame, id_col: str, upload_col: str, fault: Column, keep: Sequence[str] | None = None) -> DataFrame:
    """``rows`` (columns ``keep``, all by default) with ``status`` and ``by``.

    A row without an id or upload is quarantined by its own fault only.  The decisions are
    written before rows meet them, so a hot id can be split.
    """
    keep = list(rows.columns if keep is None else keep)
    table = materialize(latest(decisions).select(F.col("id").alias("__h_id"), F.col("upload").alias("__h_upload"), "status", "by"), "decisions")
    keyed = rows.select(*keep, F.col(id_col).cast("string").alias("__h_id"), F.col(upload_col).alias("__h_upload"),
                        F.coalesce(fault, F.lit(True)).alias("__h_fault"))
    own = F.when(F.col("__h_fault"), F.lit(QUARANTINED)).otherwise(F.lit(CLEAN))
    joined = keyed_join(keyed, table, ["__h_id", "__h_upload"], "left")
    alone = F.col("__h_id").isNull() | F.col("__h_upload").isNull()
    return joined.select(*keep, F.when(alone, own).otherwise(F.col("status")).alias("status"),
                         F.when(alone & F.col("__h_fault"), F.col("__h_upload")).when(~alone, F.col("by")).alias("by"))
