"""Step time while runs go on: each record is timed when it arrives.

The last record of each run is what one micro-batch hands to the next: a table of one row per
run, in versions of which each names the batch it is of. A batch that is played again, after a
failure or a restart, starts from the version before it and writes its own folder anew, so its rows
are there once. Within a batch ``previous_within`` does the work: a run of any size is split.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tunefeed.operators.metrics import LOG_EVERY, seconds_per_step
from tunefeed.operators.ordered import ROWS_PER_BUCKET, previous_within
from tunefeed.session import shared_path
from tunefeed.sources.versioned import VersionedTable

_AT, _TIE, _NEW, _PREVIOUS, _LATE = "__at", "__tie", "__new", "__previous", "__late"


def write_step_time_stream(
    logs: DataFrame,
    table_path: str,
    state_path: str,
    checkpoint_path: str,
    keep: tuple[str, ...] = ("run_id", "step"),
    logging_steps: int = LOG_EVERY,
    tie_break: str = "step",
    timeout: dt.timedelta | None = None,
    max_run_rows: int = ROWS_PER_BUCKET,
    every: str | None = None,
) -> StreamingQuery:
    """Append ``keep``, ``time_per_step`` and ``late`` of all records present, then stop; with
    ``every`` (such as ``"1 minute"``) go on until stopped.

    Where each run's records arrive in order of ``logged_at`` and ``tie_break``, from batch to batch
    (within one any order will do), the times are those of ``time_per_step`` over all records.

    Late is a record that comes before its run's last one of an earlier batch: it has no time, and
    changes no other's. Records without ``logged_at`` have no time either. With a ``timeout``, a
    record that comes more than that after its run's previous one is a first record again; runs
    that far behind the newest record of the earlier batches are forgotten, and records older than
    that are late. Without, a row per run is kept for ever.
    """
    spark = logs.sparkSession
    kinds = {f.name: f.dataType for f in logs.schema.fields}
    schema = T.StructType(
        [
            T.StructField("run_id", kinds["run_id"]),
            T.StructField(_AT, kinds["logged_at"]),
            T.StructField(_TIE, kinds[tie_break]),
        ]
    )
    names = list(dict.fromkeys([*keep, "run_id"]))
    patience = None if timeout is None else F.lit(timeout)

    def run(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        state = VersionedTable(own, state_path, schema, ["run_id"])
        before = state.before(checkpoint_path, number)
        last = state.read(before)
        path = shared_path(own, "step-time")
        batch.select(*names, F.col("logged_at").alias(_AT), F.col(tie_break).alias(_TIE)).write.parquet(path)
        judged = _judged(own.read.parquet(path), last, patience)
        in_time = judged.filter(f"NOT {_LATE}").drop(_LATE)
        earlier = last.select(*[F.col(c) if c in ("run_id", _AT, _TIE) else F.lit(None).cast(judged.schema[c].dataType).alias(c) for c in in_time.columns])
        both = in_time.withColumn(_NEW, F.lit(True)).unionByName(earlier.withColumn(_NEW, F.lit(False)))
        looked = previous_within(both, ["run_id"], [_AT, _TIE, _NEW], _AT, _PREVIOUS, max_run_rows).filter(_NEW)
        time = seconds_per_step(F.col(_PREVIOUS), F.col(_AT), logging_steps)
        if patience is not None:
            time = F.when(F.col(_AT) <= F.col(_PREVIOUS) + patience, time)
        timed = looked.select(*keep, time.alias("time_per_step"), F.lit(False).alias("late"))
        late = judged.filter(_LATE).select(*keep, F.lit(None).cast("double").alias("time_per_step"), F.lit(True).alias("late"))
        timed.unionAll(late).write.mode("overwrite").parquet(f"{table_path}/batch={number}")
        newest = in_time.filter(F.col(_AT).isNotNull())
        held = None
        if patience is not None:
            seen = [t for t in (_newest(last), _newest(newest)) if t is not None]
            if seen:
                held = F.col(_AT) >= F.lit(max(seen)).cast(kinds["logged_at"]) - patience
        state.upsert(newest, [_AT, F.isnull(_TIE), _TIE], checkpoint_path, number, keep=held)
        state.vacuum()

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return logs.writeStream.option("checkpointLocation", checkpoint_path).trigger(**trigger).foreachBatch(run).start()


def _newest(rows: DataFrame):
    return rows.agg(F.max(_AT)).first()[0]


def _judged(rows: DataFrame, last: DataFrame, patience: Column | None) -> DataFrame:
    """With ``__late``; never NULL."""
    known = last.select(
        F.col("run_id").alias("__run"),
        F.struct(F.col(_AT), F.isnull(_TIE), F.col(_TIE)).alias("__last"),
    )
    joined = rows.join(known, rows["run_id"].eqNullSafe(F.col("__run")), "left")
    late = [F.struct(F.col(_AT), F.isnull(_TIE), F.col(_TIE)) < F.col("__last")]
    if patience is not None and (top := _newest(last)) is not None:
        late.append(F.col(_AT) < F.lit(top).cast(rows.schema[_AT].dataType) - patience)
    tested = reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in late])
    return joined.withColumn(_LATE, F.col(_AT).isNotNull() & tested).drop("__run", "__last")


def read_step_times(spark: SparkSession, table_path: str) -> DataFrame:
    """What ``write_step_time_stream`` has written so far."""
    return spark.read.parquet(table_path).drop("batch")
