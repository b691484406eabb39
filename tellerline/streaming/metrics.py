"""Counts that a running stream takes of its own rows, kept per micro-batch.

The counts are named observations on the streaming plan: Spark fills them while it processes a micro-batch, so rows are
not read again for them. A listener stores them as progress is reported and goes when its query ends. A driver that is lost
between a micro-batch and its report stores none for it.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from tellerline.functions.columns import has_null
from tellerline.params import JobConfig, Stamp
from tellerline.schemas import CORRUPT_COLUMN, LAYER_TABLES, TableSpec
from tellerline.sources import files

COUNTS = ("input_rows", "null_keys", "late_rows", "rejected_rows")

_SCHEMA = StructType().add("table_name", "string").add("query_id", "string").add("batch_id", "long")
for _count in COUNTS:
    _SCHEMA.add(_count, "long")
_SCHEMA.add("run_ts", "timestamp")


def _path(config: JobConfig, spec: TableSpec) -> str:
    return f"{config.layer_root(spec.layer)}/stream_metrics/{spec.name}"


def keys_of(folder: str) -> Sequence[str]:
    """Key columns of a staged folder's rows: those of its silver table."""
    return next(spec.keys for spec in LAYER_TABLES["silver"] if spec.name == folder)


class Metrics(StreamingQueryListener):
    """Observes one run of a query and stores its counts; ``late_before`` is the first day that is not late.

    A row is rejected if its line does not parse, and late if it has a transaction time before
    that day, which a summary of the days since would not see. Null keys are counted among the rows that are not rejected.
    """

    def __init__(self, spark: SparkSession, config: JobConfig, spec: TableSpec, keys: Sequence[str], late_before: dt.date | None = None):
        self.spark, self.config, self.spec, self.keys, self.late_before = spark, config, spec, keys, late_before
        self.name = f"{spec.layer}.{spec.name}.{uuid.uuid4().hex}"
        self._run_id: str | None = None
        self._over: set[str] = set()
        self._change, self._error = threading.Condition(), None

    def on(self, rows: DataFrame) -> DataFrame:
        """The rows, observed. Where lines that do not parse are not marked, they are those without any value."""
        own = [c for c in rows.columns if not c.startswith("_")]
        empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in own])
        rejected = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in rows.columns else empty
        timed = self.late_before is not None and "transaction_ts" in own
        late = F.to_date("transaction_ts") < F.lit(self.late_before) if timed else F.lit(False)
        tests = (F.lit(True), has_null(self.keys) & ~rejected, late, rejected)
        return rows.observe(self.name, *[F.count_if(test).alias(name) for name, test in zip(COUNTS, tests, strict=True)])

    def leave_with(self, query: StreamingQuery) -> None:
        """Go when the query ends, whenever that is."""
        with self._change:
            self._run_id = str(query.runId)
            over = self._run_id in self._over
        if over:
            self.spark.streams.removeListener(self)

    def finish(self, query: StreamingQuery, timeout: float = 60) -> None:
        """Wait until all counts of a query that has ended are stored, and go."""
        with self._change:
            over = self._change.wait_for(lambda: str(query.runId) in self._over, timeout)
        self.spark.streams.removeListener(self)
        if self._error is not None:
            raise self._error
        if not over:
            raise TimeoutError(f"no end of the query of {self.name} was reported within {timeout} s")

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        done = event.progress
        counts = (done.observedMetrics or {}).get(self.name)
        if counts is None or not done.numInputRows:
            return
        values = (self.spec.name, str(done.id), done.batchId, *(counts[name] for name in COUNTS))
        columns = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, _SCHEMA)]
        try:
            line = self.spark.range(0, 1, 1, 1).select(*columns, Stamp.at().ts.alias("run_ts"))
            line.write.mode("append").parquet(_path(self.config, self.spec))
        except Exception as error:  # raised where the run is waited for: an error in a listener is only logged
            self._error = error

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._change:
            self._over.add(str(event.runId))
            self._change.notify_all()
            mine = str(event.runId) == self._run_id
        if mine:
            self.spark.streams.removeListener(self)


def stream_metrics(spark: SparkSession, config: JobConfig, spec: TableSpec) -> DataFrame:
    """Counts per micro-batch; of a micro-batch that ran again the last ones."""
    path = _path(config, spec)
    files.make_dir(spark, path)
    last = Window.partitionBy("query_id", "batch_id").orderBy(F.desc("run_ts"))
    lines = spark.read.schema(_SCHEMA).parquet(path).withColumn("_n", F.row_number().over(last))
    return lines.where("_n = 1").drop("_n")
