"""Pipeline run state as an append-only event table.

Every update (status, task state, output value) is one event row; the
current state is the latest event per (run, key) by (ts, event_id). Writers
only append, so concurrent tasks never rewrite each other's rows, and the
state read is a single ``max_by`` aggregation.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.schemas import RUN_STATUSES, TASK_NAMES
from evalspark.session import path_exists

EVENT_SCHEMA = "run_id string, k string, v string, ts timestamp, event_id bigint"
STATUS_KEY = "status"
CONFIG_KEY = "config"
TASK_PREFIX = "task:"
OUTPUT_PREFIX = "output:"
JOB_KEYS = ("job_id", "job_run_id")


def _rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def init_run_events(spark: SparkSession, run_id: str, config: dict, ts, first_event_id: int = 0,
                    job_id: str | None = None, job_run_id: str | None = None) -> DataFrame:
    """A new run is pending, all six tasks pending, no outputs."""
    rows = [(run_id, STATUS_KEY, "pending", ts, first_event_id),
            (run_id, CONFIG_KEY, json.dumps(config, sort_keys=True), ts, first_event_id + 1)]
    for i, t in enumerate(TASK_NAMES):
        rows.append((run_id, TASK_PREFIX + t, "pending", ts, first_event_id + 2 + i))
    for i, (k, v) in enumerate(zip(JOB_KEYS, (job_id, job_run_id))):
        if v is not None:
            rows.append((run_id, k, v, ts, first_event_id + 2 + len(TASK_NAMES) + i))
    return _rows(spark, rows)


def update_events(spark: SparkSession, run_id: str, updates: dict[str, str], ts, first_event_id: int) -> DataFrame:
    """Status / task / output updates as events (keys as in this module)."""
    return _rows(spark, [(run_id, k, v, ts, first_event_id + i) for i, (k, v) in enumerate(updates.items())])


def run_state(events: DataFrame) -> DataFrame:
    """K9: latest value per (run, key) by (ts, event_id)."""
    order = F.struct(F.col("ts"), F.col("event_id"))
    return events.groupBy("run_id", "k").agg(
        F.max_by("v", order).alias("v"),
        F.max("ts").alias("updated_at"),
    )


STATE_SCHEMA = EVENT_SCHEMA + ", first_ts timestamp"


def _folded(rows: DataFrame) -> DataFrame:
    """STATE_SCHEMA rows -> one per (run, key): its latest event and its first time."""
    order = F.struct(F.col("ts"), F.col("event_id"))
    return rows.groupBy("run_id", "k").agg(F.max_by(F.struct("v", "ts", "event_id"), order).alias("e"), F.min("first_ts").alias("first_ts")) \
        .select("run_id", "k", "e.v", "e.ts", "e.event_id", "first_ts")


class RunLog:
    """K9: run events in a shared folder, read as a snapshot plus the events
    since, so a read costs the open runs' updates and not all history.

    Events are appended under the log's current epoch. ``snapshot`` folds the
    last snapshot and the events since into the state of the next epoch; nothing
    is rewritten. A read takes the newest snapshot and the events of its epoch
    and of the one before (a writer that was still in the old epoch is not
    missed; folding an event twice changes nothing). Late events, older than
    what a snapshot holds, fold in by their time like all others.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def epoch(self) -> int:
        if not path_exists(self.spark, f"{self.root}/epochs"):
            return 0
        return self.spark.read.schema("epoch int").json(f"{self.root}/epochs").agg(F.max("epoch")).first()[0] or 0

    def append(self, events: DataFrame) -> None:
        """Only the new events are written."""
        events.select("run_id", "k", "v", "ts", "event_id").withColumn("epoch", F.lit(self.epoch())) \
            .write.mode("append").partitionBy("epoch").parquet(f"{self.root}/events")

    def state(self) -> DataFrame:
        """STATE_SCHEMA: the latest event and the first time of every (run, key)."""
        return self._state(self.epoch())

    def _state(self, epoch: int) -> DataFrame:
        rows = self.spark.createDataFrame([], STATE_SCHEMA)
        if path_exists(self.spark, f"{self.root}/events"):
            events = self.spark.read.schema(EVENT_SCHEMA + ", epoch int").parquet(f"{self.root}/events")
            rows = events.where(F.col("epoch") >= epoch - 1).drop("epoch").withColumn("first_ts", F.col("ts"))
        if epoch:
            rows = rows.unionByName(self.spark.read.schema(STATE_SCHEMA).parquet(f"{self.root}/snapshots/{epoch}"))
        return _folded(rows)

    def snapshot(self) -> None:
        """Fold everything so far; later events go to the next epoch."""
        epoch = self.epoch()
        self._state(epoch).write.mode("overwrite").parquet(f"{self.root}/snapshots/{epoch + 1}")
        self.spark.createDataFrame([(epoch + 1,)], "epoch int").coalesce(1).write.mode("append").json(f"{self.root}/epochs")

    def records(self) -> DataFrame:
        """metadata.runs rows."""
        return records_of(self.state())

    def exists(self, run_id: str) -> bool:
        """Whether any event of the run exists (stops at the first row)."""
        return not self.state().where(F.col("run_id") == run_id).isEmpty()


def _json_of(state: Column, prefix: str) -> Column:
    picked = F.filter(state, lambda e: e["k"].startswith(prefix))
    entries = F.transform(picked, lambda e: F.struct(F.substr(e["k"], F.lit(len(prefix) + 1)).alias("key"),
                                                     e["v"].alias("value")))
    return F.to_json(F.map_from_entries(entries))


def run_records(events: DataFrame) -> DataFrame:
    """metadata.runs rows from run events: status, config, task_state and
    outputs JSON, first/last update time, completion time."""
    return records_of(_folded(events.withColumn("first_ts", F.col("ts"))))


def records_of(state: DataFrame) -> DataFrame:
    """metadata.runs rows from STATE_SCHEMA rows, in one aggregation; JSON
    objects are assembled natively with their keys in order. A status that is
    none of RUN_STATUSES raises when the rows are read."""
    per_run = state.groupBy("run_id").agg(
        F.array_sort(F.collect_list(F.struct("k", "v"))).alias("_s"),
        F.max("ts").alias("updated_at"),
        F.min("first_ts").alias("created_at"),
        F.max(F.when((F.col("k") == STATUS_KEY) & F.col("v").isin("completed", "failed"), F.col("ts"))).alias("completed_at"),
    )
    get = lambda key: F.get(F.filter("_s", lambda e: e["k"] == key), 0)["v"]
    status = get(STATUS_KEY)
    checked = F.when(status.isNull() | status.isin(*RUN_STATUSES), status) \
        .otherwise(F.raise_error(F.concat(F.lit("unknown run status: "), status)).cast("string"))
    return per_run.select(
        "run_id", get("job_id").alias("job_id"), get("job_run_id").alias("job_run_id"),
        checked.alias("status"), get(CONFIG_KEY).alias("config"),
        _json_of(F.col("_s"), TASK_PREFIX).alias("task_state"),
        _json_of(F.col("_s"), OUTPUT_PREFIX).alias("outputs"),
        "created_at", "updated_at", "completed_at",
    )


def json_get(js, key: str, default: str | None = None) -> Column:
    """one value of a JSON object (nested values as JSON text). Reads the
    path directly, so any JSON text is safe (no map built from its keys)."""
    path = "$['" + key.replace("\\", "\\\\").replace("'", "\\'") + "']"
    v = F.get_json_object(F.col(js) if isinstance(js, str) else js, path)
    return v if default is None else F.coalesce(v, F.lit(default))


def json_set(js, key: str, value) -> Column:
    """the JSON object with ``key`` set to ``value`` (objects of string
    values, as this library writes them for config, task state and outputs)."""
    m = F.coalesce(F.from_json(F.col(js) if isinstance(js, str) else js, "map<string,string>"),
                   F.create_map().cast("map<string,string>"))
    rest = F.map_filter(m, lambda k, _v: k != F.lit(key))
    val = value if isinstance(value, Column) else F.lit(value)
    return F.to_json(F.map_concat(rest, F.create_map(F.lit(key), val.cast("string"))))


def run_exists(events: DataFrame, run_id: str) -> bool:
    """Whether any event of ``run_id`` exists (stops at the first row)."""
    return not events.where(F.col("run_id") == run_id).isEmpty()
