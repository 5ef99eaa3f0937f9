"""The load log: one row per load of an object, kept as an append-only table of
events. The current state of an entry is its latest event."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.intervals import as_moment, to_datetime
from tidemark.operators.filters import moment
from tidemark.operators.partitioning import END_OF_TIME
from tidemark.plans.spec import Layout
from tidemark.plans.windows import Window
from tidemark.sinks.table import Table

OPEN, DONE = 1, 2
# The last event of an entry that has been cleared; such entries are in no view.
CLEARED = 3

# The log's columns, in order.
LOG_FIELDS = T.StructType(
    [
        T.StructField("invocation_id", T.StringType()),
        T.StructField("object_name", T.StringType()),
        T.StructField("status", T.LongType()),
        T.StructField("extraction_from", T.TimestampNTZType()),
        T.StructField("extraction_to", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("extraction_from_original", T.TimestampNTZType()),
        T.StructField("extraction_to_original", T.TimestampNTZType()),
        T.StructField("model_sql", T.StringType()),
        T.StructField("load_method", T.StringType()),
        T.StructField("extraction_type", T.StringType()),
        T.StructField("load_type", T.StringType()),
        T.StructField("row_cnt", T.LongType()),
        T.StructField("delta_field", T.StringType()),
    ]
)
EVENT_FIELDS = T.StructType(
    [
        *LOG_FIELDS.fields,
        T.StructField("entry_id", T.StringType()),
        T.StructField("event_no", T.LongType()),
        T.StructField("unrouted", T.LongType()),
    ]
)
DEFAULT_TABLE = "load_info"
DEFAULT_DATABASE = "etl"


def log_table_name(
    config: Mapping[str, Mapping[str, str]], target: str, target_database: str | None = None
) -> str:
    """Settings of this target, else of ``default``, else the target's own
    database, else fixed names."""
    common = config.get("default", {})
    chosen = config.get(target, common)
    database = chosen.get("schema", common.get("schema", target_database)) or DEFAULT_DATABASE
    return f"{database}.{chosen.get('table', common.get('table', DEFAULT_TABLE))}"


# -- operators on log rows -----------------------------------------------------------


def current_state(events: DataFrame, entry: list[str], newest_first: list[Column]) -> DataFrame:
    """The latest event of every entry."""
    window = W.partitionBy(*entry).orderBy(*newest_first)
    return (
        events.withColumn("__pick", F.row_number().over(window))
        .filter(F.col("__pick") == 1)
        .drop("__pick")
    )


def last_extractions(log: DataFrame) -> DataFrame:
    """High-water mark per object over its completed loads."""
    return (
        log.filter(F.col("status") == DONE)
        .groupBy("object_name")
        .agg(F.max("extraction_to").alias("extraction_to"))
    )


def _cleared(object_name: str, cutoff) -> Column:
    hit = F.col("object_name") == object_name
    if cutoff is not None:
        hit = hit & (F.col("created_at") >= moment(to_datetime(cutoff)))
    return hit


def without_object(log: DataFrame, object_name: str, cutoff=None) -> DataFrame:
    """The log less one object's rows, or less those created since a cutoff."""
    return log.filter(~F.coalesce(_cleared(object_name, cutoff), F.lit(False)))


def missing_columns(columns: list[str]) -> list[str]:
    """Required log columns that a table lacks, whatever the letter case."""
    have = {name.lower() for name in columns}
    return [f.name for f in LOG_FIELDS.fields if f.name.lower() not in have]


# -- the log table ---------------------------------------------------------------------


class LoadLog:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        name: str = f"{DEFAULT_DATABASE}.{DEFAULT_TABLE}",
        clock: Callable[[], datetime] = datetime.now,
    ):
        self.spark = spark
        self.clock = clock
        self.table = Table(spark, name, root)

    def now(self) -> datetime:
        return self.clock().replace(tzinfo=None)

    def create_or_verify(self) -> list[str]:
        """Create the log when there is none; otherwise report the columns it
        lacks, in whatever order it has the others. It may have more."""
        if self.table.exists():
            have = {name.lower() for name in self.table.read().columns}
            own = [f.name for f in EVENT_FIELDS.fields[len(LOG_FIELDS) : -1]]
            return missing_columns(list(have)) + [name for name in own if name not in have]
        empty = self.spark.createDataFrame([], EVENT_FIELDS)
        path, _ = self.table.write(empty.coalesce(1), _version(), Layout())
        self.table.create(path, EVENT_FIELDS)
        return []

    def entries(self, *only: Column) -> DataFrame:
        """Latest event per entry. Conditions on columns that never change
        within an entry are applied to the events, where the scan uses them."""
        events = self.table.read()
        for condition in only:
            events = events.filter(condition)
        newest = [F.col("event_no").desc(), F.col("status").desc()]
        return current_state(events, ["entry_id"], newest).filter(F.col("status") != CLEARED)

    def last_extraction(self, object_name: str) -> datetime | None:
        return self.standing("", object_name)[0]

    def standing(
        self, invocation_id: str, object_name: str
    ) -> tuple[datetime | None, tuple[Window, str | None] | None]:
        """An object's high-water mark, and the window and delta field that
        this run has logged for it and not completed, in one pass."""
        return self.history(invocation_id, object_name)[:2]

    def history(
        self, invocation_id: str, object_name: str
    ) -> tuple[datetime | None, tuple[Window, str | None] | None, Window | None]:
        """``standing``, and the window of a load that this run has completed: a run
        that is repeated reads what it has read before. The end of time, which older
        logs may hold, is no mark."""
        own = F.col("invocation_id") == invocation_id
        done = F.col("status") == DONE
        first = F.struct(
            "created_at", "entry_id", "extraction_from", "extraction_to", "delta_field"
        )
        original = F.struct(
            "created_at", "entry_id", "extraction_from_original", "extraction_to_original"
        )
        had_window = F.col("extraction_to_original").isNotNull()
        real = done & (F.col("extraction_to") < F.lit(END_OF_TIME))
        row = (
            self.entries(F.col("object_name") == object_name)
            .agg(
                F.max(F.when(real, F.col("extraction_to"))).alias("mark"),
                F.min(F.when(own & (F.col("status") == OPEN), first)).alias("open"),
                F.min(F.when(own & done & had_window, original)).alias("done"),
            )
            .first()
        )
        found, ended = row["open"], row["done"]
        logged = found and (
            Window(found["extraction_from"], found["extraction_to"]),
            found["delta_field"],
        )
        repeated = ended and Window(
            ended["extraction_from_original"], ended["extraction_to_original"]
        )
        return row["mark"], logged, repeated

    def open_window(
        self, invocation_id: str, object_name: str
    ) -> tuple[Window, str | None] | None:
        return self.standing(invocation_id, object_name)[1]

    def open(
        self,
        invocation_id: str,
        object_name: str,
        window: Window,
        load_method: str | None = None,
        extraction_type: str | None = None,
        delta_field: str | None = None,
    ) -> None:
        """Log a window before anything is read."""
        self._insert(
            invocation_id=invocation_id,
            object_name=object_name,
            status=OPEN,
            extraction_from=window.lower,
            extraction_to=window.upper,
            extraction_from_original=window.lower,
            extraction_to_original=window.upper,
            load_method=load_method,
            extraction_type=extraction_type,
            delta_field=delta_field,
        )

    def complete(
        self,
        invocation_id: str,
        object_name: str,
        load_type: str,
        row_cnt: int,
        extraction_to: datetime | None,
        delta_field: str | None,
        model_sql: str | None = None,
        unrouted: int = 0,
    ) -> None:
        """Complete all entries of this run for the object, or add one. A NULL
        high-water mark (empty delta) is ignored when marks are looked up."""
        changed = {
            "status": DONE,
            "extraction_to": as_moment(extraction_to),
            "updated_at": self.now(),
            "load_type": load_type,
            "delta_field": delta_field,
            "model_sql": model_sql,
            "row_cnt": row_cnt,
            "unrouted": unrouted,
        }
        # The entries of one run for one object are one or two.
        mine = self.entries(
            F.col("object_name") == object_name, F.col("invocation_id") == invocation_id
        ).collect()
        if not mine:
            self._insert(invocation_id=invocation_id, object_name=object_name, **changed)
        for row in mine:
            own = {name.lower(): value for name, value in row.asDict().items()}
            self._write({**own, **changed, "event_no": row["event_no"] + 1})

    def insert_done(
        self, invocation_id: str, object_name: str, load_type: str, row_cnt: int, model_sql=None
    ) -> None:
        """A completed entry of its own, marked with the current time."""
        self._insert(
            invocation_id=invocation_id,
            object_name=object_name,
            status=DONE,
            extraction_to=self.now(),
            load_type=load_type,
            row_cnt=row_cnt,
            model_sql=model_sql,
        )

    def clear(self, object_name: str, cutoff=None) -> int:
        """Delete an object's entries; returns how many there were. Each gets one
        more event that says so. Nothing is rewritten, so loads of this object and
        others may log meanwhile."""
        entries = self.entries(F.col("object_name") == object_name).filter(_cleared(object_name, cutoff))
        count = entries.count()
        if count:
            event = {
                "status": F.lit(CLEARED).cast("long"),
                "event_no": F.col("event_no") + 1,
                "updated_at": F.lit(str(self.now())).cast("timestamp_ntz"),
            }
            gone = entries.withColumns(event).select(self.table.read().columns)
            gone.coalesce(1).write.mode("append").insertInto(self.table.name)
        return count

    def compact(self) -> None:
        """Keep only the latest event of every entry, in few files. The log is
        written anew: no load may run meanwhile."""
        self._rewrite(self.entries())

    def _rewrite(self, rows: DataFrame) -> None:
        path, _ = self.table.write(rows, _version(), Layout())
        self.table.point_to(path)

    def _insert(self, **values) -> None:
        now = self.now()
        row = {"created_at": now, "updated_at": now, "entry_id": uuid.uuid4().hex, "event_no": 1}
        self._write({**row, **values})

    def _write(self, event: dict) -> None:
        columns = []
        for field in self.table.read().schema.fields:  # in the log's own order
            value = event.get(field.name.lower())
            value = str(value) if isinstance(value, datetime) else value
            columns.append(F.lit(value).cast(field.dataType).alias(field.name))
        row = self.spark.range(0, 1, 1, 1).select(columns)
        row.write.mode("append").insertInto(self.table.name)


def _version() -> str:
    return f"v_{uuid.uuid4().hex}"
