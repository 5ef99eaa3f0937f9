"""One run of loads. All loads of a run share an invocation id, so a window
that an external source has logged is the one its target filters by."""

from __future__ import annotations

import logging
import uuid
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.intervals import NTZ, as_moment
from tidemark.functions.sqltypes import align, cast_fields
from tidemark.operators import keyed, strategies
from tidemark.operators.filters import delta_filter
from tidemark.operators.keyranges import Ranges, ranges_by_partition
from tidemark.operators.partitioning import (
    DEFAULT,
    PART,
    ExpressionPartitions,
    Partitions,
    RangePartitions,
    in_labels,
    route,
)
from tidemark.operators.profile import Profile
from tidemark.operators.strategies import Change
from tidemark.plans.loadlog import LoadLog
from tidemark.plans.spec import PLAIN, LoadSpec
from tidemark.plans.windows import Window, next_window
from tidemark.sinks.table import AT, FLAT, PARTITIONING, Table, batch_name, directory_name
from tidemark.sources.external import SourceSpec, read_source

logger = logging.getLogger(__name__)

# Batches of a partition above which an upsert that only adds rows to it writes the
# partition anew with them.
MOST_BATCHES = 16
# Strategies that look for keys in all partitions, and so keep the ranges of each.
RANGED = ("delta_upsert", "delete_insert")

Model = DataFrame | str | Callable[[SparkSession], DataFrame]


@dataclass(frozen=True)
class LoadResult:
    load_type: str
    row_cnt: int
    extraction_to: datetime | None = None
    touched: frozenset[str] = frozenset()
    # Delta rows outside every named partition.
    unrouted: int = 0


class LoadRun:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        log: LoadLog,
        start_date=None,
        end_date=None,
        full_refresh: bool = False,
        invocation_id: str | None = None,
    ):
        self.spark = spark
        self.root = root
        self.log = log
        self.start_date = start_date
        self.end_date = end_date
        self.full_refresh = full_refresh
        self.invocation_id = invocation_id or uuid.uuid4().hex
        self._windows: dict[str, Window] = {}
        lacking = log.create_or_verify()
        if lacking:
            raise ValueError(f"{log.table.name} lacks the columns {', '.join(lacking)}")

    def table(self, name: str) -> Table:
        return Table(self.spark, name, self.root)

    # -- windows and filters -------------------------------------------------------

    def _window(
        self,
        last: datetime | None,
        load_interval: str,
        safety_period: str,
        delta_start=None,
    ) -> Window:
        window = next_window(
            last,
            self.log.now(),
            load_interval,
            safety_period,
            delta_start,
            self.start_date,
            self.end_date,
        )
        if window.upper < window.lower:
            logger.warning("the window from %s to %s is empty", window.lower, window.upper)
        return window

    def external(self, source: SourceSpec) -> DataFrame:
        """Read an external source. Its window is computed from the target's
        log entries and logged before anything is read. A run that is repeated after
        its load was completed reads the window that it read before."""
        source.validate()
        target = source.model_target
        last, _, repeated = self.log.history(self.invocation_id, target) if target else (None,) * 3
        window = repeated or self._window(
            last, source.load_interval, source.safety_period, source.delta_start
        )
        if target:
            self._windows[target] = window
        if target and not repeated:
            self.log.open(
                self.invocation_id,
                target,
                window,
                source.fmt,
                source.extraction_type,
                source.delta_field,
            )
        return read_source(self.spark, source, window)

    def filter_delta(
        self, df: DataFrame, spec: LoadSpec, column: str | None = None, log_dates: bool = False
    ) -> DataFrame:
        """Explicit delta filter inside a model. There is none before the
        target exists and in a full refresh. ``log_dates`` computes and logs a
        window; otherwise the one logged in this run is used, if any."""
        if self.full_refresh or not self.table(spec.name).exists():
            return df
        if log_dates:
            if not column:
                raise ValueError("log_dates needs a column")
            last = self.log.last_extraction(spec.name)
            window = self._window(last, spec.load_interval, spec.safety_period)
            self.log.open(self.invocation_id, spec.name, window, "filter_delta", None, column)
            self._windows[spec.name] = window
        else:
            logged = self.log.open_window(self.invocation_id, spec.name)
            if logged is None:
                return df
            window, logged_field = logged
            column = column or logged_field
        return delta_filter(df, column, window.lower, window.upper, spec.lower_exclusive)

    def _filter_auto(self, df: DataFrame, spec: LoadSpec) -> DataFrame:
        last, logged, repeated = self.log.history(self.invocation_id, spec.name)
        if logged or repeated:
            window = logged[0] if logged else repeated
        else:
            window = self._window(last, spec.load_interval, spec.safety_period)
            self.log.open(
                self.invocation_id, spec.name, window, "filter_delta", None, spec.delta_field
            )
        self._windows[spec.name] = window
        return delta_filter(df, spec.delta_field, window.lower, window.upper, spec.lower_exclusive)

    # -- loading ---------------------------------------------------------------------

    def load(self, spec: LoadSpec, model: Model) -> LoadResult:
        spec.validate()
        self._hooks(spec.pre_hooks)
        text = model if isinstance(model, str) else None
        if isinstance(model, str):
            df = self.spark.sql(model)
        else:
            df = model if isinstance(model, DataFrame) else model(self.spark)

        table = self.table(spec.name)
        self._take_up(table)
        exists = table.exists()
        is_view = exists and table.is_view()
        if exists and not is_view and not self.full_refresh:
            spec = replace(spec, layout=table.following(spec.layout))
        if not exists:
            result = self._create(table, spec, df)
        elif self.full_refresh or is_view:
            result = self._rebuild(table, spec, df, is_view)
        elif spec.strategy in PLAIN:
            result = self._load_plain(table, spec, df)
        else:
            if spec.delta_field and spec.add_delta:
                df = self._filter_auto(df, spec)
            result = self._load_delta(table, spec, align(df, table.schema()))
        self._log(spec, result, text)
        if spec.strategy == "delta":
            table.settle()
        self._hooks(spec.post_hooks)
        return result

    def _take_up(self, table: Table) -> None:
        """Finish what an earlier load had decided on but not carried out, or not
        logged, when it died."""
        left = table.finish()
        if left is None:
            return
        logger.warning("%s: finished a change that an earlier load had begun", table.name)
        if left.note:
            mark = left.note.pop("extraction_to")
            self.log.complete(extraction_to=datetime.fromisoformat(mark) if mark else None, **left.note)
        table.settle()

    def _mark(self, spec: LoadSpec, seen: Profile) -> datetime | None:
        """The new high-water mark: what was read, but not beyond the window. Rows
        dated ahead of the clock would keep those before them from being read."""
        mark = as_moment(seen.max_delta)
        if not isinstance(mark, datetime):
            return mark
        window = self._windows.get(spec.name)
        return min(mark, window.upper if window else self.log.now())

    def _accepted(self, spec: LoadSpec, current: Partitions | None, seen: Profile) -> Profile:
        """What becomes of staged rows that no named partition covers, decided before
        anything is switched. Those that are left out stay behind in their files."""
        if current is None or isinstance(current, ExpressionPartitions) or not seen.unrouted:
            return replace(seen, unrouted=0)
        logger.warning(
            "%s: %d delta rows outside every named partition (unrouted=%s)",
            spec.name,
            seen.unrouted,
            spec.unrouted,
        )
        if spec.unrouted == "error":
            raise ValueError(f"{spec.name}: {seen.unrouted} delta rows outside every partition")
        if spec.unrouted == "drop":
            return replace(seen, parts=seen.parts - {DEFAULT}, row_cnt=seen.row_cnt - seen.unrouted)
        return seen

    def _hooks(self, hooks) -> None:
        """Callables get the session; text is run as SQL."""
        for hook in hooks:
            self.spark.sql(hook) if isinstance(hook, str) else hook(self.spark)

    def _version(self) -> str:
        """A directory name that a repeated run does not meet again."""
        return f"v_{self.invocation_id}_{uuid.uuid4().hex[:12]}"

    def _log(self, spec: LoadSpec, result: LoadResult, text: str | None) -> None:
        if spec.strategy in PLAIN:
            return
        if result.load_type == "full":
            self.log.insert_done(self.invocation_id, spec.name, "full", result.row_cnt, text)
            return
        self.log.complete(
            self.invocation_id,
            spec.name,
            result.load_type,
            result.row_cnt,
            result.extraction_to,
            spec.delta_field,
            text,
            result.unrouted,
        )

    def _new_content(self, spec: LoadSpec, df: DataFrame) -> DataFrame:
        if spec.fields:
            df = cast_fields(df, spec.fields)
        if spec.partitioning:
            return route(df, spec.partitioning)
        # Appended rows come as batches, which are catalog partitions.
        return df.withColumn(PART, F.lit(FLAT)) if spec.strategy == "append" else df

    def _create(self, table: Table, spec: LoadSpec, df: DataFrame) -> LoadResult:
        ready = self._new_content(spec, df)
        path, seen = table.write(ready, self._version(), spec.layout, None, spec.delta_field)
        seen = self._accepted(spec, spec.partitioning, seen)
        ranges = self._key_ranges(table, spec, ready, path, seen.parts)
        table.create(path, ready.schema, seen.parts, spec.partitioning, spec.layout, ranges)
        self._analyze(table, spec, None)
        return LoadResult("init", seen.row_cnt, self._mark(spec, seen), unrouted=seen.unrouted)

    def _key_ranges(
        self, table: Table, spec: LoadSpec, df: DataFrame, path: str, labels
    ) -> dict[str, Ranges]:
        """The ranges of the merge keys in partitions of a version that was written,
        for strategies that use them: a scan of its key columns."""
        if spec.strategy not in RANGED or PART not in df.columns or not labels:
            return {}
        if not set(spec.keys) <= set(df.columns):
            return {}
        rows = table.files(path, df.schema).filter(in_labels(labels))
        return ranges_by_partition(rows, spec.keys)

    def _rebuild(self, table: Table, spec: LoadSpec, df: DataFrame, is_view: bool) -> LoadResult:
        """Write the complete new table, then replace the old one by it. The
        structure comes from the model again; where it is the old one, the
        table is only pointed at the new files, else a table that is complete takes
        its name."""
        ready = self._new_content(spec, df)
        path, seen = table.write(ready, self._version(), spec.layout, None, spec.delta_field)
        seen = self._accepted(spec, spec.partitioning, seen)
        parted = spec.partitioning is not None
        ranges = self._key_ranges(table, spec, ready, path, seen.parts)
        if not is_view and table.same_structure(ready.schema, parted, spec.layout):
            if PART in ready.columns:
                partitioning = {PARTITIONING: spec.partitioning.to_json()} if parted else None
                table.switch_partitions(path, seen.parts, table.labels(), partitioning, ranges=ranges)
            else:
                table.point_to(path)
        else:
            table.replace(path, ready.schema, seen.parts, spec.partitioning, spec.layout, False, ranges)
        self._analyze(table, spec, None)
        return LoadResult("init", seen.row_cnt, self._mark(spec, seen), unrouted=seen.unrouted)

    def _analyze(self, table: Table, spec: LoadSpec, labels) -> None:
        if spec.analyze:
            table.analyze(labels, spec.analyze == "columns", spec.analyze == "histograms")

    def _load_plain(self, table: Table, spec: LoadSpec, df: DataFrame) -> LoadResult:
        delta = align(df, table.schema())
        current = table.partitioning()
        if spec.strategy == "append":
            seen = self._append(table, spec, delta, current)
        elif spec.strategy == "delete_insert":
            return self._delete_insert(table, spec, delta, current)
        else:
            seen = self._replace_all(table, spec, delta, current, keep_backup=False)
        return LoadResult(spec.strategy, seen.row_cnt, unrouted=seen.unrouted)

    def _append(
        self, table: Table, spec: LoadSpec, delta: DataFrame, current: Partitions | None
    ) -> Profile:
        """Add rows as the batch of this run: all of them or none, and those of a run
        that is repeated once."""
        if not table.batched():
            return table.append(delta, spec.layout)
        routed = route(delta, current) if current else delta.withColumn(PART, F.lit(FLAT))
        path, seen = table.write(routed, self._version(), spec.layout)
        seen = self._accepted(spec, current, seen)
        table.add_batch(path, seen.parts, self.invocation_id)
        return seen

    def _delete_insert(
        self, table: Table, spec: LoadSpec, delta: DataFrame, current: Partitions | None
    ) -> LoadResult:
        """The delta is staged first, so it is evaluated once and what is deleted
        is what is inserted. Of partitions only those with a matching key or a
        delta row are written."""
        if current is not None:
            delta = route(delta, current)
        path, seen = table.write(delta, self._version(), spec.layout, keys=spec.keys)
        seen = self._accepted(spec, current, seen)
        touched: frozenset[str] = frozenset()
        if seen.row_cnt:
            staged = self._staged(table, path, delta, seen)
            plain = replace(spec, null_keys_match=False, delete_duplicates=False)
            if current is None:
                rows = strategies.delta_upsert(table.read(), staged, plain, seen.key_bytes)
                in_order = strategies.by_buckets(plain, seen.key_bytes)
                out, _ = table.write(rows, self._version(), spec.layout, cluster=not in_order)
                table.point_to(out)
            else:
                touched = self._upsert_parted(table, plain, staged, path, seen)
        return LoadResult(spec.strategy, seen.row_cnt, touched=touched, unrouted=seen.unrouted)

    def _staged(self, table: Table, path: str, delta: DataFrame, seen: Profile) -> DataFrame:
        """The staged delta, without rows that have not been accepted."""
        staged = table.files(path, delta.schema)
        return staged.filter(in_labels(seen.parts)) if PART in delta.columns else staged

    def _replace_all(
        self,
        table: Table,
        spec: LoadSpec,
        rows: DataFrame,
        current: Partitions | None,
        keep_backup: bool,
    ) -> Profile:
        if current is not None:
            rows = route(rows, current)
        elif table.batched():
            rows = rows.withColumn(PART, F.lit(FLAT))
        path, seen = table.write(rows, self._version(), spec.layout, None, spec.delta_field)
        seen = self._accepted(spec, current, seen)
        if keep_backup and table.batched():
            # The old table is renamed, whatever the number of its partitions.
            table.replace(path, table.read_parts().schema, seen.parts, current, spec.layout, True)
        elif table.batched():
            table.switch_partitions(path, seen.parts, table.labels())
        else:
            if keep_backup:
                table.retain_backup()
            table.point_to(path)
        return seen

    def _load_delta(self, table: Table, spec: LoadSpec, delta: DataFrame) -> LoadResult:
        current = table.partitioning()
        if spec.strategy == "full":
            seen = self._replace_all(table, spec, delta, current, spec.keep_backup)
            self._analyze(table, spec, None)
            return LoadResult("full", seen.row_cnt, unrouted=seen.unrouted)
        if spec.strategy == "delta":
            return self._append_partitions(table, spec, delta, current)

        growing = spec.strategy == "partitions" and isinstance(current, RangePartitions)
        if current is not None:
            delta = route(delta, current.open_ended() if growing else current)
        path, seen = table.write(
            delta,
            self._version(),
            spec.layout,
            current.key if growing else None,
            spec.delta_field,
            self._compared_keys(spec, growing),
        )
        seen = self._accepted(spec, current, seen)
        result = LoadResult(spec.strategy, seen.row_cnt, self._mark(spec, seen), unrouted=seen.unrouted)
        touched = None
        if seen.row_cnt:
            staged = self._staged(table, path, delta, seen)
            if current is None and self._brings_new_keys_only(table, spec, staged, seen):
                table.append(strategies.upsert_rows(staged, spec), spec.layout)
            elif current is None:
                combine = getattr(strategies, spec.strategy)
                rows = combine(table.read(), staged, spec, seen.key_bytes)
                one_row = spec.strategy == "delta_merge" and spec.delete_duplicates
                in_order = strategies.by_buckets(spec, seen.key_bytes) and not one_row
                out, _ = table.write(rows, self._version(), spec.layout, cluster=not in_order)
                if spec.strategy == "delta_merge" and spec.keep_backup:
                    table.retain_backup()
                table.point_to(out)
            else:
                touched = self._load_parted(table, spec, staged, path, seen, current)
                result = replace(result, touched=touched)
        if seen.row_cnt or spec.strategy == "delta_merge":
            self._analyze(table, spec, touched)
        return result

    def _brings_new_keys_only(
        self, table: Table, spec: LoadSpec, staged: DataFrame, seen: Profile
    ) -> bool:
        """Can an upsert simply insert? Finding out reads the key columns only,
        up to the first match, and saves rewriting the table. It is only asked
        where the delta's keys are broadcast: else the question alone would
        shuffle all keys of the target."""
        if spec.strategy != "delta_upsert" or seen.key_bytes is None:
            return False
        if seen.key_bytes > keyed.BROADCAST_KEY_BYTES:
            return False
        keys = table.read().select(*spec.keys)
        return keyed.with_matches(
            keys, staged, spec.keys, spec.null_keys_match, seen.key_bytes
        ).isEmpty()

    def _compared_keys(self, spec: LoadSpec, growing: bool) -> list[str]:
        """The columns by which a target row is matched with the delta."""
        if spec.strategy != "partitions":
            return spec.keys
        return [PART, *spec.keys] if spec.merge_partitions else []

    # -- partitioned targets ------------------------------------------------------------

    def _load_parted(
        self,
        table: Table,
        spec: LoadSpec,
        staged: DataFrame,
        path: str,
        seen: Profile,
        current: Partitions,
    ) -> frozenset[str]:
        target = table.read_parts()
        if spec.strategy == "delta_merge":
            rows = strategies.delta_merge(
                target.drop(PART), staged.drop(PART), spec, seen.key_bytes
            )
            self._replace_all(table, spec, rows, current, spec.keep_backup)
            return frozenset(table.labels())
        if spec.strategy == "delta_upsert":
            return self._upsert_parted(table, spec, staged, path, seen)

        grown = strategies.grow(current, seen)
        target, moved = self._split(table, target, current, grown)
        live = replace(spec, partitioning=current)
        taken = self._complete_as_staged(table, live, seen, moved)
        rest = replace(seen, parts=seen.parts - taken)
        change = Change(frozenset(), staged)
        if rest.parts:
            delta = staged.filter(~in_labels(taken)) if taken else staged
            change = strategies.partitions(target, delta, live, rest, seen.key_bytes)
        left = moved - change.touched - taken
        if left:
            rows = target.filter(in_labels(left))
            if change.touched:
                rows = change.rows.unionByName(rows)
            change = Change(change.touched | left, rows)
        written, place = frozenset(), path
        if change.touched:
            place, written = self._write_change(table, spec, change, seen if not moved else None)
        if change.touched or taken or grown != current:
            # What is taken as staged and what was written again, in one switch.
            staged_places = {label: f"{path}/{directory_name(label)}" for label in taken}
            table.switch_partitions(place, written, change.touched, self._grown(current, grown), staged_places)
        return change.touched | taken

    def _upsert_parted(
        self, table: Table, spec: LoadSpec, staged: DataFrame, path: str, seen: Profile
    ) -> frozenset[str]:
        """Upsert by the key ranges of the partitions: those that can hold no key of the
        delta are not opened. Rows for one of these are added as they were staged, as
        a batch, or as the partition where there is none yet; nothing is written again.
        A partition with many batches is written anew instead."""
        stored = table.stored_labels()
        candidates = frozenset(table.may_hold(seen.key_ranges, spec.null_keys_match))
        counts = Counter(s.split(AT)[0] for s in stored if AT in s)
        added = frozenset()
        if not spec.delete_duplicates:
            full = {label for label in seen.parts if counts[label] >= MOST_BATCHES}
            added = seen.parts - candidates - full
        target = table.read_parts()
        change = strategies.upsert_partitions(
            target, staged, spec, seen, seen.key_bytes, candidates, added
        )
        place, written = path, frozenset()
        if change.touched:
            place, written = self._write_change(table, spec, change, seen)
        # A name of its own: what comes later in this run is no repetition of it.
        batch = AT + batch_name(path.rsplit("/", 1)[-1])
        present = {s.split(AT)[0] for s in stored}
        names = {label: label + batch if label in present else label for label in added}
        places = {name: f"{path}/{directory_name(label)}" for label, name in names.items()}
        ranges = self._key_ranges(table, spec, staged, place, written)
        fresh = self._key_ranges(table, spec, staged, path, added)
        ranges |= {names[label]: r for label, r in fresh.items()}
        table.switch_partitions(place, written, change.touched, None, places, ranges)
        return change.touched | added

    def _complete_as_staged(
        self, table: Table, spec: LoadSpec, seen: Profile, moved: frozenset[str]
    ) -> frozenset[str]:
        """Partitions whose new content is exactly what has been staged: all of
        them when overwriting, those without target rows when merging. They are
        switched to without being written again."""
        if spec.delete_duplicates or spec.dedup_scope == "changed" and spec.merge_partitions:
            return frozenset()
        parts = seen.parts
        if not isinstance(spec.partitioning, ExpressionPartitions):
            parts = parts - {DEFAULT}
        return parts - table.labels() - moved if spec.merge_partitions else parts

    def _split(
        self, table: Table, target: DataFrame, current: Partitions, grown: Partitions
    ) -> tuple[DataFrame, frozenset[str]]:
        """Take the rows of newly added partitions out of the default one.
        Returns the relabelled target and the labels that this changes."""
        if grown == current or DEFAULT not in table.labels():
            return target, frozenset()
        first, last = current.last().end, grown.last().end
        key = F.col(current.key)
        low, high = F.lit(first), F.lit(last)
        if target.schema[current.key].dataType.typeName() != "date":
            low, high = low.cast(NTZ), high.cast(NTZ)
        default_rows = target.filter(F.col(PART) == DEFAULT)
        moving = default_rows.filter((key >= low) & (key < high))
        labels = route(moving.drop(PART), grown).select(PART).distinct().collect()
        if not labels:
            return target, frozenset()
        relabelled = target.filter(F.col(PART) != DEFAULT).unionByName(
            strategies.split_default(default_rows, grown)
        )
        return relabelled, frozenset({DEFAULT, *(row[PART] for row in labels)})

    def _grown(self, current: Partitions, grown: Partitions) -> dict[str, str]:
        return {PARTITIONING: grown.to_json()} if grown != current else {}

    def _write_change(
        self, table: Table, spec: LoadSpec, change: Change, seen: Profile | None
    ) -> tuple[str, frozenset[str]]:
        """Write the changed partitions: the version and the labels that got rows.

        When the delta's keys were broadcast, target rows come straight from
        their partition's files and the delta from its staged partitions, so
        the rows need not be brought together again.
        """
        in_order = (
            seen is not None
            and seen.key_bytes is not None
            and seen.key_bytes <= keyed.BROADCAST_KEY_BYTES
            and not spec.delete_duplicates
        )
        path, written = table.write(
            change.rows, self._version(), spec.layout, cluster=not in_order
        )
        return path, written.parts

    def _append_partitions(
        self, table: Table, spec: LoadSpec, delta: DataFrame, current: Partitions
    ) -> LoadResult:
        """Add the delta as the batch of this run. Batch, grown partitions and rows
        that leave the default partition for them are one switch. What has to be
        logged is noted with it: a run that dies before it logs is completed by the
        next one, which therefore does not read its window again."""
        growing = isinstance(current, RangePartitions)
        routed = route(delta, current.open_ended() if growing else current)
        path, seen = table.write(
            routed, self._version(), spec.layout, current.key if growing else None, spec.delta_field
        )
        seen = self._accepted(spec, current, seen)
        result = LoadResult(
            "delta", seen.row_cnt, self._mark(spec, seen), frozenset(seen.parts), seen.unrouted
        )
        grown = strategies.grow(current, seen)
        target = table.read_parts(but_batch=self.invocation_id)
        target, moved = self._split(table, target, current, grown)
        rewritten = None
        if moved:
            change = Change(moved, target.filter(in_labels(moved)))
            rewritten = (*self._write_change(table, spec, change, None), moved)
        note = {
            "invocation_id": self.invocation_id,
            "object_name": spec.name,
            "load_type": result.load_type,
            "row_cnt": result.row_cnt,
            "extraction_to": result.extraction_to and result.extraction_to.isoformat(),
            "delta_field": spec.delta_field,
            "unrouted": result.unrouted,
        }
        table.add_batch(
            path, seen.parts, self.invocation_id, self._grown(current, grown), rewritten, note
        )
        if seen.row_cnt:
            self._analyze(table, spec, seen.parts | moved)
        return result
