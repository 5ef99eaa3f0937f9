"""Catalog tables that switch to new data only once it is completely written.

New data always goes to a fresh directory under the table's home; a metadata
statement then points the table, or each rewritten partition, at it. A job that
dies before that leaves the table as it was. The directories left behind stay
readable as the previous version until ``vacuum`` removes them.

Where more than one statement is needed, what they shall do is written to a journal
first. From then on the change is decided: a writer that dies between two statements
leaves the journal, and the next load carries it out before anything else.

Rows that are added come as batches: a partition has a base, which rewriting
replaces, and any number of batches beside it, each a catalog partition of its own
whose label is the partition's with ``@`` and the batch. Readers see the label alone. A batch that
comes again under its name takes the place of the first. Tables without partitions
that are filled by appending have batches of one partition, ``FLAT``.

One writer per table at a time is assumed.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.keyranges import Ranges, from_text, may_match, to_text
from tidemark.operators.partitioning import PART, Partitions, partitions_from_json
from tidemark.operators.profile import Profile, profile_columns
from tidemark.plans.spec import Layout

PARTITIONING = "tidemark.partitioning"
#: Stands before a stored label, in hexadecimal digits, in the property with the key
#: ranges of its rows.
RANGE = "tidemark.range."
#: Buckets and distribution of a table, which its writers follow.
LAYOUT = "tidemark.layout"
#: Largest files, and largest rows in memory (estimated by types), of a replicated table
#: that is sent to every executor.
REPLICATED_BYTES, REPLICATED_MEMORY = 32 << 20, 256 << 20
#: The one partition of a table without a partitioning whose rows come in batches.
FLAT = "all"
#: Stands between a partition's label and a batch; no stored label has it.
AT = "@"
JOURNAL = "switch.json"

# Characters that Spark escapes in partition directory names.
_ESCAPED = re.compile(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]")
_BATCH = 200
# Changed partitions up to which each gets a statement for its statistics; more do
# so too as long as they are fewer than half of all.
_SINGLY = 3
# Statements for statistics at a time: each is a job of a few small tasks.
_AT_ONCE = 8


@dataclass(frozen=True)
class Switch:
    """What catalog statements shall bring about, in a form that can be carried out
    twice: catalog partitions and their new places (the empty label: the table
    itself), those to go, properties; and a note for who carries it out."""

    places: dict[str, str] = field(default_factory=dict)
    gone: list[str] = field(default_factory=list)
    properties: dict[str, str] = field(default_factory=dict)
    # Key ranges of partitions in their new places. Others that change lose theirs.
    ranges: dict[str, str] = field(default_factory=dict)
    # A complete new table that takes this one's name, and what it is called till then.
    staged: str = ""
    keep_backup: bool = False
    note: dict | None = None

    def steps(self) -> int:
        simple = len(self.places) + len(self.gone) + len(self.properties)
        return simple + bool(self.ranges) + 3 * bool(self.staged)


# Properties that belong to the version of a table, not to its name.
_NOT_COPIED = ("tidemark.", "spark.", "transient_", "numFiles", "totalSize", "EXTERNAL", "option.")


def batch_name(batch: str) -> str:
    """A batch as part of a label, of characters that no catalog escapes."""
    return re.sub(r"[^A-Za-z0-9.~-]", "~", batch)


def _default_size(kind: T.DataType) -> int:
    """Bytes of a value by its type; texts are taken to be of some length."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return 64
    if isinstance(kind, T.StructType):
        return sum(_default_size(f.dataType) for f in kind.fields)
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return 512
    return 16


def range_key(label: str) -> str:
    return RANGE + label.encode().hex()


def directory_name(label: str) -> str:
    return f"{PART}=" + _ESCAPED.sub(lambda m: f"%{ord(m.group()):02X}", label)


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def arrange(df: DataFrame, layout: Layout, cluster: bool = True) -> DataFrame:
    """Order rows for writing.

    Rows of one partition (or of one distribution key) are brought together by
    a rebalance: adaptive execution sizes the tasks by bytes, so a partition
    with a third of the rows is written by many tasks and small ones share one.
    ``cluster=False`` leaves out that shuffle for rows that come off the disk
    in partition or bucket order already. A task that writes buckets has the rows of one.
    """
    parted = PART in df.columns
    if layout.buckets and cluster:
        df = df.repartition(layout.buckets, *layout.distributed_by)
    if layout.distribution == "random" and cluster and not parted:
        df = df.hint("rebalance")
    by = [PART] if parted else list(layout.distributed_by)
    if by and cluster and not layout.buckets:
        df = df.hint("rebalance", *by)
    if layout.order_by:
        df = df.sortWithinPartitions(*([PART] if parted else []), *layout.order_by)
    return df


class Table:
    def __init__(self, spark: SparkSession, name: str, root: str):
        self.spark = spark
        self.name = name
        self.home = f"{root.rstrip('/')}/{name.replace('.', '/')}"
        self.quoted = ".".join(f"`{part}`" for part in name.split("."))

    # -- reading -----------------------------------------------------------------

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def is_view(self) -> bool:
        if not self.exists():
            return False
        return self.spark.catalog.getTable(self.name).tableType in ("VIEW", "TEMPORARY")

    def read(self) -> DataFrame:
        """The table's own columns, without the partition label."""
        return self.spark.table(self.name).drop(PART)

    def read_parts(self, but_batch: str | None = None) -> DataFrame:
        """The table with its partition labels, without a batch if one is named. A
        filter on labels prunes batches like partitions."""
        df = self.spark.table(self.name)
        if PART not in df.columns or not any(AT in label for label in self.stored_labels()):
            return df
        if but_batch is not None:
            df = df.filter(~F.endswith(F.col(PART), F.lit(AT + batch_name(but_batch))))
        return df.withColumn(PART, F.substring_index(PART, AT, 1))

    def schema(self) -> T.StructType:
        return self.read().schema

    def properties(self) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.quoted}").collect()
        return {row["key"]: row["value"] for row in rows}

    def partitioning(self) -> Partitions | None:
        text = self.properties().get(PARTITIONING)
        return partitions_from_json(text) if text else None

    def batched(self) -> bool:
        """Does the catalog have partitions for this table?"""
        return PART in self.spark.table(self.name).columns

    def labels(self) -> set[str]:
        return {label.split(AT)[0] for label in self.stored_labels()}

    def stored_labels(self) -> set[str]:
        """Labels of catalog partitions, batches included."""
        return {
            row[PART]
            for row in self.spark.sql(f"SHOW PARTITIONS {self.quoted}")
            .select(F.expr(f"substring(partition, {len(PART) + 2})").alias(PART))
            .collect()
        }

    def location(self, label: str | None = None) -> str:
        """Directory of the table or of one partition."""
        part = f"PARTITION ({PART} = {_quote(label)})" if label is not None else ""
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.quoted} {part}")
        return rows.filter("col_name = 'Location'").first()["data_type"]

    def following(self, layout: Layout) -> Layout:
        """A layout with the buckets and the distribution that this table has."""
        own = json.loads(self.properties().get(LAYOUT, "{}"))
        buckets, by = own.get("buckets", 0), own.get("distributed_by")
        return replace(
            layout,
            buckets=buckets,
            distributed_by=tuple(by) if buckets else layout.distributed_by,
            distribution=own.get("distribution", ""),
        )

    def for_join(self) -> DataFrame:
        """The table as one side of a join. A replicated one is sent to every executor,
        if its last load has left it small enough; beyond that, or where its size is
        not known, Spark joins as it does with any table."""
        df, layout = self.read(), self.following(Layout())
        size, rows = self.statistics() or (None, None)
        if layout.distribution != "replicated" or size is None or rows is None:
            return df
        # Fixed value: bytes that a field takes beside its value.
        width = sum(_default_size(f.dataType) + 8 for f in df.schema.fields)
        small = size <= REPLICATED_BYTES and rows * width <= REPLICATED_MEMORY
        return F.broadcast(df) if small else df

    def same_structure(self, schema: T.StructType, parted: bool, layout: Layout = Layout()) -> bool:
        mine = self.read_parts().schema
        if self.following(layout) != layout:
            return False
        return (self.partitioning() is not None) == parted and [
            (f.name, f.dataType) for f in mine
        ] == [(f.name, f.dataType) for f in schema]

    def backup(self) -> Table:
        """The table that stands for the retained previous version."""
        return self.beside("bkp")

    def beside(self, prefix: str) -> Table:
        database, _, short = self.name.rpartition(".")
        name = f"{database}.{prefix}_{short}" if database else f"{prefix}_{short}"
        root = self.home[: -len(self.name)].rstrip("/")
        return Table(self.spark, name, root)

    # -- writing files -------------------------------------------------------------

    def write(
        self,
        df: DataFrame,
        version: str,
        layout: Layout,
        partition_key: str | None = None,
        delta_field: str | None = None,
        keys: Sequence[str] = (),
        cluster: bool = True,
    ) -> tuple[str, Profile]:
        """Write a version directory and return its path and its profile.

        The profile is observed behind the last shuffle, in the tasks that
        write: their metrics count once even when tasks or stages run again.
        """
        seen = Observation()
        ready = arrange(df, layout, cluster)
        ready = ready.observe(seen, *profile_columns(df, partition_key, delta_field, keys))
        path = f"{self.home}/{version}"
        writer = ready.write.mode("errorifexists").option("compression", layout.compression)
        if layout.compression_level is not None:
            codec = layout.compression
            writer = writer.option(
                f"parquet.compression.codec.{codec}.level", layout.compression_level
            )
        if PART in df.columns:
            writer = writer.partitionBy(PART)
        if layout.buckets:
            # Only a table can be written in buckets: one that is forgotten at once.
            passing = self.beside("wrt")
            passing.create_database()
            passing.drop()
            writer = writer.bucketBy(layout.buckets, *layout.distributed_by).format("parquet")
            writer.option("path", path).saveAsTable(passing.name)
            passing.drop()
        else:
            writer.parquet(path)
        return path, Profile.of_metrics(seen.get, keys)

    def files(self, path: str, schema: T.StructType) -> DataFrame:
        """A version directory as a DataFrame."""
        return self.spark.read.schema(schema).parquet(path)

    # -- catalog -------------------------------------------------------------------

    def create(
        self,
        path: str,
        schema: T.StructType,
        labels: Iterable[str] = (),
        partitioning: Partitions | None = None,
        layout: Layout = Layout(),
        ranges: Mapping[str, Ranges] | None = None,
    ) -> None:
        self.create_database()
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parted = f"PARTITIONED BY (`{PART}`)" if PART in schema.names else ""
        by = ", ".join(f"`{name}`" for name in layout.distributed_by)
        buckets = f"CLUSTERED BY ({by}) INTO {layout.buckets} BUCKETS" if layout.buckets else ""
        self.spark.sql(
            f"CREATE TABLE {self.quoted} ({fields}) USING parquet "
            f"OPTIONS (compression = {_quote(layout.compression)}) {parted} {buckets} "
            f"LOCATION {_quote(path)}"
        )
        if layout.buckets or layout.distribution:
            own = {"buckets": layout.buckets, "distribution": layout.distribution}
            own["distributed_by"] = list(layout.distributed_by)
            self.set_property(LAYOUT, json.dumps(own))
        if partitioning:
            self.set_property(PARTITIONING, partitioning.to_json())
        self._set_properties({range_key(label): to_text(r) for label, r in (ranges or {}).items()})
        if parted:
            self._add({label: f"{path}/{directory_name(label.split(AT)[0])}" for label in labels})

    def create_database(self) -> None:
        database, _, _ = self.name.rpartition(".")
        if database:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")

    def drop(self) -> None:
        """Forget the table; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.quoted}")

    def drop_view(self) -> None:
        if self.spark.catalog.getTable(self.name).isTemporary:
            self.spark.catalog.dropTempView(self.name)
        else:
            self.spark.sql(f"DROP VIEW {self.quoted}")

    def set_property(self, key: str, value: str) -> None:
        self._set_properties({key: value})

    def _set_properties(self, values: Mapping[str, str]) -> None:
        ordered = sorted(values)
        for at in range(0, len(ordered), _BATCH):
            pairs = ", ".join(f"{_quote(k)} = {_quote(values[k])}" for k in ordered[at : at + _BATCH])
            self.spark.sql(f"ALTER TABLE {self.quoted} SET TBLPROPERTIES ({pairs})")

    def _unset_properties(self, keys: Iterable[str]) -> None:
        ordered = sorted(keys)
        for at in range(0, len(ordered), _BATCH):
            names = ", ".join(map(_quote, ordered[at : at + _BATCH]))
            self.spark.sql(f"ALTER TABLE {self.quoted} UNSET TBLPROPERTIES IF EXISTS ({names})")

    # -- key ranges ----------------------------------------------------------------

    def key_ranges(self) -> dict[str, Ranges]:
        """The ranges of the merge keys of each stored partition, as far as known."""
        known = self.properties().items()
        return {
            bytes.fromhex(k.removeprefix(RANGE)).decode(): from_text(v)
            for k, v in known
            if k.startswith(RANGE)
        }

    def may_hold(self, ranges: Ranges, null_keys_match: bool = True) -> set[str]:
        """Labels of the partitions, batches included, that can hold a key in these
        ranges. Those whose own ranges are not known can hold any."""
        known = self.key_ranges()
        return {
            stored.split(AT)[0]
            for stored in self.stored_labels()
            if stored not in known or may_match(known[stored], ranges, null_keys_match)
        }

    def forget_ranges(self) -> None:
        """To be called by who adds rows to partitions by other ways than a load."""
        self._unset_properties(map(range_key, self.key_ranges()))

    def point_to(self, path: str) -> None:
        """Switch a table without a partitioning to another version."""
        if self.batched():
            batches = sorted(self.stored_labels() - {FLAT})
            self.switch(Switch({FLAT: path}, batches))
        else:
            self.switch(Switch({"": path}))

    def retain_backup(self) -> None:
        """Make the current version of a table without partitions readable under the
        backup's name. Only metadata is written."""
        other = self.backup()
        other.drop()
        other.create(self.location(), self.read_parts().schema, layout=self.following(Layout()))

    def switch_partitions(
        self,
        path: str,
        written: Iterable[str],
        touched: Iterable[str],
        properties: Mapping[str, str] | None = None,
        others: Mapping[str, str] | None = None,
        ranges: Mapping[str, Ranges] | None = None,
    ) -> None:
        """Point the written partitions at a version directory. Touched
        partitions that got no rows go away, and so do batches of both. ``others``
        are partitions or batches that come to places of their own in the same switch."""
        places = {label: f"{path}/{directory_name(label)}" for label in written} | dict(others or {})
        changed = {label for label in places if AT not in label} | set(touched)
        gone = [s for s in self.stored_labels() if s.split(AT)[0] in changed and s not in places]
        texts = {label: to_text(r) for label, r in (ranges or {}).items() if label in places}
        self.switch(Switch(places, sorted(gone), dict(properties or {}), texts))

    def add_batch(
        self,
        path: str,
        labels: Iterable[str],
        batch: str,
        properties: Mapping[str, str] | None = None,
        moved: tuple[str, Iterable[str], Iterable[str]] | None = None,
        note: dict | None = None,
    ) -> None:
        """Add the rows of a version directory as a batch to its partitions, or put
        them in the place of those that came under the same name. ``moved`` is what
        ``switch_partitions`` takes, done in the same switch. With a note the journal
        stays until ``settle``."""
        name = batch_name(batch)
        places = {f"{label}{AT}{name}": f"{path}/{directory_name(label)}" for label in labels}
        gone = {s for s in self.stored_labels() if s.endswith(AT + name)}
        if moved:
            there, written, touched = moved
            places |= {label: f"{there}/{directory_name(label)}" for label in written}
            gone |= {s for s in self.stored_labels() if s.split(AT)[0] in {*written, *touched}}
        self.switch(Switch(places, sorted(gone - places.keys()), dict(properties or {}), note=note))

    def replace(
        self,
        path: str,
        schema: T.StructType,
        labels: Iterable[str],
        partitioning: Partitions | None,
        layout: Layout,
        keep_backup: bool,
        ranges: Mapping[str, Ranges] | None = None,
    ) -> None:
        """Let a new table take the place of this one, which becomes the backup or
        goes. The new one is complete before the old one is touched."""
        staged = self.beside("stg")
        staged.drop()
        staged.create(path, schema, labels, partitioning, layout, ranges)
        own = {k: v for k, v in self.properties().items() if not k.startswith(_NOT_COPIED)}
        for key in sorted(own):
            staged.set_property(key, own[key])
        self.switch(Switch(staged=staged.name, keep_backup=keep_backup))

    # -- switching -----------------------------------------------------------------

    def switch(self, change: Switch) -> None:
        """Carry out a change. More than one step goes through the journal."""
        journalled = change.steps() > 1 or change.note is not None
        if journalled:
            self._write_journal(change)
        self._carry_out(change)
        if journalled and change.note is None:
            self.settle()

    def unfinished(self) -> Switch | None:
        """The change that a writer before this one had decided on, if it may not have
        carried it out. A journal that is cut short was not decided on."""
        text = self._read_journal()
        try:
            return Switch(**json.loads(text)) if text else None
        except ValueError:
            return None

    def settle(self) -> None:
        files, path = self._journal()
        files.delete(path, False)

    def finish(self) -> Switch | None:
        """Carry out what is left in the journal; the caller settles."""
        change = self.unfinished()
        if change is not None:
            self._carry_out(change)
        return change

    def _journal(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.home}/{JOURNAL}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _write_journal(self, change: Switch) -> None:
        files, path = self._journal()
        out = files.create(path, True)
        try:
            out.write(bytearray(json.dumps(asdict(change)).encode()))
        finally:
            out.close()

    def _read_journal(self) -> str:
        files, path = self._journal()
        if not files.exists(path):
            return ""
        lines = self.spark.read.text(str(path.toString()), wholetext=True)
        return "".join(row[0] for row in lines.collect())

    def _carry_out(self, change: Switch) -> None:
        if change.staged:
            self._take_over(Table(self.spark, change.staged, ""), change.keep_backup)
            return
        if change.places.get("") is not None:
            self.spark.sql(f"ALTER TABLE {self.quoted} SET LOCATION {_quote(change.places[''])}")
        # A partitioning comes first: one that knows more partitions than the table
        # has does no harm, the other way round rows would be routed past them.
        for key, value in change.properties.items():
            self.set_property(key, value)
        if change.places or change.gone:
            # A range that is no longer known goes first, which is always safe; new ones
            # come with a journal, which the next load carries out before it reads them.
            changed = {range_key(label) for label in [*change.places, *change.gone]}
            fresh = {range_key(label): text for label, text in change.ranges.items()}
            self._unset_properties((changed - fresh.keys()) & self.properties().keys())
            self._set_properties(fresh)
        places = {label: place for label, place in change.places.items() if label}
        if places or change.gone:
            present = self.stored_labels()
            for label in sorted(places.keys() & present):
                self.spark.sql(
                    f"ALTER TABLE {self.quoted} PARTITION ({PART} = {_quote(label)}) "
                    f"SET LOCATION {_quote(places[label])}"
                )
            self._add({label: places[label] for label in places.keys() - present})
            self._remove(set(change.gone) & present)
        self.spark.catalog.refreshTable(self.name)

    def _take_over(self, staged: Table, keep_backup: bool) -> None:
        """Every order of these steps that a crash leaves can be taken up again: as
        long as the staged table stands, one of this name is the old one."""
        if not staged.exists():
            return
        if self.is_view():
            self.drop_view()
        elif self.exists() and keep_backup:
            other = self.backup()
            other.drop()
            self.spark.sql(f"ALTER TABLE {self.quoted} RENAME TO {other.quoted}")
        else:
            self.drop()
        self.spark.sql(f"ALTER TABLE {staged.quoted} RENAME TO {self.quoted}")

    def _remove(self, labels: Iterable[str]) -> None:
        ordered = sorted(labels)
        for at in range(0, len(ordered), _BATCH):
            clauses = ", ".join(
                f"PARTITION ({PART} = {_quote(label)})" for label in ordered[at : at + _BATCH]
            )
            self.spark.sql(f"ALTER TABLE {self.quoted} DROP {clauses}")

    def _add(self, places: dict[str, str]) -> None:
        ordered = sorted(places)
        for at in range(0, len(ordered), _BATCH):
            clauses = " ".join(
                f"PARTITION ({PART} = {_quote(label)}) LOCATION {_quote(places[label])}"
                for label in ordered[at : at + _BATCH]
            )
            self.spark.sql(f"ALTER TABLE {self.quoted} ADD {clauses}")
        if ordered:
            self.spark.catalog.refreshTable(self.name)

    def append(self, df: DataFrame, layout: Layout) -> Profile:
        """Add rows to the live version of a table that has no batches. Other rows
        than a batch can be seen, or stay, when the job dies while it commits."""
        seen = Observation()
        ready = arrange(df, layout).observe(seen, *profile_columns(df))
        ready.write.mode("append").insertInto(self.name)
        return Profile.of_metrics(seen.get)

    # -- statistics ----------------------------------------------------------------

    def analyze(
        self,
        labels: Iterable[str] | None = None,
        columns: bool = False,
        histograms: bool = False,
    ) -> None:
        """Refresh the optimizer's statistics: size and row count, the latter
        from file footers, of the table or of the given partitions; or a scan
        for column statistics as well, with histograms if asked. A switch has dropped
        the previous ones, so a table that has grown is never taken for a small one.
        What this costs follows the partitions that have changed."""
        if columns or histograms:
            key = "spark.sql.statistics.histogram.enabled"
            before = self.spark.conf.get(key)
            self.spark.conf.set(key, str(histograms).lower())
            try:
                self.spark.sql(f"ANALYZE TABLE {self.quoted} COMPUTE STATISTICS FOR ALL COLUMNS")
            finally:
                self.spark.conf.set(key, before)
            return
        if labels is None:
            self.spark.sql(f"ANALYZE TABLE {self.quoted} COMPUTE STATISTICS")
            return
        present, labels = self.stored_labels(), set(labels)
        chosen = sorted(s for s in present if s.split(AT)[0] in labels)
        if len(chosen) > _SINGLY and 2 * len(chosen) >= len(present):
            # All partitions in one statement and one job, which reads the footers of
            # at most twice the files.
            self._analyze_partitions(PART)
            return
        with ThreadPoolExecutor(_AT_ONCE) as pool:
            list(pool.map(lambda label: self._analyze_partitions(f"{PART} = {_quote(label)}"), chosen))

    def _analyze_partitions(self, which: str) -> None:
        self.spark.sql(f"ANALYZE TABLE {self.quoted} PARTITION ({which}) COMPUTE STATISTICS")

    def statistics(self, label: str | None = None) -> tuple[int, int | None] | None:
        """Bytes and rows of the table or of one partition, batches added, as the
        catalog has them; None where it has none."""
        if label is None:
            return self._described("Statistics", "")
        own = [s for s in self.stored_labels() if s.split(AT)[0] == label]
        found = [self._described("Partition Statistics", f"PARTITION ({PART} = {_quote(s)})") for s in own]
        if not found or None in found:
            return None
        rows = [n for _, n in found]
        return sum(size for size, _ in found), None if None in rows else sum(rows)

    def _described(self, name: str, part: str) -> tuple[int, int | None] | None:
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.quoted} {part}").filter(F.col("col_name") == name)
        found = rows.first()
        if found is None:
            return None
        sizes = dict(reversed(x.split()) for x in found["data_type"].split(", "))
        return int(sizes["bytes"]), int(sizes["rows"]) if "rows" in sizes else None

    def column_statistics(self, column: str) -> dict[str, str | None]:
        """What the catalog knows of a column: min, max, num_nulls, distinct_count,
        and the histogram's bins where there is one."""
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.quoted} `{column}`").collect()
        found: dict[str, str | None] = {}
        for row in rows:
            value = None if row["info_value"] == "NULL" else row["info_value"]
            found[row["info_name"]] = value
        return found

    # -- old versions ----------------------------------------------------------------

    def _paths_in_use(self) -> set[str]:
        tables = [t for t in (self, self.backup()) if t.exists()]
        used = {t.location() for t in tables}
        for table in tables:
            if table.batched():
                used |= {table.location(label) for label in table.stored_labels()}
        return {path.split(f"{self.home}/", 1)[-1] for path in used}

    def vacuum(self) -> list[str]:
        """Delete versions, and single partitions of versions, that neither the
        table nor its backup refers to; returns what was deleted."""
        used = self._paths_in_use()
        parted = self.batched()
        jvm = self.spark._jvm
        home = jvm.org.apache.hadoop.fs.Path(self.home)
        files = home.getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = []
        for version in files.listStatus(home) if files.exists(home) else []:
            name = version.getPath().getName()
            if not name.startswith("v_"):
                continue
            if not parted and name in used:
                continue
            if not any(path.split("/")[0] == name for path in used):
                files.delete(version.getPath(), True)
                gone.append(name)
                continue
            for part in files.listStatus(version.getPath()):
                inner = part.getPath().getName()
                if inner.startswith(f"{PART}=") and f"{name}/{inner}" not in used:
                    files.delete(part.getPath(), True)
                    gone.append(f"{name}/{inner}")
        return sorted(gone)
