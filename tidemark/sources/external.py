"""External sources: tables and files of another system, with a declared
schema, read in full or by extraction window."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.sqltypes import cast_fields, struct_of
from tidemark.operators.filters import delta_filter
from tidemark.plans.windows import DEFAULT_NODES, Window, split_predicates

# Formats by how their schema comes about.
TYPED_FORMATS = ("parquet", "orc", "avro", "jdbc")
DECLARED_FORMATS = ("csv", "json", "text")
# Timestamps without a zone stay without one.
JDBC_DEFAULTS = {"preferTimestampNTZ": "true"}
# A value that does not fit its declared type fails the load instead of becoming NULL.
STRICT_FORMATS = ("csv", "json")
STRICT = {"mode": "FAILFAST"}


@dataclass(frozen=True)
class SourceSpec:
    """``fields`` declares the columns; ``options`` go to the reader as they
    are, so credentials can come from the environment or a secret store.
    ``fmt`` is any format that Spark can read, also by an installed connector."""

    fmt: str
    fields: str
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    extraction_type: str = "FULL"
    delta_field: str | None = None
    model_target: str | None = None
    safety_period: str = "0 days"
    load_interval: str = ""
    delta_start: object = None
    node_cnt: int = DEFAULT_NODES

    def validate(self) -> SourceSpec:
        if not self.fmt:
            raise ValueError("a source needs a format")
        if self.extraction_type not in ("FULL", "DELTA"):
            raise ValueError(f"unknown extraction type {self.extraction_type!r}")
        if self.node_cnt < 1:
            raise ValueError("node_cnt must be at least 1")
        struct_of(self.fields)
        return self

    @property
    def by_window(self) -> bool:
        return self.extraction_type == "DELTA" and bool(self.delta_field)


def jdbc_predicates(source: SourceSpec, window: Window) -> list[str] | None:
    """One predicate per concurrent connection; none when the options already
    say how to partition the read."""
    if not source.by_window or "partitionColumn" in source.options:
        return None
    return split_predicates(source.delta_field, window, source.node_cnt)


def read_source(spark: SparkSession, source: SourceSpec, window: Window | None = None) -> DataFrame:
    """Lazy read of the declared columns. In windowed reads the predicate stands
    on the source's own column, where the reader can use it."""
    source.validate()
    if source.fmt == "jdbc":
        predicates = jdbc_predicates(source, window) if window else None
        if predicates:
            options = {**JDBC_DEFAULTS, **source.options}
            url, table = options.pop("url"), options.pop("dbtable")
            raw = spark.read.jdbc(url, table, predicates=predicates, properties=options)
            return cast_fields(raw, source.fields)
    defaults = JDBC_DEFAULTS if source.fmt == "jdbc" else STRICT if source.fmt in STRICT_FORMATS else {}
    given = {key.lower() for key in source.options}
    defaults = {key: value for key, value in defaults.items() if key.lower() not in given}
    reader = spark.read.format(source.fmt).options(**defaults, **source.options)
    if source.fmt in DECLARED_FORMATS:
        reader = reader.schema(struct_of(source.fields))
    raw = reader.load(source.path) if source.path else reader.load()
    if source.by_window and window:
        raw = delta_filter(raw, source.delta_field, window.lower, window.upper)
    return cast_fields(raw, source.fields)
