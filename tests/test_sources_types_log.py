import uuid
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import LoadLog, LoadRun, SourceSpec, log_table_name, read_source
from tidemark.functions.sqltypes import SqlType, align, cast_fields, parse_fields, struct_of
from tidemark.operators.filters import delta_filter
from tidemark.plans.loadlog import LOG_FIELDS, missing_columns
from tidemark.plans.windows import Window
from tidemark.sources.external import jdbc_predicates

FIELDS = "id int8, name varchar(3) NULL, amount numeric(10,2) NOT NULL, changed timestamp"


# -- types ------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, spark_type",
    [
        ("int8", "bigint"),
        ("Int64", "bigint"),
        ("UInt64", "decimal(20,0)"),
        ("Nullable(Int32)", "int"),
        ("float4", "float"),
        ("numeric", "decimal(38,10)"),
        ("numeric(19, 4)", "decimal(19,4)"),
        ("numeric(5)", "decimal(5,0)"),
        ("Nullable(Decimal(18,\n 2))", "decimal(18,2)"),
        ("varchar(40)", "string"),
        ("bpchar(1)", "string"),
        ("text", "string"),
        ("Date32", "date"),
        ("timestamp", "timestamp_ntz"),
        ("DateTime", "timestamp_ntz"),
    ],
)
def test_type_names(text, spark_type):
    assert SqlType(text).spark.simpleString() == spark_type


@pytest.mark.parametrize("bad", ["money", "int8(3,4)", "numeric(", "", "varchar(a)"])
def test_unknown_types(bad):
    with pytest.raises(ValueError):
        SqlType(bad)


def test_character_casts(spark):
    df = spark.createDataFrame([("ab",), ("abcdef",), ("a  ",), (None,)], "s string")
    out = df.select(
        SqlType("varchar(4)").cast(F.col("s")).alias("v"),
        SqlType("bpchar(4)").cast(F.col("s")).alias("trimmed"),
        SqlType("bpchar(4)").cast(F.col("s"), pad_char=True).alias("padded"),
    ).collect()
    assert [tuple(r) for r in out] == [
        ("ab", "ab", "ab  "),
        ("abcd", "abcd", "abcd"),
        ("a  ", "a", "a   "),
        (None, None, None),
    ]


def test_fields(spark):
    assert [(n, null) for n, _, null in parse_fields(FIELDS)] == [
        ("id", True),
        ("name", True),
        ("amount", False),
        ("changed", True),
    ]
    assert struct_of(FIELDS).simpleString() == (
        "struct<id:bigint,name:string,amount:decimal(10,2),changed:timestamp_ntz>"
    )
    for bad in ("", "id", "id NULL", "id int8 or so"):
        with pytest.raises(ValueError):
            parse_fields(bad)


def test_overflow_raises(spark):
    df = spark.createDataFrame([(99999999999,)], "id long")
    with pytest.raises(Exception, match="OVERFLOW"):
        cast_fields(df, "id int4").collect()


def test_align_by_name_in_target_order(spark):
    target = struct_of("b int8, a text")
    delta = spark.createDataFrame([("x", 1, 2)], "A string, b int, c int")
    out = align(delta, target)
    assert out.schema.simpleString() == "struct<b:bigint,a:string>"
    assert tuple(out.first()) == (1, "x")


# -- filters ------------------------------------------------------------------------------


def test_date_columns_compare_as_midnight(spark):
    df = spark.createDataFrame([(date(2024, 1, d),) for d in range(1, 6)], "d date")

    def found(lower, upper, **more):
        return [r.d.day for r in delta_filter(df, "d", lower, upper, **more).collect()]

    assert found(datetime(2024, 1, 2), datetime(2024, 1, 4)) == [2, 3, 4]
    assert found(datetime(2024, 1, 2, 1), datetime(2024, 1, 4, 23)) == [3, 4]
    assert found(datetime(2024, 1, 2), datetime(2024, 1, 4), lower_exclusive=True) == [3, 4]


# -- sources ------------------------------------------------------------------------------


@pytest.fixture
def csv_path(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(
        "1,abcdef,1.005,2024-01-01 00:00:00\n"
        "2,b,2.50,2024-01-02 12:00:00\n"
        "3,c,3.00,2024-01-03 00:00:00\n"
    )
    return str(path)


def test_csv_full_and_by_window(spark, csv_path):
    full = SourceSpec("csv", FIELDS, csv_path)
    rows = read_source(spark, full).collect()
    assert rows[1].name == "b" and rows[1].amount == Decimal("2.50") and rows[0].name == "abc"
    delta = SourceSpec("csv", FIELDS, csv_path, extraction_type="DELTA", delta_field="changed")
    window = Window(datetime(2024, 1, 2), datetime(2024, 1, 3))
    assert [r.id for r in read_source(spark, delta, window).collect()] == [2, 3]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_file_formats_by_window(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    rows = [(i, f"n{i}", datetime(2024, 1, i)) for i in range(1, 10)]
    data = spark.createDataFrame(rows, "id int, name string, changed timestamp_ntz")
    data.write.format(fmt).save(path)
    source = SourceSpec(
        fmt,
        "id int8, changed timestamp",
        path,
        extraction_type="DELTA",
        delta_field="changed",
    )
    df = read_source(spark, source, Window(datetime(2024, 1, 3), datetime(2024, 1, 5)))
    assert df.schema.simpleString() == "struct<id:bigint,changed:timestamp_ntz>"
    assert sorted(r.id for r in df.collect()) == [3, 4, 5]


def test_invalid_sources():
    for bad in (
        SourceSpec("", FIELDS),
        SourceSpec("csv", FIELDS, extraction_type="SOME"),
        SourceSpec("csv", FIELDS, node_cnt=0),
        SourceSpec("csv", "id thing"),
    ):
        with pytest.raises(ValueError):
            bad.validate()


def test_jdbc_predicates():
    source = SourceSpec(
        "jdbc",
        FIELDS,
        options={"url": "jdbc:x", "dbtable": "t"},
        extraction_type="DELTA",
        delta_field="changed",
        node_cnt=4,
    )
    window = Window(datetime(2024, 1, 1), datetime(2024, 1, 9))
    predicates = jdbc_predicates(source, window)
    assert len(predicates) == 4
    assert predicates[1] == (
        "changed >= TIMESTAMP '2024-01-03 00:00:00' AND changed < TIMESTAMP '2024-01-05 00:00:00'"
    )
    own = SourceSpec(
        "jdbc",
        FIELDS,
        options={"partitionColumn": "id"},
        extraction_type="DELTA",
        delta_field="changed",
    )
    assert jdbc_predicates(own, window) is None
    assert jdbc_predicates(SourceSpec("jdbc", FIELDS), window) is None


# -- the log --------------------------------------------------------------------------------


@pytest.fixture
def log(spark, tmp_path):
    moments = iter(datetime(2024, 1, 1, h, m) for h in range(24) for m in range(60))
    out = LoadLog(spark, str(tmp_path), f"log_{uuid.uuid4().hex[:10]}", lambda: next(moments))
    assert out.create_or_verify() == []
    assert out.create_or_verify() == []
    return out


W1 = Window(datetime(2023, 1, 1), datetime(2023, 2, 1))


def test_log_columns(spark, tmp_path):
    name = f"old_{uuid.uuid4().hex[:10]}"
    old = [f for f in LOG_FIELDS.fieldNames() if f not in ("load_method", "model_sql")]
    spark.sql(f"CREATE TABLE {name} ({', '.join(f.upper() + ' string' for f in old)}) USING parquet")
    stale = LoadLog(spark, str(tmp_path), name)
    assert stale.create_or_verify() == ["model_sql", "load_method", "entry_id", "event_no"]
    spark.sql(f"DROP TABLE {name}")
    assert missing_columns(LOG_FIELDS.fieldNames()) == []


def test_open_complete_and_marks(log):
    log.open("run1", "obj", W1, "jdbc", "DELTA", "changed")
    window, column = log.open_window("run1", "obj")
    assert (window, column) == (W1, "changed")
    assert log.open_window("run2", "obj") is None
    assert log.last_extraction("obj") is None
    log.complete("run1", "obj", "delta", 5, datetime(2023, 1, 20), "changed", "SELECT 'x'")
    (row,) = log.entries().collect()
    assert (row.status, row.row_cnt, row.load_type) == (2, 5, "delta")
    assert row.extraction_to == datetime(2023, 1, 20)
    assert row.extraction_to_original == W1.upper and row.extraction_from == W1.lower
    assert row.load_method == "jdbc" and row.model_sql == "SELECT 'x'"
    assert row.created_at < row.updated_at
    assert log.open_window("run1", "obj") is None
    log.complete("run2", "obj", "delta", 0, None, "changed")
    assert log.last_extraction("obj") == datetime(2023, 1, 20)
    log.insert_done("run3", "other", "full", 3)
    assert log.last_extraction("other") == log.entries().filter("object_name = 'other'").first().extraction_to


def test_complete_changes_every_entry_of_the_run(log):
    log.open("run1", "obj", W1)
    log.open("run1", "obj", W1)
    log.open("run1", "else", W1)
    log.complete("run1", "obj", "delta", 7, date(2023, 1, 2), "changed")
    rows = log.entries().collect()
    assert sorted((r.object_name, r.status, r.row_cnt) for r in rows) == [
        ("else", 1, None),
        ("obj", 2, 7),
        ("obj", 2, 7),
    ]


def test_clear(log):
    for i in range(3):
        log.insert_done(f"run{i}", "obj", "full", i)
    log.insert_done("run", "else", "full", 9)
    rows = log.entries().filter("object_name = 'obj'").orderBy("created_at").collect()
    assert log.clear("obj", rows[1].created_at) == 2
    assert log.entries().filter("object_name = 'obj'").first().row_cnt == 0
    assert log.clear("nobody") == 0
    assert log.clear("obj") == 1
    assert [r.object_name for r in log.entries().collect()] == ["else"]
    log.insert_done("again", "obj", "full", 4)
    assert log.entries().count() == 2


def test_log_table_name():
    config = {"default": {"schema": "meta", "table": "loads"}, "prod": {"schema": "audit"}}
    assert log_table_name(config, "prod") == "audit.loads"
    assert log_table_name(config, "dev") == "meta.loads"
    assert log_table_name({}, "dev", "mart") == "mart.load_info"
    assert log_table_name({}, "dev") == "etl.load_info"


def test_external_logs_its_window_for_the_target(spark, log, tmp_path, csv_path):
    source = SourceSpec(
        "csv",
        FIELDS,
        csv_path,
        extraction_type="DELTA",
        delta_field="changed",
        model_target="obj",
        delta_start="2024-01-02",
    )
    log.clock = lambda: datetime(2024, 2, 1)
    run = LoadRun(spark, str(tmp_path), log)
    assert run.external(source).count() == 2
    (row,) = log.entries().collect()
    assert (row.load_method, row.extraction_type, row.delta_field) == ("csv", "DELTA", "changed")
    assert (row.extraction_from, row.extraction_to) == (datetime(2024, 1, 2), datetime(2024, 2, 1))
