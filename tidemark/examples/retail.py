"""A retail warehouse: typed models of eight source tables, the sales view over
them and the load specs that keep their targets up to date."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sqltypes import typed_select
from tidemark.operators.partitioning import ExpressionPartitions, RangePartitions
from tidemark.plans.spec import Layout, LoadSpec
from tidemark.sources.external import SourceSpec

# Columns and declared types of the external tables.
EXTERNAL_FIELDS = {
    "nation": "n_nationkey int4, n_name text, n_regionkey int4, n_comment text",
    "region": "r_regionkey int4, r_name text, r_comment text",
    "supplier": "s_suppkey int4, s_nationkey int4, s_comment text, s_name text, s_address text, "
    "s_phone text, s_acctbal numeric",
    "part": "p_partkey int8, p_type text, p_size int4, p_brand text, p_name text, "
    "p_container text, p_mfgr text, p_retailprice numeric, p_comment text",
    "customer": "c_custkey int8, c_mktsegment text, c_nationkey int4, c_name text, "
    "c_address text, c_phone text, c_acctbal numeric, c_comment text, c_modifiedts timestamp",
    "partsupp": "ps_partkey int8, ps_suppkey int4, ps_supplycost numeric, ps_availqty int4, "
    "ps_comment text, ps_modifiedts timestamp",
    "orders": "o_orderkey int4, o_custkey int4, o_orderstatus text, o_totalprice float4, "
    "o_orderdate date, o_orderpriority text, o_clerk text, o_shippriority int4, o_comment text",
    "lineitem": "l_shipdate date, l_orderkey int8, l_discount numeric, l_extendedprice numeric, "
    "l_suppkey int4, l_quantity int8, l_returnflag text, l_partkey int8, l_linestatus text, "
    "l_tax numeric, l_commitdate date, l_receiptdate date, l_shipmode text, l_linenumber int8, "
    "l_shipinstruct text, l_comment text",
    "sales_monthly": "orderkey Nullable(Int64), linenumber Nullable(UInt64), "
    "partkey Nullable(Int64), suppkey Nullable(Int32), receiptdate Nullable(Date32), "
    "orderdate Nullable(Date32), orderstatus Nullable(String), address Nullable(String), "
    "line_comment Nullable(String), returnflag Nullable(String), "
    "order_comment Nullable(String), orderpriority Nullable(String), "
    "shipmode Nullable(String), quantity Nullable(Decimal(18, 2)), "
    "discount Nullable(Decimal(5, 2)), load_timestamp Nullable(DateTime)",
    "customer_text": "customer String, txtmd Nullable(String), tmstmp DateTime",
}

# Target columns, the source column of each and its type.
TYPED_COLUMNS = {
    "nation": {
        "nationkey": ("n_nationkey", "int4"),
        "name": ("n_name", "bpchar(25)"),
        "regionkey": ("n_regionkey", "int4"),
        "comment": ("n_comment", "text"),
    },
    "region": {
        "regionkey": ("r_regionkey", "int4"),
        "name": ("r_name", "bpchar(25)"),
        "comment": ("r_comment", "text"),
    },
    "supplier": {
        "suppkey": ("s_suppkey", "int4"),
        "nationkey": ("s_nationkey", "int4"),
        "comment": ("s_comment", "text"),
        "name": ("s_name", "bpchar(25)"),
        "address": ("s_address", "varchar(40)"),
        "phone": ("s_phone", "bpchar(15)"),
        "acctbal": ("s_acctbal", "numeric(19,4)"),
    },
    "part": {
        "partkey": ("p_partkey", "int8"),
        "type": ("p_type", "varchar(25)"),
        "size": ("p_size", "int4"),
        "brand": ("p_brand", "bpchar(10)"),
        "name": ("p_name", "varchar(55)"),
        "container": ("p_container", "bpchar(10)"),
        "mfgr": ("p_mfgr", "bpchar(25)"),
        "retailprice": ("p_retailprice", "numeric(19,4)"),
        "comment": ("p_comment", "text"),
    },
    "customer": {
        "custkey": ("c_custkey", "int8"),
        "mktsegment": ("c_mktsegment", "varchar(10)"),
        "nationkey": ("c_nationkey", "int4"),
        "name": ("c_name", "varchar(25)"),
        "address": ("c_address", "varchar(40)"),
        "phone": ("c_phone", "varchar(15)"),
        "acctbal": ("c_acctbal", "numeric(19,4)"),
        "comment": ("c_comment", "text"),
        "modifiedts": ("c_modifiedts", "timestamp"),
    },
    "partsupp": {
        "partkey": ("ps_partkey", "int8"),
        "suppkey": ("ps_suppkey", "int4"),
        "supplycost": ("ps_supplycost", "numeric(19,4)"),
        "availqty": ("ps_availqty", "int4"),
        "comment": ("ps_comment", "text"),
        "modifiedts": ("ps_modifiedts", "timestamp"),
    },
    "orders": {
        "orderkey": ("o_orderkey", "int4"),
        "custkey": ("o_custkey", "int4"),
        "orderstatus": ("o_orderstatus", "varchar(50)"),
        "totalprice": ("o_totalprice", "float4"),
        "orderdate": ("o_orderdate", "date"),
        "orderpriority": ("o_orderpriority", "varchar(50)"),
        "clerk": ("o_clerk", "varchar(50)"),
        "shippriority": ("o_shippriority", "int4"),
        "comment": ("o_comment", "text"),
    },
    "lineitem": {
        "shipdate": ("l_shipdate", "date"),
        "orderkey": ("l_orderkey", "int8"),
        "discount": ("l_discount", "numeric(19,4)"),
        "extendedprice": ("l_extendedprice", "numeric(19,4)"),
        "suppkey": ("l_suppkey", "int4"),
        "quantity": ("l_quantity", "int8"),
        "returnflag": ("l_returnflag", "bpchar(1)"),
        "partkey": ("l_partkey", "int8"),
        "linestatus": ("l_linestatus", "bpchar(1)"),
        "tax": ("l_tax", "numeric(19,4)"),
        "commitdate": ("l_commitdate", "date"),
        "receiptdate": ("l_receiptdate", "date"),
        "shipmode": ("l_shipmode", "bpchar(10)"),
        "linenumber": ("l_linenumber", "int8"),
        "shipinstruct": ("l_shipinstruct", "bpchar(25)"),
        "comment": ("l_comment", "text"),
    },
}

# Grain of the sales view, by the table each column comes from.
SALES_GRAIN = {
    "lineitem": {
        "orderkey": "orderkey",
        "linenumber": "linenumber",
        "partkey": "partkey",
        "suppkey": "suppkey",
        "receiptdate": "receiptdate",
        "line_comment": "comment",
        "returnflag": "returnflag",
        "shipmode": "shipmode",
    },
    "orders": {
        "orderdate": "orderdate",
        "orderstatus": "orderstatus",
        "order_comment": "comment",
        "orderpriority": "orderpriority",
    },
    "customer": {"address": "address"},
}


def typed(df: DataFrame, table: str) -> DataFrame:
    return typed_select(df, TYPED_COLUMNS[table])


def sales_rows(
    orders: DataFrame, lineitem: DataFrame, customer: DataFrame, grain: dict[str, dict[str, str]]
) -> DataFrame:
    """Order lines with their order's and customer's attributes, summed at the
    given grain.

    The order joins its customer before the lines come in: lines are by far the
    most rows, and this way they are shuffled once, by order key. With the order
    key in the grain the aggregation needs no shuffle of its own.
    """
    taken = {
        "orders": [F.col(src).alias(f"o_{out}") for out, src in grain["orders"].items()],
        "customer": [F.col(src).alias(f"c_{out}") for out, src in grain["customer"].items()],
    }
    heads = orders.select(F.col("orderkey").alias("k_order"), "custkey", *taken["orders"]).join(
        customer.select(F.col("custkey").alias("k_customer"), *taken["customer"]),
        F.col("custkey") == F.col("k_customer"),
    )
    lines = heads.join(lineitem, F.col("k_order") == F.col("orderkey"))
    keys = [F.col(src).alias(out) for out, src in grain["lineitem"].items()]
    keys += [F.col(f"o_{out}").alias(out) for out in grain["orders"]]
    keys += [F.col(f"c_{out}").alias(out) for out in grain["customer"]]
    return lines.groupBy(*keys).agg(
        F.sum("quantity").alias("quantity"), F.sum("discount").alias("discount")
    )


def sales_view(orders: DataFrame, lineitem: DataFrame, customer: DataFrame) -> DataFrame:
    return sales_rows(orders, lineitem, customer, SALES_GRAIN)


def stamped(rows: DataFrame, now: datetime) -> DataFrame:
    """Sales rows with the time of their load, which the run hands in so that
    every task writes the same one."""
    return rows.withColumn("load_timestamp", F.lit(str(now)).cast("timestamp_ntz"))


# -- sources ---------------------------------------------------------------------------


def external_source(table: str, fmt: str, path: str | None = None, **options) -> SourceSpec:
    """Dimensions without a change date are read in full, the others by
    window."""
    # Change date, target, interval and safety period of each table.
    by_window = {
        "customer": ("c_modifiedts", "customer", "", "0 days"),
        "partsupp": ("ps_modifiedts", "partsupp", "1 day", "0 days"),
        "orders": ("o_orderdate", "orders", "1 mon", "0 days"),
        "lineitem": ("l_receiptdate", "lineitem", "1 mon", "0 days"),
    }
    common = {"fmt": fmt, "fields": EXTERNAL_FIELDS[table], "path": path, "options": options}
    if table not in by_window:
        return SourceSpec(**common)
    delta_field, target, interval, safety = by_window[table]
    return SourceSpec(
        **common,
        extraction_type="DELTA",
        delta_field=delta_field,
        model_target=target,
        load_interval=interval,
        safety_period=safety,
    )


# Key of the ledger.
LEDGER_KEYS = [
    "ac_doc_ln",
    "ac_doc_nr",
    "ac_ledger",
    "comp_code",
    "fiscper",
    "fiscvarnt",
    "fiscvrnt_e",
    "rectype",
    "version",
]


# -- targets -----------------------------------------------------------------------------


def _ranges(key: str, first_year: int) -> RangePartitions:
    # Years, and months of the running year.
    return RangePartitions.of(
        key,
        (f"{first_year}-01-01", "2023-01-01", "1 year"),
        ("2023-01-01", "2023-08-01", "1 mon"),
    )


def _layout(*columns: str) -> Layout:
    return Layout(distributed_by=columns, compression="zstd", compression_level=1)


# Strategies, keys and layouts of the example tables.
LOADS = {
    "nation": LoadSpec("nation", "full"),
    "region": LoadSpec("region", "full"),
    "supplier": LoadSpec("supplier", "full", layout=_layout("suppkey")),
    "part": LoadSpec("part", "full", layout=_layout("partkey")),
    "customer": LoadSpec(
        "customer", "delta_upsert", ["custkey"], "modifiedts", layout=_layout("custkey")
    ),
    "partsupp": LoadSpec(
        "partsupp",
        "delta_merge",
        ["partkey", "suppkey"],
        "modifiedts",
        layout=_layout("partkey", "suppkey"),
    ),
    "orders": LoadSpec(
        "orders",
        "partitions",
        delta_field="orderdate",
        partitioning=_ranges("orderdate", 2018),
        merge_partitions=False,
        layout=_layout("orderkey"),
    ),
    "lineitem": LoadSpec(
        "lineitem",
        "partitions",
        delta_field="receiptdate",
        partitioning=_ranges("receiptdate", 2020),
        merge_partitions=False,
        layout=_layout("orderkey"),
    ),
    "sales": LoadSpec(
        "sales",
        "partitions",
        ["orderkey", "linenumber"],
        "receiptdate",
        partitioning=_ranges("orderdate", 2018),
        load_interval="1 mon",
        add_delta=False,
        layout=_layout("orderkey"),
    ),
    "sales_monthly": LoadSpec(
        "sales_monthly",
        "partitions",
        ["orderkey", "linenumber"],
        "receiptdate",
        partitioning=ExpressionPartitions.monthly("orderdate"),
        add_delta=False,
        dedup_scope="changed",
        layout=Layout(order_by=("orderkey", "linenumber")),
    ),
    "customer_text": LoadSpec(
        "customer_text",
        "delta_upsert",
        ["customer"],
        "tmstmp",
        null_keys_match=False,
        layout=Layout(order_by=("tmstmp",)),
    ),
    "customer_text_full": LoadSpec("customer_text_full", "full", keep_backup=False),
    "ledger_lines": LoadSpec(
        "ledger_lines",
        "partitions",
        LEDGER_KEYS,
        "tmstmp",
        partitioning=ExpressionPartitions.monthly("pstng_date"),
        merge_partitions=False,
        layout=Layout(order_by=tuple(LEDGER_KEYS)),
    ),
}
