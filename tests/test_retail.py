"""The example warehouse from sources to sales, on a few rows."""

import uuid
from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import LoadLog, LoadRun
from tidemark.examples import retail
from tidemark.functions.sqltypes import struct_of
from tidemark.operators.partitioning import PART


def day(text):
    return date.fromisoformat(text)


def money(text):
    return Decimal(text)


ROWS = {
    "nation": [(1, "ALGERIA", 0, "n")],
    "region": [(0, "AFRICA", "r")],
    "supplier": [(1, 1, "s", "Supplier#1", "street", "1-1", money("1.5"))],
    "part": [(1, "TIN", 3, "Brand#1", "ring", "BOX", "M#1", money("9.99"), "p")],
    "customer": [
        (1, "BUILDING", 1, "Customer#1", "here", "1-1", money("5"), "c", datetime(2023, 1, 1)),
        (2, "MACHINERY", 1, "Customer#2", "there", "1-2", money("6"), "c", datetime(2023, 2, 1)),
    ],
    "partsupp": [(1, 1, money("3.5"), 7, "ps", datetime(2023, 1, 5))],
    "orders": [
        (1, 1, "O", 10.5, day("2019-05-01"), "1-URGENT", "clerk", 0, "o1"),
        (2, 2, "F", 20.5, day("2023-07-15"), "5-LOW", "clerk", 0, "o2"),
    ],
}


def line(order, number, receipt, quantity):
    receipt = day(receipt)
    price = money("100")
    return (
        receipt, order, money("0.05"), price, 1, quantity, "N", 1, "O", money("0.01"),
        receipt, receipt, "AIR", number, "NONE", f"line {number}",
    )


ROWS["lineitem"] = [line(1, 1, "2020-01-10", 4), line(2, 1, "2023-07-20", 6)]


class Shop:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.tag = f"shop_{uuid.uuid4().hex[:8]}"
        self.now = datetime(2023, 8, 15)
        self.log = LoadLog(spark, f"{root}/lake", f"{self.tag}_log", clock=lambda: self.now)
        self.rows = {name: list(rows) for name, rows in ROWS.items()}

    def source(self, name):
        """The external table as a parquet folder of its current rows."""
        path = f"{self.root}/src/{name}_{uuid.uuid4().hex[:8]}"
        fields = struct_of(retail.EXTERNAL_FIELDS[name])
        self.spark.createDataFrame(self.rows[name], fields).write.parquet(path)
        spec = retail.external_source(name, "parquet", path)
        return replace(spec, model_target=spec.model_target and self.target(spec.model_target))

    def target(self, name):
        return f"{self.tag}_{name}"

    def spec(self, name):
        return replace(retail.LOADS[name], name=self.target(name))

    def table(self, run, name):
        return run.table(self.target(name)).read()

    def load_all(self, names):
        run = LoadRun(self.spark, f"{self.root}/lake", self.log)
        for name in names:
            external = run.external(self.source(name))
            run.load(self.spec(name), retail.typed(external, name))
        sales = retail.sales_view(
            self.table(run, "orders"), self.table(run, "lineitem"), self.table(run, "customer")
        )
        spec = self.spec("sales")
        model = run.filter_delta(retail.stamped(sales, self.now), spec, "receiptdate", True)
        run.load(spec, model)
        return run


@pytest.fixture
def shop(spark, tmp_path):
    return Shop(spark, str(tmp_path))


def sales_of(shop, run):
    rows = run.table(shop.target("sales")).read_parts().collect()
    return sorted((r[PART], r.orderkey, r.linenumber, int(r.quantity), r.orderstatus) for r in rows)


def test_warehouse_from_first_load_to_update(shop):
    run = shop.load_all(list(ROWS))
    assert sales_of(shop, run) == [("2019-01-01", 1, 1, 4, "O"), ("2023-07-01", 2, 1, 6, "F")]
    assert shop.table(run, "nation").first().name == "ALGERIA"
    assert shop.table(run, "partsupp").first().supplycost == money("3.5")
    assert shop.table(run, "part").first().retailprice == money("9.99")

    # A month later: a new order with two lines, a changed line, a moved customer.
    shop.now = datetime(2023, 9, 20)
    shop.rows["orders"] += [(3, 2, "O", 30.5, day("2023-09-02"), "5-LOW", "clerk", 0, "o3")]
    shop.rows["lineitem"] = [
        line(1, 1, "2020-01-10", 4),
        line(2, 1, "2023-07-20", 7),
        line(3, 1, "2023-09-05", 1),
        line(3, 2, "2023-09-06", 2),
    ]
    moved = shop.rows["customer"][1]
    shop.rows["customer"][1] = (*moved[:4], "elsewhere", *moved[5:8], datetime(2023, 9, 1))
    shop.rows["partsupp"] = [(1, 1, money("4.5"), 7, "ps", datetime(2023, 9, 5))]
    run = shop.load_all(["nation", "customer", "partsupp", "orders", "lineitem"])
    assert sales_of(shop, run) == [
        ("2019-01-01", 1, 1, 4, "O"),
        ("2023-07-01", 2, 1, 7, "F"),
        ("2023-09-01", 3, 1, 1, "O"),
        ("2023-09-01", 3, 2, 2, "O"),
    ]
    assert shop.table(run, "partsupp").first().supplycost == money("4.5")
    addresses = {r.custkey: r.address for r in shop.table(run, "customer").collect()}
    assert addresses == {1: "here", 2: "elsewhere"}
    names = [p.name for p in run.table(shop.target("sales")).partitioning().ranges()]
    assert names[-2:] == ["m_08_2023", "m_09_2023"]
    stamps = run.table(shop.target("sales")).read().filter("orderkey = 3")
    assert {r.load_timestamp for r in stamps.collect()} == {shop.now}


def test_declared_columns_cover_the_models(spark):
    for name, columns in retail.TYPED_COLUMNS.items():
        declared = set(struct_of(retail.EXTERNAL_FIELDS[name]).fieldNames())
        assert {source for source, _ in columns.values()} == declared
    assert len(struct_of(retail.EXTERNAL_FIELDS["sales_monthly"])) == 16
    for spec in retail.LOADS.values():
        spec.validate()


def test_monthly_sales_and_texts(shop):
    run = LoadRun(shop.spark, f"{shop.root}/lake", shop.log)
    spec = shop.spec("customer_text")
    fields = struct_of(retail.EXTERNAL_FIELDS["customer_text"])

    def texts(*rows):
        return shop.spark.createDataFrame(rows, fields)

    run.load(spec, texts(("a", "old", datetime(2023, 1, 1)), ("b", None, datetime(2023, 1, 2))))
    run.load(spec, texts(("a", "new", datetime(2023, 1, 3)), ("c", "c", datetime(2022, 1, 1))))
    found = {r.customer: r.txtmd for r in run.table(spec.name).read().collect()}
    assert found == {"a": "new", "b": None}

    columns = struct_of(retail.EXTERNAL_FIELDS["sales_monthly"])
    spec = shop.spec("sales_monthly")

    def sales(*rows):
        data = [
            (key, Decimal(number), 1, 1, day(on), day(on), "O", "a", "l", "N", "o", "p", "AIR",
             Decimal(quantity), Decimal("0.1"), shop.now)
            for key, number, on, quantity in rows
        ]
        return shop.spark.createDataFrame(data, columns)

    run.load(spec, sales((1, 1, "2023-01-05", 1), (1, 2, "2023-01-06", 2), (2, 1, "2023-02-01", 3)))
    run.load(spec, sales((1, 2, "2023-02-03", 9), (3, 1, "2023-01-07", 4)))
    rows = run.table(spec.name).read_parts().collect()
    assert sorted((r[PART], r.orderkey, int(r.quantity)) for r in rows) == [
        ("202301", 1, 1),
        ("202301", 3, 4),
        ("202302", 1, 9),
        ("202302", 2, 3),
    ]


def test_ledger_lines_overwrite_by_month(shop):
    spec = replace(shop.spec("ledger_lines"), add_delta=False)
    run = LoadRun(shop.spark, f"{shop.root}/lake", shop.log)
    keys = ", ".join(f"{k} string" for k in retail.LEDGER_KEYS)

    def ledger(*rows):
        data = [(*[str(n)] * 9, day(on), datetime(2023, 1, 1)) for n, on in rows]
        return shop.spark.createDataFrame(data, f"{keys}, pstng_date date, tmstmp timestamp_ntz")

    run.load(spec, ledger((1, "2023-01-01"), (2, "2023-02-01"), (3, "2023-02-02")))
    run.load(spec, ledger((4, "2023-02-05")))
    rows = run.table(spec.name).read().select(F.col("version")).collect()
    assert sorted(r.version for r in rows) == ["1", "4"]
