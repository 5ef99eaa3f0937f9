"""The pipeline on whole small tables, stage by stage."""

import pytest

import corpus_pipeline
from tidemark.llm.common import stored

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    outputs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        outputs.append(stored(stage(spark, outputs[-1], SF_DIR), f"test-{name}"))
    return outputs


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_and_rows(stages):
    docs, clean, distinct, apart, cut, packed = stages
    for df in (clean, distinct, apart, cut):
        assert df.schema == docs.schema or df.columns == docs.columns
    assert texts(clean).items() <= texts(docs).items()
    assert texts(distinct).items() <= texts(clean).items()
    assert texts(apart).items() <= texts(distinct).items()
    assert texts(cut).keys() == texts(apart).keys()
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == texts(cut).keys()


def test_copies(stages):
    _, clean, distinct, *_ = stages
    groups = {}
    for doc_id, text in texts(clean).items():
        groups[text.lower()] = max(doc_id, groups.get(text.lower(), -1))
    assert texts(distinct).keys() == set(groups.values())


def test_near_copies(stages):
    _, _, distinct, apart, *_ = stages
    rows = texts(distinct)
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in rows.items() if (w := t.lower().split())}
    ids = sorted(sets)
    alike = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (s := sets[a] | sets[b]) and len(sets[a] & sets[b]) / len(s) >= 0.8]
    gone = rows.keys() - texts(apart).keys()
    assert gone == {b for _, b in alike} - {a for a, b in alike if a not in {y for _, y in alike}}


def test_run_gives_the_last_stage(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = sorted(corpus_pipeline.run(spark, SF_DIR).select(columns).collect())
    assert got == sorted(stages[-1].select(columns).collect())


ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, None), (5, "Same text."), (5, "Same text."), (6, "SAME text."),
    (None, "no identifier at all"), (None, "no identifier at all"), (7, "ÄÖ é 日本 🙂"),
    (8, " ".join(f"w{i % 977}x{i}" for i in range(30_000))), (9, "word"),
    (10, " ".join(f"p{i}" for i in range(30)) + " tail"), (11, " ".join(f"h{i}" for i in range(60)) + " " + " ".join(f"p{i}" for i in range(30))),
]


def test_odd_rows_pass_every_stage(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    docs = docs.select("*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").alias("n_chars"))
    docs = stored(docs.withColumns({"own_id": F.lit(1), "places": F.lit("x"), "gone_hash": F.lit(2)}), "odd")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stored(stage(spark, kept, SF_DIR), f"odd-{name}")
        assert kept.columns == docs.columns
        assert {(r.own_id, r.places, r.gone_hash) for r in kept.collect()} == {(1, "x", 2)}
    rows = {r.doc_id: r.text for r in kept.collect()}
    assert kept.count() == len(rows)
    assert len(rows[8].split()) == 30_000 and rows[7] == "ÄÖ é 日本 🙂"
    assert rows[11].split() == [f"h{i}" for i in range(60)] and rows[10].endswith("tail")
    assert rows[6] == "SAME text." and 5 not in rows
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR)
    assert {r.doc_id for r in packed.collect()} == rows.keys()


def test_empty_table_passes_every_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), f"empty-{name}")
        assert docs.count() == 0
