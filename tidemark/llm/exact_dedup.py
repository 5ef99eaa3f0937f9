"""Exact deduplication by a keyed state that lives on disk and never expires.

Rows arrive through a stream. For each digest of a text the state holds the
number of rows, the largest identifier and the locator (file and row) of the
row that carries it. A digest that was met before is a hit, and hits are decided
by the bytes: the texts are fetched by digest and compared with the text the
locator names. Rows whose digest is equal and whose text is not form groups of
their own.

Only DataFrame operations: aggregation state in RocksDB, read back through the
state data source.

Defined results: a NULL text is an empty text; a NULL identifier is smaller than
any other; of repeated rows (same text, same identifier) the one with the larger
locator stays; an empty input gives no rows. Columns besides ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, scratch, settings, small, stored, text_of, unused

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class ExactDedup:
    """``add`` takes batches of documents, ``groups`` the state so far.

    ``folder`` holds landed arrivals and state; a new object on an old folder
    continues where the last one ended.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str | None = None,
        normalise: Callable[[Column], Column] = ascii_lower,
        digest: Callable[[Column], Column] = sha256,
        reader: Callable[[list[str]], DataFrame] | None = None,
    ):
        self.spark = spark
        self.folder = folder or scratch(spark, "exact-dedup")
        self.normalise, self.digest = normalise, digest
        # How files that an earlier object had added are read again.
        self.reader = reader or (lambda files: spark.read.parquet(*files))
        self._documents: list[DataFrame] = []
        arrivals = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/arrivals")
        files = arrivals.getFileSystem(spark._jsc.hadoopConfiguration())
        self._continues = files.exists(arrivals)

    def located(self, documents: DataFrame) -> DataFrame:
        """doc_id, text (normalised), digest and locator of each row."""
        text = self.normalise(text_of())
        return documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            text.alias("text"),
            self.digest(text).alias("digest"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        )

    def add(self, documents: DataFrame) -> ExactDedup:
        """Documents must be read from files, so that locators hold."""
        self._documents.append(documents)
        self.located(documents).drop("text").write.mode("append").parquet(f"{self.folder}/arrivals")
        schema = self.spark.read.parquet(f"{self.folder}/arrivals").schema
        arrivals = self.spark.readStream.schema(schema).parquet(f"{self.folder}/arrivals")
        with settings(
            self.spark,
            spark__sql__streaming__stateStore__providerClass=ROCKSDB,
            spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true",
            spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage="true",
            spark__sql__streaming__stateStore__rocksdb__maxMemoryUsageMB="100",
            # Else each partition's store reserves some megabytes of disk, however small it is.
            spark__sql__streaming__stateStore__rocksdb__allowFAllocate="false",
        ):
            (
                arrivals.groupBy("digest")
                .agg(F.max(F.struct("doc_id", "file", "row")).alias("best"), F.count("*").alias("n"))
                .writeStream.outputMode("update")
                .format("noop")
                .option("checkpointLocation", f"{self.folder}/state")
                .trigger(availableNow=True)
                .start()
                .awaitTermination()
            )
        return self

    def arrivals(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/arrivals")

    def state(self) -> DataFrame:
        """digest, best (identifier and locator), n."""
        kept = self.spark.read.format("statestore").load(f"{self.folder}/state")
        value = kept.schema["value"].dataType.fieldNames()
        return kept.select(
            "key.digest", F.col("value").getField(value[0]).alias("best"), F.col("value").getField(value[1]).alias("n")
        )

    def members(self) -> DataFrame:
        """doc_id, digest, file, row, keep (identifier and locator of the row
        that stays), n, kept: every row that arrived, once."""
        state = stored(self.state(), "exact-state")
        hits = state.filter("n > 1").select("digest", "best")
        texts = self._texts(hits)
        suspects = texts.join(small(hits.select("digest"), 64), "digest", "left_semi")
        keepers = suspects.join(
            small(hits.select(F.col("best.file").alias("file"), F.col("best.row").alias("row")), 256),
            ["file", "row"],
            "left_semi",
        ).select("digest", F.col("text").alias("kept_text"))
        differ = stored(
            suspects.join(keepers, "digest").filter("text != kept_text").select("digest", "file", "row"),
            "exact-differ",
        )
        rows = self.arrivals()
        if differ.isEmpty():
            found = rows.join(state, "digest").withColumnRenamed("best", "keep")
        else:
            found = self._told_apart(rows, state, texts, differ.select("digest").distinct())
        at = F.struct("doc_id", "file", "row")
        return found.select("doc_id", "digest", "file", "row", "keep", "n", (at == F.col("keep")).alias("kept"))

    def _texts(self, hits: DataFrame) -> DataFrame:
        """``located`` rows of what was added here and, by the locators of the state, of
        what others had added before and has a hit."""
        own = [self.located(documents) for documents in self._documents]
        earlier = self._earlier_files(hits)
        if earlier:
            own.append(self.located(self.reader(earlier)))
        return reduce(DataFrame.unionByName, own) if own else self.arrivals().limit(0).withColumn("text", F.lit(""))

    def _earlier_files(self, hits: DataFrame) -> list[str]:
        """Files, not rows, come to the driver: those of an earlier object's documents
        that hold a row with a hit."""
        if not self._continues:
            return []
        rows = self.arrivals()
        if self._documents:
            here = reduce(DataFrame.union, [d.select("_metadata.file_path").distinct() for d in self._documents])
            rows = rows.join(here.toDF("file").distinct(), "file", "left_anti")
        rows = rows.join(small(hits.select("digest"), 64), "digest", "left_semi")
        return [unquote(r.file) for r in rows.select("file").distinct().collect()]

    @staticmethod
    def _told_apart(rows: DataFrame, state: DataFrame, texts: DataFrame, collided: DataFrame) -> DataFrame:
        """As the digests say, but for collided ones: there the text is the key."""
        plain = rows.join(collided, "digest", "left_anti").join(state, "digest")
        odd = texts.join(collided, "digest", "left_semi")
        groups = odd.groupBy("digest", "text").agg(
            F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count("*").alias("n")
        )
        told = odd.join(groups, ["digest", "text"]).select("digest", "doc_id", "file", "row", "keep", "n")
        return plain.withColumnRenamed("best", "keep").select(told.columns).unionByName(told)


def in_files(documents: DataFrame) -> DataFrame:
    """The documents if each row is one of a file's, else what they are written to."""
    try:
        documents.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return stored(documents, "exact-documents")
    return documents


def exact_groups(documents: DataFrame) -> DataFrame:
    """``ExactDedup`` over one table: doc_id, keep_id, group_size, kept, digest."""
    found = ExactDedup(documents.sparkSession).add(in_files(documents)).members()
    return found.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        "kept",
        "digest",
    )


def without_copies(documents: DataFrame) -> DataFrame:
    """The documents of which ``exact_groups`` keeps the row, all columns."""
    documents = in_files(documents)
    gone = ExactDedup(documents.sparkSession).add(documents).members().filter("NOT kept").select("file", "row")
    gone = stored(gone, "exact-gone")
    names = documents.columns
    own_file, own_row = unused(documents, "own_file", "own_row")
    marked = documents.select(
        "*", F.col("_metadata.file_path").alias(own_file), F.col("_metadata.row_index").alias(own_row)
    )
    gone = small(gone.toDF(own_file, own_row), 256)
    return marked.join(gone, [own_file, own_row], "left_anti").select(names)
