"""Line dedup over levelled sorted runs (operator 11), in built-in expressions only.

A line's key is the line without white space at both ends, A-Z lower-cased. Keys of ``least_chars`` code points
or more that stand in ``least_docs`` documents or more lose all their lines but those of the largest id.

Documents come in batches of falling ids. A run holds, for each key that a batch brought, the largest id and the
number of documents, sorted by hash and bucketed, so that runs of any level meet each other and the next
batch by merging, without a shuffle of what is stored:

* a batch is reduced to one row per key (twice grouped, so that a line of every document is counted by
  partial sums) and merge-anti-joins the keys of the runs that are decided already. As ids fall from batch
  to batch, the largest holder of a decided key can't change, and such a line adds nothing more;
* what is left becomes the batch's own run on level 0;
* ``FANOUT`` runs of a level are compacted into one of the next: largest id, sum of counts.

At last the runs are put together, the decided keys meet the lines, and the positions to drop go to their documents.
A kept text is put together from the stretches between the dropped lines.

Defined cases: a null or empty text is one empty line; rows with one id are one document, each row with its own
text; the null id is smaller than all others and one document; lines that repeat in one document count once, and are
all kept or all dropped; other columns do not matter; an empty table gives no rows; a text that loses all
lines is empty. Ids are whole numbers, because batches are cut at their quantiles. Keys are compared by two 64-bit
hashes with different seeds.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .frames import id_and_text, settle
from .quality import let

LEAST_CHARS, LEAST_DOCS = 20, 3
#: Batches of one call, and runs of a level that are compacted into one.
BATCHES, FANOUT = 8, 4
# fixed values: white space and letters of a key
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def lowered(text: Column) -> Column:
    """A-Z in lower case; ``lower`` does only that to a text of ASCII characters, and is faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_digest(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keyed_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """``doc_id, row, pos, h1, h2`` of every line that is long enough."""
    lines = docs.select("doc_id", row_digest(F.col("text")).alias("row"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keys = lines.where(F.length("line") >= least_chars).select(
        "doc_id", "row", "pos", lowered(F.trim("line", F.lit(BLANKS))).alias("key")).where(F.length("key") >= least_chars)
    return keys.select("doc_id", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"))


class Runs:
    """Sorted runs of line hashes in levels: ``h1, h2, holder, docs``.

    All runs lie in one table, bucketed and sorted by hash with a partition for each run, so that any set of
    runs is read as one scan whose buckets are already together. Compacted runs stay on disk, unread, until ``clear``.
    """

    def __init__(self, spark: SparkSession, least_docs: int = LEAST_DOCS, fanout: int = FANOUT):
        self.spark, self.least_docs, self.fanout = spark, least_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.path = scratch_path(spark, self.name)
        self.levels: list[list[int]] = []
        self.written = 0

    def add(self, lines: DataFrame) -> None:
        """Takes the lines of a batch, whose ids are smaller than those of all batches before."""
        by_document = lines.select(*KEY, "doc_id").distinct()
        own = by_document.groupBy(*KEY).agg(F.max("doc_id").alias("holder"), F.count("*").alias("docs"))
        if self.written:
            decided = self.entries().where(F.col("docs") >= self.least_docs).select(*KEY)
            own = own.join(decided.hint("merge"), KEY, "left_anti")
        self._write(own, 0)

    def entries(self) -> DataFrame:
        """The entries of all runs; a key that is not decided yet may have one in several."""
        return self._read([run for level in self.levels for run in level])

    def merged(self, runs: list[int] | None = None) -> DataFrame:
        """One entry per key, by merging the buckets of the runs."""
        entries = self.entries() if runs is None else self._read(runs)
        return entries.groupBy(*KEY).agg(F.max("holder").alias("holder"), F.sum("docs").alias("docs"))

    def decided(self) -> DataFrame:
        return self.merged().where(F.col("docs") >= self.least_docs)

    def clear(self) -> None:
        self.spark.sql(f"drop table if exists {self.name}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _read(self, runs: list[int]) -> DataFrame:
        return self.spark.table(self.name).where(F.col("run").isin(runs)).drop("run")

    def _write(self, entries: DataFrame, level: int) -> None:
        run, self.written = self.written, self.written + 1
        entries.withColumn("run", F.lit(run)).write.partitionBy("run").bucketBy(self.buckets, *KEY).sortBy(*KEY).option(
            "path", self.path).option("compression", "zstd").format("parquet").mode("append").saveAsTable(self.name)
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self.merged(full), level + 1)


def cut_points(docs: DataFrame, batches: int) -> list[int]:
    """Ids that cut the documents into batches of about equal counts."""
    if batches < 2:
        return []
    shares = [k / batches for k in range(1, batches)]
    return sorted(set(docs.agg(F.percentile_approx("doc_id", shares).alias("at")).first()["at"] or []))


def without(lines: Column, at: Column) -> Column:
    """``lines`` without those at the sorted positions ``at``: the stretches between them."""
    before = lambda k: F.coalesce(F.get(at, k - 1), F.lit(-1))
    stretch = lambda k: F.slice(lines, before(k) + 2, F.coalesce(F.get(at, k), F.size(lines)) - before(k) - 1)
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(at)), stretch))


def dedup_lines(docs: DataFrame, *, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES,
                fanout: int = FANOUT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text`` of every document."""
    spark = docs.sparkSession
    docs = id_and_text(docs, id_col, text_col)
    cuts = cut_points(docs, batches)
    batch = F.lit(0)
    for cut in cuts:  # the largest ids are batch 0, the null id is in the last
        batch = batch + F.when(F.col("doc_id") > cut, 0).otherwise(1)
    path = scratch_path(spark, "lines")
    keyed_lines(docs, least_chars).withColumn("batch", batch).write.partitionBy("batch").option("compression", "zstd").parquet(path)
    lines = spark.read.schema(f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, row bigint, pos int, h1 bigint, h2 bigint, "
                              "batch int").parquet(path)
    runs = Runs(spark, least_docs, fanout)
    for k in range(len(cuts) + 1):
        runs.add(lines.where(F.col("batch") == k))
    # stored, so that the join below can split a line that very many documents hold
    decided = settle(runs.decided().select(*KEY, "holder"), "decided")
    runs.clear()
    dropped = lines.join(decided, KEY).where(~F.col("doc_id").eqNullSafe(F.col("holder")))
    # one row per text: as many positions as it has lines at most
    places = dropped.groupBy(F.col("doc_id").alias("of"), "row").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    text = F.coalesce("text", F.lit(""))
    whole = docs.select("doc_id", text.alias("text"), row_digest(F.col("text")).alias("row"))
    found = whole.join(places.withColumnRenamed("row", "of_row"),
                       F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row")), "left")
    kept = let(F.split("text", "\n"), lambda lines: F.array_join(without(lines, F.col("at")), "\n"))
    return found.select(
        "doc_id", (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("at"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("at").isNull(), F.col("text")).otherwise(kept).alias("kept_text"))
