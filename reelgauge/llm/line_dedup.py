"""Line deduplication with levelled sorted runs of line hashes.

Documents come in batches of ascending doc_id. The hashes of a batch's lines are merge-anti-joined
with the runs, which hold the lines of all earlier batches; what is left is new, stays in the first
document of the batch that holds it, and is added as a run of its own. When a level has ``fanout``
runs, they are merged into one run of the next level, so that a batch meets few runs and a hash is
rewritten once a level. Runs are bucketed tables: neither side of the anti-join is shuffled for it.

Only hashes of 128 bits meet; texts are read twice and shuffled once, to their dropped positions. A
line common to many documents is one hash of each task before any shuffle, and its documents' rows
stand on the side of a join that adaptive execution splits. All of it is DataFrame expressions.

Defined cases: a null or empty text is one empty line; rows that share a doc_id are one document, so
that none of them takes a line from another; a null doc_id counts as the largest; an empty table
gives no rows. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, shared_folder

#: Code points from which on a key counts.
LEAST = 10
BATCHES, FANOUT = 8, 3
LAST = (1 << 63) - 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = " \t\n\x0b\x0c\r"
HASH = ["_h1", "_h2"]


def line_key(line: Column) -> Column:
    """The line stripped, A-Z lower-cased. ``lower`` is the faster of two equal ways for ASCII."""
    ascii_only = F.octet_length(line) == F.length(line)
    return F.btrim(F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, _UPPER, _LOWER)), F.lit(_BLANK))


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_doc"), F.col("doc_id").cast("long").alias("_id"), text.alias("_text"))


def line_hashes(docs: DataFrame, batches: int = BATCHES, least: int = LEAST) -> tuple[DataFrame, list[int]]:
    """_batch, _doc, _of (hash of the text), _pos, _h1, _h2 of all lines that count, stored by
    batch, and the batches that hold rows. Batches are ranges of doc_id of about equal count."""
    rows = _rows(docs)
    shares = [i / batches for i in range(1, batches)]
    cuts = sorted(set(rows.agg(F.percentile_approx("_doc", shares)).first()[0] or [])) if shares else []
    batch = sum((F.when(F.col("_doc") > cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    lines = rows.select("_doc", F.xxhash64("_text").alias("_of"), F.posexplode(F.split("_text", "\n")).alias("_pos", "_line"))
    keyed = lines.withColumn("_key", line_key(F.col("_line"))).where(F.length("_key") >= least)
    hashed = keyed.select(batch.cast("int").alias("_batch"), "_doc", "_of", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit("second"), "_key").alias("_h2"))
    path = f"{shared_folder(docs.sparkSession)}/line-hashes-{uuid.uuid4().hex}"
    hashed.write.option("compression", "zstd").partitionBy("_batch").parquet(path)
    stored = docs.sparkSession.read.schema(hashed.schema).parquet(path)
    return stored, sorted(r[0] for r in stored.select("_batch").distinct().collect())


class LineRuns:
    """Runs of (hash, first document), by level; ``merge`` has one run for each batch."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.names: list[str] = []

    def _run(self, rows: DataFrame) -> DataFrame:
        """The rows as a table in the shared folder, bucketed and sorted by hash."""
        name = f"line_run_{uuid.uuid4().hex}"
        dealt = rows.repartition(self.buckets, *HASH)
        writer = dealt.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("compression", "zstd")
        writer.option("path", f"{shared_folder(self.spark)}/{name}").saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def forget(self) -> None:
        """Take the runs out of the session's catalogue; their files stay in the shared folder."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def new_of(self, lines: DataFrame) -> DataFrame:
        """Hash and first document of the lines that no run holds."""
        keys = lines.groupBy(*HASH).agg(F.min("_doc").alias("_first"))
        for run in (r for level in self.levels for r in level):
            keys = keys.join(run.select(*HASH).hint("merge"), HASH, "left_anti")
        return keys

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in a batch of documents behind all earlier ones; the rows of ``lines`` to drop."""
        new = self._run(self.new_of(lines))
        self._put(new, 0)
        held = lines.join(new, HASH, "left")
        return held.where(F.col("_first").isNull() | (F.col("_first") != F.col("_doc"))).select("_doc", "_of", "_pos")

    def _put(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self.levels[level][0]
            for other in self.levels[level][1:]:
                merged = merged.unionByName(other)
            self.levels[level] = []
            self._put(self._run(merged), level + 1)


def dedup_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT, least: int = LEAST) -> DataFrame:
    """doc_id, text, n_lines, n_dropped: each row's text without the lines that an earlier document
    holds."""
    lines, filled = line_hashes(docs, batches, least)
    runs = LineRuns(docs.sparkSession, fanout)
    dropped = None
    for batch in filled:
        gone = runs.add(lines.where(F.col("_batch") == batch))
        dropped = gone if dropped is None else dropped.unionByName(gone)
    if dropped is None:
        dropped = lines.select("_doc", "_of", "_pos")
    by_text = saved(dropped.groupBy("_doc", "_of").agg(F.collect_set("_pos").alias("_gone")), "dropped-lines")
    runs.forget()
    met = _rows(docs).withColumn("_of", F.xxhash64("_text")).join(by_text.hint("shuffle_hash"), ["_doc", "_of"], "left")
    # A generator, so that the split is not moved into the lambda below and done for each line.
    split = met.withColumn("_lines", F.explode(F.array(F.when(F.col("_gone").isNotNull(), F.split("_text", "\n")))))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("_lines"), i)), "\n")
    count = F.octet_length("_text") - F.octet_length(F.replace(F.col("_text"), F.lit("\n"), F.lit(""))) + 1
    return split.select(
        F.col("_id").alias("doc_id"), F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(kept).alias("text"),
        count.cast("long").alias("n_lines"), F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("n_dropped"),
    )
