"""Exact duplicates by a stateful stream.

A streaming aggregation keeps, for each digest of a normalised text, on disk
(RocksDB) and without expiry: the digest, the stable identifier (the largest
doc_id so far), that row's content locator (file and row) and the number of
rows.  Partial aggregation comes before the shuffle, so a digest that a third
of all rows share costs one row a task.  After the stream has taken all
files, the state itself is read as a table.

A hit, a row whose digest the state holds more than once, is checked byte by
byte: its text is joined with the text at the state's locator.  Rows that
differ in spite of the same digest form groups of their own by their full text.

Texts are equal when identical after lower-casing A-Z; null counts as empty.
Of equal texts the row with the largest doc_id stays (null is least; among
rows that repeat that doc_id the last by file and row).  An empty table gives
no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import string
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import same, stored, text_of
from tessera.llm.registry import register
from tessera.session import scratch_path

#: Input of one micro-batch: what a failure repeats at most.  A larger table is
#: several batches, each of which meets the state of those before.
BATCH_BYTES = str(4 << 30)

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each partition reserves megabytes
}


@contextmanager
def _conf(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
        .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def _read(frame: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    """(digest, doc_id, file, row, text); the locator is what Spark's file reader tells."""
    norm = ascii_lower(text_of(text_col))
    return frame.select(digest(norm).alias("digest"), F.col(id_col).cast("long").alias("doc_id"),
                        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), norm.alias("text"))


def stream_state(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
                 digest=sha256_hex, checkpoint: str | None = None, **options: str) -> DataFrame:
    """Streams the Parquet files at ``path`` into the keyed state and returns
    it: digest, n, keeper (doc_id, file, row).  Called again with the same
    ``checkpoint``, it takes only the files that have been added."""
    schema = spark.read.parquet(path).schema
    checkpoint = checkpoint or scratch_path(spark, "dedup-state")
    options = options or {"maxBytesPerTrigger": BATCH_BYTES}
    path = path.rstrip("/")
    one = f"{path[:-1]}[{path[-1]}]"  # as a pattern, so that a table of a single file streams too
    rows = _read(spark.readStream.schema(schema).options(**options).parquet(one), id_col, text_col, digest)
    state = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "file", "row")).alias("keeper"))
    with _conf(spark, _STATE_CONF):
        query = state.writeStream.format("noop").outputMode("update").trigger(availableNow=True) \
            .option("checkpointLocation", checkpoint).start()
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        if query.lastProgress is None and not rows_there(spark, path):
            return spark.createDataFrame([], "digest string, n long, keeper struct<doc_id:long,file:string,row:long>")
        held = spark.read.format("statestore").load(checkpoint)
        value = held.schema["value"].dataType.names
        return stored(held.select(F.col("key")[held.schema["key"].dataType.names[0]].alias("digest"),
                                  F.col("value")[value[0]].alias("n"), F.col("value")[value[1]].alias("keeper")), "dedup-groups")


def rows_there(spark: SparkSession, path: str) -> bool:
    return not spark.read.parquet(path).isEmpty()


def deduplicate(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
                digest=sha256_hex, **options: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest, file, row for every row."""
    state = stream_state(spark, path, id_col, text_col, digest, **options)
    alone = state.where("n = 1").select(F.col("keeper.doc_id").alias("doc_id"), F.col("keeper.doc_id").alias("keep_id"),
                                        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest",
                                        F.col("keeper.file").alias("file"), F.col("keeper.row").alias("row"))

    docs = _read(spark.read.parquet(path), id_col, text_col, digest)
    members = stored(docs.join(state.where("n > 1"), "digest"), "dedup-members")
    at_locator = (F.col("file") == F.col("keeper.file")) & (F.col("row") == F.col("keeper.row"))
    keepers = members.where(at_locator).select("digest", F.col("text").alias("kept_text"))
    checked = members.join(keepers, "digest").withColumn("equal", F.col("text") == F.col("kept_text"))

    # rows that only share the digest: none in practice, grouped by their full text
    odd = stored(checked.where(~F.col("equal")).select("digest", "doc_id", "file", "row", "text"), "dedup-collisions")
    groups = odd.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "file", "row")).alias("keeper"))
    apart = odd.join(groups, ["digest", "text"]).select(
        "doc_id", F.col("keeper.doc_id").alias("keep_id"), F.col("n").alias("group_size"), at_locator.alias("kept"), "digest", "file", "row")

    fewer = odd.groupBy("digest").agg(F.count(F.lit(1)).alias("others"))
    together = checked.where("equal").select("digest", "doc_id", "file", "row", "n", "keeper").join(fewer, "digest", "left").select(
        "doc_id", F.col("keeper.doc_id").alias("keep_id"), (F.col("n") - F.coalesce("others", F.lit(0))).alias("group_size"),
        at_locator.alias("kept"), "digest", "file", "row")
    return alone.unionByName(together).unionByName(apart)


def drop_duplicates(spark: SparkSession, path: str, **cols) -> DataFrame:
    """The table at ``path`` without the dropped rows, with its own columns."""
    gone = deduplicate(spark, path, **cols).where(~F.col("kept")).select(F.col("file").alias("__file"), F.col("row").alias("__row"))
    table = spark.read.parquet(path)
    return table.join(gone, same(F.col("_metadata.file_path"), F.col("__file")) & same(F.col("_metadata.row_index"), F.col("__row")), "left_anti")


@register("op3_exact_dedup", sql=r"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
""")
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicate(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))
