"""Queries for scans, sources and sinks.  Each writes a driver
table to a fresh folder under the shared checkpoint folder in the format
under test, reads it back with the operator, and is checked against the
original table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import files as FS
from tessera.plans.common import r6
from tessera.plans.registry import register
from tessera.session import scratch_path, table

_LI_COLS = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]
_LI_TYPES = [T.LongType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.DoubleType(), T.StringType()]


@register("scan_csv_positional", "SELECT " + ", ".join(f"{c} AS col_{i}" for i, c in enumerate(_LI_COLS)) + " FROM lineitem")
def _csv_positional(spark, sf_dir):
    path = scratch_path(spark, "csv-positional")
    table(spark, sf_dir, "lineitem").select(*_LI_COLS).write.option("header", False).csv(path)
    return FS.read_table(spark, path, "csv", header=False, schema=FS.positional_schema(len(_LI_COLS), _LI_TYPES))


@register("scan_csv_named", """
SELECT o_orderkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice FROM orders""")
def _csv_named(spark, sf_dir):
    path = scratch_path(spark, "csv-named")
    table(spark, sf_dir, "orders").drop("o_orderdate").write.option("header", True).option("sep", ";") \
        .option("encoding", "utf-8").csv(path)
    df = FS.read_named_csv(spark, path, ["o_orderkey", "o_orderstatus", "o_totalprice"], sep=";")
    return df.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus",
                     r6(F.col("o_totalprice").cast("double")).alias("o_totalprice"))


@register("scan_parquet", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _parquet(spark, sf_dir):
    return FS.read_table(spark, f"{sf_dir.rstrip('/')}/customer.parquet", "pq").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


_EV_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
                           T.StructField("props", T.StringType())])


@register("scan_jsonl", "SELECT event_id, user_id, event_type, value, props FROM events")
def _jsonl(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    table(spark, sf_dir, "events").drop("ts").write.json(path)
    return FS.read_table(spark, path, "ndjson", schema=_EV_SCHEMA)


_ITEMS_PER_FILE = 5000
_ITEM_SCHEMA = T.StructType([
    T.StructField("part_id", T.StringType()), T.StructField("group", T.StringType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("metadata", T.StructType([T.StructField("category", T.StringType()),
                                            T.StructField("description", T.StringType())]))])


@register("scan_json_array", """
SELECT CAST(p_partkey AS VARCHAR) AS part_id, p_brand AS "group", CAST(p_size AS DOUBLE) AS weight,
       p_type AS category, p_name AS description FROM part""")
def _json_array(spark, sf_dir):
    path = scratch_path(spark, "json-array")
    p = table(spark, sf_dir, "part")
    item = F.to_json(F.struct(F.col("p_partkey").cast("string").alias("part_id"), F.col("p_brand").alias("group"),
                              F.col("p_size").cast("double").alias("weight"),
                              F.struct(F.col("p_type").alias("category"), F.col("p_name").alias("description")).alias("metadata")))
    n_files = max(1, -(-p.count() // _ITEMS_PER_FILE))     # each array file holds a bounded number of items
    files = p.select(F.pmod(F.col("p_partkey"), F.lit(n_files)).alias("bucket"), item.alias("j")) \
        .groupBy("bucket").agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("j")), F.lit("]")).alias("value"))
    files.write.partitionBy("bucket").text(path)
    items = FS.read_items(spark, path, _ITEM_SCHEMA)
    return items.select("part_id", "group", "weight", F.col("metadata.category").alias("category"),
                        F.col("metadata.description").alias("description"))


@register("scan_dir_concat", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def _dir_concat(spark, sf_dir):
    path = scratch_path(spark, "dir")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    o.repartition(4).write.option("header", True).csv(path)
    o.write.mode("append").json(path)                  # non-CSV files in the same folder are ignored
    d = FS.read_dir(spark, path, "*.csv", header=True)
    return d.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                    F.col("o_custkey").cast("bigint").alias("o_custkey"), "o_orderpriority")


def _dataset_tree(spark, sf_dir):
    root = scratch_path(spark, "datasets")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority",
                                              F.concat(F.lit("p"), F.substring("o_orderpriority", 1, 1)).alias("ds"))
    for ds in [r["ds"] for r in o.select("ds").distinct().collect()]:      # five directory names
        part = o.where(F.col("ds") == ds).drop("ds")
        part.write.option("header", True).csv(f"{root}/{ds}/train.csv")
        if ds in ("p1", "p3", "p5"):
            part.write.option("header", True).csv(f"{root}/{ds}/test.csv")
    return root


@register("list_files_recursive", """
SELECT 'p' || substr(o_orderpriority, 1, 1) || '/' || k AS folder, true AS has_bytes, true AS is_csv
FROM orders, (VALUES ('train.csv'), ('test.csv')) f(k) WHERE k = 'train.csv' OR substr(o_orderpriority, 1, 1) IN ('1', '3', '5') GROUP BY 1""")
def _list_files(spark, sf_dir):
    """Folders below the root that hold listed files (their own names and sizes are the writer's)."""
    root = _dataset_tree(spark, sf_dir)
    lst = FS.list_by_extension(spark, root, "csv")
    folder = F.regexp_extract("path", "^.*/datasets-[0-9a-f]+/(.*)/[^/]+$", 1)
    return lst.groupBy(folder.alias("folder")).agg((F.min("length") > 0).alias("has_bytes"), F.bool_and(F.lower("path").endswith(".csv")).alias("is_csv"))


@register("pair_train_test", """
SELECT DISTINCT 'p' || substr(o_orderpriority, 1, 1) AS dataset, substr(o_orderpriority, 1, 1) IN ('1', '3', '5') AS has_test
FROM orders""")
def _pair(spark, sf_dir):
    root = _dataset_tree(spark, sf_dir)
    pairs = FS.pair_datasets(FS.list_by_extension(spark, root, "csv"))
    return pairs.select(F.regexp_extract("dataset", r"/(p\d)$", 1).alias("dataset"), "has_test")


@register("file_inventory", """
SELECT l_returnflag AS flag, count(*) AS rows, count(*) AS weight FROM lineitem GROUP BY 1""")
def _inventory(spark, sf_dir):
    path = scratch_path(spark, "inv")
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_quantity")
    # a flag holds a third of the rows: several files each
    li.repartitionByRange("l_returnflag", "l_orderkey").write.partitionBy("l_returnflag").option("header", True).csv(path)
    inv = FS.inventory(spark, path).withColumn("flag", F.regexp_extract("path", r"l_returnflag=([^/]+)/", 1))
    return inv.groupBy("flag").agg(F.sum("rows").alias("rows"), F.sum("weight").alias("weight"))


#: What the records of each type of event hold.
_RECORDS = {"click": ["event_id", "value"], "view": ["event_id", "user_id"], "purchase": ["event_id", "user_id", "value"],
            "signup": ["event_id", "user_id", "props"], "error": ["event_id", "props"]}
_RECORD_COLUMNS = ["event_id", "props", "user_id", "value"]


@register("sink_csv_union_schema", " UNION ALL ".join(
    "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in cols else f"NULL::VARCHAR AS {c}" for c in _RECORD_COLUMNS)
    + f" FROM events WHERE event_type = '{kind}'" for kind, cols in _RECORDS.items()))
def _csv_union(spark, sf_dir):
    path = scratch_path(spark, "union-csv")
    e = table(spark, sf_dir, "events")
    FS.write_csv_union([e.where(F.col("event_type") == kind).select(*cols) for kind, cols in _RECORDS.items()], path)
    # text as written: blanks read back as missing, sorted names in the header
    return spark.read.schema(", ".join(f"{c} string" for c in _RECORD_COLUMNS)).option("header", True).option("enforceSchema", False) \
        .option("escape", '"').option("quote", '"').csv(path)


@register("sink_json_meta", """
SELECT lang, count(*) AS n_rows, 5 AS n_cols, count(DISTINCT source) AS n_sources, CAST(sum(n_chars) AS BIGINT) AS n_chars,
       '[{"name":"doc_id","type":"bigint","description":"number of the document"},{"name":"text","type":"string"},{"name":"lang","type":"string"},'
       || '{"name":"source","type":"string"},{"name":"n_chars","type":"bigint","description":"code points of the text"}]' AS columns
FROM documents GROUP BY 1""")
def _json_meta(spark, sf_dir):
    path = scratch_path(spark, "meta")
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    described = FS.column_descriptor(d, {"doc_id": "number of the document", "n_chars": "code points of the text"})
    meta = d.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(d.columns)).alias("n_cols"),
                                 F.count_distinct("source").alias("n_sources"), F.sum("n_chars").alias("n_chars"))
    FS.write_meta(meta.withColumn("columns", described), path)
    schema = "lang string, n_rows bigint, n_cols int, n_sources bigint, n_chars bigint, columns array<struct<name:string,type:string,description:string>>"
    return spark.read.schema(schema).json(path).withColumn("columns", F.to_json("columns"))


from tessera.plans.classify import _BASE_SQL as _CLS_SQL  # noqa: E402


@register("sink_predictions", _CLS_SQL + "SELECT row_id AS id, prediction FROM pred")
def _predictions(spark, sf_dir):
    from tessera.plans.classify import classify
    path = scratch_path(spark, "predictions")
    q, _, _ = classify(spark, sf_dir)
    FS.write_predictions(q.withColumnRenamed("row_id", "id"), path)
    return spark.read.option("header", True).csv(path)


def _batches(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select(F.floor(F.col("conv_id") / 10).cast("int").alias("batch_id"), "conv_id", "turn",
                    F.array(F.length("text").cast("float"), F.col("turn").cast("float")).alias("x"))


@register("batch_store_write", """
SELECT CAST(conv_id // 10 AS INTEGER) AS batch_id, count(*) AS rows, 2 * count(*) AS values FROM conversations GROUP BY 1""")
def _store_write(spark, sf_dir):
    path = scratch_path(spark, "batches")
    FS.save_batches(_batches(spark, sf_dir), path)
    back = spark.read.parquet(path)
    return back.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("x")).alias("values"))


@register("batch_store_read", """
SELECT CAST(conv_id // 10 AS INTEGER) * 7 AS batch_id, conv_id, turn FROM conversations
WHERE conv_id // 10 IN (SELECT DISTINCT conv_id // 10 FROM conversations WHERE conv_id // 10 * 7 >= 15 ORDER BY 1 LIMIT 3)""")
def _store_read(spark, sf_dir):
    path = scratch_path(spark, "batches")
    # numbers with gaps: the first three batches that are there from number 15 on
    FS.save_batches(_batches(spark, sf_dir).withColumn("batch_id", F.col("batch_id") * 7), path)
    return FS.load_batches(spark, path, start=15, max_batches=3).select("batch_id", "conv_id", "turn")


@register("shard_select", """
SELECT CAST(conv_id // 10 AS INTEGER) AS batch_id, conv_id, turn FROM conversations WHERE (conv_id // 10 - 1) % 3 = 1 AND conv_id // 10 >= 1""")
def _shard(spark, sf_dir):
    path = scratch_path(spark, "batches")
    FS.save_batches(_batches(spark, sf_dir), path)
    return FS.shard(spark.read.parquet(path), world=3, rank=1, start=1).select("batch_id", "conv_id", "turn")
