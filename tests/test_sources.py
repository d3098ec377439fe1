"""Readers of files that differ, and what stands next to results."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import metrics as M
from tessera.operators import ragged as RG
from tessera.operators import telemetry as TL
from tessera.sources import files as FS


def test_named_csv_reads_each_file_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;"na;me";x\n1;"one; two";5\n2;"say ""hi""\nagain";\n')
    (tmp_path / "b.csv").write_text('﻿"na;me";id\nthree;3\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "c.csv").write_bytes(b"id;na;me\n\xff\xfe;broken\n")
    (tmp_path / "d.csv").write_text('id;"na;me"\n4;"never closed\n')
    got = FS.read_named_csv(spark, str(tmp_path), ["id", "na;me"], ["x"], sep=";")
    rows = sorted((r["id"], r["na;me"], r["x"], r["file"][-5:]) for r in got.collect())
    assert rows == [("1", "one; two", "5", "a.csv"), ("2", 'say "hi"\nagain', None, "a.csv"), ("3", "three", None, "b.csv")]
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1   # every byte is read once
    (tmp_path / "e.csv").write_text("id;other\n5;x\n")
    with pytest.raises(Exception, match="missing required columns"):
        FS.read_named_csv(spark, str(tmp_path), ["id", "na;me"], sep=";").collect()


def test_batches_with_gaps(spark, tmp_path):
    df = spark.createDataFrame([(b, i) for b in (2, 40, 41, 900) for i in range(3)], "batch_id int, i int")
    FS.save_batches(df, str(tmp_path / "b"))
    got = FS.load_batches(spark, str(tmp_path / "b"), start=3, max_batches=2).select("batch_id").distinct().collect()
    assert sorted(r[0] for r in got) == [40, 41]


def test_files_without_rows_are_listed(spark):
    rows = spark.createDataFrame([("a", 1, 1), ("a", 1, 0)], "file string, p int, t int")
    files = spark.createDataFrame([("a",), ("b",)], "path string")
    got = {r["file"]: (r["n"], r["correct"], r["accuracy"]) for r in M.accuracy_per_file(rows, files, "p", "t").collect()}
    assert got == {"a": (2, 1, 0.5), "b": (0, 0, None)}


def test_microbatches_of_unlike_datasets_are_an_error(spark):
    like = spark.createDataFrame([(1, 5, 2), (1, 5, 2), (2, 7, 3)], "mb int, l int, t int")
    assert sorted(map(tuple, RG.microbatch_sizes(like, ["mb"], "l", "t").collect())) == [(1, 5, 2), (2, 7, 3)]
    for odd, what in (((1, 6, 2), "sequence length"), ((2, 7, 4), "training size")):
        with pytest.raises(Exception, match=what):
            RG.microbatch_sizes(like.union(spark.createDataFrame([odd], like.schema)), ["mb"], "l", "t").collect()


def test_column_descriptor(spark):
    df = spark.range(1).select("id", F.lit("x").alias("name"))
    got = [tuple(c) for c in df.select(FS.column_descriptor(df, {"id": "key"}).alias("c")).first()["c"]]
    assert got == [("id", "bigint", "key"), ("name", "string", None)]
    with pytest.raises(ValueError, match="not there"):
        FS.column_descriptor(df, {"nope": "x"})


def test_summaries_of_nested_values(spark):
    schema = T.StructType([T.StructField("v", T.StructType([
        T.StructField("n", T.LongType()), T.StructField("ok", T.BooleanType()), T.StructField("s", T.StringType()),
        T.StructField("m", T.MapType(T.StringType(), T.ArrayType(T.LongType()))), T.StructField("raw", T.BinaryType()),
        T.StructField("tags", T.ArrayType(T.LongType())), T.StructField("at", T.DateType())]))])
    import datetime
    values = [
        (1, True, 'q"\n', {"a": list(range(17)), "b": [1, None]}, bytes(range(40)), [3, 1, 3, *range(5, 20)], datetime.date(2020, 1, 2)),
        (None, None, "x" * 20_000, {f"k{i}": [i] for i in range(17)}, None, [], None),
        (0, False, "", {}, b"", None, None)]
    kind = schema["v"].dataType
    got = [json.loads(r[0]) for r in spark.createDataFrame([(v,) for v in values], schema).select(TL.summarise(F.col("v"), kind, sets=("tags",))).collect()]
    assert got[0] == {"n": 1, "ok": True, "s": 'q"\n', "m": {"a": {"_type": "list", "size": 17, "sample": [0, 1, 2, 3, 4]}, "b": [1, None]},
                      "raw": {"_type": "bytes", "size": 40, "head": bytes(range(32)).hex()},
                      "tags": {"_type": "set", "size": 17, "values": [1, 3, 5, 6, 7, 8, 9, 10]}, "at": "2020-01-02"}
    m = got[1]["m"]   # a map from Python has no order
    assert (m["_type"], m["size"], len(set(m["keys"]))) == ("dict", 17, 8) and got[1]["s"].endswith("...<truncated 3616 chars>")
    assert got[1]["n"] is None and got[1]["raw"] is None and got[1]["tags"] == {"_type": "set", "size": 0, "values": []}
    assert got[2]["m"] == {} and got[2]["tags"] is None
    wide = T.StructType([T.StructField(f"f{i}", T.LongType()) for i in range(17)])
    row = spark.createDataFrame([(tuple(range(17)),)], T.StructType([T.StructField("w", wide)]))
    assert json.loads(row.select(TL.summarise(F.col("w"), wide)).first()[0]) == {"_type": "dict", "size": 17, "keys": [f"f{i}" for i in range(8)]}
