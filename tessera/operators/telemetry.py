"""Telemetry and service-log analytics over many text files.

Input is a line table ``(file, line_no, value)`` -- ``sources.text.read_lines``
makes one from a directory of logs.  Everything is built-in string, regex,
map and window expressions; ordered state (headers, ticks) is carried per
chunk of lines so one huge file never collapses into one task.
"""

from __future__ import annotations

import json
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.arrays import map_last_wins
from tessera.operators.ordering import carry_forward, chunked_lag, running_sum

# Service-log levels and their ranks.
LEVELS = {"DEBUG": 10, "INFO": 20, "WARN": 30, "WARNING": 30, "ERROR": 40, "CRITICAL": 50}
# Substrings that mark a secret key (matched on the lower-cased key).
SECRET_PATTERNS = ("password", "secret", "token", "key", "credential", "pwd")
# The mask of a secret, and the lengths that a summary keeps.
MASK = "***"
SUMMARY_MAX_TEXT = 16384
SUMMARY_MAX_ITEMS = 16
SUMMARY_SAMPLE, SUMMARY_MAX_KEYS, SUMMARY_HEAD_BYTES = 5, 8, 32   # fixed values
# Byte multipliers of the link-status units.
UNIT_SCALE = {"b": 1, "kb": 1024, "mb": 1024 ** 2, "gb": 1024 ** 3, "bytes": 1}
# Fixed value: "Tx: 123.4 MB" style counter pattern.
TXRX_PATTERN = r"\b(Tx|TX|tx|Rx|RX|rx)\s*[:=]?\s*([0-9]+(?:\.[0-9]+)?)\s*([A-Za-z/]+)"
# Gpu monitor column renames.
DMON_RENAME = {"pwr": "pwr_W", "gtemp": "temp_C", "temp": "temp_C", "sm": "sm_pct", "mem": "mem_pct",
               "mclk": "mclk_MHz", "pclk": "pclk_MHz"}


def tokens(value: Column) -> Column:
    return F.split(F.trim(value), r"\s+")


def parse_start_time(lines: DataFrame) -> DataFrame:
    """Epoch seconds of the ISO time after 'Monitor started at', with or without
    fraction and zone ('Z' and no zone: UTC); null if it doesn't parse."""
    raw = F.regexp_extract("value", r"Monitor started at\s+([0-9T:\-.]+(?:Z|[+\-][0-9:]+)?)", 1)
    iso = F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(raw, F.lit("T00:00:00"))).otherwise(raw)
    zoned = F.when(iso.rlike(r"T.*(Z|[+-][0-9:]+)$"), F.regexp_replace(iso, "Z$", "+00:00")).otherwise(F.concat(iso, F.lit("+00:00")))
    return lines.select("file", F.when(iso.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}"), zoned.try_cast("timestamp").cast("double")).alias("start_epoch"))


def parse_header_driven(lines: DataFrame, rename: dict[str, str], key: str, chunk: Column, need: tuple[str, ...] = ()) -> DataFrame:
    """Lines whose first sign is '#' and that name ``key`` and ``need`` are
    headers (lower-cased; the latest wins).  Data rows have at least as many
    tokens as the header and an integer under the first ``key``; the others are
    skipped.  Every renamed column is present: the last cell of its names that
    parses as a number, or null."""
    line = F.trim(F.regexp_replace("value", r"\s+", " "))
    cols = F.filter(F.split(F.lower(F.regexp_replace(line, r"^[# ]+|[# ]+$", "")), " "), lambda c: c != "")
    names = [key, *need]
    x = lines.withColumn("_line", line).withColumn(
        "_hdr", F.when(line.startswith("#") & F.forall(F.array(*map(F.lit, names)), lambda n: F.array_contains(cols, n)), cols))
    x = carry_forward(x, ["file"], "line_no", "_hdr", chunk, "_header")
    data = x.where(~F.col("_line").startswith("#") & (F.col("_line") != "") & F.col("_header").isNotNull())
    data = data.withColumn("_tok", F.split("_line", " ")).where(F.size("_tok") >= F.size("_header"))
    keyv = F.element_at("_tok", F.array_position("_header", key).cast("int"))
    data = data.where(keyv.rlike(r"^[+-]?\d+$"))
    to = F.create_map(*[F.lit(v) for pair in rename.items() for v in pair])
    cells = F.transform(F.arrays_zip(F.col("_header").alias("h"), F.slice("_tok", F.lit(1), F.size("_header")).alias("t")),
                        lambda c: F.struct(F.try_element_at(to, c["h"]).alias("key"),
                                           F.when(F.try_element_at(to, c["h"]).isNotNull(), c["t"].try_cast("double")).alias("value")))
    row = map_last_wins(F.filter(cells, lambda c: c["key"].isNotNull() & c["value"].isNotNull()))
    data = data.withColumn("_key", keyv.cast("bigint")).withColumn("_row", row)
    return data.select("file", "line_no", F.col("_key").alias(key),
                       *[F.try_element_at("_row", F.lit(c)).alias(c) for c in dict.fromkeys(rename.values())])


def first_key_ticks(df: DataFrame, key: str, chunk: Column) -> DataFrame:
    """tick = (number of times the file's first key has been seen so far) - 1."""
    first = df.groupBy("file").agg(F.min_by(key, "line_no").alias("_first"))
    x = df.join(first, "file")
    x = running_sum(x, ["file"], ["line_no"], (F.col(key) == F.col("_first")).cast("bigint"), chunk, "_seen")
    return x.withColumn("tick", (F.col("_seen") - 1).cast("bigint")).drop("_first", "_seen")


def parse_numeric_table(lines: DataFrame, header: Column, chunk: Column) -> DataFrame:
    """vmstat style: the first line of a file for which ``header`` holds names
    the columns, lower-cased; later rows count whose tokens are all numbers and
    as many as the header's; ``sample`` = index among the kept rows of the file."""
    names = F.transform(tokens(F.col("value")), lambda t: F.lower(t))
    first = lines.where(header).groupBy("file").agg(F.min_by(F.struct(names.alias("h"), F.col("line_no").alias("at")), "line_no").alias("_first"))
    x = lines.join(first, "file").withColumn("_tok", tokens(F.col("value")))
    ok = (F.col("line_no") > F.col("_first.at")) & (F.size("_tok") == F.size("_first.h")) \
        & F.forall("_tok", lambda t: t.try_cast("double").isNotNull())
    x = running_sum(x.where(ok), ["file"], ["line_no"], F.lit(1).cast("bigint"), chunk, "_n")
    x = x.withColumn("sample", (F.col("_n") - 1).cast("bigint"))
    row = map_last_wins(F.transform(F.arrays_zip(F.col("_first.h").alias("h"), F.col("_tok").alias("t")),
                                    lambda c: F.struct(c["h"].alias("key"), c["t"].cast("double").alias("value"))))
    return x.select("file", "line_no", "sample", row.alias("row"))


def vmstat_header() -> Column:
    value = F.col("value")
    return value.rlike(r"\br\b.*\bb\b") & (value.contains("si") | value.contains("swpd"))


def parse_free_memory(lines: DataFrame, chunk: Column) -> DataFrame:
    """The fallback without vmstat: a sample for each stamp line ('===== ')
    that another line follows."""
    stamp = F.col("value").startswith("===== ")
    x = chunked_lag(lines.withColumn("_stamp", stamp), ["file"], "line_no", "_stamp", chunk, "_after")
    x = running_sum(x.where(F.col("_after") & ~F.col("_stamp")), ["file"], ["line_no"], F.lit(1).cast("bigint"), chunk, "_n")
    return x.select("file", (F.col("_n") - 1).cast("bigint").alias("time_s"), F.lit("free_mem").alias("note"))


def cpu_usage(idle: Column) -> Column:
    return F.lit(100.0) - idle


def parse_iostat(lines: DataFrame, chunk: Column) -> DataFrame:
    """Rows as long as the latest 'Device ... %util' header give util and
    await; after a header, other lines that begin like a date ('Mon 1') or a
    clock ('12:00:') start the next tick.  Mean of the numbers per tick."""
    s = F.trim("value")
    header = F.lower(s).startswith("device") & F.lower(s).contains("%util")
    x = lines.where(s != "").withColumn("_hdr", F.when(header, tokens(F.lower(s))))
    x = carry_forward(x, ["file"], "line_no", "_hdr", chunk, "_header").where(F.col("_header").isNotNull() & ~header)
    x = x.withColumn("_tok", tokens(s)).withColumn("_data", F.size("_tok") == F.size("_header"))
    stamp = ~F.col("_data") & s.rlike(r"^([A-Za-z]{3}\s+\d|\d{2}:\d{2}:)")
    x = running_sum(x, ["file"], ["line_no"], stamp.cast("bigint"), chunk, "time_s").where("_data")
    row = map_last_wins(F.transform(F.arrays_zip(F.col("_header").alias("h"), F.col("_tok").alias("t")),
                                    lambda c: F.struct(c["h"].alias("key"), c["t"].alias("value"))))
    number = lambda v: F.when(~F.isnan(v.try_cast("double")), v.try_cast("double"))
    cell = lambda *names: F.coalesce(*[F.try_element_at("_row", F.lit(n)) for n in names])
    x = x.withColumn("_row", row)
    return x.groupBy("file", "time_s").agg(F.avg(number(cell("%util", "util"))).alias("util_pct"), F.avg(number(cell("await"))).alias("await_ms"))


def net_sum(value: Column) -> Column:
    """Sum of all numeric tokens on a line with at least two of them."""
    nums = F.filter(F.transform(tokens(value), lambda t: t.try_cast("double")), lambda v: v.isNotNull())
    return F.when(F.size(nums) >= 2, F.aggregate(nums, F.lit(0.0), lambda a, v: a + v))


def interface_sum(value: Column) -> Column:
    """Received plus sent (the third and fourth token) of a row that begins
    with a clock time."""
    t = tokens(value)
    both = F.try_element_at(t, F.lit(3)).try_cast("double") + F.try_element_at(t, F.lit(4)).try_cast("double")
    return F.when(F.element_at(t, 1).rlike(r"^\d{1,2}:\d{2}:\d{2}"), both)


def parse_net(lines: DataFrame, chunk: Column, interfaces: bool = False) -> DataFrame:
    """(file, time_s, sum_kBs): of a counter log, or of an interface table whose
    rows follow an 'IFACE ... rxkB/s ... txkB/s' header."""
    if interfaces:
        t = tokens(F.col("value"))
        header = F.array_contains(t, "IFACE") & F.array_contains(t, "rxkB/s") & F.array_contains(t, "txkB/s")
        x = carry_forward(lines.withColumn("_hdr", F.when(header, True)), ["file"], "line_no", "_hdr", chunk, "_seen")
        x = x.where(F.col("_seen") & ~header).withColumn("sum_kBs", interface_sum(F.col("value")))
    else:
        x = lines.withColumn("sum_kBs", net_sum(F.col("value")))
    x = running_sum(x.where("sum_kBs is not null"), ["file"], ["line_no"], F.lit(1).cast("bigint"), chunk, "_n")
    return x.select("file", (F.col("_n") - 1).cast("bigint").alias("time_s"), "sum_kBs")


def link_throughput(rx: Column, tx: Column) -> Column:
    return (F.coalesce(rx, F.lit(0.0)) + F.coalesce(tx, F.lit(0.0))) / 1024.0


def _unit_bytes(val: Column, unit: Column) -> Column:
    u = F.lower(F.trim(unit))
    base = F.when(u.endswith("/s"), F.regexp_replace(u, "/s$", "")).otherwise(u)
    expr = None
    for k, v in UNIT_SCALE.items():
        expr = F.when(base == k, F.lit(float(v))) if expr is None else expr.when(base == k, F.lit(float(v)))
    scale = expr.otherwise(F.lit(1.0))
    return val.cast("double") * scale


def extract_unit_values(value: Column) -> tuple[Column, Column]:
    """Sum of Tx and Rx byte counts on a line; all zero -> nulls."""
    kinds = F.regexp_extract_all(value, F.lit(TXRX_PATTERN), 1)
    vals = F.regexp_extract_all(value, F.lit(TXRX_PATTERN), 2)
    units = F.regexp_extract_all(value, F.lit(TXRX_PATTERN), 3)
    z = F.arrays_zip(kinds.alias("k"), vals.alias("v"), units.alias("u"))
    b = F.transform(z, lambda s: F.struct(F.lower(s["k"]).startswith("t").alias("tx"), _unit_bytes(s["v"], s["u"]).alias("b")))
    tx = F.aggregate(b, F.lit(0.0), lambda a, s: a + F.when(s["tx"], s["b"]).otherwise(F.lit(0.0)))
    rx = F.aggregate(b, F.lit(0.0), lambda a, s: a + F.when(~s["tx"], s["b"]).otherwise(F.lit(0.0)))
    none = (tx == 0.0) & (rx == 0.0)
    return F.when(none, None).otherwise(tx), F.when(none, None).otherwise(rx)


LOG_FIELDS = ("trace_id", "span_id", "corr_id", "job_id", "attempt", "latency_ms", "msg")


def render_log_line(ts: Column, file: Column, level: Column, event: Column, fields: dict[str, Column],
                    extras: list[tuple[str, Column]]) -> Column:
    """ts|file|LEVEL|event=..|k=v..: fixed order, missing or empty omitted."""
    def nz(c):
        return F.when(c.cast("string") == "", None).otherwise(c.cast("string"))
    parts = [nz(ts), nz(file), nz(level), F.concat(F.lit("event="), nz(event))]
    for k in LOG_FIELDS:
        if k in fields:
            parts.append(F.concat(F.lit(f"{k}="), nz(fields[k])))
    for k, v in extras:
        parts.append(F.concat(F.lit(f"{k}="), nz(v)))
    return F.concat_ws("|", *parts)


def parse_log_line(line: Column) -> Column:
    """Inverse: struct(ts, file, level, kv map)."""
    parts = F.split(line, r"\|")
    fields = F.slice(parts, F.lit(4), F.greatest(F.size(parts) - 3, F.lit(0)))
    kv = map_last_wins(F.transform(fields, lambda f: F.struct(
        F.substring_index(f, "=", 1).alias("key"),
        F.when(F.instr(f, "=") > 0, F.regexp_replace(f, "^[^=]*=", "")).alias("value"))))
    return F.struct(parts[0].alias("ts"), parts[1].alias("file"), parts[2].alias("level"), kv.alias("kv"))


def redact(m: Column, allow: tuple[str, ...] = ()) -> Column:
    """Mask a value whose lower-cased key contains a secret pattern, unless
    the key is allow-listed."""
    pat = "|".join(SECRET_PATTERNS)
    allowed = F.array(*[F.lit(a) for a in allow]) if allow else F.array().cast("array<string>")
    return F.transform_values(m, lambda k, v: F.when(F.lower(k).rlike(pat) & ~F.array_contains(allowed, k), F.lit(MASK))
                              .otherwise(v))


def summarise_text(text: Column, max_length: int = SUMMARY_MAX_TEXT) -> Column:
    n = F.length(text)
    return F.when(n > max_length, F.concat(F.substring(text, 1, max_length),
                                           F.lit("...<truncated "), (n - max_length).cast("string"), F.lit(" chars>"))
                  ).otherwise(text)


def summarise_list(arr: Column) -> Column:
    """> 16 elements -> (type, size, first 5)."""
    return F.when(F.size(arr) > SUMMARY_MAX_ITEMS,
                  F.struct(F.lit("list").alias("_type"), F.size(arr).alias("size"), F.slice(arr, 1, 5).alias("sample")))


def _json_text(text: Column) -> Column:
    """The text as a JSON string, quotes included."""
    one = F.to_json(F.array(text))
    return F.substring(one, F.lit(2), F.length(one) - 2)


def _json_list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def summarise(value: Column, kind: T.DataType, sets: tuple[str, ...] = (), path: str = "") -> Column:
    """JSON text that is safe to log, of a value of any (nested) type:

    * a list of more than 16 items: its type, size and first 5 items,
    * a map or struct of more than 16 entries: type, size and first 8 keys,
    * an array named in ``sets`` (dotted path) is a set: type, size and the
      8 least values,
    * bytes: type, size and the first 32 as hex,
    * other text is cut at 16384 characters, with the number cut off.

    Items, values and fields are summarised in turn.  The types are walked once,
    when the expression is built; it holds no Python."""
    inner = lambda c, t, name="": summarise(c, t, sets, f"{path}.{name}".strip("."))
    counted = lambda name, size, rest: F.concat(F.lit(f'{{"_type":"{name}","size":'), size.cast("string"), F.lit(","), rest, F.lit("}"))
    if isinstance(kind, T.ArrayType):
        item = lambda x: inner(x, kind.elementType)
        if path in sets:
            least = F.slice(F.sort_array(F.array_distinct(value)), 1, SUMMARY_MAX_KEYS)
            out = counted("set", F.size(F.array_distinct(value)), F.concat(F.lit('"values":'), _json_list(F.transform(least, item))))
        else:
            many = counted("list", F.size(value), F.concat(F.lit('"sample":'), _json_list(F.transform(F.slice(value, 1, SUMMARY_SAMPLE), item))))
            out = F.when(F.size(value) > SUMMARY_MAX_ITEMS, many).otherwise(_json_list(F.transform(value, item)))
    elif isinstance(kind, T.MapType):
        keys = F.transform(F.map_keys(value), lambda k: _json_text(k.cast("string")))
        many = counted("dict", F.size(value), F.concat(F.lit('"keys":'), _json_list(F.slice(keys, 1, SUMMARY_MAX_KEYS))))
        entries = F.transform(F.map_entries(value), lambda e: F.concat(_json_text(e["key"].cast("string")), F.lit(":"), inner(e["value"], kind.valueType)))
        out = F.when(F.size(value) > SUMMARY_MAX_ITEMS, many).otherwise(F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}")))
    elif isinstance(kind, T.StructType):
        names = [f.name for f in kind]
        if len(names) > SUMMARY_MAX_ITEMS:
            out = counted("dict", F.lit(len(names)), F.lit('"keys":' + json.dumps(names[:SUMMARY_MAX_KEYS], ensure_ascii=False, separators=(",", ":"))))
        else:
            fields = [F.concat(F.lit(json.dumps(f.name, ensure_ascii=False) + ":"), inner(value[f.name], f.dataType, f.name)) for f in kind]
            out = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    elif isinstance(kind, T.BinaryType):
        head = F.lower(F.hex(F.substring(value, 1, SUMMARY_HEAD_BYTES)))
        out = counted("bytes", F.octet_length(value), F.concat(F.lit('"head":"'), head, F.lit('"')))
    elif isinstance(kind, (T.NumericType, T.BooleanType)):
        out = value.cast("string")
    else:
        out = _json_text(summarise_text(value.cast("string")))
    return F.coalesce(out, F.lit("null"))


def level_rank(level: Column) -> Column:
    expr = None
    for k, v in LEVELS.items():
        expr = F.when(F.upper(level) == k, F.lit(v)) if expr is None else expr.when(F.upper(level) == k, F.lit(v))
    return expr


def level_filter(df: DataFrame, level: str, minimum: str) -> DataFrame:
    return df.where(level_rank(F.col(level)) >= LEVELS[minimum])


def rule_rate(level: Column, event: Column, rules: list[tuple[str | None, str | None, float]], default: float) -> Column:
    """Rate of the first matching (level, event) rule; rules are config, so
    the match is a CASE chain in the projection (no join)."""
    expr = None
    for lv, ev, rate in rules:
        cond = F.lit(True)
        if lv:
            cond = cond & (F.upper(level) == lv.upper())
        if ev:
            cond = cond & (event == ev)
        expr = F.when(cond, F.lit(float(rate))) if expr is None else expr.when(cond, F.lit(float(rate)))
    return (expr.otherwise(F.lit(float(default))) if expr is not None else F.lit(float(default)))
