"""Work partitioning and the task ledger as table operators.

The reference runs a home-made queue (segment files, leases, a worker
pool).  On Spark the scheduling itself is Spark's; what remains are the data
questions: how items become tasks, and what state a log of queue events
implies.  Both are grouped aggregates and ranked windows here.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.arrays import map_last_wins
from tessera.functions.hashing import uniform
from tessera.operators.ordering import ROWS_PER_BUCKET, carry_forward, chunked_lag, data_buckets, exact_rank, in_ranges, running_sum
from tessera.session import stored

LEDGER_OPS = ("put", "lease", "ack", "nack", "extend")


def items_normalise(df: DataFrame, candidates: list[str], weight: str | None, meta: list[Column]) -> DataFrame:
    """ref <- first present of payload_ref | ref | id | the whole record as
    JSON; weight defaults to 1.0 and a negative weight is an error; metadata
    maps merged left to right (last wins); checksum = sha256 of ref|weight."""
    whole = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    ref = F.coalesce(*[F.col(c).cast("string") for c in candidates if c in df.columns], whole)
    w = F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)
    w = F.when(w < 0, F.raise_error(F.lit("item weight must be non-negative"))).otherwise(w)
    none = F.create_map().cast("map<string,string>")
    m = map_last_wins(F.concat(*[F.map_entries(F.coalesce(x, none)) for x in meta])) if meta else none
    out = df.select(ref.alias("ref"), w.alias("weight"), m.alias("metadata"))
    return out.withColumn("checksum", F.sha2(F.concat_ws("|", "ref", F.col("weight").cast("string")), 256))


def items_replicate(df: DataFrame, id_col: str, order: list[str], target: int,
                    bucket: Column | None = None) -> DataFrame:
    """Repeat items cyclically until ``target`` rows; copies get ``<id>_dup<n>``
    and a ``duplicate_of`` link.  The copy count comes from one count(); the
    item ordinal is an exact rank split over ``bucket`` (monotone in the
    order, e.g. floor(key / width))."""
    n = df.count()
    if n == 0:
        return df
    copies = -(-target // n)
    x = exact_rank(df.withColumn("_g", F.lit(0)), ["_g"], order[0], order[1:], out="_ord",
                   bucket=bucket if bucket is not None else data_buckets(df, order[0])).drop("_g")
    x = x.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy"))
    x = x.where((F.col("_copy") * n + F.col("_ord") - 1) < target)
    dup = F.col("_copy") > 0
    return x.withColumn("duplicate_of", F.when(dup, F.col(id_col))) \
            .withColumn(id_col, F.when(dup, F.concat(F.col(id_col), F.lit("_dup"), F.col("_copy").cast("string")))
                        .otherwise(F.col(id_col))).drop("_copy", "_ord")


def chunk_fixed(df: DataFrame, job: list[str], order: list[str], k: int, bucket: Column | None = None) -> DataFrame:
    """Consecutive chunks of at most k items per job, in ``order``.  The item
    rank is computed per ``bucket`` (monotone in the order; by default ranges
    of the data), so a job holding most items is not ranked in one task."""
    x = exact_rank(df, job, order[0], order[1:], out="_rn", bucket=bucket if bucket is not None else data_buckets(df, order[0]))
    chunk = F.floor((F.col("_rn") - 1) / k).cast("bigint")
    return x.withColumn("chunk", chunk).withColumn(
        "task_id", F.concat_ws("#", *[F.col(j).cast("string") for j in job], F.col("chunk").cast("string"))).drop("_rn")


WEIGHT = "decimal(28,9)"


def _next_starts(at: DataFrame, job: list[str], limit) -> DataFrame:
    """(job, start, next): of each (job, before, start) the first start whose
    ``before`` is at least ``limit`` more; null if there is none.  Starts and
    wanted sums lie in one order, cut into ranges of the sums."""
    n, top = at.agg(F.count(F.lit(1)), F.max("before")).first()
    ranges = max(1, -(-2 * n // ROWS_PER_BUCKET))
    width = float(top or 0) / ranges or 1.0
    rows = at.select(*job, F.col("before").alias("_v"), F.lit(1).alias("_kind"), F.col("start").alias("_found"), F.lit(None).cast("bigint").alias("start")) \
        .unionByName(at.select(*job, (F.col("before") + F.lit(limit).cast(WEIGHT)).alias("_v"), F.lit(0).alias("_kind"),
                               F.lit(None).cast("bigint").alias("_found"), "start"))
    # downwards: the last start met has the least sum that is not below the wanted one
    rows = rows.withColumn("_o", F.struct((-F.col("_v")).alias("v"), (-F.col("_kind")).alias("k")))
    found = carry_forward(rows, job, "_o", "_found", F.floor(-F.col("_v").cast("double") / width), "next")
    return found.where(F.col("_kind") == 0).select(*job, "start", "next")


def chunk_by_weight(df: DataFrame, job: list[str], order: list[str], weight: str, limit: float,
                    bucket: Column | None = None) -> DataFrame:
    """Per job and in ``order``, a chunk closes with the item that brings its
    weight to ``limit``; that item stays in it.  A single item above the limit
    is an error.

    Where the chunk after one that starts at an item would start follows from
    prefix sums alone, for every item at once.  Pointer doubling then finds the
    starts that a job really has: after round k the first 2**k are known, and
    pointers lead 2**k chunks on, so the number of rounds is the logarithm of the
    largest number of chunks, and a job of any size is worked on by all tasks.
    Weights are added as decimals (nine places), so sums are exact.  Starts and
    pointers grow with the items, so no round broadcasts them through the driver."""
    w = F.when(F.col(weight) > limit, F.raise_error(F.lit("item heavier than the chunk limit"))).otherwise(F.col(weight)).cast(WEIGHT)
    x = df.withColumn("_w", w)
    x = in_ranges(x, job, order, "_range") if bucket is None else x.withColumn("_range", bucket)
    x = exact_rank(x, job, order[0], order[1:], out="_rn", bucket=F.col("_range")).drop("_range")
    x = running_sum(x, job, ["_rn"], F.col("_w"), F.floor(F.col("_rn") / ROWS_PER_BUCKET), "_incl")
    x = stored(x.withColumn("_before", (F.col("_incl") - F.col("_w")).cast("decimal(30,9)")).drop("_incl", "_w"), "weights")
    # items of no weight share their sum; only the first of them can start a chunk
    at = x.groupBy(*job, F.col("_before").alias("before")).agg(F.min("_rn").alias("start"))
    jump = stored(_next_starts(at, job, limit).where("next is not null"), "jump")
    starts = [at.where("start = 1").select(*job, "start")]
    while not jump.isEmpty():
        known = functools.reduce(DataFrame.unionByName, starts)
        more = stored(known.join(jump.hint("merge"), [*job, "start"]).select(*job, F.col("next").alias("start")), "starts")
        starts.append(more)
        on = jump.select(*job, F.col("start").alias("next"), F.col("next").alias("_after"))
        jump = stored(jump.join(on.hint("merge"), [*job, "next"]).select(*job, "start", F.col("_after").alias("next")), "jump")
    known = functools.reduce(DataFrame.unionByName, starts).select(*job, F.col("start").alias("_rn"), F.lit(1).alias("_starts"))
    x = x.join(known.hint("merge"), [*job, "_rn"], "left")
    x = running_sum(x, job, ["_rn"], F.coalesce("_starts", F.lit(0)).cast("bigint"), F.floor(F.col("_rn") / ROWS_PER_BUCKET), "_chunk")
    return x.withColumn("chunk", F.col("_chunk") - 1).drop("_chunk", "_starts", "_rn", "_before")


def chunk_hash(key: Column, n: int) -> Column:
    """Stable hash chunk in [0, n)."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("bigint"), F.lit(n))


def chunk_balanced(df: DataFrame, weight: str, key: str, n: int, seed=0) -> DataFrame:
    """Weight-balanced: rank by weight descending (ties by md5(seed|key)), deal
    out in snake order.  Equal weights are ranked in sub-buckets of the hash
    and offset by the counts of the heavier weights, so neither all rows nor
    one frequent weight meet in a task."""
    x = df.withColumn("_w", F.col(weight).cast("double")).withColumn("_u", uniform(seed, key))
    x = exact_rank(x, ["_w"], "_u", [key], out="_r")
    heavier = x.groupBy("_w").agg(F.count(F.lit(1)).alias("_n")).withColumn("_neg", -F.col("_w"))
    heavier = running_sum(heavier, [], ["_neg"], F.col("_n"), data_buckets(heavier, "_neg"), "_upto")
    x = x.join(heavier.select("_w", (F.col("_upto") - F.col("_n")).alias("_before")), "_w")
    r = F.col("_before") + F.col("_r") - 1
    rnd, pos = F.floor(r / n), F.pmod(r, F.lit(n))
    return x.withColumn("chunk", F.when(F.pmod(rnd, F.lit(2)) == 0, pos).otherwise(F.lit(n - 1) - pos).cast("bigint")) \
            .drop("_w", "_u", "_r", "_before")


def chunk_shuffle(df: DataFrame, chunk: list[str], key: str, seed) -> DataFrame:
    """Seeded shuffle inside each chunk: position by md5(seed|key), ranked in
    sub-buckets of the hash."""
    x = exact_rank(df.withColumn("_u", uniform(seed, key)), chunk, "_u", [key], out="position")
    return x.withColumn("position", (F.col("position") - 1).cast("int")).drop("_u")


def task_build(df: DataFrame, task: str, order: str, ref: str, weight: str) -> DataFrame:
    """One row per task: ordered refs and weights, summed weight and a
    sha256 digest of the refs.  Lists are bounded by the chunk size."""
    g = df.groupBy(task).agg(F.sort_array(F.collect_list(F.struct(order, ref, weight))).alias("_items"))
    refs = F.transform("_items", lambda s: s[ref])
    ws = F.transform("_items", lambda s: s[weight])
    return g.select(task, refs.alias("payload_ref"), ws.alias("weights"),
                    F.aggregate(ws, F.lit(0.0), lambda a, v: a + v).alias("weight"),
                    F.size(refs).alias("n_items"),
                    F.sha2(F.array_join(refs, "|"), 256).alias("checksum"))


def ledger_state(events: DataFrame, now: Column, ttl_s: float, delay_s: float, max_attempts: int,
                 bucket: Column | None = None) -> DataFrame:
    """Fold queue events (task_id, op, t) into the state at time ``now``.

    An extend counts only while a lease is live: with no lease since the last
    nack, or after the lease's end, it is ignored.  acked: an ack, or attempts
    (leases) >= max_attempts once the last lease is over.  leased: now is before
    the lease's end (a live extend restarts the ttl).  delayed: until
    ``delay_s`` after a nack or a lease's end; visible otherwise.  Events of
    tasks that were never put are ignored.  An extend is live if, going back
    over events less than the ttl apart, a lease comes before a nack; that is
    carried along per ``bucket`` (monotone in t; by default ranges of the data),
    so a task with most events is not folded in one row or task."""
    g = events.where("task_id is not null").groupBy("task_id").agg(
        F.max((F.col("op") == "put").cast("int")).alias("_put"),
        F.sum((F.col("op") == "lease").cast("int")).alias("attempts"),
        F.max((F.col("op") == "ack").cast("int")).alias("acked")).where("_put = 1").drop("_put")
    ttl, delay = F.lit(float(ttl_s)), F.lit(float(delay_s))
    # repeats change nothing; without them (t, op) orders a task's events
    log = events.where(F.col("op").isin("lease", "nack", "extend") & F.col("task_id").isNotNull() & F.col("t").isNotNull())
    log = stored(log.select("task_id", "t", "op").distinct().withColumn("_o", F.struct("t", "op")), "ledger-log")
    b = bucket if bucket is not None else data_buckets(log, "t")
    log = chunked_lag(log, ["task_id"], "_o", "t", b, "_before")
    marker = F.when(F.col("op") == "lease", True).when(F.col("op") == "nack", False) \
        .when(F.coalesce(F.col("t") < F.col("_before") + ttl, F.lit(False)), None).otherwise(False)
    log = carry_forward(stored(log.withColumn("_mark", marker), "ledger-marks"), ["task_id"], "_o", "_mark", b, "_live")
    last = log.where((F.col("op") == "nack") | F.col("_live")).groupBy("task_id").agg(F.max("_o").alias("_e"))
    # until: end of the running or last lease; back: when a nacked task may be taken again
    nack = F.col("_e.op") == "nack"
    g = g.join(last, "task_id", "left").withColumn("_s", F.struct(
        F.when(~nack, F.col("_e.t") + ttl).alias("until"), F.when(nack, F.col("_e.t") + delay).alias("back")))
    live = F.coalesce(now < F.col("_s.until"), F.lit(False))
    again = F.coalesce(F.col("_s.until") + delay, F.col("_s.back"))
    state = (F.when(F.col("acked") == 1, "acked").when(live, "leased").when(F.col("attempts") >= max_attempts, "acked")
             .when(now < again, "delayed").otherwise("visible"))
    return g.select("task_id", state.alias("state"), F.col("attempts").cast("bigint").alias("attempts"))


def ledger_stats(state: DataFrame) -> DataFrame:
    """Counts per state; drained = everything acked and nothing visible/leased."""
    c = lambda s: F.sum((F.col("state") == s).cast("bigint"))
    g = state.agg(c("visible").alias("visible"), c("leased").alias("leased"), c("delayed").alias("delayed"),
                  c("acked").alias("acked"), F.count(F.lit(1)).alias("total"))
    return g.withColumn("drained", (F.col("acked") == F.col("total")))
