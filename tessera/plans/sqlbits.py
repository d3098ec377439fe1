"""DuckDB twins of the Column helpers, used to write the oracles."""

from __future__ import annotations

TWO_52 = "4503599627370496.0"


def key_sql(*exprs: str) -> str:
    return ", ".join(f"CAST({e} AS VARCHAR)" for e in exprs)


def u_sql(seed, *exprs: str) -> str:
    """Twin of functions.hashing.uniform."""
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', {key_sql(*exprs)})), 1, 13))::BIGINT / {TWO_52})"


def bucket_sql(n: int, seed, *exprs: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', {key_sql(*exprs)})), 1, 15))::BIGINT % {n})"


def digest_sql(*exprs: str) -> str:
    return f"md5(concat_ws('|', {key_sql(*exprs)}))"


# lineitem has no unique key short of these six columns
LI_KEY_SQL = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
              "CAST(round(l_extendedprice * 100) AS BIGINT)", "CAST(CAST(l_shipdate AS DATE) AS VARCHAR)"]


def clip_sql(x: str, lo, hi) -> str:
    return f"least(greatest({x}, {lo}), {hi})"


def probit_sql(p: str) -> str:
    """Twin of functions.numeric.probit."""
    from tessera.functions import numeric as N

    def poly(coefs, x):
        out = f"{coefs[0]!r}::DOUBLE"
        for c in coefs[1:]:
            out = f"({out} * {x} + {c!r}::DOUBLE)"
        return out

    p = f"CAST({p} AS DOUBLE)"
    q, lo, hi = f"({p} - 0.5)", f"sqrt(-2.0 * ln({p}))", f"sqrt(-2.0 * ln(1.0 - {p}))"
    tail = lambda x: f"{poly(N._C, x)} / ({poly(N._D, x)} * {x} + 1.0)"
    r = f"({q} * {q})"
    return (f"CASE WHEN {p} < {N._P_LOW} THEN {tail(lo)} WHEN {p} > {1 - N._P_LOW} THEN -({tail(hi)}) "
            f"ELSE {poly(N._A, r)} * {q} / ({poly(N._B, r)} * {r} + 1.0) END")


def soft_clip_sql(x: str, lo: str, hi: str) -> str:
    a = f"greatest({x}, ({lo}) - ln(1 + abs({x})))"
    return f"least({a}, ({hi}) + ln(1 + abs({a})))"
