"""Seeded, partition-independent randomness.

``rand(seed)`` depends on how rows fall into partitions, so a re-run on a
different cluster (or a retried task after executor loss with a changed
split) would draw different numbers.  Every draw here is a pure function of
``(seed, key)``: md5 of the key text, leading 52 bits as an integer.  The same
value comes out of DuckDB, which is how the oracles reproduce samples.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_52 = float(1 << 52)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_string(*cols) -> Column:
    return F.concat_ws("|", *[_col(c).cast("string") for c in cols])


def digest(*cols) -> Column:
    """Full 128-bit md5 hex digest of the key; used as a collision-safe row id."""
    return F.md5(key_string(*cols))


def uniform(seed, *cols) -> Column:
    """Uniform double in [0, 1) from md5(seed|key)."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[_col(c).cast("string") for c in cols]))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint") / F.lit(_TWO_52)


def hash_bucket(n: int, seed, *cols) -> Column:
    """Stable bucket in [0, n) from md5(seed|key)."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[_col(c).cast("string") for c in cols]))
    return F.pmod(F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint"), F.lit(n))
