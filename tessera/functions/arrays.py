"""Array-valued score and feature helpers, all higher-order built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def array_sum(arr) -> Column:
    return F.aggregate(_col(arr), F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def once(value, fn) -> Column:
    """``fn`` of a value that is computed once a row.  An expression written into
    a lambda is computed again for each element of the array that it runs over."""
    return F.transform(F.array(_col(value)), fn)[0]


def map_last_wins(entries) -> Column:
    """Map of an array of (key, value) structs; of a repeated key the last value."""
    last = lambda e, keys: F.filter(e, lambda x, i: F.array_position(keys, x["key"]) == F.size(e) - i)
    return F.map_from_entries(once(entries, lambda e: once(F.reverse(F.transform(e, lambda x: x["key"])), lambda keys: last(e, keys))))


def softmax(arr, temperature: float = 1.0) -> Column:
    """exp((x - max) / T) / sum; stable for large logits."""
    t = F.lit(float(temperature))
    e = once(arr, lambda a: once(F.array_max(a), lambda m: F.transform(a, lambda x: F.exp((x - m) / t))))
    return normalise(e)


def log_softmax(arr, temperature: float = 1.0) -> Column:
    """(x - max) / T - ln(sum(exp((x - max) / T))); finite where softmax underflows."""
    t = F.lit(float(temperature))
    z = once(arr, lambda a: once(F.array_max(a), lambda m: F.transform(a, lambda x: (x - m) / t)))
    less = lambda z: once(F.log(array_sum(F.transform(z, lambda y: F.exp(y)))), lambda s: F.transform(z, lambda x: x - s))
    return once(z, less)


def normalise(arr) -> Column:
    return once(arr, lambda a: once(array_sum(a), lambda s: F.transform(a, lambda x: x / s)))


def argmax(arr) -> Column:
    """0-based index of the largest entry; ties go to the lowest index."""
    a = _col(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def rotate_back(arr, k) -> Column:
    """Undo a class shift of k: element i of the result is element (i+k) mod n."""
    a = _col(arr)
    k = _col(k) if not isinstance(k, int) else F.lit(k)
    n = F.size(a)
    kk = F.pmod(k, n)
    return F.concat(F.slice(a, kk + 1, n - kk), F.slice(a, F.lit(1), kk))


def rotate_forward(arr, k) -> Column:
    a = _col(arr)
    k = _col(k) if not isinstance(k, int) else F.lit(k)
    n = F.size(a)
    return rotate_back(a, n - F.pmod(k, n))


def pad_to(arr, n: int, fill: float = 0.0) -> Column:
    a = _col(arr)
    return F.concat(a, F.array_repeat(F.lit(fill).cast("float"), F.greatest(F.lit(n) - F.size(a), F.lit(0))))


def permute(arr, pattern) -> Column:
    """out[j] = arr[pattern[j]] (0-based pattern)."""
    a = _col(arr)
    return F.transform(_col(pattern), lambda i: F.element_at(a, i + 1))


def invert_pattern(pattern) -> Column:
    """Inverse permutation: out[i] = position of i in pattern."""
    p = _col(pattern)
    return F.transform(F.sequence(F.lit(0), F.size(p) - 1),
                       lambda i: (F.array_position(p, i) - 1).cast("int"))
