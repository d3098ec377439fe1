"""Column-level helpers: every function returns a ``pyspark.sql.Column`` built
from JVM built-ins, so callers stay inside whole-stage codegen."""

from tessera.functions.hashing import hash_bucket, key_string, uniform, digest  # noqa: F401
from tessera.functions.arrays import (  # noqa: F401
    argmax, array_sum, invert_pattern, normalise, pad_to, permute, rotate_back, rotate_forward,
    softmax,
)
from tessera.functions.numeric import clip, probit, soft_clip  # noqa: F401
