"""Order of the rows of conversations, without a conversation in one task.

Rows lie by conversation and turn (nulls first); rows of one turn by role,
then by the first characters of the text and a digest of role and text.  Rows
that agree in all of that are alike, so their order does not matter: a salt
deals them over several partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Alike rows are dealt over so many salts.
SALTS = 1024
#: Characters of the text that order rows of one turn before their digest does.
HEAD = 16

ORDER = ["conv_id", "turn", "role", "head", "digest", "salt"]


def ordered_columns(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text and more) with head, digest and salt."""
    return rows.withColumns({
        "head": F.substring("text", 1, HEAD),
        "digest": F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), F.col("role"), F.col("text")), 256)),
        "salt": F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")})


def in_order(rows: DataFrame) -> DataFrame:
    """Partitions that follow each other in the order of ``ORDER``, sorted; a
    long conversation spans several.  ``seq`` rises over all of them and its
    bits from 33 up are the partition's number."""
    return rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).withColumn("seq", F.monotonically_increasing_id())


def part_of(seq: str = "seq") -> Column:
    return F.shiftright(F.col(seq), 33).cast("int")
