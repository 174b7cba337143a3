"""Bit fields: which rows may belong to a set, in bounded space.

A join that keeps few rows of a large table need not shuffle all of it: rows
whose bit is not set are settled where they lie, the others go to the join. A
field of more numbers than it has room for lets more through and stays exact.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 20  # the most longs of a field (8 MB)
BITS = 16  # of a field for each number, of which a bit is set


def bit_field(numbers: DataFrame, bits: int = BITS) -> tuple[Column, int]:
    """The distinct 64-bit numbers ``h`` as an array of longs with a bit set for each, and the number of bits."""
    words = min(WORDS, 1 << (numbers.count() * bits // 64).bit_length())
    slot = F.pmod("h", F.lit(64 * words))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(slot, F.lit(64)).cast("int"))
    longs = numbers.groupBy(F.floor(slot / 64).alias("id")).agg(F.bit_or(bit).alias("bits"))
    every = numbers.sparkSession.range(words).join(longs, "id", "left")
    listed = F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    return every.agg(listed["bits"].alias("field")).scalar(), 64 * words


def may_hold(field: tuple[Column, int], h: Column) -> Column:
    """Whether the number's bit is set."""
    longs, bits = field
    return F.getbit(F.get(longs, F.floor(F.pmod(h, F.lit(bits)) / 64).cast("int")), F.pmod(h, F.lit(64)).cast("int")) == 1


def _named(ids: DataFrame, column: str) -> Column:
    field = bit_field(ids.select(F.xxhash64(column).alias("h")).distinct())
    return may_hold(field, F.xxhash64(F.col(column)))


def only(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose ``column`` may be among ``ids``: all that are, and few others. ``ids`` is read more than once."""
    return docs.filter(_named(ids, column))


def without(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose ``column`` is not among ``ids``, unchanged, nulls included. ``ids`` is read more than once."""
    named = _named(ids, column)
    settled = docs.filter(named).join(ids.select(column), column, "left_anti").select(*docs.columns)
    return docs.filter(~named).unionByName(settled)
