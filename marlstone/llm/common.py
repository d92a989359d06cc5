"""What the operators of this subpackage share: text splitting, and membership filters of a checked size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import free, shared_dir, stored

__all__ = ["free", "shared_dir", "stored"]

#: The white space of every contract here: space, and U+0009 to U+000D.
SPACE = r"[ \t-\r]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def let(value: Column, body) -> Column:
    """body(value), with value computed once a row however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Array of the runs without white space; null text gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def fresh(df: DataFrame, name: str) -> str:
    """name, with as many underscores after it as it takes to be no column of df."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bits of a membership filter for each key: about one in twenty other keys passes.
BITS_A_KEY = 16
#: The largest filter that is broadcast, in bits: 16 MB. More keys than fit get no filter but a shuffled join.
MAX_FILTER_BITS = 1 << 27
#: Bits of one block of Spark's bitmap functions (fixed by Spark).
BLOCK_BITS = 32768


@dataclass
class Filter:
    """A set of keys as (block, bitmap) rows over bits bits; without rows it holds every key."""

    bits: int
    blocks: DataFrame | None

    def free(self) -> None:
        if self.blocks is not None:
            free(self.blocks)


def filter_bits(keys: int) -> int:
    """Bits for that many keys: a power of two, a block at least; 0 where they exceed what may be broadcast."""
    bits = max(BLOCK_BITS, 1 << max(0, keys * BITS_A_KEY - 1).bit_length())
    return bits if bits <= MAX_FILTER_BITS else 0


def membership_filter(keys: DataFrame, key: str, name: str) -> Filter:
    """The filter of a stored table's keys (nulls aside), sized by their number."""
    bits = filter_bits(keys.count())
    if not bits:
        return Filter(0, None)
    bit = F.pmod(F.xxhash64(key), F.lit(bits))
    blocks = (
        keys.where(F.col(key).isNotNull())
        .select(bit.alias("bit"))
        .groupBy(F.floor(F.col("bit") / BLOCK_BITS).alias("block"))
        .agg(F.bitmap_construct_agg(F.pmod("bit", F.lit(BLOCK_BITS))).alias("bitmap"))
    )
    return Filter(bits, stored(blocks, name))


def flagged(rows: DataFrame, key: str, held: Filter, flag: str) -> DataFrame:
    """rows with a boolean column flag: whether the filter may hold the key. True for all that are in it, and a few more."""
    if held.blocks is None:
        return rows.withColumn(flag, F.lit(True))
    bit, block, bitmap = fresh(rows, "_bit"), fresh(rows, "_block"), fresh(rows, "_bitmap")
    rows = rows.withColumn(bit, F.pmod(F.xxhash64(F.col(key)), F.lit(held.bits))).withColumn(block, F.floor(F.col(bit) / BLOCK_BITS))
    blocks = held.blocks.select(F.col("block").alias(block), F.col("bitmap").alias(bitmap))
    at = F.pmod(F.col(bit), F.lit(BLOCK_BITS))
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(at, F.lit(8)))), F.lit(2)) == 1
    # MAX_FILTER_BITS bounds what is broadcast
    return rows.join(F.broadcast(blocks), block, "left").withColumn(flag, F.coalesce(is_set, F.lit(False))).drop(bit, block, bitmap)


def may_hold(rows: DataFrame, key: str, held: Filter) -> DataFrame:
    """The rows whose key the filter may hold: all that are in it, and a few more, or all where there are too many keys."""
    if held.blocks is None:
        return rows
    flag = fresh(rows, "_held")
    return flagged(rows, key, held, flag).where(F.col(flag)).drop(flag)


def without(rows: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """The rows whose key is not among keys(key), in which nulls name nothing.

    A filter parts the rows that cannot be among them: these, mostly all, are not shuffled. Where the keys are too
    many for a filter, all rows are joined.
    """
    keys = stored(keys.select(key).where(F.col(key).isNotNull()).distinct(), name)
    held = membership_filter(keys, key, f"{name}-filter")
    if held.blocks is None:
        return rows.join(keys, key, "left_anti")
    flag = fresh(rows, "_held")
    seen = flagged(rows, key, held, flag)
    doubtful = seen.where(F.col(flag)).drop(flag).join(keys, key, "left_anti").select(*rows.columns)
    return seen.where(~F.col(flag)).drop(flag).select(*rows.columns).unionByName(doubtful)


#: At most this many keys are hot: each stands for more than one in HOT_KEYS of all rows.
HOT_KEYS = 1000


def skew_join(rows: DataFrame, keyed: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """rows joined to keyed, a stored table with a row for each key and the number of rows under it as weight.

    Keys with more than one in HOT_KEYS of the rows are fewer than HOT_KEYS: they are broadcast, and their rows
    stay where they are. All other rows are joined by a shuffle in which no key is hot.
    """
    total = keyed.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) * HOT_KEYS > F.lit(total)
    hot = keyed.where(is_hot)
    if total < HOT_KEYS or hot.isEmpty():
        return rows.join(keyed, keys)
    cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(keyed.where(~is_hot), keys)
    return rows.join(F.broadcast(hot), keys).unionByName(cold)
