"""Left joins on equal keys, on ordinal ranges, and to the next ordinal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_RANGES_PER_KEY = 64
# A block of this level holds half of all 64-bit numbers.
TOP_LEVEL = 63

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    hit: str | None = None,
) -> DataFrame:
    """Left equality join that adds the named right columns and, as ``hit``, whether a row matched.

    Whether the right side is broadcast is left to its measured size.
    """
    right = right.select(*keys, *columns, *([F.lit(True).alias(hit)] if hit else []))
    joined = left.join(right, list(keys), "left").select(*left.columns, *columns, *([hit] if hit else []))
    return joined.withColumn(hit, F.col(hit).isNotNull()) if hit else joined


def range_join(
    left: DataFrame,
    ranges: DataFrame,
    keys: Sequence[str],
    ordinal: str,
    low: str,
    high: str,
    columns: Sequence[str],
    max_ranges_per_key: int = MAX_RANGES_PER_KEY,
) -> DataFrame:
    """Every left row with each range of its key that contains its ordinal, both ends included, or nulls.

    Null bounds contain nothing; overlapping ranges repeat the left row. Ordinals and bounds have to be of an
    integral type, over all of which ranges may extend; a range without end ends at the type's largest value.
    If no key has more than ``max_ranges_per_key`` ranges, comparing a row with all ranges of its key is
    cheap, and a plain join does it. Otherwise ranges are looked up by the blocks they consist of.
    """
    for df, column in ((left, ordinal), (ranges, low), (ranges, high)):
        if not isinstance(df.schema[column].dataType, _INTEGRAL):
            raise TypeError(f"{column} has to be of an integral type")
    ranges = ranges.select(*keys, low, high, *columns).where(F.col(low) <= F.col(high))
    most = ranges.groupBy(*keys).count().agg(F.max("count")).first()[0]
    if (most or 0) <= max_ranges_per_key:
        right = ranges.withColumnsRenamed({k: f"_range_{k}" for k in keys})
        return left.join(right, _equal(keys) & F.col(ordinal).between(F.col(low), F.col(high)), "left").select(
            *left.columns, *columns
        )
    return _range_join_by_blocks(left, ranges, keys, ordinal, low, high, columns)


def _equal(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(key) == F.col(f"_range_{key}"))
    return condition


def _range_join_by_blocks(left, ranges, keys, ordinal, low, high, columns) -> DataFrame:
    """Range join as an equality join, so that only matching pairs are formed.

    A block of level k holds the 2**k ordinals that share ``ordinal >> k``. Each range is a disjoint
    union of blocks, at most two per level, and an ordinal lies in one block per level. A range contains
    an ordinal exactly when they share a block, and then they share exactly one.
    """
    blocks = ranges.select(
        *[F.col(k).alias(f"_range_{k}") for k in keys],
        *columns,
        F.explode(_blocks(F.col(low).cast("long"), F.col(high).cast("long"))).alias("_block"),
    ).select("*", F.col("_block.level").alias("_level"), F.col("_block.number").alias("_number"))
    levels = blocks.agg(F.collect_set("_level")).scalar()

    # One probe per distinct ordinal: copies of a left row are not multiplied by the number of levels.
    probes = left.select(*keys, F.col(ordinal).alias("_ordinal")).dropna().distinct()
    probes = probes.select("*", F.explode(levels).alias("_probe_level"))
    number = F.expr("shiftright(CAST(_ordinal AS BIGINT), _probe_level)")
    shared = _equal(keys) & (F.col("_probe_level") == F.col("_level")) & (number == F.col("_number"))
    hits = probes.join(blocks, shared).select(
        *[F.col(k).alias(f"_hit_{k}") for k in keys], F.col("_ordinal"), *columns
    )

    same = F.col(ordinal) == F.col("_ordinal")
    for key in keys:
        same = same & (F.col(key) == F.col(f"_hit_{key}"))
    return left.join(hits, same, "left").select(*left.columns, *columns)


def _blocks(low: Column, high: Column) -> Column:
    """The blocks a range consists of, as array<struct<level, number>>, largest blocks in the middle.

    At level k the blocks that are whole within the range run from ``first`` to ``last``. An odd first block has
    no partner to merge with, nor has an even last one; those stay at this level. At the top level the only
    blocks are -1 and 0, which have none either. Nothing here leaves 64 bits.
    """
    right = lambda n, by: F.call_function("shiftright", n, by)

    def at_level(level: Column) -> Column:
        # The bits of an ordinal that tell its place within a block.
        places = F.when(level > 0, F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), 64 - level))
        places = F.coalesce(places, F.lit(0).cast("long"))
        first = right(low, level) + F.when(low.bitwiseAND(places) != 0, 1).otherwise(0)
        last = right(high, level) - F.when(high.bitwiseAND(places) != places, 1).otherwise(0)
        odd = lambda n: n.bitwiseAND(F.lit(1)) == 1
        return F.array(
            F.when((first <= last) & odd(first), F.struct(level.alias("level"), first.alias("number"))),
            F.when((first <= last) & ~odd(last), F.struct(level.alias("level"), last.alias("number"))),
        )

    # A block of a level above that of the range's length would stand out of it.
    size = high.cast("double") - low.cast("double") + 2
    highest = F.least(F.ceil(F.log2(size)).cast("int") + 1, F.lit(TOP_LEVEL))
    per_level = F.transform(F.sequence(F.lit(0), highest), at_level)
    return F.filter(F.flatten(per_level), lambda block: block.isNotNull())


def next_ordinal_join(
    left: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    ordinal: str,
    columns: dict[str, str],
) -> DataFrame:
    """Every left row with the columns of the row of its key numbered one higher, or nulls.

    ``columns`` maps columns of ``rows`` to output names. ``rows`` should be unfiltered: the next
    ordinal counts even if it would not qualify for ``left`` itself.
    """
    following = rows.select(
        *keys,
        (F.col(ordinal) - 1).alias("_at"),
        *[F.col(c).alias(name) for c, name in columns.items()],
    ).withColumnsRenamed({k: f"_range_{k}" for k in keys})
    matched = _equal(keys) & (F.col(ordinal) == F.col("_at"))
    return left.join(following, matched, "left").select(*left.columns, *columns.values())
