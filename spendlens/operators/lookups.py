"""Lookups that keep the row count, and key membership."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from spendlens.functions import exprs
from spendlens.operators.dedup import keep_first
from spendlens.session import materialize

def spread_join(facts: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a side that is unique on ``keys`` to facts that may be heavily skewed on them.

    The side is stored first, which gives it a known size in bytes: Spark broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold``, and otherwise the adaptive skew join divides the rows of hot keys,
    null keys included. It can not do so when the side comes straight out of a window or an aggregate.
    """
    return facts.join(materialize(side, "join-side"), list(keys), how)


def dealt_join(rows: DataFrame, part: str, sides: Sequence[tuple[Sequence[str], DataFrame, str]]) -> DataFrame:
    """Join several sides to rows that are moved once for all of them.

    ``part`` deals the rows out, whatever their keys, and should number many small parts. A side is (keys, table, "inner" or "left"): the table has
    ``part``, the keys and the columns to add, one row for every part and key that asks for it. Rows and sides are dealt alike, so within
    ``session.dealt_alike`` the joins need no other exchange, and a hot key is as large as its share of one part. No row is
    sorted for them: what one task asks for is hashed.
    """
    joined = rows.repartition(part)
    for keys, table, how in sides:
        joined = joined.join(table.repartition(part).hint("shuffle_hash"), [part, *keys], how)
    return joined


def unique_side(dim: DataFrame, fact_key: str, dim_key: str, columns: Mapping[str, str]) -> DataFrame:
    """The first row of every key of ``dim``, under the names of the facts."""
    unique = keep_first(dim.where(F.col(dim_key).isNotNull()).select(dim_key, *columns), [dim_key])
    return unique.select(F.col(dim_key).alias(fact_key), *[F.col(old).alias(new) for old, new in columns.items()])


def left_lookup(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    columns: Mapping[str, str],
) -> DataFrame:
    """Add columns of ``dim`` to ``facts`` without changing the number of rows.

    ``columns`` maps the dimension column to its name in the result.
    """
    joined = spread_join(facts, unique_side(dim, fact_key, dim_key, columns), [fact_key])
    return joined.select(*facts.columns, *columns.values())


def current_versions(dim_employee: DataFrame) -> DataFrame:
    return dim_employee.where(F.col("is_current"))


def key_text(column: Column) -> Column:
    """Trimmed key text, null for the texts that mean "no reference"."""
    return F.trim(exprs.blank_to_null(column, exprs.FK_NULL_TOKENS))


FILTER_BITS = 1 << 26


def _filter_place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def key_filter(parents: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """(bucket, bits): the hashes of all keys as bitmaps of 4 KB, ``bits / 8`` bytes together however many keys there are."""
    place = _filter_place(F.col(key), bits)
    return parents.where(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits"))


def maybe_known(keys: DataFrame, key: str, known: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``keys`` with the flag ``_maybe``: false where the filter proves that the key is not among the parents."""
    place = _filter_place(F.col(key), bits)
    position = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("shiftright(_byte, cast(_position % 8 as int)) & 1") == 1
    probed = keys.withColumns({"_bucket": F.bitmap_bucket_number(place), "_position": position})
    # the filter's size is bounded by its bits
    return probed.join(F.broadcast(known), "_bucket", "left").withColumn("_byte", byte).withColumn(
        "_maybe", F.coalesce(is_set, F.lit(False))).drop("_bucket", "_position", "_bits", "_byte")


def orphan_keys(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, filter_bits: int | None = None
) -> DataFrame:
    """Child keys without a parent and how many rows carry each.

    The child is counted per key before the shuffle, so a hot key is one row by then. With ``filter_bits`` a filter of the
    parents' keys comes first: what it rejects is an orphan for certain, and only the rest is joined.
    """
    keys = (
        child.select(key_text(F.col(child_key)).alias(child_key))
        .where(F.col(child_key).isNotNull())
        .groupBy(child_key).agg(F.count("*").alias("row_count"))
    )
    parents = parent.select(F.trim(F.col(parent_key).cast("string")).alias(child_key))
    if not filter_bits:
        return keys.join(parents, child_key, "left_anti")
    sifted = maybe_known(keys, child_key, key_filter(parents, child_key, filter_bits), filter_bits)
    joined = sifted.where("_maybe").join(parents, child_key, "left_anti")
    return sifted.where("NOT _maybe").unionByName(joined).drop("_maybe")


def counts_by(df: DataFrame, columns: Sequence[str], name: str = "row_count") -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias(name))
