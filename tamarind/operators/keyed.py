"""Joins and filters whose NULL handling differs from a plain equi-join."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.session import cut_lineage


def join_null_safe(left: DataFrame, right: DataFrame, on: Iterable[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL keys match each other; keys come from the left."""
    on = list(on)
    renamed = right.select(
        *[F.col(c).alias(f"__r_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    cond = None
    for c in on:
        part = left[c].eqNullSafe(renamed[f"__r_{c}"])
        cond = part if cond is None else cond & part
    return left.join(renamed, cond, how).drop(*[f"__r_{c}" for c in on])


def without_keys(df: DataFrame, key: str, listed: DataFrame, listed_key: str) -> DataFrame:
    """Rows whose key is not listed; rows with a NULL key stay."""
    keys = listed.where(F.col(listed_key).isNotNull()).select(F.col(listed_key).alias(key)).distinct()
    return df.join(keys, key, "left_anti")


def not_in_keys(df: DataFrame, key: str, listed: DataFrame, listed_key: str) -> DataFrame:
    """``key NOT IN (non-null list)``: a NULL key is removed as well."""
    return without_keys(df.where(F.col(key).isNotNull()), key, listed, listed_key)


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill the named columns where a left join found nothing."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in defaults.items()}
    )


def keys_seen_once(df: DataFrame, key: str) -> DataFrame:
    """Rows of keys that occur exactly once. One pass: any value of a single
    row is its own minimum, so no join back is needed."""
    rest = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("__n"), *[F.min(c).alias(c) for c in rest])
        .where(F.col("__n") == 1)
        .select(*df.columns)
    )


PART_ROWS = 1 << 19  # rows of a key that one task should hold at most
MOST_HEAVY = 10_000  # keys that are cut; any other key has less than this fraction of all rows


def heavy_keys(df: DataFrame, on: Sequence[str], part_rows: int = PART_ROWS) -> DataFrame:
    """(keys, __parts): the keys of more than ``part_rows`` rows and how many
    parts each is to be cut into. Counted over all rows and written once, so
    that both sides of a join see the same parts; ``MOST_HEAVY`` rows at most.
    """
    known = df
    for c in on:
        known = known.where(F.col(c).isNotNull())
    counts = known.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > part_rows)
    parts = F.ceil(F.col("__n") / part_rows).cast("int").alias("__parts")
    return cut_lineage(counts.orderBy(F.desc("__n"), *on).limit(MOST_HEAVY).select(*on, parts), "heavy-keys")


def spread_join(
    big: DataFrame,
    small: DataFrame,
    on: Iterable[str],
    by: str,
    ways: int | None = None,
    counted: DataFrame | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Inner equi-join that cuts the heavy keys of ``big`` into parts.

    Rows of a heavy key are dealt out by the hash of a column that varies within
    it, and only such keys are repeated in ``small``, once for each part; all
    other keys meet as in a plain join. Keys are counted in ``counted``, for
    instance what ``big`` is computed from, or in ``big``. ``ways`` cuts every key
    into that many parts without counting.
    """
    on = list(on)
    if ways is not None:
        salted = big.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(ways)).cast("int"))
        repeated = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
        return repeated.join(salted, [*on, "__salt"], "inner").drop("__salt")
    heavy = F.broadcast(heavy_keys(big if counted is None else counted, on, part_rows))  # bounded by MOST_HEAVY
    parts = F.coalesce("__parts", F.lit(1))
    salted = big.join(heavy, on, "left").withColumn("__salt", F.pmod(F.xxhash64(by), parts).cast("int")).drop("__parts")
    repeated = small.join(heavy, on, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return repeated.join(salted, [*on, "__salt"], "inner").drop("__salt")
