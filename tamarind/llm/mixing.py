"""Sources mixed to target weights by Poisson replication.

Each document is repeated as often as a Poisson variable with its source's rate
says. The variable is drawn by inverting the distribution at a number that a
hash of the document's id and a seed gives, so a rerun repeats the same
documents, and documents don't depend on each other. A large rate is drawn as a
sum of variables of smaller rates, each at a hash of its own. The copies are
dealt out and ordered by another hash, a global shuffle.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.llm.workspace import Workspace

SEED = "mix-1"
EXPONENT = 0.5  # of a source's size, where no weights are given
EPOCHS = 1.0
SOURCES = 2000  # rates that every task gets; about 7 KB each at most
SPREAD = 64  # parts of a source where there are more
LARGEST = 500.0  # rate of one inverted variable; exp(-rate) is 0 in doubles from 746 on


def uniform(key: Column, seed: str, part: Column) -> Column:
    """A number from 0 to 1 (1 excluded) of 52 bits; ``part`` counts the numbers of a key from 0 on."""
    tail = F.when(part > 0, F.concat(F.lit("|"), part.cast("string"))).otherwise(F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(f"|{seed}"), tail)), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: dict[str, float] | None = None, exponent: float = EXPONENT, epochs: float = EPOCHS) -> DataFrame:
    """(mix_source, rate): how often a document of each source is wanted on average.

    The mixture is to have ``epochs`` times the characters of ``docs``, shared
    out by ``weights``, or by each source's characters to the power ``exponent``.
    A source without weight has the rate 0, as has one without characters.
    """
    size = docs.groupBy(F.col("source").cast("string").alias("mix_source")).agg(F.sum(F.length(F.coalesce("text", F.lit("")))).cast("double").alias("size"))
    if weights is None:
        size = size.withColumn("weight", F.pow("size", F.lit(exponent)))
    else:
        known = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.lit(None).cast("map<string,double>")
        size = size.withColumn("weight", F.coalesce(known[F.col("mix_source")].cast("double"), F.lit(0.0)))
    total = size.agg(F.sum("size").alias("sizes"), F.sum(F.when(F.col("size") > 0, F.col("weight"))).alias("weights"))
    share = F.col("weight") / F.col("weights") * F.col("sizes") * epochs / F.col("size")
    # One row of totals meets a row for each source.
    return size.join(F.broadcast(total)).select("mix_source", F.when((F.col("size") > 0) & (F.col("weights") > 0), share).otherwise(F.lit(0.0)).alias("rate"))


def _cumulative(rate: Column) -> Column:
    """P(X <= k) for k from 0 on, until the rest is below the resolution of uniform()."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct(F.exp(-rate).alias("term"), F.array(F.exp(-rate)).alias("sums"))

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * rate / k
        return F.struct(term.alias("term"), F.concat(acc["sums"], F.array(F.element_at(acc["sums"], -1) + term)).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["sums"])


def replicate(docs: DataFrame, rate: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` with each row as often as its source's rate says, in random order.

    Adds ``mix_copy`` (1 and up), ``mix_copies`` and ``mix_key``, by which rows
    are dealt out and ordered; columns of these names give way. Rows without
    source are a source of their own. Rows that repeat a doc_id are repeated
    alike; those without one are drawn by their text. A rate of 0 leaves none;
    an empty table gives no rows.

    Rows meet their source's rate where they lie: up to ``SOURCES`` rates are
    handed to all tasks; beyond, rows are spread over ``SPREAD`` parts of a source.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.coalesce("text", F.lit(""))))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"), F.col("source").cast("string").alias("of"))
    # A sum of independent Poisson variables is one of the summed rates.
    parts = F.greatest(F.ceil(F.col("rate") / LARGEST), F.lit(1)).cast("int")
    sums = rate.select("mix_source", "rate", parts.alias("parts"), _cumulative(F.col("rate") / parts).alias("sums"))
    sums = Workspace(docs.sparkSession, "mixing").keep(sums, "rates")
    same = F.col("of").eqNullSafe(F.col("mix_source"))
    if sums.count() <= SOURCES:
        both = rows.join(F.broadcast(sums), same)
    else:
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SPREAD)).cast("int"))
        sums = sums.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        both = rows.join(sums, same & (F.col("salt") == F.col("part")))
    numbers = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda part: uniform(F.col("key"), seed, part))
    drawn = F.aggregate(numbers, F.lit(0).cast("long"), lambda n, u: n + F.size(F.filter("sums", lambda p: p <= u)))
    both = both.withColumn("copies", F.when(F.col("rate") > 0, drawn).otherwise(0).cast("long")).where("copies > 0")
    both = both.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    order = F.substring(F.md5(F.concat("key", F.lit("|"), F.col("copy").cast("string"), F.lit(f"|{seed}|order"))), 1, 16)
    added = {"mix_copy": F.col("copy"), "mix_copies": F.col("copies"), "mix_key": order}
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in added]
    out = both.select(*kept, *[c.alias(name) for name, c in added.items()])
    return out.repartition("mix_key").sortWithinPartitions("mix_key")


def mixture(docs: DataFrame, weights: dict[str, float] | None = None, exponent: float = EXPONENT, epochs: float = EPOCHS, seed: str = SEED) -> DataFrame:
    """:func:`replicate` at the :func:`rates` of ``docs`` (doc_id, text, source, others)."""
    return replicate(docs, rates(docs, weights, exponent, epochs), seed)
