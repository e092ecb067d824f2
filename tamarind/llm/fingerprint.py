"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle whose hash lies below a fixed fraction of the hash
range, so its size follows the text's and two sketches of very unequal texts
still tell how much of the smaller one the larger one holds. Sketches of parts
merge into the sketch of the whole by a union. A text none of whose hashes is
kept has its least hash instead, so that it can be compared as well.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = 5
BELOW = "2"  # hex digits below it: two of sixteen, an eighth of all hashes
DIGITS = 16


def with_sketch(df: DataFrame, text: str, out: str, words: int = WORDS, below: str = BELOW) -> DataFrame:
    """Adds ``out``: an ascending array of the kept hashes (``DIGITS`` hex digits each) of ``text``.

    Words are what white space (space, \\t to \\r) separates in the lower-cased
    text. A text of fewer than ``words`` words is one shingle; a text without
    words, or a null, has an empty array.
    """
    # One projection for each step: an expression that a lambda uses would be computed anew for every element.
    split = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[ \\t\\n\\u000B\\f\\r]+")
    df = df.withColumn("_parts", F.filter(split, lambda w: w != ""))
    last = F.greatest(F.size("_parts") - words + 1, F.lit(1))
    one = lambda i: F.substring(F.md5(F.concat_ws(" ", F.slice("_parts", i, words))), 1, DIGITS)
    hashes = F.when(F.size("_parts") > 0, F.transform(F.sequence(F.lit(1), last), one)).otherwise(F.array().cast("array<string>"))
    df = df.withColumn("_hashes", hashes).drop("_parts")
    df = df.withColumn("_low", F.filter("_hashes", lambda h: h < below)).withColumn("_least", F.array_min("_hashes")).drop("_hashes")
    return df.withColumn(out, _kept("_low", "_least")).drop("_low", "_least")


def _kept(low: str, least: str) -> Column:
    return F.when(F.size(low) > 0, F.array_sort(F.array_distinct(low))).otherwise(F.array_compact(F.array(least)))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketches; 1 if both are empty."""
    common = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - common
    return F.when(total == 0, F.lit(1.0)).otherwise(common / total)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` holds; 1 if ``a`` is empty."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def merged(df: DataFrame, sketches: str, out: str, below: str = BELOW) -> DataFrame:
    """Adds ``out``: the sketch of several texts taken together, from an array of their sketches."""
    df = df.withColumn("_all", F.flatten(sketches))
    df = df.withColumn("_low", F.filter("_all", lambda h: h < below)).withColumn("_least", F.array_min("_all")).drop("_all")
    return df.withColumn(out, _kept("_low", "_least")).drop("_low", "_least")


def with_next(docs: DataFrame, columns: list[str], partitions: int) -> DataFrame:
    """``doc_id`` and ``columns`` of each row, and as ``next_<column>`` those of the
    row with the next doc_id; after the last comes the first.

    Rows are dealt into ranges of doc_id by percentiles of the ids alone, so the
    rows are shuffled once and no window spans the table. Each range also gets
    a copy of the first rows of the range after it. Rows without doc_id come
    first, rows that repeat one are in the order of their columns.
    """
    cuts = docs.where("doc_id IS NOT NULL").agg(F.percentile_approx("doc_id", [i / partitions for i in range(1, partitions)], 10000).alias("cuts")).first().cuts
    bucket = F.coalesce(F.size(F.filter(F.array(*[F.lit(c) for c in sorted(set(cuts or []))]).cast("array<long>"), lambda c: c <= F.col("doc_id"))), F.lit(0))
    docs = docs.select("doc_id", *columns).withColumn("bucket", F.when(F.col("doc_id").isNull(), 0).otherwise(bucket))
    firsts = docs.groupBy("bucket").agg(F.min(F.struct("doc_id")).alias("f")).select("bucket", F.col("f.doc_id").alias("doc_id")).orderBy("bucket").collect()
    if not firsts:
        return docs.select("doc_id", *columns, *[F.col(c).alias(f"next_{c}") for c in columns])
    # One row for each range: its first id, and the range before it, whose last row it follows.
    before = {f.bucket: firsts[i - 1].bucket for i, f in enumerate(firsts)}
    first_of = F.create_map(*[F.lit(x) for f in firsts for x in (f.bucket, f.doc_id)]) if any(f.doc_id is not None for f in firsts) else None
    to = F.create_map(*[F.lit(x) for b, p in before.items() for x in (b, p)])
    is_first = F.col("doc_id").eqNullSafe(first_of[F.col("bucket")]) if first_of is not None else F.lit(True)
    places = F.when(is_first, F.array(F.struct(F.col("bucket").alias("at"), F.lit(False).alias("extra")), F.struct(to[F.col("bucket")].alias("at"), F.lit(True).alias("extra"))))
    places = places.otherwise(F.array(F.struct(F.col("bucket").alias("at"), F.lit(False).alias("extra"))))
    dealt = docs.withColumn("place", F.explode(places)).select("doc_id", *columns, "place.at", "place.extra")
    order = Window.partitionBy("at").orderBy("extra", F.col("doc_id").asc_nulls_first(), *columns)
    out = dealt.select("doc_id", *columns, "extra", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return out.where("NOT extra").drop("extra")


def fingerprints(docs: DataFrame, words: int = WORDS, below: str = BELOW) -> DataFrame:
    """For each row of ``docs`` (doc_id, text) its sketch, and that of its text
    with the last quarter replaced by the beginning of the next document.

    Columns: doc_id, n_chars, edited_sha256, sketch, edited_sketch (arrays),
    near_edited, near_next. A null text is empty. A table of one row follows
    itself. Rows that repeat a doc_id follow each other in the order of their
    texts. An empty table gives no rows; other columns play no part.
    """
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = with_next(with_sketch(texts, "text", "sketch", words, below), ["text", "sketch"], parts)
    n = F.length("text").cast("long")
    cut = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 4) AS int))"), F.substring(F.col("next_text"), F.lit(1), cut))
    own = own.select("doc_id", n.alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    own = own.select("doc_id", "n_chars", "sketch", "next_sketch", F.sha2("edited", 256).alias("edited_sha256"), "edited")
    own = with_sketch(own, "edited", "edited_sketch", words, below)
    return own.select(
        "doc_id", "n_chars", "edited_sha256", "sketch", "edited_sketch",
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
