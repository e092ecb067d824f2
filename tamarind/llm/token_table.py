"""Token ids as Parquet files for selective reads.

A row is a document: its id, number of ids, checksum and the list of ids. Ids
are dictionary-encoded, numbers and document ids delta-encoded; row groups and
pages are small enough that the column and page indexes lead a reader to a few
documents, and columns of numbers can be read without the ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamarind.llm.encoder import encoder, vocabulary_path
from tamarind.llm.words import chunks
from tamarind.llm.workspace import DURING, Workspace, settings

END = 0
LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "compression": "zstd",
}
_ROW = "doc_id long, n_tokens long, tokens array<int>"


def _encoder(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            for i, j, data, offsets in chunks(batch.column(1)):
                ids, count = code.encode(data, offsets)
                ends = np.cumsum(count)
                ids = np.insert(ids.astype(np.int32), ends, end)
                count = count + 1
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(count), lists], names=["doc_id", "n_tokens", "tokens"])

    return run


def write_tokens(docs: DataFrame, path: str, ordered: bool = True, vocabulary: str | None = None, end: int = END) -> None:
    """Encodes each row's text, adds ``end``, and writes the ids below ``path``.

    ``ordered``: by ascending doc_id (rows without one first, rows that repeat
    one by their text), so that the files in the order of their names hold one
    sequence; else in the order in which ``docs`` is read, without a shuffle.
    A null or empty text is its end id alone. Other columns aren't written.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if ordered:
        n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        texts = texts.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    rows = texts.mapInArrow(_encoder(vocabulary or vocabulary_path(), end), _ROW).withColumn("part", F.spark_partition_id())
    with settings(docs.sparkSession, DURING):
        rows.write.options(**LAYOUT).parquet(path)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        ends = lists.offsets.to_numpy()
        ids = np.ascontiguousarray(lists.values.to_numpy(), "<u4")
        crc = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(crc, pa.int64())], names=["part", "place", "doc_id", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written rows (doc_id, n_tokens, tokens, part); select or filter before use to read less."""
    return spark.read.parquet(path)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(part, place, doc_id, n_tokens, start) read from the numbers alone.

    ``start`` counts the ids of all rows before, over all files. It is a prefix
    scan in two steps: over the totals of files, a row each, and inside a file.
    """
    rows = read_tokens(spark, path).select("part", F.col("_metadata.row_index").alias("place"), "doc_id", "n_tokens")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("total")).select("part", F.coalesce(F.sum("total").over(whole), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return rows.join(files, "part").select("part", "place", "doc_id", "n_tokens", (F.col("before") + F.col("inside")).alias("start"))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each written row, from the files."""
    rows = read_tokens(spark, path).select("part", F.col("_metadata.row_index").alias("place"), "doc_id", "n_tokens", "tokens")
    crc = rows.mapInArrow(_checksums, "part int, place long, doc_id long, n_tokens long, ids_crc32 long").select("part", "place", "ids_crc32")
    crc = Workspace(spark, "token-crc").keep(crc, "numbers")
    return token_index(spark, path).join(crc, ["part", "place"]).select("doc_id", "start", "n_tokens", "ids_crc32")
