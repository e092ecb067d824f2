"""Flat token files without an index, and a scan that finds the documents in them.

A file is a row of little-endian ids; a separator id ends each document. The
scan cuts files into blocks of fixed size, searches each block for separators at
once, and stitches documents that span blocks by a prefix scan over the blocks
of a file: the last separator before a block, and how many there are.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamarind.llm.encoder import encoder, vocabulary_path
from tamarind.llm.words import chunks
from tamarind.llm.workspace import Workspace
from tamarind.session import scratch_path

SEPARATOR = 50256  # the vocabulary's own end of text; its string in a text is ordinary text
BLOCK = 4 << 20  # bytes
ID = np.dtype("<u2")


#: Schemes of Hadoop paths, and pyarrow's names for them.
SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder's full address, as Hadoop reads it: without a scheme it lies in
    Spark's default file system. ValueError for stores that tasks can't open."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toString()
    scheme, _, rest = full.partition(":")
    if scheme not in SCHEMES:
        raise ValueError(f"token files can't be written to {scheme}: of {', '.join(SCHEMES)} only")
    return f"{SCHEMES[scheme]}://{rest.removeprefix('//')}"


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _writer(folder: str, vocabulary: str, separator: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary, special=False)
        if max(len(code.bytes_of) - 1, separator) > np.iinfo(ID).max:
            raise ValueError(f"{vocabulary} has ids beyond {np.iinfo(ID).max}, which files of 16-bit ids can't hold")
        system, where = _place(folder)
        # A task that is tried again writes another file; only the rows of the successful one are read.
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.ids"
        system.create_dir(where, recursive=True)
        seq = 0
        with system.open_output_stream(posixpath.join(where, name)) as out:
            for batch in batches:
                for i, j, data, offsets in chunks(batch.column(1)):
                    ids, count = code.encode(data, offsets)
                    out.write(np.insert(ids, np.cumsum(count), separator).astype(ID).tobytes())
                    n = j - i
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * n), pa.array(np.arange(seq, seq + n)), batch.column(0).slice(i, n), pa.array((count + 1) * ID.itemsize)],
                        names=["file", "seq", "doc_id", "n_bytes"],
                    )
                    seq += n

    return run


def write_flat(docs: DataFrame, folder: str, work: Workspace, vocabulary: str | None = None, separator: int = SEPARATOR) -> DataFrame:
    """Writes a flat file for each partition of ``docs``; returns which document
    went where (file, seq, doc_id, n_bytes). The files hold ids alone."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    folder = _qualified(docs.sparkSession, folder)
    return work.keep(texts.mapInArrow(_writer(folder, vocabulary or vocabulary_path(), separator), "file string, seq long, doc_id long, n_bytes long"), "written")


def _scanner(folder: str, separator: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, where = _place(folder)
        for batch in batches:
            for file, block, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                with system.open_input_file(posixpath.join(where, file)) as f:
                    ids = np.frombuffer(f.read_at(length, start), ID)
                at = np.flatnonzero(ids == separator) + start // ID.itemsize
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([block], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([at], pa.list_(pa.int64()))], names=["file", "block", "n_ids", "at"]
                )

    return run


def scan_documents(files: DataFrame, folder: str, work: Workspace, separator: int = SEPARATOR, block_bytes: int = BLOCK) -> DataFrame:
    """(file, seq, start, n_tokens, ended) of every document in flat files (file, n_bytes).

    ``start`` and ``n_tokens`` count ids inside a file, without the separator.
    Two separators in a row hold an empty document. Ids after a file's last
    separator are a document that isn't ``ended``. An empty file has none.
    """
    if block_bytes % ID.itemsize:
        raise ValueError("a block holds whole ids")
    blocks = files.where("n_bytes > 0").select("file", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_bytes") - 1) / block_bytes))).alias("block"))
    start = F.col("block") * block_bytes
    blocks = blocks.select("file", "block", start.alias("start"), F.least(F.lit(block_bytes), F.col("n_bytes") - start).alias("length"))
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folder = _qualified(files.sparkSession, folder)
    found = blocks.repartition(n, "file", "block").mapInArrow(_scanner(folder, separator), "file string, block long, n_ids long, at array<long>")
    found = work.keep(found, "blocks")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = found.select(
        "file", "block", "at",
        F.coalesce(F.sum(F.size("at")).over(before), F.lit(0)).alias("seen"), F.coalesce(F.max(F.element_at(F.when(F.size("at") > 0, F.col("at")), -1)).over(before), F.lit(-1)).alias("last"),
    )
    each = carried.select("file", "seen", "last", "at", F.posexplode("at").alias("i", "end"))
    previous = F.when(F.col("i") == 0, F.col("last")).otherwise(F.col("at")[F.col("i") - 1])
    ended = each.select("file", (F.col("seen") + F.col("i")).alias("seq"), (previous + 1).alias("start"), (F.col("end") - previous - 1).alias("n_tokens"), F.lit(True).alias("ended"))
    whole = found.groupBy("file").agg(F.sum("n_ids").alias("n"), F.sum(F.size("at")).cast("long").alias("seq"), F.coalesce(F.max(F.array_max("at")), F.lit(-1)).alias("last"))
    open_end = whole.where("n > last + 1").select("file", "seq", (F.col("last") + 1).alias("start"), (F.col("n") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionAll(open_end)


def token_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, file, seq, start, n_tokens) of each row, counted in flat files.

    The files are written from ``docs`` and then read without knowledge of
    where documents begin. A null or empty text has no tokens; rows that repeat
    a doc_id are documents of their own; an empty table gives no rows.
    """
    work = Workspace(docs.sparkSession, "flat")
    folder = scratch_path(docs.sparkSession, "flat-ids")
    written = write_flat(docs, folder, work)
    files = written.groupBy("file").agg(F.sum("n_bytes").alias("n_bytes"))
    found = scan_documents(files, folder, work)
    return found.join(written.select("file", "seq", "doc_id"), ["file", "seq"], "left").select("doc_id", "file", "seq", "start", "n_tokens", "ended")
