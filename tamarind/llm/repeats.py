"""Exact repeats: bytes covered by a string of ``length`` bytes that also starts earlier.

The order is that of a suffix array: suffixes that agree in ``length`` bytes
stand together, and a suffix has an earlier match of that length if and only if
the previous or the next smaller position in suffix order agrees with it that
far. To sort all suffixes of a corpus isn't needed for that.

1. Each window of ``length`` bytes has an anchor, its least ``GRAM``-byte string
   by hash (the leftmost of equals). Equal windows have equal anchors at equal
   places. Windows in a row with one anchor are a segment; a segment is named by
   its anchor and by all its bytes.
2. Segments with an anchor seen once hold no repeat. Of segments with equal
   bytes all but the first are repeats.
3. The first segments of an anchor that differ can still share windows. Their
   suffixes are sorted, and the longest previous factor of each, found from its
   previous and next smaller positions, says whether it is a repeat. An anchor
   with very many such segments is resolved window by window instead, by the
   least position of each window's hash, which its parts combine beforehand.

Anchors, windows and segments are compared by 64-bit hashes, which are joined
with the anchor's, so only strings with equal anchors can be confused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.llm.words import chunks, mix
from tamarind.llm.workspace import Workspace

LENGTH = 100
GRAM = 32
_PLACE = np.uint64(22)  # low bits of a minimum that tell its place in a chunk
MANY = 1 << 14  # differing segments of an anchor that are sorted together; beyond, window by window
PARTS = 16  # of an anchor with more
TOGETHER = 2048  # segments of several anchors that are sorted at once

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def _hashes(data: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of all strings of 1, 2, 4 ... 64 bytes that lie in ``data``."""
    out = {1: mix(data.astype(np.uint64) + np.uint64(1))}
    size = 1
    while size < 64 and len(out[size]) > size:
        h = out[size]
        out[2 * size] = h[:-size] * _ODD[size.bit_length()] + h[size:]
        size *= 2
    return out


def _of_length(grams: dict[int, np.ndarray], at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the ``length`` bytes from each place."""
    total, done = np.zeros(len(at), np.uint64), 0
    while done < length:
        size = 1 << min(6, (length - done).bit_length() - 1)
        total = total * _ODD[0] + grams[size][at + done]
        done += size
    return mix(total)


def _segments(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple | None:
    """(text number, first window, last window, anchor, anchor hash, segment hash), places within ``data``."""
    if len(data) < length:
        return None
    grams = _hashes(data)
    at_gram = mix(grams[GRAM])
    least = (at_gram >> _PLACE << _PLACE) | np.arange(len(at_gram), dtype=np.uint64)
    span, have = length - GRAM + 1, 1
    while 2 * have <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if span > have:
        least = np.minimum(least[: len(data) - length + 1], least[span - have :][: len(data) - length + 1])
    sizes = np.diff(offsets)
    windows = np.maximum(sizes - length + 1, 0)
    starts = np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(windows)[:-1]]), windows) + np.arange(windows.sum())
    if not len(starts):
        return None
    text = np.repeat(np.arange(len(sizes)), windows)
    anchor = (least[starts] & np.uint64((1 << 22) - 1)).astype(np.int64)
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    lo, hi, a = starts[first], starts[last], anchor[first]
    name = _of_length(grams, lo, length) * _ODD[1] + _of_length(grams, hi, length) * _ODD[2]
    name = mix(name + ((hi - lo) * 128 + (a - lo)).astype(np.uint64))
    return text[first], lo, hi, a, at_gram[a], name


def _parts(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets, place of the bytes in their text): a very long text in overlapping parts."""
    limit = 1 << 21
    if len(data) <= limit:
        yield data, offsets, np.zeros(len(offsets) - 1, np.int64)
        return
    for start in range(0, max(1, len(data) - length + 1), limit):  # chunks() lets one text alone be this long
        part = data[start : start + limit + length - 1]
        yield part, np.array([0, len(part)]), np.array([start])


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, _, data, offsets in chunks(batch.column(1)):
                for part, bounds, shift in _parts(data, offsets, length):
                    found = _segments(part, bounds, length)
                    if found is None:
                        continue
                    text, lo, hi, a, key, name = found
                    base = bounds[:-1][text] - shift[text]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(name.view(np.int64)), ids.take(pa.array(i + text)), pa.array((lo - base)), pa.array((hi - lo).astype(np.int16)), pa.array((a - lo).astype(np.int16))],
                        names=["key", "name", "doc_id", "lo", "more", "anchor"],
                    )

    return run


_ANCHORS = "key long, name long, doc_id long, lo long, more short, anchor short"


def _cutter(length: int):
    """Bytes of the segments that a document's row asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, asked = batch.column(0), batch.column(2).to_pylist()
            for i, j, data, offsets in chunks(batch.column(1)):
                rows = [
                    (r, s["key"], s["lo"], s["anchor"], s["many"], data[offsets[r - i] + s["lo"] : min(offsets[r - i] + s["lo"] + s["more"] + length, offsets[r - i + 1])].tobytes())
                    for r in range(i, j)
                    for s in asked[r]
                ]
                if rows:
                    row, key, lo, anchor, many, piece = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), ids.take(pa.array(row)), pa.array(lo), pa.array(anchor, pa.int16()), pa.array(many), pa.array(piece, pa.binary())],
                        names=["key", "doc_id", "lo", "anchor", "many", "bytes"],
                    )

    return run


def _window_hashes(length: int):
    """Windows of segments that come ordered by anchor and place: of equal ones in a
    batch the first, and the others, which are repeats, as spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8)
            sizes = pc.binary_length(batch.column(3)).to_numpy().astype(np.int64)
            windows = np.maximum(sizes - length + 1, 0)
            row = np.repeat(np.arange(len(sizes)), windows)
            inside = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
            if not len(row):
                continue
            name = _of_length(_hashes(data), (np.cumsum(sizes) - sizes)[row] + inside, length)
            key, lo = batch.column(0).to_numpy()[row], batch.column(2).to_numpy()[row] + inside
            order = np.lexsort((np.arange(len(row)), name, key))
            again = np.zeros(len(row), bool)
            again[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (name[order[1:]] == name[order[:-1]])
            hit, first = np.flatnonzero(again), np.flatnonzero(~again)
            head = np.append(True, (row[hit[1:]] != row[hit[:-1]]) | (lo[hit[1:]] != lo[hit[:-1]] + 1))[: len(hit)]
            tail = np.append(head[1:], True)[: len(hit)]
            at = np.concatenate([first, hit[head]])
            end = np.concatenate([np.zeros(len(first), np.int64), lo[hit[tail]] + length])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[at]), pa.array(name[at].view(np.int64)), batch.column(1).take(pa.array(row[at])), pa.array(lo[at]), pa.array(end, mask=end == 0)],
                names=["key", "window", "doc_id", "lo", "end"],
            )

    return run


def suffix_order(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places ``at`` of suffixes in the order of (group, first ``length`` bytes, place
    in ``at``), and of each how many bytes it shares with the one before, up to ``length``."""
    rows = np.empty((len(at), length + 4), np.uint8)
    rows[:, :4] = group.astype(">u4").view(np.uint8).reshape(-1, 4)
    rows[:, 4:] = data[at[:, None] + np.arange(length)]
    order = np.argsort(rows.reshape(-1).view(f"S{length + 4}"), kind="stable")
    rows = rows[order]
    differ = rows[1:] != rows[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1) - 4, length)
    return order, np.concatenate([[0], np.maximum(shared, 0)])


def longest_previous_factor(position: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """For suffixes in suffix order, the longest match with one at a smaller position.

    ``position`` gives the rank of each suffix in text order, ``shared`` the
    bytes it shares with the suffix before. The previous and the next smaller
    position in suffix order give the longest matches; a stack finds both.
    """
    out = np.zeros(len(position), np.int64)
    stack: list[tuple[int, int, int]] = []  # (index, position, bytes shared with the entry below)
    for i, (p, s) in enumerate(zip(position.tolist(), shared.tolist())):
        while stack and stack[-1][1] > p:  # p is the next smaller position of what goes
            j, _, below = stack.pop()
            out[j] = max(below, s)
            s = min(s, below)
        stack.append((i, p, s if stack else 0))
    for j, _, below in stack:
        out[j] = below
    return out


def _sorted_windows(length: int):
    """Repeats among the differing segments of each anchor; rows come ordered by anchor and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            keys = table["key"].to_numpy()
            others = np.flatnonzero(keys != keys[-1])
            whole = int(others[-1]) + 1 if len(others) else 0  # the last anchor may go on in the next batch
            yield from resolve(table.slice(0, whole))
            rest = table.slice(whole).combine_chunks().to_batches()[0]
        if rest is not None:
            yield from resolve(pa.Table.from_batches([rest]))

    def resolve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, start, n = table["key"].to_numpy(), 0, table.num_rows
        while start < n:
            end = min(n, start + TOGETHER)  # whole anchors
            while end < n and keys[end] == keys[end - 1]:
                end += 1
            part = table.slice(start, end - start).combine_chunks()
            start = end
            pieces = part["bytes"].to_pylist()
            data = np.frombuffer(b"".join(pieces), np.uint8)
            sizes = np.array([len(p) for p in pieces])
            base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            windows = np.maximum(sizes - length + 1, 0)
            row = np.repeat(np.arange(len(pieces)), windows)
            inside = np.arange(windows.sum()) - np.repeat(np.concatenate([[0], np.cumsum(windows)[:-1]]), windows)
            k = part["key"].to_numpy()
            group = np.concatenate([[0], np.cumsum(k[1:] != k[:-1])])[row]
            order, shared = suffix_order(data, base[row] + inside, group, length)
            lo = part["lo"].to_numpy()[row] + inside
            factor = longest_previous_factor(order, shared)  # rows are in text order, so the row is the position
            hit = np.sort(order[factor >= length])
            docs = part["doc_id"].take(pa.array(row[hit])).combine_chunks()
            yield pa.RecordBatch.from_arrays([docs.cast(pa.int64()), pa.array(lo[hit]), pa.array(lo[hit] + length)], names=["doc_id", "start", "end"])

    return run


def repeated_spans(docs: DataFrame, work: Workspace, length: int = LENGTH) -> DataFrame:
    """(doc_id, start, end) of strings of ``length`` bytes or more that start earlier as well; they may overlap."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    anchors = work.keep(texts.mapInArrow(_anchors(length), _ANCHORS), "anchors")
    often = anchors.groupBy("key").agg(F.count("*").alias("n"), F.min("name").alias("lo"), F.max("name").alias("hi")).where("n > 1")
    again = work.keep(anchors.join(often.select("key", (F.col("lo") < F.col("hi")).alias("mixed")), "key"), "again")
    work.drop(anchors)
    place = F.struct("doc_id", "lo")
    firsts = again.groupBy("key", "name").agg(F.min(F.struct(*[F.col(c) for c in ("doc_id", "lo", "more", "anchor")])).alias("f"), F.first("mixed").alias("mixed"), F.count("*").alias("n"))
    firsts = work.keep(firsts.select("key", "name", "f.*", "mixed", "n"), "firsts")
    of_first = firsts.where("n > 1").select("key", "name", F.struct("doc_id", "lo").alias("first"))
    copies = again.join(of_first, ["key", "name"]).where(~place.eqNullSafe(F.col("first")))
    copies = work.keep(copies.select("doc_id", F.col("lo").alias("start"), (F.col("lo") + F.col("more") + length).alias("end")), "copies")

    counted = firsts.where("mixed").groupBy("key").agg(F.count("*").alias("names"))
    asked = firsts.where("mixed").join(counted, "key").select("doc_id", F.struct("key", "lo", F.col("more").cast("int").alias("more"), F.col("anchor").cast("int").alias("anchor"), (F.col("names") > MANY).alias("many")).alias("s"))
    asked = asked.groupBy(F.col("doc_id").alias("asked_id")).agg(F.collect_list("s").alias("asked"))  # as many as a text has anchors
    cut = texts.join(asked, F.col("doc_id").eqNullSafe(F.col("asked_id"))).select("doc_id", "text", "asked")
    cut = work.keep(cut.mapInArrow(_cutter(length), "key long, doc_id long, lo long, anchor short, many boolean, bytes binary"), "cut")
    work.drop(again, firsts)
    few = cut.where("NOT many").repartition("key").sortWithinPartitions("key", F.col("doc_id").asc_nulls_first(), "lo")
    few = few.select("key", "doc_id", "lo", "bytes").mapInArrow(_sorted_windows(length), "doc_id long, start long, end long")
    # A hot anchor's segments are dealt into parts, each of which combines its equal windows before they meet.
    part = F.pmod(F.xxhash64("doc_id", "lo"), F.lit(PARTS))
    hot = cut.where("many").repartition("key", part).sortWithinPartitions("key", F.col("doc_id").asc_nulls_first(), "lo").select("key", "doc_id", "lo", "bytes")
    each = work.keep(hot.mapInArrow(_window_hashes(length), "key long, window long, doc_id long, lo long, end long"), "windows")
    met = each.where("end IS NULL")
    least = met.groupBy("key", "window").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "window", "first")
    late = met.join(least, ["key", "window"]).where(~place.eqNullSafe(F.col("first")))
    late = late.select("doc_id", F.col("lo").alias("start"), (F.col("lo") + length).alias("end"))
    late = late.unionAll(each.where("end IS NOT NULL").select("doc_id", F.col("lo").alias("start"), "end"))
    return work.only(copies.unionAll(few).unionAll(late), "spans")


def _merged(starts: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans that overlap or touch become one; cut at ``size``."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.minimum(np.maximum.accumulate(ends[order]), size)
    new = np.append(True, starts[1:] > ends[:-1]) if len(starts) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    keep = ends[np.append(first[1:], len(starts)) - 1] if len(first) else ends
    return starts[first], keep


def _remover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column(2).to_pylist()
        for i, j, data, offsets in chunks(batch.column(1)):
            out = []
            for r in range(i, j):
                a, b = int(offsets[r - i]), int(offsets[r - i + 1])
                asked = np.array([(s["start"], s["end"]) for s in spans[r] or ()], np.int64).reshape(-1, 2)
                asked = asked[asked[:, 0] < b - a]
                starts, ends = _merged(asked[:, 0], asked[:, 1], b - a)
                edges = np.stack([np.append(0, ends), np.append(starts, b - a)], axis=1).tolist()
                text = data[a:b].tobytes()
                kept = b"".join(text[x:y] for x, y in edges)
                out.append((b - a, b - a - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), list(zip(starts.tolist(), ends.tolist())), kept))
            n, gone, runs, sha, where, kept = zip(*out)
            where = pa.array([[{"start": s, "end": e} for s, e in w] for w in where], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha), where, pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept"],
            )


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) without the bytes of strings of ``length``
    bytes that also start earlier: at a smaller doc_id, or earlier in the text.

    Columns: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (spans of
    bytes), kept (the other bytes; a cut may fall inside a character).

    A null text is empty. Texts shorter than ``length`` keep all. Rows that
    repeat a doc_id are one place in the order: equal strings at equal places of
    them are no repeats, and what is removed of one is removed at that place of
    all. Rows without doc_id come before all others. Spark sorts and shuffles
    numbers, not texts, but for two joins on doc_id.
    """
    if not GRAM + 1 < length < GRAM + 128:
        raise ValueError("length must be 34 to 159 bytes")
    work = Workspace(docs.sparkSession, "repeats")
    spans = repeated_spans(docs, work, length)
    # Bounded by the text: a few spans for each anchor in it.
    of = spans.groupBy(F.col("doc_id").alias("span_id")).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    both = texts.join(of, F.col("doc_id").eqNullSafe(F.col("span_id")), "left").select("doc_id", "text", "spans")
    return both.mapInArrow(
        _remover, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start: long, end: long>>, kept binary"
    )
