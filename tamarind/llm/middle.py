"""Fill-in-middle texts: a middle part moves to the end, cut by an indexable skip list.

A text is a list of units (code points, words, lines). Its units are the nodes
of a skip list whose lanes are sparser from one to the next; a node carries for
each of its lanes the width to the next node there, in units, in code points and
in bytes. A cut rank is found from the sparsest lane down: go on while the
accumulated unit width stays at or below the rank, then descend. The widths sum
to the exact code point and byte of the cut, so no part of the text is counted
twice and none is decoded. The lowest lane is the text itself; only one of
``EVERY`` units has a node above it, so a list is small beside its text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.llm.words import SEPARATOR, chunks, mix

EVERY = 16  # units to a node of the first express lane, on average
UP = 4  # nodes to a node of the next lane
BLOCK = 1 << 20  # bytes that are turned into nodes at once
MARKS = ("<P>", "<S>", "<M>")  # before the prefix, the suffix, the middle

PLAIN, PSM, SPM = "plain", "psm", "spm"
_ROW = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _points(data: np.ndarray, before: int) -> np.ndarray:
    return (data & 0xC0) != 0x80


def _words(data: np.ndarray, before: int) -> np.ndarray:
    """A word with the white space in front of it."""
    gap = SEPARATOR[data]
    start = gap.copy()
    start[1:] &= ~gap[:-1]
    start[0] &= not SEPARATOR[before]
    return start


def _lines(data: np.ndarray, before: int) -> np.ndarray:
    start = np.empty(len(data), bool)
    start[1:] = data[:-1] == 10
    start[0] = before == 10
    return start


#: Which bytes begin a unit, given the byte before the first; a text's first byte always does.
UNITS: dict[str, Callable[[np.ndarray, int], np.ndarray]] = {"point": _points, "word": _words, "line": _lines}


class SkipList:
    """The units of one UTF-8 text, in lanes of (unit, point, byte) widths."""

    def __init__(self, data: np.ndarray, unit: str = "point"):
        self.data, self.starts = data, UNITS[unit]
        rank, point, byte = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        self.units = self.points = 0
        for a in range(0, len(data), BLOCK):
            at = self._unit_starts(a, a + BLOCK)
            up = np.flatnonzero(mix(np.arange(self.units, self.units + len(at), dtype=np.uint64)) % np.uint64(EVERY) == 0)
            up = up[up + self.units > 0]  # the first unit is the head, a node of every lane
            counted = np.cumsum(_points(data[a : a + BLOCK], 0))
            rank.append(up + self.units)
            point.append(self.points + counted[at[up] - a] - 1)
            byte.append(at[up])
            self.units += len(at)
            self.points += int(counted[-1])
        end = (self.units, self.points, len(data))
        places = [np.concatenate(x) for x in (rank, point, byte)]
        high = mix(places[0].astype(np.uint64)) // np.uint64(EVERY)
        self.lanes, below = [], np.zeros(0, np.int64)
        while True:
            self.lanes.append((*(np.diff(x, append=e) for x, e in zip(places, end)), below))
            if len(places[0]) <= UP:
                break
            stay = high % np.uint64(UP) == 0
            stay[0] = True
            below, high, places = np.flatnonzero(stay), high[stay] // np.uint64(UP), [x[stay] for x in places]
        self.lanes.reverse()

    def _unit_starts(self, a: int, b: int) -> np.ndarray:
        found = self.starts(self.data[a:b], int(self.data[a - 1]) if a else 0)
        if a == 0 and len(found):
            found[0] = True
        return np.flatnonzero(found) + a

    def cut(self, rank: int) -> tuple[int, int]:
        """Code points and bytes of the first ``rank`` units."""
        unit = point = byte = i = 0
        for units, points, sizes, below in self.lanes:
            while i < len(units) and unit + units[i] <= rank:
                unit, point, byte, i = unit + int(units[i]), point + int(points[i]), byte + int(sizes[i]), i + 1
            if i == len(units):
                return point, byte  # the end of the text
            if len(below):
                i = int(below[i])
        reach = 32 * EVERY
        while unit < rank:  # along the text, to the next node of the lowest lane at most
            at = self._unit_starts(byte, byte + reach)[1 : rank - unit + 1]
            if len(at):
                point += int(np.count_nonzero(_points(self.data[byte : at[-1]], 0)))
                unit, byte = unit + len(at), int(at[-1])
            reach *= 2
        return point, byte


def _arranger(unit: str, plain: int, spm: int):
    marks = [m.encode() for m in MARKS]

    def arrange(data: np.ndarray, digest: str) -> tuple[int, str, int | None, int | None, bytes]:
        h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
        units, text = SkipList(data, unit), data.tobytes()
        n = units.units
        if not text or h3 % 100 >= 100 - plain or any(m in text for m in marks):
            return n, PLAIN, None, None, text
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        (p, a), (q, b) = units.cut(low), units.cut(high)
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h4 % 100 < spm:
            return n, SPM, p, q - p, b"".join((marks[1], suffix, marks[0], prefix, marks[2], middle))
        return n, PSM, p, q - p, b"".join((marks[0], prefix, marks[1], suffix, marks[2], middle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = batch.column(1).to_pylist()
            for i, j, data, offsets in chunks(batch.column(2)):
                rows = [arrange(data[offsets[k] : offsets[k + 1]], digests[i + k]) for k in range(j - i)]
                n, form, prefix, middle, output = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def fill_in_middle(docs: DataFrame, unit: str = "point", plain: int = 10, spm: int = 20, seed: str = "1") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of each row of ``docs`` (doc_id, text).

    ``n`` is the number of units (``point``, ``word`` with the space before it,
    ``line``). The sha256 of ``seed:doc_id`` gives both cut ranks and the form:
    ``plain`` percent of the texts stay as they are, ``spm`` percent of the rest
    lead with their suffix. ``prefix_chars`` and ``middle_chars`` are code points,
    null where the form is plain.

    A null or empty text, or one that holds one of ``MARKS``, is plain. Rows that
    repeat a doc_id are cut at the same hashes, each by its own length; a null
    doc_id counts as an empty one. An empty table gives no rows; other columns of
    ``docs`` play no part. A text is held with a list of a few bytes to every
    ``EVERY`` units beside it.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(key, 256).alias("digest"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_arranger(unit, plain, spm), _ROW)


def restored(output: str | Column, form: str | Column) -> Column:
    """The exact text, from an arranged one and its form. As no text of another
    form than plain holds a mark, each mark is found where it was set."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == PSM, F.concat(parts[1], parts[3], parts[2]))
        .when(form == SPM, F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
