"""Languages by rank-order profiles of letter sequences.

A profile is the list of a language's most frequent sequences of one to three
letters, word edges included, in the order of their frequency. A text is
compared by the out-of-place distance: for each of its own most frequent
sequences, how far its rank is from the rank in the profile, or the profile's
length if it isn't there. Sequences are named by 32-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarind.llm.words import mix

LENGTH = 300
UNKNOWN = "und"
_CHARS = 1 << 18  # handled at once
_TEXTS = 4095
_HELD = 1 << 20  # sequences a task counts before it hands them on


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _sequences(texts: list[str]) -> np.ndarray:
    """Number of the text in the upper, hash of the sequence in the lower half, of every occurrence."""
    points = [np.frombuffer(("\0" + t).encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    number = np.repeat(np.arange(len(texts), dtype=np.uint64), [len(p) for p in points])
    c = np.append(np.concatenate(points), 0).astype(np.int64)
    c[~_letters()[c]] = 0
    c = c.astype(np.uint64)
    found = []
    use = c[:-1] > 0
    found.append((number[use], c[:-1][use] << np.uint64(42)))
    use = (c[:-1] > 0) | (c[1:] > 0)
    use[:-1] &= (c[:-2] > 0) | (number[1:] == number[:-1])  # a pair that only touches the next text's first letter is its own
    found.append((number[use], (np.uint64(1) << np.uint64(63)) | (c[:-1][use] << np.uint64(21)) | c[1:][use]))
    if len(c) > 2:
        use = c[1:-1] > 0
        found.append((number[1:][use], (c[:-2][use] << np.uint64(42)) | (c[1:-1][use] << np.uint64(21)) | c[2:][use]))
    return np.concatenate([(n << np.uint64(32)) | (mix(s) >> np.uint64(32)) for n, s in found])


def _counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        return keys[first], np.diff(np.append(first, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _pieces(text: str) -> Iterator[str]:
    """A long text in pieces that end with a word, or where there is no white space, anywhere."""
    i = 0
    while i < len(text):
        j = i + _CHARS
        if j < len(text):
            j = max(text.rfind(" ", i, j), text.rfind("\n", i, j)) + 1 or j
        yield text[i:j]
        i = j


def _counts(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, text after the last, keys, counts), for as many texts at once as fit."""
    i = 0
    while i < len(texts):
        j, chars = i, 0
        while j < len(texts) and j - i < _TEXTS and (j == i or chars + len(texts[j]) <= _CHARS):
            chars += len(texts[j])
            j += 1
        if chars <= _CHARS:
            yield i, j, *_counted(_sequences(texts[i:j]))
        else:
            keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            for piece in _pieces(texts[i]):
                k, n = _counted(_sequences([piece]))
                keys, counts = _counted(np.concatenate([keys, k]), np.concatenate([counts, n]))
            yield i, j, keys, counts
        i = j


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task by language and sequence."""
    held: dict[str, list] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, (keys, counts) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(counts)], names=["lang", "seq", "n"])
        held.clear()

    low = np.uint64(0xFFFFFFFF)
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            for _, _, keys, counts in _counts([(t or "").lower() for g, t in zip(langs, texts) if g == lang]):
                old = held.get(lang, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
                held[lang] = _counted(np.concatenate([old[0], keys & low]), np.concatenate([old[1], counts]))
        if sum(len(k) for k, _ in held.values()) > _HELD:
            yield from out()
    yield from out()


def profiles(docs: DataFrame, length: int = LENGTH) -> dict[str, list[int]]:
    """For each language its ``length`` most frequent sequences, most frequent first.

    Counts every text of ``docs`` (text, lang) with a lang. The result has a
    bounded size: ``length`` numbers for each language.
    """
    known = docs.where("lang IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = known.mapInArrow(_counter, "lang string, seq long, n long").groupBy("lang", "seq").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "seq")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= length).select("lang", "seq", "rank").collect()
    out: dict[str, list[int]] = {}
    for r in sorted(top, key=lambda r: (r.lang, r.rank)):
        out.setdefault(r.lang, []).append(r.seq)
    return out


class Ranks:
    """Profiles as a table: a row for each sequence, a column for each language."""

    def __init__(self, of: dict[str, list[int]], length: int = LENGTH):
        self.langs, self.length = sorted(of), length
        self.names = np.unique(np.array([s for seqs in of.values() for s in seqs], np.uint64))
        self.rank = np.full((len(self.names) + 1, len(self.langs)), -1)
        for i, lang in enumerate(self.langs):
            self.rank[np.searchsorted(self.names, np.array(of[lang], np.uint64)), i] = np.arange(len(of[lang]))

    def nearest(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return langs, scores
        for i, j, keys, counts in _counts([(t or "").lower() for t in texts]):
            doc = keys >> np.uint64(32)
            names = keys & np.uint64(0xFFFFFFFF)
            order = np.lexsort((names, -counts, doc))
            doc, names = doc[order].astype(np.int64), names[order]
            first = np.searchsorted(doc, np.arange(j - i + 1))
            place = np.arange(len(doc)) - first[doc]
            use = place < self.length
            doc, place, names = doc[use], place[use], names[use]
            at = np.searchsorted(self.names, names)
            at[(at == len(self.names)) | (self.names[np.minimum(at, len(self.names) - 1)] != names)] = len(self.names)
            rank = self.rank[at]
            apart = np.where(rank < 0, self.length, np.abs(rank - place[:, None]))
            total = np.stack([np.bincount(doc, apart[:, k], j - i) for k in range(len(self.langs))], axis=1)
            most = np.bincount(doc, minlength=j - i) * float(self.length)
            best = total.argmin(axis=1)
            least = total[np.arange(j - i), best]
            rest = np.partition(total, 1, axis=1)[:, 1] if len(self.langs) > 1 else most
            for t in np.flatnonzero(most):
                langs[i + t] = self.langs[best[t]]
                scores[i + t] = 1 - least[t] / rest[t] if rest[t] else 0.0
        return langs, scores


def identifier(of: dict[str, list[int]], length: int = LENGTH):
    """A column function: text to (lang_pred, score). The score is how much nearer
    the nearest language is than the second, from 0 to 1; of equally near ones the
    first by name is taken. ``und`` and 0 for a null or a text without letters."""
    ranks = Ranks(of, length)

    @F.arrow_udf("lang_pred string, score double")
    def identify(text: pa.Array) -> pa.Array:
        langs, scores = ranks.nearest(text.to_pylist())
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return identify


def languages(docs: DataFrame, learn: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, lang_pred, score) of each row of ``docs`` by the profiles of ``learn``.

    Without any language to learn every text is ``und``. Rows that repeat a
    doc_id are judged one by one; an empty table gives no rows.
    """
    found = identifier(profiles(learn, length), length)(F.col("text").cast("string"))
    return docs.select("doc_id", found.alias("found")).select("doc_id", "found.lang_pred", "found.score")
