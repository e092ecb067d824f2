"""Benchmark items in documents, up to a share of edited words.

Documents and items are sequences of words. A CGK walk reads a sequence with a
random bit for each step and word, which says whether the next step reads the
next word; two walks over sequences of small edit distance fall into step again
soon after each edit, so they differ in few steps. Samples of steps are bucketed
(bit-sampling LSH); ``WALKS * TABLES`` of them find a window of a few edits with
high probability and an unedited one always. Every hit is confirmed by the exact
edit distance of the item to the text around it.

Windows as long as the items of a length class begin at every word. An edit
breaks two pairs of neighbouring words at most, so a window that holds fewer of
the items' word pairs than must be left is no match, and isn't walked. The items are a stated query set: they reach the tasks in
blocks of bounded size, and each block is held against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.llm.words import chunks, mix, word_hashes

EDITS = 0.2  # of an item's words
WALKS, TABLES, SAMPLES = 4, 10, 4
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 32 << 20
_WINDOWS = 1 << 14  # walked at once


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes[:-1] * np.uint64(0xD1342543DE82EF95) + hashes[1:])


class Items:
    """A block of items, with the tables of their walks."""

    def __init__(self, ids: list, texts: list[str | None], edits: float = EDITS, seed: int = 7):
        column = pa.array([t or "" for t in texts], pa.large_string())
        words: list[np.ndarray] = []
        for _, _, data, offsets in chunks(column):
            hashes, first = word_hashes(data, offsets)
            words += [hashes[a:b] for a, b in zip(first[:-1], first[1:])]
        known = [(i, w) for i, w in zip(ids, words) if len(w)]  # an item without words is nowhere
        self.ids = [i for i, _ in known]
        self.vocabulary = np.unique(np.concatenate([w for _, w in known])) if known else np.zeros(0, np.uint64)
        self.words = [np.searchsorted(self.vocabulary, w) + 1 for _, w in known]  # 0 is an unknown word
        self.edits = [int(edits * len(w)) for w in self.words]
        self.pad = len(self.vocabulary) + 1
        self._maybe = np.zeros(1 << 16, bool)
        self._maybe[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        pairs = [_pairs(w) for _, w in known]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.uint64)
        self._maybe_pair = np.zeros(1 << 20, bool)
        self._maybe_pair[(self.pairs & np.uint64(0xFFFFF)).astype(np.int64)] = True
        self.masks = []
        for w in self.words:
            mask: dict[int, int] = {}
            for k, c in enumerate(w.tolist()):
                mask[c] = mask.get(c, 0) | 1 << k
            self.masks.append(mask)
        self.classes = []
        rng = np.random.Generator(np.random.PCG64(seed))
        order = sorted(range(len(self.words)), key=lambda i: len(self.words[i]))
        while order:
            least = len(self.words[order[0]])
            some = [i for i in order if len(self.words[i]) <= least * 1.15]
            order = order[len(some) :]
            self.classes.append(_Class(self, some, least, rng))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int64)
        some = np.flatnonzero(self._maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)]) if len(self.vocabulary) else np.zeros(0, np.int64)
        at = np.searchsorted(self.vocabulary, hashes[some])
        same = (at < len(self.vocabulary)) & (self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == hashes[some]) if len(some) else np.zeros(0, bool)
        out[some[same]] = at[same] + 1
        return out

    def known_pairs(self, hashes: np.ndarray) -> np.ndarray:
        """Of each word whether it and the next one are a pair of some item."""
        out, pairs = np.zeros(len(hashes), bool), _pairs(hashes)
        some = np.flatnonzero(self._maybe_pair[(pairs & np.uint64(0xFFFFF)).astype(np.int64)]) if len(self.pairs) else np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.pairs, pairs[some]), max(len(self.pairs) - 1, 0))
        out[some] = self.pairs[at] == pairs[some] if len(some) else False
        return out

    def distance(self, item: int, text: list[int]) -> tuple[int, int]:
        """(edits, end) of the best match of the whole item anywhere in ``text``: bit-parallel, exact."""
        mask, n = self.masks[item], len(self.words[item])
        full, high = (1 << n) - 1, 1 << n - 1
        up, down, now = full, 0, n
        best, end = n, 0
        for j, c in enumerate(text, 1):
            same = mask.get(c, 0)
            vertical = same | down
            across = (((same & up) + up) ^ up) | same
            plus, minus = (down | ~(across | up)) & full, up & across
            now += 1 if plus & high else -1 if minus & high else 0
            plus, minus = plus << 1 & full, minus << 1 & full
            up, down = (minus | ~(vertical | plus)) & full, plus & vertical
            if now < best:
                best, end = now, j
        return best, end


class _Class:
    """Items of about one length."""

    def __init__(self, items: Items, members: list[int], least: int, rng: np.random.Generator):
        self.members, self.steps = members, 2 * least
        self.left = min(len(items.words[i]) - 1 - 2 * items.edits[i] for i in members)  # word pairs that a match has at least
        self.reach = max(len(items.words[i]) + items.edits[i] for i in members)
        self.bits = rng.integers(0, 2, (WALKS, items.pad + 1, self.steps), dtype=np.int8)
        self.bits[:, items.pad] = 0  # past the end the walk stands still
        self.samples = rng.integers(0, self.steps, (WALKS, TABLES, SAMPLES))
        self.salts = rng.integers(1, 2**62, (TABLES, SAMPLES), dtype=np.int64) | 1
        flat = np.concatenate([np.append(items.words[i], [items.pad] * self.reach) for i in members])
        start = np.cumsum([0] + [len(items.words[i]) + self.reach for i in members])[:-1]
        self.tables = []
        for walk in range(WALKS):
            for keys in self.keys(walk, flat, start):
                order = np.argsort(keys, kind="stable")
                self.tables.append((keys[order], np.array(members)[order]))

    def keys(self, walk: int, flat: np.ndarray, start: np.ndarray) -> Iterator[np.ndarray]:
        """A key for each table, of each sequence that begins at ``start``."""
        at, read = start.copy(), np.empty((self.steps, len(start)), np.int64)
        for t in range(self.steps):
            read[t] = flat[np.minimum(at, len(flat) - 1)]
            at += self.bits[walk, read[t], t]
        for table in range(TABLES):
            with np.errstate(over="ignore"):
                yield (read[self.samples[walk, table]] * self.salts[table][:, None]).sum(axis=0)

    def hits(self, numbers: np.ndarray, paired: np.ndarray, begin: np.ndarray, limit: np.ndarray, pad: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word, item) of windows and items that share a bucket. Windows begin at the
        words ``begin`` of texts that end at ``limit``; ``paired`` sums known pairs."""
        windows = begin[paired[np.minimum(begin + self.reach, limit)] - paired[begin] >= self.left]
        for i in range(0, len(windows), _WINDOWS):
            some = windows[i : i + _WINDOWS]
            stop = np.minimum(some + self.reach, limit[np.searchsorted(begin, some)])
            width = self.reach + 1
            grid = np.minimum(some[:, None] + np.arange(width), len(numbers) - 1)
            flat = np.where(some[:, None] + np.arange(width) < stop[:, None], numbers[grid], pad).reshape(-1)
            start = np.arange(len(some)) * width
            for walk in range(WALKS):
                for table, keys in enumerate(self.keys(walk, flat, start)):
                    have, items = self.tables[walk * TABLES + table]
                    a, b = np.searchsorted(have, keys, "left"), np.searchsorted(have, keys, "right")
                    while (b > a).any():
                        yes = b > a
                        yield some[yes], items[a[yes]]
                        a = a + yes


def find(items: Items, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, item, edits, end word) of each item that a text holds, its best match (the first of equals)."""
    hashes, first = word_hashes(data, offsets)
    if not len(hashes) or not items.classes:
        return []
    numbers = items.numbers(hashes)
    # A match that doesn't begin with a word of the item is as good without what stands before it.
    begin = np.flatnonzero(numbers)
    limit = first[np.searchsorted(first, begin, "right")]
    paired = np.concatenate([[0], np.cumsum(items.known_pairs(hashes))])
    pairs = [np.unique(np.stack(p, axis=1), axis=0) for c in items.classes for p in c.hits(numbers, paired, begin, limit, items.pad)]
    best: dict[tuple[int, int], tuple[int, int]] = {}
    if pairs:
        pairs = np.unique(np.concatenate(pairs), axis=0)
        text = np.searchsorted(first, pairs[:, 0], "right") - 1
        for (word, item), t in zip(pairs.tolist(), text.tolist()):
            slack, n = items.edits[item], len(items.words[item])
            a = max(int(first[t]), word - slack)
            edits, end = items.distance(item, numbers[a : min(int(first[t + 1]), word + n + slack)].tolist())
            if edits <= slack:
                found = (edits, a - int(first[t]) + end)
                if found < best.get((t, item), (1 << 60, 0)):
                    best[t, item] = found
    return [(t, item, *found) for (t, item), found in sorted(best.items())]


def item_blocks(benchmark: DataFrame, edits: float = EDITS) -> list[Items]:
    """The items (item_id, text) in blocks of at most about ``BLOCK_ITEMS`` rows and
    ``BLOCK_BYTES`` of text. Null and empty items are left out."""
    rows = benchmark.where("text IS NOT NULL AND text <> ''").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    blocks = max(1, -(-size.n // BLOCK_ITEMS), -(-size.b // BLOCK_BYTES))
    out = []
    for k in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        out.append(Items([r.item_id for r in part], [r.text for r in part], edits))
    return out


def _finder(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, data, offsets in chunks(batch.column(1)):
                found = find(items, data, offsets)
                if found:
                    text, item, edits, end = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([i + t for t in text])), pa.array([items.ids[x] for x in item], pa.int64()), pa.array(edits, pa.int64()),
                         pa.array([len(items.words[x]) for x in item], pa.int64()), pa.array(end, pa.int64())],
                        names=["doc_id", "item_id", "edits", "n_words", "end_word"],
                    )

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """(doc_id, item_id, edits, n_words, end_word) for each document and item it holds.

    An item of ``n_words`` words is held if some part of the text has an edit
    distance of ``edits * n_words`` words at most; words are compared in lower
    case (A-Z), split at white space. ``end_word`` is the word at which the best
    match ends. A null or empty text holds nothing, nor is a null or empty item
    held. Equal items and rows that repeat a doc_id give rows of their own.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, edits long, n_words long, end_word long"
    return reduce(DataFrame.unionAll, [texts.mapInArrow(_finder(block), schema) for block in item_blocks(benchmark, edits)])


def _holder(items: Items):
    @F.arrow_udf("boolean")
    def holds(text: pa.Array) -> pa.Array:
        out = np.zeros(len(text), bool)
        for i, _, data, offsets in chunks(text):
            for t, *_ in find(items, data, offsets):
                out[i + t] = True
        return pa.array(out)

    return holds


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """``docs`` without the rows whose text holds an item, columns unchanged."""
    for block in item_blocks(benchmark, edits):
        docs = docs.where(~_holder(block)(docs["text"].cast("string")))
    return docs
