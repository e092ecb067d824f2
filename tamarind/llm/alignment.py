"""Alignment of the tokens of two tokenizers by pointer jumping.

Both tokenizers cut the same bytes. Tokens that overlap, directly or through
others, form a group; groups end where both tokenizers end a token. Every token
points to the token of the other kind that overlaps it and reaches farthest to
the right, or to itself if none reaches farther. All pointers are doubled at
once (``next = next[next]``) until they stand still: after about the logarithm
of the longest chain every token points to the last token of its group, which is
the group's label. A chunk of many documents is labelled in one go, because both
tokenizers end a token at a document's end.

Id pairs are counted over the corpus without a row for each link: a task makes
blocks of documents of bounded size and writes, beside the documents' own pairs
(places in the block's list), one list of the block's pairs with the number of
its documents that hold them. Lists are added up by pair, and each block gets
the totals of its own pairs back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.llm.encoder import VOCABULARY, Encoder, encoder, vocabulary_path
from tamarind.llm.words import chunks
from tamarind.llm.workspace import Workspace

PIECES = "piece_bpe_32k.model"
BLOCK = 4 << 20  # bytes of text whose pairs share a list
LINKS = 1 << 20  # links that are written out at once, for a while
MANY = 64  # links of a group from which its equal ids are taken together first

_SPACE = "▁"
_ROW = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "place array<int>, weight array<long>, a array<int>, b array<int>, docs array<int>"
)
_GROUPS = "doc_id long, groups array<struct<a: array<int>, b: array<int>>>"


class PieceEncoder(Encoder):
    """As :class:`Encoder`, for a sentencepiece model with identity normalisation.

    Texts are given with the space in front that the model adds. No piece of the
    vocabulary has a space behind another character, so a run of spaces always
    begins a piece, and what lies between such places is encoded on its own.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        whole = [n for i, n in enumerate(names) if not self.library.is_byte(i)]
        self.apart = not any(_SPACE in n.lstrip(_SPACE) for n in whole)
        self.entries = [bytes([int(n[3:5], 16)]) if self.library.is_byte(i) else n.replace(_SPACE, " ").encode() for i, n in enumerate(names)]
        self.lone = self.library.piece_to_id(_SPACE)
        self.type = np.uint16 if len(names) < 1 << 16 else np.uint32
        self._forget()

    def cuts(self, data: np.ndarray) -> np.ndarray:
        if not self.apart:
            return np.zeros(0, np.int64)
        return np.flatnonzero((data[1:] == 32) & (data[:-1] != 32)) + 1

    def _encode_pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = []
        for i in range(0, len(starts), 4096):
            texts = [data[s + 1 : e].tobytes().decode("utf-8", "replace") for s, e in zip(starts[i : i + 4096].tolist(), ends[i : i + 4096].tolist())]
            rows += [ids if text else [self.lone] for text, ids in zip(texts, self.library.encode(texts, num_threads=1))]
        count = np.array([len(r) for r in rows], np.int64)
        return np.concatenate([np.array(r, self.type) for r in rows]) if rows else np.zeros(0, self.type), count


def byte_alphabet() -> dict[str, int]:
    """Character of byte-level vocabularies to byte: visible Latin-1 characters
    are themselves, all other bytes follow from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokens:
    """The bytes of every entry of a vocabulary, and the decimal text of its id."""

    def __init__(self, code: Encoder, entries: list[bytes]):
        self.code = code
        self.size = np.array([len(e) for e in entries], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, ids of each text, and whether their bytes are the text's."""
        ids, count = self.code.encode(data, offsets)
        size = self.size[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        reach = np.concatenate([[0], np.cumsum(count)])
        same = np.diff(total[reach]) == np.diff(offsets)
        if same.all():
            whole = self.flat[np.repeat(self.start[ids] - total[:-1], size) + np.arange(total[-1])]
            wrong = np.flatnonzero(whole != data)
            same[np.searchsorted(offsets, wrong, "right") - 1] = False
        else:  # lengths differ somewhere: the texts of equal length one by one
            for k in np.flatnonzero(same).tolist():
                own = ids[reach[k] : reach[k + 1]]
                same[k] = b"".join(self.flat[s : s + n].tobytes() for s, n in zip(self.start[own].tolist(), self.size[own].tolist())) == data[offsets[k] : offsets[k + 1]].tobytes()
        return ids, count, same


@lru_cache(2)
def tokenizers(a: str, b: str) -> tuple[Tokens, Tokens]:
    """Both for each process: a file of the tokenizers library, a sentencepiece model."""
    first, alphabet = encoder(a, special=False), byte_alphabet()
    names = {i: name for name, i in first.library.get_vocab(with_added_tokens=True).items()}
    entries = [bytes(alphabet[c] for c in names[i]) if i in names else b"" for i in range(max(names) + 1)]
    second = PieceEncoder(b)
    return Tokens(first, entries), Tokens(second, second.entries)


def labels(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token, counted from 0, from the tokens' ascending ends.

    Tokens of a kind follow one another without gap; both kinds end together.
    """
    n = len(end_a)
    over_a = np.searchsorted(end_b, end_a)  # the token of the other kind that holds the last byte
    over_b = np.searchsorted(end_a, end_b)
    own = np.arange(n, n + len(end_b))
    to = np.concatenate([over_a + n, np.where(end_a[over_b] > end_b, over_b, own) if n else own])
    while True:
        twice = to[to]
        if np.array_equal(twice, to):
            break
        to = twice
    number = np.cumsum(to == np.arange(len(to))) - 1  # only last tokens point to themselves
    group = number[to]
    return group[:n], group[n:]


class Chunk:
    """Texts with their tokens of both kinds and the groups of these."""

    def __init__(self, pair: tuple[Tokens, Tokens], data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        full = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][full], 32)
        offsets = offsets + np.concatenate([[0], np.cumsum(full)])
        (ids_a, n_a, same_a), (ids_b, n_b, same_b) = (t.encode(data, offsets) for t in pair)
        use = same_a & same_b
        doc_a, doc_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        self.a, self.doc_a = ids_a[use[doc_a]].astype(np.int64), doc_a[use[doc_a]]
        self.b, self.doc_b = ids_b[use[doc_b]].astype(np.int64), doc_b[use[doc_b]]
        self.group_a, self.group_b = labels(np.cumsum(pair[0].size[self.a]), np.cumsum(pair[1].size[self.b]))
        self.n = n
        self.size_a, self.size_b = np.bincount(self.group_a), np.bincount(self.group_b)
        self.doc = self.doc_b[np.cumsum(self.size_b) - 1] if len(self.size_b) else np.zeros(0, np.int64)  # of each group

    def counts(self) -> list[np.ndarray]:
        """Tokens of both kinds, groups and links of each text."""
        links = np.zeros(self.n, np.int64)
        np.add.at(links, self.doc, self.size_a * self.size_b)
        return [np.bincount(x, minlength=self.n) for x in (self.doc_a, self.doc_b, self.doc)] + [links]

    def digests(self) -> list[str]:
        """sha256 of ``a1,a2|b1;a3|b2,b3`` for each text, empty without tokens."""
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        ends_a, ends_b = np.cumsum(self.size_a), np.cumsum(self.size_b)
        last_a[ends_a - 1], last_b[ends_b - 1] = 1, 2
        final = np.flatnonzero(np.append(self.doc[1:] != self.doc[:-1], True)) if len(self.doc) else np.zeros(0, np.int64)
        last_b[ends_b[final] - 1] = 3
        row = np.empty(len(self.a) + len(self.b), np.int64)
        row[np.arange(len(self.a)) + (ends_b - self.size_b)[self.group_a]] = self.a * 4 + last_a
        row[np.arange(len(self.b)) + ends_a[self.group_b]] = self.b * 4 + last_b
        tokens = np.bincount(self.doc_a, minlength=self.n) + np.bincount(self.doc_b, minlength=self.n)
        at, out, texts = 0, [], _decimals(1 << int(max(row.max(initial=0) // 4, 1)).bit_length())
        for k in tokens.tolist():
            out.append(hashlib.sha256(b"".join([texts[x] for x in row[at : at + k].tolist()])).hexdigest() if k else "")
            at += k
        return out

    def pairs(self, entries_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, links) of each text's different pairs; a pair is ``a * entries_b + b``."""
        many = self.size_a * self.size_b > MANY
        group_a, a, weight_a = _gathered(self.group_a, self.a, many)
        group_b, b, weight_b = _gathered(self.group_b, self.b, many)
        size_b = np.bincount(group_b, minlength=len(many))
        start_b = np.cumsum(size_b) - size_b
        links = np.cumsum(size_b[group_a])
        doc, pair, weight = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        i = 0
        while i < len(a):
            j = max(i + 1, int(np.searchsorted(links, (links[i - 1] if i else 0) + LINKS, "right")))
            each = size_b[group_a[i:j]]
            left = np.repeat(np.arange(i, j), each)
            right = np.arange(len(left)) + np.repeat(start_b[group_a[i:j]] - (np.cumsum(each) - each), each)
            doc, pair, weight = _added(
                np.concatenate([doc, self.doc[group_a[left]]]), np.concatenate([pair, a[left] * entries_b + b[right]]), np.concatenate([weight, weight_a[left] * weight_b[right]])
            )
            i = j
        return doc, pair, weight


@lru_cache(2)
def _decimals(n: int) -> list[bytes]:
    """The text of ``id * 4 + kind``: the id and what follows it."""
    return [b"%d%s" % (i >> 2, (b",", b"|", b";", b"")[i & 3]) for i in range(4 * n)]


def _gathered(group: np.ndarray, ids: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens with weights, by group: equal ids of the groups in ``many`` are one."""
    one = np.ones(len(ids), np.int64)
    if not many.any():
        return group, ids, one
    big = many[group]
    key, count = np.unique(group[big] << 32 | ids[big], return_counts=True)
    group, ids, one = np.concatenate([group[~big], key >> 32]), np.concatenate([ids[~big], key & 0xFFFFFFFF]), np.concatenate([one[~big], count])
    order = np.argsort(group, kind="stable")
    return group[order], ids[order], one[order]


def _added(doc: np.ndarray, pair: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a text and pair as one, ordered by both."""
    order = np.lexsort((pair, doc))
    doc, pair, weight = doc[order], pair[order], weight[order]
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1]))) if len(doc) else np.zeros(0, np.int64)
    return doc[new], pair[new], np.add.reduceat(weight, new) if len(new) else weight


def _lists(values: np.ndarray, ends: np.ndarray, type_: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values, type_))


def _blocks(a: str, b: str):
    def finished(block: int, ids: list, chunks_of: list) -> pa.RecordBatch:
        """A row for each text, then the block's list of pairs."""
        entries_b = len(tokenizers(a, b)[1].size)
        counts = [np.concatenate(x) for x in zip(*(c.counts() for c in chunks_of))]
        parts, first = [], 0
        for c in chunks_of:
            doc, pair, weight = c.pairs(entries_b)
            parts.append((doc + first, pair, weight))
            first += c.n
        doc, pair, weight = (np.concatenate(x) for x in zip(*parts))
        known, place, docs = np.unique(pair, return_inverse=True, return_counts=True)
        ends = np.searchsorted(doc, np.arange(first), "right")
        none = pa.nulls
        own = [pa.array(np.full(first, block)), pa.concat_arrays(ids), *map(pa.array, counts), pa.array([d for c in chunks_of for d in c.digests()], pa.string())]
        own += [_lists(place, ends, pa.int32()), _lists(weight, ends, pa.int64())] + [none(first, pa.list_(pa.int32()))] * 3
        of_block = [pa.array([block], pa.int64()), *(none(1, x.type) for x in own[1:9])]
        of_block += [_lists(x, np.array([len(known)]), pa.int32()) for x in (known // entries_b, known % entries_b, docs)]
        names = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "place", "weight", "a", "b", "docs"]
        return pa.RecordBatch.from_arrays([pa.concat_arrays([x, y]) for x, y in zip(own, of_block)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, block = tokenizers(a, b), TaskContext.get().partitionId() << 32
        ids, found, size = [], [], 0
        for batch in batches:
            for i, j, data, offsets in chunks(batch.column(1)):
                ids.append(batch.column(0).slice(i, j - i))
                found.append(Chunk(pair, data, offsets))
                size += len(data) + 64 * (j - i)
                if size >= BLOCK:
                    yield finished(block, ids, found)
                    ids, found, size, block = [], [], 0, block + 1
        if found:
            yield finished(block, ids, found)

    return run


def _grouper(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in chunks(batch.column(1)):
                c = Chunk(tokenizers(a, b), data, offsets)
                groups = pa.StructArray.from_arrays([_lists(c.a, np.cumsum(c.size_a), pa.int32()), _lists(c.b, np.cumsum(c.size_b), pa.int32())], ["a", "b"])
                ends = np.concatenate([[0], np.cumsum(np.bincount(c.doc, minlength=c.n))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), groups)], names=["doc_id", "groups"])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def token_groups(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """(doc_id, groups): for each row the ids of both tokenizers by group, in order."""
    return _texts(docs).mapInArrow(_grouper(a or vocabulary_path(VOCABULARY), b or vocabulary_path(PIECES)), _GROUPS)


def pair_totals(rows: DataFrame) -> DataFrame:
    """(of_block, place, total, best) of the pairs in each block's list, from what :func:`_blocks` wrote."""
    listed = rows.where("a IS NOT NULL").select("block", F.posexplode(F.arrays_zip("a", "b", "docs")).alias("place", "of"))
    listed = listed.select("block", "place", F.col("of.a").alias("a"), F.col("of.b").alias("b"), F.col("of.docs").alias("docs"))
    total = listed.groupBy("a", "b").agg(F.sum("docs").alias("total"))
    highest = total.groupBy("a").agg(F.max("total").alias("highest"))
    total = total.join(highest, "a").select("a", "b", "total", (F.col("total") == F.col("highest")).alias("best"))
    return listed.select("block", "place", "a", "b").join(total, ["a", "b"]).select(F.col("block").alias("of_block"), "place", "total", "best")


def _summed(rows: pa.Table, totals: pa.Table) -> pa.Table:
    """n_best and count_sum of a block's texts."""
    place = totals["place"].to_numpy()
    total, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    total[place], best[place] = totals["total"].to_numpy(), totals["best"].to_numpy(zero_copy_only=False)
    lists, weights = rows["place"].combine_chunks(), rows["weight"].combine_chunks()
    at, weight = lists.flatten().to_numpy(), weights.flatten().to_numpy()
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    sums = [np.diff(np.concatenate([[0], np.cumsum(weight * x[at])])[ends]) for x in (best, total)]
    out = rows.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return out.append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1])).append_column("groups_sha256", rows["groups_sha256"])


def alignment(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row of ``docs``.

    ``a`` is the file of a byte-level tokenizer, which encodes a space and the
    text; ``b`` a sentencepiece model, which adds the space. Tokens of both whose
    byte ranges share a group are linked. A pair of ids counts the rows, over all
    of ``docs``, that hold it linked; ``n_best`` are links whose count is the
    highest of their ``a`` id (ties included), ``count_sum`` adds the counts up.

    A text that is null or empty, or that a tokenizer does not give back byte by
    byte, has no tokens: zeros and an empty digest. Rows that repeat a doc_id or
    a text are rows of their own and all count; a null doc_id stays null. An
    empty table gives no rows; other columns of ``docs`` play no part. A task
    holds one block of ``BLOCK`` bytes, or one longer text, at a time.
    """
    work = Workspace(docs.sparkSession, "alignment")
    rows = _texts(docs).mapInArrow(_blocks(a or vocabulary_path(VOCABULARY), b or vocabulary_path(PIECES)), _ROW)
    rows = work.keep(rows, "blocks")
    own = rows.where("a IS NULL").drop("a", "b", "docs")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return work.only(own.groupBy("block").cogroup(pair_totals(rows).groupBy("of_block")).applyInArrow(_summed, schema), "result")
