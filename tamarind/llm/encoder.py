"""Encoding of many texts with a file of the tokenizers library, inside tasks.

Byte-level BPE splits a text before it merges bytes, and never across a single
space between two visible characters or before a sentence mark after a letter.
Pieces between such places are encoded once per worker process by the library
and looked up from then on by a 64-bit hash; texts are put together from them.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from tamarind.llm.words import span_hashes

VOCABULARY = "byte_bpe_50k.json"
MOST_PIECES = 1 << 20  # pieces a process remembers, about 30 bytes each; then it starts anew
_TEXTS = 256  # rows of pieces that the library encodes at once; its results are many times their size

_VISIBLE = np.ones(256, bool)
_VISIBLE[:33] = False
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[np.frombuffer(b",.!?;:", np.uint8)] = True


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(2)
def encoder(path: str, special: bool = True) -> "Encoder":
    """One for each process. ``special``: strings of special tokens in a text become those tokens."""
    return Encoder(path, special)


class Encoder:
    def __init__(self, path: str, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not special
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.type = np.uint16 if max(vocabulary.values()) < 1 << 16 else np.uint32
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)  # one character of the byte alphabet for each byte
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.type)

    def cuts(self, data: np.ndarray) -> np.ndarray:
        return _cuts(data)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each text."""
        begins = np.zeros(len(data), bool)  # of a text or, behind a cut, of a piece
        begins[self.cuts(data)] = begins[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begins)
        if not len(starts):
            return self.ids[:0], np.zeros(len(offsets) - 1, np.int64)
        ends = np.append(starts[1:], len(data))
        names, at, place = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        where = self._places(names, data, starts[at], ends[at])
        start, count = self.start[where][place], self.count[where][place]
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.repeat(start - total[:-1], count) + np.arange(total[-1])]
        return ids, np.diff(total[np.searchsorted(starts, offsets)])

    def _places(self, names: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.known) + len(names) > MOST_PIECES:
            self._forget()
        at = np.searchsorted(self.known, names)
        new = np.ones(len(names), bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != names
        if new.any():
            ids, count = self._encode_pieces(data, starts[new], ends[new])
            start = len(self.ids) + np.concatenate([[0], np.cumsum(count)[:-1]])
            self.ids = np.concatenate([self.ids, ids])
            self.known, self.start, self.count = (np.insert(old, at[new], x) for old, x in ((self.known, names[new]), (self.start, start), (self.count, count)))
            at = np.searchsorted(self.known, names)
        return at

    def _encode_pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces that begin with a space and end visibly stay apart when put in a row; others go alone."""
        last = ends - 1
        joined = (data[starts] == 32) & (ends - starts > 1) & _VISIBLE[data[np.minimum(starts + 1, len(data) - 1)]] & (data[starts + (ends - starts > 1)] < 128)
        joined &= _VISIBLE[data[last]] & (data[last] < 128)
        order = np.concatenate([np.flatnonzero(joined), np.flatnonzero(~joined)])
        rows, pieces = [], [data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(starts[order].tolist(), ends[order].tolist())]
        n = int(joined.sum())
        texts = ["".join(pieces[i : min(i + 64, n)]) for i in range(0, n, 64)] + pieces[n:]
        for i in range(0, len(texts), _TEXTS):
            for encoding in self.library.encode_batch_fast(texts[i : i + _TEXTS], add_special_tokens=False):
                rows.append(np.array(encoding.ids, self.type))
        width = (ends - starts)[order]
        single = np.array([len(r) for r in rows[len(rows) - (len(pieces) - n) :]], np.int64) if n < len(pieces) else np.zeros(0, np.int64)
        together = np.concatenate(rows[: len(rows) - (len(pieces) - n)]) if n else np.zeros(0, self.type)
        reach = np.concatenate([[0], np.cumsum(self.bytes_of[together])])
        edge = np.searchsorted(reach, np.concatenate([[0], np.cumsum(width[:n])]))
        count = np.concatenate([np.diff(edge), single])
        flat = np.concatenate(rows) if rows else np.zeros(0, self.type)
        # Back into the order in which the pieces came.
        start = np.concatenate([[0], np.cumsum(count)[:-1]])
        back = np.argsort(order, kind="stable")
        count, start = count[back], start[back]
        total = np.concatenate([[0], np.cumsum(count)])
        return flat[np.repeat(start - total[:-1], count) + np.arange(total[-1])], count


def _cuts(data: np.ndarray) -> np.ndarray:
    """Places at which the library always splits, whatever stands around them.

    Only such are taken as need no decoding: a space between visible ASCII or
    Latin letters, a sentence mark after one of these letters.
    """
    if len(data) < 3:
        return np.zeros(0, np.int64)
    before, here = data[:-1], data[1:]
    latin = np.zeros(len(data) - 1, bool)  # second byte of a Latin-1 letter
    latin[1:] = (data[:-2] == 0xC3) & (data[1:-1] >= 0x80) & (data[1:-1] != 0x97) & (data[1:-1] != 0xB7)
    letter = _ALPHA[before] | latin
    clear = (_VISIBLE[before] & (before < 128)) | latin
    after = np.zeros(len(data) - 1, bool)
    after[:-1] = (_VISIBLE[data[2:]] & (data[2:] < 128)) | (data[2:] == 0xC3)
    return np.flatnonzero(((here == 32) & clear & after) | (_MARK[here] & letter)) + 1
