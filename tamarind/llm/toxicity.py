"""A toxicity classifier that is kept even-handed by counterfactual texts.

A logistic model over the words of a text and their beginnings. Besides the loss
on labels it is charged for every labelled text that names a group: the text is
written again with another group of the same kind in its place, and the squared
change of the score (before the logistic function) is added to the loss. What
merely names a group therefore gets next to no weight of its own.

The fit takes a bounded sample of labelled rows, ``SAMPLE`` of each class; texts
are scored where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.llm.words import LOWER, chunks, mix, powers
from tamarind.llm.workspace import Workspace

SAMPLE = 3000  # labelled rows of each class that the fit sees at most
FEATURES = 1024  # features with a weight; more of them learn groups of copies by heart
BEGINNINGS = (4, 5, 6)  # bytes
THRESHOLD = 0.7
EVEN = 10.0  # weight of the charge for score changes

# Interchangeable group terms; fixed values, a parameter of fit().
GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("old", "young"),
    ("disabled", "deaf", "blind"),
    ("femmes", "hommes"),
    ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes"),
    ("noirs", "blancs", "asiatiques", "arabes"),
    ("frauen", "männer"),
    ("christen", "muslime", "juden", "hindus", "buddhisten"),
    ("schwarze", "weiße", "asiaten", "araber"),
    ("mujeres", "hombres"),
    ("cristianos", "musulmanes", "judíos", "hindúes", "budistas"),
    ("negros", "blancos", "asiáticos", "árabes"),
)

_SAMPLED = "toxic int, own array<long>, gone array<long>, come array<long>"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_KIND = np.array([0xA5A5A5A5, 0x1234567, 0x89ABCDE, 0xFEDCBA9], np.uint64)


def _lowered(data: np.ndarray) -> np.ndarray:
    low = LOWER[data]
    if len(low) > 1:  # Latin-1 capitals in UTF-8
        second = low[1:]
        second[(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)] += 32
    return low


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each run of letters."""
    inside = _LETTER[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    start[edge] = inside[edge]
    end[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(offsets, starts, "right") - 1


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text numbers, feature hashes) of each occurrence, block by block."""
    starts, ends, doc = _words(data, offsets)
    low = _lowered(data)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + (1 << 20), "right")))
        a, b = starts[i], ends[j - 1]
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum((low[a:b].astype(np.uint64) + np.uint64(1)) * powers(_BASE, b - a), out=total[1:])
        s, e, d = starts[i:j] - a, ends[i:j] - a, doc[i:j]
        back = powers(_BACK, b - a)[s]
        yield d, mix((total[e] - total[s]) * back + _KIND[0])
        for kind, n in enumerate(BEGINNINGS, 1):
            long = e - s > n
            cut = s[long]
            yield d[long], mix((total[cut + n] - total[cut]) * back[long] + _KIND[kind])
        i = j


def _of_text(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    found = [h for _, h in features(data, np.array([0, len(data)]))]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def swapped(text: str, groups: tuple[tuple[str, ...], ...] = GROUPS) -> str | None:
    """``text`` with every group term replaced by the next one of its kind; None if it has none."""
    import re

    after = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    pattern = re.compile(r"(?<![^\W\d_])(" + "|".join(sorted(map(re.escape, after), key=len, reverse=True)) + r")(?![^\W\d_])", re.I)
    out, n = pattern.subn(lambda m: after.get(m[0].lower(), m[0]), text)
    return out if n else None


def _sampler(groups):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                own, other = _of_text(text), swapped(text, groups)
                other = own if other is None else _of_text(other)
                gone, come = np.setdiff1d(own, other), np.setdiff1d(other, own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([toxic], pa.int32()), *(pa.array([x.view(np.int64)], pa.list_(pa.int64())) for x in (own, gone, come))],
                    names=["toxic", "own", "gone", "come"],
                )

    return run


class Model:
    """Weights by feature hash, and an intercept."""

    def __init__(self, names: np.ndarray, weights: np.ndarray, intercept: float):
        order = np.argsort(names)
        self.names, self.weights, self.intercept = names[order], weights[order], intercept
        self._maybe = np.zeros(1 << 16, bool)
        self._maybe[(names & np.uint64(0xFFFF)).astype(np.int64)] = True

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out, hits = np.full(len(offsets) - 1, self.intercept), []
        for doc, h in features(data, offsets):
            some = self._maybe[(h & np.uint64(0xFFFF)).astype(np.int64)]
            doc, h = doc[some], h[some]
            at = np.minimum(np.searchsorted(self.names, h), max(len(self.names) - 1, 0))
            if len(h):
                same = self.names[at] == h
                hits.append(doc[same] * len(self.names) + at[same])
        if hits:
            once = np.unique(np.concatenate(hits))
            np.add.at(out, once // len(self.names), self.weights[once % len(self.names)])
        return out

    def scores(self, column: pa.Array) -> np.ndarray:
        found = [self.logits(data, offsets) for _, _, data, offsets in chunks(column)]
        return 1 / (1 + np.exp(-np.clip(np.concatenate(found), -30, 30))) if found else np.zeros(0)


def fit_rows(toxic: np.ndarray, own: list, gone: list, come: list, even: float = EVEN, steps: int = 800) -> Model:
    """The model of sampled rows: labels, feature hashes, and those that a swap takes away and brings."""
    if not len(toxic) or toxic.min() == toxic.max():
        share = float(toxic.mean()) if len(toxic) else 0.0
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log((share + 0.01) / (1.01 - share))))
    size = np.array([len(x) for x in own])
    names, place = np.unique(np.concatenate(own), return_inverse=True)
    place = place.astype(np.int32)
    row = np.repeat(np.arange(len(own), dtype=np.int32), size)
    n1, n0 = toxic.sum(), len(toxic) - toxic.sum()
    in1 = np.bincount(place, toxic[row], len(names))
    seen = np.bincount(place, minlength=len(names))
    p = seen / len(toxic)
    z = np.abs(in1 / n1 - (seen - in1) / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)
    z[seen < 3] = 0
    best = np.sort(np.lexsort((names, -z))[:FEATURES])
    best = best[z[best] > 0]
    to = np.full(len(names), -1, np.int32)
    to[best] = np.arange(len(best))
    use = to[place] >= 0
    r, c = row[use], to[place][use]
    names = names[best]

    def columns(parts: list, sign: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = np.concatenate(parts) if len(parts) else np.zeros(0, np.uint64)
        at = np.minimum(np.searchsorted(names, h), max(len(names) - 1, 0))
        same = names[at] == h if len(names) else np.zeros(len(h), bool)
        return np.repeat(np.arange(len(parts)), [len(x) for x in parts])[same], at[same], np.full(int(same.sum()), sign)

    change = [np.concatenate(x) for x in zip(columns(gone, -1.0), columns(come, 1.0))]
    weight = np.where(toxic == 1, 0.5 / n1, 0.5 / n0)  # classes count alike in the fit
    w, b = np.zeros(len(names)), 0.0
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, steps + 1):
        score = b + np.bincount(r, w[c], len(toxic))
        error = weight * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - toxic)
        moved = np.bincount(change[0], w[change[1]] * change[2], len(toxic))
        slope = np.bincount(c, error[r], len(names)) + 1e-5 * w
        slope += 2 * even * np.bincount(change[1], (weight * moved)[change[0]] * change[2], len(names))
        g = np.append(slope, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(names, w, float(b))


def _telling(rows: DataFrame, n1: int, n0: int) -> list[int]:
    """Names of the ``FEATURES`` features whose shares in the two classes differ
    most, by the statistic of :func:`fit_rows`, counted over all sampled ``rows``."""
    counts = rows.select("toxic", F.explode("own").alias("name")).groupBy("name").agg(F.count("*").alias("seen"), F.sum("toxic").alias("in1"))
    p = F.col("seen") / F.lit(float(n1 + n0))
    apart = F.abs(F.col("in1") / F.lit(float(n1)) - (F.col("seen") - F.col("in1")) / F.lit(float(n0)))
    z = apart / F.sqrt(p * (1 - p) * (1.0 / n1 + 1.0 / n0) + 1e-12)
    best = counts.where("seen >= 3").withColumn("z", z).orderBy(F.desc("z"), F.col("name") < 0, "name").limit(FEATURES)
    return [r.name for r in best.select("name").collect()]


def _only(names: np.ndarray):
    """Cuts the features of sampled rows down to ``names``, which ascend."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for column in batch.columns[1:]:
                values = [np.intersect1d(x, names, assume_unique=True) for x in np.split(column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())[:-1])]
                lists.append(pa.array(values, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=batch.schema.names)

    return run


def fit(docs: DataFrame, labels: DataFrame, even: float = EVEN, groups=GROUPS, sample: int = SAMPLE) -> Model:
    """Learns from ``labels`` (doc_id, toxic 0 or 1) of ``docs`` (doc_id, text).

    At most about ``sample`` labelled rows of each class, taken by a hash of the
    id, are read. Labels that are null, unknown ids and null ids don't count.
    The features that get a weight are chosen where the rows lie; the driver
    sees a row's toxicity and those of its features, ``FEATURES`` at most.
    """
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("labelled_id"), F.col("toxic").cast("int").alias("toxic"))
    share = {r.toxic: min(1.0, sample / r["count"]) for r in known.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64("labelled_id", F.lit(5)), F.lit(1 << 30)) / (1 << 30)
    some = known.where(F.when(F.col("toxic") == 1, F.lit(share.get(1, 1.0))).otherwise(F.lit(share.get(0, 1.0))) > place)
    texts = docs.select(F.col("doc_id").cast("long").alias("labelled_id"), F.col("text").cast("string").alias("text"))
    # About 2 * sample rows of two numbers, whatever the input's size.
    rows = texts.join(F.broadcast(some), "labelled_id").select("toxic", "text")
    work = Workspace(docs.sparkSession, "toxicity")
    rows = work.keep(rows.mapInArrow(_sampler(groups), _SAMPLED), "sample")
    size = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    names = np.sort(np.array(_telling(rows, size[1], size[0]) if len(size) == 2 else [], np.int64))
    got = rows.mapInArrow(_only(names), _SAMPLED).toArrow()
    work.drop(rows)

    def lists(name: str) -> list[np.ndarray]:
        column = got[name].combine_chunks()
        ends = column.offsets.to_numpy()
        return np.split(column.values.to_numpy().view(np.uint64), ends[1:-1]) if len(column) else []

    toxic = got["toxic"].to_numpy().astype(float)
    return fit_rows(toxic, lists("own"), lists("gone"), lists("come"), even)


def scorer(model: Model):
    """A column function: text to a score from 0 to 1. A null is scored as an empty text."""

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(model.scores(text), pa.float64())

    return score


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """(doc_id, score, predicted) of each row, scored by a model fitted to ``labels``.

    Without labels of both classes the score is the share of the one there is.
    Rows that repeat a doc_id are scored one by one; an empty table gives none.
    Other columns of ``docs``, whatever their names, play no part.
    """
    out = docs.select("doc_id", scorer(fit(docs, labels, **options))(F.col("text").cast("string")).alias("score"))
    return out.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``, columns unchanged."""
    score = scorer(fit(docs, labels, **options))(docs["text"].cast("string"))
    return docs.where(score < threshold)
