"""Secrets in texts: fixed rules, and a character convolutional network for the rest.

Three rules find assignments to key words, access key ids and long hex strings.
A candidate is any run of secret-like characters that doesn't look like a word.
A network of one convolution reads the bytes of every candidate and its
surroundings; what it scores high enough is reported beside what the rules find.

The network is learned from labelled findings: all different candidates of the
texts with their context, by default labelled by the rules. They are dealt into
shards; in each round every shard goes on from the same parameters through all
its findings, and the means over the shards begin the next round. Half of the
labelled secrets are shown once more in the context of another finding, so that
the characters have to decide. Scores are calibrated on all findings kept apart
(Platt), and for each shape of candidate the threshold is the highest one that
keeps the wanted recall there; both follow from counts of each logit's step.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.llm.words import chunks, mix
from tamarind.llm.workspace import DURING, Workspace, settings

KINDS = ("assign", "access", "hex", "net")  # in the order of equal starts
CONTEXT = 24  # bytes on both sides of a candidate
SHARD = 4096  # different findings that are learned from between two means of the parameters, about
ROUNDS = 6  # passes over all findings
TASKS = 4096  # of a round at most; a task takes its shards one by one
STEPS, BATCH = 300, 128  # steps of all rounds at least; findings of a step, half of each label
LIGHT = 512  # bytes of findings that come again where a label has too few; longer ones have one turn in a pass
ENOUGH = 10  # findings of a label, or secrets of a shape, below which nothing is learned
RECALL = 0.98
LEAST, LONG = 8, 20  # bytes of a candidate; of one that has letters only

# The rules' patterns; fixed values. A finding of the first needs 8 characters in its group.
ASSIGN = re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
HEX = re.compile(rb"[0-9a-f]{32,}")
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

_RUN = np.zeros(256, bool)
_RUN[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-", np.uint8)] = True
_ODD = np.zeros(256, bool)
_ODD[np.frombuffer(b"0123456789+/_=", np.uint8)] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_HEXES = re.compile(rb"[0-9a-fA-F]+\Z")

PAD, DEPTH, WIDTH, FILTERS = 768, 8, 5, 24  # a symbol is a byte, apart for left context, candidate and right context
TILE = 4096  # positions of a window that are convolved at once
BLOCK = 1 << 16
LOGIT_STEPS, LOGIT_END = 256, 32  # logits are multiples of 1/256 up to 32, so that counts of each are a small table
_EXACT = 1 << 24  # parameters are added up as integers, so the order of shards plays no part

_FINDING = "secret int, left binary, body binary, right binary"


def rule_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the rules find, in bytes."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of each candidate of a chunk of texts, in bytes of the chunk.

    A run of ``[A-Za-z0-9+/_.=-]`` of 8 bytes or more, without the dots and dashes
    at its ends, that holds a digit, one of ``+/_=`` or an upper-case letter after
    its first, or is 20 bytes long.
    """
    inside = _RUN[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    start[edge] = inside[edge]
    end[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    long = ends - starts >= LEAST
    starts, ends = starts[long], ends[long]
    odd = np.concatenate([[0], np.cumsum(_ODD[data])])
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    use = (odd[ends] > odd[starts]) | (upper[ends] > upper[np.minimum(starts + 1, len(data))]) | (ends - starts >= LONG)
    starts, ends = starts[use], ends[use]
    for i, (s, e) in enumerate(zip(starts.tolist(), ends.tolist())):
        body = data[s:e].tobytes()
        starts[i], ends[i] = s + len(body) - len(body.lstrip(b".-")), e - len(body) + len(body.rstrip(b".-"))
    use = ends - starts >= LEAST
    starts, ends = starts[use], ends[use]
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends


def window(left: bytes, body: bytes, right: bytes) -> np.ndarray:
    parts = [np.frombuffer(x, np.uint8).astype(np.int16) + 256 * zone for zone, x in enumerate((left, body, right))]
    return np.concatenate([*parts, np.full(WIDTH - 1, PAD, np.int16)])


def shape(body: bytes) -> str:
    return "hex" if _HEXES.match(body) else "mixed" if any(48 <= c <= 57 for c in body) else "letters"


def _tiles(windows: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Windows of any length, ``BLOCK`` positions at once: (number of the window of each
    tile, symbols of the tiles, first position and number of positions of each tile,
    place of each position in the symbols)."""
    tiles = [(i, w[a : a + TILE + WIDTH - 1]) for i, w in enumerate(windows) for a in range(0, len(w) - WIDTH + 1, TILE)]
    a = 0
    while a < len(tiles):
        b, size = a, 0
        while b < len(tiles) and (b == a or size + len(tiles[b][1]) <= BLOCK):
            size += len(tiles[b][1])
            b += 1
        width = np.array([len(t) - WIDTH + 1 for _, t in tiles[a:b]])
        at = np.arange(width.sum()) + np.repeat((WIDTH - 1) * np.arange(len(width)), width)
        yield np.array([i for i, _ in tiles[a:b]]), np.concatenate([t for _, t in tiles[a:b]]), np.cumsum(width) - width, width, at
        a = b


@dataclass
class Network:
    """Symbols have vectors; a convolution over ``WIDTH`` of them, its largest and
    mean activations over the window, a logistic unit."""

    vectors: np.ndarray  # (PAD + 1, DEPTH), the last one zero
    kernel: np.ndarray  # (WIDTH, DEPTH, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    out: np.ndarray  # (2 * FILTERS,)
    shift: float
    slope: float = 1.0  # of the calibration
    offset: float = 0.0
    thresholds: dict[str, float] | None = None  # by shape; "" for all others

    def pooled(self, windows: list[np.ndarray]) -> np.ndarray:
        """(windows, 2 * FILTERS); windows of any length, ``BLOCK`` positions at once."""
        tables = [(self.vectors @ k).astype(np.float32) for k in self.kernel]
        most, total = np.zeros((len(windows), FILTERS), np.float32), np.zeros((len(windows), FILTERS))
        for owner, flat, first, _, at in _tiles(windows):
            lit = np.maximum(sum(t[flat[at + k]] for k, t in enumerate(tables)) + self.bias.astype(np.float32), 0)
            np.maximum.at(most, owner, np.maximum.reduceat(lit, first))
            np.add.at(total, owner, np.add.reduceat(lit, first, dtype=np.float64))
        size = np.array([len(w) - WIDTH + 1 for w in windows])[:, None]
        return np.hstack([most, total / size]) if windows else np.zeros((0, 2 * FILTERS))

    def logits(self, windows: list[np.ndarray]) -> np.ndarray:
        return self.pooled(windows) @ self.out + self.shift

    def steps(self, windows: list[np.ndarray]) -> np.ndarray:
        """Logits as numbers of ``1 / LOGIT_STEPS``."""
        return np.rint(np.clip(self.logits(windows), -LOGIT_END, LOGIT_END) * LOGIT_STEPS).astype(np.int64)

    def calibrated(self, steps: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (steps / LOGIT_STEPS) + self.offset, -30, 30)))

    def scores(self, windows: list[np.ndarray]) -> np.ndarray:
        """Calibrated, 0 to 1."""
        return self.calibrated(self.steps(windows))


_SHAPES = {"vectors": (PAD + 1, DEPTH), "kernel": (WIDTH, DEPTH, FILTERS), "bias": (FILTERS,), "out": (2 * FILTERS,), "shift": (1,)}


def _flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[name].ravel() for name in _SHAPES])


def _shaped(flat: np.ndarray) -> dict[str, np.ndarray]:
    ends = np.cumsum([int(np.prod(of)) for of in _SHAPES.values()])
    return {name: part.reshape(of) for (name, of), part in zip(_SHAPES.items(), np.split(flat, ends[:-1]))}


def _network(p: dict[str, np.ndarray]) -> Network:
    return Network(p["vectors"], p["kernel"], p["bias"], p["out"], float(p["shift"][0]))


def _begin() -> dict[str, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(11))
    p = {
        "vectors": rng.normal(0, 0.3, (PAD + 1, DEPTH)), "kernel": rng.normal(0, 0.3, (WIDTH, DEPTH, FILTERS)),
        "bias": np.zeros(FILTERS), "out": rng.normal(0, 0.2, 2 * FILTERS), "shift": np.zeros(1),
    }
    p["vectors"][PAD] = 0
    return p


def _gradient(p: dict[str, np.ndarray], windows: list[np.ndarray], secret: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean logistic loss; windows of any length are read whole, tile by tile."""
    most, mean = np.zeros((len(windows), FILTERS)), np.zeros((len(windows), FILTERS))
    size = np.array([len(w) - WIDTH + 1 for w in windows])

    def lights(flat: np.ndarray, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        seen = [p["vectors"][flat[at + k]] for k in range(WIDTH)]
        return seen, np.maximum(sum(x @ k for x, k in zip(seen, p["kernel"])) + p["bias"], 0)

    blocks = 0
    for owner, flat, first, _, at in _tiles(windows):
        last, blocks = lights(flat, at), blocks + 1
        np.maximum.at(most, owner, np.maximum.reduceat(last[1], first))
        np.add.at(mean, owner, np.add.reduceat(last[1], first))
    pooled = np.hstack([most, mean / size[:, None]])
    error = (1 / (1 + np.exp(-np.clip(pooled @ p["out"] + p["shift"], -30, 30))) - secret) / len(windows)
    g = {"out": pooled.T @ error, "shift": np.array([error.sum()]), "bias": np.zeros(FILTERS)}
    g["kernel"], vectors = np.zeros_like(p["kernel"]), np.zeros((PAD + 1) * DEPTH)
    back = error[:, None] * p["out"]
    for owner, flat, _, width, at in _tiles(windows):  # one block at a time is held
        seen, lit = last if blocks == 1 else lights(flat, at)
        of = np.repeat(owner, width)
        d = (lit == most[of]) * back[of, :FILTERS] + (back[:, FILTERS:] / size[:, None])[of]
        d *= lit > 0
        g["bias"] += d.sum(0)
        g["kernel"] += np.stack([x.T @ d for x in seen])
        for k in range(WIDTH):
            cell = flat[at + k].astype(np.int64)[:, None] * DEPTH + np.arange(DEPTH)
            vectors += np.bincount(cell.ravel(), (d @ p["kernel"][k].T).ravel(), len(vectors))
    g["vectors"] = vectors.reshape(PAD + 1, DEPTH)
    return g


def _learned(p: dict[str, np.ndarray], windows: list[np.ndarray], secret: np.ndarray, steps: int, batch: int, seed: list[int]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Adam on the logistic loss, both labels with equal weight, and which symbols the
    windows hold; the vectors of others stay. All findings of a label have had their
    turn before light ones come again."""
    rng = np.random.Generator(np.random.PCG64(seed))
    p = dict(p)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    held, size = np.zeros(PAD + 1, bool), np.array([len(w) for w in windows])
    for w in windows:
        held[w] = True
    turns = []
    for label in (0, 1):
        own = np.flatnonzero(secret == label)
        light = own[size[own] <= max(LIGHT, size[own].min())]
        more = max(0, steps * (batch // 2) - len(own))
        turns.append(np.concatenate([rng.permutation(own), *(rng.permutation(light) for _ in range(-(-more // len(light))))]))
    for step in range(1, steps + 1):
        rows = np.concatenate([x[(step - 1) * (batch // 2) : step * (batch // 2)] for x in turns])
        g = _gradient(p, [windows[i] for i in rows], secret[rows])
        for name in ("out", "kernel", "vectors"):
            g[name] = g[name] + 1e-4 * p[name]
        g["vectors"][~held] = g["vectors"][PAD] = 0
        for name, x in g.items():
            m[name] = 0.9 * m[name] + 0.1 * x
            v[name] = 0.999 * v[name] + 0.001 * x * x
            p[name] = p[name] - 0.01 * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)
    return p, held


def _shown(findings: list[tuple[int, bytes, bytes, bytes]]) -> tuple[list[np.ndarray], np.ndarray]:
    """Windows and labels to learn from: all findings, half of the secrets once more beside another's context."""
    others = [f for f in findings if not f[0]]
    moved = [(1, o[1], f[2], o[3]) for i, f in enumerate(f for f in findings if f[0]) for o in [others[i % len(others)]] if i % 2 == 0]
    rows = findings + moved
    return [window(*f[1:]) for f in rows], np.array([f[0] for f in rows])


def _platt(logits: np.ndarray, secret: np.ndarray, count: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the findings kept apart, ``count`` of each row."""
    n1, n0 = count[secret == 1].sum(), count[secret == 0].sum()
    target = np.where(secret == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([logits, np.ones(len(logits))], 1)

    def loss(w: np.ndarray) -> float:
        return float(count @ (np.logaddexp(0, x @ w) - target * (x @ w)) + 5e-7 * w @ w)

    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -700, 700)))
        step = np.linalg.solve((x * (count * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (count * (p - target)) + 1e-6 * w)
        size = 1.0  # a whole step leads astray where nothing lies between the labels
        while size > 1e-12 and loss(w - size * step) > loss(w):
            size /= 2
        if size <= 1e-12:
            break
        w -= size * step
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def _calibrate(net: Network, apart: list[tuple[int, str, int, int]], recall: float) -> Network:
    """Calibration and thresholds from (secret, shape, step of the logit, count) of all findings kept apart."""
    secret, shapes, steps, count = (np.array(x) for x in zip(*sorted(apart)))
    net.slope, net.offset = _platt(steps / LOGIT_STEPS, secret, count)

    def threshold(rows: np.ndarray) -> float:
        """The highest that at least ``recall`` of the findings reach."""
        rows = rows[np.argsort(steps[rows], kind="stable")]
        below = np.cumsum(count[rows])
        place = np.searchsorted(below, np.floor(below[-1] * (1 - recall) + 1e-9), "right")
        return float(net.calibrated(steps[rows[place : place + 1]])[0])

    net.thresholds = {"": threshold(np.flatnonzero(secret == 1))}
    for kind in sorted(set(shapes.tolist())):
        own = np.flatnonzero((secret == 1) & (shapes == kind))
        if count[own].sum() >= ENOUGH:
            net.thresholds[kind] = threshold(own)
    return net


def fit_findings(findings: list[tuple[int, bytes, bytes, bytes]], recall: float = RECALL, steps: int = STEPS, batch: int = BATCH) -> Network | None:
    """The network of labelled findings (secret, left, body, right) that are at hand; :func:`fit`
    learns from those of a table. None if a label has too few.

    A third of them, by a hash of their place in the list, is kept apart for
    the calibration and the thresholds. All others are learned from, whatever ``steps``.
    """
    secret = np.array([f[0] for f in findings], np.int64)
    if min(np.count_nonzero(secret == 0), np.count_nonzero(secret == 1)) < ENOUGH:
        return None
    apart = mix(np.arange(len(findings), dtype=np.uint64)) % np.uint64(3) == 0
    for label in (0, 1):  # both labels on both sides
        own = np.flatnonzero(secret == label)
        apart[own[0]], apart[own[1]] = True, False
    windows, labels = _shown([f for f, a in zip(findings, apart) if not a])
    p, held = _learned(_begin(), windows, labels, max(steps, _turns(labels, batch)), batch, [11])
    p["vectors"][~held] = 0
    net, kept = _network(p), [f for f, a in zip(findings, apart) if a]
    return _calibrate(net, [(f[0], shape(f[2]), step, 1) for f, step in zip(kept, net.steps([window(*f[1:]) for f in kept]).tolist())], recall)


def _turns(labels: np.ndarray, batch: int) -> int:
    """Steps in which every finding has its turn."""
    return -(-int(max(np.count_nonzero(labels == 0), np.count_nonzero(labels == 1))) // (batch // 2))


def _spans_of(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, bytes, list, list]]:
    """(text number, text, rule spans, candidates with whether a rule's span meets them)."""
    doc, starts, ends = candidates(data, offsets)
    first = np.searchsorted(doc, np.arange(len(offsets)))
    for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        text = data[a:b].tobytes()
        found = rule_spans(text)
        own = [(s - a, e - a) for s, e in zip(starts[first[k] : first[k + 1]].tolist(), ends[first[k] : first[k + 1]].tolist())]
        yield k, text, found, list(zip(own, _met(own, found)))


def _met(own: list[tuple[int, int]], found: list[tuple[int, int, int]]) -> list[bool]:
    """Whether each span of ``own`` shares a byte with one of ``found``; both ascend by start."""
    reach = np.maximum.accumulate([e for _, _, e in found]) if found else np.zeros(0, np.int64)
    starts = np.array([s for s, _, _ in found], np.int64)
    before = np.searchsorted(starts, [e for _, e in own])
    return [bool(n and reach[n - 1] > s) for (s, _), n in zip(own, before.tolist())]


def _around(text: bytes, s: int, e: int) -> tuple[bytes, bytes, bytes]:
    return text[max(0, s - CONTEXT) : s], text[s:e], text[e : e + CONTEXT]


def _finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different findings of each chunk of texts."""
    types = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    for batch in batches:
        for _, _, data, offsets in chunks(batch.column(0)):
            rows = {(int(met), *_around(text, s, e)) for _, text, _, own in _spans_of(data, offsets) for (s, e), met in own}
            columns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["secret", "left", "body", "right"])


def _place(salt: int):
    """A hash of a finding."""
    return F.xxhash64("left", "body", "right", F.lit(salt))


def labelled_findings(docs: DataFrame, sample: int | None = None) -> DataFrame:
    """(secret, left, body, right): all different candidates of all texts with their
    context, labelled by whether a rule finds them; a candidate is whole.

    ``sample``: only that many of each label, by a hash.
    """
    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_finder, _FINDING).distinct()
    if sample is None:
        return found
    return found.where("secret = 1").orderBy(_place(11)).limit(sample).unionAll(found.where("secret = 0").orderBy(_place(11)).limit(sample))


def _rows(table: pa.Table) -> list[tuple[int, bytes, bytes, bytes]]:
    return sorted(zip(*(table.column(name).to_pylist() for name in ("secret", "left", "body", "right"))))


def _shard_round(p: dict[str, np.ndarray], number: int):
    """A shard's findings, all of them, have their turns from ``p`` on; its parameters in units of ``1 / _EXACT``."""

    def run(table: pa.Table) -> pa.Table:
        windows, labels = _shown(_rows(table))
        steps = max(-(-STEPS // ROUNDS), _turns(labels, BATCH))
        own, held = _learned(p, windows, labels, steps, BATCH, [11, number, table.column("shard")[0].as_py()])
        use = np.concatenate([np.repeat(held, DEPTH), np.ones(len(_flat(own)) - held.size * DEPTH, bool)])
        place = np.flatnonzero(use)
        return pa.table({"place": pa.array(place.astype(np.int32)), "value": pa.array(np.rint(_flat(own)[place] * _EXACT).astype(np.int64))})

    return run


def _stepper(net: Network):
    """Label, shape and step of the logit of findings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(2).to_pylist()
            steps = net.steps([window(*f) for f in zip(batch.column(1).to_pylist(), bodies, batch.column(3).to_pylist())]) if bodies else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shape(b) for b in bodies], pa.string()), pa.array(steps, pa.int64())], names=["secret", "shape", "step"])

    return run


def fit(docs: DataFrame | None, findings: DataFrame | None = None, recall: float = RECALL) -> Network | None:
    """Learns from all ``findings`` (secret, left, body, right), by default :func:`labelled_findings`;
    rows that repeat one count once. None if a label has fewer than ``ENOUGH``.

    A third of them, by a hash, is kept apart for the calibration and the
    thresholds. All others are dealt into shards of about ``SHARD``; the light
    findings of a label that is too rare for all of them are repeated, so that each
    shard has half a batch of it, or all there are. The driver sees a network and counts of a round, no findings.
    """
    found = labelled_findings(docs) if findings is None else findings.select(F.col("secret").cast("int").alias("secret"), "left", "body", "right").distinct()
    spark = found.sparkSession
    work = Workspace(spark, "secrets")
    found = work.keep(found.withColumn("place", _place(11)), "findings")
    with settings(spark, DURING):
        net = _fit(found, recall)
    work.drop(found)
    return net


def _fit(found: DataFrame, recall: float) -> Network | None:
    total = {r.secret: r.n for r in found.groupBy("secret").agg(F.count("*").alias("n")).collect()}
    if min(total.get(0, 0), total.get(1, 0)) < ENOUGH:
        return None
    apart = F.pmod(_place(3), F.lit(3)) == 0
    for label in (0, 1):  # both labels on both sides
        first, second = (r.place for r in found.where(F.col("secret") == label).select("place").orderBy("place").limit(2).collect())
        own = F.col("secret") == label
        apart = (apart | (own & (F.col("place") == first))) & ~(own & (F.col("place") == second))
    found = found.withColumn("apart", apart)
    light = F.octet_length("body") <= LIGHT
    learn = {r.secret: r for r in found.where("not apart").groupBy("secret").agg(F.count("*").alias("n"), F.count_if(light).alias("light")).collect()}
    shards = -(-sum(r.n for r in learn.values()) // SHARD)
    times = F.lit(1)
    for label, r in learn.items():
        copies = min(shards, -(-(BATCH // 2) * shards // (r.light or r.n)))
        times = F.when((F.col("secret") == label) & (light if r.light else F.lit(True)), F.lit(copies)).otherwise(times)
    dealt = found.where("not apart").select("secret", "left", "body", "right", "place", F.explode(F.sequence(F.lit(0), times - 1)).alias("copy"))
    dealt = dealt.select("secret", "left", "body", "right", F.pmod(F.col("place") + F.col("copy"), F.lit(shards)).cast("int").alias("shard"))
    dealt = dealt.repartition(min(shards, TASKS), "shard")  # by number, as few bytes are much work
    p = _begin()
    for number in range(ROUNDS):
        parts = dealt.groupBy("shard").applyInArrow(_shard_round(p, number), "place int, value long")
        flat = np.zeros(len(_flat(p)))  # symbols of no finding say nothing
        for r in parts.groupBy("place").agg(F.sum("value").alias("sum"), F.count("*").alias("n")).collect():
            flat[r.place] = r.sum / r.n / _EXACT
        p = _shaped(flat)
    net = _network(p)
    steps = found.where("apart").select("secret", "left", "body", "right").mapInArrow(_stepper(net), "secret int, shape string, step long")
    return _calibrate(net, [tuple(r) for r in steps.groupBy("secret", "shape", "step").agg(F.count("*").alias("n")).collect()], recall)


def _scanner(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in chunks(batch.column(1)):
                found, asked, windows = [], [], []
                for k, text, spans, own in _spans_of(data, offsets):
                    rows = [(s, kind, e, None) for s, kind, e in spans]
                    found.append((text, rows))
                    for (s, e), met in own if net else ():
                        if not met:
                            around = _around(text, s, e)
                            asked.append((k, s, e, net.thresholds.get(shape(around[1]), net.thresholds[""])))
                            windows.append(window(*around))
                for (k, s, e, least), score in zip(asked, net.scores(windows).tolist() if windows else ()):
                    if score >= least:
                        found[k][1].append((s, 3, e, score))
                kinds, starts, ends, scores, count = [], [], [], [], []
                for text, rows in found:
                    count.append(len(rows))
                    if rows:
                        points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
                        for s, kind, e, score in sorted(rows, key=lambda r: r[:3]):
                            kinds.append(KINDS[kind])
                            starts.append(int(points[s]))
                            ends.append(int(points[e]))
                            scores.append(score)
                parts = [pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(scores, pa.float64())]
                spans = pa.StructArray.from_arrays(parts, ["kind", "start", "end", "score"])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), spans)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists], names=["doc_id", "spans"])

    return run


def secret_spans(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, spans) of each row of ``docs`` (doc_id, text): what the rules find
    and which candidates beside it ``net`` takes for secrets.

    A span is (kind, start, end, score) in code points, ``end`` exclusive, ordered
    by start and then by the order of ``KINDS``; rules have no score. Without
    ``net`` only rules speak. A null or empty text has no spans; rows that repeat
    a doc_id or a text are scanned one by one; an empty table gives no rows;
    other columns of ``docs`` play no part. Texts and candidates of any length
    are read whole.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scanner(net), "doc_id long, spans array<struct<kind: string, start: long, end: long, score: double>>")


def find_secrets(docs: DataFrame, findings: DataFrame | None = None, recall: float = RECALL) -> DataFrame:
    """:func:`secret_spans` with a network learned from ``findings`` or from ``docs`` themselves."""
    return secret_spans(docs, fit(docs, findings, recall))
