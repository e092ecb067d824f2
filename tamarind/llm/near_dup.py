"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A text's signature holds ``SYMBOLS`` MinHash values cut to 16 bits. It is split
into ``CHUNKS`` chunks of ``SYMBOLS / CHUNKS`` symbols. Two signatures that
differ in fewer than ``2 * CHUNKS`` symbols have, by the pigeonhole principle, a
chunk with one error at most, so they agree on one of the chunk's keys, which
leave one symbol out in turn. All such pairs meet; pairs further apart meet
unless every chunk has two errors or more. At a similarity of 0.8 that happens
to one pair in ten million.

Texts with equal shingle sets are one node. Among the nodes of a key, pairs
inside one component need no look. First each node is compared with one other
(the first of its keys' pivots, in an order that changes by round). Nodes whose
keys then still hold several components are gathered into families that share
keys; a family is cut into blocks of bounded size, and each pair of blocks is a
task that looks at pairs across components only and returns the links that join
them. A family of very many blocks is joined key by key instead. So large groups
of near copies cost no row for each pair, and no link that would join two
components is lost. Every link is confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.llm.components import components
from tamarind.llm.words import chunks, mix, shingles, word_hashes
from tamarind.llm.workspace import Workspace
from tamarind.operators.keyed import spread_join

CHUNKS, PER_CHUNK = 12, 5
SYMBOLS = CHUNKS * PER_CHUNK
LANES = SYMBOLS // 4  # longs of four 16-bit symbols
FAR = 27  # signatures further apart are no candidates: a few pairs in a million at a similarity of 0.8
ROUNDS = 2
BLOCK_NODES, BLOCK_SHINGLES = 2048, 1 << 21  # a block of a family; larger families have more blocks
FAMILY_BLOCKS = 64  # beyond, a family's keys are joined one by one instead of its blocks

_rng = np.random.Generator(np.random.PCG64(20240229))
_A = _rng.integers(1, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, SYMBOLS, dtype=np.uint64)
_SALT = _rng.integers(0, 2**63, SYMBOLS, dtype=np.uint64)

_SKETCH = "doc_id long, n_shingles long, node long, sig array<long>, keys array<long>"


def _signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(node, symbols) of non-empty sets."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    symbols = np.empty((len(sets), SYMBOLS), np.uint64)
    for i in range(SYMBOLS):
        symbols[:, i] = np.minimum.reduceat((flat * _A[i] + _B[i]) >> np.uint64(32), starts)
    node = np.add.reduceat(mix(flat), starts) + mix(np.array([len(s) for s in sets], np.uint64))
    return mix(node), symbols & np.uint64(0xFFFF)


def _packed(symbols: np.ndarray) -> np.ndarray:
    four = symbols.reshape(len(symbols), -1, 4) << np.array([0, 16, 32, 48], np.uint64)
    return np.bitwise_or.reduce(four, axis=2)


def _keys(symbols: np.ndarray) -> np.ndarray:
    """Each chunk's symbols but one, for each choice of the one."""
    out = np.empty((len(symbols), SYMBOLS), np.uint64)
    for c in range(CHUNKS):
        chunk = symbols[:, c * PER_CHUNK : (c + 1) * PER_CHUNK]
        for left_out in range(PER_CHUNK):
            rest = np.delete(chunk, left_out, axis=1)
            i = c * PER_CHUNK + left_out
            out[:, i] = mix(_packed(rest)[:, 0] ^ _SALT[i])
    return out


def _lists(rows: np.ndarray, present: np.ndarray) -> pa.Array:
    """A list column with ``rows`` where ``present``, else null."""
    width = rows.shape[1]
    offsets = np.concatenate([[0], np.cumsum(present * width)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1).view(np.int64)), mask=pa.array(~present))


def _sketcher(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, offsets in chunks(batch.column(1)):
                sets = list(shingles(*word_hashes(data, offsets), words))
                size = np.array([len(s) for s in sets], np.int64)
                full = size > 0
                node, sig, keys = np.zeros(len(sets), np.int64), np.zeros((0, LANES), np.uint64), np.zeros((0, SYMBOLS), np.uint64)
                if full.any():
                    found, symbols = _signatures([s for s in sets if len(s)])
                    node[full] = found.view(np.int64)
                    sig, keys = _packed(symbols), _keys(symbols)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i).cast(pa.int64()), pa.array(size), pa.array(node, mask=~full), _lists(sig, full), _lists(keys, full)],
                    names=["doc_id", "n_shingles", "node", "sig", "keys"],
                )

    return run


def _set_maker(words: int):
    """(node, set) of texts; a row whose text gives another node than the wanted one, if that isn't null, is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            any_node = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            wanted = batch.column(0).fill_null(0).to_numpy()
            for i, j, data, offsets in chunks(batch.column(1)):
                sets = list(shingles(*word_hashes(data, offsets), words))
                nodes = np.zeros(len(sets), np.int64)
                full = [n for n, s in enumerate(sets) if len(s)]
                if full:
                    flat = [sets[n] for n in full]
                    starts = np.concatenate([[0], np.cumsum([len(s) for s in flat])[:-1]])
                    sums = np.add.reduceat(mix(np.concatenate(flat)), starts) + mix(np.array([len(s) for s in flat], np.uint64))
                    nodes[full] = mix(sums).view(np.int64)
                use = [n for n in full if any_node[i + n] or nodes[n] == wanted[i + n]]
                if use:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes[use]), pa.array([sets[n].view(np.int64) for n in use], pa.list_(pa.int64()))], names=["node", "shingles"]
                    )

    return run


def _folded(step: int):
    """Lets a lane's lowest bit gather, in steps of 8, 4, 2 and 1, its sixteen bits."""
    return lambda x: x.bitwiseOR(F.shiftrightunsigned(x, step))


def _distance(a: str, b: str) -> Column:
    """Symbols in which two packed signatures differ."""
    bits = F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y))
    for step in (8, 4, 2, 1):
        bits = F.transform(bits, _folded(step))
    return F.aggregate(bits, F.lit(0), lambda n, x: n + F.bit_count(x.bitwiseAND(F.lit(0x0001000100010001))))


def _near(percent: int) -> Column:
    sizes = (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    return sizes & (_distance("sig_a", "sig_b") <= FAR)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("s_b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    return both.where(common * 100 >= (F.size("s_a") + F.size("s_b") - common) * percent).select("a", "b")


def _block_links(percent: int):
    """Links that join components, of one pair of blocks; of a chain of links, those that join."""

    def run(table: pa.Table) -> pa.Table:
        node, comp = table["node"].to_numpy(), table["comp"].to_numpy()
        block, same = table["block"].to_numpy(), table["left"][0].as_py() == table["right"][0].as_py()
        flat = table["shingles"].combine_chunks()
        values, ends = flat.flatten().to_numpy(), np.concatenate([[0], np.cumsum(flat.value_lengths().to_numpy())])
        size = np.diff(ends)
        sig = table["sig"].combine_chunks().flatten().to_numpy().view(np.uint16).reshape(len(node), SYMBOLS)
        root = {c: c for c in comp.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        columns = np.ascontiguousarray(sig.T)
        found = []
        for x in range(len(node)):
            apart = np.zeros(len(node) - x - 1, np.int16)
            for i in range(SYMBOLS):
                apart += columns[i, x + 1 :] != columns[i, x]
            others = np.flatnonzero(apart <= FAR) + x + 1
            low, high = np.minimum(size[others], size[x]), np.maximum(size[others], size[x])
            others = others[(low * 100 >= high * percent) & (same | (block[others] != block[x]))]
            now = find(int(comp[x]))
            others = [y for y in others[np.argsort(apart[others - x - 1], kind="stable")].tolist() if find(int(comp[y])) != now]
            own = values[ends[x] : ends[x + 1]].view(np.uint64)
            for y in others:
                there = find(int(comp[y]))
                if there == find(int(comp[x])):
                    continue
                theirs = values[ends[y] : ends[y + 1]].view(np.uint64)
                at = np.searchsorted(own, theirs)
                at[at == len(own)] = 0
                common = int(np.count_nonzero(own[at] == theirs))
                if common * 100 >= (len(own) + len(theirs) - common) * percent:
                    root[there] = find(int(comp[x]))
                    found.append((int(node[x]), int(node[y])))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return run


def _across(rest: DataFrame, nodes: DataFrame, sigs: DataFrame, sets: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """Links between components among the nodes that share a key in ``rest`` (key, node, comp, pivot)."""
    family = work.keep(components(rest.select(F.col("node").alias("a"), F.col("pivot").alias("b")), work).withColumnRenamed("comp", "family"), "family")
    of = family.join(nodes.select("node", "n"), "node").groupBy("family").agg(F.count("*").alias("count"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("count") / BLOCK_NODES), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    # A family may hold a large part of the nodes: its rows are spread by node.
    of = spread_join(family, of.select("family", blocks.alias("blocks")), ["family"], by="node", ways=64)
    comp = rest.select("node", "comp").distinct()
    some = of.where(F.col("blocks") <= FAMILY_BLOCKS).join(comp, "node").withColumn("block", F.pmod(F.hash("node"), "blocks"))
    some = some.join(sigs.select("node", "sig"), "node").join(sets, "node").withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    some = some.select("family", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", "node", "comp", "sig", "shingles")
    dense = work.keep(some.groupBy("family", "left", "right").applyInArrow(_block_links(percent), "a long, b long"), "links")

    vast = rest.join(of.where(F.col("blocks") > FAMILY_BLOCKS).select("node"), "node").join(sigs, "node")
    x = vast.select("key", *[F.col(c).alias(f"{c}_a") for c in ("node", "comp", "n", "sig")])
    y = vast.select("key", *[F.col(c).alias(f"{c}_b") for c in ("node", "comp", "n", "sig")])
    pairs = x.join(y, (x.key == y.key) & (x.comp_a < y.comp_b) & _near(percent))
    pairs = pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    return work.keep(dense.unionAll(_confirmed(pairs, sets, percent)), "links")


def _contracted(labels: DataFrame | None, links: DataFrame, work: Workspace) -> DataFrame:
    """(node, comp) after ``links`` (a, b) have joined components of ``labels``.

    Only the graph of components that the new links touch is resolved; earlier
    links are not looked at again.
    """
    if labels is None:
        return work.keep(components(links, work), "labels")
    of = lambda end: labels.select(F.col("node").alias(end), F.col("comp").alias(f"comp_{end}"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    merged = work.keep(components(ends.select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b")), work), "merged")
    moved = labels.join(merged.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left")
    moved = moved.select("node", F.coalesce("to", "comp").alias("comp"))
    after = work.keep(moved.unionAll(merged.join(labels.select("node"), "node", "left_anti")), "labels")
    work.drop(labels, merged, links)
    return after


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text).

    Rows are linked if ``100 * |A and B| >= percent * |A or B|`` for their sets
    of distinct ``words``-word shingles. ``component_id`` is the smallest doc_id
    that links reach, ``kept`` says that it is the row's own.

    A null or empty text, or one without words, has no shingles and is linked
    with nothing. Rows that repeat a doc_id and a text get equal results. A row
    without doc_id is kept only if no row with a doc_id is in its component;
    its component_id is then null. An empty table gives no rows. Other columns
    of ``docs`` play no part. ``percent`` must be 50 or more; recall is as stated
    above for 80 and higher.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be 50 to 100")
    work = Workspace(docs.sparkSession, "near-dup")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = work.keep(texts.mapInArrow(_sketcher(words), _SKETCH), "sketch")
    nodes = sketch.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("keys").alias("keys")
    )
    nodes = work.keep(nodes, "nodes")
    every = nodes.select("node", F.explode("keys").alias("key"))
    shared = every.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    keys = work.keep(every.join(shared, "key"), "keys")
    involved = keys.select("node").distinct().join(nodes.select("node", "first_id"), "node")
    # Rows with an id find their node by it; those without make their node anew, so that they don't all meet each other.
    found = texts.join(involved.where("first_id IS NOT NULL").select("node", F.col("first_id").alias("doc_id")), "doc_id").select("node", "text")
    nameless = texts.where("doc_id IS NULL").select(F.lit(None).cast("long").alias("node"), "text")
    maker = _set_maker(words), "node long, shingles array<long>"
    nameless = nameless.mapInArrow(*maker).join(involved.where("first_id IS NULL").select("node"), "node", "left_semi")
    sets = work.keep(found.mapInArrow(*maker).unionAll(nameless).dropDuplicates(["node"]), "sets")
    sigs = nodes.select("node", "n", "sig")
    side = lambda x: sigs.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))

    labels = None
    for turn in range(ROUNDS + 1):
        members = keys.withColumn("comp", F.col("node")) if labels is None else keys.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        members = members.select("key", "node", "comp")
        pivot = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("order"), F.col("node").alias("node"), F.col("comp").alias("comp")))
        mixed = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), pivot.alias("pivot")).where("lo < hi")
        if turn < ROUNDS:
            pairs = members.join(mixed.select("key", "pivot"), "key").where("comp <> pivot.comp")
            pairs = pairs.groupBy(F.col("node").alias("a")).agg(F.min("pivot").alias("pivot")).select("a", F.col("pivot.node").alias("b"))
            pairs = pairs.join(side("a"), "a").join(side("b"), "b").where(_near(percent)).select("a", "b")
            new = work.keep(_confirmed(pairs, sets, percent), "links")
        else:
            rest = work.keep(members.join(mixed.select("key", F.col("pivot.node").alias("pivot")), "key"), "rest")
            new = _across(rest, nodes, sigs, sets, percent, work)
        if not new.isEmpty():
            labels = _contracted(labels, new, work)

    of_node = nodes.select("node", "first_id")
    if labels is not None:
        named = labels.join(of_node, "node").groupBy("comp").agg(F.min("first_id").alias("least_id"))
        of_node = of_node.join(labels.join(named, "comp").select("node", "least_id"), "node", "left")
        of_node = of_node.select("node", F.coalesce("least_id", "first_id").alias("component_id"))
    else:
        of_node = of_node.withColumnRenamed("first_id", "component_id")
    out = sketch.select("doc_id", "n_shingles", "node").join(of_node, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return work.only(out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept")), "result")


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component left, columns unchanged.

    A document is a doc_id: rows that repeat a kept one all stay.
    """
    out = near_duplicates(docs, words, percent).where("NOT kept").select(F.col("doc_id").alias("id_of_copy"), F.lit(True).alias("is_copy")).distinct()
    joined = docs.join(out, docs["doc_id"].eqNullSafe(out["id_of_copy"]), "left_anti")
    return joined.select(*[docs[f"`{c}`"] for c in docs.columns])
