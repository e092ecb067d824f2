"""Near duplicates, fingerprints, repeats and decontamination against plain versions."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tamarind.llm import near_dup, repeats
from tamarind.llm.components import components
from tamarind.llm.decontaminate import Items, contaminated, drop_contaminated
from tamarind.llm.fingerprint import containment, fingerprints, merged, with_sketch
from tamarind.llm.workspace import Workspace


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", low)


def shingle_set(text, k):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def plain_near(rows, k, percent=80):
    sets = [(d, shingle_set(t, k)) for d, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(s), least[find(i)], d == least[find(i)]) for i, (d, s) in enumerate(sets))


def corpus(seed=3, groups=6):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(400)
    rows = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 2, 3, 8, 40, 120])))) for i in range(40)]
    for g in range(groups):
        base = [word() for _ in range(80)]
        for c in range(12):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                copy[rng.randrange(80)] = word()
            rows.append((100 + 20 * g + c, " ".join(copy)))
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "Same Words"), (904, "same  words"), (900, None)]
    return rows


@pytest.mark.parametrize("vast", [False, True])
def test_near_duplicates_equal_all_pairs(docs, vast, monkeypatch):
    if vast:  # families are joined key by key
        monkeypatch.setattr(near_dup, "FAMILY_BLOCKS", 0)
    else:  # and here in several blocks
        monkeypatch.setattr(near_dup, "BLOCK_NODES", 5)
    rows = corpus()
    got = near_dup.near_duplicates(docs(rows), words=2).collect()
    assert sorted(map(tuple, got)) == plain_near(rows, 2)


def test_near_duplicates_odd_input(docs):
    assert near_dup.near_duplicates(docs([])).count() == 0
    rows = [(None, "a b c d e f g"), (5, "a b c d e f g"), (None, "x y z"), (7, None), (5, "a b c d e f g"), (8, "a " * 50_000)]
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dup.near_duplicates(docs(rows)).collect()}
    assert got == {(None, 3): (5, False), (5, 3): (5, True), (None, 1): (None, True), (7, 0): (7, True), (8, 1): (8, True)}


def test_drop_near_duplicates_keeps_columns(docs):
    rows = [(1, "a b c d e f g", "en", "s"), (2, "a b c d e f g", "en", "s"), (3, None, "en", "s")]
    df = docs(rows).withColumns({"key": F.lit(1), "node": F.lit("x"), "comp": F.lit(2.0)})
    out = near_dup.drop_near_duplicates(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, x) for x in range(101, 140)] + [(200, 200)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long"), Workspace(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long"), Workspace(spark, "t")).count() == 0


def plain_sketch(text):
    w = [x for x in re.split("[ \t\n\x0b\f\r]+", (text or "").lower()) if x]
    if not w:
        return []
    h = {hashlib.md5(" ".join(w[i : i + 5]).encode()).hexdigest()[:16] for i in range(max(1, len(w) - 4))}
    return sorted(x for x in h if x < "2") or [min(h)]


def test_fingerprints(docs):
    rows = [(i, t) for i, t in corpus(5, 2) if i != 900]
    texts = [t or "" for _, t in sorted(rows)]
    got = fingerprints(docs(rows)).orderBy("doc_id").collect()
    assert len(got) == len(rows)
    for r, t, n in zip(got, texts, texts[1:] + texts[:1]):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + n[:cut]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.sketch == plain_sketch(t) and r.edited_sketch == plain_sketch(edited)
        a, b = set(r.sketch), set(plain_sketch(n))
        assert r.near_next == (len(a & b) / len(a | b) if a | b else 1.0)


def test_fingerprints_odd_input(docs):
    assert fingerprints(docs([])).count() == 0
    one = fingerprints(docs([(4, "é" * 9)]).withColumn("bucket", F.lit(1))).collect()
    assert len(one) == 1 and one[0].n_chars == 9 and one[0].near_next == 1.0
    same = fingerprints(docs([(None, None), (None, "a"), (2, "b c"), (2, "b c"), (2, None)])).collect()
    assert len(same) == 5


def test_sketches_merge_and_contain(docs):
    a, b = " ".join(f"x{i}" for i in range(300)), " ".join(f"x{i}" for i in range(40, 90))
    df = with_sketch(with_sketch(docs([(1, a)]).withColumn("part", F.lit(b)), "text", "s"), "part", "p")
    df = merged(df.withColumn("both", F.array("s", "p")), "both", "m")
    r = df.select("s", "p", "m", containment(F.col("p"), F.col("s")).alias("c")).first()
    assert r.c == 1.0 and r.m == r.s


def plain_repeats(rows, length):
    seen, out = {}, {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        covered = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen.setdefault(b[p : p + length], (d, p)) != (d, p):
                covered[p : p + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, covered) if not c)
        runs = len(re.findall(b"\1+", bytes(covered)))
        out[d] = (len(b), sum(covered), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("many", [1, 2048])
def test_repeats_equal_plain(docs, many, monkeypatch):
    monkeypatch.setattr(repeats, "MANY", many)
    rng = random.Random(9)
    line = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared = [line(n) for n in (99, 100, 101, 160, 700)]
    rows = [(i, line(rng.randrange(300)) + rng.choice(shared) + line(rng.randrange(80)) + rng.choice(shared)) for i in range(40)]
    rows += [(50, "ab" * 400), (51, "a" * 99), (52, "a" * 100), (53, "a" * 500), (54, None), (55, ""), (56, shared[4] * 3)]
    got = {r.doc_id: tuple(r)[1:5] for r in repeats.remove_repeats(docs(rows).withColumn("key", F.lit(0))).collect()}
    assert got == plain_repeats(rows, 100)


def test_repeats_odd_input(docs):
    assert repeats.remove_repeats(docs([])).count() == 0
    t = "".join(random.Random(1).choices("abcdefgh", k=150))
    got = sorted(((r.doc_id is not None, r.doc_id), r.n_removed) for r in repeats.remove_repeats(docs([(3, t), (3, t), (None, t)])).collect())
    assert got == [((False, None), 0), ((True, 3), 150), ((True, 3), 150)]


def test_long_text_is_cut_into_parts():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, (1 << 21) + 5000).astype(np.uint8)
    data[-3000:] = data[1000:4000]
    found = list(repeats._parts(data, np.array([0, len(data)]), 100))
    assert len(found) == 2 and len(found[0][0]) == (1 << 21) + 99
    assert found[1][2][0] == 1 << 21


def test_longest_previous_factor():
    text = b"abracadabra_abracadabra"
    at = np.arange(len(text) - 3)
    order, shared = repeats.suffix_order(np.frombuffer(text, np.uint8), at, np.zeros(len(at), int), 4)
    got = dict(zip(order.tolist(), repeats.longest_previous_factor(order, shared).tolist()))
    common = lambda i, j: next((k for k in range(4) if text[i + k] != text[j + k]), 4)
    assert got == {i: max([0, *(common(i, j) for j in range(i))]) for i in at.tolist()}


def edit_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_contaminated_finds_edited_items(docs, spark):
    rng = random.Random(2)
    word = lambda: "w%d" % rng.randrange(3000)
    items = [(i, " ".join(word() for _ in range(rng.randrange(15, 60)))) for i in range(60)]
    rows, wanted = [], set()
    for i, t in items:
        w = t.split()
        for _ in range(int(rng.choice([0, 0.05, 0.1]) * len(w))):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join([word() for _ in range(50)] + w + [word() for _ in range(50)]).upper()))
    rows += [(1000 + i, " ".join(word() for _ in range(200))) for i in range(40)] + [(2000, None), (2001, "")]
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, " ")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in contaminated(docs(rows), bench).collect()}
    plain = {}
    for d, t in rows:
        for i, x in items:
            w = words_of(x)
            e = edit_distance(w, words_of(t))
            if e <= int(0.2 * len(w)):
                plain[d, i] = e
    assert set(got) <= set(plain) and len(got) >= 0.97 * len(plain)
    assert all(plain[k] == v for k, v in got.items())
    left = {r.doc_id for r in drop_contaminated(docs(rows), bench).collect()}
    assert left == {d for d, _ in rows} - {d for d, _ in got}
    assert contaminated(docs([]), bench).count() == 0
    assert contaminated(docs(rows), bench.limit(0)).count() == 0


def test_item_distance_is_exact():
    rng = random.Random(4)
    for _ in range(100):
        item, text = [[str(rng.randrange(5)) for _ in range(n)] for n in (rng.randrange(1, 12), rng.randrange(0, 20))]
        one = Items([1], [" ".join(item)])
        number = {w: int(one.numbers(near_dup.word_hashes(*_bytes(w))[0])[0]) for w in {*item, *text}}
        assert one.distance(0, [number[w] for w in text])[0] == edit_distance(item, text)


def _bytes(w):
    return np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())])


def test_signature_keys_leave_out_one_symbol():
    a = np.arange(near_dup.SYMBOLS, dtype=np.uint64)[None, :]
    b = a.copy()
    b[0, ::5] += 1  # one error in each chunk
    assert (near_dup._keys(a) == near_dup._keys(b)).sum() == near_dup.CHUNKS
    assert pa.array(near_dup._packed(a)[0].view(np.int64)).null_count == 0
