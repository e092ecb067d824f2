"""The pipeline over planted toxic, copied and contaminated documents, each stage against a plain version."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from tamarind.llm.encoder import vocabulary_path
from tamarind.session import cut_lineage

INSULTS = "idiot moron scum idiot"
ITEMS = [" ".join(f"item{k}word{i}" for i in range(30)) for k in range(2)]


def _planted():
    """(doc_id, text, lang, source, n_chars)"""
    rng = np.random.default_rng(3)
    plain = lambda n: " ".join(rng.choice([f"plain{k}" for k in range(200)], n))
    texts = {100 + i: plain(40) + (f" {INSULTS}" if i % 4 == 0 else "") for i in range(400)}
    family = plain(60)
    texts |= {1: f"{family} {INSULTS}", 2: family, 3: f"{family} more", 4: family}  # without 1, 2 is the one to stay
    held = f"{plain(20)} {ITEMS[0]} {plain(20)}"
    texts |= {5: held, 6: f"{held} more", 7: ITEMS[1].replace("word4", "other").replace("word9 ", "")}  # 6 goes as a copy, 5 by its item
    texts |= {8: "one two", 9: "one two", 10: "", 11: f"{plain(30)} {' '.join(ITEMS[0].split()[:12])}"}
    source = lambda i: None if i % 9 == 0 else "ab"[i % 5 == 0]
    return [(i, t, "en", source(i), len(t)) for i, t in texts.items()]


def _without_copies(docs):
    def shingles(text):
        w = text.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    sets, first = {d: shingles(r[1]) for d, r in docs.items()}, {d: d for d in docs}

    def find(d):
        return d if first[d] == d else find(first[d])

    for a in docs:
        for b in docs:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                first[y] = x
    return {d: r for d, r in docs.items() if find(d) == d}


def _holds(text, item):
    words, item = text.lower().split(), item.lower().split()
    row = list(range(len(item) + 1))
    best = row[-1]
    for w in words:
        new = [0]
        for j, x in enumerate(item, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != x)))
        row, best = new, min(best, new[-1])
    return best <= math.floor(0.2 * len(item))


def _copies(docs):
    sizes = Counter()
    for r in docs.values():
        sizes[r[3]] += len(r[1])
    weights, out = sum(math.sqrt(s) for s in sizes.values()), Counter()
    for d, r in docs.items():
        size = sizes[r[3]]
        rate = math.sqrt(size) / weights * sum(sizes.values()) / size
        u, k = int(hashlib.md5(f"{d}|mix-1".encode()).hexdigest()[:13], 16) / (1 << 52), 0
        term = total = math.exp(-rate)
        while total <= u:
            k += 1
            term *= rate / k
            total += term
        if k:
            out[d] = k
    return out


def test_stages_equal_plain_versions(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    rows = _planted()
    toxic = {r[0] for r in rows if INSULTS in r[1]}
    sf = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    labels = [(r[0], 1, int(r[0] in toxic)) for r in rows if 100 <= r[0] < 400]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    stages = {}

    def kept(df, label):
        stages[label] = cut_lineage(df, label)
        return stages[label]

    monkeypatch.setattr(corpus_pipeline, "cut_lineage", kept)
    got = corpus_pipeline.run(spark, sf).collect()
    assert list(stages) == [f"pipeline-{n}" for n, _ in corpus_pipeline.STAGES[:-1]]

    def same(name, want):
        out = sorted(map(tuple, stages[f"pipeline-{name}"].collect()), key=lambda r: r[0])
        assert out == sorted(want, key=lambda r: r[0]), name

    docs = {r[0]: r for r in rows if r[0] not in toxic}
    same("toxicity", docs.values())
    docs = _without_copies(docs)
    assert {2, 5, 7, 8, 11} <= set(docs) and not {1, 3, 4, 6, 9} & set(docs)
    same("near_duplicates", docs.values())
    docs = {d: r for d, r in docs.items() if not any(_holds(r[1], i) for i in ITEMS)}
    assert {2, 8, 11} <= set(docs) and not {5, 7} & set(docs)
    same("decontamination", docs.values())
    copies = _copies(docs)
    assert max(copies.values()) > 1 and len(copies) < len(docs)
    same("mixing", [docs[d] for d in copies.elements()])

    library, want = Tokenizer.from_file(vocabulary_path()), Counter()
    for d, n in copies.items():
        ids = [*library.encode(docs[d][1], add_special_tokens=False).ids, 0]
        want[d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] = n
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert [s for s, _ in starts] == [0, *np.cumsum([n for _, n in starts])[:-1]]
