"""Token files, mixing, toxicity, tool calls and languages."""

import json
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tamarind.llm import token_files
from tamarind.llm.encoder import encoder, vocabulary_path
from tamarind.llm.language import UNKNOWN, languages, profiles
from tamarind.llm.mixing import mixture, rates, replicate
from tamarind.llm.token_files import scan_documents, token_counts
from tamarind.llm.token_table import token_digests, write_tokens
from tamarind.llm.tool_calls import SCHEMAS, canonical, errors_of, levels, link_calls
from tamarind.llm.toxicity import drop_toxic, fit_rows, swapped, toxicity, _of_text
from tamarind.llm.words import span_hashes
from tamarind.llm.workspace import Workspace
from tamarind.session import scratch_path

TEXTS = ["The end.\nNext, one's word.", "", None, "a  b  c　d", "Ünder <|endoftext|> x!!", " lead", "tail ", "日本 語", "x" * 5000, "\x1c a\tb"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def test_encoder_equals_the_library(library):
    rng = np.random.default_rng(0)
    bits = ["a", "B", "é", "×", " ", "  ", "\n", ".", ",", "'s", "'", "1", " ", "日", "<|endoftext|>", "ß", "Ω"]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(bits, rng.integers(0, 40))) for _ in range(400)]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in raw])])
    ids, count = encoder(vocabulary_path()).encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    ends = np.cumsum(count)
    for t, a, b in zip(texts, ends - count, ends):
        assert ids[a:b].tolist() == library.encode(t, add_special_tokens=False).ids


def test_encoder_spends_little_on_finding_pieces():
    """The pieces' beginnings cost no more than cutting, hashing and looking up, which depend on the machine as they do."""
    words = np.random.default_rng(1).choice([f"word{i}" for i in range(500)], 130_000)
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    offsets = np.arange(0, len(data) + 1, 1000)
    data = data[: offsets[-1]]
    code = encoder(vocabulary_path())
    code.encode(data, offsets)  # all pieces are known from here on

    def seconds(fn):
        spent = []
        for _ in range(5):
            start = time.process_time()
            fn()
            spent.append(time.process_time() - start)
        return min(spent)

    def parts():
        starts = np.concatenate([[0], code.cuts(data)])
        np.unique(span_hashes(data, starts, np.append(starts[1:], len(data))), return_index=True, return_inverse=True)

    assert seconds(lambda: code.encode(data, offsets)) < 1.5 * seconds(parts)


def test_token_table_round_trip(spark, docs, library):
    rows = [(i * 7 % 31, t) for i, t in enumerate(TEXTS * 3)]
    path = scratch_path(spark, "test-tokens")
    write_tokens(docs(rows).withColumn("tokens", F.lit(1)).repartition(5), path)
    got = token_digests(spark, path).orderBy("start").collect()
    start = 0
    for r, (d, t) in zip(got, sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or ""))):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        assert tuple(r) == (d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(rows)


def test_token_table_layout_and_empty(spark, docs):
    path = scratch_path(spark, "test-tokens")
    write_tokens(docs([(i, "some words " * 50) for i in range(3000)]).coalesce(1), path, ordered=False)
    import glob

    import pyarrow.parquet as pq

    group = pq.ParquetFile(max(glob.glob(f"{path}/part-*"))).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert any("DICTIONARY" in e for e in columns["tokens.list.element"].encodings)
    assert columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index
    empty = scratch_path(spark, "test-tokens")
    write_tokens(docs([]), empty)
    assert token_digests(spark, empty).count() == 0


@pytest.mark.parametrize("block", [2, 6, 4 << 20])
def test_scan_of_flat_files(spark, tmp_path, block):
    sep = token_files.SEPARATOR
    files = {"a": [1, 2, sep, sep, 3, sep], "b": [sep], "c": [4, 5, 6, 7, 8, 9], "d": [], "e": [sep, 1]}
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    table = spark.createDataFrame([(n, 2 * len(i)) for n, i in files.items()], "file string, n_bytes long")
    got = sorted(map(tuple, scan_documents(table, str(tmp_path), Workspace(spark, "t"), block_bytes=block).collect()))
    assert got == [
        ("a", 0, 0, 2, True), ("a", 1, 3, 0, True), ("a", 2, 4, 1, True), ("b", 0, 0, 0, True), ("c", 0, 0, 6, False),
        ("e", 0, 0, 0, True), ("e", 1, 1, 1, False),
    ]


def test_token_counts(docs, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3])]
    library.encode_special_tokens = True
    want = sorted((d, len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows)
    library.encode_special_tokens = False
    assert sorted((r.doc_id, r.n_tokens) for r in token_counts(docs(rows).repartition(3)).collect()) == want
    assert token_counts(docs([])).count() == 0


def test_mixture_meets_the_rates(docs):
    rows = [(i, "word " * 10, "en", "big" if i % 3 else ("small" if i % 2 else None)) for i in range(6000)]
    df = docs(rows).withColumn("rate", F.lit("mine"))
    rate = {r.mix_source: r.rate for r in rates(df, exponent=0.0).collect()}
    assert rate["big"] == pytest.approx(0.5) and rate[None] == pytest.approx(2.0)
    out = mixture(df, exponent=0.0)
    seen = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert all(abs(seen[s] - 2000) < 250 for s in ("big", "small", None))
    again = mixture(df.repartition(3), exponent=0.0)
    assert out.columns[: len(df.columns)] == df.columns and out.exceptAll(again).count() == 0
    copies = out.where("source IS NULL").groupBy("doc_id").count().groupBy("count").count().collect()
    share = {r[0]: r[1] / 1000 for r in copies}
    assert share[1] == pytest.approx(0.2707, abs=0.05) and share[3] == pytest.approx(0.1804, abs=0.05)


def test_mixture_odd_input(docs):
    assert mixture(docs([])).count() == 0
    assert mixture(docs([(1, None, "en", "a"), (2, "", "en", None)])).count() == 0
    only = mixture(docs([(i, "x", "en", "ab"[i % 2]) for i in range(200)]), {"a": 1.0}, epochs=2.0)
    assert {r.source for r in only.collect()} == {"a"}
    assert mixture(docs([(None, "x", None, "a"), (None, "x", None, "a")]), epochs=3.0).count() % 2 == 0


def test_mixture_of_large_rates(spark, docs):
    wanted = {"a": 1000.0, "b": 720.0, None: 2600.5}
    df = docs([(i, "x", "en", s) for i, s in enumerate([*wanted] * 200)])
    rate = spark.createDataFrame(list(wanted.items()), "mix_source string, rate double")
    out = replicate(df, rate)
    seen = out.groupBy("source", "doc_id").agg(F.count("*").alias("n"), F.countDistinct("mix_copy").alias("copies"), F.max("mix_copies").alias("most")).toPandas()
    assert len(seen) == 600 and (seen.n == seen.copies).all() and (seen.n == seen.most).all()
    for source, r in wanted.items():
        n = seen.n[seen.source.isna() if source is None else seen.source == source]
        assert abs(n.mean() - r) < 4 * (r / 200) ** 0.5 and 0.6 * r < n.var() < 1.4 * r


def sentences(n, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        bad = i % 4 == 0
        words = list(rng.choice([f"plain{k}" for k in range(200)], 20))
        if bad:
            words[3] = rng.choice(["idiot", "moron", "scum"])
        if rng.random() < (0.9 if bad else 0.05):
            words[7] = "Muslims"
        out.append((i, " ".join(words), int(bad)))
    return out


def test_toxicity_on_held_out_rows(spark, docs):
    rows = sentences(1500)
    df = docs([r[:2] for r in rows] + [(9000, None), (9001, "")]).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(d, 1, t) for d, _, t in rows if d < 1000] + [(5, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: (r.score, r.predicted) for r in toxicity(df, labels).collect()}
    assert np.mean([got[d][1] == t for d, _, t in rows if d >= 1000]) > 0.97
    assert got[9000] == got[9001] and got[9000][1] == 0
    kept = {r.doc_id for r in drop_toxic(df, labels).collect()}
    assert kept == {d for d, (_, p) in got.items() if not p}


def test_counterfactual_charge_evens_out_groups():
    rows = sentences(800)
    sets = [(_of_text(t), _of_text(swapped(t) or t)) for _, t, _ in rows]
    own, gone, come = [a for a, _ in sets], [np.setdiff1d(a, b) for a, b in sets], [np.setdiff1d(b, a) for a, b in sets]
    toxic = np.array([float(t) for *_, t in rows])

    def change(even):
        model = fit_rows(toxic, own, gone, come, even)
        scores = model.scores(pa.array(["plain1 Muslims plain2", "plain1 Jews plain2", "plain1 scum plain2"]))
        return abs(scores[0] - scores[1]), scores[0], scores[2]

    free, held = change(0.0), change(10.0)
    assert held[0] < 0.25 * free[0] and held[1] < free[1] and held[2] > 0.5
    assert swapped("The WOMEN, said.") == "The men, said." and swapped("womens") is None


def test_toxicity_without_both_classes(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity(docs([(1, "a")]), labels).collect()] == [0]
    assert toxicity(docs([]), labels).count() == 0


def test_languages(docs):
    rng = np.random.default_rng(2)
    make = lambda parts: " ".join("".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(60))
    parts = {"aa": ["ka", "lo", "mi", "né"], "bb": ["st", "er", "un", "g"], "cc": ["日", "本", "語"]}
    rows = [(i, make(parts[k]), k) for i, k in enumerate(["aa", "bb", "cc"] * 40)]
    learn, rest = docs(rows[:90]), docs([*rows[90:], (500, None, "aa"), (501, "12 ...", "bb"), (502, "é" * 300_000, "aa"), (500, None, "aa")])
    got = [(r.doc_id, r.lang_pred, r.score) for r in languages(rest, learn).collect()]
    of = {d: (lang, s) for d, lang, s in got}
    assert len(got) == 34 and all(of[d][0] == k for d, _, k in rows[90:]) and all(0 <= s <= 1 for _, s in of.values())
    assert of[500] == of[501] == (UNKNOWN, 0.0)
    assert {lang for _, lang, _ in [(r.doc_id, r.lang_pred, r.score) for r in languages(rest, learn.limit(0)).collect()]} == {UNKNOWN}
    assert languages(docs([]), learn).count() == 0
    assert all(len(p) <= 300 for p in profiles(learn).values())


def test_profiles_count_whole_texts(docs):
    got = profiles(docs([(1, "ab ab!AB", "x"), (2, None, "x"), (3, "c", None)]), 100)
    assert set(got) == {"x"} and len(got["x"]) == 7  # a b, _a ab b_, _ab ab_


def test_link_calls(spark):
    call = lambda *r: (1, *r)
    ok = json.dumps({"query": "é\n\"q\"", "limit": 3})
    calls = spark.createDataFrame(
        [call("a", "search", ok, []), call("b", "search", ok, ["a"]), call("c", "search", '{"limit": 99}', ["b", "a", "gone"]), call("d", "none", "{", ["e"]),
         call("e", "search", None, ["d"]), call("f", "search", "null", ["e"]), call("a", "search", ok, []), (None, "a", "translate", '{"query":"x","to":"xx"}', None), call(None, "x", ok, [])],
        "conv_id long, call_id string, name string, arguments string, after array<string>",
    )
    results = spark.createDataFrame([(1, "a", "2"), (1, "a", "1"), (1, "z", "?"), (2, "b", "other"), (None, "a", "n")], "conv_id long, call_id string, content string")
    got = {(r.conv_id, r.call_id): r for r in link_calls(calls, results, SCHEMAS).collect()}
    assert len(got) == 9
    assert {k: (r.status, r.level) for k, r in got.items()} == {
        (1, "a"): ("linked", 0), (1, "b"): ("unanswered", 1), (1, "c"): ("unanswered", 2), (1, "d"): ("unanswered", None), (1, "e"): ("unanswered", None),
        (1, "f"): ("unanswered", None), (1, "z"): ("orphan", None), (2, "b"): ("orphan", None), (None, "a"): ("linked", 0),
    }
    assert got[1, "a"].json == '{"arguments":{"limit":3,"query":"é\\n\\"q\\""},"id":"a","name":"search","result":"1"}' and got[1, "a"].valid
    assert got[1, "c"].errors == "$.query: missing; $.limit: above 9" and "not JSON" in got[1, "d"].errors
    assert got[1, "f"].errors == "$: not of type object" and not got[None, "a"].valid
    assert link_calls(calls.limit(0), results.limit(0), SCHEMAS).count() == 0


def test_errors_and_canonical():
    assert errors_of({"a": [1, "x"]}, {"properties": {"a": {"type": "array", "items": {"type": "integer"}}}}) == ["$.a[1]: not of type integer"]
    assert errors_of(True, {"type": "integer"}) and errors_of({"b": 1}, {"additionalProperties": False}) == ["$.b: not allowed"]
    assert canonical({"b": 1, "a": ["é"]}) == '{"a":["é"],"b":1}'


def test_levels_of_chains_forks_and_cycles(spark):
    """Against a plain search: long chains, calls with several needs, cycles and what hangs on them."""
    rng = np.random.Generator(np.random.PCG64(11))
    needs = {(1, f"c{i}"): [f"c{i - 1}"] if i else [] for i in range(37)}
    needs |= {(2, f"c{i}"): sorted({f"c{j}" for j in rng.integers(0, i, rng.integers(0, 4))}) if i else [] for i in range(40)}
    needs |= {(3, "a"): ["b"], (3, "b"): ["a"], (3, "c"): ["b"], (3, "d"): ["c", "e"], (3, "e"): ["gone"], (3, "f"): ["f"], (3, "g"): ["e", "e"]}
    needs |= {(None, "a"): [], (None, "b"): ["a"]}

    want = {}
    while True:
        new = {}
        for (conv, call), after in needs.items():
            known = {n for n in after if (conv, n) in needs}
            if (conv, call) not in want and all((conv, n) in want for n in known):
                new[conv, call] = max([want[conv, n] + 1 for n in known], default=0)
        if not new:
            break
        want |= new
    calls = spark.createDataFrame([(c, i, a) for (c, i), a in needs.items()], "conv_id long, call_id string, after array<string>")
    got = levels(calls, Workspace(spark, "test-levels")).collect()
    assert len(got) == len(want)
    assert {(r.conv_id, r.call_id): r.level for r in got} == want
