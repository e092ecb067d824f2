"""Clashing columns, broken JSON, addresses, very frequent sequences and hot sources."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamarind.llm import language, mixing, near_dup, token_files, toxicity
from tamarind.llm.mixing import mixture, rates, replicate
from tamarind.llm.tool_calls import check_schema, errors_of, link_calls, parsed
from tamarind.llm.words import mix


def test_mixture_with_clashing_columns(docs):
    rows = [(i, f"text {i} " * (i % 7), None, f"s{i % 3}") for i in range(60)]
    plain = mixture(docs(rows), epochs=3.0)
    names = ["mix_source", "mix_rate", "mix_sums", "mix_us", "mix_copies", "mix_key", "row", "key", "of", "rate", "copies", "copy", "salt", "part"]
    odd = mixture(docs(rows).select("*", *[F.lit(f"own {n}").alias(n) for n in names]), epochs=3.0)
    assert odd.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and len(set(odd.columns)) == len(odd.columns)
    want = sorted(map(tuple, plain.select("doc_id", "mix_copy", "mix_copies", "mix_key").collect()))
    assert sorted(map(tuple, odd.select("doc_id", "mix_copy", "mix_copies", "mix_key").collect())) == want
    assert {r.mix_rate for r in odd.select("mix_rate").collect()} == {"own mix_rate"}


def test_mixture_beyond_the_rates_that_fit_every_task(docs, monkeypatch):
    rows = [(i, "a b c", None, None if i % 9 == 0 else f"s{i % 5 if i % 2 else 1}") for i in range(200)] + [(None, "x", None, "s1"), (7, "again", None, "s2")]
    frame = docs(rows)
    want = sorted(map(tuple, mixture(frame, epochs=2.0).collect()), key=repr)
    monkeypatch.setattr(mixing, "SOURCES", 2)
    out = mixture(frame, epochs=2.0)
    assert sorted(map(tuple, out.collect()), key=repr) == want
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString() or want


def test_mixture_moves_texts_once(spark, docs):
    frame = docs([(i, "text", None, f"s{i % 2}") for i in range(20)])
    out = replicate(frame, rates(frame))
    plan = out._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert plan.count("Exchange hashpartitioning") == 1  # the global shuffle


def test_toxicity_with_clashing_columns(docs, spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["fine", "good", "day", "vile", "scum"][(0 if i % 2 else 2) :]) for _ in range(20))) for i in range(80)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(80)], "doc_id long, toxic int")
    want = sorted(map(tuple, toxicity.toxicity(docs(rows), labels).collect()))
    odd = docs(rows).select("*", *[F.lit(9).alias(n) for n in ("toxic", "labelled_id", "score", "own", "name", "predicted")])
    assert sorted(map(tuple, toxicity.toxicity(odd, labels).collect())) == want
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns
    assert sum(r[2] for r in want) == 40


def test_toxicity_equals_a_plain_logistic_model(docs, spark):
    """Scores against features made word by word, weights read from the model by name."""
    rng = random.Random(5)
    words = ["fine", "gooder", "daylight", "vilest", "scummy", "mer", "straße", "Élan"]
    rows = [(i, " ".join(rng.choice(words[(0 if i % 2 else 3) :]) for _ in range(rng.randrange(30)))) for i in range(120)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(100)], "doc_id long, toxic int")
    model = toxicity.fit(docs(rows), labels)
    weight = dict(zip(model.names.tolist(), model.weights.tolist()))

    def plain(text):
        found = set()
        for word in text.split():
            for n in (None, *toxicity.BEGINNINGS):
                if n is None or len(word.encode()) > n:
                    part = word if n is None else word.encode()[:n]
                    kind = 0 if n is None else toxicity.BEGINNINGS.index(n) + 1
                    found.add(feature(part if isinstance(part, bytes) else part.encode(), kind))
        return 1 / (1 + math.exp(-(model.intercept + sum(weight.get(f, 0.0) for f in found))))

    def feature(part, kind):
        low = toxicity._lowered(np.frombuffer(part, np.uint8)).tolist()
        mask, base = (1 << 64) - 1, toxicity._BASE
        total = sum((b + 1) * pow(base, i, 1 << 64) for i, b in enumerate(low)) & mask
        return int(mix(np.array([(total + int(toxicity._KIND[kind])) & mask], np.uint64))[0])

    for r in toxicity.toxicity(docs(rows), labels).collect():
        assert r.score == pytest.approx(plain(rows[r.doc_id][1]), abs=1e-9)


@pytest.mark.parametrize("text", ['"\\ud800"', "NaN", '{"a": Infinity}', "[" * 100_000 + "]" * 100_000, "1e999", "", "{", '{"a": "\\udc00"}'])
def test_arguments_that_are_not_json(text):
    with pytest.raises(ValueError):
        parsed(text)


def test_calls_with_broken_arguments_end_as_rows(spark):
    bad = ['"\\ud800"', '{"q": NaN}', "[" * 100_000 + "]" * 100_000, None, '{"q": 1.0}', '{"q": true}', '{"q": null}']
    calls = spark.createDataFrame([("c", f"{i}", "t", a, [], "x") for i, a in enumerate(bad)], "conv_id string, call_id string, name string, arguments string, after array<string>, result string")
    results = spark.createDataFrame([("c", "0", "ok", "y")], "conv_id string, call_id string, content string, level string")
    schemas = {"t": {"type": "object", "properties": {"q": {"type": ["integer", "null"]}}}}
    got = {r.call_id: r for r in link_calls(calls, results, schemas).collect()}
    assert [got[str(i)].valid for i in range(7)] == [False, False, False, False, True, False, True]
    for r in got.values():
        json.loads(r.json, parse_constant=lambda c: pytest.fail(c))
    with pytest.raises(ValueError, match="pattern"):
        link_calls(calls, results, {"t": {"type": "string", "pattern": "x"}})


def test_schemas():
    assert errors_of(1.0, {"type": "integer"}) == [] and errors_of(1.5, {"type": "integer"}) and errors_of(True, {"type": "number"})
    assert errors_of(1, {"enum": [True, "1"]}) and not errors_of(1, {"enum": [1.0]}) and not errors_of([1], {"const": [1]})
    assert errors_of("ab", {"minLength": 3}) and errors_of([1, 2], {"maxItems": 1}) and not errors_of("abc", {"minLength": 3, "maxLength": 3})
    for broken in ({"$ref": "#"}, {"type": "text"}, {"properties": {"a": {"oneOf": []}}}, {"items": {"format": "x"}}, {"additionalProperties": {}}):
        with pytest.raises(ValueError):
            check_schema(broken)


def test_flat_files_of_16_bit_ids(spark, docs, tmp_path):
    with pytest.raises(Exception, match="16-bit"):
        token_files.write_flat(docs([(1, "a")]), str(tmp_path / "x"), near_dup.Workspace(spark, "t"), separator=70_000)
    assert token_files._qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert token_files._qualified(spark, f"file:{tmp_path}") == f"file://{tmp_path}"
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.m.link./t", f"file://{tmp_path}")
    with pytest.raises(ValueError, match="viewfs"):
        token_files._qualified(spark, "viewfs://m/t")


def plain_nearest(text, profiles, length):
    """Out-of-place distances, one sequence at a time."""
    text, counts = text.lower(), {}
    for word in "".join(c if c.isalpha() else " " for c in text).split():
        for n in (1, 2, 3):
            padded = word if n == 1 else f"\0{word}\0"
            for i in range(len(padded) - n + 1):
                seq = padded[i : i + n]
                if seq.strip("\0") and not (n == 3 and seq[1] == "\0"):
                    counts[seq] = counts.get(seq, 0) + 1
    return counts


def test_ranks_of_very_frequent_sequences_follow_their_counts():
    """Two sequences above a million occurrences keep their order."""
    names = [1, 2, 3]
    of = {"x": names, "y": names[::-1]}
    ranks = language.Ranks(of, 3)
    counts = np.array([1_500_000, 1_400_000, 1_300_000])
    for order, lang in ((counts, "x"), (counts[::-1], "y")):
        keys = np.array(names, np.uint64)
        original = language._counts
        try:
            language._counts = lambda texts, k=keys, n=order: iter([(0, 1, k, n)])
            langs, scores = ranks.nearest(["t"])
        finally:
            language._counts = original
        assert langs == [lang] and scores[0] == 1.0


def test_distance_equals_a_plain_one(docs):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 60))) for _ in range(20)]
    texts += ["aa ab", "ab aa", "A1b2", "é"]
    of = language.profiles(docs([(i, t, "xy"[i % 2]) for i, t in enumerate(texts[:10])]), 40)
    ranks = language.Ranks(of, 40)
    langs, scores = ranks.nearest(texts)
    for text, lang, score in zip(texts, langs, scores):
        keys, counts = language._counted(language._sequences([text.lower()]))
        plain = plain_nearest(text, of, 40)
        assert sorted(counts.tolist()) == sorted(plain.values())
        top = sorted(zip(counts.tolist(), (keys & np.uint64(0xFFFFFFFF)).tolist()), key=lambda p: (-p[0], p[1]))[:40]
        total = {g: sum(abs(seqs.index(s) - i) if s in seqs else 40 for i, (_, s) in enumerate(top)) for g, seqs in of.items()}
        best = min(sorted(total), key=total.get)
        other = max(total.values()) if len(set(total.values())) > 1 else total[best]
        assert lang == best and score == pytest.approx(1 - total[best] / other if other else 0.0)


def test_rows_without_id_do_not_meet_each_other(docs):
    rows = [(None, f"one two three four five six seven eight nine {'ten' if i % 2 else 'zehn'} {i % 5}") for i in range(200)] + [(5, "one two three four five six seven eight nine ten 1")]
    out = near_dup.near_duplicates(docs(rows), words=1, percent=80).collect()
    assert len(out) == 201
    assert {r.component_id for r in out} == {5} and sum(r.kept for r in out) == 1
