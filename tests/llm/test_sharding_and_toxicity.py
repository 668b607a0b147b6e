"""Operators 7 and 3."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from spanloom.llm import sharding, toxicity
from spanloom.llm.common import plain_word_list


def check_shards(rows, texts, shards=sharding.SHARDS):
    size = [0] * shards
    slots = [[] for _ in range(shards)]
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == sorted((d is None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    keys = Counter()  # rows of one doc_id and text cannot be told apart and stay together
    for r in rows:
        keys[r["doc_id"], r["text_crc32"]] += r["size"]
    mean, largest = sum(size) / shards, max(keys.values(), default=0)
    assert all(abs(s - mean) <= largest + 2 * sharding.TOLERANCE * mean + 2 for s in size)


def test_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check_shards(sharding.assign(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_a_third_of_all_rows_is_one_text(spark):
    texts = [(i, "same text again" if i % 3 == 0 else "é" * (i % 50)) for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    rows = sharding.assign(docs).collect()
    check_shards(rows, texts)
    assert len({r["shard"] for r in rows if r["doc_id"] % 3 == 0}) > 1


def test_any_long_is_an_id(spark):
    ids = [None, -1, -5, 0, 7, (1 << 63) - 1, -(1 << 63), 1 << 62, -(1 << 62), None] * 30
    texts = [(d, "one text that all the rows share") for d in ids]
    rows = sharding.assign(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    check_shards(rows, texts)
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order, key=lambda d: -(1 << 64) if d is None else d)


def test_odd_rows(odd_docs, no_docs):
    check_shards(sharding.assign(odd_docs).collect(), [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert sharding.assign(no_docs).count() == 0
    assert sharding.assign(odd_docs.where("doc_id = 3")).count() == 2


def test_label_model_finds_accuracies_and_correlation():
    rng = np.random.default_rng(6)
    y = rng.random(6000) < 0.2
    fire = lambda good, bad: np.where(y, rng.random(6000) < good, rng.random(6000) < bad).astype(float)
    a, b, c = fire(0.8, 0.05), fire(0.7, 0.1), fire(0.6, 0.05)
    twin = np.where(rng.random(6000) < 0.95, c, 1 - c)
    votes = np.column_stack([a, b, c, twin])
    model, q = toxicity.fit_label_model(votes, np.where(np.arange(6000) % 4 == 0, y, np.nan))
    assert model.accuracies(True)[:3] == pytest.approx([0.8, 0.7, 0.6], abs=0.06) and model.accuracies(False)[:3] == pytest.approx([0.05, 0.1, 0.05], abs=0.03)
    for toxic in (True, False):
        correlation = model.correlations(toxic)
        assert correlation[2, 3] > 0.5 > abs(correlation[0, 1])
    good, bad = np.array([0.8, 0.7, 0.6]), np.array([0.05, 0.1, 0.05])
    chance = lambda rate: np.prod(np.where(votes[:, :3] > 0, rate, 1 - rate), axis=1)
    best = 0.2 * chance(good) > 0.8 * chance(bad)  # the twin adds nothing to its original
    assert ((q > 0.5) == y).mean() > (best == y).mean() - 0.01


def plain_counts(text, induced):
    """Votes of a text from their definition, one after another."""
    words = plain_word_list(text)
    out = [sum(w in entries.split() for w in words) for entries in toxicity.LEXICONS.values()]
    for entries in toxicity.PHRASES.values():
        out.append(sum(words[i : i + len(e.split())] == e.split() for e in entries for i in range(len(words))))
    for stem, length, times in induced:
        out.append(sum((w[:length] == stem and len(w) >= length) if length else w == stem for w in words) // times)
    out.append(len(re.findall("(?<=!)!", text)))
    upper, lower = len(re.findall("[A-Z]", text)), len(re.findall("[a-z]", text))
    return [*out, int(upper >= 20 and upper > lower)]


def test_votes_and_scores_equal_a_plain_version(spark):
    rng = random.Random(5)
    vocabulary = "You you IDIOT idiots shut up get LOST stupid kill plain wörds über Überall zorrible zorrow are pathetic rat! scum!! !!! a to go hell drop dead".split()
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40))) for _ in range(120)] + ["", "A" * 30, "SHUT UP " * 9, "é" * 5000]
    induced = [("zor", 3, 1), ("übe", 3, 2), ("plain", 0, 1), ("zorri", 5, 1)]
    hashes = lambda stem, length: next(h for _, h in toxicity.stems(pa.array([stem]), (length,)))[0]
    voters = toxicity.Voters([(length, int(hashes(stem, length)), times) for stem, length, times in induced])
    counts, sizes = voters.counts(pa.array(texts))
    wanted = [plain_counts(t, induced) for t in texts]
    assert counts.tolist() == wanted and sizes.tolist() == [len(plain_word_list(t)) for t in texts]
    weights = np.linspace(-1, 1, len(voters.names) + 2)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, voters, weights).collect()}
    for i, (own, n) in enumerate(zip(wanted, sizes, strict=True)):
        x = [min(math.log1p(c), 2) for c in own] + [min(20 * sum(own[:-2]) / max(n, 20), 2)]
        assert got[i] == pytest.approx(1 / (1 + math.exp(-sum(a * b for a, b in zip([*x, 1], weights, strict=True)))))


def test_repeated_labels_are_averaged_and_null_ids_ignored(spark):
    docs = spark.createDataFrame([(1, "one"), (1, "two"), (2, "three"), (None, "four"), (3, None), (4, "three")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 1), (3, 1), (4, 0), (2, None)], "doc_id bigint, toxic int")
    got = sorted((r["text"], r["toxic"]) for r in toxicity.labelled_sample(docs, labels).collect())
    assert got == [("one", 0.5), ("three", 0.5), ("two", 0.5)]


def test_held_out_quality(spark):
    import os

    path = "/root/testdata/sf0.1"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    out = toxicity.op3_toxicity(spark, path).where("held_out").join(spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "toxic"), "doc_id").toPandas()
    toxic = out[out.toxic == 1]
    assert out[out.predicted == 1].toxic.mean() > 0.9 and toxic.predicted.mean() > 0.75
    rank = out.score.rank()
    auc = (rank[out.toxic == 1].sum() - len(toxic) * (len(toxic) + 1) / 2) / (len(toxic) * (len(out) - len(toxic)))
    assert auc > 0.9


def test_odd_rows_and_no_labels(spark, odd_docs, no_docs):
    none = spark.createDataFrame([(None, None), (1, None)], "doc_id bigint, toxic int").selectExpr("*", "'x' as text")
    voters, weights, model = toxicity.learn(odd_docs, none)
    assert model is None
    rows = toxicity.score(odd_docs, voters, weights).collect()
    assert len(rows) == 9 and all(0 <= r["score"] < 0.5 for r in rows) and toxicity.score(no_docs, voters, weights).count() == 0
    rude = spark.createDataFrame([(1, "You IDIOT, you moron!!")], "doc_id bigint, text string")
    assert toxicity.score(rude, voters, weights).first()["score"] > 0.5


def test_patterns_are_induced_from_labels(spark):
    rows = [(i, f"plain words number {i} here" + (" zorrible zorrow zorring" if i % 4 == 0 else ""), i % 4 == 0) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(t)) for i, _, t in rows], "doc_id bigint, toxic int")
    voters, weights, model = toxicity.learn(docs, labels)
    assert voters.induced and model is not None
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame([(1, "a zorrid thing zorring here"), (2, "a plain thing")], "doc_id bigint, text string"), voters, weights).collect()}
    assert got[1] > 0.5 > got[2]
