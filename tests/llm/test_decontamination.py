"""Operator 6: exact edit distance, recall of the embedding, and odd rows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from spanloom.llm import decontamination as D
from spanloom.llm.common import plain_words


def brute_distance(item, words):
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(words, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def test_edit_distance_equals_brute_force():
    rng = random.Random(8)
    for _ in range(300):
        item, words = ([rng.randrange(4) for _ in range(rng.randrange(lo, 12))] for lo in (1, 0))
        assert D.edit_distance(item, words)[0] == brute_distance(item, words)


def test_seeds_survive_the_edits():
    for n in range(1, 200):
        d = D.edits_allowed(n)
        assert D.seed_length(n, d) * (d + 1) >= n - d


def edited(item, edits, rng):
    own = item.tolist()
    for _ in range(edits):
        j, kind = rng.randrange(len(own)), rng.randrange(3)
        own[j : j + (kind != 1)] = [] if kind == 2 else [rng.getrandbits(63)]
    return own


@pytest.mark.parametrize(("size", "most_passed"), [(5, 1), (12, 0.85), (20, 0.35), (35, 0.05), (60, 0.02), (120, 0.02), (350, 0.02)])
def test_recall_and_selectivity(size, most_passed):
    """Items edited as often as allowed are found; of windows that share one run with an item few meet it."""
    rng = random.Random(size)
    fresh = lambda n: [rng.getrandbits(63) for _ in range(n)]
    items = [np.array(fresh(size), np.uint64) for _ in range(100)]
    block = D.Items(list(range(100)), items)
    q, hits, windows, met = D.seed_length(size, int(block.edits[0])), 0, 0, 0
    for k, item in enumerate(items):
        doc = np.array(fresh(20) + edited(item, int(block.edits[k]), rng) + fresh(20), np.uint64)
        hits += any(m[1] == k for m in block.verify(block.windows(doc, np.array([0, len(doc)]))))
        at = rng.randrange(size - q + 1)
        doc = np.array(fresh(size) + item[at : at + q].tolist() + fresh(size), np.uint64)
        found = block.windows(doc, np.array([0, len(doc)]))
        windows += len(found.doc)
        met += len(block.meetings(found)[0])
    assert hits >= 96 and windows >= 100 and met <= most_passed * windows


def test_results_equal_brute_force(spark, sf):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"]): r["edit_distance"] for r in D.find_contamination(docs, bench).collect()}
    items = {r["item_id"]: plain_words(pa.array([r["text"]]))[0].tolist() for r in bench.collect()}
    for r in docs.collect():
        words = plain_words(pa.array([r["text"]]))[0].tolist()
        held = set(words)
        for k, item in items.items():
            if len(held & set(item)) < len(item) - D.edits_allowed(len(item)) - (len(item) - len(set(item))):
                continue  # too few words in common for any alignment
            distance = D.edit_distance(item, words)[0]
            if distance <= D.edits_allowed(len(item)):
                assert got.pop((r["doc_id"], k)) == distance
    assert not got


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "the cat sat on the mat with a dog"), (2, None), (3, "..."), (1, "the cat sat on the mat with a dog"), (4, "w")], "item_id int, text string").selectExpr("*", "1 as doc_id")
    got = sorted((r["doc_id"], r["item_id"], r["edit_distance"]) for r in D.find_contamination(odd_docs, bench).collect())
    assert got == sorted([(d, 1, 1) for d in (0, 3, 3) for _ in range(2)] + [(6, 4, 0)])
    kept = D.without_contaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == 5
    assert D.find_contamination(no_docs, bench).count() == 0 and D.find_contamination(odd_docs, bench.limit(0)).count() == 0
    assert D.without_contaminated(odd_docs, bench.limit(0)).count() == 9


def test_blocks_are_bounded(spark):
    bench = spark.createDataFrame([(i, f"alpha{i} beta gamma delta") for i in range(10)], "item_id int, text string")
    assert [len(ids) for ids, _ in D.blocks(bench, 9)] == [2] * 5
