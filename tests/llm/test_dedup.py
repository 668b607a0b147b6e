"""Operators 5, 8 and 9 against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from spanloom.llm import embedding_dedup, near_dedup, substring_dedup
from spanloom.llm.common import plain_word_list, plain_words


def brute_removed(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        left = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((len(w), sum(gone), hashlib.sha256(b" ".join(left)).hexdigest()))
    return out


def repeated_texts():
    rng = random.Random(9)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(60))
    passage, other = [word() for _ in range(70)], [word() for _ in range(36)]
    texts = ["", None, "one two", " ".join(["same"] * 90), " ".join(passage), " ".join(passage[:40]), " ".join(passage[:34]), "\x1f".join(other)]
    for _ in range(60):
        body = [word() for _ in range(rng.randrange(120))]
        cut = rng.randrange(len(body) + 1)
        piece = rng.choice([passage, passage[rng.randrange(30) :], other, []])
        texts.append(rng.choice([" ", "\n", "\t "]).join(body[:cut] + piece + body[cut:]))
    return texts + texts[10:14]


def test_repeats_equal_brute_force(spark):
    texts = repeated_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.remove_repeats(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute_removed(texts, substring_dedup.WINDOW)


def test_every_window_has_one_run():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 50, 4000).astype(np.uint64)
    first = np.array([0, 10, 10, 1000, 4000])
    _, path, after, whose, start, n = substring_dedup.bucket_runs(words, first)
    covered = sorted((d, s + k) for d, s, m in zip(whose, start, n, strict=True) for k in range(m))
    assert covered == [(d, s) for d in range(4) for s in range(first[d + 1] - first[d] - 34)]
    follows = (whose[1:] == whose[:-1]) & (start[1:] == (start + n)[:-1])
    assert (after[:-1] == np.where(follows, path[1:], 0)).all() and after[-1] == 0


def test_periodic_text_makes_few_runs():
    text = "left right " * 90_000  # 1 MB
    edge, *_ = substring_dedup.bucket_runs(*substring_dedup._words(pa.array([text])))
    assert len(edge) <= 2


def test_equal_and_periodic_rows_lose_every_window(spark):
    rng = random.Random(4)
    text = " ".join(str(rng.randrange(10**6)) for _ in range(400))
    docs = spark.createDataFrame([(7, text)] * 10_000 + [(8, "left right " * 90_000), (9, "alone " + text[: len(text) // 2])], "doc_id bigint, text string").repartition(16)
    got = substring_dedup.remove_repeats(docs).groupBy("doc_id", "n_words", "n_removed").count().collect()
    half = len(text[: len(text) // 2].split())
    whole = text[len(text) // 2] == " " or text[len(text) // 2 - 1] == " "
    assert sorted(map(tuple, got)) == [(7, 400, 400, 10_000), (8, 180_000, 180_000, 1), (9, half + 1, half if whole else half - 1, 1)]


def test_chains_end_at_branches_and_ends(spark):
    rows = [(1, 2, 3, 2, 2), (2, 2, 4, 3, 3), (3, 2, 5, 4, 4), (4, 3, 6, 9, 9), (9, 5, 1, 0, 0), (10, 2, 1, 9, 9), (11, 2, 1, 0, 12), (12, 2, 2, 0, 0)]
    paths = spark.createDataFrame(rows, "path bigint, times bigint, n int, lo bigint, hi bigint")
    got = sorted(tuple(r) for r in substring_dedup.chains(paths).select("path", "head", "ahead").collect())
    assert got == [(2, 1, 3), (3, 1, 7)]  # 4 has more places than 3, 9 more predecessors than one, 11 two successors


def test_hot_edges_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr("spanloom.llm.common.COLD_ROWS", 3)
    monkeypatch.setattr("spanloom.llm.common.HOT", 8)
    texts = repeated_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.remove_repeats(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute_removed(texts, substring_dedup.WINDOW)


def test_repeats_of_odd_rows(odd_docs, no_docs):
    rows = substring_dedup.remove_repeats(odd_docs, with_text=True).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 9 and by[1]["n_words"] == by[2]["n_words"] == 0 and by[6]["n_removed"] == 30_000 and by[6]["kept"] == "end"
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def brute_classes(ids, texts):
    words = [plain_word_list(t) for t in texts]
    df = Counter(w for ws in words for w in set(ws))
    n = sum(map(bool, words))
    idf = {w: 1 + math.log((n + 1) / (k + 1)) / math.log(n + 1) for w, k in df.items()}
    weights = []
    for ws in words:
        grams = Counter(tuple(ws[i : i + 5]) for i in range(max(len(ws) - 4, 1 if ws else 0)))
        weights.append({g: n * sum(idf[w] for w in g) / len(g) for g, n in grams.items()})
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            a, b = weights[i], weights[j]
            low = sum(min(a[g], b[g]) for g in a.keys() & b.keys())
            if low and low / (sum(a.values()) + sum(b.values()) - low) >= 0.8:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(lambda: 1 << 62)
    for i, d in enumerate(ids):
        least[find(i)] = min(least[find(i)], d)
    return [least[find(i)] for i in range(len(ids))]


def near_texts():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7)))
    base = [word() for _ in range(120)]
    texts = [" ".join(base)]
    for _ in range(60):  # edits of one text, near it and far from it
        own = list(base)
        for _ in range(rng.randrange(6)):
            own[rng.randrange(len(own))] = word()
        texts.append(" ".join(own))
    texts += [" ".join(word() for _ in range(rng.randrange(1, 80))) for _ in range(40)]
    return texts + [texts[5].upper(), texts[70], "a b", "a b", "A, b!"]


def test_classes_equal_brute_force(spark):
    texts = near_texts()
    ids = [3 * i + 1 for i in range(len(texts))]
    random.Random(3).shuffle(ids)
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert [got[i] for i in ids] == brute_classes(ids, texts)
    kept = near_dedup.one_of_each(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(got.values()))


def test_samples_agree_as_often_as_texts_are_similar():
    rng = random.Random(7)
    base = [str(rng.randrange(10**6)) for _ in range(400)]
    idf, agreed, alike = near_dedup.Idf(np.zeros(0, np.uint64), np.zeros(0), 1.0), [], []
    for _ in range(40):
        own = [w if rng.random() > 0.03 else "x" + str(rng.random()) for w in base]
        pair = pa.array([" ".join(base), " ".join(own)])
        doc, h, w, _, _ = near_dedup.features(pair, idf)
        _, samples = near_dedup.signatures(doc, h, w, 2)
        agreed.append((samples[0] == samples[1]).mean())
        alike.append(near_dedup.weighted_jaccard(pair[:1], pair[1:], idf)[0])
    assert np.mean(agreed) == pytest.approx(np.mean(alike), abs=0.05)


def test_frequent_words_have_their_own_idf(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "HEAVY", 2)
    docs = spark.createDataFrame([(i, "often " + "half " * (i % 2) + "third " * (i % 3 == 0) + f"own{i}") for i in range(12)], "doc_id bigint, text string")
    idf = near_dedup.inverse_frequencies(docs)
    value = lambda word: idf.of(plain_words(pa.array([word]))[0])[0]
    expected = {"often": 12, "half": 6, "third": 5, "own3": 5}  # rarer words weigh as one document less than the least
    assert {w: value(w) for w in expected} == {w: pytest.approx(1 + math.log(13 / (k + 1)) / math.log(13)) for w, k in expected.items()}


def test_near_copies_of_odd_rows(odd_docs, no_docs):
    rows = near_dedup.near_duplicates(odd_docs).collect()
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in rows}
    assert len(rows) == 9 and got[3] == (0, False) and got[0] == (0, True) and got[1] == (1, True) and got[2] == (2, True) and got[4] == (4, True)
    assert near_dedup.one_of_each(odd_docs).columns == odd_docs.columns
    assert near_dedup.near_duplicates(no_docs).count() == 0


def brute_links(rows):
    unit = {}
    for k, (_, v, label) in enumerate(rows):
        x = np.array([np.nan if c is None else c for c in v], np.float64) if v else np.zeros(0)
        if label is not None and len(x) and np.isfinite(x).all() and x.any():
            unit[k] = x
    parent, n = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in unit:
        for j in unit:
            if j < i and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] / np.sqrt((unit[i] @ unit[i]) * (unit[j] @ unit[j])) >= 0.98:
                n[i] += 1
                n[j] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(lambda: 1 << 62)
    for i, r in enumerate(rows):
        least[find(i)] = min(least[find(i)], r[0])
    return sorted((r[0], n[i], least[find(i)], r[0] == least[find(i)]) for i, r in enumerate(rows))


@pytest.mark.parametrize("block", [8, 512])
def test_links_equal_brute_force(spark, block):
    rng = np.random.default_rng(5)
    rows, centres = [], rng.normal(size=(6, 12))
    for i in range(240):
        v = centres[i % 6] + rng.normal(size=12) * rng.choice([0.02, 0.1, 0.3, 1.0])
        rows.append((1000 - i, v.astype(np.float32).tolist(), None if i % 40 == 7 else i % 3))
    rows += [(5, rows[0][1], rows[0][2]), (5, rows[0][1], rows[0][2]), (6, None, 1), (7, [0.0] * 12, 1), (8, [], 1), (9, [1.0, None] * 6, 1), (10, [float("nan")] * 12, 1), (11, [1.0, 0.0], 1), (12, [2.0, 0.0], 1), (13, [-0.0, 1.0], 0), (14, [0.0, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "'x' as class", "1 as size")
    got = sorted(tuple(r) for r in embedding_dedup.link_embeddings(df, block=block).select("vec_id", "n_links", "component_id", "kept").collect())
    assert got == brute_links(rows)


def test_no_vectors(spark):
    assert embedding_dedup.link_embeddings(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0
