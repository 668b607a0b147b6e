"""Benchmark decontamination by CGK embedding and bit-sampling LSH (operator 6).

An item matches a document if some stretch of the document's words is within an edit distance of
``floor((1 - similarity) * n)`` of the item's n words.

1. Item-sized windows. Edits that few leave a run of at least ``ceil((n - d) / (d + 1))`` item words intact
   (pigeonhole), so windows that no such run aligns with an item of their size need no embedding; this loses nothing.
2. Embedding. Each window walks the CGK way (Chakraborty, Goldenberg and Koucky, 2016): 2 n steps copy the word under
   a pointer, and a random bit of the word and the step moves the pointer on, so that a small edit distance becomes a
   small Hamming distance. Steps after a walk's end agree with nothing.
3. Bit-sampling LSH. WALKS independent walks, each with TABLES samples of a few steps, give a window its keys; the
   keys of all items lie in one sorted table of buckets, and a window meets the items of the buckets that it hits.
4. Each meeting is verified by the exact edit distance (bit-parallel, over the window and d words at either side).

Samples are chosen for recall: of pairs at the largest allowed distance at least 0.99 meet, while few windows that
share only one run with an item do (README).

Benchmark items are a query set: they are taken in blocks of at most BLOCK_WORDS words, and every block is held
against all rows.

Defined cases: null and empty texts match nothing; items without words match nothing; repeated documents and
items each give their rows; ties of the distance go to the first stretch; an empty table on either side gives no
rows; other columns are ignored; texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import U64, column, filled, free_name, mix, pick, plain_words, range_hashes, slices, with_column_of

SIMILARITY = 0.8
#: Walks, and tables of each walk.
WALKS, TABLES = 8, 32
#: Sampled steps of each table: for items below LONG_ITEM words, and from there on, where walks agree less.
SAMPLED, SAMPLED_LONG, LONG_ITEM = 4, 3, 250
#: Words of the items in one block, which is what a task holds of the benchmark.
BLOCK_WORDS = 500_000
#: Windows that are embedded together at most, and steps of them all.
WINDOWS, STEPS = 4096, 1 << 21
SCHEMA = "doc_id bigint, item_id bigint, n_words int, start_word bigint, edit_distance int"
_BITS = 22
#: What a walk copies after its end, in items and in windows.
_ITEM_BLANK, _WINDOW_BLANK = U64(1), U64(2)


def edits_allowed(n: int, similarity: float = SIMILARITY) -> int:
    return math.floor((1 - similarity) * n + 1e-9)


def seed_length(n: int, d: int) -> int:
    """The least length of the longest intact run among n words after d edits."""
    return max(1, -(-(n - d) // (d + 1)))


def edit_distance(item: list[int], words: list[int]) -> tuple[int, int]:
    """(least edit distance of the item to a stretch of the words, where the first such stretch ends)."""
    n, places = len(item), {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | (1 << i)
    full, high = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, best, end = full, 0, n, n, 0
    for at, w in enumerate(words):  # Myers 1999, free start and end in the words
        eq = places.get(w, 0)
        x = eq | minus
        diag = ((((x & plus) + plus) ^ plus) | x) & full
        up, down = (minus | ~(diag | plus)) & full, plus & diag
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = (down | ~(diag | up)) & full, up & diag
        if score < best:
            best, end = score, at + 1
    return best, end


class Buckets:
    """Sorted 64-bit keys with a value each; a bit filter answers most lookups that find nothing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], values[order]
        self.filter = np.zeros(1 << _BITS, bool)
        self.filter[(keys >> U64(64 - _BITS)).astype(np.int64)] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the key, value) of every hit."""
        at = np.flatnonzero(self.filter[(keys >> U64(64 - _BITS)).astype(np.int64)])
        low, high = np.searchsorted(self.keys, keys[at], "left"), np.searchsorted(self.keys, keys[at], "right")
        n = high - low
        return np.repeat(at, n), self.values[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]


class Items:
    """A block of benchmark items: runs of their words that align windows, and buckets of their embeddings' keys."""

    def __init__(self, ids: list[int], words: list[np.ndarray], similarity: float = SIMILARITY, seed: int = 6):
        self.ids, self.words = ids, words
        self.size = np.array([len(w) for w in words], np.int64)
        self.edits = np.array([edits_allowed(int(n), similarity) for n in self.size], np.int64)
        self.similarity, self.seed = similarity, seed
        by_length: dict[int, list[int]] = {}
        for k, (n, d) in enumerate(zip(self.size.tolist(), self.edits.tolist(), strict=True)):
            by_length.setdefault(seed_length(n, d), []).append(k)
        self.runs = []
        for q, members in sorted(by_length.items()):
            flat = np.concatenate([words[k] for k in members])
            first = np.concatenate([[0], np.cumsum(self.size[members])])
            at = np.concatenate([np.arange(n - q + 1) for n in self.size[members]])
            whose = np.repeat(np.arange(len(members)), self.size[members] - q + 1)
            starts = first[whose] + at
            self.runs.append((q, Buckets(range_hashes(flat, starts, starts + q), np.stack([self.size[members][whose], at], axis=1))))
        flat, first = np.concatenate(words), np.concatenate([[0], np.cumsum(self.size)])
        rows, keys = (np.concatenate(x) for x in zip(*embed_keys(flat, first[:-1], self.size, seed, first[1:], _ITEM_BLANK), strict=True))
        self.buckets = Buckets(keys.ravel(), np.repeat(rows, keys.shape[1]))

    def windows(self, words: np.ndarray, first: np.ndarray) -> "Windows":
        """The item-sized windows that a common run aligns with an item of that size, with d words at either side."""
        found = [np.zeros((3, 0), np.int64)]
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for q, runs in self.runs:
            if len(words) < q:
                continue
            starts = np.arange(len(words) - q + 1)
            starts = starts[doc[starts] == doc[starts + q - 1]]
            hit, aligned = runs.find(range_hashes(words, starts, starts + q))
            begin = starts[hit]
            found.append(np.stack([aligned[:, 0], doc[begin], begin - first[doc[begin]] - aligned[:, 1]]))
        size, doc, start = np.unique(np.concatenate(found, axis=1), axis=1)
        sizes, back = np.unique(size, return_inverse=True)
        most = np.array([edits_allowed(int(n), self.similarity) for n in sizes], np.int64)[back]
        low = np.maximum(start - most, 0)
        n = np.minimum(start + size + most, np.diff(first)[doc]) - low
        flat = words[np.repeat(first[doc] + low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        return Windows(doc, size, start, low, n, flat)

    def meetings(self, found: "Windows") -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of the pairs that share a bucket."""
        edge = np.cumsum(found.n)
        begin = edge - found.n + np.maximum(found.start, 0) - found.low
        end = np.minimum(begin + found.size, edge)
        pairs = [np.zeros((2, 0), np.int64)]
        for rows, keys in embed_keys(found.words, begin, found.size, self.seed, end, _WINDOW_BLANK):
            hit, item = self.buckets.find(keys.ravel())
            pairs.append(np.unique(np.stack([rows[hit // keys.shape[1]], item]), axis=1))
        return tuple(np.concatenate(pairs, axis=1))

    def verify(self, found: "Windows") -> list[tuple[int, int, int, int]]:
        """(document, item, first word of the stretch, distance), one row for each document and item that match."""
        edge = np.cumsum(found.n)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for i, k in zip(*(x.tolist() for x in self.meetings(found)), strict=True):
            d, low = int(found.doc[i]), int(found.low[i])
            own = self.words[k].tolist()
            piece = found.words[edge[i] - found.n[i] : edge[i]].tolist()
            distance, stop = edit_distance(own, piece)
            if distance <= self.edits[k]:
                _, length = edit_distance(own[::-1], piece[:stop][::-1])  # the shortest stretch that ends there
                row = (distance, low + stop - length)
                if (d, k) not in best or row < best[d, k]:
                    best[d, k] = row
        return [(d, k, at, distance) for (d, k), (distance, at) in sorted(best.items())]


@dataclass
class Windows:
    """Windows to look at, by size: document, size, start, start and size of the words around it, all those words."""

    doc: np.ndarray
    size: np.ndarray
    start: np.ndarray
    low: np.ndarray
    n: np.ndarray
    words: np.ndarray

    @staticmethod
    def together(parts: list["Windows"], rows_before: list[int]) -> "Windows":
        cat = lambda name: np.concatenate([getattr(p, name) for p in parts])
        doc = np.concatenate([p.doc + n for p, n in zip(parts, rows_before, strict=True)])
        return Windows(doc, *map(cat, ("size", "start", "low", "n", "words")))


@lru_cache(maxsize=4096)
def _samples(n: int, seed: int) -> np.ndarray:
    """The steps that each table of each walk samples from the 2 n of an embedding; short lists repeat their last."""
    taken = SAMPLED if n < LONG_ITEM else SAMPLED_LONG
    drawn = np.random.default_rng([seed, n]).integers(0, 2 * n, (WALKS, TABLES, taken), dtype=np.int32)
    return np.concatenate([drawn, np.repeat(drawn[:, :, -1:], max(SAMPLED, SAMPLED_LONG) - taken, axis=2)], axis=2)


def embed_keys(words: np.ndarray, begin: np.ndarray, size: np.ndarray, seed: int, end: np.ndarray, blank: np.uint64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(windows, a key for each of them and each table), window by size. A walk reads from ``begin`` to ``end``."""
    order, at = np.argsort(size, kind="stable"), 0
    while at < len(order):
        # windows of about one size together, so that all walk about as many steps
        most = 2 * int(size[order[min(at + WINDOWS, len(order)) - 1]])
        rows = order[at : at + max(1, min(WINDOWS, STEPS // most))]
        at += len(rows)
        steps = 2 * int(size[rows[-1]])
        samples = np.stack([_samples(int(n), seed) for n in size[rows]])
        here, stop = np.arange(len(rows))[:, None], np.minimum(end[rows], begin[rows] + size[rows])
        out = np.zeros((len(rows), WALKS, TABLES), U64)
        for walk in range(WALKS):
            pointer, copied = begin[rows].copy(), np.empty((steps, len(rows)), U64)
            for step in range(steps):
                live = pointer < stop
                w = np.where(live, words[np.minimum(pointer, len(words) - 1)], blank)
                copied[step] = w
                pointer += live & ((mix(w + U64((walk << 32) + step + 1)) & U64(1)) == 1)
            key = mix(size[rows].astype(U64)[:, None] * U64(WALKS * TABLES) + (walk * TABLES + np.arange(TABLES)).astype(U64))
            for place in range(samples.shape[3]):
                key = mix(key + copied[samples[:, walk, :, place], here])
            out[:, walk] = key
        yield rows, out.reshape(len(rows), -1)


def blocks(benchmark: DataFrame, most: int = BLOCK_WORDS) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """The items with words, in blocks of bounded size; one partition at a time comes to the driver."""
    ids, words, held = [], [], 0
    for row in pick(benchmark, "item_id", "text", types={"item_id": "bigint"}).where("text is not null").toLocalIterator():
        own, _ = plain_words(pa.array([row["text"]]))
        if not len(own):
            continue
        if held + len(own) > most and ids:
            yield ids, words
            ids, words, held = [], [], 0
        ids.append(row["item_id"])
        words.append(own)
        held += len(own)
    if ids:
        yield ids, words


def find_contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, n_words, start_word, edit_distance) of every item found in a document."""
    spark, out = docs.sparkSession, None
    for ids, words in blocks(benchmark):
        held = spark.sparkContext.broadcast((ids, words))  # at most BLOCK_WORDS words

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            items = Items(*held.value, similarity)
            for batch in batches:
                parts, before, n, held_windows = [], [], 0, 0
                for part in slices(batch):
                    parts.append(items.windows(*plain_words(filled(part))))
                    before.append(n)
                    n, held_windows = n + part.num_rows, held_windows + len(parts[-1].doc)
                    if held_windows >= WINDOWS:
                        yield matches(batch, items, Windows.together(parts, before))
                        parts, before, held_windows = [], [], 0
                if parts:
                    yield matches(batch, items, Windows.together(parts, before))

        def matches(batch: pa.RecordBatch, items: Items, windows: Windows) -> pa.RecordBatch:
            found = items.verify(windows)
            doc = column(batch, "doc_id").take(pa.array([d for d, *_ in found], pa.int64()))
            rows = [[items.ids[k] for _, k, _, _ in found], [int(items.size[k]) for _, k, _, _ in found], [s for *_, s, _ in found], [e for *_, e in found]]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32()]
            return pa.RecordBatch.from_arrays([doc, *[pa.array(x, t) for x, t in zip(rows, kinds, strict=True)]], [c.split()[0] for c in SCHEMA.split(", ")])

        found = pick(docs, "doc_id", "text").mapInArrow(run, SCHEMA)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], SCHEMA) if out is None else out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents in which no item is found; all columns stay as they are."""
    name = free_name(docs, "contaminated")

    def make(part: pa.RecordBatch, items: Items) -> pa.Array:
        out = np.zeros(part.num_rows, bool)
        out[[d for d, *_ in items.verify(items.windows(*plain_words(filled(part))))]] = True
        return pa.array(out)

    for ids, words in blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast((ids, words))  # at most BLOCK_WORDS words
        docs = with_column_of(docs, name, "boolean", make, lambda held=held: Items(*held.value, similarity)).where(~F.col(name)).drop(name)
    return docs


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
