"""Toxicity by weak supervision (operator 3).

Voters look at whole texts: fixed lexicons and phrases, patterns of punctuation and capitals, and induced patterns:
words, or beginnings of words, that occur so many times, found in labelled documents by greedy coverage. A voter
fires or abstains.

A generative label model explains the votes by a latent class, toxic or clean, and within a class by components.
Voters fire independently at each component's rates, so that components that fire together, or one instead of the
other, carry the voters' correlations within a class; the class's rates are the voters' accuracies. The model is
fitted by expectation maximisation. Labels are no votes: those of one document in ORIENT give the first components
of either class, which stay in as a prior of twice as many rows.
A logistic regression on the voters' counts is then trained on the posterior labels, and scores every text.

The label model and the classifier are fitted on at most SAMPLE labelled documents, taken by a hash of their ids.

Defined cases: null and empty texts score by the classifier's intercept; repeated labels of one doc_id are averaged;
equal labelled texts are one example; without labels of both classes the score rests on the fixed voters with
FALLBACK weights; repeated rows each give a row; a long text is one slice of array work and its voters count all of
it; an empty table gives no rows; a null doc_id is not learned from and not held out; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import BYTE_VALUES, PLAIN, U64, column, filled, offsets_of, pick, plain_words, range_hashes, signed, slices, word_spans
from spanloom.llm.language_id import remainder
from spanloom.storage import materialize

#: Labelled documents that the models are fitted on, about.
SAMPLE = 20_000
#: Patterns that may become voters, and those that do, at most.
CANDIDATES, INDUCED = 2_000, 64
#: Labelled toxic documents that an induced pattern must add.
SUPPORT = 5
#: Patterns that cover a labelled document before it asks for no more.
COVER = 3
#: Lengths in characters of the beginnings of words that are tried (0: the whole word), and how often one must occur.
STEMS, LEVELS = (0, 3, 4, 5, 6, 7), (1, 2, 3)
#: Sampled documents in which a voter must fire to be kept.
FIRES = 3
#: One labelled document in ORIENT gives its label to the label model's prior, which weighs PRIOR times all rows.
ORIENT, PRIOR = 4, 2
#: Components of a class at most, rows of the class's mean that smooth each, and steps of expectation maximisation.
COMPONENTS, SMOOTH, STEPS = 6, 3, 50
#: Weights without any labels: intercept, and each fired voter.
FALLBACK = (-3.0, 4.0)

# Lexicons and phrases, lower case.
LEXICONS = {
    "insult": "idiot idiots moron morons imbecile stupid dumb dumbass fool loser losers clown clowns trash garbage scum vermin",
    "contempt": "pathetic worthless disgusting disgrace despicable filthy filth ugly vile repulsive useless",
    "abuse": "bastard bitch asshole jerk freak pig rat slut whore",
    "violence": "kill murder strangle exterminate lynch",
}
PHRASES = {"dismissal": ["shut up", "get lost", "go to hell", "drop dead", "screw you"], "address": ["you idiot", "you moron", "you are stupid", "you are pathetic", "you are worthless"]}
PATTERNS = ("exclaiming", "shouting")
SCHEMA = "doc_id bigint, score double"


def _hash(words: list[str]) -> int:
    hashes, _ = plain_words(pa.array([" ".join(words)]))
    return int(range_hashes(hashes, np.array([0]), np.array([len(hashes)]))[0])


def stems(texts: pa.Array, lengths: tuple[int, ...] = STEMS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length (document, hash) of every word's beginning; shorter words have none."""
    raw, off = offsets_of(pc.utf8_lower(texts))
    start, stop, first = word_spans(raw, off, PLAIN)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    chars = np.flatnonzero((raw & 0xC0) != 0x80)
    at = np.searchsorted(chars, start)
    chars = np.append(chars, np.full(max(lengths, default=0) + 1, len(raw)))
    values = BYTE_VALUES[raw]
    for k in lengths:
        end = chars[at + k] if k else stop
        long = end <= stop
        yield doc[long], range_hashes(values, start[long], end[long]) + U64(k)


class Voters:
    """The voters as tables of hashes: fixed lexicons and phrases, induced patterns, and two patterns of bytes.

    induced: (length of the beginning, its hash, times it must occur) of each pattern.
    """

    def __init__(self, induced: list[tuple[int, int, int]]):
        self.induced = induced
        groups = {name: words.split() for name, words in LEXICONS.items()} | PHRASES
        self.names = [*groups, *(f"stem {k} {h:x} x{n}" for k, h, n in induced), *PATTERNS]
        rows = sorted((len(e.split()), _hash(e.split()), k) for k, entries in enumerate(groups.values()) for e in entries)
        self.runs = {n: Table([(h, k) for m, h, k in rows if m == n]) for n in {r[0] for r in rows}}
        self.stems = {k: Table(sorted((h, len(groups) + i) for i, (m, h, _) in enumerate(induced) if m == k)) for k in sorted({k for k, _, _ in induced})}
        self.times = np.array([1] * len(groups) + [n for _, _, n in induced] + [1] * len(PATTERNS))

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(times that each voter fires in each text, words of each text)."""
        words, first = plain_words(texts)
        sizes = np.diff(first)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        out = np.zeros((len(sizes), len(self.names)))
        for n, table in self.runs.items():
            start = np.arange(max(0, len(words) - n + 1))
            start = start[doc[start] == doc[start + n - 1]] if n > 1 else start
            at, voter = table.find(range_hashes(words, start, start + n))
            np.add.at(out, (doc[start[at]], voter), 1)
        for (whose, hashes), table in zip(stems(texts, tuple(self.stems)), self.stems.values(), strict=True):
            at, voter = table.find(hashes)
            np.add.at(out, (whose[at], voter), 1)
        raw, off = offsets_of(texts)
        total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[off])
        exclaims = raw == 0x21
        exclaims[1:] &= raw[:-1] == 0x21
        exclaims[off[:-1][off[:-1] < len(raw)]] = False  # the mark before is another text's
        upper, lower = total((raw >= 0x41) & (raw <= 0x5A)), total((raw >= 0x61) & (raw <= 0x7A))
        out[:, -2] = total(exclaims)
        out[:, -1] = (upper >= 20) & (upper > lower)
        return out // self.times, sizes


class Table:
    """Which voters a hash belongs to; rows: (hash, voter) in order. A hash may belong to several voters."""

    def __init__(self, rows: list[tuple[int, int]]):
        self.keys, self.voter = np.array([h for h, _ in rows], U64), np.array([k for _, k in rows], np.int64)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.keys >> U64(48)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, voter) of each hash that some voter has."""
        near = np.flatnonzero(self.maybe[(hashes >> U64(48)).astype(np.int64)])
        low, high = (np.searchsorted(self.keys, hashes[near], side) for side in ("left", "right"))
        n = high - low
        return np.repeat(near, n), self.voter[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]


@dataclass
class LabelModel:
    """Components of each class: their shares of all rows and the rate at which each voter fires in them."""

    share: np.ndarray
    rate: np.ndarray
    toxic: np.ndarray

    def belongs(self, votes: np.ndarray) -> np.ndarray:
        """The probability of each component, row by row."""
        gain = votes @ np.log(self.rate).T + (1 - votes) @ np.log(1 - self.rate).T + np.log(self.share)
        odds = np.exp(gain - gain.max(axis=1, keepdims=True))
        return odds / odds.sum(axis=1, keepdims=True)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return self.belongs(votes)[:, self.toxic].sum(axis=1)

    def accuracies(self, toxic: bool) -> np.ndarray:
        """The rate at which each voter fires in a class."""
        own = self.toxic == toxic
        return self.share[own] @ self.rate[own] / self.share[own].sum()

    def correlations(self, toxic: bool) -> np.ndarray:
        """The correlations of the voters within a class."""
        own, mean = self.toxic == toxic, self.accuracies(toxic)
        rest = self.rate[own] - mean
        covariance = (rest * (self.share[own] / self.share[own].sum())[:, None]).T @ rest
        spread = np.sqrt(mean * (1 - mean))
        out = covariance / np.outer(spread, spread)
        np.fill_diagonal(out, 1)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _components(votes: np.ndarray, weight: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(weight, rates) of a class's first components, from rows that orient it: clusters of their votes by k-means.

    The first centre is the most frequent pattern; each further one lies farthest from those before it, weighed by how
    often it occurs.
    """
    patterns, which = np.unique(votes, axis=0, return_inverse=True)
    times = np.bincount(which, weight, len(patterns))
    centres = patterns[times.argmax()][None]
    distance = lambda: ((patterns[:, None] - centres[None]) ** 2).sum(axis=2)
    while len(centres) < min(most, len(patterns)):
        centres = np.vstack([centres, patterns[(distance().min(axis=1) * times).argmax()]])
    for _ in range(20):
        member = (distance().argmin(axis=1)[:, None] == np.arange(len(centres))) * times[:, None]
        size = member.sum(axis=0)
        centres = np.where(size[:, None] > 0, member.T @ patterns / np.maximum(size, 1e-9)[:, None], centres)
    mean = (times @ patterns + 0.01) / (times.sum() + 0.02)
    return size, (member.T @ patterns + SMOOTH * mean) / (size + SMOOTH)[:, None]


def fit_label_model(votes: np.ndarray, oriented: np.ndarray) -> tuple[LabelModel, np.ndarray]:
    """The label model and the posterior of each row.

    votes: rows by voters, 0 or 1; oriented: the labels, 0 to 1, of the rows that orient the classes, else nan.
    """
    known = ~np.isnan(oriented)
    sides = [_components(votes[known], w) for w in (oriented[known], 1 - oriented[known])]
    toxic = np.repeat([True, False], [len(n) for n, _ in sides])
    first_share = np.concatenate([n for n, _ in sides]) + 1e-3
    first_share /= first_share.sum()
    first_rate = np.clip(np.concatenate([r for _, r in sides]), 1e-4, 1 - 1e-4)
    model = LabelModel(first_share, first_rate, toxic)
    for _ in range(STEPS):
        own, prior = model.belongs(votes), PRIOR * len(votes) * first_share
        n = own.sum(axis=0) + prior
        model = LabelModel(n / n.sum(), np.clip((own.T @ votes + prior[:, None] * first_rate) / n[:, None], 1e-4, 1 - 1e-4), toxic)
    return model, model.posterior(votes)


def fit_classifier(x: np.ndarray, q: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression on soft labels, the intercept last; Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - q) + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def inputs(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What the classifier sees: each voter's count, damped, and the share of fired words."""
    return np.column_stack([np.minimum(np.log1p(counts), 2.0), np.minimum(20 * counts[:, :-2].sum(axis=1) / np.maximum(sizes, 20), 2.0)])


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic, orients) of about ``sample`` labelled documents, equal texts once; toxic is the mean label."""
    marks = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("double").alias("toxic")).where("doc_id is not null and toxic is not null")
    marks = marks.groupBy("doc_id").agg(F.avg("toxic").alias("toxic"))
    total = marks.count()
    if total > sample:
        marks = marks.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) < F.lit(int((1 << 20) * sample / total)))
    # about `sample` rows of 16 bytes
    found = pick(docs, "doc_id", "text").where("text is not null").join(F.broadcast(marks), "doc_id")
    return found.groupBy(F.md5("text").alias("key")).agg(F.any_value("text").alias("text"), F.avg("toxic").alias("toxic")).select("text", "toxic", (F.pmod(F.xxhash64("key"), F.lit(ORIENT)) == 0).alias("orients"))


def _induced(rows: DataFrame) -> list[tuple[int, int, int]]:
    """Patterns that mark toxic documents: those of high precision, taken while they add SUPPORT documents each."""

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                toxic = np.asarray(column(part, "toxic")) > 0.5
                for k, (doc, hashes) in zip(STEMS, stems(filled(part)), strict=True):
                    order = np.lexsort((hashes, doc))
                    doc, hashes = doc[order], hashes[order]
                    at = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])])) if len(doc) else np.zeros(0, np.int64)
                    times, doc, hashes = np.diff(np.append(at, len(doc))), doc[at], hashes[at]
                    for level in LEVELS:
                        enough = times >= level
                        keys, place = np.unique(hashes[enough], return_inverse=True)
                        own = toxic[doc[enough]]
                        p, n = (np.bincount(place, x, len(keys)).astype(np.int64) for x in (own, ~own))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), k, np.int32)), pa.array(signed(keys)), pa.array(np.full(len(keys), level, np.int32)), pa.array(p), pa.array(n)], ["stem", "hash", "level", "p", "n"])

    total, toxic = rows.agg(F.count("*"), F.count_if(F.col("toxic") > 0.5)).first()
    if not toxic or toxic == total:
        return []
    counted = rows.mapInArrow(seen, "stem int, hash bigint, level int, p bigint, n bigint").groupBy("stem", "hash", "level").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    lift = (F.col("p") + 0.5) / (toxic + 1) / ((F.col("n") + 0.5) / (total - toxic + 1))
    top = counted.where((F.col("p") >= SUPPORT) & (F.col("p") > F.col("n")) & (lift >= 5)).orderBy(F.desc(F.col("p") * F.log(lift)), "stem", "hash", "level").limit(CANDIDATES)
    names = [(r["stem"], r["hash"] & 0xFFFFFFFFFFFFFFFF, r["level"]) for r in top.select("stem", "hash", "level").collect()]
    names.sort(key=lambda x: (x[2], x[0] or max(STEMS) + 1))  # of equal gain the more general comes first
    if not names:
        return []
    voters = Voters(names)
    skip = len(LEXICONS) + len(PHRASES)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                counts, _ = voters.counts(filled(part))
                has = [np.flatnonzero(c[skip:-2]).tolist() for c in counts]
                yield pa.RecordBatch.from_arrays([pa.array(has, pa.list_(pa.int32())), column(part, "toxic")], ["has", "toxic"])

    table = rows.mapInArrow(held, "has array<int>, toxic double").where(F.size("has") > 0).toArrow()  # at most the sample
    held_rows = sorted(zip(table["has"].to_pylist(), table["toxic"].to_pylist(), strict=True))  # the same order every time
    sets, marks = [h for h, _ in held_rows], np.array([t > 0.5 for _, t in held_rows], bool)
    hits = np.zeros((len(sets), len(names)), bool)
    for i, own in enumerate(sets):
        hits[i, own] = True
    out, wanted, weight = [], np.full(len(sets), COVER), np.where(marks, 1, -2)
    while len(out) < INDUCED:
        gain = (weight * (wanted > 0)) @ hits
        best = int(gain.argmax())
        if gain[best] < SUPPORT:
            break
        out.append(names[best])
        wanted -= hits[:, best]
        hits[:, best] = False
    return out


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Voters, np.ndarray, LabelModel | None]:
    """Voters, classifier weights and the label model from labelled documents."""
    rows = materialize(labelled_sample(docs, labels, sample), "labelled")
    voters = Voters(_induced(rows))

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                counts, sizes = voters.counts(filled(part))
                yield pa.RecordBatch.from_arrays([pa.array(counts.tolist(), pa.list_(pa.float64())), pa.array(sizes), column(part, "toxic"), column(part, "orients")], ["counts", "size", "toxic", "orients"])

    table = rows.mapInArrow(votes, "counts array<double>, size bigint, toxic double, orients boolean").toArrow()  # at most the sample
    voted = sorted(zip(table["toxic"].to_pylist(), table["orients"].to_pylist(), table["size"].to_pylist(), table["counts"].to_pylist(), strict=True))  # the same order every time
    marks, orients = np.array([t for t, *_ in voted]), np.array([o for _, o, *_ in voted], bool)
    width = len(voters.names) + 1
    if not len(marks) or (marks > 0.5).all() or (marks <= 0.5).all():
        return voters, np.append(np.full(width, FALLBACK[1]), FALLBACK[0]), None
    for side in (marks > 0.5, marks <= 0.5):  # each class has at least one label that orients it
        orients[np.flatnonzero(side)[0]] |= not orients[side].any()
    counts, sizes = np.array([c for *_, c in voted]), np.array([n for _, _, n, _ in voted])
    fired = (counts > 0).astype(float)
    kept = fired.sum(axis=0) >= FIRES
    model, q = fit_label_model(fired[:, kept], np.where(orients, marks, np.nan))
    x = inputs(counts, sizes)
    used = np.append(kept, True)
    weights = np.zeros(width + 1)
    weights[np.append(used, True)] = fit_classifier(x[:, used], q)
    return voters, weights, model


def score(docs: DataFrame, voters: Voters, weights: np.ndarray) -> DataFrame:
    """(doc_id, score) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = inputs(*voters.counts(filled(part)))
                p = _sigmoid(x @ weights[:-1] + weights[-1])
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), pa.array(p)], ["doc_id", "score"])

    return pick(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    voters, weights, _ = learn(docs, labels.where(remainder("doc_id", 5) != 0))
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return score(docs, voters, weights).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
