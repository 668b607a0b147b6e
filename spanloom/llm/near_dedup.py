"""Near-duplicate documents by consistent weighted sampling (operator 8).

A document is its five-word shingles with TF-IDF weights: the count of the shingle times the mean, over its words,
of ``1 + ln((N + 1) / (df + 1)) / ln(N + 1)``. Document frequencies are those of the words in all documents; the HEAVY
most frequent words have their own, all rarer ones that of the rarest of these less one. Improved consistent weighted sampling (Ioffe, 2010) draws SAMPLES samples that
agree between two documents with the probability of their weighted Jaccard similarity; BANDS bands of them are
hashed. Documents of one word sequence are one class and are sampled as one.

Classes that share a band are verified by the exact weighted Jaccard similarity of their whole texts: first each
with the least of its bucket; then, where a bucket still holds several groups, with its plainest class, the one with
the least share of weight in shingles that no other such class has (the text that the others are edits of); and at
the end every pair of classes of a bucket that lie in different groups and may be similar at all. Two classes of
weights W whose shared shingles can weigh S at most reach the similarity t only if W + W' <= S (1 + t) / t. In each
of PARTS parts of the shingles' hashes they share no more than either has there beside its own unique shingles, and S
is the sum of that. The bound is a condition of the join, which also runs over classes of weight, and leaves out no
link. A group of n copies so costs about n verifications a band.

Defined cases: null texts and texts without words belong to no group; fewer than five words are one shingle;
repeated rows and equal word sequences are one class; a long text is one slice of array work; ties go to the least doc_id; an empty table gives no rows;
other columns are ignored; a null doc_id sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import POWERS, POWERS_2, U64, column, filled, hot_join, least_count, mix, pick, plain_words, range_hashes, segment_ids, signed, slices
from spanloom.operators.graph import connected_components
from spanloom.storage import discard, materialize

SHINGLE = 5
SIMILARITY = 0.8
#: Samples of a signature, and bands that they are cut into.
SAMPLES, BANDS = 32, 8
#: Words whose document frequency is held exactly, at most; words that a task counts before it sends some on.
HEAVY, COUNTED = 1 << 16, 1 << 20
#: Width of the classes of weight, as a ratio.
STEP = 1.02
#: Parts of the shingles' hashes for which shared weight is bounded.
PARTS = 32
_SIGNED = "doc_id bigint, c1 bigint, c2 bigint, bands array<bigint>, total double"
_NO_ID = -(1 << 63)


@dataclass
class Idf:
    """The IDF of the words that most documents have, by hash in order, and of all other words."""

    words: np.ndarray
    values: np.ndarray
    other: float

    def of(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(words), self.other)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.values[at], self.other)


def _added(words: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate(words), return_inverse=True)
    return keys, np.bincount(place, np.concatenate(counts), len(keys)).astype(np.int64)


def inverse_frequencies(docs: DataFrame) -> Idf:
    """IDF from the document frequencies of all words over all documents.

    The frequencies of at most HEAVY words come to the tasks; all rarer ones weigh as words of one document less than
    the least of these. Tasks add up before the exchange.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = lambda words, counts: pa.RecordBatch.from_arrays([pa.array(signed(words)), pa.array(counts)], ["word", "n"])
        held, counts, size, n = [np.zeros(0, U64)], [np.zeros(0, np.int64)], 0, 0
        for batch in batches:
            for part in slices(batch):
                words, first = plain_words(filled(part))
                doc = segment_ids(first)
                order = np.lexsort((words, doc))
                words, doc = words[order], doc[order]
                fresh = np.concatenate([[True], (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])])[: len(words)]
                own, times = np.unique(words[fresh], return_counts=True)
                held.append(own), counts.append(times)
                size, n = size + len(own), n + int((np.diff(first) > 0).sum())
                if size > COUNTED:
                    held, counts = ([x] for x in _added(held, counts))
                    size = 0
                    if len(held[0]) > COUNTED:
                        yield out(held[0], counts[0])
                        held, counts = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        yield out(*_added(held, counts))
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([n])], ["word", "n"])

    summed = pick(docs, "doc_id", "text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = materialize(summed.where("word is null or n > 1"), "word-documents")
    n = counts.where("word is null").agg(F.sum("n")).first()[0] or 0
    counted = counts.where("word is not null")
    least = max(least_count(counted, HEAVY), 2)
    heavy = counted.where(F.col("n") >= least).toArrow()  # at most HEAVY rows
    discard(counts)
    words, df = np.asarray(heavy["word"]).view(U64), np.asarray(heavy["n"])
    order = np.argsort(words)
    return Idf(words[order], idf_of(n, df[order]), float(idf_of(n, np.array([least - 1]))[0]))


def idf_of(n: int, df: np.ndarray) -> np.ndarray:
    return 1 + np.log((n + 1) / (np.minimum(df, n) + 1)) / np.log(max(n, 1) + 1)


def features(texts: pa.Array, idf: Idf, shingle: int = SHINGLE):
    """(document, shingle, weight) in order of document and shingle, and the two hashes of each word sequence."""
    words, first = plain_words(texts)
    sizes = np.diff(first)
    rare = idf.of(words)
    width = np.minimum(sizes, shingle)
    n = np.where(sizes > 0, sizes - width + 1, 0)
    doc = np.repeat(np.arange(len(sizes)), n)
    start = first[:-1][doc] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    hashes = range_hashes(words, start, start + width[doc])
    mean = np.zeros(len(start))
    for k in range(shingle):  # in this order for every document, so that equal shingles weigh exactly the same
        inside = k < width[doc]
        mean += np.where(inside, rare[np.minimum(start + k, max(len(rare) - 1, 0))], 0.0)
    mean /= np.maximum(width[doc], 1)
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(doc[order].astype(np.uint16), kind="stable")]
    doc, hashes, mean = doc[order], hashes[order], mean[order]
    fresh = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])])) if len(doc) else np.zeros(0, np.int64)
    times = np.diff(np.append(fresh, len(doc)))
    classes = tuple(signed(range_hashes(words, first[:-1], first[1:], p)) for p in (POWERS, POWERS_2))
    return doc[fresh], hashes[fresh], times * mean[fresh], classes, sizes


@lru_cache(maxsize=1)
def _gammas() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the gamma distribution of shape 2, and the logarithms of finer ones."""
    x = np.concatenate([np.geomspace(1e-6, 1, 200_000), np.linspace(1, 40, 400_000)[1:]])
    below = -np.expm1(-x) - x * np.exp(-x)
    at = lambda n: np.interp((np.arange(n) + 0.5) / n, below, x)
    return at(1 << 16), np.log(at(1 << 20))


def signatures(doc: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents with shingles, their samples)."""
    has = np.unique(doc)
    out = np.zeros((len(has), SAMPLES), U64)
    if not len(has):
        return has, out
    gamma, log_gamma = _gammas()
    starts = np.searchsorted(doc, has)
    sizes = np.diff(np.append(starts, len(doc)))
    log_w = np.log(weights)
    for k in range(SAMPLES):
        bits = mix(hashes + U64((k + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        r = gamma[(bits & U64(0xFFFF)).astype(np.int64)]
        beta = ((bits >> U64(36)).astype(np.float64)) * 2.0**-28
        t = np.floor(log_w / r + beta)
        log_a = log_gamma[((bits >> U64(16)) & U64(0xFFFFF)).astype(np.int64)] - r * (t - beta + 1)
        low = np.minimum.reduceat(log_a, starts)
        at = np.flatnonzero(log_a == np.repeat(low, sizes))
        chosen = at[np.searchsorted(at, starts)]  # the first of equals, in order of the shingles
        out[:, k] = mix(hashes[chosen] + t[chosen].astype(np.int64).view(U64))
    return has, out


def bands_of(samples: np.ndarray) -> np.ndarray:
    rows = SAMPLES // BANDS
    out = np.zeros((len(samples), BANDS), U64)
    for b in range(BANDS):
        key = np.full(len(samples), U64(b + 1))
        for k in range(b * rows, (b + 1) * rows):
            key = mix(key + samples[:, k])
        out[:, b] = key
    return out


def weighted_jaccard(left: pa.Array, right: pa.Array, idf: Idf) -> np.ndarray:
    """The exact weighted Jaccard similarity of each pair of texts."""
    (da, ha, wa, _, _), (db, hb, wb, _, _) = features(left, idf), features(right, idf)
    doc, h, w = np.concatenate([da, db]), np.concatenate([ha, hb]), np.concatenate([wa, wb])
    order = np.argsort(h, kind="stable")
    order = order[np.argsort(doc[order].astype(np.uint16), kind="stable")]
    doc, h, w = doc[order], h[order], w[order]
    same = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    low = np.bincount(doc[1:][same], np.minimum(w[1:], w[:-1])[same], len(left))
    return low / np.maximum(np.bincount(doc, w, len(left)) - low, 1e-300)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, kept): the least doc_id of each document's group, and whether it is the document's own."""
    spark = docs.sparkSession
    docs = pick(docs, "doc_id", "text")
    idf = spark.sparkContext.broadcast(inverse_frequencies(docs))  # at most HEAVY words

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                doc, hashes, weights, classes, sizes = features(filled(part), idf.value)
                has, samples = signatures(doc, hashes, weights, part.num_rows)
                bands = np.zeros((part.num_rows, BANDS), np.int64)
                bands[has] = signed(bands_of(samples))
                off = np.where(np.concatenate([[False], sizes > 0]), BANDS, 0).cumsum()
                lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(bands[has].ravel()))
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), *map(pa.array, classes), lists, pa.array(np.bincount(doc, weights, part.num_rows))], ["doc_id", "c1", "c2", "bands", "total"])

    signed_ = materialize(docs.mapInArrow(sign, _SIGNED), "signatures")
    name = F.concat_ws("-", F.hex("c1"), F.hex("c2")).alias("class")
    known = signed_.where(F.size("bands") > 0).select(name, F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"), "bands", "total")
    classes = known.groupBy("class").agg(F.min("doc").alias("doc"), F.any_value("bands").alias("bands"), F.any_value("total").alias("total"))
    members = materialize(classes.select("class", "doc", "total", F.explode("bands").alias("key")), "bands")
    shared = materialize(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared-keys")
    bands, members = members, materialize(hot_join(members, shared, ["key"], "n").drop("n"), "shared-bands")
    discard(bands)
    discard(shared)
    texts = _texts_of(docs, members.select("class", "doc").distinct(), idf)
    tested: DataFrame | None = None
    links: DataFrame | None = None
    groups = members.select("class").distinct().withColumn("group", F.col("class"))
    for choice in ("least", "plainest", "every"):
        own = members.select("key", "class", "total").join(groups, "class")
        if choice != "least":
            mixed = own.groupBy("key").agg((F.min("group") != F.max("group")).alias("mixed"), F.count("*").alias("n")).where("mixed").select("key", "n")
            own = materialize(hot_join(own, materialize(mixed, "mixed-keys"), ["key"], "n").drop("n"), "mixed-bands")
            if own.isEmpty():
                break
            rests = _shareable_weights(texts, own.select("class").distinct(), idf) if choice == "plainest" else rests
            own = own.join(rests, "class")
        pairs = _every_pair(own, similarity) if choice == "every" else _leader_pairs(own, choice)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs.distinct(), "pairs")
        if pairs.isEmpty():
            continue
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = materialize(_verified(pairs, texts, idf, similarity), "links")
        links = found if links is None else links.unionByName(found)
        linked = connected_components(links).withColumnRenamed("node", "class")
        groups = materialize(members.select("class").distinct().join(linked, "class", "left").select("class", F.coalesce("component", "class").alias("group")), "groups")
    discard(texts)
    # back from classes to documents
    of_class = classes.select("class", "doc").join(groups, "class", "left").select("class", "doc", F.coalesce("group", "class").alias("group"))
    least = of_class.groupBy("group").agg(F.min("doc").alias("least"))
    named = of_class.join(least, "group").select("class", "least")
    out = signed_.select("doc_id", F.when(F.size("bands") > 0, name).alias("class")).join(named, "class", "left")
    class_id = F.when(F.col("least") == _NO_ID, None).otherwise(F.coalesce("least", "doc_id"))
    return out.select("doc_id", class_id.alias("class_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def _leader_pairs(own: DataFrame, choice: str) -> DataFrame:
    """Pairs (a, b) of each class with its bucket's leader, where they are of different groups."""
    entry = F.struct("class", "group") if choice == "least" else F.struct((-F.col("rest") / F.col("total")).alias("share"), "class", "group")
    leaders = materialize(own.groupBy("key").agg(F.min(entry).alias("leader"), F.count("*").alias("n")), "leaders")
    pairs = hot_join(own, leaders, ["key"], "n").where(F.col("group") != F.col("leader.group"))
    return pairs.select(F.least("class", "leader.class").alias("a"), F.greatest("class", "leader.class").alias("b"))


def _every_pair(own: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of classes of one bucket and different groups that may reach the similarity."""
    slack, most = 1 + 1e-9, (1 + similarity) / similarity
    rows = own.withColumn("rest", F.col("rest") * slack).where(F.col("rest") >= similarity * F.col("total"))
    rows = rows.withColumn("share", -F.col("rest") / F.col("total"))
    width = float(np.log(STEP))
    top = F.least(F.col("total") / similarity, F.col("rest") * most - F.col("total"))
    steps = F.sequence(F.floor(F.log(F.col("total") * similarity / slack) / width), F.floor(F.log(top * slack) / width))
    # the one with the larger unique share asks: fewer weights can match it
    one = rows.where(top * slack >= F.col("total") * similarity).withColumn("weight", F.explode(steps)).select("key", "weight", F.col("class").alias("x"), F.col("group").alias("group_x"), F.col("total").alias("total_x"), F.col("rest").alias("rest_x"), F.col("parts").alias("parts_x"), F.col("share").alias("share_x"))
    two = rows.withColumn("weight", F.floor(F.log("total") / width))
    asks = (F.col("share_x") > F.col("share")) | ((F.col("share_x") == F.col("share")) & (F.col("x") > F.col("class")))
    both = F.col("total_x") + F.col("total")
    shared = F.aggregate(F.zip_with("parts_x", "parts", lambda x, y: F.least(x, y)), F.lit(0.0), lambda x, y: x + y) * slack
    fits = (both <= F.least("rest_x", "rest") * most) & (both <= shared * most)
    pairs = one.join(two, ["key", "weight"]).where((F.col("group_x") != F.col("group")) & asks & fits)
    return pairs.select(F.least("class", "x").alias("a"), F.greatest("class", "x").alias("b"))


def _shareable_weights(texts: DataFrame, wanted: DataFrame, idf) -> DataFrame:
    """(class, rest, parts): the weight of a class's shingles that another wanted class has too, whole and in parts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                doc, hashes, weights, _, _ = features(column(part, "text"), idf.value)
                yield pa.RecordBatch.from_arrays([pa.array(signed(hashes)), column(part, "class").take(pa.array(doc)), pa.array(weights)], ["shingle", "class", "weight"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                doc, hashes, weights, _, _ = features(column(part, "text"), idf.value)
                own = np.bincount(doc * PARTS + (hashes % U64(PARTS)).astype(np.int64), weights, part.num_rows * PARTS)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1) * PARTS, pa.int32()), pa.array(own))
                yield pa.RecordBatch.from_arrays([column(part, "class"), lists], ["class", "sums"])

    texts = texts.join(wanted, "class", "left_semi").select("class", "text")
    rows = texts.mapInArrow(each, "shingle bigint, class string, weight double")
    alone = rows.groupBy("shingle").agg(F.count("*").alias("n"), F.min("class").alias("class"), F.sum("weight").alias("weight")).where("n = 1")
    # the low bits of a negative long are those of the same unsigned number
    alone = alone.groupBy("class", F.col("shingle").bitwiseAND(PARTS - 1).alias("part")).agg(F.sum("weight").alias("weight"))
    alone = alone.groupBy("class").agg(F.map_from_entries(F.collect_list(F.struct("part", "weight"))).alias("alone"))
    both = texts.mapInArrow(sums, "class string, sums array<double>").join(alone, "class", "left")
    none = F.create_map().cast("map<bigint,double>")
    parts = F.transform("sums", lambda w, i: F.greatest(F.lit(0.0), w - F.coalesce(F.try_element_at(F.coalesce("alone", none), i.cast("bigint")), F.lit(0.0))))
    out = both.select("class", parts.alias("parts")).withColumn("rest", F.aggregate("parts", F.lit(0.0), lambda x, y: x + y))
    return materialize(out, "shareable-weights")


def _texts_of(docs: DataFrame, wanted: DataFrame, idf) -> DataFrame:
    """(class, text) of each wanted class: the text of its document whose word sequence is the class's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words, first = plain_words(filled(part))
                c1, c2 = (range_hashes(words, first[:-1], first[1:], p) for p in (POWERS, POWERS_2))
                own = [f"{a:X}-{b:X}" for a, b in zip(c1.tolist(), c2.tolist(), strict=True)]
                keep = pa.array([a == b for a, b in zip(own, column(part, "class").to_pylist(), strict=True)], pa.bool_())
                yield part.select(["class", "text"]).filter(keep)

    found = docs.withColumn("doc", F.coalesce("doc_id", F.lit(_NO_ID))).join(wanted, "doc").select("class", "text").mapInArrow(run, "class string, text string")
    return materialize(found, "class-texts")


def _verified(pairs: DataFrame, texts: DataFrame, idf, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_b"):
                alike = weighted_jaccard(column(part, "text_a"), column(part, "text_b"), idf.value) >= similarity - 1e-12
                yield part.select(["a", "b"]).filter(pa.array(alike))

    left = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a string, b string").distinct()


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each group, the one of the least doc_id, and all documents without words; columns stay.

    Rows of one doc_id and one text are one document. Rows that share a doc_id but not a text stay or go together.
    """
    decided = materialize(near_duplicates(docs, similarity), "near-duplicates")
    kept = decided.where("kept").select(F.col("doc_id").alias("__kept"))
    ids = docs["doc_id"].cast("bigint")
    out = docs.join(kept, ids.eqNullSafe(kept["__kept"]), "left_semi")
    n, ids_n = decided.agg(F.count("*"), F.countDistinct(F.coalesce("doc_id", F.lit(_NO_ID)))).first()
    return out.dropDuplicates(["doc_id", "text"]) if n > ids_n else out


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
