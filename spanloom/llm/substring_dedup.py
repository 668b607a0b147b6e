"""Exact repeated-substring removal on a compacted de Bruijn graph of words (operator 5).

A window is WINDOW consecutive words of one document; a word goes if a window that covers it starts, word for
word, anywhere else too. Windows are the elementary edges of a de Bruijn graph whose nodes are the WINDOW - 1 words
that two windows share. Each window belongs to the bucket of its least-hashed token k-mer (KMER words), the same one
wherever the window stands. Consecutive windows of one bucket form a run, the unit that is exchanged: about a tenth
of all windows.

1. Buckets are counted. One that is met once holds windows that stand nowhere else; it goes.
2. Runs of the other buckets are counted. A run that repeats as a whole is a repeated path, one row from here on.
3. Repeated paths compact. A path's out-degree is the number of runs that follow it in the texts, its in-degree the
   number that precede it; the end of a text counts as one. Where a path has one successor and that one has one
   predecessor, the two join, and chains of joins are ranked by pointer doubling: (path, head of the chain, words
   from it). In the texts, the runs of a chain merge into one long span a place.
4. A bucket with several runs branches: one copy of each of its runs is expanded into windows.
5. Source coordinates verify spans and windows: the words between them are read again from the text and digested;
   only a digest that several places share counts. A text takes a verified span only if its own words at those
   coordinates have that digest.

Windows that repeat within their own text are found there, and only their first places enter the graph, so that
periodic texts make few runs. Texts that occur several times lose all windows by definition; a task sends the runs of
such a text once. Digests are pairs of 64-bit hashes with different bases.

Hot keys: counts are added up in each task before every exchange, and rows of a k-mer, run, window or text that holds
more than a thousandth of all rows are dealt over several tasks (``common.hot_join``).

Defined cases: null and empty texts have no words and keep the empty string's hash; documents shorter than WINDOW
lose nothing; rows equal in text, or in text and id, count as places of their own, so all their windows repeat; runs
of one word repeat within their own document; a long text is one slice of array work; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import POWERS_2, SPACED, U64, column, filled, hot_join, mix, offsets_of, pick, range_hashes, segment_ids, signed, slices, word_hashes, word_spans
from spanloom.storage import discard, materialize

WINDOW = 35
KMER = 17
#: Texts that a task remembers, to send equal ones once; what it forgets is merely sent again.
SEEN_TEXTS = 200_000
SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
RUNS = "edge bigint, path bigint, next bigint, doc bigint, start int, n int"
PIECES = "edge bigint, a bigint, b bigint, doc bigint, start int, n int, asks boolean"


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, off = offsets_of(texts)
    starts, stops, first = word_spans(raw, off, SPACED)
    return word_hashes(raw, starts, stops), first


def _windows(words: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, document) of every window."""
    doc = segment_ids(first)
    start = np.arange(max(len(words) - window + 1, 0))
    start = start[doc[start] == doc[start + window - 1]]
    return start, doc[start]


def own_repeats(words: np.ndarray, start: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(is the window's first place in its document, does it stand there several times), for each window."""
    a = mix(range_hashes(words, start, start + window) + doc.astype(U64))
    order = np.argsort(a, kind="stable")
    b = range_hashes(words, start, start + window, POWERS_2)[order]
    same = (a[order][1:] == a[order][:-1]) & (b[1:] == b[:-1])
    once, many = np.ones(len(start), bool), np.zeros(len(start), bool)
    once[order[1:][same]] = False
    many[order[1:][same]] = many[order[:-1][same]] = True
    return once, many


def bucket_runs(words: np.ndarray, first: np.ndarray, window: int = WINDOW, kmer: int = KMER):
    """(edge, path, next path or 0, document, first window, windows) of each run, in source order.

    Of windows that a document holds several times only the first enters.
    """
    reach = window - kmer + 1  # k-mers of a window
    start, doc = _windows(words, first, window)
    if not len(start):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    at = np.arange(len(words) - kmer + 1)
    edge = range_hashes(words, at, at + kmer)
    value, place, width = edge, at, 1
    while width < reach:  # least edge of `width` consecutive ones, leftmost of equals
        shift = min(width, reach - width)
        later = value[shift:] < value[:-shift]
        value = np.where(later, value[shift:], value[:-shift])
        place = np.where(later, place[shift:], place[:-shift])
        width += shift
    once, _ = own_repeats(words, start, doc, window)
    start, doc = start[once], doc[once]
    picked = place[start]
    fresh = np.concatenate([[True], (picked[1:] != picked[:-1]) | (start[1:] != start[:-1] + 1) | (doc[1:] != doc[:-1])])
    begin, whose = start[fresh], doc[fresh]
    n = np.diff(np.append(np.flatnonzero(fresh), len(start)))
    path = range_hashes(words, begin, begin + n + window - 1, POWERS_2)
    follows = np.append((begin[1:] == (begin + n)[:-1]) & (whose[1:] == whose[:-1]), False)
    after = np.where(follows, np.append(path[1:], U64(0)), U64(0))
    return signed(edge[picked[fresh]]), signed(path), signed(after), whose, begin - first[whose], n


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def chains(paths: DataFrame) -> DataFrame:
    """(path, head, ahead) of every repeated path that follows another without a branch between them.

    paths: path, times, n, lo and hi, the least and greatest path that follows it. Every place of a path with
    lo = hi is followed by that path; if both have as many places, each place of the second is preceded by the first.
    Heads have no row. Rounds grow with the logarithm of the longest chain; every round joins on distinct keys.
    """
    one_out = paths.where("lo = hi and lo <> 0").select(F.col("lo").alias("path"), F.col("path").alias("to"), "times", F.col("n").alias("ahead"))
    one_in = one_out.groupBy("path").agg(F.count("*").alias("ways"), F.max("to").alias("to"), F.max("times").alias("times"), F.max("ahead").alias("ahead")).where("ways = 1")
    links = one_in.join(paths.select("path", "times"), ["path", "times"]).select("path", "to", F.col("ahead").cast("bigint").alias("ahead"), F.lit(False).alias("done"))
    now = materialize(links, "links")
    while not now.where("not done").isEmpty():
        jump = now.select(F.col("path").alias("to"), F.col("to").alias("further"), F.col("ahead").alias("more"), F.col("done").alias("ends"))
        stepped = now.where("not done").join(jump, "to", "left")
        stepped = stepped.select("path", F.coalesce("further", "to").alias("head"), (F.col("ahead") + F.coalesce("more", F.lit(0))).alias("ahead"), F.coalesce("ends", F.lit(True)).alias("done"))
        after = materialize(stepped.withColumnRenamed("head", "to").unionByName(now.where("done")), "links")
        discard(now)
        now = after
    return now.select("path", F.col("to").alias("head"), "ahead")


def remove_repeats(docs: DataFrame, window: int = WINDOW, kmer: int = KMER, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every text, with ``with_text`` also kept, the words left."""
    text = F.coalesce("text", F.lit(""))
    rows = pick(docs, "doc_id", "text").select("doc_id", "text", F.xxhash64(text).alias("doc"), F.xxhash64(F.lit(1), text).alias("twin"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, None] = {}
        for batch in batches:
            for part in slices(batch):
                new = []
                for d in column(part, "doc").to_pylist():
                    new.append(d not in seen)
                    seen[d] = None
                while len(seen) > SEEN_TEXTS:
                    del seen[next(iter(seen))]
                part = part.filter(pa.array(new))
                edge, path, after, whose, start, n = bucket_runs(*_words(filled(part)), window, kmer)
                yield _batch([edge, path, after, column(part, "doc").take(pa.array(whose)), start.astype(np.int32), n.astype(np.int32)], RUNS)

    found = materialize(rows.select("doc", "text").mapInArrow(runs, RUNS), "runs")
    buckets = materialize(found.groupBy("edge").agg(F.count("*").alias("total")).where("total > 1"), "buckets")
    places = materialize(hot_join(found, buckets, ["edge"], "total"), "places")
    discard(found)
    discard(buckets)
    place = F.xxhash64("doc", "start")
    paths = places.groupBy("edge", "path").agg(F.count("*").alias("times"), F.min(place).alias("copy"), F.max("n").alias("n"), F.min("next").alias("lo"), F.max("next").alias("hi"), F.max("total").alias("total"))
    paths = materialize(paths.where("times > 1 or times < total"), "paths")
    chained = chains(paths.where("times > 1"))
    kinds = paths.join(chained, "path", "left").select("edge", "path", "times", "copy", (F.col("times") < F.col("total")).alias("branches"), F.coalesce("head", "path").alias("head"), F.coalesce("ahead", F.lit(0)).alias("ahead"))
    kinds = materialize(kinds, "path-kinds")
    discard(paths)
    marked = hot_join(places.drop("total"), kinds, ["edge", "path"], "times")
    marks = materialize(marked.select("doc", "edge", "start", "n", "head", "ahead", (F.col("times") > 1).alias("whole"), (F.col("branches") & (place == F.col("copy"))).alias("expand")).where("whole or expand"), "marks")
    discard(places)
    discard(kinds)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield from _pieces(part, window)

    # the runs of one chain in one text merge where they lie at the chain's own distances
    spans = marks.where("whole").groupBy("doc", "head", (F.col("start") - F.col("ahead")).alias("at")).agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("n")).alias("stop"))
    spans = spans.select("doc", F.col("head").alias("edge"), "start", (F.col("stop") - F.col("start")).alias("n"), F.lit(True).alias("span"), F.lit(True).alias("asks"))
    grown = marks.where("expand").select("doc", "edge", "start", "n", F.lit(False).alias("span"), (~F.col("whole")).alias("asks")).distinct()
    listed = spans.unionByName(grown).groupBy("doc").agg(F.collect_list(F.struct("edge", "start", "n", "span", "asks")).alias("marks"))
    texts = rows.groupBy("doc").agg(F.max("text").alias("text"))
    read = materialize(texts.join(listed, "doc").select("doc", "text", "marks").mapInArrow(pieces, PIECES), "pieces")
    discard(marks)
    key = ["edge", "a", "b", "n"]
    twice = materialize(read.groupBy(*key).agg(F.count("*").alias("times")).where("times > 1"), "verified")
    verified = hot_join(read.where("asks"), twice, key, "times").groupBy("doc").agg(F.collect_list(F.struct("start", "n", "a", "b")).alias("spans"))
    copies = rows.groupBy("doc", "twin").agg(F.count("*").alias("copies"))
    known = materialize(copies.join(verified, "doc", "left").select("doc", "twin", "copies", F.when(F.col("copies") == 1, F.col("spans")).alias("spans")), "verdicts")
    discard(read)
    discard(twice)
    schema = SCHEMA + (", kept string" if with_text else "")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = _kept(part, window)
                yield _batch([column(part, "doc_id"), [n for n, _, _ in out], [r for _, r, _ in out], [hashlib.sha256(t).hexdigest() for _, _, t in out], *([[t.decode() for _, _, t in out]] if with_text else [])], schema)

    return hot_join(rows, known, ["doc", "twin"], "copies").select("doc_id", "text", "copies", "spans").mapInArrow(kept, schema)


def _listed(part: pa.RecordBatch, name: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """(row of each element, the fields of the elements) of a column of lists of structs."""
    lists = column(part, name)
    whose = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(lists.offsets)))
    elements = lists.flatten()
    return whose, [elements.field(k).to_numpy(zero_copy_only=False) for k in range(elements.type.num_fields)]


def _digests(words: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return signed(range_hashes(words, begin, stop)), signed(range_hashes(words, begin, stop, POWERS_2))


def _pieces(part: pa.RecordBatch, window: int) -> Iterator[pa.RecordBatch]:
    """Digests of the words at the marks' coordinates: one a span, one a window of an expanded run."""
    words, first = _words(filled(part))
    doc = column(part, "doc")
    whose, (edge, start, n, span, asks) = _listed(part, "marks")
    fits = start + n + window - 1 <= np.diff(first)[whose]  # else the mark is another text's
    whose, edge, start, n, span, asks = (x[fits] for x in (whose, edge, start, n, span.astype(bool), asks.astype(bool)))
    for each, at, m in (
        (np.flatnonzero(span), start[span], n[span]),
        (np.repeat(np.flatnonzero(~span), n[~span]), np.repeat(start[~span], n[~span]) + _counters(n[~span]), None),
    ):
        m = np.ones(len(at), np.int32) if m is None else m
        begin = first[whose[each]] + at
        a, b = _digests(words, begin, begin + m + window - 1)
        yield _batch([edge[each], a, b, doc.take(pa.array(whose[each])), at.astype(np.int32), m.astype(np.int32), pa.array(asks[each])], PIECES)


def _counters(n: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n, one after another."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _kept(part: pa.RecordBatch, window: int) -> list[tuple[int, int, bytes]]:
    """(words, words removed, words left joined by a space) of each row, whose spans name windows that repeat."""
    texts = filled(part)
    words, first = _words(texts)
    size = np.diff(first)
    whose, (start, n, a, b) = _listed(part, "spans")
    fits = start + n + window - 1 <= size[whose]
    begin = first[whose[fits]] + start[fits]
    stop = begin + n[fits] + window - 1
    own_a, own_b = _digests(words, begin, stop)
    real = (own_a == a[fits]) & (own_b == b[fits])
    at, doc = _windows(words, first, window)
    _, many = own_repeats(words, at, doc, window)
    all_gone = (np.asarray(column(part, "copies")) > 1) & (size >= window)
    steps = np.zeros(len(words) + 1, np.int64)
    for places, change in ((begin[real], 1), (stop[real], -1), (at[many], 1), (at[many] + window, -1), (first[:-1][all_gone], 1), (first[1:][all_gone], -1)):
        np.add.at(steps, places, change)
    gone = np.cumsum(steps)[:-1] > 0
    out = []
    for i, text in enumerate(texts.to_pylist()):
        own = text.encode().split()
        drop = gone[first[i] : first[i + 1]]
        if drop.any():
            own_left = [w for w, d in zip(own, drop.tolist(), strict=True) if not d]
            out.append((len(own), len(own) - len(own_left), b" ".join(own_left)))
        else:
            out.append((len(own), 0, b" ".join(own)))
    return out


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Every window as text, counted over all documents; a word is covered by the last repeated window at or before it.
OP5_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
  SELECT r, s, array_to_string(w[s : s + 34], ' ') AS win FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS s FROM docs WHERE len(w) >= 35)
), repeated AS (
  SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY win) AS times FROM starts) WHERE times > 1
), words AS (
  SELECT r, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS word FROM docs
), marked AS (
  SELECT words.r, j, word, coalesce(max(s) OVER (PARTITION BY words.r ORDER BY j), -99) + 34 >= j AS gone
  FROM words LEFT JOIN repeated ON repeated.r = words.r AND repeated.s = words.j
), kept AS (
  SELECT r, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY j) FILTER (WHERE NOT gone), '') AS kept FROM marked GROUP BY r
)
SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""
