"""Language identification by rank-order profiles (operator 10).

A document's letters are cut into n-grams of one to three characters, word boundaries included. Its most frequent
n-grams, in order, are compared with each language's own order: an n-gram costs the difference of its two ranks,
or the profile's length where the language lacks it. The language of the least out-of-place distance wins.

Profiles are learned from at most SAMPLE labelled documents, taken by a hash of their ids from all rows of the
learning part. Predictions read whole texts.

Defined cases: a null text, an empty one and one without letters give `und` with score 0; equal distances go to
the language that sorts first; equal counts rank by the n-gram; repeated rows each give a row; texts of any length are
read whole; an empty table gives no rows; without any labelled
row everything is `und`; a null doc_id is never learned from nor held out; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm.common import column, filled, free_name, pick, slices, with_column_of

#: n-grams of a profile.
RANKS = 300
#: Labelled documents that profiles are learned from, about (a share of the ids' hashes is taken).
SAMPLE = 20_000
UNKNOWN = "und"
SCHEMA = "doc_id bigint, lang_pred string, score double"
#: Bits of a letter and of an n-gram of three; the other ten of a key number the texts that are ranked together.
_LETTER, _DOC = np.uint64(18), np.uint64(54)
_GRAM = np.uint64((1 << 54) - 1)
_TEXTS = 1 << 10
_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Of each code point its number among the letters, from 2 and in their order; 1 for what is no letter."""
    if not _TABLE:
        letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        _TABLE.append(np.where(letter, np.cumsum(letter) + 1, 1).astype(np.uint32))
    return _TABLE[0]


def ranked_grams(texts: pa.Array, most: int = RANKS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, n-gram, count, rank from 0) of the most frequent n-grams of each text, by document and rank."""
    if len(texts) > _TEXTS:
        parts = [ranked_grams(texts.slice(at, _TEXTS), most) for at in range(0, len(texts), _TEXTS)]
        return tuple(np.concatenate([p[k] + (i * _TEXTS if k == 0 else 0) for i, p in enumerate(parts)]) for k in range(4))
    low = pc.utf8_lower(texts)
    sizes = np.asarray(pc.utf8_length(low)) + 1
    points = np.frombuffer(("\n" + "\n".join(low.to_pylist()) + "\n").encode("utf-32-le"), np.uint32)
    m = _letters()[points].astype(np.uint64)
    doc = np.concatenate([[0], np.repeat(np.arange(len(sizes)), sizes)]).astype(np.uint64) << _DOC
    is_letter = m > 1
    two = (m[:-1] << _LETTER) | m[1:]
    three = (two[:-1] << _LETTER) | m[2:]
    either = is_letter[:-1] | is_letter[1:]
    home = np.where(is_letter[:-1], doc[:-1], doc[1:])
    keys = np.concatenate([(doc | m)[is_letter], (home | two)[either], (doc[1:-1] | three)[is_letter[1:-1]]])
    keys.sort()
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(at, len(keys)))
    keys = keys[at]
    whose = (keys >> _DOC).astype(np.int64)
    if len(keys) < 1 << 24 and (not len(keys) or counts.max() < 1 << 24):
        packed = (whose.astype(np.uint64) << np.uint64(48)) | ((np.uint64((1 << 24) - 1) - counts.astype(np.uint64)) << np.uint64(24)) | np.arange(len(keys), dtype=np.uint64)
        packed.sort()
        order = (packed & np.uint64((1 << 24) - 1)).astype(np.int64)
    else:
        order = np.lexsort((keys, -counts, whose))
    whose = whose[order]
    rank = np.arange(len(order)) - np.searchsorted(whose, whose)
    kept = rank < most
    order = order[kept]
    return whose[kept], keys[order] & _GRAM, counts[order], rank[kept]


def learn_profiles(labelled: DataFrame, sample: int = SAMPLE, ranks: int = RANKS) -> dict[str, list[int]]:
    """Of each language its most frequent n-grams in order. labelled: doc_id, text, lang."""
    rows = pick(labelled, "doc_id", "text", "lang").where("doc_id is not null and text is not null and lang is not null")
    total = rows.select("doc_id").count()
    if total > sample:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(1 << 20)) < F.lit(int((1 << 20) * sample / total)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                langs = column(part, "lang").dictionary_encode()
                whose, grams, counts, _ = ranked_grams(filled(part), most=1 << 62)
                lang = np.asarray(langs.indices)[whose]
                order = np.lexsort((grams, lang))
                lang, grams, counts = lang[order], grams[order], counts[order]
                fresh = np.flatnonzero(np.concatenate([[True], (grams[1:] != grams[:-1]) | (lang[1:] != lang[:-1])])) if len(order) else np.zeros(0, np.int64)
                sums = np.add.reduceat(counts, fresh).astype(np.int64) if len(fresh) else np.zeros(0, np.int64)
                names = langs.dictionary.take(pa.array(lang[fresh]))
                yield pa.RecordBatch.from_arrays([names, pa.array(grams[fresh].astype(np.int64)), pa.array(sums)], ["lang", "gram", "n"])

    summed = rows.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = [F.desc("n"), "gram"]
    part = summed.withColumn("part", F.pmod("gram", F.lit(16))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= ranks)
    best = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= ranks)
    out: dict[str, list[tuple[int, int]]] = {}
    for r in best.select("lang", "gram", "rank").collect():  # at most `ranks` rows a language
        out.setdefault(r["lang"], []).append((r["rank"], r["gram"]))
    return {lang: [g for _, g in sorted(rows)] for lang, rows in sorted(out.items())}


class Profiles:
    """The languages' orders as one table of n-grams by languages."""

    def __init__(self, profiles: dict[str, list[int]], ranks: int = RANKS):
        self.langs, self.ranks = sorted(profiles), ranks
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), np.uint64)
        self.place = np.full((len(self.grams), len(self.langs)), -1, np.int64)
        for k, lang in enumerate(self.langs):
            self.place[np.searchsorted(self.grams, np.array(profiles[lang], np.uint64)), k] = np.arange(len(profiles[lang]))

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        n, width = len(texts), len(self.langs)
        whose, grams, _, rank = ranked_grams(texts, self.ranks)
        sizes = np.bincount(whose, minlength=n)
        if not width:
            return [UNKNOWN] * n, np.zeros(n)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = self.grams[at] == grams
        place = self.place[at]
        cost = np.where(known[:, None] & (place >= 0), np.abs(place - rank[:, None]), self.ranks)
        far = np.stack([np.bincount(whose, cost[:, k], n) for k in range(width)], axis=1)
        best = far.argmin(axis=1)
        score = 1 - far[np.arange(n), best] / np.maximum(sizes * self.ranks, 1)
        return [self.langs[b] if s else UNKNOWN for b, s in zip(best, sizes, strict=True)], np.where(sizes > 0, score, 0.0)


def identify(docs: DataFrame, profiles: dict[str, list[int]], ranks: int = RANKS) -> DataFrame:
    """(doc_id, lang_pred, score) of every text. profiles: bounded by languages times ranks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(profiles, ranks)
        for batch in batches:
            for part in slices(batch):
                langs, score = model.predict(filled(part))
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), pa.array(langs, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return pick(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def reject_unknown(docs: DataFrame, profiles: dict[str, list[int]], ranks: int = RANKS) -> DataFrame:
    """The documents whose text has a language; all columns stay as they are."""
    name = free_name(docs, "lang_pred")
    make = lambda part, model: pa.array(model.predict(filled(part))[0], pa.string())
    return with_column_of(docs, name, "string", make, lambda: Profiles(profiles, ranks)).where(F.col(name) != UNKNOWN).drop(name)


def remainder(column: str, by: int) -> Column:
    return F.crc32(F.col(column).cast("string")) % by


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = learn_profiles(docs.where(remainder("doc_id", 4) != 2))
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return identify(docs, profiles).select("doc_id", held.alias("held_out"), "lang_pred", "score")
