"""Token counts without encoding: rank-synchronous array merging (operator 2).

Pre-tokens of a slice of documents are gathered, the distinct new ones are merged together as ragged arrays
(:class:`~spanloom.llm.bpe.Bpe`), and only the number of surviving symbols of each is kept.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); empty texts give 0; repeated rows each give a
row; an empty table gives no rows; other columns are ignored. Very long texts are sliced alone; a pre-token of
any length is merged in memory proportional to its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import bpe
from spanloom.llm.common import column, filled, offsets_of, pick, slices

#: Distinct pre-tokens whose counts a worker remembers; beyond it the memory starts anew (a cache, not a cap).
REMEMBERED = 200_000
SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every text under a byte-level BPE vocabulary file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = bpe.load(tokenizer), {}
        for batch in batches:
            for part in slices(batch):
                counts = _count(model, filled(part).to_pylist(), known)
                _, off = offsets_of(filled(part))
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id"), pa.array(np.diff(off)), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return pick(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def _count(model: bpe.Bpe, texts: list[str], known: dict[str, int]) -> list[int]:
    specials, tokens = [], []
    for text in texts:
        parts = model.parts(text)
        specials.append(len(parts) // 2)
        tokens.append(model.pre_tokens(parts[0]) if len(parts) == 1 else [t for p in parts[::2] for t in model.pre_tokens(p)])
    if len(known) > REMEMBERED:
        known.clear()
    new = [t for t in bpe.distinct(tokens) if t not in known]
    if new:
        _, begins = model.merge(new)
        known.update(zip(new, np.diff(begins).tolist(), strict=True))
    get = known.__getitem__
    return [n + sum(map(get, t)) for n, t in zip(specials, tokens, strict=True)]


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, bpe.tokenizer_path("byte_bpe_50k.json"))
