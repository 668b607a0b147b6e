"""What the training-data operators share: slices of Arrow batches, word hashes, columns by position."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one pass of array work holds at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 19
#: Rows that one slice holds at most, however short its texts are.
SLICE_ROWS = 16_384

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_2 = U64(0xC2B2AE3D27D4EB4F)


#: Rows of an Arrow batch at most, where the session keeps Spark's default of 10,000: texts are long.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(df: DataFrame) -> None:
    """Ask the session for Arrow batches of few rows, unless it has a number of its own."""
    if df.sparkSession.conf.get(_BATCH) == "10000":
        df.sparkSession.conf.set(_BATCH, str(BATCH_ROWS))


def pick(df: DataFrame, *names: str, types: dict[str, str] | None = None) -> DataFrame:
    """Just the named columns, cast; other columns never enter the plan, so their names cannot clash."""
    bound_batches(df)
    kinds = {"doc_id": "bigint", "text": "string", **(types or {})}
    return df.select(*[F.col(f"`{n}`").cast(kinds.get(n, "string")).alias(n) for n in names])


def offsets_of(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without a copy; null texts are empty."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    off = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of a batch whose texts together hold about ``most`` bytes."""
    if not batch.num_rows:
        return
    _, off = offsets_of(batch.column(batch.schema.get_field_index(column)))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(off, off[start] + most, side="right")) - 1
        stop = min(max(stop, start + 1), start + SLICE_ROWS, batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def filled(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The texts with null as empty."""
    return pc.fill_null(column(batch, name), "")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, U64(pow(int(base), -1, 1 << 64))
        self.up, self.down = np.ones(1, U64), np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up = np.concatenate([np.ones(1, U64), np.cumprod(np.full(n - 1, self.base, U64))])
            self.down = np.concatenate([np.ones(1, U64), np.cumprod(np.full(n - 1, self.inverse, U64))])
        return self.up, self.down


POWERS, POWERS_2 = Powers(_BASE), Powers(_BASE_2)


def range_hashes(values: np.ndarray, starts: np.ndarray, stops: np.ndarray, powers: Powers = POWERS) -> np.ndarray:
    """A 64-bit hash of each ``values[start:stop]``, which depends on the values and their order alone."""
    if not len(starts):
        return np.zeros(0, U64)
    up, down = powers.upto(len(values) + 1)
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[stops] - total[starts]) * down[starts] + (stops - starts).astype(U64))


#: A scrambled value of each byte.
BYTE_VALUES = mix(np.arange(1, 257).astype(U64))


def word_spans(raw: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of word bytes that stay within one document: (starts, stops, words before each document)."""
    is_word = np.zeros(len(raw) + 1, bool)
    is_word[:-1] = inside[raw]
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1]
    ends = ~is_word
    ends[1:] &= is_word[:-1]
    ends[0] = False
    cuts = np.unique(off[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    both = cuts[is_word[cuts] & is_word[cuts - 1]]  # a word that touches the next document's first word
    begins[both] = True
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends)
    if len(both):
        stops = np.sort(np.concatenate([stops, both]))
    return starts, stops, np.searchsorted(starts, off)


def word_hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    return range_hashes(BYTE_VALUES[raw], starts, stops)


_SPACES = np.ones(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words that any of space, tab, newline, vertical tab, form feed and return part.
SPACED = _SPACES
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Bytes of plain words: ASCII letters and digits, and every byte of a character beyond ASCII.
PLAIN = _LETTERS


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, words before each document) of lower-cased plain words."""
    raw, off = offsets_of(pc.utf8_lower(texts))
    starts, stops, first = word_spans(raw, off, PLAIN)
    return word_hashes(raw, starts, stops), first


def plain_word_list(text: str | None) -> list[str]:
    """The plain words of one text, as :func:`plain_words` sees them."""
    import re

    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", pc.utf8_lower(pa.array([text or ""]))[0].as_py())


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def segment_ids(first: np.ndarray) -> np.ndarray:
    """For each element, the document it belongs to; first: elements before each document."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def with_column_of(df: DataFrame, name: str, kind: str, make, prepare=None) -> DataFrame:
    """``df`` with one more column that ``make(part, state)`` gives for each slice of rows; no exchange, no join.

    prepare: gives a task's state. The name must be free in ``df`` (see :func:`free_name`).
    """
    bound_batches(df)
    fields = [*df.schema.names, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = prepare() if prepare else None
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([*part.columns, make(part, state)], fields)

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *T.StructType.fromDDL(f"`{name}` {kind}").fields]))


#: Keys that may be split at once: a key is hot once it holds more than one row in HOT of all.
HOT = 1_024
#: Rows of a key that one task takes in any case.
COLD_ROWS = 1_000


def hot_join(rows: DataFrame, side: DataFrame, keys: list[str], times: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``side``, a written table of one row a key; ``times``: how many of ``rows`` hold the key.

    The rows of a hot key are dealt over several tasks and its one row of ``side`` is repeated for each of them. Hot
    keys each hold more than a share of all rows, so there are at most HOT of them, and only these are broadcast.
    """
    total = side.agg(F.sum(times)).first()[0] or 0
    share = max(total // HOT, COLD_ROWS)
    ways = F.greatest(F.ceil(F.col(times) / F.lit(share)), F.lit(1))
    hot = side.where(F.col(times) > share).select(*keys, ways.alias("__ways"))
    salt = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("__ways")), F.lit(0))
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn("__salt", salt).drop("__ways")
    wide = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), ways - 1)))
    return dealt.join(wide, [*keys, "__salt"], how).drop("__salt")


def least_count(counts: DataFrame, most: int, n: str = "n") -> int:
    """The least count that at most ``most`` rows of a written table reach: first its power of two, then the count.

    Two jobs; the driver sees a row a power, and then at most ``most`` + 1 counts.
    """
    by_power = {r[0]: r[1] for r in counts.groupBy(F.floor(F.log2(n)).alias("p")).count().collect()}
    left, power = most, max(by_power, default=0)
    while power >= 0 and by_power.get(power, 0) <= left:
        left -= by_power.get(power, 0)
        power -= 1
    least = 1 << (power + 1)
    if power >= 0:  # every count of this power has a row, so that `left` counts and one more decide
        inside = counts.where((F.col(n) >= 1 << power) & (F.col(n) < least)).groupBy(n).agg(F.count("*").alias("rows"))
        for value, rows in inside.orderBy(F.desc(n)).limit(left + 1).collect():
            left -= rows
            if left < 0:
                break
            least = value
    return least


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores as make it new in ``df``."""
    while name in df.columns:
        name += "_"
    return name
