"""BPE encoding and decoding with a minimal acyclic transducer lexicon (operator 1).

Pre-tokens are counted over all documents. The most frequent ones are compiled into a minimal acyclic automaton
whose edges carry the number of words before them, so that the sum along a word's path is the word's place in
the table of id outputs, and equal endings share states. The compiled arrays are one file in the shared folder, which
Spark hands to every executor once and each Python worker maps into memory, so that workers share its pages. A pre-token outside the lexicon is merged exactly by :class:`~spanloom.llm.bpe.Bpe`.
Counting and encoding hold the pre-tokens of a slice of texts as one Arrow array and work on its distinct values, so
that Python takes no step for a single word. Only texts with special strings or foreign characters are cut one by one.

Defined cases: a null text is empty (0 ids, the hash of the empty string, an empty decoded text); repeated rows
each give a row; an empty table gives no rows; other columns are ignored; words of any length are encoded whole.
Ties of the word count at the lexicon's bound stay outside the lexicon together; they are merged, so that the
result never depends on the lexicon.
"""

from __future__ import annotations

import hashlib
import mmap
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm import bpe
from spanloom.llm.common import bound_batches, column, filled, free_name, least_count, pick, slices
from spanloom.storage import discard, materialize, shared_dir

#: Words that the lexicon holds at most. The compiled file stays under 4 MB, whatever the corpus's size.
LEXICON_WORDS = 32_768
#: Longest word of the lexicon in UTF-8 bytes.
LEXICON_BYTES = 48
#: Distinct words that a task counts before it sends its counts on.
COUNTED = 200_000
#: Merged words that a worker remembers from task to task, the last ones.
REMEMBERED = 200_000
#: Bytes of text that are counted or encoded together.
ENCODED_BYTES = 1 << 21
SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class Lexicon:
    """A minimal acyclic transducer from words to id sequences, as arrays in one memory-mapped file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        head = np.frombuffer(self.map, np.int64, 4)
        at, parts = 32, []
        for n in (head[0], head[0], head[0], head[1], head[2], head[3]):
            parts.append(np.frombuffer(self.map, np.int64, int(n), at))
            at += 8 * int(n)
        self.keys, self.target, self.before, self.final, self.begins, self.ids = parts

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the id table, -1 where the lexicon lacks it; all words walk in step."""
        return self.places(np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words)))

    def places(self, raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """:meth:`find` for words that stand in a row as bytes."""
        out = np.full(len(sizes), -1, np.int64)
        live = np.flatnonzero((sizes > 0) & (sizes <= LEXICON_BYTES))
        if not len(live) or not len(self.keys):
            return out
        begin = np.cumsum(sizes) - sizes
        state, total = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
        for step in range(LEXICON_BYTES + 1):
            ended = sizes[live] == step
            if ended.any():
                good = self.final[state[ended]] == 1
                out[live[ended][good]] = total[ended][good]
                live, state, total = live[~ended], state[~ended], total[~ended]
            if not len(live):
                break
            key = state * 256 + raw[begin[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[at] == key
            live, at = live[ok], at[ok]
            state, total = self.target[at], total[ok] + self.before[at]
        return out


def compile_lexicon(words: list[str], model: bpe.Bpe) -> bytes:
    """The file of :class:`Lexicon` for distinct words: states that accept the same endings are one state."""
    data = sorted({w.encode("utf-8", "surrogateescape"): w for w in words}.items())
    ids, begins = model.merge([w for _, w in data])
    known: dict[tuple, int] = {}
    edges: list[list[tuple[int, int]]] = []  # of each state: (byte, state)
    final: list[int] = []

    def state(out: list[tuple[int, int]], accepts: int) -> int:
        key = (accepts, *out)
        if key not in known:
            known[key] = len(edges)
            edges.append(out)
            final.append(accepts)
        return known[key]

    path: list[list] = [[[], 0]]  # the unfinished states of the last word: edges so far, accepts
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            out, accepts = path.pop()
            path[-1][0].append((last[len(path) - 1], state(out, accepts)))

    for word, _ in data:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        close(same)
        path.extend([[], 0] for _ in word[same:])
        path[-1][1] = 1
        last = word
    close(0)
    root = state(*path[0])
    if root != 0:  # the root is state 0
        swap = {0: root, root: 0}
        edges[0], edges[root] = edges[root], edges[0]
        final[0], final[root] = final[root], final[0]
        edges = [[(b, swap.get(s, s)) for b, s in out] for out in edges]
    below = [-1] * len(edges)

    def count(s: int) -> int:
        stack = [s]
        while stack:
            s = stack[-1]
            todo = [t for _, t in edges[s] if below[t] < 0]
            if todo:
                stack.extend(todo)
            else:
                below[s] = final[s] + sum(below[t] for _, t in edges[s])
                stack.pop()
        return below[s]

    count(0)
    keys, target, before = [], [], []
    for s, out in enumerate(edges):
        n = final[s]
        for b, t in out:
            keys.append(s * 256 + b)
            target.append(t)
            before.append(n)
            n += below[t]
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    arrays = [np.array(x, np.int64)[order] for x in (keys, target, before)] + [np.array(final, np.int64), begins.astype(np.int64), ids.astype(np.int64)]
    head = np.array([len(keys), len(final), len(begins), len(ids)], np.int64)
    return b"".join(x.tobytes() for x in [head, *arrays])


def word_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(word, n) of every pre-token of every text; tasks add up before the exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = bpe.load(tokenizer), []
        for batch in batches:
            for part in slices(batch, most=ENCODED_BYTES):
                seen.append(counted(model.cut(filled(part).to_pylist())[0]))
                if sum(len(words) for words, _ in seen) > COUNTED:
                    seen = [counted(pa.concat_arrays([w for w, _ in seen]), np.concatenate([n for _, n in seen]))]
                    if len(seen[0][0]) > COUNTED:
                        yield sent(model, *seen.pop())
        if seen:
            yield sent(model, *counted(pa.concat_arrays([w for w, _ in seen]), np.concatenate([n for _, n in seen])))

    def counted(words: pa.LargeBinaryArray, n: np.ndarray | None = None) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """The distinct words and the sum of each one's counts."""
        coded = words.dictionary_encode()
        return coded.dictionary, np.bincount(coded.indices.to_numpy(), n, len(coded.dictionary)).astype(np.int64)  # exact below 2**53

    def sent(model: bpe.Bpe, words: pa.LargeBinaryArray, n: np.ndarray) -> pa.RecordBatch:
        fit = (pc.binary_length(words).to_numpy() <= LEXICON_BYTES) & ~pc.is_in(words, pa.array(list(model.marked), pa.large_binary())).to_numpy(zero_copy_only=False)
        words, n = words.filter(pa.array(fit)), n[fit]
        try:
            words = words.cast(pa.string())
        except pa.ArrowInvalid:  # bytes that are no text have no place in a table of strings; they are merged
            texts = [w.decode(errors="ignore") for w in words.to_pylist()]
            fit = np.array([t.encode() == w for t, w in zip(texts, words.to_pylist(), strict=True)])
            words, n = pa.array(texts, pa.string()).filter(pa.array(fit)), n[fit]
        return pa.RecordBatch.from_arrays([words, pa.array(n)], ["word", "n"])

    return pick(docs, "doc_id", "text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, tokenizer: str, most: int = LEXICON_WORDS) -> list[str]:
    """The words whose count reaches the least count that at most ``most`` words reach."""
    counts = materialize(word_counts(docs, tokenizer).where("n > 1"), "word-counts")
    least = least_count(counts, most)
    words = [r[0] for r in counts.where(F.col("n") >= least).select("word").collect()]
    discard(counts)
    return sorted(words)


def ship_lexicon(spark: SparkSession, words: list[str], tokenizer: str) -> str:
    """Compile the lexicon into one file of the shared folder and hand it to all executors; returns its name."""
    name = f"lexicon-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(compile_lexicon(words[:LEXICON_WORDS], bpe.load(tokenizer))))  # bounded by LEXICON_WORDS
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


_CODECS: dict[tuple[str, str], "Codec"] = {}


def _codec(tokenizer: str, lexicon: str) -> "Codec":
    """This worker's codec; it keeps the last one from task to task."""
    if (tokenizer, lexicon) not in _CODECS:
        _CODECS.clear()
        _CODECS[tokenizer, lexicon] = Codec(bpe.load(tokenizer), Lexicon(SparkFiles.get(lexicon)))
    return _CODECS[tokenizer, lexicon]


def _coded(part: pa.RecordBatch, codec: Codec, more: tuple[str, ...] = ()) -> Iterator[pa.Array]:
    """n_tokens, the two hashes and, if named in ``more``, the ids and the decoded text of each row."""
    coded = codec.coded(filled(part).to_pylist())
    yield pa.array(np.diff(coded.ends))
    for lines in (coded.ids, coded.decoded):
        yield pa.array([hashlib.sha256(x).hexdigest() for x in lines], pa.string())
    if "ids" in more:
        yield pa.ListArray.from_arrays(pa.array(coded.ends, pa.int32()), coded.flat())
    if "decoded" in more:
        yield pa.array([str(x, "utf-8") for x in coded.decoded], pa.string())


def encode(docs: DataFrame, tokenizer: str, words: list[str] | None = None, with_ids: bool = False) -> DataFrame:
    """Every whole text as token ids and back.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``with_ids`` also ids array<int> and decoded.
    ``words``: the lexicon; None compiles the frequent words of ``docs``.
    """
    words = frequent_words(docs, tokenizer) if words is None else words
    lexicon = ship_lexicon(docs.sparkSession, words, tokenizer)
    schema = SCHEMA + (", ids array<int>, decoded string" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(tokenizer, lexicon)
        for batch in batches:
            for part in slices(batch, most=ENCODED_BYTES):
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), *_coded(part, codec, ("ids", "decoded") if with_ids else ())], [c.split()[0] for c in schema.split(", ")])

    return pick(docs, "doc_id", "text").mapInArrow(run, schema)


def with_tokens(docs: DataFrame, tokenizer: str, words: list[str] | None = None) -> DataFrame:
    """The documents with all their columns and, after them, n_tokens, ids_sha256, decoded_sha256 and ids array<int>.

    A name that the documents hold already gets an underscore.
    """
    words = frequent_words(docs, tokenizer) if words is None else words
    lexicon = ship_lexicon(docs.sparkSession, words, tokenizer)
    kinds = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType(), "ids": T.ArrayType(T.IntegerType())}
    schema = T.StructType([*docs.schema.fields, *(T.StructField(free_name(docs, n), k) for n, k in kinds.items())])
    bound_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(tokenizer, lexicon)
        for batch in batches:
            for part in slices(batch, most=ENCODED_BYTES):
                yield pa.RecordBatch.from_arrays([*part.columns, *_coded(part, codec, ("ids",))], schema.names)

    return docs.mapInArrow(run, schema)


_REMEMBERED: dict[int, list] = {}


class Coded(NamedTuple):
    """What texts were encoded to: ids before each text (and in all), lines of ids, decoded texts, and the ids in a row."""

    ends: np.ndarray
    ids: list[memoryview]
    decoded: list[memoryview]
    flat: Callable[[], pa.Array]


class Codec:
    """Texts to ids and back."""

    def __init__(self, model: bpe.Bpe, lexicon: Lexicon):
        self.model, self.lexicon = model, lexicon
        piece = dict(enumerate(model.piece)) | {i: s for s, i in model.special.items()}  # whose ids may lie beyond the merges'
        ids = range(max(piece) + 1)
        self.names = pa.array([b"%d " % i for i in ids], pa.large_binary())
        self.pieces = pa.array([piece.get(i, "").encode() + b" " for i in ids], pa.large_binary())
        self.listed = pa.LargeListArray.from_arrays(pa.array(lexicon.begins), pa.array(lexicon.ids, pa.int32()))
        self.special = pa.array(list(model.marked), pa.large_binary()), pa.array([[i] for i in model.marked.values()], pa.large_list(pa.int32()))
        #: Words and their ids, exact, so the same under any lexicon.
        self.known = _REMEMBERED.setdefault(id(model), [pa.array([], pa.large_binary()), pa.array([], pa.large_list(pa.int32()))])

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, ids joined by spaces, decoded text) of each text."""
        coded = self.coded(texts)
        return [(n, str(a, "utf-8"), str(b, "utf-8")) for n, a, b in zip(np.diff(coded.ends).tolist(), coded.ids, coded.decoded, strict=True)]

    def coded(self, texts: list[str]) -> Coded:
        tokens, before = self.model.cut(texts)
        tokens = tokens.dictionary_encode()
        entries = self._entries(tokens.dictionary)
        begins, flat = entries.offsets.to_numpy(), entries.values
        ends = np.cumsum(np.concatenate([[0], np.diff(begins)[tokens.indices.to_numpy()]]))[before]

        def lines(of: pa.LargeBinaryArray) -> list[memoryview]:
            raw, off = bpe.contents(of.take(flat))
            raw, off = bpe.contents(bpe.binaries(raw, off[begins]).take(tokens.indices))
            raw, cut = memoryview(raw), off[before].tolist()
            return [raw[a : max(a, b - 1)] for a, b in zip(cut[:-1], cut[1:], strict=True)]  # without the last space

        return Coded(ends, lines(self.names), lines(self.pieces), lambda: entries.take(tokens.indices).flatten())

    def _entries(self, words: pa.LargeBinaryArray) -> pa.LargeListArray:
        """The ids of distinct pre-tokens: from the lexicon, else remembered, else merged."""
        raw, off = bpe.contents(words)
        place = self.lexicon.places(raw, np.diff(off))
        rest = np.flatnonzero(place < 0)
        others = words.take(pa.array(rest))
        held = pa.concat_arrays([self.special[0], self.known[0]])
        at = pc.fill_null(pc.index_in(others, held), -1).to_numpy().astype(np.int64)
        unseen = np.flatnonzero(at < 0)
        new = others.take(pa.array(unseen))
        raw, off = bpe.contents(new)
        ids, begins = self.model.merge_bytes(raw, np.diff(off))
        at[unseen] = len(held) + np.arange(len(unseen))
        place[rest] = len(self.listed) + at
        merged = pa.concat_arrays([self.known[1], pa.LargeListArray.from_arrays(pa.array(begins), pa.array(ids, pa.int32()))])
        drop = max(len(merged) - REMEMBERED, 0)
        self.known[:] = pa.concat_arrays([self.known[0], new])[drop:], merged[drop:]
        return pa.concat_arrays([self.listed, self.special[1], merged]).take(pa.array(place))


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, decoded) of rows of (doc_id, ids): the vocabulary's pieces joined as the library joins them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe.load(tokenizer)
        names = dict(enumerate(model.piece)) | {i: s for s, i in model.special.items()}
        for batch in batches:
            rows = [" ".join(names[i] for i in ids or []) for ids in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(rows, pa.string())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, decoded string")


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode(docs, bpe.tokenizer_path("word_bpe_49k.json"))
