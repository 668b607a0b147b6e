"""Byte-pair encoding over arrays: vocabulary files, pre-tokens, and the rank-synchronous merger.

The merger holds many pre-tokens as one ragged array of symbols. Each round finds the lowest rank in every
sequence and merges that pair everywhere in the sequence, all sequences at once, until no pair is left.
"""

from __future__ import annotations

import json
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

#: Characters on which the pattern engine and the tokenizer library agree for sure; others take the library's own way.
_FOREIGN = regex.compile(r"[^\x00-˿Ͱ-ͷͺ-Ϳ΄-ΊΌΎ-ΡΣ-ҁҊ-ԯ‐-‧‰-⁞₠-₿ぁ-ゖァ-ヺ一-龥가-힣]")
_NONE = np.int64(1 << 40)
#: Bits of the slots' number in the table of pairs.
_SLOTS = 18


def _slots(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOTS)).astype(np.int64)


def binaries(raw: np.ndarray, begins: np.ndarray) -> pa.LargeBinaryArray:
    """Bytes cut at ``begins``, which holds one place more than the array has values; nothing is copied."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins) - 1, [None, pa.py_buffer(np.ascontiguousarray(begins, np.int64)), pa.py_buffer(raw)])


def contents(values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, where each value begins, and the end) of an array, without a copy of the bytes."""
    off = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    data = values.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[off[0] : off[-1]], off - off[0]


#: Kinds of characters to the patterns.
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def _kinds() -> np.ndarray:
    """The kind of every character up to U+FFFF, as the pattern engine sees it."""
    out, every = np.full(1 << 16, _OTHER, np.uint8), "".join(map(chr, range(1 << 16)))
    for kind, pattern in ((_SPACE, r"\s+"), (_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
        for found in regex.finditer(pattern, every):
            out[slice(*found.span())] = kind
    return out


def byte_characters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free one from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(plain))
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class Bpe:
    """One vocabulary file of the tokenizers library (byte-level, with or without an end-of-word suffix)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.lowers = spec["normalizer"] is not None
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        words = r"'s|'t|'re|'ve|'m|'ll|'d|"
        self.pattern = regex.compile(words + (r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+" if self.lowers else r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"))
        chars = byte_characters()
        self.back = {c: b for b, c in chars.items()}
        self.inner = np.array([vocab[chars[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[chars[b] + self.suffix] for b in range(256)], np.int64)
        self.size = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * self.size + right
        self.made_by = made
        self._fill(keys)
        lowest = np.full(self.size, len(pairs), np.int64)  # of the pairs that hold a symbol
        ranks = np.arange(len(pairs))
        np.minimum.at(lowest, left, ranks)
        np.minimum.at(lowest, right, ranks)
        #: Ranks whose merge makes no pair of a lower or equal rank: all its places in a sequence can go in one round.
        self.at_once = lowest[made] > ranks
        self.kinds = _kinds() if self.lowers else None
        #: Special strings as :meth:`cut` marks them: after a space, so that no pre-token of a text equals one.
        self.marked = {b" " + s.encode(): i for s, i in self.special.items()}
        self.piece = [""] * self.size
        for text, i in vocab.items():
            self.piece[i] = text

    def parts(self, text: str) -> list[str]:
        """A text cut at the special strings, which stand at the odd places."""
        return self.splitter.split(text) if "<|" in text else [text]

    def pre_tokens(self, part: str) -> list[str]:
        """The library's pre-tokens of a part without special strings; their characters, not their byte stand-ins."""
        if not part.isascii() and _FOREIGN.search(part):
            if self.lowers:
                part = self.library.normalizer.normalize_str(part)
            back = self.back
            return [bytes(map(back.__getitem__, w)).decode("utf-8", "surrogateescape") for w, _ in self.library.pre_tokenizer.pre_tokenize_str(part)]
        return self.pattern.findall(self.normal(part))

    def normal(self, part: str) -> str:
        """A part without foreign characters as the library normalizes it."""
        if self.lowers:
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")  # one character at a time: no final sigma
            part = part.lower()
        return part

    def cut(self, texts: list[str]) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """The pre-tokens of all texts in a row, and how many stand before each text (and in all).

        Texts without special strings and foreign characters are cut together by the kinds of their bytes; the others
        one by one, with a special string standing as a pre-token of its own, marked by a space before it.
        """
        blobs, own = [], {}
        for k, text in enumerate(texts):
            parts = self.parts(text)
            if len(parts) > 1 or not self.lowers or (not text.isascii() and _FOREIGN.search(text)):
                own[k] = [t for i, p in enumerate(parts) for t in ([b" " + p.encode()] if i % 2 else [w.encode("utf-8", "surrogateescape") for w in self.pre_tokens(p)])]
                blobs.append(b" " * sum(map(len, own[k])))
            else:
                blobs.append(self.normal(text).encode())
        at = np.cumsum([0, *(len(b) + 1 for b in blobs)])
        raw = np.frombuffer(bytearray(b"\n".join([*blobs, b"\n\n\n"])), np.uint8)  # so that three places follow any character
        del blobs
        begin, inside = self._begins(raw) if len(own) < len(texts) else (np.zeros(len(raw), bool), np.zeros(len(raw), bool))
        for k, tokens in own.items():
            stop = at[k + 1] - 1
            raw[at[k] : stop] = np.frombuffer(b"".join(tokens), np.uint8)
            inside[at[k] : stop] = True
            begin[at[k] + np.cumsum([0, *map(len, tokens[:-1])])[: len(tokens)]] = True
        before = np.searchsorted(np.flatnonzero(begin), at)
        words = raw[inside]
        return binaries(words, np.append(np.flatnonzero(begin[inside]), len(words))), before

    def _begins(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of normalized texts' bytes: where a pre-token of the lower-casing pattern begins, and what lies inside one."""
        kind = self.kinds[raw]
        tails = []
        if raw.max() >= 0x80:
            for low, high, size in ((0xC0, 0xE0, 2), (0xE0, 0xF0, 3)):
                lead = np.flatnonzero((raw >= low) & (raw < high))
                code = raw[lead].astype(np.int64) & (high - low - 1)
                for k in range(1, size):
                    code = code << 6 | (raw[lead + k] & 0x3F)
                for k in range(size):
                    kind[lead + k] = self.kinds[code]
                tails += [lead + k for k in range(1, size)]
        begin = kind == _NUMBER  # each number alone, the others in runs
        begin[0] |= kind[0] != _SPACE
        begin[1:] |= kind[1:] != kind[:-1]
        begin &= kind != _SPACE
        for tail in tails:
            begin[tail] = False
        mark = np.flatnonzero(raw == 0x27)
        mark = mark[begin[mark]]
        mark = mark[kind[mark + 1] == _LETTER]
        first, second = raw[mark + 1], raw[mark + 2]
        one = np.isin(first, np.frombuffer(b"stmd", np.uint8))
        two = (second == 0x65) & ((first == 0x72) | (first == 0x76)) | (second == 0x6C) & (first == 0x6C)  # re, ve, ll
        for size, at in ((2, mark[one]), (3, mark[two])):
            begin[at + 1] = False
            begin[at + size] |= kind[at + size] == _LETTER
        return begin, kind != _SPACE

    def _fill(self, keys: np.ndarray) -> None:
        """An open-addressing table from pairs to ranks, filled round by round: in each, the first pair of a free slot."""
        self.slot_key, self.slot_rank = np.full(1 << _SLOTS, -1, np.int64), np.full(1 << _SLOTS, _NONE, np.int64)
        left, at = np.arange(len(keys)), _slots(keys)
        while len(left):
            free = np.flatnonzero(self.slot_key[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.slot_key[at[put]], self.slot_rank[at[put]] = keys[left[put]], left[put]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, at = left[rest], (at[rest] + 1) & (len(self.slot_key) - 1)

    def ranks(self, keys: np.ndarray) -> np.ndarray:
        at = _slots(keys)
        found = self.slot_key[at]
        out = np.where(found == keys, self.slot_rank[at], _NONE)
        left = np.flatnonzero((found != keys) & (found >= 0))
        at = at[left]
        while len(left):
            at = (at + 1) & (len(self.slot_key) - 1)
            found = self.slot_key[at]
            hit = found == keys[left]
            out[left[hit]] = self.slot_rank[at[hit]]
            more = ~hit & (found >= 0)
            left, at = left[more], at[more]
        return out

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, where each word's ids begin) by rank-synchronous merging."""
        data = [w.encode("utf-8", "surrogateescape") for w in words]
        return self.merge_bytes(np.frombuffer(b"".join(data), np.uint8), np.fromiter(map(len, data), np.int64, len(data)))

    def merge_bytes(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`merge` of words that stand in a row as bytes."""
        counts = np.zeros(len(sizes), np.int64)
        sym = self.inner[raw]
        if self.suffix:
            ends = np.cumsum(sizes)[sizes > 0] - 1
            sym[ends] = self.last[raw[ends]]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        done_sym, done_owner = [], []
        rank = self._adjacent(sym, owner, np.arange(len(sym)))
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = np.minimum.reduceat(rank, starts)
            lens = np.diff(np.append(starts, len(sym)))
            ready = np.repeat(best == _NONE, lens)
            if ready.any():
                done_sym.append(sym[ready])
                done_owner.append(owner[ready])
                sym, owner, rank = sym[~ready], owner[~ready], rank[~ready]
                if not len(sym):
                    break
                going = best != _NONE
                best, lens = best[going], lens[going]
                starts = np.cumsum(lens) - lens
            low = np.repeat(best, lens)
            hits = np.flatnonzero(rank == low)
            fresh = np.concatenate([[True], np.diff(hits) != 1])  # begins a run of overlapping places (a a a)
            nth = np.arange(len(hits)) - np.maximum.accumulate(np.where(fresh, np.arange(len(hits)), 0))
            first = np.concatenate([[True], owner[hits[1:]] != owner[hits[:-1]]])
            hits = hits[np.where(self.at_once[low[hits]], nth % 2 == 0, first)]
            sym[hits] = self.made_by[rank[hits]]
            keep = np.ones(len(sym), bool)
            keep[hits + 1] = False
            moved = np.cumsum(keep) - 1
            sym, owner, rank = sym[keep], owner[keep], rank[keep]
            at = moved[hits]
            changed = np.zeros(len(sym), bool)
            changed[at] = True
            changed[np.maximum(at - 1, 0)] = True
            redo = np.flatnonzero(changed)
            rank[redo] = self._adjacent(sym, owner, redo)
        out, whose = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_sym, done_owner))
        order = np.argsort(whose, kind="stable")
        np.add.at(counts, whose, 1)
        return out[order], np.concatenate([[0], np.cumsum(counts)])

    def _adjacent(self, sym: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The rank of the pair that begins at each place; none at a sequence's end."""
        after = np.minimum(at + 1, max(len(sym) - 1, 0))
        ok = (after > at) & (owner[after] == owner[at])
        out = np.full(len(at), _NONE, np.int64)
        out[ok] = self.ranks(sym[at[ok]] * self.size + sym[after[ok]])
        return out


_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """The vocabulary of a file, read once in each worker."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def distinct(tokens: list[list[str]]) -> list[str]:
    """The distinct strings of several lists, in order of first sight."""
    return list(dict.fromkeys(chain.from_iterable(tokens)))
