"""Operators 1 and 2 against the tokenizers library."""

import hashlib
import random
import sys
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from spanloom.llm import bpe, bpe_codec, token_counts

WORD, BYTE = bpe.tokenizer_path("word_bpe_49k.json"), bpe.tokenizer_path("byte_bpe_50k.json")


def texts() -> list[str]:
    rng = random.Random(4)
    out = ["", " ", "a" * 3000, "abab" * 400, "don't we'll I'M", "<|startoftext|>ab<|endoftext|> cd", "İstanbul ΣΑΣ ẞ ﬁ ①² ໐", "a\x1cb\x85c\xa0d", "é É Ａ", "💥💥 ok", "tab\t\n\n  x  "]
    out += ["".join(rng.choice("aab er tin.'s1 ") for _ in range(rng.randrange(80))) for _ in range(400)]
    out += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x800), rng.randrange(0x800, 0xD800), rng.randrange(0xE000, 0x11000)])) for _ in range(rng.randrange(40))) for _ in range(400)]
    return out


def test_counts_equal_the_library():
    library = Tokenizer.from_file(BYTE)
    got = token_counts._count(bpe.load(BYTE), texts(), {})
    assert got == [len(x.ids) for x in library.encode_batch(texts(), add_special_tokens=False)]


def lexicon_of(words, model, folder):
    path = folder / "lexicon"
    path.write_bytes(bpe_codec.compile_lexicon(words, model))
    return bpe_codec.Lexicon(str(path))


def test_codec_equals_the_library_with_and_without_a_lexicon(tmp_path):
    library, model = Tokenizer.from_file(WORD), bpe.load(WORD)
    for words in ([], ["don", "'t", "we", "ab", "cd", "aab", "tin"]):
        bpe_codec._REMEMBERED.clear()
        codec = bpe_codec.Codec(model, lexicon_of(words, model, tmp_path))
        for text, (n, ids, decoded) in zip(texts(), codec.encode(texts()), strict=True):
            own = library.encode(text, add_special_tokens=False).ids
            assert (n, ids) == (len(own), " ".join(map(str, own)))
            assert decoded == library.decode(own, skip_special_tokens=False)


def test_lexicon_is_minimal_and_exact(tmp_path):
    model = bpe.load(WORD)
    words = ["walking", "talking", "walked", "talked", "walk", "talk", "é"]
    lexicon = lexicon_of(words, model, tmp_path)
    found = lexicon.find([w.encode() for w in [*words, "wal", "walkings", ""]])
    assert sorted(found[:7]) == list(range(7)) and (found[7:] == -1).all()
    for w, k in zip(words, found, strict=False):
        assert lexicon.ids[lexicon.begins[k] : lexicon.begins[k + 1]].tolist() == model.merge([w])[0].tolist()
    # the root, w|t, alk..., and one state for each distinct set of endings
    assert len(lexicon.final) < sum(map(len, words)) // 2


def test_cut_equals_the_pre_tokens_of_each_text():
    model = bpe.load(WORD)
    some = ["x's' 's's ''s 'RE've'll'd'x 'é .'s", "1²3Ⅷ٣ a1b", "\u2028a\u3000b\x85c\x1cd", "é", *texts(), "", "a"]
    words, before = model.cut(some)
    for k, text in enumerate(some):
        want = []
        for i, part in enumerate(model.parts(text)):
            want += [" " + part] if i % 2 else model.pre_tokens(part)
        assert [w.decode() for w in words[int(before[k]) : int(before[k + 1])].to_pylist()] == want, text
    assert before[-1] == len(words) and len(model.cut([])[0]) == 0


def test_encoding_takes_no_step_for_each_word(tmp_path):
    model = bpe.load(WORD)
    codec, steps = bpe_codec.Codec(model, lexicon_of(["ab"], model, tmp_path)), Counter()
    rng = random.Random(7)
    text = " ".join("".join(rng.choices("abcdefgh", k=7)) + rng.choice([",", "."]) for _ in range(20_000))
    sys.setprofile(lambda frame, event, arg: steps.update([event]))
    try:
        (n, ids, decoded), = codec.encode([text])
    finally:
        sys.setprofile(None)
    assert ids.count(" ") + 1 == n and decoded.replace("</w>", "").replace(" ", "") == text.replace(" ", "")
    assert sum(steps.values()) < 10_000  # words differ; steps are those of the merger's rounds


@pytest.mark.parametrize("most", [0, 40])
def test_codec_is_exact_however_little_it_remembers(tmp_path, monkeypatch, most):
    monkeypatch.setattr(bpe_codec, "REMEMBERED", most)
    library, model = Tokenizer.from_file(WORD), bpe.load(WORD)
    bpe_codec._REMEMBERED.clear()
    codec = bpe_codec.Codec(model, lexicon_of(["ab", "tin"], model, tmp_path))
    for start in range(0, 800, 100):
        some = texts()[start : start + 100]
        assert [ids for _, ids, _ in codec.encode(some)] == [" ".join(map(str, library.encode(t, add_special_tokens=False).ids)) for t in some]
        assert len(codec.known[0]) == len(codec.known[1]) <= most
    bpe_codec._REMEMBERED.clear()


def test_word_counts_equal_the_pre_tokens(spark):
    model = bpe.load(WORD)
    want = Counter(w for t in texts() for part in model.parts(t)[::2] for w in model.pre_tokens(part) if len(w.encode()) <= bpe_codec.LEXICON_BYTES)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([*texts(), None])], "doc_id bigint, text string")
    assert {r["word"]: r["n"] for r in bpe_codec.word_counts(docs, WORD).collect()} == want


def test_merge_keeps_order_of_words():
    ids, begins = bpe.load(BYTE).merge(["", "b", "", "aaaa"])
    assert np.diff(begins).tolist()[0] == 0 and np.diff(begins).tolist()[2] == 0 and len(ids) == begins[-1]


def test_odd_rows(odd_docs, no_docs):
    counts = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.count_tokens(odd_docs, BYTE).collect())
    assert len(counts) == 9 and (1, 0, 0, False) in counts and (2, 0, 0, False) in counts and [c for c in counts if c[0] == 6][0][3]
    rows = bpe_codec.encode(odd_docs, WORD, with_ids=True).collect()
    assert len(rows) == 9
    empty = next(r for r in rows if r["doc_id"] == 1)
    assert (empty["n_tokens"], empty["ids_sha256"]) == (0, hashlib.sha256(b"").hexdigest())
    back = {r["doc_id"]: r["decoded"] for r in bpe_codec.decode(bpe_codec.encode(odd_docs.where("doc_id = 5"), WORD, [], with_ids=True), WORD).collect()}
    assert back[5].startswith("le</w> chat</w>")
    assert bpe_codec.encode(no_docs, WORD).count() == 0 and token_counts.count_tokens(no_docs, BYTE).count() == 0


def test_tokens_stand_beside_all_columns(spark, odd_docs):
    docs = odd_docs.selectExpr("*", "7 as ids")
    rows = bpe_codec.with_tokens(docs, WORD, ["cat"]).collect()
    assert list(rows[0].asDict()) == [*docs.columns, "n_tokens", "ids_sha256", "decoded_sha256", "ids_"] and len(rows) == 9
    library = Tokenizer.from_file(WORD)
    for r in rows:
        assert r["ids_"] == library.encode(r["text"] or "", add_special_tokens=False).ids and r["n_tokens"] == len(r["ids_"]) and r["ids"] == 7


@pytest.mark.parametrize("most", [1, 3])
def test_frequent_words_keep_ties_together(spark, most):
    docs = spark.createDataFrame([(1, "b b b a a c c"), (2, "b")], "doc_id bigint, text string")
    assert bpe_codec.frequent_words(docs, WORD, most) == (["b"] if most == 1 else ["a", "b", "c"])
