"""Operators 4 and 10."""

import base64
import bz2
import gzip
import lzma
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from spanloom.llm import language_id, secret_scan

KEY = "AKIA" + "Z7Q" * 5 + "A"


def plain(text: str) -> list[tuple[int, str, int]]:
    """The base spans straight from their definition."""
    low = [("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+")]
    out = []
    for k, (name, pattern) in enumerate(low):
        for m in re.finditer(pattern, text):
            if (len(m[1]) >= 8) if name == "assign" else len(m[0]) >= (16 if name == "access" else 32):
                out.append((m.start(), k, m.end()))
    return sorted(out)


@pytest.mark.parametrize(
    "text",
    ["", "token = abc", 'PassWord: "abcdefgh12"', f"x {KEY} y", "f" * 40, "é token='a1b2c3d4e5'", "password: token: abcdefghij", "secret=secret=abcdefgh1", "AKIAAKIA12345678", "api_key=12345678 apikey:abcdefgh", "toKen=abcdefgh", "ſecret=abcdefgh"],
)
def test_base_spans(text):
    assert secret_scan.find(text)[0] == plain(text)


def wrap(kind: str, text: str) -> str:
    return {
        "percent": lambda: "".join(f"%{b:02x}" for b in text.encode()),
        "unicode": lambda: "".join(f"\\u{ord(c):04x}" for c in text),
        "base64": lambda: base64.b64encode(text.encode()).decode(),
        "urlsafe": lambda: base64.urlsafe_b64encode(text.encode()).decode().rstrip("="),
        "gzip": lambda: base64.b64encode(gzip.compress(text.encode())).decode(),
        "zlib": lambda: base64.b64encode(zlib.compress(text.encode())).decode(),
        "hex": lambda: text.encode().hex(),
    }[kind]()


@pytest.mark.parametrize("kinds", [["percent"], ["unicode"], ["base64"], ["urlsafe"], ["gzip"], ["zlib"], ["hex"], ["percent", "percent"], ["base64", "percent"], ["gzip", "base64", "unicode"]])
def test_nested_layers_map_to_the_document(kinds):
    inner = f"key {KEY} end"
    for kind in kinds:
        inner = wrap(kind, inner)
    text = f"see {inner} there"
    base, every = secret_scan.find(text)
    found = [(a, b) for a, k, b in every if k == 1]
    assert found and all(4 <= a < b <= 4 + len(inner) for a, b in found) and set(base) <= set(every)
    assert KEY not in secret_scan.redact(text, every)


def test_escapes_map_to_their_characters():
    text = "x pass%77ord=abcdefgh1 y"
    assert secret_scan.find(text)[1] == [(2, 0, 22)] and text[2:22] == "pass%77ord=abcdefgh1"


def escaped(text: str) -> str:
    return "".join(f"%{b:02x}" for b in text.encode())


@pytest.mark.parametrize(
    "text",
    [
        "see\n" + base64.encodebytes(f"{'some words before ' * 5}key {KEY} and {'more words ' * 9}".encode()).decode() + "end",
        "see\r\n" + base64.encodebytes(f"{'some words before ' * 5}key {KEY}".encode()).decode().replace("\n", "\r\n") + "end of it",
        "path/" + wrap("base64", f"key {KEY}"),
        "id_" + wrap("urlsafe", f"key {KEY}"),
        "a/b-" + wrap("base64", f"key {KEY}") + "/more",
        "%ff" + escaped(f"key {KEY}") + "%80",
        "\\ud800" + wrap("unicode", f"key {KEY}"),
        "".join(f"\\u{{{ord(c):x}}}" for c in f"key {KEY}"),
        base64.b64encode(b"\x01\x00" + f"key {KEY}".encode() + b"\x00").decode(),
        base64.b64encode(b"\xff\xfe" + f"key {KEY}".encode()).decode(),
        "f" + f"key {KEY}".encode().hex(),
    ],
)
def test_layers_among_other_bytes(text):
    assert places(text) and KEY not in secret_scan.redact(text, secret_scan.find(text)[1])


def test_the_shortest_secret_in_hex():
    run = b"token=abcdefgh".hex()
    assert len(run) == 28 and places(f"x {run}.", 0) == [run]


def test_cycles_and_bombs_end():
    assert secret_scan.find("%25" * 2000)[1] == []
    bomb = base64.b64encode(zlib.compress(b"a" * (80 << 20))).decode()
    assert secret_scan.find(bomb)[0] == plain(bomb)


def places(text: str, wanted: int = 1) -> list[str]:
    return [text[a:b] for a, k, b in secret_scan.find(text)[1] if k == wanted]


def test_long_texts_are_unwrapped_whole():
    inner = wrap("base64", f"key {KEY}")
    text = "%41 \\u0041\n" + "\n" * (35 << 20) + wrap("percent", wrap("unicode", inner)) + f"\n{inner}"
    assert places(text) == [wrap("percent", wrap("unicode", inner)), inner]


def test_runs_that_open_to_much_hide_nothing():
    filler = b"\n" * (65 << 20)
    run, clean = (base64.b64encode(gzip.compress(filler + x.encode(), 1)).decode() for x in (f"key {KEY}", "key"))
    later = wrap("base64", f"key {KEY}")
    assert places(f"{run}\n{later}") == [run, later] and places(f"{clean}\n{later}") == [later]


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress])
def test_every_member_is_opened(pack):
    run = base64.b64encode(pack(b"nothing here, ") + pack(f"key {KEY}".encode())).decode()
    assert places(f"see {run}") == [run]


def test_pieces_end_between_stretches(monkeypatch):
    monkeypatch.setattr(secret_scan, "CHUNK", 7)
    monkeypatch.setattr(secret_scan, "HELD", 9)
    text = f"é😀é😀, password: token: abcdefghij, {wrap('gzip', 'é' * 30 + KEY)}, é"
    run = wrap("gzip", wrap("gzip", text))
    assert secret_scan.find(text)[1] and secret_scan.find(run)[1] == [(0, 1, len(run))]


def test_scan_of_odd_rows(odd_docs, no_docs):
    rows = secret_scan.scan(odd_docs).collect()
    assert len(rows) == 9 and all(r["spans"] == "" for r in rows) and secret_scan.scan(no_docs).count() == 0
    out = secret_scan.redacted(odd_docs)
    assert out.columns == odd_docs.columns and sorted(map(str, out.collect())) == sorted(map(str, odd_docs.collect()))


def plain_grams(text):
    """Counts of the n-grams of a text, which sort as their letters do, shorter ones first."""
    counts: Counter = Counter()
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    for word in words:
        padded = f"\x01{word}\x01"
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if gram != "\x01":
                    counts[(n, gram)] += 1
    return counts


def ranking(counts):
    return {g: r for r, (g, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: language_id.RANKS])}


def plain_language(text, profiles):
    """Rank-order profiles in plain Python."""
    order, most = ranking(plain_grams(text)), language_id.RANKS
    if not order:
        return "und", 0.0
    far = {lang: sum(abs(p[g] - r) if g in p else most for g, r in order.items()) for lang, p in profiles.items()}
    best = min(sorted(far), key=far.get)
    return best, 1 - far[best] / (len(order) * most)


def test_languages_equal_a_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows, learned = docs.select("doc_id", "text", "lang").collect(), defaultdict(Counter)
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["lang"] is not None:
            learned[r["lang"]] += plain_grams(r["text"])
    profiles = {lang: ranking(counts) for lang, counts in learned.items()}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.op10_language_id(spark, sf).collect()}
    for r in rows:
        lang, score = plain_language(r["text"], profiles)
        assert got[r["doc_id"]] == (lang, pytest.approx(score))
    assert sum(got[r["doc_id"]][0] == r["lang"] for r in rows) / len(rows) > 0.95


def test_letters_of_all_planes_are_told_apart():
    texts = pa.array([chr(0x20000) * 3, chr(0x21900) * 3, "ab", ""] * 600)
    whose, grams, _, _ = language_id.ranked_grams(texts)
    of = [set(grams[whose == i].tolist()) for i in range(len(texts))]
    assert not of[0] & of[1] and len(of[0]) == 7 and of[0] == of[2396] and of[3] == set() and len(of[2]) == 7


def test_language_of_odd_rows(odd_docs, no_docs):
    profiles = language_id.learn_profiles(odd_docs)
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(odd_docs, profiles).collect()}
    assert got[1] == got[2] == got[4] == "und" and got[0] == "en" and got[5] == "fr"
    kept = language_id.reject_unknown(odd_docs, profiles)
    assert kept.columns == odd_docs.columns and kept.count() == 6
    assert language_id.learn_profiles(no_docs) == {} and language_id.identify(no_docs, {}).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(odd_docs, {}).collect()} == {"und"}
