"""Secret scan by a recursive decoding worklist (operator 4).

Each text is a first layer. A layer is scanned for secrets, then unwrapped: percent escapes and Unicode escapes
give one new layer each, every base64 or hexadecimal run gives one more, which is decompressed first where it is
compressed. Base64 may be broken over lines, or follow a ``/``, ``_`` or ``-`` of other text. Bytes and escapes that
are no text stay as they stand and hide nothing of what is around them. New layers go to the worklist until none is left; a layer whose text was seen before in its place is not
taken again, and data that lies within itself is not opened again, which ends cycles. Spans found in a layer are
mapped back, layer by layer, to code points of the document: through an escape to its own characters, through an
encoded run to the whole run.

No match, escape or run on one line crosses a character outside STRETCH, so each stretch of such characters is unwrapped by
itself; the layers of a text with few escapes cost their stretches, not the text. All that a run holds maps to the
whole run, so that of its data only the kinds found are kept: what is compressed is read as a stream, member after
member, in pieces of CHUNK bytes that end between stretches, and is never held whole beyond HELD bytes.

Nothing is left out for its size. Time grows with all that a document unpacks to, and in one stretch with its length
times the depth of its escapes; memory with the longest stretch and, for data in data, with the depth. Beginnings of base64 within a run are tried only
where the first bytes look like text or compressed data.

Defined cases: null and empty texts have no spans; repeated rows each give a row; an empty table gives no rows;
other columns are ignored. Compressed data that breaks off is read as far as it goes; damaged data is not opened,
but what stands before a damaged further member is. Bytes after the last member are not read.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import column, filled, free_name, pick, slices, with_column_of

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Without one of these in the lower-cased text, ASSIGN cannot match.
ASSIGN_WORDS = ("passw", "secret", "token", "api")
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
#: Base64 that is broken over lines of one length, as mail and key files do after 76 or 64 characters.
LINES64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{60,80}\r?\n)+[A-Za-z0-9+/_-]+={0,2}")
#: Where base64 may begin within a run.
PARTED = re.compile(r"[+/_-](?=[A-Za-z0-9+/_-]{16})")
#: The shortest secret has 14 bytes.
HEX_RUN = re.compile(r"[0-9A-Fa-f]{28,}")
#: Every character that a match of the patterns above may hold.
STRETCH = re.compile(r"""[A-Za-z0-9+/_.=\-"'\x20:%\\&#;{}]{3,}""")
_STRETCH_CHARS = "".join(c for c in map(chr, range(128)) if STRETCH.fullmatch(3 * c))
#: Without one of these, a stretch has nothing to unwrap.
WRAPPED = re.compile(r"%[0-9A-Fa-f]{2}|\\[ux]|&#|[A-Za-z0-9+/_-]{16}")
CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
#: Bytes that one step of decompression gives, and bytes of opened data that are kept for the next reading.
CHUNK, HELD = 1 << 20, 16 << 20
_DAMAGED = (zlib.error, OSError, lzma.LZMAError, EOFError)
SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"

Span = tuple[int, int, int]  # start, place in KINDS, end
Mapping = Callable[[int, int], tuple[int, int]]
Source = Callable[[], Iterator[bytes]]  # reads data from its beginning, each time anew
Task = Generator["Task", set, set]


def base_spans(text: str) -> list[Span]:
    """The spans of one layer, ordered by start, then kind."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _unescaped(text: str, pattern: re.Pattern, meaning: Callable[[str], list[tuple[str, int]] | None]) -> tuple[str, Mapping] | None:
    """The text with its escapes replaced. meaning: of a match, its characters with the source length of each."""
    parts, begin, source = [], [], []  # pieces of the new text: where each begins there and in the source
    ends: list[int] = []  # of an escape the source end, of plain text -1
    at = size = 0

    def add(piece: str, start: int, end: int) -> None:
        nonlocal size
        if piece:
            parts.append(piece)
            begin.append(size)
            source.append(start)
            ends.append(end)
            size += len(piece)

    changed = False
    for m in pattern.finditer(text):
        chars = meaning(m[0])
        if chars is None:
            continue
        changed = True
        add(text[at : m.start()], at, -1)
        at = m.start()
        for c, n in chars:
            add(c, at, at + n)
            at += n
    if not changed:
        return None
    add(text[at:], at, -1)

    def back(start: int, end: int) -> tuple[int, int]:
        a, b = bisect_right(begin, start) - 1, bisect_right(begin, end - 1) - 1
        return source[a] + (start - begin[a] if ends[a] < 0 else 0), ends[b] if ends[b] >= 0 else source[b] + end - begin[b]

    return "".join(parts), back


def _percent(run: str) -> list[tuple[str, int]]:
    out, at = [], 0
    for c in bytes.fromhex(run.replace("%", "")).decode(errors="surrogateescape"):
        if 0xDC80 <= ord(c) < 0xDD00:  # a byte that is no text keeps its escape
            out += [(x, 1) for x in run[at : at + 3]]
            at += 3
        else:
            out.append((c, 3 * len(c.encode())))
            at += out[-1][1]
    return out


def _escape(run: str) -> list[tuple[str, int]] | None:
    if run[0] == "&":
        n = int(run[3:-1], 16) if run[2] in "xX" else int(run[2:-1])
        return [(chr(n), len(run))] if n < 0x110000 and not 0xD800 <= n < 0xE000 else None
    if run[1] == "x":
        return [(chr(int(run[2:], 16)), 4)]
    if run[2] == "{":
        n = int(run[3:-1], 16)
        return [(chr(n), len(run))] if n < 0x110000 and not 0xD800 <= n < 0xE000 else None
    out, at = [], 0
    for c in b"".join(int(x, 16).to_bytes(2, "big") for x in run.split("\\u")[1:]).decode("utf-16-be", "surrogatepass"):
        n = 12 if ord(c) > 0xFFFF else 6
        out += [(x, 1) for x in run[at : at + n]] if 0xD800 <= ord(c) < 0xE000 else [(c, n)]
        at += n
    return out


def _opener(head: bytes) -> Callable | None:
    """What makes a decompressor of data that begins so."""
    if head[:2] == b"\x1f\x8b" or head[:1] == b"\x78":
        return partial(zlib.decompressobj, 47)
    return bz2.BZ2Decompressor if head[:3] == b"BZh" else lzma.LZMADecompressor if head[:6] == b"\xfd7zXZ\0" else None


def _members(source: Source, opener: Callable) -> Iterator[bytes]:
    """The opened data, one member after another. Damage in the first member is an error, later it is the end."""
    chunks, first = source(), True
    data, kind = next(chunks, b""), opener()
    while True:
        try:
            opened = kind.decompress(data, CHUNK)
        except _DAMAGED:
            if first:
                raise
            return
        if opened:
            yield opened
        if kind.eof:
            data = kind.unused_data
            while len(data) < 6 and (more := next(chunks, b"")):
                data += more
            if (opener := _opener(data[:6])) is None:
                return
            kind, first = opener(), False
            continue
        data = getattr(kind, "unconsumed_tail", b"")
        if not data and not opened and not (data := next(chunks, b"")):
            return


@dataclass
class Look:
    """What one reading of data tells: its first bytes, mark, whether to scan it as text, and how to read it again."""

    head: bytes
    mark: bytes
    text: bool
    source: Source


def _look(source: Source) -> Look:
    head, size, text, kept = b"", 0, True, []
    digest, decoder = hashlib.blake2b(digest_size=16), codecs.getincrementaldecoder("utf-8")()
    for chunk in source():
        head += chunk[: 6 - len(head)]
        size += len(chunk)
        digest.update(chunk)
        kept = [*kept, chunk] if kept is not None and size <= HELD else None
        text = text and _is_text(decoder, chunk)
    text = size > 0 and (not _opener(head) or text and _is_text(decoder, b"", True))
    return Look(head, digest.digest(), text, source if kept is None else partial(_once, b"".join(kept)))


def _once(data: bytes) -> Iterator[bytes]:
    yield data


def _is_text(decoder: codecs.IncrementalDecoder, data: bytes, final: bool = False) -> bool:
    try:
        decoder.decode(data, final)
    except UnicodeDecodeError:
        return False
    return True


def _decode64(run: str) -> bytes:
    """The bytes of base64 in either alphabet; a last character that completes no byte is left."""
    run = run[:-1] if len(run) % 4 == 1 else run
    return base64.b64decode(run.translate({0x2D: 0x2B, 0x5F: 0x2F}) + "=" * (-len(run) % 4))


def _begins_data(run: str) -> bool:
    """Do the run's first bytes look like text or like compressed data?"""
    head = _decode64(run[:24])
    decoder = codecs.getincrementaldecoder("utf-8")()
    return bool(_opener(head[:6])) or _is_text(decoder, head) and not CONTROL.search(head.decode(errors="ignore"))


def _runs(text: str) -> Iterator[tuple[bytes, tuple[int, int]]]:
    """The bytes of the encoded runs, each with its place."""
    for m in BASE64.finditer(text):
        run = m[0].rstrip("=")
        yield _decode64(run), m.span()
        for cut in PARTED.finditer(run):
            if _begins_data(run[cut.end() : cut.end() + 24]):
                yield _decode64(run[cut.end() :]), (m.start() + cut.end(), m.end())
    yield from _broken_runs(text)
    for m in HEX_RUN.finditer(text):
        for odd in range(1 + len(m[0]) % 2):
            at, stop = m.start() + odd, m.end() - (len(m[0]) - odd) % 2
            yield bytes.fromhex(text[at:stop]), (at, stop)


def _broken_runs(text: str) -> Iterator[tuple[bytes, tuple[int, int]]]:
    """The bytes of base64 that is broken over lines, with its place."""
    if "\n" in text:
        for m in LINES64.finditer(text):
            lines = m[0].rstrip("=").split()
            if len({len(x) for x in lines[:-1]}) == 1 and len(lines[-1]) <= len(lines[0]):
                yield _decode64("".join(lines)), m.span()


def _mapped(maps: list[Mapping], start: int, end: int) -> tuple[int, int]:
    for back in maps:
        start, end = back(start, end)
    return start, end


def _stretches(text: str) -> Iterator[tuple[int, int]]:
    """Where the text has stretches with something to unwrap."""
    if WRAPPED.search(text):
        for m in STRETCH.finditer(text):
            if WRAPPED.search(text, *m.span()):
                yield m.span()


def _below(text: str, above: set[bytes]) -> Task:
    """The spans of a stretch and of all layers below it. above: marks of the data that the stretch lies in."""
    out: set[Span] = set()
    work: list[tuple[str, list[Mapping]]] = [(text, [])]  # with the mappings back to the stretch, innermost first
    seen, opened = {_mark(text)}, set()  # data may come again elsewhere in the stretch, not in the same place
    while work:
        layer, maps = work.pop()
        for start, kind, end in base_spans(layer):
            start, end = _mapped(maps, start, end)
            out.add((start, kind, end))
        for data, where in _runs(layer):
            start, end = _mapped(maps, *where)
            key = (hashlib.blake2b(data, digest_size=16).digest(), start, end)
            if key not in opened:
                opened.add(key)
                out.update((start, kind, end) for kind in (yield _held(data, above)))
        for there, pattern, meaning in (("%" in layer, PERCENT, _percent), ("\\" in layer or "&#" in layer, ESCAPE, _escape)):
            if there and (x := _unescaped(layer, pattern, meaning)) and (key := _mark(x[0])) not in seen:
                seen.add(key)
                work.append((x[0], [x[1], *maps]))
    return out


def _held(data: bytes, above: set[bytes]) -> Task:
    """The kinds of secrets that the data of a run holds, as text or compressed, in any layer."""
    kinds: set[int] = set()
    own: set[bytes] = set()
    look: Look | None = _look(partial(_once, data))
    while look and look.mark not in above:
        above.add(look.mark)
        own.add(look.mark)
        if look.text:
            decoder, kept = codecs.getincrementaldecoder("utf-8")("replace"), []
            for chunk in look.source():
                piece = decoder.decode(chunk)
                cut = len(piece.rstrip(_STRETCH_CHARS + "\r\n"))
                if cut:
                    kinds |= yield _kinds("".join([*kept, piece[:cut]]), above)
                    kept = []
                kept.append(piece[cut:])
                if len(kinds) == len(KINDS):
                    break
            else:
                kinds |= yield _kinds("".join(kept), above)
        opener = _opener(look.head)
        try:
            look = _look(partial(_members, look.source, opener)) if opener and len(kinds) < len(KINDS) else None
        except _DAMAGED:
            look = None
    above -= own
    return kinds


def _kinds(text: str, above: set[bytes]) -> Task:
    """The kinds of secrets in a text and all layers below it."""
    kinds = {kind for _, kind, _ in base_spans(text)}
    for start, end in _stretches(text):
        if len(kinds) == len(KINDS):
            break
        kinds |= {kind for _, kind, _ in (yield _below(text[start:end], above))}
    for data, _ in _broken_runs(text):
        kinds |= yield _held(data, above)
    return kinds


def _done(task: Task) -> set:
    """What a task returns. Tasks yield tasks and get their results, so that depth is not Python's."""
    stack, value = [task], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as e:
            stack.pop()
            value = e.value
    return value


def _mark(text: str) -> bytes:
    return hashlib.blake2b(text.encode(errors="surrogatepass"), digest_size=16).digest()


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a text, in code points of the text."""
    text = text or ""
    base = base_spans(text)
    every = set(base)
    for at, stop in _stretches(text):
        every.update((at + start, kind, at + end) for start, kind, end in _done(_below(text[at:stop], set())))
    for data, (start, end) in _broken_runs(text):
        every.update((start, kind, end) for kind in _done(_held(data, set())))
    return base, sorted(every)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str, spans: list[Span], mask: str = "[SECRET]") -> str:
    """The text with each stretch that spans cover replaced by the mask."""
    out, at = [], 0
    for a, _, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mask]
        at = b
    return "".join(out) + text[at:]


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [find(x) for x in filled(part).to_pylist()]
                counts = [pa.array([sum(s[1] == k for s in base) for base, _ in found], pa.int64()) for k in range(3)]
                hashes = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
                out = [column(part, "doc_id"), *counts, pa.array(hashes, pa.string()), pa.array([joined(every) for _, every in found], pa.string())]
                yield pa.RecordBatch.from_arrays(out, [c.split()[0] for c in SCHEMA.split(", ")])

    return pick(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every secret masked, and n_chars, where there is one, counted anew; other columns stay."""
    name = free_name(docs, "redacted")

    def make(part: pa.RecordBatch, _) -> pa.Array:
        texts = column(part, "text").to_pylist()
        return pa.array([t if t is None else redact(t, find(t)[1]) for t in texts], pa.string())

    out = with_column_of(docs, name, "string", make)
    changed = {"text": F.col(name)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("text").eqNullSafe(F.col(name)), F.col("n_chars")).otherwise(F.length(name)).cast(docs.schema["n_chars"].dataType)
    return out.withColumns(changed).select(*[f"`{c}`" for c in docs.columns])


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
