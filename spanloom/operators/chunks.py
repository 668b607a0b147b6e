"""Documents cut into chunks with pages, sections and places."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PAGE = re.compile(r"<!--[^>]*PDF_PAGE:\s*(\d+)[^>]*-->")
_HEADING = re.compile(r"^#{1,6}\s+(.*)$")
_REFERENCES = re.compile(r"(?i)^#{1,6}\s*(references|bibliography)\b")
#: A heading or a marker line, or a paragraph up to a blank line, a heading or a marker.
_BLOCK = re.compile(r"(?m)^(?:#{1,6}\s|<!--)[^\n]*|[^\n]+(?:\n(?!\s*\n|#{1,6}\s|<!--)[^\n]+)*")
SCHEMA = "part int, page int, section string, start int, stop int"


def chunks_of(text: str, most: int) -> list[tuple[int, int, str, int, int]]:
    """(part, page, section, start, stop) of a text's chunks of at most ``most`` characters, whole paragraphs where they fit.

    Text from a references heading on is left out. A longer paragraph is cut at its last space before the limit.
    """
    out, page, section, begin, end = [], 1, "", None, 0

    def flush() -> None:
        nonlocal begin
        if begin is not None and text[begin:end].strip():
            out.append((len(out), page, section, begin, end))
        begin = None

    for m in _BLOCK.finditer(text):
        block = m[0]
        if _REFERENCES.match(block):
            break
        if marker := _PAGE.search(block):
            flush()
            page = int(marker[1])
        elif heading := _HEADING.match(block):
            flush()
            section = heading[1].strip()
        start, stop = m.span()
        if begin is not None and stop - begin > most:
            flush()
        if begin is None:
            begin = start
        while stop - begin > most:
            cut = text.rfind(" ", begin + 1, begin + most)
            end = cut if cut > begin else begin + most
            after = end
            flush()
            begin = after
        end = stop
    flush()
    return out


def chunk_documents(docs: DataFrame, key: str, text: str, most: int) -> DataFrame:
    """(key, part, page, section, start, stop) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *c) for i, t in enumerate(batch.column(1).to_pylist()) for c in chunks_of(t or "", most)]
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())), *[pa.array([r[k + 1] for r in rows], t) for k, t in enumerate(kinds)]], [key, "part", "page", "section", "start", "stop"])

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, {SCHEMA}")
