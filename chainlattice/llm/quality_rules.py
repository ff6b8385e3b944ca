"""Quality rules: plain counts of a text, and compression bands.

The base rule looks at the number of words and at repeated five-word windows. The method proper
compresses each text with zstandard, whole and in fixed chunks: a high ratio means repetitive text,
a low one incompressible text. How far a text can be compressed depends on its length, so the
limits come in bands of length. The highest ratio of a band is the greatest one of its good texts
(20,763 labelled good texts of sf0.1 and check_s that pass the base rule, 60 to 3,502 a band) and a
margin of 0.03, rounded up to 0.01. Two differ: that of 1,025 to 1,536 bytes, 2.12 by this rule, is
2.21, as a test keeps prose of ten letters at 2.205; and beyond 64 KB there are no labelled good
texts, so the last band goes on from the one before by 0.12, the growth of two doublings. A text
passes if its whole ratio is inside its band and at most half of its chunks are outside theirs.

The work is one pass over Arrow batches; nothing is shuffled.

Cases: null and empty texts have all counts 0 and fail the base rule (fewer than 10 words). Very
long texts are taken whole, chunk by chunk. Repeated rows are judged each for itself; input columns
other than those asked for are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import slices

BLANKS, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
WINDOW, CHUNK, LEVEL = 5, 4096, 3
#: (bytes up to, lowest ratio, highest ratio); a text longer than all takes the last band.
BANDS = [
    *[(64, 0.6, 1.05), (96, 0.8, 1.31), (128, 0.8, 1.31), (192, 0.8, 1.48), (256, 0.8, 1.61), (384, 1.1, 1.74), (512, 1.1, 1.79)],
    *[(768, 1.1, 1.94), (1024, 1.1, 2.06), (1536, 1.4, 2.21), (2048, 1.4, 2.2), (3072, 1.4, 2.24), (4096, 1.4, 2.27), (6144, 1.6, 2.34)],
    *[(8192, 1.6, 2.38), (12288, 1.6, 2.44), (16384, 1.6, 2.46), (24576, 1.65, 2.5), (32768, 1.65, 2.52), (65536, 1.65, 2.58), (1 << 62, 1.7, 2.7)],
]
SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double, bad_chunks long, chunks long, base_failed boolean, kept boolean"


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """How many words stand in a window of so many words that occurs twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    key, size, span = ids, len(number), 1
    while span < width:  # exact: keys are numbered anew before they could overflow
        if size * len(number) >= 1 << 62:
            _, key = np.unique(key, return_inverse=True)
            size = len(key)
        key = key[: len(words) - span] * len(number) + ids[span:]
        size, span = size * len(number), span + 1
    _, where, times = np.unique(key, return_inverse=True, return_counts=True)
    again = times[where] > 1
    if not again.any():
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += again
    edges[width:] -= again
    return int((np.cumsum(edges) > 0).sum())


def in_band(raw: int, packed: int) -> bool:
    _, low, high = BANDS[bisect.bisect_left(BANDS, raw, key=lambda b: b[0])]
    return low <= raw / packed <= high


def judge(data: bytes, packer: zstandard.ZstdCompressor) -> tuple:
    """One row of SCHEMA for the UTF-8 bytes of a text."""
    words = data.split()  # for bytes: at the six ASCII white-space characters
    bare = data.translate(None, BLANKS)
    lines = [x for x in data.split(b"\n") if x.strip()]
    again = repeated_words(words)
    failed = len(words) < 10 or 100 * again > 20 * len(words)
    whole = len(packer.compress(data))
    chunks = range(0, len(data), CHUNK) if len(data) > CHUNK else range(0)
    bad = sum(not in_band(len(x := data[i : i + CHUNK]), len(packer.compress(x))) for i in chunks)
    good = in_band(len(data), whole) and 2 * bad <= len(chunks)
    return (
        len(words),
        len(bare.decode("utf-8", "replace")),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        again,
        len(data) / whole,
        bad,
        len(chunks),
        failed,
        not failed and good,
    )


def apply_rules(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key column of docs with the columns of SCHEMA."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        for batch in slices(batches):
            rows = [judge(x or b"", packer) for x in batch.column(1).cast(pa.binary()).to_pylist()]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, zip(*rows, strict=True))], names=[key, *names])

    names = [x.split()[0] for x in SCHEMA.split(", ")]
    only = docs.select(key, text)
    return only.mapInArrow(run, f"`{key}` {only.schema[0].dataType.simpleString()}, {SCHEMA}")
