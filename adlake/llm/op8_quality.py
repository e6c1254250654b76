"""Quality rules by compression bands.

The zstandard ratio (bytes / compressed bytes) of the whole document and of
every fixed chunk is held against limits for its length: a ratio above the band
is repetitive text, below it incompressible text.  Short texts compress little
and long ones more, so each length has a band of its own; scripts of two or
three bytes a letter compress more per byte, so the greatest ratio grows with
the square root of the bytes per code point.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from adlake.llm.tokens import WORD_BYTES, column_bytes, pieces, window_hashes, word_hashes, words

LEVEL = 3
CHUNK_BYTES = 4096
MIN_CHUNK_BYTES = 1024  # a shorter last chunk belongs to the one before it
MAX_BAD_CHUNKS = 0.25  # share of chunks out of their band
STREAM_BYTES = 8 << 20  # longer texts are compressed as a stream
#: (bytes up to, least ratio, greatest ratio at a byte a code point); the last holds for all longer texts.
#: The greatest are above the 99th percentile of slices of that length of license texts and perldiag.pod
#: (README), with room for longer and plainer prose; text that repeats itself reaches 10 and more.
BANDS = (
    (256, 0.0, 3.0), (400, 1.05, 3.2), (800, 1.2, 3.5), (1600, 1.35, 4.0), (3200, 1.45, 4.5), (6400, 1.55, 5.0),
    (12800, 1.6, 5.2), (25600, 1.65, 5.5), (51200, 1.65, 5.8), (1 << 62, 1.65, 6.0))
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long")
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_CODE_POINT = (np.arange(256) & 0xC0) != 0x80
_BLANK = b" \t\n\x0b\x0c\r"


def compressed_bytes(packer: zstandard.ZstdCompressor, text: memoryview) -> int:
    if len(text) <= STREAM_BYTES:
        return len(packer.compress(text))
    stream, total = packer.compressobj(), 0
    for at in range(0, len(text), 1 << 20):
        total += len(stream.compress(text[at : at + (1 << 20)]))
    return total + len(stream.flush())


def in_band(size: int, points: int, packed: int, bands=BANDS) -> bool:
    """Whether `size` bytes of `points` code points may pack to `packed` bytes."""
    least, most = next((lo, hi) for upto, lo, hi in bands if size <= upto)
    return least * packed <= size <= most * math.sqrt(size / max(points, 1)) * packed


def _repeat_words(windows: np.ndarray) -> int:
    """Words in 3-word windows that occur twice or more."""
    if len(windows) < 2:
        return 0
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    hit = np.zeros(len(windows) + 2, dtype=bool)
    at = np.flatnonzero(np.isin(windows, twice))
    for j in range(3):
        hit[at + j] = True
    return int(hit.sum())


def _dup_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    n = 0
    for line in text.split(b"\n"):
        if line.strip(_BLANK):
            n += line in seen
            seen.add(line)
    return n


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(flags)
    return np.diff(np.searchsorted(at, offsets))


def measure(col: pa.Array, bands=BANDS) -> pa.Array:
    """The measures of each text of a column as a struct array."""
    raw, offsets = column_bytes(col)
    packer = zstandard.ZstdCompressor(level=LEVEL)
    rows = []
    for first, last in pieces(offsets):
        data = raw[offsets[first] : offsets[last]]
        own = offsets[first : last + 1] - offsets[first]
        starts, ends, of = words(data, own, "space")
        hashed = word_hashes(data, starts, ends, lower=False)
        windows = window_hashes(hashed, 3)
        inside = WORD_BYTES["space"][data]
        point = _CODE_POINT[data]
        chars = _sums(inside & point, own)
        symbols = _sums(_SYMBOLS[data], own)
        view = memoryview(data)
        for row in range(last - first):
            a, b = int(of[row]), int(of[row + 1])
            text, first_byte = view[own[row] : own[row + 1]], point[own[row] : own[row + 1]]
            n = b - a
            repeats = _repeat_words(windows[a : b - 2]) if n >= 3 else 0
            failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
            packed = compressed_bytes(packer, text) if len(text) else 0
            cuts = list(range(0, len(text), CHUNK_BYTES))
            if len(cuts) > 1 and len(text) - cuts[-1] < MIN_CHUNK_BYTES:
                cuts.pop()
            spans = list(zip(cuts, [*cuts[1:], len(text)]))
            whole = in_band(len(text), int(np.count_nonzero(first_byte)), packed, bands)
            bad = 0
            if len(spans) == 1:
                bad = int(not whole)
            else:
                bad = sum(not in_band(q - p, int(np.count_nonzero(first_byte[p:q])), len(packer.compress(text[p:q])), bands) for p, q in spans)
            good = bool(len(text)) and whole and bad <= MAX_BAD_CHUNKS * len(spans)
            rows.append((n, int(chars[row]), int(symbols[row]), _dup_lines(text.tobytes()), repeats, failed,
                         good and not failed, len(text) / packed if packed else None, len(spans), bad))
    names = [f.split()[0] for f in MEASURES.split(", ")]
    kinds = [{"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}[f.split()[1]] for f in MEASURES.split(", ")]
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.StructArray.from_arrays(columns, names=names)


def measures(text: Column) -> Column:
    """Struct of MEASURES of a text column."""

    @arrow_udf(MEASURES)
    def run(col: pa.Array) -> pa.Array:
        return measure(col)

    return run(text)


def quality(docs: DataFrame) -> DataFrame:
    """doc_id and MEASURES of every row of `docs`.

    Null and empty texts have no words, so they fail the base rule; their ratio
    is null.  Repeated rows are judged alike.  Other columns are not read; a
    text is judged whole, whatever its length."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), measures(F.col("text").cast("string")).alias("_m")).select("doc_id", "_m.*")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, all columns as they are."""
    return docs.where(measures(F.col("text").cast("string"))["kept"])
