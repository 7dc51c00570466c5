"""Quality rules: compression bands.

The zstandard ratio of a text (bytes divided by compressed bytes) is high for
repetitive text and low for incompressible text. Both limits depend on the
length, since short inputs carry the frame's overhead and long ones give the
compressor more to refer back to. The same limits are applied to fixed chunks,
so a long text can't hide a stretch of noise or repetition behind its average.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from tidemark.llm.runtime import utf8

WHITE_SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
WINDOW = 3


@dataclass(frozen=True)
class Bands:
    """``limits``: (bytes up to which it holds, least ratio, greatest ratio), by length.

    A chunk shorter than ``least_chunk`` isn't judged. A text falls if its own
    ratio lies outside, or more than ``bad_share`` of its chunks.
    """

    limits: tuple = (
        (256, 0.50, 2.60),
        (1_024, 1.10, 2.90),
        (4_096, 1.30, 3.20),
        (16_384, 1.40, 3.60),
        (65_536, 1.45, 4.00),
        (float("inf"), 1.50, 4.50),
    )
    chunk: int = 4_096
    least_chunk: int = 512
    bad_share: float = 0.25
    level: int = 3

    def of(self, size: int) -> tuple[float, float]:
        return next((low, high) for most, low, high in self.limits if size <= most)


RESULT = pa.struct(
    [
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("n_bytes", pa.int64()),
        ("ratio", pa.float64()),
        ("n_chunks", pa.int64()),
        ("n_bad_chunks", pa.int64()),
        ("base_failed", pa.bool_()),
        ("band_failed", pa.bool_()),
        ("kept", pa.bool_()),
    ]
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    codes: dict[bytes, int] = {}
    code = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, n)
    size = len(codes)
    pairs = code[:-1] * size + code[1:]
    if size >= 1 << 20:  # three codes would not fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * size + code[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(len(windows), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(WINDOW):
        covered[shift : shift + len(windows)] |= again
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    found = 0
    for line in text.split(b"\n"):
        if line.strip(WHITE_SPACE):
            found += line in seen
            seen.add(line)
    return found


def judged(text: bytes, bands: Bands, compressor: zstandard.ZstdCompressor) -> tuple:
    """One row of ``RESULT``."""
    words = text.split()
    n = len(words)
    in_words = np.frombuffer(text.translate(None, WHITE_SPACE), np.uint8)
    word_chars = int(np.count_nonzero((in_words & 0xC0) != 0x80))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    repeats = repeated_words(words)
    base_failed = n < 50 or 100 * repeats > 50 * n
    ratio, bad, chunks, band_failed = None, 0, 0, False
    if text:
        ratio = len(text) / len(compressor.compress(text))
        low, high = bands.of(len(text))
        band_failed = not low <= ratio <= high
        if len(text) > bands.chunk:
            for start in range(0, len(text), bands.chunk):
                part = text[start : start + bands.chunk]
                if len(part) >= bands.least_chunk:
                    low, high = bands.of(len(part))
                    chunks += 1
                    bad += not low <= len(part) / len(compressor.compress(part)) <= high
            band_failed |= bad > bands.bad_share * chunks
    return (
        n, word_chars, symbols, duplicate_lines(text), repeats, len(text),
        ratio, chunks, bad, base_failed, band_failed, not (base_failed or band_failed),
    )


def compression_bands(text: str | Column = "text", bands: Bands = Bands()) -> Column:
    """A struct of the measures and the verdict for one text column.

    Null counts as empty. An empty text has no ratio and fails by its word
    count. Texts are judged one by one, so repeated rows get equal results; a
    table without rows gives none; other columns of the table don't matter.
    """

    def measure(texts: pa.Array) -> pa.Array:
        compressor = zstandard.ZstdCompressor(level=bands.level)
        rows = [judged(t.as_py(), bands, compressor) for t in texts]
        columns = zip(*rows) if rows else [[]] * len(RESULT)
        return pa.StructArray.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, RESULT)], fields=list(RESULT)
        )

    # Declared nondeterministic so that a filter on the verdict is not pushed
    # below it, which would measure every text twice.
    return F.arrow_udf(measure, from_arrow_type(RESULT)).asNondeterministic()(utf8(text))
