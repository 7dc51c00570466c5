"""Document fingerprints: threshold-scaled sketches, in SQL functions only.

A sketch holds every shingle hash below a fixed fraction of the hash range, so two
sketches are samples of the same hashes however unequal the documents are, and
containment can be estimated from them. The union's sketch is the union of the
sketches. Where no hash falls below the threshold the least one is kept, so short
texts have a sketch too; merging drops it once there is a hash below.
"""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Settings:
    """``words`` per shingle; one hash in ``scale`` is kept."""

    words: int = 5
    scale: int = 8

    @property
    def threshold(self) -> int:
        """Hashes are signed: those below lie in the lowest 1/scale of the range."""
        return -(1 << 63) + (1 << 64) // self.scale


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_hashes(text: str | Column) -> Column:
    """A hash for each word; words are separated by ASCII white space."""
    spaced = F.translate(F.coalesce(_column(text), F.lit("")), "\t\n\x0b\f\r", "     ")
    return F.transform(F.filter(F.split(spaced, " "), lambda w: w != ""), lambda w: F.xxhash64(w))


def _shingles(hashes: Column, words: int) -> Column:
    ends = F.sequence(F.lit(0), F.greatest(F.size(hashes) - words, F.lit(0)))

    def shingle(start: Column) -> Column:
        return F.xxhash64(*(F.get(hashes, start + k) for k in range(words)))

    return F.when(F.size(hashes) > 0, F.transform(ends, shingle)).otherwise(F.array().cast("array<bigint>"))


def _below(hashes: Column, settings: Settings) -> Column:
    def choose(low: Column) -> Column:
        least = F.when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(low)
        return F.when(F.size(low) > 0, low).otherwise(least)

    low = F.sort_array(F.array_distinct(F.filter(hashes, lambda h: h < settings.threshold)))
    return _let(low, choose)


def sketch(text: str | Column, settings: Settings = Settings()) -> Column:
    """Sorted distinct hashes. Fewer words than a shingle: their whole sequence.

    Null and wordless texts have an empty sketch. Equal texts have equal sketches.
    """
    return _let(
        word_hashes(text),
        lambda words: _let(_shingles(words, settings.words), lambda hashes: _below(hashes, settings)),
    )


def merged(a: Column, b: Column, settings: Settings = Settings()) -> Column:
    """The sketch of two texts' shingles together."""
    return _below(F.array_union(a, b), settings)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller text's shingles that the other has too.

    1 for two empty sketches, 0 if just one is empty.
    """
    least = F.least(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b)) / least
    return F.when(least > 0, shared).when(F.size(a) == F.size(b), F.lit(1.0)).otherwise(F.lit(0.0))


def as_text(hashes: Column) -> Column:
    """Sixteen hexadecimal digits a hash."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")
