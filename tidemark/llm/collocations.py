"""Phrase collocations by Rabin-Karp fingerprints.

Texts are cut into pieces and words. Word hashes are summed with the powers of a
base into prefix polynomials (numpy, modulo 2^64), so the fingerprint of any run of
words is a difference of two prefixes. A phrase is no more frequent than its parts, so
three passes over the texts do:

1. words by fingerprint;
2. words that may be frequent, exactly, and pairs of such words by fingerprint;
3. pairs that may be frequent and longer phrases all of whose pairs may be, exactly.

What may be frequent travels as a Bloom filter of bounded size
(``Settings.filter_bits``); what passes it wrongly is counted and found rare, so the
filter changes the work, not the result. Counting exactly means: beside the
fingerprint a check (a polynomial over other word hashes) and a pointer to a text
that holds the phrase go through the shuffle. Fingerprint and check are one key, so
phrases whose fingerprints collide stay apart, and a phrase is spelled out, once it is
known to be frequent, only from a text in which both numbers are found again.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.runtime import forget, stored, utf8

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BREAK = b","
TABLE = bytes(ord(BREAK) if c in PIECE_ENDS else c for c in bytes(range(256)).lower())
U64 = np.uint64


@dataclass(frozen=True)
class Settings:
    """``least`` occurrences, ``longest`` phrase in words, ``top`` per language,
    ``covered``: percentage of a longer phrase that makes a part superfluous,
    ``filter_bits``: most bits of a filter, as a power of two, ``held``: fingerprints a
    task holds before it hands them on, ``words``: spellings it remembers."""

    least: int = 100
    longest: int = 5
    top: int = 2_000
    covered: int = 100
    filter_bits: int = 27
    held: int = 1 << 20
    words: int = 400_000


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Vocabulary(dict):
    """Numbers of words in order of first sight; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({BREAK: 0})
        self.spelled = [BREAK]
        self.hashes = [[0], [0]]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.spelled.append(word)
        self.hashes[0].append(xxhash.xxh3_64_intdigest(word))
        self.hashes[1].append(xxhash.xxh64_intdigest(word, 11))
        return number


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64."""

    def __init__(self, base: int):
        self.base, self.size = base, 0

    def upto(self, size: int):
        if size > self.size:
            self.size = max(size, 1 << 16)
            self.up, self.down = (self._of(b) for b in (self.base, pow(self.base, -1, 1 << 64)))
        return self.up[:size], self.down[:size]

    def _of(self, base: int) -> np.ndarray:
        factors = np.full(self.size, base, U64)
        factors[0] = 1
        return np.cumprod(factors, dtype=U64)


BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


class Grams:
    """All runs of words of some texts."""

    def __init__(self, langs: list[str], texts: list[bytes], words: Vocabulary, powers: list[Powers]):
        split = [t.translate(TABLE).replace(BREAK, b" , ").split() for t in texts]
        sizes = np.array([len(s) + 1 for s in split], np.int64)
        total = int(sizes.sum())
        numbers = map(words.__getitem__, chain.from_iterable((*s, BREAK) for s in split))
        self.words = np.fromiter(numbers, np.int64, total)
        self.text = np.repeat(np.arange(len(texts)), sizes)
        seeds = {lang: xxhash.xxh3_64_intdigest(lang.encode(), 5) for lang in set(langs)}
        self.seeds = np.array([seeds[lang] for lang in langs], U64)[self.text]
        # Words of one language have one kind.
        number = {lang: k for k, lang in enumerate(seeds)}
        self.kind = np.array([number[lang] for lang in langs], np.int64)[self.text] * len(words) + self.words
        self.kinds = len(number) * len(words)
        self.breaks = np.concatenate([[0], np.cumsum(self.words == 0)])
        self.prefixes = []
        for hashes, power in zip(words.hashes, powers):
            up, down = power.upto(total)
            prefix = np.cumsum(np.array(hashes, U64)[self.words] * up, dtype=U64)
            self.prefixes.append((np.concatenate([np.zeros(1, U64), prefix]), down))

    def whole(self, n: int) -> np.ndarray:
        """Where n words stand within one piece."""
        at = np.zeros(len(self.words), bool)
        if len(at) >= n:
            at[: len(at) - n + 1] = self.breaks[n:] == self.breaks[:-n]
        return at

    def different(self, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of runs of n words and how many runs each stands for; equal words
        are one place already, longer runs are not told apart here."""
        places = np.flatnonzero(at)
        if n != 1:
            return places, np.ones(len(places), np.int64)
        counts = np.bincount(self.kind[places], minlength=self.kinds)
        some = np.zeros(self.kinds, np.int64)
        some[self.kind[places]] = places
        found = np.flatnonzero(counts)
        return some[found], counts[found]

    def prints(self, n: int, at: np.ndarray, which: int = 0) -> np.ndarray:
        """Fingerprints (or, ``which`` 1, checks) of the runs of n words at some places."""
        prefix, down = self.prefixes[which]
        run = (prefix[at + n] - prefix[at]) * down[at]
        return mixed(mixed(run + U64(n)) ^ self.seeds[at])


class Filter:
    """Bloom filter over fingerprints, three probes."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    @staticmethod
    def probes(prints: np.ndarray, bits: int):
        other, low = mixed(prints ^ U64(0x5851F42D4C957F2D)), U64((1 << bits) - 1)
        return [prints & low, other & low, (other >> U64(32)) & low]

    def __contains__(self, _):
        raise TypeError("use holds")

    def holds(self, prints: np.ndarray) -> np.ndarray:
        found = np.ones(len(prints), bool)
        for probe in self.probes(prints, self.bits):
            found &= (self.words[probe >> U64(6)] >> (probe & U64(63))) & U64(1) == 1
        return found


def make_filter(frequent: DataFrame, most_bits: int) -> Filter:
    """A filter of at most 2^most_bits bits; its words are or-ed on the executors."""
    count = frequent.count()
    bits = min(most_bits, max(10, (16 * count).bit_length()))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << (bits - 6), U64)
        for batch in batches:
            prints = batch["print"].to_numpy().view(U64)
            for probe in Filter.probes(prints, bits):
                np.bitwise_or.at(held, probe >> U64(6), U64(1) << (probe & U64(63)))
        at = np.flatnonzero(held)
        for k in range(0, len(at), 1 << 16):
            part = at[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(held[part].view(np.int64))], names=["at", "word"])

    found = frequent.select("print").mapInArrow(words, "at bigint, word bigint").groupBy("at").agg(F.bit_or("word").alias("word"))
    table = found.toArrow()
    whole = np.zeros(1 << (bits - 6), U64)
    whole[table["at"].to_numpy()] = table["word"].to_numpy().view(U64)
    return Filter(bits, whole)


COUNTS = "print bigint, check bigint, n bigint, pointer bigint"


def added(prints: np.ndarray, checks: np.ndarray, counts: np.ndarray, pointers: np.ndarray):
    """Sums of neighbours with equal print and check after sorting; least pointers."""
    order = np.argsort(prints, kind="stable")
    prints, checks, counts, pointers = prints[order], checks[order], counts[order], pointers[order]
    new = np.flatnonzero((prints[1:] != prints[:-1]) | (checks[1:] != checks[:-1])) + 1
    starts = np.concatenate([[0], new])
    return prints[starts], checks[starts], np.add.reduceat(counts, starts), np.minimum.reduceat(pointers, starts)


@dataclass(frozen=True)
class Run:
    """Runs of ``size`` words (0: all words of a language) whose runs of ``parts`` words
    may be frequent; ``exact`` ones are counted with check and pointer."""

    size: int
    parts: int
    exact: bool


def _count(runs: list[Run], settings: Settings, known=None):
    """Counts runs; ``known`` is a broadcast filter over their parts. Rows that are not
    exact have check 0, others an odd check."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        powers = [Powers(base) for base in BASES]
        words, held = Vocabulary(), []

        def flush(least: int):
            if not held:
                return None
            rows = added(*(np.concatenate(c) for c in zip(*held)))
            held.clear()
            if len(rows[0]) < least:
                held.append(rows)
                return None
            return pa.RecordBatch.from_arrays(
                [pa.array(c.view(np.int64)) for c in rows], names=["print", "check", "n", "pointer"]
            )

        for batch in batches:
            if len(words) > settings.words:
                words = Vocabulary()
            langs, texts, pointers = batch["lang"].to_pylist(), batch["text"].to_pylist(), batch["pointer"].to_numpy()
            grams = Grams(langs, texts, words, powers)
            passed = _passed(grams, known, max(run.parts for run in runs))
            for run in runs:
                at, ones = grams.different(_extended(grams, passed if run.parts else None, run.size, run.parts), run.size)
                if len(at):
                    prints = grams.prints(run.size, at)
                    checks = grams.prints(run.size, at, 1) | U64(1) if run.exact else np.zeros(len(at), U64)
                    texts_at = pointers[grams.text[at]] if run.exact else np.zeros(len(at), np.int64)
                    held.append(added(prints, checks, ones, texts_at))
            if sum(len(rows[0]) for rows in held) > 2 * settings.held:
                ready = flush(settings.held)
                if ready is not None:
                    yield ready
        ready = flush(1)
        if ready is not None:
            yield ready

    return count


def _passed(grams: Grams, known, parts: int) -> np.ndarray | None:
    """Where runs of ``parts`` words stand whole and may be frequent."""
    if known is None:
        return None
    at = grams.whole(parts)
    if parts > 1:
        places = np.flatnonzero(at)
        at[places] = known.value.holds(grams.prints(parts, places))
    else:
        places, _ = grams.different(at, 1)
        good = np.zeros(grams.kinds, bool)
        good[grams.kind[places]] = known.value.holds(grams.prints(1, places))
        at &= good[grams.kind]
    return at


def _extended(grams: Grams, passed: np.ndarray | None, size: int, parts: int) -> np.ndarray:
    """Where runs of a size stand whole and all their parts passed."""
    if size == 0:
        return grams.whole(1)
    at = grams.whole(size)
    for k in range(size - parts + 1 if passed is not None else 0):
        at[: len(at) - k] &= passed[k:]
    return at


def _spell(longest: int):
    """The wanted phrases of each text."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        powers = [Powers(base) for base in BASES]
        for batch in batches:
            out = {"lang": [], "size": [], "phrase": [], "print": [], "check": [], "n": []}
            for lang, text, wanted in zip(*(batch[c].to_pylist() for c in ("lang", "text", "wanted"))):
                words = Vocabulary()
                grams = Grams([lang], [text], words, powers)
                prints = np.array([w["print"] for w in wanted], np.int64).view(U64)
                counts = {(w["print"], w["check"]): w["n"] for w in wanted}
                for size in range(longest + 1):
                    at = np.flatnonzero(_extended(grams, None, size, 0))
                    here = grams.prints(size, at)
                    at = at[np.isin(here, prints)]
                    here, first = np.unique(grams.prints(size, at), return_index=True)
                    at = at[first]
                    checks = (grams.prints(size, at, 1) | U64(1)).view(np.int64).tolist()
                    for place, key in zip(at.tolist(), zip(here.view(np.int64).tolist(), checks)):
                        if key in counts:
                            spelled = b" ".join(words.spelled[k] for k in grams.words[place : place + size])
                            for name, value in zip(out, (lang, size, spelled.decode(), *key, counts[key])):
                                out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=SPELLED_ARROW)

    return spell


SPELLED = "lang string, size int, phrase string, print bigint, check bigint, n bigint"
SPELLED_ARROW = pa.schema(
    [("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("print", pa.int64()), ("check", pa.int64()), ("n", pa.int64())]
)


def frequent_phrases(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``lang``, ``size`` (words), ``phrase`` and ``n`` for runs of up to ``longest`` words
    within a piece that occur at least ``least`` times in a language; size 0 has the
    number of all words.

    ``docs``: ``lang``, ``text``; further columns are ignored. A null language is
    ``und``, a null text has no words. Every row counts, repeated ones too. A long text
    is read whole by one task. No rows, no rows.
    """
    context = docs.sparkSession.sparkContext
    lang, text = F.coalesce(F.col("lang").cast("string"), F.lit("und")), utf8("text")
    rows = docs.select(lang.alias("lang"), text.alias("text")).withColumn("pointer", F.xxhash64("lang", "text"))

    def counted(purpose: str, runs: list[Run], known=None) -> tuple[DataFrame, DataFrame]:
        parts = rows.mapInArrow(_count(runs, settings, known), COUNTS)
        sums = parts.groupBy("print", "check").agg(F.sum("n").alias("n"), F.min("pointer").alias("pointer"))
        kept = stored(sums.where(F.col("n") >= settings.least), purpose)
        return kept.where("check <> 0"), kept.where("check = 0")

    def filtered(candidates: DataFrame):
        return context.broadcast(make_filter(candidates, settings.filter_bits))

    _, words = counted("likely-words", [Run(1, 0, False)])
    pairs = [Run(2, 1, False)] if settings.longest > 1 else []
    found, likely = counted("frequent-words", [Run(0, 0, True), Run(1, 1, True), *pairs], filtered(words))
    if pairs:
        longer = [Run(size, 2, True) for size in range(2, settings.longest + 1)]
        found = found.unionByName(counted("frequent-phrases", longer, filtered(likely))[0])

    wanted = found.groupBy("pointer").agg(F.collect_list(F.struct("print", "check", "n")).alias("wanted"))
    wanted = stored(wanted, "wanted-phrases")
    # One of equal texts; texts that only share the pointer's hash are all read.
    held = rows.join(wanted.select("pointer"), "pointer", "left_semi")
    second = F.xxhash64(F.lit(1), "lang", "text").alias("second")
    held = held.groupBy("pointer", second).agg(F.first("lang").alias("lang"), F.first("text").alias("text"))
    held = held.join(wanted, "pointer").select("lang", "text", "wanted")
    spelled = held.mapInArrow(_spell(settings.longest), SPELLED)
    return spelled.dropDuplicates(["print", "check"]).select("lang", "size", "phrase", "n")


def collocations(phrases: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``,
    ``r``, ``n``, ``score``.

    A phrase is scored at the cut that binds least, floor(1000 a n / (l r)), the first
    of equal ones. Phrases that stand inside a longer one about as often go.
    """
    words = F.split("phrase", " ")
    totals = phrases.where("size = 0").select("lang", F.col("n").alias("words"))
    counts = phrases.where("size > 0").select("lang", "phrase", "n")
    candidates = phrases.where("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"), words.alias("parts"))

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("parts", 1, F.col("k")), " ").alias("head"),
        F.array_join(F.slice("parts", F.col("k") + 1, F.col("size")), " ").alias("rest"),
    )
    for part, name in (("head", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name)), ["lang", part])
    a, n, l, r = (F.col(c).cast("decimal(15,0)") for c in ("a", "words", "l", "r"))
    exact = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * a * n, l * r)
    scored = cuts.join(totals, "lang").withColumn("score", exact)
    lowest = scored.groupBy("lang", "phrase", "a", F.col("words").alias("n")).agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    width = F.explode(F.sequence(F.lit(2), F.col("size") - 1))
    inside = candidates.where("size > 2").withColumn("width", width)
    inside = inside.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("width") + 1)))
    part = F.array_join(F.slice("parts", F.col("start"), F.col("width")), " ")
    covers = inside.groupBy("lang", part.alias("phrase")).agg((100 * F.max("a")).alias("cover"))
    kept = lowest.join(covers, ["lang", "phrase"], "left")
    kept = kept.where(F.col("cover").isNull() | (F.col("cover") < settings.covered * F.col("a")))

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.where(F.col("rank") <= settings.top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
