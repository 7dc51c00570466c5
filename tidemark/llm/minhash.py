"""MinHash near-duplicates: universal hash minima, banding, signature verification,
full sets, and components by alternating large and small stars.

A document's set holds its distinct shingles of words; documents are linked when
the sets' overlap (Jaccard) reaches ``percent``. Equal sets are folded first.
Signatures hold 192 minima of strongly universal hash functions, in 32 bands of six
minima: a pair at 0.85 shares no band once in four million cases.

1. Every bucket (band and its minima) pairs its members with one of them, the one
   of least hash, which differs from band to band. Of these pairs each set tries its
   most alike first; pairs inside a component found so far need no trial.
2. What is still apart although a bucket holds it is compared by signatures inside
   the bucket; a forest of what agrees enough joins components to families. A
   bucket with more than ``bucket`` members is dealt out by a second band first.
   Inside a family, every set outside its largest component is met with all
   others on the full sets, by an index of shingles over blocks of bounded size.
   What leaves a bucket or a block is a forest, never its pairs.

Pairs whose signatures agree too little for the threshold (six standard
deviations below it) go; all others are confirmed on their full sets, taken from the
texts. A set that many others are tried against is handed to each share of them.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components, joined_roots, tree_roots
from tidemark.llm.runtime import forget, stored, utf8

# Most text keys (24 bytes each) that are broadcast.
BROADCAST_TEXTS = 500_000
LOWER = bytes(range(256)).lower()
# Odd multipliers that tell the places of a shingle's words apart.
PLACES = np.random.default_rng(7).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Settings:
    """``words`` per shingle, ``percent`` of overlap, ``bands`` of ``rows`` minima,
    ``bucket``: most signatures compared at a time, ``share``: most sets tried against
    one set in a task, ``block`` and ``weight``: about how many sets, and shingles, an
    index holds."""

    words: int = 3
    percent: int = 85
    bands: int = 32
    rows: int = 6
    bucket: int = 2_048
    share: int = 500
    block: int = 2_000
    weight: int = 2_000_000
    seed: int = 12

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    @property
    def least_agreement(self) -> int:
        """Equal minima that a pair at the threshold falls short of by chance once in 10^9."""
        p = self.percent / 100
        return int(self.minima * p - 6 * (self.minima * p * (1 - p)) ** 0.5)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    parts = text.translate(LOWER).split()
    if len(parts) < words:
        whole = [xxhash.xxh3_64_intdigest(b" ".join(parts), len(parts))] if parts else []
        return np.array(whole, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter(map(digest, parts), np.uint64, len(parts))
    count = len(parts) - words + 1
    joined = np.zeros(count, np.uint64)
    for k in range(words):
        joined += _mixed(hashes[k : k + count] * PLACES[k])
    return np.unique(_mixed(joined))


def _universal(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(settings.seed)
    return tuple(rng.integers(0, 1 << 64, settings.minima, dtype=np.uint64) for _ in range(2))


def minima(sets: list[np.ndarray], settings: Settings) -> np.ndarray:
    """Least values of (a x + b) mod 2^64 >> 32 over each nonempty set, one row a set."""
    a, b = _universal(settings)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    values = np.concatenate(sets) >> np.uint64(32)
    found = np.empty((settings.minima, len(sets)), np.uint32)
    for k in range(settings.minima):
        found[k] = np.minimum.reduceat(values * a[k] + b[k], starts) >> np.uint64(32)
    return found.T


SIGNED = "n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, marks binary"


def signature(text: str | Column = "text", settings: Settings = Settings()) -> Column:
    """Size, 128-bit digest, band keys and one byte of each minimum of the text's set.

    A text with fewer words than a shingle is one shingle; without words (null, empty
    or blank) the size is 0 and the rest null. Long texts are read whole.
    """

    def compute(texts: pa.Array) -> pa.Array:
        forget()
        sizes, digests, bands, marks = [], [], [], []
        for at, stop in _runs(texts, 4 << 20):
            sets = [shingles(t.as_py(), settings.words) for t in texts[at:stop]]
            full = [s for s in sets if len(s)]
            least = iter(minima(full, settings) if full else ())
            for s in sets:
                row = next(least) if len(s) else None
                sizes.append(len(s))
                digests.append(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) if len(s) else (None, None))
                bands.append(None if row is None else _band_keys(row, settings))
                marks.append(None if row is None else (row & 0xFF).astype(np.uint8).tobytes())
        columns = [
            pa.array(sizes, pa.int64()), pa.array([None if a is None else int(a) for a, _ in digests], pa.int64()),
            pa.array([None if b is None else int(b) for _, b in digests], pa.int64()),
            pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary()),
        ]
        return pa.StructArray.from_arrays(columns, names=["n_shingles", "set_a", "set_b", "bands", "marks"])

    return F.arrow_udf(compute, SIGNED).asNondeterministic()(utf8(text))


def _runs(texts: pa.Array, most: int):
    """Ranges of neighbouring texts of about ``most`` bytes together."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield at, stop
        at = stop


def _band_keys(row: np.ndarray, settings: Settings) -> np.ndarray:
    parts = row.reshape(settings.bands, settings.rows)
    return np.array([xxhash.xxh3_64_intdigest(p.tobytes(), k) for k, p in enumerate(parts)], np.uint64).view(np.int64)


# ---- candidates


def _agreement(marks_a: str, marks_b: str, minima: int) -> Column:
    """How many bytes of two signatures are equal."""

    def compute(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = (np.frombuffer(b"".join(v.to_pylist()), np.uint8).reshape(-1, minima) for v in (a, b))
        return pa.array((x == y).sum(axis=1), pa.int64())

    return F.arrow_udf(compute, "bigint")(F.col(marks_a), F.col(marks_b))


def _paired(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Pairs ``a`` < ``b`` whose sizes and signatures allow the overlap, with ``alike``."""
    one = sets.select(F.col("node").alias("a"), F.col("marks").alias("marks_a"), F.col("n_shingles").alias("n_a"))
    two = sets.select(F.col("node").alias("b"), F.col("marks").alias("marks_b"), F.col("n_shingles").alias("n_b"))
    both = pairs.join(one, "a").join(two, "b").where(_sizes_allow(settings))
    scored = both.select("a", "b", _agreement("marks_a", "marks_b", settings.minima).alias("alike"))
    return scored.where(F.col("alike") >= settings.least_agreement)


def _sizes_allow(settings: Settings) -> Column:
    return 100 * F.least("n_a", "n_b") >= settings.percent * F.greatest("n_a", "n_b")


def shared_buckets(sets: DataFrame) -> DataFrame:
    """Buckets (``key``, a band and its minima) with two or more members: ``node`` and the
    bucket's ``head``, the member whose number is least once it is mixed with the key."""
    keys = sets.select(F.explode("bands").alias("key"), "node")
    rank = F.min(F.col("node").bitwiseXOR(F.col("key"))).alias("rank")
    heads = stored(keys.groupBy("key").agg(rank, F.count("*").alias("n")).where("n > 1"), "bucket-heads")
    return stored(keys.join(heads, "key").select("key", "node", F.col("rank").bitwiseXOR(F.col("key")).alias("head")), "shared-buckets")


CROSS = "a bigint, b bigint"


class Forest:
    """Joins numbers to trees and says which joins were new."""

    def __init__(self):
        self.parent = {}

    def root(self, x):
        while x != (up := self.parent.setdefault(x, x)):
            self.parent[x] = x = self.parent.setdefault(up, up)
        return x

    def join(self, x, y) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def _batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = [pa.array([pair[k] for pair in pairs], pa.int64()) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _rows(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _agreeing_roots(settings: Settings):
    """A forest of the roots in a bucket whose members' signatures agree enough.

    Rows are sorted by bucket; a bucket is held as arrays of roots and marks.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, run in groupby(_rows(batches), key=lambda row: row[:2]):
            run = list(run)
            roots = np.array([row[3] for row in run], np.int64)
            marks = np.frombuffer(b"".join(row[4] for row in run), np.uint8).reshape(len(run), -1)
            kinds, counts = np.unique(roots, return_counts=True)
            largest = kinds[counts.argmax()]  # its members are met by all others
            forest, found = Forest(), []
            for i in np.flatnonzero(roots != largest):
                met = (roots == largest) | (np.arange(len(run)) > i)
                apart = np.flatnonzero(met & (roots != roots[i]))
                alike = apart[(marks[apart] == marks[i]).sum(axis=1) >= settings.least_agreement]
                one = int(roots[i])
                found += [(one, other) for other in np.unique(roots[alike]).tolist() if forest.join(one, other)]
            if found:
                yield _batch(found)

    return compare


def families(shared: DataFrame, sets: DataFrame, roots: DataFrame, settings: Settings) -> DataFrame:
    """``node``, ``root`` and ``family`` of sets whose buckets hold several components that
    may be linked.

    A bucket over ``bucket`` members is dealt out by a second band: a pair at the
    threshold shares one band or none once in 180 000 cases.
    """
    rooted = shared.select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    mixed = stored(mixed.where("lo <> hi").select("key", "n"), "mixed-buckets")
    held = stored(rooted.join(mixed, "key"), "mixed-members")
    described = held.join(sets.select("node", "marks", "bands"), "node")
    small = described.where(F.col("n") <= settings.bucket).withColumn("second", F.lit(0).cast("long"))
    second = F.explode(F.slice("bands", (F.array_position("bands", F.col("key")) + 1).cast("int"), settings.bands))
    large = described.where(F.col("n") > settings.bucket).withColumn("second", second)
    columns = ["key", "second", "node", "root", "marks"]
    rows = small.select(*columns).unionByName(large.select(*columns))
    placed = rows.repartition("key", "second").sortWithinPartitions("key", "second", "node")
    met = components(placed.mapInArrow(_agreeing_roots(settings), CROSS))
    named = met.select(F.col("node").alias("root"), F.col("root").alias("family"))
    return held.select("node", "root").distinct().join(named, "root")


def _index_block(settings: Settings):
    """Links between the sets of a block and those that are met with it, as a forest of
    their roots.

    Rows are sorted by family and block, the block's own sets first.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for _, run in groupby(_rows(batches), key=lambda row: row[:2]):
            roots, own, index, forest, found = [], [], None, Forest(), []
            for _, _, visitor, _, root, text in run:
                words = shingles(text, settings.words)
                if not visitor:
                    roots.append(root)
                    own.append(words)
                    continue
                index = index or _index(own)
                common = _common(index, words, len(own))
                linked = 100 * common >= settings.percent * (index[2] + len(words) - common)
                for k in np.flatnonzero(linked).tolist():
                    if forest.join(root, roots[k]):
                        found.append((root, roots[k]))
            if found:
                yield _batch(found)

    return meet


def _index(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted shingles, the set of each, and the sets' sizes."""
    sizes = np.array([len(s) for s in sets], np.int64)
    whole = np.concatenate([*sets, np.empty(0, np.uint64)])
    order = np.argsort(whole, kind="stable")
    return whole[order], np.repeat(np.arange(len(sets)), sizes)[order], sizes


def _common(index, words: np.ndarray, count: int) -> np.ndarray:
    """How many of the words each indexed set has."""
    whole, owners, _ = index
    low, high = np.searchsorted(whole, words, "left"), np.searchsorted(whole, words, "right")
    lengths = high - low
    at = np.repeat(low - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    return np.bincount(owners[at], minlength=count)


def family_links(members: DataFrame, sizes: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Links between the roots of each family that its full sets show."""
    members = stored(members.join(sizes, "node"), "family-members")
    counts = members.groupBy("family", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("weight"))
    largest = F.max(F.struct("n", "root"))["root"].alias("largest")
    blocks = F.greatest(F.sum("n") / settings.block, F.sum("weight") / settings.weight)
    counts = counts.groupBy("family").agg(largest, F.ceil(blocks).cast("long").alias("blocks"))
    placed = members.join(stored(counts, "families"), "family")
    own = placed.select("family", F.pmod(F.xxhash64("node"), "blocks").alias("block"), F.lit(False).alias("visitor"), "node", "root")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    visitors = placed.where("root <> largest").select("family", every, F.lit(True).alias("visitor"), "node", "root")
    rows = stored(own.unionByName(visitors), "block-members").join(texts, "node")
    rows = rows.select("family", "block", "visitor", "node", "root", "text").repartition("family", "block")
    return rows.sortWithinPartitions("family", "block", "visitor", "node").mapInArrow(_index_block(settings), CROSS)


# ---- confirmation


def _confirm(settings: Settings):
    """Streams each share's first set, then the sets that are tried against it."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        head, key = None, None
        for batch in batches:
            a, b = [], []
            for one, share, other, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = shingles(text, settings.words)
                if other is None:
                    head, key = words, (one, share)
                elif key == (one, share):
                    common = len(np.intersect1d(head, words, assume_unique=True))
                    if 100 * common >= settings.percent * (len(head) + len(words) - common):
                        a.append(one)
                        b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return confirm


def confirmed(pairs: DataFrame, texts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets overlap enough; ``texts`` has ``node``, ``text``."""
    counts = pairs.groupBy("a").agg(F.count("*").alias("n"))
    shares = F.greatest(F.lit(1), F.ceil(F.col("n") / settings.share)).cast("long")
    counts = stored(counts.withColumn("shares", shares).drop("n"), "tried-sets")
    heads = counts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"))
    heads = heads.select(F.col("a").alias("node"), "a", "share", F.lit(None).cast("long").alias("b"))
    share = F.pmod(F.xxhash64("b"), F.col("shares")).alias("share")
    tried = pairs.join(counts, "a").select(F.col("b").alias("node"), "a", share, "b")
    rows = stored(heads.unionByName(tried), "trials").join(texts, "node").select("a", "share", "b", "text")
    placed = rows.repartition("a", "share").sortWithinPartitions("a", "share", F.col("b").asc_nulls_first())
    return placed.mapInArrow(_confirm(settings), CROSS)


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends have different roots."""
    for end in ("a", "b"):
        pairs = pairs.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    pairs = pairs.withColumns({f"root_{end}": F.coalesce(f"root_{end}", end) for end in ("a", "b")})
    return pairs.where("root_a <> root_b")


def links(sets: DataFrame, texts_of: Callable[[DataFrame], DataFrame], settings: Settings = Settings()) -> DataFrame:
    """``node`` and ``root`` of all sets that are linked with another.

    ``sets`` has ``node``, ``n_shingles``, ``bands``, ``marks``, one row per distinct set;
    ``texts_of`` gives ``node`` and ``text`` (bytes) for the nodes of a table of pairs.
    """
    shared = shared_buckets(sets)
    led = shared.where("node <> head").select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"))
    pairs = stored(_paired(led.distinct(), sets, settings), "likely-pairs")
    texts = texts_of(pairs)
    # Each set's most alike partner first: that settles most pairs without a trial.
    best = F.max(F.struct("alike", (-F.col("a")).alias("order"), F.col("a"))).alias("best")
    tried = stored(pairs.groupBy("b").agg(best).select(F.col("best.a").alias("a"), "b"), "leading-pairs")
    roots = tree_roots(stored(confirmed(tried, texts, settings), "links"))
    columns = ["a", "b", "root_a", "root_b"]
    rest = stored(_apart(pairs.join(tried, ["a", "b"], "left_anti"), roots).select(*columns), "open-pairs")
    if not rest.isEmpty():
        found = confirmed(rest.select("a", "b"), texts, settings).join(rest, ["a", "b"])
        roots = joined_roots(roots, found.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    members = stored(families(shared, sets, roots, settings), "families")
    if not members.isEmpty():
        texts = texts_of(members.select(F.col("node").alias("a"), F.col("node").alias("b")))
        more = family_links(members, sets.select("node", "n_shingles"), texts, settings)
        roots = joined_roots(roots, more)
    return roots


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id`` for rows ``id``, ``text``.

    ``component_id`` is the least ``id`` reachable over links, also through equal sets;
    null ids count only if there is no other. Texts without words are linked with
    nothing and keep their own id. Repeated rows stay, each with its own result.
    Further columns are ignored; no rows, no result.
    """
    text = utf8("text")
    keys = (F.xxhash64(text).alias("text_a"), F.xxhash64(F.lit(1), text).alias("text_b"))
    signed = docs.select("id", *keys, signature("text", settings).alias("s"), F.monotonically_increasing_id().alias("node"))
    rows = stored(signed.select("id", "text_a", "text_b", "node", "s.*"), "signed-texts")
    digest = ["set_a", "set_b"]
    firsts = rows.where("n_shingles > 0").groupBy(*digest).agg(F.min("node").alias("node"), F.min("id").alias("least"))
    sets = stored(rows.drop("id", *digest).join(firsts, "node"), "distinct-sets")

    def texts_of(pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = stored(sets.select("node", "text_a", "text_b").join(nodes, "node", "left_semi"), "wanted-texts")
        if wanted.count() <= BROADCAST_TEXTS:
            wanted = F.broadcast(wanted)
        named = docs.select(*keys, text.alias("text")).join(wanted, ["text_a", "text_b"])
        return stored(named.groupBy("node").agg(F.first("text").alias("text")), "compared-texts")

    roots = links(sets.select("node", "n_shingles", "bands", "marks"), texts_of, settings)
    rooted = sets.select("node", *digest, "least").join(roots, "node", "left")
    rooted = stored(rooted.withColumn("root", F.coalesce("root", "node")).drop("node"), "rooted-sets")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select(*digest, "component_id")
    linked = rows.select("id", "n_shingles", *digest).join(named, digest, "left")
    own = F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component_id"))
    return linked.select("id", "n_shingles", own.alias("component_id"))
