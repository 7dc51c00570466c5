"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints of 64 bits that differ in at most ``radius`` bits are linked. Each
bit position gets a nonzero vector of ``radius + 1`` bits; every nonzero vector v
names a table, whose mask has the positions whose vector has an odd product with
v. For any ``radius`` positions some v has even products with all of them, so a
pair within the radius agrees under that table's mask: no linked pair is missed.

Exact copies are folded into one fingerprint first. A bucket is compared in one
task, and what leaves it is a spanning forest of its links, never its pairs. A
bucket of more than ``bucket`` fingerprints is dealt out again: the same
construction over the bits outside the mask leaves about 15 open bits, so the
parts are bounded by themselves, and still no pair is missed.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.llm.runtime import forget, stored, utf8

BITS = 64
LOWER = bytes(range(256)).lower()


@dataclass(frozen=True)
class Settings:
    """``words`` per shingle, ``radius`` in bits, ``bucket``: most fingerprints compared at a time."""

    words: int = 4
    radius: int = 4
    seed: int = 42
    bucket: int = 8_192


def fingerprint(text: bytes, words: int, seed: int) -> int:
    """Majority bits of the shingles' hashes; 0 for a text without words."""
    parts = text.translate(LOWER).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    shingles = max(1, len(parts) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    stops = ends[-shingles:].tolist()
    starts = [0, *(ends[: shingles - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, shingles, 1 << 16):
        stop = min(shingles, at + (1 << 16))
        hashes = np.fromiter(
            (digest(joined[a:b], seed) for a, b in zip(starts[at:stop], stops[at:stop])), np.uint64, stop - at
        )
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * counts > shingles))


def simhash(text: str | Column = "text", settings: Settings = Settings()) -> Column:
    """The fingerprint as a long (its 64 bits, two's complement)."""
    words, seed = settings.words, settings.seed

    def compute(texts: pa.Array) -> pa.Array:
        forget()
        prints = [fingerprint(t.as_py(), words, seed) for t in texts]
        return pa.array(np.array(prints, np.uint64).view(np.int64))

    return F.arrow_udf(compute, "bigint").asNondeterministic()(utf8(text))


def as_hex(fingerprint: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def masks(positions: list[int], radius: int) -> list[int]:
    """Covering masks over the given bit positions, as signed 64-bit numbers."""
    vectors = range(1, 1 << (radius + 1))
    found = set()
    for v in vectors:
        mask = 0
        for k, p in enumerate(positions):
            if ((1 + k % len(vectors)) & v).bit_count() & 1:
                mask |= 1 << p
        found.add(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return sorted(found)


def near(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    # bitwise_count takes the absolute value of signed numbers.
    return np.bitwise_count((a ^ b).view(np.uint64)) <= radius


def linked_forest(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (indices) that span the components of distinct fingerprints."""
    open_, found = np.arange(len(prints)), []
    while len(open_):
        root, open_ = open_[0], open_[1:]
        queue = [root]
        while queue and len(open_):
            at = queue.pop()
            linked = near(prints[open_], prints[at], radius)
            if linked.any():
                reached = open_[linked]
                found.extend((int(at), int(x)) for x in reached)
                queue.extend(reached)
                open_ = open_[~linked]
    return found


LINKS = "a bigint, b bigint, mask bigint, bits bigint, large boolean"


def _compare(radius: int, most: int | None):
    """Streams rows sorted by (mask, sub, bits, part) and yields each bucket's links.

    A bucket with more than ``most`` fingerprints isn't held: one row names it.
    """

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last bucket seen, which may go on
        skipped = None  # the bucket that was found too large

        for batch in _and_end(batches):
            rows = None if batch is None else np.stack([batch[c].to_numpy() for c in ("mask", "sub", "bits", "part", "print")], 1)
            if rows is not None and skipped is not None:
                rows = rows[~(rows[:, :4] == skipped).all(1)]
            if rows is not None and held is not None:
                rows = np.concatenate([held, rows])
            if rows is None:
                rows, last = held, True
            else:
                last = False
            if rows is None or not len(rows):
                held = None
                continue
            edge = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1)) + 1
            starts = np.concatenate([[0], edge])
            stops = np.concatenate([edge, [len(rows)]])
            held = None
            if not last:
                held = rows[starts[-1] :]
                starts, stops = starts[:-1], stops[:-1]
            sizes = stops - starts
            a, b = [], []
            pairs = starts[sizes == 2]
            x, y = rows[pairs, 4], rows[pairs + 1, 4]
            linked = near(x, y, radius)
            a.append(x[linked])
            b.append(y[linked])
            large = [s for s, n in zip(starts[sizes > 2], sizes[sizes > 2]) if most and n > most]
            for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
                if most and n > most:
                    continue
                part = rows[s : s + n, 4]
                forest = linked_forest(part, radius)
                if forest:
                    i, j = np.array(forest).T
                    a.append(part[i])
                    b.append(part[j])
            named = [rows[s, [0, 2]] for s in large]
            if held is not None and most and len(held) > most:
                skipped, held = held[0, :4].copy(), None
                named.append(skipped[[0, 2]])
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a) or named:
                blank = np.zeros(len(a), np.int64)
                keys = np.array(named, np.int64).reshape(-1, 2)
                zero = np.zeros(len(keys), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([a, zero])),
                        pa.array(np.concatenate([b, zero])),
                        pa.array(np.concatenate([blank, keys[:, 0]])),
                        pa.array(np.concatenate([blank, keys[:, 1]])),
                        pa.array(np.arange(len(a) + len(keys)) >= len(a)),
                    ],
                    names=["a", "b", "mask", "bits", "large"],
                )

    return links


def _and_end(batches):
    yield from batches
    yield None


def _in_buckets(keys: DataFrame) -> DataFrame:
    order = ["mask", "sub", "bits", "part"]
    return keys.select(*order, "print").repartition(*order).sortWithinPartitions(*order, "print")


def links(prints: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints (column ``print``) whose
    components are those of all links within the radius."""
    radius = settings.radius
    first = masks(list(range(BITS)), radius)
    table = F.explode(F.array(*(F.lit(m) for m in first)))
    keys = prints.withColumn("mask", table).withColumn("bits", F.col("print").bitwiseAND(F.col("mask")))
    keys = keys.withColumn("sub", F.lit(0).cast("long")).withColumn("part", F.lit(0).cast("long"))
    found = stored(_in_buckets(keys).mapInArrow(_compare(radius, settings.bucket), LINKS), "bit-links")
    small = found.where("not large").select("a", "b")
    large = found.where("large").select("mask", "bits").distinct()
    if large.isEmpty():
        return small
    inner = {m: masks([i for i in range(BITS) if not (m >> i) & 1], radius) for m in first}
    subs = F.create_map(*(x for m, s in inner.items() for x in (F.lit(m), F.array(*(F.lit(i) for i in s)))))
    again = keys.drop("sub", "part").join(large, ["mask", "bits"]).withColumn("sub", F.explode(subs[F.col("mask")]))
    again = again.withColumn("part", F.col("print").bitwiseAND(F.col("sub")))
    return small.unionByName(_in_buckets(again).mapInArrow(_compare(radius, None), LINKS).select("a", "b"))


def near_duplicates(prints: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``print``, ``root`` and ``component_id`` for rows ``id``, ``print``.

    ``root`` is a component's least fingerprint.
    ``component_id`` is the least ``id`` reachable over links; null ids count only
    if there is no other. Every fingerprint appears once, also those without a
    link. Equal rows and equal fingerprints fold together. No rows, no result.
    """
    each = stored(prints.groupBy("print").agg(F.min("id").alias("id")), "fingerprints")
    roots = components(links(each.select("print"), settings))
    rooted = stored(
        each.join(roots.withColumnRenamed("node", "print"), "print", "left")
        .select("print", "id", F.coalesce("root", "print").alias("root")),
        "rooted",
    )
    least = stored(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "components")
    return rooted.join(least, "root").select("print", "root", "component_id")
