"""Removal of repeated byte strings by a distributed merge sort of suffixes.

Every byte that lies in a string of ``length`` bytes which also starts somewhere
else is removed. Sorting a suffix at every byte would write each text hundreds of
times over, so only suffixes at anchors are sorted: of the 64-byte grams inside a
string of 200 bytes the one with the least hash (leftmost on ties) is the string's
anchor. Equal strings have equal anchors at equal places, so the anchor's suffix
and the bytes before it tell all that can be known about the strings around it.

1. Anchors of all texts; grams that occur once are dropped by their hash.
2. Suffixes at the remaining anchors are sorted into runs by each task, front-coded,
   and dealt out by gram.
3. Runs are merged by a loser tree that carries common prefixes. In the merged order
   suffixes that share r bytes stand together; so do, in the order of what stands
   before the anchors, those that share p bytes to the left. A string that starts p
   bytes before its anchor is repeated if another anchor shares p bytes to the left
   and ``length - p`` to the right.

Suffixes at one gram meet in one task. A gram with more than ``often`` sites is left
out of the runs: the strings at its anchors are grouped by a 128-bit hash instead,
which Spark combines before the shuffle.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import forget, stored, utf8
from tidemark.llm.suffix_runs import LoserTree, common_in_order, decoded, front_coded

GRAM = 64
WINDOW = 128
TAG = 8  # bytes of the gram's hash before each suffix
BLOCK = (1 << 20) - 4_096
KEY = ["k1", "k2"]


@dataclass(frozen=True)
class Settings:
    """``length`` of the strings: at least GRAM + WINDOW - 1, since the anchor's gram
    must lie inside. ``run_bytes``: a run's size in a task. ``part``: suffixes that
    are merged together, about."""

    length: int = 200
    run_bytes: int = 32 << 20
    part: int = 40_000
    often: int = 400_000


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed hash of each gram, from hashes of halves."""
    hashes = data.astype(np.uint64) + np.uint64(1)
    factor, size = 0x9E3779B97F4A7C15, 1
    while size < GRAM:
        hashes = hashes[:-size] * np.uint64(factor) + hashes[size:]
        factor = factor * factor % (1 << 64)
        size *= 2
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(29)
    return hashes


def anchors(data: np.ndarray, ends: np.ndarray, length: int):
    """Anchors of concatenated texts that end at ``ends``.

    Yields (hash, text, anchor, first, last): the strings that start at ``first`` to
    ``last`` have their anchor there; positions count in ``data``.
    """
    starts = np.concatenate([[0], ends[:-1]])
    low = np.uint64((1 << 20) - 1)
    for begin in range(0, len(data), BLOCK):
        count = min(BLOCK, len(data) - begin - length + 1)
        if count <= 0:
            return
        hashes = gram_hashes(data[begin : begin + count + length - 1])
        best = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        size = 1
        while size < WINDOW:
            best = np.minimum(best[:-size], best[size:])
            size *= 2
        at = (best[:count] & low).astype(np.int64)
        here = np.arange(count)
        text = np.searchsorted(ends, begin + here, side="right")
        inside = begin + here + length <= ends[text]
        here, at, text = here[inside], at[inside], text[inside]
        if not len(here):
            continue
        fresh = np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])])
        first = np.flatnonzero(fresh)
        last = np.concatenate([first[1:], [len(here)]]) - 1
        yield hashes[at[first]], text[first], begin + at[first] - starts[text[first]], begin + here[first] - starts[
            text[first]
        ], begin + here[last] - starts[text[first]]


def _find_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            texts = batch["bytes"]
            offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
            keys = [batch[k].to_numpy() for k in KEY]
            for gram, text, at, first, last in anchors(data, offsets[1:].astype(np.int64) - offsets[0], length):
                # Position, and how far before it the strings start at most and at least.
                place = at << 16 | (at - first) << 8 | (at - last)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), *(pa.array(k[text]) for k in keys), pa.array(place)],
                    names=["gram", *KEY, "place"],
                )

    return run


RUN = "part bigint, shared binary, sizes binary, rest binary, left_shared binary, left_sizes binary, lefts binary, keys binary, places binary"


def _sorted_runs(settings: Settings, parts: int):
    length = settings.length

    def flush(entries: list) -> Iterator[pa.RecordBatch]:
        entries.sort()
        part = [int.from_bytes(e[0][:TAG], "big") * parts >> (8 * TAG) for e in entries]
        edges = np.flatnonzero(np.diff(part, prepend=-1, append=parts)).tolist()
        rows = []
        for begin, end in zip(edges, edges[1:]):
            suffixes, lefts, keys, places = zip(*entries[begin:end])
            # What stands to the left is written as its difference from the entry before.
            same = [0, *(_common_left(a, b) for a, b in zip(lefts, lefts[1:]))]
            rest = [x[: len(x) - k] for x, k in zip(lefts, same)]
            rows.append(
                (part[begin], *front_coded(list(suffixes)), np.array(same, np.uint8).tobytes(),
                 np.fromiter(map(len, rest), np.uint8, len(rest)).tobytes(), b"".join(rest), b"".join(keys),
                 np.array(places, np.int64).tobytes())
            )
        names = [c.split()[0] for c in RUN.split(", ")]
        for k in range(0, len(rows), 256):
            columns = list(zip(*rows[k : k + 256]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=names
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        entries, held = [], 0
        for batch in batches:
            keys = np.stack([batch[k].to_numpy() for k in KEY], 1)
            for k in range(len(batch)):
                text, key = batch["bytes"][k].as_py(), keys[k].tobytes()
                for place in batch["places"][k].values.to_numpy().tolist():
                    at, most, least = place >> 16, place >> 8 & 255, place & 255
                    suffix = text[at : at + length - least]
                    tag = xxhash.xxh64_digest(suffix[:GRAM])
                    entries.append((tag + suffix, text[at - most : at], key, place))
                    held += len(suffix) + most + 160
                if held > settings.run_bytes:
                    yield from flush(entries)
                    entries, held = [], 0
        if entries:
            yield from flush(entries)

    return run


def _strings(length: int):
    """(hash, text, start) of every string at the anchors of frequent grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack([batch[k].to_numpy() for k in KEY], 1)
            for k in range(len(batch)):
                text = batch["bytes"][k].as_py()
                starts = [
                    (place >> 16) - p
                    for place in batch["often"][k].values.to_numpy().tolist()
                    for p in range(place & 255, (place >> 8 & 255) + 1)
                ]
                digests = b"".join(xxhash.xxh3_128_digest(text[a : a + length]) for a in starts)
                pair = np.frombuffer(digests, np.int64).reshape(-1, 2)
                both = np.broadcast_to(keys[k], (len(starts), 2))
                columns = [pair[:, 0], pair[:, 1], both[:, 0], both[:, 1], np.array(starts, np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(c)) for c in columns], names=["h1", "h2", *KEY, "start"]
                )

    return run


def _frequent_spans(strings: DataFrame, length: int) -> DataFrame:
    site = F.xxhash64(*KEY, "start")
    twice = strings.groupBy("h1", "h2").agg(F.min(site).alias("least"), F.max(site).alias("most"))
    twice = stored(twice.where("least <> most").select("h1", "h2"), "repeated-strings")
    return strings.join(twice, ["h1", "h2"]).select(*KEY, "start", (F.col("start") + length).alias("stop"))


def _common_left(a: bytes, b: bytes) -> int:
    """Length of the common ending."""
    if a == b:
        return len(a)
    most, at = min(len(a), len(b)), 0
    while at < most and a[-1 - at] == b[-1 - at]:
        at += 1
    return at


def repeated(shared: np.ndarray, lefts: list[bytes], least: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Which strings around sorted anchors are repeated: (entry, nearest, farthest),
    distances of the starts before the anchor, inclusive.

    ``shared``: bytes in common with the entry before; ``lefts``: the bytes before
    each anchor, as far as strings start there; ``least``: the nearest start.
    """
    count = len(lefts)
    backwards = [x[::-1] for x in lefts]
    order = sorted(range(count), key=backwards.__getitem__)
    left_shared = common_in_order([backwards[k] for k in order])
    order = np.array(order)
    most = np.fromiter(map(len, lefts), np.int64, count)
    near = np.maximum(shared, np.append(shared[1:], 0))  # with either neighbour
    marks = np.zeros((count, WINDOW + 2), bool)
    left_class = np.zeros(count, np.int64)
    for p in range(WINDOW):
        some = np.flatnonzero((least <= p) & (p <= most) & (near >= length - p))
        if len(some) < 2:
            continue
        right_class = np.cumsum(shared < length - p)
        left_class[order] = np.cumsum(left_shared < p)
        pair = right_class[some] * count + left_class[some]
        by = np.argsort(pair, kind="stable")
        equal = pair[by][1:] == pair[by][:-1]
        marks[some[by[1:][equal]], p + 1] = True
        marks[some[by[:-1][equal]], p + 1] = True
    edges = np.diff(marks.astype(np.int8), axis=1)
    entry, nearest = np.nonzero(edges == 1)
    _, after = np.nonzero(edges == -1)
    return entry, nearest, after - 1


def _merge(settings: Settings):
    length = settings.length

    def spans(runs: list[dict]) -> pa.RecordBatch:
        tree = LoserTree([decoded(r["shared"], r["sizes"], r["rest"]) for r in runs])
        lefts, keys, places = [], [], []
        for r in runs:
            last, at, own = b"", 0, []
            for same, size in zip(r["left_shared"], r["left_sizes"]):
                last = r["lefts"][at : at + size] + (last[len(last) - same :] if same else b"")
                at += size
                own.append(last)
            lefts.append(own)
            keys.append(np.frombuffer(r["keys"], np.int64).reshape(-1, 2))
            places.append(np.frombuffer(r["places"], np.int64))
        shared, run, seen, index = [], [], [0] * len(runs), []
        for k, _, w in tree:
            shared.append(k)
            run.append(w)
            index.append(seen[w])
            seen[w] += 1
        base = np.concatenate([[0], np.cumsum([len(p) for p in places])])[np.array(run)] + np.array(index)
        place = np.concatenate(places)[base]
        key = np.concatenate(keys)[base]
        left = [lefts[w][i] for w, i in zip(run, index)]
        # The tag is no part of the text: less than a gram in common counts as nothing.
        right = np.array(shared, np.int64) - TAG
        entry, nearest, farthest = repeated(right, left, place & 255, length)
        at = place[entry] >> 16
        return pa.RecordBatch.from_arrays(
            [pa.array(key[entry, 0]), pa.array(key[entry, 1]), pa.array(at - farthest), pa.array(at - nearest + length)],
            names=[*KEY, "start", "stop"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["part"] != row["part"]:
                    yield spans(held)
                    held = []
                held.append(row)
        if held:
            yield spans(held)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, runs = [], []
        for k in range(len(batch)):
            text = batch["bytes"][k].as_py()
            spans = batch["spans"][k].values
            starts, stops = (spans.field(f).to_numpy() for f in ("start", "stop"))
            order = np.lexsort((stops, starts))
            starts, stops = starts[order], np.maximum.accumulate(stops[order])
            fresh = np.concatenate([[True], starts[1:] > stops[:-1]])
            first = starts[fresh]
            last = stops[np.append(np.flatnonzero(fresh)[1:] - 1, len(stops) - 1)]
            at = [0, *last.tolist()]
            kept.append(b"".join(text[a:b] for a, b in zip(at, [*first.tolist(), len(text)])))
            runs.append([{"start": int(a), "stop": int(b)} for a, b in zip(first, last)])
        yield pa.RecordBatch.from_arrays(
            [*(batch[k] for k in KEY), pa.array(kept, pa.binary()),
             pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
            names=[*KEY, "kept", "spans"],
        )


def text_keys(text: str) -> list:
    """Two hashes that stand for a text's bytes."""
    return [F.xxhash64(utf8(text)).alias("k1"), F.xxhash64(F.lit(1), utf8(text)).alias("k2")]


def without_repeats(docs: DataFrame, text: str, settings: Settings = Settings()) -> DataFrame:
    """``k1``, ``k2`` (see ``text_keys``), ``kept`` (bytes) and ``spans`` (removed runs)
    of every distinct text that has a repeated string inside or in a different text.

    Copies of a text are one here; a caller knows that a text of at least ``length``
    bytes which stands in two rows is repeated as a whole. Null counts as empty;
    texts shorter than ``length`` have no string to repeat.
    """
    base = docs.select(*text_keys(text), utf8(text).alias("bytes"))
    long = base.where(F.octet_length("bytes") >= settings.length)
    found = stored(
        long.mapInArrow(_find_anchors(settings.length), "gram bigint, k1 bigint, k2 bigint, place bigint"), "anchors"
    )
    site = F.xxhash64(*KEY, "place")
    twice = found.groupBy("gram").agg(F.min(site).alias("least"), F.max(site).alias("most"), F.count("*").alias("sites"))
    frequent = (F.col("sites") > settings.often).alias("frequent")
    twice = stored(twice.where("least <> most").select("gram", frequent), "repeated-grams")
    places = [F.collect_set(F.when(F.col("frequent") == f, F.col("place"))).alias(n) for f, n in ((False, "places"), (True, "often"))]
    located = stored(found.join(twice, "gram").groupBy(*KEY).agg(*places), "located-anchors")
    total = located.agg(F.sum(F.size("places"))).first()[0] or 0
    parts = max(1, -(-total // settings.part))
    # Copies fold within each task before the shuffle; both joins read that shuffle.
    texts = long.groupBy(*KEY).agg(F.first("bytes").alias("bytes"))
    runs = texts.join(located.drop("often"), KEY).mapInArrow(_sorted_runs(settings, parts), RUN)
    merged = runs.repartition("part").sortWithinPartitions("part").mapInArrow(
        _merge(settings), "k1 bigint, k2 bigint, start bigint, stop bigint"
    )
    if not twice.where("frequent").isEmpty():
        rows = texts.join(located.drop("places").where(F.size("often") > 0), KEY)
        strings = rows.mapInArrow(_strings(settings.length), "h1 bigint, h2 bigint, k1 bigint, k2 bigint, start bigint")
        merged = merged.unionByName(_frequent_spans(strings, settings.length))
    spans = merged.groupBy(*KEY).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return texts.join(spans, KEY).mapInArrow(
        _cut, "k1 bigint, k2 bigint, kept binary, spans array<struct<start:bigint,stop:bigint>>"
    )
