"""Byte-level BPE by overlapping chunk encoding, and decoding.

A long text is cut into overlapping chunks that are pre-tokenised in parallel. A
chunk may start inside a pre-token, but the pattern never looks back, so from the
first boundary that two neighbouring chunks share their boundaries are the same.
The chunks are stitched there; then each chunk's own pre-tokens are encoded. Where
no boundary is shared within the overlap, as in a very long run of one kind, the
chunk is joined to the one before it and pre-tokenised again. Short texts are one
chunk. Decoding concatenates the tokens' bytes.
"""

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Settings:
    """Lengths in code points. ``kept``: pre-tokens whose ids a task remembers."""

    chunk: int = 16_384
    overlap: int = 512
    kept: int = 200_000


@cache
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@cache
def compiled(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


class Encoder:
    """Ids of single pre-tokens, remembered up to a bound."""

    def __init__(self, path: str, pattern: str, kept: int):
        self.one = encoding(path, pattern)._encode_single_piece
        self.pattern, self.kept, self.known = compiled(pattern), kept, {}

    def ids(self, pieces: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.kept:
            known.clear()
        for piece in set(pieces):
            if piece not in known:
                known[piece] = np.array(self.one(piece), np.int32).tobytes()
        return np.frombuffer(b"".join(map(known.__getitem__, pieces)), np.int32)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def encode_whole(text: str | Column, path: str, pattern: str, settings: Settings = Settings()) -> Column:
    """Ids of texts of any length, each in one go; null counts as empty."""

    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(path, pattern, settings.kept)
        for batch in texts:
            yield _lists([encoder.ids(encoder.pattern.findall(t)) for t in batch.to_pylist()])

    column = F.col(text) if isinstance(text, str) else text
    return F.arrow_udf(encode, "array<int>").asNondeterministic()(F.coalesce(column, F.lit("")))


# A match may depend on so many characters after it (a contraction on three).
MARGIN = 4


def trusted(pattern: regex.Pattern, text: str, final: bool) -> list[int]:
    """Ends of the matches, without those that more text could change."""
    ends = [m.end() for m in pattern.finditer(text)]
    if not final:
        while ends and ends[-1] > len(text) - MARGIN:
            ends.pop()
    return ends


def encode(docs: DataFrame, key: str, text: str, path: str, pattern: str, settings: Settings = Settings()) -> DataFrame:
    """``key`` and ``ids`` (array<int>), one row per row of ``docs``.

    Keys may repeat or be null. Null and empty texts give an empty array; other
    columns are ignored; no rows, no result.
    """
    size = F.coalesce(F.length(text), F.lit(0))
    short = docs.where(size <= settings.chunk).select(F.col(key).alias("key"), F.col(text).alias("text"))
    long = docs.where(size > settings.chunk).select(F.col(key).alias("key"), F.col(text).alias("text"))
    whole = short.select("key", encode_whole("text", path, pattern, settings).alias("ids"))
    return whole.unionByName(_encode_long(long, path, pattern, settings)).withColumnRenamed("key", key)


def _encode_long(long: DataFrame, path: str, pattern: str, settings: Settings) -> DataFrame:
    size, kind = settings.chunk, long.schema["key"].dataType
    # Numbered before the chunks are made, so that a text's chunks share the number.
    numbered = long.select(F.monotonically_increasing_id().alias("row"), "key", "text")
    chunks = numbered.select(
        "row",
        "key",
        F.length("text").alias("length"),
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.length("text") - 1) / size).cast("int")),
                lambda i: F.substring(F.col("text"), i * size + 1, F.lit(size + settings.overlap)),
            )
        ).alias("number", "part"),
    ).repartition("row", "number")
    with_ends = T.StructType([*chunks.schema, T.StructField("ends", T.ArrayType(T.IntegerType()))])
    result = T.StructType([T.StructField("key", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    ordered = chunks.mapInArrow(_pretokenise(pattern, size), with_ends).repartition("row").sortWithinPartitions("row", "number")
    return ordered.mapInArrow(_stitch(path, pattern, settings), result)


def _pretokenise(pattern: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = []
            for number, length, part in zip(*(batch[c].to_pylist() for c in ("number", "length", "part"))):
                final = number * size + len(part) >= length
                ends.append(np.array(trusted(compiled(pattern), part, final), np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(ends)], names=[*batch.schema.names, "ends"])

    return run


class _Open:
    """The text that is being stitched: its latest chunk, not encoded yet."""

    def __init__(self, row: dict):
        self.key, self.length = row["key"], row["length"]
        self.text, self.ends, self.start = row["part"], row["ends"], 0
        self.ids: list[np.ndarray] = []

    def add(self, row: dict, here: int, encoder: Encoder):
        mine = {e + here for e in row["ends"]}
        meet = next((e for e in self.ends if e + self.start >= here and e + self.start in mine), None)
        if meet is None:
            # No shared boundary: go on from the last certain one, through both chunks.
            sure = self.ends[-1] if self.ends else 0
            rest = self.text[sure:] + row["part"][self.start + len(self.text) - here :]
            final = here + len(row["part"]) >= self.length
            self.ends = self.ends + [sure + e for e in trusted(encoder.pattern, rest, final)]
            self.text = self.text[:sure] + rest
            return
        self.encode(encoder, meet)
        at = meet + self.start
        self.text, self.start = row["part"][at - here :], at
        self.ends = [e + here - at for e in row["ends"] if e + here > at]

    def encode(self, encoder: Encoder, stop: int):
        ends = [e for e in self.ends if e <= stop]
        self.ids.append(encoder.ids([self.text[a:b] for a, b in zip([0, *ends], ends)]))


def _stitch(path: str, pattern: str, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The chunks of a text follow each other in order; its ids leave together."""
        encoder, text, kind = Encoder(path, pattern, settings.kept), None, None

        def closed():
            text.encode(encoder, len(text.text))
            return pa.RecordBatch.from_arrays(
                [pa.array([text.key], kind), _lists([np.concatenate(text.ids)])], names=["key", "ids"]
            )

        for batch in batches:
            kind = batch.schema.field("key").type
            for row in batch.to_pylist():
                if row["number"]:
                    text.add(row, row["number"] * settings.chunk, encoder)
                    continue
                if text is not None:
                    yield closed()
                text = _Open(row)
        if text is not None:
            yield closed()

    return run


def decode(ids: str | Column, path: str, pattern: str) -> Column:
    """The bytes of an array of ids; null counts as empty."""

    def join(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = encoding(path, pattern).decode_single_token_bytes
        table = [token(i) for i in range(encoding(path, pattern).n_vocab)]
        for batch in lists:
            parts = [
                b"".join([table[i] for i in batch[k].values.to_numpy()]) if batch[k].is_valid else b""
                for k in range(len(batch))
            ]
            yield pa.array(parts, pa.binary())

    column = F.col(ids) if isinstance(ids, str) else ids
    return F.arrow_udf(join, "binary").asNondeterministic()(column)
