"""Packing by minimum bin slack.

Documents are tokenised and cut into pieces of the window's length; what remains
of each is shorter than a window. Per task only the number of remainders of each
length matters. A window starts with the longest remainder left; a bitset dynamic
program over the other lengths and their counts finds the sums that fit, the
greatest is taken, and going back through the program's steps gives how many
remainders of each length it uses. The same choice fills as many windows as the
counts allow. Work therefore follows the windows and the distinct lengths.
"""

import os
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.runtime import remembered


@dataclass(frozen=True)
class Settings:
    """``window`` in tokens; ``end``: the id that closes a document. ``kept``: words
    whose ids a task remembers. ``block``: bytes of text that are encoded at a time."""

    window: int = 4_096
    end: int = 2
    kept: int = 800_000
    block: int = 1 << 21


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


# Letters whose lower case is one letter of the same set, then ASCII punctuation
# other than the apostrophe: such a word is split between the two and nowhere else.
# One word a line; no word has a line end.
WORD_END = "</w>"
LINE = re.compile(r"^(?:([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)|(.*))$", re.MULTILINE)


class WordEncoder:
    """Ids of texts, word by word.

    The vocabulary has word ends and no pre-token reaches over white space, so a
    text's ids are those of its words. Ids of words are remembered as bytes; words
    that differ in case or in punctuation after them share what is encoded. A Python
    worker keeps its encoder from task to task.
    """

    def __init__(self, path: str, settings: Settings):
        self.tokenizer, self.settings = tokenizer(path), settings
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(WORD_END)]] = True

    def _encoded(self, parts: list[str]):
        """Each part by itself, as bytes."""
        for part, found in zip(parts, self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)):
            self.parts[part] = np.array(found.ids, "<u4").tobytes()

    def _encoded_together(self, parts: list[str]):
        """Parts of one pre-token each in one text, taken apart at the word ends."""
        for i in range(0, len(parts), 20_000):
            some = parts[i : i + 20_000]
            (found,) = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(stops) != len(some):
                self._encoded(some)
                continue
            data = ids.tobytes()
            self.parts.update(zip(some, map(data.__getitem__, map(slice, [0, *stops], stops))))

    def _learn(self, words: list[bytes]):
        known, simple, other, split = self.parts, set(), set(), []
        for head, tail, whole in LINE.findall(b"\n".join(words).decode()):
            if whole:
                if whole not in known:
                    other.add(whole)
                split.append((whole, ""))
                continue
            head = head.lower()
            if head not in known:
                simple.add(head)
            if tail and tail not in known:
                simple.add(tail)
            split.append((head, tail))
        self._encoded_together(list(simple))
        self._encoded(list(other))
        known[""] = b""
        self.words.update(zip(words, [known[head] + known[tail] if tail else known[head] for head, tail in split]))

    def _words(self, text: bytes) -> Iterator[list[bytes]]:
        """The words of one block of text after another."""
        at, block = 0, self.settings.block
        while at < len(text):
            stop = at + block
            while stop < len(text) and text[stop] not in b" \t\n\r\x0b\x0c":
                stop += 1
            yield text[at:stop].split()
            at = stop

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text, with the closing id.

        Short texts are looked up together, up to a block; longer ones block by block.
        """
        end = np.array([self.settings.end], "<u4").tobytes()
        held, size = [], 0
        for text in texts:
            if len(text) > self.settings.block:
                yield from self._closed(held, end)
                held, size = [], 0
                yield b"".join([*(self._looked_up([words])[0] for words in self._words(text)), end])
                continue
            held.append(text.split())
            size += len(text)
            if size > self.settings.block:
                yield from self._closed(held, end)
                held, size = [], 0
        yield from self._closed(held, end)

    def _closed(self, lists: list[list[bytes]], end: bytes) -> list[bytes]:
        return [found + end for found in self._looked_up(lists)]

    def _looked_up(self, lists: list[list[bytes]]) -> list[bytes]:
        known = self.words
        present = set().union(*lists)
        unknown = present.difference(known)
        if unknown:
            if len(known) > self.settings.kept:
                known.clear()
                unknown = present
            if len(self.parts) > self.settings.kept:
                self.parts.clear()
            self._learn(list(unknown))
        return [b"".join(map(known.__getitem__, words)) for words in lists]


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """How many of each length fill ``room`` best; ``lengths`` descend."""
    reach, steps, goal, mask = 1, [], 1 << room, (1 << (room + 1)) - 1
    for length in lengths[bisect_left(lengths, -room, key=lambda x: -x) :]:
        left, take = min(counts[length], room // length), 1
        while left and not reach & goal:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (take * length)) & mask
            left -= take
            take *= 2
        if reach & goal:
            break
    at, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + take
            at -= take * length
    return used


def packed(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece, by minimum bin slack."""
    number = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    order = np.argsort(lengths, kind="stable")
    values, starts, sizes = np.unique(lengths[order], return_index=True, return_counts=True)
    next_of = dict(zip(values.tolist(), starts.tolist()))
    counts = dict(zip(values.tolist(), sizes.tolist()))
    left = values[::-1].tolist()
    windows = 0
    while left:
        longest = left[0]
        counts[longest] -= 1
        used = fullest(counts, left, window - longest)
        counts[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(counts[length] // n for length, n in used.items())
        base = 0
        for length, n in used.items():
            at = next_of[length]
            rows = order[at : at + times * n]
            number[rows] = windows + np.repeat(np.arange(times), n)
            offset[rows] = base + np.tile(np.arange(n) * length, times)
            next_of[length] = at + times * n
            counts[length] -= times * n
            base += n * length
        windows += times
        if not all(counts[length] for length in used):
            left = [length for length in left if counts[length]]
    return number, offset


def _pieces(path: str, settings: Settings):
    window = settings.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = remembered(("words", path, settings), lambda: WordEncoder(path, settings))
        for batch in batches:
            rows = []
            source, texts = [], batch["text"]
            for k, ids in enumerate(encoder.ids(texts.to_pylist())):
                size = len(ids) // 4
                for start in range(0, size, window):
                    part = ids[4 * start : 4 * (start + window)]
                    rows.append((start, len(part) // 4, zlib.crc32(part), size, part))
                    source.append(k)
            columns = list(zip(*rows))
            kept = batch.select(["row", "id"]).take(pa.array(source, pa.int64()))
            made = [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(columns[4], pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *made], names=["row", "id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
            )

    return run


def _pack(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)  # one shuffle partition of pieces
        if not batches:
            return
        pieces = pa.Table.from_batches(batches).sort_by([("row", "ascending"), ("start", "ascending")])
        number, offset = packed(pieces["length"].to_numpy(), window)
        first = TaskContext.get().partitionId() << 33
        pieces = pieces.append_column("sequence_id", pa.array(number + first)).append_column("offset", pa.array(offset))
        yield from pieces.drop_columns(["row"]).to_batches(max_chunksize=10_000)

    return run


def pack(docs: DataFrame, key: str, text: str, path: str, settings: Settings = Settings(), with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    ``key``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset``, and ``ids`` (little-endian 32-bit) if asked for. Null texts count as
    empty: their document is the closing id alone. Keys may repeat or be null; other
    columns are ignored; no rows, no result. Pieces go to tasks by a hash of their
    row, so copies and hot keys spread; each task packs what it has.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("id"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    plain = [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
    schema = T.StructType([*rows.schema.fields[:2], *plain, T.StructField("ids", T.BinaryType())])
    pieces = rows.mapInArrow(_pieces(path, settings), schema)
    if not with_ids:
        pieces = pieces.drop("ids")
    places = [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")]
    result = T.StructType([*pieces.schema.fields[1:], *places])
    return pieces.repartition("row", "start").mapInArrow(_pack(settings.window), result).withColumnRenamed("id", key)
