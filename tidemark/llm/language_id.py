"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
The probability of a word is the sum over all its segmentations into pieces,
by the forward algorithm; a text's likelihood is the product over its words
(runs of letters, lower case, marked at their start). The piece probabilities
are fitted by expectation maximisation on a bounded sample of labelled texts.
"""

import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from math import exp, log

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.runtime import remembered, stored

LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
START = "▁"
UNDECIDED = "und"
# Below this a product of chances may have lost terms; it is computed again in logs.
TINY = 1e-250


@dataclass(frozen=True)
class Settings:
    """``documents``: most labelled texts per language that are fitted on.
    ``languages``: most languages; their counts come to the driver.

    ``rounds``: expectation maximisation rounds. ``added``: count added to every
    piece. ``longest``: letters after which a run is cut (scripts without
    spaces). ``kept_words``: word scores that a task remembers at a time.
    """

    documents: int = 600
    languages: int = 1_000
    rounds: int = 2
    added: float = 0.02
    longest: int = 32
    kept_words: int = 250_000


@cache
def vocabulary(path: str) -> tuple[dict[str, int], int]:
    """Pieces of letters with their ids, and the length of the longest."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces: dict[str, int] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).lower()
        body = piece[1:] if piece.startswith(START) else piece
        if all(unicodedata.category(c)[0] in "LM" for c in body):
            pieces.setdefault(piece, len(pieces))
    return pieces, max(map(len, pieces))


def words_of(text: str, longest: int) -> Counter:
    """Letter runs in lower case; long runs are cut."""
    runs = LETTERS.findall(text.lower())
    if any(len(r) > longest for r in runs):
        runs = [r[i : i + longest] for r in runs for i in range(0, len(r), longest)]
    return Counter(runs)


def matches(word: str, pieces: dict[str, int], most: int) -> list[tuple[int, int, int]]:
    """(start, end, piece) of every vocabulary piece in the marked word; a
    character that no piece covers counts as the unknown piece."""
    marked, unknown = START + word, len(pieces)
    found = []
    for i in range(len(marked)):
        single = False
        for j in range(i + 1, min(len(marked), i + most) + 1):
            piece = pieces.get(marked[i:j])
            if piece is not None:
                found.append((i, j, piece))
                single |= j == i + 1
        if not single:
            found.append((i, i + 1, unknown))
    return found


@dataclass(frozen=True)
class Trie:
    """The vocabulary's prefixes as numbered nodes; an edge's key is its node and character."""

    keys: np.ndarray  # sorted: node << 21 | character
    target: np.ndarray
    piece: np.ndarray  # of each node, -1 where no piece ends


@cache
def trie(path: str) -> Trie:
    pieces, _ = vocabulary(path)
    nodes: dict[str, int] = {"": 0}
    edges: dict[int, int] = {}
    for piece in pieces:
        for end in range(1, len(piece) + 1):
            node = nodes.setdefault(piece[:end], len(nodes))
            edges[nodes[piece[: end - 1]] << 21 | ord(piece[end - 1])] = node
    ends = np.full(len(nodes), -1, np.int64)
    for piece, number in pieces.items():
        ends[nodes[piece]] = number
    keys = np.array(sorted(edges), np.int64)
    return Trie(keys, np.array([edges[k] for k in keys.tolist()], np.int64), ends)


def forward(words: list[str], path: str, chances: np.ndarray) -> np.ndarray:
    """Log probability of each word (row) in each language (column).

    All starts of all words walk the vocabulary's trie together; then all words
    advance together, one end position and piece length at a time.
    """
    tree, unknown = trie(path), len(chances) - 1
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    width = int(lengths.max())
    letters = np.full((len(words), width), -1, np.int64)
    letters[:, 0] = ord(START)
    text = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    spot = np.repeat(np.arange(len(words)) * width + 1 - np.cumsum(np.append(0, lengths[:-1] - 1)), lengths - 1)
    letters.ravel()[spot + np.arange(len(text))] = text
    row, start = np.nonzero(letters >= 0)
    node = np.zeros(len(row), np.int64)
    single = np.zeros((len(words), width), bool)
    steps: list[list[tuple]] = [[] for _ in range(width + 1)]
    found = []
    size = 0
    while len(row):
        at = start + size
        within = at < lengths[row]
        row, start, node, at = row[within], start[within], node[within], at[within]
        key = node << 21 | letters[row, at]
        edge = np.minimum(np.searchsorted(tree.keys, key), len(tree.keys) - 1)
        hit = tree.keys[edge] == key
        row, start, node = row[hit], start[hit], tree.target[edge[hit]]
        size += 1
        piece = tree.piece[node]
        ends = piece >= 0
        found.append((size, row[ends], start[ends], piece[ends]))
        if size == 1:
            single[row[ends], start[ends]] = True
    lone_row, lone_start = np.nonzero(~single & (letters >= 0))
    found.append((1, lone_row, lone_start, np.full(len(lone_row), unknown)))
    for size, rows, starts, pieces in found:
        order = np.argsort(starts, kind="stable")
        rows, starts, pieces = rows[order], starts[order], pieces[order]
        edges = np.flatnonzero(np.diff(starts, prepend=-1, append=width + 1))
        for begin, end in zip(edges[:-1], edges[1:]):
            steps[starts[begin] + size].append((size, rows[begin:end], pieces[begin:end]))
    alpha = np.zeros((width + 1, len(words), chances.shape[1]))
    alpha[0] = 1.0
    for end in range(1, width + 1):
        for size, rows, pieces in steps[end]:
            alpha[end, rows] += alpha[end - size, rows] * chances[pieces]
    total = alpha[lengths, np.arange(len(words))]
    low = (total < TINY).any(axis=1)
    scores = np.log(np.maximum(total, TINY))
    if low.any():
        place, logs = np.cumsum(low) - 1, np.log(chances)
        alpha = np.full((width + 1, int(low.sum()), chances.shape[1]), -np.inf)
        alpha[0] = 0.0
        for end in range(1, width + 1):
            for size, rows, pieces in steps[end]:
                again = low[rows]
                at = place[rows[again]]
                alpha[end, at] = np.logaddexp(alpha[end, at], alpha[end - size, at] + logs[pieces[again]])
        scores[low] = alpha[lengths[low], np.arange(len(alpha[0]))]
    return scores


def expected(word: str, pieces: dict[str, int], most: int, chance: np.ndarray) -> tuple[list[int], list[float]]:
    """Pieces and their expected counts over all segmentations of one word."""
    found = matches(word, pieces, most)
    size = len(word) + 1
    before, after = [0.0] * (size + 1), [0.0] * (size + 1)
    before[0] = after[size] = 1.0
    weights = [chance[p] for _, _, p in found]
    for (i, j, _), w in zip(found, weights):  # sorted by start
        before[j] += before[i] * w
    for (i, j, _), w in zip(reversed(found), reversed(weights)):
        after[i] += after[j] * w
    if before[size] < TINY:
        return [p for _, _, p in found], _expected_in_logs(found, [log(w) for w in weights], size)
    return [p for _, _, p in found], [before[i] * w * after[j] / before[size] for (i, j, _), w in zip(found, weights)]


def _expected_in_logs(found: list[tuple[int, int, int]], weights: list[float], size: int) -> list[float]:
    before, after = np.full(size + 1, -np.inf), np.full(size + 1, -np.inf)
    before[0] = after[size] = 0.0
    for (i, j, _), w in zip(found, weights):
        before[j] = np.logaddexp(before[j], before[i] + w)
    for (i, j, _), w in zip(reversed(found), reversed(weights)):
        after[i] = np.logaddexp(after[i], after[j] + w)
    return [exp(before[i] + w + after[j] - before[size]) for (i, j, _), w in zip(found, weights)]


@dataclass(frozen=True)
class Model:
    path: str
    languages: tuple[str, ...]
    chances: np.ndarray  # (pieces and the unknown piece) x languages
    settings: Settings


def _sample(labelled: DataFrame, settings: Settings) -> DataFrame:
    """At most ``documents`` texts of each language, the smallest by a hash.

    A first cut by hash at the share that leaves about twice as many keeps the
    ranking small; the rank then makes the bound exact.
    """
    counts = labelled.groupBy("lang").count().limit(settings.languages + 1).collect()
    if len(counts) > settings.languages:
        raise ValueError(f"more than {settings.languages} languages")
    shares = {r["lang"]: 2.0 * settings.documents / r["count"] for r in counts}
    if not shares:
        return labelled.select("lang", "text").limit(0)
    share = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))[F.col("lang")]
    spread = F.pmod(F.xxhash64("key"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = labelled.select("lang", "text", spread.alias("spread")).where(F.col("spread") <= share)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("spread", F.xxhash64("text")))
    return drawn.withColumn("rank", rank).where(F.col("rank") <= settings.documents).select("lang", "text")


def _word_counts(sample: DataFrame, settings: Settings) -> DataFrame:
    longest = settings.longest

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                counts.setdefault(lang, Counter()).update(words_of(text, longest))
            rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*rows)], names=["lang", "word", "n"]
                )

    counted = sample.mapInArrow(count, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _expected_counts(words: DataFrame, model) -> DataFrame:
    """Expected count of every piece in every language under the current chances."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = model.value
        pieces, most = vocabulary(at.path)
        column = {lang: at.chances[:, k].tolist() for k, lang in enumerate(at.languages)}
        sums = {lang: np.zeros(len(pieces) + 1) for lang in at.languages}
        for batch in batches:
            for lang, word, n in zip(*(batch[c].to_pylist() for c in ("lang", "word", "n"))):
                ids, weights = expected(word, pieces, most, column[lang])
                total = sums[lang]
                for i, w in zip(ids, weights):
                    total[i] += n * w
        for lang, total in sums.items():
            ids = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(ids), pa.string()), pa.array(ids, pa.int32()), pa.array(total[ids])],
                names=["lang", "piece", "n"],
            )

    counted = words.mapInArrow(count, "lang string, piece int, n double")
    return counted.groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, path: str, settings: Settings = Settings()) -> Model:
    """Fit on columns ``key`` (any hashable value that spreads), ``lang``, ``text``.

    Rows with a null language or text are left out. What comes to the driver is
    one number per piece of the vocabulary and language.
    """
    spark = labelled.sparkSession
    pieces, _ = vocabulary(path)
    labelled = labelled.where("lang is not null and text is not null")
    words = stored(_word_counts(_sample(labelled, settings), settings), "language-words")
    languages = tuple(r["lang"] for r in words.select("lang").distinct().orderBy("lang").collect())
    size = len(pieces) + 1
    model = Model(path, languages, np.full((size, len(languages)), 1.0 / size), settings)
    column = {lang: k for k, lang in enumerate(languages)}
    for _ in range(settings.rounds if languages else 0):
        shared = spark.sparkContext.broadcast(model)
        counts = np.full((size, len(languages)), settings.added)
        for row in _expected_counts(words, shared).toLocalIterator():
            counts[row["piece"], column[row["lang"]]] += row["n"]
        shared.unpersist()
        model = Model(path, languages, counts / counts.sum(axis=0), settings)
    return model


class WordScores:
    """Scores of words seen so far; a Python worker keeps them from task to task."""

    def __init__(self, model: Model):
        self.model, self.rows = model, {}
        self.scores = np.zeros((0, len(model.languages)))

    def learn(self, counts: list[Counter]):
        new = {w for c in counts for w in c if w not in self.rows}
        if new and len(self.rows) + len(new) > self.model.settings.kept_words:
            self.rows, self.scores = {}, self.scores[:0]
            new = {w for c in counts for w in c}
        words = sorted(new, key=len)  # words of like length advance together
        found = [self.scores]
        for i in range(0, len(words), 8_192):
            part = words[i : i + 8_192]
            self.rows.update(zip(part, range(len(self.rows), len(self.rows) + len(part))))
            found.append(forward(part, self.model.path, self.model.chances))
        self.scores = np.concatenate(found)

    def total(self, count: Counter) -> np.ndarray:
        rows = np.fromiter(map(self.rows.__getitem__, count), np.int64, len(count))
        return np.fromiter(count.values(), np.float64, len(count)) @ self.scores[rows]


def predict(spark: SparkSession, model: Model, text: str | Column = "text") -> Column:
    """A struct of ``lang`` and ``score``, the posterior under equal priors.

    ``und`` with score 0 for null texts, texts without a letter, and for all
    texts if nothing was learned. Ties go to the first language by name.
    """
    shared = spark.sparkContext.broadcast(model)
    column = F.col(text) if isinstance(text, str) else text
    name = uuid.uuid4().hex

    def classify(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at = shared.value
        known = remembered(("scores", name), lambda: WordScores(at))
        for batch in texts:
            langs, values = [], []
            counts = [words_of(t, at.settings.longest) if t else {} for t in batch.to_pylist()]
            if at.languages:
                known.learn(counts)
            for c in counts:
                if not c or not at.languages:
                    langs.append(UNDECIDED)
                    values.append(0.0)
                    continue
                total = known.total(c)
                best = int(total.argmax())
                langs.append(at.languages[best])
                values.append(float(1.0 / np.exp(total - total[best]).sum()))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(values, pa.float64())], names=["lang", "score"])

    return F.arrow_udf(classify, "struct<lang:string,score:double>").asNondeterministic()(column.cast("string"))
