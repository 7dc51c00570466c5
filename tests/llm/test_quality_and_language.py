import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import zstandard

from tidemark.llm import language_id, queries
from tidemark.llm.compression_bands import Bands, compression_bands

from .conftest import AWKWARD, SMALL


def plain_base(text):
    """The base measures, counted plainly."""
    white = " \t\n\x0b\f\r"
    words, word = [], ""
    for c in text + " ":
        if c in white:
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines, seen, again = text.split("\n"), set(), 0
    for line in lines:
        if line.strip(white):
            again += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), again, len(covered), failed


def test_base_measures_against_plain_counts(llm_spark, documents):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op1_compression_bands"](llm_spark, SMALL).collect()}
    assert len(rows) == len(documents)
    for key, text in documents:
        r = rows[key]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_base(text)
        size = len(text.encode())
        assert r.n_bytes == size
        if size:
            assert r.ratio == size / len(zstandard.ZstdCompressor(level=3).compress(text.encode()))
        assert r.kept == (not r.base_failed and not r.band_failed)


def test_bands_reject_repetition_and_noise(llm_spark):
    rng = np.random.default_rng(1)
    words = ["w" + "".join(rng.choice(list("aeioustrnl"), 6)) for _ in range(4_000)]
    text = " ".join(rng.choice(words, 3_000))
    noise = " ".join("".join(map(chr, rng.integers(0x4E00, 0x9FFF, 30))) for _ in range(400))
    repeat = "abcdefgh ijklmnop qrstuvwx " * 400
    half = text + " " + "zq " * 6_000
    df = llm_spark.createDataFrame([(1, text), (2, noise), (3, repeat), (4, half)], "id long, text string")
    got = {r["id"]: r["b"]["band_failed"] for r in df.select("id", compression_bands("text").alias("b")).collect()}
    assert got == {1: False, 2: True, 3: True, 4: True}


def test_limits_follow_the_length():
    bands = Bands()
    assert bands.of(100) == bands.limits[0][1:] and bands.of(10**9) == bands.limits[-1][1:]


def test_quality_of_awkward_rows(awkward, nothing):
    rows = [r["b"] for r in awkward.select(compression_bands("text").alias("b")).collect()]
    for (_, text, *_), r in zip(AWKWARD, rows):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_base(text or "")
    assert not any(r.kept for r in rows)
    assert nothing.select(compression_bands("text")).count() == 0


def test_forward_sums_all_segmentations():
    path = public_tokenizers.path(queries.PIECES)
    pieces, most = language_id.vocabulary(path)
    chances = np.random.default_rng(2).random((len(pieces) + 1, 3))

    def total(marked, column):
        if not marked:
            return 1.0
        found, single = 0.0, False
        for size in range(1, min(most, len(marked)) + 1):
            piece = pieces.get(marked[:size])
            if piece is not None:
                single |= size == 1
                found += chances[piece, column] * total(marked[size:], column)
        return found if single else found + chances[-1, column] * total(marked[1:], column)

    words = sorted(["a", "haus", "straße", "日本", "qwxz", "información"], key=len)
    got = language_id.forward(words, path, chances)
    want = [[np.log(total(language_id.START + w, k)) for k in range(3)] for w in words]
    assert np.allclose(got, want)
    ids, counts = language_id.expected("haus", pieces, most, chances[:, 0])
    spelled = sum(n * len(next(p for p, i in pieces.items() if i == k)) for k, n in zip(ids, counts))
    assert abs(spelled - 5) < 1e-9  # the segmentations cover every character once


def test_products_too_small_for_a_number():
    path = public_tokenizers.path(queries.PIECES)
    pieces, most = language_id.vocabulary(path)
    letter = "\U00010330"  # no piece holds it
    assert letter not in pieces
    chances = np.full((len(pieces) + 1, 2), 1e-5)
    chances[-1] = 2e-11, 1e-12
    words = ["haus", letter * 5, letter * 32]
    got = language_id.forward(words, path, chances)
    assert np.isfinite(got).all()
    for n, row in ((5, got[1]), (32, got[2])):
        assert np.allclose(row, np.log(chances[pieces[language_id.START]]) + n * np.log(chances[-1]))
    assert np.allclose(got[0], language_id.forward(["haus"], path, chances)[0])
    ids, counts = language_id.expected(letter * 32, pieces, most, chances[:, 1])
    assert abs(sum(counts) - 33) < 1e-6 and ids.count(len(pieces)) == 32
    # In logs and as plain products alike.
    word = "información"
    found = language_id.matches(word, pieces, most)
    plain = language_id.expected(word, pieces, most, chances[:, 0])[1]
    assert np.allclose(plain, language_id._expected_in_logs(found, np.log(chances[[p for _, _, p in found], 0]).tolist(), len(word) + 1))


def test_held_out_languages(llm_spark, documents):
    import duckdb

    rows = {r["doc_id"]: r for r in queries.QUERIES["op3_language_id"](llm_spark, SMALL).collect()}
    assert len(rows) == len(documents)
    truth = dict(duckdb.sql(f"select doc_id, lang from '{SMALL}/documents.parquet'").fetchall())
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r.score <= 1 for k, r in rows.items())
    held = [k for k, r in rows.items() if r.held_out]
    assert sum(rows[k].lang_pred == truth[k] for k in held) >= 0.95 * len(held)


def test_language_of_awkward_rows(llm_spark, awkward, nothing):
    path = public_tokenizers.path(queries.PIECES)
    model = language_id.fit(awkward.selectExpr("cast(doc_id as string) key", "lang", "text"), path)
    assert model.languages == ("de", "en", "fr", "xx")
    rows = awkward.select("text", language_id.predict(llm_spark, model).alias("g")).collect()
    for r in rows:
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["g"]["lang"] == "und") == (not lettered) and 0 <= r["g"]["score"] <= 1
    empty = language_id.fit(nothing.selectExpr("cast(doc_id as string) key", "lang", "text"), path)
    assert empty.languages == ()
    assert {tuple(r["g"]) for r in awkward.select(language_id.predict(llm_spark, empty).alias("g")).collect()} == {("und", 0.0)}


def test_the_sample_is_bounded(llm_spark):
    rows = [(str(i), "en" if i % 3 else "de", f"text {i}") for i in range(900)]
    df = llm_spark.createDataFrame(rows, "key string, lang string, text string")
    settings = language_id.Settings(documents=40)
    counts = {r["lang"]: r["count"] for r in language_id._sample(df, settings).groupBy("lang").count().collect()}
    assert set(counts) == {"en", "de"} and all(25 <= n <= 40 for n in counts.values())
