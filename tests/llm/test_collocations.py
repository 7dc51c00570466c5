import random
import re
from collections import Counter

import numpy as np

from tidemark.llm import collocations as C
from tidemark.llm import queries

from .conftest import AWKWARD, SMALL

SCHEMA = "lang string, text string"
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def expected(rows, settings):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, settings.longest + 1):
                counts.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    candidates = {k: n for k, n in counts.items() if len(k[1]) > 1 and n >= settings.least}
    dropped = set()
    for (lang, words), n in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                if 100 * n >= settings.covered * counts[lang, words[i : i + size]]:
                    dropped.add((lang, words[i : i + size]))
    found = {}
    for (lang, words), a in candidates.items():
        if (lang, words) not in dropped:
            cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
            score, k = min((1000 * a * totals[lang] // (l * r), k) for k, (l, r) in enumerate(cuts))
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), *cuts[k]))
    out = []
    for lang, rows in found.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[: settings.top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def mined(df, settings):
    got = C.collocations(C.frequent_phrases(df, settings), settings).collect()
    return sorted(tuple(r[c] for c in COLUMNS) for r in got)


def prose(seed, n):
    rng = random.Random(seed)
    names = ["new", "york", "City", "of", "the", "a", "être", "日本", "x#1", "o k", "\x1c", "it's"]
    for _ in range(n):
        words = [rng.choice(names) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", "\t", "  ", ". ", ",", "\n"]) for w in words)
        yield rng.choice(["en", "de", None, "und"]), text + rng.choice(["", "New York City hall, the city of the", " a a a a a a"])


def test_against_plain_counting(llm_spark):
    rows = list(prose(1, 120))
    df = llm_spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as print", "2 as n", "'p' as phrase", "3 as pointer").repartition(5)
    for settings in (C.Settings(least=4, top=50), C.Settings(least=3, held=16, words=5, filter_bits=10), C.Settings(least=9, longest=2, covered=60)):
        want = expected(rows, settings)
        assert want and mined(df, settings) == want


def test_the_smallest_table(llm_spark):
    import duckdb

    rows = duckdb.sql(f"select lang, text from '{SMALL}/documents.parquet'").fetchall()
    got = queries.QUERIES["op11_collocations"](llm_spark, SMALL).collect()
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got) == expected(rows, C.Settings())


def test_awkward_documents(llm_spark, awkward, nothing):
    settings = C.Settings(least=2)
    assert mined(awkward, settings) == expected([(r[2], r[1]) for r in AWKWARD], settings)
    assert queries.op11(nothing).count() == 0
    blank = llm_spark.createDataFrame([(None, None), ("en", ""), ("en", " ,.\t")], SCHEMA)
    assert mined(blank, settings) == []


def test_scores_beyond_64_bits(llm_spark):
    big = 9 * 10**12
    rows = [("en", 0, "", big), ("en", 1, "a", big // 3), ("en", 1, "b", 77), ("en", 2, "a b", 76), ("en", 1, "c", 2 * 10**9), ("en", 2, "c c", 10**9 + 7)]
    df = llm_spark.createDataFrame(rows, "lang string, size int, phrase string, n long")
    got = {r.phrase: r.score for r in C.collocations(df, C.Settings(least=1)).collect()}
    assert got == {"a b": 1000 * 76 * big // (big // 3 * 77), "c c": 1000 * (10**9 + 7) * big // (2 * 10**9) ** 2}


def test_equal_fingerprints_with_other_checks_stay_apart():
    prints = np.array([5, 5, 7, 5], np.uint64)
    checks = np.array([1, 2, 1, 1], np.uint64)
    sums = {}
    for print_, check, n, pointer in zip(*(c.tolist() for c in C.added(prints, checks, np.ones(4, np.int64), np.array([9, 8, 7, 6])))):
        known = sums.setdefault((print_, check), [0, pointer])
        known[0] += n
        known[1] = min(known[1], pointer)
    assert sums == {(5, 1): [2, 6], (5, 2): [1, 8], (7, 1): [1, 7]}


def test_prefix_polynomials_depend_on_words_order_and_language():
    powers = [C.Powers(base) for base in C.BASES]
    grams = C.Grams(["en", "en", "de"], [b"a b a b", b"b a. b", b"a b"], C.Vocabulary(), powers)
    at = np.flatnonzero(grams.whole(2))
    prints = grams.prints(2, at).tolist()
    assert len(at) == 5 and prints[0] == prints[2] != prints[1] == prints[3] and prints[4] not in prints[:4]
    assert not grams.whole(3)[-3:].any()
