import random
import re

import numpy as np

from tidemark.llm import graph, minhash, queries, runtime

from .conftest import AWKWARD, SMALL


def shingle_set(text):
    words = re.findall(r"[^ \t\n\x0b\x0c\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) > 2 else {tuple(words)} - {()}


def expected(rows):
    """(doc_id, n_shingles, component_id, kept) over all pairs."""
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if 100 * min(len(sets[i]), len(sets[j])) >= 85 * max(len(sets[i]), len(sets[j])) > 0:
                common = len(sets[i] & sets[j])
                if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                    parent[root(i)] = root(j)
    out = []
    for k, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if sets[k] and root(j) == root(k) and rows[j][0] is not None]
        least = min(ids, default=None) if sets[k] else doc
        out.append((doc, len(sets[k]), least, doc == least))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in queries.op12(df).collect()), key=str)


def near_copies(seed, families, most):
    """Texts at overlaps around the threshold, in chains and in dense groups."""
    rng = random.Random(seed)
    for _ in range(families):
        base = [f"w{rng.randrange(5_000)}" for _ in range(rng.randint(30, 160))]
        for _ in range(rng.randint(1, most)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 14))):
                text[rng.randrange(len(text))] = f"x{rng.randrange(5_000)}"
            base = text if rng.random() < 0.4 else base
            yield " ".join(text)


def test_components_against_all_pairs(llm_spark):
    rows = [(k, text) for k, text in enumerate(near_copies(4, 60, 9))]
    df = llm_spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found(df) == expected(rows)


def test_a_dense_group_with_unlinked_neighbours(llm_spark):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(150):  # half of them short of the threshold to most others
        text = list(base)
        for at in rng.sample(range(120), 1 if k % 2 else 5):
            text[at] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(text)))
    df = llm_spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(df) == expected(rows)
    small = minhash.Settings(bucket=8, share=5, block=20)  # buckets dealt out again, sets handed to shares, small blocks
    ids = minhash.near_duplicates(df.selectExpr("doc_id as id", "text"), small).collect()
    assert sorted(((r.id, r.n_shingles, r.component_id, r.id == r.component_id) for r in ids), key=str) == expected(rows)


def test_query_against_all_pairs(llm_spark, documents):
    got = queries.QUERIES["op12_minhash"](llm_spark, SMALL).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == expected(documents)


def test_awkward_documents(awkward, nothing):
    rows = [(r[0], r[1]) for r in AWKWARD]
    want = [(d, n, c, (d == c)) for d, n, c, _ in expected(rows)]
    assert found(awkward) == sorted(want, key=str)
    assert found(nothing) == []


def test_short_texts_are_one_shingle(llm_spark):
    rows = [(3, "a B"), (2, "A  b"), (1, "a b c"), (4, "a"), (5, "a"), (6, " "), (7, None), (8, "b a")]
    assert found(llm_spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


def test_minima_estimate_the_overlap():
    settings, rng = minhash.Settings(), np.random.default_rng(3)
    for share in (0.2, 0.6, 0.85):
        pool = rng.integers(0, 1 << 64, 4_000, dtype=np.uint64)
        common = int(2_000 * share)
        sets = [pool[:2_000], np.concatenate([pool[:common], pool[2_000 : 4_000 - common]])]
        a, b = minhash.minima(sets, settings)
        overlap = common / (4_000 - common)
        assert abs((a == b).mean() - overlap) < 0.15
    assert settings.least_agreement < 0.75 * settings.minima


def linked_numbers(spark, rows):
    return spark.createDataFrame(rows, "a long, b long").repartition(3)


def test_roots_take_few_rounds(llm_spark, monkeypatch):
    steps = []
    monkeypatch.setattr(graph, "stored", lambda df, purpose: steps.append(purpose) or runtime.stored(df, purpose))
    stars = [(1, k) for k in range(2, 40)] + [(50, 60), (60, 50), (50, 70), (80, 80)]
    want = {**{k: 1 for k in range(1, 40)}, **dict.fromkeys((50, 60, 70), 50)}
    assert {(r.node, r.root) for r in graph.components(linked_numbers(llm_spark, stars)).collect()} == set(want.items())
    assert steps == ["links", "least"]  # stars are seen as such; another round would write four tables more
    path = [(k, k + 1) for k in range(1, 33)] + [(40, 41)]
    steps.clear()
    roots = graph.tree_roots(linked_numbers(llm_spark, path))
    assert sorted(tuple(r) for r in roots.collect()) == [*((k, 1) for k in range(1, 34)), (40, 40), (41, 40)]
    assert len(steps) <= 7
    further = graph.joined_roots(roots, linked_numbers(llm_spark, [(40, 1), (100, 40), (101, 102)]))
    want = {**{k: 1 for k in range(1, 34)}, 40: 1, 41: 1, 100: 1, 101: 101, 102: 101}
    assert sorted(tuple(r) for r in further.collect()) == sorted(want.items())
    for find in (graph.components, graph.tree_roots):
        assert find(linked_numbers(llm_spark, path).limit(0)).count() == 0
