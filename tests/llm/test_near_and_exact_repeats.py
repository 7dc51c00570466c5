import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import xxhash

from pyspark.sql import functions as F
from tidemark.llm import covering_simhash, graph, queries, scaled_sketch, suffix_dedup
from tidemark.llm.suffix_runs import LoserTree, common, common_in_order, decoded, front_coded

from .conftest import AWKWARD, SMALL


def plain_fingerprint(text):
    words = [w for w in (text or "").translate({c: " " for c in b"\t\n\x0b\f\r"}).split(" ") if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """Least id reachable for each fingerprint, over all pairs."""
    ids = defaultdict(list)
    for key, value in prints:
        ids[value].append(key)
    values, found = list(ids), {}
    for value in values:
        if value in found:
            continue
        group, queue = {value}, [value]
        while queue:
            at = queue.pop()
            near = {v for v in values if v not in group and (v ^ at).bit_count() <= radius}
            group |= near
            queue.extend(near)
        keys = [k for v in group for k in ids[v] if k is not None]
        found |= dict.fromkeys(group, min(keys) if keys else None)
    return found


def test_simhash_against_all_pairs(llm_spark, documents):
    prints = [(k, plain_fingerprint(t)) for k, t in documents]
    want = plain_components(prints, 4)
    rows = queries.QUERIES["op4_covering_simhash"](llm_spark, SMALL).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows) == sorted((k, f"{v:016x}", want[v]) for k, v in prints)


def test_simhash_of_awkward_rows(awkward, nothing):
    values = [r["p"] for r in awkward.select(covering_simhash.simhash("text").alias("p")).collect()]
    assert [v % (1 << 64) for v in values] == [plain_fingerprint(t) for _, t, *_ in AWKWARD]
    assert nothing.select(covering_simhash.simhash("text")).count() == 0


def test_every_pair_within_the_radius_shares_a_bucket():
    rng = random.Random(1)
    for positions in (list(range(64)), sorted(rng.sample(range(64), 31))):
        masks = covering_simhash.masks(positions, 4)
        assert len(masks) == 31
        for _ in range(3_000):
            flips = sum(1 << b for b in rng.sample(positions, rng.randint(1, 4)))
            assert any(m & flips == 0 for m in masks)


def test_links_with_small_and_large_buckets(llm_spark):
    rng = random.Random(2)
    prints = []
    for _ in range(6):
        base = rng.getrandbits(64)
        prints += [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(60)]
    prints += [rng.getrandbits(64) for _ in range(300)] + [0, (1 << 64) - 1, 1 << 63]
    rows = [(i, int(np.uint64(p).astype(np.int64))) for i, p in enumerate(prints)] + [(0, 5), (None, 7)]
    want = plain_components([(k, v % (1 << 64)) for k, v in rows], 4)
    df = llm_spark.createDataFrame(rows, "id long, print long")
    for bucket in (4, 8_192):
        found = covering_simhash.near_duplicates(df, covering_simhash.Settings(bucket=bucket)).collect()
        assert {r["print"] % (1 << 64): r["component_id"] for r in found} == want
    assert covering_simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_paths_and_stars(llm_spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (201, 200), (200, 201)]
    found = graph.components(llm_spark.createDataFrame(links, "a long, b long")).collect()
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)} | {200: 200, 201: 200}
    assert sorted((r["node"], r["root"]) for r in found) == sorted(want.items())


def plain_repeats(texts, length):
    """(removed bytes, spans, kept) of each text, string by string."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    found = []
    for t in texts:
        covered = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        spans = sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))
        found.append((sum(covered), spans, bytes(b for b, c in zip(t, covered) if not c)))
    return found


def test_suffix_dedup_against_all_strings(llm_spark, documents):
    want = plain_repeats([t.encode() for _, t in documents], 200)
    rows = {r.doc_id: r for r in queries.QUERIES["op6_suffix_dedup"](llm_spark, SMALL).collect()}
    assert len(rows) == len(documents)
    for (key, text), (removed, spans, kept) in zip(documents, want):
        r = rows[key]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(text.encode()), removed, spans, sha256(kept).hexdigest())


def made_repeats():
    rng = random.Random(3)
    noise = lambda n: "".join(rng.choice("abcdefghij kl\né") for _ in range(n)).encode()
    passages = [noise(n) for n in (199, 200, 201, 230, 400, 1_000)]
    texts = []
    for _ in range(60):
        parts = [noise(rng.randint(0, 150)) for _ in range(3)]
        picked = [rng.choice(passages) for _ in range(2)]
        texts.append(parts[0] + picked[0] + parts[1] + picked[1][rng.randint(0, 20) :] + parts[2])
    texts += [b"a" * 900, b"ab" * 300, b"xyz" * 90 + noise(50), b"", noise(199), noise(3_000), texts[0][:-1] + b"?", b"a" * 200, b"a" * 199]
    return texts


def test_suffix_dedup_on_made_texts(llm_spark):
    texts = made_repeats()
    want = plain_repeats(texts, 200)
    df = llm_spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, b binary")
    df = df.withColumn("text", F.col("b").cast("string"))
    for settings in (suffix_dedup.Settings(), suffix_dedup.Settings(run_bytes=20_000, part=50), suffix_dedup.Settings(often=3)):
        keys = df.select("i", *suffix_dedup.text_keys("text"))
        found = suffix_dedup.without_repeats(df, "text", settings)
        got = {r["i"]: r for r in keys.join(found, ["k1", "k2"]).collect()}
        for i, (removed, spans, kept) in enumerate(want):
            if removed:
                assert bytes(got[i]["kept"]) == kept and len(got[i]["spans"]) == spans, i
            else:
                assert i not in got


def test_suffix_dedup_of_awkward_rows(awkward, nothing):
    want = plain_repeats([(t or "").encode() for _, t, *_ in AWKWARD], 200)
    rows = sorted(queries.op6(awkward).collect(), key=lambda r: (r.n_bytes, r.doc_id or 0))
    expect = [(k, len((t or "").encode()), w) for (k, t, *_), w in zip(AWKWARD, want)]
    expect.sort(key=lambda x: (x[1], x[0] or 0))
    assert [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in rows] == [(k, n, w[0], w[1]) for k, n, w in expect]
    assert queries.op6(nothing).count() == 0


def test_front_coding_and_loser_tree():
    rng = random.Random(4)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).encode() for _ in range(700)]
    runs = [sorted(strings[i::7]) for i in range(7)] + [[]]
    for run in runs:
        assert [s for _, s in decoded(*front_coded(run))] == run
        assert common_in_order(run).tolist() == [common(a, b) for a, b in zip([b"", *run], run)]
    merged = list(LoserTree([decoded(*front_coded(r)) for r in runs]))
    assert [s for _, s, _ in merged] == sorted(strings)
    assert [k for k, _, _ in merged] == [common(a, b) for a, b in zip([b"", *sorted(strings)], sorted(strings))]
    assert list(LoserTree([])) == []


def plain_sketch(text, settings=scaled_sketch.Settings()):
    def h(value, seed=42):
        return xxhash.xxh64_intdigest(value, seed=seed)

    def chain(numbers):
        seed = 42
        for n in numbers:
            seed = h(n.to_bytes(8, "little"), seed)
        return seed - (1 << 64) if seed >> 63 else seed

    words = [h(w) for w in (text or "").encode().split()]
    found = {chain(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    low = sorted(x for x in found if x < settings.threshold)
    return low or sorted(found)[:1]


def test_sketch_against_plain_hashes(llm_spark, documents):
    rows = llm_spark.createDataFrame(documents, "k long, text string").select("k", scaled_sketch.sketch("text").alias("s")).collect()
    assert {r["k"]: r["s"] for r in rows} == {k: plain_sketch(t) for k, t in documents}


def test_edited_and_next_documents(llm_spark, documents):
    rows = {r.doc_id: r for r in queries.QUERIES["op5_scaled_sketch"](llm_spark, SMALL).collect()}
    assert len(rows) == len(documents)

    def alike(a, b):
        return 1.0 if not a and not b else len(set(a) & set(b)) / min(len(a), len(b)) if a and b else 0.0

    def as_text(s):
        return "".join(f"{x % (1 << 64):016x}" for x in s)

    for i, (key, text) in enumerate(documents):
        after = documents[(i + 1) % len(documents)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        a, b, c = plain_sketch(text), plain_sketch(edited), plain_sketch(after)
        r = rows[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (as_text(a), as_text(b))
        assert abs(r.near_edited - alike(a, b)) < 1e-12 and abs(r.near_next - alike(a, c)) < 1e-12


def test_sketches_merge(llm_spark):
    texts = [("a b c d e f g h " * 5, " ".join(map(str, range(500)))), ("", "x"), ("one two", "three four five"), (None, None)]
    df = llm_spark.createDataFrame(texts, "a string, b string")
    sketches = df.select(scaled_sketch.sketch("a").alias("a"), scaled_sketch.sketch("b").alias("b"))
    settings = scaled_sketch.Settings()
    for r in sketches.select("a", "b", scaled_sketch.merged(F.col("a"), F.col("b")).alias("m")).collect():
        both = sorted(set(r["a"]) | set(r["b"]))
        assert r["m"] == ([x for x in both if x < settings.threshold] or both[:1])


def test_sketch_of_awkward_rows(awkward, nothing):
    rows = queries.op5(awkward).collect()
    assert len(rows) == len(AWKWARD)
    ids = sorted({k for k, *_ in AWKWARD if k is not None})
    first = {k: min((t or "" for i, t, *_ in AWKWARD if i == k), key=len) for k in [None, *ids]}
    follow = dict(zip([None, *ids], [*ids, None]))
    for r in rows:
        texts = [t or "" for k, t, *_ in AWKWARD if k == r.doc_id and len(t or "") == r.n_chars]
        edits = {t[: len(t) - len(t) // 4] + first[follow[r.doc_id]][: len(t) // 4] for t in texts}
        assert r.edited_sha256 in {sha256(e.encode()).hexdigest() for e in edits}
    assert queries.op5(nothing).count() == 0
    one = queries.op5(awkward.where("doc_id = 6")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
