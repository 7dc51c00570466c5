import base64
import random
import zlib
from hashlib import sha256
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import bin_slack, chunked_bpe, queries

from .conftest import AWKWARD, SMALL

WORDS = public_tokenizers.path(queries.WORDS)
RANKS = public_tokenizers.path(queries.RANKS)


@pytest.fixture(scope="module")
def word_ids():
    loaded = Tokenizer.from_file(WORDS)
    return lambda text: np.array([*loaded.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


@pytest.fixture(scope="module")
def byte_ids():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: own.encode_ordinary(text or "")


def check_pieces(rows, ids, window=4_096):
    """Every id of every document in one piece, sequences without gaps; returns the padding."""
    covered, sequences = {}, {}
    for r in rows:
        own = ids[r.doc_id]
        part = own[r.start : r.start + r.length]
        assert r.doc_tokens == len(own) and len(part) == r.length > 0
        assert zlib.crc32(part.tobytes()) == r.ids_crc32
        covered.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for key, own in ids.items():
        at = 0
        for start, length in sorted(covered[key]):
            assert start == at
            at += length
        assert at == len(own)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / (window * len(sequences))


def test_packing_of_documents(llm_spark, documents, word_ids):
    rows = queries.QUERIES["op2_bin_slack"](llm_spark, SMALL).collect()
    assert check_pieces(rows, {k: word_ids(t) for k, t in documents}) < 0.03


def test_packing_of_awkward_rows(awkward, nothing, word_ids):
    numbered = awkward.where("doc_id is not null and doc_id <> 4")
    kept = {k: word_ids(t) for k, t, *_ in AWKWARD if k not in (None, 4)}
    check_pieces(queries.op2(numbered).collect(), kept)
    rows = queries.op2(awkward).collect()
    assert sum(r.length for r in rows) == sum(len(word_ids(t)) for _, t, *_ in AWKWARD)
    assert queries.op2(nothing).count() == 0


def test_words_encode_as_the_whole_text(word_ids):
    rng = random.Random(1)
    alphabet = ["a", "B", "Éa", "ß", "it's", "'S", "don't", " ", "\n", "\t", "\x0b", " ", "\x85", "12", "...", "##", "é", "é", "İ", "Σ", "ΑΣ", "日本", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "<|ENDOFTEXT|>", "\U0001f600", "word,", "x.y", "ÿ"]
    encoder = bin_slack.WordEncoder(WORDS, bin_slack.Settings(kept=20, block=7))
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    assert list(encoder.ids([t.encode() for t in texts])) == [word_ids(t).tobytes() for t in texts]


def test_special_strings_have_their_ids(word_ids):
    """As the plain call of the tokenizer has it."""
    encoder = bin_slack.WordEncoder(WORDS, bin_slack.Settings())
    (found,) = encoder.ids([b"end <|endoftext|>more,<|startoftext|> x"])
    ids = np.frombuffer(found, "<u4").tolist()
    assert ids.count(49407) == 1 and ids.count(49406) == 1
    assert ids == word_ids("end <|endoftext|>more,<|startoftext|> x").tolist()


def test_fullest_against_all_choices():
    rng = random.Random(2)
    for _ in range(200):
        lengths = sorted({rng.randint(1, 12) for _ in range(4)}, reverse=True)
        counts = {n: rng.randint(1, 3) for n in lengths}
        room = rng.randint(0, 30)
        used = bin_slack.fullest(counts, lengths, room)
        assert all(0 < n <= counts[k] for k, n in used.items())
        best = max(
            sum(c)
            for size in range(13)
            for c in combinations_with_replacement(lengths, size)
            if sum(c) <= room and all(c.count(k) <= counts[k] for k in lengths)
        )
        assert sum(k * n for k, n in used.items()) == best


def test_packed_places_every_piece():
    rng = np.random.default_rng(3)
    lengths = np.concatenate([rng.integers(1, 100, 3_000), [100] * 20])
    number, offset = bin_slack.packed(lengths, 100)
    sums = np.bincount(number, lengths)
    assert sums.max() <= 100 and sums.mean() > 99
    order = np.lexsort((offset, number))
    starts = np.concatenate([[0], np.cumsum(lengths[order])[:-1]])
    first = np.concatenate([[0], np.cumsum(sums)[:-1]])[number[order]]
    assert (starts - first == offset[order]).all()
    assert bin_slack.packed(np.zeros(0, np.int64), 100)[0].size == 0


def test_bytes_of_documents(llm_spark, documents, byte_ids):
    rows = {r.doc_id: r for r in queries.QUERIES["op7_chunked_bpe"](llm_spark, SMALL).collect()}
    assert len(rows) == len(documents)
    for key, text in documents:
        ids = byte_ids(text)
        want = (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(text.encode()).hexdigest())
        assert (rows[key].n_tokens, rows[key].ids_sha256, rows[key].decoded_sha256) == want


@pytest.mark.parametrize(("chunk", "overlap"), [(16, 8), (30, 5), (7, 2), (64, 64)])
def test_chunks_encode_as_the_whole_text(llm_spark, byte_ids, chunk, overlap):
    rng = random.Random(chunk)
    alphabet = ["a", "b", " ", "  ", "\n", "\t", "'", "'re", "'ll", "1", "23", "é", "日", "!", "??", "x'", "’", "\U0001f600", "\x1c", "٣", "Ⅷ"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300))) for _ in range(150)]
    texts += ["a" * 500, " " * 300, None, "", "a" * 37 + " " * 100 + "b" * 90, texts[0], texts[0]]
    rows = [(i % 150, t) for i, t in enumerate(texts)]
    df = llm_spark.createDataFrame(rows, "id long, text string").repartition(3)
    settings = chunked_bpe.Settings(chunk=chunk, overlap=overlap, kept=50)
    got = chunked_bpe.encode(df, "id", "text", RANKS, public_tokenizers.PATTERN, settings).collect()
    assert sorted((r["id"], r["ids"]) for r in got) == sorted((k, byte_ids(t)) for k, t in rows)


def test_bytes_of_awkward_rows(awkward, nothing, byte_ids):
    rows = queries.op7(awkward).collect()
    want = [(k, len(byte_ids(t)), sha256((t or "").encode()).hexdigest()) for k, t, *_ in AWKWARD]
    assert sorted(((r.doc_id, r.n_tokens, r.decoded_sha256) for r in rows), key=str) == sorted(want, key=str)
    assert queries.op7(nothing).count() == 0
