import shutil
import subprocess
import sys
from pathlib import Path

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import stages

from .conftest import AWKWARD, SMALL
from .test_near_and_exact_repeats import plain_components, plain_fingerprint, plain_repeats

REPO = Path(__file__).resolve().parents[2]
GOOD = " ".join(f"word{i} und the of more{i * i}" for i in range(40))


def test_stages_against_plain_code(llm_spark):
    docs = llm_spark.read.parquet(f"{SMALL}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language ID", "quality rules", "SimHash near-dedup", "suffix-array dedup", "packing"]
    columns = docs.columns
    known = steps["language ID"](llm_spark, docs, SMALL)
    assert known.columns == columns and known.count() == docs.where("text rlike '\\\\p{L}'").count()
    good = steps["quality rules"](llm_spark, known, SMALL).persist()
    assert good.columns == columns and 0 < good.count() < known.count()
    before = {r.doc_id: r for r in good.collect()}
    single = steps["SimHash near-dedup"](llm_spark, good, SMALL).persist()
    prints = [(k, plain_fingerprint(r.text)) for k, r in before.items()]
    want = plain_components(prints, 4)
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(want.values()))
    cut = steps["suffix-array dedup"](llm_spark, single, SMALL).persist()
    rows = {r.doc_id: r for r in cut.collect()}
    left = single.orderBy("doc_id").collect()
    assert cut.columns == columns and len(rows) == len(left)
    for r, (removed, _, kept) in zip(left, plain_repeats([r.text.encode() for r in left], 200)):
        assert rows[r.doc_id].text == (kept.decode("utf-8", "ignore") if removed else r.text)
        assert rows[r.doc_id].n_chars == len(rows[r.doc_id].text)
        assert (rows[r.doc_id].lang, rows[r.doc_id].source) == (r.lang, r.source)
    pieces = steps["packing"](llm_spark, cut, SMALL).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in rows.values())
    assert sum(p.length for p in pieces) == total


def test_run_applies_all_stages(llm_spark):
    packed = corpus_pipeline.run(llm_spark, SMALL)
    assert packed.columns[:3] == ["doc_id", "start", "length"] and packed.count() > 0


def test_stages_on_awkward_rows(llm_spark, awkward, nothing):
    for step in (stages.keep_known_language, stages.keep_good_quality, stages.keep_one_of_near_duplicates, stages.remove_repeated_strings):
        assert step(awkward).columns == awkward.columns
        assert step(nothing).count() == 0
    known = stages.keep_known_language(awkward)
    assert {r.doc_id for r in known.collect()} >= {None, 4, 5, 7, 9} and known.count() == 8
    single = stages.keep_one_of_near_duplicates(awkward)
    want = plain_components([(k, plain_fingerprint(t)) for k, t, *_ in AWKWARD], 4)
    assert single.count() == len(set(want.values()))
    assert sorted(r.doc_id for r in single.collect() if r.doc_id is not None) == sorted(v for v in set(want.values()) if v is not None)
    cut = stages.remove_repeated_strings(awkward)
    assert cut.count() == len(AWKWARD)
    assert [r.text for r in cut.where("doc_id in (1, 6)").orderBy("doc_id").collect()] == [None, AWKWARD[7][1]]


def test_copies_leave_one_document(llm_spark):
    rows = [(5, GOOD), (5, GOOD), (3, GOOD), (None, GOOD), (9, GOOD + " end")]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string")
    assert [tuple(r) for r in stages.keep_one_of_near_duplicates(docs).collect()] == [(3, GOOD)]
    nulls = docs.where("doc_id is null")
    assert stages.keep_one_of_near_duplicates(nulls.union(nulls)).count() == 1
    cut = stages.remove_repeated_strings(docs.where("doc_id = 5"))
    assert [r.text for r in cut.collect()] == ["", ""]


def test_entry_without_the_text_operators(tmp_path):
    shutil.copytree(REPO, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), [k for k in q if k.startswith(('op', 'pipeline'))])"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True)
    assert done.returncode == 0 and done.stdout.strip().endswith("[]")
