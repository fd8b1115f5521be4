from __future__ import annotations

import subprocess
import sys
import zlib
from functools import cache
from pathlib import Path

import numpy as np
import plain
import pytest
from compare import SMALL

import corpus_pipeline
from lorebed.llm import langid, pieces, queries
from lorebed.llm.queries import PIECES_FILE

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and result, written and read again."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SMALL).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def test_columns(stages):
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


@cache
def bucket(gram: str) -> int:
    data = np.frombuffer(gram.encode(), np.uint8)
    return int(langid.char_grams(data, np.array([0, len(data)]), 3, 16)[0][0])


def test_language_stage(spark, stages):
    """Against naive Bayes in plain Python, learnt from the documents of the same folds."""
    _, before, after = stages[0]
    rows = sorted((r.doc_id, r.text, r.lang) for r in before.collect())
    train = [(t, lang) for k, t, lang in rows if zlib.crc32(str(k).encode()) % 5]
    found = plain.languages(train, [t for _, t, _ in rows], bucket)
    unsure = {k for (k, _, _), (_, score) in zip(rows, found) if abs(score - 0.5) < 1e-9}
    want = {k for (k, _, _), (lang, score) in zip(rows, found) if lang != "und" and score >= 0.5}
    assert {r.doc_id for r in after.collect()} - unsure == want - unsure


def test_language_query_against_plain(spark, stages):
    rows = sorted((r.doc_id, r.text, r.lang) for r in stages[0][1].collect())
    want = plain.languages([(t, lang) for k, t, lang in rows if zlib.crc32(str(k).encode()) % 5], [t for _, t, _ in rows], bucket)
    got = {r.doc_id: r for r in queries.op5_language_id(spark, SMALL).collect()}
    for (k, _, _), (lang, score) in zip(rows, want):
        assert (got[k].lang_pred, got[k].held_out) == (lang, zlib.crc32(str(k).encode()) % 5 == 0) and got[k].score == pytest.approx(score)


def test_line_stage(stages):
    _, before, after = stages[1]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    gone = plain.without_lines(rows)
    left = {k: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[k]) for k, t in rows}
    assert {r.doc_id: r.text for r in after.collect()} == {k: t for k, t in left.items() if not gone[k] or t.strip()}
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_copies_stage(stages):
    _, before, after = stages[2]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    want = {min(rows[j][0] for j in members) for members, _ in plain.classes(rows).values()}
    assert {r.doc_id for r in after.collect()} == want


def test_benchmark_stage(spark, stages):
    _, before, after = stages[3]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = {k for k, v in plain.contaminated([(r.doc_id, r.text) for r in before.collect()], items).items() if not v[3]}
    assert {r.doc_id for r in after.collect()} == want


def test_pieces_stage_and_run(spark, stages):
    _, before, after = stages[4]
    back = {r.doc_id: r.text for r in pieces.decode(after, pieces.load(PIECES_FILE)).collect()}
    assert back == {r.doc_id: r.text for r in before.collect()}
    assert sorted(corpus_pipeline.run(spark, SMALL).select("doc_id", "n_tokens").collect()) == sorted(after.select("doc_id", "n_tokens").collect())


def test_stages_of_no_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, items string"
    odd = [
        (1, None, None, None, None, "a", "b"), (2, "", "en", "s", 0, "a", "b"), (None, "words of a text here", None, "s", 20, "a", "b"),
        (3, "words of a text here", "en", "s", 20, "c", "d"), (3, "words of a text here", "en", "s", 20, "c", "d")
    ]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, SMALL)
            assert kept.columns == docs.columns and {r.score for r in kept.collect()} <= {"a", "c"} and {r["items"] for r in kept.collect()} <= {"b", "d"}
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == len(rows)


def test_entry_without_these_folders():
    code = "import sys; sys.modules['lorebed.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
