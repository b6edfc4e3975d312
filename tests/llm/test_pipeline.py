from __future__ import annotations

import os
import shutil

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from changecapture.llm.queries import SENTENCEPIECE_MODEL

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def document(i):
    """Prose of 80 words of its own."""
    return " ".join(f"word{(i * 37 + k * k) % 101}x{i} and the" for k in range(27))


@pytest.fixture
def docs(spark):
    texts = {i: document(i) for i in range(1, 31)}
    line = "this very long line stands in some documents and is a copy in all but one"
    texts[3] += "\n" + line
    texts[4] += "\n" + line
    texts[40] = texts[5]
    texts[41] = texts[6] + " end"
    texts[42] = "%%% 123 ..."
    texts[43] = None
    texts[44] = ""
    texts[45] = "\n" + line
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    rows += [(None, document(99), None, None, None), (46, document(50), "en", "s", 1), (46, document(50), "en", "s", 1)]
    return spark.createDataFrame(rows, SCHEMA)


def test_stages(spark, docs, tmp_path):
    item = "what is the right answer to this long question of the benchmark that nobody should see"
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    leak = spark.createDataFrame([(60, document(60) + " " + item, "en", "s", 9)], SCHEMA)
    given = docs.unionByName(leak)
    after = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        given = corpus_pipeline.written(stage(spark, given, str(tmp_path)))
        assert given.columns == COLUMNS
        after.append({(r.doc_id): r for r in given.collect()})
    first, lines, near, clean = after
    assert set(first) == {*range(1, 31), 40, 41, 45, 46, 60, None}
    # nothing is left of an exact copy, and of a document of one copied line
    assert set(lines) == set(first) - {40, 45}
    assert "\n" in lines[3].text and lines[4].text == document(4) and lines[4].n_chars == len(document(4))
    assert set(near) == set(lines) - {41}
    assert set(clean) == set(near) - {60}
    ids = {r.doc_id: r.ids for r in corpus_pipeline.STAGES[-1][1](spark, given, str(tmp_path)).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=SENTENCEPIECE_MODEL)
    assert ids == {k: library.encode(r.text) for k, r in clean.items()}
    assert given.where("doc_id = 46").count() == 1


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_run(spark, data):
    got = corpus_pipeline.run(spark, data)
    n = spark.read.parquet(f"{data}/documents.parquet").count()
    kept = got.count()
    assert 0.7 * n < kept < n
    assert got.where(F.size("ids") == 0).count() == 0


def test_the_rest_stands_without_this_part(tmp_path):
    """The entry file works, and names no operator, where the subpackage is missing."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent.parent
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", "corpus_pipeline.py")
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=skip)
    code = "import __spark_entry__ as e; print(sorted(n for n in e.queries() if n[:2] == 'op' and n[2].isdigit()), 'pipeline' in e.queries(), len(e.oracle_sql()) > 50)"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env=os.environ)
    assert done.stdout.split("\n")[0] == "[] False True", done.stderr
