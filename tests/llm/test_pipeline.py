"""The corpus pipeline against plain versions of its stages, and the registration."""

import os
import subprocess
import sys

import duckdb
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_near_dedup import brute as components
from tests.llm.test_secret_scan import plain_spans
from tillcast.llm import piece_codec, secret_scan
from tillcast.llm.oracle import OP3

ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def test_pipeline_equals_plain_stages(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({OP3}) WHERE kept").fetchall()}
    docs = [r for r in con.execute("SELECT doc_id, text FROM documents").fetchall() if r[0] in good]
    of, _ = components(docs)
    docs = [r for r in docs if of[r[0]] == r[0]]
    bad = {r[0] for r in contaminated(docs, con.execute("SELECT item_id, text FROM benchmark").fetchall()) if r[4]}
    docs = {i: t for i, t in docs if i not in bad}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(got) == set(docs)
    lib = sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    added = {r.doc_id: r.spans for r in secret_scan.scan(frame).collect()}
    for i, text in docs.items():
        base = plain_spans(text)
        spans = sorted((int(a), secret_scan.KINDS.index(k), int(b)) for k, a, b in (x.split(":") for x in filter(None, added[i].split(","))))
        assert set(base) <= set(spans)
        clean = secret_scan.masked(text, spans, "[secret]")
        assert not plain_spans(clean) or not base
        assert got[i].token_ids == lib.encode(clean) and got[i].decoded == lib.decode(lib.encode(clean))


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, None, "en", "s", 0), (1, "", "en", "s", 0), (2, "w " * 200, None, None, 400)]])
def test_stages_take_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("kept_id", F.lit("clash"))
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_SMALL).collect()


def test_every_operator_is_registered_once():
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_library_works_without_the_operators(tmp_path):
    code = ("import sys\n"
            "class Hide:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('corpus_pipeline', 'tillcast.llm'):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Hide())\n"
            "import __spark_entry__ as e\n"
            "assert 'pipeline' not in e.queries() and not any(q.startswith('op1') for q in e.queries()) and e.oracle_sql()\n")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
