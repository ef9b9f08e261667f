"""SentencePiece coding against the library itself."""

import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF_SMALL
from tillcast.llm import piece_codec as pc


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=pc.default_model())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abcdething  \n\t.,'\"<>0123▁éß你ſḰ\x00😀_-=(){}²")), max_size=60))
def test_equals_library_on_random_texts(text):
    c = pc.codec(pc.default_model())
    assert c.encode(text) == c.processor.encode(text)
    assert c.decode(c.encode(text)) == c.processor.decode(c.processor.encode(text))


def test_backtracking_equals_merging():
    c = pc.codec(pc.default_model())
    rng = random.Random(5)
    for _ in range(2000):
        word = "".join(rng.choice("aeinrstlhéü") for _ in range(rng.randint(1, 14)))
        assert c.backtrack("▁" + word) == c.merge("▁" + word) == c.merge_long("▁" + word)


def test_long_texts_and_runs(lib):
    c = pc.codec(pc.default_model())
    for text in ("ab" * 20_000, " " * 5_001, "q" * 30_000, "\n" * 1_000 + " x" * 1_000):
        assert c.encode(text) == lib.encode(text)


def test_caches_are_bounded(monkeypatch):
    monkeypatch.setattr(pc, "CACHED_CHUNKS", 5)
    monkeypatch.setattr(pc, "CACHED_PAIRS", 5)
    c = pc.PieceCodec(pc.default_model())
    text = " ".join(f"word{i}x" for i in range(200))
    assert c.encode(text) == c.processor.encode(text)
    assert c.encode("some more") == c.processor.encode("some more")
    texts = [" ".join(f"w{i % 7}x{j}" for j in range(4)) for i in range(60)]
    assert [x.tolist() for t in texts for x in c.coded_many([t])] == [c.processor.encode(t) for t in texts]
    assert len(c.table.hashes) <= 5 + 8 and c.n_pairs <= 5 + 1 and sum(map(len, c.pairs.values())) <= 5 + 1


def test_chunks_are_the_matches_of_the_cuts():
    import re

    import numpy as np

    rng = random.Random(8)
    for level, cut in enumerate(pc.CUTS):
        for _ in range(300):
            texts = ["".join(rng.choice("▁▁aZéÖ×÷ɏɐ1.日\n😀") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 4))]
            points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
            rows = np.cumsum([0, *map(len, texts)])[:-1].astype(np.int64)
            starts = pc.chunk_starts(points, rows, level).tolist()
            whole, want = "".join(texts), [x for t in texts for x in re.findall(cut, t)]
            assert [whole[a:b] for a, b in zip(starts, [*starts[1:], len(whole)])] == want


def test_a_worker_gives_up_tables_of_other_operators():
    from tillcast.llm import common

    mine, other = common.worker_tables("mine"), common.worker_tables("other")
    mine["a"], other["b"] = 1, 2
    common.use_only("mine")
    assert mine == {"a": 1} and other == {}
    common.use_only(None)
    assert mine == {}


def test_table_equals_library(spark, lib):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: r for r in pc.code_digests(docs).collect()}
    for r in docs.collect():
        ids = lib.encode(r.text or "")
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "", 6), (3, "Hi  there", 7)], "doc_id long, text string, row_id int")
    rows = pc.encode_texts(docs).collect()
    assert sorted((r.doc_id or 0, len(r.token_ids), r.decoded) for r in rows) == [(0, 0, ""), (1, 0, ""), (1, 0, ""), (3, 3, "Hi  there")]
    assert pc.code_digests(docs.limit(0)).count() == 0


def test_ids_are_handed_on_slice_by_slice(spark, monkeypatch):
    """No batch of ids and texts is larger than a slice; rows keep their order and number."""
    docs = spark.createDataFrame([(i, None if i % 7 == 0 else f"text {i} " * 40) for i in range(60)], "doc_id long, text string").coalesce(1)
    sizes = []
    monkeypatch.setattr(pc, "SLICE", 2000)
    monkeypatch.setattr(pc, "map_arrow", lambda df, fn, schema, tables: sizes.extend(
        [len(x["token_ids"]) for b in df.toArrow().combine_chunks().to_batches() for x in fn(b)]) or docs.withColumnRenamed("doc_id", "row_id"))
    pc.encode_texts(docs)
    assert sum(sizes) == 60 and len(sizes) > 5 and max(sizes) < 20


def test_pieces_that_do_not_fit_are_tried_once(lib):
    """Also where pieces are taken back: a chunk of known steps asks for no pair again."""
    c = pc.PieceCodec(pc.default_model())
    words = ["menteuxelle", "annding", "onshes", "einzube", "ofthhawhen", "vianré", "réeuxelle", "日本語x"]
    first = c.encode(" ".join(words))
    assert first == lib.encode(" ".join(words)) and c.n_steps
    c.table.empty()
    asked = []
    c.fits = lambda a, b: asked.append((a, b)) or pc.PieceCodec.fits(c, a, b)
    c.pairs.clear()
    assert c.encode(" ".join(words)) == first and not asked


def test_steps_are_bounded(monkeypatch, lib):
    monkeypatch.setattr(pc, "CACHED_STEPS", 5)
    c = pc.PieceCodec(pc.default_model())
    for i in range(60):
        text = f"word{i}x menteuxelle annding {i * 37} 日本é"
        assert c.encode(text) == lib.encode(text)
        assert c.n_steps <= 5 and len(c.after) <= 5 and len(c.first) + sum(len(own) for _, own, _, _, _ in c.after.values()) <= 5
