"""Decontamination against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tillcast.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - 12, 1) if w else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    found |= own
        out.append((doc or 0, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def rows_of(df):
    return sorted((r.doc_id or 0, r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in df.collect())


@pytest.mark.parametrize("small", [True, False])
def test_equals_brute_force(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(dc, "small_enough", lambda df, **k: False)
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(30)] + ["É", "the", "Of"]
    text = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", "", ",", "\n"]) for _ in range(n))
    items = [(i, text(rng.randint(0, 30))) for i in range(30)] + [(40, "the"), (41, "of the w1"), (42, None), (43, "?!"), (44, "w1 w2 " * 30), (10, "the")]
    docs = [(i, text(rng.randint(0, 60)) + rng.choice(["", " " + (items[rng.randrange(30)][1]).upper()]) + " " + text(5)) for i in range(1, 121)]
    docs += [(500, None), (501, ""), (None, "the the"), (502, items[3][1]), (502, items[3][1]), (503, "x " * 40_000 + (items[4][1] or ""))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as line", "2 as n_words", "3 as shingle")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "4 as words")
    want = brute(docs, items)
    assert rows_of(dc.contamination(frame, bench)) == want
    clean = dc.keep_clean(frame, bench)
    bad = {r[0] or 0 for r in want if r[4]}  # a row without an id has its own verdict, too
    assert clean.columns == frame.columns
    assert sorted(r.doc_id or 0 for r in clean.collect()) == sorted((d or 0) for d, _ in docs if (d or 0) not in bad)


@pytest.mark.parametrize("small", [True, False])
def test_shared_passage_is_joined_as_rows(spark, monkeypatch, small):
    tables = {}
    keep = dc.stored
    monkeypatch.setattr(dc, "stored", lambda df, name: tables.setdefault(name, keep(df, name)))
    if not small:
        monkeypatch.setattr(dc, "small_enough", lambda df, **k: False)
    passage = " ".join(f"p{i}" for i in range(16))
    items = [(i, f"{passage} own{i}") for i in range(60)] + [(None, passage)]
    docs = [(i, f"{passage} and {passage} text{i}") for i in range(1, 20)] + [(20, "nothing of it")]
    got = rows_of(dc.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    assert got == sorted((i, len(words(t)), 32 if i < 20 else 0, sorted(map(str, range(60))) if i < 20 else [], i < 20) for i, t in docs)
    assert "array<string>" not in {kind for t in ("prefixes", "hits", "owners") for _, kind in tables[t].dtypes}


def test_full_bit_table_loses_nothing(spark):
    items = [(1, "a b c d e f g h i j k l m n o"), (2, "x y")]
    docs = [(1, "z a b c d e f g h i j k l m n o z"), (2, "y x y x"), (3, "q")]
    p = dc.Decontamination(table_bits=6)
    got = rows_of(dc.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), p))
    assert got == brute(docs, items)


def test_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert rows_of(dc.contamination(docs, items)) == [(1, 2, 0, [], False)]
    assert dc.contamination(docs.limit(0), items).count() == 0


def test_rows_with_one_id_get_each_their_own_verdict(spark):
    passage = " ".join(f"bench{i}" for i in range(20))
    items = spark.createDataFrame([("i", passage)], "item_id string, text string")
    rows = [(1, "all clean here"), (1, passage), (None, passage), (None, "clean too"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bad_key", F.lit("clash"))
    kept = dc.keep_clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "clean too"), (1, "all clean here"), (2, "")]
