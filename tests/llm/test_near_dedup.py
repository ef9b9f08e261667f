"""Near-dedup and connected components against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tillcast.llm import near_dedup as nd
from tillcast.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(UPPER))
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def brute(rows):
    """{id: component} by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def noisy_group(rng, start, n, words, most):
    base = [f"g{start}w{rng.randint(0, 400)}" for _ in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(len(w))] = f"n{rng.randint(0, 10**6)}"
        out.append((start + i, " ".join(w)))
    return out


def test_equals_brute_force_on_noisy_groups(spark):
    rng = random.Random(3)
    rows = [r for g, (n, words, most) in enumerate([(120, 120, 9), (60, 40, 4), (40, 7, 2), (30, 300, 30), (30, 12, 1)]) for r in noisy_group(rng, 1000 * g, n, words, most)]
    passage = " ".join(f"p{i}" for i in range(90))
    rows += [(9000 + i, passage + " " + " ".join(f"u{i}x{j}" for j in range(rng.randint(10, 80)))) for i in range(60)]
    rows += [(9500, "one two"), (9501, "One  TWO"), (9502, ""), (9503, " \n"), (9504, "one"), (9505, "a b c d e"), (9506, "A b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row_id", F.lit("clash")).withColumn("component", F.lit(1))
    want, sizes = brute(rows)
    got = {r.doc_id: r for r in nd.near_duplicates(docs).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == sizes
    assert all(r.kept == (i == want[i]) for i, r in got.items())
    kept = nd.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_without_broadcasts(spark, monkeypatch):
    docs = spark.createDataFrame(noisy_group(random.Random(4), 0, 80, 100, 8), "doc_id long, text string")
    one = sorted(map(tuple, nd.near_duplicates(docs).collect()))
    monkeypatch.setattr(nd, "small_enough", lambda df: False)
    assert sorted(map(tuple, nd.near_duplicates(docs).collect())) == one


def test_odd_rows(spark):
    long = "a b c d e f g " * 20_000
    docs = spark.createDataFrame([(5, long), (4, long), (4, long), (None, long), (7, None), (8, None), (None, None)], "doc_id long, text string")
    rows = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(docs).collect())
    assert rows == [(0, 0, None, True), (0, 7, None, True), (4, 7, 4, True), (4, 7, 4, True), (5, 7, 4, False), (7, 0, 7, True), (8, 0, 8, True)]
    # one row of the group of equal texts stays, whatever the ids; rows without words are no copies
    assert sorted((r.doc_id or 0) for r in nd.keep_first(docs).collect()) == [0, 4, 7, 8]
    empty = docs.limit(0)
    assert nd.near_duplicates(empty).count() == 0 and nd.keep_first(empty).count() == 0


def test_rows_with_one_id_and_different_texts_stay(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    docs = spark.createDataFrame([(1, a), (1, b), (None, a + " more"), (None, "c d e f g h i"), (2, b), (3, "")], "doc_id long, text string").withColumn("number", F.lit("clash"))
    kept = nd.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "c d e f g h i"), (1, a), (1, b), (3, "")]


def test_small_sets_are_confirmed_whatever_their_sketches(spark, monkeypatch):
    """Sets of 4 and 3 shingles with 3 in common are linked, although a floor of 1 refuses all but equal sketches of large sets."""
    rows = [(10 * i + j, " ".join(f"t{i}w{k}" for k in range(8 - j))) for i in range(200) for j in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in nd.near_duplicates(docs, nd.NearDedup(floor=1.0)).collect()}
    assert got == {i: i - i % 10 for i, _ in rows}


def test_template_documents_meet_in_few_pairs(spark, monkeypatch):
    """Documents that share a template of half their words: linked are only copies; the join on rare shingles compares few."""
    rng = random.Random(5)
    template = [f"t{i}" for i in range(120)]
    rows = [(i, " ".join(template + [f"d{i}x{rng.randint(0, 10**6)}" for _ in range(60)])) for i in range(1500)]
    rows += [(5000 + i, t + " end") for i, t in rows[:50]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, plain = [], nd._prefix_pairs
    monkeypatch.setattr(nd, "_prefix_pairs", lambda *a: seen.append(nd.stored(plain(*a), "pairs")) or seen[-1])
    got = {r.doc_id: r.component_id for r in nd.near_duplicates(docs).collect()}
    assert got == {i: i - 5000 if i >= 5000 else i for i, _ in rows}
    assert all(x.count() < 5 * len(rows) for x in seen)


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(1)
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 300)],
             "random": [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)]}[shape]
    parent = {}
    for a, b in edges:
        for x in (a, b):
            parent.setdefault(x, x)

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    rows = [*edges, *edges[:5], (None, 3), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    loops = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in loops}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_middle_table_equals_brute_force_sample(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    want, _ = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: r.component_id for r in nd.near_duplicates(docs).collect()} == want


def test_stars_end_without_a_round_that_changes_nothing(spark, monkeypatch):
    """Every round is a handful of shuffles and a written table, whatever the rows: one settles a star."""
    from tillcast.llm import graph

    written, plain = [], graph.stored
    monkeypatch.setattr(graph, "stored", lambda df, name: written.append(name) or plain(df, name))
    edges = spark.createDataFrame([(0, i) for i in range(1, 300)] + [(1000, 1000 + i) for i in range(1, 5)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(300)} | {1000 + i: 1000 for i in range(5)}
    assert len(written) == 2  # the distinct edges and one round


def test_few_tables_are_written_between_steps(spark, monkeypatch):
    """Confirmed centres with several parts, a second pass over mixed buckets, components of both: the same result with few writes."""
    from tillcast.llm import graph

    rows = noisy_group(random.Random(6), 0, 120, 120, 9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    names, plain = [], nd.stored
    for module in (nd, graph):
        monkeypatch.setattr(module, "stored", lambda df, name: names.append(name) or plain(df, name))
    got = {r.doc_id: r.component_id for r in nd.near_duplicates(docs, nd.NearDedup(chunk=3)).collect()}
    assert got == brute(rows)[0]
    assert "wanted" not in names and "prefixes" in names  # texts to confirm go straight into their join; the second pass ran
