"""Packing: token pieces against the library, bins against bounds and small optima."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillcast.llm import packing as pk
from tillcast.llm.textbytes import slices


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(pk.default_tokenizer())


def coded(texts, size=1 << 20):
    import pyarrow as pa

    c, out = pk.WordCoder(pk.default_tokenizer()), []
    for lo, hi, data, off in slices(pa.array(texts, pa.string()), size):
        ids, first = c.encode(data, off)
        out += [ids[first[i]:first[i + 1]].tolist() for i in range(hi - lo)]
    return out, c


ODD = ["", None, " ", "a", " a", "a ", "  a  b ", "foo\nbar\n\n baz\t\tq", "it's we'll  '  s", "café con leche é  x  y", "a  b  c　d", "x\x85 y\x1c z\x0b w\x0c v",
       "日本語 の text", "\U0001f600 \U0001f600x", "<|endoftext|> a<|endoftext|>b <|endoftext|>", "1234567 12 3", "!!! ??? ...", "\r\n \r\n", "x" * 5000, "ab " * 3000, " \n" * 50 + "z", "­ ​ ﻿ t"]


def test_word_by_word_ids_equal_the_library():
    rng = random.Random(1)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "1", "'", "'s", "é", " ", " ", "　", "日", ".", "<|endoftext|>", "word", " the", "\U0001f600", "\x85", "Å", "š", " ", " "]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    lib = library()
    want = [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    for size in (1 << 20, 300):
        assert coded(texts, size)[0] == want


def test_a_full_table_is_thinned_out(monkeypatch):
    monkeypatch.setattr(pk, "KEPT_WORDS", 60)
    monkeypatch.setattr(pk, "JOINED_WORDS", 7)
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["often", "seen", "words"]) if rng.random() < 0.5 else f"w{rng.randint(0, 10**6)}" for _ in range(20)) for _ in range(60)]
    lib = library()
    got, c = coded(texts, 400)
    assert got == [lib.encode(t, add_special_tokens=False).ids for t in texts] and len(c.table.hashes) <= 60 + 80


def optimum(sizes, capacity):
    """Fewest bins, by trying all assignments in canonical order."""
    best = [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + sizes[i] <= capacity:
                bins[j] += sizes[i]
                place(i + 1, bins)
                bins[j] -= sizes[i]
        place(i + 1, bins + [sizes[i]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_bound_and_best_fit_enclose_the_optimum(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 12, 30])
    sizes = sorted([rng.randint(1, capacity) for _ in range(rng.randint(1, 8))], reverse=True)
    bins = pk.best_fit(sizes, capacity)
    assert sorted(itertools.chain(*bins)) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= capacity for b in bins)
    least = pk.bins_needed(pk.bound(np.bincount(sizes, minlength=capacity + 1)))
    best = optimum(sizes, capacity)
    assert least <= best <= len(bins)
    assert least >= max(-(-sum(sizes) // capacity), sum(2 * s > capacity for s in sizes))


def test_dual_feasible_functions_bound_every_full_bin():
    values, whole = pk.dual_feasible(12)
    for n in range(1, 7):
        for sizes in itertools.combinations_with_replacement(range(1, 13), n):
            if sum(sizes) <= 12:
                assert (values[:, sizes].sum(axis=1) <= whole).all()
    assert pk.bound(np.bincount([5, 5, 5, 5, 5], minlength=13)) >= 2.5  # only two of them fit into 12: the plain sum says 2.08


def test_best_fit_takes_the_fullest_bin_with_room():
    assert pk.best_fit([7, 6, 3, 3, 1], 10) == [[0, 2], [1, 3, 4]]
    assert pk.best_fit([], 10) == [] and pk.best_fit([10, 10], 10) == [[0], [1]]


def check(rows, docs, capacity, lib):
    """Every document whole, pieces cut as stated, sequences gapless and within the capacity."""
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_bin[r.sequence_id].append(r)
    for b in by_bin.values():
        at = 0
        for r in sorted(b, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    for i, texts in docs.items():
        want = []
        for t in texts:
            ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4")
            cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
            want += [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]) == sorted(want)
    assert sum(len(v) for v in by_doc.values()) == len(rows) and set(by_doc) == set(docs)
    return len(by_bin)


def test_pack_table_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 1, ""), (None, "x y"), (None, "x y"), (-5, "wört " * 60_000)], "doc_id long, text string"))
    docs = docs.withColumn("key", F.lit("clash")).withColumn("piece", F.lit(1))
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text)
    lib = library()
    for capacity, part in ((1024, pk.PART_PIECES), (64, 40)):
        out = pk.pack(docs, capacity, part_pieces=part)
        assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        check(out.collect(), texts, capacity, lib)
    assert pk.pack(docs.limit(0)).count() == 0


def test_parts_exchange_until_the_bound(spark):
    """Lengths of which every part alone needs a bin more than its share."""
    rng = random.Random(3)
    rows = [(i, 0, rng.choice([3, 5, 7, 11, 13])) for i in range(4000)]
    pieces = spark.createDataFrame(rows, "key long, piece int, length long")
    placed, rounds, least = pk.place(pieces, 64, part_pieces=500, merge=4)
    got = placed.join(pieces, ["key", "piece"]).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("k"), F.countDistinct("offset").alias("d")).collect()
    assert placed.count() == placed.select("key", "piece").distinct().count() == 4000
    assert max(r.n for r in got) <= 64 and all(r.k == r.d for r in got)
    assert len(rounds) > 1 and rounds[-1][1] == len(got) < rounds[0][1]
    whole = len(pk.best_fit(sorted((r[2] for r in rows), reverse=True), 64))
    assert least <= len(got) <= whole


def test_part_that_is_certified_gives_back_one_bin_and_no_more_than_asked():
    number, offset, back, bins, low = pk.pack_part(np.array([6, 4, 6, 4, 3]), 10, 100)
    assert bins == 3 == pk.bins_needed(low) and back.tolist() == [False, False, False, False, True]
    rng = np.random.default_rng(1)
    lengths = rng.integers(350, 620, 500)
    number, offset, back, bins, low = pk.pack_part(lengths, 1024, 50)
    if bins > pk.bins_needed(low):
        assert 0 < back.sum() <= 52


def test_written_sequences_hold_the_ids(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two three"), (2, "x " * 100), (3, None)], "doc_id long, text string")
    pk.write_sequences(docs, str(tmp_path / "s"), capacity=32)
    lib = library()
    want = {1: lib.encode("one two three").ids + [2], 2: lib.encode("x " * 100).ids + [2], 3: [2]}
    got = defaultdict(dict)
    for r in pk.read_sequences(spark, str(tmp_path / "s")).collect():
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == sum(p.length for p in r.pieces) <= 32
        for p in r.pieces:
            got[p.doc_id][p.piece] = ids[p.offset:p.offset + p.length].tolist()
    assert {i: [x for k in sorted(v) for x in v[k]] for i, v in got.items()} == want
