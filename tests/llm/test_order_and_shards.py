"""Training order and sharding against brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from tillcast.llm import sharding
from tillcast.llm import training_order as to


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_feistel_is_a_permutation_with_an_inverse(size):
    f = to.Feistel(size, 11)
    slots = f.slots(np.arange(size))
    assert sorted(slots) == list(range(size))
    assert (f.indices(slots) == np.arange(size)).all()
    if size > 100:
        assert (slots != to.Feistel(size, 12).slots(np.arange(size))).any()


def test_order_holds_every_text_once(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 1, ""), (None, "x" * 64), (-5, "é" * 100_000)], "doc_id long, text string"))
    docs = docs.withColumn("shard", F.lit("clash"))
    path = str(tmp_path / "o")
    shards = to.materialise(docs, path, length=64, shard_records=500).collect()
    rows = to.read_order(spark, path).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(len(rows))) and sum(s.records for s in shards) == len(rows)
    assert sorted(s.shard for s in shards) == list(range(-(-len(rows) // 500)))
    by_doc = defaultdict(lambda: defaultdict(list))
    for r in rows:
        assert r.shard == r.slot // 500 and r.n_tokens == len(r.ids)
        by_doc[r.doc_id][r.sequence].append(bytes(r.ids))
    for r in docs.where("doc_id <> 1000001 or doc_id is null").collect():
        parts = by_doc[r.doc_id]
        assert b"".join(parts[i][0] for i in range(len(parts))) == (r.text or "").encode() + b"\xff"
    assert by_doc[10**6 + 1] == {0: [b"\xff", b"\xff"]}
    part = to.read_order(spark, path, 730, 1234).orderBy("slot").collect()  # resumes anywhere
    assert [(r.slot, r.doc_id, r.ids) for r in part] == [(r.slot, r.doc_id, r.ids) for r in rows[730:1234]]
    plan = to.layout(path)
    one = next(to.records_at(path, plan, 777, 778))
    assert one[0] == 777 and one[1]["sequence"][0] == rows[777].sequence
    again = str(tmp_path / "again")
    to.materialise(docs, again, length=64, shard_records=500)
    for s in shards:
        name = f"shard-{s.shard:06d}.bin"
        assert (tmp_path / "o" / name).read_bytes() == (tmp_path / "again" / name).read_bytes()


def test_order_holds_the_tokens_of_every_text(spark, tmp_path):
    import sentencepiece

    from tillcast.llm import piece_codec
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").repartition(5, "doc_id").unionByName(
        spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 1, ""), (None, "x" * 64), (-5, "é日 " * 30_000)], "doc_id long, text string"))
    path = str(tmp_path / "o")
    shards = to.materialise_tokens(docs, path, length=64, shard_records=500).collect()
    lib = sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())
    end, pad = lib.get_piece_size(), lib.get_piece_size() + 1
    plan = to.layout(path)
    assert plan["kind"] == "<u2" and sum(s.records for s in shards) == plan["total"]
    recs = np.concatenate([r for _, r in to.records_at(path, plan, 0, plan["total"])])
    rows = to.read_order(spark, path).orderBy("slot").collect()
    assert [(r.doc_id if r.doc_id is not None else to.NO_ID, r.sequence, r.n_tokens, bytes(r.ids)) for r in rows] == [
        (int(r["doc_id"]), int(r["sequence"]), int(r["n_tokens"]), r["ids"][:r["n_tokens"]].tobytes()) for r in recs]
    by_doc = defaultdict(lambda: defaultdict(list))
    for r in recs:
        assert (r["ids"][r["n_tokens"]:] == pad).all()
        by_doc[int(r["doc_id"])][int(r["sequence"])].append(r["ids"][:r["n_tokens"]].tolist())
    for r in docs.where("doc_id <> 1000001 or doc_id is null").collect():
        parts = by_doc.pop(to.NO_ID if r.doc_id is None else r.doc_id)
        assert [t for i in range(len(parts)) for t in parts[i][0]] == lib.encode(r.text or "") + [end]
    assert by_doc == {10**6 + 1: {0: [[end], [end]]}}


def test_registered_order_is_of_tokens(spark):
    from tillcast.llm import piece_codec, queries
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    counts = {r.doc_id: r.n_tokens for r in piece_codec.code_digests(docs).collect()}
    got = Counter()
    for r in queries.op7_training_order(spark, SF_SMALL).collect():
        got[r.doc_id] += r.n_tokens
    assert got == {i: n + 1 for i, n in counts.items()}  # and the end of each


def test_order_of_no_tokens(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert to.materialise_tokens(docs, str(tmp_path / "o")).count() == 0
    assert to.read_order(spark, str(tmp_path / "o")).count() == 0


def test_order_of_nothing(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert to.materialise(docs, str(tmp_path / "o")).count() == 0
    assert to.read_order(spark, str(tmp_path / "o")).count() == 0


def brute_shards(rows, shards):
    """Shard and slot by the order (fraction, stratum) given each source's own order."""
    order = sorted(rows, key=lambda r: (r["fraction"], r["stratum"]))
    n = len(order)
    out = []
    for i, r in enumerate(order):
        shard = i * shards // n
        out.append((r["id"], shard, i - -(-shard * n // shards)))
    return sorted(out, key=str)


def test_interleaving_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "source").unionByName(
        spark.createDataFrame([(None, None, None), (None, "x", None), (-7, "", "src0")], "doc_id long, text string, source string")).withColumn("slot", F.lit("clash"))
    got = sharding.interleave(docs, shards=7, slice_bits=4).collect()
    src = docs.select("doc_id", "text", "source", F.xxhash64(F.lit(1), "doc_id", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")),
                      (F.octet_length(F.coalesce("text", F.lit(""))) + 8).cast("long")).alias("h")).collect()
    strata = {"null" if r.source is None else "s" + r.source for r in src}
    hashes = spark.createDataFrame([(x,) for x in strata], "s string").select("s", F.xxhash64(F.lit(1), "s").alias("h")).collect()
    phase = {r.s: (r.h % 2**64 >> 12) / 2**52 for r in hashes}
    groups = defaultdict(list)
    for r in src:
        groups["null" if r.source is None else "s" + r.source].append((r.h % 2**64, r.doc_id))
    rows = [{"id": i, "fraction": (k + phase[s]) / len(g), "stratum": s} for s, g in groups.items() for k, (_, i) in enumerate(sorted(g, key=lambda x: (x[0], x[1] is not None, x[1])))]
    assert sorted(((r.doc_id, r.shard, r.slot) for r in got), key=str) == brute_shards(rows, 7)
    texts = {r.doc_id: r.text or "" for r in src if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None:
            assert r.size == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())


def test_every_shard_matches_the_mixture(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('x', id % 5) as text", "case when id % 3 = 0 then 'hot' else concat('s', id % 11) end as source")
    rows = sharding.interleave(docs, shards=24).collect()
    counts, sizes = Counter((r.source, r.shard) for r in rows), Counter(r.source for r in rows)
    for source, n in sizes.items():
        assert all(abs(counts[source, s] - n / 24) <= 3 for s in range(24))
    per = Counter(r.shard for r in rows)
    assert max(per.values()) - min(per.values()) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(per[s])) for s in per)


def test_few_and_repeated_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a", "s"), (1, "a", "s"), (2, "b", "t")], "doc_id long, text string, source string")
    rows = sharding.interleave(docs).collect()
    assert len(rows) == 3 and len({(r.shard, r.slot) for r in rows}) == 3
    assert sharding.interleave(docs.limit(0)).count() == 0
    sharding.write_shards(docs.dropDuplicates(), str(tmp_path / "s"), shards=2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 2 and back.select("shard").distinct().count() == 2


def test_token_table_and_blocks_are_packed_hard(spark, tmp_path):
    """Both lie beside the shards on disk: one codec level for both, well above the default's size for repeated ids."""
    import numpy as np
    import zstandard

    from tillcast.llm import training_order as to

    rng = np.random.default_rng(1)
    words = [rng.integers(0, 3000, 6) for _ in range(400)]
    flat = np.concatenate([words[i] for i in rng.zipf(1.3, 60_000) % 400]).astype("<u2")
    n = len(flat) // 512
    recs = to.records_of(np.arange(n), flat[:n * 512].copy(), np.arange(n + 1) * 512, to.record_type(512, "<u2"), 512, 32000, 32001)
    packed = to.blocks(np.arange(len(recs)), recs, len(recs)).column("records")[0].as_py()
    assert len(packed) < 0.97 * len(zstandard.ZstdCompressor(level=3).compress(recs.tobytes()))
    assert np.array_equal(np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=recs.dtype), recs)


def test_blocks_find_repeats_of_two_ids(spark):
    """Pairs of ids that come again among others are packed as such, which level 9 alone does not see."""
    import zstandard

    rng = np.random.default_rng(2)
    pairs = rng.integers(0, 32_000, (300, 2))
    flat = np.concatenate([np.r_[pairs[i], j] for i, j in zip(rng.integers(0, 300, 100_000), rng.integers(0, 32_000, 100_000))]).astype("<u2")
    n = len(flat) // 511
    recs = to.records_of(np.arange(n), flat[:n * 511].copy(), np.arange(n + 1) * 511, to.record_type(512, "<u2"), 512, 32000, 32001)
    packed = to.blocks(np.arange(n), recs, n).column("records")[0].as_py()
    assert len(packed) < 0.97 * len(zstandard.ZstdCompressor(level=9).compress(recs.tobytes()))
    assert zstandard.ZstdDecompressor().decompress(packed) == recs.tobytes()
