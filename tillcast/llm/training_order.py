"""Training-order materialisation of token sequences.

Texts become token sequences of a fixed length. ``materialise_tokens`` codes them with a SentencePiece
model (``piece_codec``); the two ids after the vocabulary end a document and pad, and records hold u2
ids, u4 for vocabularies beyond 65,534 pieces. ``materialise`` takes the vocabulary of UTF-8 bytes: the
ids of a text are its bytes, 255 ends a document and 254 pads, both of which UTF-8 never uses. The sequences are numbered
0 to N - 1 and a keyed Feistel permutation of the smallest even number of bits, walked until
it falls below N, gives each its global slot, so the order is a function of the key alone
and can be inverted. Every shard is a range of slots and one file of fixed-stride records, so a
slot is found by arithmetic and a reader resumes anywhere. Records travel in compressed blocks, one
for each shard and Arrow batch; the shard's task puts them in their places and writes the file. It
holds one shard (``shard_records`` records, by default 34 MB of bytes or 68 MB of u2 ids), whatever the input.

A record is a header (doc_id int64, sequence int32, tokens int32) and the padded ids.

Numbering needs no shuffle. Bytes: one pass counts the sequences of each input partition, the second
numbers them on from there and fails if it meets another count. Tokens: every text is coded once, and
its ids are stored in the shared folder with the partition that coded it and the number of sequences
before it there, so the counts of the partitions are all that is added later, however the stored table
is split when it is read. Files are written under an attempt's name and then moved, so a repeated task
replaces its own file.

Defined results: null and empty texts are one sequence, only the end. A null id is stored as
-2**63. Texts of any length are cut into as many sequences as they need. Repeated rows are
sequences of their own. An empty table writes no shard. Further columns are not read.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm import textbytes as tb
from tillcast.llm.common import narrow, scratch_path, small_batches
from tillcast.llm.piece_codec import codec, default_model
from tillcast.llm.warc import file_system

END, PAD = 255, 254
NO_ID = -(1 << 63)
LAYOUT = "_layout.json"
PACKED_RECORDS = 1 << 15  # of tokens, after which their blocks are handed on
#: Token table, shuffled blocks and shards lie on disk together at the end: the first two are packed harder than by default.
PACK_LEVEL, PAGE_BYTES = 7, 8 << 20
#: Blocks are u2 ids for the most part: matches of two ids count, which a level alone takes from three on.
BLOCK_LEVEL, BLOCK_MATCH, BLOCK_BYTES = 5, 4, 2 << 20
CODED_BYTES = 1 << 20  # of texts coded at a time: each time the codec's table is written anew


@dataclass(frozen=True)
class Feistel:
    """A permutation of 0 .. size - 1."""

    size: int
    key: int
    rounds: int = 6

    @property
    def half(self) -> int:
        return max(1, ((max(self.size, 2) - 1).bit_length() + 1) // 2)

    def _round(self, x: np.ndarray, i: int) -> np.ndarray:
        seed = tb.U64((self.key * 0x9E3779B97F4A7C15 + (i + 1) * 0xD1B54A32D192ED03) % (1 << 64))
        return tb.mix64(tb.mix64(x ^ seed) + seed) & tb.U64((1 << self.half) - 1)

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        h, mask = tb.U64(self.half), tb.U64((1 << self.half) - 1)
        a, b = x >> h, x & mask
        for i in range(self.rounds)[::-1 if back else 1]:
            if back:
                a, b = b ^ self._round(a, i), a
            else:
                a, b = b, a ^ self._round(b, i)
        return (a << h) | b

    def _walk(self, x, back: bool) -> np.ndarray:
        out = self._once(np.asarray(x, dtype=tb.U64), back)
        while (outside := out >= tb.U64(self.size)).any():
            out[outside] = self._once(out[outside], back)
        return out.astype(np.int64)

    def slots(self, index) -> np.ndarray:
        return self._walk(index, False)

    def indices(self, slot) -> np.ndarray:
        return self._walk(slot, True)


def record_type(length: int, kind: str) -> np.dtype:
    return np.dtype([("doc_id", "<i8"), ("sequence", "<i4"), ("n_tokens", "<i4"), ("ids", kind, (length,))])


BLOCK = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("places", T.BinaryType()), T.StructField("records", T.BinaryType())])


def blocks(slots: np.ndarray, records: np.ndarray, shard_records: int) -> pa.RecordBatch:
    """A row for each shard that the slots fall into: the places in it and the compressed records."""
    import zstandard

    pack = zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters.from_level(BLOCK_LEVEL, source_size=BLOCK_BYTES, min_match=BLOCK_MATCH)).compress
    order = np.argsort(slots, kind="stable")
    slots, records = slots[order], records[order]
    shard = slots // shard_records
    at = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(slots) else slots
    ends = np.r_[at[1:], len(slots)] if len(slots) else at
    return pa.RecordBatch.from_arrays([pa.array(shard[at].astype(np.int32)),
                                       pa.array([(slots[a:b] % shard_records).astype("<u4").tobytes() for a, b in zip(at, ends)], pa.binary()),
                                       pa.array([pack(records[a:b].tobytes()) for a, b in zip(at, ends)], pa.binary())], schema=_arrow(BLOCK))


def records_of(ids: np.ndarray, flat_ids: np.ndarray, off: np.ndarray, kind: np.dtype, length: int, end: int, pad: int) -> np.ndarray:
    """Records of all sequences of some rows: ``ids`` of the rows, their tokens one after the other, where each row's begin and end."""
    sizes = np.diff(off)
    n = (sizes + length) // length
    m = int(n.sum())
    first = np.r_[0, np.cumsum(n)]
    out = np.zeros(m, dtype=kind)
    row = np.repeat(np.arange(len(sizes)), n)
    out["doc_id"], out["sequence"] = ids[row], np.arange(m) - first[row]
    flat = np.full(m * length, pad, dtype=kind["ids"].base)
    flat[np.arange(len(flat_ids)) + np.repeat(first[:-1] * length - off[:-1], sizes)] = flat_ids
    flat[first[:-1] * length + sizes] = end
    out["ids"] = flat.reshape(m, length)
    out["n_tokens"] = np.minimum(sizes[row] + 1 - out["sequence"].astype(np.int64) * length, length)
    return out


def _row_ids(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([NO_ID if x is None else x for x in batch.column("row_id").to_pylist()], dtype=np.int64)


def byte_sequences(docs: DataFrame, length: int, key: int, shard_records: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """Blocks of all sequences, and the number of sequences."""
    rows = narrow(docs, row_id=id_col, text=text_col)
    needed = F.floor((F.coalesce(F.octet_length("text"), F.lit(0)) + length) / length).cast("long")
    per_part = {r[0]: r[1] for r in rows.select(F.spark_partition_id().alias("part"), needed.alias("n")).groupBy("part").agg(F.sum("n")).collect()}
    starts, total = {}, 0
    for part in sorted(per_part):
        starts[part], total = total, total + per_part[part]
    order, kind = Feistel(total, key), record_type(length, "u1")
    shared = docs.sparkSession.sparkContext.broadcast((starts, per_part))  # two numbers for each input partition

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        start, left = shared.value[0].get(part, 0), shared.value[1].get(part, 0)
        for batch in batches:
            made, places = [], []
            ids = _row_ids(batch)
            for lo, hi, data, off in tb.slices(batch.column("text")):
                out = records_of(ids[lo:hi], data, off, kind, length, END, PAD)
                m = len(out)
                left -= m
                if left < 0:
                    raise RuntimeError("the input's partitions changed between two passes")
                places.append(order.slots(np.arange(start, start + m)))
                made.append(out)
                start += m
            yield blocks(np.concatenate(places), np.concatenate(made), shard_records)
        if left:
            raise RuntimeError("the input's partitions changed between two passes")

    return rows.mapInArrow(run, BLOCK), total


def token_kind(model_path: str) -> tuple[str, int, int]:
    """(type of an id in records, end, pad) for a model's vocabulary."""
    import sentencepiece

    size = sentencepiece.SentencePieceProcessor(model_file=model_path).get_piece_size()
    return "<u2" if size + 2 <= 1 << 16 else "<u4", size, size + 1


CODED = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType()),
                      T.StructField("n", T.LongType()), T.StructField("tokens", T.BinaryType())])


def coded_texts(docs: DataFrame, length: int, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The token ids of every text, coded once and stored: row_id, part (that coded it), before (sequences of earlier rows of the part), n (sequences), tokens."""
    small_batches(docs.sparkSession)
    kind = token_kind(model_path or default_model())[0]

    def run(batches):
        from pyspark import TaskContext

        c, part, before = codec(model_path or default_model()), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column("row_id").cast(pa.int64()), batch.column("text")
            for lo, hi, _, _ in tb.slices(texts, CODED_BYTES):
                tokens = c.coded_many(texts.slice(lo, hi - lo).to_pylist())
                n = np.array([(len(t) + length) // length for t in tokens], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(np.full(hi - lo, part, np.int32)), pa.array(before + np.cumsum(n) - n), pa.array(n),
                                                  pa.array([t.astype(kind).tobytes() for t in tokens], pa.binary())], schema=_arrow(CODED))
                before += int(n.sum())

    path = scratch_path(docs.sparkSession, "tokens")
    narrow(docs, row_id=id_col, text=text_col).mapInArrow(run, CODED).write.option("compression", "zstd").option(
        "parquet.compression.codec.zstd.level", str(PACK_LEVEL)).option("parquet.page.size", str(PAGE_BYTES)).parquet(path)
    return docs.sparkSession.read.schema(CODED).parquet(path)


def token_sequences(coded: DataFrame, length: int, key: int, shard_records: int, kind: str, end: int, pad: int) -> tuple[DataFrame, int]:
    """Blocks of all sequences of ``coded_texts``, and the number of sequences."""
    small_batches(coded.sparkSession)
    per_part = {r[0]: r[1] for r in coded.groupBy("part").agg(F.sum("n")).collect()}
    starts, total = {}, 0
    for part in sorted(per_part):
        starts[part], total = total, total + per_part[part]
    order, record = Feistel(total, key), record_type(length, kind)
    shared = coded.sparkSession.sparkContext.broadcast(starts)  # a number for each input partition
    width = record["ids"].base.itemsize

    def run(batches):
        for batch in batches:
            ids, n = _row_ids(batch), batch.column("n").to_numpy()
            first = np.array([shared.value[p] for p in batch.column("part").to_pylist()], dtype=np.int64) + batch.column("before").to_numpy()
            made, places, held = [], [], 0
            for lo, hi, data, off in tb.slices(batch.column("tokens")):
                made.append(records_of(ids[lo:hi], data.view(kind), off // width, record, length, end, pad))
                index = np.repeat(first[lo:hi], n[lo:hi]) + made[-1]["sequence"]
                places.append(order.slots(index))
                held += len(index)
                if held >= PACKED_RECORDS:
                    yield blocks(np.concatenate(places), np.concatenate(made), shard_records)
                    made, places, held = [], [], 0
            if made:
                yield blocks(np.concatenate(places), np.concatenate(made), shard_records)

    return coded.select("row_id", "part", "before", "n", "tokens").mapInArrow(run, BLOCK), total


def write_order(sequences: DataFrame, total: int, path: str, length: int, shard_records: int, kind: str = "u1") -> DataFrame:
    """Writes blocks as shard files; returns shard, records, bytes once they are written."""
    record, shards = record_type(length, kind), -(-total // shard_records)
    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("records", T.LongType()), T.StructField("bytes", T.LongType())])

    def run(batches):
        import zstandard

        unpack, whole, shard = zstandard.ZstdDecompressor().decompress, None, None
        for batch in batches:
            for own, places, packed in zip(*(batch.column(c).to_pylist() for c in ("shard", "places", "records"))):
                if whole is None:
                    shard = own
                    whole = np.zeros(min(shard_records, total - shard * shard_records), dtype=record)
                    filled = np.zeros(len(whole), dtype=np.int64)
                at = np.frombuffer(places, dtype="<u4")
                whole[at] = np.frombuffer(unpack(packed), dtype=record)
                np.add.at(filled, at, 1)
                if own != shard:
                    raise RuntimeError("two shards in one partition")
        if whole is not None:
            if (filled != 1).any():
                raise RuntimeError("a shard's slots are not whole")
            store, root = file_system(path)
            store.create_dir(root, recursive=True)
            temporary = f"{root}/.{shard}-{uuid.uuid4().hex}"
            with store.open_output_stream(temporary, compression=None) as out:
                out.write(whole)
            store.move(temporary, f"{root}/shard-{shard:06d}.bin")
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(whole)], pa.int64()), pa.array([whole.nbytes], pa.int64())], schema=_arrow(schema))

    store, root = file_system(path)
    store.create_dir(root, recursive=True)
    written = sequences.repartitionById(max(shards, 1), F.col("shard")).mapInArrow(run, schema)
    rows = written.collect()  # a row for each shard
    with store.open_output_stream(f"{root}/{LAYOUT}") as f:
        f.write(json.dumps({"total": total, "length": length, "kind": kind, "shard_records": shard_records, "shards": shards}).encode())
    return sequences.sparkSession.createDataFrame(rows, schema)


def _arrow(schema):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def layout(path: str) -> dict:
    store, root = file_system(path)
    with store.open_input_stream(f"{root}/{LAYOUT}") as f:
        return json.loads(f.read())


def records_at(path: str, plan: dict, lo: int, hi: int, step: int = 1 << 14):
    """(first slot, records) blocks of the slots from lo up to hi: one seek, then sequential reads."""
    store, root = file_system(path)
    kind = record_type(plan["length"], plan["kind"])
    while lo < min(hi, plan["total"]):
        shard = lo // plan["shard_records"]
        end = min(hi, plan["total"], (shard + 1) * plan["shard_records"])
        with store.open_input_file(f"{root}/shard-{shard:06d}.bin") as f:
            f.seek((lo - shard * plan["shard_records"]) * kind.itemsize)
            while lo < end:
                n = min(step, end - lo)
                yield lo, np.frombuffer(f.read(n * kind.itemsize), dtype=kind)
                lo += n


def read_order(spark: SparkSession, path: str, lo: int = 0, hi: int | None = None) -> DataFrame:
    """slot, shard, doc_id, sequence, n_tokens, ids (the tokens' bytes) from slot lo up to hi, a task for each shard."""
    plan = layout(path)
    hi = plan["total"] if hi is None else min(hi, plan["total"])
    schema = T.StructType([T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("doc_id", T.LongType()),
                           T.StructField("sequence", T.IntegerType()), T.StructField("n_tokens", T.IntegerType()), T.StructField("ids", T.BinaryType())])
    a, b = lo // plan["shard_records"], -(-hi // plan["shard_records"])

    def run(batches):
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                for at, recs in records_at(path, plan, max(lo, shard * plan["shard_records"]), min(hi, (shard + 1) * plan["shard_records"])):
                    ids = [r[:k].tobytes() for r, k in zip(recs["ids"], recs["n_tokens"].tolist())]
                    doc = pa.array(recs["doc_id"], mask=recs["doc_id"] == NO_ID)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + len(recs))), pa.array(np.full(len(recs), shard, np.int32)), doc,
                                                      pa.array(recs["sequence"]), pa.array(recs["n_tokens"]), pa.array(ids, pa.binary())], schema=_arrow(schema))

    return spark.range(a, max(a, b), 1, max(1, b - a)).mapInArrow(run, schema)


def materialise(docs: DataFrame, path: str, length: int = 512, key: int = 20, shard_records: int = 1 << 16, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Writes the byte sequences of all texts in training order into a new folder; returns its shards."""
    sequences, total = byte_sequences(docs, length, key, shard_records, id_col, text_col)
    return write_order(sequences, total, path, length, shard_records)


def materialise_tokens(docs: DataFrame, path: str, length: int = 512, key: int = 20, shard_records: int = 1 << 16, model_path: str | None = None,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the sequences of all texts' token ids in training order into a new folder; returns its shards."""
    kind, end, pad = token_kind(model_path or default_model())
    sequences, total = token_sequences(coded_texts(docs, length, model_path, id_col, text_col), length, key, shard_records, kind, end, pad)
    return write_order(sequences, total, path, length, shard_records, kind)
