"""Best-fit packing of token sequences, each partition's bin count certified by a lower bound.

Documents become token ids (byte-level BPE) and an end id; those longer than a sequence are cut
into pieces. Pieces are dealt by a hash into parts of about ``PART_PIECES``. Each part is packed
by best-fit decreasing and gets a lower bound on its bins from dual-feasible functions: a function f
with sum f(x) <= 1 for every set of sizes that fits into a bin turns the part's sizes into a number
of bins that no packing can go below. Three families are tried, each with all its parameters or 127
of them (one that drops small sizes and rounds large ones up, one that counts how often a size divides
a bin, one that rounds multiples); the best, before rounding up, is the part's bound. A part whose
count equals the bound rounded up is certified and gives only its emptiest bin back, in which its
rounding lies; a part with a gap gives back its bins with room, the emptiest first, to the number of pieces
that keeps the next round's parts at ``PART_PIECES``. What is given back goes to fewer parts,
``MERGE`` to one, which pack it anew: parts exchange documents round by round until the bins of all
together equal the bound over the lengths of all pieces, or one part is left. A bin that is
kept is never opened again.

The tokenizer's own cut at white space lets texts be coded word by word (a word and the one white space
character before it): each worker keeps the ids of recent short words in a table of bounded size and asks the library for
the rest. Words are told apart by 64-bit hashes of their bytes.

Defined results: a null text is empty: one piece, the end id alone. Texts of any length are cut
whole. Repeated rows and null ids: rows are told apart by a key of their own, so each gets its
pieces. Ties: of equal lengths the smaller key goes first, of equal bins the oldest. An empty table
gives an empty result. Further columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.common import map_arrow, narrow, stored, worker_tables
from tillcast.llm.idtable import IdTable, gathered
from tillcast.llm.textbytes import byte_class, slices, span_hashes

CAPACITY = 1024
END_ID = 2
PART_PIECES = 16_384
MERGE = 8
#: Words longer than this many bytes are coded without being kept.
KEPT_BYTES = 32
#: Words and ids that a worker keeps, some 100 MB; beyond, those stay that were asked for again.
KEPT_WORDS, KEPT_IDS = 1_500_000, 8_000_000
#: Words that are coded as one text.
JOINED_WORDS = 8192
SLICE = 1 << 20

WHITE = byte_class([0x20, 0x09, 0x0A, 0x0D])
#: Bytes below "!" may be white space to the tokenizer; so may these last bytes of characters of several bytes.
MAYBE_WHITE = byte_class([*range(0x21), 0x7F, 0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F])
LEADS = byte_class([0xC2, 0xE1, 0xE2, 0xE3])


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the words of all rows, the rows' own starts included: places where white space follows
    something that certainly is none; for each byte whether it ends something that is none)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    solid = ~MAYBE_WHITE[data]
    # é ends in 0xA9 like U+2029 does: a two-byte character is white space only behind 0xC2, a three-byte one behind 0xE1 to 0xE3
    multi = np.flatnonzero(MAYBE_WHITE[data] & (data >= 0x80))
    one, two = data[np.maximum(multi - 1, 0)], data[np.maximum(multi - 2, 0)]
    solid[multi] = np.where(one >= 0xC0, ~LEADS[one], (two >= 0xC0) & ~LEADS[two])
    cut = np.zeros(n, dtype=bool)
    cut[1:] = WHITE[data[1:]] & solid[:-1]
    cut[offsets[:-1][offsets[:-1] < n]] = True
    return np.flatnonzero(cut), solid


class WordCoder:
    """Token ids of whole texts by the tokenizers library, with the ids of recent words in flat arrays."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # a character of a byte-level token is a byte; an added token is its own text
        added = self.tokenizer.get_added_tokens_decoder()
        self.width = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.width[i] = len(token.encode()) if i in added else len(token)
        self.table = IdTable(KEPT_WORDS, KEPT_IDS)

    def _coded(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first of them and number of them for each word). Words that begin with white space and end in none are
        coded as one text, where they are the same words, and told apart by the widths of their tokens."""
        joined = WHITE[data[starts]] & solid[ends - 1]
        text = data.tobytes()
        begin, lengths = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        parts, total = [np.zeros(0, np.uint32)], 0
        many = np.flatnonzero(joined)
        for lo in range(0, len(many), JOINED_WORDS):
            at = many[lo:lo + JOINED_WORDS]
            one = b"".join([text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]).decode()
            ids = np.array(self.tokenizer.encode_batch_fast([one], add_special_tokens=False)[0].ids, dtype=np.uint32)
            edge = np.r_[0, np.searchsorted(np.cumsum(self.width[ids]), np.cumsum((ends - starts)[at])) + 1]
            begin[at], lengths[at] = total + edge[:-1], np.diff(edge)
            parts.append(ids)
            total += len(ids)
        alone = np.flatnonzero(~joined).tolist()
        if alone:
            for i, e in zip(alone, self.tokenizer.encode_batch_fast([text[starts[i]:ends[i]].decode() for i in alone], add_special_tokens=False)):
                parts.append(np.array(e.ids, dtype=np.uint32))
                begin[i], lengths[i] = total, len(e)
                total += len(e)
        return np.concatenate(parts), begin, lengths

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows end to end, first id of each row with the total last)."""
        starts, solid = word_starts(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.r_[starts[1:], len(data)]
        hashes, first, where = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        known, begin, length = self.table.find(hashes)
        new = np.flatnonzero(~known)
        ids = self.table.ids
        if len(new):
            more, at, lengths = self._coded(data, starts[first[new]], ends[first[new]], solid)
            begin[new], length[new] = len(ids) + at, lengths
            ids = np.concatenate([ids, more])
        per_word = length[where]
        total = np.r_[0, np.cumsum(per_word)]
        out = gathered(ids, begin[where], per_word)
        if len(new):
            short = (ends - starts)[first[new]] <= KEPT_BYTES
            self.table.keep(hashes[new][short], more, at[short], lengths[short])
        return out, total[np.searchsorted(starts, offsets)]


_CODERS: dict[str, WordCoder] = worker_tables("words")


def coder(path: str) -> WordCoder:
    """One for each file and worker process."""
    if path not in _CODERS:
        _CODERS[path] = WordCoder(path)
    return _CODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
               with_ids: bool = False) -> DataFrame:
    """A row for each piece: key (of the row), the id, piece, start, length, ids_crc32 and, if asked for, ids
    (little-endian 32-bit). Only the first piece of a document may be shorter than ``capacity``."""
    rows = narrow(docs, row_id=id_col, text=text_col).withColumn("key", F.monotonically_increasing_id())
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("row_id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())] + [T.StructField("ids", T.BinaryType())] * with_ids)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        c = coder(tokenizer or default_tokenizer())
        for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
            ids, first = c.encode(data, offsets)
            # the end id behind each document
            whole = np.insert(ids, first[1:], np.uint32(end_id)).astype("<u4").tobytes()
            begin = first + np.arange(len(first))
            size = np.diff(begin)
            pieces = -(-size // capacity)
            row = np.repeat(np.arange(hi - lo), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            head = size - (pieces - 1) * capacity
            start = np.where(piece > 0, head[row] + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, head[row])
            at = (4 * (begin[row] + start)).tolist()
            parts = [whole[a:a + n] for a, n in zip(at, (4 * length).tolist())]
            rows = pa.array(row + lo)
            yield {"key": batch.column("key").take(rows), "row_id": batch.column("row_id").take(rows), "piece": piece.astype(np.int32), "start": start, "length": length,
                   "ids_crc32": list(map(zlib.crc32, parts))} | ({"ids": parts} if with_ids else {})

    return map_arrow(rows, work, schema, "words")


@lru_cache(maxsize=4)
def dual_feasible(capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(values of every function at the sizes 0 to capacity, value of a whole bin)."""
    x = np.arange(capacity + 1)
    values, whole = [x], [capacity]
    for a in range(1, capacity // 2 + 1):
        values.append(np.where(x > capacity - a, capacity, np.where(x >= a, x, 0)))
        whole.append(capacity)
        times = capacity // a
        values.append(np.where(2 * x > capacity, 2 * (times - (capacity - x) // a), np.where(2 * x == capacity, times, 2 * (x // a))))
        whole.append(2 * times)
    for k in range(1, min(capacity, 128)):
        values.append(np.where((k + 1) * x % capacity == 0, k * x, (k + 1) * x // capacity * capacity))
        whole.append(k * capacity)
    return np.array(values, dtype=np.int64), np.array(whole, dtype=np.int64)


def bound(counts: np.ndarray) -> float:
    """No packing has fewer bins; ``counts`` by size, 0 to the capacity. Not rounded up."""
    values, whole = dual_feasible(len(counts) - 1)
    return float((values @ counts / whole).max())


def bins_needed(b: float) -> int:
    return int(np.ceil(b - 1e-9))


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indexes by bin; lengths descend. Each goes to the fullest bin with room for it, the oldest of equals."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by the room left, as queues
    head = [0] * (capacity + 1)
    rooms = 0  # a bit for each room that some bin has
    for i, n in enumerate(lengths):
        fit = rooms >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            b = by_room[room][head[room]]
            head[room] += 1
            if head[room] == len(by_room[room]):
                by_room[room], head[room] = [], 0
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if left := room - n:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins


def pack_part(lengths: np.ndarray, capacity: int, give: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, float]:
    """(bin, offset in it and whether it is given back, of each piece; bins; bound) of one part; the bins
    that are given back hold ``give`` pieces at most, or are one."""
    order = np.argsort(-lengths, kind="stable")
    bins = best_fit(lengths[order].tolist(), capacity)
    counts = np.bincount(lengths, minlength=capacity + 1)
    low = bound(counts)
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fill = np.zeros(len(bins), np.int64)
    for b, members in enumerate(bins):
        at = 0
        for i in order[members].tolist():
            number[i], offset[i] = b, at
            at += int(lengths[i])
        fill[b] = at
    back = np.zeros(len(bins), dtype=bool)
    by_fill = np.argsort(fill, kind="stable")
    open_ = by_fill[:np.searchsorted(fill[by_fill], capacity)]
    if len(bins) > bins_needed(low):
        held = np.cumsum([len(bins[b]) for b in open_.tolist()])
        back[open_[:max(1, int(np.searchsorted(held, give, "right")))]] = True
    else:
        back[open_[:1]] = True
    return number, offset, back[number], len(bins), low


_STATE = "key long, piece int, length int, round int, part long, bin long, offset long, back boolean"


def _round(pieces: DataFrame, no: int, capacity: int, give: int) -> DataFrame:
    """One packing of every part of ``pieces`` (key, piece, length, part)."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("piece", "ascending")])
        number, offset, back, _, _ = pack_part(table["length"].to_numpy().astype(np.int64), capacity, give)
        n = len(table)
        return pa.table({"key": table["key"], "piece": table["piece"], "length": table["length"], "round": pa.array(np.full(n, no, np.int32)), "part": table["part"],
                         "bin": pa.array(number), "offset": pa.array(offset), "back": pa.array(back)})

    return stored(pieces.groupBy("part").applyInArrow(pack, _STATE), "bins")


def certificate(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length") -> float:
    """The lower bound over all pieces, from their counts by length (``capacity`` rows at most)."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in pieces.groupBy(F.col(length_col).alias("length")).agg(F.count("*").alias("n")).collect():
        counts[r.length] = r.n
    return bound(counts)


def place(pieces: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES, merge: int = MERGE) -> tuple[DataFrame, list[tuple[int, int]], int]:
    """(key, piece, sequence_id, offset of every piece; (parts, bins in use) of each round; bound on all bins).

    ``pieces`` is a stored table with key, piece and length.
    """
    n = pieces.count()
    least = bins_needed(certificate(pieces, capacity))
    parts = max(1, -(-n // part_pieces))
    now = pieces.select("key", "piece", F.col("length").cast("int").alias("length")).withColumn("part", F.pmod(F.xxhash64("key", "piece"), F.lit(parts)))
    done, rounds, kept = [], [], 0
    while True:
        state = _round(now, len(rounds), capacity, max(1, part_pieces // merge))
        bins = state.groupBy("part", "bin").agg(F.first("back").alias("back"))
        closed, opened = bins.agg(F.count_if(~F.col("back")), F.count_if("back")).first()
        rounds.append((parts, kept + closed + opened))
        if parts == 1 or not opened or kept + closed + opened <= least:
            done.append(state)
            break
        done.append(state.where("not back"))
        kept += closed
        parts = -(-parts // merge)
        now = state.where("back").select("key", "piece", "length", F.expr(f"part div {merge}").alias("part"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    # 2^8 rounds, 2^35 parts and 2^20 bins of a part stay apart
    number = F.shiftleft(F.col("round").cast("long"), 55) + F.shiftleft("part", 20) + F.col("bin")
    return out.select("key", "piece", number.alias("sequence_id"), "offset"), rounds, least


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
         part_pieces: int = PART_PIECES) -> DataFrame:
    """A row for each piece: the id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stored(cut_pieces(docs, capacity, tokenizer, end_id, id_col, text_col), "pieces")
    placed, _, _ = place(pieces, capacity, part_pieces)
    return pieces.join(placed, ["key", "piece"]).select(F.col("row_id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def write_sequences(docs: DataFrame, path: str, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID, id_col: str = "doc_id",
                    text_col: str = "text", part_pieces: int = PART_PIECES) -> None:
    """Parquet with a row for each sequence: sequence_id, ids (little-endian 32-bit) and its pieces (id, piece, offset, length)."""
    pieces = stored(cut_pieces(docs, capacity, tokenizer, end_id, id_col, text_col, with_ids=True), "pieces")
    placed, _, _ = place(pieces, capacity, part_pieces)
    one = F.struct("offset", "length", F.col("row_id").alias(id_col), "piece", "ids")
    whole = pieces.join(placed, ["key", "piece"]).groupBy("sequence_id").agg(F.sort_array(F.collect_list(one)).alias("p"))  # ``capacity`` pieces at most
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    whole.select("sequence_id", joined.alias("ids"), F.transform("p", lambda x: F.struct(x[id_col].alias(id_col), x["piece"].alias("piece"), x["offset"].alias("offset"),
                                                                                       x["length"].alias("length"))).alias("pieces")).write.parquet(path)


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
