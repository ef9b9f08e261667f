"""SentencePiece encoding and decoding of whole texts (merge-type models with byte fallback).

Method: exact encoding by backtracking. An Aho-Corasick automaton over the vocabulary gives
the longest piece at every position; pieces are laid greedily, a piece is accepted only if
re-merging it with its left neighbour gives back the same two pieces, otherwise the next
shorter piece is tried; when none is left the position is cleared in a bitfield and the
previous piece is taken back. Which piece is accepted after another, given the longest ahead, is kept
as a step, so pieces that do not fit are tried once and not in every chunk. The first complete sequence is the one that merging would
build. Pieces whose merge scores tie with another piece (in public models the runs of
spaces) order merges by place instead of by piece, which pairwise checks cannot see, so a
chunk that holds such a run is merged directly.

Texts are cut into chunks where no piece of the vocabulary can reach across, some texts at a time and
as arrays of code points; the ids of recent chunks are kept in a table of bounded size per worker
(``idtable``, by 64-bit hashes of the chunks), the checked pairs in another, the steps in a third.

Defined results: null and empty text: no ids, decoded to the empty text. Texts of any length
are encoded whole. Rows are independent: repeated rows give repeated results. Further
columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillcast.llm import textbytes as tb
from tillcast.llm.common import map_arrow, narrow, worker_tables
from tillcast.llm.idtable import IdTable, gathered

SPACE = "▁"
#: Candidate cuts, finest first; a model uses the first that never divides one of its pieces.
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
CUTS = (rf"{SPACE}*[{LATIN}]+|{SPACE}*[^{LATIN}{SPACE}]+|{SPACE}+", rf"{SPACE}*[^{SPACE}]+|{SPACE}+", r"(?s:.+)")
#: 0 for the space, 2 for the characters of LATIN, 1 for all others, of which the last place stands for what comes after it.
POINT_KIND = np.ones(ord(SPACE) + 2, dtype=np.int8)
POINT_KIND[ord(SPACE)] = 0
POINT_KIND[[i for i in range(0x250) if re.match(f"[{LATIN}]", chr(i))]] = 2
CACHED_CHUNKS, CACHED_CHARS, CACHED_IDS = 500_000, 24, 4_000_000
CACHED_PAIRS = 400_000
CACHED_STEPS = 400_000


def chunk_starts(points: np.ndarray, rows: np.ndarray, level: int) -> np.ndarray:
    """Where ``CUTS[level]`` begins a match in texts of code points; ``rows``: where the texts begin."""
    first = np.zeros(len(points), dtype=bool)
    first[rows[rows < len(points)]] = True
    if level < 2 and len(points):
        kind = POINT_KIND.take(points, mode="clip") if level == 0 else (points != ord(SPACE)).view(np.int8)
        first[1:] |= (kind[:-1] != 0) & (kind[1:] != kind[:-1])
    return np.flatnonzero(first)


class PieceCodec:
    """Encoder built from the vocabulary and scores of a SentencePiece BPE model file."""

    def __init__(self, model_path: str) -> None:
        import ahocorasick
        import sentencepiece

        self.processor = p = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.scores: dict[str, float] = {}
        self.code: dict[str, bytes] = {}
        self.byte_ids = [0] * 256
        for i in range(p.get_piece_size()):
            piece = p.id_to_piece(i)
            if p.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
                self.scores[piece], self.code[piece] = p.get_score(i), np.uint32(i).tobytes()
        seen: dict[float, int] = {}
        for piece, s in self.scores.items():
            if len(piece) > 1:
                seen[s] = seen.get(s, 0) + 1
        tied = [x for x, s in self.scores.items() if len(x) > 1 and seen[s] > 1]
        self.tied = re.compile("|".join(map(re.escape, tied))) if tied else None
        self.automaton = ahocorasick.Automaton()
        for piece in self.scores:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.shorter: dict[str, str] = {}
        for piece in self.scores:
            cut = piece[:-1]
            while len(cut) > 1 and cut not in self.scores:
                cut = cut[:-1]
            if cut:
                self.shorter[piece] = cut
        for self.level, cut in enumerate(CUTS):
            if all(len(re.findall(cut, x)) == 1 for x in self.scores):
                break
        self.pairs: dict[str, dict[str, bool]] = {}  # by the left piece
        self.n_pairs = 0
        # of an accepted piece: its ids, the steps after it, its length, the next shorter piece, itself; a step leads
        # from a piece that is tried to the first that fits, of it and the shorter ones
        self.after: dict[str, tuple[bytes, dict, int, str | None, str]] = {}
        self.first: dict[str, tuple | None] = {}  # the steps from a chunk's begin
        self.n_steps = 0
        self.table = IdTable(CACHED_CHUNKS, CACHED_IDS)
        self.decimal = [str(i) for i in range(p.get_piece_size())]

    def merge(self, text: str) -> list[str]:
        """Merging itself: the best adjacent pair first, the leftmost of equals."""
        parts, score, none = list(text), self.scores.get, float("-inf")
        pairs = [score(x + y, none) for x, y in zip(parts, parts[1:])]
        while pairs:
            best = max(pairs)
            if best == none:
                break
            at = pairs.index(best)
            whole = parts[at] + parts[at + 1]
            parts[at:at + 2] = [whole]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = score(whole + parts[at + 1], none)
            if at:
                pairs[at - 1] = score(parts[at - 1] + whole, none)
        return parts

    def merge_long(self, text: str) -> list[str]:
        """``merge`` with a queue, for long runs of tied pieces."""
        import heapq

        parts: list[str | None] = list(text)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        queue: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and right[i] < len(parts):
                s = self.scores.get(whole := parts[i] + parts[right[i]])
                if s is not None:
                    heapq.heappush(queue, (-s, i, whole))

        for i in range(len(parts) - 1):
            offer(i)
        while queue:
            _, i, whole = heapq.heappop(queue)
            if parts[i] is None or right[i] >= len(parts) or parts[i] + parts[right[i]] != whole:
                continue
            j = right[i]
            parts[i], parts[j], right[i] = whole, None, right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            offer(left[i])
            offer(i)
        return [x for x in parts if x is not None]

    def fits(self, a: str, b: str) -> bool:
        """True if merging a + b gives a and b again; with no a, if b is what merging its own text gives."""
        row = self.pairs.get(a)
        if row is None:
            row = self.pairs[a] = {}
        ok = row.get(b)
        if ok is None:
            if self.n_pairs >= CACHED_PAIRS:
                self.pairs.clear()
                self.n_pairs, row = 0, {}
                self.pairs[a] = row
            ok = row[b] = self.merge(a + b) == ([a, b] if a else [b])
            self.n_pairs += 1
        return ok

    def step(self, steps: dict, last: str, piece: str) -> tuple | None:
        """The ``after`` of the longest piece that fits after ``last``, of ``piece`` and its shorter ones; none: None."""
        if self.n_steps >= CACHED_STEPS:
            for _, own, _, _, _ in self.after.values():
                own.clear()
            self.after.clear()
            self.first.clear()
            self.n_steps = 0
        longest = piece
        while not (ok := self.fits(last, piece)) and len(piece) > 1:
            piece = self.shorter[piece]
        if ok and piece not in self.after:
            self.after[piece] = (self.code_of(piece), {}, len(piece), self.shorter.get(piece), piece)
        found = steps[longest] = self.after[piece] if ok else None
        self.n_steps += 1
        return found

    def accepted(self, chunk: str) -> list[tuple]:
        """The ``after`` of every piece of a chunk."""
        longest: list[str] = list(chunk)
        for end, piece in self.automaton.iter(chunk):
            longest[end + 1 - len(piece)] = piece  # ends ascend, so a longer one comes later
        n, pos, failed = len(chunk), 0, 0  # failed: a bit for each position that no sequence gets past
        out: list[tuple] = []
        before: list[tuple[dict, str]] = []  # the steps and the piece before each accepted one
        steps, last, piece = self.first, "", longest[0]
        while True:
            found = None
            while piece is not None:
                try:
                    found = steps[piece]
                except KeyError:
                    found = self.step(steps, last, piece)
                if found is None or not failed or not failed >> (pos + found[2]) & 1:
                    break
                piece, found = found[3], None
            if found is not None:
                out.append(found)
                pos += found[2]
                if pos == n:
                    return out
                before.append((steps, last))
                steps, last, piece = found[1], found[4], longest[pos]
            else:
                failed |= 1 << pos
                if not out:
                    raise ValueError("no valid sequence of pieces")
                _, _, size, piece, _ = out.pop()
                steps, last = before.pop()
                pos -= size

    def backtrack(self, chunk: str) -> list[str]:
        return [x[4] for x in self.accepted(chunk)]

    def code_of(self, piece: str) -> bytes:
        """Its id, or the ids of its bytes for a character that is no piece."""
        return self.code.get(piece) or np.array([self.byte_ids[b] for b in piece.encode()], dtype=np.uint32).tobytes()

    def encode_chunk(self, chunk: str) -> bytes:
        if self.tied and self.tied.search(chunk):
            return b"".join([self.code_of(x) for x in self.merge_long(chunk)])
        return b"".join([x[0] for x in self.accepted(chunk)])

    def coded_many(self, texts: list[str | None]) -> list[np.ndarray]:
        """All ids of each text."""
        normal = [self.processor.normalize(t) if t else "" for t in texts]
        whole = "".join(normal)
        points = np.frombuffer(whole.encode("utf-32-le"), dtype="<u4")
        rows = np.r_[0, np.cumsum([len(t) for t in normal], dtype=np.int64)]
        starts = chunk_starts(points, rows[:-1], self.level)
        ends = np.r_[starts[1:], len(points)]
        hashes, one, where = np.unique(tb.run_hashes(tb.mix64(points), starts, ends), return_index=True, return_inverse=True)
        known, begin, length = self.table.find(hashes)
        new, ids = np.flatnonzero(~known), self.table.ids
        if len(new):
            parts = [self.encode_chunk(whole[a:b]) for a, b in zip(starts[one[new]].tolist(), ends[one[new]].tolist())]
            more, lengths = np.frombuffer(b"".join(parts), dtype=np.uint32), np.fromiter(map(len, parts), np.int64, len(parts)) // 4
            at = np.cumsum(lengths) - lengths
            begin[new], length[new] = len(ids) + at, lengths
            ids = np.concatenate([ids, more])
            short = (ends - starts)[one[new]] <= CACHED_CHARS
            self.table.keep(hashes[new][short], more, at[short], lengths[short])
        out = gathered(ids, begin[where], length[where])
        cut = np.r_[0, np.cumsum(length[where])][np.searchsorted(starts, rows)]
        return [out[a:b] for a, b in zip(cut.tolist(), cut[1:].tolist())]

    def coded(self, text: str | None) -> np.ndarray:
        return self.coded_many([text])[0]

    def encode(self, text: str | None) -> list[int]:
        return self.coded(text).tolist()

    def joined(self, ids: list[int]) -> str:
        return ",".join(map(self.decimal.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.processor.decode(ids) if ids else ""


_CODECS: dict[str, PieceCodec] = worker_tables("pieces")


def codec(model_path: str) -> PieceCodec:
    """One codec for each model and worker process."""
    if model_path not in _CODECS:
        _CODECS[model_path] = PieceCodec(model_path)
    return _CODECS[model_path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


SLICE = 1 << 18


def texts_coded(texts: pa.Array, c: PieceCodec):
    """(first row, end, the ids of each text) of some texts at a time."""
    for lo, hi, _, _ in tb.slices(texts, SLICE):
        yield lo, hi, c.coded_many(texts.slice(lo, hi - lo).to_pylist())


def encode_texts(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 with_text: bool = True) -> DataFrame:
    """One row per input row: the id column, ``token_ids`` and, if asked for, ``decoded``."""
    schema = T.StructType([T.StructField("row_id", docs.schema[id_col].dataType), T.StructField("token_ids", T.ArrayType(T.IntegerType()))]
                          + [T.StructField("decoded", T.StringType())] * with_text)

    def work(batch: pa.RecordBatch):
        c = codec(model_path or default_model())
        # handed on slice by slice: neither the worker nor Spark holds the ids and texts of a whole batch
        for lo, hi, ids in texts_coded(batch.column("text"), c):
            decoded = {"decoded": [c.decode(own.tolist()) for own in ids]} if with_text else {}
            yield {"row_id": batch.column("row_id").slice(lo, hi - lo), "token_ids": ids} | decoded

    return map_arrow(narrow(docs, row_id=id_col, text=text_col), work, schema, "pieces").withColumnRenamed("row_id", id_col)


def code_digests(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text; return n_tokens and the digests of ids and decoded text.

    The ids and texts themselves stay in the task that made them.
    """
    schema = T.StructType([T.StructField("row_id", docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def work(batch: pa.RecordBatch):
        c = codec(model_path or default_model())
        n, a, b = [], [], []
        for _, _, coded in texts_coded(batch.column("text"), c):
            for own in coded:
                ids = own.tolist()
                n.append(len(ids))
                a.append(hashlib.sha256(c.joined(ids).encode()).hexdigest())
                b.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
        yield {"row_id": batch.column("row_id"), "n_tokens": n, "ids_sha256": a, "decoded_sha256": b}

    return map_arrow(narrow(docs, row_id=id_col, text=text_col), work, schema, "pieces").withColumnRenamed("row_id", id_col)
