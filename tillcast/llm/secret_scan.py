"""Secret scans: fixed patterns plus a linear-chain conditional random field.

The patterns (kinds assign, access, hex) are searched in whole texts. The CRF (kind crf) tags
every token as begin, inside or outside of a secret. Tokens are runs of ``[A-Za-z0-9+/_=-]``
and single other non-space characters. Features of a token: its shape (length class, digits,
cases, hex only, changes between letters and digits), its lower-cased text, the text of the
two words before and of the next one, whether a separator (``=`` ``:`` or a quote) precedes
it, and two features of the file (share of digits, share of symbols). It is trained here, on
a bounded sample of windows around pattern hits and of other windows of the corpus (the
patterns are the silver labels; ``train_windows`` is the bound), by maximum likelihood, and
decoded by Viterbi.

Decoding is exact but skips what it can prove: where a token's score of "outside" is above
its other scores by more than all transitions could change, the best path is outside there,
so only the stretches between such tokens are decoded.

Every decoded span is reported, whatever its length or characters; where pattern spans cover a part
of it, the rest is.

Offsets are code points, ends exclusive. Defined results: null and empty texts have no spans;
texts of any length are scanned whole; repeated rows are scanned each; without pattern hits to
learn from (an empty table, too) the CRF adds nothing. Further columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm import textbytes as tb
from tillcast.llm.common import map_arrow, narrow, stored

# Kinds in the order of the contract, their patterns, group and least length.
KINDS = ("assign", "access", "hex", "crf")
PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    # shorter runs are dropped anyway, and runs are maximal, so the least length may stand in the pattern
    "hex": (re.compile(r"[0-9a-f]{24,}"), 0, 24),
}
OUT, BEGIN, INSIDE = 0, 1, 2
SECRET_BYTE = tb.byte_class([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *b"+/_=-"])
SPACE = ~tb.SPACE_WORD
DIGIT = tb.byte_class(range(0x30, 0x3A))
UPPER = tb.byte_class(range(0x41, 0x5B))
LOWER = tb.byte_class(range(0x61, 0x7B))
HEX = tb.byte_class([*range(0x30, 0x3A), *range(0x61, 0x67)])
SYMBOL = tb.byte_class(b"#*$%&|<>!")


@dataclass(frozen=True)
class SecretScan:
    bits: int = 16              # log2 of the hashed feature weights
    train_windows: int = 3000   # most windows of each sort (with and without a hit) that are learnt from
    offered: int = 8            # one in so many texts without a hit offers a window
    window: int = 41            # tokens of a training window
    rounds: int = 60
    rate: float = 0.5
    decay: float = 1e-5
    seed: int = 7


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the pattern matches, sorted."""
    out = []
    for k, kind in enumerate(KINDS[:3]):
        pattern, group, least = PATTERNS[kind]
        for m in pattern.finditer(text):
            if len(m[group]) >= least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first token of each row): secret-like runs, and other bytes but spaces one by one
    (a non-ASCII run is one token)."""
    high = tb.byte_class(range(0x80, 0x100))
    kind = np.select([SECRET_BYTE[data], high[data], SPACE[data]], [1, 2, 0], 3).astype(np.int8)
    new = np.r_[True, (kind[1:] != kind[:-1]) | (kind[1:] == 3)] if len(data) else np.zeros(0, bool)
    cut = offsets[:-1]
    new[cut[cut < len(data)]] = True
    at = np.flatnonzero(new)
    ends = np.r_[at[1:], len(data)] if len(at) else at
    real = kind[at] != 0
    starts, ends = at[real], ends[real]
    return starts, ends, np.searchsorted(starts, offsets)


N_FEATURES = 9


def features(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, bits: int) -> np.ndarray:
    """Hashed feature places, one row for each token."""
    lower = tb.LOWER[data]
    word = tb.span_hashes(lower, starts, ends)

    def count(cls):
        total = np.r_[0, np.cumsum(cls[data])]
        return total[ends] - total[starts]

    length, digits, upper, low, hexa = ends - starts, count(DIGIT), count(UPPER), count(LOWER), count(HEX)
    is_digit = DIGIT[data]
    change = np.r_[0, np.cumsum(np.r_[False, is_digit[1:] != is_digit[:-1]])] if len(data) else np.zeros(1, int)
    changes = change[ends] - change[np.minimum(starts + 1, ends)]
    shape = (np.minimum(np.searchsorted([1, 2, 4, 8, 12, 16, 20, 24, 32, 48, 64], length, "right"), 15)
             + 16 * (np.sign(digits) + (2 * digits >= length)) + 64 * np.sign(upper) + 128 * np.sign(low)
             + 256 * (hexa == length) + 512 * np.minimum(changes, 7) + 4096 * (digits + upper + low == length)).astype(tb.U64)
    n, row = len(starts), np.repeat(np.arange(len(offsets) - 1), np.diff(first))

    def moved(values, by):
        out = np.zeros(n, dtype=tb.U64)
        if abs(by) < n:
            if by > 0:
                ok = row[by:] == row[:-by]
                out[by:][ok] = values[:-by][ok]
            else:
                ok = row[-by:] == row[:by]
                out[:by][ok] = values[-by:][ok]
        return out

    is_word = SECRET_BYTE[data[starts]] if n else np.zeros(0, bool)
    separator = np.isin(data[starts], list(b"=:\"'")) if n else np.zeros(0, bool)
    at = np.where(is_word & ~separator, np.arange(n), -1)
    last = np.r_[-1, np.maximum.accumulate(at)[:-1]] if n else at  # the word before, separators passed over
    ok = (last >= 0) & (np.arange(n) - last <= 4)
    ok[ok] = row[last[ok]] == row[ok]
    key = np.where(ok, word[np.maximum(last, 0)], tb.U64(0)) if n else word
    size = np.maximum(np.diff(offsets), 1)
    digit_share = np.minimum(20 * tb.row_sums(is_digit, offsets) // size, 9)[row].astype(tb.U64)
    symbol_share = np.minimum(40 * tb.row_sums(SYMBOL[data], offsets) // size, 9)[row].astype(tb.U64)
    long = (length >= 12).astype(tb.U64)
    columns = [shape, moved(shape, 1) * tb.U64(2) + long, moved(word, 1), moved(word, -1), np.where(length < 12, word, tb.U64(1)),
               mixed(key, long), mixed(shape, moved(word, 1)), digit_share * tb.U64(2) + long, symbol_share * tb.U64(2) + long]
    mask = tb.U64((1 << bits) - 1)
    return np.stack([(tb.mix64(c + tb.U64((i + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) & mask).astype(np.int64) for i, c in enumerate(columns)], axis=1)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return tb.mix64(a) ^ (tb.mix64(b + tb.U64(77)) * tb.U64(3))


@dataclass
class Crf:
    weights: np.ndarray  # (2**bits, 3)
    moves: np.ndarray    # (from, to)

    @property
    def reach(self) -> float:
        """Most that the transitions into and out of a token can change a path's score."""
        return 2 * float(self.moves.max() - self.moves.min())


def fit(feats: np.ndarray, tags: np.ndarray, p: SecretScan) -> Crf:
    """Maximum likelihood over windows of equal length: feats (windows, tokens, features), tags -1 past the end."""
    windows, steps, _ = feats.shape
    w, moves = np.zeros((1 << p.bits, 3)), np.zeros((3, 3))
    gw, gm = np.full_like(w, 1e-8), np.full_like(moves, 1e-8)
    real = tags >= 0
    flat = feats[real].ravel()
    gold = np.eye(3)[tags[real]]
    gold_moves = np.zeros((3, 3))
    both = real[:, 1:] & real[:, :-1]
    np.add.at(gold_moves, (tags[:, :-1][both], tags[:, 1:][both]), 1)
    for _ in range(p.rounds):
        e = w[feats].sum(axis=2)                        # windows, steps, 3
        f, b = np.empty_like(e), np.zeros_like(e)
        f[:, 0] = e[:, 0]
        for t in range(1, steps):
            new = _lse(f[:, t - 1][:, :, None] + moves, 1) + e[:, t]
            f[:, t] = np.where(real[:, t, None], new, f[:, t - 1])
        z = _lse(f[:, -1], 1)
        expect = np.zeros((3, 3))
        for t in range(steps - 2, -1, -1):
            after = e[:, t + 1] + b[:, t + 1]
            b[:, t] = np.where(real[:, t + 1, None], _lse(moves + after[:, None, :], 2), b[:, t + 1])
            pair = np.exp(f[:, t][:, :, None] + moves + after[:, None, :] - z[:, None, None])
            expect += pair[both[:, t]].sum(axis=0)
        post = np.exp(f + b - z[:, None, None])[real]
        diff = np.repeat(gold - post, feats.shape[2], axis=0)
        grad = np.stack([np.bincount(flat, weights=diff[:, k], minlength=len(w)) for k in range(3)], axis=1) / windows - p.decay * w
        grad_moves = (gold_moves - expect) / windows
        gw += grad ** 2
        gm += grad_moves ** 2
        w += p.rate * grad / np.sqrt(gw)
        moves += p.rate * grad_moves / np.sqrt(gm)
    return Crf(w.astype(np.float32), moves)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis=axis))


def viterbi(emit: np.ndarray, moves: np.ndarray) -> list[int]:
    """Best path; of equals the lowest tag."""
    score, back = emit[0].astype(float), []
    for e in emit[1:]:
        step = score[:, None] + moves
        best = step.argmax(axis=0)
        back.append(best)
        score = step[best, range(3)] + e
    path = [int(score.argmax())]
    for best in reversed(back):
        path.append(int(best[path[-1]]))
    return path[::-1]


def best_tags(emit: np.ndarray, first: np.ndarray, crf: Crf) -> np.ndarray:
    """Viterbi tags of every row's chain (rows from first[i] to first[i + 1])."""
    tags = np.zeros(len(emit), dtype=np.int8)
    if not len(emit):
        return tags
    sure = emit[:, OUT] - emit[:, 1:].max(axis=1) > crf.reach
    open_ = ~sure
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    begin = np.flatnonzero(open_ & np.r_[True, sure[:-1] | (row[1:] != row[:-1])])
    end = np.flatnonzero(open_ & np.r_[sure[1:] | (row[1:] != row[:-1]), True]) + 1
    before = np.r_[False, row[1:] == row[:-1]]
    for a, b in zip(begin.tolist(), end.tolist()):
        part = emit[a:b].astype(float)
        if before[a]:
            part[0] += crf.moves[OUT]      # the sure token before
        if b < len(emit) and before[b]:
            part[-1] += crf.moves[:, OUT]  # and behind
        tags[a:b] = viterbi(part, crf.moves)
    return tags


def emissions(data, offsets, crf: Crf, bits: int):
    starts, ends, first = tokens(data, offsets)
    feats = features(data, offsets, starts, ends, first, bits)
    emit = np.zeros((len(starts), 3), dtype=np.float32)
    for j in range(feats.shape[1]):
        emit += crf.weights[feats[:, j]]
    return starts, ends, first, emit


def crf_spans(data: np.ndarray, offsets: np.ndarray, crf: Crf, p: SecretScan) -> list[list[tuple[int, int]]]:
    """Code point spans of the secrets tagged in every row."""
    starts, ends, first, emit = emissions(data, offsets, crf, p.bits)
    tags = best_tags(emit, first, crf)
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(offsets) - 1)]
    hit = np.flatnonzero(tags != OUT)
    if not len(hit):
        return out
    lead = np.r_[0, np.cumsum(~tb.CONTINUATION[data])]
    rows = np.searchsorted(first, hit, "right") - 1
    a = None
    for n, (i, r) in enumerate(zip(hit.tolist(), rows.tolist())):
        if a is None or tags[i] == BEGIN or hit[n - 1] != i - 1 or rows[n - 1] != r:
            a = i
        if n + 1 == len(hit) or hit[n + 1] != i + 1 or rows[n + 1] != r or tags[hit[n + 1]] == BEGIN:
            base = lead[offsets[r]]
            out[r].append((int(lead[starts[a]] - base), int(lead[ends[i]] - base)))
    return out


def silver_windows(docs: DataFrame, p: SecretScan) -> tuple[np.ndarray, np.ndarray]:
    """A bounded sample of windows: (features, tags), at most 2 * train_windows rows.

    Each distinct text offers one window around its first hit; of those without a hit one in
    ``offered`` does. The windows with the smallest hash of their text are taken, so the sample
    does not depend on the layout.
    """
    schema = T.StructType([T.StructField("hit", T.BooleanType()), T.StructField("rank", T.LongType()),
                           T.StructField("feats", T.BinaryType()), T.StructField("tags", T.BinaryType())])

    def work(batch: pa.RecordBatch):
        best: dict[bool, list] = {True: [], False: []}
        for lo, hi, data, off in tb.slices(batch.column("text")):
            texts = batch.column("text").slice(lo, hi - lo).to_pylist()
            key = tb.mix64(tb.span_hashes(data, off[:-1], off[1:]) + tb.U64(p.seed)) >> tb.U64(1)
            for i, text in enumerate(texts):
                spans = [(a, b) for a, _, b in pattern_spans(text)] if text else []
                if not text or not spans and int(key[i]) % p.offered:
                    continue
                own, whole = data[off[i]:off[i + 1]], np.array([0, off[i + 1] - off[i]])
                starts, ends, first = tokens(own, whole)
                n = len(starts)
                lead = np.r_[0, np.cumsum(~tb.CONTINUATION[own])]
                cs, ce = lead[starts], lead[ends]
                tags = np.zeros(n, dtype=np.int32)
                for s, e in spans:
                    inside = np.flatnonzero((cs >= _value(text, s, e)) & (ce <= e))
                    if len(inside) and not tags[inside].any():
                        tags[inside] = INSIDE
                        tags[inside[0]] = BEGIN
                if not n or spans and not tags.any():
                    continue
                middle = int(np.flatnonzero(tags)[0]) if spans else int(key[i] >> tb.U64(8)) % n
                x = min(max(0, middle - p.window // 2), max(0, n - p.window))
                feats = features(own, whole, starts, ends, first, p.bits)[x:x + p.window]
                best[bool(spans)].append((int(key[i]), feats.astype(np.int32).tobytes(), tags[x:x + p.window].tobytes()))
        rows = [(h, *r) for h in best for r in sorted(best[h], key=lambda r: r[0])[:p.train_windows]]
        yield {"hit": [r[0] for r in rows], "rank": [r[1] for r in rows], "feats": [r[2] for r in rows], "tags": [r[3] for r in rows]}

    found = stored(map_arrow(docs, work, schema).dropDuplicates(["hit", "rank"]), "windows")
    rows = [r for hit in (True, False) for r in _smallest(found.where(F.col("hit") == hit), p.train_windows)]
    return _pad([r.feats for r in rows], [r.tags for r in rows], p)


#: Leading bits of a rank that are counted at once.
RANK_BITS = 12


def _smallest(found: DataFrame, n: int) -> list:
    """The n rows of smallest ``rank`` (63 bits, distinct), in order. The n-th rank is narrowed down by counts of leading
    bits, the executors filter by it, and no more than n rows are sent to the driver."""
    low, shift, before = 0, 63, 0
    while shift > 0:
        step = min(RANK_BITS, shift)
        shift -= step
        inside = found.where((F.col("rank") >= low) & (F.col("rank") <= low + (1 << shift + step) - 1))
        counts = inside.groupBy(F.shiftright("rank", shift).alias("lead")).agg(F.count("*").alias("n")).orderBy("lead").collect()  # 2**RANK_BITS rows
        for r in counts:
            if before + r.n > n:
                low = r.lead << shift
                break
            before += r.n
        else:  # all that is left fits
            low = low + (1 << shift + step)
            break
        if before == n:
            break
    return found.where(F.col("rank") <= low - 1).orderBy("rank").collect()


def _value(text: str, start: int, end: int) -> int:
    """Where the value of a pattern span begins (behind the name and the separators)."""
    m = PATTERNS["assign"][0].match(text, start, end)
    return m.start(2) if m else start


def _pad(feats: list, tags: list, p: SecretScan) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((len(feats), p.window, N_FEATURES), dtype=np.int64)
    y = np.full((len(feats), p.window), -1, dtype=np.int64)
    for i, (f, t) in enumerate(zip(feats, tags)):
        t = np.frombuffer(t, dtype=np.int32)
        x[i, :len(t)] = np.frombuffer(f, dtype=np.int32).reshape(-1, N_FEATURES)
        y[i, :len(t)] = t
    return x, y


def train(docs: DataFrame, p: SecretScan = SecretScan(), text_col: str = "text") -> Crf | None:
    """A CRF learnt from the corpus' own pattern hits; None where there are none."""
    x, y = silver_windows(narrow(docs, text=text_col), p)
    return fit(x, y, p) if (y == BEGIN).any() else None


def uncovered(start: int, end: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What is left of a span without the stretches of other spans (sorted by their starts)."""
    out = []
    for s, _, e in base:
        if s < end and start < e:
            if start < s:
                out.append((start, s))
            start = max(start, e)
    return out + ([(start, end)] if start < end else [])


def all_spans(texts: pa.Array, crf: Crf | None, p: SecretScan):
    """(pattern spans, all spans) of every text."""
    for lo, hi, data, off in tb.slices(texts):
        added = crf_spans(data, off, crf, p) if crf is not None else [[]] * (hi - lo)
        for i, text in enumerate(texts.slice(lo, hi - lo).to_pylist()):
            base = pattern_spans(text or "")
            more = [(a, 3, b) for x in added[i] for a, b in uncovered(*x, base)]
            yield base, sorted(base + more)


def scan(docs: DataFrame, p: SecretScan = SecretScan(), crf: Crf | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: the id, counts by kind, base_spans and spans (kind:start:end, comma-joined)."""
    crf = crf or train(docs, p, text_col)
    model = docs.sparkSession.sparkContext.broadcast(crf)  # 2**bits * 3 weights
    schema = T.StructType([T.StructField("row_id", docs.schema[id_col].dataType)] + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
                          + [T.StructField("base_spans", T.StringType()), T.StructField("spans", T.StringType())])

    def work(batch: pa.RecordBatch):
        out = {f.name: [] for f in schema if f.name != "row_id"}
        for base, spans in all_spans(batch.column("text"), model.value, p):
            for k, kind in enumerate(KINDS):
                out[f"n_{kind}"].append(sum(x[1] == k for x in spans))
            out["base_spans"].append(joined(base))
            out["spans"].append(joined(spans))
        yield {"row_id": batch.column("row_id")} | out

    return map_arrow(narrow(docs, row_id=id_col, text=text_col), work, schema).withColumnRenamed("row_id", id_col)


def masked(text: str | None, spans: list[tuple[int, int, int]], mask: str) -> str | None:
    """The text with every stretch of overlapping spans replaced by ``mask``."""
    if not spans:
        return text
    out, end = [], 0
    for a, _, b in spans:
        if a >= end:
            out += [text[end:a], mask]
        end = max(end, b)
    return "".join(out) + text[end:]


def redact(docs: DataFrame, p: SecretScan = SecretScan(), crf: Crf | None = None, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """The same rows and columns with the secrets in the text masked."""
    crf = crf or train(docs, p, text_col)
    model = docs.sparkSession.sparkContext.broadcast(crf)
    at, schema = docs.columns.index(text_col), docs.schema

    def work(batch: pa.RecordBatch):
        texts = batch.column(at)
        clean = [masked(t, spans, mask) for t, (_, spans) in zip(texts.to_pylist(), all_spans(texts, model.value, p))]
        yield {c: clean if i == at else batch.column(i) for i, c in enumerate(docs_columns)}

    docs_columns = docs.columns
    return map_arrow(docs, work, schema)
