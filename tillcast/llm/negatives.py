"""Hard-negative mining over embeddings, scores bounded by summaries of vector segments.

A vector of d components is cut into segments of ``SEGMENT``; each segment's mean m and deviation s
(length of what is left of it without the mean) are stored with the vector. Over a segment of k
components the inner product of two vectors is k m m' plus the product of the two rests, which lies
within s s': the sum of k m m' plus or minus the sum of s s' bounds the score. Two neighbouring
segments make one of twice the length whose mean and deviation follow from theirs, so the
same summary gives a hierarchy: a pair is first bounded over a few long segments, pairs that could
still matter over shorter ones, and only what is left is scored exactly.

Every anchor meets every row, in blocks: anchors lie in ``g`` groups, rows in ``h`` slices by a hash
of their block, a task has one slice and one group (each row block is sent to the g groups, each
anchor block to the h slices), so neither a label nor an anchor that is frequent makes a large
task. A task holds for each anchor of its group the best rows so far; its last of them is the
bar that a pair's upper bound must reach. What tasks found is merged by a window of some rows a
slice for each anchor. A first pass finds the positives; with their scores, which give each
positive a band of allowed scores, a second one finds the negatives.

Defined results: rows with a null id, a null label or without an exact vector take no part (see
``vectors``); scores are exact integers. A row of the anchor's own id is not another row. Repeated
rows are rows of their own: each copy of an anchor gives its result, copies fill places. An anchor
without positives, a positive with no row in its band and an empty table give no rows. A label or
id that is no integer is null. Further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.common import narrow, stored
from tillcast.llm.vectors import binary_rows, coded, matrix

FACTOR = 256
SEGMENT = 4  # components of a stored segment
ANCHORS = 256  # of a block
ROWS = 2048
#: Pairs of one task; small inputs are dealt finer, to ``SPREAD`` tasks a core.
TASK_PAIRS = 1 << 32
SPREAD = 2
#: Share of the vectors' lengths added to a bound for the rounding of the 32-bit summaries, and more for each segment.
SLACK, SLACK_SEGMENT = 4e-6, 2.4e-7
NONE = -(1 << 62)  # a score below all others


def summaries(flat: np.ndarray, lengths: np.ndarray) -> dict:
    """Means and deviations of all segments of each row (rows of one table end to end), as 32-bit floats."""
    means, devs, counts = [np.zeros(0, np.float32)], [np.zeros(0, np.float32)], []
    at = 0
    for n in lengths.tolist():
        m, s = _summary(flat[at:at + n][None, :])
        means.append(m[0]), devs.append(s[0]), counts.append(m.shape[1])
        at += n
    counts = np.array(counts, dtype=np.int64)
    return {"means": binary_rows(np.concatenate(means), counts), "deviations": binary_rows(np.concatenate(devs), counts)}


def _summary(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows of equal length; the last segment is filled up with zeros."""
    n, d = x.shape
    k = -(-d // SEGMENT)
    parts = np.zeros((n, k * SEGMENT))
    parts[:, :d] = x
    parts = parts.reshape(n, k, SEGMENT)
    mean = parts.mean(axis=2)
    return mean.astype(np.float32), np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2)).astype(np.float32)


def coarser(mean: np.ndarray, dev: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Neighbouring segments joined in pairs; a last odd one is joined with a segment of zeros."""
    if mean.shape[1] % 2:
        mean, dev = np.pad(mean, ((0, 0), (0, 1))), np.pad(dev, ((0, 0), (0, 1)))
    a, b = mean[:, ::2], mean[:, 1::2]
    return (a + b) / 2, np.sqrt(dev[:, ::2] ** 2 + dev[:, 1::2] ** 2 + (a - b) ** 2 * (length / 2)), 2 * length


class Side:
    """One block: ids, labels, vectors, and summaries by level, the longest segments first; rows by (label, id)."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, mean: np.ndarray, dev: np.ndarray) -> None:
        self.ids, self.labels, self.x = ids, labels, x
        self.top = int(np.abs(x).max(initial=0))
        levels = [(mean, dev, SEGMENT)]
        while levels[-1][0].shape[1] > 2:
            levels.append(coarser(*levels[-1]))
        # every second level: each refines fourfold
        self.levels = [(np.ascontiguousarray(m * np.float32(math.sqrt(n))), np.ascontiguousarray(s)) for m, s, n in levels[::2][::-1]]
        self.size = np.sqrt((np.asarray(x, dtype=np.float64) ** 2).sum(axis=1)).astype(np.float32)


def exact_scores(a: Side, b: Side, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Inner products as int64, by floating products where those are exact."""
    most = a.top * b.top * a.x.shape[1]
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return (a.x[rows].astype(kind) @ b.x[cols].astype(kind).T).astype(np.int64)


def candidates(a: Side, b: Side, rows: np.ndarray, cols: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchors, rows, exact scores): a sub-block outside which no score lies between ``least`` and
    ``most`` of its anchor (indexed as ``rows``); pairs within it may lie outside."""
    for (ma, sa), (mb, sb) in zip(a.levels, b.levels):
        if not len(rows) or not len(cols):
            break
        slack = np.float32(SLACK + SLACK_SEGMENT * ma.shape[1])
        mid = ma[rows] @ mb[cols].T
        off = sa[rows] @ sb[cols].T + slack * np.outer(a.size[rows], b.size[cols])
        open_ = (mid + off >= least[:, None]) & (mid - off <= most[:, None])
        keep_a, keep_b = open_.any(axis=1), open_.any(axis=0)
        rows, least, most, cols = rows[keep_a], least[keep_a], most[keep_a], cols[keep_b]
    return rows, cols, exact_scores(a, b, rows, cols) if len(rows) and len(cols) else np.zeros((len(rows), len(cols)), np.int64)


def merge(scores: np.ndarray, ids: np.ndarray, more_scores: np.ndarray, more_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k along the last axis: higher scores first, ties by smaller id."""
    s, i = np.concatenate([scores, more_scores], axis=-1), np.concatenate([ids, more_ids], axis=-1)
    order = np.lexsort((i, -s), axis=-1)[..., :k]
    return np.take_along_axis(s, order, -1), np.take_along_axis(i, order, -1)


def _first(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best allowed columns of each row; columns must ascend by id, so ties go to the first."""
    n = scores.shape[1]
    if np.abs(scores).max(initial=0) >= (1 << 61) // n:  # no room for the place in the key
        masked = np.where(allowed, scores, NONE)
        at = np.argsort(-masked, axis=1, kind="stable")[:, :k]
        masked = np.take_along_axis(masked, at, 1)
        return masked, np.where(masked != NONE, ids[at], np.iinfo(np.int64).max)
    key = np.where(allowed, scores * n + np.arange(n - 1, -1, -1), np.int64(NONE))
    if n > k:
        at = np.argpartition(key, n - k, axis=1)[:, n - k:]
        key = np.take_along_axis(key, at, 1)
    else:
        at = np.broadcast_to(np.arange(n), key.shape)
    hit = key != NONE
    return np.where(hit, np.take_along_axis(scores, at, 1), NONE), np.where(hit, ids[at], np.iinfo(np.int64).max)


class Best:
    """For each anchor of a block and each of its lists the best rows so far."""

    def __init__(self, n: int, lists: int, k: int) -> None:
        self.scores = np.full((n, lists, k), NONE, dtype=np.int64)
        self.ids = np.full((n, lists, k), np.iinfo(np.int64).max, dtype=np.int64)

    def add(self, rows: np.ndarray, j: int, scores: np.ndarray, ids: np.ndarray) -> None:
        self.scores[rows, j], self.ids[rows, j] = merge(self.scores[rows, j], self.ids[rows, j], scores, ids, self.scores.shape[2])

    @property
    def bar(self) -> np.ndarray:
        return self.scores[:, :, -1]


def _wide(v: np.ndarray, up: bool) -> np.ndarray:
    """Integers as 32-bit floats, rounded outwards."""
    f = v.astype(np.float32)
    return np.nextafter(f, np.float32(np.inf if up else -np.inf))


def add_positives(best: Best, a: Side, b: Side) -> None:
    """Rows of the anchor's label, label by label."""
    for label in np.unique(a.labels):
        lo, hi = np.searchsorted(b.labels, [label, label + 1])
        rows, cols = np.flatnonzero(a.labels == label), np.arange(lo, hi)
        if not len(cols):
            continue
        rows, cols, scores = candidates(a, b, rows, cols, _wide(best.bar[rows, 0], False), np.full(len(rows), np.inf, np.float32))
        if scores.size:
            allowed = (scores >= best.bar[rows, 0][:, None]) & (a.ids[rows][:, None] != b.ids[cols][None, :])
            best.add(rows, 0, *_first(scores, allowed, b.ids[cols], best.scores.shape[2]))


def add_negatives(best: Best, a: Side, b: Side, low: np.ndarray, high: np.ndarray) -> None:
    """Rows of another label, for each positive within its band (an empty band: low > high)."""
    bar = np.maximum(low, best.bar)
    some = low <= high
    rows = np.flatnonzero(some.any(axis=1))
    least = np.where(some, bar, np.iinfo(np.int64).max).min(axis=1)[rows]
    most = np.where(some, high, NONE).max(axis=1)[rows]
    order = np.argsort(b.ids, kind="stable")  # columns ascend by id
    rows, cols, scores = candidates(a, b, rows, order, _wide(least, False), _wide(most, True))
    if not scores.size:
        return
    other = a.labels[rows][:, None] != b.labels[cols][None, :]
    for j in range(low.shape[1]):
        allowed = other & (scores >= bar[rows, j][:, None]) & (scores <= high[rows, j][:, None])
        hit = allowed.any(axis=1)
        if hit.any():
            best.add(rows[hit], j, *_first(scores[hit], allowed[hit], b.ids[cols], best.scores.shape[2]))


BLOCK = "n int, ids binary, labels binary, x binary, means binary, deviations binary"


def _pack(batch: pa.RecordBatch, dims: int) -> tuple[dict, np.ndarray]:
    ids, labels = (batch.column(c).to_numpy(zero_copy_only=False).astype("<i8") for c in ("row_id", "label"))
    order = np.lexsort((ids, labels))
    segments = -(-dims // SEGMENT)
    x = matrix(batch.column("x"), "<i4", dims)
    if np.abs(x).max(initial=0) < 1 << 15:
        x = x.astype("<i2")
    return {"n": len(ids), "ids": ids[order].tobytes(), "labels": labels[order].tobytes(), "x": x[order].tobytes(),
            "means": matrix(batch.column("means"), "<f4", segments)[order].tobytes(), "deviations": matrix(batch.column("deviations"), "<f4", segments)[order].tobytes()}, order


def _side(row: dict, at: int, prefix: str, dims: int, own: bool = False) -> Side:
    """A block of an Arrow batch; ``own``: copied, as it outlives the batch."""

    def get(c: str):
        data = row[f"{prefix}{c}"][at].as_buffer()
        return data.to_pybytes() if own else data

    n = row[f"{prefix}n"][at].as_py()
    x = np.frombuffer(get("x"), dtype="<i2" if len(get("x")) == 2 * n * dims else "<i4").reshape(n, dims)
    return Side(np.frombuffer(get("ids"), "<i8"), np.frombuffer(get("labels"), "<i8"), x,
                np.frombuffer(get("means"), "<f4").reshape(n, -1), np.frombuffer(get("deviations"), "<f4").reshape(n, -1))


def _merged(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of up to ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            room = rows - sum(x.num_rows for x in held)
            held.append(batch.slice(0, room))
            batch = batch.slice(room)
            if sum(x.num_rows for x in held) == rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _blocks(df: DataFrame, dims: int, rows: int, extra: list[tuple[str, str]] = ()) -> DataFrame:
    """The rows of a table in blocks; ``extra`` are 64-bit columns or binary columns of equal width, carried along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _merged(batches, rows):
            block, order = _pack(batch, dims)
            for name, kind in extra:
                column = batch.column(name)
                block[name] = (column.to_numpy(zero_copy_only=False).astype("<i8") if kind == "long" else matrix(column, "<i8", len(column[0].as_py()) // 8))[order].tobytes()
            yield pa.RecordBatch.from_pylist([block], schema)

    ddl = BLOCK + "".join(f", {name} binary" for name, _ in extra)
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(T._parse_datatype_string(ddl))
    return df.mapInArrow(run, ddl)


def _grid(rows: DataFrame, anchors: DataFrame, g: int, h: int) -> DataFrame:
    """Every row block beside every anchor block, one (g, h) a key."""
    left = rows.withColumn("h", F.pmod(F.xxhash64("ids"), F.lit(h))).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(g - 1))))
    right = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns]).withColumn("g", F.pmod(F.xxhash64("a_key"), F.lit(g)).cast("int"))
    right = right.withColumn("h", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(h - 1).cast("long"))))
    return left.hint("shuffle_merge").join(right, ["g", "h"])


def _tasks(n_rows: int, n_anchors: int, cores: int) -> tuple[int, int]:
    """(groups of anchors, slices of rows): sends as few copies as a grid of so many tasks can."""
    tasks = max(-(-n_rows * n_anchors // TASK_PAIRS), min(SPREAD * cores, -(-n_rows // ROWS)), 1)
    slices = min(max(1, round(math.sqrt(tasks * n_rows / max(n_anchors, 1)))), max(1, -(-n_rows // ROWS)), tasks)
    return max(1, min(-(-tasks // slices), -(-n_anchors // ANCHORS))), slices


def mine(df: DataFrame, anchor_every: int = 50, relabel_every: int | None = 7, labels: int = 10, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the ids divisible by ``anchor_every``; where ``relabel_every`` divides an id, its label becomes
    the next of ``labels``. A negative's score lies between ``low`` and ``high`` percent of the positive's.
    """
    spark = df.sparkSession
    rows = narrow(df, row_id=id_col, label=label_col, vector=vec_col)
    rows = rows.select(F.col("row_id").try_cast("long").alias("row_id"), F.col("label").try_cast("long").alias("label"), "vector")
    rows = rows.where("row_id is not null and label is not null")
    if relabel_every:
        rows = rows.withColumn("label", F.when(F.col("row_id") % relabel_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")))
    table, dims = coded(rows, ["row_id", "label"], "vector", FACTOR, summaries,
                        [T.StructField("means", T.BinaryType()), T.StructField("deviations", T.BinaryType())], "summaries")
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    is_anchor = F.col("row_id") % anchor_every == 0
    counts = table.agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors")).first()
    if not dims or not counts.anchors:
        return spark.createDataFrame([], result)
    g, h = _tasks(counts.n, counts.anchors, spark.sparkContext.defaultParallelism)
    row_blocks = stored(_blocks(table, dims, ROWS), "row-blocks")
    anchors = stored(table.where(is_anchor).withColumn("key", F.monotonically_increasing_id()), "anchors")
    parts = max(1, counts.anchors // (16 * ANCHORS))
    found = _search(_grid(row_blocks, _blocks(anchors.repartition(parts, "key"), dims, ANCHORS, [("key", "long")]).withColumnRenamed("key", "keys").withColumn("key", F.xxhash64("keys")), g, h),
                    dims, 1, positives, None)
    place = F.row_number().over(W.partitionBy("key").orderBy(F.desc("score"), "found_id"))
    found = found.withColumn("place", place).where(F.col("place") <= positives)
    lists = found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "found_id", "score"))).alias("p"))  # ``positives`` entries
    lists = stored(lists, "positives")
    wide = _bands(anchors.join(lists, "key"), positives, low, high, dims)
    blocks = _blocks(wide.repartition(parts, "key"), dims, ANCHORS, [("key", "long"), ("low", "bytes"), ("high", "bytes")])
    got = _search(_grid(row_blocks, blocks.withColumnRenamed("key", "keys").withColumn("key", F.xxhash64("keys")), g, h), dims, positives, negatives, ("a_low", "a_high"))
    rank = F.row_number().over(W.partitionBy("key", "list").orderBy(F.desc("score"), "found_id"))
    got = got.withColumn("rank", rank).where(F.col("rank") <= negatives)
    named = lists.select("key", F.posexplode("p").alias("list", "one")).select("key", "list", F.col("one.found_id").alias("positive_id"), F.col("one.score").alias("positive_score"))
    return got.join(named, ["key", "list"]).join(anchors.select("key", F.col("row_id").alias("anchor_id")), "key").select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _bands(df: DataFrame, positives: int, low: int, high: int, dims: int) -> DataFrame:
    """Adds the lowest and highest allowed score of each positive as binary columns; missing positives get an empty band."""
    columns = [c for c in df.columns if c != "p"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo, hi = [], []
            for p in batch.column("p").to_pylist():
                s = [x["score"] for x in p]
                lo.append(np.array([-(-low * v // 100) for v in s] + [1] * (positives - len(s)), dtype="<i8").tobytes())
                hi.append(np.array([high * v // 100 for v in s] + [0] * (positives - len(s)), dtype="<i8").tobytes())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(lo, pa.binary()), pa.array(hi, pa.binary())], [*columns, "low", "high"])

    schema = T.StructType([*[f for f in df.schema if f.name != "p"], T.StructField("low", T.BinaryType()), T.StructField("high", T.BinaryType())])
    return df.mapInArrow(run, schema)


def _search(pairs: DataFrame, dims: int, lists: int, k: int, bands: tuple[str, str] | None) -> DataFrame:
    """(key of the anchor, list, found_id, score): the best k of each task for each anchor and list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}  # anchor blocks of the group at hand
        group = None

        def out() -> Iterator[pa.RecordBatch]:
            for keys, best, *_ in held.values():
                a, j, r = np.nonzero(best.scores != NONE)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[a]), pa.array(j.astype(np.int32)), pa.array(best.ids[a, j, r]), pa.array(best.scores[a, j, r])],
                                                     ["key", "list", "found_id", "score"])

        for batch in batches:
            row, rows = {c: batch.column(c) for c in batch.schema.names}, {}
            for at in range(batch.num_rows):
                if (now := (row["g"][at].as_py(), row["h"][at].as_py())) != group:  # rows come sorted by (g, h)
                    yield from out()
                    held, group, rows = {}, now, {}
                key = row["a_key"][at].as_py()
                if key not in held:
                    a = _side(row, at, "a_", dims, True)
                    n = len(a.ids)
                    held[key] = (np.frombuffer(row["a_keys"][at].as_buffer(), "<i8").copy(), Best(n, lists, k), a,
                                 *[np.frombuffer(row[c][at].as_buffer(), "<i8").reshape(n, lists).copy() for c in bands or ()])
                _, best, a, *band = held[key]
                ids = row["ids"][at].as_buffer()
                if (b := rows.get(bytes(ids[:64]))) is None or b.ids.nbytes != len(ids) or b.ids.tobytes() != ids.to_pybytes():
                    rows = {bytes(ids[:64]): (b := _side(row, at, "", dims))}
                if bands:
                    add_negatives(best, a, b, *band)
                else:
                    add_positives(best, a, b)
        yield from out()

    return pairs.mapInArrow(run, "key long, list int, found_id long, score long")
