"""Near-duplicate documents by MinHash.

A document is the set of its distinct 5-word shingles (64-bit hashes); documents with equal
sets are collapsed to their smallest id first. Each remaining set gets a one-permutation
sketch: one hash per shingle, its top part picks one of the bins, the bin keeps its minimum,
and an empty bin copies the first filled bin of an order fixed for that bin and shared by all
sets (optimal densification). The sketch is cut into bands; sets with an equal band share a
bucket. Every member of a bucket is paired with its smallest member only (a star), so the
pairs grow with the rows. Pairs of large sets whose sketches are clearly apart are left out, the others
are confirmed on their full sets; the confirmed links give connected components.

Stars alone could miss a link between two members that the centre is not linked with.
So the documents of buckets that hold more than one component after that are looked at again:
a prefix-filtered set join (rarest shingles first, a shorter prefix for the smaller set, with positional
bounds) gives every pair of different components that could meet the limit, and each is confirmed on
its full sets, whatever its sketches say. Copies of one text with many changes, or a
passage that many documents share, thus cost a few rows a document instead of all their
pairs. No bucket is dropped or capped.

With 50 bands of 4 rows a pair at the limit (Jaccard 0.75) shares no band with probability about
6e-9 if bins are independent; bins of small sets are not (many are copies). Simulated at the limit,
6,000 pairs each of unions of 4, 8, 12, 20, 40, 80, 200 and 600 shingles: none missed (so under about
0.05% of such pairs at each size, at 95%). ``floor`` is asked only of sets with as many shingles as bins
or more, where 200 bins that agree with probability 0.75 each agree in under half with about 1e-14.

Defined results: null, empty and blank texts have an empty set and are linked with nothing;
texts of fewer than five words have one shingle, the whole sequence. Repeated rows are returned
each, with the same component. Ids are meant to be unique but for repeated rows: of different
texts under one id any one is compared, and all classes they lead share its component. A row without
an id is never linked, has no component and is kept. An empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm import textbytes as tb
from tillcast.llm.common import map_arrow, narrow, small_enough, stored
from tillcast.llm.graph import stars


@dataclass(frozen=True)
class NearDedup:
    shingle_words: int = 5
    link_pct: int = 75
    bands: int = 50
    rows: int = 4
    floor: float = 0.5       # sketches of large sets that agree on fewer bins are not confirmed
    chunk: int = 64          # members confirmed against one copy of their centre's text

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def shingle_sets(texts: pa.Array, k: int):
    """The sorted distinct shingle hashes of every text."""
    for lo, hi, data, off in tb.slices(texts):
        data = tb.LOWER[data]
        starts, ends, first = tb.word_bounds(data, off, tb.SPACE_WORD)
        words = tb.span_hashes(data, starts, ends)
        grams = tb.gram_hashes(words, k)
        for i in range(hi - lo):
            n = first[i + 1] - first[i]
            if n >= k:
                yield np.unique(grams[first[i]:first[i + 1] - k + 1])
            else:
                yield tb.gram_hashes(words[first[i]:first[i + 1]], int(n)) if n else np.zeros(0, tb.U64)


class Sketcher:
    def __init__(self, p: NearDedup) -> None:
        self.p = p
        self.order = tb.sequence64(37, p.bins * p.bins).reshape(p.bins, p.bins)
        self.band_factor = tb.sequence64(41, p.rows) | tb.U64(1)

    def bins(self, hashes: np.ndarray) -> np.ndarray:
        """The value of every bin; ``hashes`` is sorted and not empty."""
        n = self.p.bins
        which = ((hashes >> tb.U64(32)) * tb.U64(n) >> tb.U64(32)).astype(np.int64)
        at = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
        out = np.zeros(n, dtype=tb.U64)
        filled = which[at]
        out[filled] = hashes[at]
        if len(filled) < n:
            empty = np.ones(n, dtype=bool)
            empty[filled] = False
            empty = np.flatnonzero(empty)
            out[empty] = out[filled[self.order[np.ix_(empty, filled)].argmin(axis=1)]]
        return out

    def band_hashes(self, bins: np.ndarray) -> np.ndarray:
        return tb.mix64((tb.mix64(bins).reshape(self.p.bands, self.p.rows) * self.band_factor).sum(axis=1, dtype=tb.U64))


def _set_key(hashes: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, p: NearDedup, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_id, n_shingles, set_key (null for an empty set), bands (array), sketch (a byte for each bin)."""
    schema = T.StructType([T.StructField("row_id", docs.schema[id_col].dataType), T.StructField("n_shingles", T.LongType()),
                           T.StructField("set_key", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
                           T.StructField("sketch", T.BinaryType())])

    def work(batch: pa.RecordBatch):
        sk = Sketcher(p)
        sizes, keys, bands, low = [], [], [], []
        for hashes in shingle_sets(batch.column("text"), p.shingle_words):
            sizes.append(len(hashes))
            if len(hashes):
                bins = sk.bins(hashes)
                keys.append(_set_key(hashes))
                bands.append(sk.band_hashes(bins).view(np.int64))
                low.append((tb.mix64(bins) & tb.U64(255)).astype(np.uint8).tobytes())
            else:
                keys.append(None)
                bands.append(None)
                low.append(None)
        yield {"row_id": batch.column("row_id"), "n_shingles": sizes, "set_key": keys, "bands": bands, "sketch": low}

    return map_arrow(narrow(docs, row_id=id_col, text=text_col), work, schema)


def _alike(pairs: DataFrame, reps: DataFrame, p: NearDedup) -> DataFrame:
    """Pairs (a, b) whose sizes allow a link and, if both have ``bins`` shingles, whose sketches agree on at least ``floor`` of the bins."""
    one = reps.select(F.col("row_id").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    two = reps.select(F.col("row_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))
    both = (pairs.join(one, "a").join(two, "b")
            .where(100 * F.least("na", "nb") >= p.link_pct * F.greatest("na", "nb")))
    ids = pairs.schema["a"].dataType
    schema = T.StructType([T.StructField("a", ids), T.StructField("b", ids)])

    def work(batch: pa.RecordBatch):
        n = batch.num_rows
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(n, -1) for c in ("sa", "sb"))
        small = batch.column("n").to_numpy() < p.bins  # their bins depend on each other
        keep = pa.array(small | ((x == y).mean(axis=1) >= p.floor))
        yield {c: batch.column(c).filter(keep) for c in ("a", "b")}

    return map_arrow(both.select("a", "b", "sa", "sb", F.least("na", "nb").alias("n")), work, schema)


def confirm(pairs: DataFrame, docs: DataFrame, p: NearDedup) -> DataFrame:
    """The pairs (a, b) that are linked by their full sets. ``docs``: row_id (unique), text.

    A centre's text goes once to every ``chunk`` of its members, so no task holds more than
    one centre's set and one member at a time.
    """
    # at most two texts are wanted for a pair
    few = small_enough(pairs.select("a", F.lit(0).cast("long").alias("part"), F.lit(0).alias("role"), F.explode(F.array("a", "b")).alias("wanted_id")))
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / p.chunk).alias("parts"))
    members = pairs.join(F.broadcast(degree) if few else degree, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), F.lit(1).alias("role"), F.col("b").alias("wanted_id"))
    centres = degree.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("a").alias("wanted_id"))
    wanted = members.unionByName(centres)
    texts = docs.join(F.broadcast(wanted) if few else wanted, F.col("row_id") == F.col("wanted_id"))
    texts = (texts.select("a", "part", "role", F.col("row_id").alias("b"), "text")
             .repartition("a", "part").sortWithinPartitions("a", "part", "role"))
    ids = pairs.schema["a"].dataType
    schema = T.StructType([T.StructField("a", ids), T.StructField("b", ids)])

    def run(batches):
        centre, own = None, np.zeros(0, tb.U64)
        for batch in batches:
            a, part, role, b = (batch.column(c).to_pylist() for c in ("a", "part", "role", "b"))
            linked = []
            for i, hashes in enumerate(shingle_sets(batch.column("text"), p.shingle_words)):
                if role[i] == 0:
                    centre, own = (a[i], part[i]), hashes
                elif centre == (a[i], part[i]):
                    common = len(np.intersect1d(own, hashes, assume_unique=True))
                    if 100 * common >= p.link_pct * (len(own) + len(hashes) - common):
                        linked.append(i)
            if linked:
                yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in linked], batch.column("a").type),
                                                  pa.array([b[i] for i in linked], batch.column("b").type)], names=["a", "b"])

    return texts.mapInArrow(run, schema)


def _named(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows (row_id, ...) with their component so far; unlinked rows are their own."""
    return rows.join(found, F.col("row_id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "row_id")).drop("node")


def _merged(found: DataFrame, new_links: DataFrame) -> DataFrame:
    """(node, component) after further links (a, b): components of the components."""
    ends = new_links.select("a", "b").join(found.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(
        found.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    higher = stars(stored(ends, "edges")).withColumnRenamed("component", "top")
    moved = found.join(higher.select(F.col("node").alias("component"), "top"), "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    fresh = higher.select("node", F.col("top").alias("component")).join(found, "node", "left_anti")
    return stored(moved.unionByName(fresh), "components")


def _unsettled(members: DataFrame, found: DataFrame) -> DataFrame:
    """(key, row_id, component) in the buckets of three or more that hold several components; pairs have been tried."""
    seen = _named(members.select("key", "row_id"), found)
    mixed = (seen.groupBy("key").agg(F.count("*").alias("size"), F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("size > 2 and lo <> hi").select("key"))
    return stored(seen.join(mixed, "key"), "unsettled")


def _prefix_pairs(unsettled: DataFrame, docs: DataFrame, p: NearDedup) -> DataFrame:
    """Every pair of unsettled documents of different components that could still be linked.

    Shingles are ordered by rarity among these documents; two sets that meet the limit share
    a shingle of their necessary prefixes, at places that leave room for the overlap they need.
    """
    ids = unsettled.select("row_id", "component").distinct()
    wanted = ids.select(F.col("row_id").alias("wanted_id"), "component")
    texts = docs.join(F.broadcast(wanted) if small_enough(wanted) else wanted, F.col("row_id") == F.col("wanted_id"))
    schema = T.StructType([T.StructField("row_id", ids.schema["row_id"].dataType), T.StructField("component", ids.schema["row_id"].dataType),
                           T.StructField("shingles", T.ArrayType(T.LongType()))])

    def work(batch: pa.RecordBatch):
        yield {"row_id": batch.column("row_id"), "component": batch.column("component"),
               "shingles": [h.view(np.int64) for h in shingle_sets(batch.column("text"), p.shingle_words)]}

    sets = stored(map_arrow(texts.select("row_id", "component", "text"), work, schema), "sets")
    shingles = sets.select("row_id", F.explode("shingles").alias("shingle"))
    shared = shingles.groupBy("shingle").agg(F.count("*").alias("docs")).where("docs > 1")
    # shingles of one document only come first and match nothing, so their number is enough
    common = shingles.join(shared, "shingle").groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("docs", "shingle"))).alias("common"))
    n = F.size("shingles")
    length = n - F.ceil(n * p.link_pct / 100) + 1
    alone = n - F.size("common")
    prefix = sets.join(common, "row_id").select("row_id", "component", n.alias("n"), alone.alias("alone"), length.alias("length"), "common").where("alone < length").select(
        "row_id", "component", "n", "alone", F.posexplode(F.expr("slice(common, 1, cast(length - alone as int))")).alias("i", "x"))
    prefix = stored(prefix.select("row_id", "component", "n", (F.col("alone") + F.col("i")).alias("pos"), F.col("x.shingle").alias("shingle")), "prefixes")
    mixed = prefix.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("shingle")
    prefix = stored(prefix.join(mixed, "shingle", "left_semi"), "prefixes")
    x, y = prefix.alias("x"), prefix.alias("y")
    # x is the smaller set: it needs only as many of its rarest shingles as a pair of its own size would
    short = F.col("x.n") - F.ceil(2 * p.link_pct * F.col("x.n") / (100 + p.link_pct)) + 1
    smaller = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.row_id") < F.col("y.row_id")))
    need = F.ceil(p.link_pct * (F.col("x.n") + F.col("y.n")) / (100 + p.link_pct))
    room = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    on = ((F.col("x.shingle") == F.col("y.shingle")) & smaller & (F.col("x.pos") < short) & (F.col("x.component") != F.col("y.component")) & (room >= need)
          & (100 * F.col("x.n") >= p.link_pct * F.col("y.n")))
    return x.join(y, on).select(F.least("x.row_id", "y.row_id").alias("a"), F.greatest("x.row_id", "y.row_id").alias("b")).distinct()


def linked_components(reps: DataFrame, docs: DataFrame, p: NearDedup) -> DataFrame:
    """(node, component) of the linked representatives (row_id, n_shingles, bands, sketch) but each component's smallest."""
    rows = reps.select("row_id", F.posexplode("bands").alias("band", "hash")).select(
        F.xxhash64("band", "hash").alias("key"), "row_id")
    centres = rows.groupBy("key").agg(F.min("row_id").alias("centre"), F.max("row_id").alias("other")).where("centre <> other")
    members = stored(rows.join(centres.select("key", "centre"), "key"), "members")
    spokes = members.where("row_id <> centre").select(F.col("centre").alias("a"), F.col("row_id").alias("b")).distinct()
    tried = stored(_alike(spokes, reps, p), "spokes")
    found = stars(stored(confirm(tried, docs, p), "links"))
    unsettled = _unsettled(members, found)
    if not unsettled.isEmpty():
        pairs = _untried(_prefix_pairs(unsettled, docs, p), tried)
        found = _merged(found, stored(confirm(pairs, docs, p), "links"))
    return found


def _untried(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    """Pairs not yet confirmed or refused on their full sets, either way round."""
    both = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return stored(pairs.join(both, ["a", "b"], "left_anti"), "pairs")


def keep_first(docs: DataFrame, p: NearDedup = NearDedup(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of every group, with the columns it came with: that of the smallest id.

    Where ids are missing or shared, rows are told apart by a number of their own, stored with them: of rows
    with one id and different texts each has its own group, rows without an id are grouped like
    all others, and of each group one row of the smallest id stays. Texts without words are no copies of each other and stay.
    """
    ids = docs.groupBy(F.col(id_col).alias("id")).agg(F.count("*").alias("rows"))
    if ids.where("rows > 1 or id is null").isEmpty():
        dropped = _hinted(stored(near_duplicates(docs, p, id_col, text_col).where(~F.col("kept")).select(F.col(id_col).alias("dropped_id")), "dropped"))
        return docs.join(dropped, docs[id_col] == dropped["dropped_id"], "left_anti")
    number = "row_number_of_keep_first"
    numbered = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    judged = near_duplicates(numbered, p, number, text_col).select(F.col(number).alias("number"), "component_id")
    named = judged.join(numbered.select(F.col(number).alias("number"), F.col(id_col).alias("id")), "number")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "number")).alias("first"))
    dropped = _hinted(stored(judged.join(first.select(F.col("first.number").alias("number")), "number", "left_anti").select(F.col("number").alias("dropped_id")), "dropped"))
    return numbered.join(dropped, numbered[number] == dropped["dropped_id"], "left_anti").drop(number)


def _hinted(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if small_enough(df) else df


def near_duplicates(docs: DataFrame, p: NearDedup = NearDedup(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: the id, n_shingles, component_id and kept (the component's smallest id)."""
    made = stored(sketches(docs, p, id_col, text_col), "sketches")
    known = made.where("set_key is not null and row_id is not null")
    classes = known.groupBy("set_key").agg(F.min("row_id").alias("rep"))
    reps = known.join(classes.select(F.col("set_key").alias("rep_key"), "rep"),
                      (F.col("set_key") == F.col("rep_key")) & (F.col("row_id") == F.col("rep")), "left_semi")
    reps = stored(reps.dropDuplicates(["row_id"]).drop("set_key"), "reps")
    texts = narrow(docs, row_id=id_col, text=text_col)
    labels = _named(reps.select("row_id"), linked_components(reps, texts, p))
    classes = classes.join(labels, F.col("rep") == F.col("row_id")).select(F.col("set_key").alias("class_key"), "component")
    out = made.select("row_id", "n_shingles", "set_key").join(classes, F.col("set_key") == F.col("class_key"), "left")
    component = F.when(F.col("row_id").isNotNull(), F.coalesce("component", "row_id"))
    return out.select(F.col("row_id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.col("row_id").eqNullSafe(component).alias("kept"))
