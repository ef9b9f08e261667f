"""Benchmark decontamination by a prefix-filtered set join with exact windows.

A window is a run of ``window`` words of an item (all its words if it has fewer); a document
is hit where one of the windows occurs. A window must be contained whole, so of its shingles
(3 words; fewer in shorter windows) the necessary prefix is one, and the rarest one in the
corpus is chosen: shingles are ordered by their document counts over all documents. The
prefix shingles are joined with the documents' shingles; a candidate must leave room for the
window before and behind it (length and positional bounds) and is then verified word by word
over the whole window.

Both passes over the documents emit only shingles that pass a bit table of the benchmark's
shingles. The table has a fixed size; a benchmark that fills it lets more shingles through to
the join, it never loses one. The shingle tables themselves are joined (broadcast only if
their counted size allows it).

Words: A-Z lower-cased, runs of letters a-z, digits and non-ASCII characters; each is
represented by a 64-bit hash.

Defined results: null, empty or wordless texts have no words, no hits and are not
contaminated; such items have no window. Repeated documents are judged each, repeated items
(same id) count once. No items: nothing is hit. No documents: an empty result. Further columns
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm import textbytes as tb
from tillcast.llm.common import content_key, map_arrow, narrow, small_enough, stored


@dataclass(frozen=True)
class Decontamination:
    window: int = 13
    shingle: int = 3
    table_bits: int = 23      # log2 of the bits of the table that screens shingles (1 MB)
    least_share: int = 20     # contaminated if least_share * hit words >= words


def _words(texts: pa.Array):
    """Per slice: word hashes and the place of each row's first word."""
    for lo, hi, data, off in tb.slices(texts):
        data = tb.LOWER[data]
        starts, ends, first = tb.word_bounds(data, off, tb.ALNUM_WORD)
        yield lo, hi, tb.span_hashes(data, starts, ends), first


def item_windows(items: DataFrame, p: Decontamination, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item, words (array of hashes) of every distinct window of every item."""
    schema = T.StructType([T.StructField("item", items.schema[id_col].dataType), T.StructField("words", T.ArrayType(T.LongType()))])

    def work(batch: pa.RecordBatch):
        ids, out = batch.column("item").to_pylist(), {"item": [], "words": []}
        for lo, hi, words, first in _words(batch.column("text")):
            signed = words.view(np.int64)
            for i in range(hi - lo):
                own = signed[first[i]:first[i + 1]]
                for j in range(max(1, len(own) - p.window + 1) if len(own) else 0):
                    out["item"].append(ids[lo + i])
                    out["words"].append(own[j:j + p.window])
        yield out

    return map_arrow(narrow(items, item=id_col, text=text_col), work, schema).distinct()


def window_shingles(windows: DataFrame, p: Decontamination) -> DataFrame:
    """words, at, shingle of every distinct window and every place in it."""
    schema = T.StructType([T.StructField("words", T.ArrayType(T.LongType())), T.StructField("at", T.IntegerType()), T.StructField("shingle", T.LongType())])

    def work(batch: pa.RecordBatch):
        out = {"words": [], "at": [], "shingle": []}
        for words in batch.column("words").to_pylist():
            grams = tb.gram_hashes(np.array(words, dtype=np.int64).view(tb.U64), min(p.shingle, len(words))).view(np.int64)
            out["words"] += [words] * len(grams)
            out["at"] += range(len(grams))
            out["shingle"] += grams.tolist()
        yield out

    return map_arrow(windows.select("words").distinct(), work, schema)


def bit_table(shingles: DataFrame, bits: int) -> bytes:
    """A table of 2**bits bits with those of the ``shingle`` column set; at most 2**bits / 8 bytes reach the driver."""
    place = F.col("shingle").bitwiseAND((1 << bits) - 1)
    rows = shingles.select(F.shiftright(place, 6).alias("cell"), F.expr("shiftleft(1L, cast(shingle & 63 as int))").alias("bit"))
    cells = rows.groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros((1 << bits) // 64, dtype=np.int64)
    for cell, value in cells.toLocalIterator():
        out[cell] = value
    return out.tobytes()


def _screened(grams: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    place = grams & tb.U64((1 << bits) - 1)
    return (table[(place >> tb.U64(6)).astype(np.int64)] >> (place & tb.U64(63))) & tb.U64(1) > 0


def shingle_counts(docs: DataFrame, table: bytes, sizes: list[int], p: Decontamination) -> DataFrame:
    """shingle, docs: in how many documents each screened shingle stands."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    schema = T.StructType([T.StructField("shingle", T.LongType()), T.StructField("docs", T.LongType())])

    def work(batch: pa.RecordBatch):
        cells = np.frombuffer(shared.value, dtype=tb.U64)
        found = []
        for lo, hi, words, first in _words(batch.column("text")):
            row = np.repeat(np.arange(hi - lo), np.diff(first))
            for k in sizes:
                grams = tb.gram_hashes(words, k)
                at = np.flatnonzero(_screened(grams, cells, p.table_bits))
                at = at[row[at] == row[at + k - 1]]
                if len(at):
                    pairs = np.unique(np.stack([row[at].astype(tb.U64), grams[at]]), axis=1)
                    found.append(pairs[1])
        if found:
            shingles, n = np.unique(np.concatenate(found), return_counts=True)
            yield {"shingle": shingles.view(np.int64), "docs": n}

    return map_arrow(narrow(docs, text="text"), work, schema).groupBy("shingle").agg(F.sum("docs").alias("docs"))


def candidates(docs: DataFrame, table: bytes, sizes: list[int], p: Decontamination) -> DataFrame:
    """row_id, n_words and, where a screened shingle stands: shingle, position, the words around it."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    found = T.StructType([T.StructField("shingle", T.LongType()), T.StructField("pos", T.IntegerType()),
                          T.StructField("first", T.IntegerType()), T.StructField("around", T.ArrayType(T.LongType()))])
    schema = T.StructType([T.StructField("row_id", docs.schema["row_id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("found", T.ArrayType(found))])

    def work(batch: pa.RecordBatch):
        cells = np.frombuffer(shared.value, dtype=tb.U64)
        for lo, hi, words, first in _words(batch.column("text")):
            row = np.repeat(np.arange(hi - lo), np.diff(first))
            at, shingles, ends = [], [], []
            for k in sizes:
                grams = tb.gram_hashes(words, k)
                j = np.flatnonzero(_screened(grams, cells, p.table_bits))
                j = j[row[j] == row[j + k - 1]]
                at.append(j)
                shingles.append(grams[j].view(np.int64))
                ends.append(j + k)
            at, shingles, ends = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (at, shingles, ends))
            order = np.argsort(at, kind="stable")
            at, shingles, ends = at[order], shingles[order], ends[order]
            start = first[row[at]] if len(at) else at
            a, b = np.maximum(start, ends - p.window), np.minimum(first[row[at] + 1] if len(at) else at, at + p.window)
            size = b - a
            cut = np.r_[0, np.cumsum(size)]
            around = words.view(np.int64)[np.arange(cut[-1]) + np.repeat(a - cut[:-1], size)]
            hits = pa.StructArray.from_arrays([pa.array(shingles), pa.array((at - start).astype(np.int32)), pa.array((a - start).astype(np.int32)),
                                               pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(around))], names=found.names)
            per_row = np.searchsorted(at, first) if len(at) else np.zeros(hi - lo + 1, np.int64)
            yield {"row_id": batch.column("row_id").slice(lo, hi - lo), "n_words": np.diff(first), "found": pa.ListArray.from_arrays(pa.array(per_row.astype(np.int32)), hits)}

    return map_arrow(docs.select("row_id", "text"), work, schema)


def contamination(docs: DataFrame, items: DataFrame, p: Decontamination = Decontamination(), id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: the id, n_words, n_hit, item_ids (sorted strings), contaminated."""
    texts = narrow(docs, row_id=id_col, text=text_col)
    windows = stored(item_windows(items, p, item_col, item_text_col), "windows")
    places = stored(window_shingles(windows, p), "places")
    sizes = [r[0] for r in places.select(F.least(F.size("words"), F.lit(p.shingle)).alias("k")).distinct().collect()]  # at most p.shingle values
    counts = shingle_counts(texts, bit_table(places, p.table_bits), sizes, p)
    counts = stored(counts.join(F.broadcast(places.select("shingle").distinct()) if small_enough(places) else places.select("shingle").distinct(),
                                "shingle", "left_semi"), "counts")
    # the necessary prefix: the rarest shingle; windows with a shingle that no document has can't occur
    ranked = places.join(counts, "shingle").groupBy("words").agg(
        F.count_distinct("at").alias("known"), F.min_by(F.struct("shingle", "at"), F.struct("docs", "shingle", "at")).alias("prefix"))
    prefix = ranked.where(F.col("known") == F.size("words") - F.least(F.size("words"), F.lit(p.shingle)) + 1)
    prefix = stored(prefix.select("prefix.shingle", "prefix.at", "words", F.monotonically_increasing_id().alias("window")), "prefixes")
    owners = stored(windows.join(prefix.select("words", "window"), "words").select("window", F.col("item").cast("string").alias("item")), "owners")

    made = stored(candidates(texts, bit_table(prefix, p.table_bits), sizes, p).withColumn("line", F.monotonically_increasing_id()), "candidates")
    around = made.where(F.size("found") > 0).select("line", F.inline("found"))
    around = around.where(F.size("around") > 0)
    joined = around.join(F.broadcast(prefix) if small_enough(prefix, most=1 << 23) else prefix, "shingle")
    start = F.col("pos") - F.col("at")
    inside = (start >= F.col("first")) & (start - F.col("first") + F.size("words") <= F.size("around"))
    exact = F.when(inside, F.slice("around", F.when(inside, start - F.col("first") + 1).otherwise(1), F.size("words")) == F.col("words"))
    hits = stored(joined.where(exact).select("line", start.alias("start"), (start + F.size("words")).alias("end"), "window"), "hits")
    spans = hits.groupBy("line").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    # no row holds the items of a window: a window found often, or shared by many items, is rows here, distinct before they are gathered
    owners = F.broadcast(owners) if small_enough(owners, most=1 << 23) else owners
    found = hits.select("line", "window").distinct().join(owners, "window").where("item is not null").select("line", "item").distinct()
    found = found.groupBy("line").agg(F.array_sort(F.collect_list("item")).alias("item_ids"))
    # words covered by the union of the sorted spans
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    n_hit = F.aggregate("spans", zero, lambda acc, x: F.struct(
        (acc["n"] + F.greatest(x["end"] - F.greatest(x["start"], acc["reach"]), F.lit(0))).alias("n"),
        F.greatest(acc["reach"], x["end"]).alias("reach")))["n"]
    by_line = spans.join(found, "line", "left").select(F.col("line").alias("hit_line"), n_hit.cast("long").alias("n_hit"), "item_ids")
    out = made.select("line", "row_id", "n_words").join(by_line, F.col("line") == F.col("hit_line"), "left")
    n = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(F.col("row_id").alias(id_col), "n_words", n.alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                      ((n > 0) & (p.least_share * n >= F.col("n_words"))).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, p: Decontamination = Decontamination(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with the columns they came with. A verdict depends on the text
    alone and is joined back on it, so rows that share an id, or have none, get each their own."""
    key = "content_key_of_keep_clean"
    docs = docs.withColumn(key, content_key(text_col))
    bad = stored(contamination(docs, items, p, key, text_col).where("contaminated").select(F.col(key).alias("bad_key")).distinct(), "contaminated")
    bad = F.broadcast(bad) if small_enough(bad) else bad
    return docs.join(bad, docs[key] == bad["bad_key"], "left_anti").drop(key)
