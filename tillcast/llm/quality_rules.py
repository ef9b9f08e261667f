"""Quality rules with host-level verdicts.

Method: every document is measured by a few rules; rule failures are counted by host
(``source``); the failure rate of each host and rule is shrunk towards the rate of all hosts
with an empirical beta prior (method of moments over hosts); a host whose shrunk rate of a
rule is above ``host_factor`` times the prior's mean, or above ``host_limit``, gets a verdict for
that rule, which is joined back: in such a host a document that fails the rule is dropped, in a
host that fails it no more often than others a failed soft rule alone is tolerated. The base rules (too short, too repetitive) drop a document in any host.

Words are runs of bytes other than space and \\t \\n \\v \\f \\r. Texts are measured whole.

Defined results: null and empty text: all measures 0, which fails the rule of the shortest
length. A null host is a host of its own. Repeated rows are measured and returned each.
An empty table gives an empty result. Further columns are not read.
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

SYMBOLS = tb.byte_class(b"#*$%&|<>")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    repeat_pct: int = 50      # most words in repeated 3-word windows, in percent
    symbol_pct: int = 30      # most symbols for 100 words
    dup_line_pct: int = 30    # most repeated lines, in percent of the lines with a word
    host_factor: float = 1.1  # times the mean rate: a shrunk failure rate above that gets a verdict ...
    host_limit: float = 0.5   # ... and so does one above this, whatever the mean
    most_weight: float = 1e4  # most documents that the prior may weigh
    salts: int = 16

    def failures(self) -> dict[str, F.Column]:
        """Soft rules: true where a document fails."""
        c = F.col
        return {
            "fail_symbols": 100 * c("n_symbols") > self.symbol_pct * c("n_words"),
            "fail_dup_lines": 100 * c("n_dup_lines") > self.dup_line_pct * c("n_lines"),
            "fail_word_length": (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 20 * c("n_words")),
        }

    def base(self) -> F.Column:
        return (F.col("n_words") < self.min_words) | (100 * F.col("n_repeat_words") > self.repeat_pct * F.col("n_words"))


def _later_copies(keys: np.ndarray) -> int:
    """Members equal to an earlier one."""
    return len(keys) - len(np.unique(keys))


def _repeat_words(words: np.ndarray) -> int:
    """Words that stand in a 3-word window found twice or more."""
    if len(words) < 4:
        return 0
    grams = tb.gram_hashes(words, 3)
    order = np.sort(grams)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return 0
    at = np.minimum(np.searchsorted(twice, grams), len(twice) - 1)
    hit = twice[at] == grams
    covered = np.zeros(len(words), dtype=bool)
    for j in range(3):
        covered[j:len(grams) + j] |= hit
    return int(covered.sum())


def measure_batch(texts: pa.Array) -> dict[str, np.ndarray]:
    out = {m: np.zeros(len(texts), dtype=np.int64) for m in MEASURES}
    for lo, hi, data, off in tb.slices(texts):
        starts, ends, first = tb.word_bounds(data, off, tb.SPACE_WORD)
        words = tb.span_hashes(data, starts, ends)
        inside = tb.SPACE_WORD[data]
        out["n_words"][lo:hi] = np.diff(first)
        out["word_chars"][lo:hi] = tb.row_sums(inside & ~tb.CONTINUATION[data], off)
        out["n_symbols"][lo:hi] = tb.row_sums(SYMBOLS[data], off)
        line_starts, line_ends, line_first = tb.word_bounds(data, off, _NOT_NEWLINE)
        total = np.r_[0, np.cumsum(inside)]
        with_word = total[line_ends] > total[line_starts]
        line_row = np.repeat(np.arange(hi - lo), np.diff(line_first))[with_word]
        lines = tb.span_hashes(data, line_starts, line_ends)[with_word]
        line_at = np.searchsorted(line_row, np.arange(hi - lo + 1))
        out["n_lines"][lo:hi] = np.diff(line_at)
        for i in range(hi - lo):
            if line_at[i + 1] - line_at[i] > 1:
                out["n_dup_lines"][lo + i] = _later_copies(lines[line_at[i]:line_at[i + 1]])
            out["n_repeat_words"][lo + i] = _repeat_words(words[first[i]:first[i + 1]])
    return out


_NOT_NEWLINE = ~tb.byte_class([0x0A])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """row_id, host and the measures of every document."""
    schema = T.StructType([T.StructField("row_id", docs.schema[id_col].dataType), T.StructField("host", docs.schema[host_col].dataType)]
                          + [T.StructField(m, T.LongType()) for m in MEASURES])

    def work(batch: pa.RecordBatch):
        yield {"row_id": batch.column("row_id"), "host": batch.column("host")} | measure_batch(batch.column("text"))

    return map_arrow(narrow(docs, row_id=id_col, host=host_col, text=text_col), work, schema)


def host_rates(measured: DataFrame, rules: QualityRules) -> DataFrame:
    """Per host: documents and, for each soft rule, the shrunk failure rate ``rate_<rule>`` and the rate above which
    a host gets a verdict, ``limit_<rule>``."""
    fails = rules.failures()
    hosts = measured.groupBy("host").agg(F.count("*").alias("docs"), *[F.count_if(e).alias(k) for k, e in fails.items()])
    prior = hosts.agg(*[x for k in fails for x in (F.avg(F.col(k) / F.col("docs")).alias(f"m_{k}"),
                                                  F.var_pop(F.col(k) / F.col("docs")).alias(f"v_{k}"))]).first()
    out = hosts
    for k in fails:
        mean, var = prior[f"m_{k}"] or 0.0, prior[f"v_{k}"] or 0.0
        weight = min(max(mean * (1 - mean) / var - 1, 1.0), rules.most_weight) if var > 0 else rules.most_weight
        out = out.withColumns({f"rate_{k}": (F.col(k) + F.lit(mean * weight)) / (F.col("docs") + F.lit(weight)), f"limit_{k}": F.lit(min(rules.host_limit, rules.host_factor * mean))})
    return out


def judge(docs: DataFrame, rules: QualityRules = QualityRules(), id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source") -> DataFrame:
    """One row per document: the id, the measures, base_failed, host_failed and kept."""
    measured = stored(measure(docs, id_col, text_col, host_col), "quality")
    rates = host_rates(measured, rules)
    verdicts = rates.select(F.col("host").alias("verdict_host"),
                            *[(F.col(f"rate_{k}") > F.col(f"limit_{k}")).alias(f"host_{k}") for k in rules.failures()])
    verdicts = verdicts.where(" or ".join(f"host_{k}" for k in rules.failures()))
    if small_enough(verdicts):
        joined = measured.join(F.broadcast(verdicts), F.col("host").eqNullSafe(F.col("verdict_host")), "left")
    else:  # many hosts: a host's documents are spread over ``salts`` keys
        spread = verdicts.withColumn("verdict_salt", F.explode(F.sequence(F.lit(0), F.lit(rules.salts - 1))))
        joined = measured.withColumn("salt", F.pmod(F.xxhash64("row_id", "word_chars"), F.lit(rules.salts)).cast("int")).join(
            spread, F.col("host").eqNullSafe(F.col("verdict_host")) & (F.col("salt") == F.col("verdict_salt")), "left")
    host_failed = F.lit(False)
    for k, e in rules.failures().items():
        host_failed = host_failed | (F.coalesce(F.col(f"host_{k}"), F.lit(False)) & e)
    return joined.select(F.col("row_id").alias(id_col), *MEASURES, rules.base().alias("base_failed"), host_failed.alias("host_failed"),
                         (~rules.base() & ~host_failed).alias("kept"))


def keep_good(docs: DataFrame, rules: QualityRules = QualityRules(), id_col: str = "doc_id", text_col: str = "text",
              host_col: str = "source") -> DataFrame:
    """The documents that the rules keep, with the columns they came with.

    A verdict depends on a document's text and host alone and is joined back on them, so rows that share an
    id, or have none, get each their own.
    """
    key = "content_key_of_keep_good"
    docs = docs.withColumn(key, content_key(text_col, host_col))
    judged = judge(docs, rules, key, text_col, host_col)
    dropped = stored(judged.where("not kept").select(F.col(key).alias("dropped_key")).distinct(), "dropped")
    dropped = F.broadcast(dropped) if small_enough(dropped) else dropped
    return docs.join(dropped, docs[key] == dropped["dropped_key"], "left_anti").drop(key)
