"""Periodic runs of words: the same words again and again, as loops of generated or scraped text leave them.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) of at least
``MIN_WORDS`` words and ``MIN_POWER`` periods that no neighbouring word extends keeping the period. The
runs of a text come from its dictionary of basic factors:

* level k names the factors of 2^k words; a name is shared by equal factors, a factor that occurs once in
  its text has none. Level k + 1 names pairs of names 2^k apart, so a level is one sort, and texts are named
  together (a word's first name includes its text, so that nothing is equal across texts);
* for each named factor the distance to its successor, if at most twice its length. Where a
  factor's distance d is its successor's as well, three occurrences are an arithmetic progression and d is
  proposed as a period. Inside a run of period q the successor of a factor of q to 2q - 1 words is exactly q
  away (a nearer one would give the run a smaller period), so every run is proposed on the level of that length;
* a proposal is extended both ways by descending through the levels, and proposals that end as the same
  stretch are one run, of the smallest period proposed.

Results: ``runs`` array of (start, length, period), word numbers from 0, by start and period; ``collapsed``,
the text's words joined by one space without those that a run holds after its first q words.

Defined cases: a null text has no words; empty and blank texts likewise: no runs, ``collapsed`` is the empty
string. Repeated rows and ties of ids are kept row by row; other columns pass through, an input column named
like an output is replaced; an empty table gives an empty table. Whole texts of any length: memory is
one slice (or one longer text) times the number of levels, at most log2 of its words.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SEPARATORS, map_slices, ship

ship(__name__)

MIN_WORDS, MIN_POWER = 6, 4
WORD = re.compile(f"[^{SEPARATORS}]+")
RUN = "struct<start:bigint,length:bigint,period:bigint>"


# --- runs of a sequence of names ------------------------------------------------------------

def _named(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Names (0, 1, ...) of the positions ``at`` by their ``values``; -1 elsewhere and for a value met once."""
    names = np.full(n, -1, dtype=np.int32)
    _, which, counts = np.unique(values, return_inverse=True, return_counts=True)
    names[at] = np.where(counts[which] > 1, which, -1)
    return names


def basic_factors(words: np.ndarray) -> list[np.ndarray]:
    """Level k: the names of the factors of 2^k words by position, as long as any occurs twice."""
    n, size = len(words), 1
    names = _named(words, np.arange(n), n)
    levels = []
    while (names >= 0).any():
        levels.append(names)
        at = np.flatnonzero(names[:max(0, n - size)] >= 0)
        at = at[names[at + size] >= 0]
        names = _named(names[at].astype(np.int64) * (n + 1) + names[at + size], at, n)
        size *= 2
    return levels


def proposals(names: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first position, period) of the progressions that successors at most 2 * size away form."""
    live = np.flatnonzero(names >= 0)
    order = live[np.argsort(names[live], kind="stable")]
    gap = np.diff(order)
    near = (names[order[1:]] == names[order[:-1]]) & (gap <= 2 * size)
    step = np.zeros(len(names), dtype=np.int64)
    step[order[:-1][near]] = gap[near]
    at = np.flatnonzero(step)
    at = at[step[at + step[at]] == step[at]]
    first = np.ones(len(at), dtype=bool)
    first[1:] = (np.diff(at) > 1) | (np.diff(step[at]) != 0)
    return at[first], step[at[first]]


def _reach(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
    """How many words agree from ``a`` and ``b`` on (``back``: up to and including them, leftwards)."""
    n = len(levels[0])
    done = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        size = 1 << k
        x, y = (a - done - size + 1, b - done - size + 1) if back else (a + done, b + done)
        inside = (x >= 0) & (y >= 0) & (x < n) & (y < n)
        p, q = levels[k][np.where(inside, x, 0)], levels[k][np.where(inside, y, 0)]
        done += np.where(inside & (p >= 0) & (p == q), size, 0)
    return done


def find_runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of ``words`` (integers, equal where words are), by start and period."""
    none = np.zeros(0, dtype=np.int64)
    levels = basic_factors(words)
    if not levels:
        return none, none, none
    found = [proposals(names, 1 << k) for k, names in enumerate(levels)]
    at, period = (np.concatenate(x) for x in zip(*found, strict=True))
    left = _reach(levels, at - 1, at + period - 1, back=True)
    start, length = at - left, left + _reach(levels, at, at + period, back=False) + period
    long = length >= np.maximum(MIN_WORDS, MIN_POWER * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))  # of one stretch the smallest period comes first
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


# --- the operator ---------------------------------------------------------------------------

def runs_of_texts(texts: list) -> tuple[list[np.ndarray], list[str]]:
    """Per text its runs (rows of start, length, period) and its collapsed words."""
    words = [WORD.findall(t) if t else [] for t in texts]
    flat = [w for ws in words for w in ws]
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    text_of = np.repeat(np.arange(len(texts)), np.diff(bounds))
    names = pa.array(flat, type=pa.large_string()).dictionary_encode()
    ids = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    start, length, period = find_runs(text_of * (len(names.dictionary) + 1) + ids)
    edge = np.zeros(len(flat) + 1, dtype=np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    kept = np.cumsum(edge[:-1]) == 0
    cut = np.searchsorted(start, bounds)
    runs, collapsed = [], []
    for i, ws in enumerate(words):
        lo, hi = cut[i], cut[i + 1]
        runs.append(np.stack([start[lo:hi] - bounds[i], length[lo:hi], period[lo:hi]], axis=1))
        keep = kept[bounds[i]:bounds[i + 1]]
        collapsed.append(" ".join(ws if hi == lo else [w for w, k in zip(ws, keep.tolist(), strict=True) if k]))
    return runs, collapsed


def periodic_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus ``runs`` and ``collapsed`` of the whole text."""
    keep = [f for f in df.schema.fields if f.name not in ("runs", "collapsed")]
    names = [f.name for f in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + [f"runs array<{RUN}>", "collapsed string"])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        runs, collapsed = runs_of_texts(batch.column(batch.schema.get_field_index(text)).to_pylist())
        flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
        fields = pa.StructArray.from_arrays([pa.array(flat[:, k], type=pa.int64()) for k in range(3)], ["start", "length", "period"])
        ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends), fields), pa.array(collapsed, type=pa.string())],
                                          [*names, "runs", "collapsed"])

    passed = df.select(*(F.col(f"`{n}`") for n in dict.fromkeys([*names, text])))
    return map_slices(passed, work, schema, text)


# --- the query of the contract ----------------------------------------------------------------

def _number(x: Column) -> Column:
    return x.cast("bigint")


def looped_words(doc_id: Column, words: Column) -> Column:
    """The contract's input: where h % 10 is 0 the words from a on are a loop of p original words.

    ``words`` is to be a column that is already there: the function reads it once per word."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = _number(F.floor(h / 10))
    n = _number(F.size(words))
    a = g % n
    p = 1 + _number(F.floor((n - a) / (3 + g % 8)))
    looped = F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.element_at(words, (a + (i - a) % p + 1).cast("int"))))
    return F.when((h % 10 == 0) & (n > 0), looped).otherwise(words)


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, compared without rounding (ties: smallest start, then period)."""
    def better(best, run):
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)
    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def run_digests(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_runs, the strongest run, digests of the runs and of the collapsed text (contract of op12)."""
    words = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(f"([^{SEPARATORS}]+)"), F.lit(1))
    planted = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    split = docs.select("doc_id", "text", F.when(planted, words).alias("_words"))
    looped = F.array_join(looped_words(F.col("doc_id"), F.col("_words")), " ")
    read = split.select("doc_id", F.when(F.col("_words").isNotNull(), looped).otherwise(F.col("text")).alias("text"))
    found = periodic_runs(read).withColumn("_best", strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.select(
        "doc_id", _number(F.size("runs")).alias("n_runs"), F.col("_best.start").alias("start"), F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"),
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
