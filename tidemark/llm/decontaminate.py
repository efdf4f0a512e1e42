"""Benchmark decontamination by spaced seeds.

Words are runs of non-separators, lower-cased and stripped of punctuation at their borders; in scripts
written without blanks every character is a word. A spaced
seed is a fixed mask over ``SPAN`` consecutive words: positions with 1 must agree, positions
with 0 are ignored, so a substituted word does not hide a passage. For every benchmark text
and every document all positions of all masks are hashed; equal hashes of a test and a training
position give a diagonal (document position minus benchmark position). Around each diagonal
the aligned words are compared: a document is contaminated if some aligned stretch of
``LEAST`` words (or the whole benchmark text, if shorter) agrees in at least ``PERCENT`` percent
of its words.

The benchmark is read in blocks of at most ``BLOCK_WORDS`` words, each a table of proven size
that the tasks hold (a stated query set against all rows, in blocks); the documents are read once
per block, whole, and only verified hits leave a task. A passage that a third of all documents carry
costs each of them one row.

Defined cases: null and empty texts on either side match nothing; benchmark texts under ``SPAN``
words match as whole texts in ``PERCENT`` percent of their words. Under ``SHORTEST`` words no substitution is left: such a
text matches where it is a whole line of a document, word for word but for words of punctuation alone (inside a sentence, "yes" or "the answer is"
tells nothing). Copies of a benchmark text each give their rows, as do repeated documents; null item ids are items
without a name (their rows have a null ``item_id``); of equally good places of an item the first is told. Extra columns are ignored by
``contaminated`` and passed through by ``clean``; an empty benchmark flags nothing, an empty table gives no row.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Shared, map_slices, ship

ship(__name__)

SPAN = 10
#: Fixed masks of weight 6: their zeros are a covering design, every two of SPAN places are zeros of one mask.
#: So any two substitutions in a stretch of SPAN words and more leave a seed at each offset.
MASKS = ("1111000110", "1110111000", "1101011001", "1011110001", "1000101111",
         "0111101001", "0110010111", "0101110110", "0011011110")
#: For whole texts of SHORTEST words to under SPAN, at their beginning: any one substitution leaves a seed.
SHORT_MASKS = ("11111000", "11100111", "00011111")
LEAST = 13
SHORTEST = 8
PERCENT = 80
BLOCK_WORDS = 1 << 20
STRIP = ".,;:!?\"'()[]{}<>*#$%&|-_、。，．！？：；「」『』（）"
#: Scripts written without blanks (Thai, Lao, Myanmar, Khmer, kana, Han): a word is cut before and after each such character.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93,
                0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], dtype=np.uint64)


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    if not text.isascii() and UNSPACED.search(text):
        text = UNSPACED.sub(r" \g<0> ", text)
    return [w.strip(STRIP) or w for w in text.lower().split()]


def spoken(words: list[str]) -> tuple[str, ...]:
    """The words that are more than punctuation."""
    return tuple(w for w in words if w.strip(STRIP))


def seed_hashes(ids: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of a mask over word numbers; 0 is a foreign word, which agrees with none."""
    n = len(ids) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    acc = np.zeros(n, dtype=np.uint64)
    ok = np.ones(n, dtype=bool)
    for k, m in enumerate(mask):
        if m == "1":
            part = ids[k:k + n]
            ok &= part > 0
            acc += part.astype(np.uint64) * ODD[k]
    at = np.flatnonzero(ok)
    h = acc[at]
    return at, (h ^ (h >> np.uint64(31))) * ODD[0]


class Benchmark:
    """One block of the benchmark: word numbers, texts end to end, and the sorted seed hashes of each mask."""

    def __init__(self, items: list[tuple[int | None, str]]):
        lists = [(i, words_of(t)) for i, t in items]
        #: Texts too short for any seed, by their words: a mask without zeros over all of them.
        self.lines: dict[tuple[str, ...], list[int | None]] = {}
        for i, ws in lists:
            if len(ws) < SHORTEST and spoken(ws):
                self.lines.setdefault(spoken(ws), []).append(i)
        lists = [(i, w) for i, w in lists if len(w) >= SHORTEST]
        self.number: dict[str, int] = {}
        for _, ws in lists:
            for w in ws:
                self.number.setdefault(w, len(self.number) + 1)
        self.item = [i for i, _ in lists]
        self.size = np.array([len(w) for _, w in lists], dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)
        self.words = np.array([self.number[w] for _, ws in lists for w in ws], dtype=np.int64)
        owner = np.repeat(np.arange(len(lists)), self.size)
        self.seeds = []
        for mask in (*MASKS, *SHORT_MASKS):
            at, h = seed_hashes(self.words, mask) if len(self.words) else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
            inside = owner[at] == owner[at + len(mask) - 1] if len(at) else np.zeros(0, bool)
            if len(mask) == SHORTEST and len(at):  # texts too short for the masks
                inside &= (self.size[owner[at]] < SPAN) & (at == self.begin[owner[at]])
            at, h = at[inside], h[inside]
            order = np.argsort(h, kind="stable")
            self.seeds.append((mask, h[order], at[order]))

    def hits(self, ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Distinct (text, item index, diagonal) of all seed hits of texts laid end to end from ``begin`` on."""
        found = [np.zeros((3, 0), dtype=np.int64)]
        for mask, hashes, places in self.seeds:
            if not len(hashes):
                continue
            at, h = seed_hashes(ids, mask)
            lo = np.searchsorted(hashes, h, side="left")
            some = lo < len(hashes)
            some[some] = hashes[lo[some]] == h[some]
            at, h, lo = at[some], h[some], lo[some]
            hi = np.searchsorted(hashes, h, side="right")
            many = hi - lo
            if not len(many):
                continue
            place = places[np.repeat(lo - np.cumsum(many) + many, many) + np.arange(int(many.sum()))]
            item = np.searchsorted(self.begin, place, side="right") - 1
            at = np.repeat(at, many)
            found.append(np.stack([np.searchsorted(begin, at, side="right") - 1, item, at - (place - self.begin[item])]))
        return np.unique(np.concatenate(found, axis=1), axis=1)

    def verify(self, ids: np.ndarray, lo: int, hi: int, item: int, shift: int):
        """Best aligned stretch of an item with the document's words ids[lo:hi]: (start, words, equal) or None."""
        size = int(self.size[item])
        a = max(lo - shift, 0)
        b = min(hi - shift, size)
        need = min(LEAST, size)
        if b - a < need:
            return None
        base = int(self.begin[item])
        same = (self.words[base + a:base + b] == ids[shift + a:shift + b]).astype(np.int64)
        total = np.concatenate([[0], np.cumsum(same)])
        run = total[need:] - total[:-need]
        good = np.flatnonzero(100 * run >= PERCENT * need)
        if not len(good):
            return None
        first, last = int(good[0]), int(good[-1]) + need  # the stretch from the first to the last good window
        return shift + a + first - lo, last - first, int(total[last] - total[first])


    def whole_lines(self, text: str | None) -> list[tuple[int | None, int, int]]:
        """(item, start, words) of the lines that are a short benchmark text, the first of each."""
        if not text or not self.lines:
            return []
        found: dict[tuple[str, ...], int] = {}
        at = 0
        for line in text.split("\n"):
            ws = words_of(line)
            key = spoken(ws)
            if key in self.lines:
                found.setdefault(key, at)
            at += len(ws)
        return [(item, at, len(ws)) for ws, at in found.items() for item in self.lines[ws]]

    def found_in(self, texts: list[str | None]) -> list[tuple[int, int | None, int, int, int]]:
        """(text, item, start, words, equal words): the best stretch of each item in each of the texts."""
        get = self.number.get
        rows, begins, out = [], [], []
        for k, t in enumerate(texts):
            begins.append(len(rows))
            rows += [get(w, 0) for w in words_of(t)]
            rows += [0] * SPAN  # no seed runs from one text into the next
            out += [(k, item, start, n, n) for item, start, n in self.whole_lines(t)]
        begins.append(len(rows))
        flat, begin = np.array(rows, dtype=np.int64), np.array(begins, dtype=np.int64)
        best: dict[tuple[int, int], tuple] = {}
        for k, item, shift in self.hits(flat, begin).T.tolist():
            found = self.verify(flat, int(begin[k]), int(begin[k + 1]) - SPAN, item, shift)
            if found and (best.get((k, item)) or (0, 0, -1))[2] < found[2]:
                best[k, item] = found
        out += [(k, self.item[item], *found) for (k, item), found in sorted(best.items())]
        return sorted(out, key=lambda x: x[0])


FOUND = "doc_id bigint, item_id bigint, start bigint, n_words bigint, n_equal bigint"


def _against(docs: DataFrame, block: Benchmark) -> DataFrame:
    shared = Shared(docs.sparkSession, block, "benchmark")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        ids = batch.column(0).to_pylist()
        out = [(ids[k], *found) for k, *found in shared.get().found_in(batch.column(1).to_pylist())]
        if not out:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], [c.split(" ")[0] for c in FOUND.split(", ")])

    return map_slices(docs.select("doc_id", "text"), work, FOUND, "text")


def blocks_of(benchmark: DataFrame, most_words: int = BLOCK_WORDS):
    """The benchmark in blocks of at most about ``most_words`` words, one after the other on the driver."""
    rows, size = [], 0
    frame = benchmark.where("text is not null").select("item_id", "text")
    for r in frame.toLocalIterator(prefetchPartitions=False):
        n = len(words_of(r["text"]))
        if rows and size + n > most_words:
            yield rows
            rows, size = [], 0
        rows.append((r["item_id"], r["text"]))
        size += n
    if rows:
        yield rows


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document and benchmark item: (doc_id, item_id, start, n_words, n_equal)."""
    out = None
    for rows in blocks_of(benchmark):
        part = _against(docs, Benchmark(rows))
        out = part if out is None else out.unionAll(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], FOUND)


def _without(docs: DataFrame, block: Benchmark) -> DataFrame:
    shared = Shared(docs.sparkSession, block, "benchmark")
    at = docs.columns.index("text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bad = {k for k, *_ in shared.get().found_in(batch.column(at).to_pylist())}
        return batch.take(pa.array([k for k in range(batch.num_rows) if k not in bad], pa.int64())) if bad else batch

    return map_slices(docs, work, docs.schema, "text")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents, all columns. Each row is judged by its own text where it
    lies (no join, no shuffle), so null and repeated ids make no difference."""
    for rows in blocks_of(benchmark):
        docs = _without(docs, Benchmark(rows))
    return docs
