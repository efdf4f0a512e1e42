"""Token counts by a finite-state transducer compiled from a byte-level BPE tokenizer file.

The tokenizer is compiled into two deterministic transducers:

* over character classes (:mod:`tidemark.llm.pretokens`): where pre-tokens start. Long rows
  are cut into chunks whose state maps compose in a parallel prefix scan;
* over the bytes of a pre-token: each transition carries the change of the token count.

The second rests on a property of BPE: a segmentation is the encoding of its string exactly
if every adjacent pair of tokens encodes to itself. So for each prefix of a pre-token there
is one last token, and the count of a prefix is the count at that token's start plus one. A
state holds the positions from which a longer token may still be growing, each with the node
of the token trie reached, the last token before it and its count relative to the present
one. That is a finite description; reading a byte gives the next state and a count change.
States are numbered, and transitions compiled, when first met (a lazily determinised
automaton); the table is an open-addressing hash of ``(state, byte)`` read for a whole slice
of pre-tokens in step. It is bounded: beyond ``MAX_TRANSITIONS`` it is compiled afresh, between
two bytes of a pre-token too, whose states are then carried over; so no text is too diverse.

Defined cases: a null or empty text has 0 bytes and 0 tokens; strings of special tokens
inside a text count as the library counts them by default (one token each, the text around
them split there). Rows repeat as given; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import pretokens
from tidemark.llm.bpe_codec import byte_alphabet
from tidemark.llm.common import map_slices, process_cache, ship

ship(__name__)

MAX_TRANSITIONS = 1 << 19
_BITS = 21  # of the hash table: four times the transitions
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Transducer:
    """The byte transducer of one tokenizer file."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        pre = spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or not pre.get("use_regex", True) or pre["add_prefix_space"]:
            raise ValueError("only byte-level BPE without a prefix space can be compiled")
        self.special = [t["content"] for t in spec["added_tokens"]]
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        self.vocab = {bytes(byte_of[c] for c in piece): i for piece, i in model["vocab"].items()
                      if all(c in byte_of for c in piece) and piece not in self.special}
        ids = model["vocab"]
        self.merge = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merge[ids[a], ids[b]] = (rank, ids[a + b])
        self.single = [self.vocab[bytes([b])] for b in range(256)]
        self.named = {i: t for t, i in self.vocab.items()}
        # Trie of the tokens: node * 256 + byte -> node; the token that ends at a node.
        self.child: dict[int, int] = {}
        self.token_at = [-1]
        self.inner = [True]  # has children
        for token, i in self.vocab.items():
            node = 0
            for b in token:
                nxt = self.child.get(node << 8 | b)
                if nxt is None:
                    nxt = self.child[node << 8 | b] = len(self.token_at)
                    self.token_at.append(-1)
                    self.inner.append(False)
                    self.inner[node] = True
                node = nxt
            self.token_at[node] = i
        self.pairs: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.items = [((0, -1, 0),)]  # state 0: nothing read yet
        self.number = {self.items[0]: 0}
        self.keys = np.full(1 << _BITS, -1, dtype=np.int64)
        self.next = np.zeros(1 << _BITS, dtype=np.int32)
        self.change = np.zeros(1 << _BITS, dtype=np.int8)
        self.filled = 0

    def carried(self, state: np.ndarray) -> np.ndarray:
        """The numbers of these states in a table begun afresh."""
        old, at = np.unique(state, return_inverse=True)
        kept = [self.items[x] for x in old.tolist()]
        self.reset()
        numbers = []
        for items in kept:
            number = self.number.get(items)
            if number is None:
                number = self.number[items] = len(self.items)
                self.items.append(items)
            numbers.append(number)
        return np.array(numbers, dtype=np.int64)[at]

    def bpe(self, raw: bytes) -> list[int]:
        """Plain BPE: merge the pair of lowest rank, leftmost first."""
        ids = [self.single[b] for b in raw]
        merge = self.merge
        while len(ids) > 1:
            best = min(((merge[p][0], k) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in merge), default=None)
            if best is None:
                break
            k = best[1]
            ids[k:k + 2] = [merge[ids[k], ids[k + 1]][1]]
        return ids

    def stable(self, a: int, b: int) -> bool:
        """Does the pair of tokens encode to itself?"""
        key = (a, b)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > MAX_TRANSITIONS:
                self.pairs.clear()
            known = self.pairs[key] = self.bpe(self.named[a] + self.named[b]) == [a, b]
        return known

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """Next state and count change of one transition."""
        grown = []
        last = change = None
        for node, before, count in self.items[state]:
            nxt = self.child.get(node << 8 | byte)
            if nxt is None:
                continue
            token = self.token_at[nxt]
            if last is None and token >= 0 and (before < 0 or self.stable(before, token)):
                last, change = token, count + 1
            if self.inner[nxt]:
                grown.append((nxt, before, count))
        items = (*((node, before, count - change) for node, before, count in grown), (0, last, 0))
        number = self.number.get(items)
        if number is None:
            number = self.number[items] = len(self.items)
            self.items.append(items)
        return number, change

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """For each key its slot, or that of the free place where it belongs."""
        at = ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - _BITS)).astype(np.int64)
        found = self.keys[at]
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << _BITS) - 1)
            found = self.keys[at[open_]]
            open_ = open_[(found != keys[open_]) & (found >= 0)]
        return at

    def run(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Token counts of the byte strings ``data[start:start + length]``, in groups of ``MAX_TRANSITIONS``."""
        groups = range(0, len(starts), MAX_TRANSITIONS)
        parts = [self.run_group(data, starts[k:k + MAX_TRANSITIONS], lengths[k:k + MAX_TRANSITIONS]) for k in groups]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)

    def run_group(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Token counts of at most ``MAX_TRANSITIONS`` byte strings, read in step: a byte adds so many transitions at most."""
        order = np.argsort(-lengths, kind="stable")
        start, length = starts[order], lengths[order]
        state = np.zeros(len(order), dtype=np.int64)
        count = np.zeros(len(order), dtype=np.int64)
        active = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), side="left")
        for j, k in enumerate(active.tolist()):
            key = state[:k] << 8 | data[start[:k] + j]
            at = self.slots(key)
            new = np.flatnonzero(self.keys[at] < 0)
            if len(new):
                for x in np.unique(key[new]).tolist():
                    slot = int(self.slots(np.array([x], dtype=np.int64))[0])
                    self.next[slot], self.change[slot] = self.compile(x >> 8, x & 255)
                    self.keys[slot] = x
                    self.filled += 1
                at[new] = self.slots(key[new])
            state[:k] = self.next[at]
            count[:k] += self.change[at]
            if self.filled > 2 * MAX_TRANSITIONS:
                state[:k] = self.carried(state[:k])
        out = np.empty(len(order), dtype=np.int64)
        out[order] = count
        if self.filled > MAX_TRANSITIONS:
            self.reset()
        return out

    def count(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(UTF-8 bytes, tokens) of each text."""
        parts, extra, owner = [], np.zeros(len(texts), dtype=np.int64), []
        for i, t in enumerate(texts):
            rest = [t or ""]
            for s in self.special:
                if s in (t or ""):
                    cut = [p.split(s) for p in rest]
                    extra[i] += sum(len(c) - 1 for c in cut)
                    rest = [p for c in cut for p in c]
            parts += rest
            owner += [i] * len(rest)
        at, ends, joined = pretokens.starts_of(parts)
        data = np.frombuffer(joined.encode("utf-8"), dtype=np.uint8)
        char = np.flatnonzero((data & 0xC0) != 0x80)  # the byte at which each character starts
        byte_at = np.append(char[at], len(data))
        closing = np.searchsorted(at, ends)
        keep = np.ones(len(at), dtype=bool)
        keep[closing] = False
        got = np.zeros(len(at), dtype=np.int64)
        got[keep] = self.run(data, byte_at[:-1][keep], np.diff(byte_at)[keep])
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(got)])
        per_part = np.diff(total[closing], prepend=0)
        n_bytes = np.fromiter((len(t.encode("utf-8")) if t else 0 for t in texts), dtype=np.int64, count=len(texts))
        return n_bytes, extra + np.bincount(np.array(owner, dtype=np.int64), weights=per_part, minlength=len(texts)).astype(np.int64)


def _transducer(raw: bytes) -> Transducer:
    key = ("token_counts", hashlib.sha256(raw).digest())
    cache = process_cache("tokenizers")
    if key not in cache:
        cache[key] = Transducer(raw)
    return cache[key]


def token_counts(df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_bytes (UTF-8) and n_tokens of every whole text."""
    with open(tokenizer_path, "rb") as f:  # about 2 MB, fixed
        raw = df.sparkSession.sparkContext.broadcast(f.read())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_bytes, n_tokens = _transducer(raw.value).count(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes), pa.array(n_tokens)], [key, "n_bytes", "n_tokens"])

    kind = df.schema[key].dataType.simpleString()
    return map_slices(df.select(F.col(f"`{key}`"), F.col(f"`{text}`")), work, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint", text)


def over_limit(df: DataFrame, tokenizer_path: str, limit: int = 1024) -> DataFrame:
    """Contract of op8: the counts and whether a text is longer than ``limit`` tokens."""
    return token_counts(df, tokenizer_path).withColumn("over_limit", F.col("n_tokens") > limit)
