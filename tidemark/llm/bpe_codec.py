"""Byte-level BPE encoding and decoding through a sentencepiece model built from ranks.

No tokenizer is trained. The rank file (``base64(bytes) rank`` lines) is turned into a
sentencepiece BPE model by writing its protocol buffer directly:

* every byte is mapped to one printable character (the usual byte alphabet), so a token's
  bytes become a string and each string is one NORMAL piece;
* a piece's score is its negative rank, so sentencepiece's "best score first, leftmost
  first" merging is "lowest rank first, leftmost first";
* normalisation is the identity: no charsmap, no dummy prefix, no white-space handling.

A text is split by the pattern; each match (pre-token) is encoded by itself. A pre-token
that is a token as a whole is that token. Decoding maps ids back to bytes and joins them.

Defined cases: a null or empty text has no ids and decodes to no bytes; repeated rows and
ties of ids are kept row by row; columns besides the text pass through ``encode`` untouched
(an input column of the output's name is replaced); an empty table gives an empty table.
Memory: one slice of texts plus a cache of at most ``CACHE_ENTRIES`` pre-tokens.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import partial
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import pretokens
from tidemark.llm.common import map_slices, process_cache, ship

ship(__name__)

CACHE_ENTRIES = 150_000
#: The split pattern that :mod:`tidemark.llm.pretokens` is compiled from (a fixed value).
BYTE_BPE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# --- the model file ----------------------------------------------------------------------

def byte_alphabet() -> list[str]:
    """One printable character for each byte: itself where printable, else from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0x100
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _flag(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """The rank file's lines ``base64(bytes) rank``."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line.strip())}


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece ModelProto: piece 0 is <unk>, then the tokens by rank.

    Message fields: ModelProto.pieces = 1, .trainer_spec = 2, .normalizer_spec = 3;
    SentencePiece.piece = 1, .score = 2 (float), .type = 3 (NORMAL 1, UNKNOWN 2);
    TrainerSpec.model_type = 3 (BPE 2); NormalizerSpec.name = 1, .add_dummy_prefix = 3,
    .remove_extra_whitespaces = 4, .escape_whitespaces = 5.
    """
    alphabet = byte_alphabet()
    parts = [_field(1, _field(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _flag(3, 2))]
    for token, rank in sorted(ranks.items(), key=lambda kv: kv[1]):
        piece = "".join(alphabet[b] for b in token).encode()
        parts.append(_field(1, _field(1, piece) + b"\x15" + struct.pack("<f", -float(rank)) + _flag(3, 1)))
    parts.append(_field(2, _flag(3, 2)))
    parts.append(_field(3, _field(1, b"identity") + _flag(3, 0) + _flag(4, 0) + _flag(5, 0)))
    return b"".join(parts)


def _split_by(findall, texts: list[str]) -> tuple[list[str], np.ndarray]:
    pieces = [findall(t) for t in texts]
    return list(chain.from_iterable(pieces)), np.array([len(p) for p in pieces], dtype=np.int64)


def gather(starts: np.ndarray, lengths: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The runs ``data[start:start + length]``, end to end."""
    shift = starts - np.cumsum(lengths) + lengths
    return data[np.repeat(shift, lengths) + np.arange(int(lengths.sum()), dtype=np.int64)]


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(lengths)])


class Codec:
    """Encoder and decoder of one rank file; pre-tokens already met are remembered, up to a bound."""

    def __init__(self, raw: bytes, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(raw)
        by_rank = sorted(self.ranks.items(), key=lambda kv: kv[1])
        self.of_piece = np.array([-1] + [rank for _, rank in by_rank], dtype=np.int32)  # sentencepiece id -> rank
        self.table = dict(enumerate(byte_alphabet()))
        #: The public pattern has a compiled transducer; any other goes through the regex engine.
        self.split = pretokens.split if pattern == BYTE_BPE_PATTERN else partial(_split_by, regex.compile(pattern).findall)
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(model_proto(self.ranks))
        top = by_rank[-1][0 + 1] + 1 if by_rank else 0
        self.token_length = np.zeros(top, dtype=np.int64)
        for token, rank in by_rank:
            self.token_length[rank] = len(token)
        self.token_start = offsets_of(self.token_length)[:-1]
        named = {rank: token for token, rank in by_rank}
        self.token_data = np.frombuffer(b"".join(named.get(i, b"") for i in range(top)), dtype=np.uint8)
        self._forget(None)

    def _forget(self, used: np.ndarray | None) -> None:
        """Start the memory anew with the entries ``used`` only."""
        if used is None:
            self.known: dict[str, int] = {}
            self.start, self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
            return
        names = list(self.known)
        self.known = {names[i]: k for k, i in enumerate(used.tolist())}
        self.ids = gather(self.start[used], self.length[used], self.ids)
        self.length = self.length[used]
        self.start = offsets_of(self.length)[:-1]

    def _learn(self, new: list[str]) -> None:
        """Encode the pre-tokens ``new`` (none of them known) in one call and remember them."""
        raw = [p.encode("utf-8", "surrogatepass") for p in new]
        whole = np.fromiter((self.ranks.get(r, -1) for r in raw), dtype=np.int64, count=len(raw))
        ask = np.flatnonzero(whole < 0)
        length = np.ones(len(new), dtype=np.int64)
        table = self.table
        got = self.model.Encode([raw[i].decode("latin-1").translate(table) for i in ask.tolist()], out_type=int, num_threads=1) if len(ask) else []
        length[ask] = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        ids = np.empty(int(length.sum()), dtype=np.int32)
        start = offsets_of(length)[:-1]
        sure = whole >= 0
        ids[start[sure]] = whole[sure]
        if len(ask):
            flat = self.of_piece[np.fromiter(chain.from_iterable(got), dtype=np.int64, count=int(length[ask].sum()))]
            ids[gather(start[ask], length[ask], np.arange(len(ids)))] = flat
        base = len(self.known)
        self.known.update(zip(new, range(base, base + len(new)), strict=True))
        self.start = np.concatenate([self.start, start + len(self.ids)])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, ids])

    def encode_slice(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, end to end; ids per text). Null counts as empty."""
        pieces, counts = self.split([t or "" for t in texts])
        at = np.fromiter(map(self.known.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            self._learn(list(dict.fromkeys([pieces[i] for i in missing])))
            at[missing] = [self.known[pieces[i]] for i in missing]
        ids = gather(self.start[at], self.length[at], self.ids)
        per_piece = offsets_of(self.length[at])
        bounds = offsets_of(counts)
        if len(self.known) > CACHE_ENTRIES:
            used = np.unique(at)
            self._forget(used if len(used) < CACHE_ENTRIES // 2 else None)
        return ids, per_piece[bounds[1:]] - per_piece[bounds[:-1]]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ``ids``, end to end."""
        return gather(self.token_start[ids], self.token_length[ids], self.token_data)


def _codec(vocab: bytes, pattern: str) -> Codec:
    key = ("bpe_codec", hashlib.sha256(vocab).digest(), pattern)
    cache = process_cache("tokenizers")
    if key not in cache:
        cache[key] = Codec(vocab, pattern)
    return cache[key]


# --- the operator -------------------------------------------------------------------------

def _vocabulary(df: DataFrame, vocab_path: str):
    """The vocabulary file (about 1 MB, fixed) as a broadcast: executors need no copy of it."""
    with open(vocab_path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _schema_with(df: DataFrame, drop: set[str], field: str) -> tuple[list[str], str]:
    keep = [f for f in df.schema.fields if f.name not in drop]
    return [f.name for f in keep], ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + [field])


def encode(df: DataFrame, vocab_path: str, pattern: str, text: str = "text", out: str = "ids", round_trip: str | None = None) -> DataFrame:
    """``df`` plus ``out`` array<int>: the ids of the whole text (null or empty text: none).

    ``round_trip``: a column for the sha256 (lowercase hex) of the bytes that the ids decode to. Encoding and decoding are
    then one pass by one Python worker, and the bytes never leave it."""
    vocab = _vocabulary(df, vocab_path)
    more = [(out, "array<int>")] + ([(round_trip, "string")] if round_trip else [])
    names, schema = _schema_with(df, {n for n, _ in more}, ", ".join(f"`{n}` {t}" for n, t in more))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(vocab.value, pattern)
        ids, counts = codec.encode_slice(batch.column(batch.schema.get_field_index(text)).to_pylist())
        ends = offsets_of(counts)
        columns = [*(batch.column(batch.schema.get_field_index(n)) for n in names),
                   pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(ids, type=pa.int32()))]
        if round_trip:
            raw, cut = memoryview(codec.decode(ids)), offsets_of(codec.token_length[ids])[ends].tolist()
            columns.append(pa.array([hashlib.sha256(raw[lo:hi]).hexdigest() for lo, hi in zip(cut[:-1], cut[1:], strict=True)], type=pa.string()))
        return pa.RecordBatch.from_arrays(columns, [*names, *(n for n, _ in more)])

    return map_slices(df.select(*(F.col(f"`{n}`") for n in dict.fromkeys([*names, text]))), work, schema, text)


def ids_digest(ids: str = "ids"):
    """sha256 of the decimal ids joined by commas, lowercase hex."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ",").cast("binary"), 256)


def decode(df: DataFrame, vocab_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` without its ids, plus ``out`` binary: the bytes that the ids stand for (null ids: none)."""
    vocab = _vocabulary(df, vocab_path)
    names, schema = _schema_with(df, {ids, out}, f"`{out}` binary")

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                col = pa.compute.fill_null(part.column(part.schema.get_field_index(ids)), [])
                codec = _codec(vocab.value, BYTE_BPE_PATTERN)
                flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                lengths = pa.compute.list_value_length(col).to_numpy(zero_copy_only=False).astype(np.int64)
                ends = offsets_of(codec.token_length[flat])[offsets_of(lengths)]
                raw = pa.BinaryArray.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(codec.decode(flat))])
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(n)) for n in names), raw], [*names, out])

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, vocab_path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (contract of op4)."""
    enc = encode(df.select("doc_id", "text"), vocab_path, pattern, round_trip="decoded_sha256")
    return enc.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), ids_digest().alias("ids_sha256"), "decoded_sha256")
