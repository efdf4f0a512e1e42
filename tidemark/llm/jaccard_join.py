"""Exact n-gram Jaccard self-join, and the components of its links.

Words are runs of non-separators, A-Z lower-cased. A document's set is its distinct
5-word shingles (fewer words: the whole sequence is one), each a 64-bit hash. Two sets link
when 100 * intersection >= percent * union.

1. *Profile* (one pass): per document the set's size and digest and a hashed bitmap
   signature of at least two bits a shingle. The same pass notes the most frequent shingles.
2. *Tiles*: under any fixed order of shingles, two similar sets share one of the first
   ``n - ceil(n * percent / 100) + 1`` of the larger's and of the first ``n - ceil(2 n percent / (100 + percent)) + 1``
   of the smaller's. The order is by frequency (at most ``ORDERED``
   frequent shingles are known, and come last), then by hash: passages that many documents share fall behind.
   Rows (shingle, size, digest, id) are sorted inside each shingle by size; equal sets are one
   row (within a slice before the shuffle already), and rows without a partner of a like size (ratio percent / 100) are gone.
3. *First links*: every document is held against its neighbours in its tiles, first by size, then in ``ROUNDS`` more
   orders by hash, those with the most tiles in common first, and components are formed in between. This connects
   large groups of near copies with a few comparisons a document instead of all pairs.
4. *The rest, exactly*: tiles that still hold two components are compared in full, but only
   across components, in numpy blocks: ``|A and B| <= |A| - bits(A without B)`` bounds the
   overlap from above; pairs that pass are verified. Tiles above ``TILE`` rows are cut into
   blocks, and each pair of blocks is a task's work; nothing is dropped.
5. Verification intersects the sorted arrays of exactly the documents named in pairs.

Links inside one component need not all be listed: the components are those of the full join.

Defined cases: null and empty texts have 0 shingles and link with nothing; a null id is its
own component (null); equal texts and repeated rows share a component; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Shared, map_slices, materialize, process_cache, ship
from tidemark.llm.components import connected_components

ship(__name__)

SHINGLE = 5
PERCENT = 80
ORDERED = 1 << 17
TILE = 2048
ROUNDS = 1
#: Tiles by which a pair's repeats are told, and the number of no tile.
FIRSTS, NEVER = 8, 2**63 - 1
CACHE_WORDS = 150_000
FILTER_BITS = 23
#: Odd multipliers of the shingle hash (any will do; fixed so that hashes agree).
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every bit over the 64."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    known = process_cache("shingles").setdefault("word_hashes", {})
    if len(known) > CACHE_WORDS:
        known.clear()
    out = []
    for w in words:
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh3_64_intdigest(w)
        out.append(h)
    return np.array(out, dtype=np.uint64)


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = word_hashes(words)
    k = min(width, len(h))
    n = len(h) - k + 1
    acc = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        acc = mix(acc + h[j:j + n] * ODD[j % len(ODD)])
    return np.unique(acc)


def least_overlap(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def bitmap(s: np.ndarray) -> np.ndarray:
    """Signature of a set: bytes of a bitmap with 2 to 4 bits a shingle, indexed by the hash's low bits."""
    bits = max(64, 1 << int(2 * len(s) - 1).bit_length())
    out = np.zeros(bits, dtype=np.uint8)
    out[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little")


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """Rows of bitmaps brought down to ``size`` bytes (halves are united)."""
    while bits.shape[1] > size:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def may_link(na, nb, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """For rows of equally long bitmaps: can the sets still reach the similarity?"""
    only_a = np.bitwise_count(a.view(np.uint64) & ~b.view(np.uint64)).sum(axis=1, dtype=np.int64)
    only_b = np.bitwise_count(b.view(np.uint64) & ~a.view(np.uint64)).sum(axis=1, dtype=np.int64)
    both = np.minimum(na - only_a, nb - only_b)
    return 100 * both >= percent * (na + nb - both)


def signatures_may_link(na: np.ndarray, nb: np.ndarray, a: list[bytes], b: list[bytes], percent: int) -> np.ndarray:
    """``may_link`` for pairs of signatures of any lengths."""
    out = np.zeros(len(a), dtype=bool)
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    for sa, sb in {*zip(la.tolist(), lb.tolist(), strict=True)}:
        at = np.flatnonzero((la == sa) & (lb == sb))
        step = max(1, (1 << 22) // max(sa, sb))
        for lo in range(0, len(at), step):
            i = at[lo:lo + step]
            x = np.frombuffer(b"".join([a[k] for k in i.tolist()]), dtype=np.uint8).reshape(len(i), sa)
            y = np.frombuffer(b"".join([b[k] for k in i.tolist()]), dtype=np.uint8).reshape(len(i), sb)
            size = min(sa, sb)
            out[i] = may_link(na[i], nb[i], np.ascontiguousarray(fold(x, size)), np.ascontiguousarray(fold(y, size)), percent)
    return out


def like_size(na, nb, percent: int):
    return 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)


# --- 1. profile ----------------------------------------------------------------------------

PROFILE = "doc_id bigint, n bigint, digest bigint, digest2 bigint, bits binary, shingle bigint, seen bigint"


def profile(docs: DataFrame) -> DataFrame:
    """Rows per document (id, n, digests, bits), and rows (shingle, seen) of shingles frequent within a slice."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t) for t in batch.column(1).to_pylist()]
        digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        often = counts >= 4
        k = int(often.sum())
        half = 1 << 63

        def signed(xs):
            return [x - (1 << 64) if x >= half else x for x in xs]

        empty = [None] * k
        return pa.RecordBatch.from_arrays([
            pa.array(batch.column(0).to_pylist() + empty, pa.int64()),
            pa.array([len(s) for s in sets] + empty, pa.int64()),
            pa.array(signed([d & (1 << 64) - 1 for d in digests]) + empty, pa.int64()),
            pa.array(signed([d >> 64 for d in digests]) + empty, pa.int64()),
            pa.array([bitmap(s).tobytes() if len(s) else None for s in sets] + empty, pa.binary()),
            pa.array([None] * len(sets) + values[often].view(np.int64).tolist(), pa.int64()),
            pa.array([None] * len(sets) + counts[often].tolist(), pa.int64()),
        ], ["doc_id", "n", "digest", "digest2", "bits", "shingle", "seen"])

    return map_slices(docs.select("doc_id", "text"), work, PROFILE, "text")


# --- 2. tiles ------------------------------------------------------------------------------

def prefixes(docs: DataFrame, frequent: Shared, percent: int) -> DataFrame:
    """(shingle, n, digest, doc_id, small) of the first shingles of every set, in the order by frequency and hash.

    ``small``: the shingle counts when the document is the smaller one of a pair.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        heavy, rank = frequent.get()
        least: dict[int, tuple[int, np.ndarray]] = {}
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            s = shingles(t)
            if not len(s) or i is None:
                continue
            d = xxhash.xxh3_128_intdigest(s.tobytes())
            if d not in least or least[d][0] > i:  # equal sets of a slice: the smallest id stands for them
                least[d] = (i, s)
        keys, sizes, digests, ids, small = [], [], [], [], []
        for d, (i, s) in least.items():
            n = len(s)
            first = n - least_overlap(n, percent) + 1
            if len(heavy):
                at = np.searchsorted(heavy, s)
                at[at == len(heavy)] = 0
                place = np.where(heavy[at] == s, rank[at], 0)
                s = s[np.argsort(place, kind="stable")] if place.any() else s
            keys.append(s[:first])
            sizes.append(np.full(first, n, dtype=np.int32))
            digests.append(np.full(first, d & (1 << 64) - 1, dtype=np.uint64))
            ids.append(np.full(first, i, dtype=np.int64))
            small.append(np.arange(first) <= n - -(-2 * percent * n // (100 + percent)))
        if not keys:
            return None
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(digests).view(np.int64)),
            pa.array(np.concatenate(ids)), pa.array(np.concatenate(small))], ["shingle", "n", "digest", "doc_id", "small"])

    return map_slices(docs.select("doc_id", "text"), work, "shingle bigint, n int, digest bigint, doc_id bigint, small boolean", "text")


def tiles(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct sets of every shingle that have a partner of a like size: (shingle, n, doc_id, small, prev).

    ``prev`` is the document before by size, null if it is not of a like size. The stream holds back
    one row (its partner may follow) and the last row that counts as the smaller one.
    """

    def run(batches):
        held = None  # the last distinct row: its columns, whether it has a partner already, its prev
        lead = (0, -1)  # (shingle, n) of the last row with ``small``
        for batch in batches:
            if not batch.num_rows:
                continue
            key, n, digest, doc, small = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            n = n.astype(np.int64)
            if held is not None:
                key, n, digest, doc, small = (np.concatenate([[v], x]) for v, x in zip(held["row"], (key, n, digest, doc, small), strict=True))
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (n[1:] != n[:-1]) | (digest[1:] != digest[:-1])
            key, n, digest, doc, small = key[new], n[new], digest[new], doc[new], small[new].astype(bool)
            at = np.arange(len(key))
            near = np.zeros(len(key), dtype=bool)
            near[1:] = (key[1:] == key[:-1]) & like_size(n[1:], n[:-1], percent)
            # The last row with ``small`` before each row.
            before = np.concatenate([[-1], np.maximum.accumulate(np.where(small, at, -1))[:-1]])
            lead_key, lead_n = np.where(before >= 0, key[before], lead[0]), np.where(before >= 0, n[before], lead[1])
            partner = (lead_n >= 0) & (lead_key == key) & like_size(n, lead_n, percent)
            partner[:-1] |= small[:-1] & near[1:]
            prev = np.concatenate([[0], doc[:-1]])
            if held is not None:
                near[0], prev[0] = held["near"], held["prev"]
                partner[0] |= held["partner"]
            k = len(key) - 1
            if small.any():
                j = int(np.flatnonzero(small)[-1])
                if j < k:
                    lead = (key[j], n[j])
            out = partner.copy()
            out[k] = False  # held back
            if out.any():
                yield self_rows(key, n, doc, small, prev, near, out)
            # The held row is not its own partner: it joins the leads when the next batch begins.
            held = {"row": (key[k], n[k], digest[k], doc[k], small[k]), "partner": bool(partner[k]), "near": bool(near[k]), "prev": prev[k]}
        if held is not None and held["partner"]:
            row = [np.array([x]) for x in (held["row"][0], held["row"][1], held["row"][3], held["row"][4], held["prev"], held["near"])]
            yield self_rows(*row, np.array([True]))

    def self_rows(key, n, doc, small, prev, near, out):
        return pa.RecordBatch.from_arrays([
            pa.array(key[out].astype(np.int64)), pa.array(n[out].astype(np.int64)), pa.array(doc[out].astype(np.int64)), pa.array(small[out].astype(bool)),
            pa.array(prev[out].astype(np.int64), mask=~near[out].astype(bool))], ["shingle", "n", "doc_id", "small", "prev"])

    ordered = rows.repartition("shingle").sortWithinPartitions("shingle", "n", "digest", "doc_id")
    return ordered.mapInArrow(run, "shingle bigint, n bigint, doc_id bigint, small boolean, prev bigint")


def neighbours(open_rows: DataFrame, percent: int, turn: int) -> DataFrame:
    """(doc_id, other): rows next to each other in a tile under an order by hash, across components, of a like size."""

    def run(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, n, comp, doc = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            if last is not None:
                key, n, comp, doc = (np.concatenate([[v], x]) for v, x in zip(last, (key, n, comp, doc), strict=True))
            last = key[-1], n[-1], comp[-1], doc[-1]
            ok = (key[1:] == key[:-1]) & (comp[1:] != comp[:-1]) & like_size(n[1:], n[:-1], percent)
            if ok.any():
                yield pa.RecordBatch.from_arrays([pa.array(doc[1:][ok]), pa.array(doc[:-1][ok])], ["doc_id", "other"])

    ordered = open_rows.withColumn("turn", F.xxhash64("doc_id", F.lit(turn))).repartition("shingle").sortWithinPartitions("shingle", "turn")
    return ordered.select("shingle", "n", "component", "doc_id").mapInArrow(run, "doc_id bigint, other bigint")


# --- 5. verification -----------------------------------------------------------------------

def wanted_filter(ids: DataFrame) -> Shared:
    """A bitmap of fixed size over hashes of the ids; others pass with the share of set bits."""
    size = 1 << FILTER_BITS

    def run(batches):
        bits = np.zeros(size, dtype=np.uint8)
        for batch in batches:
            bits[batch.column(0).to_numpy(zero_copy_only=False)] = 1
        if bits.any():
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["bits"])

    total = np.zeros(size // 8, dtype=np.uint8)
    slots = ids.select(F.pmod(F.xxhash64("doc_id"), F.lit(size)).cast("int").alias("slot")).coalesce(8)
    for r in slots.mapInArrow(run, "bits binary").toLocalIterator():
        total |= np.frombuffer(r["bits"], dtype=np.uint8)
    return Shared(ids.sparkSession, total, "shingles")


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, items): the sorted arrays of the documents ``ids``; texts of others are not even split."""
    keep = wanted_filter(ids)
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS)).cast("int")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        slots = batch.column(2).to_numpy(zero_copy_only=False)
        bits = keep.get()
        hit = (bits[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1
        part = batch.filter(pa.array(hit.astype(bool)))
        arrays = [shingles(t).tobytes() for t in part.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(arrays, pa.binary())], ["doc_id", "items"])

    frame = docs.where("doc_id is not null").select("doc_id", "text", slot.alias("slot"))
    found = map_slices(frame, work, "doc_id bigint, items binary", "text")
    return found.join(ids.select("doc_id").distinct(), "doc_id", "left_semi")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity, by sorted-array intersection."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                s, t = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                at = np.searchsorted(t, s)
                at[at == len(t)] = 0
                both = int((t[at] == s).sum()) if len(t) and len(s) else 0
                keep.append(both > 0 and 100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    a = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def passing(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures leave the similarity possible."""

    def run(batches):
        for batch in batches:
            na, nb = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            ok = signatures_may_link(na, nb, batch.column(4).to_pylist(), batch.column(5).to_pylist(), percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok))

    a = signatures.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba"))
    b = signatures.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "ba", "bb").mapInArrow(run, "a bigint, b bigint")


# --- 4. the rest ---------------------------------------------------------------------------

def cross_pairs(open_rows: DataFrame, percent: int) -> DataFrame:
    """Pairs across components in the blocks of tiles whose signatures leave the similarity possible.

    ``open_rows``: (shingle, i, j, side, n, small, component, doc_id, bits, firsts, smalls); a block pair
    (i, j) holds about 2 * TILE rows by the way blocks are dealt, and is compared in numpy, the smaller set of a pair
    first. A pair can come from every tile that it has in common; it is not made again where the two documents' first
    open tiles (``first_tiles``) show an earlier one that made it, and the few repeats left are made one before they are used.
    """

    def compare(block: pa.Table):
        n = block["n"].to_numpy()
        comp = block["component"].to_numpy()
        doc = block["doc_id"].to_numpy()
        side = block["side"].to_numpy()
        small = block["small"].to_numpy()
        cross = block["i"].to_numpy() != block["j"].to_numpy()
        keys = np.stack([block[c].to_numpy() for c in ("shingle", "i", "j")])
        bits = block["bits"].to_pylist()
        firsts, smalls = (block[c].combine_chunks().flatten().to_numpy().reshape(-1, FIRSTS) for c in ("firsts", "smalls"))
        rows = np.arange(len(n))
        d = 1
        left = rows[:-1]
        while len(left):  # pairs at distance d within one block pair
            left = left[left + d < len(n)]
            left = left[(keys[:, left] == keys[:, left + d]).all(axis=0)]
            right = left + d
            ok = (comp[left] != comp[right]) & like_size(n[left], n[right], percent)
            ok &= small[left] & (~cross[left] | (side[left] != side[right]))
            a, b = left[ok], right[ok]
            if len(a):
                pass_ = signatures_may_link(n[a], n[b], [bits[x] for x in a.tolist()], [bits[x] for x in b.tolist()], percent)
                a, b = a[pass_], b[pass_]
                told = (smalls[a][:, :, None] == firsts[b][:, None, :]) & (smalls[a] < keys[0, a][:, None])[:, :, None]
                again = told.any(axis=(1, 2))
                a, b = a[~again], b[~again]
                if len(a):
                    x, y = doc[a], doc[b]
                    yield pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], ["a", "b"])
            d += 1

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            keys = np.stack([table[c].to_numpy() for c in ("shingle", "i", "j")])
            cut = len(table) - int(np.argmin((keys == keys[:, -1:]).all(axis=0)[::-1])) if not (keys == keys[:, -1:]).all() else 0
            if cut:
                yield from compare(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None and len(rest):
            yield from compare(rest)

    ordered = open_rows.repartition("shingle", "i", "j").sortWithinPartitions("shingle", "i", "j", "n", "doc_id")
    return ordered.select("shingle", "i", "j", "side", "n", "small", "component", "doc_id", "bits", "firsts", "smalls").mapInArrow(run, "a bigint, b bigint").distinct()


def first_tiles(rows: DataFrame) -> DataFrame:
    """(doc_id, firsts, smalls): the ``FIRSTS`` least open tiles of each document (at most its prefix), and those where it may be
    the smaller one of a pair; the last one repeats where there are fewer."""
    def least(tiles):
        few = F.slice(F.sort_array(tiles), 1, FIRSTS)
        return F.array(*[F.coalesce(F.get(few, F.least(F.lit(k), F.size(few) - 1)), F.lit(NEVER)) for k in range(FIRSTS)])

    small = F.when(F.col("small"), F.col("shingle"))
    held = rows.groupBy("doc_id").agg(F.collect_set("shingle").alias("_t"), F.collect_set(small).alias("_s"))
    return held.select("doc_id", least(F.col("_t")).alias("firsts"), least(F.col("_s")).alias("smalls"))


def verify_all(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    ids = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select(F.col("b").alias("doc_id"))).distinct()
    return materialize(verified(pairs, materialize(sets_of(docs, ids), "jaccard-sets"), percent), "jaccard-links")


def still_open(met: DataFrame, label: DataFrame) -> DataFrame:
    """The rows (shingle, n, doc_id, small, component) of tiles that hold two components or more."""
    rows = met.select("shingle", "n", "doc_id", "small").join(label, F.col("doc_id") == F.col("node"), "left").select(
        "shingle", "n", "doc_id", "small", F.coalesce("component", "doc_id").alias("component"))
    rows = materialize(rows, "jaccard-labelled")
    keys = rows.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("shingle")
    return materialize(rows.join(keys, "shingle", "left_semi"), "jaccard-open")


# --- the join ------------------------------------------------------------------------------

def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    whole = materialize(profile(docs), "jaccard-profile")
    per_doc = whole.where("n is not null").select("doc_id", "n", "digest", "digest2", "bits")
    often = (whole.where("shingle is not null").groupBy("shingle").agg(F.sum("seen").alias("seen"))
             .orderBy(F.desc("seen"), "shingle").limit(ORDERED).collect())  # an order, not a cap: the rest is ordered by hash
    heavy = np.array([r["shingle"] for r in often], dtype=np.int64).view(np.uint64)
    order = np.argsort(heavy)
    frequent = Shared(spark, (heavy[order], (len(heavy) - np.arange(len(heavy)))[order]), "shingles")

    met = materialize(tiles(prefixes(docs, frequent, percent), percent), "jaccard-tiles")
    signatures = per_doc.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    signatures = materialize(signatures.join(met.select("doc_id").distinct(), "doc_id", "left_semi"), "jaccard-signatures")

    # 3. first links
    links, tried = None, None
    rows = met.select("shingle", "n", "doc_id", "small", F.col("doc_id").alias("component"))
    near = met.select("doc_id", F.col("prev").alias("other")).where("other is not null")
    for turn in range(1 + ROUNDS):
        some = near.groupBy("doc_id", "other").agg(F.count("*").alias("tiles"))
        best = some.groupBy("doc_id").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("tiles")).alias("t"), "other"))), 1, 3).alias("best"))
        pairs = best.select("doc_id", F.explode("best.other").alias("other")).select(F.greatest("doc_id", "other").alias("a"), F.least("doc_id", "other").alias("b")).distinct()
        pairs = materialize(passing(pairs, signatures, percent), "jaccard-pairs")
        tried = pairs if tried is None else tried.unionAll(pairs)
        if turn == 0 or pairs.head(1):
            found = verify_all(docs, pairs, percent)
            links = found if links is None else materialize(links.unionAll(found), "jaccard-links")
            label = connected_components(links)
        rows = still_open(met, label)
        if turn == ROUNDS or not rows.head(1):
            break
        near = neighbours(rows, percent, turn)

    # 4. what is still apart within a tile
    sizes = rows.groupBy("shingle").agg(F.count("*").alias("size")).select("shingle", F.ceil(F.col("size") / TILE).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "shingle").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("shingle", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"),
                         F.when(F.col("own") <= F.col("with"), 0).otherwise(1).alias("side"), "n", "small", "component", "doc_id")
    apart = materialize(cross_pairs(dealt.join(signatures.select("doc_id", "bits"), "doc_id").join(first_tiles(rows), "doc_id"), percent), "jaccard-pairs")
    apart = materialize(apart.join(tried.distinct(), ["a", "b"], "left_anti"), "jaccard-pairs")
    if apart.head(1):
        links = materialize(links.unionAll(verify_all(docs, apart, percent)), "jaccard-links")
        label = connected_components(links)

    # Equal sets: the smallest id stands for all.
    same = per_doc.where("n > 0 and doc_id is not null").groupBy("n", "digest", "digest2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("k")).where("k > 1").drop("k")
    with_rep = per_doc.select("doc_id", "n", "digest", "digest2").join(same, ["n", "digest", "digest2"], "left")
    with_rep = with_rep.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("rep"))
    out = with_rep.join(label, F.col("rep") == F.col("node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
