"""Approximate nearest neighbours by cosine: a hierarchical navigable small-world graph per shard, shard results merged.

The index is a table: a row per shard with its ids, vectors, the sizes of its layers and the neighbours of all layers
end to end, ``LINKS`` slots a node above the ground and ``2 * LINKS`` on it (-1: free). Every node draws its top layer
from a hash of its id; nodes are kept by falling layer, so that layer l is the first ``sizes[l]`` nodes and node
0 is the entry. Nodes are inserted in that order, in batches that at most double the graph. A batch searches
the graph before it and its own members, keeps diverse neighbours (one nearer to a kept one than to the node is passed over while others
fill the slots) and is linked back, the target's slots chosen anew by the same rule. All of a batch's searches go in step: a
round opens the best unopened node of every beam, in array operations over the batch.

Rows of equal vectors are one node. Its ``copies`` smallest ids can be among the nearest of a query, for up to ``copies`` - 1
neighbours asked; the rest of a group of copies loses every tie to them, so nothing is lost and a vector
that a third of the rows share costs a node (the limit is taken before the shuffle as well).
Search: blocks of queries meet every shard; a shard answers with its nearest nodes, scored in double precision on
the original vectors; the merge ranks nodes, then the rows behind them. Ties go to the smaller id.

Defined cases: vectors null, empty, zero or with null or non-finite components, and null ids, take no part; of rows repeating an
id the one of the smallest vector counts; vectors of different lengths never meet (shards are per length); fewer
candidates than asked: all found; an empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.blocks import MOST_TASKS, array_of, blocks_of, finite_vector, meet
from tidemark.llm.common import materialize, ship

ship(__name__)

#: Rows of a shard, neighbours of a node above the ground layer, widths of the beams that build and search.
SHARD_ROWS, LINKS, BUILD_BEAM, SEARCH_BEAM = 8192, 16, 64, 96
BATCH = 256
#: Members of its own batch that a new node considers.
PEERS = 16


# --- the graph --------------------------------------------------------------------------------

def top_layers(ids: np.ndarray, links: int = LINKS) -> np.ndarray:
    """The top layer of each node, geometric with ratio 1 / links, from a 64-bit mix of its id."""
    z = ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return np.floor(-np.log(np.maximum(u, 1e-300)) / np.log(links)).astype(np.int64)


def beam_search(vectors: np.ndarray, slots: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of one layer for all ``queries`` in step: (nodes, similarities), nearest first, -1 where fewer.

    ``entry``: the nodes (distinct in a row, -1: none) that each query's beam starts from."""
    n, m = len(queries), slots.shape[1]
    start = entry[:, :width]
    seen = np.zeros((n, len(slots)), dtype=bool)
    nodes = np.full((n, width), -1, dtype=np.int64)
    near = np.full((n, width), -np.inf, dtype=np.float32)
    opened = np.ones((n, width), dtype=bool)
    r, c = np.nonzero(start >= 0)
    nodes[r, c] = start[r, c]
    near[r, c] = np.einsum("ij,ij->i", vectors[start[r, c]], queries[r])
    opened[r, c] = False
    seen[r, start[r, c]] = True
    while True:
        waiting = np.where(opened, -np.inf, near)
        best = waiting.argmax(axis=1)
        rows = np.flatnonzero(~opened[np.arange(n), best])
        if not len(rows):
            break
        best = best[rows]
        opened[rows, best] = True
        around = slots[nodes[rows, best]]
        new = (around >= 0) & ~seen[rows[:, None], around]
        r, c = np.nonzero(new)
        met = around[r, c]
        seen[rows[r], met] = True
        more = np.full((len(rows), m), -np.inf, dtype=np.float32)
        more[r, c] = np.einsum("ij,ij->i", vectors[met], queries[rows[r]])
        all_near = np.concatenate([near[rows], more], axis=1)
        take = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
        near[rows] = np.take_along_axis(all_near, take, 1)
        nodes[rows] = np.take_along_axis(np.concatenate([nodes[rows], np.where(new, around, -1)], axis=1), take, 1)
        opened[rows] = np.take_along_axis(np.concatenate([opened[rows], ~new], axis=1), take, 1)
    order = np.lexsort((nodes, -near), axis=1)
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(near, order, 1)


def diverse(vectors: np.ndarray, nodes: np.ndarray, near: np.ndarray, slots: int) -> np.ndarray:
    """``slots`` neighbours of each row out of its candidates (nearest first, -1: none): diverse ones, then the nearest left."""
    n, width = nodes.shape
    there = nodes >= 0
    points = vectors[np.where(there, nodes, 0)]
    between = points @ points.transpose(0, 2, 1)
    to_kept = np.full((n, width), -np.inf, dtype=np.float32)
    kept, count = np.zeros((n, width), dtype=bool), np.zeros(n, dtype=np.int64)
    for j in range(width):
        ok = there[:, j] & (count < slots) & (near[:, j] > to_kept[:, j])
        kept[:, j] = ok
        count += ok
        to_kept = np.where(ok[:, None], np.maximum(to_kept, between[:, j, :]), to_kept)
    first = np.argsort(np.where(kept, 0, np.where(there, 1, 2)), axis=1, kind="stable")[:, :slots]
    out = np.take_along_axis(np.where(there, nodes, -1), first, 1)
    if out.shape[1] < slots:
        out = np.concatenate([out, np.full((n, slots - out.shape[1]), -1, dtype=np.int64)], axis=1)
    return out


def link_back(vectors: np.ndarray, slots: np.ndarray, sources: np.ndarray, targets: np.ndarray) -> None:
    """Add ``sources`` to the slots of their ``targets`` (pairs, of distinct pairs); full targets choose anew."""
    room = slots.shape[1]
    near = np.einsum("ij,ij->i", vectors[sources], vectors[targets])
    order = np.lexsort((sources, -near, targets))
    sources, targets = sources[order], targets[order]
    owners, first, counts = np.unique(targets, return_index=True, return_counts=True)
    place = np.arange(len(targets)) - np.repeat(first, counts)
    new = np.full((len(owners), room), -1, dtype=np.int64)
    some = place < room  # the nearest newcomers are as many as there can be slots for
    new[np.repeat(np.arange(len(owners)), counts)[some], place[some]] = sources[some]
    both = np.concatenate([slots[owners], new], axis=1)
    held = (both >= 0).sum(axis=1)
    fits = held <= room
    if fits.any():
        slots[owners[fits]] = np.take_along_axis(both[fits], np.argsort(both[fits] < 0, axis=1, kind="stable"), 1)[:, :room]
    full = np.flatnonzero(~fits)
    for lo in range(0, len(full), BATCH):
        some = full[lo:lo + BATCH]
        mine, cand = owners[some], both[some]
        sims = np.where(cand >= 0, np.einsum("ijk,ik->ij", vectors[np.where(cand >= 0, cand, 0)], vectors[mine]), -np.inf).astype(np.float32)
        order = np.lexsort((cand, -sims), axis=1)
        slots[mine] = diverse(vectors, np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1), room)


def build(ids: np.ndarray, vectors: np.ndarray, links: int = LINKS, width: int = BUILD_BEAM) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(order of the nodes, sizes of the layers, slots per layer); ``vectors`` of length one, by ``order`` in the slots."""
    top = top_layers(ids, links)
    order = np.lexsort((ids, -top))
    vectors, top = vectors[order], top[order]
    sizes = np.array([int((top >= layer).sum()) for layer in range(int(top[0]) + 1)], dtype=np.int64)
    slots = [np.full((int(size), links * (2 if layer == 0 else 1)), -1, dtype=np.int64) for layer, size in enumerate(sizes)]
    lo = 1
    while lo < len(ids):
        hi = min(lo + min(BATCH, lo), int(sizes[top[lo]]))  # one top layer to a batch
        insert(vectors, slots, lo, hi, int(top[lo]), width)
        lo = hi
    return order, sizes, slots


def insert(vectors: np.ndarray, slots: list[np.ndarray], lo: int, hi: int, top: int, width: int) -> None:
    """Link the nodes lo to hi - 1, all of top layer ``top``, into layers ``top`` to 0 of the graph of the nodes below lo."""
    new = vectors[lo:hi]
    nodes = np.zeros((hi - lo, 1), dtype=np.int64)
    for layer in range(len(slots) - 1, top, -1):
        nodes, _ = beam_search(vectors, slots[layer], new, nodes, 1)
    among = new @ new.T
    np.fill_diagonal(among, -np.inf)
    peers = np.argsort(-among, axis=1, kind="stable")[:, :min(PEERS, hi - lo - 1)]
    for layer in range(top, -1, -1):
        nodes, near = beam_search(vectors, slots[layer], new, nodes, width)
        cand = np.concatenate([nodes, peers + lo], axis=1)
        sims = np.concatenate([near, np.take_along_axis(among, peers, 1)], axis=1)
        by = np.lexsort((cand, -sims), axis=1)
        picked = diverse(vectors, np.take_along_axis(cand, by, 1), np.take_along_axis(sims, by, 1), LINKS if layer else slots[0].shape[1] // 2)
        slots[layer][lo:hi, :picked.shape[1]] = picked
        r, c = np.nonzero(picked >= 0)
        pairs = np.stack([r + lo, picked[r, c]], axis=1)
        back = ~((picked[np.maximum(pairs[:, 1] - lo, 0)] == pairs[:, :1]).any(axis=1) & (pairs[:, 1] >= lo))  # peers that chose each other are linked
        if back.any():
            link_back(vectors, slots[layer], pairs[back, 0], pairs[back, 1])


def search(vectors: np.ndarray, slots: list[np.ndarray], queries: np.ndarray, width: int = SEARCH_BEAM) -> np.ndarray:
    """The nodes that the beams of ``queries`` end with, nearest first, -1 where fewer."""
    nodes = np.zeros((len(queries), 1), dtype=np.int64)
    for layer in range(len(slots) - 1, 0, -1):
        nodes, _ = beam_search(vectors, slots[layer], queries, nodes, 1)
    return beam_search(vectors, slots[0], queries, nodes, width)[0]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, single precision; scaled before they are squared, so that none over- or underflows."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return (v / np.sqrt((v * v).sum(axis=1, keepdims=True))).astype(np.float32)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, double precision (a length beyond double's range: of the rows scaled)."""
    with np.errstate(over="ignore", invalid="ignore", divide="ignore", under="ignore"):
        out = np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))
    odd = ~np.isfinite(out)
    if odd.any():
        x, y = (v[odd] / np.abs(v[odd]).max(axis=1, keepdims=True) for v in (a, b))
        out[odd] = np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
    return out


# --- the index as a table ---------------------------------------------------------------------------

def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vector as doubles) of the rows that take part, one per id."""
    ok = rows.where(F.col(key).isNotNull() & finite_vector(vector) & F.exists(vector, lambda x: x != 0))
    return ok.groupBy(F.col(key).cast("bigint").alias("id")).agg(F.min(F.col(vector).cast("array<double>")).alias("v"))


def nodes_of(vectors: DataFrame, copies: int) -> DataFrame:
    """(node, id, v): the ``copies`` smallest ids of each distinct vector, named by the smallest."""
    same = Window.partitionBy("v")
    few = vectors.withColumn("_r", F.row_number().over(same.orderBy("id"))).where(F.col("_r") <= copies)
    return few.withColumn("node", F.min("id").over(same)).select("node", "id", "v")


def shard_graph(table: pa.Table) -> pa.Table:
    """One shard's row of the index."""
    ids = table.column("id").to_numpy()
    by = np.argsort(ids, kind="stable")
    ids = ids[by]
    dim = table.column("dim")[0].as_py()
    vectors = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), dim)[by]
    order, sizes, slots = build(ids, unit(vectors))
    flat = np.concatenate([s.ravel() for s in slots])
    return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "ids": pa.array([ids[order]], pa.list_(pa.int64())),
                     "vectors": pa.array([vectors[order].ravel()], pa.list_(pa.float64())), "sizes": pa.array([sizes], pa.list_(pa.int64())), "slots": pa.array([flat.astype(np.int32)], pa.list_(pa.int32()))})


def build_index(nodes: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index of all nodes (id, v): a row per shard, shards numbered through by column ``piece``."""
    sized = nodes.select("id", "v", F.size("v").alias("dim"))
    shards = sized.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("_n"))
    dealt = sized.join(shards, "dim").select("id", "v", "dim", F.pmod(F.xxhash64("id"), F.col("_n")).cast("int").alias("shard"))
    # a shard is much work for its bytes: as many partitions as shards, which are not merged by size
    tasks = shards.agg(F.sum("_n")).first()[0] or 1
    return dealt.repartition(min(int(tasks), MOST_TASKS), "dim", "shard").groupBy("dim", "shard").applyInArrow(shard_graph, "dim int, shard int, ids array<bigint>, vectors array<double>, sizes array<bigint>, slots array<int>")


class Shard:
    """One row of the index, ready to search."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        self.dim = batch.column(batch.schema.get_field_index("dim"))[row].as_py()
        self.ids = array_of(batch, "ids", row)
        self.exact = array_of(batch, "vectors", row).reshape(len(self.ids), self.dim)
        self.unit = unit(self.exact)
        sizes, flat, self.slots, at = array_of(batch, "sizes", row), array_of(batch, "slots", row), [], 0
        for layer, size in enumerate(sizes.tolist()):
            end = at + size * LINKS * (2 if layer == 0 else 1)
            self.slots.append(flat[at:end].reshape(size, -1).astype(np.int64))
            at = end

    def nearest(self, queries: np.ndarray, k: int, width: int = SEARCH_BEAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, node's id, score) of the k best nodes found for each query."""
        found = search(self.unit, self.slots, unit(queries), max(width, 2 * k))
        r, c = np.nonzero(found >= 0)
        node = found[r, c]
        score = cosines(queries[r], self.exact[node])
        by = np.lexsort((self.ids[node], -score, r))
        r, node, score = r[by], node[by], score[by]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        keep = place < k
        return r[keep], self.ids[node[keep]], score[keep]


def nearest_neighbours(rows: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found of every query, never the query's own row."""
    members = materialize(nodes_of(usable(rows, key, vector), k + 1), "ann-nodes")
    index = materialize(build_index(members.where("node = id"), shard_rows), "ann-index")
    numbered = index.select("dim", "shard").withColumn("piece", F.row_number().over(Window.orderBy("dim", "shard")) - 1)  # a row per shard
    pieces = index.join(numbered, ["dim", "shard"])
    n_pieces = index.count()
    asked = usable(queries, key, vector).withColumn("dim", F.size("v"))
    if n_pieces == 0:
        return asked.limit(0).select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), "id", F.lit(0.0).alias("score"))
    blocks = blocks_of(asked, ["id", "dim"], ["v"], "id").select("part", F.col("id").alias("ids"), F.col("dim").alias("dims"), F.col("v").alias("vectors"))

    def answer(shard, batch, row):
        ids, dims, flat = (array_of(batch, c, row) for c in ("ids", "dims", "vectors"))
        mine = dims == shard.dim
        if not mine.any():
            return None
        queries = flat[np.repeat(mine, dims)].reshape(-1, shard.dim)
        r, node, score = shard.nearest(queries, k + 1)
        return pa.RecordBatch.from_arrays([pa.array(ids[mine][r]), pa.array(node), pa.array(score)], ["query_id", "node", "score"])

    found = meet(pieces.drop("shard"), blocks, n_pieces, Shard, answer, "query_id bigint, node bigint, score double")
    best = Window.partitionBy("query_id")
    nodes = found.withColumn("_r", F.row_number().over(best.orderBy(F.desc("score"), "node"))).where(F.col("_r") <= k + 1)
    # few queries with few nodes each against the members' ids: the vectors stay where they are
    named = nodes.join(members.select("node", "id"), "node").where("id <> query_id")
    return (named.withColumn("rank", F.row_number().over(best.orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))


def five_nearest(embeddings: DataFrame) -> DataFrame:
    """The contract of op11: the five nearest of every row whose id 50 divides."""
    out = nearest_neighbours(embeddings, embeddings.where("vec_id % 50 = 0"), 5)
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
