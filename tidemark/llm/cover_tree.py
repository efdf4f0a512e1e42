"""Hard negatives: rows of another label whose inner product with an anchor lies just below that of a row of its own label.

Exact search over cover trees, one per piece of the candidates:

* candidates are augmented by one coordinate, sqrt(M^2 - |x|^2) with M the piece's greatest norm, so that all lie on
  one sphere and an anchor's inner products (its own added coordinate is 0) order them as distances do;
* a node covers its rows within the radius of its level; levels shrink by ``BASE``. Its children are centres picked
  farthest first, itself first, until all rows are within the next level's radius of one, so centres are farther
  than that apart; each row goes to its nearest centre. A node of few rows, or of one point, is a leaf;
* a node keeps the radius that it really covers, at most its level's. As all is on a sphere, the angle between
  anchor and centre, more or less the angle of the radius, bounds the inner products below a node from both sides;
* the descent opens the nodes of greatest upper bound first, some at a time, and passes over a node whose labels cannot
  count or whose bounds miss every window still wanted: windows [low % of a positive's score, high %], their lower
  ends raised to the last of the best found so far. Leaves are verified by exact integer inner products.

Anchors meet the pieces in blocks, twice: for the positives (one window, without bounds), and for the negatives
of all positives of an anchor at once; the best per piece are merged.

Defined cases: rows with a null label, id or vector, an empty vector, or a null or non-finite component take no part;
of rows repeating an id the one of the smallest label and vector counts; vectors of different lengths never meet (pieces
are per length). Ties go to the smaller id; rows of equal vectors are rows like others. Fewer than asked: all. Scores are exact
while they fit 53 bits, beyond that by Python's integers, held to the range of a long. An empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.blocks import MOST_TASKS, array_of, blocks_of, finite_vector, meet
from tidemark.llm.common import materialize, ship

ship(__name__)

#: Rows of a piece (about), ratio of the radii of two levels, rows of a leaf, nodes opened at a time.
PIECE_ROWS, BASE, LEAF_ROWS, OPENED = 8192, 1.3, 48, 256
LONG = 2**63 - 1
#: A node's numbers: first child, children, first row, rows, smallest and greatest label, row of the centre.
CHILD, CHILDREN, ROW, ROWS, LOW, HIGH, CENTRE = range(7)


# --- the tree -------------------------------------------------------------------------------------

def augmented(vectors: np.ndarray) -> tuple[np.ndarray, float]:
    """(rows on a sphere, its radius): one coordinate more, which brings every row to the greatest norm."""
    squares = np.einsum("ij,ij->i", vectors, vectors)
    most = float(squares.max())
    return np.concatenate([vectors, np.sqrt(np.maximum(most - squares, 0))[:, None]], axis=1), float(np.sqrt(most))


def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    diff = points - centre
    return np.sqrt(np.einsum("ij,ij->i", diff, diff))


def children_of(points: np.ndarray, rows: np.ndarray, far: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centres as places in ``rows``, nearest centre of each row, distance to it): farthest first, until ``radius`` covers all.

    ``rows[0]`` is the parent's centre and the first child's; ``far``: distances to it."""
    mine = points[rows]
    near, owner, centres = far.copy(), np.zeros(len(rows), dtype=np.int64), [0]
    while near[(at := int(near.argmax()))] > radius:
        fresh = distances(mine, mine[at])
        closer = fresh < near
        closer[at] = True
        near[closer], owner[closer] = fresh[closer], len(centres)
        near[at] = 0.0
        centres.append(at)
    return np.array(centres), owner, near


def build_tree(vectors: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the rows, numbers of the nodes, their radii); a node's rows are a slice, its children consecutive nodes."""
    points, norm = augmented(vectors)
    order = np.arange(len(vectors))
    tiny = 1e-9 * max(norm, 1.0)  # below this a radius is rounding, not distance
    numbers, radii, todo = [None], [0.0], []

    def settle(node: int, rows: np.ndarray, first: int, far: np.ndarray) -> None:
        """Write the node of ``rows`` (its centre first) and queue it if it is to have children."""
        order[first:first + len(rows)] = rows
        radii[node] = float(far.max())
        numbers[node] = [0, 0, first, len(rows), int(labels[rows].min()), int(labels[rows].max()), int(rows[0])]
        if len(rows) > LEAF_ROWS and radii[node] > tiny:
            todo.append((node, rows, first, far))

    settle(0, order.copy(), 0, distances(points, points[0]))
    while todo:
        node, rows, first, far = todo.pop()
        level = np.ceil(np.log(radii[node]) / np.log(BASE)) - 1  # the first level below the radius: two children at least
        if BASE ** level >= radii[node]:
            level -= 1
        centres, owner, near = children_of(points, rows, far, BASE ** level)
        numbers[node][CHILD], numbers[node][CHILDREN] = len(numbers), len(centres)
        base = len(numbers)
        numbers.extend([None] * len(centres))
        radii.extend([0.0] * len(centres))
        by = np.lexsort((near, owner))  # a centre (distance 0) comes first among its own
        cuts = np.searchsorted(owner[by], np.arange(len(centres) + 1))
        for c, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            own = by[lo:hi]
            if own[0] != centres[c]:  # copies of the centre are as near
                own = np.concatenate([[centres[c]], own[own != centres[c]]])
            settle(base + c, rows[own], first + lo, near[own])
    return order, np.array(numbers, dtype=np.int64), np.array(radii)


def inner(vectors: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; ``exact``: doubles hold every partial sum."""
    if exact:
        return (vectors @ query).astype(np.int64)
    q = [int(x) for x in query]
    return np.array([max(-LONG, min(LONG, sum(int(a) * b for a, b in zip(v, q, strict=True)))) for v in vectors], dtype=np.int64)


class Tree:
    """One piece's tree, ready to search."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, numbers: np.ndarray, radii: np.ndarray, centres: np.ndarray):
        self.ids, self.labels, self.vectors, self.numbers = ids, labels, vectors, numbers
        self.norm = float(np.sqrt(np.einsum("ij,ij->i", vectors, vectors).max()))
        self.centres = centres
        self.angle = 2 * np.arcsin(np.minimum(1.0, radii / (2 * self.norm))) if self.norm else np.zeros(len(radii))

    def bounds(self, nodes: np.ndarray, query: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the inner products below the nodes, with room for rounding."""
        most = size * self.norm
        if most == 0:
            return np.zeros(len(nodes)), np.zeros(len(nodes))
        at = np.arccos(np.clip((self.centres[nodes] @ query) / most, -1.0, 1.0))
        spare = 1e-6  # radians: beyond what arccos and the sums above lose
        low = np.cos(np.minimum(np.pi, at + self.angle[nodes] + spare)) * most
        high = np.cos(np.maximum(0.0, at - self.angle[nodes] - spare)) * most
        return low - 1e-9 * most, high + 1e-9 * most

    def best(self, query: np.ndarray, own_id: int, own_label: int, same_label: bool, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per window (low, high), inclusive, the k best (ids, scores) in it, of the wanted labels, without the anchor's own id."""
        size = float(np.sqrt(query @ query))
        exact = size * self.norm < 2**52
        low = np.array([float(w[0]) for w in windows])
        high = np.array([float(w[1]) for w in windows])
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(windows)
        nodes = np.zeros(1, dtype=np.int64)
        lower, upper = self.bounds(nodes, query, size)
        slack = 0.0 if exact else 1e-9 * size * self.norm
        while len(nodes):
            keep = ((upper[:, None] + slack >= low) & (lower[:, None] - slack <= high)).any(axis=1)
            nodes, lower, upper = nodes[keep], lower[keep], upper[keep]
            if not len(nodes):
                break
            first = np.argpartition(-upper, min(OPENED, len(upper)) - 1)[:OPENED]
            rest = np.ones(len(nodes), dtype=bool)
            rest[first] = False
            opened = self.numbers[nodes[first]]
            nodes, lower, upper = nodes[rest], lower[rest], upper[rest]
            leaf = opened[:, CHILDREN] == 0
            if leaf.any():
                rows = spans(opened[leaf, ROW], opened[leaf, ROWS])
                rows = rows[((self.labels[rows] == own_label) == same_label) & (self.ids[rows] != own_id)]
                ids, scores = self.ids[rows], inner(self.vectors[rows], query, exact)
                for w, (least, most) in enumerate(windows):
                    inside = (scores >= least) & (scores <= most)
                    if inside.any():
                        a, s = np.concatenate([found[w][0], ids[inside]]), np.concatenate([found[w][1], scores[inside]])
                        by = np.lexsort((a, -s))[:k]
                        found[w] = a[by], s[by]
                        if len(by) == k:
                            low[w] = max(low[w], float(s[by[-1]]))
            inner_nodes = opened[~leaf]
            if len(inner_nodes):
                down = spans(inner_nodes[:, CHILD], inner_nodes[:, CHILDREN])
                pure = self.numbers[down, LOW] == self.numbers[down, HIGH]
                has = (self.numbers[down, LOW] <= own_label) & (own_label <= self.numbers[down, HIGH])
                down = down[has if same_label else ~(pure & has)]
                a, b = self.bounds(down, query, size)
                nodes, lower, upper = np.concatenate([nodes, down]), np.concatenate([lower, a]), np.concatenate([upper, b])
        return found


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start to start + count - 1 of each pair, end to end."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))


# --- the index as a table -----------------------------------------------------------------------------

def piece_tree(table: pa.Table) -> pa.Table:
    """One piece's row of the index."""
    ids = table.column("id").to_numpy()
    by = np.argsort(ids, kind="stable")
    dim = table.column("dim")[0].as_py()
    ids, labels = ids[by], table.column("label").to_numpy()[by]
    vectors = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), dim)[by]
    order, numbers, radii = build_tree(vectors, labels)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    numbers[:, CENTRE] = place[numbers[:, CENTRE]]
    return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "ids": pa.array([ids[order]], pa.list_(pa.int64())),
                     "labels": pa.array([labels[order]], pa.list_(pa.int64())), "vectors": pa.array([vectors[order].ravel()], pa.list_(pa.float64())),
                     "nodes": pa.array([numbers.ravel()], pa.list_(pa.int64())), "radii": pa.array([radii], pa.list_(pa.float64()))})


INDEX = "dim int, shard int, ids array<bigint>, labels array<bigint>, vectors array<double>, nodes array<bigint>, radii array<double>"


def build_index(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """A tree per piece of the rows (id, label, v)."""
    sized = rows.select("id", "label", "v", F.size("v").alias("dim"))
    pieces = sized.groupBy("dim").agg(F.ceil(F.count("*") / piece_rows).cast("int").alias("_n"))
    dealt = sized.join(pieces, "dim").select("id", "label", "v", "dim", F.pmod(F.xxhash64("id"), F.col("_n")).cast("int").alias("shard"))
    # a piece is much work for its bytes: as many partitions as pieces, which are not merged by size
    tasks = pieces.agg(F.sum("_n")).first()[0] or 1
    return dealt.repartition(min(int(tasks), MOST_TASKS), "dim", "shard").groupBy("dim", "shard").applyInArrow(piece_tree, INDEX)


def load_tree(batch: pa.RecordBatch, row: int) -> tuple[int, Tree]:
    dim = batch.column(batch.schema.get_field_index("dim"))[row].as_py()
    ids, labels, vectors, nodes, radii = (array_of(batch, c, row) for c in ("ids", "labels", "vectors", "nodes", "radii"))
    vectors, numbers = vectors.reshape(-1, dim), nodes.reshape(-1, 7)
    return dim, Tree(ids, labels, vectors, numbers, radii, np.ascontiguousarray(vectors[numbers[:, CENTRE]]))


def usable(rows: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """(id, label, v) of the rows that take part, one per id."""
    ok = rows.where(F.col(key).isNotNull() & F.col(label).isNotNull() & finite_vector(vector))
    one = ok.groupBy(F.col(key).cast("bigint").alias("id")).agg(F.min(F.struct(F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("v"))).alias("_m"))
    return one.select("id", "_m.label", "_m.v")


def in_tree(held, batch: pa.RecordBatch, row: int):
    """The anchors of a block that have the tree's length: (tree, ids, labels, vectors, place in the block)."""
    dim, tree = held
    ids, labels, dims, flat = (array_of(batch, c, row) for c in ("ids", "labels", "dims", "vectors"))
    mine = np.flatnonzero(dims == dim)
    vectors = flat[np.repeat(dims == dim, dims)].reshape(-1, dim)
    return tree, ids[mine], labels[mine], vectors, mine


def hard_negatives(rows: DataFrame, anchors: DataFrame, k: int = 5, positives: int = 5, low_percent: int = 80, high_percent: int = 100, key: str = "vec_id", label: str = "label",
                   vector: str = "embedding", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its best
    ``positives`` the first ``k`` rows of other labels with low_percent * positive_score <= 100 * score <= high_percent * positive_score.

    Components are whole numbers, held as doubles."""
    index = materialize(build_index(usable(rows, key, label, vector), piece_rows), "cover-trees")
    n_pieces = index.count()
    asked = usable(anchors, key, label, vector).withColumn("dim", F.size("v"))
    if n_pieces == 0:
        return asked.limit(0).select(F.col("id").alias("anchor_id"), F.col("id").alias("positive_id"), F.lit(1).alias("rank"), F.col("id").alias("negative_id"),
                                     F.col("id").alias("positive_score"), F.col("id").alias("negative_score"))
    numbered = index.select("dim", "shard").withColumn("piece", F.row_number().over(Window.orderBy("dim", "shard")) - 1)  # a row per piece
    pieces = index.join(numbered, ["dim", "shard"]).drop("shard")
    names = ["part", F.col("id").alias("ids"), F.col("label").alias("labels"), F.col("dim").alias("dims"), F.col("v").alias("vectors")]

    def nearest_same(held, batch, row):
        tree, ids, labels, vectors, _ = in_tree(held, batch, row)
        out = [(i, *tree.best(v, i, y, True, [(-LONG, LONG)], positives)[0]) for i, y, v in zip(ids.tolist(), labels.tolist(), vectors, strict=True)]
        return pairs([(i, i, a, s) for i, a, s in out], ["anchor_id", "_", "positive_id", "positive_score"])

    blocks = blocks_of(asked, ["id", "label", "dim"], ["v"], "id").select(*names)
    same = meet(pieces, blocks, n_pieces, load_tree, nearest_same, "anchor_id bigint, _ bigint, positive_id bigint, positive_score bigint")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = same.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= positives).drop("_r", "_")
    best = materialize(best, "positives")

    def windows_other(held, batch, row):
        tree, ids, labels, vectors, mine = in_tree(held, batch, row)
        counts, pos, scores = (array_of(batch, c, row) for c in ("counts", "positives", "scores"))
        ends = np.cumsum(counts)
        out = []
        for i, y, v, at in zip(ids.tolist(), labels.tolist(), vectors, mine.tolist(), strict=True):
            p, s = (x[ends[at] - counts[at]:ends[at]].tolist() for x in (pos, scores))
            wanted = [(max(-LONG, -(-low_percent * x // 100)), min(LONG, high_percent * x // 100)) for x in s]
            out += [(i, q, a, b) for q, (a, b) in zip(p, tree.best(v, i, y, False, wanted, k), strict=True)]
        return pairs(out, ["anchor_id", "positive_id", "negative_id", "negative_score"])

    each = best.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("_p"))  # at most ``positives``
    asked = asked.join(each, "id").select("id", "label", "dim", "v", F.size("_p").alias("count"), F.col("_p.positive_id").alias("p"), F.col("_p.positive_score").alias("s"))
    blocks = blocks_of(asked, ["id", "label", "dim", "count"], ["v", "p", "s"], "id").select(*names, F.col("count").alias("counts"), F.col("p").alias("positives"), F.col("s").alias("scores"))
    other = meet(pieces, blocks, n_pieces, load_tree, windows_other, "anchor_id bigint, positive_id bigint, negative_id bigint, negative_score bigint")
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = other.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.join(best, ["anchor_id", "positive_id"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def pairs(found: list, names: list[str]) -> pa.RecordBatch:
    """(a, b, ids, scores) tuples as rows."""
    counts = np.array([len(f[2]) for f in found], dtype=np.int64)
    a, b = (np.repeat(np.array([f[j] for f in found], dtype=np.int64), counts) for j in (0, 1))
    none = [np.zeros(0, np.int64)]
    ids, scores = (np.concatenate([f[j] for f in found] or none) for j in (2, 3))
    return pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in (a, b, ids, scores)], names)


def mined(embeddings: DataFrame) -> DataFrame:
    """The contract of op13: labels of ids that 7 divides moved on by one, components floor(256 x), anchors the ids that 100 divides."""
    # floor as a double: a component may be beyond a long
    whole = F.transform("embedding", lambda x: F.rint(256 * x.cast("double")) - F.when(F.rint(256 * x.cast("double")) > 256 * x.cast("double"), 1.0).otherwise(0.0))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    read = embeddings.select("vec_id", label.alias("label"), whole.alias("embedding"))
    return hard_negatives(read, read.where("vec_id % 100 = 0"))
