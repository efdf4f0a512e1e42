"""op11 and op13 against brute force: whole sf tables, awkward vectors, ties, copies of a third of the rows."""

import math

import numpy as np
import pytest
from llm_data import SF
from pyspark.sql import functions as F

from tidemark.llm import cover_tree, small_world
from tidemark.sources.tables import read_table

SF_LARGER = "/root/testdata/sf0.01"
VECTORS = "vec_id bigint, embedding array<float>, label int, score double, rank string, node int"


def usable(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)


def plain_nearest(rows, k=5):
    rows = {i: np.array(v, dtype=np.float64) for i, v in rows if i is not None and usable(v) and any(v)}
    out = {}
    for q, a in rows.items():
        if q % 50 == 0:
            scored = [(float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b))), i) for i, b in rows.items() if i != q and len(a) == len(b)]
            out[q] = sorted(scored, key=lambda s: (-round(s[0], 12), s[1]))[:k]
    return out


def plain_negatives(rows):
    kept = {}
    for i, v, label in rows:
        if i is not None and label is not None and usable(v):
            kept[i] = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v])
    out = set()
    for q, (label, a) in kept.items():
        if q % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i, lab) for i, (lab, b) in kept.items() if i != q and len(a) == len(b))
        for p, i, lab in [s for s in scored if s[2] == label][:5]:
            inside = [(s, j) for s, j, other in scored if other != label and 80 * -p <= 100 * -s <= 100 * -p][:5]
            out |= {(q, i, r + 1, j, -p, -s) for r, (s, j) in enumerate(inside)}
    return out


def spiky(n=700, hot=300, dim=12, seed=5):
    """Vectors in a few clusters, one of them the same vector for many rows; ties between ids."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, dim))
    rows = [(int(i), [float(np.float32(x)) for x in centres[i % 6] + 0.3 * r.normal(size=dim)], int(r.integers(0, 10))) for i in range(n)]
    same = [0.5] * dim
    return rows + [(n + i, same, i % 10) for i in range(hot)]


def odd_rows():
    nan, inf = float("nan"), float("inf")
    base = [0.25, -0.5, 0.125]
    return [(0, base, 1), (50, None, 1), (100, [], 2), (150, [0.0, 0.0, 0.0], 1), (200, [1.0, None, 2.0], 1), (250, [1.0, nan, 2.0], 1), (300, [inf, 1.0, 1.0], 1), (None, base, 1), (350, base, None),
            (400, base, 1), (7, base, 1), (1, [0.5, -1.0, 0.25], 1), (2, [-0.25, 0.5, -0.125], 2), (3, [0.25, -0.5, 0.1259765625], 2), (4, [1.0, 2.0], 1), (500, [1.0, 1.0], 1), (5, [1.0, 3.0], 2), (0, base, 1)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, 0.5, "x", 1) for i, v, y in rows], VECTORS)


def recall(got, want):
    ids = {}
    for r in got:
        ids.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(ids) == {q for q, w in want.items() if w}
    hit = total = 0
    for q, found in ids.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, len(want[q]) + 1))
        assert [(-round(s, 12), i) for _, i, s in found] == sorted((-round(s, 12), i) for _, i, s in found)
        truth = {i: s for s, i in want[q]}
        hit += sum(i in truth for _, i, _ in found)
        total += len(truth)
        for _, i, s in found:
            assert i not in truth or abs(truth[i] - s) < 1e-12
    return hit / max(1, total)


@pytest.mark.parametrize("sf", [SF, SF_LARGER])
def test_nearest_of_whole_tables(spark, sf):
    table = read_table(spark, sf, "embeddings")
    want = plain_nearest([(r["vec_id"], r["embedding"]) for r in table.collect()])
    assert recall(small_world.five_nearest(table).collect(), want) >= 0.98


def test_nearest_with_many_copies_and_shards(spark):
    rows = spiky()
    table = frame(spark, rows)
    out = small_world.nearest_neighbours(table, table.where("vec_id % 50 = 0"), 5, shard_rows=150)
    assert recall(out.withColumnRenamed("id", "vec_id").collect(), plain_nearest([r[:2] for r in rows])) >= 0.98
    copies = out.where("query_id = 750").orderBy("rank").collect()
    assert [r["id"] for r in copies] == [700, 701, 702, 703, 704]


def test_nearest_of_odd_vectors(spark):
    got = small_world.five_nearest(frame(spark, odd_rows())).collect()
    assert recall(got, plain_nearest([r[:2] for r in odd_rows()])) == 1.0
    assert small_world.five_nearest(frame(spark, [])).collect() == []
    assert small_world.five_nearest(frame(spark, [(50, [1.0], 1)])).collect() == []


def test_graph_recall_and_slots():
    r = np.random.default_rng(2)
    vectors = small_world.unit(r.normal(size=(3000, 24)))
    order, sizes, slots = small_world.build(np.arange(3000), vectors)
    points = vectors[order]
    assert sizes[0] == 3000 and [len(s) for s in slots] == sizes.tolist()
    for s in slots:
        held = [x[x >= 0] for x in s]
        assert all(len(set(x.tolist())) == len(x) for x in held) and all((x != i).all() for i, x in enumerate(held))
    found = small_world.search(points, slots, points[::10])[:, :6]
    truth = np.argsort(-(points[::10] @ points.T), axis=1)[:, :6]
    assert np.mean([len(set(a) & set(b)) / 6 for a, b in zip(found, truth, strict=True)]) >= 0.98


NEGATIVES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("sf", [SF, SF_LARGER])
def test_negatives_of_whole_tables(spark, sf):
    table = read_table(spark, sf, "embeddings")
    want = plain_negatives([(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()])
    got = cover_tree.mined(table).select(*NEGATIVES).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_negatives_with_many_copies_and_pieces(spark):
    rows = spiky(seed=6)
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double"))
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    table = frame(spark, rows).select("vec_id", label.alias("label"), whole.alias("embedding"))
    out = cover_tree.hard_negatives(table, table.where("vec_id % 100 = 0"), piece_rows=150)
    assert {tuple(r) for r in out.select(*NEGATIVES).collect()} == plain_negatives(rows) != set()


def test_negatives_of_odd_vectors(spark):
    got = cover_tree.mined(frame(spark, odd_rows())).select(*NEGATIVES).collect()
    assert {tuple(r) for r in got} == plain_negatives(odd_rows())
    assert cover_tree.mined(frame(spark, [])).collect() == []


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(100, [2.0**30 + 1, 3.0], 1), (1, [2.0**30 + 1, 5.0], 1), (2, [2.0**30 + 1, 4.0], 2), (3, [2.0**30 - 1, 4.0], 2)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = cover_tree.hard_negatives(table, table.where("vec_id = 100")).orderBy("rank").collect()
    dot = lambda a, b: sum(int(x) * int(y) for x, y in zip(a, b, strict=True))
    assert [(r["negative_id"], r["positive_score"], r["negative_score"]) for r in got] == [(i, dot(rows[0][1], rows[1][1]), dot(rows[0][1], rows[i][1])) for i in (2, 3)]


def test_tree_covers_its_rows():
    r = np.random.default_rng(3)
    vectors = np.floor(50 * r.normal(size=(2000, 8)))
    vectors[500:900] = vectors[500]
    order, numbers, radii = cover_tree.build_tree(vectors, r.integers(0, 4, 2000))
    points, _ = cover_tree.augmented(vectors)
    assert sorted(order.tolist()) == list(range(2000))
    for node, radius in zip(numbers.tolist(), radii.tolist(), strict=True):
        rows = order[node[cover_tree.ROW]:node[cover_tree.ROW] + node[cover_tree.ROWS]]
        assert rows[0] == node[cover_tree.CENTRE] and cover_tree.distances(points[rows], points[rows[0]]).max() <= radius + 1e-9
        if node[cover_tree.CHILDREN]:
            below = numbers[node[cover_tree.CHILD]:node[cover_tree.CHILD] + node[cover_tree.CHILDREN]]
            assert below[:, cover_tree.ROWS].sum() == node[cover_tree.ROWS] and node[cover_tree.CHILDREN] >= 2
