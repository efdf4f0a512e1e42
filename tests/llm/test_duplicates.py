"""op9, op10 and op5 against brute force."""

import itertools
import random
import re

import numpy as np
import pytest
from llm_data import awkward, empty, prose

from tidemark.llm import decontaminate, jaccard_join, substring_dedup
from tidemark.llm.components import connected_components


def near(text: str, seed: int, edits: int) -> str:
    r = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)


def plain_components(rows, percent=80):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or ""))
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in w]
        sets.append((i, frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    up = {i: i for i, _ in sets if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((top(i), top(j)))
                up[y] = x
    return sorted((i if i is not None else -1, len(s), top(i) if i is not None else -1) for i, s in sets)


def cluster_rows():
    r = random.Random(8)
    passage = prose(77, 60)
    rows, i = [], 0
    for g in range(12):
        text = prose(100 + g, r.choice([12, 40, 150, 400]))
        for k in range(r.choice([1, 2, 5, 30])):
            rows.append((i, near(text, i, k % 4) if k else text))
            i += 1
    for g in range(60):  # a passage that many different documents share
        rows.append((i, passage + " " + prose(500 + g, r.choice([10, 14, 60]))))
        i += 1
    for _ in range(40):  # exact copies
        rows.append((i, rows[3][1]))
        i += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("tile", [2048, 8])
def test_components_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard_join, "TILE", tile)  # 8: tiles are cut into blocks
    rows = cluster_rows() + [(None, None), (None, "x y"), (9001, ""), (9002, None), (9003, "A b"), (9004, "a B")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r[0] if r[0] is not None else -1, r[1], r[2] if r[2] is not None else -1) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == plain_components(rows)


def test_jaccard_awkward(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted((r[0] if r[0] is not None else -1, r[1], r[2] if r[2] is not None else -1) for r in jaccard_join.jaccard_components(docs).collect())
    assert [g[:2] for g in got] == [g[:2] for g in plain_components(rows)]
    assert {g for g in got if g[0] >= 0} == {g for g in plain_components(rows) if g[0] >= 0}
    assert jaccard_join.jaccard_components(empty(spark)).count() == 0


def test_bound_never_rejects_a_link():
    r = np.random.default_rng(4)
    for _ in range(300):
        n = int(r.integers(1, 400))
        a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([r.choice(a, max(1, int(len(a) * r.uniform(0.7, 1))), replace=False), r.integers(0, 1 << 63, int(n * r.uniform(0, 0.3))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert jaccard_join.signatures_may_link(np.array([len(a)]), np.array([len(b)]), [jaccard_join.bitmap(a).tobytes()], [jaccard_join.bitmap(b).tobytes()], 80)[0]


def test_connected_components(spark):
    r = random.Random(1)
    edges = [(i, i - 1) for i in range(1, 40)] + [(100 + r.randrange(60), 100 + r.randrange(60)) for _ in range(50)] + [(500, i) for i in range(501, 560)] + [(7, 7), (None, 3)]
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((top(a), top(b)))
            up[y] = x
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: top(x) for x in up}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_compact_windows_are_the_trees_wide_nodes():
    r = np.random.default_rng(3)
    for n in (0, 5, 45, 46, 47, 300):
        v = r.permutation(n).astype(np.uint64) << np.uint64(40)
        value, lo, c, hi = substring_dedup.compact_windows(v)
        want = []
        for k in range(n):
            a, b = k, k
            while a > 0 and v[a - 1] > v[k]:
                a -= 1
            while b < n - 1 and v[b + 1] > v[k]:
                b += 1
            if b - a + 1 >= substring_dedup.WIDTH:
                want.append((int(v[k]), a, k, b))
        assert sorted(zip(value.tolist(), lo.tolist(), c.tolist(), hi.tolist(), strict=True)) == sorted(want)


def test_repeated_passages(spark):
    shared, other = prose(1, 60), prose(2, 90)
    rows = [(i, prose(50 + i, 80)) for i in range(20)]  # clean
    rows += [(100 + i, prose(200 + i, 30 + i) + " " + shared + " " + prose(300 + i, 40)) for i in range(15)]
    rows += [(200, other), (201, prose(9, 100) + " " + near(other, 4, 1)), (202, other), (203, other)]
    rows += [(300, prose(400, 30) + " " + " ".join(shared.split()[:40]))]  # too short a passage
    rows += [(None, shared), (301, None), (302, "")]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    ids = {r["doc_id"] for r in got} | {r["other_id"] for r in got}
    assert ids == {*range(100, 115), 200, 201, 202, 203}
    words = {i: t.split() for i, t in rows if t}
    for r in got:
        a = words[r["doc_id"]][r["start"]:r["start"] + r["n_words"]]
        b = words[r["other_id"]][r["other_start"]:r["other_start"] + r["n_words"]]
        assert r["n_words"] >= 50 and r["similarity"] >= 0.8 and sum(x == y for x, y in zip(a, b, strict=True)) >= 0.9 * len(a)
    assert substring_dedup.repeated_passages(empty(spark)).count() == 0
    assert substring_dedup.repeated_passages(awkward(spark)).count() > 0


def test_spaced_seeds_find_substituted_passages(spark):
    bench = [(i, prose(1000 + i, n)) for i, n in enumerate([8, 9, 15, 20, 30, 45, 60])] + [(7, None), (8, ""), (None, prose(1008, 20)), (9, "too short")]
    r = random.Random(6)
    docs, want = [], set()
    for d in range(120):
        item, text = bench[d % 7]
        words = text.split()
        if len(words) >= 15:
            for k in range(r.choice([0, 0, 1, 2]) * len(words) // 15):
                words[(k * 13 + d) % len(words)] = "changed"
        host = prose(5000 + d, r.randint(0, 80)).split()
        at = r.randint(0, len(host))
        docs.append((d, " ".join([*host[:at], " ".join(words).upper() + ",", *host[at:]])))
        want.add((d, item))
    docs += [(500 + d, prose(9000 + d, 100)) for d in range(60)] + [(None, None), (900, ""), (901, None)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    test = spark.createDataFrame(bench, "item_id bigint, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.contaminated(frame, test).collect()}
    assert got == want
    kept = {x["doc_id"] for x in decontaminate.clean(frame, test).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}
    assert decontaminate.contaminated(empty(spark), test).count() == 0 == decontaminate.contaminated(frame, empty(spark).select("text", "n").toDF("text", "item_id")).count()


def test_benchmark_blocks_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i % 9, 60)) for i in range(30)], "doc_id bigint, text string")
    test = spark.createDataFrame([(i, " ".join(prose(i, 60).split()[10:40])) for i in range(6)], "item_id bigint, text string")
    whole = sorted(map(tuple, decontaminate.contaminated(docs, test).collect()))
    monkeypatch.setattr(decontaminate.blocks_of, "__defaults__", (50,))
    assert sorted(map(tuple, decontaminate.contaminated(docs, test).collect())) == whole and len(whole) >= 20


def test_short_benchmark_texts_match_as_whole_lines(spark):
    items = [(1, "What is the capital of France?"), (2, "yes"), (None, "Two plus two is four"), (3, "天気が良い"), (4, "yes"), (5, None), (6, " ")]
    test = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [(1, "intro line\n  what is the capital of france\nend"), (2, "he said yes to it"), (3, "YES!"), (None, "two plus two is four."), (None, "clean text"), (4, ""), (5, None),
            (6, "a\nyes\nb\nyes"), (7, "天気が良い。"), (8, "今日は天気が良いので"), (3, "YES!"), (3, "a clean one under the same id")]
    docs = spark.createDataFrame([(*x, 7) for x in rows], "doc_id bigint, text string, item_id bigint")
    got = sorted(map(tuple, decontaminate.contaminated(docs, test).collect()), key=str)
    want = [(1, 1, 2, 6, 6), (3, 2, 0, 1, 1), (3, 4, 0, 1, 1), (3, 2, 0, 1, 1), (3, 4, 0, 1, 1), (None, None, 0, 5, 5), (6, 2, 1, 1, 1), (6, 4, 1, 1, 1), (7, 3, 0, 5, 5)]
    assert got == sorted(want, key=str)
    kept = decontaminate.clean(docs, test)
    assert kept.columns == docs.columns
    assert sorted((r["text"] or "" for r in kept.collect())) == sorted(["he said yes to it", "clean text", "", "", "今日は天気が良いので", "a clean one under the same id"])


def edited(words: list[str], kind: str, at: int) -> list[str]:
    return {"insert": words[:at] + ["inserted"] + words[at:], "delete": words[:at] + words[at + 1:], "change": words[:at] + ["changed"] + words[at + 1:]}[kind]


@pytest.mark.parametrize("kind", ["insert", "delete", "change"])
def test_stretches_equal_brute_force_with_edits(kind):
    """Some window of WIDTH shingles on one side and of WIDTH to WIDTH + 11 on the other reaches the similarity."""
    r = random.Random(17)
    seen = {True: 0, False: 0}
    for trial, n in enumerate([50, 51, 60, 70, 88] * 6):
        shared = [f"w{trial}x{k}" for k in range(n)]
        other = shared
        for _ in range(r.choice([1, 1, 2, 3])):
            other = edited(other, kind, len(other) // 2 if trial < 5 else r.randrange(len(other)))
        texts = [" ".join([f"{side}{k}" for k in range(r.randint(0, 30))] + w + [f"{side}z{k}" for k in range(r.randint(6, 30))]) for side, w in (("a", shared), ("b", other))]
        x, y = (substring_dedup.positions(t) for t in texts)
        want = False
        for i in range(len(x) - substring_dedup.WIDTH + 1):
            w = set(x[i:i + substring_dedup.WIDTH].tolist())
            for size in range(substring_dedup.WIDTH, substring_dedup.WIDTH + 12):
                for j in range(len(y) - size + 1):
                    both = len(w & set(y[j:j + size].tolist()))
                    want = want or 180 * both >= 80 * (len(w) + size)
        at = {v: k for k, v in enumerate(y.tolist())}
        shift = next((k - at[v] for k, v in enumerate(x.tolist()) if v in at), 0)
        got = substring_dedup.stretches(x, y, shift - substring_dedup.NEAR, shift + substring_dedup.NEAR)
        assert bool(got) == want
        seen[want] += 1
        for a, k, same, b, m in got:
            both = len(set(x[a:a + k].tolist()) & set(y[b:b + m].tolist()))
            assert k >= substring_dedup.WIDTH <= m and both >= 0.8 * (k + m - both) - 1
    assert seen[True] >= 5


def test_passages_with_an_inserted_word(spark):
    rows = []
    for k in range(20):
        words = prose(700 + k, 50 + 2 * k).split()
        rows += [(2 * k, " ".join([prose(800 + k, 40), *words, prose(830 + k, 40)])),
                 (2 * k + 1, " ".join([prose(860 + k, 30), *edited(words, "insert" if k % 2 else "delete", len(words) // 2), prose(890 + k, 50)]))]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"] // 2 for r in got} == {r["other_id"] // 2 for r in got} and len({r["doc_id"] // 2 for r in got}) >= 18
    assert max(r["n_words"] for r in got) > 80  # whole, not its longer half


def test_passages_of_a_group_of_near_copies(spark):
    """One original; every other document changes one word of its own, so most pairs of changed ones are no passages."""
    rows = []
    for g in range(12):
        words = prose(2000 + g, 50).split()
        for k in range(9):
            own = words if k == 1 else edited(words, "change", [6, 0, 11, 16, 21, 26, 31, 36, 41][k])
            rows.append((100 * g + k, " ".join([prose(3000 + 100 * g + k, 30 + k), *own, prose(4000 + 100 * g + k, 30)])))
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    ids = {r["doc_id"] for r in got} | {r["other_id"] for r in got}
    assert len(ids) >= 0.95 * len(rows)
    words = {i: t.split() for i, t in rows}
    for r in got:
        assert sum(x == y for x, y in zip(words[r["doc_id"]][r["start"]:], words[r["other_id"]][r["other_start"]:][:r["n_words"]], strict=False)) >= 0.9 * r["n_words"] - 1


def test_passages_in_lines_of_many_documents(spark, monkeypatch):
    """Every line of the shared passages stands in many documents, in other company."""
    lines = [prose(5000 + k, 12) for k in range(24)]
    r = random.Random(8)
    rows = [(k, "\n".join(r.sample(lines, 12))) for k in range(150)]
    want = set()
    for k in range(10):
        shared = r.sample(lines, 6)
        for d in (1000 + 2 * k, 1001 + 2 * k):
            rows.append((d, "\n".join([prose(6000 + d, 30), *shared, prose(7000 + d, 30)])))
            want.add(d)
    for tile in (2048, 16):
        monkeypatch.setattr(substring_dedup, "TILE", tile)
        got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert want <= {x["doc_id"] for x in got} | {x["other_id"] for x in got}


@pytest.mark.parametrize("n", range(8, 26))
def test_every_accepted_stretch_has_a_seed(n):
    """A benchmark text of n words: all places of substitutions that verify() accepts in a window are hit."""
    words = [f"w{k}" for k in range(n)]
    bench = decontaminate.Benchmark([(1, " ".join(words))])
    need = min(decontaminate.LEAST, n)
    lost = need - -(-need * decontaminate.PERCENT // 100)
    for begin in range(n - need + 1):
        for places in itertools.combinations(range(begin, begin + need), lost):
            own = [w if begin <= k < begin + need and k not in places else "other" for k, w in enumerate(words)]
            ids = np.array([bench.number.get(w, 0) for w in own] + [0] * decontaminate.SPAN, dtype=np.int64)
            found = bench.hits(ids, np.array([0, len(ids)], dtype=np.int64)).T.tolist()
            assert any(bench.verify(ids, 0, n, item, shift) for _, item, shift in found), (begin, places)


def test_unspaced_scripts_are_cut_into_characters(spark):
    passage = "今日は天気が良いので散歩に行きましょう"
    test = spark.createDataFrame([(1, passage), (2, "ในน้ำมีปลาในนามีข้าว")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "前文。" + passage + "。後文"), (2, "別の文章です"), (3, "xx ในน้ำมีปลาในนามีข้าว")], "doc_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, test).collect()} == {(1, 1), (3, 2)}


def test_no_exact_repeat_on_a_candidate_diagonal_is_lost():
    """Texts that share many blocks, damaged between them: every window that both hold word for word is touched by a passage."""
    r = np.random.default_rng(0)
    whole = 0
    for _ in range(150):
        n = int(r.integers(100, 400))
        x = r.integers(0, 2**32, n, dtype=np.uint32)
        y = x.copy()
        for _ in range(int(r.integers(1, 8))):
            at = int(r.integers(0, n))
            y[at:at + int(r.integers(1, 25))] = r.integers(0, 2**32)
        got = substring_dedup.passages(x, y, [(-16, 16)])
        spans = sorted((s, s + m) for s, m, *_ in got)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False)) and all(e - s >= substring_dedup.WIDTH for s, e in spans)
        covered = np.zeros(n, dtype=bool)
        for s, e in spans:
            covered[s:e] = True
        for at in range(n - substring_dedup.WIDTH + 1):
            if (x[at:at + substring_dedup.WIDTH] == y[at:at + substring_dedup.WIDTH]).all():
                whole += 1
                assert covered[at:at + substring_dedup.WIDTH].any()
    assert whole > 5000
