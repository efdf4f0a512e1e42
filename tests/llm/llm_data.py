"""Small tables for the training-data operators: every awkward case the docstrings define."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, score double, ids string, n bigint"
SF = "/root/testdata/sf0.001"


def prose(seed: int, n: int, syllables: str = "th er on an re in ti he ou st ea nd") -> str:
    r = random.Random(seed)
    parts = syllables.split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(n))


def awkward(spark):
    """Nulls in every column, empty and blank texts, a very long text, ties, repeated rows, clashing names."""
    base = prose(1, 120)
    texts = [None, "", " \n\t ", "a", "one two three", base, base, base + " tail", base.replace(" ", "\n", 3), prose(2, 20_000),
             "<|endoftext|> x", "日本語 テスト", "1234 5678", prose(3, 200)]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", None, 1, 0.5, "x", 9) for i, t in enumerate(texts)]
    rows += [rows[5], (None, base, "en", "s", 1, 1, 0.5, "x", 9), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
