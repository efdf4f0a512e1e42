"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Every rule is a condition that rejects a text. On a bounded sample (``SAMPLE`` rows) each rule is
run by itself: its share of rejections and its time a row. Rules are then ordered by rejection
per cost and chained in one CASE expression, so a text that an early, cheap rule rejects never meets
the later ones. The verdict is that of all rules whatever their order; only the work depends on it.

Words are runs of non-separators (space, \\t, \\n, \\v, \\f, \\r). Repeated 3-word windows are found
inside the row: each window's 64-bit hash and position are packed into one long, the sorted longs
put equal windows side by side, and full hashes are compared; if two hashes that differ share their packed
part, the row takes the path that sorts (hash, position) pairs. Both are O(n log n) in the text's length.

Defined cases: null and empty texts have no words, fail the base rule and are not kept; texts of any length are
read whole; repeated rows get equal verdicts; other columns are not read; an empty table gives an empty one.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 2000
BLANKS = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once (a lambda's variable is not computed anew for
    every element of an inner function, as a plain expression would be)."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(BLANKS))
    none = F.array().cast("array<string>")
    return F.when(inner.isNull() | (inner == ""), none).otherwise(F.split(inner, GAP))


def word_lines(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")


def _covered(at: Column) -> Column:
    """Words under the 3-word windows that start at the sorted positions ``at``."""
    steps = F.aggregate(F.sequence(F.lit(1), F.size(at) - 1), F.lit(3),
                        lambda acc, k: acc + F.least(F.lit(3), (F.get(at, k) - F.get(at, k - 1)).cast("int")))
    return F.when(F.size(at) == 0, F.lit(0)).when(F.size(at) == 1, F.lit(3)).otherwise(steps)


def _numbers(n: Column) -> Column:
    """0 .. n - 1 (n at least 1)."""
    return F.sequence(F.lit(0), n - 1)


def _repeated_fast(h: Column, low: Column) -> Column:
    """Positions of repeated hashes, or null if two hashes differ in their low bits alone."""
    packed = F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("bigint")))

    def scan(s: Column) -> Column:
        def part(i):
            return F.get(s, i).bitwiseAND(F.bitwise_not(low))

        def hash_at(i):
            return F.get(h, F.get(s, i).bitwiseAND(low).cast("int"))

        clash = F.exists(_numbers(F.size(s)), lambda i: (part(i) == part(i + 1)) & (hash_at(i) != hash_at(i + 1)))
        same = F.filter(_numbers(F.size(s)), lambda i: F.coalesce(part(i) == part(i - 1), F.lit(False)) | F.coalesce(part(i) == part(i + 1), F.lit(False)))
        return F.when(F.coalesce(clash, F.lit(False)), F.lit(None)).otherwise(F.sort_array(F.transform(same, lambda i: F.get(s, i).bitwiseAND(low))))

    return let(F.sort_array(packed), scan)


def _repeated_exact(h: Column) -> Column:
    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.cast("bigint").alias("i"))))

    def scan(s: Column) -> Column:
        def hash_at(i):
            return F.get(s, i)["h"]

        same = F.filter(_numbers(F.size(s)), lambda i: F.coalesce(hash_at(i) == hash_at(i - 1), F.lit(False)) | F.coalesce(hash_at(i) == hash_at(i + 1), F.lit(False)))
        return F.sort_array(F.transform(same, lambda i: F.get(s, i)["i"]))

    return let(pairs, scan)


def repeat_words(w: Column) -> Column:
    """Words in 3-word windows that occur twice or more in ``w`` (a bound variable)."""
    def from_hashes(h: Column) -> Column:
        low = (F.expr("1L") * F.pow(F.lit(2), F.length(F.bin(F.size(h).cast("bigint")))).cast("bigint")) - 1
        found = let(low, lambda m: F.coalesce(_repeated_fast(h, m), _repeated_exact(h)))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(found, _covered))

    hashes = F.transform(_numbers(F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(hashes, from_hashes))


# --- measures and rules ---------------------------------------------------------------------

def base_measures(text: Column) -> Column:
    """Struct of the counts that every row returns."""
    def body(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            F.coalesce(F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")), F.lit(0)).cast("bigint").alias("n_symbols"),
            let(word_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            repeat_words(w).cast("bigint").alias("n_repeat_words"),
        )
    return let(words(text), body)


#: The rules: name -> condition under which a text is rejected, over ``text`` and the base measures.
RULES: dict[str, Callable[[], Column]] = {
    "symbols": lambda: 10 * F.col("n_symbols") > 3 * F.col("n_words"),
    "duplicate_lines": lambda: 10 * F.col("n_dup_lines") > 4 * F.size(word_lines(F.col("text"))),
    "word_length": lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")),
    "shouting": lambda: 10 * F.size(F.filter(words(F.col("text")), lambda x: (x == F.upper(x)) & (x != F.lower(x)) & (F.length(x) > 1))) > 5 * F.col("n_words"),
    "exclamations": lambda: 2 * F.length(F.regexp_replace("text", r"[^!]+", "")) > F.col("n_words"),
    "letters": lambda: 10 * F.size(F.filter(words(F.col("text")), lambda x: x.rlike(r"\p{L}"))) < 6 * F.col("n_words"),
}


def measured_order(sample: DataFrame, rules: dict[str, Callable[[], Column]]) -> list[str]:
    """Rule names by rejections per second on the sample, best first."""
    sample = sample.persist()
    try:
        n = max(1, sample.count())
        gain = {}
        for name, rule in rules.items():
            began = time.perf_counter()
            rejected = sample.agg(F.count_if(rule())).first()[0]
            gain[name] = (rejected / n) / max(1e-6, time.perf_counter() - began)
        return sorted(rules, key=lambda k: (-gain[k], k))
    finally:
        sample.unpersist()


def cascade(df: DataFrame, rules: dict[str, Callable[[], Column]], order: list[str], passes: Column | None = None) -> Column:
    """The verdict (true: kept) of the rules chained in the given order; ``passes`` must hold first."""
    out = F.when(~passes, F.lit(False)) if passes is not None else F.when(F.lit(False), F.lit(False))
    for name in order:
        out = out.when(F.coalesce(rules[name](), F.lit(True)), F.lit(False))
    return out.otherwise(F.lit(True))


def quality(docs: DataFrame, rules: dict[str, Callable[[], Column]] | None = None) -> DataFrame:
    """Contract of op2: the base measures, the base verdict and the cascade's verdict of every document."""
    rules = RULES if rules is None else rules
    texts = docs.select("doc_id", "text")
    measured = texts.withColumn("_m", base_measures(F.col("text"))).select("doc_id", "text", "_m.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    total = max(1, docs.count())
    drawn = texts.where(F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / total))).limit(2 * SAMPLE)
    sample = drawn.withColumn("_m", base_measures(F.col("text"))).select("doc_id", "text", "_m.*")
    order = measured_order(sample, rules)
    return measured.withColumn("base_failed", failed).withColumn("kept", cascade(measured, rules, order, ~F.col("base_failed"))).drop("text")


ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
p AS (SELECT doc_id, unnest(words) AS a, unnest(range(len(words))) AS i FROM w),
g AS (SELECT doc_id, i, a, lead(a) OVER d AS b, lead(a, 2) OVER d AS c FROM p WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS k FROM g WHERE c IS NOT NULL),
t AS (SELECT doc_id, count(DISTINCT i + s) AS n FROM r, (SELECT unnest([0, 1, 2]) AS s) WHERE k >= 2 GROUP BY doc_id),
m AS (
  SELECT w.doc_id, text, words, lines, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(t.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN t ON w.doc_id = t.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 10 * n_dup_lines > 4 * len(lines)
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 10 * len(list_filter(words, lambda x: x = upper(x) AND x <> lower(x) AND length(x) > 1)) > 5 * n_words
            OR 2 * length(regexp_replace(text, '[^!]+', '', 'g')) > n_words
            OR 10 * len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) < 6 * n_words) AS kept
FROM f
"""
