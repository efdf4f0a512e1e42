"""Secret scanning with a random forest for false-positive removal, in DataFrame expressions only.

A word of at least ``SHORTEST`` characters is a finding if it has a digit, holds one of ``KNOWN_FORMATS``,
or is assigned to a secret's name (``name=value``, ``"name":"value"``, ``name = value``, ``name: value``), whatever its letters.
Private-key blocks are findings up to their END line; without one, over the header fields and key lines that follow.
A finding's value is the word without its wrapping, and without the name before ``=`` or ``:``.
Features: length; shares of digits, capitals and signs; changes between letters, digits and signs;
distinct characters; runs of pairs usual in words; dictionary coverage (frequent words of the corpus);
path parts; and names in the value's own assignment or in the two words before it and the one after.

The forest (Spark ML, a fixed seed) is trained on labelled findings, a bounded sample of ``SAMPLE``.
``scan`` takes them from the caller; where there are none, ``weak_labels`` labels the
findings whose format or naming leaves no doubt (see there), and the rest is for the forest to judge.
What has a provider's format or is a key block (``certain``) stays whatever the forest says.
Its trees become one expression, so findings are scored inside their row: nothing is exploded,
shuffled or joined to scan or to redact, whatever one document or source holds.

Defined cases: null and empty texts have no finding; a value found several times is a finding each
time; without labels of both kinds the weak labels decide alone; documents of any length are read whole; repeated
rows and repeated ids are scanned each by itself; a score of exactly 0.5 stays; an empty table gives no row;
``scan`` ignores extra columns, ``redact`` passes them through whatever their names. Values under ``SHORTEST``
characters, and plain words under a secret's name ("key: understanding"), are left in the text.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize
from tidemark.llm.quality_rules import let, words

SHORTEST = 8
SAMPLE = 4000
TREES = 15
DEPTH = 5
DICTIONARY = 400
#: A name and the value assigned to it, in one word.
ASSIGNED = r"^([A-Za-z_.-]{2,40})[\"']?[=:](?!//)[\"']?(.+)$"
WRAP = "\"'`.,;:!?()[]{}<>"
#: Names that announce a secret, and words that announce something else.
NAMES = r"(?i)(passw|pwd|secret|token|api|auth|cred|private|access|key)"
NAMED = NAMES + r"[A-Za-z_.-]*[\"']?[=:](?!//)."
HARMLESS = r"(?i)(example|sample|dummy|test|placeholder|sha|md5|commit|checksum|digest|uuid|version|card|phone|mail)"
#: Up to the END line (header fields hold single dashes), or the header fields and key lines after a BEGIN that has none.
KEY_BLOCK = (r"-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----(?:[^-]+(?:-{1,4}[^-]+){0,40}-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
             r"|(?:\s+(?:[A-Za-z-]+: \S+|[A-Za-z0-9+/=]{16,})){1,400})")
#: Formats that providers give their keys.
KNOWN_FORMATS = (r"^AKIA[0-9A-Z]{16}$", r"^gh[pousr]_[A-Za-z0-9]{36,}$", r"^xox[abprs]-[A-Za-z0-9-]{10,}$", r"^sk_(live|test)_[A-Za-z0-9]{16,}$",
                 r"^AIza[A-Za-z0-9_-]{35}$", r"^eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+$")
#: What makes a word a finding by itself: a digit, or a key format, which can do without one.
HINT = "|".join(["[0-9]", *(p.strip("^$") for p in KNOWN_FORMATS)])
#: A value under a secret's name without a digit: surely a password, or surely a plain word.
STRONG = (r"[a-z]", r"[A-Z]", r"[!#$%&*+=?^~]")
PLAIN = r"^\p{L}[\p{Ll}'_-]*$"
HARMLESS_FORMATS = (r"^[^@\s]+@[^@\s]+\.[A-Za-z]+$", r"^[0-9.,:/+()-]+$", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"^[a-z]+://")


def findings(text: Column) -> Column:
    """Array of (at, name, value, before, after) of a text's findings."""
    def of_words(w: Column) -> Column:
        def hinted(i: Column) -> Column:
            last = F.get(w, i - 1)
            under = (last.endswith("=") | last.endswith(":")) & F.concat_ws(" ", F.get(w, i - 2), last).rlike(NAMES)
            return (F.length(F.get(w, i)) >= SHORTEST) & (F.get(w, i).rlike(HINT) | F.get(w, i).rlike(NAMED) | F.coalesce(under, F.lit(False)))

        at = F.filter(F.sequence(F.lit(0), F.size(w) - 1), hinted)

        def one(i: Column) -> Column:
            bare = F.btrim(F.get(w, i), F.lit(WRAP))
            assigned = F.regexp_extract(bare, ASSIGNED, 2)
            return F.struct(
                i.cast("bigint").alias("at"), F.regexp_extract(bare, ASSIGNED, 1).alias("name"),
                F.btrim(F.when(assigned == "", bare).otherwise(assigned), F.lit(WRAP)).alias("value"),
                F.concat_ws(" ", F.get(w, i - 2), F.get(w, i - 1)).alias("before"), F.coalesce(F.get(w, i + 1), F.lit("")).alias("after"))

        return F.filter(F.transform(at, one), lambda x: F.length(x["value"]) >= SHORTEST)

    kind = "array<struct<at:bigint,name:string,value:string,before:string,after:string>>"
    blocks = F.transform(F.regexp_extract_all(text, F.lit(KEY_BLOCK), F.lit(0)), lambda v: F.struct(
        F.lit(-1).cast("bigint").alias("at"), F.lit("private key").alias("name"), v.alias("value"), F.lit("").alias("before"), F.lit("").alias("after")))
    none = F.array().cast(kind)
    found = F.when(F.coalesce(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit("")) == "", none).otherwise(let(words(text), of_words).cast(kind))
    return F.concat(found, F.when(F.coalesce(F.contains(text, F.lit("PRIVATE KEY")), F.lit(False)), blocks.cast(kind)).otherwise(none))


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The most frequent plain words of five letters and more, over all documents."""
    w = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\b[\p{L}]{5,}\b"), F.lit(0))).alias("word"))
    top = w.groupBy("word").count().orderBy(F.desc("count"), "word").limit(size).collect()
    return [r["word"] for r in top]


FEATURES = ("length", "digits", "capitals", "signs", "changes", "distinct", "pairs", "covered", "path", "own_name", "named", "harmless", "assigned")


def features(f: Column, known: list[str]) -> list[Column]:
    """The features of a finding (a struct), as doubles in the order of ``FEATURES``."""
    v = f["value"]
    n = F.length(v)

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(v, pattern, "")) / n

    entries = "|".join(re.escape(w) for w in sorted(known, key=lambda x: (-len(x), x))) or "(?!)"
    return [x.cast("double") for x in (
        n, share("[^0-9]"), share("[^A-Z]"), share("[A-Za-z0-9]"),
        F.regexp_count(v, F.lit(r"(?<=[A-Za-z])[^A-Za-z]|(?<=[0-9])[^0-9]|(?<=[^A-Za-z0-9])[A-Za-z0-9]")) / n,
        F.size(F.array_distinct(F.split(v, ""))) / F.least(n, F.lit(16)),
        F.regexp_count(F.lower(v), F.lit(r"(?=(th|he|in|er|an|re|on|en|at|or|es|st|de|le|ch|ie|la|ti|ed|ou))")) / n,
        1 - F.length(F.regexp_replace(F.lower(v), entries, "")) / n,
        F.regexp_count(v, F.lit(r"[/\\@.]")) / n,
        f["name"].rlike(NAMES).cast("int"), f["before"].rlike(NAMES).cast("int"),
        F.concat_ws(" ", f["name"], f["before"], f["after"]).rlike(HARMLESS).cast("int"),
        ((f["name"] != "") | f["before"].rlike("[=:]$")).cast("int"))]


def certain(f: Column) -> Column:
    """Whether a finding has a provider's key format or is a private-key block."""
    return reduce(lambda a, b: a | b, [f["value"].rlike(p) for p in KNOWN_FORMATS]) | (f["name"] == "private key")


def weak_labels(f: Column) -> Column:
    """1 or 0 where a finding's format or naming leaves no doubt, else null.

    1: a provider's key format, a private-key block, or, under a secret's name, a value of digits and letters or of
    small letters, capitals and signs.
    0: mail addresses, addresses, numbers, dates, uuids, anything announced as an example or checksum, or a plain word.
    """
    v = f["value"]
    harmless = reduce(lambda a, b: a | b, [v.rlike(p) for p in HARMLESS_FORMATS]) | f["before"].rlike(HARMLESS)
    under = f["name"].rlike(NAMES) | (f["before"].rlike(NAMES) & f["before"].rlike("[=:]$"))
    named = under & v.rlike("[0-9]") & v.rlike("[A-Za-z]") & ~v.rlike("[@/]")
    strong = under & reduce(lambda a, b: a & b, [v.rlike(p) for p in STRONG])
    return F.when(certain(f), 1).when(harmless, 0).when(named | strong, 1).when(under & v.rlike(PLAIN), 0)


# --- the forest -----------------------------------------------------------------------------

def train(labelled: DataFrame, known: list[str]) -> str | None:
    """A forest from (finding, label) rows, as its printed trees; null without labels of both kinds."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    rows = labelled.where("label is not null").select(array_to_vector(F.array(*features(F.col("finding"), known))).alias("features"), F.col("label").cast("double").alias("label"),
                                                      F.xxhash64("finding").alias("order"))
    parts = [rows.where(F.col("label") == y).orderBy("order").limit(SAMPLE // 2) for y in (0, 1)]
    rows = parts[0].unionAll(parts[1]).coalesce(1).persist()  # at most SAMPLE rows, in one order
    try:
        if rows.select("label").distinct().count() < 2:
            return None
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, featureSubsetStrategy="sqrt").fit(rows.drop("order"))
        return forest.toDebugString
    finally:
        rows.unpersist()


def forest_score(printed: str, values: list[Column]) -> Column:
    """The share of trees that say 1, from the trees as Spark ML prints them."""
    trees: list[list[str]] = []
    for line in printed.splitlines()[1:]:
        if line.strip().startswith("Tree "):
            trees.append([])
        elif line.strip():
            trees[-1].append(line.strip())

    def read(lines: list[str]) -> Column:
        head = lines.pop(0)
        if head.startswith("Predict:"):
            return F.lit(float(head.split()[1]))
        k, bound = re.match(r"If \(feature (\d+) <= (\S+)\)", head).groups()
        low = read(lines)
        lines.pop(0)  # the Else of the same split
        return F.when(values[int(k)] <= float(bound), low).otherwise(read(lines))

    return reduce(lambda a, b: a + b, [read(t) for t in trees]) / len(trees)


class Scanner:
    """Trained on (finding, label); gives scored findings and redacted texts as expressions."""

    def __init__(self, docs: DataFrame, labelled: DataFrame | None = None):
        self.known = dictionary(docs)
        if labelled is None:
            found = docs.select(F.explode(findings(F.col("text"))).alias("finding"))
            labelled = materialize(found.withColumn("label", weak_labels(F.col("finding"))).where("label is not null"), "findings")
        self.printed = train(labelled, self.known)

    def score(self, f: Column) -> Column:
        if self.printed is None:
            return F.coalesce(weak_labels(f), F.lit(0)).cast("double")
        judged = let(F.array(*features(f, self.known)), lambda v: forest_score(self.printed, [F.get(v, F.lit(i)) for i in range(len(FEATURES))]))
        return F.when(certain(f), 1.0).otherwise(judged)

    def secrets(self, text: Column) -> Column:
        """Array of (at, name, value, score) of the findings that stay."""
        scored = F.transform(findings(text), lambda f: F.struct(f["at"].alias("at"), f["name"].alias("name"), f["value"].alias("value"), self.score(f).alias("score")))
        return F.filter(scored, lambda x: x["score"] >= 0.5)

    def redacted(self, text: Column, mark: str = "[SECRET]") -> Column:
        """The text with every secret's value replaced, longest values first."""
        values = F.sort_array(F.transform(F.array_distinct(F.transform(self.secrets(text), lambda s: s["value"])), lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v"))))
        return F.aggregate(values, text, lambda acc, x: F.replace(acc, x["v"], F.lit(mark)))


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """One row per secret that stays: (doc_id, at, kind, n_chars, value_sha256, score); values are not shown."""
    scanner = Scanner(docs, labelled)
    found = docs.select("doc_id", F.explode(scanner.secrets(F.col("text"))).alias("s"))
    return found.select("doc_id", F.col("s.at").alias("at"), F.col("s.name").alias("kind"), F.length("s.value").cast("bigint").alias("n_chars"),
                        F.sha2(F.col("s.value").cast("binary"), 256).alias("value_sha256"), F.round("s.score", 6).alias("score"))


def redact(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` with secrets replaced in ``text``; all rows and columns stay."""
    scanner = Scanner(docs, labelled)
    return docs.withColumn("text", scanner.redacted(F.col("text")))
