"""Language identification with string kernels.

The kernel is the blended-spectrum presence kernel: two texts are compared by how many
distinct character n-grams of length 1 to 3 they have in common, divided by the geometric
mean of their own numbers. Characters are lower-cased and coded by an alphabet of 62
frequent letters, "another letter" and "no letter", so that an n-gram is an exact index and
presence is one bit of a table of 64 + 64^2 + 64^3 entries.

Learning (bounded sample, ``PER_CLASS`` labelled texts a language of at most ``SAMPLE_CHARS``
characters): ``LANDMARKS`` of the sample per language are Nyström landmarks. With K the
kernel among the landmarks, texts are mapped to k(x, landmarks) K^-1/2, and one kernel ridge
regression per language (one against the rest) is solved on them. All of it folds into one
matrix, so a block of texts is scored by two matrix products: presence x landmarks, then
kernel x weights. Only n-grams that some landmark has enter the product; the norm of a text
counts all its n-grams.

Defined cases: null texts and texts without a letter are ``und`` with score 0; ties go to the
language first in order; with no labelled text every text is ``und`` with score 0. Any length of text
is read whole, in slices. Repeated rows are scored alike, and an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Shared, bounded_sample, crc_fold, map_slices, process_cache, ship

ship(__name__)

PER_CLASS = 400
SAMPLE_CHARS = 20_000
LANDMARKS = 40
RIDGE = 1e-3
LETTERS = 62
GRAMS = 64 + 64**2 + 64**3
UNKNOWN = "und"
BLOCK = 256


class KernelClassifier:
    """Fitted model: alphabet, the landmarks' n-grams and presence, and the folded weights."""

    def __init__(self, texts: list[str], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE):
        self.classes = sorted(set(labels))
        counts = np.zeros(0x110000, dtype=np.int64)
        for t in texts:
            cp = np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            np.add.at(counts, cp, 1)
        seen = [int(c) for c in np.flatnonzero(counts) if chr(int(c)).isalpha()]
        top = sorted(seen, key=lambda c: (-counts[c], c))[:LETTERS]
        self.codes = letter_codes(top)
        used = np.zeros(GRAMS, dtype=bool)
        rows = [self.present(t) for t in texts]
        chosen: list[int] = []
        for c in self.classes:
            chosen += [i for i, y in enumerate(labels) if y == c][:landmarks]
        for i in chosen:
            used[rows[i]] = True
        self.column = np.full(GRAMS, -1, dtype=np.int32)
        self.column[used] = np.arange(int(used.sum()), dtype=np.int32)
        marks = np.zeros((len(chosen), int(used.sum())), dtype=np.float32)
        for k, i in enumerate(chosen):
            marks[k, self.column[rows[i]]] = 1
        norms = np.sqrt(np.maximum(1, [len(rows[i]) for i in chosen]))
        self.marks = (marks / norms[:, None]).astype(np.float32).T.copy()  # n-gram x landmark
        self.weights = np.eye(len(chosen), dtype=np.float32)
        kernel = np.concatenate([self.kernel(rows[lo:lo + BLOCK]) for lo in range(0, len(rows), BLOCK)]).astype(np.float64)
        among = kernel[chosen]
        values, vectors = np.linalg.eigh((among + among.T) / 2)
        good = values > 1e-6
        root = vectors[:, good] / np.sqrt(values[good])
        mapped = np.hstack([kernel @ root, np.ones((len(rows), 1))])
        target = np.where(np.array(labels)[:, None] == np.array(self.classes)[None, :], 1.0, -1.0)
        weight = len(rows) / np.maximum(1, (target > 0).sum(axis=0))  # the classes may be uneven
        solved = []
        for c in range(len(self.classes)):
            w = np.where(target[:, c] > 0, weight[c], 1.0)
            gram = (mapped * w[:, None]).T @ mapped + ridge * len(rows) * np.eye(mapped.shape[1])
            solved.append(np.linalg.solve(gram, (mapped * w[:, None]).T @ target[:, c]))
        solved = np.array(solved).T
        self.weights = (root @ solved[:-1]).astype(np.float32)
        self.bias = solved[-1].astype(np.float32)

    def present(self, text: str) -> np.ndarray:
        """Indices of the distinct n-grams (1 to 3) of the whole text."""
        cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        code = self.codes[cp].astype(np.int32)
        code = code[np.concatenate([[True], (code[1:] != 0) | (code[:-1] != 0)])] if len(code) else code  # runs of non-letters are one
        seen = process_cache("language").setdefault("language_grams", np.zeros(GRAMS, dtype=bool))
        seen[code] = True
        if len(code) > 1:
            two = code[:-1] << 6 | code[1:]
            seen[64 + two] = True
            if len(code) > 2:
                seen[64 + 4096 + (two[:-1] << 6 | code[2:])] = True
        out = np.flatnonzero(seen)
        seen[out] = False
        return out

    def kernel(self, rows: list[np.ndarray]) -> np.ndarray:
        """Normalised kernel of the texts (by their n-grams) with the landmarks."""
        block = np.zeros((len(rows), self.marks.shape[0]), dtype=np.float32)
        for k, grams in enumerate(rows):
            col = self.column[grams]
            block[k, col[col >= 0]] = 1
        norms = np.sqrt(np.maximum(1, np.array([len(r) for r in rows], dtype=np.float32)))
        return (block @ self.marks) / norms[:, None]

    def predict(self, texts: list) -> tuple[list[str], np.ndarray]:
        pred = [UNKNOWN] * len(texts)
        score = np.zeros(len(texts))
        live = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        for lo in range(0, len(live), BLOCK):
            part = live[lo:lo + BLOCK]
            f = self.kernel([self.present(texts[i]) for i in part]) @ self.weights + self.bias
            best = f.argmax(axis=1)
            for k, i in enumerate(part):
                pred[i] = self.classes[best[k]]
            score[part] = np.clip((f[np.arange(len(part)), best] + 1) / 2, 0, 1)
        return pred, score


def letter_codes(top: list[int]) -> np.ndarray:
    """Code of each character: 1.. for the letters ``top``, 63 for another letter, 0 for the rest."""
    codes = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x110000):
        if chr(c).isalpha():
            codes[c] = 63
    for k, c in enumerate(top):
        codes[c] = k + 1
    return codes


def fit(labelled: DataFrame, per_class: int = PER_CLASS) -> KernelClassifier | None:
    """A classifier from the rows of ``labelled`` (doc_id, text, lang) with text and label."""
    rows = labelled.where("lang is not null and text rlike '\\\\p{L}'").where(F.length("text") <= SAMPLE_CHARS)
    sample = bounded_sample(rows.select("doc_id", "text", "lang"), "lang", per_class)
    if not sample:
        return None
    return KernelClassifier([r["text"] for r in sample], [r["lang"] for r in sample])


def predict(df: DataFrame, model: KernelClassifier | None) -> DataFrame:
    """``df`` plus lang_pred and score; other columns pass through (columns of those names are replaced)."""
    keep = [f for f in df.schema.fields if f.name not in ("lang_pred", "score")]
    names = [f.name for f in keep]
    frame = df.select(*(F.col(f"`{n}`") for n in names))
    if model is None:
        return frame.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
    shared = Shared(df.sparkSession, model, "language")  # about 10 MB, set by the parameters alone

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        pred, score = shared.get().predict(batch.column(batch.schema.get_field_index("text")).to_pylist())
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, type=pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), "lang_pred string", "score double"])
    return map_slices(frame, work, schema, "text")


def identify(docs: DataFrame) -> DataFrame:
    """Contract of op3: learn from folds 1 to 4, predict every whole text."""
    folded = docs.select("doc_id", "text", "lang").withColumn("held_out", crc_fold() == 0)
    model = fit(folded.where(~F.col("held_out")))
    return predict(folded.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")
