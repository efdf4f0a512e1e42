"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A text is lower-cased and cut into words, runs of more than ``LONGEST`` bytes (joined words, scripts
without blanks) into overlapping pieces that are words of their own; every overlapping window of ``WINDOW`` words
(step ``WINDOW / 2``; the last window ends at the last word) is scored and the text's score
is that of its worst window. A word enters as two vectors: its own embedding (frequent
words of the sample; others share one) and the mean embedding of its character n-grams
(lengths 3 to 5 with word borders, hashed to ``BUCKETS`` rows). A gated recurrent unit reads the window forwards,
another backwards; attention weights the positions, and a logistic unit scores their mean.

Training: a bounded sample of labelled texts (``PER_CLASS`` a label, of at most
``SAMPLE_CHARS`` characters), gradients by back-propagation through time, Adam. Labels are of
whole texts, so a text's windows share its label through their soft maximum: a toxic text needs one
toxic window, a clean text has none. Seeds and order are fixed: every run learns the same.

Scoring keeps, per worker, the two input projections of words already met (at most
``CACHE_WORDS``), so a window costs the recurrences alone.

Defined cases: null and empty texts, and texts without a word, score 0; without labels of both kinds
every score is 0. Texts are read whole, at any length; repeated rows score alike.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Shared, bounded_sample, crc_fold, map_slices, process_cache, ship

ship(__name__)

PER_CLASS = 1200
SAMPLE_CHARS = 6_000
WINDOW = 16
STEPS = 300  # of 32 texts
BUCKET_BITS = 13
BUCKETS = 1 << BUCKET_BITS
WORDS = 3000
DIM = 8
DECAY = 0.02
HIDDEN = 8
CACHE_WORDS = 200_000
LONGEST = 64  # bytes of a word
PIECE = 16  # characters of a piece of a longer run; every second half is the next one's first
STRIP = ".,;:!?\"'()[]{}<>*#$%&|-_"


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of each word's UTF-8 bytes within its borders: (all, end to end; how many each word has)."""
    raw = [b"^" + w.encode("utf-8", "surrogatepass") + b"$" for w in words]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    data = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.uint32)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))  # bytes from here to the word's end
    word = np.repeat(np.arange(len(raw)), sizes)
    h = data * np.uint32(0x01000193)
    found, owner = [], []
    for n in range(2, 6):
        shifted = np.zeros_like(data)
        shifted[:max(0, len(data) - n + 1)] = data[n - 1:]
        h = (h ^ shifted) * np.uint32(0x01000193)
        if n > 2:
            ok = left >= n
            found.append((((h[ok] + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64))
            owner.append(word[ok])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order], np.bincount(owner, minlength=len(words))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def windows_of(n: int, width: int = WINDOW) -> np.ndarray:
    """Starts of the overlapping windows over ``n`` words; together they cover every word."""
    step = width // 2
    if n <= width:
        return np.zeros(1 if n else 0, dtype=np.int64)
    starts = np.arange(0, n - width + 1, step)
    return starts if starts[-1] == n - width else np.append(starts, n - width)


class Network:
    """Parameters, forward and backward pass. Index 0 of the words is "another word"."""

    def __init__(self, vocabulary: list[str], seed: int = 7):
        r = np.random.default_rng(seed)
        self.word = {w: i + 1 for i, w in enumerate(vocabulary)}
        h, d = HIDDEN, 2 * DIM

        def init(*shape, scale=None):
            return (r.standard_normal(shape) * (scale or 1 / np.sqrt(shape[0]))).astype(np.float32)

        self.p = {
            "word": init(len(vocabulary) + 1, DIM, scale=0.3), "gram": init(BUCKETS, DIM, scale=0.5),
            "wf": init(d, 3 * h), "uf": init(h, 3 * h), "bf": np.zeros(3 * h, np.float32),
            "wb": init(d, 3 * h), "ub": init(h, 3 * h), "bb": np.zeros(3 * h, np.float32),
            "aw": init(2 * h, h), "ab": np.zeros(h, np.float32), "av": init(h),
            "ow": init(2 * h), "ob": np.array([-1.0], np.float32),
        }

    # --- inputs ---------------------------------------------------------------------------

    def inputs(self, words: list[str]) -> np.ndarray:
        """Word and character vectors of the given words, side by side."""
        ids = np.fromiter((self.word.get(w, 0) for w in words), dtype=np.int64, count=len(words))
        flat, sizes = grams(words)
        sums = np.add.reduceat(self.p["gram"][flat], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0)
        return np.hstack([self.p["word"][ids], sums / sizes[:, None].astype(np.float32)])

    # --- forward --------------------------------------------------------------------------

    def recur(self, x: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: list | None):
        """A gated recurrent unit over x [time, window, 3 h] (input projections with bias)."""
        t, n, _ = x.shape
        h = HIDDEN
        state = np.zeros((n, h), dtype=np.float32)
        out = np.empty((t, n, h), dtype=np.float32)
        uz, uc = u[:, :2 * h], u[:, 2 * h:]
        for k in range(t):
            gates = sigmoid(x[k, :, :2 * h] + state @ uz)
            z, r = gates[:, :h], gates[:, h:]
            c = np.tanh(x[k, :, 2 * h:] + (r * state) @ uc)
            m = mask[k][:, None]
            new = state + m * z * (c - state)
            if keep is not None:
                keep.append((state, z, r, c, m))
            state = out[k] = new
        return out

    def forward(self, xf: np.ndarray, xb: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows: projections of both directions [time, window, 3 h], mask [time, window]."""
        p = self.p
        kf, kb = ([], []) if keep is not None else (None, None)
        hf = self.recur(xf, mask, p["uf"], kf)
        hb = self.recur(xb[::-1], mask[::-1], p["ub"], kb)[::-1]
        hid = np.concatenate([hf, hb], axis=2)
        a = np.tanh(hid @ p["aw"] + p["ab"])
        e = a @ p["av"]
        e = np.where(mask > 0, e, -1e9)
        e = np.exp(e - e.max(axis=0))
        alpha = e / e.sum(axis=0)
        pooled = np.einsum("tn,tnd->nd", alpha, hid)
        if keep is not None:
            keep.update(kf=kf, kb=kb, hid=hid, a=a, alpha=alpha, pooled=pooled)
        return pooled @ p["ow"] + p["ob"][0]

    # --- backward -------------------------------------------------------------------------

    def unrecur(self, grad: np.ndarray, kept: list, u: np.ndarray):
        """Gradients of a recurrence: (input projections, u)."""
        t, n, h = grad.shape
        gx = np.zeros((t, n, 3 * h), dtype=np.float32)
        gu = np.zeros_like(u)
        gs = np.zeros((n, h), dtype=np.float32)
        uz, uc = u[:, :2 * h], u[:, 2 * h:]
        for k in range(t - 1, -1, -1):
            state, z, r, c, m = kept[k]
            g = gs + grad[k]
            gc = g * m * z * (1 - c * c)
            gz = g * m * (c - state) * z * (1 - z)
            grs = gc @ uc.T
            gr = grs * state * r * (1 - r)
            gg = np.hstack([gz, gr])
            gx[k] = np.hstack([gg, gc])
            gu[:, :2 * h] += state.T @ gg
            gu[:, 2 * h:] += (r * state).T @ gc
            gs = g * (1 - m * z) + grs * r + gg @ uz.T
        return gx, gu

    def backward(self, glogit: np.ndarray, x: np.ndarray, keep: dict) -> tuple[dict, np.ndarray]:
        """Gradients of the parameters and of the inputs x [time, window, 2 dim]."""
        p, h = self.p, HIDDEN
        hid, a, alpha = keep["hid"], keep["a"], keep["alpha"]
        g = {"ow": keep["pooled"].T @ glogit, "ob": np.array([glogit.sum()], np.float32)}
        gpool = glogit[:, None] * p["ow"]
        galpha = np.einsum("nd,tnd->tn", gpool, hid)
        ge = alpha * (galpha - (alpha * galpha).sum(axis=0))
        ghid = alpha[:, :, None] * gpool[None]
        ga = ge[:, :, None] * p["av"] * (1 - a * a)
        g["av"] = np.einsum("tn,tnd->d", ge, a)
        g["aw"] = np.einsum("tnd,tnk->dk", hid, ga)
        g["ab"] = ga.sum(axis=(0, 1))
        ghid = ghid + ga @ p["aw"].T
        gxf, g["uf"] = self.unrecur(ghid[:, :, :h], keep["kf"], p["uf"])
        gxb, g["ub"] = self.unrecur(np.ascontiguousarray(ghid[::-1, :, h:]), keep["kb"], p["ub"])
        gxb = gxb[::-1]
        g["bf"], g["bb"] = gxf.sum(axis=(0, 1)), gxb.sum(axis=(0, 1))
        flat = x.reshape(-1, x.shape[2])
        g["wf"] = flat.T @ gxf.reshape(-1, 3 * h)
        g["wb"] = flat.T @ gxb.reshape(-1, 3 * h)
        return g, gxf @ p["wf"].T + gxb @ p["wb"].T


def words_of(text: str) -> list[str]:
    """The words of a text; a run of more than ``LONGEST`` bytes as pieces that overlap by half, none of it left out."""
    words = text.lower().split()
    if not words or max(map(len, words)) <= PIECE:
        return words
    out = []
    for w in words:
        if len(w) <= PIECE or len(w) <= LONGEST and (w.isascii() or len(w.encode("utf-8", "surrogatepass")) <= LONGEST):
            out.append(w)
        else:
            out += [w[i:i + PIECE] for i in range(0, max(1, len(w) - PIECE // 2), PIECE // 2)]
    return out


def contrast(lists: list[list[str]], number: dict[str, int], y: np.ndarray, values: np.ndarray, sizes: np.ndarray | None, n: int) -> np.ndarray:
    """Where a first weight starts: how far the share of toxic texts with a word (or n-gram) departs
    from that of clean ones, in standard errors / 4, cut at 2."""
    starts = np.arange(len(values) + 1) if sizes is None else np.concatenate([[0], np.cumsum(sizes)])
    having = np.zeros((2, n))
    for ws, label in zip(lists, y.astype(int).tolist(), strict=True):
        own = [number[w] for w in set(ws)]
        if own:
            having[label, np.unique(np.concatenate([values[starts[i]:starts[i + 1]] for i in own]))] += 1
    of = np.array([(y == 0).sum(), (y == 1).sum()], dtype=float)[:, None]
    share = having.sum(axis=0) / of.sum()
    error = np.sqrt(share * (1 - share) * (1 / of).sum() + 1e-4)
    return np.clip((having[1] / of[1] - having[0] / of[0]) / error / 4, -2, 2).astype(np.float32)


def train(texts: list[str], labels: list[int], total: int = STEPS, seed: int = 7) -> Network:
    """Fit a network to labelled texts."""
    r = np.random.default_rng(seed)
    lists = [[w.strip(STRIP) or w for w in words_of(t)] for t in texts]
    seen: dict[str, int] = {}
    for ws in lists:
        for w in set(ws):
            seen[w] = seen.get(w, 0) + 1
    common = sorted((w for w, n in seen.items() if n >= 5), key=lambda w: (-seen[w], w))[:WORDS]
    net = Network(common, seed)
    # Distinct words once: their ids and n-grams.
    distinct = sorted(seen)
    number = {w: i for i, w in enumerate(distinct)}
    ids = np.array([net.word.get(w, 0) for w in distinct], dtype=np.int64)
    gram_flat, gram_size = grams(distinct)
    gram_start = np.concatenate([[0], np.cumsum(gram_size)])
    wins, owner = [], []
    for d, ws in enumerate(lists):
        seq = np.array([number[w] for w in ws], dtype=np.int64)
        for s in windows_of(len(seq)):
            w = seq[s:s + WINDOW]
            wins.append(np.pad(w, (0, WINDOW - len(w)), constant_values=-1))
            owner.append(d)
    wins, owner = np.array(wins), np.array(owner)
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    y = np.array(labels, dtype=np.float32)
    for table, values, of in (("word", ids, None), ("gram", gram_flat, gram_size)):
        net.p[table] *= 0.3
        net.p[table][:, 0] = contrast(lists, number, y, values, of, len(net.p[table]))
    net.p["word"][0, 0] = 0
    rows = {0: np.flatnonzero(y == 0), 1: np.flatnonzero(y == 1)}
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    steps = 0
    while steps < total and len(wins):
        order = r.permutation(len(texts))
        for lo in range(0, len(order), 32):
            sharp = 1.0 if steps < total // 6 else 3.0  # of the soft maximum over a text's windows
            docs = order[lo:lo + 32]
            docs = docs[first[docs + 1] > first[docs]]
            if not len(docs) or steps >= total:
                continue
            pick = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
            part = np.concatenate([np.full(first[d + 1] - first[d], k) for k, d in enumerate(docs)])
            win = wins[pick].T  # time x window
            mask = (win >= 0).astype(np.float32)
            uniq, inv = np.unique(np.maximum(win, 0), return_inverse=True)
            inv = inv.reshape(win.shape)
            wid = np.where(r.random(len(uniq)) < 0.15, 0, ids[uniq])  # some words unknown: the characters must carry them
            size = gram_size[uniq]
            cat = np.repeat(gram_start[uniq] - np.cumsum(size) + size, size) + np.arange(size.sum())
            gram_ids = gram_flat[cat]
            edge = np.concatenate([[0], np.cumsum(size)[:-1]])
            xin = np.hstack([net.p["word"][wid], np.add.reduceat(net.p["gram"][gram_ids], edge, axis=0) / size[:, None]]).astype(np.float32)
            x = xin[inv]
            keep: dict = {}
            logit = net.forward(x @ net.p["wf"] + net.p["bf"], x @ net.p["wb"] + net.p["bb"], mask, keep)
            # Soft maximum per text: weights softmax(sharp * logit).
            top = np.full(len(docs), -np.inf)
            np.maximum.at(top, part, logit)
            e = np.exp(sharp * (logit - top[part]))
            weight = e / np.bincount(part, weights=e, minlength=len(docs))[part]
            text_logit = np.bincount(part, weights=weight * logit, minlength=len(docs))
            err = (sigmoid(text_logit) - y[docs]) / len(docs)
            err = err * np.where(y[docs] > 0, len(y) / (2 * max(1, len(rows[1]))), len(y) / (2 * max(1, len(rows[0]))))
            glogit = (err[part] * weight).astype(np.float32)
            g, gx = net.backward(glogit, x, keep)
            gxin = np.zeros_like(xin)
            np.add.at(gxin, inv.reshape(-1), (gx * mask[:, :, None]).reshape(-1, gx.shape[2]))
            g["word"] = np.zeros_like(net.p["word"])
            np.add.at(g["word"], wid, gxin[:, :DIM])
            g["gram"] = np.zeros_like(net.p["gram"])
            np.add.at(g["gram"], gram_ids, np.repeat(gxin[:, DIM:] / size[:, None], size, axis=0))
            steps += 1
            rate = 0.01 * (1 - 0.8 * steps / total)
            for k, grad in g.items():
                m, v = moment[k]
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                net.p[k] -= (DECAY * rate * net.p[k] + rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-7)).astype(np.float32)
    return net


class Scorer:
    """Scores texts with a trained network; remembers the input projections of words met."""

    def __init__(self, net: Network):
        self.net = net
        self.known: dict[str, int] = {}
        self.table = np.zeros((1, 6 * HIDDEN), dtype=np.float32)
        self.used = 0

    def look_up(self, words: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.known.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            if len(self.known) > CACHE_WORDS:
                self.known, self.used = {}, 0
                return self.look_up(words)
            new = list(dict.fromkeys(words[i] for i in missing.tolist()))
            p = self.net.p
            need = self.used + len(new)
            if need > len(self.table):
                grown = np.zeros((max(need, 2 * len(self.table)), 6 * HIDDEN), dtype=np.float32)
                grown[:self.used] = self.table[:self.used]
                self.table = grown
            for lo in range(0, len(new), 20_000):
                part = new[lo:lo + 20_000]
                x = self.net.inputs([w.strip(STRIP) or w for w in part])
                self.table[self.used + lo:self.used + lo + len(part)] = np.hstack([x @ p["wf"] + p["bf"], x @ p["wb"] + p["bb"]])
            self.known.update(zip(new, range(self.used, need), strict=True))
            self.used = need
            at[missing] = [self.known[words[i]] for i in missing.tolist()]
        return at

    def score(self, texts: list) -> np.ndarray:
        lists = [words_of(t) if t else [] for t in texts]
        at = self.look_up([w for ws in lists for w in ws])
        starts, lengths, owner, base = [], [], [], 0
        for d, ws in enumerate(lists):
            s = windows_of(len(ws))
            starts.append(s + base)
            lengths.append(np.minimum(WINDOW, len(ws) - s))
            owner.append(np.full(len(s), d))
            base += len(ws)
        out = np.zeros(len(texts))
        if not base:
            return out
        starts, lengths, owner = map(np.concatenate, (starts, lengths, owner))
        best = np.full(len(texts), -np.inf)
        step = np.arange(WINDOW)[:, None]
        for lo in range(0, len(starts), 4096):
            s, n = starts[lo:lo + 4096], lengths[lo:lo + 4096]
            mask = (step < n).astype(np.float32)
            rows = self.table[at[np.where(mask > 0, s + step, s)]]
            logit = self.net.forward(rows[:, :, :3 * HIDDEN], rows[:, :, 3 * HIDDEN:], mask)
            np.maximum.at(best, owner[lo:lo + 4096], logit)
        live = np.isfinite(best)
        out[live] = sigmoid(best[live])
        return out


def fit(docs: DataFrame, marks: DataFrame, per_class: int = PER_CLASS) -> Network | None:
    """A network from the texts ``docs`` (doc_id, text) under the labels ``marks`` (doc_id, toxic).

    The draw is made on the narrow labels; only its rows (a bound set by ``per_class``) meet the texts.
    """
    drawn = bounded_sample(marks.where("toxic in (0, 1)").select("doc_id", "toxic"), "toxic", 3 * per_class // 2)
    labels = {r["doc_id"]: int(r["toxic"]) for r in drawn}
    if len(set(labels.values())) < 2:
        return None
    ids = docs.sparkSession.createDataFrame([(i,) for i in sorted(labels)], "doc_id bigint")
    texts = docs.where("text is not null").where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(ids), "doc_id", "left_semi")
    text_of = {r["doc_id"]: r["text"] for r in texts.select("doc_id", "text").orderBy("doc_id", "text").collect()}
    taken = []
    for label in (0, 1):
        taken += [i for i in labels if labels[i] == label and i in text_of][:per_class]  # in the order of the draw
    if len({labels[i] for i in taken}) < 2:
        return None
    return train([text_of[i] for i in taken], [labels[i] for i in taken])


def score(df: DataFrame, net: Network | None) -> DataFrame:
    """``df`` plus score (0 to 1) of every whole text; other columns pass through."""
    keep = [f for f in df.schema.fields if f.name != "score"]
    names = [f.name for f in keep]
    frame = df.select(*(F.col(f"`{n}`") for n in names))
    if net is None:
        return frame.withColumn("score", F.lit(0.0))
    shared = Shared(df.sparkSession, net, "toxicity")  # under 1 MB, set by the parameters alone

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        net = shared.get()
        cache = process_cache("toxicity")
        if cache.get("toxicity_net") is not net:
            cache["toxicity_net"], cache["toxicity_scorer"] = net, Scorer(net)
        got = cache["toxicity_scorer"].score(batch.column(batch.schema.get_field_index("text")).to_pylist())
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(got)], [*names, "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), "score double"])
    return map_slices(frame, work, schema, "text")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract of op1: learn from the labels of folds 1 to 4, score every whole text."""
    marks = labels.where(crc_fold() != 0).where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    net = fit(docs, marks)
    scored = score(docs.select("doc_id", (crc_fold() == 0).alias("held_out"), "text"), net)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
