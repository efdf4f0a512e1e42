"""Pre-token boundaries of byte-level BPE by a deterministic transducer over character classes.

The public split pattern (contractions, ` ?` + letters / numbers / other signs, white space
with one look-ahead) is compiled to a transducer of 12 states and 12 input classes. Each
transition names the next state and whether a pre-token starts at this character and, where
a decision was pending, at the one before (the last blank of a run; the letter after an
apostrophe that was no contraction).

A slice of texts is one long row of classes, each text closed by an END class that resets
the state. The row is cut into chunks. For every chunk the map "state before -> state
after" is built for all states at once, four characters at a time through precomposed
tables. Maps compose associatively, so a parallel prefix scan (log2 of the chunk count
steps) gives the state before each chunk; a last pass emits the boundaries. A single very
long text is therefore worked off in parallel lanes like many short ones.
"""

from __future__ import annotations

import unicodedata

import numpy as np

from tidemark.llm.common import process_cache, ship

ship(__name__)

# Input classes and states.
BLANK, SPACE, NUMBER, SIGN, APOSTROPHE, LETTER, STMD, R, V, LL, E, END = range(12)
START, IN_L, IN_N, IN_P, APO, APO_R, APO_V, APO_L, ONE_BLANK, ONE_SPACE, RUN_BLANK, RUN_SPACE = range(12)
#: White space of the pattern's \s (the Unicode property White_Space).
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CHUNK = 256


def _step(state: int, c: int) -> tuple[int, int, int]:
    """(next state, a pre-token starts here, a pre-token starts one character before)."""
    letter = c in (LETTER, STMD, R, V, LL, E)
    white = c in (BLANK, SPACE)
    back = 0
    if state == APO:
        if c == STMD:
            return START, 0, 0
        if c in (R, V, LL):
            return {R: APO_R, V: APO_V, LL: APO_L}[c], 0, 0
        if c in (SIGN, APOSTROPHE):
            return IN_P, 0, 0
    elif state in (APO_R, APO_V, APO_L):
        if c == (LL if state == APO_L else E):
            return START, 0, 0
        back, state = 1, IN_L  # no contraction: the letter starts a word of its own
    if white:
        if state in (ONE_BLANK, ONE_SPACE, RUN_BLANK, RUN_SPACE):
            return (RUN_BLANK if c == BLANK else RUN_SPACE), 0, back
        return (ONE_BLANK if c == BLANK else ONE_SPACE), 1, back
    if c == END:
        return START, 1, back
    new = 1
    if state in (ONE_BLANK, RUN_BLANK):  # the blank belongs to what follows
        back, new = int(state == RUN_BLANK), 0
        if c == APOSTROPHE:
            return IN_P, new, back
    elif state == RUN_SPACE:
        back = 1
    elif state == IN_L and letter or state == IN_N and c == NUMBER or state == IN_P and c in (SIGN, APOSTROPHE):
        new = 0
        if c == APOSTROPHE:
            return IN_P, new, back
    if letter:
        return IN_L, new, back
    if c == NUMBER:
        return IN_N, new, back
    if c == APOSTROPHE:
        return APO, new, back
    return IN_P, new, back


def _tables() -> dict:
    cache = process_cache("tokenizers")
    if "pretokens" in cache:
        return cache["pretokens"]
    cls = np.full(0x110000, SIGN, dtype=np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            cls[cp] = LETTER
        elif kind == "N":
            cls[cp] = NUMBER
    cls[WHITE] = SPACE
    cls[0x20] = BLANK
    cls[ord("'")] = APOSTROPHE
    for ch, c in [*((x, STMD) for x in "stmd"), ("r", R), ("v", V), ("l", LL), ("e", E)]:
        cls[ord(ch)] = c
    steps = np.array([[_step(s, c) for c in range(12)] for s in range(12)], dtype=np.uint8)
    one = steps[:, :, 0].T.copy()  # [class, state before] -> state after
    two = np.stack([one[b][one[a]] for a in range(12) for b in range(12)])
    four = np.stack([two[b][two[a]] for a in range(144) for b in range(144)])
    code = (steps[:, :, 0] | steps[:, :, 1] << 4 | steps[:, :, 2] << 5).reshape(-1)  # by state * 12 + class
    cache["pretokens"] = {"class": cls, "four": four.reshape(-1).astype(np.uint8), "code": code.astype(np.uint8)}
    return cache["pretokens"]


def starts_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, str]:
    """Boundaries of the pre-tokens of ``texts`` laid end to end, each followed by one newline.

    Returns (positions, ends, joined): every position where a pre-token or a text's closing
    newline starts, in characters of ``joined``, and the position of each closing newline.
    """
    t = _tables()
    joined = "\n".join(texts) + "\n"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(cp)
    ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1) - 1
    chunks = -(-n // CHUNK)
    row = np.full(chunks * CHUNK, END, dtype=np.uint8)
    row[:n] = t["class"][cp]
    row[ends] = END
    row = row.reshape(chunks, CHUNK)

    before = np.zeros(chunks, dtype=np.uint8)
    if chunks > 1:
        quad = row.astype(np.int32).reshape(chunks, CHUNK // 4, 4)
        quad = ((quad[:, :, 0] * 12 + quad[:, :, 1]) * 144 + quad[:, :, 2] * 12 + quad[:, :, 3]) * 12
        maps = np.broadcast_to(np.arange(12, dtype=np.uint8), (chunks, 12)).copy()
        for j in range(CHUNK // 4):
            maps = t["four"][quad[:, j, None] + maps]
        step = 1
        while step < chunks:  # inclusive scan: maps[i] becomes the map over chunks 0..i
            later = np.take_along_axis(maps[step:], maps[:-step].astype(np.intp), axis=1)
            maps = np.concatenate([maps[:step], later])
            step *= 2
        before[1:] = maps[:-1, START]

    state = before.astype(np.intp)
    columns = np.ascontiguousarray(row.T)
    codes = np.empty((CHUNK, chunks), dtype=np.uint8)
    for j in range(CHUNK):
        code = t["code"][state * 12 + columns[j]]
        codes[j] = code
        state = (code & 15).astype(np.intp)
    codes = np.ascontiguousarray(codes.T).reshape(-1)[:n]
    flag = (codes & 16) != 0
    flag[:-1] |= (codes[1:] & 32) != 0
    return np.flatnonzero(flag), ends, joined


def split(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """(the pre-tokens of all texts in order, how many each text has)."""
    at, ends, joined = starts_of(texts)
    closing = np.searchsorted(at, ends)  # the closing newline of each text is a boundary itself
    keep = np.ones(len(at), dtype=bool)
    keep[closing] = False
    after = np.append(at[1:], len(joined))
    pieces = [joined[a:b] for a, b in zip(at[keep].tolist(), after[keep].tolist(), strict=True)]
    return pieces, np.diff(closing, prepend=-1) - 1
