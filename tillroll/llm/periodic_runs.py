"""Periodic runs of words: suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q, at least
max(6, 4 * q) words long, that no neighbouring word extends keeping period q.

The automaton of a stretch of words is built first; then its prefixes are
accessed in order in the tree of suffix links. An access of prefix r recolours
the path to the root by r. A segment of that path that had colour e shares with
prefix r a suffix of L words, the length of its deepest state on the path, and e
is the last place before r where that suffix ended. With p = r - e and L >= p
there is a square; the words r - L - p + 1 to r have period p. With L >= 3 * p, as
runs need, p is the smallest period, and the same start and period come again
with each further word, up to the run's end. The preferred paths of the link-cut
forest are the segments: a tree of splay nodes has one colour, kept at its root.
So a stretch of n words takes O(n log n) amortised steps and O(n) memory.

Only stretches that can hold a run get there. In a run, each window of WINDOW
words after the first q words has an equal one q words before it. So windows that
repeat an earlier one of the text are marked, in numpy for many texts at once; a
series of m marked windows can hold runs of periods up to (m + 3) / 3 only, marks
whose distance is over that go, until none does. A run lies within a series and
that many words before it; stretches that overlap are joined. This drops no run,
and prose leaves next to nothing to the automaton.

Work is by row, a batch of texts at a time; no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

SHORTEST, TIMES, WINDOW = 6, 4, 4
RESULT = ("struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, "
          "runs_sha256: string, collapsed_sha256: string>")


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(suffix link, longest length) of every state and the state of every prefix; state 0 is the empty suffix."""
    steps: list[dict[int, int]] = [{}]
    link, length, prefix = [0], [0], []
    last = 0
    for i, word in enumerate(words):
        new = len(length)
        length.append(i + 1)
        steps.append({})
        link.append(0)
        at = last
        while True:
            step = steps[at]
            if word in step:
                to = step[word]
                if length[to] == length[at] + 1:
                    link[new] = to
                    break
                split = len(length)
                length.append(length[at] + 1)
                steps.append(steps[to].copy())
                link.append(link[to])
                link[to] = link[new] = split
                while steps[at].get(word) == to:
                    steps[at][word] = split
                    if at == 0:
                        break
                    at = link[at]
                break
            step[word] = new
            if at == 0:
                break
            at = link[at]
        last = new
        prefix.append(new)
    return link, length, prefix


def runs_of(words: list[int], times: int = TIMES, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the words, by start and period."""
    link, length, prefix = suffix_automaton(words)
    up = link  # parent in a splay tree, or at its root the state above the segment
    n = len(up)
    left, right, colour = [0] * n, [0] * n, [0] * n
    ends: dict[tuple[int, int], int] = {}

    def splay(x: int) -> int:
        """Make x the root of its tree; returns the old root."""
        top = x
        while True:
            p = up[x]
            if not p:
                return top
            is_left = left[p] == x
            if not is_left and right[p] != x:
                return top
            top = p
            g = up[p]
            g_left = g and left[g] == p
            g_right = g and not g_left and right[g] == p
            if g_left or g_right:
                top = g
                if g_left == is_left or (g_right and not is_left):  # same side twice: turn the parent first
                    if is_left:
                        c = right[p]
                        left[g] = c
                        right[p] = g
                    else:
                        c = left[p]
                        right[g] = c
                        left[p] = g
                    if c:
                        up[c] = g
                    gg = up[g]
                    up[p], up[g] = gg, p
                    if gg:
                        if left[gg] == g:
                            left[gg] = p
                        elif right[gg] == g:
                            right[gg] = p
                    is_left = left[p] == x
                else:  # x over its parent, below the grandparent
                    if is_left:
                        c = right[x]
                        left[p] = c
                        right[x] = p
                    else:
                        c = left[x]
                        right[p] = c
                        left[x] = p
                    if c:
                        up[c] = p
                    up[p], up[x] = x, g
                    if g_left:
                        left[g] = x
                    else:
                        right[g] = x
                    p = g
                    is_left = left[p] == x
            if is_left:
                c = right[x]
                left[p] = c
                right[x] = p
            else:
                c = left[x]
                right[p] = c
                left[x] = p
            if c:
                up[c] = p
            gg = up[p]
            up[p], up[x] = x, gg
            if gg:
                if left[gg] == p:
                    left[gg] = x
                elif right[gg] == p:
                    right[gg] = x

    for r, state in enumerate(prefix, 1):
        below, x = 0, state
        while x:
            root = splay(x)
            e = colour[root]
            if e:
                p, same = r - e, length[x]
                if same >= (times - 1) * p and same + p >= shortest:
                    ends[r - same - p, p] = r
                rest = right[x]
                if rest:
                    colour[rest] = e
            right[x] = below  # what hung there keeps its own colour, below a path parent
            below, x = x, up[x]
        colour[below] = r
    return [(start, end - start, p) for (start, p), end in sorted(ends.items())]


def stretches(words: np.ndarray, text: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint ranges of words, each within one text, that hold every run; ``at``: offsets of the texts' words."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return []
    value = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        value += words[j:j + n] * tv._PLACE[j]
    start = np.flatnonzero(text[:n] == text[WINDOW - 1:])
    key = value[start] ^ tv.mix(text[start].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    key, start = key[order], start[order]
    again = np.flatnonzero((key[1:] == key[:-1]) & (text[start[1:]] == text[start[:-1]])) + 1
    mark, gap = start[again], start[again] - start[again - 1]
    order = np.argsort(mark)
    mark, gap = mark[order], gap[order]
    while len(mark):
        first = np.r_[True, (mark[1:] != mark[:-1] + 1) | (text[mark[1:]] != text[mark[:-1]])]
        group = np.cumsum(first) - 1
        most = (np.bincount(group)[group] + WINDOW - 1) // (TIMES - 1)
        keep = gap <= most
        if keep.all():
            break
        mark, gap = mark[keep], gap[keep]
    if not len(mark):
        return []
    heads = np.flatnonzero(first)
    size = np.diff(np.r_[heads, len(mark)])
    begin = np.maximum(mark[heads] - (size + WINDOW - 1) // (TIMES - 1), at[text[mark[heads]]])
    out: list[tuple[int, int]] = []
    for a, b in zip(begin.tolist(), (mark[heads] + size + WINDOW - 1).tolist()):
        # Series stand in order of their ends; one may begin before those already found.
        while out and out[-1][1] > a:
            a, b = min(out.pop()[0], a), b
        out.append((a, b))
    return out


def _texts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int, int]], str, str]]:
    """(words, runs, digest of the runs, digest of the kept words) of each text of a slice."""
    start, end, text = tv.word_spans(data, offsets)
    texts = len(offsets) - 1
    at = tv.per_text(text, texts)
    words = tv.hash_spans(data, start, end)
    found: dict[int, list[tuple[int, int, int]]] = {}
    drop = np.zeros(len(words) + 1, np.int64)
    for a, b in stretches(words, text, at):
        ids = np.unique(words[a:b], return_inverse=True)[1].tolist()
        t = int(text[a])
        for s, length, q in runs_of(ids):
            found.setdefault(t, []).append((int(a - at[t]) + s, length, q))
            drop[a + s + q] += 1
            drop[a + s + length] -= 1
    kept = np.cumsum(drop[:-1]) == 0
    # Bytes of the kept words, and the first byte after each that has a kept word of its text behind it.
    start, end, text = start[kept], end[kept], text[kept]
    edge = np.zeros(len(data) + 1, np.int8)
    edge[start] = 1
    edge[end] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    data = data.copy()
    gap = end[:-1][text[1:] == text[:-1]] if len(end) else end
    data[gap] = 32
    inside[gap] = True
    size = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=size[1:])
    joined = data[inside].tobytes()
    bounds = size[offsets].tolist()
    counts = np.diff(at).tolist()
    for t in range(texts):
        runs = sorted((s, q, length) for s, length, q in found.get(t, ()))
        lines = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
        yield (counts[t], [(s, length, q) for s, q, length in runs], hashlib.sha256(lines.encode()).hexdigest(),
               hashlib.sha256(joined[bounds[t]:bounds[t + 1]]).hexdigest())


def find_runs(docs: DataFrame, text_col: str = "text", out: str = "periodic") -> DataFrame:
    """``docs`` and a struct ``out``: n_words, runs (start, length, period; by start, then period), runs_sha256
    (of the lines ``start,length,period``) and collapsed_sha256 (of the words that stay, joined by one space).

    A word goes if any run has it after that run's first period. Words are runs
    of characters other than space and \\t to \\r. Null and empty texts have no
    word and no run; both digests are those of nothing. Rows are taken one by
    one, so repeated ids and rows don't matter, and an empty table gives an
    empty one. A column that already has the name ``out`` is replaced.
    """
    rest = [c for c in docs.columns if c != out]
    schema = docs.select(*rest, F.lit(None).cast(RESULT).alias(out)).schema
    kind = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                      ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])
    names = ("start", "length", "period")

    def work(batches):
        for batch in batches:
            rows = []
            for _, _, data, offsets in tv.text_slices(batch.column(batch.num_columns - 1)):
                rows += [{"n_words": n, "runs": [dict(zip(names, r)) for r in runs], "runs_sha256": a, "collapsed_sha256": b}
                         for n, runs, a, b in _texts(data, offsets)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, kind)], names=schema.names)

    return docs.select(*rest, F.col(text_col).cast("string").alias("__text")).mapInArrow(work, schema)
