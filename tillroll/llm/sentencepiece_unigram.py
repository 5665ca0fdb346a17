"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The pieces and log scores come from a public model file. A text is encoded as
the sequence of pieces of the highest total score; a character that no piece
spells costs the lowest score less 10 and becomes its bytes' pieces. White
space marks (U+2581) are one byte, 0x20, inside the trie, as they are in the
text. No piece of the usual models goes on past the end of a word into white
space, so a text falls into words that are encoded on their own; equal words of
a slice are encoded once. (With a model that has such pieces, the texts
themselves take the words' place.) All words of a slice go through the trie
and the Viterbi steps together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()
UNKNOWN_COST = 10.0


def double_array(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value): from state s a byte c leads to base[s] + c if check there is s; value is a word's number or -1."""
    children: list[dict[int, int]] = [{}]
    number = [-1]
    for i, w in enumerate(words):
        node = 0
        for c in w:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                number.append(-1)
            node = children[node][c]
        number[node] = i
    size = 4 * len(children) + 20_000
    base, check, value = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    check[0], free, queue = 0, 1, [(0, 0)]
    for node, state in queue:
        value[state] = number[node]
        if not children[node]:
            continue
        codes = np.array(sorted(children[node]))
        while check[free] >= 0:
            free += 1
        at, found = max(free, int(codes[0]) + 1), np.zeros(0, np.int64)
        if len(codes) == 1 and at == free:
            found = [free - codes[0]]
        while not len(found):  # the first place where all the children's cells are free
            empty = np.flatnonzero(check[at:at + 2048] < 0) + at - codes[0]
            found = empty[(check[empty[:, None] + codes] < 0).all(axis=1)] if len(codes) > 1 else empty
            at += 2048
            if at + 4096 > len(check):
                base, check, value = (np.r_[x, np.full(size, fill)] for x, fill in ((base, 0), (check, -1), (value, -1)))
        b = int(found[0])
        base[state] = b
        check[b + codes] = state
        queue += [(children[node][c], b + c) for c in codes.tolist()]
    return base, check, value


SLICE_BYTES = 500_000  # of text encoded at once; a longer text is a slice of its own


@dataclass
class Pieces:
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    ids: np.ndarray       # piece id by word number of the trie
    scores: np.ndarray    # by word number
    unknown: float
    byte_ids: np.ndarray  # piece id by byte
    spelled: np.ndarray   # bytes of all pieces, as decoding writes them
    spelled_at: np.ndarray
    by_words: bool

    @classmethod
    def load(cls, path: str = MODEL) -> Pieces:
        """From a model file that the driver can read; the vocabulary bounds its size."""
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        words, ids, scores, spelled, byte_ids = [], [], [], [], np.full(256, m.unk_id())
        for i in range(m.get_piece_size()):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                spelled.append(bytes([int(piece[3:5], 16)]))
            elif m.is_control(i) or m.is_unused(i):
                spelled.append(b"")
            elif m.is_unknown(i):
                spelled.append(" ⁇ ".encode())
            else:
                w = piece.encode().replace(MARK, b" ")
                words.append(w)
                ids.append(i)
                scores.append(m.get_score(i))
                spelled.append(w)
        return cls(*double_array(words), np.array(ids), np.array(scores), min(scores) - UNKNOWN_COST, byte_ids,
                   np.frombuffer(b"".join(spelled), np.uint8), np.cumsum([0] + [len(x) for x in spelled]),
                   not any(b" " in w.lstrip(b" ") for w in words))


def _matches(p: Pieces, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, trie number or -1) of every piece at every character, and the unknown characters."""
    place = np.flatnonzero((data & 0xC0) != 0x80)
    end = np.repeat(offsets[1:], np.diff(offsets))[place]
    letters = np.diff(np.r_[place, len(data)])
    single = np.zeros(len(data), bool)
    at, state, stop, size = place, np.zeros(len(place), np.int64), end, letters
    out = []
    depth = 0
    while len(at):
        ok = at + depth < stop
        at, state, stop, size = at[ok], state[ok], stop[ok], size[ok]
        after = p.base[state] + data[at + depth]
        ok = p.check[after] == state
        at, state, stop, size = at[ok], after[ok], stop[ok], size[ok]
        depth += 1
        hit = p.value[state]
        is_word = hit >= 0
        out.append((at[is_word], np.full(int(is_word.sum()), depth), hit[is_word]))
        single[at[is_word & (size == depth)]] = True
    lone = ~single[place]
    out.append((place[lone], letters[lone], np.full(int(lone.sum()), -1)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def best_pieces(p: Pieces, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece ids, offsets of each string's ids) of the best segmentation of strings given by offsets."""
    n = len(offsets) - 1
    start, size, number = _matches(p, data, offsets)
    string = np.repeat(np.arange(n), np.diff(offsets))[start] if len(start) else start
    score = np.where(number >= 0, p.scores[np.maximum(number, 0)], p.unknown)
    node, rel = start + string, start - offsets[string]  # a string of z bytes has z + 1 nodes
    order = np.argsort(rel, kind="stable")
    steps = np.searchsorted(rel[order], np.arange(int(rel.max(initial=-1)) + 2))
    best = np.full(len(data) + n, -np.inf)
    best[offsets[:-1] + np.arange(n)] = 0
    back = np.full(len(best), -1)
    source, target, score = node[order], (node + size)[order], score[order]
    for a, b in zip(steps[:-1].tolist(), steps[1:].tolist(), strict=True):
        if a < b:
            total = best[source[a:b]] + score[a:b]
            better = np.flatnonzero(total > best[target[a:b]]) + a  # ties keep the earlier start
            best[target[better]] = total[better - a]
            back[target[better]] = better
    # Walk back from every end at once.
    first, now, owner = offsets[:-1] + np.arange(n), offsets[1:] + np.arange(n), np.arange(n)
    taken, of = [], []
    while len(owner):
        live = now > first[owner]
        now, owner = now[live], owner[live]
        if len(owner):
            m = back[now]
            taken.append(order[m])
            of.append(owner)
            now = source[m]
    if not taken:
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    taken, of = np.concatenate(taken[::-1]), np.concatenate(of[::-1])
    by = np.argsort(of, kind="stable")
    taken, of = taken[by], of[by]
    known = number[taken] >= 0
    width = np.where(known, 1, size[taken])
    at = np.r_[0, np.cumsum(width)]
    which = np.repeat(np.arange(len(taken)), width)
    byte = data[start[taken][which] + np.arange(at[-1]) - at[which]]
    ids = np.where(known[which], p.ids[np.maximum(number[taken], 0)][which], p.byte_ids[byte])
    return ids, np.r_[0, np.cumsum(np.bincount(of, width, n))].astype(np.int64)


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of runs laid end to end."""
    at = np.r_[0, np.cumsum(size)]
    return np.repeat(start - at[:-1], size) + np.arange(at[-1])


def encode_slice(p: Pieces, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece ids, offsets of each text's ids); a text that isn't empty gets a white space mark in front."""
    n = len(offsets) - 1
    filled = np.diff(offsets) > 0
    data = np.insert(data, offsets[:-1][filled], 0x20)
    offsets = offsets + np.r_[0, np.cumsum(filled)]
    if p.by_words:
        blank = data == 0x20
        begin = blank.copy()
        begin[1:] &= ~blank[:-1]
        begin[offsets[:-1][filled]] = True
        begin = np.flatnonzero(begin)
    else:
        begin = offsets[:-1][filled]
    end = np.r_[begin[1:], len(data)][:len(begin)]
    _, first, again = np.unique(tv.hash_spans(data, begin, end), return_index=True, return_inverse=True)
    size = (end - begin)[first]
    ids, at = best_pieces(p, data[_runs(begin[first], size)], np.r_[0, np.cumsum(size)])
    width = np.diff(at)[again]
    text = np.searchsorted(offsets, begin, "right") - 1
    return ids[_runs(at[:-1][again], width)], np.r_[0, np.cumsum(np.bincount(text, width, n))].astype(np.int64)


def decode_slice(p: Pieces, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of each text) that the pieces spell, the mark in front of a text removed."""
    width = np.diff(p.spelled_at)[ids]
    data = p.spelled[_runs(p.spelled_at[ids], width)]
    offsets = np.r_[0, np.cumsum(width)][at]
    front = offsets[:-1][np.diff(offsets) > 0]
    front = front[data[front] == 0x20]
    return np.delete(data, front), offsets - np.searchsorted(front, offsets)


def _marked(column: pa.Array) -> pa.Array:
    """U+2581 in a text is the mark itself, so it reads as a space."""
    import pyarrow.compute as pc

    return pc.replace_substring(pc.fill_null(column.cast(pa.large_string()), ""), "▁", " ")


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL) -> DataFrame:
    """One row per row of ``docs``: id, ids (piece ids), n_tokens and lossless (decoding gives the whole text back).

    A null or empty text has no pieces; an empty one is lossless, for a null one
    lossless is null. A text with U+2581 decodes with a space in its place and
    is not lossless. Null and repeated ids pass through; other columns of ``docs`` are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(vars(Pieces.load(model_path)))

    def run(batches):
        p = Pieces(**held.value)
        for batch in batches:
            texts = batch.column(1)
            whole, whole_at = tv.utf8(texts)
            for i, j, data, offsets in tv.text_slices(_marked(texts), SLICE_BYTES):
                ids, at = encode_slice(p, data, offsets)
                back, back_at = decode_slice(p, ids, at)
                same = _equal_texts(back, back_at, whole[whole_at[i]:whole_at[j]], whole_at[i:j + 1] - whole_at[i])
                null = texts.slice(i, j - i).is_null().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array(np.diff(at)), pa.array(same, mask=null)], ["id", "ids", "n_tokens", "lossless"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, ids array<int>, n_tokens long, lossless boolean").withColumnRenamed("id", id_col)


def _equal_texts(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray) -> np.ndarray:
    same = np.diff(a_at) == np.diff(b_at)
    if same.all():
        return tv.sums((a != b).astype(np.int64), a_at) == 0
    return np.array([s and bool((a[u:v] == b[x:y]).all()) for s, u, v, x, y in
                     zip(same.tolist(), a_at[:-1].tolist(), a_at[1:].tolist(), b_at[:-1].tolist(), b_at[1:].tolist(), strict=True)], bool)


def decode_texts(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model_path: str = MODEL) -> DataFrame:
    """One row per row of ``tokens``: id and the text its piece ids spell.

    Null ids lists give null, empty ones an empty text. Bytes that aren't UTF-8
    become U+FFFD; control pieces spell nothing; null or unknown ids read as the unknown piece.
    """
    held = tokens.sparkSession.sparkContext.broadcast(vars(Pieces.load(model_path)))

    def run(batches):
        p = Pieces(**held.value)
        for batch in batches:
            lists = batch.column(1)
            ids = np.array([x if x is not None and 0 <= x < len(p.spelled_at) - 1 else 0 for x in lists.flatten().to_pylist()], np.int64)
            sizes = np.array([0 if x is None else len(x) for x in lists.to_pylist()], np.int64)
            data, at = decode_slice(p, ids, np.r_[0, np.cumsum(sizes)])
            raw, at = data.tobytes(), at.tolist()
            text = [raw[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))], ["id", "text"])

    rows = tokens.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)
