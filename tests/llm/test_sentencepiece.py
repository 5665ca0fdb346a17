import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from tillroll.llm import sentencepiece_unigram as sp
from tillroll.llm import textvec as tv

from .cases import TEXTS, docs, empty, table


@pytest.fixture(scope="module")
def pieces():
    return sp.Pieces.load()


def brute(p, text):
    """Plain Viterbi over a dictionary."""
    at = np.flatnonzero(p.value >= 0)
    if not hasattr(brute, "words"):
        m = sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)
        brute.words = {m.id_to_piece(i).replace("▁", " "): (i, m.get_score(i)) for i in range(m.get_piece_size())
                       if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))}
        brute.longest = max(map(len, brute.words))
        assert len(at) == len(brute.words)
    if not text:
        return []
    text = " " + text.replace("▁", " ")
    best, back = [0.0] + [-np.inf] * len(text), [None] * (len(text) + 1)
    for i in range(len(text)):
        for j in range(i + 1, min(i + brute.longest, len(text)) + 1):
            w = text[i:j]
            if w in brute.words or j == i + 1:
                ids, s = ([brute.words[w][0]], brute.words[w][1]) if w in brute.words else (p.byte_ids[list(w.encode())].tolist(), p.unknown)
                if best[i] + s > best[j]:
                    best[j], back[j] = best[i] + s, (i, ids)
    out, j = [], len(text)
    while j:
        i, ids = back[j]
        out, j = ids + out, i
    return out


def encode(p, texts):
    data, offsets = tv.utf8(sp._marked(pa.array(texts, pa.string())))
    ids, at = sp.encode_slice(p, data, offsets)
    back, back_at = sp.decode_slice(p, ids, at)
    return ([ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)],
            [back[a:b].tobytes().decode() for a, b in zip(back_at, back_at[1:], strict=False)])


AWKWARD = ["", " ", "  a  b ", "日本語 текст \n\t\x00x", "a" * 700, "▁x", "é" * 50, "\n", " 😀 ok", "a\nb c", "   lead", "trail   ", "the The THE the"]


def test_equals_a_plain_viterbi(pieces, spark):
    texts = AWKWARD + [r.text[:300] for r in table(spark, "documents").limit(60).collect() if r.text]
    ids, back = encode(pieces, texts)
    assert ids == [brute(pieces, t) for t in texts]
    assert back == [t.replace("▁", " ") for t in texts]


def _as_unigram(raw):
    """The model file with its model type set to unigram (field 3 of field 2)."""
    def varint(b, i):
        v = s = 0
        while True:
            v |= (b[i] & 127) << s
            s, i = s + 7, i + 1
            if b[i - 1] < 128:
                return v, i

    def fields(b):
        i = 0
        while i < len(b):
            first = i
            key, i = varint(b, i)
            if key & 7 == 0:
                _, i = varint(b, i)
            elif key & 7 == 2:
                n, i = varint(b, i)
                i += n
            else:
                i += 8 if key & 7 == 1 else 4
            yield key >> 3, first, i

    out = b""
    for number, a, b in fields(raw):
        if number == 2:
            _, i = varint(raw, a)
            n, i = varint(raw, i)
            body = raw[i:i + n]
            body = b"".join(b"\x18\x01" if f == 3 else body[x:y] for f, x, y in fields(body))
            size, n = b"", len(body)
            while n > 127:
                size, n = size + bytes([n & 127 | 128]), n >> 7
            out += b"\x12" + size + bytes([n]) + body
        else:
            out += raw[a:b]
    return out


def test_equals_the_library_where_its_sums_are_exact(pieces, spark):
    """Against the best of the library's lattice search. Pieces of score -1e9 (and unknown characters) make its
    32-bit sums lose the other scores, so it is compared on words whose best pieces have none of them."""
    with open(sp.MODEL, "rb") as f:
        lib = sentencepiece.SentencePieceProcessor(model_proto=_as_unigram(f.read()))
    words = sorted({w for r in table(spark, "documents").collect() if r.text for w in r.text.split() if w.isalpha()})
    exact = [(t, ids) for t, ids in zip(words, encode(pieces, words)[0], strict=True) if all(lib.get_score(i) > -1e8 for i in ids)]
    assert len(exact) > 500

    def total(ids):
        return sum(lib.get_score(i) for i in ids)
    for t, ids in exact:
        best = lib.nbest_encode_as_ids(t, 2)[0]
        assert ids == best or total(ids) == total(best), t


def test_trie_holds_just_its_words():
    words = [b"a", b"ab", b"abc", b"b", b"ba", b"\xff\x00", b"zzz"]
    base, check, value = sp.double_array(words)

    def find(w):
        s = 0
        for c in w:
            n = base[s] + c
            if check[n] != s:
                return -1
            s = n
        return value[s]
    assert [find(w) for w in words] == list(range(len(words)))
    assert all(find(w) == -1 for w in (b"z", b"c", b"abcd", b"\x00", b"\xff", b"bb"))


def test_operator_round_trip(spark):
    out = sp.encode_texts(docs(spark))
    back = {(r.doc_id, r.text) for r in sp.decode_texts(out).collect()}
    want = {(i, t) for i, t, _ in TEXTS if t is not None} | {(i, "") for i, t, _ in TEXTS if t is None}
    assert back == want
    for r in out.collect():
        assert r.n_tokens == len(r.ids) and r.lossless in (True, None)
    assert sum(r.lossless is None for r in out.collect()) == sum(t is None for _, t, _ in TEXTS)


def test_decoding_odd_ids(spark):
    rows = [(1, [3 + 0xE2, 3 + 0x82]), (2, None), (3, []), (4, [1, 2]), (None, [99_999_999, None, -5])]
    got = {r.doc_id: r.text for r in sp.decode_texts(spark.createDataFrame(rows, "doc_id long, ids array<int>")).collect()}
    assert "�" in got[1] and got[2] is None and got[3] == "" and got[4] == "" and "⁇" in got[None]


def test_empty_table(spark):
    assert sp.encode_texts(empty(spark)).collect() == []
