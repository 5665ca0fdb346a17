"""Main text of web pages by a recurrent block labeller.

A page is read into its leaf blocks of text in page order, each with the path
of elements around it (tags and their class and id words) and the group it
stands in: the last element around it that is more than a paragraph or the like.
A bidirectional LSTM in numpy reads the blocks' hashed path and word vectors and
the size and link share of their groups, so that the whole page stands behind
every decision, and gives each block the log-odds of being main text. Blocks of
a group share their mean log-odds; to that of a list, table, unnamed leaf div or
named paragraph its surrounding group's is added. Nothing else decides.

The labeller is trained on a bounded sample of the pages. The labels come from
markup that says what it is: text within article or main is main text, unless
it is within navigation, a form, or an element in there that is named after
adverts, comments and the like. Every sampled page also gives variants, so that
no single name decides: its article as an element named otherwise, by a
misleading word or not at all, its other parts without their names, and more
such parts around and within it.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashed_text import run_sums, sigmoid

BITS = 12
DIM = 16
HIDDEN = 12
DENSE = 7
TRAIN_PAGES = 300  # about
VARIANTS = 2        # of each, drawn anew in every epoch

# Names from HTML, and the words that sites give to what isn't main text.
RAW = {"script", "style", "textarea", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q",
          "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "math", "mi", "mn", "mo", "ms", "mtext", "mrow", "mfrac", "msup", "msub", "msqrt", "svg", "g", "path", "use"}
LISTS = {"ul", "ol", "dl", "table"}
LEAF = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "tr", "tbody", "thead", "tfoot", "pre", "blockquote", "figure", "figcaption", "caption", "address", "center"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
OTHER_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "head", "noscript", "template", "iframe", "object", "canvas", "audio", "video", "select", "button"}
OTHER_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "promo", "sponsor", "sponsored", "cookie", "cookies", "consent",
               "notice", "alert", "sidebar", "aside", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "comment", "comments",
               "reply", "replies", "disqus", "share", "sharing", "social", "related", "newsletter", "subscribe", "signup", "popup", "modal", "toolbar",
               "pagination", "pager", "widget", "disclaimer", "copyright", "login", "search"}
MAIN_WORDS = ("content", "post", "entry", "story", "text", "body", "article-body", "page")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^<>]*+>", re.S)
_NAME = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_BLANKS = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]   # elements around it, as tag or tag.words, from the root
    linked: int             # characters inside links
    group: int = 0          # number of the element that is its group
    around: int = -1        # the group around that one, where it has a say too


def _element(tag: str, attributes: str) -> str:
    words = [w for m in _NAME.finditer(attributes) for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower())] if "=" in attributes else []
    return ".".join([tag, *words])


def blocks_of(page: str) -> list[Block]:
    """The leaf blocks of a page. Inline elements, images and line breaks don't end a block; every other element does.

    Scripts, styles, titles, text areas and comments are not text; one that nobody closes runs to the
    end. All other elements that nobody closes end with the element around them.
    """
    out: list[Block] = []
    stack: list[str] = []   # elements as in Block.path
    tags: list[str] = []
    numbers: list[int] = []
    parts: list[str] = []
    linked = opened = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _BLANKS.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                around = [(e, n) for e, t, n in zip(stack, tags, numbers, strict=True) if t not in INLINE]
                out.append(Block(text, tuple(e for e, _ in around), linked, *_groups(around)))
            parts.clear()
        linked = 0

    def pop_to(i: int) -> None:
        del stack[i:], tags[i:], numbers[i:]

    def push(e: str, tag: str) -> None:
        nonlocal opened
        opened += 1
        stack.append(e)
        tags.append(tag)
        numbers.append(opened)

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        cut = m.start() if m else end
        if cut > at:
            parts.append(page[at:cut])
            if "a" in tags:
                linked += cut - at
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag not in INLINE:
                flush()
            if tag in tags:
                pop_to(len(tags) - 1 - tags[::-1].index(tag))
            elif tag == "p":
                flush()
            continue
        if tag in {"br", "img", "wbr"}:
            if tag == "br":
                parts.append(" ")
            continue
        if tag in INLINE:
            push(tag, tag)
            continue
        flush()
        if tag in VOID:
            continue
        if "p" in tags and tag not in RAW:      # a block ends an open paragraph and what is open within it
            last = len(tags) - 1 - tags[::-1].index("p")
            if all(t in INLINE for t in tags[last + 1:]):
                pop_to(last)
        for t in CLOSES.get(tag, ()):
            if t in tags:
                last = len(tags) - 1 - tags[::-1].index(t)
                if not {"ul", "ol", "dl", "table"} & set(tags[last + 1:]):
                    pop_to(last)
        while tags and tags[-1] in INLINE and tag not in RAW:
            pop_to(len(tags) - 1)               # a block inside an inline element that nobody closed
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if not (m[3] or "").rstrip().endswith("/"):
            push(_element(tag, m[3] or ""), tag)
    flush()
    return out


def _groups(path: list[tuple[str, int]]) -> tuple[int, int]:
    """(group, group around it or -1) of a block, from the elements around it and their numbers."""
    weak = -1
    for at in range(len(path) - 1, -1, -1):
        e, number = path[at]
        tag, _, names = e.partition(".")
        if tag in LEAF and not names:
            continue
        if tag in LEAF or (not names and (tag in LISTS or (tag == "div" and at == len(path) - 1))):
            weak = number if weak < 0 else weak
            continue
        return (number, -1) if weak < 0 else (weak, number)
    return (0, -1) if weak < 0 else (weak, 0)


def _marked(path: tuple[str, ...]) -> int:
    """Where on the path the first article or main is; -1 without one."""
    return next((i for i, e in enumerate(path) if e.split(".")[0] in {"article", "main"}), -1)


def weak_labels(blocks: list[Block]) -> list[bool]:
    """Main text by the markup, for training: what is in article or main, but not in an element in there that names something else."""
    def good(path: tuple[str, ...]) -> bool:
        at = _marked(path)
        return at >= 0 and not any(tag in OTHER_TAGS or OTHER_WORDS & set(names)
                                   for tag, *names in (e.split(".") for e in path[at + 1:])) and not OTHER_TAGS & {e.split(".")[0] for e in path[:at]}

    return [good(b.path) for b in blocks]


def _bucket(word: str, salt: str) -> int:
    return zlib.crc32((salt + word).encode()) % 2 ** BITS


def features(pages: list[list[Block]]) -> tuple[np.ndarray, ...]:
    """(path buckets, their offsets, word buckets, their offsets, dense features) of all blocks of the pages, one after the other."""
    tokens, at, words, words_at, dense = [], [0], [], [0], []
    known: dict[str, int] = {}

    def bucket(w: str, salt: str) -> int:
        k = known.get(salt + w)
        if k is None:
            k = known[salt + w] = _bucket(w, salt)
        return k

    for blocks in pages:
        own = [b.text.lower().split() for b in blocks]
        total = sum(map(len, own))
        sizes: dict[int, list[int]] = {}    # words, characters, those inside links
        for b, w in zip(blocks, own, strict=True):
            for g in {b.group, b.around} - {-1}:
                n = sizes.setdefault(g, [0, 0, 0])
                n[0] += len(w)
                n[1] += len(b.text)
                n[2] += b.linked
        for i, (b, w) in enumerate(zip(blocks, own, strict=True)):
            for e in b.path:
                tag, *names = e.split(".")
                tokens.append(bucket(tag, "t:"))
                tokens += [bucket(x, "n:") for x in names]
            last = next((e for e in reversed(b.path) if e.split(".")[0] not in LEAF), "none").split(".")
            tokens += [bucket(x, "g:") for x in last]
            tokens.append(bucket("leaf " + b.path[-1].split(".")[0] if b.path else "none", "t:"))
            at.append(len(tokens))
            words += [bucket(x, "w:") for x in w]
            words_at.append(len(words))
            n = sizes[b.group]
            dense.append((min(np.log1p(len(w)) / 6, 1.5), min(b.linked / max(len(b.text), 1), 1.0), i / max(len(blocks) - 1, 1), 1.0,
                          min(np.log1p(n[0]) / 8, 1.5), min(n[2] / max(n[1], 1), 1.0), n[0] / max(total, 1)))
        if len(known) > 500_000:
            known.clear()
    return (np.array(tokens, np.int64), np.array(at), np.array(words, np.int64), np.array(words_at), np.array(dense, np.float32).reshape(-1, DENSE))


def _means(table: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    return run_sums(table[ids], at) / np.maximum(np.diff(at), 1)[:, None].astype(np.float32)


def _lstm(x: np.ndarray, live: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states (T, pages, HIDDEN) over inputs (T, pages, inputs); a page's state rests where ``live`` is 0."""
    pre = x @ w + b
    h = np.zeros((x.shape[1], HIDDEN), np.float32)
    c = np.zeros_like(h)
    out = np.zeros((*x.shape[:2], HIDDEN), np.float32)
    for t in range(len(x)):
        z = pre[t] + h @ u
        s = 1 / (1 + np.exp(-z[:, :3 * HIDDEN]))
        i, f, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        m = live[t][:, None]
        new = f * c + i * g
        tc = np.tanh(new)
        if keep is not None:
            keep.append((h, c, i, f, o, g, tc, m))
        c = m * new + (1 - m) * c
        h = m * (o * tc) + (1 - m) * h
        out[t] = h
    return out


def _lstm_back(x: np.ndarray, u: np.ndarray, keep: list, dout: np.ndarray) -> tuple[np.ndarray, ...]:
    """Gradients of (pre-activations by step, u)."""
    dpre = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
    du = np.zeros_like(u)
    dh, dc = np.zeros((x.shape[1], HIDDEN), np.float32), np.zeros((x.shape[1], HIDDEN), np.float32)
    for t in range(len(x) - 1, -1, -1):
        h, c, i, f, o, g, tc, m = keep[t]
        dh = dh + dout[t]
        dnew = m * dc + m * dh * o * (1 - tc * tc)
        dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), m * dh * tc * o * (1 - o), dnew * i * (1 - g * g)], axis=1)
        dpre[t] = dz
        du += h.T @ dz
        dh = (1 - m) * dh + dz @ u.T
        dc = (1 - m) * dc + dnew * f
    return dpre, du


def _padded(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(step, reversed step, page) of every block, for pages padded to the longest."""
    page = np.repeat(np.arange(len(sizes)), sizes)
    at = np.r_[0, np.cumsum(sizes)]
    step = np.arange(at[-1]) - at[page]
    return step, sizes[page] - 1 - step, page


def _start(rng) -> dict[str, np.ndarray]:
    p = {"tags": rng.normal(0, 0.3, (2 ** BITS, DIM)), "words": rng.normal(0, 0.05, (2 ** BITS, DIM)), "dense": rng.normal(0, 0.3, (DENSE, DIM)),
         "out": rng.normal(0, 0.3, (2 * HIDDEN, 1)), "out_b": np.zeros(1)}
    for d in "fb":
        p |= {f"w{d}": rng.normal(0, 0.25, (DIM, 4 * HIDDEN)), f"u{d}": rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)), f"b{d}": np.zeros(4 * HIDDEN)}
        p[f"b{d}"][HIDDEN:2 * HIDDEN] = 1
    return {k: v.astype(np.float32) for k, v in p.items()}


def log_odds(p: dict[str, np.ndarray], pages: list[list[Block]], train: np.ndarray | None = None):
    """Log-odds of main text for all blocks; with labels, the gradients of the mean loss too."""
    tokens, at, words, words_at, dense = features(pages)
    sizes = np.array([len(b) for b in pages])
    step, back, page = _padded(sizes)
    if not len(step):
        return (np.zeros(0), {}) if train is not None else np.zeros(0)
    vec = run_sums(p["tags"][tokens], at) + _means(p["words"], words, words_at) + dense @ p["dense"]
    shape = (int(sizes.max()), len(pages), DIM)
    live = np.zeros(shape[:2], np.float32)
    live[step, page] = 1
    hidden, kept, inputs = [], {}, {}
    for d, s in (("f", step), ("b", back)):
        x = np.zeros(shape, np.float32)
        x[s, page] = vec
        keep = [] if train is not None else None
        hidden.append(_lstm(x, live, p[f"w{d}"], p[f"u{d}"], p[f"b{d}"], keep)[s, page])
        kept[d], inputs[d] = keep, x
    h = np.concatenate(hidden, axis=1)
    z = (h @ p["out"])[:, 0] + p["out_b"][0]
    if train is None:
        return z
    dz = ((sigmoid(z) - train) / len(z)).astype(np.float32)
    grads = {"out": h.T @ dz[:, None], "out_b": dz.sum(keepdims=True)}
    dvec = np.zeros_like(vec)
    for k, (d, s) in enumerate((("f", step), ("b", back))):
        dout = np.zeros((*shape[:2], HIDDEN), np.float32)
        dout[s, page] = dz[:, None] * p["out"][k * HIDDEN:(k + 1) * HIDDEN, 0]
        dpre, grads[f"u{d}"] = _lstm_back(inputs[d], p[f"u{d}"], kept[d], dout)
        grads[f"w{d}"] = np.einsum("tbi,tbj->ij", inputs[d], dpre)
        grads[f"b{d}"] = dpre.sum(axis=(0, 1))
        dvec += (dpre @ p[f"w{d}"].T)[s, page]
    grads["dense"] = dense.T @ dvec
    for name, ids, offs, mean in (("tags", tokens, at, False), ("words", words, words_at, True)):
        g = np.zeros_like(p[name])
        size = np.diff(offs)
        each = dvec / np.maximum(size, 1)[:, None].astype(dvec.dtype) if mean else dvec
        np.add.at(g, ids, np.repeat(each, size, axis=0))
        grads[name] = g
    return z, grads


def _variant(blocks: list[Block], rng) -> tuple[list[Block], list[bool]]:
    """A page with the same main text in an element named otherwise, other parts put around and within it, and the labels."""
    text = " ".join(b.text for b in blocks).split() or ["x"]
    count = max((b.group for b in blocks), default=0) + 1
    out: list[Block] = []
    labels: list[bool] = []
    root = ("html", "body")
    plain = rng.random() < 0.35             # a page whose parts have no names

    def one(xs):
        return xs[int(rng.integers(len(xs)))]

    def part(base: tuple[str, ...], named: bool) -> None:
        nonlocal count
        count += 1
        tag = one(["nav", "footer", "aside", "form", "header", "div", "section", "ul", "select", "button"]) if named else one(["div", "div", "section"])
        e = f"{tag}.{one(sorted(OTHER_WORDS))}" if named and (tag in {"div", "section", "ul"} or rng.random() < 0.3) else tag
        leaf = one([("p",), ("li",), ("ul", "li"), ("div",), ("h1",), ("h3",), ()])
        linked = rng.random() < (0.4 if named else 0.7)
        for _ in range(int(rng.integers(1, 6))):
            k = int(rng.integers(0, len(text)))
            t = " ".join((text[k:] + text)[:int(rng.integers(1, 40 if named else 8))])
            out.append(Block(t, (*base, e, *leaf), len(t) if linked else 0, count))
            labels.append(False)

    kind = rng.random()
    if plain:
        main = one([("div",), ("div", "div"), ("section",), ("div", "section")])
    elif kind < 0.4:
        main = one([("article",), ("main",), ("main", "article"), ("div", "article"), (f"div.{one(sorted(OTHER_WORDS))}", "article")])
    else:
        word = one(MAIN_WORDS) if kind < 0.92 else one(sorted(OTHER_WORDS))
        main = (f"{one(['div', 'section', 'article'])}.{word}" + (f".{one(['with', 'no'])}.{one(sorted(OTHER_WORDS))}" if rng.random() < 0.2 else ""),)
        main = (*one([(), ("div",), ("div.page",)]), *main, *one([(), ("div",)]))
    main_group = count = count + 1
    for _ in range(int(rng.integers(0, 4))):
        part(root, not plain)
    for b, good in zip(blocks, weak_labels(blocks), strict=True):
        if good:
            leaf, group = one([b.path[_marked(b.path) + 1:]] * 5 + [("h2",), ("blockquote", "p"), ("div",), ("ul", "li"), ("table", "tr", "td")]), (main_group, -1)
            if leaf and leaf[0] in {"ul", "table", "div"}:
                count += 1
                group = (count, main_group)
            out.append(Block(b.text, (*root, *main, *leaf), b.linked, *group))
            labels.append(True)
            if rng.random() < 0.1:
                part((*root, *main), True)
        elif rng.random() < 0.8:
            path = b.path
            if plain:
                path = tuple("div" if e.split(".")[0] not in LEAF | LISTS | {"html", "body"} else e.split(".")[0] for e in path)
            out.append(Block(b.text, path, b.linked, b.group, b.around))
            labels.append(False)
    for _ in range(int(rng.integers(0, 3))):
        part(root if plain or rng.random() < 0.7 else (*root, *main), not plain)
    return out, labels


def train(pages: list[list[Block]], epochs: int = 20, batch: int = 16, rate: float = 0.01, seed: int = 1) -> dict[str, np.ndarray] | None:
    """The labeller's parameters; None where no page marks its main text."""
    rng = np.random.default_rng(seed)
    pages = [p for p in pages if any(weak_labels(p))]
    if not pages:
        return None
    params = _start(rng)
    first, second = ({k: np.zeros_like(v) for k, v in params.items()} for _ in "12")
    n = 0
    for epoch in range(epochs):
        pairs = [v for p in pages for v in ((p, weak_labels(p)), *(_variant(p, rng) for _ in range(VARIANTS)))]
        order = sorted(rng.permutation(len(pairs)).tolist(), key=lambda i: len(pairs[i][0]) // 16)
        groups = [order[a:a + batch] for a in range(0, len(order), batch)]
        for g in rng.permutation(len(groups)):
            y = np.array([x for i in groups[g] for x in pairs[i][1]], np.float32)
            _, grads = log_odds(params, [pairs[i][0] for i in groups[g]], y)
            n += 1
            size = np.sqrt(sum(float((v * v).sum()) for v in grads.values()))
            for k, v in grads.items():
                v = v * min(1.0, 1.0 / max(size, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.99 * second[k] + 0.01 * v * v
                params[k] -= rate * (1 - 0.8 * epoch / epochs) * (first[k] / (1 - 0.9 ** n)) / (np.sqrt(second[k] / (1 - 0.99 ** n)) + 1e-7)
    return params


def chosen(blocks: list[Block], odds: list[float]) -> list[bool]:
    """Which blocks are main text, given their log-odds: by the mean of their group, plus that of the group around it where it has a say."""
    held: dict[int, list[float]] = {}
    for b, v in zip(blocks, odds, strict=True):
        for g in {b.group, b.around} - {-1}:
            held.setdefault(g, []).append(v)
    mean = {g: sum(v) / len(v) for g, v in held.items()}
    return [mean[b.group] + (mean[b.around] if b.around >= 0 else 0.0) > 0 for b in blocks]


def main_text(pages: list[str], params: dict[str, np.ndarray] | None, group_blocks: int = 20_000) -> list[str]:
    """The main text of each page: the blocks that the labeller chooses, joined by line ends. Without a labeller, all blocks."""
    read = [blocks_of(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i in range(len(pages)) if read[i]), key=lambda i: len(read[i]))
    while order:
        take, size = [], 0
        while order and (not take or (len(take) + 1) * len(read[order[0]]) <= group_blocks):
            size += len(read[order[0]])
            take.append(order.pop(0))
        z = log_odds(params, [read[i] for i in take]) if params else np.ones(size)
        a = 0
        for i in take:
            blocks = read[i]
            keep = chosen(blocks, z[a:a + len(blocks)].tolist())
            a += len(blocks)
            out[i] = "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)
    return out


def fit_pages(pages: DataFrame, html_col: str = "html", most: int = TRAIN_PAGES) -> dict[str, np.ndarray] | None:
    """Train on about ``most`` pages, chosen by the hash of their html; their blocks are read in tasks."""
    rows = pages.select(F.col(html_col).cast("string").alias("html")).where("html <> ''")
    n = rows.count()
    share = min(1.0, most / max(n, 1))
    few = rows.where(F.pmod(F.xxhash64("html"), F.lit(2 ** 24)) < share * 2 ** 24)

    def run(batches):
        for batch in batches:
            for page in batch.column(0).to_pylist():
                blocks = blocks_of(page)
                yield pa.RecordBatch.from_arrays([
                    pa.array([zlib.crc32(page.encode())], pa.int64()), pa.array([[b.text for b in blocks]], pa.list_(pa.string())),
                    pa.array([[" ".join(b.path) for b in blocks]], pa.list_(pa.string())),
                    *(pa.array([[getattr(b, f) for b in blocks]], pa.list_(pa.int64())) for f in ("linked", "group", "around"))],
                    ["h", "texts", "paths", "linked", "group", "around"])

    got = few.mapInArrow(run, "h long, texts array<string>, paths array<string>, linked array<long>, group array<long>, around array<long>").collect()
    got.sort(key=lambda r: (r.h, r.texts))
    return train([[Block(t, tuple(p.split(" ")) if p else (), *n) for t, p, *n in zip(r.texts, r.paths, r.linked, r.group, r.around, strict=True)] for r in got])


def extract_main_text(pages: DataFrame, params: dict[str, np.ndarray] | None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text and n_chars (code points).

    White space inside a block is one space, blocks are joined by one line end,
    nothing else is dropped or cut. Null and empty html, and pages without main
    text, give an empty text. Without a trained labeller (no page marks its main
    text) every block is kept. Null and repeated ids and null urls pass through.
    """
    held = pages.sparkSession.sparkContext.broadcast(params)

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                text = main_text([x or "" for x in part.column(2).to_pylist()], held.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                                                 ["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "id long, url string, text string, n_chars long").withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
