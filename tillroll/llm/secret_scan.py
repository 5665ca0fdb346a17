"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression. From its parse tree follow the literal
strings that a match may consist of, with gaps where many characters fit; the
trigrams of one such string are a clause, all of which a text must hold, and a
rule is the "or" of its clauses. Postings (trigram, document) are kept for the
trigrams that any clause names; intersecting them clause by clause gives each
document's candidate rules, and the expression itself is then run on the whole
text of the candidates. A rule with a string that has no trigram (long
character classes only) scans every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import staged

GAP = "\0"
FILTER_BITS = 23
MOST_STRINGS = 256  # beyond it a part of an expression counts as a gap, which only widens the candidates


@dataclass(frozen=True)
class Rule:
    """``group`` and ``least``: a match counts if that group has so many characters."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base kinds, in their order, then the added ones.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hub", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE + ADDED


def _strings(tree) -> set[str]:
    """The strings a parse tree matches, lower-cased, GAP for parts that aren't spelled out."""
    found = {""}
    for op, arg in tree:
        op = str(op)
        if op == "LITERAL":
            here = {chr(arg).lower()}
        elif op == "IN" and all(str(o) == "LITERAL" for o, _ in arg) and len(arg) <= 4:
            here = {chr(c).lower() for _, c in arg}
        elif op == "BRANCH":
            here = set().union(*(_strings(t) for t in arg[1]))
        elif op == "SUBPATTERN":
            here = _strings(arg[3])
        elif op == "MAX_REPEAT":
            low, high, inner = arg
            if high == 1:
                here = {""} | _strings(inner) if low == 0 else _strings(inner)
            elif low == 0:
                here = {GAP}
            else:
                here = {s + GAP for s in _strings(inner)}
        elif op == "AT":
            here = {""}
        else:
            here = {GAP}
        both = {a + b for a, b in product(found, here)} if len(found) * len(here) <= MOST_STRINGS else {a + GAP for a in found}
        found = both
    return found


def clauses(pattern: str) -> list[frozenset[str]]:
    """The Boolean trigram query of an expression: one of these sets must be held whole. Empty: nothing is mandatory."""
    sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2) if GAP not in s[i:i + 3]) for s in _strings(re._parser.parse(pattern))}
    if frozenset() in sets:
        return []
    return sorted((c for c in sets if not any(d < c for d in sets)), key=sorted)


def _plan(rules: tuple[Rule, ...]) -> tuple[list[str], list[tuple[int, frozenset[str]]]]:
    """(the trigrams to index, (rule number, clause) pairs)."""
    terms = [(n, c) for n, r in enumerate(rules) for c in clauses(r.pattern)]
    return sorted(set().union(*(c for _, c in terms))), terms


def postings(docs: DataFrame, trigrams: list[str], id_col: str, text_col: str) -> DataFrame:
    """The index: (trigram number, id) for every trigram of the list that a text holds, in either case."""
    low = docs.select(F.col(id_col).alias("id"), F.lower(F.col(text_col).cast("string")).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(n)) for n, t in enumerate(trigrams)]))
    return low.select("id", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, trigrams: list[str], terms: list[tuple[int, frozenset[str]]]) -> DataFrame:
    """(id, rules): a bit for every rule of which the postings hold a whole clause."""
    uses: dict[int, list] = {n: [] for n in range(len(trigrams))}
    for c, (rule, clause) in enumerate(terms):
        for p, t in enumerate(sorted(clause)):
            uses[trigrams.index(t)].append((c, rule, p, len(clause)))
    kind = "array<struct<clause:int,rule:int,place:int,size:int>>"
    of = F.from_json(F.lit("[" + ",".join("[" + ",".join(f'{{"clause":{c},"rule":{r},"place":{p},"size":{z}}}' for c, r, p, z in uses[n]) + "]"
                                          for n in range(len(trigrams))) + "]"), f"array<{kind}>")
    met = index.select("id", F.explode(F.get(of, F.col("trigram"))).alias("x")).select("id", "x.*")
    whole = (met.groupBy("id", "clause", "rule", "size").agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("held"))
             .where("held = shiftleft(1L, size) - 1"))
    return whole.groupBy("id").agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("rules"))


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """(start, kind number, end) of a rule's matches: what lies between the matches and their lengths give the places."""
    pattern = F.lit(rule.pattern)
    between, found = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["b"])
        end = start + F.length(x["m"])
        span = F.array(F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end")))
        if rule.least:
            enough = F.length(F.regexp_extract(x["m"], rule.pattern, rule.group) if rule.group else x["m"]) >= rule.least
            span = F.when(enough, span).otherwise(none)
        return F.struct(end.alias("at"), F.concat(acc["out"], span).alias("out"))

    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, m: F.struct(b.alias("b"), m.alias("m")))
    walked = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), add)["out"]
    return F.when(F.regexp_like(text, pattern), walked).otherwise(none)


def _may_hold(docs: DataFrame, ids: DataFrame, id_col: str, name: str) -> DataFrame:
    """``docs`` with a boolean column: false only where the row's id is surely none of ``ids``.

    The hashes of the ids are a bitmap of 2**FILTER_BITS bits in rows of 4 KB (1 MB in all, whatever the input),
    which is what is broadcast. It only spares shuffling rows; a join decides.
    """
    def place(column: str) -> tuple[Column, Column]:
        h = F.pmod(F.xxhash64(F.col(f"`{column}`")), F.lit(2 ** FILTER_BITS))
        return F.floor(h / 32768), F.pmod(h, F.lit(32768))

    part, bit = place(ids.columns[0])
    bitmap = ids.select(part.alias("p"), bit.alias("b")).groupBy("p").agg(F.bitmap_construct_agg("b").alias("m"))
    row, held = _free(docs.columns, "__part", "__map")
    part, bit = place(id_col)
    byte = F.conv(F.hex(F.substring(F.col(held), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    test = F.coalesce(F.floor(byte / F.pow(F.lit(2), F.pmod(bit, F.lit(8)))) % 2 == 1, F.lit(False))
    return docs.join(F.broadcast(bitmap.toDF(row, held)), part == F.col(row), "left").select(*[F.col(f"`{c}`") for c in docs.columns], test.alias(name))


def _free(taken: list[str], *names: str) -> list[str]:
    """The names, each with underscores before it until no column of ``taken`` has it."""
    low = {c.lower() for c in taken}
    out = []
    for n in names:
        while n.lower() in low:
            n = f"_{n}"
        out.append(n)
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``__secrets``: the spans (start, kind number, end) of every rule's matches, by start, then kind.

    Places are code points, the end exclusive. A null or empty text has none.
    Rows with null or repeated ids are scanned like any other: candidates are
    found by id, and each row's own text is then matched. Only rows that may be
    candidates are shuffled; the others are scanned where they are, for the
    rules without a trigram. An empty table stays empty. ``__secrets`` replaces
    a column of that name; all others stay as they are.
    """
    trigrams, terms = _plan(rules)
    docs = docs.drop("__secrets")
    own, bits, flag = _free(docs.columns, "__id", "__rules", "__may")
    found = staged(candidates(postings(docs, trigrams, id_col, text_col), trigrams, terms).toDF(own, bits), "secret-candidates")
    marked = _may_hold(docs, found.select(own), id_col, flag)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    likely = marked.where(F.col(flag)).join(found, F.col(f"`{id_col}`").eqNullSafe(F.col(own)), "left").select(*columns, bits)
    rows = likely.union(marked.where(~F.col(flag)).select(*columns, F.lit(None).cast("long").alias(bits)))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    selective = {n for n, _ in terms}
    spans = [F.when(F.coalesce(F.col(bits), F.lit(0)).bitwiseAND(F.lit(2 ** n)) != 0, _spans(text, r, n)).otherwise(none) if n in selective else _spans(text, r, n)
             for n, r in enumerate(rules)]
    return rows.select(*columns, F.sort_array(F.concat(*spans)).alias("__secrets"))


def joined_spans(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    def cut(acc: Column, x: Column) -> Column:
        piece = F.when(x["start"] >= acc["at"], F.concat(F.substr(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))).otherwise("")
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.concat(acc["out"], piece).alias("out"))

    walked = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), cut,
                         lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, walked).otherwise(text)


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the secrets in its texts replaced; null texts stay null, other columns stay as they are."""
    rows = find_secrets(docs, id_col, text_col, rules)
    return rows.select(*[(redacted(F.col(f"`{c}`").cast("string"), F.col("__secrets")) if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns])
