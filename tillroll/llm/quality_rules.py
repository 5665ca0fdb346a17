"""Risk-controlled quality rules, in DataFrame functions only.

Each rule rejects a text whose value (per thousand) is over a cutoff. The
cutoff comes from labelled holdouts: in every stratum the candidate cutoffs, which
hold for all rules at once, are tested from the loosest to the tightest. One is
certified if an exact binomial test rejects "more than ``risk`` of the good documents
would go", by whichever rules, and all looser ones are certified; testing in a fixed
order and stopping at the first failure needs no correction for the number of
cutoffs. Over the strata the level is ``delta`` / strata (Bonferroni), so with
probability 1 - delta no stratum loses more than ``risk`` of its good
documents to the rules, whichever certified cutoffs are then chosen. Of the
certified cutoffs, the one that rejects the most bad documents is used, each
good one rejected counting against ``price`` bad ones; without a gain, or
without a certificate (too few labels), the rules reject nothing there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import staged

SPACES = r"\x20\x09-\x0D"
SYMBOLS = r"[#*$%&|<>]"
RULES = ("symbols", "dup_lines", "repeats", "capitals", "shouts")
CUTOFFS = (10, 20, 50, 100, 150, 200, 300, 400, 500, 700, 1000, 2000)
RISK, DELTA, PRICE = 0.02, 0.05, 5


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` and a struct ``__q`` of its base counts and rule values."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.withColumns({
        "__w": F.array_remove(F.split(text, f"[{SPACES}]+"), ""),
        "__l": F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(" \t\n\x0b\f\r")) != ""),
    })
    n = F.size("__w")
    hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)))
    out = out.withColumn("__h", F.when(n >= 3, hashes).otherwise(F.array().cast("array<bigint>")))
    # Windows found twice or more: equal neighbours once the windows are sorted.
    sized = F.size("__h")
    sort = F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("__s", F.when(F.size(F.array_distinct("__h")) < sized, sort))
    twins = F.zip_with(F.slice("__s", 1, sized - 1), F.slice("__s", 2, sized - 1),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    out = out.withColumn("__p", F.when(F.col("__s").isNotNull(), F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda x: x.isNotNull()))))))
    # A window covers three words; one that starts g words after the last adds min(3, g).
    gaps = F.zip_with(F.slice("__p", 1, F.size("__p") - 1), F.slice("__p", 2, F.size("__p") - 1), lambda a, b: F.least(b - a, F.lit(3)))
    covered = F.when(F.col("__p").isNotNull(), F.lit(3) + F.aggregate(gaps, F.lit(0), lambda x, y: x + y)).otherwise(0)
    long = {"n_words": n, "word_chars": F.length(F.concat_ws("", "__w")), "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
            "n_dup_lines": F.size("__l") - F.size(F.array_distinct("__l")), "n_repeat_words": covered,
            "n_lines": F.size("__l"), "n_capitals": F.regexp_count(text, F.lit(r"\p{Lu}")), "n_shouts": F.regexp_count(text, F.lit("!"))}
    out = out.withColumn("__q", F.struct(*[c.cast("long").alias(k) for k, c in long.items()])).drop("__w", "__l", "__h", "__s", "__p")

    def q(name: str) -> Column:
        return F.col("__q")[name]

    share = {"symbols": (q("n_symbols"), q("n_words")), "dup_lines": (q("n_dup_lines"), q("n_lines")),
             "repeats": (q("n_repeat_words"), q("n_words")), "capitals": (q("n_capitals"), q("word_chars")),
             "shouts": (q("n_shouts"), q("n_words"))}
    values = [F.when(b > 0, F.floor(a * 1000 / b)).otherwise(0).cast("long").alias(k) for k, (a, b) in share.items()]
    failed = (q("n_words") < 50) | (100 * q("n_repeat_words") > 50 * q("n_words"))
    return out.withColumn("__q", F.struct("__q.*", failed.alias("base_failed"), *values))


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), from above: the largest term by Stirling's series with its
    remainder added, then the falling terms one by one, then a geometric bound on the rest.

    Terms below k fall once k < n * p; elsewhere 1 is returned (no certificate
    is possible there). The number of terms is about the square root of n.
    """
    def log_factorial(x: Column) -> Column:
        y = x + 8.0  # x! = (x + 7)! / ((x + 1) ... (x + 7)); the series is exact to 1e-11 from 8 on
        series = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3))) + 1 / (1260 * F.pow(y, F.lit(5)))
        return series - reduce(lambda a, b: a + b, (F.log(x + i) for i in range(1, 8)))

    k, n = k.cast("double"), n.cast("double")
    top = F.exp(log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * F.log(F.lit(p)) + (n - k) * F.log1p(F.lit(-p)))
    steps = F.least(k, F.ceil(12 * F.sqrt(n)) + 50).cast("int")
    odds = (1 - p) / p
    start = F.struct(top.alias("term"), top.alias("sum"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] * (k - i + 1) / (n - k + i) * odds
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    walked = F.aggregate(F.when(steps >= 1, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")), start, step)
    last = F.greatest((k - steps) / (n - k + steps + 1) * odds, F.lit(0.0))
    rest = walked["term"] * last / (1 - F.least(last, F.lit(0.999999)))
    return F.when((n > 0) & (k < n * p), F.least((walked["sum"] + rest) * (1 + 1e-9), F.lit(1.0))).otherwise(1.0)


def certified_cutoffs(values: DataFrame, risk: float = RISK, delta: float = DELTA, price: int = PRICE) -> DataFrame:
    """From rows (stratum, good boolean, one value per rule): stratum and its cutoff (null: none)."""
    worst = F.greatest(*RULES)
    counts = []
    for c in CUTOFFS:
        counts += [F.count_if((worst > c) & F.col("good")).alias(f"g_{c}"), F.count_if((worst > c) & ~F.col("good")).alias(f"b_{c}")]
    wide = staged(values.groupBy("stratum").agg(F.count_if("good").alias("n"), *counts), "quality-counts")
    level = delta / max(wide.count(), 1)
    cells = wide.select("stratum", "n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("cutoff"), F.col(f"g_{c}").alias("good"), F.col(f"b_{c}").alias("bad"))
        for c in CUTOFFS])).alias("x")).select("stratum", "n", "x.*")
    sure = binomial_cdf(F.col("good"), F.col("n"), risk) <= level
    looser = Window.partitionBy("stratum").orderBy(F.col("cutoff").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("certified", F.min(sure).over(looser))
    gain = F.col("bad") - price * F.col("good")
    best = cells.where(F.col("certified") & (gain > 0)).groupBy("stratum").agg(F.max_by("cutoff", F.struct(gain, F.col("cutoff"))).alias("cutoff"))
    return staged(wide.select("stratum").join(best, "stratum", "left").select("stratum", F.col("cutoff").cast("long").alias("cutoff")), "quality-cutoffs")


def _values(docs: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    """id, stratum and the features of every row, written once: a few numbers a row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
                       F.col(text_col).cast("string").alias("text"))
    return staged(with_features(rows, "text").select("id", "stratum", "__q.*"), "quality-values")


def _cutoffs(values: DataFrame, labels: DataFrame, id_col: str, risk: float, delta: float, price: int) -> DataFrame:
    graded = labels.where("quality is not null").groupBy(F.col(id_col).alias("id")).agg((F.max("quality") == 1).alias("good"))
    return certified_cutoffs(values.where("not base_failed").join(graded, "id"), risk, delta, price)


def _rejected_by(value, cutoff: Column) -> Column:
    return F.filter(F.array(*[F.when(value(r) > cutoff, F.lit(r)) for r in RULES]), lambda x: x.isNotNull())


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
                  risk: float = RISK, delta: float = DELTA, price: int = PRICE) -> DataFrame:
    """One row per row of ``docs``: its id, the base counts, base_failed, kept, one value per rule and rejected_by (rule names).

    ``labels`` has ``id_col`` and quality (1 good, 0 bad, null: no label); of several
    labels of an id any 1 makes it good. Base-failed documents take no part in
    choosing cutoffs. A null text counts as empty (base_failed). Null strata are
    one stratum. Rows with null or repeated ids are judged like any other. An
    empty ``labels`` gives no cutoffs, so kept is then not base_failed; an empty
    ``docs`` gives an empty result. Other columns of ``docs`` are not read.
    """
    values = _values(docs, id_col, text_col, stratum_col)
    cuts = _cutoffs(values, labels, id_col, risk, delta, price)
    judged = values.join(cuts, "stratum", "left").withColumn("rejected_by", _rejected_by(F.col, F.col("cutoff")))
    return judged.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"), "rejected_by", *RULES)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
              risk: float = RISK, delta: float = DELTA, price: int = PRICE) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns.

    The features are computed again beside the text rather than joined to it, so
    no text is shuffled. The row number in the filter keeps the optimizer from
    writing the feature expressions into a filter of their own.
    """
    cuts = _cutoffs(_values(docs, id_col, text_col, stratum_col), labels, id_col, risk, delta, price)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"))
    rows = with_features(rows, "text").withColumn("row", F.monotonically_increasing_id())
    judged = rows.join(cuts, "stratum", "left")
    hits = _rejected_by(lambda r: F.col("__q")[r], F.col("cutoff"))
    return judged.where(~F.col("__q")["base_failed"] & (F.size(hits) == 0) & (F.col("row") >= 0)).select("doc.*")
