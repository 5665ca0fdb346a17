"""Column expressions shared by the operators. All are JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.contracts import MONEY, MONEY_TOTAL


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_key(date_col: Column | str) -> Column:
    """'yyyy-MM' string of a date: the month key of both marts."""
    return F.date_format(_col(date_col), "yyyy-MM")


def full_name(first: Column | str, last: Column | str) -> Column:
    """first || ' ' || last; null when either part is null (plain concat)."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def fold_columns(cols: list[Column | str]) -> Column:
    """Fold several columns into one comma-joined string.

    Nulls are skipped; all-null gives '' (not null), as concat_ws does.
    """
    return F.concat_ws(",", *[_col(c) for c in cols])


def null_string() -> Column:
    return F.lit(None).cast("string")


def money(c: Column | str) -> Column:
    return _col(c).cast(MONEY)


def money_total(c: Column | str) -> Column:
    return _col(c).cast(MONEY_TOTAL)


def cents(c: Column | str) -> Column:
    """Money as exact integer cents (bigint).

    Sums of decimal(12,2) widen past 18 digits, where Spark falls back from
    long-backed decimals to BigDecimal arithmetic; summing cents keeps the
    aggregate on plain longs (codegen'd, exact, and under ANSI an overflow
    raises instead of wrapping).
    """
    return (_col(c).cast(MONEY) * 100).cast("bigint")


def from_cents(c: Column | str) -> Column:
    """Integer cents back to decimal(18,2), exactly."""
    return (_col(c).cast("decimal(20,0)") / 100).cast(MONEY_TOTAL)


def source_path() -> Column:
    """Path of the file a row came from, in the same (unencoded) form as the
    ``path`` column of the binaryFile source.

    ``_metadata.file_path`` is URL-encoded (a space is %20, a % is %25);
    ``url_decode`` would also turn '+' into a space, so '+' is protected
    first (it is left literal by the encoding).
    """
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def header_fields(line: Column | str) -> Column:
    """Split a CSV header line into column names, as Spark's CSV reader names them.

    Commas inside double quotes do not split; the quotes around a name are
    removed and a doubled quote inside it ("") stands for one quote. Names are
    not trimmed. A blank name is called _c and its position.

    The line is cut at its quotes: every second piece is quoted, and only the
    commas of the other pieces separate names. Each step is one pass, whatever
    the length of the line.
    """
    sep = "\u0001"
    pieces = F.transform(F.split(_col(line), '"'),
                         lambda x, i: F.when(i % 2 == 0, F.replace(x, F.lit(","), F.lit(sep))).otherwise(x))
    quoted = F.split(F.array_join(pieces, '"'), sep)

    def name(x: Column, i: Column) -> Column:
        bare = F.when(x.startswith('"') & x.endswith('"') & (F.length(x) > 1),
                      F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x)
        return F.when(F.trim(bare) == "", F.concat(F.lit("_c"), i.cast("string"))).otherwise(bare)

    return F.transform(quoted, name)
