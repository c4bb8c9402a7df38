"""Column expressions shared by the operators. All are built-in Spark functions, so they
stay inside whole-stage codegen; none of them is a Python UDF."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import DATE_FORMATS


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """num / den as DOUBLE; NULL (never inf/NaN) when den is 0 or NULL."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


# Every character Python's str.strip() removes (derived by rule, not listed by hand).
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def trim_ws(c) -> Column:
    """Strip leading/trailing whitespace exactly as ``str.strip()`` does (tab, newline,
    unicode spaces); plain ``trim`` only strips the space character. ``btrim`` with a
    character set looks every end character up in the set and copies it for that, so texts whose first
    and last characters are printable ASCII (between ``!`` and ``~``) are passed as they are."""
    c = col(c)
    text = c.cast("string")
    tidy = (text >= "!") & (text < "\x7f") & F.substring(text, -1, 1).between("!", "~")
    return F.when(tidy, text).otherwise(F.btrim(c, F.lit(WHITESPACE)))


_FIELD = {"yyyy": "[+-]?[0-9]{4,}", "yy": "[0-9]{2}", "MMM": "[^0-9]+", "MM": "[0-9]{2}", "dd": "[0-9]{2}", "HH": "[0-9]{2}",
          "mm": "[0-9]{2}", "ss": "[0-9]{2}", "M": "-?[0-9]+", "d": "-?[0-9]+"}


def date_shape(fmt: str) -> str | None:
    """A regular expression that every text of a date format matches; None where a field is not known."""
    parts = re.findall("[A-Za-z]+|[^A-Za-z]+", fmt)
    if "'" in fmt or "[" in fmt or any(p.isalpha() and p not in _FIELD for p in parts):
        return None
    return "^" + "".join(_FIELD.get(p) or re.escape(p) for p in parts) + "$"


def try_date(s: Column, fmt: str) -> Column:
    """``s`` parsed in one format, NULL where it does not fit. A failing parse raises and catches an exception
    in the row, so texts that do not have the format's shape are not given to the parser."""
    shape, parsed = date_shape(fmt), F.try_to_timestamp(s, F.lit(fmt))
    return parsed if shape is None else F.when(s.rlike(shape), parsed)


def align_sunday(d) -> Column:
    """Move a date forward to the next Sunday; Sundays stay put."""
    return F.next_day(F.date_sub(col(d), 1), "SUN")


def parse_mixed_date(c, dtype: T.DataType, formats=DATE_FORMATS) -> Column:
    """Parse a date that may arrive as text in several formats; NULL when none fits."""
    if isinstance(dtype, T.DateType):
        return col(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return col(c).cast("date")
    s = trim_ws(col(c).cast("string"))
    return F.coalesce(*[try_date(s, f) for f in formats]).cast("date")


def non_negative_number(c, dtype: T.DataType) -> Column:
    """Coerce to a number, bad text and NULL become 0, negatives are clipped to 0.
    Numeric columns keep their type (DECIMAL money stays exact)."""
    if isinstance(dtype, T.StringType):
        v = F.coalesce(F.expr(f"try_cast(`{c}` as double)"), F.lit(0.0))
        return F.greatest(v, F.lit(0.0))
    v = F.coalesce(col(c), F.lit(0).cast(dtype))
    return F.greatest(v, F.lit(0).cast(dtype)).cast(dtype)


def pair_masked(x, y):
    """Pairwise-complete inputs: keep x only where y is present and vice versa."""
    x, y = col(x), col(y)
    both = x.isNotNull() & y.isNotNull()
    return F.when(both, x.cast("double")), F.when(both, y.cast("double"))


def safe_corr(x, y) -> Column:
    """Pearson r over pairwise-complete rows; NULL (not an error) for a constant input.

    ``corr`` raises a divide-by-zero under ANSI mode when a column is constant.
    """
    xm, ym = pair_masked(x, y)
    return F.try_divide(F.covar_samp(xm, ym), F.stddev_samp(xm) * F.stddev_samp(ym))


def label_unknown(c) -> Column:
    """NULL and the texts None/nan/NaN become 'Unknown' (display labels)."""
    c = col(c).cast("string")
    return F.when(c.isNull() | c.isin("None", "nan", "NaN"), F.lit("Unknown")).otherwise(c)


def money_label(v) -> Column:
    """$12.3M / $4.5k / $999 label of an amount."""
    v = col(v)
    return (F.when(v > 1_000_000, F.format_string("$%.1fM", v / 1_000_000))
            .when(v > 1_000, F.format_string("$%.1fk", v / 1_000))
            .otherwise(F.concat(F.lit("$"), F.format_number(v, 0))))


def present(df: DataFrame, digits: dict | None = None) -> DataFrame:
    """Presentation projection used by the registered queries: dates as ISO text,
    decimals as DOUBLE, and the listed double columns rounded (half away from zero, as both engines do) so that two
    engines summing in different orders print the same value."""
    digits = digits or {}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        if f.name in digits:
            c = F.round(c.cast("double"), digits[f.name])
        out.append(c.alias(f.name))
    return df.select(*out)
