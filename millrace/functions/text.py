"""Text and scalar expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unicode white space plus the four separators Python also strips.
_SPACE = r"[\s\x1c-\x1f]+"


def strip(c) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.regexp_replace(c, rf"(?U)^{_SPACE}|{_SPACE}$", "")


def preview(c, length) -> Column:
    """The first ``length`` characters."""
    return F.substring(c, 1, length)


def mask_credentials(c) -> Column:
    """Hide the secret in the first ``:secret@`` of each line."""
    return F.regexp_replace(c, r"(?m)^(.*?):[^:@\n]+@", "$1:*****@")


def null_if(c, sentinel) -> Column:
    """Null in place of a sentinel value."""
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(sentinel))


def iso_time(c) -> Column:
    """ISO 8601 text with offset; microseconds only when there are any."""
    ts = F.col(c) if isinstance(c, str) else c
    ts = ts.cast("timestamp")
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    exact = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(exact)


def money(c) -> Column:
    """Two-decimal text of a double, rounded as its exact binary value.

    Few doubles are exact halves of a cent: most that print as one lie a little
    above or below.  The rounding error of the product with 100, found by
    splitting the factor, tells which; a true half goes to the even cent.
    """
    x = F.col(c) if isinstance(c, str) else c
    size = F.abs(x)
    product = size * 100.0
    high = size * 134217729.0 - (size * 134217729.0 - size)
    error = (high * 100.0 - product) + (size - high) * 100.0
    whole = F.floor(product)
    over = (product - whole - 0.5) + error
    cents = whole + F.when((over > 0) | ((over == 0) & (whole % 2 == 1)), 1).otherwise(0)
    sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
    text = F.concat(
        sign, F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0")
    )
    # Beyond that, the part after the point is exact, and so is its product with 100.
    large = F.least(size, F.lit(2.0**53))
    rest = F.rint((large - F.floor(large)) * 100.0).cast("long")
    units = F.floor(large) + F.floor(rest / 100)
    large_text = F.concat(sign, units.cast("string"), F.lit("."), F.lpad((rest % 100).cast("string"), 2, "0"))
    return F.when(size < 1e13, text).when(size < 2.0**53, large_text).otherwise(F.format_string("%.2f", x))


def decision_status(c) -> Column:
    """approve/reject to a status; null marks an invalid action."""
    action = F.col(c) if isinstance(c, str) else c
    return F.when(action == "approve", "approved").when(action == "reject", "rejected")


def business_id(*columns) -> Column:
    """A repeatable row id: a hash of the business key."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def session_id(given, *key) -> Column:
    """The given session, or one made from the business key where it is empty."""
    return F.coalesce(F.nullif(F.col(given), F.lit("")), business_id(*key))


def without_blanks(df: DataFrame, column) -> tuple[DataFrame, DataFrame]:
    """Rows with the text stripped, and the rows rejected for having none."""
    stripped = df.withColumn(column, strip(column))
    filled = F.coalesce(F.length(column) > 0, F.lit(False))
    return stripped.filter(filled), stripped.filter(~filled)


def clean_missing(c, kind=None) -> Column:
    """Null for null and for NaN, as checks treat both as missing."""
    column = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(column), column) if kind in ("float", "double") else column
