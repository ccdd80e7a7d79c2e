"""Registration of named queries with their SQL."""

from pyspark.sql import functions as F

from millrace.session import pin_settings
from millrace.sources.files import scan

_queries, _oracles = {}, {}


def query(name, sql=None):
    """Register a ``(spark, directory) -> DataFrame`` function."""

    def register(build):
        def run(spark, directory):
            return build(pin_settings(spark), directory.rstrip("/"))

        run.__name__ = name
        run.__doc__ = build.__doc__
        _queries[name] = run
        if sql is not None:
            _oracles[name] = sql
        return build

    return register


def queries():
    return dict(_queries)


def oracles():
    return dict(_oracles)


def table(spark, directory, name):
    """One of the given tables."""
    return scan(spark, f"{directory}/{name}.parquet")


def rounded(column, digits):
    """A rounded double, so that summation order does not show."""
    return F.round(column, digits)


def rounded_average(column, digits):
    """As ``rounded``, first moved off exact halves, where engines differ."""
    return F.round(F.col(column) + 1e-9, digits)


def time_text(column):
    """Time as text with microseconds, the same in every engine."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
