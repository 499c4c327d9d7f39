"""Named queries over a scale folder, each with the SQL another engine can check it by."""

from pyspark.sql import functions as F

from framelark.plans.fixtures import Tables, with_tables

QUERIES = {}
ORACLES = {}


def query(name, sql=None, recursive=False, **ctes):
    """Register fn(tables) -> DataFrame under `name`; `sql` gives the same rows in DuckDB."""

    def add(fn):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = with_tables(sql, recursive, **ctes)
        return fn

    return add


def r6(col, name):
    """Doubles are compared after rounding to 6 places on both sides."""
    return F.round(F.col(col) if isinstance(col, str) else col, 6).alias(name)
