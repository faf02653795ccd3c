"""Query registry: ``name -> (spark_fn(spark, sf_dir) -> DataFrame, duckdb_sql | None)``.

Each query reads the driver tables (through a fixture view) and applies one
operator or one branch. The DuckDB twin, when there is one, computes the same
rows with the same column names; queries without a twin are checked by row
count and by pytest against brute force on a small fixture.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
SURVEY_IDS: dict[str, str] = {}


def widen(df):
    """Small integer columns become 64-bit (the SQL twin's integer width)."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import ByteType, IntegerType, ShortType

    small = (ByteType, IntegerType, ShortType)
    if not any(isinstance(f.dataType, small) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("long").alias(f.name) if isinstance(f.dataType, small) else F.col(f.name)
                       for f in df.schema.fields])


def query(name: str, survey_id: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            return widen(fn(spark, sf_dir))

        QUERIES[name] = run
        SURVEY_IDS[name] = survey_id
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every query module (registration happens at import)."""
    from glean.plans import q_code, q_corpus, q_qa, q_repos, q_scripts  # noqa: F401
