"""Entry points used by ``__spark_entry__.py`` and ``bench.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RANK_CLASS
from ..operators.ranks import with_rank_value
from ..sources import derived
from . import queries as _queries  # noqa: F401  (registers the queries)
from . import queries_stats as _queries_stats  # noqa: F401
from . import queries_ops as _queries_ops  # noqa: F401
from . import queries_stream as _queries_stream  # noqa: F401
from . import queries_more as _queries_more  # noqa: F401
from .queries import all_queries, oracle_queries

__all__ = ["all_queries", "oracle_queries", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hands per class: derive hands, rank them by broadcast join, count per class."""
    ranked = with_rank_value(derived.hands(spark, sf_dir))
    return ranked.groupBy(RANK_CLASS).agg(F.count(F.lit(1)).alias("n_hands"))
