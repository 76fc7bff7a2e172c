"""Search over documents (SE1-SE8): ``id``, a text ``name``, a number ``score`` and a list ``actor_list`` of (id, name).

Filters are row by row; a page is a top-k, so no full sort is made and no more than its rows reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.text import has_any_token, highlight


def by_id(docs: DataFrame, doc_id: int) -> DataFrame:
    return docs.where(F.col("id") == doc_id)


def match(docs: DataFrame, query: str) -> DataFrame:
    """Documents whose text holds any token of the query."""
    return docs.where(has_any_token(F.col("name"), query))


def term(docs: DataFrame, actor: str) -> DataFrame:
    """Documents with exactly this name in the nested list."""
    return docs.where(F.exists("actor_list", lambda a: a["name"] == actor))


def match_and_term(docs: DataFrame, query: str, actor: str) -> DataFrame:
    """Both conditions. The cheap one is listed first."""
    return match(term(docs, actor), query)


def page(docs: DataFrame, offset: int, size: int, descending: bool = True) -> DataFrame:
    """One page in score order; equal scores are ordered by id."""
    score = F.col("score").desc() if descending else F.col("score").asc()
    return docs.orderBy(score, F.col("id")).offset(offset).limit(size)


def with_highlight(docs: DataFrame, query: str) -> DataFrame:
    return docs.withColumn("highlight", highlight(F.col("name"), query))


def total_hits(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).alias("total"))
