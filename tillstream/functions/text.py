"""Search terms and highlighting (SE2, SE7)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a run of letters and digits in any script (fixed value).
TOKEN_CHAR = r"[\p{L}\p{N}]"


def query_tokens(query: str) -> list[str]:
    """Lower-case tokens of a search text."""
    return sorted({t for t in re.split(r"[\W_]+", query.lower()) if t})


def _any_token(query: str) -> str:
    tokens = query_tokens(query)
    if not tokens:
        raise ValueError(f"no token in search text {query!r}")
    return rf"(?<!{TOKEN_CHAR})({'|'.join(re.escape(t) for t in tokens)})(?!{TOKEN_CHAR})"


def has_any_token(text: Column, query: str) -> Column:
    """True where the text holds at least one token of the query. Stops at the first hit; builds no token array."""
    return F.lower(text).rlike(_any_token(query))


def highlight(text: Column, query: str, before: str = "<em>", after: str = "</em>") -> Column:
    """The text with every token of the query wrapped, whatever its case."""
    return F.regexp_replace(text, "(?iu)" + _any_token(query), f"{before}$1{after}")
