"""A registered query: what runs on Spark and the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from parcelight.functions.text import WHITESPACE
from parcelight.sources.fixtures import Inputs, with_views


@dataclass(frozen=True)
class Spec:
    run: Callable[[Inputs], DataFrame]
    views: str = ""
    sql: str | None = None

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        return with_views(self.views, self.sql) if self.views else self.sql


def rounded(expression: str, digits: int) -> str:
    """The rounding rule of ``functions.numbers.round_half_up`` in SQL."""
    return f"floor(({expression})*1e{digits}+0.5)/1e{digits}"


def words_sql(column: str) -> str:
    """The words of a text column in SQL."""
    return f"regexp_extract_all({column}, '[^{WHITESPACE[1:]}+')"
