"""A statement's filter and projection over a streaming DataFrame.

The dialect has no streaming clauses; a SELECT without ORDER BY, TOP, LIMIT or
COUNT(*) is a stateless map, so it runs unchanged on a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..errors import DeskQueryError
from ..plans.ast import Select
from ..plans.params import bind
from ..plans.parser import parse
from ..plans.planner import plan


def stream_select(stream: DataFrame, query: str, *params) -> DataFrame:
    """The statement over the stream, whatever table it names."""
    statement = bind(parse(query), params)
    if not isinstance(statement, Select) or statement.order or statement.top is not None or statement.count:
        raise DeskQueryError("only a SELECT without ORDER BY, TOP, LIMIT and COUNT runs on a stream")
    return plan(statement, stream)
