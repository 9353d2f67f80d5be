"""Evaluate a column once and use it many times inside one expression."""

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` where ``value`` is computed once.

    A column used inside the lambda of ``transform`` is otherwise evaluated per element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
