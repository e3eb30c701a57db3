"""Small column helpers shared by the expression modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``.

    Projections holding higher-order functions are not code-generated, so a
    sub-expression used several times is computed several times. Binding it
    as the lambda variable of a one-element ``transform`` computes it once.
    """
    return F.transform(F.array(value), body)[0]
