"""Values that an expression uses several times, computed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(use: Callable[[Column], Column], **values: Column) -> Column:
    """use(struct of the values), in which each value stands once however often it is used.

    Written out at every use, a chain of such expressions doubles with each step.
    """
    one = F.array(F.struct(*[v.alias(k) for k, v in values.items()]))
    return F.get(F.transform(one, use), F.lit(0))
