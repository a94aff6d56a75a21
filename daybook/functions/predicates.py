"""Center rules used as filters.

Two different holes exist on purpose and both are kept as named predicates:
the spine (operating centers) excludes 5000-5999, the fact feeds exclude only
5000-5100, so centers 5101-5999 can appear through plan-only rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Center-number bounds of the two rules.
MIN_CENTER = 25
OPERATING_HOLE = (5000, 5999)
FACT_HOLE = (5000, 5100)
# prefixes/suffixes that mark roll-up members in the goals cube.
ROLLUP_SUFFIX = "Centers"
ROLLUP_PREFIX = "D"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_operating_center(c: Column | str = "CENTER") -> Column:
    """Rule A: center >= 25 and outside 5000-5999 (spine, NPS)."""
    c = _c(c)
    lo, hi = OPERATING_HOLE
    return (c >= MIN_CENTER) & ((c < lo) | (c > hi))


def is_fact_center(c: Column | str = "CENTER") -> Column:
    """Rule B: center >= 25 and not between 5000 and 5100 (fact feeds)."""
    c = _c(c)
    lo, hi = FACT_HOLE
    return (c >= MIN_CENTER) & ~c.between(lo, hi)


def is_rollup_member(c: Column | str = "CENTER") -> Column:
    """Goal-cube members that are roll-ups ('All Centers', 'D12', ...), not stores."""
    c = _c(c)
    return c.endswith(ROLLUP_SUFFIX) | c.startswith(ROLLUP_PREFIX)


def _sql(rule):
    def attach(fn):
        fn.sql = rule
        return fn
    return attach


# The same rules as SQL text (one parse in the JVM when filters are built).
is_operating_center = _sql(lambda c="CENTER": f"({c} >= {MIN_CENTER} AND ({c} < {OPERATING_HOLE[0]} "
                                             f"OR {c} > {OPERATING_HOLE[1]}))")(is_operating_center)
is_fact_center = _sql(lambda c="CENTER": f"({c} >= {MIN_CENTER} AND NOT ({c} BETWEEN {FACT_HOLE[0]} "
                                        f"AND {FACT_HOLE[1]}))")(is_fact_center)
