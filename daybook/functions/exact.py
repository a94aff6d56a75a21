"""Sums of DOUBLE values that do not depend on their order.

A sum of doubles depends on the order in which partitions are combined, so a rerun on other partitions may
restate a value by its last bits.  Here each value goes to a grid of ``places`` decimal places and is split into
its whole part and its units of the grid, both BIGINT; integer sums are the same in any order, and map-side combine
and hash aggregation stay.  The sum is put together once per group as DECIMAL and given back as the nearest DOUBLE.

The split is exact: the fraction of a double is a double, and it is rounded to the grid once (half to even).  Values
with up to ``places`` decimals, the usual money feed, are summed as a NUMERIC column of a warehouse would be.

Defined cases: NULLs are left out, a group without values gives NULL; NaN and infinities give what a plain sum
gives; a value of 1e18 or more, or a sum beyond BIGINT, raises, in ANSI mode or not.
"""

from __future__ import annotations

MAX_PLACES = 9


def exact_sum_sql(value: str, places: int) -> str:
    """Aggregate expression: the sum of the SQL expression ``value`` on a grid of ``places`` decimals."""
    if not 1 <= places <= MAX_PLACES:
        raise ValueError(f"places must be 1 to {MAX_PLACES}, not {places}")
    x = f"CAST({value} AS DOUBLE)"
    whole = f"CAST(CASE WHEN abs({x}) < 1e18 THEN {x} END AS BIGINT)"
    units = f"CAST(rint(({x} - {whole}) * 1e{places}) AS BIGINT)"
    too_large = f"CAST(raise_error('exact sum: a value of 1e18 or more') AS DOUBLE)"
    other = (f"SUM(CASE WHEN abs({x}) >= 1e18 THEN CASE WHEN abs({x}) < DOUBLE('Infinity') THEN {too_large} ELSE {x} END END)")
    unit = f"0.{'1'.rjust(places, '0')}BD"
    total = (f"CAST(try_sum({whole}) AS DECIMAL({19 + places}, {places})) "
             f"+ CAST(try_sum({units}) AS DECIMAL(19, 0)) * {unit}")
    overflow = "CAST(raise_error('exact sum: the sum is beyond BIGINT') AS DOUBLE)"
    return f"COALESCE({other}, CASE WHEN COUNT({whole}) > 0 THEN COALESCE(CAST({total} AS DOUBLE), {overflow}) END)"


def total_sql(value: str, places: int | None = None) -> str:
    """``SUM(value)``, or its order-free form where ``places`` is given."""
    return f"SUM({value})" if places is None else exact_sum_sql(value, places)
