"""Numeric column expressions with the studied pipeline's rounding rules.

numpy's ``round`` is ``rint(x * 10^n) / 10^n`` (half-even on the scaled
double). ``F.round`` is half-up and must not be used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def np_round(x, n: int) -> Column:
    """numpy-style rounding; ``+ 0.0`` folds ``-0.0`` into ``0.0``."""
    scale = float(10 ** n)
    return F.rint(_c(x) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def py_round(x, n: int) -> Column:
    """Python ``round(x, n)`` (half-even) as a double.

    Implemented like numpy's form: ``bround`` rounds the shortest decimal
    text of the double and disagrees with both Python and DuckDB's
    ``round_even`` at ties such as 32.535, while ``rint`` of the scaled value
    agrees with ``round_even`` everywhere.
    """
    return np_round(_c(x).cast("double"), n)


def safe_ratio(num, den) -> Column:
    """``num/den`` when ``den > 0`` else ``0.0``."""
    num, den = _c(num), _c(den)
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def safe_divide(num, den) -> Column:
    """DIVIDE(a, b, 0): zero when the division is undefined."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")),
                      F.lit(0.0))


def utilization_pct(used, ceiling) -> Column:
    """``round(used / ceiling * 100, 2)``, numpy rounding, may exceed 100."""
    return np_round(F.try_divide(_c(used).cast("double"), _c(ceiling).cast("double"))
                    * F.lit(100.0), 2)


def clamp_score(failed, total) -> Column:
    """``round(max(0, 100 * (1 - failed / max(1, total))), 2)``."""
    raw = F.lit(100.0) * (F.lit(1.0) - _c(failed).cast("double")
                          / F.greatest(F.lit(1), _c(total)).cast("double"))
    return py_round(F.greatest(F.lit(0.0), raw), 2)
