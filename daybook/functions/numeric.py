"""Rounding with one definition everywhere.

``rnd(x, d) = floor(x * 10^d + 0.5) / 10^d`` (half up).  Written with plain
IEEE operations, it gives bit-identical doubles in any engine that gets the
same input, which is what report files and cross-engine checks need
(built-in ``round`` implementations differ on ties and in the last bit).
A value whose scaled form is 2^53 or more has no digits left to round, and NaN
and infinities have none either: these pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


LIMIT = 2 ** 53


def rnd(c, digits: int = 6) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    value = col.cast("double")
    return F.when(F.abs(value * scale) < float(LIMIT), F.floor(value * scale + 0.5) / F.lit(scale)).otherwise(value)


def sql_round_rewrite(sql: str) -> str:
    """Rewrite every ``ROUND(expr, d)`` of a SQL text into the same
    floor-based form (balanced-parenthesis scan, case-sensitive ``ROUND``)."""
    out, i = [], 0
    while True:
        j = sql.find("ROUND(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        k, depth, last_comma = j + 6, 1, None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                last_comma = k
            k += 1
        inner = sql[j + 6:k - 1]
        if last_comma is None:
            expr, d = inner, "0"
        else:
            expr, d = sql[j + 6:last_comma], sql[last_comma + 1:k - 1].strip()
        expr = sql_round_rewrite(expr)
        x = f"CAST(({expr}) AS DOUBLE)"
        out.append(f"(CASE WHEN abs({x} * 1e{d}) < {LIMIT} THEN floor({x} * 1e{d} + 0.5) / 1e{d} ELSE {x} END)")
        i = k
