"""sRGB (0-255) to CIELAB (D65) as native column expressions.

The published sRGB -> linear -> XYZ -> L*a*b* formulas, evaluated inside the
plan. ``lab_sql`` gives the same formula as SQL text for an ``SQLTransformer``
stage (``__THIS__``) or a DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# sRGB primaries (D65) to XYZ, and the D65 reference white.
SRGB_TO_XYZ = (
    (0.4124564, 0.3575761, 0.1804375),
    (0.2126729, 0.7151522, 0.0721750),
    (0.0193339, 0.1191920, 0.9503041),
)
WHITE_D65 = (0.95047, 1.00000, 1.08883)
_EPS = (6.0 / 29.0) ** 3
_K = 1.0 / (3.0 * (6.0 / 29.0) ** 2)


def _linear(c: Column) -> Column:
    s = c.cast("double") / 255.0
    return F.when(s <= 0.04045, s / 12.92).otherwise(F.pow((s + 0.055) / 1.055, 2.4))


def _f(t: Column) -> Column:
    return F.when(t > _EPS, F.pow(t, 1.0 / 3.0)).otherwise(t * _K + 4.0 / 29.0)


def rgb_to_lab(r, g, b) -> tuple[Column, Column, Column]:
    """(L, a, b) columns for 0-255 R, G, B columns."""
    cols = [F.col(x) if isinstance(x, str) else x for x in (r, g, b)]
    lin = [_linear(c) for c in cols]
    xyz = [(m[0] * lin[0] + m[1] * lin[1] + m[2] * lin[2]) / w
           for m, w in zip(SRGB_TO_XYZ, WHITE_D65)]
    fx, fy, fz = (_f(t) for t in xyz)
    return 116.0 * fy - 16.0, 500.0 * (fx - fy), 200.0 * (fy - fz)


def lab_sql(r: str = "R", g: str = "G", b: str = "B", passthrough=(),
            table: str = "__THIS__", names=("lL", "lA", "lB")) -> str:
    """The same formula as one SQL statement over ``table``."""
    def lin(c):
        s = f"(CAST({c} AS DOUBLE) / 255.0)"
        return f"(CASE WHEN {s} <= 0.04045 THEN {s} / 12.92 ELSE pow(({s} + 0.055) / 1.055, 2.4) END)"

    def f(t):
        return f"(CASE WHEN {t} > {_EPS!r} THEN pow({t}, {1.0 / 3.0!r}) ELSE {t} * {_K!r} + {4.0 / 29.0!r} END)"

    ls = [lin(c) for c in (r, g, b)]
    xyz = [f"(({m[0]!r} * {ls[0]} + {m[1]!r} * {ls[1]} + {m[2]!r} * {ls[2]}) / {w!r})"
           for m, w in zip(SRGB_TO_XYZ, WHITE_D65)]
    fx, fy, fz = (f(t) for t in xyz)
    cols = list(passthrough) + [r, g, b]
    return (f"SELECT {', '.join(cols)}, 116.0 * {fy} - 16.0 AS {names[0]}, "
            f"500.0 * ({fx} - {fy}) AS {names[1]}, 200.0 * ({fy} - {fz}) AS {names[2]} "
            f"FROM {table}")
