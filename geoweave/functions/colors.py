"""Colour and label expressions for map feature tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Six-colour cycle used for BFS levels (index = level % 6).
LEVEL_PALETTE = ["#1f77b4", "#ff7f0e", "#2ca02c", "#9467bd", "#8c564b", "#e377c2"]

# Route colours (shortest sample, longest sample, any other route).
ROUTE_COLORS = {"shortest": "#d62728", "longest": "#2ca02c", "other": "#555555"}
# Fixed value: colour of BFS tree edges.
TREE_EDGE_COLOR = "#AAAAAA"

# Gradient runs from hue 240° (blue) to 0° (red) at lightness 0.5, saturation 0.8.
GRADIENT_LIGHTNESS = 0.5
GRADIENT_SATURATION = 0.8
SINGLE_STEP_COLOR = "#FF0000"


def _hls_channel(m1: float, m2: float, hue: Column) -> Column:
    """Standard HLS→RGB helper for one channel; ``hue`` in [0, 1)."""
    h = F.pmod(hue, F.lit(1.0))
    return (
        F.when(h < 1.0 / 6.0, m1 + (m2 - m1) * h * 6.0)
        .when(h < 0.5, F.lit(m2))
        .when(h < 2.0 / 3.0, m1 + (m2 - m1) * (F.lit(2.0 / 3.0) - h) * 6.0)
        .otherwise(F.lit(m1))
    )


def gradient_color(step, total_steps) -> Column:
    """Hex colour from blue (step 0) to red (last step); a single step is pure red."""
    step = F.col(step) if isinstance(step, str) else step
    total = F.col(total_steps) if isinstance(total_steps, str) else total_steps
    lightness, sat = GRADIENT_LIGHTNESS, GRADIENT_SATURATION
    m2 = lightness * (1.0 + sat) if lightness <= 0.5 else lightness + sat - lightness * sat
    m1 = 2.0 * lightness - m2
    hue = F.lit(240.0 / 360.0) * (F.lit(1.0) - step.cast("double") / (total - 1).cast("double"))
    r = _hls_channel(m1, m2, hue + 1.0 / 3.0)
    g = _hls_channel(m1, m2, hue)
    b = _hls_channel(m1, m2, hue - 1.0 / 3.0)

    def byte(x: Column) -> Column:
        return F.floor(x * 255).cast("int")

    return F.when(total <= 1, F.lit(SINGLE_STEP_COLOR)).otherwise(
        F.format_string("#%02x%02x%02x", byte(r), byte(g), byte(b))
    )


def level_color(level) -> Column:
    """Cyclic palette by BFS level."""
    level = F.col(level) if isinstance(level, str) else level
    return F.element_at(F.array(*[F.lit(c) for c in LEVEL_PALETTE]), (level % 6 + 1).cast("int"))


def log_scale(size, min_size, max_size) -> Column:
    """``ln(size/min)/ln(max/min)`` in [0,1]; 0 when all sizes are equal."""
    size, lo, hi = (F.col(x) if isinstance(x, str) else x for x in (size, min_size, max_size))
    den = F.ln(hi.cast("double") / lo.cast("double"))
    return F.coalesce(F.ln(size.cast("double") / lo.cast("double")) / F.nullif(den, F.lit(0.0)), F.lit(0.0))


def two_end_color(t) -> Column:
    """Linear blend blue (#3b4cc0, t=0) → red (#b40426, t=1) for a normalised value."""
    t = F.col(t) if isinstance(t, str) else t
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))

    def mix(a: int, b: int) -> Column:
        return F.round(F.lit(float(a)) + (F.lit(float(b - a)) * t)).cast("int")

    return F.format_string("#%02x%02x%02x", mix(0x3B, 0xB4), mix(0x4C, 0x04), mix(0xC0, 0x26))


def route_style(length, min_length, max_length) -> Column:
    """P10: equal to the minimum → shortest; else equal to the maximum → longest; else other."""
    length, lo, hi = (F.col(x) if isinstance(x, str) else x for x in (length, min_length, max_length))
    return F.when(length == lo, F.lit("shortest")).when(length == hi, F.lit("longest")).otherwise(
        F.lit("other")
    )
