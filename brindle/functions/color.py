"""Colour of a point in the plane of two component scores."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

_SECTORS = {  # hue sector -> red, green, blue in terms of value, falling and rising edge
    0: ("value", "rise", "zero"),
    1: ("fall", "value", "zero"),
    2: ("zero", "value", "rise"),
    3: ("zero", "fall", "value"),
    4: ("rise", "zero", "value"),
    5: ("value", "zero", "fall"),
}


def polar_rgb(first: Column, second: Column, scale: float = 1.0) -> tuple[Column, Column, Column]:
    """Hue from the angle, brightness from the radius, at full saturation.

    `scale` multiplies the brightness and then, before clipping to [0, 1], the colour again.
    """
    turn = 2 * math.pi
    hue = F.pmod(F.atan2(-first, -second) + math.pi / 2, F.lit(turn)) / turn
    value = F.lit(float(scale)) * F.sqrt(first * first + second * second)
    sector = F.floor(hue * 6)
    part = hue * 6 - sector
    edges = {
        "value": value,
        "fall": value * (1 - part),
        "rise": value * part,
        "zero": F.lit(0.0),
    }

    def channel(i: int) -> Column:
        picked = F.lit(None).cast("double")
        for number, names in _SECTORS.items():
            picked = F.when(sector % 6 == number, edges[names[i]]).otherwise(picked)
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), picked * float(scale)))

    return channel(0), channel(1), channel(2)
