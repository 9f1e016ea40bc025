"""Linear and logarithmic binning (with labels and neighbours) and mass bins."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LinearBins:
    """Bins of equal width over [low, high); values outside go to the end bins, or to null without overflow."""

    low: float
    high: float
    count: int
    overflow: bool = True

    @property
    def width(self) -> float:
        return (self.high - self.low) / self.count

    def bin(self, value: Column) -> Column:
        raw = F.floor((value - self.low) / self.width).cast("int")
        inside = F.when((value >= self.low) & (value < self.high), raw)
        if not self.overflow:
            return inside
        return F.when(value < self.low, 0).when(value >= self.high, self.count - 1).otherwise(raw)

    def label(self, value: Column) -> Column:
        b = self.bin(value)
        return F.format_string("%.2f-%.2f", self.low + b * self.width, self.low + (b + 1) * self.width)

    def neighbours(self, value: Column) -> Column:
        """The value's bin and those beside it, where there are such."""
        b = self.bin(value)
        return F.sequence(F.greatest(b - 1, F.lit(0)), F.least(b + 1, F.lit(self.count - 1)))


@dataclass(frozen=True)
class LogBins:
    """Bins of equal ratio over [low, high), low > 0."""

    low: float
    high: float
    count: int

    def bin(self, value: Column) -> Column:
        step = math.log10(self.high / self.low) / self.count
        raw = F.floor(F.log10(value / self.low) / step).cast("int")
        return F.when(value.isNull(), None).when(value <= self.low, 0).when(value >= self.high, self.count - 1).otherwise(raw)

    def start(self, b: Column) -> Column:
        return F.lit(self.low) * F.pow(F.lit(self.high / self.low), b / self.count)


def linear_mass_bin(mass: Column, width: float = 0.01) -> Column:
    return F.floor(F.lit(0.5) + mass / width).cast("long")


def ratio_bin(mass: Column, ppm: float) -> Column:
    """Bin whose width is a fixed share of the mass: within `ppm` of each other, two masses lie at most one bin apart."""
    return F.floor(F.log(mass) / math.log1p(2 * ppm / 1e6)).cast("long")
