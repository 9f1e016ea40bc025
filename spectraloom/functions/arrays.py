"""Array expressions whose work grows with the array, not with its square."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Entries that are walked with the list so far carried along; longer arrays go block by block.
BLOCK = 64


def once(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c), where c is computed once a row however often it is used."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def running_starts(sizes: Column) -> Column:
    """For every entry of an array of whole numbers the sum of those before it. Blocks are added up first."""
    zero = F.lit(0).cast("long")

    def summed(x: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int"))
        part = lambda b: F.slice(x, b * BLOCK + 1, BLOCK)
        totals = F.transform(blocks, lambda b: F.aggregate(part(b), zero, lambda a, v: a + v))

        def walked(starts: Column) -> Column:
            def step(a: Column, v: Column) -> Column:
                return F.struct((a["at"] + v).alias("at"), F.array_append(a["out"], a["at"]).alias("out"))

            begin = lambda b: F.struct(F.get(starts, b).alias("at"), F.array().cast("array<bigint>").alias("out"))
            return F.flatten(F.transform(blocks, lambda b: F.aggregate(part(b), begin(b), step, lambda a: a["out"])))

        return once(F.aggregate(totals, F.array(zero), lambda a, n: F.array_append(a, F.element_at(a, -1) + n)), walked)

    return F.when(F.size(sizes) > 0, once(F.transform(sizes, lambda n: n.cast("long")), summed)).otherwise(F.array().cast("array<bigint>"))
