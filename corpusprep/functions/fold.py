"""Running folds over an array of the row, for rules that carry a state from lexeme to lexeme."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusprep.functions.text import let

BLOCK = 64  # states are collected in blocks, so that a long row is not copied once for each element


def running(arr: Column, zero: Column, step: Callable[[Column, Column], Column], block: int = BLOCK) -> Column:
    """The state after each element: ``step(state, element)`` from ``zero`` on; as long as ``arr``."""
    def states(a: Column) -> Column:
        def one_block(done: Column, b: Column) -> Column:
            start = F.array(F.element_at(done, -1))
            more = F.aggregate(F.slice(a, b * block + 1, F.lit(block)), start, lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x))))
            return F.concat(done, F.slice(more, 2, block))

        blocks = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / block).cast("int"))
        every = F.aggregate(blocks, F.array(zero), one_block)
        return F.when(F.size(a) > 0, F.slice(every, F.lit(2), F.size(a))).otherwise(F.slice(F.array(zero), 2, 1))

    return let(arr, states)


def bracket_depths(lexemes: Column, openers=("(", "[", "{"), closers=(")", "]", "}")) -> Column:
    """The bracket depth after each lexeme; a closer without an opener counts as nothing."""
    def step(depth: Column, t: Column) -> Column:
        return (F.when(t.isin(*openers), depth + 1).when(t.isin(*closers), F.greatest(depth - 1, F.lit(0))).otherwise(depth))

    return running(lexemes, F.lit(0), step)
