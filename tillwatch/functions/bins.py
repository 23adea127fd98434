"""Right-closed binning with labels and ordinals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Price bands of the sales category, right-closed, and their labels in order.
SALES_EDGES = [0.0, 30.0, 40.0, 50.0, float("inf")]
SALES_LABELS = ["Baixa", "Média", "Alta", "Muito Alta"]


def _check(edges: list[float], labels: list) -> None:
    if len(edges) != len(labels) + 1:
        raise ValueError("bins need exactly one edge more than labels")
    if any(a >= b for a, b in zip(edges, edges[1:])):
        raise ValueError("bin edges must increase")


def _cases(col: Column, edges: list[float], values: list) -> Column:
    value = col.cast("double")
    inside = (value > edges[0]) & (value <= edges[-1]) & ~F.isnan(value)
    steps = [(value <= upper, v) for upper, v in zip(edges[1:], values)]
    chain = reduce(lambda acc, s: acc.when(s[0], s[1]), steps[1:], F.when(*steps[0]))
    return F.when(inside, chain)


def bin_label(col: Column, edges: list[float], labels: list[str]) -> Column:
    """Label of the interval ``(edge, next edge]`` holding the value, else null."""
    _check(edges, labels)
    return _cases(col, edges, labels)


def bin_ordinal(col: Column, edges: list[float], labels: list[str]) -> Column:
    """Position of that interval, for ordering by category."""
    _check(edges, labels)
    return _cases(col, edges, list(range(len(labels)))).cast("int")
