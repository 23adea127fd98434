"""Blocks of consecutive rows of a whole table's order, without moving the table first.

A window without PARTITION BY sends every row to one task.  Here narrow passes over the
order key alone find where the table can be cut: a bounded hash sample of keys gives the
borders of cells, counting gives every cell's exact size, and neighbouring cells form the
blocks.  Borders and sizes go into the plan as literals, so every row knows its block from
its own key, and rows that later blocks must see as well are copied to them on the way.
The table itself is shuffled once, by block, with its halo.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schema import column_type, q, require_columns, require_list

SAMPLE = 20_000       # expected keys of the sample that come to the driver, at most
PER_CELL = 32         # keys of the sample for each cell
CELLS = 2_048         # cells, at most
BLOCK_ROWS = 250_000  # rows a block is meant to have, if there are cells enough
TASK_ROWS = 20_000    # below the number of cores, a block for each so many rows

BLOCK, HALO, KEY = "__block", "__halo", "__key"

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


def sort_columns(order_by: list[str] | None) -> list[Column]:
    """Ascending, missing last.  Order-dependent operators refuse to run without it."""
    if not order_by:
        raise ValueError("order_by is required: a list of columns ending in a unique tie-breaker")
    return [F.col(q(c)).asc_nulls_last() for c in require_list(order_by, "order_by")]


def _sortable(df: DataFrame, name: str) -> tuple[Column, str]:
    """The column as a type that sorts alike and has a literal, and that type."""
    kind, column = column_type(df, name), F.col(q(name))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column), "bigint"
    if isinstance(kind, _WHOLE):
        return column.cast("bigint"), "bigint"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return column.cast("double"), "double"
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return column.cast("binary"), "binary"
    if isinstance(kind, (T.DateType, T.TimestampNTZType, T.DecimalType)):
        return column, kind.simpleString()
    raise ValueError(f"cannot order by {name}: {kind.simpleString()}")


def _literal(value, kind: str) -> str:
    if value is None:
        return f"CAST(NULL AS {kind})"
    if kind == "binary":
        return f"X'{bytes(value).hex()}'"
    if kind == "bigint":
        return f"CAST('{value}' AS BIGINT)"
    return f"CAST('{value!r}' AS DOUBLE)" if kind == "double" else f"CAST('{value}' AS {kind})"


class Order:
    """The order of a table's rows as one comparable column ``__key``, and borders in it."""

    def __init__(self, df: DataFrame, order_by: list[str]):
        self.sort = sort_columns(order_by)
        require_columns(df, order_by)
        parts = [_sortable(df, c) for c in order_by]
        self.kinds = [kind for _, kind in parts]
        # missing last: the flag decides before the missing value is looked at
        self.key = F.struct(*[x for i, (c, _) in enumerate(parts) for x in (c.isNull().alias(f"m{i}"), c.alias(f"k{i}"))])

    def written(self, row) -> str:
        """A collected key as a literal."""
        pairs = [(f"m{i}", f"k{i}", kind) for i, kind in enumerate(self.kinds)]
        return "struct(" + ", ".join(
            f"{str(bool(row[m])).lower()} AS {m}, {_literal(row[k], kind)} AS {k}" for m, k, kind in pairs) + ")"

    def place(self, borders: list) -> Column:
        """How many of the ascending borders are at most ``__key``, by halving."""
        if not borders:
            return F.lit(0)
        steps = [1 << b for b in reversed(range(len(borders).bit_length()))]
        table = F.expr("array(" + ", ".join(self.written(b) for b in borders) + ")")

        def halve(at: Column, step: Column) -> Column:
            reached = F.try_element_at(table, at + step) <= F.col(KEY)
            return F.when((at + step <= len(borders)) & reached, at + step).otherwise(at)

        return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), halve)


@dataclass
class Block:
    """Rows ``start`` to ``end`` (exclusive) of the order."""

    number: int
    start: int
    end: int


class Blocks:
    """The blocks of a table under an order: ``found``, and rows dealt to them."""

    def __init__(self, df: DataFrame, order_by: list[str], blocks: int | None = None, halo: int = 0):
        self.df, self.order = df, Order(df, order_by)
        keys = df.select(self.order.key.alias(KEY))
        rows = keys.count()
        cores = df.sparkSession.sparkContext.defaultParallelism
        wanted = blocks or max(math.ceil(rows / BLOCK_ROWS), min(cores, rows // TASK_ROWS), 1)
        self.borders = self._borders(keys, rows, min(CELLS, max(8 * wanted, 64)) if wanted > 1 else 1)
        self.sizes = self._sizes(keys, rows)
        self._cut(rows, wanted, halo)

    def _borders(self, keys: DataFrame, rows: int, cells: int) -> list:
        if rows < 2 or cells < 2:
            return []
        share = min(1.0, min(SAMPLE, PER_CELL * cells) / rows)
        drawn = keys if share == 1.0 else keys.filter(
            F.pmod(F.xxhash64(KEY), F.lit(1 << 30)) < int(share * (1 << 30)))
        sample = [r[0] for r in drawn.orderBy(KEY).collect()]
        step = max(1, len(sample) // cells)
        return sample[step::step]

    def _sizes(self, keys: DataFrame, rows: int) -> list[int]:
        """Exact rows of every cell."""
        if not self.borders:
            return [rows]
        counted = keys.groupBy(self.order.place(self.borders).alias("cell")).count().collect()
        sizes = [0] * (len(self.borders) + 1)
        for r in counted:  # one row a cell
            sizes[r["cell"]] = r["count"]
        return sizes

    def _cut(self, rows: int, wanted: int, halo: int) -> None:
        goal, self.found, of_cell, at = rows / wanted, [], [], 0
        for size in self.sizes:
            if not self.found or self.found[-1].end - self.found[-1].start >= goal:
                self.found.append(Block(len(self.found), at, at))
            at += size
            self.found[-1].end = at
            of_cell.append(self.found[-1].number)
        # a cell's own block first, then the blocks that see it as part of the last ``halo`` rows before them
        self.homes = [[b] for b in of_cell]
        first_cell: dict[int, int] = {}
        for cell, b in enumerate(of_cell):
            first_cell.setdefault(b, cell)
        for b, cell in first_cell.items():
            seen = 0
            while cell and seen < halo:
                cell -= 1
                seen += self.sizes[cell]
                self.homes[cell].append(b)
        self.starts = [block.start for block in self.found]

    def keyed(self, df: DataFrame | None = None) -> DataFrame:
        """Every row with its ``__key`` and its own ``__block``."""
        own = F.expr("array(" + ", ".join(str(h[0]) for h in self.homes) + ")")
        keyed = (self.df if df is None else df).withColumn(KEY, self.order.key)
        return keyed.withColumn(BLOCK, F.element_at(own, self.order.place(self.borders) + 1))

    def dealt(self, halo: bool = True) -> DataFrame:
        """The table with ``__block`` and ``__halo``; halo rows are copies that only feed frames."""
        if not halo or all(len(h) == 1 for h in self.homes):
            return self.keyed().drop(KEY).withColumn(HALO, F.lit(False))
        homes = F.expr("array(" + ", ".join(f"array({', '.join(map(str, h))})" for h in self.homes) + ")")
        keyed = self.df.withColumn(KEY, self.order.key)
        seen = keyed.select(*[q(c) for c in self.df.columns], F.posexplode(F.element_at(homes, self.order.place(self.borders) + 1)).alias("__nth", BLOCK))
        return seen.withColumn(HALO, F.col("__nth") > 0).drop("__nth")

    def start_of(self) -> Column:
        """Rows before a row's own block."""
        return F.element_at(F.expr("array(" + ", ".join(f"CAST('{s}' AS BIGINT)" for s in self.starts) + ")"), F.col(BLOCK) + 1)
