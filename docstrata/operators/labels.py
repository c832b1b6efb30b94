"""Index-labelled flattening: wide rows in which every array leaves a label such as ``a_0_b_1``.

Two label styles exist. ``"own"`` names a label after its own level only (``b_1``) and keeps dots in
column names; ``"chain"`` names it after all array levels above it (``a_0_b_1``) and uses underscores.
Struct levels never enter a label.

Sibling arrays multiply within one document, which is what a flat row set of the document means. Each
is opened by its own outer generator, so the product never leaves the document's row. With ``rows_per_range`` the
rows of documents whose product is larger are numbered instead, and ranges of numbers dealt over tasks. Where that row
growth is not wanted at all, ``labeled_tables`` or ``child_tables`` give one table per array instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docstrata.conventions import ROOT_KEY
from docstrata.errors import LayoutError
from docstrata.functions.schema_walk import Path, dotted, is_array, is_struct, top_column, underscored
from docstrata.operators.expand import Cell, select_cells

OWN, CHAIN = "own", "chain"
# Name and label of a list that is itself the document set.
LIST_NAME = "root"


def _cell_name(path: Path, style: str) -> str:
    return dotted(path) if style == OWN else underscored(path)


def _index_name(path: Path, style: str, nesting: int) -> str:
    suffix = "_index" if nesting == 1 else f"_index{nesting}"
    return ("_" if style == OWN else "") + underscored(path) + suffix


def _label(path: Path, position: Column, above: Column | None, style: str) -> Column:
    name = dotted(path).split(".")[-1]
    own = F.concat(F.lit(name + "_"), position.cast("string"))
    return own if style == OWN or above is None else F.concat(above, F.lit("_"), own)


def _div(number: str, by: str) -> Column:
    return F.expr(f"{number} div {by}")  # division of columns would go by way of doubles


def _length(array: Column) -> Column:
    return F.when(array.isNull(), F.lit(0)).otherwise(F.size(array)).cast("bigint")


@dataclass(frozen=True)
class _Node:
    """A value to be laid out: where it is now, its source path, and the label of the array around it."""

    column: Column
    data_type: T.DataType
    path: Path
    above: Column | None
    nesting: int = 1

    def leaves(self) -> list[_Node]:
        """The node itself, or the plain values and arrays below a struct, in document order."""
        if not is_struct(self.data_type):
            return [self]
        fields = [
            _Node(self.column.getField(f.name), f.dataType, self.path + (f.name,), self.above)
            for f in self.data_type.fields
        ]
        return [leaf for field in fields for leaf in field.leaves()]

    def element(self, item: Column, label: Column) -> _Node:
        return _Node(item, self.data_type.elementType, self.path, label, self.nesting + 1)


class _Layout:
    """A frame being laid out. ``live`` names the helper columns that later steps still need.

    Every step selects just those, so that an array, or a struct holding one, is never copied along
    with each of its own elements.
    """

    def __init__(self, df: DataFrame, live: tuple[str, ...] = (), made: int = 0):
        self.df = df
        self.live = live
        self.made = made

    def _fresh(self, count: int) -> list[str]:
        self.made += count
        return [f"__{number}" for number in range(self.made - count, self.made)]

    def _kept(self) -> list[Column]:
        return [top_column(name) for name in self.live]

    def hold(self, columns: Sequence[Column]) -> list[str]:
        """Compute columns from the current row and keep only them and what is live."""
        names = self._fresh(len(columns))
        self.df = self.df.select(*self._kept(), *[c.alias(name) for c, name in zip(columns, names)])
        self.live += tuple(names)
        return names

    def open(self, array: Column, outer: bool) -> tuple[Column, Column]:
        """One row per element; returns its position, which stays live, and the element, which does not."""
        position, item = self._fresh(2)
        generator = F.posexplode_outer(array) if outer else F.posexplode(array)
        self.df = self.df.select(*self._kept(), generator.alias(position, item))
        self.live += (position,)
        return F.col(position), F.col(item)

    def open_ranges(self, arrays: Sequence[str], rows: int) -> list[tuple[Column, str]]:
        """One row per combination of elements of all the arrays; returns each one's position and the name of its element, both live.

        Combinations are numbered in mixed radix, a digit per array. A row first becomes one row per ``rows`` numbers, with
        just the slices of the arrays that those numbers reach; these are dealt over tasks, and there each number is read back as positions.
        """
        for name in arrays:
            self.release(name)
        digits = range(len(arrays))
        sizes, strides, slices, offsets = ([f"{kind}_{j}" for j in digits] for kind in ("__size", "__stride", "__slice", "__offset"))
        length = [_length(F.col(name)) for name in arrays]
        stride = [reduce(mul, (F.greatest(n, F.lit(1)) for n in length[j + 1:]), F.lit(1).cast("bigint")) for j in digits]
        sized = self.df.select(
            *self._kept(), *map(F.col, arrays), F.monotonically_increasing_id().alias("__row"),
            *[c.alias(name) for c, name in zip(length + stride, sizes + strides)],
        )
        radix = [F.greatest(F.col(name), F.lit(1)) for name in sizes]
        total = radix[0] * F.col(strides[0])
        ranged = sized.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), total - 1, F.lit(rows).cast("bigint"))).alias("__from"))
        ranged = ranged.withColumn("__to", F.least(total, F.col("__from") + rows) - 1)
        cut = []
        for j in digits:
            low, high = _div("__from", strides[j]), _div("__to", strides[j])
            # Numbers that pass the array's end reach its start again and take all of it, as do those that go round.
            part = (high - low + 1 < radix[j]) & (low % radix[j] <= high % radix[j])
            cut.append(F.when(part, F.slice(arrays[j], (low % radix[j] + 1).cast("int"), (high - low + 1).cast("int"))).otherwise(F.col(arrays[j])).alias(slices[j]))
            cut.append(F.when(part, low % radix[j]).otherwise(F.lit(0)).alias(offsets[j]))
        cut = ranged.select(*self._kept(), *map(F.col, sizes + strides), "__row", "__from", "__to", *cut)
        # A number of partitions of its own: ranges are small in bytes and large in rows, so they must not be put together by size.
        tasks = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        numbered = cut.repartition(tasks, "__row", "__from").select("*", F.explode(F.sequence("__from", "__to")).alias("__number"))
        names = self._fresh(2 * len(arrays))
        opened = []
        for j in digits:
            place = _div("__number", strides[j]) % radix[j]
            opened.append(F.when(F.col(sizes[j]) > 0, place).alias(names[2 * j]))
            opened.append(F.get(F.col(slices[j]), (place - F.col(offsets[j])).cast("int")).alias(names[2 * j + 1]))
        self.df = numbered.select(*self._kept(), *opened)
        self.live += tuple(names)
        return [(F.col(names[2 * j]), names[2 * j + 1]) for j in digits]

    def release(self, name: str) -> None:
        self.live = tuple(n for n in self.live if n != name)

    def copy(self) -> _Layout:
        return _Layout(self.df, self.live, self.made)


def _unroll(layout: _Layout, nodes: Sequence[_Node], style: str, rows_per_range: int | None = None) -> list[Cell]:
    """Cells of everything at and below the nodes, in document order, arrays opened by outer generators.

    With ``rows_per_range`` the arrays of these nodes themselves are opened together, by ranges of row numbers.
    """
    leaves = [leaf for node in nodes for leaf in node.leaves()]
    names = layout.hold([leaf.column for leaf in leaves])
    arrays = [name for leaf, name in zip(leaves, names) if is_array(leaf.data_type)]
    ranged = dict(zip(arrays, layout.open_ranges(arrays, rows_per_range))) if rows_per_range else {}
    cells = []
    for leaf, name in zip(leaves, names):
        if not is_array(leaf.data_type):
            cells.append(Cell(_cell_name(leaf.path, style), F.col(name), leaf.data_type, leaf.path))
            continue
        if name in ranged:
            position, held = ranged[name]
            layout.release(held)
            item = F.col(held)
        else:
            layout.release(name)
            position, item = layout.open(F.col(name), outer=True)
        label = _label(leaf.path, position, leaf.above, style)
        cells += _unroll(layout, [leaf.element(item, label)], style)
        cells.append(Cell(_index_name(leaf.path, style, leaf.nesting), label, T.StringType(), leaf.path))
    return cells


def _top_nodes(df: DataFrame, above: Column | None, leave_out: str | None) -> list[_Node]:
    return [
        _Node(top_column(f.name), f.dataType, (f.name,), above) for f in df.schema.fields if f.name != leave_out
    ]


def flatten_labeled(
    df: DataFrame, style: str = CHAIN, list_position: str | None = None, rows_per_range: int | None = None
) -> DataFrame:
    """All structs and all arrays, also arrays of plain values, as one wide row set.

    Empty and null arrays keep their row, with nulls in the array's columns. ``list_position`` names
    a column holding each document's place in a top-level list; it becomes the label ``root_<i>``.

    ``rows_per_range`` spreads the rows of single documents: where a document's own arrays, arrays inside their elements not
    counted, make more rows than that, they are made in ranges of so many by different tasks. Other documents don't move. The rows are the same;
    the documents are read twice, so ``df`` should be a stored table.
    """
    if style not in (OWN, CHAIN):
        raise LayoutError(f"unknown label style {style!r}")
    if rows_per_range is None:
        return _flattened(df, style, list_position)
    if rows_per_range < 1:
        raise LayoutError(f"no range of {rows_per_range} rows")
    arrays = [leaf.column for node in _top_nodes(df, None, list_position) for leaf in node.leaves() if is_array(leaf.data_type)]
    if len(arrays) < 2:
        return _flattened(df, style, list_position)
    product = reduce(mul, (F.greatest(_length(array), F.lit(1)) for array in arrays))
    large = _flattened(df.where(product > rows_per_range), style, list_position, rows_per_range)
    return _flattened(df.where(product <= rows_per_range), style, list_position).unionByName(large)


def _flattened(df: DataFrame, style: str, list_position: str | None, rows_per_range: int | None = None) -> DataFrame:
    layout, above = _Layout(df), None
    if list_position:
        layout.live = (list_position,)
        above = _label((LIST_NAME,), top_column(list_position), None, style)
    cells = _unroll(layout, _top_nodes(df, above, list_position), style, rows_per_range)
    if list_position:
        cells.append(Cell(_index_name((LIST_NAME,), style, 1), above, T.StringType(), (list_position,)))
    return select_cells(layout.df, cells)


def labeled_tables(df: DataFrame, key_col: str | None = None, list_position: str | None = None) -> dict[str, DataFrame]:
    """One table per array path, named after the path, rows labelled with the full chain.

    A table holds the element's own fields with the arrays inside it opened as well, but nothing of
    its ancestors besides their part of the label. Labels are unique within one document only;
    ``key_col`` adds that document key as ``root_id``. With ``list_position`` the documents are the items
    of a top-level list, which then has a table of its own.
    """
    tables: dict[str, DataFrame] = {}
    root = []
    carried = {name: None for name in (key_col, list_position) if name}  # in order, each once
    if key_col:
        root = [Cell(ROOT_KEY, top_column(key_col), df.schema[key_col].dataType, (key_col,))]

    def visit(layout: _Layout, node: _Node) -> None:
        for leaf in node.leaves():
            if not is_array(leaf.data_type):
                continue
            opened = layout.copy()
            position, item = opened.open(leaf.column, outer=False)
            element = leaf.element(item, _label(leaf.path, position, leaf.above, CHAIN))
            if leaf.nesting == 1:
                name = underscored(leaf.path)
                if name in tables:
                    raise LayoutError(f"two array paths would share the table {name!r}")
                inner = opened.copy()
                cells = _unroll(inner, [element], CHAIN)
                index = Cell(_index_name(leaf.path, CHAIN, 1), element.above, T.StringType(), leaf.path)
                tables[name] = select_cells(inner.df, root + cells + [index])
            visit(opened, element)

    above = None
    if list_position:
        above = _label((LIST_NAME,), top_column(list_position), None, CHAIN)
        tables[LIST_NAME] = flatten_labeled(df, CHAIN, list_position)
    for node in _top_nodes(df, above, list_position):
        visit(_Layout(df, tuple(carried)), node)
    return tables
