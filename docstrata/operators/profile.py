"""Column profile: five counts and a class per column, from one aggregate over all tables.

Each row becomes one small code per column (null, empty, integer, decimal, other), and the codes are counted
per column. The plan is the same for any number of columns, and counting is pre-aggregated within each
task to a few rows per column, so neither row count nor skew in the values matters for the exchange. Only text
is looked at as text; for numbers the code follows from the value itself.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docstrata.conventions import (
    CLASS_DECIMAL,
    CLASS_INTEGER,
    CLASS_MIXED,
    CLASS_NULL,
    CLASS_STRING,
    DECIMAL_TEXT,
)
from docstrata.errors import LayoutError
from docstrata.functions.values import NESTED_TYPES, pretty_json

_COUNTS = ("null_count", "empty_count", "integer_count", "decimal_count", "string_count")
_NULL, _EMPTY, _INTEGER, _DECIMAL, _OTHER = range(5)
_NEVER_NUMERIC = (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, *NESTED_TYPES)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _code(name: str, data_type: T.DataType) -> str:
    """SQL of the code of one value. As text, because a wide table has thousands of expressions."""
    column = _quoted(name)
    if isinstance(data_type, _NEVER_NUMERIC):
        found = ""
    elif isinstance(data_type, T.IntegralType):
        found = f"WHEN {column} >= 0 THEN {_INTEGER} "
    elif isinstance(data_type, (T.DoubleType, T.FloatType)):
        # Text form of a double: plain digits with a point from 1e-3 up to 1e7, otherwise with an exponent.
        plain = f"double({column}) >= 1e-3 AND double({column}) < 1e7"
        found = f"WHEN ({plain}) OR ({column} = 0 AND string({column}) = '0.0') THEN {_DECIMAL} "
    else:
        text = column if isinstance(data_type, T.StringType) else f"string({column})"
        # The first character spares nearly all prose the pattern, and the decoding that comes with it.
        found = (
            f"WHEN {text} = '' THEN {_EMPTY} "
            f"WHEN NOT (substring({text}, 1, 1) BETWEEN '0' AND '9' AND {text} RLIKE {_literal(DECIMAL_TEXT)}) THEN {_OTHER} "
            f"WHEN contains({text}, '.') THEN {_DECIMAL} WHEN true THEN {_INTEGER} "
        )
    return f"tinyint(CASE WHEN {column} IS NULL THEN {_NULL} {found}ELSE {_OTHER} END)"


def _class_of(strict: bool) -> str:
    blank = "null_count + empty_count"
    mixed = "" if strict else f"WHEN decimal_count > 0 THEN '{CLASS_MIXED}' "
    return (
        f"CASE WHEN {blank} = total_count THEN '{CLASS_NULL}' "
        f"WHEN integer_count + {blank} = total_count THEN '{CLASS_INTEGER}' "
        f"WHEN decimal_count + {blank} = total_count THEN '{CLASS_DECIMAL}' "
        f"{mixed}ELSE '{CLASS_STRING}' END AS column_class"
    )


def _code_counts(tables: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The columns of all tables (``table_no, ordinal, DataFrame_name, column_name, data_type``), and per column and code a ``count``."""
    if not tables:
        raise LayoutError("no tables to profile")
    columns, codes = [], []
    for number, (name, df) in enumerate(tables.items()):
        fields = df.schema.fields
        if not fields:
            raise LayoutError(f"{name!r} has no columns to profile")
        columns += [
            f"({number}, {i}, {_literal(name)}, {_literal(f.name)}, {_literal(f.dataType.simpleString())})"
            for i, f in enumerate(fields)
        ]
        row_codes = ", ".join(_code(f.name, f.dataType) for f in fields)
        codes.append(df.selectExpr(f"{number} AS table_no", f"posexplode(array({row_codes})) AS (ordinal, code)"))
    # The list of columns brings back those of tables without rows.
    listed = codes[0].sparkSession.sql(
        f"SELECT * FROM VALUES {', '.join(columns)} AS t(table_no, ordinal, DataFrame_name, column_name, data_type)"
    )
    return listed, reduce(DataFrame.unionAll, codes).groupBy("table_no", "ordinal", "code").count()


def _counts(count: str = "count") -> list[Column]:
    def rows_with(*wanted: int) -> Column:
        return F.sum(F.when(F.col("code").isin(*wanted), F.col(count)).otherwise(F.lit(0)))

    return [
        F.coalesce(F.sum(count), F.lit(0)).alias("total_count"),
        rows_with(_NULL).alias("null_count"),
        rows_with(_EMPTY).alias("empty_count"),
        rows_with(_INTEGER).alias("integer_count"),
        rows_with(_INTEGER, _DECIMAL).alias("decimal_count"),
        rows_with(_INTEGER, _DECIMAL, _OTHER).alias("string_count"),
    ]


def profile_tables(tables: Mapping[str, DataFrame], strict: bool = True) -> DataFrame:
    """One row per column of every named table: name, type, total, five counts and class.

    A decimal count includes the integers. The class is the first that fits of null, integer, decimal
    and string, blanks being allowed in each. With ``strict=False`` text columns holding numeric and
    other values are ``mixed``.
    """
    listed, per_code = _code_counts(tables)
    counted = per_code.groupBy("table_no", "ordinal").agg(*_counts())
    totals = ("total_count", *_COUNTS)
    return (
        listed.join(counted, ["table_no", "ordinal"], "left")
        .select("DataFrame_name", "ordinal", "column_name", "data_type", *[F.coalesce(c, F.lit(0)).alias(c) for c in totals])
        .selectExpr("*", _class_of(strict))
    )


def profile_state(tables: Mapping[str, DataFrame]) -> DataFrame:
    """What later profiles need of one delivery: ``DataFrame_name, ordinal, column_name, data_type, code, count``.

    Counts add up, so states of several deliveries together say what a profile of all their rows would. A column without rows is
    kept by a row without code.
    """
    listed, per_code = _code_counts(tables)
    return listed.join(per_code, ["table_no", "ordinal"], "left").select(
        "DataFrame_name", "ordinal", "column_name", "data_type", F.col("code").cast("int").alias("code"), F.coalesce("count", F.lit(0)).alias("count")
    )


def merged_profile(states: DataFrame, strict: bool = True) -> DataFrame:
    """The profile of all deliveries in ``states``, columns by name, laid out as ``profile_tables`` does.

    A column keeps its first place. Where its type differs between deliveries, all its types are named, sorted, with ``|`` between them. Rows of a
    delivery that lacks a column count as null there, as they would in a union by name.
    """
    rows_of = states.groupBy("DataFrame_name", "delivery", "column_name").agg(F.sum("count").alias("rows"))
    rows_of = rows_of.groupBy("DataFrame_name", "delivery").agg(F.max("rows").alias("rows"))
    all_rows = rows_of.groupBy("DataFrame_name").agg(F.sum("rows").alias("all_rows"))
    merged = states.groupBy("DataFrame_name", "column_name").agg(
        F.min("ordinal").alias("ordinal"), F.array_join(F.array_sort(F.collect_set("data_type")), "|").alias("data_type"), *_counts()
    )
    unseen = F.col("all_rows") - F.col("total_count")
    filled = merged.join(all_rows, "DataFrame_name").withColumn("null_count", F.col("null_count") + unseen).withColumn("total_count", F.col("all_rows"))
    totals = ("total_count", *_COUNTS)
    return filled.select("DataFrame_name", "ordinal", "column_name", "data_type", *totals).selectExpr("*", _class_of(strict))


def profile_columns(df: DataFrame, name: str, strict: bool = True) -> DataFrame:
    """The profile of one table."""
    return profile_tables({name: df}, strict)


def profile_reports(tables: Mapping[str, DataFrame], strict: bool = True) -> DataFrame:
    """One JSON text per table, in the layout of the per-table profile report.

    Grouping is by table, and a group has one row per column of that table's schema.
    """
    gathered = profile_tables(tables, strict).groupBy("DataFrame_name").agg(
        F.sort_array(F.collect_list(F.struct("ordinal", "column_name", "column_class", *_COUNTS))).alias("found"),
    )

    def named(column_class: str) -> Column:
        fitting = F.filter("found", lambda c: c["column_class"] == column_class)
        return F.transform(fitting, lambda c: c["column_name"]).alias(f"{column_class}_columns")

    frequencies = F.map_from_entries(F.transform("found", lambda c: F.struct(
        c["column_name"], F.struct(*[c[count].alias(count) for count in _COUNTS])
    )))
    schemas = F.create_map(*[F.lit(text) for name, df in tables.items() for text in (name, df.schema.json())])
    report = F.struct(
        F.col("DataFrame_name"),
        F.parse_json(schemas[F.col("DataFrame_name")]).alias("schema"),
        F.transform("found", lambda c: c["column_name"]).alias("column_names"),
        *[named(c) for c in (CLASS_INTEGER, CLASS_DECIMAL, CLASS_STRING, CLASS_MIXED, CLASS_NULL)],
        frequencies.alias("column_frequencies"),
    )
    return gathered.select("DataFrame_name", pretty_json(report).alias("report"))
