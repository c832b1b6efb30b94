"""Schema drift between deliveries: which fields change type, or are absent, from file to file.

The input is a catalogue set: rows ``Field, Data Type, filename``, or the same with a count of
``entries``. A report row lists file names. A list
of every file would grow without bound, so each list holds about ``files_per_row`` names and goes on in
further rows (``part`` 0, 1, ...); all rows of a field and type together name every file. Counts are
pre-aggregated before each exchange, so a field, type or file that owns a large share of the
catalogue rows costs no single task more than its distinct entries.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from docstrata.conventions import CATALOG_FILE, DATA_TYPE, FIELD, TYPE_ABSENT
from docstrata.session import settle

FILES_PER_ROW = 1_000
FIELDS_PER_SLOT = 1_000
GROUP_SLOTS = 16
PART = "part"
ENTRIES = "entries"


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name, missing columns null."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def catalog_entries(catalog: DataFrame) -> DataFrame:
    """``Field, Data Type, filename, entries``: how often a file lists a field with a type.

    Rows without a field or type do not count. The reports below accept a catalogue set in either form.
    For one with very many rows, write this small table once (``settle``) and report from there: each
    report reads its input more than once.
    """
    weight = F.sum(ENTRIES) if ENTRIES in catalog.columns else F.count("*")
    typed = catalog.filter(F.col(FIELD).isNotNull() & F.col(f"`{DATA_TYPE}`").isNotNull())
    return typed.groupBy(FIELD, DATA_TYPE, CATALOG_FILE).agg(weight.alias(ENTRIES))


def type_conflicts(catalog: DataFrame, files_per_row: int = FILES_PER_ROW) -> DataFrame:
    """Fields that occur with more than one type: ``Field, Data Type, part, filename`` (a sorted list).

    A file that lists a field with the same type several times is named as often.
    """
    entries = catalog_entries(catalog)
    per_type = entries.groupBy(FIELD, DATA_TYPE).agg(F.sum(ENTRIES).alias("total"))
    # More than one type: the most frequent type does not account for all entries of the field.
    torn = (
        per_type.groupBy(FIELD).agg(F.sum("total").alias("all_types"), F.max("total").alias("one_type"))
        .filter(F.col("all_types") > F.col("one_type")).select(FIELD)
    )
    parts = F.ceil(F.col("total") / F.lit(files_per_row)).alias("parts")
    listed = entries.join(per_type.join(torn, FIELD).select(FIELD, DATA_TYPE, parts), [FIELD, DATA_TYPE])
    # A file named more often than one list may hold is cut into pieces first.
    last_piece = F.floor((F.col(ENTRIES) - 1) / F.lit(files_per_row))
    pieces = listed.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last_piece)))
    times = F.least(F.lit(files_per_row).cast("bigint"), F.col(ENTRIES) - F.col("piece") * files_per_row).cast("int")
    # Spread by part as well: grouping where the join left the rows would keep a hot field in one task.
    return (
        pieces.select(
            FIELD, DATA_TYPE,
            F.pmod(F.xxhash64(CATALOG_FILE, "piece"), F.col("parts")).cast("int").alias(PART),
            F.array_repeat(F.col(CATALOG_FILE), times).alias("names"),
        )
        .repartition(FIELD, DATA_TYPE, PART)
        .groupBy(FIELD, DATA_TYPE, PART)
        .agg(F.sort_array(F.flatten(F.collect_list("names"))).alias(CATALOG_FILE))
    )


def first_types(catalog: DataFrame, order_col: str | None = None) -> DataFrame:
    """One type per field and file: the first by ``order_col``, else the smallest text."""
    if order_col:
        typed = catalog.dropna(subset=[FIELD, DATA_TYPE])
        return typed.groupBy(FIELD, CATALOG_FILE).agg(F.min_by(DATA_TYPE, order_col).alias(DATA_TYPE))
    # A minimum over texts sorts its input; the exchange in between makes that the distinct entries.
    entries = catalog_entries(catalog).select(FIELD, DATA_TYPE, CATALOG_FILE)
    return entries.repartition(FIELD, CATALOG_FILE).groupBy(FIELD, CATALOG_FILE).agg(F.min(DATA_TYPE).alias(DATA_TYPE))


def _groups_of(size: int, names: DataFrame) -> Column:
    """How many groups of about ``size`` the rows of ``names`` make, at least one: counted once, then a constant."""
    return F.lit(max(1, -(-names.count() // size)))


def _group_number(column: str, groups: Column) -> Column:
    return F.pmod(F.xxhash64(column), groups).cast("int")


def _absences(typed: DataFrame, files_per_row: int, only: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The typed rows with their ``part``, and per field and part the list of files lacking the field.

    File names lie on numbered shelves of about ``files_per_row`` names (the ``part``). Every field, or
    those in ``only``, meets every shelf rather than every file, in an equi-join that is spread over as
    many slots as there are thousands of fields. It is always a merge: size estimates do not see how
    often a row has been repeated, and might have the grown side broadcast.
    """
    files = typed.select(CATALOG_FILE).distinct()
    shelf_count = _groups_of(files_per_row, files)
    placed = typed.withColumn(PART, _group_number(CATALOG_FILE, shelf_count))
    present = placed if only is None else placed.join(only, FIELD, "left_semi").repartition(FIELD, PART)
    fields = typed.select(FIELD).distinct() if only is None else only
    slot_count = _groups_of(FIELDS_PER_SLOT, fields)

    held = present.groupBy(FIELD, PART).agg(F.collect_list(CATALOG_FILE).alias("held"))
    wanted = (
        fields.select(FIELD, F.explode(F.sequence(F.lit(0), shelf_count - 1)).alias(PART))
        .join(held, [FIELD, PART], "left")
        .withColumn("slot", _group_number(FIELD, slot_count))
    )
    shelves = (
        files.groupBy(_group_number(CATALOG_FILE, shelf_count).alias(PART)).agg(F.collect_list(CATALOG_FILE).alias("shelf"))
        .select(PART, "shelf", F.explode(F.sequence(F.lit(0), slot_count - 1)).alias("slot"))
    )
    lacking = F.when(F.col("held").isNull(), F.col("shelf")).otherwise(F.array_except("shelf", "held"))
    absent = wanted.join(shelves.hint("merge"), [PART, "slot"]).select(FIELD, PART, lacking.alias("lacking"))
    return present, absent.filter(F.size("lacking") > 0)


def type_conflicts_with_absence(
    catalog: DataFrame, files_per_row: int = FILES_PER_ROW, order_col: str | None = None
) -> DataFrame:
    """As ``type_conflicts``, where a file lacking a field counts as type ``Data Type Not Present``.

    Each file has one type per field here, so a conflict within a single file does not show.
    """
    typed = settle(first_types(catalog, order_col), "first-types")
    file_count = typed.select(CATALOG_FILE).distinct().count()
    uneven = settle(
        typed.groupBy(FIELD)
        .agg(F.min(DATA_TYPE).alias("low"), F.max(DATA_TYPE).alias("high"), F.count("*").alias("files"))
        .filter((F.col("low") != F.col("high")) | (F.col("files") < file_count))
        .select(FIELD), "uneven-fields"
    )
    present, absent = _absences(typed, files_per_row, uneven)
    found = present.groupBy(FIELD, DATA_TYPE, PART).agg(F.collect_list(CATALOG_FILE).alias("names"))
    missing = absent.select(FIELD, F.lit(TYPE_ABSENT).alias(DATA_TYPE), PART, F.col("lacking").alias("names"))
    return found.unionByName(missing).select(FIELD, DATA_TYPE, PART, F.sort_array("names").alias(CATALOG_FILE))


def file_groups(typed: DataFrame) -> DataFrame:
    """``filename, file_group``: files with the same fields of the same types share a group.

    The group is a fingerprint of the file's rows that does not depend on their order: two sums of hashes and the count,
    pre-aggregated before the exchange.
    """
    row = lambda seed: F.sum(F.xxhash64(F.lit(seed), FIELD, DATA_TYPE).cast("decimal(20,0)"))
    parts = F.concat_ws("/", row(1).cast("string"), row(2).cast("string"), F.count("*").cast("string"))
    return typed.groupBy(CATALOG_FILE).agg(F.sha2(parts, 256).alias("file_group"))


def group_conflicts(catalog: DataFrame, order_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Conflicts, absence included, by groups of files: (``Field, Data Type, file_group, files``; ``file_group, filename``).

    A field's row tells for a group of alike files, and their number, the type they give it or ``Data Type Not Present``.
    Together the two tables say the same as ``type_conflicts_with_absence``, in the size of the input and of the distinct
    catalogues; joined by ``file_group`` they name every file. Deliveries mostly repeat few catalogues.
    """
    typed = settle(first_types(catalog, order_col), "first-types")
    members = settle(file_groups(typed), "file-groups")
    groups = settle(members.groupBy("file_group").agg(F.count("*").alias("files"), F.min(CATALOG_FILE).alias(CATALOG_FILE)), "group-sizes")
    # One file stands for its group from here on.
    known = settle(typed.join(groups, CATALOG_FILE).select(FIELD, DATA_TYPE, "file_group", "files"), "group-types")
    every = groups.agg(F.count("*").alias("groups")).first()["groups"]
    uneven = known.groupBy(FIELD).agg(F.min(DATA_TYPE).alias("low"), F.max(DATA_TYPE).alias("high"), F.count("*").alias("held"))
    uneven = settle(uneven.where((F.col("low") != F.col("high")) | (F.col("held") < every)).select(FIELD, "held"), "uneven-fields")
    present = known.join(uneven.select(FIELD), FIELD)
    # Only fields that some group lacks are laid against the groups, each against all of them.
    slots = F.explode(F.sequence(F.lit(0), F.lit(GROUP_SLOTS - 1))).alias("slot")
    gaps = uneven.where(F.col("held") < every).select(FIELD, slots)
    spread = groups.select("file_group", "files", F.pmod(F.xxhash64("file_group"), F.lit(GROUP_SLOTS)).cast("int").alias("slot"))
    lacking = gaps.join(spread, "slot").join(known.select(FIELD, "file_group"), [FIELD, "file_group"], "left_anti")
    missing = lacking.select(FIELD, F.lit(TYPE_ABSENT).alias(DATA_TYPE), "file_group", "files")
    return present.select(FIELD, DATA_TYPE, "file_group", "files").unionByName(missing), members


def types_by_file(
    catalog: DataFrame, files_per_row: int = FILES_PER_ROW, order_col: str | None = None
) -> DataFrame:
    """Long form: ``Field, filename, Data Type`` for every field and every file."""
    typed = settle(first_types(catalog, order_col), "first-types")
    present, absent = _absences(typed, files_per_row)
    missing = absent.select(FIELD, F.explode("lacking").alias(CATALOG_FILE), F.lit(TYPE_ABSENT).alias(DATA_TYPE))
    return present.select(FIELD, CATALOG_FILE, DATA_TYPE).unionByName(missing)


def pivot_types(
    catalog: DataFrame, files: Sequence[str] | None = None, order_col: str | None = None
) -> DataFrame:
    """Wide form: one row per field, one column per file.

    As wide as there are files: Spark refuses more columns than ``spark.sql.pivotMaxValues``. Use
    ``types_by_file`` for catalogue sets of that size.
    """
    typed = first_types(catalog, order_col)
    wide = typed.groupBy(FIELD).pivot(CATALOG_FILE, list(files) if files else None).agg(F.first(DATA_TYPE, ignorenulls=True))
    return wide.na.fill(TYPE_ABSENT)


def melt_types(wide: DataFrame) -> DataFrame:
    """The wide form back to ``Field, filename, Data Type``."""
    files = [F.col("`" + name.replace("`", "``") + "`") for name in wide.columns if name != FIELD]
    return wide.unpivot(FIELD, files, CATALOG_FILE, DATA_TYPE)


def as_delimited_report(conflicts: DataFrame, separator: str = ", ") -> DataFrame:
    """The report with its file list as one text, for delimited files."""
    return conflicts.withColumn(CATALOG_FILE, F.array_join(CATALOG_FILE, separator))
