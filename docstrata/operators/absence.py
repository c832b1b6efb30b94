"""Which files lack which field, kept as bitmaps: one bit per file and type instead of a name.

Files are numbered once: a hash deals them to shelves of about ``FILES_PER_SHELF``, and a file's place on its shelf is a bit of
that shelf's bitmap. Absence is stored as a number only, since the files that lack a field are those whose bit no type of the field
has set. So the report has no row for a field and a file, nor for a field and a shelf it does not occur on; ``opened_absences``
gives the names, for all fields or the few asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docstrata.conventions import CATALOG_FILE, DATA_TYPE, FIELD, TYPE_ABSENT
from docstrata.operators.drift import first_types
from docstrata.session import settle

#: Half of what one bitmap holds. A shelf that takes more than a bitmap's worth goes on in a further one.
FILES_PER_SHELF = 16_384
_PLACE = ("shelf", "bucket")
_MOST_BITMAPS = 2_000  # of all files together, broadcast up to 8 MB


def numbered_files(catalog: DataFrame, files_per_shelf: int = FILES_PER_SHELF) -> DataFrame:
    """``filename, shelf, bucket, bit``: every file's place, the same for the same set of files."""
    files = settle(catalog.select(CATALOG_FILE).where(F.col(CATALOG_FILE).isNotNull()).distinct(), "file-names")
    shelves = max(1, -(-files.count() // files_per_shelf))
    dealt = files.withColumn("shelf", F.pmod(F.xxhash64(CATALOG_FILE), F.lit(shelves)).cast("int"))
    number = F.row_number().over(Window.partitionBy("shelf").orderBy(CATALOG_FILE))
    placed = dealt.withColumn("number", number)
    return placed.select(
        CATALOG_FILE, "shelf", F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("bit")
    )


def absence_bitmaps(
    catalog: DataFrame, order_col: str | None = None, files_per_shelf: int = FILES_PER_SHELF
) -> tuple[DataFrame, DataFrame]:
    """Conflicts, absence included: (``Field, Data Type, shelf, bucket, bits, files``; the places of all files).

    A row holds the files of one bitmap that give the field that type. A field that some files lack has one more row, of type
    ``Data Type Not Present``, with their number and no bitmap. Each file has one type per field, as in
    ``type_conflicts_with_absence``, which gives the same report with names. Rows without field, type or file do not count.
    """
    typed = settle(first_types(catalog.where(F.col(CATALOG_FILE).isNotNull()), order_col), "first-types")
    places = settle(numbered_files(typed, files_per_shelf), "file-places")
    every = places.count()
    held = typed.join(places, CATALOG_FILE).groupBy(FIELD, DATA_TYPE, *_PLACE).agg(F.bitmap_construct_agg("bit").alias("bits"))
    held = settle(held.withColumn("files", F.bitmap_count("bits")), "type-bitmaps")
    per_type = held.groupBy(FIELD, DATA_TYPE).agg(F.sum("files").alias("files"))
    fields = per_type.groupBy(FIELD).agg(F.sum("files").alias("holders"), F.count("*").alias("types"))
    uneven = settle(fields.where((F.col("types") > 1) | (F.col("holders") < every)), "uneven-fields")
    present = held.join(uneven.select(FIELD), FIELD).select(FIELD, DATA_TYPE, *_PLACE, "bits", "files")
    nowhere = [F.lit(None).cast(held.schema[name].dataType).alias(name) for name in (*_PLACE, "bits")]
    lacking = uneven.where(F.col("holders") < every).select(
        FIELD, F.lit(TYPE_ABSENT).alias(DATA_TYPE), *nowhere, (F.lit(every) - F.col("holders")).alias("files")
    )
    return settle(present.unionByName(lacking), "absence-bitmaps"), places


def _byte(bits: Column, place: Column) -> Column:
    return F.conv(F.hex(F.substring(bits, place + 1, F.lit(1))), 16, 10).cast("int")


def _bits(of: Column, less: Column | None = None) -> Column:
    """Positions of the bits set in one bitmap, and not in the other. Bytes without any are passed over at once."""
    def eight(place: Column) -> Column:
        value = _byte(of, place)
        if less is not None:
            value = value.bitwiseAND(F.bitwise_not(F.coalesce(_byte(less, place), F.lit(0))))
        return F.filter(
            F.array(*[F.when(value.bitwiseAND(F.lit(1 << bit)) != 0, place * 8 + bit) for bit in range(8)]), lambda found: found.isNotNull()
        )

    taken = F.filter(F.sequence(F.lit(0), F.length(of) - 1), lambda place: F.substring(of, place + 1, F.lit(1)) != F.lit(b"\x00"))
    return F.flatten(F.transform(taken, eight))


def opened_absences(bitmaps: DataFrame, places: DataFrame) -> DataFrame:
    """``Field, Data Type, filename`` of a report, every file named. As long as the names are: filter ``bitmaps`` by field first."""
    of_bit = [*_PLACE, "bit"]
    present = bitmaps.where(F.col("bits").isNotNull()).select(FIELD, DATA_TYPE, *_PLACE, F.explode(_bits(F.col("bits"))).alias("bit"))
    # A field meets every bitmap of all files, not every file; its own bits go out there.
    lacking = bitmaps.where(F.col(f"`{DATA_TYPE}`") == TYPE_ABSENT).select(FIELD)
    whole = settle(places.groupBy(*_PLACE).agg(F.bitmap_construct_agg("bit").alias("whole")), "whole-shelves")
    shelves = whole.agg(F.count("*").alias("n"), F.max("shelf").alias("last")).first()
    if shelves["n"] == 0:
        return present.select(FIELD, DATA_TYPE, F.lit(None).cast("string").alias(CATALOG_FILE)).limit(0)
    held = bitmaps.where(F.col("bits").isNotNull()).groupBy(FIELD, *_PLACE).agg(F.bitmap_or_agg("bits").alias("held"))
    wanted = lacking.select(FIELD, F.explode(F.sequence(F.lit(0), F.lit(shelves["last"]))).alias("shelf"))
    met = wanted.join(F.broadcast(whole) if shelves["n"] <= _MOST_BITMAPS else whole, "shelf").join(held, [FIELD, *_PLACE], "left")
    gaps = met.select(FIELD, F.lit(TYPE_ABSENT).alias(DATA_TYPE), *_PLACE, F.explode(_bits(F.col("whole"), F.col("held"))).alias("bit"))
    return present.unionByName(gaps).join(places, of_bit).select(FIELD, DATA_TYPE, CATALOG_FILE)
