"""Registered queries over the given tables, each with the SQL that must give the same rows.

A query takes ``(spark, sf_dir)``. Column names are equal on both sides. The SQL is left out where the
result depends on the environment.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docstrata.conventions import CATALOG_FILE, DATA_TYPE, FIELD, HIERARCHY, ORIGIN_COLUMN, TOP_LEVEL
from docstrata.functions.names import base_name, object_name, parent_path, routed_table
from docstrata.functions.values import (
    is_decimal_text,
    is_empty_text,
    is_filled_text,
    is_integer_text,
    is_numeric_or_present,
    iso_time,
    listing_time,
    with_default,
)
from docstrata.operators.absence import absence_bitmaps, opened_absences
from docstrata.operators.catalog import ancestors, array_fields, schema_catalog, schema_tree_rows
from docstrata.operators.drift import (
    ENTRIES,
    as_delimited_report,
    group_conflicts,
    melt_types,
    pivot_types,
    type_conflicts,
    type_conflicts_with_absence,
    types_by_file,
    union_by_name,
)
from docstrata.operators.expand import drop_arrays, expand_structs
from docstrata.operators.extract import batches, child_table, child_tables, main_table, row_counts, tables_as_one
from docstrata.operators.file_catalogs import file_catalogs
from docstrata.operators.labels import CHAIN, OWN, flatten_labeled, labeled_tables
from docstrata.operators.nulls import empty_to_null, mark_nulls
from docstrata.operators.profile import profile_columns, profile_reports, profile_tables
from docstrata.plans.incremental import load_new_files, loaded_table
from docstrata.plans.load import load_folder, two_level_rows
from docstrata.plans.profiles import add_delivery, grown_profile
from docstrata.plans.schema_growth import conformed, replayed, widened_schema
from docstrata.plans.table_sets import flatten_documents, json_to_tables
from docstrata.session import scratch_path, settle
from docstrata.sinks.tables import write_catalog, write_delimited, write_drift_report, write_marked, write_profile, write_tables
from docstrata.sources.delimited import read_catalogs, read_delimited, read_delimited_by_name
from docstrata.sources.documents import parse_json_column, read_document_lists, read_documents, with_origin
from docstrata.streaming.ingest import ingest_documents, ingested_table
from docstrata.workload import oracles as sql
from docstrata.workload.shapes import (
    CATALOG_FILES,
    event_entries,
    line_docs,
    order_docs,
    page_docs,
    patchy_customers,
    table,
    text_docs,
    vector_docs,
    written_json,
    written_json_lists,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None):
    def register(function: Query) -> Query:
        name = function.__name__
        QUERIES[name] = function
        if check:
            CHECKS[name] = check
        return function

    return register


# --- sources ---------------------------------------------------------------------------------------


_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"


def _events(spark, sf_dir):
    """Events with their time as text, which JSON keeps to the microsecond."""
    return table(spark, sf_dir, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(f"SELECT event_id, {_TS} AS ts, user_id, event_type, value, props FROM events")
def q_json_scan(spark, sf_dir):
    return read_documents(spark, written_json(_events(spark, sf_dir), "events"))


@query("SELECT event_type, user_id, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id, "
       f"min({_TS}) AS first_ts, max({_TS}) AS last_ts FROM events GROUP BY event_type, user_id")
def q_json_multiline(spark, sf_dir):
    path = written_json_lists(_events(spark, sf_dir), "event-lists")
    documents = read_documents(spark, path, multiline=True)
    return documents.groupBy("event_type", "user_id").agg(
        F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
    )


@query("SELECT event_id, 0 AS gap, value FROM events")
def q_json_lists(spark, sf_dir):
    """List files, each item with its place: items of a file stand in the order of their ids, one place after another."""
    events = _events(spark, sf_dir).withColumn("id_in_part", F.monotonically_increasing_id())
    path = written_json_lists(events, "placed-lists")
    items = read_document_lists(spark, path, events.schema, "place", rescued_col="lost")
    # Within a list, number and place go up together; a list starts at a number its batch starts at.
    batch = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    inside = F.col("id_in_part").bitwiseAND((1 << 33) - 1) % batch
    return items.where("lost IS NULL").select("event_id", (inside - F.col("place")).cast("int").alias("gap"), "value")


@query("""SELECT event_id, user_id, value,
       CASE event_id % 9 WHEN 0 THEN 'broken' WHEN 1 THEN 'unknown field' WHEN 2 THEN 'other type' WHEN 3 THEN 'unknown inner field'
         WHEN 4 THEN 'unknown in lists' WHEN 5 THEN 'unknown in a map' WHEN 6 THEN 'twice' WHEN 7 THEN 'trailing' END AS spoilt
FROM events""")
def q_rescued(spark, sf_dir):
    """Events as JSON, eight in nine spoilt, read with the schema of the good ones: every line is a document or a rescued text."""
    good = F.to_json(F.struct("event_id", "user_id", "value", F.struct("event_type").alias("kind")))
    kind = F.col("event_id") % 9
    line = (
        F.when(kind == 0, F.substring(good, F.lit(2), F.length(good)))
        .when(kind == 1, F.regexp_replace(good, r"\}$", ',"more":[1]}'))
        .when(kind == 2, F.regexp_replace(good, '"value":[^,]*', '"value":"x"'))
        .when(kind == 3, F.replace(good, F.lit('"kind":{'), F.lit('"kind":{"extra":1,')))
        .when(kind == 4, F.regexp_replace(good, r"\}$", ',"grid":[[{"x":1},{"deep":2}]]}'))
        .when(kind == 5, F.regexp_replace(good, r"\}$", ',"named":{"any":{"inside":1}}}'))
        .when(kind == 6, F.regexp_replace(good, r"\}$", ',"user_id":-1}'))
        .when(kind == 7, F.concat(good, F.lit(" and on")))
        .otherwise(F.regexp_replace(good, r"\}$", ',"grid":[[{"x":1}],[]],"named":{"any":{"x":1}}}'))
    )
    path = scratch_path(spark, "spoilt-events")
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    schema = T.StructType.fromDDL(
        "event_id bigint, user_id bigint, value double, kind struct<event_type: string>, grid array<array<struct<x: bigint>>>, named map<string, struct<x: bigint>>"
    )
    read = read_documents(spark, path, schema, rescued_col="rescued")
    # What was rescued is the whole line, so nothing of it is lost: the ids are found in either.
    text = F.coalesce("rescued", F.to_json(F.struct("event_id", "user_id")))

    def found(name):
        return F.regexp_extract(text, f'{name}":([0-9]+)', 1).cast("bigint").alias(name)

    spoilt = (
        F.when(~F.startswith("rescued", F.lit("{")), "broken").when(F.contains("rescued", F.lit('"more"')), "unknown field")
        .when(F.contains("rescued", F.lit('"extra"')), "unknown inner field").when(F.contains("rescued", F.lit('"deep"')), "unknown in lists")
        .when(F.contains("rescued", F.lit('"inside"')), "unknown in a map").when(F.contains("rescued", F.lit('"user_id":-1')), "twice")
        .when(F.endswith("rescued", F.lit("on")), "trailing").when(F.col("rescued").isNotNull(), "other type")
    )
    rows = read.select(found("event_id"), found("user_id"), spoilt.alias("spoilt"))
    return rows.join(table(spark, sf_dir, "events").select("event_id", "value"), "event_id")


@query("SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def q_parse_props(spark, sf_dir):
    parsed = parse_json_column(table(spark, sf_dir, "events"), "props", "k bigint")
    return parsed.select("event_id", "props.k")


@query(" UNION ALL ".join(f"SELECT '{name}' AS table_name, true AS named, count(*) AS n FROM {name}" for name in sql.TABLE_COLUMNS))
def q_origin_column(spark, sf_dir):
    # A table may be one file or a folder of parts, so only the ending of the name is the same everywhere.
    named = F.endswith(ORIGIN_COLUMN, F.lit(".parquet")).alias("named")
    frames = [with_origin(table(spark, sf_dir, name)).select(F.lit(name).alias("table_name"), named) for name in sql.TABLE_COLUMNS]
    return union_by_name(frames).groupBy("table_name", "named").agg(F.count("*").alias("n"))


@query("""SELECT page_id, lower(split_part(base, '.', 1)) AS stem, 'web.' || lower(split_part(base, '.', 1)) AS target,
       replace(translate(base, '.[', '__'), ']', '') AS safe
FROM (SELECT page_id, string_split(url, '/')[-1] AS base FROM pages)""")
def q_table_names(spark, sf_dir):
    name = base_name(F.col("url"))
    return table(spark, sf_dir, "pages").select(
        "page_id", routed_table(name).alias("stem"), routed_table(name, "web").alias("target"), object_name(name).alias("safe")
    )


# --- documents to tables ---------------------------------------------------------------------------


@query(f"""WITH {sql.LINES}
SELECT text, CAST(length(text) AS INTEGER) AS n_chars, count(*) AS n FROM lines GROUP BY text""")
def q_child_explode(spark, sf_dir):
    lines = child_table(text_docs(spark, sf_dir), "lines", keys=False)
    return lines.groupBy("text", "n_chars").agg(F.count("*").alias("n"))


@query(f"WITH {sql.LINES} SELECT doc_id AS root_id, pos AS lines_pos, text, CAST(length(text) AS INTEGER) AS n_chars FROM lines")
def q_child_one_level(spark, sf_dir):
    return child_table(text_docs(spark, sf_dir), "lines")


@query(f"""WITH {sql.WORDS}
SELECT doc_id AS root_id, pos AS lines_pos, wpos AS words_pos, word, CAST(length(word) AS INTEGER) AS size,
       regexp_extract(word, '[.,]$') AS mark
FROM words""")
def q_child_two_levels(spark, sf_dir):
    return child_table(text_docs(spark, sf_dir), "lines.words")


@query(f"""WITH {sql.CHARGES}
SELECT l_orderkey AS root_id_order, l_linenumber AS root_id_line, l_partkey AS root_id_part,
       CAST(pos AS INTEGER) AS charges_pos, kind, rate, l_extendedprice AS base_price, l_quantity AS base_units
FROM charges""")
def q_child_through_struct(spark, sf_dir):
    return child_table(line_docs(spark, sf_dir), "body.charges")


@query(f"""WITH {sql.WORDS}
SELECT 'documents_main' AS table_name, count(*) AS row_count FROM documents
UNION ALL SELECT 'lines', count(*) FROM lines
UNION ALL SELECT 'lines_words', count(*) FROM words""")
def q_all_children_counts(spark, sf_dir):
    # Several tables off one computed input: built once, landed, and each table reads its own columns.
    landed = settle(text_docs(spark, sf_dir), "text-documents")
    return row_counts(flatten_documents(landed, "documents", stored=True))


@query(f"""WITH {sql.LINKS}, {sql.HEADS}
SELECT 'page_links' AS table_name, CAST(page_id AS VARCHAR) AS "root_id_$oid", pos AS links_pos, href,
       CAST(NULL AS INTEGER) AS heads_pos, CAST(NULL AS VARCHAR) AS title FROM links
UNION ALL SELECT 'page_heads', CAST(page_id AS VARCHAR), NULL, NULL, pos, title FROM heads""")
def q_tables_one_job(spark, sf_dir):
    # Landed once, so that the pages are scanned and parsed once and each table reads its own columns.
    landed = settle(page_docs(spark, sf_dir), "page-documents")
    groups = batches(child_tables(landed, stored=True), size=5)
    return union_by_name(tables_as_one(group) for group in groups)


@query("""SELECT o_orderkey AS _id, o_custkey AS customer, o_orderstatus AS header_status, o_totalprice AS header_price,
       o_orderpriority AS header_meta_priority, strftime(o_orderdate, '%Y-%m-%d') AS header_meta_placed FROM orders""")
def q_main_table(spark, sf_dir):
    return main_table(order_docs(spark, sf_dir))


@query("""SELECT o_orderkey AS _id, o_custkey AS customer, o_orderstatus AS header_status, o_totalprice AS header_price,
       o_orderpriority AS header_meta_priority, strftime(o_orderdate, '%Y-%m-%d') AS header_meta_placed,
       replace(o_orderpriority, '-', '|') AS header_meta_codes, replace(o_orderpriority, ' ', '|') AS tags FROM orders""")
def q_expand_structs(spark, sf_dir):
    wide = expand_structs(order_docs(spark, sf_dir))
    return wide.withColumns({c: F.array_join(c, "|") for c in ("tags", "header_meta_codes")})


@query("""SELECT o_orderkey AS _id, o_custkey AS customer, o_orderstatus AS status, o_totalprice AS price,
       o_orderpriority AS priority, strftime(o_orderdate, '%Y-%m-%d') AS placed,
       replace(o_orderpriority, '-', '|') AS codes, replace(o_orderpriority, ' ', '|') AS tags FROM orders""")
def q_expand_unprefixed(spark, sf_dir):
    wide = expand_structs(order_docs(spark, sf_dir), prefixed=False)
    return wide.withColumns({c: F.array_join(c, "|") for c in ("tags", "codes")})


@query("""SELECT o_orderkey AS _id, o_custkey AS customer, o_orderstatus AS status, o_totalprice AS price,
       o_orderpriority AS priority, strftime(o_orderdate, '%Y-%m-%d') AS placed FROM orders""")
def q_drop_arrays(spark, sf_dir):
    # Opening the structs by star shows exactly the fields that are left in them.
    pruned = drop_arrays(order_docs(spark, sf_dir))
    return pruned.select("_id", "customer", "header.*").select("_id", "customer", "status", "price", "meta.*")


@query(f"""WITH {sql.WORDS}
SELECT CAST(w.doc_id AS VARCHAR) AS _id, CAST(length(l.text) AS VARCHAR) AS n_chars, w.word AS word,
       coalesce(nullif(regexp_extract(w.word, '[.,]$'), ''), 'NULL') AS mark
FROM words w JOIN lines l ON l.doc_id = w.doc_id AND l.pos = w.pos""")
def q_nested_extract(spark, sf_dir):
    rows = two_level_rows(text_docs(spark, sf_dir), "lines", "words", ["n_chars"], drop=["size"])
    return mark_nulls(rows)


_PAGE_TABLES = f"""WITH {sql.LINKS}, {sql.HEADS}
SELECT 'pages_main' AS table_name, CAST(page_id AS VARCHAR) AS "_id_$oid", url AS page_url, CAST(NULL AS VARCHAR) AS "root_id_$oid",
       CAST(NULL AS INTEGER) AS links_pos, CAST(NULL AS VARCHAR) AS href, CAST(NULL AS INTEGER) AS heads_pos, CAST(NULL AS VARCHAR) AS title{{origin}} FROM pages
UNION ALL SELECT 'page_links', NULL, NULL, CAST(page_id AS VARCHAR), pos, href, NULL, NULL{{origin}} FROM links
UNION ALL SELECT 'page_heads', NULL, NULL, CAST(page_id AS VARCHAR), NULL, NULL, pos, title{{origin}} FROM heads"""


@query(_PAGE_TABLES.format(origin=", 'part-*.json' AS \"Filename\""))
def q_document_table_set(spark, sf_dir):
    source = written_json(page_docs(spark, sf_dir), "pages")
    target = scratch_path(spark, "page-tables")
    names = json_to_tables(spark, source, target, "pages", file_format="parquet", landing=scratch_path(spark, "page-landing"))
    stacked = tables_as_one({name: spark.read.parquet(f"{target}/{name}.parquet") for name in names})
    # The part files' own names differ from run to run.
    return stacked.withColumn(ORIGIN_COLUMN, F.regexp_replace(ORIGIN_COLUMN, r"^part-.*\.json$", "part-*.json"))


# --- index labels ----------------------------------------------------------------------------------


@query("""SELECT vec_id AS _id, label, UNNEST(embedding) AS embedding,
       'embedding_' || UNNEST(range(len(embedding))) AS embedding_index FROM embeddings""")
def q_primitive_array(spark, sf_dir):
    return flatten_labeled(vector_docs(spark, sf_dir))


_LABELLED_PAGES = """
SELECT CAST(p.page_id AS VARCHAR) AS "_id{dot}$oid", p.url AS "page{dot}url", s.href AS "page{dot}links{dot}href",
       s.step AS "page{dot}links{dot}steps", {inner} AS "{lead}page_links_steps_index", 'links_' || s.pos AS "{lead}page_links_index",
       h.title AS "page{dot}heads{dot}title", 'heads_' || h.pos AS "{lead}page_heads_index"
FROM pages p LEFT JOIN steps s ON s.page_id = p.page_id LEFT JOIN heads h ON h.page_id = p.page_id"""


@query(f"WITH {sql.STEPS}, {sql.HEADS}" + _LABELLED_PAGES.format(dot="__", lead="_", inner="'steps_' || s.spos"))
def q_labels_v1(spark, sf_dir):
    flat = flatten_labeled(page_docs(spark, sf_dir), OWN)
    # This style names columns with dots, which would have to be quoted wherever they are selected.
    return flat.toDF(*[name.replace(".", "__") for name in flat.columns])


_CHAINED = "'links_' || s.pos || '_steps_' || s.spos"


@query(f"WITH {sql.STEPS}, {sql.HEADS}" + _LABELLED_PAGES.format(dot="_", lead="", inner=_CHAINED))
def q_labels_v2(spark, sf_dir):
    return flatten_labeled(page_docs(spark, sf_dir), CHAIN)


@query(f"""WITH {sql.STEPS}, {sql.HEADS}
SELECT 'page_links' AS table_name, CAST(page_id AS VARCHAR) AS "root_id", href AS page_links_href,
       step AS page_links_steps, 'links_' || pos || '_steps_' || spos AS page_links_steps_index,
       'links_' || pos AS page_links_index, CAST(NULL AS VARCHAR) AS page_heads_title,
       CAST(NULL AS VARCHAR) AS page_heads_index FROM steps
UNION ALL SELECT 'page_links_steps', CAST(page_id AS VARCHAR), NULL, step, 'links_' || pos || '_steps_' || spos,
       NULL, NULL, NULL FROM steps
UNION ALL SELECT 'page_heads', CAST(page_id AS VARCHAR), NULL, NULL, NULL, NULL, title, 'heads_' || pos FROM heads""")
def q_labels_tables(spark, sf_dir):
    docs = page_docs(spark, sf_dir).withColumn("key", F.col("_id").getField("$oid"))
    return tables_as_one(labeled_tables(docs, key_col="key"))


@query(f"""WITH {sql.CHARGES}, {sql.MARKS}
SELECT i.l_orderkey AS _id_order, i.l_linenumber AS _id_line, i.l_partkey AS _id_part,
       strftime(i.l_shipdate, '%Y-%m-%d') AS body_shipped, c.kind AS body_charges_kind, c.rate AS body_charges_rate,
       c.l_extendedprice AS body_charges_base_price, c.l_quantity AS body_charges_base_units,
       'charges_' || c.pos AS body_charges_index, m.code AS marks_code, 'marks_' || m.pos AS marks_index
FROM items i LEFT JOIN charges c ON c.rid = i.rid LEFT JOIN marks m ON m.rid = i.rid""")
def q_sibling_product(spark, sf_dir):
    return flatten_labeled(line_docs(spark, sf_dir))


@query(CHECKS["q_sibling_product"])
def q_sibling_ranges(spark, sf_dir):
    """The same rows, those of documents with more than two spread over tasks by ranges of two."""
    stored = settle(line_docs(spark, sf_dir), "line-docs")
    return flatten_labeled(stored, rows_per_range=2)


# --- catalogue -------------------------------------------------------------------------------------

# Fields of the page documents as a JSON scan infers them: names in order, numbers as text or bigint.
_PAGE_CATALOG = [
    ("_id", "root", "struct"),
    ("_id.$oid", "_id", "string"),
    ("page", "root", "struct"),
    ("page.heads", "page", "array<struct>"),
    ("page.heads.title", "page.heads", "string"),
    ("page.links", "page", "array<struct>"),
    ("page.links.href", "page.links", "string"),
    ("page.links.steps", "page.links", "array<string>"),
    ("page.url", "page", "string"),
]
_CATALOG_COLUMNS = [FIELD, HIERARCHY, DATA_TYPE]


def _scanned_pages(spark, sf_dir):
    """Page documents read back from JSON, their schema inferred from all of them."""
    return read_documents(spark, written_json(page_docs(spark, sf_dir), "pages"))


@query(sql.values(_CATALOG_COLUMNS, _PAGE_CATALOG))
def q_schema_catalog(spark, sf_dir):
    return schema_catalog(_scanned_pages(spark, sf_dir))


@query(sql.values(_CATALOG_COLUMNS, [row for row in _PAGE_CATALOG if row[2] == "array<struct>"]))
def q_array_paths(spark, sf_dir):
    return array_fields(schema_catalog(_scanned_pages(spark, sf_dir)))


@query(sql.values(_CATALOG_COLUMNS, [row for row in _PAGE_CATALOG if row[0] in ("page", "page.links")]))
def q_ancestors(spark, sf_dir):
    return ancestors(schema_catalog(_scanned_pages(spark, sf_dir)), "page.links")


@query(sql.values(["line_no", "line"], list(enumerate([
    "root",
    " |-- _id: struct (nullable = true)",
    " |    |-- $oid: string (nullable = true)",
    " |-- page: struct (nullable = true)",
    " |    |-- heads: array (nullable = true)",
    " |    |    |-- element: struct (containsNull = true)",
    " |    |    |    |-- title: string (nullable = true)",
    " |    |-- links: array (nullable = true)",
    " |    |    |-- element: struct (containsNull = true)",
    " |    |    |    |-- href: string (nullable = true)",
    " |    |    |    |-- steps: array (nullable = true)",
    " |    |    |    |    |-- element: string (containsNull = true)",
    " |    |-- url: string (nullable = true)",
]))))
def q_schema_tree(spark, sf_dir):
    return schema_tree_rows(_scanned_pages(spark, sf_dir))


@query("""SELECT page_id, field AS "Field",
       CASE WHEN contains(field, '.') THEN array_to_string(string_split(field, '.')[1:-2], '.') ELSE 'root' END AS "Hierarchy"
FROM (SELECT page_id, string_split(url, '/')[-1] AS field FROM pages
      UNION ALL SELECT page_id, string_split(url, '/')[3] FROM pages)""")
def q_hierarchy(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    host = F.get(F.split("url", "/"), F.lit(2))
    fields = pages.select("page_id", base_name(F.col("url")).alias(FIELD)).unionByName(pages.select("page_id", host.alias(FIELD)))
    return fields.withColumn(HIERARCHY, parent_path(F.col(FIELD), TOP_LEVEL))


# --- null handling, predicates, formats ------------------------------------------------------------


@query(f"""WITH {sql.PATCHY}
SELECT c_custkey, c_nationkey, nullif(segment, '') AS segment, nullif(balance, '') AS balance,
       nullif(nation_text, '') AS nation_text, nullif(price_text, '') AS price_text, nullif(nothing, '') AS nothing
FROM patchy""")
def q_empty_to_null(spark, sf_dir):
    return empty_to_null(patchy_customers(spark, sf_dir))


@query(f"""WITH {sql.PATCHY}
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       coalesce(segment, 'NULL') AS segment, balance, nation_text, price_text, coalesce(nothing, 'NULL') AS nothing
FROM patchy""")
def q_null_marker(spark, sf_dir):
    return mark_nulls(patchy_customers(spark, sf_dir))


@query(f"WITH {sql.PATCHY} SELECT c_custkey, coalesce(segment, 'Unknown') AS segment, coalesce(nothing, 'N/A') AS nothing FROM patchy")
def q_defaults(spark, sf_dir):
    customers = patchy_customers(spark, sf_dir)
    return customers.select(
        "c_custkey", with_default(F.col("segment"), "Unknown").alias("segment"), with_default(F.col("nothing")).alias("nothing")
    )


@query(f"""WITH {sql.PATCHY}
SELECT c_custkey, balance IS NULL AS is_null, balance = '' AS is_empty, balance IS NOT NULL AND balance <> '' AS is_filled,
       regexp_matches(nation_text, '^[0-9]+$') AS is_integer, regexp_matches(balance, '^[0-9]+(\\.[0-9]+)?$') AS is_decimal,
       regexp_matches(segment, '^[0-9]+$') OR regexp_matches(segment, '^[0-9]+(\\.[0-9]+)?$')
         OR segment IS NOT NULL AS is_present
FROM patchy""")
def q_predicates(spark, sf_dir):
    balance, nation, segment = F.col("balance"), F.col("nation_text"), F.col("segment")
    return patchy_customers(spark, sf_dir).select(
        "c_custkey", balance.isNull().alias("is_null"), is_empty_text(balance).alias("is_empty"),
        is_filled_text(balance).alias("is_filled"), is_integer_text(nation).alias("is_integer"),
        is_decimal_text(balance).alias("is_decimal"),
        is_numeric_or_present(segment).alias("is_present"),
    )


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS listed, strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
       CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END AS iso FROM events""")
def q_format_ts(spark, sf_dir):
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select("event_id", listing_time(ts).alias("listed"), iso_time(ts).alias("iso"))


# --- profile ---------------------------------------------------------------------------------------


@query(sql.profile_sql("lineitem", sql.TABLE_COLUMNS["lineitem"], "lineitem"))
def q_profile(spark, sf_dir):
    return profile_columns(table(spark, sf_dir, "lineitem"), "lineitem")


@query(CHECKS["q_profile"])
def q_profile_merged(spark, sf_dir):
    """The profile of order lines that came in four deliveries, each counted once; the last is delivered twice."""
    lines, target = table(spark, sf_dir, "lineitem"), scratch_path(spark, "profile-state")
    for part in (0, 1, 2, 3, 3):
        add_delivery({"lineitem": lines.where(f"l_orderkey % 4 = {part}")}, target, f"d{part}")
    return grown_profile(spark, target)


@query(" UNION ALL ".join(
    "SELECT * FROM (" + sql.profile_sql("patchy", sql.PATCHY_COLUMNS, name, strict, f"WITH {sql.PATCHY} ") + ")"
    for name, strict in (("strict", True), ("loose", False))
))
def q_profile_class(spark, sf_dir):
    customers = patchy_customers(spark, sf_dir)
    return profile_columns(customers, "strict").unionByName(profile_columns(customers, "loose", strict=False))


@query(" UNION ALL ".join(f"SELECT * FROM ({sql.profile_sql(t, c, t)})" for t, c in sql.TABLE_COLUMNS.items()))
def q_profile_many(spark, sf_dir):
    return profile_tables({name: table(spark, sf_dir, name) for name in sql.TABLE_COLUMNS})


_COUNT_NAMES = ("null_count", "empty_count", "integer_count", "decimal_count", "string_count")
_LISTS = ("integer", "decimal", "string", "null")


def _all_tables(spark, sf_dir):
    return {name: table(spark, sf_dir, name) for name in sql.TABLE_COLUMNS}


def _read_reports(reports):
    """The values of report texts: names, classes, all counts and the number of schema fields."""
    names, counts = "array<string>", ", ".join(f"{c}: bigint" for c in _COUNT_NAMES)
    layout = (
        f"DataFrame_name string, column_names {names}, {', '.join(f'{c}_columns {names}' for c in _LISTS)}, "
        f"schema struct<fields: array<struct<name: string>>>, column_frequencies map<string, struct<{counts}>>"
    )
    read = reports.select(F.from_json("report", layout).alias("r")).select("r.*")
    listed = [F.array_join(c, ",").alias(c) for c in ("column_names", *(f"{c}_columns" for c in _LISTS))]

    def counted(count):
        values = F.transform("column_names", lambda name: F.element_at(F.col("column_frequencies"), name)[count].cast("string"))
        return F.array_join(values, ",").alias(f"{count}s")

    return read.select("DataFrame_name", *listed, *map(counted, _COUNT_NAMES), F.size("schema.fields").cast("bigint").alias("schema_fields"))


_PROFILE_CHECK = "WITH profiles AS (" + " UNION ALL ".join(
    f"SELECT * FROM ({sql.profile_sql(t, c, t)})" for t, c in sql.TABLE_COLUMNS.items()
) + """)
SELECT "DataFrame_name", string_agg(column_name, ',' ORDER BY ordinal) AS column_names,
""" + "".join(
    f"coalesce(string_agg(column_name, ',' ORDER BY ordinal) FILTER (WHERE column_class = '{c}'), '') AS {c}_columns,\n" for c in _LISTS
) + "".join(f"string_agg({c}, ',' ORDER BY ordinal) AS {c}s,\n" for c in _COUNT_NAMES) + "count(*) AS schema_fields FROM profiles GROUP BY \"DataFrame_name\""


@query(_PROFILE_CHECK)
def q_profile_json(spark, sf_dir):
    return _read_reports(profile_reports(_all_tables(spark, sf_dir)))


@query(_PROFILE_CHECK)
def q_profile_file(spark, sf_dir):
    """The report file: one JSON list of all tables' reports."""
    path = scratch_path(spark, "profile")
    write_profile(_all_tables(spark, sf_dir), path)
    listed = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("report"))
    return _read_reports(listed)


# --- drift -----------------------------------------------------------------------------------------


@query(sql.values([*_CATALOG_COLUMNS, CATALOG_FILE], [(*row, "pages.csv") for row in _PAGE_CATALOG] + [
    ("embedding", "root", "array<double>", "vectors.csv"), ("_id", "root", "bigint", "vectors.csv"),
    ("label", "root", "bigint", "vectors.csv"),
]))
def q_catalog_merge(spark, sf_dir):
    folder = scratch_path(spark, "catalogs")
    write_catalog(_scanned_pages(spark, sf_dir), f"{folder}/pages.csv")
    write_catalog(read_documents(spark, written_json(vector_docs(spark, sf_dir), "vectors")), f"{folder}/vectors.csv")
    return read_catalogs(spark, folder)


@query(f"""WITH {sql.CATALOG}
SELECT field AS "Field", dtype AS "Data Type", file AS filename, count(*) AS entries FROM catalog
WHERE field IN (SELECT field FROM catalog GROUP BY field HAVING count(DISTINCT dtype) > 1)
GROUP BY field, dtype, file""")
def q_type_conflicts(spark, sf_dir):
    # The lists are opened again, so that the check does not depend on how they were cut into rows.
    named = type_conflicts(event_entries(spark, sf_dir)).withColumn(CATALOG_FILE, F.explode(CATALOG_FILE))
    return named.groupBy(FIELD, DATA_TYPE, CATALOG_FILE).agg(F.count("*").alias("entries"))


@query(f"""WITH {sql.CATALOG}
SELECT field AS "Field", dtype AS "Data Type", 0 AS part, string_agg(DISTINCT file, ', ' ORDER BY file) AS filename FROM catalog
WHERE field IN (SELECT field FROM catalog GROUP BY field HAVING count(DISTINCT dtype) > 1)
GROUP BY field, dtype""")
def q_type_conflicts_report(spark, sf_dir):
    once = event_entries(spark, sf_dir).drop(ENTRIES)
    return as_delimited_report(type_conflicts(once))


@query(f"""WITH {sql.CATALOG}
SELECT field AS "Field", dtype AS "Data Type", file AS filename FROM grid
WHERE field IN (SELECT field FROM grid GROUP BY field HAVING count(DISTINCT dtype) > 1)""")
def q_type_conflicts_missing(spark, sf_dir):
    """Conflicts by groups of alike files; one join with the groups' members names every file."""
    conflicts, members = group_conflicts(event_entries(spark, sf_dir))
    return conflicts.join(members, "file_group").select(FIELD, DATA_TYPE, CATALOG_FILE)


@query(CHECKS["q_type_conflicts_missing"])
def q_absence_bitmap(spark, sf_dir):
    """The same conflicts from one bit per file and type, opened again to name every file."""
    bitmaps, places = absence_bitmaps(event_entries(spark, sf_dir), files_per_shelf=16)
    return opened_absences(bitmaps, places)


@query(f"""WITH {sql.CATALOG}
SELECT field AS "Field", dtype AS "Data Type", '0' AS part, string_agg(file, ', ' ORDER BY file) AS filename FROM grid
WHERE field IN (SELECT field FROM grid GROUP BY field HAVING count(DISTINCT dtype) > 1)
GROUP BY field, dtype""")
def q_drift_report_file(spark, sf_dir):
    """The report with every file named, written as a delimited file and read back."""
    path = scratch_path(spark, "drift-report")
    write_drift_report(type_conflicts_with_absence(event_entries(spark, sf_dir)), path)
    return read_delimited(spark, path)


_FILES = [f"file_{i:02d}" for i in range(CATALOG_FILES)]


@query(f"""WITH {sql.CATALOG}
SELECT field AS "Field", """ + ", ".join(f"coalesce(max(dtype) FILTER (WHERE file = '{f}'), 'Data Type Not Present') AS {f}" for f in _FILES)
       + " FROM grid GROUP BY field")
def q_pivot_types(spark, sf_dir):
    return pivot_types(event_entries(spark, sf_dir), _FILES)


@query(f"""WITH {sql.CATALOG} SELECT field AS "Field", file AS filename, dtype AS "Data Type" FROM grid""")
def q_melt_types(spark, sf_dir):
    """Wide to long over a given list of files; over files not listed beforehand the same rows come from ``types_by_file``."""
    entries = event_entries(spark, sf_dir)
    long = melt_types(pivot_types(entries, _FILES))
    return long.join(entries.select(CATALOG_FILE).distinct(), CATALOG_FILE, "left_semi")


@query(CHECKS["q_melt_types"])
def q_types_by_file(spark, sf_dir):
    return types_by_file(event_entries(spark, sf_dir))


# --- loading ---------------------------------------------------------------------------------------


@query(f"""WITH {sql.PATCHY}
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, nullif(segment, '') AS segment,
       nullif(balance, '') AS balance, nullif(nation_text, '') AS nation_text, nullif(price_text, '') AS price_text,
       nullif(nothing, '') AS nothing
FROM patchy""")
def q_csv_load(spark, sf_dir):
    return _loaded(patchy_customers(spark, sf_dir), "customers")


def _loaded(rows, stem):
    """Rows written as a delimited table, loaded into the catalogue, and read from there; the catalogue's entry goes again."""
    spark, name = rows.sparkSession, f"{stem}_{uuid.uuid4().hex[:12]}"
    folder, warehouse = scratch_path(spark, "delimited"), scratch_path(spark, "warehouse")
    write_delimited(rows, f"{folder}/{name}.csv")
    load_folder(spark, folder, location=warehouse)
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    return spark.read.schema(schema).parquet(f"{warehouse}/{name}")


@query("""SELECT 'document' AS kind, CAST(doc_id AS VARCHAR) AS id, nullif(text, '') AS body, nullif(lang, '') AS lang, nullif(source, '') AS source,
       CAST(n_chars AS VARCHAR) AS n_chars, NULL AS url FROM documents
UNION ALL SELECT 'page', CAST(page_id AS VARCHAR), nullif(html, ''), NULL, NULL, NULL, nullif(url, '') FROM pages""")
def q_csv_text_load(spark, sf_dir):
    """Whole rows with line breaks, quotes and separators through delimited files into a table."""
    documents = table(spark, sf_dir, "documents").withColumnsRenamed({"doc_id": "id", "text": "body"}).withColumn("kind", F.lit("document"))
    pages = table(spark, sf_dir, "pages").withColumnsRenamed({"page_id": "id", "html": "body"}).withColumn("kind", F.lit("page"))
    return _loaded(union_by_name([documents, pages]), "texts").select("kind", "id", "body", "lang", "source", "n_chars", "url")


@query("SELECT CASE WHEN o_orderkey % 3 = 2 THEN nullif(o_orderstatus, '') END AS note FROM orders")
def q_one_column_load(spark, sf_dir):
    """A table of one column keeps its null and empty rows."""
    key = F.col("o_orderkey") % 3
    return _loaded(table(spark, sf_dir, "orders").select(F.when(key == 1, "").when(key == 2, F.col("o_orderstatus")).alias("note")), "notes")


@query(f"""WITH {sql.PATCHY}
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, coalesce(segment, 'NULL') AS segment,
       coalesce(balance, 'NULL') AS balance, coalesce(nation_text, 'NULL') AS nation_text, coalesce(price_text, 'NULL') AS price_text,
       coalesce(nothing, 'NULL') AS nothing FROM patchy""")
def q_marked_file(spark, sf_dir):
    """Nulls as a marker in a file; empty text shows as nothing, and is made empty text again after reading."""
    path = scratch_path(spark, "marked")
    write_marked(patchy_customers(spark, sf_dir), path)
    return read_delimited(spark, path).na.fill("")


@query("""SELECT table_name, row_count FROM (
SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'small', count(*) FROM orders WHERE o_totalprice < 20000
UNION ALL SELECT 'none', count(*) FROM orders WHERE o_totalprice < 0) WHERE row_count > 0""")
def q_skip_empty(spark, sf_dir):
    """Tables without rows are not written."""
    orders, folder = table(spark, sf_dir, "orders"), scratch_path(spark, "order-tables")
    tables = {"orders": orders, "small": orders.where("o_totalprice < 20000"), "none": orders.where("o_totalprice < 0")}
    written = write_tables(tables, folder, "parquet", skip_empty=True)
    return row_counts({name: spark.read.parquet(f"{folder}/{name}.parquet") for name in written})


@query("SELECT vec_id AS root_id, CAST(UNNEST(range(len(embedding))) AS INTEGER) AS embedding_pos, UNNEST(embedding) AS embedding FROM embeddings")
def q_primitive_table(spark, sf_dir):
    """A table of its own for an array of plain values."""
    return child_tables(vector_docs(spark, sf_dir), primitive_arrays=True)["embedding"]


@query("SELECT 'customers.csv' AS filename, CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer "
       "UNION ALL SELECT 'all suppliers+.csv', CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR) FROM supplier")
def q_delimited_by_name(spark, sf_dir):
    """Two tables in many part files, their columns in different orders and far to the right, as one by name."""
    folder = scratch_path(spark, "by-name")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), *[F.lit("x").alias(f"filler_{i}") for i in range(80)], F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")
    )
    write_delimited(customers.repartition(3), f"{folder}/customers.csv")
    write_delimited(suppliers.repartition(2), f"{folder}/deep/all suppliers+.csv")
    return read_delimited_by_name(spark, folder, ["id", "name", "nation"])


@query(_PAGE_TABLES.format(origin=""))
def q_stream_ingest(spark, sf_dir):
    docs = page_docs(spark, sf_dir)
    source = written_json(docs, "stream-source")
    target, checkpoint = scratch_path(spark, "stream-tables"), scratch_path(spark, "stream-checkpoint")
    for _ in range(2):  # the second run finds nothing new
        ingest_documents(spark, source, docs.schema, target, checkpoint, "pages").awaitTermination()
    names = ("pages_main", "page_links", "page_heads")
    return tables_as_one({name: ingested_table(spark, target, name) for name in names})


@query("""WITH d AS (SELECT DISTINCT event_id % 8 AS k FROM events),
e AS (
  SELECT k, UNNEST(list_concat([['event_id', 'root', 'bigint']],
    CASE k % 3 WHEN 0 THEN [['value', 'root', 'double']] WHEN 1 THEN [['value', 'root', 'string']]
      ELSE [['value', 'root', 'struct'], ['value.amount', 'value', 'double'], ['value.unit', 'value', 'string'],
            ['tags', 'root', 'array<struct>'], ['tags.n', 'tags', 'bigint'], ['tags.name', 'tags', 'string']] END,
    CASE WHEN k % 2 = 0 THEN [['props', 'root', 'struct'], ['props.k', 'props', 'bigint']] ELSE [] END)) AS f FROM d
)
SELECT f[1] AS "Field", f[2] AS "Hierarchy", f[3] AS "Data Type", 'delivery_' || k AS filename FROM e""")
def q_file_catalogs(spark, sf_dir):
    """Events delivered in eight shapes as raw JSON files; the catalogues of all deliveries from one pass."""
    return file_catalogs(spark, _deliveries(spark, sf_dir), F.concat(F.lit("delivery_"), F.regexp_extract("path", "delivery=([0-9]+)", 1)))


def _deliveries(spark, sf_dir):
    k = F.col("event_id") % 8
    plain = F.to_json(F.struct("event_id", "value"))
    text = F.to_json(F.struct("event_id", F.col("value").cast("string").alias("value")))
    value = F.struct(F.col("value").alias("amount"), F.col("event_type").alias("unit"))
    tags = F.array(F.struct(F.col("event_type").alias("name"), F.col("user_id").alias("n")))
    nested = F.to_json(F.struct("event_id", value.alias("value"), tags.alias("tags")))
    line = F.when(k % 3 == 0, plain).when(k % 3 == 1, text).otherwise(nested)
    with_props = F.concat(F.left(line, F.length(line) - 1), F.lit(',"props":'), F.col("props"), F.lit("}"))
    path = scratch_path(spark, "deliveries")
    lines = table(spark, sf_dir, "events").select(k.alias("delivery"), F.when(k % 2 == 0, with_props).otherwise(line).alias("value"))
    lines.write.partitionBy("delivery").text(path)
    return path


@query("""SELECT event_id, CASE WHEN event_id % 3 <> 2 THEN value END AS value_number, CASE WHEN event_id % 3 = 2 THEN 'v' || event_id END AS value_text,
       CASE WHEN event_id % 3 = 1 THEN user_id END AS user_id, event_type, CASE WHEN event_id % 3 = 1 THEN event_id END AS extra FROM events""")
def q_schema_merge(spark, sf_dir):
    """Events whose later deliveries add fields and change a type: the schema grows by what was rescued, which is then read again."""
    k, value = F.col("event_id") % 3, F.col("value")
    first = F.to_json(F.struct("event_id", value, F.struct("event_type").alias("kind")))
    more = F.to_json(F.struct("event_id", value, "user_id", F.struct("event_type", F.array("event_id").alias("extra")).alias("kind")))
    other = F.to_json(F.struct("event_id", F.concat(F.lit("v"), "event_id").alias("value"), F.struct("event_type").alias("kind")))
    path = scratch_path(spark, "growing-events")
    table(spark, sf_dir, "events").select(F.when(k == 0, first).when(k == 1, more).otherwise(other).alias("value")).write.text(path)
    known = T.StructType.fromDDL("event_id bigint, value double, kind struct<event_type: string>")
    read = settle(read_documents(spark, path, known, rescued_col="rescued"), "first-reading")
    kept = read.where("rescued IS NOT NULL").select("rescued")
    wide = widened_schema(known, kept, "rescued")
    # Texts that the widened schema did not hold would be rescued again, and missing here.
    again = replayed(kept, "rescued", wide, "rescued").where("rescued IS NULL").drop("rescued")
    docs = conformed(read.where("rescued IS NULL").drop("rescued"), wide).unionByName(again)
    is_text = F.startswith("value", F.lit("v"))
    return docs.select(
        "event_id", F.when(~is_text, F.col("value").cast("double")).alias("value_number"), F.when(is_text, F.col("value")).alias("value_text"),
        "user_id", F.col("kind.event_type").alias("event_type"), F.get("kind.extra", F.lit(0)).alias("extra"),
    )


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, nullif(o_orderstatus, '') AS o_orderstatus, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CASE WHEN o_orderkey % 3 < 2 THEN 'first' ELSE 'second' END AS load_id FROM orders""")
def q_incremental_load(spark, sf_dir):
    """Orders in two deliveries: each load takes in the files that no load before it had, whatever the order of their columns."""
    folder, target = scratch_path(spark, "deliveries"), scratch_path(spark, "loaded")
    orders = table(spark, sf_dir, "orders")
    write_delimited(orders.where("o_orderkey % 3 < 2").select("o_orderkey", "o_orderstatus", "o_custkey"), f"{folder}/orders.csv")
    load_new_files(spark, folder, target, "first")
    write_delimited(orders.where("o_orderkey % 3 = 2").select("o_custkey", "o_orderkey", "o_orderstatus"), f"{folder}/late/orders.csv")
    for load_id in ("second", "third"):  # the third finds nothing new
        load_new_files(spark, folder, target, load_id)
    return loaded_table(spark, target, "orders", with_load=True)


@query("""SELECT 'customers' AS kind, CAST(c_custkey AS VARCHAR) AS id, nullif(c_name, '') AS name FROM customer
UNION ALL SELECT 'suppliers', CAST(s_suppkey AS VARCHAR), nullif(s_name, '') FROM supplier""")
def q_repeatable_load(spark, sf_dir):
    """The same load run twice: the second run replaces the rows of the first."""
    folder, target = scratch_path(spark, "delivery"), scratch_path(spark, "loaded")
    write_delimited(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), f"{folder}/customers.csv")
    write_delimited(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), f"{folder}/suppliers.csv")
    for _ in range(2):
        load_new_files(spark, folder, target, "only")
    customers, suppliers = (loaded_table(spark, target, name).withColumn("kind", F.lit(name)) for name in ("customers", "suppliers"))
    return customers.unionByName(suppliers)
