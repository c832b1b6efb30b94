"""SQL fragments shared by the checks: the same shapes, unnested straight from the flat tables."""

from __future__ import annotations

# The arrays of the document shapes, one row per element, position from 0.
LINES = """
lines AS (
  SELECT doc_id, UNNEST(ls) AS text, CAST(UNNEST(range(len(ls))) AS INTEGER) AS pos
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
)"""

WORDS = LINES + """,
words AS (
  SELECT doc_id, pos, UNNEST(ws) AS word, CAST(UNNEST(range(len(ws))) AS INTEGER) AS wpos
  FROM (SELECT doc_id, pos, [x FOR x IN string_split(text, ' ') IF x <> ''] AS ws FROM lines)
)"""

CHARGES = """
items AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM lineitem),
charges AS (
  SELECT rid, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, 'discount' AS kind,
         l_discount AS rate, 0 AS pos
  FROM items WHERE l_discount > 0
  UNION ALL
  SELECT rid, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, 'tax', l_tax,
         CASE WHEN l_discount > 0 THEN 1 ELSE 0 END
  FROM items WHERE l_tax > 0
)"""

MARKS = """
marks AS (
  SELECT rid, l_returnflag AS code, 0 AS pos FROM items WHERE l_returnflag <> 'N'
  UNION ALL
  SELECT rid, l_linestatus, CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END FROM items WHERE l_linestatus <> 'N'
)"""

LINKS = """
links AS (
  SELECT page_id, UNNEST(hs) AS href, CAST(UNNEST(range(len(hs))) AS INTEGER) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hs FROM pages)
)"""

HEADS = """
heads AS (
  SELECT page_id, UNNEST(hs) AS title, CAST(UNNEST(range(len(hs))) AS INTEGER) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, '<h[1-3]>([^<]*)<', 1) AS hs FROM pages)
)"""

STEPS = LINKS + """,
steps AS (
  SELECT page_id, pos, href, UNNEST(ss) AS step, CAST(UNNEST(range(len(ss))) AS INTEGER) AS spos
  FROM (SELECT page_id, pos, href, string_split(href, '/') AS ss FROM links)
)"""

# A catalogue set from the events.
CATALOG = """
catalog AS (
  SELECT event_type || '.k' || (props->>'$.k') AS field,
         CASE WHEN value < 20 THEN 'bigint' WHEN value < 80 THEN 'double' ELSE 'string' END AS dtype,
         'file_' || lpad(CAST(user_id % 40 AS VARCHAR), 2, '0') AS file
  FROM events
),
firsts AS (SELECT field, file, min(dtype) AS dtype FROM catalog GROUP BY field, file),
grid AS (
  SELECT f.field, g.file, coalesce(t.dtype, 'Data Type Not Present') AS dtype
  FROM (SELECT DISTINCT field FROM firsts) f CROSS JOIN (SELECT DISTINCT file FROM firsts) g
  LEFT JOIN firsts t ON t.field = f.field AND t.file = g.file
)"""

PATCHY = """
patchy AS (
  SELECT c_custkey, c_nationkey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS segment,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN CAST(c_acctbal AS VARCHAR) ELSE '' END AS balance,
         CASE WHEN c_nationkey < 5 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS nation_text,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN 'none' ELSE CAST(abs(c_acctbal) AS VARCHAR) END AS price_text,
         CASE WHEN c_mktsegment = 'NO SUCH SEGMENT' THEN '' END AS nothing
  FROM customer
)"""


def values(columns: list[str], rows: list[tuple]) -> str:
    """A literal relation of texts and numbers."""
    def literal(value):
        return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(f'"{c}"' for c in columns)
    return f"SELECT * FROM (VALUES {body}) AS t({names})"


# Columns of the given tables with their type text on the Spark side.
TABLE_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
PATCHY_COLUMNS = (
    "c_custkey bigint, c_nationkey int, segment string, balance string, nation_text string, price_text string, nothing string"
)


def profile_sql(source: str, columns: str, name: str, strict: bool = True, head: str = "") -> str:
    """The column profile of ``source`` as one aggregate per column, unioned."""
    mixed = "" if strict else "WHEN decimal_count > 0 THEN 'mixed' "
    parts = []
    for ordinal, column in enumerate(columns.split(", ")):
        field, data_type = column.split(" ", 1)
        text = f"CAST({field} AS VARCHAR)"
        nested = data_type.startswith("array")
        integer = "FALSE" if nested else f"regexp_matches({text}, '^[0-9]+$')"
        decimal = "FALSE" if nested else f"regexp_matches({text}, '^[0-9]+(\\.[0-9]+)?$')"
        parts.append(
            f"SELECT '{name}' AS \"DataFrame_name\", {ordinal} AS ordinal, '{field}' AS column_name, "
            f"'{data_type}' AS data_type, count(*) AS total_count, count(*) - count({field}) AS null_count, "
            f"count(*) FILTER (WHERE {text} = '') AS empty_count, count(*) FILTER (WHERE {integer}) AS integer_count, "
            f"count(*) FILTER (WHERE {decimal}) AS decimal_count, "
            f"count(*) FILTER (WHERE {field} IS NOT NULL AND {text} <> '') AS string_count FROM {source}"
        )
    union = " UNION ALL ".join(parts)
    return (
        f"{head}SELECT *, CASE WHEN null_count + empty_count = total_count THEN 'null' "
        "WHEN integer_count + null_count + empty_count = total_count THEN 'integer' "
        "WHEN decimal_count + null_count + empty_count = total_count THEN 'decimal' "
        f"{mixed}ELSE 'string' END AS column_class FROM ({union})"
    )
