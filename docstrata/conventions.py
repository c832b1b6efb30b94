"""Fixed values of the table layout.

These names and texts are part of the result contract: consumers of the produced tables match on
them, so they are stated once here and never built from anything else.
"""

# Key columns of main and child tables.
DOCUMENT_KEY = "_id"
ROOT_KEY = "root_id"
POSITION_SUFFIX = "_pos"
ORIGIN_COLUMN = "Filename"

# Names of our own: what did not fit a given schema, as a column beside the documents and in its table.
RESCUED_COLUMN = "__rescued"
RESCUED = "rescued"

# Columns and texts of a schema catalogue.
FIELD = "Field"
HIERARCHY = "Hierarchy"
DATA_TYPE = "Data Type"
CATALOG_FILE = "filename"
TOP_LEVEL = "root"
STRUCT_TEXT = "struct"
STRUCT_ARRAY_TEXT = "array<struct>"
TYPE_ABSENT = "Data Type Not Present"

# Text patterns of the column profile.
INTEGER_TEXT = r"^[0-9]+$"
DECIMAL_TEXT = r"^[0-9]+(\.[0-9]+)?$"

# Column classes of the profile.
CLASS_NULL = "null"
CLASS_INTEGER = "integer"
CLASS_DECIMAL = "decimal"
CLASS_STRING = "string"
CLASS_MIXED = "mixed"

# Export marker, timestamp text, files that are never loaded as tables.
NULL_MARKER = "NULL"
LISTING_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"
CATALOG_FILE_NAME = "schema_info.csv"
MISSING_ATTRIBUTE = "N/A"
UNKNOWN_ATTRIBUTE = "Unknown"
