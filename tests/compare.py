"""The tables that tests read, and the order-free comparison of a Spark result with a SQL result."""

import math
from collections import Counter

SF_DIR = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value if value is None or isinstance(value, bool) else str(value)


def spark_rows(df):
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    return sorted(df.columns), Counter(tuple(plain(row[i]) for i in order) for row in df.collect())


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
