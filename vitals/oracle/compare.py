"""Order-insensitive comparison of a Spark result with an oracle result.

Rows are compared as multisets after sorting columns by name; floats are
rounded to 5 decimals, timestamps to seconds; list values become tuples.
"""

from __future__ import annotations

import math

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


SPARK_FAMILY = {"integer": "int", "long": "bigint", "short": "int", "byte": "int", "double": "double",
                "float": "double", "string": "varchar", "date": "date", "timestamp_ntz": "timestamp",
                "timestamp": "timestamp", "boolean": "boolean", "decimal": "decimal", "array": "list"}
DUCK_FAMILY = {"INTEGER": "int", "BIGINT": "bigint", "SMALLINT": "int", "HUGEINT": "hugeint", "DOUBLE": "double",
               "FLOAT": "double", "VARCHAR": "varchar", "DATE": "date", "TIMESTAMP": "timestamp",
               "BOOLEAN": "boolean", "DECIMAL": "decimal"}


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 5)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19].replace("T", " ")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return round(float(v), 5)
    except Exception:
        pass
    if isinstance(v, bool):
        return int(v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))




def duck_with_views(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(df, con, sql: str) -> list[str]:
    """Problems found (empty list = match)."""
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    problems = []
    if sorted(scols) != sorted(ocols):
        problems.append(f"cols spark={sorted(scols)} oracle={sorted(ocols)}")
    if len(srows) != len(orows):
        problems.append(f"rows spark={len(srows)} oracle={len(orows)}")
    if not problems:
        a, b = rows_of(scols, srows), rows_of(ocols, orows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ e.g. {diff}")
    return problems
