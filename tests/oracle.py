"""Compare a registered query with its SQL on the same tables."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(r[i] for i in order) for r in rows], key=repr)


def compare(spark, con, name, run, sql, sf_dir):
    """(rows, list of differences)."""
    df = run(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    want = _rows(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return len(got), [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    differences = [f"rows {len(got)} != {len(want)}"] if len(got) != len(want) else []
    for g, w in zip(got, want):
        if g != w:
            cells = [f"{c}: {str(a)[:80]!r} != {str(b)[:80]!r}" for c, a, b in zip(sorted(columns), g, w) if a != b]
            differences.append("; ".join(cells))
    return len(got), differences
