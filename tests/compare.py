"""Run queries next to their SQL twins and compare all values.

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def database(folder):
    base = duckdb.connect()
    for name in TABLES:
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return base


def plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(plain(row[i]) for i in order)) for row in rows)


TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp", "VARCHAR[]": "array<string>",
}


def compare(base, frame, sql):
    """Text describing the first difference, or None."""
    got = frame.collect()
    cursor = base.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in cursor.description}
    want = cursor.fetchall()
    have_types = dict(frame.dtypes)
    if sorted(have_types) != sorted(types):
        return f"columns {sorted(have_types)} and {sorted(types)}", len(got)
    odd = {c: (have_types[c], types[c]) for c in types if have_types[c] != types[c]}
    if odd:
        return f"types {odd}", len(got)
    _, left = rows_of(frame.columns, got)
    _, right = rows_of(names, want)
    if left != right:
        only_left = [r for r in left if r not in set(right)][:3]
        only_right = [r for r in right if r not in set(left)][:3]
        return f"{len(left)} and {len(right)} rows; only Spark {only_left}; only SQL {only_right}", len(got)
    return None, len(got)


def main(folder, names):
    from garimpo.queries import REGISTRY
    from garimpo.session import local_session

    spark = local_session(8, "16g")
    spark.sparkContext.setLogLevel("ERROR")
    base = database(folder)
    bad = 0
    for name, entry in REGISTRY.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if entry.sql is None:
                result, count = None, entry.run(spark, folder).count()
            else:
                frame = entry.run(spark, folder)
                result, count = compare(base, frame, entry.sql)
        except Exception as error:  # noqa: BLE001
            result, count = f"{type(error).__name__}: {str(error)[:600]}", -1
        mark = "ok  " if result is None else "DIFF"
        bad += result is not None
        kind = "" if entry.sql else " (rows only)"
        print(f"{mark} {name}{kind} rows={count} {time.time() - start:.1f}s {result or ''}", flush=True)
    print(f"{bad} differences")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
