"""Compare queries with their SQL twins: python tests/check_catalog.py SF_DIR [name ...]"""

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark, con, query, sql, sf_dir):
    """None if the results agree, else a short reason."""
    df = query(spark, sf_dir)
    ours = df.toArrow()
    if sql is None:
        return None if ours.num_rows else "no rows"
    theirs = con.execute(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {ours.column_names} / {theirs.column_names}"
    names = sorted(ours.column_names)
    types = {n: (str(ours.schema.field(n).type), str(theirs.schema.field(n).type)) for n in names}
    wrong = {n: t for n, t in types.items() if t[0].replace("large_", "") != t[1].replace("large_", "")}
    if ours.num_rows != theirs.num_rows:
        return f"{ours.num_rows} rows / {theirs.num_rows}"
    a = ordered([tuple(map(plain, r)) for r in zip(*(ours.column(n).to_pylist() for n in names))])
    b = ordered([tuple(map(plain, r)) for r in zip(*(theirs.column(n).to_pylist() for n in names))])
    different = [(x, y) for x, y in zip(a, b) if x != y]
    if different:
        return f"{len(different)} rows differ, e.g. {str(different[0])[:300]}"
    return f"types {wrong}" if wrong else None


def main():
    import __spark_entry__ as entry

    from lexiframe.session import session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = session(
        "check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="check-catalog-")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            reason = compare(spark, con, query, sql.get(name), sf_dir)
        except Exception as e:  # report and go on
            reason = f"{type(e).__name__}: {str(e)[:600]}"
        failed += reason is not None
        kind = "sql " if name in sql else "rows"
        print(f"{'FAIL' if reason else 'ok':4} {kind} {time.time() - start:6.1f}s {name} {reason or ''}", flush=True)
    print("failed:", failed)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
