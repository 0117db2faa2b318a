"""Compare registered queries with their SQL on DuckDB: python tests/oracle.py [sf_dir] [names…]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return f"{value:.6g}"
    return value


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_cell(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(v)) for v in row))


FAMILY = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double",
          "BOOLEAN": "boolean", "HUGEINT": "hugeint"}


def compare(spark, con, sf_dir: str, name: str, fn, sql: str) -> list[str]:
    """Differences between the two sides, empty when they agree."""
    df = fn(spark, sf_dir)
    got = df.collect()
    relation = con.sql(sql)
    problems = []
    ours = dict(df.dtypes)
    theirs = {c: FAMILY.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    theirs = {c: ours[c] if t == '"NULL"' or t == "NULL" else t for c, t in theirs.items() if c in ours or True}
    if sorted(ours) != sorted(theirs):
        return [f"columns {sorted(ours)} against {sorted(theirs)}"]
    kinds = {c: (ours[c], theirs[c]) for c in ours if ours[c] != theirs[c]}
    if kinds:
        problems.append(f"types {kinds}")
    left, right = normalised(df.columns, got), normalised(relation.columns, relation.fetchall())
    if len(left) != len(right):
        problems.append(f"{len(left)} rows against {len(right)}")
    if left != right:
        a, b = set(left), set(right)
        problems.append(f"only here {len(a - b)}: {str(sorted(a - b, key=str)[:2])[:600]}")
        problems.append(f"only SQL {len(b - a)}: {str(sorted(b - a, key=str)[:2])[:600]}")
    elif not left:
        problems.append("no rows on either side")
    return problems


def main() -> int:
    import logging

    import __spark_entry__ as entry
    from voxtally import build_session

    logging.disable(logging.WARNING)
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    sql = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problems = compare(spark, con, sf_dir, name, fn, sql[name]) if name in sql else [
                f"no SQL, {fn(spark, sf_dir).count()} rows"]
        except Exception as err:  # keep going: one broken query must not hide the others
            problems = [f"{type(err).__name__}: {str(err)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n     " if problems else "")
    print(failed, "of", len(wanted) or len(entry.queries()), "differ")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
