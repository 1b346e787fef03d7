"""Runs queries beside their SQL and compares rows, as the driver does.

python tests/oracle.py SF NAME...   (all names when none is given)
"""

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, d, f, sql):
    con = duckdb.connect()
    for p in Path(d).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    want = con.execute(sql)
    want = rows_of([c[0] for c in want.description], want.fetchall())
    df = f(spark, d)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got[0] == want[0], (got[0], want[0])
    extra, lacking = got[1] - want[1], want[1] - got[1]
    assert not extra and not lacking, (sum(got[1].values()), sum(want[1].values()), list(extra)[:3], list(lacking)[:3])
    return sum(got[1].values())


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as e
    from skeinmill.session import session

    s = session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    d, sql = f"/root/testdata/{sys.argv[1]}", e.oracle_sql()
    for name, f in e.queries().items():
        if sys.argv[2:] and not any(name.startswith(a) for a in sys.argv[2:]):
            continue
        t = time.time()
        try:
            n = compare(s, d, f, sql[name]) if name in sql else f(s, d).count()
            print(f"{'ok' if name in sql else 'rows'} {name} {n} {time.time() - t:.1f}s", flush=True)
        except Exception as x:
            print(f"BAD {name}: {str(x)[:900]}", flush=True)
