"""Compare registered queries with their check SQL the way the driver does."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    out = {}
    for c in df.columns:
        out[c] = [None if (x is None or x is pd.NaT or (isinstance(x, float) and x != x)) else x for x in df[c].astype(object)]
    out = pd.DataFrame(out, dtype=object)
    text = out.map(lambda x: "~" if x is None else f"{x:.6f}" if isinstance(x, float) else str(x))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def kinds(df: pd.DataFrame) -> dict[str, str]:
    return {c: df[c].dtype.kind for c in sorted(df.columns)}


def compare(spark_df: pd.DataFrame, duck_df: pd.DataFrame) -> str | None:
    if sorted(spark_df.columns) != sorted(duck_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(duck_df.columns)}"
    if len(spark_df) != len(duck_df):
        return f"rows {len(spark_df)} vs {len(duck_df)}"
    a, b = canon(spark_df), canon(duck_df)
    if len(a):
        ka, kb = kinds(spark_df), kinds(duck_df)
        bad = {c: (ka[c], kb[c]) for c in ka if ka[c] != kb[c] and not ({ka[c], kb[c]} <= {"O", "T", "U"})}
        if bad:
            return f"types {bad}"
    diff = a.ne(b)
    if diff.any(axis=None):
        rows = diff.any(axis=1)
        return f"{int(rows.sum())} of {len(a)} rows differ in {list(diff.columns[diff.any()])}\n{a[rows].head(4).to_string()}\n{b[rows].head(4).to_string()}"
    return None


def main(prefixes: list[str], sf_dir: str = "/root/testdata/sf0.01") -> int:
    from sensorqc import catalog
    from sensorqc.session import build_session

    catalog.load()
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf_dir)
    bad = 0
    for name in sorted(catalog.QUERIES):
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            got = catalog.QUERIES[name](spark, sf_dir).toPandas()
            t1 = time.time()
            if name not in catalog.ORACLES:
                print(f"rows {name:34s} {len(got):8d} {t1 - t0:6.2f}s", flush=True)
                continue
            want = con.execute(catalog.ORACLES[name]).df()
            problem = compare(got, want)
            note = "" if len(got) else "  EMPTY"
            print(f"{'ok  ' if problem is None else 'FAIL'} {name:34s} {len(got):8d} {t1 - t0:6.2f}s {time.time() - t1:6.2f}s{note}", flush=True)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
            print(f"FAIL {name}", flush=True)
        if problem:
            bad += 1
            print("   ", problem, flush=True)
    print("failures", bad)
    return bad


if __name__ == "__main__":
    sys.path.insert(0, ".")
    sys.exit(1 if main(sys.argv[1:]) else 0)
