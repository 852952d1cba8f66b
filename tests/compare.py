"""Run registered queries and their SQL side by side: compare.py [sf_dir] [name ...]"""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values comparable as text, rows in order."""
    out = pd.DataFrame(index=frame.index)
    for name in sorted(frame.columns):
        col = frame[name]
        if pd.api.types.is_datetime64_any_dtype(col):
            out[name] = col.dt.strftime("%Y-%m-%d %H:%M:%S.%f").astype(object)
        elif pd.api.types.is_float_dtype(col):
            out[name] = [None if pd.isna(v) else repr(float(v) + 0.0) for v in col]
        else:
            out[name] = [None if v is None or v is pd.NaT else str(v) for v in col]
    out = out.astype(object).where(out.notna(), "null")
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def numbers_as_floats(frame: pd.DataFrame, like: pd.DataFrame) -> pd.DataFrame:
    """Integers that a null turned to floats on one side are made so on the other."""
    for name in frame.columns:
        if name in like.columns and pd.api.types.is_float_dtype(like[name]):
            if pd.api.types.is_integer_dtype(frame[name]) or frame[name].dtype == object:
                frame[name] = pd.to_numeric(frame[name]).astype(float)
    return frame


def differences(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} / {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} / {len(sql_rows)} rows"
    ours = canonical(numbers_as_floats(spark_rows, sql_rows))
    theirs = canonical(numbers_as_floats(sql_rows, spark_rows))
    unequal = (ours != theirs).any(axis=1)
    if unequal.any():
        at = unequal.idxmax()
        return f"{unequal.sum()} rows differ, first {ours.loc[at].to_dict()} / {theirs.loc[at].to_dict()}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from snapflow.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark = local_session("8")
    db = connect(sf_dir)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            frame = queries()[name](spark, sf_dir)
            rows = frame.toPandas()
            took = time.time() - start
            if name not in oracle_sql():
                verdict = f"rows only ({len(rows)})"
            else:
                found = differences(rows, db.execute(oracle_sql()[name]).df())
                failed += found is not None
                verdict = found or f"equal ({len(rows)} rows)"
        except Exception as error:  # report each query, then go on
            took = time.time() - start
            failed += 1
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:26s} {took:6.2f}s {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
