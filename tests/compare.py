"""Compare a registered query with its SQL on one folder of tables."""

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted(frame):
    frame = frame[sorted(frame.columns)]
    for column in frame.columns:
        if str(frame[column].dtype).startswith("datetime"):
            frame[column] = frame[column].astype("datetime64[us]")
        elif frame[column].dtype == object or str(frame[column].dtype) in ("str", "string"):
            frame[column] = frame[column].astype(object).where(frame[column].notna(), None)
    key = frame.astype(str).agg("|".join, axis=1) if len(frame) else pd.Series(dtype=str)
    return frame.iloc[key.argsort(kind="stable")].reset_index(drop=True)


def differences(spark, con, sf_dir, query, sql):
    """None if both have the same columns, kinds of type, and rows; otherwise what differs."""
    ours, theirs = query(spark, sf_dir).toPandas(), con.execute(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    ours, theirs = _sorted(ours), _sorted(theirs)
    try:
        pd.testing.assert_frame_equal(ours, theirs, check_exact=True)
    except AssertionError as found:
        return str(found)
    return None
