"""Order-insensitive comparison of a Spark result with an oracle result."""

from __future__ import annotations

import math

import pandas as pd


def canon(v):
    if v is None:
        return "NULL"
    try:
        if pd.isna(v):
            return "NULL"
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v == int(v) and abs(v) < 2 ** 53:
            return str(int(v))
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def table(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(canon(x) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None))


def assert_same(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame, name: str = ""):
    sc, sr = table(spark_pdf)
    oc, orr = table(oracle_pdf)
    assert sc == oc, f"{name}: columns {sc} != {oc}"
    assert len(sr) == len(orr), f"{name}: rows {len(sr)} != {len(orr)}"
    bad = [(a, b) for a, b in zip(sr, orr) if a != b][:3]
    assert not bad, f"{name}: first differences {bad}"
