"""Compare every registered query with its DuckDB twin (like the driver's gate).

usage: [GLEAN_CONF='{"conf": "value"}'] python tools/oracle_check.py [sf_dir] [name ...]
Prints one line per query: status, rows spark/duck, seconds.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, bool):
        return bool(v)
    return v


def digest(rows):
    keys = sorted(repr(r) for r in rows)
    return hashlib.md5("\n".join(keys).encode()).hexdigest(), keys


def main():
    import duckdb

    from glean.plans.registry import ORACLES, QUERIES, load_all
    from glean.plans.tables import TABLES
    from glean.session import get_local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    load_all()
    extra = json.loads(os.environ.get("GLEAN_CONF", "{}"))   # e.g. '{"spark.sql.adaptive.enabled": "false"}'
    spark = get_local_session("oracle-check", shuffle_partitions=int(extra.pop("spark.sql.shuffle.partitions", 0)) or None,
                        extra=extra)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name in names or sorted(QUERIES):
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf_dir)
            cols = sorted(sdf.columns)
            srows = [tuple(norm(r[c]) for c in cols) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"SPARK-ERROR {name}: {str(e)[:600]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ORACLES:
            print(f"rows-only  {name:32s} spark={len(srows)} {ts:.1f}s")
            continue
        try:
            rel = con.sql(ORACLES[name])
            dcols = rel.columns
            data = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"DUCK-ERROR {name}: {str(e)[:600]}")
            bad += 1
            continue
        idx = {c: i for i, c in enumerate(dcols)}
        if sorted(dcols) != cols:
            print(f"COLS-DIFF  {name}: spark={cols} duck={sorted(dcols)}")
            bad += 1
            continue
        tmap = {"string": "VARCHAR", "bigint": "BIGINT", "boolean": "BOOLEAN"}
        stypes = {f.name: tmap.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
        dtypes = {c: str(t) for c, t in zip(dcols, rel.types)}
        tdiff = {c: (stypes[c], dtypes[c]) for c in cols if stypes[c] != dtypes[c]}
        if tdiff:
            print(f"TYPE-DIFF  {name}: {tdiff}")
        drows = [tuple(norm(r[idx[c]]) for c in cols) for r in data]
        hs, ks = digest(srows)
        hd, kd = digest(drows)
        ok = hs == hd
        print(f"{'OK' if ok else 'MISMATCH':10s} {name:32s} spark={len(srows)} duck={len(drows)} {ts:.1f}s")
        if not ok:
            bad += 1
            only_s = sorted(set(ks) - set(kd))[:3]
            only_d = sorted(set(kd) - set(ks))[:3]
            for r in only_s:
                print("   spark-only:", r[:400])
            for r in only_d:
                print("   duck-only: ", r[:400])
    print(f"done, {bad} problems")


if __name__ == "__main__":
    main()
