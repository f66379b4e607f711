"""Check the catalogue against the second engine: python tests/run_catalog.py [sf] [name-prefix ...]"""

import sys
import time

sys.path[:0] = ["/root/repo", "/root/repo/tests"]

import importlib  # noqa: E402

from compare import compare, duck  # noqa: E402

from kithscope.session import local_session  # noqa: E402


def main():
    sf, prefixes = sys.argv[1], sys.argv[2:]
    sf_dir = f"/root/testdata/{sf}"
    entry = importlib.import_module("__spark_entry__")
    builders, sqls = entry.queries(), entry.oracle_sql()
    spark = local_session("8", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name, build in builders.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            if name in sqls:
                n = compare(df, con, sqls[name])
                kind = "equal"
            else:
                n, kind = len(df.collect()), "rows"
            print(f"{name:32s} {kind} {n:7d} {time.time() - start:6.1f}s", flush=True)
        except Exception as error:  # report and go on
            bad += 1
            print(f"{name:32s} FAILED {type(error).__name__}: {str(error)[:700]}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
