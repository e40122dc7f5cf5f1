"""Run every registered query beside its SQL twin: python tests/check_queries.py [sf_dir] [name ...]"""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from oracle import connect, mismatch
from conftest import make_session

import __spark_entry__ as registry


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = make_session()
    con = connect(sf_dir)
    oracles = registry.oracle_sql()
    bad = 0
    for name, query in registry.queries().items():
        if name not in oracles or wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            problem = mismatch(query(spark, sf_dir), con, oracles[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - begin:.1f}s {problem or ''}", flush=True)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
