"""Command line: python tests/parity.py <folder> [query ...] prints disagreeing queries and times."""

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from compare import connect, differences  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from millrace.session import build_session  # noqa: E402


def main(directory: str, names: list[str]) -> int:
    spark = build_session("parity", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                  "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, statements, bad = connect(directory), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, directory)
            if name in statements:
                problem = differences(df, con, statements[name])
                note = f"{df.count()} rows"
            else:
                problem, note = "", f"{df.count()} rows, no statement"
        except Exception:
            problem, note = traceback.format_exc(limit=-2)[-1800:], ""
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {note}\n{problem}".rstrip(), flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
