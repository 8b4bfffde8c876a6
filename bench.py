"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local threads. Every query is
built and run in full; results go to a sink that drops them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from lakemill.registry import Tables, load, runner
from lakemill.session import build_session

HEADLINE = (
    # scans, copies and layered files
    "S01 S04 S05 S10 S15 G10 "
    # filters, joins, aggregates
    "P10 P16 P17 J01 J03 J08 J11 A04 A08 A09 A13 A15 A18 A20 "
    # windows and global order
    "W01 W04 W09 W11 W12 W14 L02 U04 U05 "
    # functions, cleaning, versions
    "F03 F12 F35 D03 D15 D19 D21 D29 V04 V06 V08 "
    # jobs
    "Q01 Q02 Q07 Q08 Q09 Q11 Q14 Q15 Q16 Q17 Q25 Q28 Q34 Q43 G02 G03 G08 "
    # streams
    "R01 R04"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    items = load()
    names = [n for n in sys.argv[1:] if n in items] or HEADLINE
    Tables(spark, folder).lineitem.groupBy("l_returnflag").count().collect()  # starts the engine

    seconds = {}
    for name in names:
        start = time.perf_counter()
        runner(items[name])(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
