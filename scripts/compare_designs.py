"""

1. dominant direction: ordered-set ``mode`` vs per-direction counts;
2. the three message roll-ups (symbol-hour, market-hour, symbol-day):
   three direct aggregations over messages vs one scan into mergeable
   partials (checkpointed) re-aggregated three times.

    python scripts/compare_designs.py [sf_dir] [runs]

Prints one JSON line (median seconds per variant, one warm-up).
"""

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from sentimart.operators import rollups as G  # noqa: E402
from sentimart.plans.inputs import staged  # noqa: E402
from sentimart.session import build_session  # noqa: E402


def timed(fn, runs):
    fn()
    out = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        out.append(time.perf_counter() - t0)
    return round(statistics.median(out), 3)


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.ui.showConsoleProgress": "false",
                                 "spark.checkpoint.dir": tempfile.mkdtemp(prefix="sentimart-cmp-")})
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    res = {}
    res["tick_rollup_counts"] = timed(lambda: noop(G.tick_rollup(staged(spark, sf_dir).prices, "hour", "counts")), runs)
    res["tick_rollup_mode"] = timed(lambda: noop(G.tick_rollup(staged(spark, sf_dir).prices, "hour", "mode")), runs)

    def three_scans():
        s = staged(spark, sf_dir).sentiment
        w = F.col("combined_sentiment_score") * F.col("influence_score")
        for keys in (["symbol", "sentiment_date", "sentiment_hour"], ["sentiment_date", "sentiment_hour"],
                     ["symbol", "sentiment_date"]):
            noop(s.groupBy(*keys).agg(F.count(F.lit(1)), F.avg("combined_sentiment_score"),
                                      F.avg("influence_score"), F.sum(w), F.sum("influence_score"),
                                      F.max("user_followers"),
                                      F.count_if(F.col("final_sentiment") == "bullish")))

    def one_scan():
        p = G.message_partials(staged(spark, sf_dir).sentiment).checkpoint(eager=True)
        noop(G.symbol_sentiment(p))
        noop(G.social_rollup(p))
        noop(G.leaderboard_rollup(p))

    res["message_rollups_three_scans"] = timed(three_scans, runs)
    res["message_rollups_one_scan_partials"] = timed(one_scan, runs)
    spark.stop()
    print(json.dumps({"sf_dir": sf_dir, "runs": runs, "median_sec": res}))


if __name__ == "__main__":
    main()
