"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
  {"metric": "whole_day_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Inputs (the derived fixture tables) are written once before timing.  Each
query is run once to warm up, then ``BENCH_RUNS`` times (default 5) into
the ``noop`` sink; the median is reported.  ``*_literal`` entries are the
original job's forms (eight scans, eight joins, separate quantile calls),
kept here only as the comparison the rewrites are measured against.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from pagefeatures import config as C, dates  # noqa: E402
from pagefeatures.functions.columns import composite_key, flag_in  # noqa: E402
from pagefeatures.operators import bands, enrich, features, label, pages, report  # noqa: E402
from pagefeatures.plans.daily import DayInputs, build_day, build_days, lookback_rows  # noqa: E402
from pagefeatures.session import get_session  # noqa: E402
from pagefeatures.sources import tables  # noqa: E402
from pagefeatures.sources.fixtures import TARGET_DAY, input_tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
T = TARGET_DAY
BACK = dates.lookback_days(T, C.LOOKBACK_DAYS)


def timed(build) -> float:
    """Median seconds of ``build()`` written to the noop sink."""
    def once():
        t = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t
    once()
    return statistics.median(once() for _ in range(RUNS))


def band_ratio_literal(info):
    """Eight filtered scans and aggregates, one per band (original form)."""
    e = C.BAND_EDGES
    out = None
    for b in range(1, C.N_BANDS + 1):
        s = F.col("ctr_score")
        cond = (s < e[0]) if b == 1 else (s >= e[-1]) if b == C.N_BANDS else ((s < e[b - 1]) & (s >= e[b - 2]))
        t = (info.where(cond).select(composite_key("boss_city", "boss_position").alias("cp"),
                                      flag_in("deal_type", C.CONTACT_TYPES).alias("f"))
             .groupBy("cp").agg((F.sum("f") / F.count(F.lit(1))).alias("addf_ratio"), F.count(F.lit(1)).alias("num"))
             .where(F.col("num") > C.BAND_MIN_COUNT[b - 1]).withColumn("band", F.lit(b)))
        out = t if out is None else out.unionByName(t)
    return out


def ratio_join_literal(pg, info):
    """Eight left joins, one per band table (original form)."""
    lit = band_ratio_literal(info)
    x = pg
    for b in range(1, C.N_BANDS + 1):
        x = x.join(lit.where(F.col("band") == b).select("cp", F.col("addf_ratio").alias(f"pct{b}_ratio")), "cp", "left")
    return x


def quartiles_literal(info):
    """Three separate percentile calls on the same column (original form)."""
    rows = info.where(F.col("deal_type").isin(list(C.QUARTILE_TYPES)))
    return rows.groupBy("job_id").agg(*[F.percentile_approx("ctr_score", p).alias(f"q{i}")
                                        for i, p in enumerate((0.25, 0.5, 0.75), 1)],
                                      F.count(F.lit(1)).alias("num"))


def report_literal(final):
    """Four scans, one per report column (original form)."""
    out = None
    for c in C.REPORT_COLUMNS:
        t = (final.groupBy("addf_num").agg(F.percentile_approx(c, list(C.REPORT_PROBS)).alias("q"),
                                           F.stddev_pop(c).alias("std"), F.count(F.lit(1)).alias("num"))
             .orderBy("addf_num").limit(C.REPORT_LIMIT).withColumn("feature", F.lit(c)))
        out = t if out is None else out.unionByName(t)
    return out


def main():
    # the shared folder comes from the session (spark.checkpoint.dir); only a
    # local session without one gets a private folder (see session.shared_dir)
    spark = get_session(f"local[{CPUS}]", shuffle_partitions=int(CPUS) * 2,
                        conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    tb = input_tables(spark, SF_DIR)
    inputs = DayInputs(**tb)
    days = [T] + BACK
    labelled = label.label_impressions(tables.scan_days(tb["rank_scores"], days),
                                       tables.scan_days(tb["impressions"], days))
    info = tables.materialize(spark, labelled, "bench-labelled")
    back = lookback_rows(info, [T])
    pg = pages.page_samples(tables.scan_day(info, T))
    final = tables.materialize(spark, build_day(inputs, T, info=info), "bench-final")

    q = {}
    q["label_impressions"] = timed(lambda: labelled)
    q["band_ratio"] = timed(lambda: bands.band_ratio_wide(back))
    q["band_ratio_literal"] = timed(lambda: band_ratio_literal(back))
    q["quartiles_by_job"] = timed(lambda: features.score_quartiles(back, "job"))
    q["quartiles_by_job_literal"] = timed(lambda: quartiles_literal(back))
    q["quartiles_by_cp"] = timed(lambda: features.score_quartiles(back, "cp"))
    q["page_samples"] = timed(lambda: pg)
    q["ratio_join"] = timed(lambda: enrich.join_ratios(pg, bands.band_ratio_wide(back)))
    q["ratio_join_literal"] = timed(lambda: ratio_join_literal(pg, back))
    q["final_rows"] = timed(lambda: build_day(inputs, T, info=info))
    q["threshold_report"] = timed(lambda: report.threshold_report(final))
    q["threshold_report_literal"] = timed(lambda: report_literal(final))
    q["whole_day"] = timed(lambda: build_day(inputs, T))
    q["backfill_4_days"] = timed(lambda: build_days(inputs, [T] + BACK))

    rows = tb["rank_scores"].count()
    print(json.dumps({"metric": "whole_day_sec", "value": round(q["whole_day"], 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in q.items()},
                      "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
                      "impressions": rows, "cpus": int(CPUS), "runs": RUNS}))
    spark.stop()


if __name__ == "__main__":
    main()
