"""Scale check on generated customers: features -> RFM (distributed cut-key
path) -> rule score -> metrics -> top-k, at N rows (default 10^6).

Usage: python scale_bench.py N [scratch_dir]; prints one JSON line.
The generated table is written once as Parquet to the scratch folder.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    n = int(float(sys.argv[1])) if len(sys.argv) > 1 else 1_000_000
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="attrition-scale-")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    from pyspark.sql import functions as F

    from attrition.operators import features as fe
    from attrition.operators import metrics as me
    from attrition.operators import profile as pr
    from attrition.operators import rfm, scoring
    from attrition.session import local_session
    from attrition.sources import samples

    spark = local_session(cpus, shuffle_partitions=64)
    path = f"{scratch}/customers_{n}"
    t = {}
    t0 = time.perf_counter()
    samples.sample_customers(spark, n).write.mode("overwrite").parquet(path)
    t["generate"] = time.perf_counter() - t0
    base = spark.read.parquet(path)

    t0 = time.perf_counter()
    feats = rfm.rfm_features(fe.ratio_features(base), method="cuts")
    scored = scoring.decide(scoring.rule_score(feats, fit_on=base))
    scored.write.format("noop").mode("overwrite").save()
    t["features_rfm_cuts_score"] = time.perf_counter() - t0

    t0 = time.perf_counter()
    me.class_metrics(scored.select(F.col("churned").alias("actual"),
                                   F.col("churn_predicted").alias("predicted"))).collect()
    t["class_metrics"] = time.perf_counter() - t0

    t0 = time.perf_counter()
    scoring.top_k(scored, "churn_probability", 10).collect()
    t["top10"] = time.perf_counter() - t0

    t0 = time.perf_counter()
    pr.describe(base, ["recency_days", "frequency", "monetary_value"], method="cuts").collect()
    t["describe_exact_cuts"] = time.perf_counter() - t0

    out = {k: round(v, 2) for k, v in t.items()}
    print(json.dumps({"rows": n, "cpus": cpus, "sec": out,
                      "rows_per_sec_features": round(n / t["features_rfm_cuts_score"])}))
    spark.stop()


if __name__ == "__main__":
    main()
