"""Specifications for the marts derived from the order tables."""
from __future__ import annotations

from scorewatch.spec import (Attribution, Baseline, Bucket, DriftSpec, Enrichment, Limit, Metric,
                             Monitoring, SampleRules, Segment, Share, Source, TableSpec, Thresholds)

CHANNELS = ("F", "O", "P")
FEATURES = ("quantity", "discount", "tax", "lines", "balance")
KEYS = ("creditaccountid", "customerid")
BUSINESS = ("source", "line", "saleamount", "salecount", "mob_pti", "endingreceivable")

# Monthly report
REPORT_BASELINE = ("1995-01", "1996-12")
RUN_MONTH, RUN_VERSION = "2001-05", "v1.0"
WATCHED_SOURCE = "1-URGENT"

SOURCE = Source(keys=KEYS, month="month", score="risk_score", channel="channel", channels=CHANNELS,
                features=FEATURES, business=BUSINESS)

BANDS = {"Low": (1, 2, 3), "Medium": (4, 5, 6, 7), "High": (8, 9, 10)}

ENRICHMENT = Enrichment(
    dynamic_partition=("month", "channel"),
    bands=BANDS,
    buckets=(
        Bucket("receivable_bucket", "endingreceivable", (0, 500, 1000, 2500, 5000),
               ("0 or less", "0-500", "500-1K", "1K-2.5K", "2.5K-5K", "5K+")),
        Bucket("saleamount_bucket", "saleamount", (50000, 100000, 200000, 400000),
               ("0-50K", "50K-100K", "100K-200K", "200K-400K", "400K+")),
        Bucket("salecount_bucket", "salecount", (1, 3, 5), ("0-1", "2-3", "4-5", "6+")),
        Bucket("mob_pti_bucket", "mob_pti", (2, 4, 6), ("0-2", "3-4", "5-6", "7+")),
    ),
    flags={
        "dq_missing_flag": "CASE WHEN risk_score IS NULL THEN 1 ELSE 0 END",
        "dq_outlier_flag": "CASE WHEN risk_score < 0 OR risk_score > 1 THEN 1 ELSE 0 END",
    },
)

STANDARD_METRICS = (
    Metric("count", "account_count"),
    Metric("avg", "avg_risk_score", "risk_score"),
    Metric("sum", "sum_risk_score", "risk_score"),
    Metric("sum", "total_endingreceivable", "endingreceivable"),
    Metric("avg", "avg_endingreceivable", "endingreceivable"),
    Metric("sum", "total_saleamount", "saleamount"),
    Metric("avg", "avg_saleamount", "saleamount"),
    Metric("sum", "total_salecount", "salecount"),
    Metric("avg", "avg_salecount", "salecount"),
)


def _by(name: str, *extra: str) -> TableSpec:
    return TableSpec(name, ("vintage_month", "channel", *extra), STANDARD_METRICS)


TABLES = (
    _by("overall_summary"),
    TableSpec("score_distribution", ("vintage_month", "channel", "risk_decile_dyn"),
              STANDARD_METRICS[:3],
              (Share("pct_of_channel_vintage_accounts", "account_count",
                     ("vintage_month", "channel")),)),
    _by("by_source", "source"),
    _by("by_line", "line"),
    _by("by_receivable_bucket", "receivable_bucket"),
    _by("by_saleamount_bucket", "saleamount_bucket"),
    _by("by_salecount_bucket", "salecount_bucket"),
    _by("by_mob_pti_bucket", "mob_pti_bucket"),
)

DRIFT = DriftSpec(segments=(Segment("source", "source"), Segment("line", "line"),
                            Segment("receivable_bucket", "receivable_bucket"),
                            Segment("saleamount_bucket", "saleamount_bucket")))

# Running-month monitoring
THRESHOLDS = Thresholds(
    default={"psi": Limit(0.10, 0.25), "ks_drop": Limit(-0.03, -0.07),
             "calibration_gap": Limit(0.02, 0.05), "edr_delta": Limit(0.01, 0.03),
             "missing_rate": Limit(0.01, 0.05), "feature_psi": Limit(0.10, 0.25)},
    model={"psi": Limit(0.08, 0.20)},
    scorecard={"SC001": {"psi": Limit(0.12, 0.30)}},
)

MONITORING = Monitoring(
    source=Source(keys=KEYS, month="score_month", score="risk_score", channel="channel",
                  channels=CHANNELS, features=FEATURES),
    thresholds=THRESHOLDS,
    baseline=Baseline("fixed_window", "1996-01", "1996-12"),
    sample=SampleRules(min_accounts_ks=100, min_bads_ks=10, min_accounts_bin=50),
    scorecard="scorecard_id",
    attribution=Attribution(),
)
