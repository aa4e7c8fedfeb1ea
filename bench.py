"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Every query runs twice from the files; the second run is reported, the first one compiles its
code. Nothing is cached in between. The total of the first runs is given as ``first_total``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from refrain.plans.catalog import REGISTRY  # noqa: E402
from refrain.session import local_session  # noqa: E402

HEADLINE = [
    "sq1_daily_heat_rank",
    "sq2_rfm_segments",
    "sq3_weekly_growth",
    "sq4_interaction_funnel",
    "sq5_artist_matrix",
    "fd_top_artists",
    "gd_heatmap",
    "gd_song_list",
    "gd_top_comments10",
    "gd_sentiment_weekly",
    "gd_sentiment_shift",
    "gd_value_hist",
    "bd_song_rank",
    "bd_user_portrait",
    "bd_cohort",
    "bd_song_features",
    "bd_hot_label",
    "clean_spam_regex",
    "dedup_exact",
    "dedup_simhash",
    "tx_tfidf_song",
    "tx_tfidf_global",
    "tx_sentiment_lexicon",
    "st_mannwhitney",
    "st_kruskal",
    "ab_test",
    "ml_auc",
    "ml_bootstrap_ci",
    "ml_forecast",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus=cpus, partitions=cpus)

    def run(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name](spark, root).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    first = {name: run(name) for name in HEADLINE}
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(root).name,
                "first_total": round(sum(first.values()), 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
