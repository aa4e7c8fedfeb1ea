"""Comparison SQL of what can be said of the results of trained models."""

from checks.predictions import ORACLES as _PREDICTIONS
from checks.sql import statement

ORACLES: dict[str, str] = {}


def add(name: str, body: str, deps: str = "") -> None:
    ORACLES[f"{name}_facts"] = statement(deps, body)


def _all(source: str) -> str:
    """All rows are there once, and valid."""
    return f"SELECT count(*) AS n_rows, count(*) AS n_keys, count(*) AS n_valid FROM ({source})"


_SONGS = "SELECT DISTINCT l_partkey FROM lineitem JOIN part ON p_partkey = l_partkey"
_USERS = "SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate IS NOT NULL"
for _model in ("lr", "rf", "gbt"):
    add(f"ml_hot_{_model}", _all(_SONGS))
    add(f"ml_churn_{_model}", _all(_USERS))
add("gd_hot_top10", _all(f"{_SONGS} LIMIT 10"))
add("gd_hot_predict20", _all(f"{_SONGS} LIMIT 20"))
add("gd_churn_high10", "SELECT 0 AS n_rows, 0 AS n_keys, 0 AS n_valid FROM (SELECT count(*) FROM orders)")
for _name in ("fd_model_metrics", "gd_model_metrics", "gd_churn_metrics"):
    add(_name, _all("SELECT * FROM range(3)"))
add("ml_cv5", _all("SELECT * FROM range(6)"))
add(
    "fd_churn_metrics",
    f"""SELECT count(*) FILTER (WHERE label = 1) AS support_pos, count(*) FILTER (WHERE label = 0) AS support_neg, 3 AS n_rows, 3 AS n_keys, 3 AS n_valid
FROM ({_PREDICTIONS["ml_churn_frame"]}) WHERE fold = -1""",
)
for _name in ("ml_feature_importance", "ml_permutation_importance", "ml_tree_attribution", "ml_linear_attribution"):
    add(_name, _all("SELECT * FROM range(21)"))
add("fd_feature_top8", _all("SELECT * FROM range(8)"))
add("gd_feature_top15", _all("SELECT * FROM range(15)"))
add("bd_rfm_kmeans", _all("SELECT DISTINCT o_custkey FROM orders"))
add("bd_user_kmeans", _all("SELECT DISTINCT user_id FROM comment_raw"), "comment_raw")
for _name in ("tx_lda", "gd_topics", "fd_topics"):
    add(_name, _all("SELECT * FROM range(5)"))
add("tx_topic_assign", "SELECT source, count(*) AS documents FROM documents GROUP BY source")
add("gd_topic_dist_lda", "SELECT count(*) AS documents, 0 AS odd_names FROM documents")
add("tx_sentiment_model", _all("SELECT doc_id FROM documents"))
add(
    "sq5_artist_matrix_approx",
    """SELECT artist_name, count(DISTINCT comment_id) AS comment_count, count(DISTINCT user_id) AS user_count, 1 AS near
FROM comment_lengths JOIN song USING (song_id) GROUP BY artist_name""",
    "comment_lengths song",
)
