"""Lines of layered tables that need nothing of each other."""

import threading

from refrain.operators import keywords, models
from refrain.plans import layers, learning
from refrain.plans.warehouse import Warehouse
from refrain.session import scratch_path


def test_lines_are_written_side_by_side(spark, monkeypatch):
    met = threading.Barrier(2, timeout=20)

    def waits(frame):
        def build(w):
            met.wait()  # broken if one table is only built after the other was written
            return frame(w)

        return build

    tables = {
        "ads_comment_topic": ("ads", waits(lambda w: w.song.limit(3)), None),
        "dwd_user_info": ("dwd", waits(lambda w: w.user.limit(2)), None),
    }
    monkeypatch.setattr(layers, "LAYERS", tables)
    target = scratch_path(spark, "layers")
    layers.write_layers(Warehouse(spark, "/root/testdata/sf0.001"), target)
    assert [layers.read_layer(spark, target, name).count() for name in tables] == [3, 2]


def test_every_line_names_tables_of_the_layers():
    assert set(layers._LINES) < set(layers.LAYERS)


def test_words_of_topics_are_found_once(spark, monkeypatch):
    built = []
    table = models.topic_table
    monkeypatch.setattr(models, "topic_table", lambda topics: built.append(1) or table(topics))
    monkeypatch.setattr(learning, "_kept", {})
    w = Warehouse(spark, "/root/testdata/sf0.001")
    assert learning.topics_page(w).count() == 5
    assert learning.topic_counts_dense(w).groupBy("topic_id").count().count() == 5
    assert len(built) == 1


def test_keywords_of_the_corpus_come_from_the_counts_by_source(spark, monkeypatch):
    rows = [(1, "s", "guitar and drum, drum"), (2, None, "guitar solo"), (3, "t", "drum 好听的"), (4, "t", None)]
    documents = spark.createDataFrame(rows, "doc_id long, source string, text string")
    want = sorted(map(tuple, keywords.corpus_keywords(documents).collect()))
    counts = keywords.group_counts(documents, ["source"]).localCheckpoint()
    assert sorted(map(tuple, keywords.group_keywords(documents, "source", counts=counts).collect())) == sorted(map(tuple, keywords.group_keywords(documents, "source").collect()))
    monkeypatch.setattr(keywords, "group_counts", None)  # the texts are not unfolded again
    assert sorted(map(tuple, keywords.corpus_keywords(documents, counts=counts).collect())) == want
