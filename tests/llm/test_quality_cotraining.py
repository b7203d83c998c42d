"""Co-training: held-out accuracy, exchange of pseudo-labels, edge cases."""

import numpy as np

from gridmart.llm import quality_cotraining as Q

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    # Documents whose id is divisible by three are never seen with a label.
    model = Q.fit(docs, labels.where("doc_id % 3 <> 0"))
    got = {r.doc_id: r.kept for r in Q.score(docs, model).collect()}
    held = [(r.doc_id, r.quality) for r in labels.where("doc_id % 3 = 0").collect()]
    right = [got[d] == bool(q) for d, q in held]
    assert len(got) == docs.count() and sum(right) / len(right) > 0.97
    assert all(got[d] for d, q in held if q == 1)


def test_views_hand_confident_labels_to_each_other():
    r = np.random.default_rng(0)
    n = 600
    truth = r.random(n) < 0.5
    xt = np.where(truth, 1.0, -1.0)[:, None] + 0.3 * r.standard_normal((n, 3))
    xm = np.where(truth, 1.0, -1.0)[:, None] + 0.3 * r.standard_normal((n, 2))
    y = np.where(np.arange(n) < 300, truth, -1).astype(int)
    model = Q.co_train(xt, xm, y, np.arange(n) % 4 == 0)
    assert all(a > 100 and b > 100 for a, b in model.handed_over) and len(model.handed_over) == Q.ROUNDS
    text, meta, both = model.scores(xt, xm)
    assert ((both >= 0.5) == truth).mean() >= max(((text >= 0.5) == truth).mean(), 0.99)
    assert ((meta >= 0.5) == truth).mean() > 0.98


def rows(spark):
    base = [(1, "fine words " * 50, "en", "a", 550), (2, None, None, None, None), (3, "", "en", "a", 0),
            (1, "fine words " * 50, "en", "a", 550), (None, "x" * 300000, "de", None, -5), (5, "one", "fr", "b", 3)]
    return spark.createDataFrame([(*r, "clash") for r in base], SCHEMA)


def test_edge_rows_without_labels_are_kept_unchanged(spark):
    docs = rows(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    model = Q.fit(docs, labels)
    assert model.text is None
    assert Q.score(docs, model).count() == 6 and Q.score(docs, model).where("kept").count() == 6
    kept = Q.keep_good(docs, model)
    assert kept.schema == docs.schema and kept.count() == 6


def test_conflicting_labels_count_as_bad_and_empty_tables_work(spark):
    docs = rows(spark)
    empty = docs.limit(0)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    model = Q.fit(docs, labels)
    assert model.prior < 0  # doc 1 is bad (twice in the table)
    assert Q.score(empty, Q.fit(empty, labels)).collect() == []


def test_labels_of_bad_documents_alone_reject_nothing(spark):
    docs = rows(spark)
    model = Q.fit(docs, spark.createDataFrame([(1, 0, 0), (3, 0, 0), (5, 0, 0)], "doc_id long, quality int, toxic int"))
    assert model.text is None and model.prior < 0
    assert Q.keep_good(docs, model).count() == 6 and Q.score(docs, model).where("kept AND score < 0.5").count() == 6


def test_a_repeated_key_gives_the_fit_one_row(spark, monkeypatch):
    hot = [(1, f"text {i}", "en", "a", i) for i in range(300)] + [(2, "same", "en", "a", 4)] * 300
    rest = [(k, f"doc {k}", "de", "b", k) for k in range(3, 23)] + [(None, "n", None, None, None)] * 5
    docs = spark.createDataFrame([(*r, "clash") for r in hot + rest], SCHEMA).repartition(7)
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    seen = []
    plain = Q.co_train
    monkeypatch.setattr(Q, "co_train", lambda xt, xm, y, *a: seen.append((xt.tobytes(), sorted(y))) or plain(xt, xm, y, *a))
    for d in (docs, docs.repartition(3)):
        Q.fit(d, labels)
    assert seen[0] == seen[1] and seen[0][1] == [-1] * 21 + [0, 1]


def test_trained_model_scores_edge_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = Q.fit(docs, labels)
    got = Q.score(rows(spark), model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert got[0].score == got[3].score
