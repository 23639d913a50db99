"""Metrics (A4-A7) against Spark's own evaluator, dedup survivors, sort orders, CSV export."""

import glob
import os

from pyspark.mllib.evaluation import MulticlassMetrics
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dockcast.operators import curate as cur
from dockcast.operators import lookup as lk
from dockcast.operators import metrics as me
from dockcast.operators import sinks as sk
from dockcast.operators import split as sp
from dockcast.plans import catalog as cat

PAIRS = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 4 + [(1.0, 2.0)] * 1 + [(2.0, 2.0)] * 3 \
    + [(2.0, 0.0)] * 2 + [(3.0, 3.0)] * 1 + [(3.0, 7.0)] * 2          # class 7 is only predicted


def test_metrics_match_mllib(spark):
    df = spark.createDataFrame(PAIRS, "label double, prediction double")
    counts = me.confusion_counts(df)
    per = {r.label: r for r in me.class_metrics(counts).collect()}
    m = MulticlassMetrics(df.select("prediction", "label").rdd.map(tuple))
    assert 7.0 in per and per[7.0].n_actual == 0 and per[7.0].precision == 0.0
    for c in (0.0, 1.0, 2.0, 3.0):
        assert abs(per[c].precision - m.precision(c)) < 1e-12
        assert abs(per[c].recall - m.recall(c)) < 1e-12
        assert abs(per[c].f1 - m.fMeasure(c, 1.0)) < 1e-12
        assert abs(per[c].false_positive_rate - m.falsePositiveRate(c)) < 1e-12
    acc = me.accuracy(counts).first()
    assert acc.n_rows == len(PAIRS) and abs(acc.accuracy - m.accuracy) < 1e-12
    w = me.weighted_metrics(me.class_metrics(counts)).first()
    assert abs(w.weighted_precision - m.weightedPrecision) < 1e-12
    assert abs(w.weighted_recall - m.weightedRecall) < 1e-12
    assert abs(w.weighted_f1 - m.weightedFMeasure()) < 1e-12
    assert abs(w.weighted_false_positive_rate - m.weightedFalsePositiveRate) < 1e-12


def test_confusion_matrix_form(spark):
    counts = me.confusion_counts(spark.createDataFrame(PAIRS, "label double, prediction double"))
    mat = {r.label: r for r in me.confusion_matrix(counts).collect()}
    assert mat[0.0]["0.0"] == 5 and mat[0.0]["1.0"] == 2 and mat[3.0]["7.0"] == 2 and mat[1.0]["8.0"] == 0


def _readings(spark):
    rows = [(1, 1000, 5, 5, "1 - A"), (1, 3000, 5, 5, "1 - A"), (1, 2000, 5, 5, "1 - A"),
            (2, 1000, 12, 1, "2 - B"), (2, 1000, 11, 1, "2 - B")]
    return spark.createDataFrame(rows, "id bigint, dtUpdate bigint, bikes int, places int, name string") \
        .withColumn("x", F.lit(0))


def test_latest_per_station_is_deterministic(spark):
    got = {r.id: (r.dtUpdate, r.bikes) for r in lk.latest_per_station(_readings(spark)).collect()}
    assert got == {1: (3000, 5), 2: (1000, 12)}


def test_dedup_identity_keeps_latest(spark):
    df = spark.createDataFrame(
        [(0.0, 1, 1.0, 5, 1, 8, 0.0, 100, 1, 1, "a"), (0.0, 1, 1.0, 5, 1, 8, 0.0, 200, 2, 2, "a"),
         (0.0, 1, None, 5, 1, 8, 0.0, 50, 3, 3, "a")],
        "nBike double, id bigint, soleil double, minute int, day int, hour int, nPlace double, "
        "dtUpdate bigint, bikes int, places int, name string")
    got = sorted((r.soleil, r.dtUpdate) for r in cur.dedup_identity(df).collect() if r.soleil is not None)
    assert got == [(1.0, 200)] and cur.dedup_identity(df).count() == 2


def test_natural_order_and_preview(spark):
    r = _readings(spark)
    keys = [(x.id, x.dtUpdate) for x in lk.natural_order(r).collect()]
    assert keys == sorted(keys)
    top = lk.preview(r, n=2).collect()
    assert [(x.id, x.dtUpdate) for x in top] == [(1, 1000), (1, 2000)]


def test_hash_split_is_repeatable_and_partition_free(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") * 7).alias("dtUpdate"))
    a = sp.label_parts(df).where("part = 'train'").select("id")
    b = sp.label_parts(df.repartition(13)).where("part = 'train'").select("id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    share = a.count() / 5000
    assert 0.55 < share < 0.65
    folds = {r.fold: r.n for r in sp.fold_column(df).groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert set(folds) == {0, 1, 2}


def test_export_is_ordered_by_name_then_x(spark, workdir):
    rows = [(f"n{i % 7}", (i * 37) % 101, i) for i in range(300)]
    df = spark.createDataFrame(rows, "name string, x int, v int").repartition(5)
    path = sk.export_ordered(df, os.path.join(workdir, "out"))
    lines = []
    for part in sorted(glob.glob(os.path.join(path, "part-*.csv"))):
        with open(part) as f:
            body = f.read().splitlines()
        assert body[0] == "name;x;v"
        lines += [tuple(line.split(";")) for line in body[1:]]
    keys = [(n, int(x), int(v)) for n, x, v in lines]
    assert len(keys) == 300 and keys == sorted(keys)


def test_preview_cuts_like_show(spark):
    long = "x" * 150
    df = spark.createDataFrame([(1, 1, 1, 1, long)], "id bigint, dtUpdate bigint, bikes int, places int, name string")
    got = lk.preview(df).first().name
    assert got == "x" * 97 + "..." and len(got) == 100


def test_second_part_of_a_one_to_two_split(spark):
    """R2: weights 0.3/0.6 normalise to 1/3 and 2/3; the service evaluated the second part."""
    df = spark.range(6000).select(F.col("id"), (F.col("id") * 3).alias("dtUpdate"))
    first, second = sp.split_parts(df, train_share=0.3 / 0.9)
    assert first.count() + second.count() == 6000
    assert 0.62 < second.count() / 6000 < 0.72


def test_exported_predictions_are_scored_once(spark):
    """The export's sort takes its bounds from a stored table: its plan holds no scoring."""
    seen, export = [], sk.export_ordered
    sk.export_ordered = lambda df, path: (seen.append(df._jdf.queryExecution().optimizedPlan().toString()), export(df, path))[1]
    try:
        out = cat.QUERIES["export_predictions"](spark, SF_SMALL)
    finally:
        sk.export_ordered = export
    assert "UDF" not in seen[0] and "Join" not in seen[0]
    assert out.where("valid AND likeliest AND n_probabilities = 9 AND n_raw = 9 AND n_features = 5").count() == out.count() > 0
