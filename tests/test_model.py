"""MLP on a planted rule (the driver data carries no signal), warm start, save/load, search."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from dockcast.operators import features as fe
from dockcast.operators import metrics as me
from dockcast.operators import model as mo
from dockcast.operators import split as sp
from dockcast.operators import training as tr
from dockcast.plans import catalog as cat


@pytest.fixture(scope="module")
def planted(spark):
    """Readings with soleil, relabelled by a planted rule: label = floor(hour / 8)."""
    rows = fe.usable(cat.stored_readings(spark, SF_CHECK))
    rows = rows.withColumn("label", F.floor(F.col("hour") / 8).cast("double"))
    train, test = sp.split_parts(rows)
    return mo.materialize(spark, train, "test-train").cache(), test.cache()


@pytest.fixture(scope="module")
def fitted(planted):
    train, _ = planted
    return mo.train(train, mo.topology("20-20"), 60, seed=7)


def test_weights_count(spark, fitted):
    assert mo.n_weights([5, 20, 20, 9]) == 729
    assert mo.weights_frame(spark, fitted.model).count() == 729


def test_planted_rule_beats_majority(planted, fitted):
    _, test = planted
    acc = me.accuracy(me.confusion_counts(mo.predict(fitted.model, test))).first().accuracy
    majority = test.groupBy("label").count().agg(F.max("count")).first()[0] / test.count()
    assert acc > majority + 0.2, (acc, majority)


def test_warm_start_resumes(planted, fitted):
    train, _ = planted
    more = mo.train(train, mo.topology("20-20"), 5, seed=7, warm=fitted.model)
    assert more.objective[0] <= fitted.objective[0]
    assert abs(more.objective[0] - fitted.objective[-1]) < 0.05


def test_save_load_same_predictions(spark, planted, fitted, workdir):
    _, test = planted
    path = mo.save(fitted.model, os.path.join(workdir, "m"))
    again = mo.load(spark, path)
    a = mo.predict(fitted.model, test).select("id", "dtUpdate", "prediction")
    b = mo.predict(again, test).select("id", "dtUpdate", "prediction")
    assert a.exceptAll(b).count() == 0


def test_unseen_station_is_scored(spark, planted, fitted):
    _, test = planted
    one = test.limit(1).withColumn("id", F.lit(987654321).cast("bigint"))
    assert mo.predict(fitted.model, one).count() == 1


def test_chunks_are_exact():
    assert mo.chunk_sizes(0) == []
    assert mo.chunk_sizes(7) == [7]
    assert mo.chunk_sizes(10_001) == [2001, 2000, 2000, 2000, 2000]
    assert sum(mo.chunk_sizes(123_457)) == 123_457


def test_stepwise_runs(planted):
    train, _ = planted
    res = mo.train_stepwise(train, mo.topology("10"), 6, seed=3)
    assert res.iterations <= 6 and len(mo.mlp_stage(res.model).weights) == mo.n_weights([5, 10, 9])


def test_search_reports_each_topology(planted):
    train, _ = planted
    best, scores = mo.search(sp.fold_column(train), ["10", "20-20"], 5, fold_col="fold")
    assert [s[0] for s in scores] == ["10", "20-20"] and all(0.0 <= s[2] <= 1.0 for s in scores)
    assert mo.mlp_stage(best).getLayers() in ([5, 10, 9], [5, 20, 20, 9])


def test_topology_validation():
    assert mo.topology("20-20") == [5, 20, 20, 9]
    with pytest.raises(ValueError):
        mo.topology("0")


def test_weights_text_round_trip(spark, fitted, workdir):
    path = mo.write_weights_text(spark, fitted.model, workdir)
    assert path.endswith("mlp-5-20-20-9-.weights")
    w = mo.read_weights_text(spark, path)
    assert w == mo.mlp_stage(fitted.model).weights.toArray().tolist()
    warm = mo.perceptron([5, 20, 20, 9], 1, initial_weights=w)
    assert list(warm.getInitialWeights().toArray()) == w


def test_retrain_on_table(spark, fitted):
    readings = cat.stored_readings(spark, SF_CHECK)
    res, held_out = mo.retrain(spark, readings, "20-20", 3, warm=fitted.model)
    assert res.layers == [5, 20, 20, 9] and held_out.count() > 0


def test_input_vector(spark):
    row = spark.createDataFrame([(7, 1, 2, 25, 1.0)], "id bigint, day int, hour int, minute int, soleil double") \
        .select(fe.input_vector().alias("v")).first()
    assert row.v.toArray().tolist() == [7.0, 1.0, 2.0, 25.0, 1.0]


def test_zero_feature_vector_stays_zero(spark):
    """L2 normalisation of an all-zero vector leaves it zero (no NaN): the station with the most
    readings (index 0) at midnight on a Sunday in cold weather."""
    rows = spark.createDataFrame([(1, 0, 0, 0, 0.0, 0, 1.0), (1, 1, 3, 5, 1.0, 1, 2.0), (2, 2, 4, 10, 0.0, 2, 3.0)],
                                 "id bigint, dtUpdate bigint, hour int, minute int, soleil double, day int, label double")
    out = {r.dtUpdate: r for r in fe.features_l2(rows).collect()}
    assert [out[0][f"f{i}"] for i in range(5)] == [0.0] * 5
    assert abs(sum(out[1][f"f{i}"] ** 2 for i in range(5)) - 1.0) < 1e-12


def test_search_query_fits_all_topologies_with_the_default_iterations(spark, monkeypatch):
    asked = []

    class Stopped(Exception):
        pass

    def run_trials(spark, rows, hidden, max_iter, folder, fold_col, folds, **_):
        asked.append((list(hidden), max_iter, folds))
        raise Stopped

    monkeypatch.setattr(cat, "_TRIALS", {})
    monkeypatch.setattr(tr, "run_trials", run_trials)
    with pytest.raises(Stopped):
        cat.q_search_topology(spark, SF_CHECK)
    assert asked == [(mo.SEARCH_HIDDEN, 100, 3)] and len(mo.SEARCH_HIDDEN) == 10


def test_round_trip_query_fits_as_the_training_query_does(spark, monkeypatch):
    asked = []

    class Stopped(Exception):
        pass

    def train(rows, layers, max_iter, **_):
        asked.append((layers, max_iter))
        raise Stopped

    monkeypatch.setattr(mo, "train", train)
    with pytest.raises(Stopped):
        cat.q_model_roundtrip(spark, SF_CHECK)
    assert asked == [([5, 20, 20, 9], 100)]
