"""Multilayer perceptron: train (M6), warm start (M6b), stepwise (M6c), topology search (M7),
scoring (M8, M8b), evaluation (M9), topology (M10), weights (M11), save/load (K4, S8).

Design decisions against the source (SURVEY 2.13): a model is fitted on training rows only and
scored with the saved fitted pipeline (Q1, Q2, Q14); ``max_iter`` is honoured (Q3); splits are
seeded hash splits (Q16); stepwise training runs exactly the requested iterations (Q17).

Scale: the fit is Spark ML's L-BFGS, one distributed gradient pass (treeAggregate) per iteration.
The training rows are first written to the shared scratch folder, so an iteration never re-runs
the curation plan and a lost executor only re-reads parquet.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.functions.bins import N_CLASSES, label_text
from dockcast.functions.text import topology_list
from dockcast.operators.features import N_FEATURES, feature_stages, grow_index, id_index_table, station_stages, station_width, with_index
from dockcast.operators.sinks import persist_training
from dockcast.session import scratch_path, write_table

# Fixed values of the service.
BLOCK_SIZE = 512
DEFAULT_SEED = 1234
DEFAULT_MAX_ITER = 100          # /setmodele
STEP_CHUNKS_ABOVE = 10_000      # iterations above this are run in 5 chunks
STEP_CHUNKS = 5
# Hidden layers of the topology search (input 5 and output 9 are added around them).
SEARCH_HIDDEN = ["20-20", "50-50", "100-100", "300-300", "50-50-50", "10-10-10-10", "20-20-20-20",
                 "60", "500", "5000"]


def topology(hidden: str) -> list[int]:
    """``5-<hidden>-9``; hidden layers from text like ``20-20``."""
    layers = [N_FEATURES, *topology_list(hidden), N_CLASSES]
    if any(n <= 0 for n in layers):
        raise ValueError(f"bad topology {layers}")
    return layers


def n_weights(layers: list[int]) -> int:
    """Size of the weight vector: sum of (l_i + 1) * l_{i+1}."""
    return sum((a + 1) * b for a, b in zip(layers, layers[1:]))


def perceptron(layers: list[int], max_iter: int = DEFAULT_MAX_ITER, seed: int = DEFAULT_SEED,
               initial_weights=None) -> MultilayerPerceptronClassifier:
    """M6: label ``label``, features ``features``, block size 512, L-BFGS."""
    mlp = MultilayerPerceptronClassifier(labelCol="label", featuresCol="features", layers=list(layers),
                                         maxIter=int(max_iter), blockSize=BLOCK_SIZE, seed=int(seed))
    if initial_weights is not None:
        mlp.setInitialWeights(Vectors.dense(list(initial_weights)))
    return mlp


def materialize(spark: SparkSession, rows: DataFrame, kind: str = "train") -> DataFrame:
    """Write the rows to the shared scratch folder and read them back (lineage cut, survives
    executor loss; never a machine-local folder)."""
    return write_table(rows, spark, f"tables/{kind}")


@dataclass
class StationModel:
    """A fitted model: the id index as a table beside the pipeline (assembler, normaliser, MLP)."""
    index: DataFrame
    unseen: float
    pipeline: PipelineModel

    @property
    def stages(self) -> list:
        return self.pipeline.stages

    def indexed(self, rows: DataFrame) -> DataFrame:
        """Rows with their ``id_index``; those that bring it (their stations were looked up before) are left as they are."""
        return rows if "id_index" in rows.columns else with_index(rows, self.index, self.unseen)

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.pipeline.transform(self.indexed(rows))


@dataclass
class TrainResult:
    model: StationModel
    layers: list[int]
    iterations: int
    objective: list[float]


def mlp_stage(model: StationModel) -> MultilayerPerceptronClassificationModel:
    return model.stages[-1]


@dataclass
class Featurizer:
    """M1-M3 ready to apply: the index and the stages without anything to fit."""
    index: DataFrame
    unseen: float
    stages: list

    def transform(self, rows: DataFrame) -> DataFrame:
        out = with_index(rows, self.index, self.unseen)
        for stage in self.stages:
            out = stage.transform(out)
        return out

    def model(self, mlp: MultilayerPerceptronClassificationModel) -> StationModel:
        return StationModel(self.index, self.unseen, PipelineModel(stages=[*self.stages, mlp]))


def featurizer(rows: DataFrame, normalize: bool = True, warm: StationModel | None = None, grow: bool = False,
               station: str = "index") -> Featurizer:
    """The index of ``rows`` (or of a warm model, whose index its weights belong to), stored once. With ``grow``, ids of
    ``rows`` that the warm index lacks are ranked after its own, which stay as they are. ``station`` is "index" (the scaled
    rank, as the service has it) or "onehot" (a slot for each station; such a model cannot grow)."""
    if station not in ("index", "onehot") or (grow and station == "onehot"):
        raise ValueError("station must be 'index', or 'onehot' without growth")
    if warm is not None and not grow:
        return Featurizer(warm.index, warm.unseen, warm.stages[:-1])
    if warm is not None:
        index = materialize(rows.sparkSession, grow_index(warm.index, rows), "id_index")
        return Featurizer(index, float(index.count()), warm.stages[:-1])
    index = materialize(rows.sparkSession, id_index_table(rows).select("id", "id_index"), "id_index")
    n = index.count()
    return Featurizer(index, float(n), feature_stages(normalize) if station == "index" else station_stages(n, normalize))


def train_station(rows: DataFrame, hidden: str, max_iter: int, seed: int = DEFAULT_SEED) -> TrainResult:
    """M6 with the station one-hot: the first layer is as wide as the assembled vector."""
    feats = featurizer(rows, station="onehot")
    layers = [station_width(int(feats.unseen)), *topology(hidden)[1:]]
    cached = persist_training(feats.transform(rows).select("label", "features"))
    try:
        return fit_featurized(perceptron(layers, max_iter, seed), cached, feats, layers)
    finally:
        cached.unpersist()


def fit_featurized(mlp: MultilayerPerceptronClassifier, cached: DataFrame, feats: Featurizer, layers: list[int]) -> TrainResult:
    m = mlp.fit(cached)
    hist = list(m.summary().objectiveHistory) if m.hasSummary else []
    return TrainResult(feats.model(m), list(layers), max(len(hist) - 1, 0), hist)


def _warm_weights(warm: StationModel | None, layers: list[int]):
    if warm is None:
        return None
    w = mlp_stage(warm).weights
    if len(w) != n_weights(layers):
        raise ValueError("warm start needs the same topology")
    return w.toArray()


def train(rows: DataFrame, layers: list[int], max_iter: int, seed: int = DEFAULT_SEED,
          warm: StationModel | None = None, normalize: bool = True) -> TrainResult:
    """M6 (+ M6b): fit index and MLP on the training rows. With ``warm`` its index is reused and the
    MLP starts from its weights (same topology required).

    The featurized rows are persisted once (MEMORY_AND_DISK): every L-BFGS iteration is a gradient
    pass over cached blocks. Lost blocks are recomputed from the written training table."""
    return train_in_chunks(rows, layers, [max_iter], seed, warm, normalize)[-1]


def train_in_chunks(rows: DataFrame, layers: list[int], chunks: list[int], seed: int = DEFAULT_SEED,
                    warm: StationModel | None = None, normalize: bool = True, grow: bool = False) -> list[TrainResult]:
    """One fit for each chunk of iterations, each starting from the weights before it, over rows
    featurized and persisted once. ``grow`` appends ids that the warm model's index lacks."""
    start = _warm_weights(warm, layers)
    feats = featurizer(rows, normalize, warm, grow)
    cached = persist_training(feats.transform(rows).select("label", "features"))
    results: list[TrainResult] = []
    try:
        for iterations in chunks:
            results.append(fit_featurized(perceptron(layers, iterations, seed, start), cached, feats, layers))
            start = _warm_weights(results[-1].model, layers)
    finally:
        cached.unpersist()
    return results


def chunk_sizes(iters: int, above: int = STEP_CHUNKS_ABOVE) -> list[int]:
    """Iterations per chunk; exactly ``iters`` in total (Q17), 5 chunks above ``above``."""
    if iters <= 0:
        return []
    n = STEP_CHUNKS if iters > above else 1
    base, extra = divmod(iters, n)
    return [base + (1 if i < extra else 0) for i in range(n)]


def train_stepwise(rows: DataFrame, layers: list[int], iters: int, seed: int = DEFAULT_SEED,
                   warm: StationModel | None = None, above: int = STEP_CHUNKS_ABOVE, grow: bool = False) -> TrainResult:
    """Chunks of iterations, each warm-started from the previous chunk's weights."""
    if iters <= 0:
        raise ValueError("iters must be positive")
    return train_in_chunks(rows, layers, chunk_sizes(iters, above), seed, warm, grow=grow)[-1]


def search(rows: DataFrame, hidden: list[str], max_iter: int, folds: int = 3, seed: int = DEFAULT_SEED,
           fold_col: str | None = None, parallelism: int = 2):
    """M7: grid over topologies, k-fold CV, F1 (the evaluator's default), best model refit on all rows.

    Features are fitted once on the training rows; CV runs the MLP only. Returns (best model,
    [(hidden, layers, avg_f1)]); the best is the first with the greatest F1.
    """
    feats = featurizer(rows)
    keep = ["label", "features"] + ([fold_col] if fold_col else [])
    data = persist_training(feats.transform(rows).select(*keep))   # folds and the final refit reuse it
    mlp = perceptron(topology(hidden[0]), max_iter, seed)
    grid = ParamGridBuilder().addGrid(mlp.layers, [topology(h) for h in hidden]).build()
    cv = CrossValidator(estimator=mlp, estimatorParamMaps=grid,
                        evaluator=MulticlassClassificationEvaluator(labelCol="label", metricName="f1"),
                        numFolds=folds, seed=seed, parallelism=parallelism)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    try:
        cvm = cv.fit(data)
    finally:
        data.unpersist()
    scores = [(h, topology(h), float(m)) for h, m in zip(hidden, cvm.avgMetrics)]
    return feats.model(cvm.bestModel), scores


def predict(model: StationModel, rows: DataFrame) -> DataFrame:
    """M8: score rows with the fitted pipeline (no refit)."""
    return model.transform(rows)


def weights_frame(spark: SparkSession, model: StationModel) -> DataFrame:
    """(idx, weight) of the MLP; its size is fixed by the topology, not by the data."""
    w = mlp_stage(model).weights.toArray().tolist()
    return spark.createDataFrame(list(enumerate(w)), "idx INT, weight DOUBLE")


def save(model: StationModel, path: str) -> str:
    """K4: Spark ML's own format (weights and layers included), the index as a table beside it."""
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    model.index.withColumn("unseen", F.lit(model.unseen)).write.mode("overwrite").parquet(f"{path}/index")
    return path


def load(spark: SparkSession, path: str) -> StationModel:
    """S8."""
    index = spark.read.parquet(f"{path}/index")
    row = index.select("unseen").first()
    return StationModel(index.select("id", "id_index"), row.unseen if row else 0.0, PipelineModel.load(f"{path}/pipeline"))


def save_classifier(mlp: MultilayerPerceptronClassifier, path: str) -> str:
    """S9's counterpart: an untrained classifier with its settings."""
    mlp.write().overwrite().save(path)
    return path


def load_classifier(path: str) -> MultilayerPerceptronClassifier:
    """An untrained classifier, ready to fit."""
    return MultilayerPerceptronClassifier.load(path)


def model_path(spark: SparkSession, layers: list[int]) -> str:
    """A new model folder named by topology under the shared scratch folder."""
    return scratch_path(spark, "models/mlp-" + "-".join(map(str, layers)))


def summary_frame(spark: SparkSession, res: TrainResult, n_rows: int | None = None) -> DataFrame:
    """One row describing a fit (driver-side scalars only)."""
    final = res.objective[-1] if res.objective else None
    return spark.createDataFrame(
        [("-".join(map(str, res.layers)), n_weights(res.layers), res.iterations, final, n_rows)],
        "layers STRING, n_weights INT, iterations INT, final_loss DOUBLE, train_rows BIGINT")


def prediction_columns(scored: DataFrame) -> DataFrame:
    """Scored rows without vector columns (CSV and SQL cannot hold vectors)."""
    return scored.drop("features", "tempFeatures", "rawPrediction", "probability", "station")


def forecast_rows(scored: DataFrame) -> DataFrame:
    """M8b's answer: each request's stations at the asked time with the predicted class, its description (C14), its probability, and
    those of all classes."""
    p = vector_to_array("probability")
    return scored.select("req_id", "id", "name", "day", "hour", "minute", "soleil", "prediction", label_text("prediction").alias("description"),
                         F.array_max(p).alias("confidence"), p.alias("probabilities"))


def weights_file_name(layers: list[int]) -> str:
    """The service's weight file name, ``mlp-<l1>-<l2>-...-.weights``."""
    return "mlp-" + "".join(f"{n}-" for n in layers) + ".weights"


def write_weights_text(spark: SparkSession, model: StationModel, folder: str) -> str:
    """K4 (text form): one line of ``w;`` items, as the service wrote them. The vector's size is
    fixed by the topology; it is written as a one-row text table."""
    m = mlp_stage(model)
    text = "".join(f"{w!r};" for w in m.weights.toArray().tolist())
    path = f"{folder.rstrip('/')}/{weights_file_name(list(m.getLayers()))}"
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.mode("errorifexists").text(path)
    return path


def read_weights_text(spark: SparkSession, path: str) -> list[float]:
    """S8 (text form): weights for a warm start (C19 parsing on Spark, one row back)."""
    from dockcast.functions.text import parse_weights
    row = spark.read.text(path).select(parse_weights("value").alias("w")).where(F.size("w") > 0).first()
    return [] if row is None else list(row["w"])


def retrain(spark: SparkSession, readings: DataFrame, hidden: str, iters: int, seed: int = DEFAULT_SEED,
            warm: StationModel | None = None) -> tuple[TrainResult, DataFrame]:
    """Retrain on the current readings table (e.g. the streaming sink), warm-started from the
    previous model when given: its index grows by the stations that have come since, so each has an index of its own and
    the old ones keep theirs. Returns the fit and the held-out rows for evaluation."""
    from dockcast.operators.features import usable
    from dockcast.operators.split import split_parts
    train_rows, test_rows = split_parts(usable(readings))
    res = train_stepwise(materialize(spark, train_rows, "retrain"), topology(hidden), iters, seed, warm=warm, grow=True)
    return res, test_rows
