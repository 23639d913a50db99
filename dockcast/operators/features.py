"""Feature pipeline (M1-M5), fitted once and reused for scoring.

M1 index of ``id`` (by frequency; ties by the id's text) as a table joined to the rows, so that the
number of stations is not bounded by the driver's memory; M2 ``VectorAssembler``, M3 ``Normalizer``
(L2). M4 is the unused alternative (other column order, L1).
"""

from __future__ import annotations

from pyspark.ml.feature import Normalizer, OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.operators.rank import global_rank

# Fixed column orders of the two feature vectors.
FEATURE_COLUMNS = ["hour", "minute", "id_index", "soleil", "day"]   # M2 (used)
L1_COLUMNS = ["id", "day", "hour", "soleil", "minute"]               # M4 (alternative)
N_FEATURES = len(FEATURE_COLUMNS)


# The service's display vector of a reading (fixed order).
INPUT_VECTOR_COLUMNS = ["id", "day", "hour", "minute", "soleil"]


def input_vector(prefix: str = "") -> "F.Column":
    """Dense vector [id, day, hour, minute, soleil] of a row."""
    return array_to_vector(F.array(*[F.col(prefix + c).cast("double") for c in INPUT_VECTOR_COLUMNS]))


def usable(readings: DataFrame) -> DataFrame:
    """Rows the model can use: a reading without weather (``soleil`` NULL) is left out (Q13)."""
    return readings.where(F.col("soleil").isNotNull())


def id_index_table(rows: DataFrame) -> DataFrame:
    """(id, n, id_index), ids ranked by frequency, ties by the id's text. Counting combines
    map-side; the rank is a range-partitioned sort with offsets (``global_rank``)."""
    counts = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    ranked = global_rank(counts, [F.desc("n"), F.asc(F.col("id").cast("string"))], "id_index")
    return ranked.select("id", "n", F.col("id_index").cast("double").alias("id_index"))


def grow_index(index: DataFrame, rows: DataFrame) -> DataFrame:
    """M1 over time: (id, id_index), the rows of ``index`` as they are and the ids of ``rows`` that it lacks ranked after them, by
    frequency and text as ever. Ids are counted before they meet the index, so the join is as small as the stations."""
    counts = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).join(index.select("id"), "id", "left_anti")
    ranked = global_rank(counts, [F.desc("n"), F.asc(F.col("id").cast("string"))], "_rank")
    first = index.agg(F.coalesce(F.max("id_index") + 1, F.lit(0.0)).alias("n")).first().n
    return index.select("id", "id_index").unionByName(ranked.select("id", (F.col("_rank") + F.lit(first)).cast("double").alias("id_index")))


def with_index(rows: DataFrame, index: DataFrame, unseen: float) -> DataFrame:
    """Rows with the ``id_index`` of a fitted index (fitted once, Q14); an unseen id gets the extra
    index. AQE broadcasts the index if its measured size allows, else both sides are shuffled."""
    return (rows.join(index.select("id", "id_index"), "id", "left")
            .withColumn("id_index", F.coalesce("id_index", F.lit(float(unseen)))))


STATION_COLUMNS = ["hour", "minute", "station", "soleil", "day"]     # M2 with the station as a vector of its own


def station_stages(n_stations: int, normalize: bool = True) -> list:
    """M2 (+ M3) with the station one-hot (sparse) in the place of its index: a net can then learn each station apart, while a
    rank by frequency puts unrelated stations side by side. The encoder's size comes from the index, with a slot more for
    unseen stations, so nothing is fitted on the rows. The first layer of a net has ``station_width`` inputs."""
    spark = SparkSession.getActiveSession()
    sizes = spark.createDataFrame([(float(n_stations),)], "id_index DOUBLE")          # one row: the greatest index
    encoder = OneHotEncoder(inputCols=["id_index"], outputCols=["station"], dropLast=False).fit(sizes)
    out = "tempFeatures" if normalize else "features"
    stages = [encoder, VectorAssembler(inputCols=STATION_COLUMNS, outputCol=out, handleInvalid="skip")]
    return stages + ([Normalizer(inputCol="tempFeatures", outputCol="features", p=2.0)] if normalize else [])


def station_width(n_stations: int) -> int:
    """Length of the assembled vector: four scalars, a slot for each station and one for unseen ones."""
    return len(STATION_COLUMNS) - 1 + n_stations + 1


def features_station(rows: DataFrame, index: DataFrame, unseen: float) -> DataFrame:
    """(id, dtUpdate, label, size, positions): the positions of the assembled vector that are not zero, as text."""
    out = with_index(rows, index, unseen)
    for stage in station_stages(int(unseen), normalize=False):
        out = stage.transform(out)
    v = F.unwrap_udt("features")
    held = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))     # a dense vector names no positions
    there = F.filter(F.arrays_zip(held.alias("at"), v["values"].alias("x")), lambda p: p["x"] != 0)
    return out.select("id", "dtUpdate", "label", F.coalesce(v["size"], F.size(v["values"])).alias("size"),
                      F.array_join(F.transform(there, lambda p: p["at"].cast("string")), ",").alias("positions"))


def feature_stages(normalize: bool = True, p: float = 2.0) -> list:
    """M2 (+ M3): stages producing ``features`` from rows with an index; nothing in them is fitted."""
    out = "tempFeatures" if normalize else "features"
    stages = [VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol=out, handleInvalid="skip")]
    if normalize:
        stages.append(Normalizer(inputCol="tempFeatures", outputCol="features", p=p))
    return stages


def features_as_columns(df: DataFrame, vec: str = "features", prefix: str = "f") -> DataFrame:
    """Vector -> one double column per element (vectors cannot go to CSV or SQL)."""
    arr = vector_to_array(F.col(vec))
    n = N_FEATURES
    return df.select(*[c for c in df.columns if c != vec], *[arr[i].alias(f"{prefix}{i}") for i in range(n)])


def features_l2(rows: DataFrame) -> DataFrame:
    """M1-M3 (M5) applied to ``rows`` (the index is theirs)."""
    out = with_index(rows, id_index_table(rows), 0.0)
    for stage in feature_stages():
        out = stage.transform(out)
    return features_as_columns(out.select("id", "dtUpdate", "label", "id_index", "features"))


def features_l1(rows: DataFrame) -> DataFrame:
    """M4: assemble [id, day, hour, soleil, minute], L1-normalise."""
    asm = VectorAssembler(inputCols=L1_COLUMNS, outputCol="tempFeatures", handleInvalid="skip")
    norm = Normalizer(inputCol="tempFeatures", outputCol="features", p=1.0)
    out = norm.transform(asm.transform(rows)).select("id", "dtUpdate", "label", "features")
    return features_as_columns(out, prefix="g")
