"""The fare model: sampling, feature vectors, boosted trees, evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.sources.scratch import materialize

# The features, shares and seed of the fare model.
CATEGORICAL = (
    "departure_airport_fk",
    "arrival_airport_fk",
    "airline_fk",
    "aircraft_fk",
    "flight_day_of_week",
    "flight_month",
)
NUMERICAL = ("search_to_flight_days", "flight_week_of_year")
LABEL = "total_fare"
SAMPLE_FRACTION = 0.01
TRAIN_FRACTION = 0.8
SEED = 42
_BUCKETS = 1 << 32


def hash_fraction(columns: Sequence[str], seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the row's values and the seed only."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / _BUCKETS


def sample_rows(
    df: DataFrame,
    fraction: float = SAMPLE_FRACTION,
    seed: int = SEED,
    identity: Sequence[str] | None = None,
) -> DataFrame:
    """A sample without replacement.

    By default each row of a stored table is drawn by itself. With ``identity``,
    columns that identify a row, the draw does not depend on how the table is cut
    into files and tasks; copies of a row are then drawn together.
    """
    if identity is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.where(hash_fraction(identity, seed) < fraction)


def split_rows(
    df: DataFrame,
    train: float = TRAIN_FRACTION,
    seed: int = SEED,
    identity: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Disjoint training and test rows that together are all rows."""
    if identity is None:
        first, second = df.randomSplit([train, 1.0 - train], seed=seed)
        return first, second
    share = hash_fraction(identity, seed)
    return df.where(share < train), df.where(share >= train)


def feature_stages(
    categorical: Sequence[str] = CATEGORICAL, numerical: Sequence[str] = NUMERICAL
) -> list:
    """Mean for missing numbers; index and one-hot code for categories.

    Unseen and missing categories share one extra index, which the one-hot code
    leaves all zero.
    """
    imputed = [f"{c}_imputed" for c in numerical]
    indexed = [f"{c}_index" for c in categorical]
    coded = [f"{c}_vec" for c in categorical]
    return [
        Imputer(inputCols=list(numerical), outputCols=imputed),
        StringIndexer(
            inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"
        ),
        OneHotEncoder(inputCols=indexed, outputCols=coded),
        VectorAssembler(inputCols=coded + imputed, outputCol="features"),
    ]


@dataclass(frozen=True)
class TrainedModel:
    model: PipelineModel
    predictions: DataFrame
    rmse: float


def train_fare_model(
    training_data: DataFrame,
    fraction: float = SAMPLE_FRACTION,
    seed: int = SEED,
    identity: Sequence[str] | None = None,
    label: str = LABEL,
    **tree_options: object,
) -> TrainedModel:
    """Sample, split 80/20, fit boosted trees and measure them on the test rows.

    The sample is stored before the split, so the many passes of the fit and the
    evaluation all see the same rows.
    """
    sample = materialize(
        sample_rows(training_data, fraction, seed, identity), "training-sample"
    )
    train, test = split_rows(sample, TRAIN_FRACTION, seed, identity)
    trees = GBTRegressor(featuresCol="features", labelCol=label, seed=seed, **tree_options)
    model = Pipeline(stages=[*feature_stages(), trees]).fit(train)
    predictions = model.transform(test)
    evaluator = RegressionEvaluator(
        labelCol=label, predictionCol="prediction", metricName="rmse"
    )
    return TrainedModel(model, predictions, evaluator.evaluate(predictions))


def fit_numeric_trees(
    rows: DataFrame, features: Sequence[str], label: str = LABEL, **tree_options: object
) -> PipelineModel:
    """Boosted trees on numeric columns as they are, without coding or sampling.

    A column with at most ``maxBins`` different values is split half way between two of
    them, wherever that lowers the variance most.
    """
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features"),
        GBTRegressor(featuresCol="features", labelCol=label, seed=SEED, **tree_options),
    ]
    return Pipeline(stages=stages).fit(rows.select(*features, label))


def _slots(model: PipelineModel) -> list[tuple[str, str | None]]:
    """What each place of the feature vector holds: a column, or one value of a column.

    Follows the stages back from the assembler: a one-hot slot is one label of the
    indexed column, an imputed column stands for the column that was imputed.
    """
    by_kind = {type(stage).__name__: stage for stage in model.stages}
    assembler = by_kind["VectorAssembler"]
    coded: dict[str, list[tuple[str, str | None]]] = {}
    if "OneHotEncoderModel" in by_kind:
        indexer, encoder = by_kind["StringIndexerModel"], by_kind["OneHotEncoderModel"]
        labels = dict(zip(indexer.getOutputCols(), indexer.labelsArray))
        source = dict(zip(indexer.getOutputCols(), indexer.getInputCols()))
        sizes = encoder.categorySizes
        for size, given, out in zip(sizes, encoder.getInputCols(), encoder.getOutputCols()):
            # The last index, that of unseen values, has no slot.
            known = list(labels[given])[: size - 1]
            coded[out] = [(source[given], x) for x in known]
    return [slot for c in assembler.getInputCols() for slot in coded.get(c, [(c, None)])]


def _slot_value(slot: tuple[str, str | None], filled: dict[str, Column]) -> Column:
    name, label = slot
    if label is None:
        return filled.get(name, F.col(name)).cast("double")
    return F.when(F.col(name).cast("string") == label, 1.0).otherwise(0.0)


def _nodes(model: GBTRegressionModel) -> list[dict]:
    """The nodes of all trees, parents first; ``go_left`` lists values or is a threshold."""
    out: list[dict] = []

    def walk(tree: int, number: int, node) -> None:
        row = {"tree": tree, "node": number, "value": float(node.prediction())}
        out.append(row)
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        row["feature"] = int(split.featureIndex())
        if split.getClass().getSimpleName() == "ContinuousSplit":
            row["threshold"] = float(split.threshold())
        else:
            row["categories"] = [float(x) for x in split.leftCategories()]
        walk(tree, 2 * number, node.leftChild())
        walk(tree, 2 * number + 1, node.rightChild())

    for i, tree in enumerate(model.trees):
        walk(i, 1, tree._java_obj.rootNode())
    return out


def tree_table(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """One row per node of the fitted trees.

    ``node`` 1 is a root and ``2 n``, ``2 n + 1`` are the children of n. An inner node
    sends rows left whose ``feature`` is at most ``threshold``, or is one of
    ``categories``; ``label`` names the value for a feature that is a one-hot slot.
    """
    trees = model.stages[-1]
    slots = _slots(model)
    rows = [
        (
            n["tree"],
            n["node"],
            float(trees.treeWeights[n["tree"]]),
            slots[n["feature"]][0] if "feature" in n else None,
            slots[n["feature"]][1] if "feature" in n else None,
            n.get("threshold"),
            n.get("categories"),
            n["value"],
        )
        for n in _nodes(trees)
    ]
    return spark.createDataFrame(
        rows,
        "tree int, node long, weight double, feature string, label string, threshold double, "
        "categories array<double>, value double",
    )


def as_expression(model: PipelineModel, schema: T.StructType) -> Column:
    """The prediction of a fitted model as an expression of raw columns of ``schema``.

    One nested ``when`` per tree, added up by weight: scoring needs no feature vector
    and no model object, and stays within generated code. Values equal those of
    ``transform`` but for the rounding of the sum.
    """
    trees, slots = model.stages[-1], _slots(model)
    filled = {}
    for stage in model.stages:
        if type(stage).__name__ == "ImputerModel":
            means = stage.surrogateDF.first()
            for given, out in zip(stage.getInputCols(), stage.getOutputCols()):
                # The stand-in takes the column's own type, as when the model was applied.
                kind = schema[given].dataType
                missing = F.col(given).isNull() | F.isnan(F.col(given).cast("double"))
                mean = F.lit(float(means[given])).cast(kind)
                filled[out] = F.when(missing, mean).otherwise(F.col(given))
    nodes = {(n["tree"], n["node"]): n for n in _nodes(trees)}

    def of(tree: int, number: int) -> Column:
        node = nodes[tree, number]
        if "feature" not in node:
            return F.lit(node["value"])
        value = _slot_value(slots[node["feature"]], filled)
        if "threshold" in node:
            left = value <= node["threshold"]
        else:
            left = value.isin(node["categories"])
        return F.when(left, of(tree, 2 * number)).otherwise(of(tree, 2 * number + 1))

    parts = [of(i, 1) * float(w) for i, w in enumerate(trees.treeWeights)]
    return reduce(lambda a, b: a + b, parts)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
