"""Training and comparing the three classifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.operators.cleaning import numeric_columns
from stayrate.operators.curves import curve_areas, ranked_counts
from stayrate.operators.encoding import numeric_assembler
from stayrate.operators.metrics import class_metrics, confusion_matrix
from stayrate.operators.sampling import hash_sample, hash_split, with_fold
from stayrate.schemas import MODEL_NAMES
from stayrate.sources.models import has_model, load_model
from stayrate.sources.storage import checkpoint_dir

_ROW_KEY = "_row_key"

#: Rows and numbers that one task of a fit reads. Trees keep every number of a row uncompressed, so a task must not
#: read too many; a boosted fit runs hundreds of jobs and pays for each task in each of them, so not too few either.
TASK_ROWS = 100_000
TASK_NUMBERS = 10_000_000


@dataclass(frozen=True)
class TrainingConfig:
    """``fast`` shortens the search; ``sample_fraction`` applies before the split.

    Rows with the same ``split_key`` fall on the same side; ``split_key=None`` splits by row content.
    Rows whose key is NULL are told apart by the ``null_keys`` columns, and fail the job without any.
    """

    fast: bool = False
    sample_fraction: float = 1.0
    train_fraction: float = 0.8
    split_key: str | None = "customerID"
    null_keys: tuple[str, ...] = ()
    seed: int = 42
    parallelism: int = 4
    models: tuple[str, ...] = tuple(MODEL_NAMES)

    @property
    def folds(self) -> int:
        return 2 if self.fast else 3


def candidates(config: TrainingConfig) -> dict[str, tuple[Estimator, list[dict]]]:
    """Each classifier with its grid. Grid parameters belong to the very estimator they tune."""
    fast, seed = config.fast, config.seed
    lr = LogisticRegression(maxIter=50 if fast else 100)
    # Rows keep their node in each tree, or every level would walk all trees again for each row: the same forest in half
    # the time where trees are many and deep. Boosted trees, one at a time, take longer that way.
    rf = RandomForestClassifier(seed=seed, cacheNodeIds=True)
    gbt = GBTClassifier(maxIter=20 if fast else 50, seed=seed)
    # The searched settings.
    grids = {
        "LR": (lr, {lr.regParam: [0.1] if fast else [0.01, 0.1], lr.elasticNetParam: [0.0] if fast else [0.0, 0.5]}),
        "RF": (rf, {rf.numTrees: [20] if fast else [50, 100], rf.maxDepth: [5] if fast else [5, 10]}),
        "GBT": (gbt, {gbt.maxDepth: [5] if fast else [5, 8], gbt.stepSize: [0.1] if fast else [0.1, 0.05]}),
    }
    chosen = {}
    for name in config.models:
        estimator, settings = grids[name]
        builder = ParamGridBuilder()
        for param, values in settings.items():
            builder = builder.addGrid(param, values)
        chosen[name] = (estimator, builder.build())
    return chosen


def fixed_classifier(name: str, seed: int = 42) -> Estimator:
    """The classifier trained without a search."""
    # The settings used when no saved model is at hand.
    return {
        "LR": lambda: LogisticRegression(maxIter=40),
        "RF": lambda: RandomForestClassifier(numTrees=20, maxDepth=6, seed=seed),
        "GBT": lambda: GBTClassifier(maxIter=20, maxDepth=5, stepSize=0.1, seed=seed),
    }[name]()


def feature_stages(df: DataFrame) -> list:
    """Nothing for tables that bring a vector, else an assembler over their numeric columns."""
    return [] if "features" in df.columns else [numeric_assembler(df)]


def model_inputs(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Only what fitting reads: the vector (or the numbers it is made of), the label and ``extra``."""
    inputs = ["features"] if "features" in df.columns else numeric_columns(df, exclude=("label", *extra))
    return df.select(*inputs, "label", *extra)


def keyed_rows(df: DataFrame, config: TrainingConfig) -> tuple[DataFrame, str]:
    """The table and its split key; a missing key column is an error."""
    if config.split_key is not None:
        if config.split_key not in df.columns:
            raise ValueError(f"the table has no column {config.split_key!r} to split by (split_key=None splits by row content)")
        return df, config.split_key
    return df.withColumn(_ROW_KEY, F.xxhash64(*df.columns)), _ROW_KEY


def sample_rows(df: DataFrame, config: TrainingConfig) -> DataFrame:
    """The configured fraction of the table."""
    if config.sample_fraction >= 1.0:
        return df
    keyed, key = keyed_rows(df, config)
    return hash_sample(keyed, key, config.sample_fraction, seed=config.seed, null_keys=config.null_keys).drop(_ROW_KEY)


def split_rows(df: DataFrame, config: TrainingConfig) -> tuple[DataFrame, DataFrame]:
    """Sample, then split by key into training rows with a ``fold`` and held-out rows.

    The side of a row depends on its key only, not on the sample.
    """
    keyed, key = keyed_rows(sample_rows(df, config), config)
    train, test = hash_split(keyed, key, train_fraction=config.train_fraction, seed=config.seed, null_keys=config.null_keys)
    train = with_fold(train, key, config.folds, seed=config.seed, null_keys=config.null_keys)
    return model_inputs(train.drop(_ROW_KEY), ("fold",)), test.drop(_ROW_KEY)


def vector_width(df: DataFrame) -> int:
    """Numbers of a row: the vector's slots as its metadata names them, or the numeric columns."""
    if "features" not in df.columns:
        return len(numeric_columns(df, exclude=("label", "fold")))
    described = df.schema["features"].metadata.get("ml_attr", {})
    return described.get("num_attrs", sum(map(len, described.get("attrs", {}).values())))


def spread_rows(train: DataFrame, *, rows: int = TASK_ROWS, numbers: int = TASK_NUMBERS) -> DataFrame:
    """``train`` in even pieces of ``rows`` rows, fewer where rows are wide; a table of one piece stays as it is.

    Files do not bound what a task reads: a compact store has few row groups, each of them one task's work, and
    what the learners keep of a row is many times its size there.
    """
    pieces = -(-train.count() // max(1, min(rows, numbers // max(1, vector_width(train)))))
    return train if pieces <= 1 else train.repartition(pieces)


def cross_validate(train: DataFrame, estimator: Estimator, grid: list[dict], config: TrainingConfig) -> CrossValidatorModel:
    """Grid search on the ``fold`` column, ranked by area under ROC."""
    checkpoint_dir(train.sparkSession)  # boosting cuts its lineage there every few rounds
    features = train.drop("fold")
    validator = CrossValidator(
        estimator=Pipeline(stages=[*feature_stages(features), estimator]),
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(metricName="areaUnderROC"),
        numFolds=config.folds,
        foldCol="fold",
        seed=config.seed,
        parallelism=config.parallelism,
    )
    return validator.fit(train)


def train_all(train: DataFrame, config: TrainingConfig) -> dict[str, CrossValidatorModel]:
    """Search all models side by side, each with ``config.parallelism`` fits at a time.

    The end of one search, a few long fits and one more of the best point, then leaves no cores idle. The fits do
    not depend on each other; the driver holds models only, the rows stay in ``train``.
    """
    searches = candidates(config)
    with ThreadPoolExecutor(max(1, len(searches))) as pool:
        fits = {name: pool.submit(cross_validate, train, est, grid, config) for name, (est, grid) in searches.items()}
        return {name: fit.result() for name, fit in fits.items()}


def train_fixed(train: DataFrame, name: str, *, seed: int = 42) -> PipelineModel:
    checkpoint_dir(train.sparkSession)
    inputs = spread_rows(model_inputs(train))
    return Pipeline(stages=[*feature_stages(inputs), fixed_classifier(name, seed)]).fit(inputs)


def load_or_train(
    spark: SparkSession, root: str, name: str, train: DataFrame | None = None, *, seed: int = 42
) -> PipelineModel:
    """The saved model, or one trained on ``train``. Without ``train`` a missing model is an error."""
    if train is None or has_model(spark, root, name):
        return load_model(spark, root, name)
    return train_fixed(train, name, seed=seed)


def cv_table(fitted: Mapping[str, CrossValidatorModel], spark: SparkSession) -> DataFrame:
    """Mean cross-validation AUC of each grid point."""
    rows = []
    for name, model in fitted.items():
        scores = [float(score) for score in model.avgMetrics]
        best = scores.index(max(scores))
        for point, params in enumerate(model.getEstimatorParamMaps()):
            text = ", ".join(f"{p.name}={v}" for p, v in params.items())
            rows.append((name, point, text, scores[point], point == best))
    return spark.createDataFrame(rows, "model string, grid_point int, params string, mean_auc double, is_best boolean")


def model_report(predictions: DataFrame) -> DataFrame:
    """One row per model: exact AUC, weighted F1, accuracy, class rates and matrix cells.

    Takes (model, label, prediction, score) and measures all models together.
    """
    by = ["model"]
    cells = class_metrics(confusion_matrix(predictions, by=by))
    areas = curve_areas(ranked_counts(predictions, by=by), by=by)
    areas = areas.select("model", F.col("roc_auc").alias("auc"), "pr_auc_trapezoid", "average_precision")
    return areas.join(cells.withColumnRenamed("weighted_f1", "f1"), "model")
