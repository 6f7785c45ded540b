"""Boosted trees on feature tables: training, search and batch scoring."""

from __future__ import annotations

import math
import random
import uuid
from collections.abc import Collection, Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.operators import boosting
from cardflow.operators.assemble import imbalance_weight
from cardflow.operators.cleaning import apply_scaler
from cardflow.operators.metrics import classification_report, f1_binary, promotion_decision
from cardflow.operators.selection import temporal_split
from cardflow.schema import LABEL, MODEL_COLS
from cardflow.session import shared_dir

TRIALS = 15
SEED = 42
# What stands for a missing value until it has a bin.
MISSING = "-1e6"
# Bins of a feature, settings judged at the same time, and binned rows that keep a task busy.
BINS = 30
PARALLEL_TRIALS = 8
ROWS_A_TASK = 50_000


@dataclass(frozen=True)
class TreeParams:
    max_depth: int = 6
    learning_rate: float = 0.1
    trees: int = 100
    positive_weight: float = 1.0


def candidates(base_weight: float, n: int = TRIALS, seed: int = SEED) -> list[TreeParams]:
    """Seeded random settings.

    Depth 3 to 9, rate 0.01 to 0.2 (even on a log scale), 50 to 150 trees, and a
    positive weight of 0.5 to 1.5 times the class ratio.
    """
    draw = random.Random(seed)
    return [
        TreeParams(
            max_depth=draw.randint(3, 9),
            learning_rate=math.exp(draw.uniform(math.log(0.01), math.log(0.2))),
            trees=draw.randint(50, 150),
            positive_weight=base_weight * draw.uniform(0.5, 1.5),
        )
        for _ in range(n)
    ]


def bin_features(df: DataFrame, features: Sequence[str] = MODEL_COLS) -> PipelineModel:
    """Stages that put each feature into one of ``BINS`` bins of about as many rows.

    The bounds of all columns come from one pass. A missing value has a bin below all
    others, so that trees can tell it apart; minus infinity shares it.
    """
    known = ", ".join(
        f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), {MISSING}) AS `_f_{c}`"
        for c in features
    )
    complete = SQLTransformer(statement=f"SELECT *, {known} FROM __THIS__")
    columns, binned = [f"_f_{c}" for c in features], [f"_b_{c}" for c in features]
    shares = [k / BINS for k in range(BINS)]
    bounds = complete.transform(df).approxQuantile(columns, shares, 1 / (20 * BINS))
    above = float(MISSING) + 0.5
    splits = [[-math.inf, above, *sorted({x for x in found if above < x < math.inf}), math.inf] for found in bounds]
    bins = Bucketizer(inputCols=columns, outputCols=binned, splitsArray=splits, handleInvalid="keep")
    assembler = VectorAssembler(inputCols=binned, outputCol="_features")
    return PipelineModel([complete, bins, assembler])


def _alike(df: DataFrame, bins: PipelineModel, label: str, asked: Collection[int]) -> DataFrame:
    """Label, binned features and the number of rows ``_n`` that are alike in ``asked`` columns.

    Rows of a batch that are alike are one row. The other columns are 0.
    """
    complete, into, assembler = bins.stages
    columns = into.getOutputCols()
    kept = [c for k, c in enumerate(columns) if k in asked]
    keys = ["_label", *kept]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(keys, use_threads=False).aggregate([([], "count_all")])
            yield from found.select([*keys, "count_all"]).rename_columns([*keys, "_n"]).to_batches()

    known = into.transform(complete.transform(df)).select(
        F.col(label).cast("int").alias("_label"), *[F.col(c).cast("smallint") for c in kept]
    )
    schema = ", ".join(["_label int", *[f"`{c}` smallint" for c in kept], "_n bigint"])
    whole = known.mapInArrow(counted, schema).withColumns({c: F.lit(0) for c in columns if c not in kept})
    return assembler.transform(whole).select("_label", "_features", "_n")


def _binned(df: DataFrame, bins: PipelineModel, label: str, asked: Collection[int] | None = None) -> DataFrame:
    """Label and binned features only, in no more partitions than rows ask for.

    With ``asked``, rows alike in those columns are one, with their number.
    """
    if asked is None:
        narrow = bins.transform(df).select(F.col(label).alias("_label"), "_features")
    else:
        narrow = _alike(df, bins, label, asked)
    narrow = narrow.persist(StorageLevel.MEMORY_AND_DISK)
    wanted = max(1, math.ceil(narrow.count() / ROWS_A_TASK))
    if wanted >= narrow.rdd.getNumPartitions():
        return narrow
    # Each setting is judged by a job over this table, so tiny tasks would cost the most.
    fewer = narrow.repartition(wanted).persist(StorageLevel.MEMORY_AND_DISK)
    fewer.count()
    narrow.unpersist()
    return fewer


def _blocks(df: DataFrame, bins: PipelineModel, label: str) -> boosting.Blocks:
    """Label and bins as the trees are grown from them."""
    complete, into = bins.stages[:2]
    numbers = [len(bounds) - 1 for bounds in into.getSplitsArray()]
    return boosting.pack(into.transform(complete.transform(df)), label, into.getOutputCols(), numbers)


def _fit_all(blocks: boosting.Blocks, settings: Sequence[TreeParams], seed: int) -> list[GBTClassificationModel]:
    """Models of all settings, whose trees are grown in the same passes."""
    return _models(blocks.bins, settings, boosting.grow(blocks, settings), seed)


def _models(
    bins: Sequence[int], settings: Sequence[TreeParams], grown: Sequence[list[boosting.Tree]], seed: int
) -> list[GBTClassificationModel]:
    spark = SparkSession.active()

    def model(params: TreeParams, grown: list[boosting.Tree]) -> GBTClassificationModel:
        estimator = GBTClassifier(
            featuresCol="_features",
            labelCol="_label",
            weightCol="_weight",
            maxDepth=params.max_depth,
            maxIter=params.trees,
            stepSize=params.learning_rate,
            maxBins=BINS + 2,
            seed=seed,
        )
        path = f"{shared_dir(spark)}/trees-{uuid.uuid4().hex}"
        return boosting.to_model(spark, path, grown, estimator, bins)

    with ThreadPool(min(PARALLEL_TRIALS, len(settings))) as pool:
        return pool.starmap(inheritable_thread_target(spark)(model), zip(settings, grown), chunksize=1)


def _fit_trees(blocks: boosting.Blocks, params: TreeParams, seed: int) -> GBTClassificationModel:
    return _fit_all(blocks, [params], seed)[0]


def train_gbt(
    df: DataFrame,
    params: TreeParams,
    features: Sequence[str] = MODEL_COLS,
    label: str = LABEL,
    seed: int = SEED,
) -> PipelineModel:
    """Fit weighted boosted trees. Positives weigh ``positive_weight``, negatives 1."""
    bins = bin_features(df, features)
    blocks = _blocks(df, bins, label)
    try:
        return PipelineModel([*bins.stages, _fit_trees(blocks, params, seed)])
    finally:
        blocks.unpersist()


@dataclass(frozen=True)
class ScoringModel:
    """Trees and the scaler statistics that their training rows were scaled with."""

    trees: PipelineModel
    scaler: DataFrame


def save_model(model: ScoringModel, path: str) -> str:
    model.scaler.write.mode("overwrite").parquet(f"{path}/scaler")
    model.trees.write().overwrite().save(f"{path}/trees")
    return path


def load_model(spark: SparkSession, path: str) -> ScoringModel:
    return ScoringModel(
        PipelineModel.load(f"{path}/trees"), spark.read.parquet(f"{path}/scaler")
    )


def score(df: DataFrame, model: PipelineModel | ScoringModel) -> DataFrame:
    """Input columns and ``prediction`` (0 or 1), from the stored feature row.

    A model with a scaler scores, and returns, the amount as that scales it.
    """
    if isinstance(model, ScoringModel):
        df, model = apply_scaler(df, model.scaler), model.trees
    scored = model.transform(df)
    return scored.select(*df.columns, F.col("prediction").cast("int").alias("prediction"))


def search(
    train: DataFrame,
    test: DataFrame,
    n: int = TRIALS,
    seed: int = SEED,
    settings: Sequence[TreeParams] | None = None,
    features: Sequence[str] = MODEL_COLS,
) -> tuple[PipelineModel, TreeParams, list[tuple[TreeParams, float]]]:
    """Best of ``n`` settings by F1 on the later rows, with all trials.

    Bins are fitted once on the earlier rows, and both sides are kept as binned rows that
    all trials read. The trees of all settings grow in the same passes. ``PARALLEL_TRIALS``
    are judged at once; their order has no influence. Later rows that no tree can tell apart
    are judged as one, by their number. Of equal settings the first one wins.
    """
    if settings is None:
        settings = candidates(imbalance_weight(train).first()["weight"], n, seed)
    bins = bin_features(train, features)
    learn = _blocks(train, bins, LABEL)
    try:
        grown = boosting.grow(learn, settings)
    finally:
        learn.unpersist()
    models = _models(learn.bins, settings, grown, seed)
    judge = _binned(test, bins, LABEL, {c for trees in grown for tree in trees for c in tree.asked()})

    def trial(trees: GBTClassificationModel) -> float:
        return f1_binary(trees.transform(judge), "_label", rows="_n").first()["f1"]

    try:
        with ThreadPool(min(PARALLEL_TRIALS, len(settings))) as pool:
            found = pool.map(inheritable_thread_target(train.sparkSession)(trial), models, chunksize=1)
    finally:
        judge.unpersist()
    best = max(range(len(found)), key=found.__getitem__)
    model = PipelineModel([*bins.stages, models[best]])
    return model, settings[best], list(zip(settings, found))


def train_candidate(
    dataset: DataFrame,
    production_f1: DataFrame | None = None,
    settings: Sequence[TreeParams] | None = None,
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Search on the earlier rows and judge the winner on the later ones.

    Returns the model, its classification report and the one-row promotion decision.
    """
    train, test = temporal_split(dataset)
    model, _, _ = search(train, test, settings=settings)
    scored = score(test, model)
    decision = promotion_decision(f1_binary(scored), production_f1)
    return model, classification_report(scored), decision
