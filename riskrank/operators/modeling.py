"""Model grids: fitting, scoring and importances.

Trees, forests and boosted trees (`trees`) and logistic regressions (`logistic`) of a grid are fitted together; registered
models are Spark ML's, one by one.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce
from math import ceil

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrank.operators.logistic import LogisticView, fit_points, load_point, save_point, score_points
from riskrank.operators.matrix import labeled
from riskrank.operators.ranking import rank_baseline
from riskrank.operators.trees import (
    Family, TreeView, boost, feature_count, grow, load_view, save_view, score_views, view_importances,
)
from riskrank.session import cut_lineage

MAX_TREE_DEPTH = 30  # the deepest tree Spark ML grows
_SEED = 17
#: Classes whose trees are grown exactly, all of a grid at once.
EXACT_TREES = ("DecisionTreeClassifier", "RandomForestClassifier")
BOOSTED = "GradientBoostingClassifier"
LOGISTIC = "LogisticRegression"


@dataclass
class Model:
    """One grid point: its identity, and after fitting its transformer or its failure."""

    model_id: str
    model_class: str
    kwargs: dict
    spark_params: dict = field(default_factory=dict)
    fitted: PipelineModel | TreeView | LogisticView | None = None
    fit_status: str = "unfitted"

    @property
    def kind(self) -> str:
        return self.model_class.rsplit(".", 1)[-1]

    @property
    def is_baseline(self) -> bool:
        return self.kind == "RankBaseline"


def expand_grid(model_config: Mapping[str, Mapping[str, Sequence]]) -> list[Model]:
    """Every combination of the listed values of every class, in config order."""
    models = []
    for name, options in model_config.items():
        for values in itertools.product(*options.values()):
            kwargs = dict(zip(options, values))
            text = json.dumps([name, kwargs], sort_keys=True)
            digest = hashlib.sha256(text.encode()).hexdigest()[:10]
            models.append(Model(f"{name.rsplit('.', 1)[-1]}_{digest}", name, kwargs))
    return models


def penalty_point(rows: int, penalty: str | None, C: float, l1_ratio: float | None) -> tuple[float, float]:
    """Strength against the mean loss, and the absolute penalty's share of it.

    The inverse strength C weighs the summed loss, so the strength is 1 / (C * rows).
    """
    mix = {"l1": 1.0, "l2": 0.0, "elasticnet": l1_ratio or 0.0, "none": 0.0, None: 0.0}[penalty]
    return (0.0, 0.0) if penalty in ("none", None) else (1.0 / (C * max(rows, 1)), mix)


def logistic_model(
    rows: int, penalty: str | None = "l2", C: float = 1.0, l1_ratio: float | None = None,
    max_iter: int = 100, features: str = "features", label: str = "label",
) -> list:
    """Standardised inputs, then Spark ML's logistic regression, for `register_model`."""
    strength, mix = penalty_point(rows, penalty, C, l1_ratio)
    scaler = StandardScaler(inputCol=features, outputCol="scaled", withMean=True, withStd=True)
    model = LogisticRegression(featuresCol="scaled", labelCol=label, regParam=strength,
                               elasticNetParam=mix, maxIter=max_iter, standardization=False)
    return [scaler, model]


def _subset(max_features, auto: str) -> str:
    return {"auto": auto, "sqrt": "sqrt", "log2": "log2", None: "all"}.get(max_features, str(max_features))


def tree_model(
    kind: str, *, max_depth: int | None = None, min_samples_split: int = 2,
    min_samples_leaf: int = 1, min_weight_fraction_leaf: float = 0.0, n_estimators: int = 100,
    max_features: str | float | None = "sqrt", learning_rate: float = 0.1, subsample: float = 1.0,
    seed: int = _SEED, features: str = "features", label: str = "label",
) -> list:
    """Spark ML's decision tree, random forest or gradient boosting by class name, for `register_model`.

    Trees and forests are regressions on the 0/1 label: variance picks the splits that
    the Gini index picks, and a leaf's mean is its share of positives.  Spark's
    classification trees merge leaves that predict the same class, which leaves one
    score for everybody when positives are rare.  A depth above Spark's limit, or none,
    is grown to the limit; `fit_grid` reports a failure if that cuts a tree short.  A
    minimum split size becomes a minimum leaf size of half of it, the nearest that
    Spark ML offers; `spark_params` has both.
    """
    depth = MAX_TREE_DEPTH if max_depth is None else min(max_depth, MAX_TREE_DEPTH)
    common = dict(featuresCol=features, labelCol=label, maxDepth=depth, seed=seed,
                  minInstancesPerNode=max(min_samples_leaf, ceil(min_samples_split / 2)),
                  minWeightFractionPerNode=min_weight_fraction_leaf)
    if kind == "DecisionTreeClassifier":
        return [DecisionTreeRegressor(**common)]
    if kind == "RandomForestClassifier":
        return [RandomForestRegressor(numTrees=n_estimators,
                                      featureSubsetStrategy=_subset(max_features, "sqrt"), **common)]
    if kind == "GradientBoostingClassifier":
        return [GBTClassifier(maxIter=n_estimators, stepSize=learning_rate, subsamplingRate=float(subsample),
                              featureSubsetStrategy=_subset(max_features, "sqrt"), **common)]
    raise ValueError(f"unknown tree model {kind!r}")


Builder = Callable[..., list]
_BUILDERS: dict[str, Builder] = {}


def register_model(kind: str, builder: Builder) -> None:
    """Make a class name usable in model configs; `builder(rows, **kwargs)` returns stages."""
    _BUILDERS[kind] = builder


def _refuse_cut_trees(model: Model) -> None:
    """A tree that was to grow deeper than Spark's limit must have stopped before it."""
    last, wanted = model.fitted.stages[-1], model.kwargs.get("max_depth", MAX_TREE_DEPTH)
    if not hasattr(last, "featureImportances") or wanted is not None and wanted <= MAX_TREE_DEPTH:
        return
    if max((t.depth for t in getattr(last, "trees", [last])), default=0) >= MAX_TREE_DEPTH:
        raise ValueError(f"trees need a depth above {MAX_TREE_DEPTH}, max_depth={wanted} cannot be grown")


def _fit_one(model: Model, train: DataFrame, rows: int, classes: int, feature_columns: Sequence[str]) -> Model:
    try:
        if model.is_baseline:
            if model.kwargs.get("sort", "desc") not in ("asc", "desc"):
                raise ValueError("sort must be 'asc' or 'desc'")
            if model.kwargs.get("column") not in feature_columns:
                raise ValueError(f"no feature column {model.kwargs.get('column')!r}")
        else:
            stages = _BUILDERS[model.kind](rows, **model.kwargs)
            if classes < 2:
                raise ValueError(f"training labels have {classes} classes, two are needed")
            model.spark_params = {p.name: v for p, v in stages[-1].extractParamMap().items()
                                  if p.name in ("regParam", "elasticNetParam", "maxDepth", "numTrees",
                                                "maxIter", "minInstancesPerNode", "featureSubsetStrategy")}
            if "min_samples_split" in model.kwargs:
                model.spark_params["min_samples_split"] = model.kwargs["min_samples_split"]
            model.fitted = Pipeline(stages=stages).fit(train)
            _refuse_cut_trees(model)
        model.fit_status = "ok"
    except Exception as error:  # a failed grid point is reported and skipped
        model.fitted, model.fit_status = None, f"{type(error).__name__}: {error}"
    return model


def _tree_setting(model: Model, features: int) -> tuple[Family, int]:
    """The family a tree or forest belongs to, as it alone would need it, and its number of trees."""
    def setting(*, max_depth=None, min_samples_split=2, min_samples_leaf=1, min_weight_fraction_leaf=0.0, seed=_SEED,
                n_estimators=100, max_features="auto", bootstrap=True):
        forest = model.kind == "RandomForestClassifier"
        used = feature_count(max_features if forest or max_features != "auto" else None, features)
        name = f"{model.kind} {used} {min_samples_leaf} {min_weight_fraction_leaf} {seed} {forest and bootstrap}"
        trees = n_estimators if forest else 1
        if trees < 1 or min_samples_split < 2 or min_samples_leaf < 1 or max_depth is not None and max_depth < 0:
            raise ValueError(f"no tree can be grown with {model.kwargs}")
        return Family(name, trees, forest and bootstrap, used, min_samples_leaf, min_weight_fraction_leaf, max_depth,
                      min_samples_split, seed)

    return setting(**model.kwargs)


def fit_boosted(matrix: DataFrame, feature_columns: Sequence[str], models: Sequence[Model], *, label: str = "label",
                **sizes: int) -> None:
    """Fit all boosted models of a grid round by round; those that differ in the number of rounds only are one family."""
    def setting(*, n_estimators=100, learning_rate=0.1, subsample=1.0, max_depth=3, min_samples_split=2,
                min_samples_leaf=1, max_features=None, seed=_SEED):
        used = feature_count(max_features, len(feature_columns))
        if n_estimators < 1 or learning_rate <= 0 or not 0 < subsample <= 1 or min_samples_leaf < 1:
            raise ValueError(f"nothing can be boosted with {m.kwargs}")
        name = f"{BOOSTED} {learning_rate} {subsample} {max_depth} {min_samples_split} {min_samples_leaf} {used} {seed}"
        return Family(name, n_estimators, False, used, min_samples_leaf, 0.0, max_depth, min_samples_split, seed,
                      float(learning_rate), float(subsample))

    settings: dict[str, Family] = {}
    for m in models:
        try:
            settings[m.model_id] = setting(**m.kwargs)
        except Exception as error:  # a grid point that means nothing is reported and skipped
            m.fit_status = f"{type(error).__name__}: {error}"
    families: dict[str, Family] = {}
    for f in settings.values():
        families[f.name] = replace(f, trees=max(f.trees, families.get(f.name, f).trees))
    if not families:
        return
    try:
        nodes, start = boost(plain_rows(matrix, feature_columns, label), list(families.values()), len(feature_columns), **sizes)
    except Exception as error:
        for m in models:
            if m.model_id in settings:
                m.fit_status = f"{type(error).__name__}: {error}"
        return
    for m in models:
        if m.model_id in settings:
            f = settings[m.model_id]
            m.fitted, m.fit_status = TreeView(nodes, f.name, f.trees, f.max_depth, f.min_split, f.rate, start), "ok"
            m.spark_params = {"maxIter": f.trees, "maxDepth": f.max_depth, "minInstancesPerNode": f.min_leaf,
                              "featuresPerNode": f.max_features}


def plain_rows(matrix: DataFrame, feature_columns: Sequence[str], label: str = "label") -> DataFrame:
    """(rid, y, x0, x1, ...): row, label and features as plain columns, written once."""
    keys = [c for c in ("split_id", "entity_id") if c in matrix.columns]
    row = F.xxhash64(*keys) if keys else F.monotonically_increasing_id()
    return cut_lineage(matrix.select(
        row.alias("rid"), F.col(label).cast("double").alias("y"),
        *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(feature_columns)]))


def fit_logistic(matrix: DataFrame, feature_columns: Sequence[str], models: Sequence[Model], rows: int, *,
                 label: str = "label") -> None:
    """Fit all logistic regressions of a grid in one go: as many passes over the rows as the slowest alone needs."""
    def setting(*, penalty="l2", C=1.0, l1_ratio=None, max_iter=100):
        if C <= 0 or max_iter < 1:
            raise ValueError(f"no regression can be fitted with C={C}, max_iter={max_iter}")
        return (*penalty_point(rows, penalty, C, l1_ratio), max_iter)

    settings = {}
    for m in models:
        try:
            settings[m.model_id] = setting(**m.kwargs)
        except Exception as error:  # a grid point that means nothing is reported and skipped
            m.fit_status = f"{type(error).__name__}: {error}"
    train = plain_rows(matrix, feature_columns, label) if settings else None
    for most in sorted({s[2] for s in settings.values()}):
        mine = [m for m in models if settings.get(m.model_id, (0, 0, 0))[2] == most]
        points = sorted({settings[m.model_id][:2] for m in mine})
        try:
            fitted = dict(zip(points, fit_points(train, len(feature_columns), points, most)))
        except Exception as error:
            for m in mine:
                m.fit_status = f"{type(error).__name__}: {error}"
            continue
        for m in mine:
            strength, mix, _ = settings[m.model_id]
            m.fitted, m.fit_status = fitted[strength, mix], "ok"
            m.spark_params = {"regParam": strength, "elasticNetParam": mix, "maxIter": most}


def fit_trees(matrix: DataFrame, feature_columns: Sequence[str], models: Sequence[Model], *, label: str = "label",
              **sizes: int) -> None:
    """Fit all trees and forests of a grid in one go, as views of the few families they belong to.

    The number of Spark jobs follows the depth down to which nodes are too large for a task, not the number of models.
    """
    settings = {}
    for m in models:
        try:
            settings[m.model_id] = _tree_setting(m, len(feature_columns))
        except Exception as error:  # a grid point that means nothing is reported and skipped
            m.fit_status = f"{type(error).__name__}: {error}"
    families: dict[str, Family] = {}
    for f in settings.values():
        known = families.get(f.name, f)
        depth = None if None in (f.max_depth, known.max_depth) else max(f.max_depth, known.max_depth)
        families[f.name] = replace(f, trees=max(f.trees, known.trees), max_depth=depth,
                                   min_split=min(f.min_split, known.min_split))
    if not families:
        return
    train = plain_rows(matrix, feature_columns, label)
    try:
        nodes = grow(train, list(families.values()), len(feature_columns), **sizes)
    except Exception as error:
        for m in models:
            if m.model_id in settings:
                m.fit_status = f"{type(error).__name__}: {error}"
        return
    for m in models:
        if m.model_id in settings:
            f = settings[m.model_id]
            m.fitted, m.fit_status = TreeView(nodes, f.name, f.trees, f.max_depth, f.min_split), "ok"
            m.spark_params = {"numTrees": f.trees, "maxDepth": f.max_depth, "min_samples_split": f.min_split,
                              "minInstancesPerNode": f.min_leaf, "featuresPerNode": f.max_features}


def fit_grid(
    matrix: DataFrame,
    feature_columns: Sequence[str],
    models: Sequence[Model],
    *,
    label: str = "label",
    parallelism: int = 4,
) -> list[Model]:
    """Fit every grid point on the labeled rows.

    Trees and forests are grown together (`fit_trees`), boosted round by round (`fit_boosted`), and logistic regressions
    fitted step by step (`fit_logistic`); each other fit is a distributed Spark ML job of its own.  The assembled training rows of these are cached for the whole grid and released after it.  A fit that fails is returned
    with the reason in `fit_status`; so is one whose training labels are all the same.
    """
    rows = labeled(matrix, label)
    models = [Model(m.model_id, m.model_class, dict(m.kwargs)) for m in models]
    counts = ([r["count"] for r in rows.groupBy(label).count().collect()]
              if any(not m.is_baseline for m in models) else [])
    together = [m for m in models if m.kind in (*EXACT_TREES, BOOSTED, LOGISTIC) and m.kind not in _BUILDERS]
    if len(counts) < 2:
        for m in together:
            m.fit_status = f"ValueError: training labels have {len(counts)} classes, two are needed"
    else:
        if trees := [m for m in together if m.kind in EXACT_TREES]:
            fit_trees(rows, feature_columns, trees, label=label)
        if boosted := [m for m in together if m.kind == BOOSTED]:
            fit_boosted(rows, feature_columns, boosted, label=label)
        if regressions := [m for m in together if m.kind == LOGISTIC]:
            fit_logistic(rows, feature_columns, regressions, sum(counts), label=label)
    others = [m for m in models if not any(m is t for t in together)]
    if not any(not m.is_baseline for m in others):
        for m in others:
            _fit_one(m, rows, 0, 0, feature_columns)
        return models
    train = (VectorAssembler(inputCols=list(feature_columns), outputCol="features", handleInvalid="error")
             .transform(rows.withColumn("label", F.col(label).cast("double"))).select("features", "label"))
    train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        task = inheritable_thread_target(matrix.sparkSession)(
            lambda m: _fit_one(m, train, sum(counts), len(counts), feature_columns))
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            list(pool.map(task, others))
        return models
    finally:
        train.unpersist()


def model_table(spark: SparkSession, models: Sequence[Model]) -> DataFrame:
    """One row per grid point: class, arguments, Spark parameters and fit status."""
    rows = [(m.model_id, m.model_class, json.dumps(m.kwargs, sort_keys=True),
             json.dumps(m.spark_params, sort_keys=True, default=str), m.fit_status) for m in models]
    return spark.createDataFrame(rows, "model_id string, model_class string, model_kwargs string, "
                                       "spark_params string, fit_status string")


def save_models(models: Sequence[Model], path: str) -> None:
    """Every usable model under `path`; trees that several models are views of are written once."""
    tables: dict[int, str] = {}
    for m in models:
        if isinstance(m.fitted, TreeView):
            nodes = m.fitted.nodes
            if id(nodes) not in tables:
                tables[id(nodes)] = f"{path}/trees-{uuid.uuid4().hex}"
                nodes.write.parquet(tables[id(nodes)])
            save_view(m.fitted, f"{path}/{m.model_id}", tables[id(nodes)])
        elif isinstance(m.fitted, LogisticView):
            save_point(m.fitted, SparkSession.active(), f"{path}/{m.model_id}")
        elif m.fitted is not None:
            m.fitted.write().overwrite().save(f"{path}/{m.model_id}")


def load_model(path: str, model: Model) -> Model:
    place, spark = f"{path}/{model.model_id}", SparkSession.active()
    fitted = load_view(spark, place) or load_point(spark, place) or PipelineModel.load(place)
    return Model(model.model_id, model.model_class, model.kwargs, fitted=fitted, fit_status="ok")


def _probability_only(model: Model, column: str) -> tuple[PipelineModel, Column]:
    """A copy that writes one column and no others beside its scaled input; the probability in it."""
    copy = model.fitted.copy()
    *before, last = copy.stages
    for stage in before:
        stage.setOutputCol(f"scaled_{column}")
        last.setFeaturesCol(f"scaled_{column}")
    if not last.hasParam("probabilityCol"):  # a regression on the label
        last.setPredictionCol(column)
        return copy, F.col(column)
    last.setProbabilityCol(column)
    last.setPredictionCol("")
    last.setRawPredictionCol("")
    return copy, F.get(vector_to_array(column), F.lit(1))


def score_models(
    models: Sequence[Model],
    features: DataFrame,
    feature_columns: Sequence[str],
    *,
    keys: Sequence[str] = ("split_id", "entity_id"),
    models_per_pass: int = 16,
) -> DataFrame:
    """(keys, model_id, probability) for every row, labeled or not.

    Up to `models_per_pass` Spark ML models read the features in one pass: each adds its
    probability as a column, and the columns are unfolded to rows.  Trees and forests
    share passes of their own, and so do logistic regressions.
    """
    views = {m.model_id: m.fitted for m in models if isinstance(m.fitted, TreeView)}
    points = {m.model_id: m.fitted for m in models if isinstance(m.fitted, LogisticView)}
    usable = [m for m in models if m.fitted is not None and m.model_id not in views and m.model_id not in points]
    assembled = (VectorAssembler(inputCols=list(feature_columns), outputCol="features", handleInvalid="error")
                 .transform(features).select(*keys, "features"))
    passes = [score(found, features, feature_columns, keys) for score, found in
              ((score_views, views), (score_points, points)) if found]
    for start in range(0, len(usable), models_per_pass):
        chunk = usable[start:start + models_per_pass]
        wide, entries = assembled, []
        for i, model in enumerate(chunk):
            copy, probability = _probability_only(model, f"p{i}")
            wide = copy.transform(wide)
            missing = F.raise_error(F.lit(f"{model.model_id} gave no probability")).cast("double")
            entries.append(F.struct(F.lit(model.model_id).alias("model_id"),
                                    F.coalesce(probability, missing).alias("probability")))
        scored = F.explode(F.array(*entries))
        passes.append(wide.select(*keys, scored.alias("_s")).select(*keys, "_s.*"))
    if not passes:
        return features.select(*keys, F.lit("").alias("model_id"), F.lit(0.0).alias("probability")).limit(0)
    return reduce(DataFrame.unionByName, passes)


def score_baselines(
    models: Sequence[Model], features: DataFrame, *, entity: str = "entity_id",
    group: Sequence[str] = ("split_id",), carry: Sequence[str] = (), tiebreak: Sequence[str] = (),
) -> DataFrame | None:
    """(group, entity, carry, model_id, probability, rank, group_rows) of the rank baselines.

    All baselines are ranked in one pass: their columns are unfolded to rows with a
    sort value that is highest at the top of the ranking.
    """
    usable = [m for m in models if m.is_baseline and m.fit_status == "ok"]
    if not usable:
        return None
    entries = []
    for m in usable:
        value = F.col(m.kwargs["column"]).cast("double")
        if m.kwargs.get("sort", "desc") == "asc":
            value = F.coalesce(-value, F.lit(float("-inf")))
        entries.append(F.struct(F.lit(m.model_id).alias("model_id"), value.alias("_value")))
    kept = [*group, entity, *carry]
    long = features.select(*kept, F.explode(F.array(*entries)).alias("_m")).select(*kept, "_m.*")
    return rank_baseline(long, "_value", entity=entity, group=[*group, "model_id"], tiebreak=tiebreak).drop(
        "_value", "prediction")


def feature_importance(models: Sequence[Model], feature_columns: Sequence[str], spark: SparkSession) -> DataFrame:
    """(model_id, feature, importance) of every usable model.

    Absolute coefficients on standardised inputs for logistic regression, impurity
    importances for trees, one for a baseline's own column, NULL when there is none.
    The values are model parameters: features x models rows, whatever the data size.
    """
    rows, views = [], {m.model_id: m.fitted for m in models if isinstance(m.fitted, TreeView)}
    of_trees = view_importances(views, len(feature_columns))
    for m in models:
        if m.fit_status != "ok":
            continue
        if m.model_id in views:
            values = of_trees[m.model_id]
        elif isinstance(m.fitted, LogisticView):
            values = [abs(c) for c in m.fitted.coefficients]
        elif m.is_baseline:
            values = [1.0 if c == m.kwargs["column"] else 0.0 for c in feature_columns]
        else:
            last = m.fitted.stages[-1]
            if hasattr(last, "coefficients"):
                values = [abs(float(v)) for v in last.coefficients.toArray()]
            elif hasattr(last, "featureImportances"):
                values = [float(v) for v in last.featureImportances.toArray()]
            else:
                values = [None] * len(feature_columns)
        rows += [(m.model_id, c, v) for c, v in zip(feature_columns, values)]
    return spark.createDataFrame(rows, "model_id string, feature string, importance double")
