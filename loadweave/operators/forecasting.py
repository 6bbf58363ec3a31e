"""Fitting, scoring and reporting the load model with Spark ML."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadweave.functions import metrics as M
from loadweave.operators.baselines import BASELINES
from loadweave.operators.evaluation import (
    error_table,
    evaluate_baselines,
    exact_percentiles,
    fold_averages,
    two_stage,
    with_baselines,
)
from loadweave.operators.features import build_features, feature_names
from loadweave.operators.histograms import KNOWN, Fit, Tree, boost_binned, fits_of
from loadweave.operators.splits import chrono_split, row_index
from loadweave.plans.joins import BROADCAST_ROWS
from loadweave.session import checkpointed, scratch_path, shared_dir
from loadweave.settings import PanelSpec, Settings

FOLD_SCHEMA = (
    "fold int, train_rows long, val_rows long, best_iteration int, "
    "val_mae double, val_rmse double, val_mape double"
)

#: Trees after which the running forecast is checkpointed, and rows that are worth a task.
CHECKPOINT_EVERY = 10
ROWS_PER_TASK = 50_000
#: Up to so many rows training keeps them in memory and fits all folds side by side.
FEW_ROWS = 1_000_000


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    folds: DataFrame
    n_rows: int
    names: tuple[str, ...]
    importances: tuple[float, ...]


@dataclass(frozen=True)
class Boosted:
    """Trees on residuals: ``base + rate * (sum of the trees)``."""

    base: float
    rate: float
    trees: tuple[DecisionTreeRegressionModel | Tree, ...]
    errors: tuple[float, ...]

    @property
    def importances(self) -> np.ndarray:
        """Normalised gain per feature, summed over the trees and normalised again."""
        total = sum(t.featureImportances.toArray() for t in self.trees)
        return total / total.sum() if total.sum() else total


def best_iteration(errors: Sequence[float], patience: int) -> int:
    """Number of trees at the least error, where the search stops once ``patience``
    further trees have not bettered it."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def boost(rows: DataFrame, settings: Settings, rounds: int, patience: int | None = None) -> Boosted:
    """Up to ``rounds`` trees, each fitted to what the ones before it leave, all shrunk by the
    learning rate, from the mean on.

    ``rows``: features, target and ``held_out``; trees see the rows not held out. With
    ``patience`` the mean absolute error on the held-out rows is taken after every tree, and
    fitting ends (with the trees of the best round) once so many trees have not bettered it.
    The latest trees add their steps to the running forecast, a column of ``rows``; every
    ``CHECKPOINT_EVERY`` trees it is written to the checkpoint folder and cached from there.
    ``rows`` are read several times a tree and not copied: the caller keeps them at hand.
    """
    learner = DecisionTreeRegressor(
        featuresCol="features",
        labelCol="_left",
        predictionCol="_step",
        maxDepth=settings.tree_depth,
        seed=settings.model_seed,
    )
    base = rows.filter(~F.col("held_out")).agg(F.avg("target")).first()[0]
    now = rows.withColumn("_sum", F.lit(float(base or 0.0)))
    trees, errors, recent = [], [], []
    try:
        while len(trees) < rounds:
            left = _moved(now, recent, settings).filter(~F.col("held_out"))
            tree = learner.fit(
                left.select("features", (F.col("target") - F.col("_moved")).alias("_left"))
            )
            trees.append(tree)
            recent.append(tree)
            moved = _moved(now, recent, settings)
            if patience is not None:
                miss = F.avg(F.abs(F.col("target") - F.col("_moved")))
                errors.append(moved.filter("held_out").agg(miss).first()[0])
                if len(errors) - best_iteration(errors, patience) >= patience:
                    break
            if len(recent) == CHECKPOINT_EVERY:
                kept = moved.select("features", "target", "held_out", F.col("_moved").alias("_sum"))
                after = kept.checkpoint(eager=True)
                now.unpersist()
                now, recent = after.persist(), []
    finally:
        now.unpersist()
    if errors:
        trees = trees[: best_iteration(errors, patience)]
    return Boosted(float(base or 0.0), settings.learning_rate, tuple(trees), tuple(errors))


def boost_many(fit: Fit, settings: Settings, rounds: int, patience: int | None = None) -> Boosted:
    """``boost`` of many rows, which are binned once for all trees, by histograms of their bins."""
    trees, errors = boost_binned(
        fit,
        rounds,
        patience,
        settings.tree_depth,
        settings.learning_rate,
        lambda found, wait: len(found) - best_iteration(found, wait) >= wait,
        CHECKPOINT_EVERY,
    )
    if errors:
        trees = trees[: best_iteration(errors, patience)]
    return Boosted(fit.base, settings.learning_rate, tuple(trees), tuple(errors))


def _moved(now: DataFrame, trees: Sequence[DecisionTreeRegressionModel], settings: Settings) -> DataFrame:
    """``now`` with its running forecast moved on by ``trees``, as ``_moved``."""
    moved = F.col("_sum")
    for i, tree in enumerate(trees):
        now = tree.setPredictionCol(f"_step{i}").transform(now)
        moved = moved + F.lit(settings.learning_rate) * F.col(f"_step{i}")
    return now.withColumn("_moved", moved)


def tree_sql(tree: DecisionTreeRegressionModel | Tree, features: Sequence[str]) -> str:
    """A fitted tree as a nested CASE over the expressions of its features."""
    if isinstance(tree, Tree):
        return tree.sql(features)
    lines = iter(tree.toDebugString.splitlines()[1:])

    def node() -> str:
        line = next(lines).strip()
        if line.startswith("Predict:"):
            return f"{float(line.split()[1])!r}D"
        feature, bound = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        below = node()
        next(lines)  # the Else line
        return f"CASE WHEN {features[int(feature)]} <= {float(bound)!r}D THEN {below} ELSE {node()} END"

    return node()


def as_model(boosted: Boosted, names: Sequence[str]) -> PipelineModel:
    """The trees as one expression over the feature columns, which adds ``prediction``: it
    scores inside code generation, in batch and in streams, and is saved as one stage."""
    quoted = [f"`{n}`" for n in names]
    steps = " + ".join(f"({tree_sql(t, quoted)})" for t in boosted.trees) or "0.0D"
    value = f"{boosted.base!r}D + {boosted.rate!r}D * ({steps})"
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {value} AS prediction FROM __THIS__")])


def assembler(names: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(names), outputCol="features")


def training_rows(features: DataFrame, spec: PanelSpec, settings: Settings = Settings()) -> DataFrame:
    """Keys, time, features and target, written once as Parquet columns in the order they are made
    in, with the number ``_line`` of each row: neighbouring rows share most values, so that is a
    fraction of their size as vectors, and the wide rows are not shuffled for it."""
    spark = features.sparkSession
    names = feature_names(spec, settings)
    lines = features.select(
        *spec.keys, spec.ts, *names, "target", F.monotonically_increasing_id().alias("_line")
    )
    path = scratch_path(spark, "training-rows")
    lines.write.parquet(path)
    return spark.read.schema(lines.schema).parquet(path)


def with_cuts(
    written: DataFrame,
    spec: PanelSpec,
    settings: Settings,
    embargo: int = 0,
    max_rows: int | None = None,
) -> DataFrame:
    """``training_rows`` with their ``_place`` in their panel (time, then line) and the places
    ``_from_<fold>`` and ``_until_<fold>`` at which a fold's held-out rows begin and, ``embargo``
    rows before them, its known ones end.

    Only keys and places are shuffled and counted; a panel's few places are joined to its rows.
    """
    place = F.struct(spec.ts, "_line")
    narrow = written.select(*spec.keys, spec.ts, "_line")
    placed = row_index(narrow, spec.keys, [spec.ts, "_line"], "_pos", "_n", max_rows=max_rows)
    block = F.call_function("div", F.col("_n"), F.lit(settings.walk_forward_folds))
    cuts = []
    for fold in range(1, settings.walk_forward_folds):
        start = block * F.lit(fold)
        for name, position in (("_from", start), ("_until", start - F.lit(embargo))):
            here = F.col("_pos") == F.greatest(position, F.lit(0))
            cuts.append(F.max(F.when(here, place)).alias(f"{name}_{fold}"))
    of = [F.col(k).alias(f"_of_{k}") for k in spec.keys]
    side = checkpointed(placed.groupBy(*of).agg(*cuts))
    side = F.broadcast(side) if side.count() <= BROADCAST_ROWS else side
    same = F.lit(True)
    for k in spec.keys:  # a null panel has folds as well
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    rows = written.withColumn("_place", place)
    return rows.join(side, same).drop(*[f"_of_{k}" for k in spec.keys])


def fit_walk_forward(
    features: DataFrame,
    spec: PanelSpec,
    settings: Settings = Settings(),
    embargo: int = 0,
    max_rows: int | None = None,
) -> Trained:
    """``fit_folds`` of the features, which are written once."""
    return fit_folds(training_rows(features, spec, settings), spec, settings, embargo, max_rows)


def fit_folds(
    written: DataFrame,
    spec: PanelSpec,
    settings: Settings = Settings(),
    embargo: int = 0,
    max_rows: int | None = None,
) -> Trained:
    """Expanding folds with early stopping, then a final model on all ``training_rows``.

    Every fold adds trees until ``settings.patience`` of them have not bettered the mean
    absolute error on its held-out rows. Folds are cut by each panel's own row position, so
    every panel is validated on its own later rows. The final model gets as many trees as
    the folds needed on average.

    The folds are fitted side by side. ``FEW_ROWS`` are cached and fitted by Spark ML; more are
    read from the file and binned once for all fits, which keep their bins while they run
    (``boost_many``).
    """
    spark = written.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    names = feature_names(spec, settings)
    n_rows = written.count()
    few = n_rows <= FEW_ROWS
    places = [f"{n}_{f}" for f in range(1, settings.walk_forward_folds) for n in ("_from", "_until")]
    cut = with_cuts(written, spec, settings, embargo, max_rows)

    def parts(fold: int) -> tuple[Column, Column]:
        last = fold == settings.walk_forward_folds - 1
        place = F.col("_place")
        held_out = place >= F.col(f"_from_{fold}")
        before_end = F.lit(True) if last else place < F.col(f"_from_{fold + 1}")
        return held_out, before_end & (held_out | (place < F.col(f"_until_{fold}")))

    folds_of = range(1, settings.walk_forward_folds)
    if few:
        kept = assembler(names).transform(cut).select("_place", *places, "features", "target").persist()
        # a round is a dozen small jobs: no more tasks than the rows are worth
        rows = kept.coalesce(n_rows // ROWS_PER_TASK + 1)
    else:
        rows = cut
        roles = [F.when(taken, held.cast("int")) for held, taken in map(parts, folds_of)]
        draw = F.xxhash64(*spec.keys, spec.ts, F.lit(settings.model_seed))
        kept, fits = fits_of(rows, names, [*roles, F.lit(KNOWN)], draw)

    def fit_fold(fold: int) -> tuple:
        held_out, taken = parts(fold)
        if few:
            part = rows.filter(taken).select("features", "target", held_out.alias("held_out"))
            boosted = boost(part, settings, settings.trees, settings.patience)
            known = part.filter("not held_out").count()
            values = [F.col("_x")[i].alias(n) for i, n in enumerate(names)]
            flat = part.withColumn("_x", vector_to_array("features")).select("target", "held_out", *values)
            return fold, known, boosted, flat.filter("held_out")
        boosted = boost_many(fits[fold - 1], settings, settings.trees, settings.patience)
        return fold, fits[fold - 1].n, boosted, rows.filter(taken & held_out).select("target", *names)

    try:
        with ThreadPool(max(1, len(folds_of))) as pool:
            fit = inheritable_thread_target(spark)(fit_fold)
            fitted = pool.map(fit, folds_of)
        found = []
        for fold, known, boosted, held in fitted:
            scored = as_model(boosted, names).transform(held)
            errors = error_table(scored, [], "target", "prediction").first()
            found.append(
                (
                    fold,
                    known,
                    errors["n_samples"],
                    len(boosted.trees),
                    errors["mae"],
                    errors["rmse"],
                    errors["mape"],
                )
            )
        folds = spark.createDataFrame(found, FOLD_SCHEMA)
        trees = max(1, int(sum(f[3] for f in found) / max(1, len(found))))
        if few:
            final = boost(
                rows.select("features", "target", F.lit(False).alias("held_out")), settings, trees
            )
        else:
            final = boost_many(fits[-1], settings, trees)
    finally:
        kept.unpersist()
    return Trained(
        as_model(final, names), folds, n_rows, tuple(names), tuple(map(float, final.importances))
    )


def score(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds ``prediction``; a map over rows, the same in batch and in a stream."""
    return model.transform(features).drop("features")


def feature_importances(spark: SparkSession, trained: Trained) -> DataFrame:
    """Normalised gain per feature."""
    return spark.createDataFrame(
        list(zip(trained.names, trained.importances)), "feature string, importance double"
    )


def top_features(importances: DataFrame, n: int = 15) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(n)


def _as_list(df: DataFrame, name: str) -> DataFrame:
    """A short table as one row with one array of structs."""
    return df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias(name))


def _side_by_side(parts: Sequence[DataFrame]) -> DataFrame:
    """One-row tables as one row."""
    out = parts[0].withColumn("_one", F.lit(1))
    for part in parts[1:]:
        out = out.join(F.broadcast(part.withColumn("_one", F.lit(1))), "_one")
    return out.drop("_one")


def train(
    panel: DataFrame,
    spec: PanelSpec,
    settings: Settings = Settings(),
    max_rows: int | None = None,
) -> tuple[Trained, DataFrame]:
    """Split, features of the train part, walk-forward fit; model and baseline scores.

    The panel is read and its features are made once, for the fit and the scores."""
    parts = chrono_split(panel, spec.keys, [spec.ts], settings.train_ratio, max_rows)
    known = build_features(
        parts.filter(F.col("split") == "train"), spec, settings, max_rows=max_rows
    )
    written = training_rows(known, spec, settings)
    trained = fit_folds(written, spec, settings, max_rows=max_rows)
    scores = evaluate_baselines(
        written,
        spec.keys,
        [spec.ts],
        "target",
        f"{spec.target}_lag_1",
        max_rows=max_rows,
        by=[],
    )
    baselines = panel.sparkSession.createDataFrame(scores.collect(), scores.schema)
    return trained, baselines


def training_report(
    spark: SparkSession, trained: Trained, baselines: DataFrame, model_path: str
) -> DataFrame:
    """One row: sizes, fold results, averages, importances, baselines."""
    importances = _as_list(feature_importances(spark, trained), "_i").select(
        F.map_from_entries("_i").alias("feature_importances")
    )
    head = spark.createDataFrame(
        [(trained.n_rows, len(trained.names), list(trained.names), model_path)],
        "n_training_rows long, n_features int, feature_names array<string>, model_path string",
    )
    averages = fold_averages(trained.folds)
    return _side_by_side(
        [
            head,
            _as_list(trained.folds, "fold_results"),
            averages.select(
                F.struct("mae", "rmse", "mape").alias("average_metrics"), "average_best_iteration"
            ),
            importances,
            _as_list(baselines, "baseline_results"),
        ]
    )


def holdout_features(
    panel: DataFrame,
    spec: PanelSpec,
    settings: Settings = Settings(),
    carry_history: bool = False,
    max_rows: int | None = None,
) -> DataFrame:
    """Features of the stream part, with its row number as ``sequence_id``.

    By default the part stands alone and loses its own warm-up rows;
    ``carry_history`` lets its first rows look back into the train part.
    """
    parts = chrono_split(panel, spec.keys, [spec.ts], settings.train_ratio, max_rows)
    source = parts if carry_history else parts.filter(F.col("split") == "stream")
    made = build_features(
        source.withColumnRenamed("split_index", "sequence_id"),
        spec,
        settings,
        keep=("split", "sequence_id", spec.target),
        max_rows=max_rows,
    )
    return made.filter(F.col("split") == "stream").drop("split")


def forecast(
    features: DataFrame,
    model: PipelineModel,
    spec: PanelSpec,
    settings: Settings = Settings(),
    align: str = "next_row",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Two-stage results of the model, with the columns ``carry`` of the features.

    ``next_row`` scores the forecast made at t against the load it forecasts;
    ``same_row`` against the load at t.
    """
    if align not in ("next_row", "same_row"):
        raise ValueError("align must be 'next_row' or 'same_row'")
    actual = F.col("target") if align == "next_row" else F.col(spec.target)
    return two_stage(
        score(features, model),
        F.col("prediction"),
        actual,
        F.col("sequence_id"),
        settings=settings,
        keep=(*spec.keys, spec.ts, *carry),
    )


def evaluation_report(
    results: DataFrame,
    spec: PanelSpec,
    series: str,
    max_rows: int | None = None,
    measured_latency: bool = False,
) -> DataFrame:
    """One row: rows, load and price errors, latency (null unless ``latency_ns`` was measured), baselines, whether all are beaten.

    ``results`` carry the column ``series`` that the baselines shift. Model, price and
    baselines are scored by one aggregate over one pass.
    """
    rows = with_baselines(results, spec.keys, [spec.ts], series, max_rows=max_rows)
    pairs = {
        "load": ("load_actual_mw", "load_forecast_mw"),
        "price": ("price_actual_usd_mwh", "price_forecast_usd_mwh"),
    } | {name: ("load_actual_mw", name) for name in BASELINES}
    aggregates = []
    for name, (actual, predicted) in pairs.items():
        a, p = F.col(actual), F.col(predicted)
        scored = F.when(p.isNotNull(), a) if name in BASELINES else a
        aggregates += M.error_metrics(scored, p, f"{name}_")
        aggregates.append(M.n_samples(a, p).alias(f"{name}_n"))
    errors = rows.agg(*aggregates)

    def shape(name: str) -> list[Column]:
        return [F.col(f"{name}_{m}").alias(m) for m in ("mae", "rmse", "mape")]

    scores = [
        F.struct(F.lit(b).alias("baseline"), *shape(b), F.col(f"{b}_n").alias("n_samples"))
        for b in BASELINES
    ]
    wins = F.lit(True)
    for b in BASELINES:
        wins = wins & (F.col("load_mae") < F.col(f"{b}_mae"))
    unknown = [F.lit(None).cast("double").alias(n) for n in M.LATENCY_NAMES]
    report = errors.select(
        F.col("load_n").alias("evaluation_set_rows"),
        F.struct(*shape("load")).alias("load"),
        F.struct(*shape("price")).alias("price"),
        F.struct(*unknown).alias("latency"),
        F.sort_array(F.array(*scores)).alias("baseline_results"),
        wins.alias("model_beats_all_baselines"),
    )
    if "latency_ns" in results.columns and measured_latency:
        timed = exact_percentiles(results.withColumn("_all", F.lit(1)), ["_all"], "latency_ns")
        timed = timed.select(F.struct(*M.LATENCY_NAMES).alias("latency"))
        report = _side_by_side([report.drop("latency"), timed])
    return report
