"""Fit and score with Spark ML estimators; all take a table with a feature vector and a label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators import cells, level_trees
from tablewright.operators.classify import binary_metrics, multiclass_accuracy, with_auc
from tablewright.operators.evaluate import regression_metrics
from tablewright.operators.sampling import class_weights
from tablewright.operators.skew import held, spread_out
from tablewright.session import pin, small_table


def assembled(df: DataFrame, xs: Sequence[str], *keep: str) -> DataFrame:
    """Kept columns and a feature vector, spread over the cores if the input is one small file."""
    df = spread_out(df.select(*keep, *[x for x in xs if x not in keep]))
    return VectorAssembler(inputCols=list(xs), outputCol="features").transform(df).select(*keep, "features")


def class_probability(pred: DataFrame, column: str = "probability", out: str = "score") -> DataFrame:
    """Probability of class 1 as a plain column."""
    return pred.withColumn(out, vector_to_array(column)[1])


def fit_score(estimator, train: DataFrame, test: DataFrame, count: str | None = None) -> DataFrame:
    """Accuracy, precision, recall, F1 and AUC on the hold-out as one row.

    ``count`` names a column with the number of rows that each row stands for, in both tables.
    """
    if count:
        estimator = estimator.setWeightCol(count)
    with held(train) as data:
        pred = estimator.fit(data).transform(test)
    raw = "probability" if "probability" in pred.columns else "rawPrediction"
    return with_auc(class_probability(pred, raw).select("label", "prediction", "score", *([count] if count else [])), "score", count=count)


def tree_split(df: DataFrame, xs: Sequence[str], bins: int = 32, seed: int = 7) -> tuple[DataFrame, DataFrame, str | None]:
    """Training and test rows (column ``part``) with label and feature vector, and no count; of a long table its counted
    cells, and the column of their counts, so that a fit of many passes reads the rows twice and the cells each time."""
    if df.count() <= cells.MANY:
        rows, count = assembled(df, xs, "label", "part"), None
    else:
        drawn = cells.sampled(df.filter("part = 'train'"), xs, bins, seed)
        cuts = [cells.cut_points(v, bins) for v in drawn.T]
        rows, count = pin(cells.counted_cells(df, xs, cuts, ["label", "part"])), cells.COUNT
    return rows.filter("part = 'train'"), rows.filter("part = 'test'"), count


def logistic_regression(train: DataFrame, test: DataFrame, weighted: bool = True) -> DataFrame:
    est = LogisticRegression(maxIter=50)
    if weighted:
        train = class_weights(train, "label")
        est = est.setWeightCol("weight")
    return fit_score(est, train, test)


def logit_inference(train: DataFrame, xs: Sequence[str]) -> DataFrame:
    """(position, feature, coef) by falling size of the coefficient on standardised features."""
    from tablewright.operators.features import scale_standard

    scaled = scale_standard(train, train, xs)
    model = LogisticRegression(maxIter=50, standardization=False).fit(assembled(scaled, xs, "label"))
    ranked = sorted(zip(xs, model.coefficients), key=lambda c: -abs(c[1]))
    rows = [(i + 1, n, float(c)) for i, (n, c) in enumerate(ranked)]
    return small_table(train.sparkSession, rows, "position int, feature string, coef double")


def decision_tree(train, test, impurity="gini", depth=5, min_leaf=1, seed=7) -> DataFrame:
    return fit_score(
        DecisionTreeClassifier(impurity=impurity, maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed), train, test
    )


def random_forest(train, test, trees=20, depth=5, subset="auto", bins=32, seed=7) -> DataFrame:
    return fit_score(
        RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy=subset, maxBins=bins, seed=seed),
        train,
        test,
    )


def bagging_trees(train, test, trees=50, depth=5, seed=7) -> DataFrame:
    """Bootstrap trees that see all features."""
    return random_forest(train, test, trees, depth, "all", seed=seed)


def extra_trees(train, test, trees=30, depth=6, seed=7) -> DataFrame:
    """Trees cut at random thresholds, grown level by level (``level_trees.grow``)."""
    with held(train) as data:
        model = level_trees.grow(data, trees, depth, seed=seed)
    pred = model.transform(test).withColumn("score", F.get("probability", F.lit(1)))
    return with_auc(pred.select("label", "prediction", "score"), "score")


def gradient_boosting(train, test, rounds=10, depth=3, seed=7, count: str | None = None) -> DataFrame:
    est = GBTClassifier(maxIter=rounds, maxDepth=depth, seed=seed)
    return fit_score(est.setMaxBins(cells.all_seen(train)) if count else est, train, test, count)


def gradient_boosting_multi(train, test, rounds=5, depth=3, seed=7, count: str | None = None) -> DataFrame:
    """One boosted model per class against the rest."""
    boosted = GBTClassifier(maxIter=rounds, maxDepth=depth, seed=seed)
    est = OneVsRest(classifier=boosted, parallelism=4)
    if count:
        boosted.setMaxBins(cells.all_seen(train))
        est = est.setWeightCol(count)
    with held(train) as data:
        model = est.fit(data)
    return multiclass_accuracy(model.transform(test), count=count)


def gbt_multi_target(train: DataFrame, test: DataFrame, targets: Sequence[str], rounds=8, depth=3, seed=7) -> DataFrame:
    """(target, n, mae, mse, rmse, r2, adj_r2): one boosted regressor per target."""
    out = None
    with held(train) as data:
        models = {
            y: GBTRegressor(labelCol=y, predictionCol="_p", maxIter=rounds, maxDepth=depth, seed=seed).fit(data)
            for y in targets
        }
    for y, model in models.items():
        row = regression_metrics(model.transform(test), y, "_p").select(F.lit(y).alias("target"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def naive_bayes(train, test, kind="gaussian") -> DataFrame:
    return multiclass_accuracy(NaiveBayes(modelType=kind).fit(train).transform(test))


def linear_svc(train, test) -> DataFrame:
    return fit_score(LinearSVC(maxIter=30, regParam=0.01), train, test)


def kernel_svc(train: DataFrame, test: DataFrame, key: str, vec: str, kernel: str, param: float, landmarks: int = 32) -> DataFrame:
    """Accuracy of a kernel machine for several classes: linear machines, one class against the
    rest, on a kernel map by landmark rows. ``vec`` is an array column; rows have a ``label``."""
    from pyspark.ml.classification import OneVsRest
    from pyspark.ml.functions import array_to_vector

    from tablewright.operators.features import nystrom_map

    lift = nystrom_map(train, key, vec, landmarks, kernel, param)
    mapped = [pin(df.withColumn("features", array_to_vector(lift(vec))).select("label", "features")) for df in (train, test)]
    with held(mapped[0]) as data:
        model = OneVsRest(classifier=LinearSVC(maxIter=12, regParam=0.001), parallelism=4).fit(data)
    return multiclass_accuracy(model.transform(mapped[1]))


def mlp_classifier(train, test, layers: Sequence[int], seed=7) -> DataFrame:
    return multiclass_accuracy(
        MultilayerPerceptronClassifier(layers=list(layers), maxIter=40, seed=seed, blockSize=128).fit(train).transform(test)
    )


def feature_importance(df: DataFrame, xs: Sequence[str], label: str, trees=15, seed=7) -> dict[str, float]:
    model = RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=5, seed=seed).fit(assembled(df, xs, label))
    return dict(zip(xs, map(float, model.featureImportances.toArray())))


def grid_search_cv(train: DataFrame, folds: int = 3, seed: int = 7) -> DataFrame:
    """(depth, bins, auc, best) of a decision-tree grid, points fitted side by side."""
    est = DecisionTreeClassifier(seed=seed)
    grid = ParamGridBuilder().addGrid(est.maxDepth, [2, 5]).addGrid(est.maxBins, [8, 32]).build()
    search = CrossValidator(
        estimator=est, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=folds,
        seed=seed, parallelism=4,
    )
    with held(train) as data:
        cv = search.fit(data)
    points = [(p[est.maxDepth], p[est.maxBins]) for p in grid]
    return _search_table(train.sparkSession, points, cv.avgMetrics)


def grid_search_cells(train: DataFrame, xs: Sequence[str], folds: int = 3, seed: int = 7) -> DataFrame:
    """``grid_search_cv`` of a long table with plain feature columns: each fold's rows become counted cells once for
    every number of bins, by thresholds from the rows outside the fold, and all fits and scores read these."""
    # A fold is an equal range of random numbers, as in CrossValidator.
    rows = train.withColumn("_fold", F.floor(F.rand(seed) * folds))
    evaluator = BinaryClassificationEvaluator(weightCol=cells.COUNT)

    def fold_scores(run: tuple[int, int]) -> list[float]:
        k, bins = run
        drawn = cells.sampled(rows.filter(F.col("_fold") != k), xs, bins, seed)
        cuts = [cells.cut_points(v, bins) for v in drawn.T]
        mine = (F.col("_fold") == k).alias("mine")
        counted = pin(cells.counted_cells(rows.select("label", *xs, mine), xs, cuts, ["label", "mine"]))
        outside = counted.filter(~F.col("mine"))
        est = DecisionTreeClassifier(seed=seed, weightCol=cells.COUNT, maxBins=cells.all_seen(outside, bins))
        with held(outside) as data:
            models = [est.setMaxDepth(depth).fit(data) for depth in depths]
        return [evaluator.evaluate(m.transform(counted.filter("mine"))) for m in models]

    depths, sizes = [2, 5], [8, 32]
    runs = [(k, bins) for bins in sizes for k in range(folds)]
    with ThreadPool(2) as pool:
        scores = dict(zip(runs, pool.map(inheritable_thread_target(train.sparkSession)(fold_scores), runs)))
    points = [(depth, bins) for depth in depths for bins in sizes]
    means = [sum(scores[k, bins][depths.index(depth)] for k in range(folds)) / folds for depth, bins in points]
    return _search_table(train.sparkSession, points, means)


def _search_table(spark: SparkSession, points: Sequence[tuple[int, int]], metrics: Sequence[float]) -> DataFrame:
    best = max(metrics)
    rows = [(depth, bins, float(m), int(m == best)) for (depth, bins), m in zip(points, metrics)]
    return small_table(spark, rows, "depth int, bins int, auc double, best int")


def cross_val_scores(df: DataFrame, estimator, folds: int, fold: str = "fold") -> DataFrame:
    """(fold, n, accuracy, precision, recall, f1) for given fold numbers."""
    out = None
    with held(df) as data:
        models = [estimator.fit(data.filter(F.col(fold) != k)) for k in range(folds)]
    for k, model in enumerate(models):
        pred = model.transform(df.filter(F.col(fold) == k))
        row = binary_metrics(pred).select(F.lit(k).alias("fold"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def compare_models(models: Mapping[str, object], train: DataFrame, test: DataFrame) -> DataFrame:
    """(model, n, accuracy, precision, recall, f1, best): best by accuracy, ties by name."""
    out = None
    with held(train) as data:
        fitted = {name: est.fit(data) for name, est in models.items()}
    for name, model in fitted.items():
        row = binary_metrics(model.transform(test)).select(F.lit(name).alias("model"), "*")
        out = row if out is None else out.unionByName(row)
    best = out.agg(F.min_by("model", F.struct(-F.col("accuracy"), F.col("model")))).scalar()
    return out.withColumn("best", (F.col("model") == best).cast("int"))


def tabular_pipeline(numeric: Sequence[str], text: Sequence[str]) -> Pipeline:
    """Index the strings (unseen kept), then assemble everything."""
    stages = [StringIndexer(inputCols=list(text), outputCols=[f"{c}_ix" for c in text], handleInvalid="keep")] if text else []
    stages.append(
        VectorAssembler(inputCols=[*numeric, *[f"{c}_ix" for c in text]], outputCol="features", handleInvalid="keep")
    )
    return Pipeline(stages=stages)


def submission_table(pred: DataFrame, key: str, classes: Sequence[str], column: str = "probability") -> DataFrame:
    """Id first, then one probability column per class, ordered by id."""
    p = vector_to_array(column) if not str(pred.schema[column].dataType).startswith("Array") else F.col(column)
    return pred.select(key, *[p[i].alias(f"Status_{c}") for i, c in enumerate(classes)]).orderBy(key)
