"""Feature encoding, deterministic splits, weights, tree models, scoring and model inspection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.operators.ordering import order_statistics
from lossloom.operators.trees import walked_dependence

LABEL_LIMIT = 10_000
STRATA_LIMIT = 100


def categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast code columns to text, so that they are one-hot encoded; missing becomes a value of its own."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in columns})


def binary_target(df: DataFrame, target: str) -> DataFrame:
    """2 counts as 1, missing as 0."""
    return df.withColumn(target, F.coalesce(F.when(F.col(target) == 2, 1).otherwise(F.col(target)), F.lit(0)))


def encoder(df: DataFrame, texts: Sequence[str], numbers: Sequence[str], vectors: Sequence[str] = (),
            output: str = "features") -> Pipeline:
    """Text columns one-hot (all values kept), numbers mean-imputed, all in one vector.

    The distinct values of each text column are held by the driver, so their number is checked first.
    """
    stages = []
    if texts:
        sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in texts]).first()
        wide = [c for c in texts if sizes[c] > LABEL_LIMIT]
        if wide:
            raise ValueError(f"too many distinct values to encode: {wide}")
        stages.append(StringIndexer(inputCols=list(texts), outputCols=[f"{c}__i" for c in texts],
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=[f"{c}__i" for c in texts], outputCols=[f"{c}__v" for c in texts],
                                    dropLast=False))
    if numbers:
        stages.append(Imputer(strategy="mean", inputCols=list(numbers), outputCols=[f"{c}__n" for c in numbers]))
    inputs = [f"{c}__v" for c in texts] + [f"{c}__n" for c in numbers] + list(vectors)
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="keep"))
    return Pipeline(stages=stages)


def hash_bucket(key: Column, buckets: int = 100, seed: int = 398) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(buckets))


def split(df: DataFrame, key: str, share: float = 0.7, seed: int = 398,
          bucket: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) decided by the key alone, so it does not depend on partitioning or recomputation."""
    chosen = hash_bucket(F.col(key), 10_000, seed) if bucket is None else bucket
    return df.filter(chosen < int(share * 10_000)), df.filter(chosen >= int(share * 10_000))


def stratified_sample(df: DataFrame, stratum: str, share: float, order: Column) -> DataFrame:
    """Exactly round(share * n) rows of each stratum, those with the smallest order value.

    The cut-off per stratum is an order statistic; no stratum is sorted or gathered. `order` is a whole number
    without repeats inside a stratum, such as a hash of the key.
    """
    values = [r[0] for r in df.select(stratum).distinct().limit(STRATA_LIMIT + 1).collect()]
    if len(values) > STRATA_LIMIT:
        raise ValueError("too many strata")
    wanted = {
        f"s{i}": (F.when(F.col(stratum).eqNullSafe(v), order), lambda n: round(share * n) - 1) for i, v in enumerate(values)}
    cuts = order_statistics(df, wanted, value_type="bigint")
    keep = F.lit(False)
    for i, v in enumerate(values):
        if cuts[f"s{i}"] is not None:
            keep = keep | (F.col(stratum).eqNullSafe(v) & (order <= F.lit(cuts[f"s{i}"])))
    return df.filter(keep)


def fixed_weight(label: Column, positive: float = 39.0) -> Column:
    return F.when(label == 1, F.lit(positive)).otherwise(F.lit(1.0))


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """n / (classes * class size) for every row with a label, null for the others; the class table has one row per class."""
    sizes = {r[label]: r["n"] for r in df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(LABEL_LIMIT + 1).collect()}
    if not sizes or len(sizes) > LABEL_LIMIT:
        raise ValueError(f"{len(sizes)} classes; between 1 and {LABEL_LIMIT} are needed")
    total = sum(sizes.values())
    table = F.create_map(*[F.lit(x) for c, n in sizes.items() for x in (c, total / (len(sizes) * n))])
    return df.withColumn(name, F.try_element_at(table, F.col(label)))


def boosted_trees(label: str = "label", features: str = "features", weight: str | None = "weight", trees: int = 400,
                  depth: int = 4, rate: float = 0.05, leaf: int = 20, seed: int = 398) -> GBTClassifier:
    model = GBTClassifier(labelCol=label, featuresCol=features, maxIter=trees, maxDepth=depth, stepSize=rate,
                          minInstancesPerNode=leaf, seed=seed)
    return model.setWeightCol(weight) if weight else model


def forest(label: str = "label", features: str = "features", weight: str | None = "weight", trees: int = 100,
           depth: int = 30, seed: int = 1) -> RandomForestClassifier:
    """Gini forest; 30 is the deepest tree available."""
    model = RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=trees, impurity="gini", maxDepth=depth,
                                   featureSubsetStrategy="sqrt", seed=seed)
    return model.setWeightCol(weight) if weight else model


def grid_search(df: DataFrame, estimator, grid: Mapping[str, Sequence], label: str = "label", folds: int = 3,
                seed: int = 398) -> CrossValidatorModel:
    """Cross-validated choice over a parameter grid by area under the ROC curve."""
    builder = ParamGridBuilder()
    for parameter, values in grid.items():
        builder = builder.addGrid(estimator.getParam(parameter), list(values))
    evaluator = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="probability")
    return CrossValidator(estimator=estimator, estimatorParamMaps=builder.build(), evaluator=evaluator, numFolds=folds,
                          seed=seed, parallelism=2).fit(df)


def score(df: DataFrame, model, keep: Sequence[str], places: int | None = None) -> DataFrame:
    """Keys with predicted class and probability; the score never leaves its row."""
    probability = vector_to_array("probability")[1]
    return model.transform(df).select(
        *keep, F.col("prediction").cast("int").alias("predicted_class"),
        (probability if places is None else F.round(probability, places)).alias("predicted_prob"))


def feature_names(encoded: DataFrame, features: str = "features") -> list[str]:
    """Component names from the metadata of an assembled vector."""
    groups = encoded.schema[features].metadata["ml_attr"].get("attrs", {})
    entries = sorted((a for g in groups.values() for a in g), key=lambda a: a["idx"])
    return [a.get("name", str(a["idx"])) for a in entries]


def importance(encoded: DataFrame, model, features: str = "features") -> DataFrame:
    """(feature, importance) with the largest at 100, in descending order."""
    raw = model.featureImportances.toArray()
    top = raw.max() or 1.0
    names = feature_names(encoded, features) or [str(i) for i in range(len(raw))]
    rows = [(n, float(100.0 * v / top)) for n, v in zip(names, raw)]
    return encoded.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature")


def exploded_dependence(df: DataFrame, pipeline: PipelineModel, feature: str, grid: Sequence[float]) -> DataFrame:
    """(value, mean probability): every row is scored at every grid value, a short literal array exploded in place."""
    values = F.array(*[F.lit(float(v)) for v in grid])
    scored = pipeline.transform(df.drop(feature).withColumn(feature, F.explode(values)))
    return scored.groupBy(F.col(feature).alias("value")).agg(
        F.avg(vector_to_array("probability")[1]).alias("mean_probability"))


def partial_dependence(df: DataFrame, pipeline: PipelineModel, feature: str, points: int = 20) -> DataFrame:
    """(value, mean probability) of one input column over a grid between its 5th and 95th percentile.

    A number that `encoder` imputes is one component of the vector: rows are encoded once and walk through the trees of a boosted or
    forest model once. Other inputs and models are scored at every grid value.
    """
    low, high = df.agg(F.percentile_approx(feature, [0.05, 0.95], 10_000)).first()[0]
    step = (high - low) / max(points - 1, 1)
    grid = [float(low + i * step) for i in range(points)]
    *encoding, model = pipeline.stages
    encoded = PipelineModel(stages=encoding).transform(df)
    names = feature_names(encoded) if "features" in encoded.columns else []
    if f"{feature}__n" in names:
        walked = walked_dependence(encoded, "features", model, names.index(f"{feature}__n"), grid)
        if walked is not None:
            return walked
    return exploded_dependence(df, pipeline, feature, grid)
