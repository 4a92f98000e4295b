"""Feature encoding, the forest and what it says about single features."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelloom.functions.metrics import signal_label
from panelloom.modelling.grow import covered, grow
from panelloom.operators.cross_section import cross_section_zscore
from panelloom.schema import FOREST, KEY, TIME, WEAK_PREDICTORS, financial_columns, flag_columns
from panelloom.session import stage

LABEL = "Target_Top_Quintile"
NOT_PREDICTORS = [
    "MonthlyExcessReturn_Quantile", "Target_Top_Quintile", "Open", "Close", "AverageDailyVolume_Lag1",
    "Ticker", "FinancialsSource",
]


def predictors(df, excluded=WEAK_PREDICTORS + NOT_PREDICTORS, group=(TIME, "Sector")):
    """(numeric, categorical) predictor names after the exclusions."""
    out = set(financial_columns()) | set(flag_columns(df)) | set(excluded)
    numbers = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    left = [(n, kind) for n, kind in df.dtypes if n not in out and n != group[0]]
    return ([n for n, kind in left if kind in numbers and n not in group],
            [n for n, kind in left if kind == "string"])


def scale_features(df, numeric, group=(TIME, "Sector"), min_samples=5):
    """Cross-sectional z-scores; months are independent, so history and live rows may go together."""
    return cross_section_zscore(df, numeric, group, min_samples)


def encoder(numeric, categorical):
    """One-hot codes of the categorical predictors behind the numeric ones, as one vector."""
    codes = [f"{c}_code" for c in categorical]
    hot = [f"{c}_hot" for c in categorical]
    return Pipeline(stages=[
        StringIndexer(inputCols=categorical, outputCols=codes, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=codes, outputCols=hot, dropLast=False),
        VectorAssembler(inputCols=[*numeric, *hot], outputCol="features"),
    ])


def class_counts(df, label=LABEL):
    """Rows by class: a few numbers."""
    return {row[label]: row["count"] for row in df.groupBy(label).count().collect()}


def class_weights(df, label=LABEL, counts=None):
    """Add ``weight`` = n / (classes x rows of the class)."""
    counts = counts or class_counts(df, label)
    n = sum(counts.values())
    weight = F.coalesce(*[F.when(F.col(label) == k, F.lit(n / (len(counts) * c))) for k, c in counts.items()])
    return df.withColumn("weight", weight)


def fit_forest(encoded, label=LABEL, **params):
    """Balanced random forest on an encoded frame, read a few times; its keys decide the draws, not its layout.

    Spark grows it only where a feature has more than two categories, which the ``encoder`` never gives.
    """
    settings = {**FOREST, **params}
    forest = RandomForestClassifier(
        labelCol=label, featuresCol="features", weightCol="weight", **settings)
    counts, meta = class_counts(encoded, label), encoded.schema["features"].metadata.get("ml_attr", {})
    if "attrs" in meta and covered(meta["attrs"]):
        return grow(forest, encoded, counts)
    return forest.fit(class_weights(encoded, label, counts))


def probability_of(target=1):
    """Classes are 0..k-1 in the probability vector."""
    return vector_to_array("probability")[target]


def rank_scores(scored, probability, target=1, key=KEY):
    """Predicted class, probability of the target class and signal of scored rows, best first; ties by key."""
    return scored.select(
        key, F.col("prediction").cast("int").alias("Predicted_Class"), probability.alias("Probability_Top"),
    ).withColumn("Signal", signal_label("Predicted_Class", target)).orderBy(F.desc("Probability_Top"), key)


def ranked_predictions(model, encoded_live, target=1, key=KEY):
    """``rank_scores`` of a model's predictions."""
    return rank_scores(model.transform(encoded_live), probability_of(target), target, key)


def feature_names(encoded, column="features"):
    """Names by vector position, from the assembler's metadata."""
    attributes = encoded.schema[column].metadata["ml_attr"]["attrs"]
    named = {a["idx"]: a["name"] for kind in attributes.values() for a in kind}
    return [named[i] for i in range(len(named))]


def feature_importance(spark, model, names):
    """One row per feature; the table is as long as the feature vector."""
    values = model.featureImportances.toArray()
    rows = [(name, float(value)) for name, value in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")
