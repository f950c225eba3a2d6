"""Scoring predictions against references, and comparing two models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import edits, overlap_scores, rouge_scores

METRICS = ("rouge1", "rouge2", "rougeL", "levenshtein_normalized", "levenshtein_avg")
LOWER_IS_BETTER = ("levenshtein_avg",)


def paired(predictions: DataFrame, references: DataFrame, key: str = "example_idx") -> DataFrame:
    """predictions(key, prediction) and references(key, reference) joined one to one. A key on one side alone, twice on a side, or null is an error when it is read. A null prediction (a failure) is an empty text."""
    return _checked(references, {"prediction": predictions}, key).select(key, "prediction", "reference")


def _once(side: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """key, the value of a row with it, and how many rows have it. The join after it finds the rows already dealt by the key."""
    return side.groupBy(F.col(key).alias(key)).agg(F.struct(F.max(value).alias(value), F.count(F.lit(1)).alias("n")).alias(f"of_{name}"))


def _checked(references: DataFrame, sides: dict[str, DataFrame], key: str) -> DataFrame:
    """key, reference and a column for the predictions of each side. All are dealt by the key once."""
    out = _once(references, key, "reference", "references")
    for name, side in sides.items():
        out = out.join(_once(side, key, "prediction", name), key, "full_outer")
    every = [f"of_{name}" for name in ("references", *sides)]
    missing, repeated = F.lit(False), F.lit(False)
    for name in every:
        missing |= F.col(name).isNull()
        repeated |= F.coalesce(F.col(name)["n"], F.lit(0)) > 1
    shown = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    # On the reference, which every use reads.
    reference = F.when(repeated, F.raise_error(F.concat(F.lit("several rows for example "), shown))).when(missing, F.raise_error(F.concat(F.lit("no pair for example "), shown))).otherwise(F.coalesce("of_references.reference", F.lit("")))
    texts = [F.coalesce(f"of_{name}.prediction", F.lit("")).alias(name) for name in sides]
    return out.select(key, reference.alias("reference"), *texts)


def scored(pairs: DataFrame, stemmed: bool = True) -> DataFrame:
    """pairs(prediction, reference) with each metric of each pair. Plain scores don't stem and leave ROUGE-L out."""
    p, r = F.col("prediction"), F.col("reference")
    made = pairs.select(F.struct("*").alias("pair"), (rouge_scores if stemmed else overlap_scores).asNondeterministic()(p, r).alias("grams"), edits.asNondeterministic()(p, r).alias("edits"))
    return made.select("pair.*", "grams.*", F.col("edits.distance").cast("double").alias("levenshtein_avg"), F.col("edits.similarity").alias("levenshtein_normalized"))


def averaged(scores: DataFrame) -> DataFrame:
    """metric, value: the mean of each metric, 0 if there are no rows."""
    names = [m for m in METRICS if m in scores.columns]
    means = scores.agg(*[F.coalesce(F.avg(m), F.lit(0.0)).alias(m) for m in names])
    return means.unpivot([], names, "metric", "value")


def comparison(references: DataFrame, base: DataFrame, tuned: DataFrame, key: str = "example_idx", stemmed: bool = True) -> DataFrame:
    """metric, base, finetuned, improvement_pct: both models' predictions joined with the references and scored in one pass."""
    both = _checked(references, {"base": base, "finetuned": tuned}, key)
    sides = [F.struct(F.lit(x).alias("side"), F.col(x).alias("prediction"), "reference") for x in ("base", "finetuned")]
    scores = scored(both.select(F.explode(F.array(*sides)).alias("x")).select("x.*"), stemmed)
    names = [m for m in METRICS if m in scores.columns]
    means = scores.groupBy("side").agg(*[F.avg(m).alias(m) for m in names]).unpivot("side", names, "metric", "value")
    value = lambda x: F.coalesce(F.max(F.when(F.col("side") == x, F.col("value"))), F.lit(0.0)).alias(x)
    every = references.sparkSession.createDataFrame([(m,) for m in names], "metric string")
    table = every.join(means, "metric", "left").groupBy("metric").agg(value("base"), value("finetuned"))
    return table.withColumn("improvement_pct", improvement("metric", "base", "finetuned"))


def improvement(metric: str, base: str, tuned: str):
    """Percent better than the base; less is better for distances; 0 if the base is not positive."""
    b, t = F.col(base), F.col(tuned)
    gain = F.when(F.col(metric).isin(*LOWER_IS_BETTER), b - t).otherwise(t - b)
    return F.when(b > 0, gain * 100.0 / b).otherwise(0.0)


def compared(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """metric, base, finetuned, improvement_pct of two results of ``averaged``."""
    joined = base.withColumnRenamed("value", "base").join(tuned.withColumnRenamed("value", "finetuned"), "metric")
    return joined.withColumn("improvement_pct", improvement("metric", "base", "finetuned"))


def samples(references: DataFrame, base: DataFrame, tuned: DataFrame, key: str = "example_idx") -> DataFrame:
    """key, reference, base_prediction, finetuned_prediction, paired one to one as in ``paired``."""
    return _checked(references, {"base_prediction": base, "finetuned_prediction": tuned}, key)
