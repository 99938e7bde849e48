"""Linear preference model, bulk scoring and learning curves."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions.keys import row_key
from pairloom.functions.token_counts import number_lists, text_pieces, token_counts, token_numbers
from pairloom.operators.evaluate import category_evaluation
from pairloom.operators.nested_fit import NestedFit, fit_nested
from pairloom.operators.subsample import fraction_membership
from pairloom.settings import CURVE_FRACTIONS, PreferenceModelSettings

BatchScorer = Callable[[pd.Series], pd.Series]

#: Text bytes of the rows that are handed to a scorer together.
SCORED_BYTES = 16_000_000


def add_text_features(df: DataFrame, text: str, features: str, num_buckets: int, portable: bool = False) -> DataFrame:
    """Hashed token counts plus the token count itself, as an array; row-local, in Arrow batches.

    Buckets are those of ``HashingTF``. ``portable`` takes a token's bucket from the first four md5 digits, which any
    SQL engine can compute.
    """

    @F.arrow_udf("array<double>")
    def counted(texts: pa.Array) -> pa.Array:
        return number_lists(token_counts(texts, num_buckets, portable))

    return df.withColumn(features, counted(F.col(text)))


def pair_features(
    pairs: DataFrame, settings: PreferenceModelSettings = PreferenceModelSettings()
) -> DataFrame:
    """Feature difference of each pair, as ``add_text_features`` has them; what the shared prompt adds cancels out."""
    num_buckets, portable = settings.num_buckets, settings.portable_hash

    @F.arrow_udf("array<double>")
    def difference(chosen: pa.Array, rejected: pa.Array) -> pa.Array:
        return number_lists(token_counts(chosen, num_buckets, portable) - token_counts(rejected, num_buckets, portable))

    return pairs.withColumn("difference", difference(F.col("chosen"), F.col("rejected")))


def _oriented(features: DataFrame, order_key: Column) -> DataFrame:
    """Half of the pairs are turned around, so that both labels occur at equal likelihood.

    The half is chosen by a key of its own: splits and samples cut on the order key itself.
    """
    turned = F.substring(F.md5(F.concat(F.lit("side|"), order_key)), 1, 1) < "8"
    vector = F.when(turned, F.transform("difference", lambda x: -x)).otherwise(F.col("difference"))
    return features.select(
        array_to_vector(vector).alias("features"), F.when(turned, 0.0).otherwise(1.0).alias("label")
    )


def fit_preferences(
    features: DataFrame,
    settings: PreferenceModelSettings = PreferenceModelSettings(),
    cached: bool = False,
) -> LogisticRegressionModel:
    """Bradley-Terry fit: logistic regression without intercept on feature differences.

    The solver reads its input twice, so it is kept for that time unless it comes from a cache.
    """
    regression = LogisticRegression(
        fitIntercept=False,
        family="binomial",
        maxIter=settings.max_iter,
        tol=settings.tolerance,
        regParam=settings.reg_param,
    )
    examples = _oriented(features, row_key(features, settings.seed))
    if cached:
        return regression.fit(examples)
    examples.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return regression.fit(examples)
    finally:
        examples.unpersist()


def weights_table(model: LogisticRegressionModel, spark) -> DataFrame:
    """One row per feature; the size is a model parameter."""
    rows = [(i, float(w)) for i, w in enumerate(model.coefficients.toArray())]
    return spark.createDataFrame(rows, "feature int, weight double")


def _weighted(weights: Sequence[float], features: Column) -> Column:
    products = F.zip_with(features, F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def score_features(features: DataFrame, model: LogisticRegressionModel) -> DataFrame:
    """Margin of each pair from its feature difference."""
    return features.withColumn("margin", _weighted(model.coefficients.toArray(), F.col("difference")))


def score_with_model(
    df: DataFrame,
    model: LogisticRegressionModel,
    texts: dict[str, str],
    settings: PreferenceModelSettings = PreferenceModelSettings(),
) -> DataFrame:
    """Add a score column per text column; all on the JVM side."""
    weights = model.coefficients.toArray()

    def add(frame: DataFrame, item: tuple[str, str]) -> DataFrame:
        text, score = item
        frame = add_text_features(frame, text, "_features", settings.num_buckets, settings.portable_hash)
        return frame.withColumn(score, _weighted(weights, F.col("_features"))).drop("_features")

    return reduce(add, texts.items(), df)


def _with_scores(df: DataFrame, texts: dict[str, str], score: Callable[[pa.RecordBatch, str], np.ndarray]) -> DataFrame:
    """Add a number per text column; the other columns stay Arrow, and a task holds a piece of a batch at a time."""
    schema = T.StructType([*df.schema.fields, *[T.StructField(name, T.DoubleType()) for name in texts.values()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_pieces(batch, list(texts), SCORED_BYTES):
                added = [pa.array(score(piece, text), pa.float64(), from_pandas=True) for text in texts]
                yield pa.RecordBatch.from_arrays([*piece.columns, *added], names=schema.names)

    return df.mapInArrow(run, schema)


def score_with(df: DataFrame, scorer: BatchScorer, texts: dict[str, str]) -> DataFrame:
    """Add a score column per text column with a user's batch function, in pieces of Arrow batches."""

    def score(piece: pa.RecordBatch, text: str) -> np.ndarray:
        return scorer(piece.column(text).to_pandas()).astype("float64").to_numpy()

    return _with_scores(df, texts, score)


def padded_batches(lengths: np.ndarray, budget: int) -> list[np.ndarray]:
    """Row numbers by length, cut so that rows x longest of a batch is at most the budget.

    Rows of equal length keep their order. A row longer than the budget is a batch of its own.
    """
    order = np.argsort(lengths, kind="stable")
    batches, start = [], 0
    for i, row in enumerate(order):
        if i > start and (i - start + 1) * max(int(lengths[row]), 1) > budget:
            batches.append(order[start:i])
            start = i
    return [*batches, order[start:]] if len(order) else []


def score_within_budget(df: DataFrame, scorer: BatchScorer, texts: dict[str, str], budget: int) -> DataFrame:
    """``score_with`` for scorers that pad a batch to its longest text: no call gets more than ``budget`` padded tokens.

    Tokens are what stands between white space. Rows of a piece of an Arrow batch are scored in order of
    length, so that little is padded, and get their scores back by row number. A longer text is scored alone.
    """

    def score(piece: pa.RecordBatch, text: str) -> np.ndarray:
        series, values = piece.column(text).to_pandas(), np.empty(piece.num_rows)
        for rows in padded_batches(token_numbers(piece.column(text)), budget):
            values[rows] = scorer(series.iloc[rows].reset_index(drop=True)).astype("float64").to_numpy()
        return values

    return _with_scores(df, texts, score)


def fit_fractions(
    train: DataFrame,
    fractions: Sequence[float] = CURVE_FRACTIONS,
    settings: PreferenceModelSettings = PreferenceModelSettings(),
) -> NestedFit:
    """A model per nested sample of the training pairs; features are computed once, a pass serves all models."""
    kept = [c for c in ("pair_id", "prompt_category", "difference") if c == "difference" or c in train.columns]
    features = pair_features(train, settings).select(*kept)
    sampled = fraction_membership(features, fractions, settings.seed).select("difference", "fractions")
    sampled.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return fit_nested(
            sampled,
            fractions,
            settings.num_buckets + 1,
            settings.reg_param,
            settings.max_iter,
            settings.newton_tolerance,
        )
    finally:
        sampled.unpersist()


def learning_curve(
    train: DataFrame,
    validation: DataFrame,
    fractions: Sequence[float] = CURVE_FRACTIONS,
    settings: PreferenceModelSettings = PreferenceModelSettings(),
) -> DataFrame:
    """Fit on growing samples, evaluate each fit on the same validation pairs.

    The fits share their passes over the features, the validation margins of all fits come from one pass.
    """
    fit = fit_fractions(train, fractions, settings)
    held_out = pair_features(validation, settings).select("prompt_category", "difference")
    scored = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(f).alias("fraction"),
                    F.lit(int(fit.pairs[k])).cast("long").alias("train_pairs"),
                    _weighted(fit.weights[k], F.col("difference")).alias("chosen_score"),
                    F.lit(0.0).alias("rejected_score"),
                )
                for k, f in enumerate(fit.fractions)
            ]
        )
    )
    margins = held_out.select("prompt_category", scored.alias("s")).select("prompt_category", "s.*")
    return category_evaluation(margins, by=("fraction", "train_pairs"))
