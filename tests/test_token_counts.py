import pyarrow as pa
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pairloom.functions import token_counts as counted
from pairloom.functions.text import stripped, whitespace_tokens
from pairloom.operators.preference_model import add_text_features, pair_features, score_with
from pairloom.operators.views import cap_length
from pairloom.settings import PreferenceModelSettings

TEXTS = [
    "", None, "   ", "a", " a\tab  abc\nabcd abcde ", "größe straße é x 日本語 😀", "x" * 5000 + " y",
    "a\x0bb\x0cc\rd", "same same same", "a b\x1cc",
]


@pytest.mark.parametrize("size", [1, 20, 4_000_000])
def test_counts_are_those_of_hashing_tf(spark, monkeypatch, size):
    monkeypatch.setattr(counted.text_pieces, "__defaults__", (size,))
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string").coalesce(1)
    words = whitespace_tokens(stripped(F.coalesce("t", F.lit(""))))
    hashed = HashingTF(numFeatures=7, inputCol="w", outputCol="c").transform(df.withColumn("w", words))
    expected = hashed.select("i", F.concat(vector_to_array("c"), F.array(F.size("w").cast("double"))).alias("f"))
    assert sorted(expected.collect()) == sorted(add_text_features(df, "t", "f", 7).select("i", "f").collect())
    assert counted.token_counts(pa.array(TEXTS), 7).tolist() == [r.f for r in expected.orderBy("i").collect()]


def test_features_use_no_row_by_row_text_functions(spark):
    pairs = spark.createDataFrame([(1, "a b", "c")], "pair_id long, chosen string, rejected string")
    plan = pair_features(pairs, PreferenceModelSettings(num_buckets=4))._jdf.queryExecution().toString()
    assert "split(" not in plan and "ArrowEvalPython" in plan


def test_cap_and_scores_on_odd_texts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    words = F.split(stripped(F.col("t")), r"\s+", 3)
    words = F.filter(words, lambda w: w != "")
    expected = df.select(
        "i",
        F.when(F.size(words) > 2, F.array_join(F.slice(words, 1, 2), " ")).otherwise(F.col("t")).alias("t"),
        (F.size(words) > 2).alias("t_was_truncated"),
    )
    capped = cap_length(df, "t", 2).select("i", "t", "t_was_truncated")
    assert sorted(map(str, expected.collect())) == sorted(map(str, capped.collect()))
    scored = {r.i: r.s for r in score_with(df, lambda x: x.str.len().astype("float64"), {"t": "s"}).collect()}
    assert scored == {i: None if t is None else float(len(t)) for i, t in enumerate(TEXTS)}
