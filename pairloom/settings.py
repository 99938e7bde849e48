"""Fixed values and parameter records shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Defaults a caller relies on.
SEED = 42
VAL_FRACTION = 0.2
CURVE_VAL_FRACTION = 0.5
MIN_READING_TIME_S = 2.0
MAX_READING_TIME_S = 600.0
SYSTEM_MESSAGE = "You are a helpful assistant."
MAX_TEXT_TOKENS = 1024
MAX_PROMPT_TOKENS = 512
CURVE_FRACTIONS = (0.2, 0.4, 0.6, 0.8, 1.0)
POWER_TARGETS = (0.55, 0.60, 0.65, 0.70, 0.75, 0.80)
ALPHA = 0.05
POWER = 0.80
WILSON_Z = 1.96
NEAREST_TARGET_WITHIN = 0.025
ADVANTAGE_EPSILON = 1e-8
BASELINE_KEEP = 0.9
MAX_LOSS_FOR_PERPLEXITY = 20.0

# Words a CSV uses for a missing number.
MISSING_NUMBER_WORDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

PREFERENCE_SCHEMA = T.StructType(
    [
        T.StructField("prompt_id", T.StringType()),
        T.StructField("prompt", T.StringType()),
        T.StructField("prompt_category", T.StringType()),
        T.StructField("chosen", T.StringType()),
        T.StructField("rejected", T.StringType()),
        T.StructField("chosen_temperature", T.DoubleType()),
        T.StructField("rejected_temperature", T.DoubleType()),
        T.StructField("chosen_output_tokens", T.LongType()),
        T.StructField("rejected_output_tokens", T.LongType()),
        T.StructField("reading_time_s", T.DoubleType()),
        T.StructField("is_tie", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class CurationSettings:
    """How raw annotations become a labelled table of usable pairs."""

    val_fraction: float = VAL_FRACTION
    min_reading_time: float = MIN_READING_TIME_S
    max_reading_time: float = MAX_READING_TIME_S
    seed: int = SEED


@dataclass(frozen=True)
class PolicyRunSettings:
    """Parameters of the policy runs whose token logs are analysed."""

    num_epochs: int = 2
    batch_size: int = 4
    learning_rate: float = 1e-5
    clip_range: float = 0.2
    kl_coefficient: float = 0.05
    seed: int = SEED


@dataclass(frozen=True)
class TrainingSettings:
    """What a training stage states of itself in its record."""

    base_model: str = "linear-preference"
    num_epochs: int = 3
    max_steps: int = -1
    batch_size: int = 4
    accumulation_steps: int = 4
    learning_rate: float = 2e-4

    @property
    def effective_batch_size(self) -> int:
        return self.batch_size * self.accumulation_steps


@dataclass(frozen=True)
class PreferenceModelSettings:
    """Parameters of the linear preference model."""

    num_buckets: int = 64
    max_iter: int = 50
    tolerance: float = 1e-5
    reg_param: float = 1e-3
    seed: int = SEED
    newton_tolerance: float = 1e-10
    portable_hash: bool = False
