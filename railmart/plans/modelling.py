"""From the wide fact to model-ready splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart.operators.numbering import category_codes
from railmart.operators.split import (
    CLASS_TARGET, FEATURES, SAVING_TARGET, apply_scaler, class_balance, encode, exact_split,
    fit_scaler, model_columns,
)

KEYS = ["origin", "destination", "vehicule_type"]


@dataclass
class ModelTables:
    encoder: DataFrame
    scaler: DataFrame
    classification: DataFrame
    classification_scaled: DataFrame
    regression: DataFrame
    balance: DataFrame


def prepare(fact: DataFrame, drop_null_train: bool = False) -> ModelTables:
    """Encoded and split tables: substitution class (stratified) and saved CO2 (rows with a flight)."""
    rows = model_columns(fact, KEYS, drop_null_train)
    encoder = category_codes(rows, "vehicule_type")
    encoded = encode(rows, encoder, "vehicule_type", "vehicule_code")
    features = [f if f != "vehicule_type" else "vehicule_code" for f in FEATURES]
    classification = exact_split(
        encoded.select(*KEYS, *features, CLASS_TARGET), KEYS, [CLASS_TARGET]
    )
    flown = encoded.where(F.col(SAVING_TARGET).isNotNull())
    regression = exact_split(flown.select(*KEYS, *features, SAVING_TARGET), KEYS)
    scaler = fit_scaler(classification.where(F.col("split") == "train"), features)
    return ModelTables(
        encoder=encoder,
        scaler=scaler,
        classification=classification,
        classification_scaled=apply_scaler(classification, scaler, features),
        regression=regression,
        balance=class_balance(classification, CLASS_TARGET),
    )
