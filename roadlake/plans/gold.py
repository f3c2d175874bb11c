"""Silver -> lookup and gold training features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..operators.aggregates import free_flow_lookup
from ..operators.filters import time_split
from ..operators.joins import enrich_free_flow
from ..operators.windows import gold_features


def build_lookup(silver: DataFrame, bounds=S.SPLIT_BOUNDS, split: str = "train",
                 method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """G1+G2+J2 on the training split: (link_id, free_flow_speed, borough, link_name)."""
    train = time_split(silver, bounds, name=split)
    return free_flow_lookup(train, order="data_as_of_utc", method=method, accuracy=accuracy)


def build_gold(silver: DataFrame, lookup: DataFrame, params: S.GoldParams = S.GoldParams()) -> DataFrame:
    """J3 + F7/F8 + W4: the gold table (19 features, label, data_as_of, year)."""
    enriched = enrich_free_flow(silver, lookup)
    feats = gold_features(enriched, params, ts="data_as_of_utc", tie=("speed",))
    return feats.select(*S.GOLD_COLUMNS)
