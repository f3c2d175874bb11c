"""The scorer (T7, T8): lookback snapshots -> serving features -> model -> predictions.

Two forms.  A run over the topic's last 90 minutes is a bounded Spark job, which ``start_predictor``
triggers every 5 minutes.  ``start_lookback_predictor`` keeps each link's lookback as state of the stream
instead, so a tick reads only the snapshots that are new.
"""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..operators.asof import lag_features, serving_features
from ..operators.ml import score_batch
from ..sources.readers import lookback_window
from ..sources.writers import write_predictions

LOG = logging.getLogger(__name__)


def predict_once(snapshots: DataFrame, lookup: DataFrame, holidays: DataFrame, model, now,
                 params: S.ServingParams = S.ServingParams(), tie: str | None = None) -> DataFrame:
    """T7 + J8 + M7: predictions for the newest snapshot of every link with all four lags."""
    window = lookback_window(snapshots, now, params.lookback_minutes * params.scale.factor)
    feats = serving_features(window, lookup, holidays, tie=tie, params=params)
    return score_batch(model, feats)


def run_predictor(snapshots: DataFrame, lookup: DataFrame, holidays: DataFrame, model, out_root: str,
                  run_id: str, batch_id: int, now: str | None = None,
                  params: S.ServingParams = S.ServingParams()) -> bool:
    """T8 (one tick): score and write to ``out_root`` once per run and batch (nothing for an empty run)."""
    now = now or datetime.now(timezone.utc).replace(tzinfo=None).strftime("%Y-%m-%d %H:%M:%S")
    preds = predict_once(snapshots, lookup, holidays, model, now, params)
    return write_predictions(preds, out_root, now, run_id, batch_id)


def start_predictor(tick_stream: DataFrame, load_snapshots, lookup: DataFrame, holidays: DataFrame,
                    model, out_root: str, checkpoint: str, trigger: dict | None = None,
                    params: S.ServingParams = S.ServingParams(), now: str | None = None, on_error=None):
    """T8 (streaming): every trigger re-reads the bounded lookback (``load_snapshots()``)
    and scores it; ``tick_stream`` only paces the runs (e.g. the snapshot topic).

    A run's clock is its micro-batch's time, which a retry keeps; ``now`` pins it (replays,
    tests).  A failing run is tried once more, then logged and handed to
    ``on_error(batch_id, error)``.  ``lookup`` is a stored table: it is read, not computed.
    """
    from .collector import now_utc, run_id_of

    def tick(batch: DataFrame, batch_id: int) -> None:
        at = now or batch.agg(F.date_format(F.max("_tick"), "yyyy-MM-dd HH:mm:ss")).first()[0]
        if at is None:
            return
        for attempt in (1, 2):
            try:
                run_predictor(load_snapshots(), lookup, holidays, model, out_root,
                              run_id_of(batch.sparkSession, checkpoint), batch_id, now=at, params=params)
                return
            except Exception as e:  # noqa: BLE001 - the next tick scores the same lookback again
                LOG.warning("scoring of batch %s failed, attempt %s: %s", batch_id, attempt, e)
                if attempt == 2 and on_error:
                    on_error(batch_id, e)

    w = (tick_stream.select(now_utc().alias("_tick")).writeStream.foreachBatch(tick)
         .option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"processingTime": "5 minutes"})).start()


def start_lookback_predictor(snapshots: DataFrame, lookup: DataFrame, holidays: DataFrame, model, out_root: str, checkpoint: str,
                             initial: DataFrame | None = None, trigger: dict | None = None,
                             params: S.ServingParams = S.ServingParams(), late_minutes: float = S.LOOKBACK_MINUTES, on_error=None):
    """T7 + T8 in the stream: every micro-batch scores the links whose lookback it changed.

    ``snapshots`` is a stream (``snapshot_stream``), ``initial`` a batch frame with the lookback before
    the first start.  Predictions are written once per run and batch; a micro-batch that fails
    twice is logged and handed to ``on_error(batch_id, error)``, and its links are scored again with
    their next snapshot.
    """
    from .collector import run_id_of
    from .state import lookback_stream, with_state_store

    def score(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for attempt in (1, 2):
                try:
                    preds = score_batch(model, lag_features(batch, lookup, holidays, params=params))
                    # the batch's own time, so that a retry goes to the same partition
                    at = batch.agg(F.date_format(F.max("data_as_of"), "yyyy-MM-dd HH:mm:ss")).first()[0]
                    if at is not None:
                        write_predictions(preds, out_root, at, run_id_of(batch.sparkSession, checkpoint), batch_id)
                    return
                except Exception as e:  # noqa: BLE001 - the next snapshot of a link scores it again
                    LOG.warning("scoring of batch %s failed, attempt %s: %s", batch_id, attempt, e)
                    if attempt == 2 and on_error:
                        on_error(batch_id, e)
        finally:
            batch.unpersist()

    w = lookback_stream(snapshots, params, late_minutes, initial).writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    with with_state_store(snapshots.sparkSession):
        return w.outputMode("append").trigger(**(trigger or {"processingTime": "5 minutes"})).start()
