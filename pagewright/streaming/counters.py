"""The telemetry operators on streams; state and rates are those of the batch operators."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.telemetry import CANDIDATES, RATES, WINDOW, frame_rates, snapshots


def scrape_stream(spark, path: str) -> DataFrame:
    """One row a scrape file: ``path, ts, text, available`` and the snapshot's metrics. A scrape without any sample is not available."""
    raw = spark.readStream.format("text").option("wholetext", True).schema("value string").load(path)
    s = snapshots(raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("ts"), F.col("value").alias("text")))
    known = F.lit(False)
    for c in CANDIDATES:
        known = known | F.col(c).isNotNull()
    return s.withColumn("available", known)


def rate_stream(snaps: DataFrame, window: float = WINDOW, key: str = "server") -> DataFrame:
    """Rates after each snapshot of a stream of ``server, ts`` (seconds) and metrics. The state is the samples that later ones need;
    samples of one time come in one micro-batch, and none comes after a later one was handled."""
    names = [x.split()[0] for x in RATES.split(", ")]
    have = ["ts", *[f for f in CANDIDATES if f in snaps.columns]]

    def fold(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = pd.DataFrame(json.loads(state.get[0]), columns=have, dtype=float) if state.exists else pd.DataFrame(columns=have, dtype=float)
        new = pd.concat([b[have].astype(float) for b in batches]).groupby("ts", as_index=False).max()
        frame = pd.concat([kept, new], ignore_index=True)
        rates, need = frame_rates(frame, window)
        state.update((frame[need].to_json(orient="records"),))
        out = rates.iloc[len(kept) :]
        out.insert(0, key, k[0])
        yield out[[key, "ts", *names]]

    return snaps.groupBy(key).applyInPandasWithState(fold, f"{key} string, ts double, {RATES}", "state string", "append", GroupStateTimeout.NoTimeout)


def windowed_counters(samples: DataFrame, late: str = "10 minutes", width: str = "5 minutes", slide: str | None = "1 minute") -> DataFrame:
    """``window, key, total`` of ``ts, key, value``: sums over windows that slide (or do not, without ``slide``), late rows up to the watermark."""
    at = F.window("ts", width, slide) if slide else F.window("ts", width)
    return samples.withWatermark("ts", late).groupBy(at, "key").agg(F.sum("value").alias("total"))


def outages(scrapes: DataFrame, key: str = "server") -> DataFrame:
    """``key, ts`` of the first unavailable scrape of each outage of a stream of ``key, ts`` (seconds), ``available``: one warning an outage."""

    def fold(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(batches)).sort_values("ts", kind="stable")
        up = new["available"].fillna(False).astype(bool).to_numpy()
        before = [state.get[0] if state.exists else True, *up[:-1]]
        state.update((bool(up[-1]),))
        out = new[[b and not u for b, u in zip(before, up)]]
        yield pd.DataFrame({key: [k[0]] * len(out), "ts": out["ts"].astype(float)})

    return scrapes.select(key, "ts", "available").groupBy(key).applyInPandasWithState(fold, f"{key} string, ts double", "up boolean", "append", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, write, checkpoint: str) -> None:
    """Runs a stream until its input is used up, handing each micro-batch to ``write(df, batch_id)``."""
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def commit_documents(store, phase: str):
    """A ``foreachBatch`` writer: rows (with ``text_sha1``) of finished documents go into the metric store as they arrive."""

    def write(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            store.write_phase(phase, df.where("page is not null").drop("text_sha1"), df.select("model", "doc", "text_sha1").distinct())
        finally:
            df.unpersist()

    return write
