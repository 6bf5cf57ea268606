"""Keyed state of the streams: the first event of a delivery (W2) and timers that
expire timeline entries (W7).

Both keep one small entry per key in Spark's state store and free it by an
event-time timer, so state is bounded by the keys that the watermark can still
reach, not by the history.  A lost executor restores its part of the state from
the checkpoint.

Keys are dealt by hash to ``BUCKETS`` groups, and a row of state holds the live
keys of a group: a call into Python, about a millisecond, is paid per group and
trigger and not per key.  The number of groups belongs to a checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_MS = 1_000_000     # nanoseconds
BUCKETS = 256


def _millis(times: pd.Series) -> pd.Series:
    """Event times as whole milliseconds; a missing time counts as 0."""
    return times.astype("datetime64[ns]").fillna(pd.Timestamp(0)).astype("int64") // _MS


def interval_ms(spark, interval: str) -> int:
    return spark.range(1).select(F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"INTERVAL {interval}"))).first()[0]


def _bucket(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS))


def _keep(state: GroupState, live: list[tuple], columns: int) -> None:
    """The entries of a group, column by column; the last column is their timers."""
    if live:
        state.update(tuple(list(c) for c in zip(*live)))
        state.setTimeoutTimestamp(max(min(e[columns - 1] for e in live), state.getCurrentWatermarkMs()))
    elif state.exists:
        state.remove()


# ------------------------------------------------------------------ W2
def first_of_delivery(events: DataFrame, delay: str = "1 hour", horizon: str = "2 hours", ts: str = "ts",
                      key: str = "delivery_id", order: str = "event_id") -> DataFrame:
    """The first event of every delivery, once, however its events are spread
    over micro-batches.  A handled delivery is remembered until the watermark
    (``delay`` behind) has passed its latest event by ``horizon``; an event that
    comes later than ``delay`` is dropped by the watermark, so with a horizon of at
    least ``delay`` a delivery is never handled twice.  Of the events that arrive
    together the smallest ``order`` is the first.  Events without a delivery are
    one delivery."""
    wait = interval_ms(events.sparkSession, horizon)
    columns = events.columns
    # pandas has no whole numbers with gaps: a null travels as 0 with a flag beside it
    whole = [c for c, kind in events.dtypes if kind == "bigint"]
    flag = {c: f"__no_{c}" for c in whole}
    keys, by = ([flag[c], c] if c in flag else [c] for c in (key, order))
    rows = events.withWatermark(ts, delay).withColumns({"__bucket": _bucket(key), **{flag[c]: F.col(c).isNull() for c in whole}})
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in whole})

    def first_rows(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.sort_values(by, kind="stable").drop_duplicates(keys)

    def names(frame: pd.DataFrame) -> list:
        if key not in flag:
            return [None if pd.isna(k) else k for k in frame[key].tolist()]
        return [None if gone else k for gone, k in zip(frame[flag[key]].tolist(), frame[key].tolist())]

    def handle(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = {k: (k, latest, timer) for k, latest, timer in zip(*state.get)} if state.exists else {}
        watermark, seen, first = state.getCurrentWatermarkMs(), {}, None
        for frame in frames:            # one Arrow batch at a time: a hot delivery is never held whole
            if not len(frame):
                continue
            for k, at in zip(names(frame), _millis(frame[ts]).tolist()):
                seen[k] = max(seen.get(k, 0), at)
            mine = first_rows(frame)
            first = mine if first is None else first_rows(pd.concat([first, mine]))
        if first is not None:
            first = first[[k not in known for k in names(first)]]
            if len(first):
                yield first[[*columns, *flag.values()]]
        live = [e for e in known.values() if e[0] not in seen and e[2] >= watermark]
        for k, at in seen.items():
            latest = max(at, known[k][1] if k in known else 0)
            live.append((k, latest, max(latest + wait, watermark + 1)))
        _keep(state, live, 3)

    kind = events.schema[key].dataType.simpleString()
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema] + [f"`{c}` boolean" for c in flag.values()])
    out = rows.groupBy("__bucket").applyInPandasWithState(
        handle, fields, f"key array<{kind}>, latest array<bigint>, timer array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(*[F.when(~F.col(flag[c]), F.col(c)).alias(c) if c in flag else F.col(c) for c in columns])


# ------------------------------------------------------------------ W7
EXPIRY = "entry_id string, object string, seq bigint, expired_at timestamp"
_VERSION = "entry_id array<string>, object array<string>, seq array<bigint>, updated array<bigint>, expires array<bigint>"


def expiries(entries: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """One row per version of a timeline entry that runs out, when it does.

    The state of an entry is its latest version.  A version that is replaced
    before it runs out leaves no row: the new version's expiry counts.  The timer
    fires once the watermark (``delay`` behind the latest ``updated_at``) has passed
    ``expires_at``; versions that never expire hold no state.  The rows do not
    depend on how versions are spread over micro-batches."""
    def handle(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        live = {v[0]: v for v in zip(*state.get)} if state.exists else {}
        versions: list[tuple] = []
        for frame in frames:
            if not len(frame):
                continue
            expires = [None if none else at for none, at in zip(frame["expires_at"].isna(), _millis(frame["expires_at"]).tolist())]
            versions += zip(frame["entry_id"], frame["object"], map(int, frame["seq"]), _millis(frame["updated_at"]).tolist(), expires)
        for v in sorted(versions, key=lambda v: (v[3], v[2])):
            last = live.get(v[0])
            if last:
                if (last[3], last[2]) > (v[3], v[2]):
                    continue            # an older version than the one that counts
                if last[4] <= v[3]:
                    out.append(last)    # ran out before it was replaced
            if v[4] is not None:
                live[v[0]] = v
            elif last:
                del live[v[0]]
        watermark = state.getCurrentWatermarkMs()
        out += [v for v in live.values() if v[4] < watermark]
        _keep(state, [v for v in live.values() if v[4] >= watermark], 5)
        if out:
            yield pd.DataFrame({"entry_id": [v[0] for v in out], "object": [v[1] for v in out], "seq": [v[2] for v in out],
                                "expired_at": pd.to_datetime([v[4] for v in out], unit="ms")})

    rows = entries.select("entry_id", "object", "seq", "updated_at", "expires_at").withWatermark("updated_at", delay)
    return rows.withColumn("__bucket", _bucket("entry_id")).groupBy("__bucket").applyInPandasWithState(
        handle, EXPIRY, _VERSION, "append", GroupStateTimeout.EventTimeTimeout)
