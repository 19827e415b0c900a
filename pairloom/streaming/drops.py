"""Drop events: which object notifications announce a complete drop.

The same columns serve a table of events and a stream of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from ..operators import skew
from ..operators.relational import first_row
from ..session import cut_lineage

# The path partitions a drop must name, and its completion marker.
PARTITIONS = ["company_code", "product_segment", "load_date"]
SUFFIX = "_SUCCESS"


def decoded_key(key: Column) -> Column:
    """URL-decoded object key; a malformed escape leaves the key as it is."""
    return F.coalesce(F.try_url_decode(key), key)


def path_value(key: Column, name: str) -> Column:
    """Value of the last ``name=value`` segment of a path with a value, null if there is none."""
    found = F.regexp_extract_all(key, F.lit(f"(?:^|/){re.escape(name)}=([^/]+)"), F.lit(1))
    return F.try_element_at(found, F.lit(-1))


def classify(events: DataFrame, suffix: str = SUFFIX, scheme: str = "s3") -> DataFrame:
    """Add the decoded key, its partitions, ``input_prefix``, ``action`` and ``reason``.

    ``events`` has ``bucket`` and ``key``. A key without the completion suffix or
    without one of the partitions is ``ignored``, the rest ``accepted``.
    """
    key = F.col("key")
    rows = events.withColumn("key", decoded_key(key)).withColumns({p: path_value(key, p) for p in PARTITIONS})
    absent = F.concat_ws(", ", *[F.when(F.col(p).isNull(), F.lit(p)) for p in PARTITIONS])
    reason = F.when(~key.endswith(suffix), F.lit("suffix mismatch")).when(
        absent != "", F.concat(F.lit("missing "), absent)
    )
    folder = F.left(key, F.length(key) - F.length(F.substring_index(key, "/", -1)))
    return rows.withColumns({
        "reason": reason,
        "action": F.when(reason.isNull(), "accepted").otherwise("ignored"),
        "input_prefix": F.when(reason.isNull(), F.concat(F.lit(f"{scheme}://"), F.col("bucket"), F.lit("/"), folder)),
    })


def accept_once(
    events: DataFrame, time: str = "ts", scheme: str = "s3", finished: DataFrame | None = None, hot_parts: int | None = None
) -> DataFrame:
    """Batch: one accepted event per prefix and run stays, the earliest; the others become ``skipped``.

    A run is in flight from its event until it is reported in ``finished``
    (``input_prefix`` and ``time``), so the first event after that starts another;
    without ``finished`` no run ever ends. Events without a time come last.

    Events are told apart by all their columns and not by an id, so ids may repeat
    or be null. Of deliveries that are equal in every column one counts. Ignored
    events, which have no prefix, pass by. A prefix that is announced very often is
    cut to its first events on the map side, and its others are spread over tasks.
    """
    rows = classify(events, scheme=scheme)
    columns = rows.columns
    # Read three times, so parsed and counted once.
    counted = cut_lineage(rows.where("action = 'accepted'").groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")))
    hot = skew.hot_keys(counted, ["input_prefix"], hot_parts)
    counted = _with_run(counted, finished, time, hot)
    run = ["input_prefix", "_run"]
    first = first_row(counted.drop("_copies"), run, [F.col(time).asc_nulls_last()]).select(*run, F.struct(*columns).alias("_first"))
    marked = skew.join_spread(counted, first, run, "left", hot, columns)
    each = marked.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    stays = F.struct(*columns).eqNullSafe(F.col("_first")) & (F.col("_copy") == 1)
    judged = each.withColumn("_repeat", ~stays).withColumns({
        "reason": F.when(F.col("_repeat"), "repeated event").otherwise(F.col("reason")),
        "action": F.when(F.col("_repeat"), "skipped").otherwise(F.col("action")),
    })
    return rows.where("action <> 'accepted'").unionByName(judged.select(*columns))


def _with_run(counted: DataFrame, finished: DataFrame | None, time: str, hot: skew.HotKeys) -> DataFrame:
    """Number ``_run`` of the runs of each event's prefix that ended before it."""
    if finished is None:
        return counted.withColumn("_run", F.lit(0))
    ends = finished.where(F.col(time).isNotNull()).groupBy("input_prefix").agg(F.array_sort(F.collect_set(time)).alias("_ends"))
    before = F.filter("_ends", lambda t: (t <= F.col(time)) | F.col(time).isNull())
    found = skew.join_spread(counted, ends, ["input_prefix"], "left", hot, counted.columns)
    return found.withColumn("_run", F.when(F.col("_ends").isNull(), 0).otherwise(F.size(before))).drop("_ends")


def accept_stream(
    events: DataFrame, time: str = "ts", delay: str = "1 hour", finished: DataFrame | None = None, late: str = "10 minutes"
) -> DataFrame:
    """Stream: which events start a run.

    Without ``finished`` the accepted events, one per prefix within the watermark
    ``delay``, which then stands for the time a run is in flight. With ``finished``,
    a stream of ``input_prefix`` and ``time``, every event that could start a run
    comes out as ``accepted`` or ``skipped``: a prefix is in flight from its
    accepted event until it is reported finished, or for ``delay`` if that never
    happens. The events of a prefix are taken by time within a trigger; its state
    is one time, and a timer drops it. Rows more than ``late`` behind the newest
    ones are left out.
    """
    accepted = classify(events).where("action = 'accepted'")
    if finished is None:
        return accepted.withWatermark(time, delay).dropDuplicatesWithinWatermark(["input_prefix"])
    columns = [c for c in accepted.columns if c != "input_prefix"]
    schema = accepted.select("input_prefix", *columns).schema
    seconds = pd.Timedelta(delay).total_seconds()
    payload = F.struct(*columns).alias("_event")
    starts = accepted.select("input_prefix", F.col(time).alias("_at"), payload)
    ends = finished.select("input_prefix", F.col(time).alias("_at"), F.lit(None).cast(starts.schema["_event"].dataType).alias("_event"))
    both = starts.unionByName(ends).withWatermark("_at", late)

    def guard(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames)).sort_values("_at", kind="stable")
        since, out = (state.get[0] if state.exists else None), []
        for at, event in zip(rows["_at"], rows["_event"], strict=True):
            now = at.timestamp()
            if event is None:
                since = None
                continue
            busy = since is not None and now < since + seconds
            judged = {"action": "skipped", "reason": "in flight"} if busy else {}
            out.append({"input_prefix": key[0], **(event if isinstance(event, dict) else event.asDict()), **judged})
            since = since if busy else now
        if since is None:
            if state.exists:
                state.remove()
        else:
            state.update((since,))
            # A timer must lie after the watermark.
            state.setTimeoutTimestamp(max(int((since + seconds) * 1000), state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame(out, columns=schema.names)

    return both.groupBy("input_prefix").applyInPandasWithState(guard, schema, "since double", "append", "EventTimeTimeout")
