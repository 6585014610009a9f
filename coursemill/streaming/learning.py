"""Watch time of videos: by dimension, and with repeated viewing taken out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from coursemill.functions.columns import int_or_zero, watch_seconds
from coursemill.operators.intervals import interval_sets, interval_text, islands, watch_totals
from coursemill.sinks.tables import publish_changes
from coursemill.sources.lines import json_fields

# Fields of a viewing message (``int``, ``long`` or text) and the keys totals are kept for.
_INTS = ["uid", "cwareid", "videoid", "chapterid", "edutypeid", "subjectid", "speed", "ps", "pe"]
_LONGS = ["ts", "te"]
_TEXTS = ["sourceType"]
VIDEO_KEYS = ["userid", "cwareid", "videoid"]
DIMENSIONS = ["chapterid", "cwareid", "edutypeid", "sourceType", "subjectid"]


def learn_events(lines: DataFrame) -> DataFrame:
    """Typed viewing rows; lines that are no JSON object are dropped."""
    raw = json_fields(lines, [*_INTS, *_LONGS, *_TEXTS])
    return raw.select(
        int_or_zero("uid").alias("userid"),
        *[int_or_zero(c).alias(c) for c in _INTS if c != "uid"],
        *[F.coalesce(F.col(c).try_cast("long"), F.lit(0)).alias(c) for c in _LONGS],
        *_TEXTS,
    )


def seconds_by_dimension(events: DataFrame) -> DataFrame:
    """Watched seconds per value of the five dimensions, in one scan and one shuffle.

    Each row is copied once per dimension inside its task and summed there before the shuffle.
    """
    pairs = [F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("key")) for d in DIMENSIONS]
    return (
        events.select(watch_seconds("ts", "te").alias("_s"), F.explode(F.array(*pairs)).alias("d"))
        .groupBy(F.col("d.dim").alias("dim"), F.col("d.key").alias("key"))
        .agg(F.sum("_s").alias("totaltime"))
    )


def watch_time(events: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Batch form: total, effective and complete seconds per user, courseware and video."""
    return watch_totals(events, VIDEO_KEYS, history)


def play_intervals(events: DataFrame) -> DataFrame:
    """Watched intervals per user, courseware and video as ``s-e,s-e``."""
    sets = interval_sets(islands(events, VIDEO_KEYS), VIDEO_KEYS)
    return sets.select(*VIDEO_KEYS, interval_text("intervals").alias("play_interval"))


# State of a user: per video, in key order, three sums and the number of its intervals; the intervals of all, one after another.
_STATE = (
    "cwareids array<int>, videoids array<int>, totaltimes array<long>, effecttimes array<long>, completetimes array<long>, "
    "sizes array<int>, starts array<int>, ends array<int>"
)
_OUTPUT = "userid int, cwareid int, videoid int, play_interval string, totaltime long, effecttime long, completetime long"
_LANE = 1 << 33  # positions are ints: video ``n`` of a group has its own range of numbers around ``n * _LANE``


def _covered_before(starts: np.ndarray, ends: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Seconds before each ``x`` inside sorted disjoint intervals."""
    if not len(starts):
        return np.zeros_like(x)
    lengths = np.concatenate([[0], np.cumsum(ends - starts)])
    i = np.searchsorted(starts, x, side="right")
    over = np.maximum(0, ends[np.maximum(i - 1, 0)] - x)
    return lengths[i] - np.where(i > 0, over, 0)


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, touching ones joined."""
    order = np.lexsort((ends, starts))
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], reach[:-1] < starts[1:]])
    last = np.concatenate([first[1:], [True]])
    return starts[first], reach[last]


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Places at which a new key begins in sorted rows."""
    changed = np.zeros(max(len(keys[0]) - 1, 0), dtype=bool)
    for key in keys:
        changed |= key[1:] != key[:-1]
    return np.flatnonzero(np.concatenate([[True], changed]))


def _reduced(columns: list[np.ndarray]) -> list[np.ndarray]:
    """One row per (video, ps, pe) in that order: the first row in (ts, te) order and the sum of seconds."""
    cware, video, ps, pe, ts, te, first, secs = columns
    order = np.lexsort((te, ts, pe, ps, video, cware))
    cware, video, ps, pe, ts, te, first, secs = (c[order] for c in (cware, video, ps, pe, ts, te, first, secs))
    heads = _heads(cware, video, ps, pe)
    return [*(c[heads] for c in (cware, video, ps, pe, ts, te, first)), np.add.reduceat(secs, heads)]


def _update_user(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """All touched videos of a user at once: a group costs the same in Python with one video or with many."""
    stored = state.get if state.exists else ([],) * 8
    stored = [np.array(c, dtype=np.int64) for c in stored]
    old, old_sums, sizes = stored[:2], stored[2:5], stored[5]
    kept = None
    for chunk in chunks:
        viewings = np.concatenate(chunk["viewing"].to_numpy()).reshape(-1, 6).astype(np.int64, copy=False)
        ts, te = viewings[:, 4], viewings[:, 5]
        secs = np.sign(te - ts) * (np.abs(te - ts) // 1000)
        new_rows = [*viewings.T, secs, secs]
        kept = _reduced(new_rows if kept is None else [np.concatenate(two) for two in zip(kept, new_rows)])
    cware, video, ps, pe, _, _, first, secs = kept
    heads = _heads(cware, video)
    counts = np.diff(np.append(heads, len(ps)))

    # the videos of before and of now in one order; ``at`` and ``lane`` say where those of now, and their rows, stand in it
    both = [np.concatenate([o, c[heads]]) for o, c in zip(old, (cware, video))]
    order = np.lexsort(both[::-1])
    firsts = _heads(*(c[order] for c in both))
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(order))))
    was, at = place[: len(old[0])], place[len(old[0]) :]
    lane, owner = np.repeat(at, counts) * _LANE, np.repeat(was, sizes)
    starts, ends = stored[6] + owner * _LANE, stored[7] + owner * _LANE
    had = np.zeros(len(firsts), dtype=np.int64)
    had[was] = sizes

    ps, pe = ps + lane, pe + lane
    reached = np.concatenate([ps[:1], np.maximum.accumulate(pe)[:-1]])
    reached[heads] = ps[heads]
    lo = np.maximum(ps, reached)
    known = _covered_before(starts, ends, pe) - _covered_before(starts, ends, lo)
    new = np.where(lo < pe, pe - lo - known, 0)
    length = np.where(pe == ps, 1, np.abs(pe - ps))
    share = np.sign(first) * (np.abs(first) * new // length)
    fresh = heads[had[at] == 0]
    share[fresh] = first[fresh]

    whole = pe >= ps
    if whole.any():
        starts, ends = _merged(np.concatenate([starts, ps[whole]]), np.concatenate([ends, pe[whole]]))
    owner = (starts + _LANE // 2) // _LANE
    starts, ends = starts - owner * _LANE, ends - owner * _LANE
    sizes = np.bincount(owner, minlength=len(firsts))
    sums = []
    for before, added in zip(old_sums, (secs, share, new)):
        total = np.zeros(len(firsts), dtype=np.int64)
        total[was] = before
        total[at] += np.add.reduceat(added, heads)
        sums.append(total)
    videos = [c[order][firsts] for c in both]
    state.update(tuple(c.tolist() for c in (*videos, *sums, sizes, starts, ends)))

    bounds = np.concatenate([[0], np.cumsum(sizes)])
    pieces = [f"{s}-{e}" for s, e in zip(starts.tolist(), ends.tolist())]
    texts = [",".join(pieces[bounds[i] : bounds[i + 1]]) for i in at]
    yield pd.DataFrame(
        {
            "userid": np.repeat(key[0], len(at)), "cwareid": videos[0][at], "videoid": videos[1][at], "play_interval": texts,
            "totaltime": sums[0][at], "effecttime": sums[1][at], "completetime": sums[2][at],
        }
    )


def watch_time_stream(events: DataFrame) -> DataFrame:
    """Streaming form: running totals and intervals of the videos each micro-batch touched (update mode).

    The state of a user is the disjoint intervals and three sums of each of their videos. A call to Python costs far more
    than the few rows of one video, so a user's videos are worked off together. Rows of a group within a batch are
    reduced chunk by chunk to one per (video, ps, pe), so memory follows the videos' lengths and not the number of rows.
    User 0 stands for all whose id could not be read and may have any number of videos: a group holds one of them there.
    """
    # one array column instead of six: handing a group to Python is paid per column
    viewing = F.array(*[F.col(c).cast("long") for c in ("cwareid", "videoid", "ps", "pe", "ts", "te")])
    nobody = F.when(F.col("userid") == 0, F.xxhash64("cwareid", "videoid")).otherwise(F.lit(0).cast("long"))
    rows = events.select("userid", nobody.alias("_shelf"), viewing.alias("viewing"))
    return rows.groupBy("userid", "_shelf").applyInPandasWithState(
        _update_user, _OUTPUT, _STATE, "update", GroupStateTimeout.NoTimeout
    )


def publish_videos(root: str):
    """Publisher for changed videos: last value per key wins (``latest_rows``)."""
    def publish(rows: DataFrame, batch: int) -> None:
        publish_changes(rows, root, batch, compact=True)

    return publish
