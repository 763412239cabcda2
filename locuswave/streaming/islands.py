"""Islands of events while they are still arriving, in any order within a delay.

State holds the open islands of a key, each with its span, size and best event.  Arriving events extend and join them;
an island is given out once the watermark has passed its end by more than the gap, when no event that may still arrive
could reach it.  Events behind the watermark are dropped by Spark and counted in the query's progress.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# start, stop, members, (priority.., payload..)
Island = tuple[int, int, int, tuple]


def joined(islands: list[Island], gap: int) -> list[Island]:
    """Islands in order, those within ``gap`` of each other made one."""
    out: list[Island] = []
    for start, stop, members, best in sorted(islands, key=lambda i: i[:2]):
        if out and start <= out[-1][1] + gap:
            first, last, n, top = out[-1]
            out[-1] = (first, max(last, stop), n + members, max(top, best))
        else:
            out.append((start, stop, members, best))
    return out


def running_islands(events: DataFrame, keys: Sequence[str], gap: int, time: str, delay: str, priority: Sequence[str],
                    payload: Sequence[str]) -> DataFrame:
    """Closed islands of a stream: keys, island_start, island_stop (microseconds), members, payload of the best event.

    ``events`` has the timestamp column ``time``; events of a key belong together while they are at most ``gap``
    microseconds apart.  The best event has the greatest ``priority`` tuple, which has no NULLs and no ties.
    ``delay`` is how late an event may be.  Equal to ``operators.islands.island_best`` on the events that were in time.
    """
    fields = {f.name: f for f in events.schema}
    layout = T.StructType([
        *[fields[k] for k in keys], T.StructField("island_start", T.LongType()), T.StructField("island_stop", T.LongType()),
        T.StructField("members", T.LongType()), *[fields[c] for c in payload]])
    wanted = list(dict.fromkeys([*priority, *payload]))
    at = [wanted.index(c) for c in payload]

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        islands: list[Island] = pickle.loads(state.get[0]) if state.exists else []
        if not state.hasTimedOut:
            for frame in frames:
                values = zip(*(frame[c].tolist() for c in wanted))
                islands = joined(islands + [(t, t, 1, v) for t, v in zip(frame["_t"].tolist(), values)], gap)
        # Events at or after the watermark may still come.
        passed = state.getCurrentWatermarkMs() * 1000
        closed = [i for i in islands if i[1] + gap < passed]
        open_ = islands[len(closed):]
        if open_:
            state.update((pickle.dumps(open_),))
            # The least time at which the first open island may be closed.
            state.setTimeoutTimestamp(max((open_[0][1] + gap) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        else:
            state.remove()
        if closed:
            yield pd.DataFrame([(*key, start, stop, n, *[best[k] for k in at]) for start, stop, n, best in closed],
                               columns=layout.names)

    marked = events.withWatermark(time, delay)
    named = marked.select(*keys, time, F.unix_micros(time).alias("_t"), *[c for c in wanted if c not in (*keys, time)])
    return named.groupBy(*keys).applyInPandasWithState(
        update, layout, "islands binary", "append", GroupStateTimeout.EventTimeTimeout)
