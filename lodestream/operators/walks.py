"""Folds over streams whose state depends on their own earlier results, so that no window expresses them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def walk_in_order(df: DataFrame, by: list[str], order: list[str], fresh: Callable[[], Any], step: Callable[[Any, Any], Any], name: str, kind: str, tasks: int = 0) -> DataFrame:
    """``df`` with the column ``name``: what ``step(state, row)`` says of each row of a stream, in order.

    Streams are dealt to tasks by key and sorted there (on disk where they are
    long); a task holds one batch of rows and one stream's state.  The state is
    made anew by ``fresh()`` at a stream's start.  Rows of null key are one stream.
    ``tasks`` is a number of partitions; rows that lie in as many by that key are not dealt again.
    """
    schema = StructType.fromJson(df.schema.jsonValue()).add(name, kind)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = state = None
        for frame in frames:
            keys = zip(*[frame[b].astype(object).where(frame[b].notna(), None) for b in by], strict=True)
            said = []
            for key, row in zip(keys, frame.itertuples(index=False), strict=True):
                if key != at:
                    at, state = key, fresh()
                said.append(step(state, row))
            frame[name] = said
            yield frame

    dealt = df.repartition(tasks, *by) if tasks else df.repartition(*by)
    return dealt.sortWithinPartitions(*by, *order).mapInPandas(run, schema)
