"""Aggregates of one's own that are taken in parts: per task, then merged in a tree.

An aggregate says how a state starts, takes values, merges with another and ends as a number
(:class:`InParts`). Every task keeps one state per group it meets; states of a group are merged ``_FAN``
at a time. So no task ever holds a group, however much of the table it is, as long as the
states stay small.
"""

from __future__ import annotations

import math
import pickle
from abc import ABC, abstractmethod
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

#: States merged at a time, and places for tasks at the foot of the tree.
_FAN, _PLACES = 64, 4096
#: Groups whose states a task holds before it hands them on.
_HELD = 10_000


class InParts(ABC):
    """An aggregate by its parts. States must pickle; ``merge`` must not depend on the order of its sides."""

    name = "in_parts"

    @abstractmethod
    def start(self): ...

    @abstractmethod
    def add(self, state, values: np.ndarray):
        """The state with more values, which are neither null nor NaN."""

    @abstractmethod
    def merge(self, one, other): ...

    @abstractmethod
    def finish(self, state) -> float | None: ...


class _Values:
    """Values with their weights: exactly, by count, while there are at most ``most`` different ones, else levels of
    halved samples, where a value on level h stands for 2^h rows.

    A level with more than ``most`` values is sorted and every second one goes a level up. With L levels
    the rank of a value is off by L / most of the rows at most.
    """

    def __init__(self, most: int):
        self.most = most
        self.values, self.counts = np.zeros(0), np.zeros(0, dtype=np.int64)
        self.levels: list[np.ndarray] | None = None
        self.flips = 0

    def add(self, values: np.ndarray, counts: np.ndarray | None = None) -> None:
        if self.levels is not None:
            self._lift(values, counts)
            return
        both = np.concatenate([self.values, values])
        weights = np.concatenate([self.counts, np.ones(len(values), np.int64) if counts is None else counts])
        self.values, inverse = np.unique(both, return_inverse=True)
        self.counts = np.bincount(inverse, weights, len(self.values)).astype(np.int64)
        if len(self.values) > self.most:
            self.levels = [np.zeros(0)]
            known, numbers = self.values, self.counts
            self.values, self.counts = np.zeros(0), np.zeros(0, dtype=np.int64)
            self._lift(known, numbers)

    def _lift(self, values: np.ndarray, counts: np.ndarray | None) -> None:
        """Adds values to the levels; a count goes to the levels of its binary places."""
        if counts is None:
            self._put(0, values)
        else:
            for h in range(int(counts.max(initial=0)).bit_length()):
                self._put(h, values[counts >> h & 1 == 1])
        for h, level in enumerate(self.levels):
            if len(level) > self.most:
                level = np.sort(level)
                even = len(level) // 2 * 2
                self.levels[h] = level[even:]
                self.flips += 1
                self._put(h + 1, level[self.flips % 2:even:2])

    def _put(self, h: int, values: np.ndarray) -> None:
        while len(self.levels) <= h:
            self.levels.append(np.zeros(0))
        self.levels[h] = np.concatenate([self.levels[h], values])

    def merge(self, other: _Values) -> None:
        if other.levels is None:
            self.add(other.values, other.counts)
            return
        if self.levels is None:
            self.levels = [np.zeros(0)]
            known, numbers = self.values, self.counts
            self.values, self.counts = np.zeros(0), np.zeros(0, dtype=np.int64)
            self._lift(known, numbers)
        for h, level in enumerate(other.levels):
            self._put(h, level)
        self._lift(np.zeros(0), None)

    def weighted(self) -> tuple[np.ndarray, np.ndarray]:
        """Values in order with their weights."""
        if self.levels is None:
            return self.values, self.counts
        values = np.concatenate(self.levels)
        weights = np.concatenate([np.full(len(level), 1 << h) for h, level in enumerate(self.levels)])
        order = np.argsort(values, kind="stable")
        return values[order], weights[order]


class _OfValues(InParts):
    """An aggregate of the values in order; exact while a group has at most ``most`` different values."""

    def __init__(self, name: str, most: int = 8192):
        self.name, self.most = name, most

    def start(self) -> _Values:
        return _Values(self.most)

    def add(self, state: _Values, values: np.ndarray) -> _Values:
        state.add(values)
        return state

    def merge(self, one: _Values, other: _Values) -> _Values:
        one.merge(other)
        return one


class Quantile(_OfValues):
    """A quantile with linear interpolation."""

    def __init__(self, probability: float, name: str | None = None, most: int = 8192):
        super().__init__(name or f"q{probability:g}", most)
        self.probability = probability

    def finish(self, state: _Values) -> float | None:
        values, weights = state.weighted()
        if not len(values):
            return None
        upto = np.cumsum(weights)
        place = self.probability * (int(upto[-1]) - 1)
        low, high = (values[np.searchsorted(upto, k, side="right")] for k in (math.floor(place), math.ceil(place)))
        return float(low + (high - low) * (place - math.floor(place)))


class TrimmedMean(_OfValues):
    """The mean without a share of the rows at either end, rounded down to whole rows."""

    def __init__(self, share: float, name: str | None = None, most: int = 8192):
        super().__init__(name or f"trimmed{share:g}", most)
        self.share = share

    def finish(self, state: _Values) -> float | None:
        values, weights = state.weighted()
        n = int(weights.sum())
        cut = math.floor(self.share * n)
        if n - 2 * cut <= 0:
            return None
        upto = np.cumsum(weights)
        kept = np.clip(np.minimum(upto, n - cut) - np.maximum(upto - weights, cut), 0, None)
        return math.fsum((values * kept).tolist()) / (n - 2 * cut)


def aggregate_in_parts(df: DataFrame, keys: list[str], col: str, aggregate: InParts, alias: str) -> DataFrame:
    """``keys`` and an aggregate of ``col`` by its parts; groups without a value have a null."""
    rows = df.select(*keys, F.col(col).cast("double").alias("_value"))
    kinds = [rows.schema[k] for k in keys]
    states = T.StructType([*kinds, T.StructField("_place", T.IntegerType()), T.StructField("_state", T.BinaryType())])

    def frame(held: dict, place: int) -> pd.DataFrame:
        out = pd.DataFrame(list(held), columns=keys, dtype=object)
        out["_place"] = place
        out["_state"] = [pickle.dumps(s) for s in held.values()]
        return out

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, held = TaskContext.get().partitionId() % _PLACES, {}
        for part in frames:
            for key, values in part.groupby(keys, sort=False, dropna=False)["_value"]:
                key = key if isinstance(key, tuple) else (key,)
                state = held[key] if key in held else aggregate.start()
                held[key] = aggregate.add(state, values.dropna().to_numpy())
            if len(held) > _HELD:
                yield frame(held, place)
                held = {}
        if held:
            yield frame(held, place)

    def joined(part: pd.DataFrame) -> pd.DataFrame:
        state = None
        for raw in part["_state"]:
            other = pickle.loads(raw)
            state = other if state is None else aggregate.merge(state, other)
        out = part.head(1).copy()
        out["_state"] = [pickle.dumps(state)]
        return out

    def ended(part: pd.DataFrame) -> pd.DataFrame:
        out = joined(part)
        out[alias] = [aggregate.finish(pickle.loads(out["_state"].iloc[0]))]
        return out[[*keys, alias]]

    tree = rows.mapInPandas(first, states).withColumn("_place", F.floor(F.col("_place") / _FAN).cast("int"))
    tree = tree.groupBy(*keys, "_place").applyInPandas(joined, states)
    return tree.groupBy(*keys).applyInPandas(ended, T.StructType([*kinds, T.StructField(alias, T.DoubleType())]))
