"""Folds in windows and sessions of streams that give up no record silently: what comes too late, or makes a step fail, is data.

State is held with `transformWithState` by buckets of keys, with one text and one timer each (`running._Bucket`). Results
are streams of final rows, in the order in which the watermark closes them; their quarantine is read from the same state. The
engine drops late rows before its own windows see them; here the event time goes no further than the watermark's node, and
the state decides by itself.
"""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

from relstream.functions.times import complete, length_micros
from relstream.operators.sessions import END, START
from relstream.operators.windows import WINDOW, TimeWindows
from relstream.sources.topics import JSON_TIMES
from relstream.streaming.keyed import _delay, _parsed
from relstream.streaming.running import _Bucket, _by_name, _fields, _in_chunks, _key_text, _plain, _points, _points_of, _schema_of, _sorted, _state_of

_LATE = "later than the watermark"


def _told(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def _rows(stream, windows) -> DataFrame:
    """The stream's complete records under the windows' watermark; `stream.ts` is an instant."""
    if not stream.ts:
        raise ValueError("windows need event times")
    return complete(stream, _delay(windows))


def _record(stream) -> list[Column]:
    return [*_plain(stream), F.to_json(F.struct(*stream.value), JSON_TIMES).alias("text")]


def _result(stream, found: DataFrame, operator: str, bounds: tuple[str, str], schema: T.StructType):
    """Final rows and the quarantine out of `grp, first, last, state, at, seq0…, text, error`."""
    kinds = T.StructType([T.StructField(f"k{i}", stream.df.schema[k].dataType) for i, k in enumerate(stream.key)])
    found = found.withColumn("__g", _parsed("grp", kinds))
    named = [F.col("__g")[f"k{i}"].alias(k) for i, k in enumerate(stream.key)]
    seqs = [F.col(o).alias(s) for o, s in zip(_points(stream)[1:], stream.seq)]
    failed = found.where("error IS NOT NULL").select(
        F.lit(operator).alias("operator"), F.to_json(F.struct(*named), JSON_TIMES).alias("key"), F.col("text").alias("value"), "error",
        F.timestamp_micros("at").alias("ts"), F.to_json(F.struct(*seqs)).alias("seq"))
    times = [F.timestamp_micros(c).alias(b) for c, b in zip(("first", "last"), bounds)]
    df = found.where("error IS NULL").select(*named, *times, _parsed("state", schema).alias("__s"))
    keys = (*stream.key, *bounds)
    from relstream.model import RecordStream
    return RecordStream(df.select(*keys, "__s.*"), keys, tuple(schema.names), None, (), (*stream.rejects, failed))


class _Names:
    """How result rows are built: either a final state or a record with its error."""

    def __init__(self, numbers: list[str]):
        self.numbers = numbers
        self.schema = _fields("grp string", "first long", "last long", "state string", *[f"{n} long" for n in numbers], "text string", "error string")

    def final(self, grp: str, first: int, last: int, state: str | None) -> tuple:
        return (grp, first, last, state, *[None] * len(self.numbers), None, None)

    def failed(self, grp: str, point: tuple, text: str | None, error: str) -> tuple:
        return (grp, None, None, None, *point, text, error)


def _given(batch: pd.DataFrame, numbers: list[str]) -> list[tuple[tuple, str]]:
    return list(zip(_points_of(batch, numbers), batch["text"].tolist()))


# -- time windows --------------------------------------------------------------------------------

class _Window(_Bucket):
    """States of keys in windows, each until the watermark reaches its window's end."""

    def __init__(self, names: _Names, init: Callable, step: Callable):
        self.names, self.start, self.step = names, init, step

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        states = self._load()
        batch = _sorted(rows, self.names.numbers)
        yield from _in_chunks(self._results(batch, states, timerValues.getCurrentWatermarkInMs()), self.names.schema.names)
        self._put_away(states)

    def _results(self, batch: pd.DataFrame, states: dict, watermark: int) -> Iterator[tuple]:
        windows = zip(*[batch[c].tolist() for c in ("grp", "first", "last")])
        for (grp, first, last), (point, text) in zip(windows, _given(batch, self.names.numbers)):
            if self._closes(last) <= watermark:
                yield self.names.failed(grp, point, text, _LATE)
                continue
            name = f"{first} {last} {grp}"
            current = states.setdefault(name, None)
            try:
                states[name] = self.step(self.start() if current is None else current, json.loads(text))
            except Exception as error:  # the state stays, the record is data
                yield self.names.failed(grp, point, text, _told(error))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        states = self._load()
        yield from _in_chunks(self._closed(states, timerValues.getCurrentWatermarkInMs()), self.names.schema.names)
        self._put_away(states)

    def _closed(self, states: dict, watermark: int) -> Iterator[tuple]:
        for name in list(states):
            first, last, grp = name.split(" ", 2)
            if self._closes(int(last)) <= watermark:
                state = states.pop(name)
                if state is not None:
                    yield self.names.final(grp, int(first), int(last), json.dumps(state))

    def _put_away(self, states: dict) -> None:
        self._save(states)
        if states:
            self.handle.registerTimer(min(self._closes(int(name.split(" ", 2)[1])) for name in states))

    def _closes(self, last: int) -> int:
        return -(-int(last) // 1000)


def window_fold(stream, windows: TimeWindows, init: Callable[[], object], step: Callable[[object, dict], object],
                state_schema: T.StructType | str):
    """A Python `step(state, value)` inside each key and time window, as a stream of final rows with a quarantine.

    A window's row appears once the watermark (`windows.retention` behind the newest record) has reached its end. A record
    counts in every window that is still open, however far it lags itself. For each window that is already out it is in the
    quarantine, as it is where `step` raises, which leaves the state alone. A window whose step gives None last has no row.
    Kept and quarantined records together are the input. Windows without an end are refused.
    """
    if not isinstance(windows, TimeWindows):
        raise ValueError("a window that never ends has no final row")
    schema, names = _schema_of(state_schema), _Names(_points(stream))
    rows = windows.assign(_rows(stream, windows), stream.ts)
    bounds = [F.unix_micros(F.col(f"{WINDOW}.{side}").cast("timestamp")).alias(name) for side, name in (("start", "first"), ("end", "last"))]
    rows = rows.select(_key_text(*[F.col(k) for k in stream.key]).alias("grp"), *bounds, *_record(stream))
    found = _state_of(rows, ["grp", "first", "last"], _Window(names, init, step), names.schema, "EventTime")
    return _result(stream, found, "window_fold", ("window_start", "window_end"), schema)


# -- sessions ------------------------------------------------------------------------------------

class _Sessions:
    """Sessions of one key in order of time, more than a gap apart from each other."""

    def __init__(self, gap: int, merge: Callable, known: list[tuple[int, int, object]] = ()):
        self.gap, self.merge = gap, merge
        self.firsts, self.lasts, self.states = ([s[i] for s in known] for i in range(3))

    def _near(self, first: int, last: int) -> slice:
        """The sessions that one from `first` to `last` joins."""
        return slice(bisect_left(self.lasts, first - self.gap), bisect_right(self.firsts, last + self.gap))

    def add(self, at: int, value: dict, init: Callable, step: Callable) -> list[tuple[object, str]]:
        """Takes a record into the session that it follows, or into one of its own; raises what `step` raises."""
        near = self._near(at, at)
        follows = near.start < near.stop and self.firsts[near.start] <= at
        before = self.states[near.start] if follows else None
        state = step(init() if before is None else before, value)
        if follows:
            i = near.start
            self.states[i], self.lasts[i] = state, max(self.lasts[i], at)
            return self._joined(near)
        return self.put(at, at, state)

    def put(self, first: int, last: int, state: object) -> list[tuple[object, str]]:
        """Takes a session in; one that fails to merge is given back with the error, and the earlier state stays."""
        near = self._near(first, last)
        place = bisect_right(self.firsts, first, near.start, near.stop)
        for values, value in ((self.firsts, first), (self.lasts, last), (self.states, state)):
            values.insert(place, value)
        return self._joined(slice(near.start, near.stop + 1))

    def _joined(self, near: slice) -> list[tuple[object, str]]:
        if near.stop - near.start < 2:
            return []
        failed, (state, *others) = [], self.states[near]
        for other in others:
            if state is None or other is None:
                state = other if state is None else state
                continue
            try:
                state = self.merge(state, other)
            except Exception as error:
                failed.append((other, _told(error)))
        self.firsts[near], self.lasts[near], self.states[near] = [min(self.firsts[near])], [max(self.lasts[near])], [state]
        return failed

    def closed(self, watermark: int) -> list[tuple[int, int, object]]:
        """Takes out the sessions that no record on time can reach any more."""
        until = bisect_left(self.lasts, watermark - self.gap)
        done = list(zip(self.firsts[:until], self.lasts[:until], self.states[:until]))
        del self.firsts[:until], self.lasts[:until], self.states[:until]
        return done


class _Session(_Bucket):
    """Keys' open sessions, in order of time."""

    def __init__(self, names: _Names, gap: int, init: Callable, step: Callable, merge: Callable):
        self.names, self.gap, self.start, self.step, self.merge = names, gap, init, step, merge

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from _in_chunks(self._results(key, rows, timerValues.getCurrentWatermarkInMs() * 1000), self.names.schema.names)

    def _results(self, key, rows, watermark: int) -> Iterator[tuple]:
        states = self._load()
        for grp, given in self._given(key, rows).items():
            sessions = _Sessions(self.gap, self.merge, states.get(grp, ()))
            yield from self._taken(grp, given, sessions, watermark)
            self._hold(states, grp, sessions)
        yield from self._settled(states, watermark)

    def _given(self, key, rows) -> dict:
        """The bucket's rows by key, in order; rows that name none are of the group's own."""
        batch = _sorted(rows, self.names.numbers)
        return _by_name(batch["grp"].tolist() if "grp" in batch else [key[0]] * len(batch), _given(batch, self.names.numbers))

    def _taken(self, grp: str, given: list, sessions: _Sessions, watermark: int) -> Iterator[tuple]:
        """Adds the records on time to `sessions`; the others, and those that fail, are results."""
        for point, text in given:
            if point[0] + self.gap <= watermark:
                yield self.names.failed(grp, point, text, _LATE)
                continue
            try:
                unmerged = sessions.add(point[0], json.loads(text), self.start, self.step)
            except Exception as error:
                yield self.names.failed(grp, point, text, _told(error))
                continue
            for state, error in unmerged:
                yield self.names.failed(grp, point, json.dumps(state), error)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        settled = self._settled(self._load(), timerValues.getCurrentWatermarkInMs() * 1000)
        yield from _in_chunks(settled, self.names.schema.names)

    def _hold(self, states: dict, grp: str, sessions: _Sessions) -> None:
        if sessions.firsts:
            states[grp] = list(zip(sessions.firsts, sessions.lasts, sessions.states))
        else:
            states.pop(grp, None)

    def _settled(self, states: dict, watermark: int) -> Iterator[tuple]:
        for grp in [g for g, known in states.items() if known[0][1] < watermark - self.gap]:
            sessions = _Sessions(self.gap, self.merge, states[grp])
            for first, last, state in sessions.closed(watermark):
                if state is not None:
                    yield self.names.final(grp, first, last, json.dumps(state))
            self._hold(states, grp, sessions)
        self._save(states)
        if states:
            self.handle.registerTimer((min(known[0][1] for known in states.values()) + self.gap) // 1000 + 1)


class _Part(_Session):
    """The sessions of parts of keys' records in one micro-batch, passed on at once: nothing stays here."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def _results(self, key, rows, watermark: int) -> Iterator[tuple]:
        for grp, given in self._given(key, rows).items():
            sessions = _Sessions(self.gap, self.merge)
            yield from self._taken(grp, given, sessions, watermark)
            for first, last, state in zip(sessions.firsts, sessions.lasts, sessions.states):
                yield self.names.final(grp, first, last, None if state is None else json.dumps(state))


class _Parts(_Session):
    """Keys' open sessions, from the sessions of their parts."""

    def _given(self, key, rows) -> dict:
        found: dict = {}
        for frame in rows:
            for grp, *row in zip(*[frame[n].tolist() for n in self.names.schema.names]):
                found.setdefault(grp, []).append(row)
        return found

    def _taken(self, grp: str, given: list, sessions: _Sessions, watermark: int) -> Iterator[tuple]:
        for first, last, state, *rest in given:
            if isinstance(rest[-1], str):  # a record that its part gave up
                yield self.names.failed(grp, tuple(int(n) for n in rest[:-2]), rest[-2], rest[-1])
                continue
            for other, error in sessions.put(int(first), int(last), json.loads(state) if isinstance(state, str) else None):
                yield self.names.failed(grp, (int(first), *[-1] * (len(self.names.numbers) - 1)), json.dumps(other), error)


def session_fold(stream, windows, init: Callable[[], object], step: Callable[[object, dict], object],
                 merge: Callable[[object, object], object], state_schema: T.StructType | str, spread: int = 1):
    """`window_fold` inside each key's sessions; a session's row appears once the watermark is more than a gap past its end.

    A record further than a gap behind the watermark is too late. One that connects two sessions `merge`s the earlier's state
    with the later's. Where `step` fails the record changes nothing and is in the quarantine; where `merge` fails the earlier
    state stays and the later one is there, as the value of the record that connects them.

    `spread` is for keys with very many records: they are dealt out to that many groups, each of which makes sessions of its own
    part of a micro-batch, and the key merges those. Its group then has a row per part and session. Parts mix in time, so `step` and
    `merge` must not depend on order.
    """
    schema, names, gap = _schema_of(state_schema), _Names(_points(stream)), length_micros(windows.gap)
    salt = F.pmod(F.xxhash64(*stream.order), F.lit(spread)).cast("int").alias("salt")
    rows = _rows(stream, windows).select(_key_text(*[F.col(k) for k in stream.key]).alias("grp"), salt, *_record(stream))
    if spread == 1:
        found = _state_of(rows.drop("salt"), ["grp"], _Session(names, gap, init, step, merge), names.schema, "EventTime")
    else:
        parts = _state_of(rows, ["grp", "salt"], _Part(names, gap, init, step, merge), names.schema, "EventTime")
        found = _state_of(parts, ["grp"], _Parts(names, gap, init, step, merge), names.schema, "EventTime")
    return _result(stream, found, "session_fold", (START, END), schema)
