"""Streaming forms of the operators that need per-key state: joins with tables, change rows, folds.

All of them are `applyInPandasWithState` over small frames: a key as JSON text, the order as numbers, the
value as JSON text. A group of the engine costs milliseconds whatever it holds, so keys are dealt by their
hash into buckets (`relstream.state.buckets`, fixed for the life of a checkpoint), and a bucket is a group:
its rows of one micro-batch are sorted and taken one by one, its keys' states are one JSON text that is read
and written once. The size of a micro-batch is set at the source (`maxFilesPerTrigger`,
`maxBytesPerTrigger`), and no group is larger than that.

Seq columns must be whole numbers here. Rows of one key have to reach the stream in order as far as
micro-batches go. An update that is not after the version in state, by the whole order (time, then
seq), changes nothing and goes to the quarantine; `changes` marks it with `op = 0` where asked.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from relstream.functions.predicates import all_of, all_present
from relstream.functions.times import complete, length_micros
from relstream.operators.joiners import LEFT, RIGHT, Joiner
from relstream.operators.joins import _check
from relstream.operators.sessions import END, START
from relstream.operators.tables import OP
from relstream.operators.windows import WINDOW
from relstream.sources.topics import JSON_TIMES, encode_json

_TEXT = "__text"
_SIDE = "__side"
_AT = "__at"
_KEY = "__key"
_BUCKET = "__bucket"
#: Stands for a missing number of the order: last, as a whole number, so that no other number of the bucket becomes a float.
_NEVER = (1 << 63) - 1


def _numbers(flow) -> list[Column]:
    """The order columns as whole numbers: event time in microseconds, then seq."""
    time = [F.unix_micros(F.col(flow.ts).cast("timestamp")).alias(_AT)] if flow.ts else [F.lit(0).cast("long").alias(_AT)]
    return [*time, *[F.col(s).cast("long").alias(f"__seq{i}") for i, s in enumerate(flow.seq)]]


def _order(flow, side_first: bool = True) -> list[str]:
    seqs = [f"__seq{i}" for i in range(len(flow.seq))]
    return [_AT, _SIDE, *seqs] if flow.ts and side_first else [_AT, *seqs, _SIDE]


def _schema(df: DataFrame, names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, df.schema[n].dataType) for n in names])


def _parsed(text: str, schema: T.StructType) -> Column:
    return F.from_json(F.col(text), schema, JSON_TIMES)


def _key(df: DataFrame, names: list[str]) -> Column:
    """A row's key as one text, equal where the columns are."""
    def plain(name: str) -> Column:
        kind = df.schema[name].dataType
        return F.col(name) + F.lit(0.0).cast(kind) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(name)  # -0.0 is 0.0
    return F.to_json(F.struct(*[plain(n).alias(f"k{i}") for i, n in enumerate(names)]), JSON_TIMES).alias(_KEY)


def bucket_of(df: DataFrame, *parts: Column) -> Column:
    """The bucket of a key; how many there are must stay as it is while a checkpoint is used."""
    return F.pmod(F.xxhash64(*parts), F.lit(int(df.sparkSession.conf.get("relstream.state.buckets", "256")))).cast("int")


def _bucketed(df: DataFrame, names: list[str], *rest: Column | str) -> DataFrame:
    """`rest` under the row's key, by bucket."""
    keyed = df.select(_key(df, names), *rest)
    keyed = keyed.select(*[F.coalesce(c, F.lit(_NEVER)).alias(c) if c == _AT or c.startswith("__seq") else c for c in keyed.columns])
    return keyed.withColumn(_BUCKET, bucket_of(df, F.col(_KEY)))


def _unpacked(df: DataFrame, keys: list[str], schema: T.StructType) -> DataFrame:
    """Results with the columns of their key in place of its text."""
    kinds = T.StructType([T.StructField(f"k{i}", schema[k].dataType) for i, k in enumerate(keys)])
    rest = [c for c in df.columns if c != _KEY]
    return df.withColumn("__k", _parsed(_KEY, kinds)).select(*[F.col("__k")[f"k{i}"].alias(k) for i, k in enumerate(keys)], *rest)


def _given(frames: Iterator[pd.DataFrame], order: list[str], columns: list[str]) -> Iterator[tuple]:
    """The bucket's rows in order; a text that is missing is None."""
    batch = pd.concat(list(frames), ignore_index=True).sort_values(order, kind="stable", ignore_index=True)
    return zip(*[batch[c].tolist() for c in columns])


def _after(at: list[int], point: list[int] | None) -> bool:
    """Whether a place in the order is after a version's; one that is not known is after none."""
    return _NEVER not in at and (point is None or at > point)


def _shown(at: list[int]) -> list[int | None]:
    return [None if n == _NEVER else n for n in at]


def _held(state: GroupState) -> dict:
    return json.loads(state.get[0]) if state.exists else {}


def _keep(state: GroupState, held: dict) -> None:
    if held:
        state.update((json.dumps(held),))
    elif state.exists:
        state.remove()


def _frame(rows: list[tuple], out: T.StructType) -> Iterator[pd.DataFrame]:
    if rows:
        yield pd.DataFrame(rows, columns=out.names, dtype=object)


def _too_late(found: DataFrame, operator: str, flow, names: list[str], order: list[str]) -> DataFrame:
    """Quarantine rows for updates that came after a later one of their key."""
    return found.select(
        F.lit(operator).alias("operator"),
        F.to_json(F.struct(*[F.col(n).alias(k) for n, k in zip(names, flow.key)]), JSON_TIMES).alias("key"),
        F.col(_TEXT).alias("value"), F.lit("older than the version in state").alias("error"),
        (F.timestamp_micros(_AT) if flow.ts else F.lit(None).cast("timestamp")).alias("ts"),
        F.to_json(F.struct(*[F.col(o).alias(s) for o, s in zip(order, flow.seq)])).alias("seq"),
    )


def _stateful(df: DataFrame, handle: Callable, output: T.StructType, mode: str = "append",
              timeout: str = GroupStateTimeout.NoTimeout) -> DataFrame:
    return df.groupBy(_BUCKET).applyInPandasWithState(handle, output, "text string", mode, timeout)


def _output(*fields: str) -> T.StructType:
    return T._parse_datatype_string(", ".join((f"{_KEY} string", *fields)))


# -- change rows ---------------------------------------------------------------------------------

def changes(table, with_late: bool = False) -> DataFrame:
    """The streaming form of `table.changes()`: -1 takes the replaced value back, +1 adds the new.

    `with_late` adds the updates that came too late to change anything, as rows with `op = 0`.
    """
    keys, order = list(table.key), [_AT, *[f"__seq{i}" for i in range(len(table.seq))]]
    given = table.rows()
    rows = _bucketed(given, keys, *_numbers(table), encode_json(table.value).alias(_TEXT))
    out = _output(f"{OP} int", f"{_TEXT} string", *[f"{o} long" for o in order])

    def handle(key, frames, state: GroupState):
        held, began, found = _held(state), {}, []
        for name, text, *at in _given(frames, order, [_KEY, _TEXT, *order]):
            at = list(map(int, at))
            known, old = held.get(name, (None, None))
            point = began.setdefault(name, known)  # late is what is not after the version before this micro-batch
            if not _after(at, point):
                if with_late:
                    found.append((name, 0, text, *_shown(at)))
                continue
            if old is not None:
                found.append((name, -1, old, *at))
            if text is not None:
                found.append((name, 1, text, *at))
            held[name] = (at, text)
        _keep(state, held)
        yield from _frame(found, out)

    found = _unpacked(_stateful(rows, handle, out), keys, given.schema)
    value = _parsed(_TEXT, _schema(table.df, list(table.value)))
    time = [F.timestamp_micros(_AT).alias(table.ts)] if table.ts else []
    seqs = [F.col(f"__seq{i}").cast(table.df.schema[s].dataType).alias(s) for i, s in enumerate(table.seq)]
    return found.select(*keys, OP, value.alias("__v"), *time, *seqs).select(
        *keys, OP, "__v.*", *[c for c in (table.ts, *table.seq) if c])


# -- joins ---------------------------------------------------------------------------------------

def join_table(stream, table, joiner=None, how: str = "inner", on: dict[str, Column] | None = None, spread: int = 1):
    """The streaming form of `stream.join_table(table)`.

    `spread` deals the records of every key out to that many groups, each with its own copy of the
    key's version, so that a key with very many records is not one task's work.
    """
    _check(how, "inner", "left")
    names = [f"__jk{i}" for i in range(len(table.key))]
    sources = list(on.values()) if on else [F.col(k) for k in stream.key]
    if len(sources) != len(names):
        raise ValueError(f"join key has {len(sources)} columns, the table's key has {len(names)}")
    carried = [*stream.key, *stream.value, *stream.order]
    usable = stream.rows().where(stream.has_key & stream.has_value)
    salt = F.pmod(F.xxhash64(*stream.seq), F.lit(spread)).cast("int")
    records = usable.select(
        *[c.alias(n) for n, c in zip(names, sources)], salt.alias("__salt"), F.lit(1).alias(_SIDE), *_numbers(stream),
        F.to_json(F.struct(*carried), JSON_TIMES).alias(_TEXT),
    )
    rejects = stream.all_rejects(table)
    if how == "inner":
        failed = usable.where(~all_of(c.isNotNull() for c in sources))
        rejects = (*rejects, stream.reject("join_table", failed, "no join key")) if on else rejects
        records = records.where(all_present(names))
    versions = table.rows().select(
        *[F.col(k).alias(n) for k, n in zip(table.key, names)],
        F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("__salt"),
        F.lit(0).alias(_SIDE), *_numbers(table), encode_json(table.value).alias(_TEXT),
    )
    united = records.unionByName(versions)
    order = _order(stream)
    points = [_AT, *[f"__seq{i}" for i in range(len(table.seq))]]
    absent = [F.isnan(n) if isinstance(united.schema[n].dataType, (T.FloatType, T.DoubleType)) else F.lit(False) for n in names]
    missing = ~all_of(F.col(n).isNotNull() & ~nan for n, nan in zip(names, absent))
    rows = _bucketed(united, names, "__salt", missing.alias("__missing"), _SIDE, *points, _TEXT) \
        .withColumn(_BUCKET, bucket_of(united, F.col(_KEY), F.col("__salt")))
    out = _output(*[f"{p} long" for p in points], f"{_TEXT} string", "__version string", "__late boolean")

    def handle(key, frames, state: GroupState):
        held, began, found = _held(state), {}, []
        for name, salt, missing, side, text, *at in _given(frames, order, [_KEY, "__salt", "__missing", _SIDE, _TEXT, *points]):
            part, at = f"{salt} {name}", list(map(int, at))
            if missing:  # a missing join key matches nothing
                if side == 1:
                    found.append((name, *_shown(at), text, None, False))
                continue
            known, version = held.get(part, (None, None))
            point = began.setdefault(part, known)
            if side == 1:
                found.append((name, *_shown(at), text, version, False))
            elif _after(at, point):
                held[part] = (at, text)
            elif salt == 0:
                found.append((name, *_shown(at), text, version, True))
        _keep(state, held)
        yield from _frame(found, out)

    found = _unpacked(_stateful(rows, handle, out), names, united.schema)
    rejects = (*rejects, _too_late(found.where("__late"), "join_table", table, names, points[1:]))
    joined = found.where("NOT __late")
    if how == "inner":
        joined = joined.where(F.col("__version").isNotNull())
    record = _parsed(_TEXT, _schema(stream.df, carried))
    rows = joined.select(record.alias("__record"), _parsed("__version", _schema(table.df, list(table.value))).alias(RIGHT))
    rows = rows.select("__record.*", RIGHT).withColumn(LEFT, F.struct(*stream.value))
    return stream._joined("join_table", rows, Joiner.of(joiner, stream.value, table.value), rejects)


def join_changelog(left, right, joiner=None, how: str = "inner"):
    """The streaming form of `left.join_changelog(right)`: a log of the joined table."""
    _check(how, "inner", "left", "full")
    names = [f"__k{i}" for i in range(len(left.key))]
    order = _order(left, side_first=False)

    def log(table, side: int) -> DataFrame:
        return table.rows().select(
            *[F.col(k).alias(n) for k, n in zip(table.key, names)], F.lit(side).alias(_SIDE), *_numbers(table),
            encode_json(table.value).alias(_TEXT),
        )

    united = log(left, 0).unionByName(log(right, 1))

    numbers = [o for o in order if o != _SIDE]
    exists = {"inner": lambda l, r: l and r, "left": lambda l, r: l, "full": lambda l, r: l or r}[how]
    rows = _bucketed(united, names, *order, _TEXT)
    out = _output(*[f"{o} long" for o in numbers], f"{_SIDE} int", f"{_TEXT} string", "__left string", "__right string", "__exists boolean")

    def handle(key, frames, state: GroupState):
        held, began, found = _held(state), {}, []
        for name, side, text, *at in _given(frames, order, [_KEY, _SIDE, _TEXT, *numbers]):
            at = list(map(int, at))
            points, texts = held.get(name, ((None, None), (None, None)))
            point = began.setdefault(name, points)[side]
            if not _after(at, point):
                found.append((name, *_shown(at), side, text, None, None, None))
                continue
            now = (text, texts[1]) if side == 0 else (texts[0], text)
            held[name] = ((at, points[1]) if side == 0 else (points[0], at), now)
            is_now, was_before = (exists(*[t is not None for t in both]) for both in (now, texts))
            if is_now or was_before:
                found.append((name, *at, side, None, *now, is_now))
        _keep(state, held)
        yield from _frame(found, out)

    every = _unpacked(_stateful(rows, handle, out), names, united.schema)
    late, found = every.where("__exists IS NULL"), every.where("__exists IS NOT NULL")
    # One frame for both sides, under the left one's names: a stream takes no two such operators in one query.
    rejects = (*left.all_rejects(right), _too_late(late, "join_changelog", left, names, numbers[1:]))
    time = [F.timestamp_micros(_AT).alias(left.ts)] if left.ts else []
    rows = found.select(
        *[F.col(n).alias(k) for n, k in zip(names, left.key)],
        _parsed("__left", _schema(left.df, list(left.value))).alias(LEFT),
        _parsed("__right", _schema(right.df, list(right.value))).alias(RIGHT), "__exists", *time,
        *[F.col(f"__seq{i}").cast(left.df.schema[s].dataType).alias(s) for i, s in enumerate(left.seq)],
    )
    joiner = Joiner.of(joiner, left.value, right.value)
    columns = joiner.columns(emit=F.col("__exists"))
    df = rows.select(*left.key, *[c.alias(n) for n, c in columns.items()], *left.order)
    failed = joiner.rejects(left, "join_changelog", rows, F.col("__exists"))
    return left.with_(df=df, value=tuple(columns), rejects=(*rejects, *failed))


# -- folds ---------------------------------------------------------------------------------------

def fold(stream, init: Callable[[], object], step: Callable[[object, dict], object], state_schema: T.StructType | str):
    """Folds each key's records with a Python `step(state, value)` that need not be mergeable.

    For logic that `GroupedRecords.fold` cannot split. The state is a JSON-like object described by
    `state_schema`; where `step` raises the state stays as it was, and where it returns None the key
    is deleted and starts again from `init()`. Runs in update mode: one row per changed key, with
    `live` false for a deleted one.
    """
    keys, order = list(stream.key), [_AT, *[f"__seq{i}" for i in range(len(stream.seq))]]
    given = stream.rows().where(stream.has_key & stream.has_value)
    rows = _bucketed(given, keys, *_numbers(stream), F.to_json(F.struct(*stream.value), JSON_TIMES).alias(_TEXT))
    schema = T._parse_datatype_string(state_schema) if isinstance(state_schema, str) else state_schema
    out = _output("live boolean", f"{_TEXT} string")

    def handle(key, frames, state: GroupState):
        held, changed = _held(state), {}
        for name, text in _given(frames, order, [_KEY, _TEXT]):
            held[name] = _stepped(held.get(name), init, step, json.loads(text))
            changed[name] = True
        _keep(state, held)
        yield from _frame([(n, held[n] is not None, None if held[n] is None else json.dumps(held[n])) for n in changed], out)

    folded = _unpacked(_stateful(rows, handle, out, "update"), keys, given.schema)
    return folded.select(*keys, "live", _parsed(_TEXT, schema).alias("__s")).select(*keys, "live", "__s.*")


def window_fold(stream, windows, init: Callable[[], object], step: Callable[[object, dict], object],
                state_schema: T.StructType | str) -> DataFrame:
    """`fold` inside each key and time window; a window's row is final and appears once the watermark has passed its end.

    `windows` needs a retention, the watermark delay. State is kept per key and window and dropped with the row. Records
    of a window that is already out are ignored, as Spark's own windows do.
    """
    order = [_AT, *[f"__seq{i}" for i in range(len(stream.seq))]]
    given = windows.assign(complete(stream, _delay(windows)), stream.ts)
    # Bounds are instants in microseconds: as times they would reach Python in the session's zone.
    bounds = [F.unix_micros(F.col(f"{WINDOW}.{side}").cast("timestamp")).alias(f"window_{side}") for side in ("start", "end")]
    rows = _bucketed(given, list(stream.key), *bounds, *_numbers(stream), F.to_json(F.struct(*stream.value), JSON_TIMES).alias(_TEXT),
                     F.col(stream.ts).alias("__time"))
    rows = rows.withColumn(_BUCKET, bucket_of(given, F.col(_KEY), F.col("window_start")))
    schema = T._parse_datatype_string(state_schema) if isinstance(state_schema, str) else state_schema
    out = _output("window_start long", "window_end long", f"{_TEXT} string")

    def handle(key, frames, state: GroupState):
        watermark, held = state.getCurrentWatermarkMs(), _held(state)
        closes = lambda end: -(-end // 1000)
        if not state.hasTimedOut:
            for name, start, end, text in _given(frames, order, [_KEY, "window_start", "window_end", _TEXT]):
                if closes(end) > watermark:
                    part = f"{start} {end} {name}"
                    held[part] = _stepped(held.get(part), init, step, json.loads(text))
        ends = {part: closes(int(part.split(" ", 2)[1])) for part in held}
        found = []
        for part in [p for p, end in ends.items() if end <= watermark]:
            current, (start, end, name) = held.pop(part), part.split(" ", 2)
            del ends[part]
            if current is not None:
                found.append((name, int(start), int(end), json.dumps(current)))
        _keep(state, held)
        if held:
            state.setTimeoutTimestamp(min(ends.values()))
        yield from _frame(found, out)

    folded = _unpacked(_stateful(rows, handle, out, timeout=GroupStateTimeout.EventTimeTimeout), list(stream.key), given.schema)
    keys = [*stream.key, "window_start", "window_end"]
    times = [F.timestamp_micros(k).alias(k) for k in keys[-2:]]
    return folded.select(*stream.key, *times, _parsed(_TEXT, schema).alias("__s")).select(*keys, "__s.*")


def session_fold(stream, windows, init: Callable[[], object], step: Callable[[object, dict], object],
                 merge: Callable[[object, object], object], state_schema: T.StructType | str) -> DataFrame:
    """`fold` inside each key's sessions; a session's row is final and appears once the watermark is a gap past its end.

    Records of a micro-batch are taken in order and extend the session that they follow; one that connects two sessions
    `merge`s the earlier's state with the later's. `windows` needs a retention. A key's open sessions, in order of time, are its state.
    """
    keys, order = list(stream.key), [_AT, *[f"__seq{i}" for i in range(len(stream.seq))]]
    given = complete(stream, _delay(windows))
    rows = _bucketed(given, keys, *_numbers(stream), F.to_json(F.struct(*stream.value), JSON_TIMES).alias(_TEXT), F.col(stream.ts).alias("__time"))
    schema = T._parse_datatype_string(state_schema) if isinstance(state_schema, str) else state_schema
    gap = length_micros(windows.gap)
    out = _output("__from long", "__to long", f"{_TEXT} string")

    def handle(key, frames, state: GroupState):
        watermark, held, found = state.getCurrentWatermarkMs() * 1000, _held(state), []
        if not state.hasTimedOut:
            for name, at, text in _given(frames, order, [_KEY, _AT, _TEXT]):
                if at + gap > watermark:
                    held[name] = _with_record(held.get(name, []), at, json.loads(text), gap, init, step, merge)
        for name in [n for n, known in held.items() if known[0][1] + gap < watermark]:
            waiting = [s for s in held[name] if s[1] + gap >= watermark]
            found += [(name, s[0], s[1], json.dumps(s[2])) for s in held[name] if s[1] + gap < watermark and s[2] is not None]
            if waiting:
                held[name] = waiting
            else:
                del held[name]
        _keep(state, held)
        if held:
            first = min(s[0][1] for s in held.values())
            state.setTimeoutTimestamp(max((first + gap) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        yield from _frame(found, out)

    folded = _unpacked(_stateful(rows, handle, out, timeout=GroupStateTimeout.EventTimeTimeout), keys, given.schema)
    bounds = [F.timestamp_micros("__from").alias(START), F.timestamp_micros("__to").alias(END)]
    return folded.select(*keys, *bounds, _parsed(_TEXT, schema).alias("__s")).select(*keys, START, END, "__s.*")


def _delay(windows):
    if windows.retention is None:
        raise ValueError("windows on a stream need a retention, the watermark delay")
    return windows.retention


def _stepped(current, init: Callable, step: Callable, value: dict):
    try:
        return step(init() if current is None else current, value)
    except Exception:  # a failing step leaves the state alone
        return current


def _with_record(found: list, at: int, value: dict, gap: int, init: Callable, step: Callable, merge: Callable) -> list:
    """The sessions, [first, last, state] in order of time, with one more record."""
    before = [s for s in found if s[1] < at - gap]
    after = [s for s in found if s[0] > at + gap]
    near = [s for s in found if s[1] >= at - gap and s[0] <= at + gap]
    earlier = [s for s in near if s[0] <= at]
    if earlier:
        first, last, state = earlier[0]
        joined = [first, max(last, at), _stepped(state, init, step, value)]
    else:
        joined = [at, at, _stepped(None, init, step, value)]
    for first, last, state in near[len(earlier[:1]):]:
        if state is None or joined[2] is None:
            both = state if joined[2] is None else joined[2]
        else:
            try:
                both = merge(joined[2], state)
            except Exception:  # a failing merge keeps the earlier state
                both = joined[2]
        joined = [min(joined[0], first), max(joined[1], last), both]
    return [*before, joined, *after]
