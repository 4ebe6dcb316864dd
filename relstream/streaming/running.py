"""Running tables: foreign-key joins, adder/subtractor aggregates, and as-of joins with a history of versions.

The first two take the change rows of a table (`keyed.changes`: what an update takes back and what it adds) into a second
keyed state of the same query. Results are logs of versions, tables in their own right. State is held with
`transformWithState` by buckets of keys (`keyed.bucket_of`): one text per bucket, read and written once in a micro-batch that
touches it, and a timer for the first of its keys that waits.
"""

from __future__ import annotations

import json
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from relstream.functions.predicates import all_of
from relstream.functions.times import interval_text, length_micros
from relstream.operators.joiners import LEFT, RIGHT, Joiner
from relstream.operators.joins import _check
from relstream.operators.tables import OP
from relstream.sources.topics import JSON_TIMES, encode_json
from relstream.streaming.keyed import _numbers, _parsed, _schema, bucket_of, changes

#: Result rows passed on at once.
_CHUNK = 5_000
#: Where no row of the right side has been seen, and where a row has left its group.
_NO_RIGHT, _GONE = -1, -2
_LATE = "older than the version in state"



def _plain(flow) -> list[Column]:
    """The order as whole numbers under names without leading underscores, which the state's rows cannot have."""
    return [c.alias(n) for c, n in zip(_numbers(flow), _points(flow))]


def _points(flow) -> list[str]:
    return ["at", *[f"seq{i}" for i in range(len(flow.seq))]]


def _fields(*fields: str) -> T.StructType:
    return T._parse_datatype_string(", ".join(fields))


def _key_text(*columns: Column) -> Column:
    """The key as one text: a group's key in the state is never null, and "" stands for a key that is."""
    return F.when(all_of(c.isNotNull() for c in columns), F.to_json(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(columns)]), JSON_TIMES)) \
        .otherwise("")


def _state_of(df: DataFrame, keys: list[str], processor: StatefulProcessor, output: T.StructType, time: str = "None") -> DataFrame:
    """`processor` over the buckets of `keys`."""
    dealt = df.withColumn("bucket", bucket_of(df, *[F.col(k) for k in keys]))
    return dealt.groupBy("bucket").transformWithStateInPandas(processor, output, "Append", time)


class _Bucket(StatefulProcessor):
    """States of many keys by name, as one JSON text: a group of the engine, and each access to its state, costs far more
    than a key does."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "text string")

    def _load(self) -> dict:
        packed = self.held.get()
        return {} if packed is None else json.loads(packed[0])

    def _save(self, states: dict) -> None:
        if states:
            self.held.update((json.dumps(states),))
        else:
            self.held.clear()

    def close(self) -> None:
        pass


def _by_name(names: list, rows: list) -> dict:
    """Rows of each name, in the order given."""
    found: dict = {}
    for name, row in zip(names, rows):
        found.setdefault(name, []).append(row)
    return found


def _points_of(batch: pd.DataFrame, numbers: list[str]) -> list[tuple[int, ...]]:
    return [tuple(map(int, row)) for row in zip(*[batch[n].tolist() for n in numbers])]


def _sorted(frames: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return pd.concat(list(frames), ignore_index=True).sort_values(order, kind="stable", ignore_index=True)


def _in_chunks(rows: Iterator[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= _CHUNK:
            yield pd.DataFrame(held, columns=names, dtype=object)
            held = []
    if held:
        yield pd.DataFrame(held, columns=names, dtype=object)


# -- foreign-key joins ---------------------------------------------------------------------------

class _Subscriptions(_Bucket):
    """For each foreign key (and salt): the right row, and which left rows point at it.

    `mine` maps a left key to its version, so that an update of the right row reaches each of them without a search.
    """

    def __init__(self, names: list[str], numbers: list[str], inner: bool):
        self.names, self.numbers, self.inner = names, numbers, inner

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        states = self._load()
        yield from _in_chunks(self._results(_sorted(rows, [*self.numbers, "side", OP]), states), self.names)
        self._save(states)

    def _results(self, batch: pd.DataFrame, states: dict) -> Iterator[tuple]:
        names = [f"{salt} {fk}" for salt, fk in zip(batch["salt"].tolist(), batch["fk"].tolist())]
        points = [list(p) for p in _points_of(batch, self.numbers)]
        given = list(zip(points, *[batch[c].tolist() for c in ("side", OP, "mine", "text")]))
        for name, own in _by_name(names, given).items():
            state = states.setdefault(name, {"at": None, "text": None, "mine": {}})
            yield from self._of(own, state, name.endswith(" "))
            if state["at"] is None and not state["mine"]:
                del states[name]

    def _of(self, given: list, state: dict, missing: bool) -> Iterator[tuple]:
        right_at, right, mine = state["at"], state["text"], state["mine"]
        none = [_NO_RIGHT] * len(self.numbers)
        for k, (at, side, op, key, text) in enumerate(given):
            if side == 0:
                present = right is not None
                if op == 0:
                    yield key, *at, *none, text, None, False, _LATE
                elif missing and self.inner:
                    if op > 0:
                        yield key, *at, *none, text, None, False, "no foreign key"
                elif op < 0:
                    replaced = k + 1 < len(given) and given[k + 1][:4] == (at, 0, 1, key)
                    if not replaced:
                        mine.pop(key, None)
                        if present or not self.inner:
                            yield key, *at, *([_GONE] * len(at)), None, None, False, None
                else:
                    mine[key] = (at, text)
                    if present or not self.inner:
                        yield key, *at, *(right_at or none), text, right, True, None
            elif missing or (right_at is not None and at <= right_at):
                yield None, *at, *none, None, text, False, _LATE
            else:
                before, right, right_at = right is not None, text if isinstance(text, str) else None, at
                if self.inner and not before and right is None:
                    continue
                exists = right is not None or not self.inner
                for subscriber, (left_at, left) in mine.items():
                    yield subscriber, *left_at, *at, left, right, exists, None
        state.update(at=right_at, text=right)


def join_foreign(left, right, on: dict[str, Column], joiner=None, how: str = "inner", spread: int = 1):
    """The streaming form of `left.join_foreign(right, on)`: a log of the joined table, by the left key.

    `on` computes the right table's key from a left row. A left update leaves the row it pointed at and joins the one it
    points at now, which may be the same; an update of a right row gives a new version of every left row that points at it.
    Versions are ordered by the left version and within it by the right one (`right_at` and, for each seq column of the right
    table, `right_seq0` and so on; -1 without a right row, -2 for a row that is gone), so that the last version of a key is right although
    it may come from another group. Late updates of either side change nothing and are quarantined.

    `spread` deals the left rows of one foreign key, and those without one, out to that many groups.
    """
    _check(how, "inner", "left")
    if len(on) != len(right.key):
        raise ValueError(f"foreign key has {len(on)} columns, the table's key has {len(right.key)}")
    if len(left.seq) != len(right.seq) or (left.ts is None) != (right.ts is None):
        raise ValueError("both tables need the same kinds of order columns")
    numbers = _points(left)
    foreign = [c.cast(right.df.schema[k].dataType) for c, k in zip(on.values(), right.key)]
    # Late updates and rows that point nowhere pass through the state too: what fails comes out of one query, by its tag.
    subscribing = changes(left, with_late=True).select(
        _key_text(*foreign).alias("fk"), F.pmod(F.xxhash64(*left.key), F.lit(spread)).cast("int").alias("salt"), F.lit(0).alias("side"), F.col(OP),
        F.to_json(F.struct(*left.key), JSON_TIMES).alias("mine"), *_plain(left), F.to_json(F.struct(*left.value), JSON_TIMES).alias("text"))
    versions = right.rows().select(
        _key_text(*[F.col(k) for k in right.key]).alias("fk"), F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("salt"),
        F.lit(1).alias("side"), F.lit(1).alias(OP), F.lit(None).cast("string").alias("mine"), *_plain(right), encode_json(right.value).alias("text"))
    theirs = [f"right_{o}" for o in numbers]
    output = _fields("mine string", *[f"{o} long" for o in (*numbers, *theirs)], "l string", "r string", "present boolean", "error string")
    found = _state_of(subscribing.unionByName(versions), ["fk", "salt"], _Subscriptions(output.names, numbers, how == "inner"), output)
    failed = found.where("error IS NOT NULL").select(
        F.lit("join_foreign").alias("operator"), F.col("mine").alias("key"), F.coalesce("l", "r").alias("value"), "error",
        (F.timestamp_micros("at") if left.ts else F.lit(None).cast("timestamp")).alias("ts"),
        F.to_json(F.struct(*[F.col(n).alias(s) for n, s in zip(numbers[1:], left.seq)])).alias("seq"))
    seq = (*left.seq, *theirs)
    rows = found.where("error IS NULL").select(
        _parsed("mine", _schema(left.df, list(left.key))).alias("__k"), _parsed("l", _schema(left.df, list(left.value))).alias(LEFT),
        _parsed("r", _schema(right.df, list(right.value))).alias(RIGHT), F.col("present").alias("__exists"),
        *([F.timestamp_micros("at").alias(left.ts)] if left.ts else []),
        *[F.col(n).cast(left.df.schema[s].dataType).alias(s) for n, s in zip(numbers[1:], left.seq)], *theirs,
    ).select("__k.*", LEFT, RIGHT, "__exists", *([left.ts] if left.ts else []), *seq)
    joiner = Joiner.of(joiner, left.value, right.value)
    columns = joiner.columns(emit=F.col("__exists"))
    log = left.with_(df=rows, seq=seq, rejects=())
    df = rows.select(*left.key, *[c.alias(n) for n, c in columns.items()], *log.order)
    return log.with_(df=df, value=tuple(columns), rejects=(*left.all_rejects(right), failed, *joiner.rejects(log, "join_foreign", rows, F.col("__exists"))))


# -- adder / subtractor aggregates ---------------------------------------------------------------

class _Retracting(_Bucket):
    """Each group's aggregate, and how many changes it has seen: the number of its version."""

    def __init__(self, names: list[str], order: list[str], init: Callable | None, add: Callable, subtract: Callable):
        self.names, self.order, self.start, self.add, self.subtract = names, order, init, add, subtract

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        states = self._load()
        yield from _in_chunks(self._results(_sorted(rows, [*self.order, OP]), states), self.names)
        self._save(states)

    def _results(self, batch: pd.DataFrame, states: dict) -> Iterator[tuple]:
        changed, last = {}, {}
        for grp, op, text, *at in zip(*[batch[c].tolist() for c in ("grp", OP, "text", *self.order)]):
            value, last[grp] = json.loads(text), at[0]
            version, packed = states.get(grp, (0, None))
            try:
                if packed is None and self.start is None:
                    # A reduction starts with the first value; nothing can be taken back from none.
                    after = value if op > 0 else None
                else:
                    before = self.start() if packed is None else json.loads(packed)
                    after = (self.add if op > 0 else self.subtract)(before, value)
            except Exception as error:  # the state stays, the change is data
                yield grp, at[0], None, False, None, *at[1:], op, text, f"{type(error).__name__}: {error}"
                continue
            states[grp], changed[grp] = (version, None if after is None else json.dumps(after)), True
        for grp in changed:
            version, packed = states[grp][0] + 1, states[grp][1]
            states[grp] = (version, packed)
            yield grp, int(last[grp]), packed, True, version, *[None] * (len(self.order) - 1), None, None, None


def _folded(flow, keys: dict[str, Column], rows: DataFrame, operator: str, init: Callable | None, add: Callable, subtract: Callable | None,
            schema: T.StructType):
    """`rows` have the columns of `flow` and `OP`; the result is a table with the columns of `keys` as its key."""
    order = _points(flow)
    groups = T.StructType([T.StructField(f"k{i}", f.dataType) for i, f in enumerate(rows.select(*keys.values()).schema)])
    given = rows.select(_key_text(*keys.values()).alias("grp"), OP, *_plain(flow), F.to_json(F.struct(*flow.value), JSON_TIMES).alias("text"))
    output = _fields("grp string", "at long", "total string", "done boolean", "version long", *[f"{o} long" for o in order[1:]], f"{OP} int",
                     "text string", "error string")
    found = _state_of(given, ["grp"], _Retracting(output.names, order, init, add, subtract), output).withColumn("__g", _parsed("grp", groups))
    named = [F.col("__g")[f"k{i}"].alias(k) for i, k in enumerate(keys)]
    time = (F.timestamp_micros("at") if flow.ts else F.lit(None).cast("timestamp")).alias("ts")
    seqs = [F.col(o).alias(s) for o, s in zip(order[1:], flow.seq)]
    failed = found.where("NOT done").select(
        F.lit(operator).alias("operator"), F.to_json(F.struct(*named), JSON_TIMES).alias("key"), F.col("text").alias("value"), "error", time,
        F.to_json(F.struct(*seqs, *([F.col(OP)] if subtract else []))).alias("seq"))
    df = found.where("done").select(*named, _parsed("total", schema).alias("__s"), "version").select(*keys, "__s.*", "version")
    from relstream.model import UpsertTable
    return UpsertTable(df, tuple(keys), tuple(schema.names), None, ("version",), (*flow.rejects, failed))


def _schema_of(schema: T.StructType | str) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def _of_groups(grouped, operator: str, init: Callable | None, add: Callable, subtract: Callable, schema: T.StructType):
    keys = {k: F.col(n) for k, n in zip(grouped.key, grouped._names)}
    return _folded(grouped.table, keys, grouped.changes(), operator, init, add, subtract, schema)


def aggregate(grouped, init: Callable[[], object], add: Callable[[object, dict], object], subtract: Callable[[object, dict], object],
              state_schema: T.StructType | str):
    """Any aggregate of a running table's groups, in one query: `subtract(state, value)` takes a replaced row back,
    `add(state, value)` adds the new one.

    `grouped` is a table's `group_by(…)`. States are JSON-like objects described by `state_schema`. Where a function gives None the
    group is deleted and its next change starts from `init()` again. Where one fails, the state stays and the change goes to the
    quarantine. The result is a table: a version per group and micro-batch in which it changed, numbered by `version`.
    """
    return _of_groups(grouped, "aggregate", init, add, subtract, _schema_of(state_schema))


def reduce(grouped, add: Callable[[dict, dict], object], subtract: Callable[[dict, dict], object]):
    """`aggregate` over values of the table's own columns: a group starts with the value of its first row."""
    return _of_groups(grouped, "reduce", None, add, subtract, _schema(grouped.table.df, list(grouped.table.value)))


# -- folds of records, with their failures -------------------------------------------------------

def fold(stream, init: Callable[[], object], step: Callable[[object, dict], object], state_schema: T.StructType | str):
    """`keyed.fold` as a table: a version of a key for each micro-batch with records of it.

    Where `step` fails, the state stays and the record goes to the quarantine, in the same query; None deletes the key, whose next
    record starts from `init()` again.
    """
    return _folded(stream, {k: F.col(k) for k in stream.key}, _complete(stream), "fold", init, step, None, _schema_of(state_schema))


def reduce_records(stream, combine: Callable[[dict, dict], object]):
    """`fold` over values of the stream's own columns: a key starts with its first value."""
    schema = _schema(stream.df, list(stream.value))
    return _folded(stream, {k: F.col(k) for k in stream.key}, _complete(stream), "reduce", None, combine, None, schema)


def _complete(stream) -> DataFrame:
    return stream.rows().where(stream.has_key & stream.has_value).withColumn(OP, F.lit(1))


# -- as-of joins with history --------------------------------------------------------------------

class _Held:
    """What is held for the key in hand."""

    def __init__(self, values: list):
        self.values = values

    def get(self) -> list:
        return self.values

    def put(self, values: list) -> None:
        self.values = values


class _Versions(_Bucket):
    """Each key's versions, sorted, and its records that wait until no earlier version can come any more."""

    def __init__(self, numbers: list[str], history: int):
        self.numbers, self.history = numbers, history

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark, states = timerValues.getCurrentWatermarkInMs() * 1000, self._load()
        yield from self._rows(self._results(_sorted(rows, self.numbers), states, watermark))
        self._put_away(states)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark, states = timerValues.getCurrentWatermarkInMs() * 1000, self._load()
        yield from self._rows(row for name in list(states) if any(at[0] <= watermark for at, _ in states[name][1])
                              for row in self._taken(states, name, [], watermark))
        self._put_away(states)

    def _results(self, batch: pd.DataFrame, states: dict, watermark: int) -> Iterator[tuple]:
        names = [f"{salt} {jk}" for salt, jk in zip(batch["salt"].tolist(), batch["jk"].tolist())]
        given = list(zip(_points_of(batch, self.numbers), batch["side"].tolist(), batch["text"].tolist()))
        for name, own in _by_name(names, given).items():
            if name.endswith(" "):  # a missing join key matches nothing
                yield from [(at, text, None, None) for at, side, text in own if side == 1]
            else:
                yield from self._taken(states, name, own, watermark)

    def _taken(self, states: dict, name: str, given: list, watermark: int) -> list:
        versions, waiting = states.get(name, ((), ()))
        self.versions, self.waiting = _Held(versions), _Held(waiting)
        oldest = watermark - self.history
        known = [(tuple(at), text) for at, text in self.versions.get()]
        known.sort(key=lambda version: version[0])
        out = [(at, text, None, "version" if side == 0 else "record") for at, side, text in given if at[0] < oldest]
        for at, side, text in given:
            if side == 0 and at[0] >= oldest:
                insort(known, (at, text if isinstance(text, str) else None), key=lambda version: version[0])
        records = [(at, text) for at, side, text in given if side == 1 and at[0] >= oldest]
        out += self._settled(known, records, watermark)
        states[name] = (self.versions.get(), self.waiting.get())
        return out

    def _settled(self, known: list, records: list, watermark: int) -> list:
        """Joins what need not wait any more, then lets go of versions that nothing can ask for."""
        held = [(tuple(at), text) for at, text in self.waiting.get()]
        self.waiting.put([(list(at), text) for at, text in held + records if at[0] > watermark])
        done = self._joined(known, sorted(r for r in held + records if r[0][0] <= watermark))
        self._keep(known, watermark - self.history)
        return done

    def _put_away(self, states: dict) -> None:
        self._save({name: state for name, state in states.items() if state[0] or state[1]})
        first = min((at[0] for _, waiting in states.values() for at, _ in waiting), default=None)
        if first is not None:
            self.handle.registerTimer(first // 1000 + 1)

    def _joined(self, known: list, records: list) -> list:
        times = [at[0] for at, _ in known]
        found = [bisect_right(times, at[0]) for at, _ in records]
        return [(at, text, known[k - 1][1] if k else None, None) for (at, text), k in zip(records, found)]

    def _keep(self, known: list, oldest: int) -> None:
        """The versions of the history, and the one that holds when it begins."""
        first = max(bisect_right([at[0] for at, _ in known], oldest) - 1, 0)
        if known:
            self.versions.put([(list(at), text) for at, text in known[first:]])

    def _rows(self, rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        names = [*self.numbers, "text", "version", "late"]
        yield from _in_chunks(((*at, text, version, late) for at, text, version, late in rows), names)


def join_versions(stream, table, joiner=None, how: str = "inner", on: dict[str, Column] | None = None, *,
                  late: timedelta, history: timedelta = timedelta(), spread: int = 1):
    """`stream.join_table(table)` on streams whose rows do not come in order: each record sees the version of its own time.

    `late` is how far a row may lag behind the newest one, the watermark's delay: a record is held until the watermark has
    passed it, so that a version that comes after it still counts. Of each key the versions of the last `history` before the
    watermark are kept, and the one before them: records and versions that are later than `late`, but within the history, are
    still taken, a record at once. What is older still is quarantined, records and versions alike. `spread` deals a key's
    records out to that many groups with their own copies of its versions.
    """
    _check(how, "inner", "left")
    if not stream.ts or not table.ts or len(stream.seq) != len(table.seq):
        raise ValueError("both sides need event times and the same number of seq columns")
    sources = list(on.values()) if on else [F.col(k) for k in stream.key]
    if len(sources) != len(table.key):
        raise ValueError(f"join key has {len(sources)} columns, the table's key has {len(table.key)}")
    sources = [c.cast(table.df.schema[k].dataType) for c, k in zip(sources, table.key)]
    carried = [*stream.key, *stream.value, *stream.order]
    numbers = _points(stream)
    # Rows without event time, key or value pass too: they may be the ones that advance the watermark.
    rows = stream.rows()
    usable = stream.has_key & stream.has_value & F.col(stream.ts).isNotNull()
    rejects = stream.all_rejects(table)
    keyed_ = all_of(c.isNotNull() for c in sources)
    if how == "inner":
        if on:
            rejects = (*rejects, stream.reject("join_table", rows.where(usable & ~keyed_), "no join key"))
        usable = usable & keyed_
    records = rows.select(
        _key_text(*sources).alias("jk"), F.pmod(F.xxhash64(*stream.seq), F.lit(spread)).cast("int").alias("salt"), F.lit(1).alias("side"), *_plain(stream),
        F.to_json(F.struct(*carried), JSON_TIMES).alias("text"), usable.alias("usable"), F.col(stream.ts).cast("timestamp").alias("time"))
    versions = table.df.select(*table.columns)
    versions = versions.select(
        _key_text(*[F.col(k) for k in table.key]).alias("jk"), F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("salt"), F.lit(0).alias("side"),
        *_plain(table), encode_json(table.value).alias("text"), (table.has_key & F.col(table.ts).isNotNull()).alias("usable"),
        F.col(table.ts).cast("timestamp").alias("time"))
    united = records.unionByName(versions).withWatermark("time", interval_text(late))
    # The state decides what is too late, not the engine, which would drop it: the time itself goes no further.
    united = united.where(F.when(F.col("time").isNotNull(), F.col("usable"))).drop("time", "usable")
    output = _fields(*[f"{o} long" for o in numbers], "text string", "version string", "late string")
    found = _state_of(united, ["jk", "salt"], _Versions(numbers, length_micros(history)), output, "EventTime")
    older = found.where("late IS NOT NULL")
    refused = older.select(
        F.lit("join_table").alias("operator"), F.lit(None).cast("string").alias("key"), F.col("text").alias("value"),
        F.concat(F.lit("older than the history: "), F.col("late")).alias("error"), F.timestamp_micros("at").alias("ts"),
        F.to_json(F.struct(*[F.col(n).alias(s) for n, s in zip(numbers[1:], stream.seq)])).alias("seq"))
    joined = found.where("late IS NULL")
    if how == "inner":
        joined = joined.where(F.col("version").isNotNull())
    pairs = joined.select(_parsed("text", _schema(stream.df, carried)).alias("__record"),
                          _parsed("version", _schema(table.df, list(table.value))).alias(RIGHT))
    pairs = pairs.select("__record.*", RIGHT).withColumn(LEFT, F.struct(*stream.value))
    return stream._joined("join_table", pairs, Joiner.of(joiner, stream.value, table.value), (*rejects, refused))
