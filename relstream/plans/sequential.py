"""Folds by Python functions: one record after the other, or in partial states."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ERROR, FAILED = "__error", "__failed"
#: Partial states that a task holds before it gives them out.
HELD = 50_000


def sequential_fold(rows: DataFrame, group: Sequence[str], order: Sequence[str], value: Sequence[str],
                    init: Callable[[], dict] | None, step: Callable[[dict, dict], dict | None],
                    state_schema: T.StructType | str) -> DataFrame:
    """Folds each group's rows in order with a Python function; one row per group that is not deleted.

    One shuffle by group and a sort that spills; a task keeps one state and a batch of rows. A step
    that raises leaves the state alone, and the row that it failed on comes out beside the states: with
    `ERROR`, its value and its order columns as `FAILED`. One that gives None deletes the group for now.
    `init` gives the state to start from; where it is None, a group's first value is its first state.
    """
    group, order, value = list(group), list(order), list(value)
    fields = T._parse_datatype_string(state_schema) if isinstance(state_schema, str) else state_schema
    kept = rows.select(*group, *value, *[c for c in order if c not in group and c not in value])
    sorted_rows = kept.repartition(*group).sortWithinPartitions(*group, *order)
    failed = T.StructType([T.StructField("value", T.StringType()), *kept.select(*order).schema.fields])
    schema = T.StructType([*kept.select(*group).schema.fields, *[T.StructField(f.name, f.dataType) for f in fields],
                           T.StructField(ERROR, T.StringType()), T.StructField(FAILED, failed)])
    target, names = to_arrow_schema(schema), fields.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, key, state = None, (), None
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = zip(*done) if done else [[] for _ in target]
            batch = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, target)], schema=target)
            done.clear()
            return batch

        def close() -> None:
            if current is not None and state is not None:
                done.append((*key, *[state.get(n) for n in names], None, None))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*group, *value)]
            places = [batch.column(c).to_pylist() for c in order]
            for k, row in enumerate(zip(*columns)):
                own = row[: len(group)]
                if (found := repr(own)) != current:
                    close()
                    current, key, state = found, own, None
                given = dict(zip(value, row[len(group):]))
                try:
                    state = given if state is None and init is None else step(init() if state is None else state, given)
                except Exception as error:
                    told = {"value": json.dumps(given, default=str), **{c: place[k] for c, place in zip(order, places)}}
                    done.append((*own, *[None] * len(names), f"{type(error).__name__}: {error}", told))
            yield flush()
        close()
        yield flush()

    return sorted_rows.mapInArrow(run, schema)


def partial_fold(rows: DataFrame, group: Sequence[str], order: Sequence[str], value: Sequence[str], init: Callable[[], dict],
                 step: Callable[[dict, dict], dict | None], merge: Callable[[dict, dict], dict | None],
                 state_schema: T.StructType | str, held: int = HELD) -> DataFrame:
    """Folds each group's rows in any order: every task makes partial states, one per group, and only these are shuffled and merged.

    A task holds at most `held` states; it gives them out and begins again when there are more. A group in a third of all rows is so one
    state per task and turn. A step that raises leaves the state alone and its row comes out as in `sequential_fold`; a merge that
    raises leaves the first state, and the other one comes out as the value, without order columns. None deletes a group for now.
    """
    group, order, value = list(group), list(order), list(value)
    fields = T._parse_datatype_string(state_schema) if isinstance(state_schema, str) else state_schema
    kept = rows.select(*group, *value, *[c for c in order if c not in group and c not in value])
    failed = T.StructType([T.StructField("value", T.StringType()), *[T.StructField(f.name, f.dataType) for f in kept.select(*order).schema]])
    schema = T.StructType([*kept.select(*group).schema.fields, *[T.StructField(f.name, f.dataType) for f in fields],
                           T.StructField(ERROR, T.StringType()), T.StructField(FAILED, failed)])
    target, names, width = to_arrow_schema(schema), fields.names, len(group)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out) if out else [[] for _ in target]
        batch = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, target)], schema=target)
        out.clear()
        return batch

    def told(own: tuple, given: dict, places: dict, error: Exception) -> tuple:
        text = {"value": json.dumps(given, default=str), **{c: places.get(c) for c in order}}
        return (*own, *[None] * len(names), f"{type(error).__name__}: {error}", text)

    def closed(own: tuple, state: dict) -> tuple:
        return (*own, *[state.get(n) for n in names], None, None)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[str, tuple[tuple, dict]] = {}
        out: list[tuple] = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*group, *value)]
            places = {c: batch.column(c).to_pylist() for c in order}
            for k, row in enumerate(zip(*columns)):
                own, given = row[:width], dict(zip(value, row[width:]))
                name = repr(own)
                try:
                    state = step(states[name][1] if name in states else init(), given)
                except Exception as error:
                    out.append(told(own, given, {c: place[k] for c, place in places.items()}, error))
                    continue
                if state is None:
                    states.pop(name, None)
                else:
                    states[name] = (own, state)
                if len(states) > held:
                    out.extend(closed(*one) for one in states.values())
                    states.clear()
            yield batch_of(out)
        out.extend(closed(*one) for one in states.values())
        yield batch_of(out)

    def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, key, state = None, (), None
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns]):
                if row[-2] is not None:
                    out.append(row)
                    continue
                own, given = row[:width], dict(zip(names, row[width:-2]))
                if (found := repr(own)) != current:
                    if state is not None:
                        out.append(closed(key, state))
                    current, key, state = found, own, None
                try:
                    state = given if state is None else merge(state, given)
                except Exception as error:
                    out.append(told(own, given, {}, error))
            yield batch_of(out)
        if state is not None:
            out.append(closed(key, state))
        yield batch_of(out)

    partials = kept.mapInArrow(partial, schema)
    return partials.repartition(*group).sortWithinPartitions(*group).mapInArrow(merged, schema)
