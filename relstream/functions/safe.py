"""User Python functions whose failures become data instead of job failures."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def safe_udf(fn: Callable, return_type: T.DataType | str) -> Callable[..., Column]:
    """Wraps `fn` as an Arrow-batched function returning `struct<value, error>`.

    `error` is null when the call succeeded, so `error.isNull()` is the `valid=` condition of the
    operators. Prefer built-in `try_*` expressions; this is for logic that needs Python.
    """
    value_type = T._parse_datatype_string(return_type) if isinstance(return_type, str) else return_type
    schema = T.StructType([T.StructField("value", value_type), T.StructField("error", T.StringType())])

    def attempt(*args):
        try:
            return fn(*args), None
        except Exception as error:  # the record's failure, kept as data
            return None, f"{type(error).__name__}: {error}"

    kind = to_arrow_type(value_type)

    def fit(value):
        """A value that the declared type cannot hold is its record's failure, not the batch's."""
        try:
            pa.array([value], kind)
        except Exception as error:
            return None, f"{type(error).__name__}: {error}"
        return value, None

    def call(*columns: pa.Array) -> pa.Array:
        # Arrow to Python and back: whole numbers stay whole, also beside a null.
        results = [attempt(*args) for args in zip(*[c.to_pylist() for c in columns])]
        errors = [r[1] for r in results]
        try:
            values = pa.array([r[0] for r in results], kind)
        except (pa.ArrowInvalid, pa.ArrowTypeError, OverflowError):
            checked = [fit(value) if error is None else (None, error) for value, error in results]
            values, errors = pa.array([c[0] for c in checked], kind), [c[1] for c in checked]
        return pa.StructArray.from_arrays([values, pa.array(errors, pa.string())], ["value", "error"])

    call.__annotations__ = {"columns": pa.Array, "return": pa.Array}
    # Otherwise a filter on `error` would be moved below the call and make a second one.
    return F.arrow_udf(call, schema).asNondeterministic()
