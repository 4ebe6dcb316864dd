"""Joins whose left side is a record stream: with a stream, a table, or a lookup table.

A left record needs a key and a value, in left joins too. A join key computed by `on` (the mapper)
does not replace the record's own key; where it is null the record matches nothing: a left join keeps
it, an inner join quarantines it.
"""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relstream.functions.predicates import all_of, all_present
from relstream.functions.times import above_watermark, complete, seconds
from relstream.operators.joiners import LEFT, RIGHT, Joiner
from relstream.plans.ordered import Carried, carry_forward, last_known
from relstream.plans.skew import SplitPolicy, fits_broadcast, lookup_join

_SIDE = "__side"
_VERSION = "__version"
_AT = "__at"


def _check(how: str, *allowed: str) -> None:
    if how not in allowed:
        raise ValueError(f"how must be one of {allowed}, not {how!r}")


class StreamJoinOps:

    def _join_keys(self, on: dict[str, Column] | None, right_key: tuple[str, ...]) -> dict[str, Column]:
        """The left side's join key columns, named apart from every other column."""
        sources = list(on.values()) if on else [F.col(k) for k in self.key]
        if len(sources) != len(right_key):
            raise ValueError(f"join key has {len(sources)} columns, the table's key has {len(right_key)}")
        return {f"__jk{i}": c for i, c in enumerate(sources)}

    def _joined(self, operator: str, df: DataFrame, joiner: Joiner, rejects):
        columns = joiner.columns()
        return self.with_(
            df=df.select(*self.key, *[c.alias(n) for n, c in columns.items()], *self.order),
            value=tuple(columns), rejects=(*rejects, *joiner.rejects(self, operator, df)),
        )

    # -- stream with lookup table ----------------------------------------------------------------

    def join_lookup(self, table, joiner=None, how: str = "inner", on: dict[str, Column] | None = None):
        """Looks each record's key, or the key computed by `on`, up in a static table."""
        _check(how, "inner", "left")
        keys = self._join_keys(on, table.key)
        left = complete(self).select(
            *self.key, F.struct(*self.value).alias(LEFT), *self.order, *[c.alias(n) for n, c in keys.items()]
        )
        rejects = self.rejects
        if on and how == "inner":
            failed = complete(self).where(~all_of(c.isNotNull() for c in keys.values()))
            rejects = (*rejects, self.reject("join_lookup", failed, "no join key"))
        right_keys = [f"__rk{i}" for i in range(len(table.key))]
        right = table.rows().select(
            *[F.col(k).alias(r) for k, r in zip(table.key, right_keys)], F.struct(*table.value).alias(RIGHT)
        )
        joined = lookup_join(left, right, list(keys), right_keys, how, spread_by=self.order)
        return self._joined("join_lookup", joined, Joiner.of(joiner, self.value, table.value), rejects)

    # -- stream with table, as of the record -----------------------------------------------------

    def join_table(self, table, joiner=None, how: str = "inner", on: dict[str, Column] | None = None):
        """Joins each record with the table's version at the record's time (batch).

        Only records produce output. A version with the record's own time counts as already there.
        Versions that fit into a broadcast are searched in place; otherwise the two logs are united
        and each record takes the last version before it, see `carry_forward`. Streams use
        `streaming.keyed.join_table`.
        """
        _check(how, "inner", "left")
        keys = self._join_keys(on, table.key)
        names = list(keys)
        if (self.ts is None) != (table.ts is None) or len(self.seq) != len(table.seq):
            raise ValueError("both sides need the same kinds of order columns")
        # At equal times the version comes first; without times the arrival numbers decide.
        seqs = [f"__seq{i}" for i in range(len(self.seq))]
        order = [_AT, _SIDE, *seqs] if self.ts else [*seqs, _SIDE]

        def placed(side, number: int) -> list[Column]:
            at = [F.col(side.ts).alias(_AT)] if side.ts else []
            return [*at, F.lit(number).alias(_SIDE), *[F.col(s).alias(q) for s, q in zip(side.seq, seqs)]]

        # Order columns travel once, under their common names, and so does a key that is the join key.
        own_key = self.key if on else ()
        record = F.struct(*own_key, F.struct(*self.value).alias(LEFT))
        usable = complete(self)
        records = usable.select(*[c.alias(n) for n, c in keys.items()], *placed(self, 1), record.alias("__record"))
        # The wrapping struct is never null, which tells a deleted version from no version.
        versions = table.rows().select(
            *[F.col(k).alias(n) for k, n in zip(table.key, names)], *placed(table, 0),
            F.struct(table.value_struct().alias(RIGHT)).alias(_VERSION),
        )
        own = {**({} if on else dict(zip(names, self.key))), **({_AT: self.ts} if self.ts else {}), **dict(zip(seqs, self.seq))}
        back = [F.col(common).alias(name) for common, name in own.items()]
        keyless = None
        rejects = self.rejects
        if on:
            if how == "inner":
                failed = usable.where(~all_of(c.isNotNull() for c in keys.values()))
                rejects = (*rejects, self.reject("join_table", failed, "no join key"))
            else:
                keyless = records.where(~all_present(names)).select(*back, "__record")
            records = records.where(all_present(names))
        if fits_broadcast(versions, SplitPolicy.of(self.spark)):
            times = [_AT] if self.ts else seqs
            ties = seqs if self.ts else []
            states = last_known(records, versions, names, times, ties, _VERSION, "__state", how)
        else:
            united = records.unionByName(versions, allowMissingColumns=True)
            states = carry_forward(united, names, order, {"__state": Carried(F.col(_VERSION))})
            states = states.where(F.col(_SIDE) == 1)
        seen = states.select(*back, "__record", F.col("__state")[RIGHT].alias(RIGHT))
        if how == "inner":
            seen = seen.where(F.col(RIGHT).isNotNull())
        elif keyless is not None:
            seen = seen.unionByName(keyless, allowMissingColumns=True)
        joined = seen.select(*[c for c in seen.columns if c != "__record"], "__record.*")
        return self._joined("join_table", joined, Joiner.of(joiner, self.value, table.value), rejects)

    # -- stream with stream, within a time distance ----------------------------------------------

    def join_stream(self, other, before: timedelta, after: timedelta, joiner=None, how: str = "inner",
                    late: timedelta | None = None):
        """Joins records of one key where `ts - before <= other.ts <= ts + after`.

        Both bounds are inclusive. The result carries the left record's order columns; in a full join
        an unmatched right record brings its own. Only final rows appear. On streams `late` is the
        watermark delay of both sides.
        """
        _check(how, "inner", "left", "full")
        if len(self.key) != len(other.key) or len(self.seq) != len(other.seq):
            raise ValueError("both streams need equally many key and seq columns")
        names = [f"__k{i}" for i in range(len(self.key))]
        sides = [_side(self, names, "__lt", "__ls", LEFT, late), _side(other, names, "__rt", "__rs", RIGHT, late)]
        if how == "full" and (self.df.isStreaming or other.df.isStreaming):
            joined = _interval_full_streaming(*sides, names, before, after)
        else:
            joined = _interval(*sides, names, before, after, how)
        order = [
            F.coalesce("__lt", "__rt").alias(self.ts),
            *[F.coalesce(f"__ls{i}", f"__rs{i}").alias(s) for i, s in enumerate(self.seq)],
        ]
        pairs = joined.select(*[F.col(n).alias(k) for n, k in zip(names, self.key)], LEFT, RIGHT, *order)
        found = self._joined("join_stream", pairs, Joiner.of(joiner, self.value, other.value), ())
        return found.with_(rejects=(*self.all_rejects(other), *found.rejects))


def _side(stream, names: list[str], ts: str, seq: str, value: str, late: timedelta | None) -> DataFrame:
    if stream.df.isStreaming and late is None:
        raise ValueError("a stream needs late=, the watermark delay")
    rows = complete(stream, late).where(F.col(stream.ts).isNotNull())
    return rows.select(
        # The join makes the optimizer filter for present keys, which must stay above the watermark.
        *[above_watermark(stream, F.col(k)).alias(n) for k, n in zip(stream.key, names)],
        F.col(stream.ts).alias(ts),
        *[F.col(s).alias(f"{seq}{i}") for i, s in enumerate(stream.seq)],
        F.struct(*stream.value).alias(value),
    )


def _near(before: timedelta, after: timedelta) -> Column:
    return (F.col("__rt") >= F.col("__lt") - F.lit(before)) & (F.col("__rt") <= F.col("__lt") + F.lit(after))


def _interval(left: DataFrame, right: DataFrame, names: list[str], before: timedelta,
              after: timedelta, how: str) -> DataFrame:
    """Equi-join on key and time bucket, so that a key's records meet only their neighbours.

    A bucket is twice as long as the window: a right record belongs to one or two buckets, a left one to
    exactly one, so left and inner joins need nothing more. The right records that a full join adds
    come from an anti join with the roles swapped. On streams the time condition lets Spark drop rows
    from state once the watermarks have passed them.
    """
    width = 2 * math.ceil((before + after) / timedelta(seconds=1)) + 1

    def bucket(df: DataFrame, ts: str, shift: timedelta = timedelta()) -> Column:
        return F.floor(seconds(df, ts, shift) / F.lit(width))

    def in_one(df: DataFrame, ts: str) -> DataFrame:
        return df.withColumn("__bucket", bucket(df, ts))

    def in_all(df: DataFrame, ts: str, back: timedelta, ahead: timedelta) -> DataFrame:
        span = F.sequence(bucket(df, ts, -back), bucket(df, ts, ahead))
        return df.withColumn("__bucket", F.explode(span))

    on = [*names, "__bucket"]

    def aside(df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed({n: f"__r{n}" for n in on})

    matched = _near(before, after) & _same(on)
    joined = in_one(left, "__lt").join(
        aside(in_all(right, "__rt", after, before)), matched, "inner" if how == "inner" else "left"
    ).drop("__bucket", *[f"__r{n}" for n in on])
    if how != "full":
        return joined
    neighbours = aside(in_all(left.select(*names, "__lt"), "__lt", before, after))
    alone = in_one(right, "__rt").join(neighbours, matched, "left_anti").drop("__bucket")
    return joined.unionByName(alone, allowMissingColumns=True)


def _same(on: list[str]) -> Column:
    condition = F.lit(True)
    for name in on:
        condition = condition & (F.col(name) == F.col(f"__r{name}"))
    return condition


def _interval_full_streaming(left: DataFrame, right: DataFrame, names: list[str], before: timedelta,
                             after: timedelta) -> DataFrame:
    """The left join, and the unmatched rows of the left join with the roles swapped: streams have no anti join.

    Both are by key and time bucket, so a hot key is many groups here too; the price is that both sides are kept twice.
    """
    joined = _interval(left, right, names, before, after, "left")
    rights = right.withColumnsRenamed({c: c.replace("__r", "__l", 1) for c in right.columns if c.startswith(("__rt", "__rs"))})
    swapped = _interval(rights, left.select(*names, F.col("__lt").alias("__rt")), names, after, before, "left")
    alone = swapped.where(F.col("__rt").isNull()).drop("__rt")
    alone = alone.withColumnsRenamed({c: c.replace("__l", "__r", 1) for c in alone.columns if c.startswith(("__lt", "__ls"))})
    return joined.unionByName(alone, allowMissingColumns=True)
