"""Joins of two upsert tables, by primary key and by foreign key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relstream.functions.predicates import all_of
from relstream.operators.joiners import LEFT, RIGHT, Joiner
from relstream.operators.joins import _SIDE, _check
from relstream.plans.ordered import Carried, carry_forward
from relstream.plans.skew import lookup_join


def _current(table, names: list[str], value: str) -> DataFrame:
    """Live rows as (key names, value struct, order struct)."""
    return table.latest().select(
        *[F.col(k).alias(n) for k, n in zip(table.key, names)],
        F.struct(*table.value).alias(value),
        _position(table).alias(f"{value}_at"),
    )


def _position(table) -> Column:
    return F.struct(*table.order) if table.order else F.lit(None)


class TableJoinOps:

    def join(self, other, joiner=None, how: str = "inner"):
        """Current rows of two tables with the same key; the result is a snapshot.

        Both sides are reduced to one row per key first, and the join reuses that partitioning. A row
        whose join function fails is absent, as if deleted.
        """
        _check(how, "inner", "left", "full")
        names = [f"__k{i}" for i in range(len(self.key))]
        left, right = _current(self, names, LEFT), _current(other, names, RIGHT)
        joined = left.join(right, names, how)
        return self._result(joined, dict(zip(names, self.key)), Joiner.of(joiner, self.value, other.value), other)

    def join_changelog(self, other, joiner=None, how: str = "inner"):
        """The join as a log: one version per update of either side, deletes included (batch).

        An update yields a version when the result row exists after it or existed before it. Both
        logs need order columns of the same kinds, with numbers that order updates across the sides.
        """
        _check(how, "inner", "left", "full")
        if len(self.order) != len(other.order) or (self.ts is None) != (other.ts is None):
            raise ValueError("both tables need the same kinds of order columns")
        names = [f"__k{i}" for i in range(len(self.key))]
        order = [f"__o{i}" for i in range(len(self.order))]

        def log(table, value: str) -> DataFrame:
            return table.rows().select(
                *[F.col(k).alias(n) for k, n in zip(table.key, names)],
                *[F.col(c).alias(o) for c, o in zip(table.order, order)],
                F.lit(int(value == RIGHT)).alias(_SIDE),
                F.struct(table.value_struct().alias("v")).alias(f"{value}_version"),
            )

        united = log(self, LEFT).unionByName(log(other, RIGHT), allowMissingColumns=True)
        sides = {LEFT: F.col(f"{LEFT}_version"), RIGHT: F.col(f"{RIGHT}_version")}
        # Numbers of two topics may tie: the left update then comes first.
        states = carry_forward(united, names, [*order, _SIDE], {
            **{f"{s}_now": Carried(c) for s, c in sides.items()},
            **{f"{s}_was": Carried(c, inclusive=False) for s, c in sides.items()},
        })

        def exists(when: str) -> Column:
            left = F.col(f"{LEFT}_{when}")["v"].isNotNull()
            right = F.col(f"{RIGHT}_{when}")["v"].isNotNull()
            both = {"inner": left & right, "left": left, "full": left | right}[how]
            return F.coalesce(both, F.lit(False))

        rows = states.where(exists("now") | exists("was")).select(
            *[F.col(n).alias(k) for n, k in zip(names, self.key)],
            *[F.col(o).alias(c) for o, c in zip(order, self.order)],
            F.col(f"{LEFT}_now")["v"].alias(LEFT), F.col(f"{RIGHT}_now")["v"].alias(RIGHT),
            exists("now").alias("__exists"),
        )
        joiner = Joiner.of(joiner, self.value, other.value)
        columns = joiner.columns(emit=F.col("__exists"))
        df = rows.select(*self.key, *[c.alias(n) for n, c in columns.items()], *self.order)
        failed = joiner.rejects(self, "join_changelog", rows, F.col("__exists"))
        return self.with_(df=df, value=tuple(columns), rejects=(*self.all_rejects(other), *failed))

    def join_foreign(self, other, on: dict[str, Column], joiner=None, how: str = "inner"):
        """Joins each current row with the row of `other` whose primary key is computed by `on`.

        Many rows may point at one. A foreign key shared by very many rows is spread over tasks,
        see `lookup_join`. The reverse direction has no key to go by, so there is no full join. On a
        stream the result is a log, see `streaming.running.join_foreign`.
        """
        if how == "full":
            raise NotImplementedError("a foreign-key join is inner or left: unmatched right rows have no left key")
        _check(how, "inner", "left")
        if len(on) != len(other.key):
            raise ValueError(f"foreign key has {len(on)} columns, the table's key has {len(other.key)}")
        if self.df.isStreaming or other.df.isStreaming:
            from relstream.streaming import running
            return running.join_foreign(self, other, on, joiner, how)
        foreign = [f"__fk{i}" for i in range(len(on))]
        current = self.latest()
        left = current.select(
            *self.key, *[c.alias(n) for c, n in zip(on.values(), foreign)],
            F.struct(*self.value).alias(LEFT), _position(self).alias(f"{LEFT}_at"),
        )
        rejects = self.rejects
        if how == "inner":
            keyed = all_of(c.isNotNull() for c in on.values())
            rejects = (*rejects, self.reject("join_foreign", current.where(~keyed), "no foreign key"))
        right = _current(other, [f"__pk{i}" for i in range(len(other.key))], RIGHT)
        joined = lookup_join(left, right, foreign, [f"__pk{i}" for i in range(len(other.key))], how,
                             spread_by=self.key)
        result = self._result(joined, {k: k for k in self.key}, Joiner.of(joiner, self.value, other.value), other)
        return result.with_(rejects=self.with_(rejects=rejects).all_rejects(result))

    def _result(self, joined: DataFrame, keys: dict[str, str], joiner: Joiner, other):
        """A snapshot with the left row's order columns, or the right row's where there is no left."""
        columns = joiner.columns()
        left_at, right_at = F.col(f"{LEFT}_at"), F.col(f"{RIGHT}_at")
        if len(self.order) == len(other.order):
            order = [
                F.when(left_at.isNull(), right_at[theirs]).otherwise(left_at[ours]).alias(ours)
                for ours, theirs in zip(self.order, other.order)
            ]
        else:
            order = [left_at[ours].alias(ours) for ours in self.order]
        pairs = joined.select(*[F.col(n).alias(k) for n, k in keys.items()], LEFT, RIGHT, *order)
        df = pairs.select(*self.key, *[c.alias(n) for n, c in columns.items()], *self.order)
        rejects = (*self.all_rejects(other), *joiner.rejects(self, "join", pairs))
        result = self.with_(df=df, value=tuple(columns), rejects=rejects, is_snapshot=True)
        return result.with_(df=df.where(result.has_value))

