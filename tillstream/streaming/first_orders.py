"""First order of a user, remembered in the state store.

The state holds one value per user: the order that counts as the first. It is kept by the stream's own
state store and commits with its positions, so no table is read or listed, a batch costs what its own
orders cost however many users are known, and a replayed batch starts from the state its first attempt
started from. Users are dealt over a fixed number of keys, each with a map of its users: what Spark
spends on handing Python another key is shared by many of them. The orders of a key come in frames; of
each user only the best so far is held. A key that remembers nobody is not asked user by user. Orders
without user or id are nobody's first; they are spread over all tasks and touch no state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

from tillstream import schemas
from tillstream.sinks import tables as sink_tables

if TYPE_CHECKING:
    import pandas as pd

_STATE = "create_time string, id long"
# The order of a user who has ordered before the stream began: earlier than any.
_BEFORE = ("", -(1 << 63))
# Keys that users are dealt over, fixed for a checkpoint's life; orders that play no part have keys below 0.
_SLOTS = 2048
_SPREAD = 1024


def _slot(user: Column) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(_SLOTS)).cast("int")


class _FirstOrder(StatefulProcessor):
    """Rows come with the columns ``names``, then user and id as numbers. Columns are told by position:
    Spark does not keep the names of all."""

    def __init__(self, names: list[str], by_time: bool):
        self.names, self.by_time = names, by_time

    def init(self, handle) -> None:
        self.firsts = handle.getMapState("firsts", "user long", _STATE)
        # The key whose initial state came last, and its users. It comes in the stream's first batch only,
        # right before the key's orders: nobody else is known then.
        self.loaded: tuple[tuple | None, set[int]] = (None, set())

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if self.loaded[0] != key:
            self.loaded = (key, set())
        for user in initialState["_user"].tolist():
            self.loaded[1].add(user)
            self.firsts.updateValue((user,), _BEFORE)

    def _known(self, key: tuple) -> Callable[[int], tuple | None]:
        """What tells the first order known of a user with this key."""
        if self.loaded[0] == key:
            before = self.loaded[1]
            return lambda user: _BEFORE if user in before else None
        if not self.firsts.exists():
            return lambda user: None

        def stored(user: int) -> tuple | None:
            value = self.firsts.getValue((user,))
            return tuple(value) if value is not None else None

        return stored

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        import pandas as pd
        return pd.DataFrame(rows, columns=[*self.names, "if_first_order"], dtype=object)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        width, time_at = len(self.names), self.names.index("create_time")
        frames = (frame.itertuples(index=False, name=None) for frame in rows)
        if key[0] < 0:
            for frame in frames:
                yield self._frame([(*row[:width], "0") for row in frame])
            return
        known_of = self._known(key)
        users: dict[int, tuple] = {}    # the first order known, the best of the batch, its row
        for frame in frames:
            out = []
            for row in frame:
                user, order = row[width], row[width + 1]
                if user not in users:
                    users[user] = known_of(user), None, None
                known, best, held = users[user]
                if known and not self.by_time:
                    out.append((*row[:width], "1" if order == known[1] else "0"))
                    continue
                at = (row[time_at] or "", order)
                if known and order == known[1]:
                    at = min(at, known)
                if best is None or at < best:
                    users[user] = known, at, row
                    if best is not None and order != best[1]:
                        out.append((*held[:width], "0"))
                elif order != best[1]:
                    out.append((*row[:width], "0"))
            if out:
                yield self._frame(out)
        out = []
        for user, (known, best, held) in users.items():
            if best is None:
                continue
            first = known is None or best <= known
            if first and known and known[1] not in (_BEFORE[1], best[1]):
                lost = {"id": str(known[1]), "user_id": str(user)}
                out.append((*[lost.get(n) for n in self.names], "0"))
            if first and best != known:
                self.firsts.updateValue((user,), best)
            out.append((*held[:width], "1" if first else "0"))
        if out:
            yield self._frame(out)

    def close(self) -> None:
        pass


def flag(orders: DataFrame, before: DataFrame | None = None, by_time: bool = False) -> DataFrame:
    """A stream of orders with ``if_first_order``; they need ``id``, ``user_id`` and ``create_time``.

    Inside a batch the earliest order of a user is the first, ties going to the smaller id. Between
    batches arrival decides, and the first order sent again is still the first. ``by_time`` lets time
    decide: an order that turns out to be earlier gets the flag, and the one that had it comes out once
    more with "0" and nothing but its ids; the latest row of an order holds. An order sent several times
    counts with its earliest time. An order that comes twice in one batch may come out twice; "1" then
    holds. ``before``: users (``user_id``) who had ordered before the stream first ran; their first order
    is never among these."""
    names = orders.columns
    plays = F.col("user_id").isNotNull() & F.col("id").isNotNull()
    user, order = F.col("user_id").cast("bigint"), F.col("id").cast("bigint")
    spread = F.pmod(F.xxhash64(*names), F.lit(_SPREAD)).cast("int")
    # Numbers travel as text: in a frame, whole numbers beside an absent one would lose digits.
    numbers = {f.name for f in orders.schema.fields if isinstance(f.dataType, T.NumericType)}
    keyed = orders.select(
        *[F.col(n).cast("string").alias(n) if n in numbers else n for n in names],
        F.coalesce(user, F.lit(0)).alias("_user"), F.coalesce(order, F.lit(0)).alias("_order"),
        F.when(user.isNotNull() & order.isNotNull(), _slot(user)).otherwise(-1 - spread).alias("_slot"))
    start = None
    if before is not None:
        users = before.select(F.col("user_id").try_cast("bigint").alias("_user")).where(F.col("_user").isNotNull())
        start = users.distinct().withColumn("_slot", _slot(F.col("_user"))).groupBy("_slot")
    shape = T.StructType([*[T.StructField(f.name, T.StringType() if f.name in numbers else f.dataType)
                            for f in orders.schema.fields], T.StructField("if_first_order", T.StringType())])
    flagged = keyed.groupBy("_slot").transformWithStateInPandas(
        _FirstOrder(names, by_time), shape, "append", "none", start)
    return flagged.select(*[F.col(f.name).cast(f.dataType) if f.name in numbers else f.name
                            for f in orders.schema.fields], "if_first_order")


FLAGS = T.StructType([T.StructField("id", T.LongType()), T.StructField("user_id", T.LongType()),
                      T.StructField("if_first_order", T.StringType())])


def store_flags(batch: DataFrame, n: int, table: str) -> None:
    """Add the flags that a batch has decided, or changed."""
    sink_tables.append_table(batch.select(*FLAGS.names), table, n, None)


def read_flags(spark, table: str) -> DataFrame:
    """The current flag of every order."""
    return sink_tables.read_keyed(spark, table, FLAGS, ["id"])


def known_users(spark, table: str) -> DataFrame:
    """Users whom the user-state table says to have ordered."""
    rows = sink_tables.read_keyed(spark, table, schemas.USER_STATE, ["user_id"])
    return rows.where(F.col("if_consumed") == "1").select("user_id")
