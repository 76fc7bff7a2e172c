"""State per key with a lifetime (DD1, W2, W4, W6): first orders, open sums of orders, devices of a day.

Each operator keeps one small value per key in Spark's state store. A key's rows of a micro-batch are read once, in bounded frames, holding back a
single row; the other columns of a row travel as one JSON text, so that nulls and long ids stay what they are.

``Lifetime`` says when a key is forgotten: never, some time after its last write by the processing time (for queries that run on),
or by event time, some time after the latest event written, once the watermark has passed that (also for queries that end). Every write renews it.
All rows of a key meet in one task: where one order or user may hold a large share of the rows, ``wide.with_open_sums`` and
``orders.with_order_counts`` spread them instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tillstream.functions.money import paid_share

TIME = "_time"


@dataclass(frozen=True)
class Lifetime:
    """How long a key lives after a write, in seconds of the processing time or of event time."""

    seconds: float
    event_time: bool = False

    @property
    def ms(self) -> int:
        return int(self.seconds * 1000)


CACHE = Lifetime(600)  # of joins and open orders
DAY = Lifetime(86_400)  # of devices


class _Keyed(StatefulProcessor):
    """One value per key, its lifetime, and rows that are read once."""

    layout = "known boolean"

    def __init__(self, lifetime: Lifetime | None = None):
        self.lifetime = lifetime

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        ttl = self.lifetime.ms if self.lifetime and not self.lifetime.event_time else None
        self.state = handle.getValueState("value", self.layout, ttl)

    def keep(self, value: tuple, latest_ms: int | None) -> None:
        """Writes the value and renews its lifetime."""
        self.state.update(value)
        if self.lifetime and self.lifetime.event_time:
            ends = [latest_ms + self.lifetime.ms] if latest_ms is not None else []
            for timer in list(self.handle.listTimers()):
                ends.append(timer)
                self.handle.deleteTimer(timer)
            if ends:
                self.handle.registerTimer(max(ends))

    def forget(self) -> None:
        self.state.clear()
        if self.lifetime and self.lifetime.event_time:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def _latest(frame: pd.DataFrame, before: int | None) -> int | None:
    return max([int(frame["event_ms"].max()), *([before] if before is not None else [])])


class FirstOrders(_Keyed):
    """Flags the earliest order, by time and id, of the first micro-batch in which a user appears."""

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((True,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new, held, latest = not self.state.exists(), None, None
        for frame in rows:
            latest, out = _latest(frame, latest), list(frame["payload"])
            if new:
                first = min(range(len(frame)), key=lambda i: (frame["create_time"].iat[i], frame["id"].iat[i]))
                mine = (frame["create_time"].iat[first], frame["id"].iat[first], out[first])
                if held is None or mine[:2] < held[:2]:
                    out.pop(first)
                    out += [held[2]] if held else []
                    held = mine
            if out:
                yield pd.DataFrame({"payload": out, "flag": ["0"] * len(out)})
        self.keep((True,), latest)
        if held:
            yield pd.DataFrame({"payload": [held[2]], "flag": ["1"]})


class FirstRows(_Keyed):
    """The first row of a key, by time and ``rank``, of the first micro-batch in which it appears. Every row renews the key.

    With a lifetime in event time, a row later than the last one by more than that is a first row again, also where the watermark has
    not yet let the key go.
    """

    layout = "latest_ms bigint"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, latest = None, None
        for frame in rows:
            latest = _latest(frame, latest)
            i = min(range(len(frame)), key=lambda k: (frame["event_ms"].iat[k], frame["rank"].iat[k]))
            mine = (int(frame["event_ms"].iat[i]), frame["rank"].iat[i], frame["payload"].iat[i])
            held = min(held, mine, key=lambda m: m[:2]) if held else mine
        last = self.state.get()[0] if self.state.exists() else None
        gone = last is not None and self.lifetime is not None and self.lifetime.event_time and held[0] > last + self.lifetime.ms
        self.keep((latest if last is None else max(latest, last),), latest)
        if last is None or gone:
            yield pd.DataFrame({"payload": [held[2]]})


class OpenOrders(_Keyed):
    """Shares the paid total out to an order's lines as they come; what is left goes to the greatest line of the batch that completes it.

    An order is complete when the amounts so far equal its original total; it is forgotten then. One without an amount is remembered as
    done, or its next line would complete it again.
    """

    layout = "amount_c bigint, shares_c bigint, done boolean"

    def handleInitialState(self, key, initialState, timerValues) -> None:
        row = initialState.iloc[0]
        self.state.update((int(row["amount_c"]), int(row["shares_c"]), False))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        amount, shares, done = self.state.get() if self.state.exists() else (0, 0, False)
        held, latest, total = None, None, (0, 0)
        for frame in rows:
            latest = _latest(frame, latest)
            amount, shares = amount + int(frame["amount_c"].sum()), shares + int(frame["share_c"].sum())
            total = int(frame["original_total_c"].iat[0]), int(frame["final_total_c"].iat[0])
            i = int(frame["order_detail_id"].argmax())
            mine = (int(frame["order_detail_id"].iat[i]), int(frame["share_c"].iat[i]), frame["payload"].iat[i])
            texts, own = list(frame["payload"]), [int(s) for s in frame["share_c"]]
            if held is None or mine[0] > held[0]:
                texts.pop(i), own.pop(i)
                if held:
                    texts.append(held[2])
                    own.append(held[1])
                held = mine
            if texts:
                yield pd.DataFrame({"payload": texts, "final_detail_c": own})
        complete = not done and amount == total[0]
        left = total[1] - shares if complete else 0
        if complete and total[0]:
            self.forget()
        else:
            self.keep((amount, shares, done or complete), latest)
        yield pd.DataFrame({"payload": [held[2]], "final_detail_c": [held[1] + left]})


def _mode(lifetime: Lifetime | None) -> str:
    return "none" if lifetime is None else "eventTime" if lifetime.event_time else "processingTime"


def _apply(stream: DataFrame, keys: list[str], rest: list, processor: _Keyed, made: str, initial: DataFrame | None = None) -> DataFrame:
    """Runs a processor over the stream, grouped by keys; returns its rows in full, with the columns that it makes.

    ``stream`` has the event time in ``_time``, with a watermark where the lifetime counts event time.
    """
    schema = stream.drop(TIME).schema
    payload = F.to_json(F.struct(*schema.fieldNames()), {"ignoreNullFields": "true"}).alias("payload")
    # Frames lose names that begin with an underscore.
    rows = stream.select(*keys, *rest, payload, F.unix_millis(TIME).alias("event_ms"), TIME)
    out = rows.groupBy(*keys).transformWithStateInPandas(
        processor, f"payload string{', ' + made if made else ''}", "append", _mode(processor.lifetime),
        initialState=initial.groupBy(*keys) if initial is not None else None,
    )
    more = [part.split()[0] for part in made.split(", ") if part]
    return out.withColumn("row", F.from_json("payload", schema)).select("row.*", *more)


def first_orders(orders: DataFrame, known_users: DataFrame | None = None, lifetime: Lifetime | None = None) -> DataFrame:
    """Orders (user_id, id, create_time, _time and more) in full with ``if_first_order`` (W2). ``known_users`` (user_id) have ordered before."""
    known = known_users.select(F.col("user_id").try_cast("long").alias("user_id")).where("user_id is not null").distinct() if known_users is not None else None
    flagged = _apply(orders, ["user_id"], ["id", "create_time"], FirstOrders(lifetime), "flag string", known)
    return flagged.withColumnRenamed("flag", "if_first_order")


def first_visits(logs: DataFrame, rank: str, lifetime: Lifetime | None = DAY) -> DataFrame:
    """The first record, in full, of each device and day (DD1); times that are equal are decided by ``rank``."""
    return _apply(logs, ["dt", "mid"], [F.col(rank).alias("rank")], FirstRows(lifetime), "")


def allocated(pairs: DataFrame, open_sums: DataFrame | None = None, lifetime: Lifetime | None = None) -> DataFrame:
    """Pairs of order and line, each once and in full, with ``final_detail_c`` (W4). ``open_sums`` (order_id, amount_c, shares_c) are of orders begun before."""
    share = paid_share(F.col("final_total_c"), F.col("amount_c"), F.col("original_total_c")).alias("share_c")
    rest = ["order_detail_id", "amount_c", share, "original_total_c", "final_total_c"]
    return _apply(pairs, ["order_id"], rest, OpenOrders(lifetime), "final_detail_c bigint", open_sums)
