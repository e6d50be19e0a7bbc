"""Keyed state for streams, each the streaming form of a batch operator.

The processors only decide per row against a few values of state; parsing, joining and
summing stay with built-in operators before and after them.  Rows are taken as they come, so
no batch of a key is held in memory.  State lives in RocksDB.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import timedelta

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemart.functions.dates import DAY_MS, day_start_millis, local_day

# Send the classes themselves to the workers, which then need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LONG = T.StructType([T.StructField("v", T.LongType())])
_MS = T.StructField("_ms", T.LongType())
_TEXT = T.StructType([T.StructField("v", T.StringType())])


def _with_ms(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, _MS])


def _values(struct, schema: T.StructType) -> tuple:
    """The fields of a struct column, which comes as a row or as a dictionary."""
    return tuple(struct[name] for name in schema.names)


class _Keyed(StatefulProcessor):
    def close(self) -> None:
        pass


class FirstOfDay(_Keyed):
    """Flag 1 on the first row of the key on a day.

    All days seen are remembered until the watermark is two days past them, so rows that arrive
    out of order do not count a day twice.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", _LONG, _LONG)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for row in rows:
            values = row.asDict()
            start = values.pop("_day_start")
            first = not self.days.containsKey((start,))
            if first:
                self.days.updateValue((start,), (1,))
                self.handle.registerTimer(start + 2 * DAY_MS)
            yield Row(**values, first_of_day=int(first))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        day = (expiredTimerInfo.getExpiryTimeInMs() - 2 * DAY_MS,)
        if self.days.containsKey(day):
            self.days.removeKey(day)
        return iter(())


class LoginDays(_Keyed):
    """The first login of a user on a new day; ``back_ct`` is 1 after ``gap_days`` days away."""

    def __init__(self, gap_days: int = 8):
        self.gap_days = gap_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", _LONG)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        newest = last
        for row in rows:
            start = row["_day_start"]
            if newest is None or start > newest:
                back = newest is not None and (row["ts"] - newest) // DAY_MS >= self.gap_days
                newest = start
                yield Row(uid=row["uid"], et=row["et"], ts=row["ts"], uu_ct=1, back_ct=int(back))
        if newest != last:
            self.last.update((newest,))


class FirstVisit(_Keyed):
    """``is_new`` set to 0 where a row says 1 on another day than the device's first visit."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", _LONG)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.first.get()[0] if self.first.exists() else None
        first = known
        for row in rows:
            values = row.asDict()
            start, new = values.pop("_day_start"), values["is_new"] == "1"
            if first is None:
                first = start if new else start - DAY_MS
            if new and start != first:
                values["is_new"] = "0"
            yield Row(**values)
        if first != known:
            self.first.update((first,))


class Retract(_Keyed):
    """Each row; if the key was seen within ``ttl_ms``, its previous row first, measures negated.

    A row may not leave with a time that the watermark has passed.  The negation of such a row takes the new
    row's time: its window is out already, so the correction falls into the present one and totals stay right.
    """

    def __init__(self, schema: T.StructType, measures: list[str], ttl_ms: int):
        self.schema, self.measures, self.ttl_ms = schema, measures, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.previous = handle.getValueState("previous", _with_ms(self.schema))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names = self.schema.names
        held = self.previous.get() if self.previous.exists() else None
        last_ms, passed = 0, timerValues.getCurrentWatermarkInMs()
        for row in rows:
            values, last_ms = tuple(row[n] for n in names), max(last_ms, row["_ms"])
            if held is not None:
                negated = {n: (-(v or 0) if n in self.measures else v) for n, v in zip(names, held)}
                if held[-1] < passed:
                    negated["et"] = row["et"]
                yield Row(**negated)
            yield Row(**dict(zip(names, values)))
            held = (*values, row["_ms"])
        self.previous.update(held)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last_ms + self.ttl_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.previous.clear()
        return iter(())


class NewestAfter(_Keyed):
    """The newest row of a key once, ``delay_ms`` of event time after its first row.

    The alternative to ``Retract``: nothing is taken back, results come later.  A row leaves when the watermark has
    passed it, so its ``et`` is moved up to the watermark; its own time stays in ``ts``.
    """

    def __init__(self, schema: T.StructType, delay_ms: int):
        self.schema, self.delay_ms = schema, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", _with_ms(self.schema))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        at = self.schema.names.index("ts")
        held = self.newest.get() if self.newest.exists() else None
        for row in rows:
            values = tuple(row[n] for n in self.schema.names)
            if held is None:
                self.handle.registerTimer(row["_ms"] + self.delay_ms)
            if held is None or values[at] >= held[at]:
                held = (*values, row["_ms"])
        self.newest.update(held)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.newest.exists():
            *values, own_ms = self.newest.get()
            row = dict(zip(self.schema.names, values))
            row["et"] += timedelta(milliseconds=max(0, timerValues.getCurrentWatermarkInMs() - own_ms))
            yield Row(**row)
            self.newest.clear()


class LatestRecord(_Keyed):
    """Only rows whose ``ts`` exceeds that of every earlier row of the key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getValueState("top", _LONG)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.top.get()[0] if self.top.exists() else None
        top = known
        for row in rows:
            if top is None or row["ts"] > top:
                top = row["ts"]
                yield row
        if top != known:
            self.top.update((top,))


class Profile(_Keyed):
    """Per row: rows of the user so far, and the distinct systems and keywords, sorted and comma-joined."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pv = handle.getValueState("pv", _LONG)
        self.seen = {name: handle.getMapState(name, _TEXT, _LONG) for name in ("os", "keyword")}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        pv = self.pv.get()[0] if self.pv.exists() else 0
        sets = {name: {k[0] for k in state.keys()} for name, state in self.seen.items()}
        for row in rows:
            pv += 1
            for name, values in sets.items():
                if row[name] is not None and row[name] not in values:
                    values.add(row[name])
                    self.seen[name].updateValue((row[name],), (1,))
            yield Row(uid=row["uid"], pv=pv, **{n: ",".join(sorted(v)) for n, v in sets.items()})
        self.pv.update((pv,))


class VersionInForce(_Keyed):
    """Rows with the version of their key that was in force at their time, given out when the watermark has passed them.

    Versions are kept as long as a row may still ask for them: the newest that the watermark has passed, and all later ones.
    """

    def __init__(self, rows: T.StructType, versions: T.StructType):
        self.rows, self.versions = rows, versions

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getMapState("known", _LONG, self.versions)
        self.waiting = handle.getListState("waiting", _with_ms(self.rows))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        times = set()
        for row in rows:
            if row["_kind"] == 0:
                self.known.updateValue((row["_ms"],), _values(row["_version"], self.versions))
            else:
                self.waiting.appendValue((*_values(row["_row"], self.rows), row["_ms"]))
                times.add(row["_ms"])
        for ms in times:
            self.handle.registerTimer(ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        waiting = [tuple(w) for w in self.waiting.get()] if self.waiting.exists() else []
        known = sorted((k[0], tuple(v)) for k, v in self.known.iterator())
        for *values, ms in (w for w in waiting if w[-1] <= passed):
            held = [v for at, v in known if at <= ms]
            found = held[-1] if held and held[-1][0] else (None,) * len(self.versions)
            yield Row(**dict(zip(self.rows.names, values)), **dict(zip(self.versions.names[1:], found[1:])))
        left = [w for w in waiting if w[-1] > passed]
        if left:
            self.waiting.put(left)
        else:
            self.waiting.clear()
        for at in [at for at, _ in known if at <= passed][:-1]:
            self.known.removeKey((at,))


class EarlyJoin(_Keyed):
    """A left join that answers at once: the row with nulls, and when a partner comes its retraction and the joined row.

    ``change`` is + for a row that holds and - for one that is taken back, ``version`` counts a key's changes.  A key is
    forgotten ``bound_ms`` after its last row.
    """

    def __init__(self, left: T.StructType, right: T.StructType, bound_ms: int):
        self.left, self.right, self.bound_ms = left, right, bound_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lefts, self.rights = handle.getListState("lefts", self.left), handle.getListState("rights", self.right)
        self.version = handle.getValueState("version", _LONG)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        lefts = [tuple(x) for x in self.lefts.get()] if self.lefts.exists() else []
        rights = [tuple(x) for x in self.rights.get()] if self.rights.exists() else []
        version, last_ms = self.version.get()[0] if self.version.exists() else 0, 0
        nothing = (None,) * len(self.right)
        timers = list(self.handle.listTimers())
        if timers and max(timers) <= timerValues.getCurrentWatermarkInMs():  # ended, though the timer's turn comes after the rows
            lefts, rights = [], []
            self.lefts.clear()
            self.rights.clear()

        def out(change: str, a: tuple, b: tuple) -> Row:
            return Row(**dict(zip(self.left.names, a)), **dict(zip(self.right.names, b)), change=change, version=version)

        for row in rows:
            last_ms = max(last_ms, row["_ms"])
            if row["_kind"] == 0:
                a = _values(row["_left"], self.left)
                for b in rights or [nothing]:
                    version += 1
                    yield out("+", a, b)
                lefts.append(a)
                self.lefts.appendValue(a)
            else:
                b = _values(row["_right"], self.right)
                for a in lefts:
                    if not rights:
                        version += 1
                        yield out("-", a, nothing)
                    version += 1
                    yield out("+", a, b)
                rights.append(b)
                self.rights.appendValue(b)
        self.version.update((version,))
        for timer in timers:
            last_ms = max(last_ms, timer - self.bound_ms)
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last_ms + self.bound_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        for state in (self.lefts, self.rights, self.version):
            state.clear()
        return iter(())


class FirstEver(_Keyed):
    """The first row of a key to arrive, and never another one: the mark has no end.  Keys of an initial state are marked."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", _LONG)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.update((1,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if not self.seen.exists():
            self.seen.update((1,))
            yield next(iter(rows))


# -- the processors on DataFrames -----------------------------------------------------------

def _day_start(df: DataFrame, ts: str, tz: str | None) -> DataFrame:
    return df.withColumn("_day_start", day_start_millis(local_day(F.col(ts), tz), tz))


def _event_ms(df: DataFrame) -> DataFrame:
    return df.withColumn("_ms", F.unix_millis("et"))


def _apply(df: DataFrame, keys: list[str], processor: StatefulProcessor, schema: T.StructType) -> DataFrame:
    """Event-time mode keeps the watermark of ``et`` alive for a window after the processor."""
    event_time = {"eventTimeColumnName": "et"} if "et" in schema.names else {}
    return df.groupBy(*keys).transformWithState(processor, schema, "Append",
                                                "EventTime" if event_time else "None", **event_time)


def first_of_day_stream(df: DataFrame, keys: list[str], ts: str, flag: str = "uv", tz: str | None = None) -> DataFrame:
    """``df`` (with ``et``) and ``flag``: streaming form of ``flag_first_of_day``."""
    schema = T.StructType(df.schema.fields + [T.StructField("first_of_day", T.LongType())])
    return _apply(_day_start(df, ts, tz), keys, FirstOfDay(), schema).withColumnRenamed("first_of_day", flag)


def daily_logins_stream(df: DataFrame, tz: str | None = None, gap_days: int = 8) -> DataFrame:
    """Rows (uid, et, ts): streaming form of ``daily_logins``."""
    schema = T.StructType([df.schema["uid"], df.schema["et"], df.schema["ts"],
                           T.StructField("uu_ct", T.LongType()), T.StructField("back_ct", T.LongType())])
    return _apply(_day_start(df, "ts", tz), ["uid"], LoginDays(gap_days), schema)


def repair_new_visitors_stream(df: DataFrame, tz: str | None = None) -> DataFrame:
    """Flat rows with mid, is_new, ts and ``et``: streaming form of ``repair_new_visitors``."""
    return _apply(_day_start(df, "ts", tz), ["mid"], FirstVisit(), df.schema)


def retract_stream(df: DataFrame, keys: list[str], measures: list[str], ttl_ms: int = 10_000) -> DataFrame:
    """Rows with ``et``: streaming form of ``retract_by_negation``, forgetting keys after ``ttl_ms``."""
    return _apply(_event_ms(df), keys, Retract(df.schema, measures, ttl_ms), df.schema)


def newest_after_stream(df: DataFrame, keys: list[str], delay_ms: int = 5_000) -> DataFrame:
    """Rows with ``ts`` and ``et``: streaming form of ``latest_per_key``, each key given out after ``delay_ms``."""
    return _apply(_event_ms(df), keys, NewestAfter(df.schema, delay_ms), df.schema)


def latest_records_stream(df: DataFrame, key: str) -> DataFrame:
    """Rows with ``ts`` and ``et``: streaming form of ``latest_records``."""
    return _apply(df, [key], LatestRecord(), df.schema)


def profile_stream(df: DataFrame) -> DataFrame:
    """Rows (uid, os, keyword): streaming form of ``running_profile``."""
    schema = T.StructType([df.schema["uid"], T.StructField("pv", T.LongType()),
                           T.StructField("os", T.StringType()), T.StructField("keyword", T.StringType())])
    return _apply(df, ["uid"], Profile(), schema)


def lookup_as_of_stream(df: DataFrame, versions: DataFrame, on: dict[str, str], add: dict[str, str], deleted: Column | None = None,
                        salts: int = 1) -> DataFrame:
    """Streaming form of ``lookup_as_of``: both streams have a watermarked ``et``, whose milliseconds count as time.

    A row leaves when the watermark has passed it, so it meets every version up to its time; it leaves without ``et``.
    With ``salts`` the rows of a key are spread and its versions copied, for keys as few as a configuration's.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    columns = [c for c in df.columns if c != "et"]
    alive = ~F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(True)
    held = versions.select(
        *[F.col(d).alias(k) for k, d in zip(keys, on.values(), strict=True)], F.explode(F.array(*[F.lit(k) for k in range(salts)])).alias("_salt"),
        "et", F.struct(alive.alias("_alive"), *[F.col(c).alias(name) for c, name in add.items()]).alias("_version"))
    # Columns may hold maps, which have no hash of their own.
    salt = F.pmod(F.xxhash64(F.to_json(F.struct(*columns))), F.lit(salts)).cast("int") if salts > 1 else F.lit(0)
    rows = df.select(*[F.col(c).alias(k) for k, c in zip(keys, on, strict=True)], salt.alias("_salt"), "et", F.struct(*columns).alias("_row"))
    row_type, version_type = rows.schema["_row"].dataType, held.schema["_version"].dataType
    both = rows.withColumns({"_version": F.lit(None).cast(version_type), "_kind": F.lit(1)}).unionByName(
        held.withColumns({"_row": F.lit(None).cast(row_type), "_kind": F.lit(0)}))
    out = T.StructType([*row_type.fields, *[T.StructField(f.name, f.dataType) for f in version_type.fields[1:]]])
    return _event_ms(both).groupBy(*keys, "_salt").transformWithState(VersionInForce(row_type, version_type), out, "Append", "EventTime")


def early_left_join_stream(left: DataFrame, right: DataFrame, left_key: str, right_key: str, bound_ms: int = 10_000) -> DataFrame:
    """Rows of ``left`` at once, joined as soon as a partner comes (see ``EarlyJoin``); both have a watermarked ``et``.

    Columns of the two sides differ; the result has those of both without ``et``, ``change`` and ``version``.
    """
    mine, other = ([c for c in df.columns if c != "et"] for df in (left, right))
    a = left.select(F.col(left_key).alias("_key"), "et", F.struct(*mine).alias("_left"))
    b = right.select(F.col(right_key).cast(left.schema[left_key].dataType).alias("_key"), "et", F.struct(*other).alias("_right"))
    left_type, right_type = a.schema["_left"].dataType, b.schema["_right"].dataType
    both = a.withColumns({"_right": F.lit(None).cast(right_type), "_kind": F.lit(0)}).unionByName(
        b.withColumns({"_left": F.lit(None).cast(left_type), "_kind": F.lit(1)}))
    right_out = [T.StructField(f.name, f.dataType) for f in right_type.fields]
    out = T.StructType([*left_type.fields, *right_out, T.StructField("change", T.StringType()), T.StructField("version", T.LongType())])
    return _event_ms(both).groupBy("_key").transformWithState(EarlyJoin(left_type, right_type, bound_ms), out, "Append", "EventTime")


def first_ever_stream(df: DataFrame, keys: list[str], seen: DataFrame | None = None) -> DataFrame:
    """The first row of each key to arrive, for ever; ``seen`` holds the keys of rows given out before, on a new start.

    The state grows with the number of keys and has no end, as nothing says when a key may come again.
    """
    schema, event_time = df.schema, {"eventTimeColumnName": "et"} if "et" in df.columns else {}
    initial = None if seen is None else seen.select(*keys).distinct().groupBy(*keys)
    return df.groupBy(*keys).transformWithState(FirstEver(), schema, "Append", "EventTime" if event_time else "None",
                                                initialState=initial, **event_time)
