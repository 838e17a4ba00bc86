"""Streams over keyed state: reorganisations, throttled calls and events that wait for their calls.

State lives in the state store (transformWithState needs RocksDB, see `started_in`), keyed within each group, and nothing of
a group is put together in one frame: rows come in Arrow batches and go to the state as they come. Event-time timers say when rows are
in order, or late: whatever files come in which order, within the watermark's delay the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerloom.operators.reorg import DEPTH

#: What the streams of this package need of the session they are started in: state in RocksDB, and one stateful operator per stream, so that
#: a batch's late rows are judged by the watermark that closed the windows before it.
NEEDED = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.statefulOperator.allowMultiple": "false",
}


@contextmanager
def started_in(spark: SparkSession):
    """Streams that are started within have what they need; the session is as before afterwards."""
    before = {k: spark.conf.get(k, None) for k in NEEDED}
    for k, v in NEEDED.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class InOrder(StatefulProcessor):
    """Steps through a group's rows in order of their times.

    Rows wait in a list state until the watermark has passed their time, that is until no earlier one can come. A timer at the earliest
    waiting row wakes the group, so it gets on without new rows of its own. An entry of the list holds up to CHUNK rows, an array per
    column: what an entry costs to write and to read is paid once for all of them.
    """

    CHUNK = 4096
    #: Name and type of the columns that wait; `ms`, the row's time, is added.
    columns: tuple[tuple[str, str], ...] = ()
    output = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.names = [*[c for c, _ in self.columns], "ms"]
        self.waiting = handle.getListState("waiting", ", ".join(f"{c} array<{t}>" for c, t in self.columns) + ", ms array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held: list[list] = [[] for _ in self.names]
        first = None
        for p in rows:
            if len(p):
                ms = p["time"].astype("datetime64[ms]").astype("int64")
                for values, (c, _) in zip(held, self.columns):
                    values += p[c].tolist() if p[c].notna().all() else p[c].astype(object).where(p[c].notna(), None).tolist()
                held[-1] += ms.tolist()
                first = int(ms.min()) if first is None else min(first, int(ms.min()))
                if len(held[-1]) >= self.CHUNK:
                    self.waiting.appendList(self.chunks(held))
                    held = [[] for _ in self.names]
        if held[-1]:
            self.waiting.appendList(self.chunks(held))
        if first is not None:
            self.handle.registerTimer(first + 1)
        yield from ()

    def chunks(self, columns: list[list]) -> list[tuple]:
        """Columns as entries of the list state."""
        return [tuple(c[at : at + self.CHUNK] for c in columns) for at in range(0, len(columns[-1]), self.CHUNK)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs()
        held: list[list] = [[] for _ in self.names]
        for entry in self.waiting.get():
            for values, more in zip(held, entry):
                values += more
        ready = [t < upto for t in held[-1]]
        if any(ready):
            self.waiting.clear()
            if not all(ready):
                rest = [[v for v, r in zip(c, ready) if not r] for c in held]
                self.waiting.put(self.chunks(rest))
                self.handle.registerTimer(min(rest[-1]) + 1)
            found = self.step(key, pd.DataFrame({n: pd.Series([v for v, r in zip(c, ready) if r], dtype=object) for n, c in zip(self.names, held)}))
            if len(found):
                yield found

    def step(self, key, rows: pd.DataFrame) -> pd.DataFrame:
        raise NotImplementedError

    def close(self) -> None:
        pass


def walk(tracked: dict[int, str], blocks, depth: int = DEPTH) -> list[tuple[int, str, int | None]]:
    """(number, kind, ancestor) of the reorganisations that blocks (number, hash, parent_hash, in order) cause; tracked is brought up to date.

    A block whose number is known under another hash has replaced it; one whose parent hash is not the hash tracked for the number
    before is detached. It builds on the tracked block that its parent hash names, if that is not deeper than `depth`. What it orphans
    is forgotten, and so is what lies `depth` below.
    """
    out = []
    for n, h, parent in blocks:
        kind = "replaced" if tracked.get(n, h) != h else "detached" if tracked.get(n - 1, parent) != parent else None
        if kind:
            found = [k for k, v in tracked.items() if v == parent]
            out.append((n, kind, max(found) if found else None))
            for k in [k for k in tracked if k >= n]:
                del tracked[k]
        tracked[n] = h
        if len(tracked) > depth:
            for k in [k for k in tracked if k <= n - depth]:
                del tracked[k]
    return out


class Reorgs(InOrder):
    columns = (("number", "bigint"), ("hash", "string"), ("parent_hash", "string"))
    output = "chain_id long, number long, kind string, ancestor long"

    def __init__(self, depth: int):
        self.depth = depth

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.tracked = handle.getMapState("tracked", "number bigint", "hash string")

    def step(self, key, rows: pd.DataFrame) -> pd.DataFrame:
        """The tracked blocks are a map state of `depth` entries at most; only what a step changes is written."""
        before = {k[0]: v[0] for k, v in self.tracked.iterator()}
        after = dict(before)
        rows = rows[rows["hash"].notna()].sort_values(["ms", "number", "hash"], kind="stable")
        found = walk(after, zip(rows["number"].astype(int).tolist(), rows["hash"], rows["parent_hash"]), self.depth)
        for n in before.keys() - after.keys():
            self.tracked.removeKey((n,))
        for n, h in after.items():
            if before.get(n) != h:
                self.tracked.updateValue((n,), (h,))
        frame = pd.DataFrame([(key[0], *r) for r in found], columns=["chain_id", "number", "kind", "ancestor"], dtype=object)
        return frame.astype({"chain_id": "Int64", "number": "int64", "ancestor": "Int64"})


def reorgs(blocks: DataFrame, depth: int = DEPTH, late: str = "10 minutes") -> DataFrame:
    """(chain_id, number, kind, ancestor) of the reorganisations in a stream of blocks (chain_id, number, hash, parent_hash, time).

    Blocks count in order of (time, number, hash), in whatever order they come within `late`; a row without a hash only moves the
    watermark. The result is that of `walk` over a chain's blocks in that order.
    """
    rows = blocks.select("chain_id", "number", "hash", "parent_hash", "time").withWatermark("time", late)
    return rows.groupBy("chain_id").transformWithStateInPandas(Reorgs(depth), Reorgs.output, "append", "EventTime")


class Throttle(InOrder):
    """One group holds many keys; the last block taken of each that has one is an entry of two arrays."""

    columns = (("key", "bigint"), ("number", "bigint"), ("ts", "bigint"))
    output = "key long, number long, ts long"

    def __init__(self, seconds: int):
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.taken = handle.getValueState("taken", "key array<bigint>, ts array<bigint>")

    def step(self, key, rows: pd.DataFrame) -> pd.DataFrame:
        last = dict(zip(*self.taken.get())) if self.taken.exists() else {}
        rows = rows[rows["ts"].notna() & rows["key"].notna()].astype("int64").sort_values(["key", "ts", "number"], ignore_index=True)
        keys, times, keep = rows["key"].to_numpy(), rows["ts"].to_numpy(), []
        ends = [*np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)] if len(keys) else []
        begin = 0
        for end in ends:
            own, k = times[begin:end], int(keys[begin])
            at = int(own.searchsorted(last.get(k, 0) + self.seconds))
            while at < len(own):
                keep.append(begin + at)
                last[k] = int(own[at])
                at = int(own.searchsorted(last[k] + self.seconds))
            begin = end
        if keep:
            self.taken.update((list(last), list(last.values())))
        return rows.iloc[keep][["key", "number", "ts"]]


def throttled(blocks: DataFrame, seconds: int, late: str = "10 minutes", groups: int = 512) -> DataFrame:
    """Blocks (key, number, ts) of a stream (also time) that a call falls due at: the first at least `seconds` after the one before.

    Keys share `groups` groups: most have few blocks, and a group costs several calls of the state store however small it is. With many
    times the keys, `groups` is to be raised.
    """
    rows = blocks.select("key", "number", "ts", "time").withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups))).withWatermark("time", late)
    return rows.groupBy("group").transformWithStateInPandas(Throttle(seconds), Throttle.output, "append", "EventTime")


#: Blocks and log indexes whose events share a group, and rows that are packed at once.
SPAN, LANE, PACKED = 16384, 16, 1 << 17
#: A row that goes to a group: an event (its needs) or a call (its name and result). Null times are the least number.
ROWS = pa.schema([("block_number", pa.int64()), ("log_index", pa.int64()), ("us", pa.int64()), ("call", pa.bool_()), ("needs", pa.list_(pa.string())), ("name", pa.string()), ("result", pa.string())])
NO_TIME = np.iinfo("int64").min


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches put together to PACKED rows or a little more."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= PACKED:
            yield pa.concat_batches(held)
            held, n = [], 0
    if n:
        yield pa.concat_batches(held)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one group in one value: (span, lane, time of the latest, rows), so that what a row costs on its way to the state is paid once for many.

    Rows without a time are packed apart. Those with null block_number have no rows to pack, only a time; their group is not null, since keys
    beside a null one reach the state as floats, which it takes for nulls.
    """
    def packs(span, lane, time, rows, kind):
        return pa.RecordBatch.from_arrays([pa.array(span, pa.int64()), pa.array(lane, pa.int64()), time.cast(kind), pa.array(rows, pa.binary())], ["span", "lane", "time", "rows"])

    for batch in _gathered(batches):
        time, unknown = batch["time"], batch["block_number"].is_null()
        if unknown.true_count:
            yield packs([0], [0], pa.array([pc.max(time.filter(unknown))]), [None], time.type)
            batch = batch.filter(pc.invert(unknown))
        if not batch.num_rows:
            continue
        us = pc.fill_null(batch["time"].cast(pa.int64()), NO_TIME)
        rows = pa.RecordBatch.from_arrays([us if f.name == "us" else batch[f.name].cast(f.type) for f in ROWS], schema=ROWS)
        span, lane, us = rows["block_number"].to_numpy() // SPAN, rows["log_index"].to_numpy() // LANE, us.to_numpy()
        order = np.lexsort((us == NO_TIME, lane, span))
        rows, span, lane, us = rows.take(pa.array(order)), span[order], lane[order], us[order]
        change = (span[1:] != span[:-1]) | (lane[1:] != lane[:-1]) | ((us[1:] == NO_TIME) != (us[:-1] == NO_TIME))
        first = np.append(0, np.flatnonzero(change) + 1)
        last = np.maximum.reduceat(us, first)
        parts = [rows.slice(at, n).serialize().to_pybytes() for at, n in zip(first.tolist(), np.diff(first, append=len(us)).tolist())]
        yield packs(span[first], lane[first], pa.array(last, mask=last == NO_TIME), parts, time.type)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What groups put out, a row each again."""
    for batch in batches:
        for rows in batch["rows"]:
            yield pa.ipc.read_record_batch(rows.as_buffer(), Awaited.OUT)


class Awaited(StatefulProcessor):
    """The events of a group that wait, and the calls that have come for them or for events that have not: one Arrow batch in a value state."""

    output = "block_number long, log_index long, state string, missing array<string>, calls array<string>, results array<string>"
    OUT = pa.schema([("block_number", pa.int64()), ("log_index", pa.int64()), ("state", pa.string()), *[(c, pa.list_(pa.string())) for c in ("missing", "calls", "results")]])

    def __init__(self, wait: int):
        self.wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [self.read(pack) for p in rows for pack in p["rows"] if pack is not None]
        if new:
            new, late = pa.concat_batches(new), timerValues.getCurrentWatermarkInMs() * 1000
            us = new["us"].to_numpy()
            new = new.filter(pa.array((us > late) | (us == NO_TIME)))
            yield from self.step(pa.concat_batches([*self.held(), new]), None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for rows in self.held():
            yield from self.step(rows, timerValues.getCurrentWatermarkInMs())

    def read(self, pack) -> pa.RecordBatch:
        return pa.ipc.read_record_batch(pa.py_buffer(pack), ROWS)

    def held(self) -> list[pa.RecordBatch]:
        return [self.read(self.waiting.get()[0])] if self.waiting.exists() else []

    def step(self, rows: pa.RecordBatch, upto: int | None) -> Iterator[pd.DataFrame]:
        """Events that are ready come out, or, with `upto`, those whose deadline lies before it; the other rows are held. Of several rows of one
        event the latest to come counts."""
        block, log, ms = rows["block_number"].to_numpy(), rows["log_index"].to_numpy(), rows["us"].to_numpy() // 1000
        is_event = ~rows["call"].to_numpy(zero_copy_only=False)
        events, calls = np.flatnonzero(is_event), np.flatnonzero(~is_event)
        keys, at = np.unique(block % SPAN * LANE + log % LANE, return_inverse=True)  # all rows are of one span and lane
        event = np.full(len(keys), -1)
        event[at[events]] = events
        has = event >= 0
        last = np.full(len(keys), NO_TIME)
        np.maximum.at(last, at[calls], ms[calls])
        last[has] = ms[event[has]]

        # what each event wants, a number per event and name in order of both, and the earliest call in time for it
        needs = rows["needs"].take(pa.array(event[has]))
        named = pa.concat_arrays([needs.flatten(), rows["name"].take(pa.array(calls))]).dictionary_encode(null_encoding="encode")
        order = pc.sort_indices(named.dictionary).to_numpy()
        names, n = named.dictionary.take(pa.array(order)), max(len(order), 1)
        code = np.argsort(order)[named.indices.to_numpy()]
        owner = np.repeat(np.flatnonzero(has), pc.list_value_length(needs).to_numpy())
        wants = np.unique(owner * n + code[: len(owner)])
        found = np.full(len(wants), -1)
        if len(wants):
            asked = at[calls] * n + code[len(owner) :]
            want = np.minimum(wants.searchsorted(asked), len(wants) - 1)
            hit = (wants[want] == asked) & (np.abs(ms[calls] - last[at[calls]]) <= self.wait)
            want, call = want[hit], calls[hit]
            rank = pc.rank(rows["result"].take(pa.array(call)), "ascending", null_placement="at_start").to_numpy()
            best = np.lexsort((rank, ms[call], want))[::-1]
            found[want[best]] = call[best]
        owner, missing = wants // n, found < 0
        lacks = np.bincount(owner[missing], minlength=len(keys))

        gone = has & (lacks == 0) if upto is None else last + self.wait < upto
        done = has & gone
        if done.any():
            lack, came = done[owner] & missing, done[owner] & ~missing
            name = lambda which: names.take(pa.array(wants[which] % n))

            def lists(which: np.ndarray, values: pa.Array) -> pa.ListArray:
                """One list for each event that is done."""
                ends = np.cumsum(np.bincount(owner[which], minlength=len(keys))[done])
                return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), values)

            own, results = event[done], rows["result"].take(pa.array(found[came]))
            state = pa.array(np.where(lacks[done] > 0, "backlog", "ready"), pa.string())
            columns = [pa.array(block[own]), pa.array(log[own]), state, lists(lack, name(lack)), lists(came, name(came)), lists(came, results)]
            yield pd.DataFrame({"rows": [pa.RecordBatch.from_arrays(columns, schema=self.OUT).serialize().to_pybytes()]})

        stays = ~gone[at] & (~is_event | (event[at] == np.arange(len(at))))
        if stays.any():
            self.waiting.update((rows.filter(pa.array(stays)).serialize().to_pybytes(),))
            self.wake_at(int(last[~gone].min()) + self.wait + 1, upto)
        elif self.waiting.exists():
            self.waiting.clear()

    def wake_at(self, first: int, upto: int | None) -> None:
        """One timer at a time: at the earliest deadline. Those up to `upto` are expiring: they are still listed, but will be gone."""
        known = [t for t in self.handle.listTimers() if upto is None or t > upto]
        if not known or first < min(known):
            for t in known:
                self.handle.deleteTimer(t)
            self.handle.registerTimer(first)

    def close(self) -> None:
        pass


def awaited(events: DataFrame, calls: DataFrame, wait: int = 300, late: str = "0 seconds") -> DataFrame:
    """Events with their calls: ready as soon as all they await have come, backlog (with what is missing) `wait` seconds after the event.

    events: block_number, log_index, needs (names of calls; none: ready at once), time; calls: block_number, log_index, name, result,
    time. A call counts for its event when their times lie at most `wait` apart, whichever comes first; the earliest of several of one
    name. Calls without an event are forgotten after the wait. Rows with null block_number only move the watermark.

    Rows go to their group, that of SPAN blocks and LANE log indexes, packed, and what a group puts out is packed too.
    """
    # no list is null: Arrow's writer goes through all null ones before a row again for each row
    none = F.array().cast("array<string>")
    e = events.select("block_number", "log_index", F.lit(False).alias("call"), F.coalesce("needs", none).alias("needs"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("result"), "time")
    c = calls.select("block_number", "log_index", F.lit(True).alias("call"), none.alias("needs"), "name", F.col("result").cast("string").alias("result"), "time")
    rows = e.unionByName(c).mapInArrow(_packed, "span long, lane long, time timestamp, rows binary").withWatermark("time", late)
    done = rows.groupBy("span", "lane").transformWithStateInPandas(Awaited(1000 * wait), "rows binary", "append", "EventTime")
    return done.mapInArrow(_unpacked, Awaited.output)


class Late(StatefulProcessor):
    """Rows whose window had closed before they came. There is no state: the watermark alone decides."""

    def __init__(self, shift: int):
        self.shift = shift

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs() + self.shift
        for p in rows:
            came_late = p["closes"].astype("datetime64[ms]").astype("int64") <= closed
            if came_late.any():
                yield p.loc[came_late].drop(columns=["closes", "salt"])

    def close(self) -> None:
        pass


def late_rows(rows: DataFrame, late: str, kept: str = "365 days", width: str = "1 hour", salts: int = 64) -> DataFrame:
    """Rows (with time) of a stream that come after `candles` with this lateness and width has closed their window: its side table.

    Up to `kept` late rows are told apart; the stream's own watermark is that far behind.
    """
    ms = lambda text: int(pd.Timedelta(text).total_seconds() * 1000)
    marked = rows.withColumn("closes", F.window("time", width)["end"]).withColumn("salt", F.pmod(F.xxhash64("time"), F.lit(salts))).withWatermark("time", kept)
    return marked.groupBy("salt").transformWithStateInPandas(Late(ms(kept) - ms(late)), rows.schema, "append", "EventTime")
