"""Sequential acceptance: what happens to a row depends on the last row of its key that was accepted, which no window
expresses. Spark deals the rows by key and sorts them within partitions (spilling as it must); a task goes through them in
order and holds one key's state at a time, however many rows the key has. The steps are small functions, shared with the
streaming counterparts."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Takes the state of a key (None before its first row) and the needed values of a row; gives the new state and added values.
Step = Callable[[Any, tuple], tuple[Any, tuple]]


def with_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], needs: Sequence[str], step: Step, added: str) -> DataFrame:
    """df with the columns ``added`` (a schema) that ``step`` gives when it goes through each key's rows in order. Null keys are
    a key of their own; columns of the same names are replaced; other columns pass through unread."""
    new = T.StructType.fromDDL(added)
    taken = {f.name.lower() for f in new}
    kept = [c for c in df.columns if c.lower() not in taken]
    missing = [c for c in (*keys, *needs) if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    hidden = {f"_fold_{i}": c for i, c in enumerate([*keys, *needs])}
    rows = df.repartition(*[F.col(f"`{k}`") for k in keys]).sortWithinPartitions(*[F.col(f"`{k}`") for k in keys], *order)
    rows = rows.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(h) for h, c in hidden.items()])
    n_kept, n_keys, kinds = len(kept), len(keys), [to_arrow_type(f.dataType) for f in new]
    names = [*kept, *new.names]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        state: Any = None
        for batch in batches:
            found: list[tuple] = []
            for row in zip(*[batch.column(n_kept + i).to_pylist() for i in range(len(hidden))], strict=True):
                if row[:n_keys] != key:
                    key, state = row[:n_keys], None
                state, values = step(state, row[n_keys:])
                found.append(values)
            extra = [pa.array(v, kind) for v, kind in zip(zip(*found, strict=True) if found else [()] * len(kinds), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(n_kept)], *extra], names=names)

    return rows.mapInArrow(fold, T.StructType([df.schema[c] for c in kept] + list(new)))


# deliveries


def delivery_step(window: float) -> Step:
    """accepted: the delivery was not accepted within the last ``window``. A repeat that is refused does not prolong it."""

    def step(state: Any, row: tuple) -> tuple[Any, tuple]:
        (at,) = row
        if state is not None and at is not None and at - state <= window:
            return state, (False,)
        return at, (True,)

    return step


def dedupe_deliveries(df: DataFrame, keys: Sequence[str], at: str, order: Sequence[str | Column], *, window: float) -> DataFrame:
    """df with ``accepted``; a delivery's id is forgotten when ``window`` has passed since it was accepted."""
    return with_fold(df, keys, order, [at], delivery_step(window), "accepted boolean")


# reports in sequence


def sequence_step(interval: float, lifetime: float) -> Step:
    """accepted and refusal: the last accepted report of a key must be ``interval`` old at least ("interval"), and of the same
    session with a smaller sequence ("superseded"). It is forgotten once it is older than ``lifetime``."""

    def step(state: Any, row: tuple) -> tuple[Any, tuple]:
        at, session, sequence = row
        if state is not None and at - state[0] <= lifetime:
            if at - state[0] < interval:
                return state, (False, "interval")
            if session != state[1] or sequence <= state[2]:
                return state, (False, "superseded")
        return (at, session, sequence), (True, None)

    return step


def sequence_guard(df: DataFrame, keys: Sequence[str], at: str, session: str, sequence: str, order: Sequence[str | Column] = (), *, interval: float = 10, lifetime: float = 86_400) -> DataFrame:
    """df with ``accepted`` and ``refusal`` of every report, in the order of ``at`` and then ``order``."""
    return with_fold(df, keys, [at, *order], [at, session, sequence], sequence_step(interval, lifetime), "accepted boolean, refusal string")


# bindings


def binding_step(n_fixed: int, lifetime: float) -> Step:
    """accepted, first (the sighting began the binding) and bound values: a key is bound to the ``fixed`` values of its first
    sighting; one with others is refused and does not refresh the binding, which ends when unseen for over ``lifetime``."""

    def step(state: Any, row: tuple) -> tuple[Any, tuple]:
        at, fixed = row[0], row[1 : 1 + n_fixed]
        if any(v is None for v in fixed):
            return state, (False, False)
        if state is not None and at - state[0] <= lifetime:
            if fixed != state[1]:
                return state, (False, False)
            return (at, fixed), (True, False)
        return (at, fixed), (True, True)

    return step


def bindings(df: DataFrame, key: str, at: str, fixed: Sequence[str], order: Sequence[str | Column] = (), *, lifetime: float) -> DataFrame:
    """df with ``accepted`` and ``first`` of every sighting, in the order of ``at`` and then ``order``. A sighting without all of
    ``fixed`` is no sighting."""
    return with_fold(df, [key], [at, *order], [at, *fixed], binding_step(len(fixed), lifetime), "accepted boolean, first boolean")


def sticky_mapping(df: DataFrame, key: str, at: str, fixed: Sequence[str], latest: Sequence[str], order: Sequence[str] = (), *, clock: float, lifetime: float) -> DataFrame:
    """key, fixed, latest (of the last accepted sighting), since (start of the binding), seen of the bindings alive at ``clock``."""
    seen = bindings(df, key, at, fixed, order, lifetime=lifetime).where("accepted")
    last = F.max(F.struct(at, *order, *[F.col(c).alias(f"_v{i}") for i, c in enumerate([*fixed, *latest])])).alias("r")
    found = seen.groupBy(key).agg(last, F.max(F.when(F.col("first"), F.col(at))).alias("since"))
    found = found.select(key, *[F.col(f"r._v{i}").alias(c) for i, c in enumerate([*fixed, *latest])], "since", F.col(f"r.{at}").alias("seen"))
    return found.where(F.col("seen") >= F.lit(clock) - F.lit(lifetime))


# records

# Ranks of statuses; any other has the lowest.
STATUS_RANK = {"in_progress": 2, "completed": 3}
WAITING = ("pending", "waiting")


@dataclass(frozen=True)
class Merge:
    """How a record follows its predecessor.

    A later record replaces an earlier one unless its status ranks lower (but a running one may wait again) or it was updated
    earlier. ``fill`` names the columns that keep their old value when the new one says nothing: null, empty, or the given
    word. ``learn`` (column of a known host, column of the kind, kinds that are no host, columns taken along) lets a record of a
    known host name the kind even if it comes too late to replace anything, as a job's place never changes."""

    status: str = "status"
    updated: str = "updated"
    fill: Mapping[str, Any] = field(default_factory=dict)
    learn: tuple[str, str, Sequence[str], Sequence[str]] | None = None

    def __call__(self, old: dict | None, new: dict) -> tuple[dict, bool]:
        """The state after ``new``, and whether ``new`` replaced ``old``."""
        if old is None:
            return new, True
        was, now = old.get(self.status), new.get(self.status)
        waits_again = was == "in_progress" and now in WAITING
        before, after = old.get(self.updated), new.get(self.updated)
        older = before is not None and (after is None or after < before)
        accepted = not older and (waits_again or STATUS_RANK.get(now, 1) >= STATUS_RANK.get(was, 1))
        state = dict(new if accepted else old)
        if accepted:
            for column, empty in self.fill.items():
                if not state.get(column) or state.get(column) == empty:
                    if old.get(column) is not None:
                        state[column] = old[column]
        if self.learn:
            host, kind, unknown, along = self.learn
            known = new.get(host)
            if known and (state.get(kind) in (None, *unknown)):
                state |= {kind: known, host: known} | {c: new[c] for c in along if new.get(c)}
        return state, accepted


def packed(df: DataFrame, columns: Sequence[str]) -> Column:
    """The columns as JSON text; null ones are left out."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]))


def record_step(merge: Merge) -> Step:
    """accepted, before and after as JSON: null before a key's first record, and equal where nothing changed."""

    def step(state: Any, row: tuple) -> tuple[Any, tuple]:
        old, text = state if state is not None else (None, None)
        new, accepted = merge(old, json.loads(row[0]))
        after = json.dumps(new, sort_keys=True)
        return (new, after), (accepted, text, after)

    return step


def record_type(df: DataFrame, columns: Sequence[str]) -> str:
    return T.StructType([df.schema[c] for c in columns]).simpleString()


def state_changes(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], columns: Sequence[str], merge: Merge) -> DataFrame:
    """df with ``accepted`` and the whole record ``before`` and ``after`` each observation of its key (structs of ``columns``),
    in order of arrival. What counts a record by its columns can thus take back ``before`` and add ``after``.

    Values pass through JSON, so columns hold what JSON can: texts, numbers, flags, and arrays and structs of these."""
    rows = with_fold(df.withColumn("_record", packed(df, columns)), keys, order, ["_record"], record_step(merge), "accepted boolean, before string, after string")
    shape = record_type(df, columns)
    return rows.drop("_record").withColumns({c: F.from_json(c, shape) for c in ("before", "after")})


def signed_records(changes: DataFrame) -> DataFrame:
    """The changes as rows to add and to take back: all other columns, record and sign (1 or -1); none where nothing changed."""
    rest = [c for c in changes.columns if c not in ("accepted", "before", "after")]
    moved = changes.where(~F.col("before").eqNullSafe(F.col("after")))
    both = F.array(F.struct(F.col("before").alias("record"), F.lit(-1).alias("sign")), F.struct(F.col("after").alias("record"), F.lit(1).alias("sign")))
    return moved.select(*rest, F.explode(both).alias("_s")).select(*rest, "_s.record", "_s.sign").where("record is not null")


def agreeing(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Whether the values of two arrays of one type and length agree, null with null. What cannot be compared (NaN, maps) does not."""
    kind, (a_null, b_null) = a.type, [x.is_null().to_numpy(zero_copy_only=False) for x in (a, b)]
    same = a_null == b_null
    if pa.types.is_struct(kind):
        for x, y in zip(a.flatten(), b.flatten(), strict=True):
            same &= agreeing(x, y)
    elif pa.types.is_list(kind) or pa.types.is_large_list(kind):
        a_size, b_size = [pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False) for x in (a, b)]
        same &= a_size == b_size
        rows = np.flatnonzero(same & (a_size > 0))
        inner = agreeing(a.take(pa.array(rows)).flatten(), b.take(pa.array(rows)).flatten())
        same[np.repeat(rows, a_size[rows])[~inner]] = False
    elif pa.types.is_nested(kind):
        same &= a_null
    elif not pa.types.is_null(kind):
        same &= a_null | pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False)
    return same


class _Blank(int):
    """The place of a value that is there but says nothing."""

    def __bool__(self) -> bool:
        return False


def _places(values: pa.Array) -> list:
    """For every value its place, counted from 1, that is true where the value is (as read from JSON); None for null."""
    kind = values.type
    if pa.types.is_struct(kind):
        blank = np.logical_and.reduce([np.ones(len(values), bool), *[x.is_null().to_numpy(zero_copy_only=False) for x in values.flatten()]])
    else:
        size = pc.list_value_length if pa.types.is_nested(kind) else pc.binary_length if pa.types.is_string(kind) or pa.types.is_large_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_binary(kind) else None
        number = size(values) if size else values.cast(pa.int8()) if pa.types.is_boolean(kind) else values if pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_decimal(kind) else None
        blank = pc.fill_null(pc.equal(number, pa.scalar(0, number.type)), False).to_numpy(zero_copy_only=False) if number is not None else np.zeros(len(values), bool)
    places = np.arange(1, len(values) + 1).astype(object)
    for i in np.flatnonzero(blank):
        places[i] = _Blank(i + 1)
    places[values.is_null().to_numpy(zero_copy_only=False)] = None
    return places.tolist()


def net_records(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], columns: Sequence[str], merge: Merge, along: Sequence[str] = ()) -> DataFrame:
    """keys, the columns ``along`` of the observation, record and sign: ``signed_records`` of ``state_changes`` without those that cancel.

    What an observation adds, the next one that changes its key's record takes back. Where both have the same values ``along`` (say,
    of a run), this is one row with both signs, and neither is made; where these values changed, both are. So summed over all rows, anything
    that is counted by a record and ``along`` is the same, however often a record was replaced in between.

    Values do not pass through Python but those that ``merge`` compares: a record is kept as the places its columns were seen at, and
    is put together by Arrow when it is given out. Of a key nothing is held but one row."""
    seen = [*keys, *along, *columns]
    missing = [c for c in seen if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    n_keys, n_along = len(keys), len(along)
    compared = {merge.status, merge.updated, *(merge.learn[:2] if merge.learn else ()), *(c for c, empty in merge.fill.items() if empty is not None)}
    placed = {*merge.fill, *(merge.learn[3] if merge.learn else ())} - compared
    compared, placed = [c for c in columns if c in compared], [c for c in columns if c in placed]
    rows = df.repartition(*[F.col(f"`{k}`") for k in keys]).sortWithinPartitions(*[F.col(f"`{k}`") for k in keys], *order)
    rows = rows.select(*[F.col(f"`{c}`").alias(f"_net_{i}") for i, c in enumerate(seen)])
    at_column = {c: n_keys + n_along + i for i, c in enumerate(columns)}
    row = ""  # the entry of a record that tells the place of all columns that are not listed by themselves

    def put_together(values: list[pa.Array], states: list[dict]) -> list[pa.Array]:
        """The columns of records, from the places they name."""
        where = {c: pa.array([None if s[c] is None else s[c] - 1 for s in states], pa.int64()) for c in (row, *placed)}
        made = lambda c, v: pa.array([s[c] for s in states], v.type) if c in compared else v.take(where[c if c in placed else row])
        return [made(c, values[at_column[c]]) for c in columns]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None
        carried: list[pa.Array] = []  # the row at place 1: the last key, the record's columns, and the values along of what it was last counted with

        def given(values: list[pa.Array], out: list[tuple[int, dict, int]]) -> pa.RecordBatch:
            index, states, signs = ([x[i] for x in out] for i in range(3))
            record = pa.StructArray.from_arrays(put_together(values, states), names=list(columns))
            return pa.RecordBatch.from_arrays([*[v.take(pa.array(index, pa.int64())) for v in values[: n_keys + n_along]], record, pa.array(signs, pa.int32())], names=[*keys, *along, "record", "sign"])

        for batch in batches:
            if not batch.num_rows:
                continue
            values = [pa.concat_arrays([old, new]) for old, new in zip(carried, batch.columns, strict=True)] if carried else list(batch.columns)
            n = len(values[0])
            same = [np.logical_and.reduce([np.ones(n - 1, bool), *[agreeing(v.slice(0, n - 1), v.slice(1)) for v in part]]) for part in (values[:n_keys], values[n_keys : n_keys + n_along])]
            same_key, same_along = [[False, *s.tolist()] for s in same]
            names = [row, *compared, *placed]
            entries = zip(range(1, n + 1), *[values[at_column[c]].to_pylist() for c in compared], *[_places(values[at_column[c]]) for c in placed], strict=True)
            out: list[tuple[int, dict, int]] = []
            last, moved = 0, False  # where the record was last counted, and whether values along have changed since
            for i, entry in enumerate(entries):
                if i == 0 and carried:
                    continue
                if state is not None and not same_key[i]:
                    out.append((last, state, 1))
                    state = None
                new, _ = merge(state, dict(zip(names, entry, strict=True)))
                moved = state is not None and (moved or not same_along[i])
                if new == state:
                    continue
                if moved:
                    out += [(last, state, 1), (i, state, -1)]
                state, last, moved = new, i, False
            if out:
                yield given(values, out)
            carried = [*[v.take(pa.array([last])) for v in values[: n_keys + n_along]], *put_together(values, [state])]
            state = {c: v if c in compared or v is None else 1 if v else _Blank(1) for c, v in state.items()}
        if state is not None:
            yield given(carried, [(0, state, 1)])

    record = T.StructType([T.StructField(c, df.schema[c].dataType) for c in columns])
    return rows.mapInArrow(fold, T.StructType([T.StructField(c, df.schema[c].dataType) for c in (*keys, *along)]).add("record", record).add("sign", "integer"))


def latest_state(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], merge: Merge) -> DataFrame:
    """keys, columns and n_accepted after the last observation of each key; columns named in ``order`` end the ordering."""
    rows = state_changes(df, keys, order, columns, merge)
    last = F.max_by("after", F.struct(*order)).alias("r")
    return rows.groupBy(*keys).agg(last, F.count_if("accepted").alias("n_accepted")).select(*keys, *[F.col(f"r.`{c}`").alias(c) for c in columns if c not in keys], "n_accepted")
