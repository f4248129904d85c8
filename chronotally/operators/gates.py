"""Recursive gates: a tree of rules over parsed JSON, compiled to column expressions, that gives the first reason to reject a
payload with the path where it holds. Also the canonical text of JSON, of which equal documents have equal fingerprints.

JSON is parsed once into a variant; arrays and nested objects are checked by expressions over its parts, inside Spark. A text
that is no JSON, or has a key twice, is ``not-json``."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAFE = 2**53 - 1
UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
SHA = "^[0-9a-f]{40}$"
IDENTITY = "^[0-9]{1,20}$"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"


#: Where a value stands: names and signs, and the places in arrays.
Path = tuple["str | Column", ...]


@dataclass(frozen=True)
class Fields:
    """An object whose fields were taken out of it once: those that its gate knows, and a map of all."""

    known: Mapping[str, Column]
    all: Column


def part(value: Column | Fields, name: str, kind: str = "variant") -> Column:
    """A field of an object; null if it is absent, and a variant's null if it is null there."""
    if isinstance(value, Fields):
        found = value.known[name] if name in value.known else F.try_element_at(value.all, F.lit(name))
        return found if kind == "variant" else as_(found, kind)
    return F.try_variant_get(value, f'$["{name}"]', kind)


def as_(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def is_null(value: Column) -> Column:
    return F.coalesce(F.is_variant_null(value), F.lit(False))


def once(value: Column, *steps: Callable[[Column], Column]) -> Column:
    """The last of the steps, each a function of the one before and the last a text; by lambdas, so that each is worked out once however
    often it is used. An aggregate takes the text out, as ``get`` would derive the type of all that is inside anew for every row."""
    found = F.array(value)
    for step in steps[:-1]:
        found = F.transform(found, step)
    return F.aggregate(found, F.lit(None).cast("string"), lambda _, x: steps[-1](x))


def _written(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


@dataclass(frozen=True)
class Gate:
    """``reads`` is the type by which the tests read a value; those of a plain value may ask for its kind too."""

    nullable: bool = field(default=False, kw_only=True)
    reads, plain = None, False

    def seen(self, value: Column) -> Column:
        """What the tests need of a value: itself (v), its kind (k) and how it reads (x)."""
        kind = [F.schema_of_variant(value).alias("k")] if self.plain else []
        return F.struct(value.alias("v"), *kind, *([] if self.reads is None else [as_(value, self.reads).alias("x")]))

    def tests(self, seen: Column, path: Path) -> list[tuple[str | Column, Column]]:
        """Reasons and when they hold (or reasons that are null if they do not), for a value that is not null."""
        return []

    def judged(self, seen: Column, path: Path) -> Column:
        say = lambda why: _written(f"{why}:", *path)
        found = [F.when(holds, say(why) if isinstance(why, str) else why) for why, holds in self.tests(seen, path)]
        return F.when(seen["k"] == "VOID" if self.plain else is_null(seen["v"]), F.lit(None).cast("string") if self.nullable else say("null")).otherwise(F.coalesce(*found, F.lit(None).cast("string")))

    def reason(self, value: Column, path: Path = ()) -> Column:
        """The first reason to reject a variant, or null."""
        return once(self.seen(value), lambda s: self.judged(s, path))


def _of(seen: Column, kind: str) -> Column:
    return seen["k"] == kind


@dataclass(frozen=True)
class Text(Gate):
    longest: int = 300
    pattern: str | None = None
    values: Sequence[str] | None = None
    reads, plain = "string", True

    def tests(self, seen, path):
        text = seen["x"]
        out = [("type", ~_of(seen, "STRING")), ("length", F.length(text) > self.longest), ("control", text.rlike(CONTROL))]
        if self.pattern is not None:
            out.append(("pattern", ~text.rlike(self.pattern)))
        if self.values is not None:
            out.append(("enum", ~text.isin(*self.values) if self.values else F.lit(True)))
        return out


@dataclass(frozen=True)
class Number(Gate):
    low: float | None = None
    high: float | None = None
    whole: bool = False
    reads, plain = "double", True

    def tests(self, seen, path):
        x = seen["x"]
        out = [("type", ~(_of(seen, "BIGINT") | seen["k"].rlike("^(DECIMAL|DOUBLE|FLOAT)")))]
        if self.whole:
            out.append(("type", (x != F.floor(x)) | (F.abs(x) > SAFE)))
        if self.low is not None:
            out.append(("range", x < self.low))
        if self.high is not None:
            out.append(("range", x > self.high))
        return out


def whole(low: float = 0, high: float = SAFE, *, nullable: bool = False) -> Number:
    return Number(low, high, True, nullable=nullable)


@dataclass(frozen=True)
class Flag(Gate):
    plain = True

    def tests(self, seen, path):
        return [("type", ~_of(seen, "BOOLEAN"))]


@dataclass(frozen=True)
class Stamp(Gate):
    """An instant as text; may be null unless said otherwise."""

    nullable: bool = field(default=True, kw_only=True)
    reads, plain = "string", True

    def tests(self, seen, path):
        text = seen["x"]
        return [("type", ~_of(seen, "STRING")), ("length", F.length(text) > 40), ("time", F.try_to_timestamp(text).isNull())]


@dataclass(frozen=True)
class Exactly(Gate):
    """One of a few JSON values, given as their text without spaces."""

    texts: Sequence[str] = ()

    def tests(self, seen, path):
        return [("enum", ~F.to_json(seen["v"]).isin(*self.texts))]


@dataclass(frozen=True)
class Either(Gate):
    """The first gate if the value is a flag, else the second."""

    flag: Gate = field(default_factory=Flag)
    other: Gate = field(default_factory=whole)
    plain = True

    def tests(self, seen, path):
        return [(F.when(_of(seen, "BOOLEAN"), self.flag.reason(seen["v"], path)).otherwise(self.other.reason(seen["v"], path)), F.lit(True))]


@dataclass(frozen=True)
class Items(Gate):
    item: Gate = field(default_factory=Gate)
    most: int = 100
    least: int = 0
    unique: bool = False
    reads = "array<variant>"

    def tests(self, seen, path):
        items = seen["x"]
        none = F.struct(F.lit(0).alias("i"), F.lit(None).cast("string").alias("r"))
        at = lambda a: (*path, "[", a["i"].cast("string"), "]")
        found = F.aggregate(items, none, lambda a, x: F.struct((a["i"] + 1).alias("i"), F.coalesce(a["r"], self.item.reason(x, at(a))).alias("r")), lambda a: a["r"])
        out = [("type", items.isNull()), ("count", (F.size(items) > self.most) | (F.size(items) < self.least)), (found, F.lit(True))]
        if self.unique:
            texts = F.transform(items, lambda x: F.to_json(x))
            out.append(("repeated", F.size(F.array_distinct(texts)) < F.size(texts)))
        return out


@dataclass(frozen=True)
class Maybe(Gate):
    """A field that may be absent."""

    gate: Gate = field(default_factory=Gate)

    def seen(self, value):
        return self.gate.seen(value)


@dataclass(frozen=True)
class Absent(Gate):
    """A known field that must not be there."""


@dataclass(frozen=True)
class Object(Gate):
    """Known fields only, each by its gate in order; ``cases`` are gates of fields that hold only under a condition on the object;
    ``rules`` are conditions that must not be false, by name, over the object."""

    fields: Mapping[str, Gate] = field(default_factory=dict)
    cases: Sequence[tuple[Callable[[Fields], Column], Mapping[str, Gate]]] = ()
    rules: Sequence[tuple[str, Callable[[Fields], Column]]] = ()
    open: bool = False
    reads = "map<string,variant>"

    def tests(self, seen, path):
        every = seen["x"]
        out: list = [("not-an-object", every.isNull())]
        if not self.open:
            more = F.array_sort(F.array_except(F.map_keys(every), F.array(*[F.lit(n) for n in self.fields]).cast("array<string>")))
            out.append((_written("unknown:", *self._at(path, F.array_join(more, ","))), F.size(more) > 0))
        gates = [(None, n, g) for n, g in self.fields.items()] + [(holds, n, g) for holds, fields in self.cases for n, g in fields.items()]
        names = list(dict.fromkeys(n for _, n, _ in gates))
        taken = F.struct(F.lit(0).alias("_"), *[F.try_element_at(every, F.lit(n)).alias(f"f{k}") for k, n in enumerate(names)])
        look = lambda t: F.struct(t.alias("t"), *[g.seen(t[f"f{names.index(n)}"]).alias(f"s{k}") for k, (_, n, g) in enumerate(gates)])

        def first(s: Column) -> Column:
            of = Fields({n: s["t"][f"f{k}"] for k, n in enumerate(names)}, every)
            found = []
            for k, (holds, n, g) in enumerate(gates):
                reason = self._field(s[f"s{k}"], self._at(path, n), g)
                found.append(reason if holds is None else F.when(holds(of), reason))
            found += [F.when(~F.coalesce(rule(of), F.lit(True)), _written(f"{name}:", *path)) for name, rule in self.rules]
            return F.coalesce(*found, F.lit(None).cast("string"))

        return [*out, (once(taken, look, first), F.lit(True))]

    @staticmethod
    def _at(path: Path, name: Column | str) -> Path:
        return (*path, ".", name) if path else (name,)

    @staticmethod
    def _field(seen: Column, at: Path, gate: Gate) -> Column:
        if isinstance(gate, Absent):
            return F.when(seen["v"].isNotNull(), _written("not-enabled:", *at))
        if isinstance(gate, Maybe):
            return F.when(seen["v"].isNotNull(), gate.gate.judged(seen, at))
        return F.when(seen["v"].isNull(), _written("missing:", *at)).otherwise(gate.judged(seen, at))


def reject_reason(payload: Column, gate: Gate) -> Column:
    """The first reason to reject a JSON text, or null."""
    value = F.try_parse_json(payload)
    return F.when(value.isNull(), F.lit("not-json")).otherwise(gate.reason(value))


def gated(df: DataFrame, payload: str, gate: Gate) -> DataFrame:
    """df with ``reason``; the JSON is parsed once a row."""
    rows = df.withColumn("_value", F.try_parse_json(payload))
    return rows.withColumn("reason", F.when(F.col("_value").isNull(), F.lit("not-json")).otherwise(gate.reason(F.col("_value")))).drop("_value")


def canonical(payload: Column) -> Column:
    """JSON text with the keys of every object in order and without spaces; null if the text is no JSON."""
    return F.to_json(F.try_parse_json(payload))


# the gates; fixed values: the names, bounds and patterns of their fields

# What a report may call its phase, and the collections of a frame.
PHASES = ("starting", "cache-unpack", "build", "audit-setup", "audit-import", "audit-duplicates", "audit-axioms", "audit-module-system", "lint-env", "lint-style", "declaration-names", "stage-cache", "end", "unknown")
COLLECTIONS = ("batches", "inputs", "members", "attempts", "tasks", "events")
COUNT = whole(0, 10_000_000, nullable=True)


def number_of(value: Column | Fields, name: str) -> Column:
    return part(value, name, "double")


def text_of(value: Column | Fields, name: str) -> Column:
    return part(value, name, "string")


def progress_gate(schema: str, modules: str) -> Object:
    """Counters that a running job reports; ``modules`` is the pattern of a module's name."""
    done, total = (lambda v: number_of(v, "completed_tasks")), (lambda v: number_of(v, "total_tasks"))
    return Object(
        {
            "schema": Text(values=[schema]), "session": Text(pattern=UUID), "sequence": whole(1), "observed_at": Stamp(), "phase": Text(values=PHASES), "completed_modules": COUNT, "failed_modules": COUNT, "last_module": Text(pattern=modules, nullable=True),
            "last_progress_at": Stamp(), "active_compilers": COUNT, "cpu_seconds": Number(0, 1e12, nullable=True), "source_revision": Text(40, pattern="^$|" + SHA), "completed_tasks": Maybe(COUNT), "total_tasks": Maybe(COUNT), "tasks_per_minute": Maybe(Number(0, 1e7, nullable=True)),
        },
        rules=[("task-counter", lambda v: done(v).isNull() | F.coalesce(done(v) <= total(v), F.lit(False)))],
    )


def metadata_gate(schema: str, repositories: Sequence[str]) -> Object:
    """What closes a snapshot: scope, service, coverage, claims and workers."""
    order = Items(Text(pattern="^[a-z][a-z0-9_-]{0,59}$"), most=20, least=1, unique=True)
    config = Object({"repository": Text(values=repositories), "revision": Text(pattern=SHA), "namespace_build_cap": whole(0, 10_000), "pr_order": order, "staging_order": order}, nullable=True)
    setting, alias = Either(), "^queue-worker-[a-f0-9]{12}$"
    settings = ("repair_concurrency", "stall_interval_seconds", "open_batch_limit", "prepare_min_members", "prepare_quiet_seconds", "prepare_open_batches", "pre_rebase_enabled", "prepare_pre_rebased")
    worker = Object(
        {"id": Text(pattern=r"^(queue-worker-[a-f0-9]{12}|worker-[0-9]+)$"), "coverage": Text(values=["observed", "unavailable"]), "observed_at": Stamp(), **{n: Maybe(Gate(nullable=True)) for n in ("state", "started_at", "tasks", "errors")}},
        cases=[(lambda v: text_of(v, "coverage") == "observed", {"state": Text(40), "started_at": Stamp(), "tasks": whole(nullable=True), "errors": whole(nullable=True)})],
    )
    own = lambda v: part(v, "dispatch_config")
    inside = lambda v: F.array_contains(F.try_variant_get(part(v, "scope"), "$.repositories", "array<string>"), text_of(own(v), "repository"))
    return Object(
        {
            "schema": Text(values=[schema]), "coverage": Text(values=["observed", "partial", "unavailable"]), "observed_at": Stamp(), "status_observed_at": Stamp(), "source_revision": Text(40), "canonical_sha": Maybe(Text(pattern=SHA, nullable=True)),
            "truncated": Flag(), "event_history_truncated": Flag(), "claim_history_truncated": Flag(), "scope": Object({"repositories": Items(Text(values=repositories), most=50)}), "dispatch_config": Maybe(config),
            "service": Object({"revision": Text(40), "started_at": Text(40), "mode": Text(values=["production", "shadow", "unknown"]), "controller": Text(values=["running", "unavailable", "unknown"]), "publication_enabled": Flag(nullable=True)}),
            "collection_counts": Object({c: whole(0, 20_000) for c in COLLECTIONS}), "collection_complete": Object({c: Flag() for c in COLLECTIONS}), "retained_batch_ids": Items(Text(pattern=IDENTITY), most=20_000), "active_batch_ids": Items(Text(pattern=IDENTITY), most=128),
            "conditions": Items(Object({"kind": Text(80), "since": Maybe(Stamp()), "batch_id": Maybe(Text(pattern=IDENTITY)), "seconds": Maybe(Number(0, nullable=True))})),
            "outbox": Items(Object({"kind": Text(60), "state": Text(30), "count": whole()}), nullable=True), "settings": Object({**{n: Maybe(setting) for n in settings}, "sealed_successor_min_members": Maybe(whole())}),
            "claims": Items(Object({"batch_id": Text(pattern=IDENTITY), "task_id": Text(pattern=IDENTITY, nullable=True), "operation": Text(40), "worker": Text(pattern=alias), "created_at": Stamp(), "expires_at": Stamp()}), most=1000),
            "workers": Items(worker), "history": Absent(),
        },
        rules=[("config-scope", lambda v: own(v).isNull() | is_null(own(v)) | F.coalesce(inside(v), F.lit(False))), ("config-revision", lambda v: own(v).isNull() | is_null(own(v)) | text_of(own(v), "revision").eqNullSafe(text_of(v, "canonical_sha")))],
    )


def frame_gate(schema: str, metadata: Object, records: Mapping[str, Object]) -> Object:
    """A part of a snapshot: changes whose values pass their collection's gate and carry the change's id; the last part, and no
    other, brings the metadata."""
    place = {"epoch": whole(1), "sequence": whole(1)}
    there = lambda v: part(v, "value").isNotNull() & ~is_null(part(v, "value"))
    of = lambda c: lambda v: there(v) & (text_of(v, "collection") == c)
    change = Object(
        {"collection": Text(values=COLLECTIONS), "id": Text(pattern=IDENTITY), "value": Gate(nullable=True)}, cases=[(of(c), {"value": gate}) for c, gate in records.items()],
        rules=[("identity", lambda v: ~there(v) | text_of(v, "id").eqNullSafe(text_of(part(v, "value"), "id")))],
    )
    last = lambda v: number_of(v, "part") == number_of(v, "parts") - 1
    return Object(
        {"schema": Text(values=[schema]), "snapshot": Text(pattern=UUID), "base": Object(place, nullable=True), "source": Object({"id": Text(pattern=UUID), **place}), "parts": whole(1, 2000), "part": whole(0), "changes": Items(change, most=500), "metadata": Maybe(Gate(nullable=True))},
        cases=[(last, {"metadata": metadata}), (lambda v: ~last(v), {"metadata": Absent()})], rules=[("part", lambda v: number_of(v, "part") < number_of(v, "parts"))],
    )


def telemetry_gate() -> Object:
    """Phases of a run and the class of its failure; other fields are left alone."""
    phase = Object({"phase": Text(80), "seconds": Number(0, 7 * 86_400, nullable=True)}, open=True)
    return Object({"phases": Maybe(Items(phase, most=100, nullable=True)), "failure": Maybe(Text(61, pattern="^[a-z][a-z0-9-]{0,60}$", nullable=True))}, open=True)


def event_gate(repositories: Sequence[str], past: Sequence[str] = ()) -> Object:
    """A delivery: its repository is listed, or was once and the delivery is historical; run and jobs have numbers and times; a
    sampling belongs to historical ones only. Other fields are left alone."""
    old = lambda v: F.coalesce(part(v, "historical", "boolean"), F.lit(False))
    run = lambda v: part(v, "run")
    first = lambda v: F.get(part(v, "jobs", "array<variant>"), F.lit(0))
    number = lambda *found: F.coalesce(*found)
    run_id = lambda v: number(text_of(run(v), "id"), text_of(run(v), "run_id"), text_of(v, "run_id"), text_of(first(v), "run_id"))
    job = Object({"created_at": Stamp(nullable=False)}, open=True, rules=[("job-id", lambda v: F.coalesce(number(text_of(v, "id"), text_of(v, "job_id")).rlike("^[0-9]+$"), F.lit(False)))])

    def sampled(v: Fields) -> Column:
        sampling = part(run(v), "archive_sampling")
        fine = old(v) & number_of(sampling, "until").isNotNull() & (number_of(sampling, "weight") >= 0)
        return sampling.isNull() | is_null(sampling) | F.coalesce(fine, F.lit(False))

    named = lambda v: F.coalesce(text_of(v, "repo").isin(*repositories) | (old(v) & text_of(v, "repo").isin(*past) if past else F.lit(False)), F.lit(False))
    return Object(
        {"delivery": Text(300), "run": Maybe(Object({"created_at": Stamp(nullable=False)}, open=True, nullable=True)), "jobs": Maybe(Items(job, most=100, nullable=True)), "telemetry": Maybe(Object(telemetry_gate().fields, open=True, nullable=True))},
        rules=[("repository", named), ("run-id", lambda v: F.coalesce(run_id(v).rlike("^[0-9]+$"), F.lit(True))), ("sampling", sampled)], open=True,
    )


# The public names of a history window's measures and of its distributions.
MEASURES = (
    "landed_heads", "landed_prs", "landed_prs_per_hour", "landed_membership_occurrences", "nonempty_unique_prs_per_hour", "nonempty_unique_prs", "empty_member_occurrences", "already_landed_empty_occurrences", "emptiness_unknown", "baseline_ratio", "ci_attempts", "singleton_runs",
    "failed_rounds_per_large_landing", "claim_collisions", "claim_expiries", "opt_outs", "anticipated_withdrawals", "needs_rebase", "readmissions", "edit_summaries", "shrink_to_empty", "inference_hold_minutes",
)
DISTRIBUTIONS = ("head_dispatch_minutes", "head_seal_minutes", "repair_task_minutes", "approval_to_insertion_minutes", "currently_waiting_age_minutes")
HEAD_MEASURES = ("size", "ci_rounds", "source_failure_rounds", "first_dispatch_to_landing_minutes", "seal_to_landing_minutes", "ci_observed_minutes", "claimed_task_minutes", "ci_task_overlap_minutes", "other_or_unobserved_minutes")
BASELINE = ("hours", "landed_prs", "landed_prs_per_hour", "singleton_runs", "failed_rounds_per_large_landing")


def registry_of(rows: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """(machine id, alias) of the hosts that may be shown: at most 100, each id and each alias once. Raises otherwise."""
    if len(rows) > 100:
        raise ValueError("more than 100 hosts")
    for n, kind, pattern in ((0, "machine id", "[a-f0-9]{32}"), (1, "alias", "[A-Za-z0-9_.-]{1,60}")):
        found = [r[n] for r in rows]
        if bad := [x for x in found if not re.fullmatch(pattern, x)]:
            raise ValueError(f"no {kind}: {bad[0]}")
        if len(set(found)) < len(found):
            raise ValueError(f"repeated {kind}")
    return list(rows)


def hosts_gate(schema: str, registry: Sequence[tuple[str, str]]) -> Object:
    """A sample of all public hosts, each of them once: resources, slots and workers, with bounded lists and numbers."""
    some, flag, stamp = Number(0, 1e18, nullable=True), Flag(), Stamp()
    known = [f"{machine} {alias}" for machine, alias in registry_of(registry)]
    numbers = lambda *names: {n: some for n in names}
    slot_compiler = Object({"observed_at": stamp, **numbers("waiting_now", "running_now", "completed", "oldest_wait", "wait_seconds", "run_seconds", "lost")}, nullable=True)
    slot = Object({
        "slot": some, "instance_id": Text(pattern="^[a-f0-9]{16}$", nullable=True), "runner_id": Text(pattern=IDENTITY, nullable=True), "runner_name": Text(100), "phase": Text(40), "busy": flag, "started_at": stamp, "vcpus": some, "memory_gib": some, "compiler": Maybe(slot_compiler),
    })
    memory = {n: Maybe(some) for n in ("working_set", "charged", "maximum", "high", "swap", "oom_kill", "stall_some", "stall_full")}
    admission = Object({"state": Text(values=["at_ceiling", "paused", "unknown"]), "reason": Text(values=["at_ceiling", "memory_reserve", "zero_ceiling", "disabled_or_draining", "unknown"])})
    running = Object({n: Maybe(whole(nullable=True)) for n in ("github", "namespace", "self-hosted")})
    capacity = Object({"observed_at": stamp, "scope": Text(values=["organization_all_workflow_jobs"]), "coverage": Text(values=["observed", "unavailable"]), "observer_error": flag, "running_jobs": running})
    host = Object(
        {
            "machine_id": Text(), "alias": Text(), "observed_at": stamp, "transport_at": stamp, "source_revision": Text(64, pattern="^$|^[a-f0-9]{40,64}$"), "coverage": Text(values=["observed", "unavailable"]), **{n: flag for n in ("connected", "controller_error", "slots_truncated", "workers_truncated")},
            **{n: Flag(nullable=True) for n in ("ci_enabled", "workers_enabled", "memory_pressure")}, "worker_memory": Maybe(Object(memory)), "worker_admission": Maybe(admission), "ci_cooldown": Maybe(Object({"until": stamp}, nullable=True)), "capacity_context": Maybe(capacity),
            "admission": Maybe(Object({"ci_kinds": Exactly(['["pr"]', '["staging"]', '["pr","staging"]'], nullable=True), **numbers("staging_slots", "memory_budget_gib"), "reservation_error": flag})),
            "activity": Maybe(Object({"observed_at": stamp, "window_hours": Number(24, 24), **numbers("finished_rounds", "failed_rounds", "unknown_rounds")})), **numbers("ci_max_jobs", "worker_limit", "cpu_idle_fraction"), "resources": Object(numbers("cpus", "memory_total", "memory_available")),
            "compiler": Object({"observed_at": stamp, **numbers("waiting_guests", "guests"), "healthy": flag}), "slots": Items(slot, most=128), "workers": Items(Object({"id": Text(100), "state": Text(40), "alive": flag, "observed_at": stamp}), most=128),
        },
        rules=[("not-public", lambda v: F.coalesce(F.concat_ws(" ", text_of(v, "machine_id"), text_of(v, "alias")).isin(*known) if known else F.lit(False), F.lit(False)))],
    )
    ids = lambda v: part(v, "hosts", "array<struct<machine_id:string>>")["machine_id"]
    return Object(
        {"schema": Text(values=[schema]), "source": Object({"id": Text(pattern=UUID), "epoch": whole(1), "sequence": whole(1)}), "observed_at": stamp, "hosts": Items(host, most=128)},
        rules=[("repeated-host", lambda v: F.size(F.array_distinct(ids(v))) == F.size(ids(v))), ("registry-coverage", lambda v: F.size(ids(v)) == len(known))],
    )


def history_gate(schema: str, repositories: Sequence[str]) -> Object:
    """Measures of up to three windows against a baseline, with the heads that landed in each."""
    some, at, flag = Number(0, nullable=True), Stamp(nullable=False), Flag()
    batch = Text(pattern=IDENTITY)
    scenario = Object({"status": Text(values=["timing_met_verification_required", "not_met_in_observed_data", "not_observed"]), "eligible_count": some, "qualifying_count": some, "qualifying_batches": Items(batch, most=100)})
    week = Object({"status": Text(values=["not_yet_observable", "requires_attribution_and_comment_audit"]), "observed_days": some, "rate_above_baseline": flag})
    spread = Object({n: Maybe(some) for n in ("count", "min", "median", "p95", "max")})
    cost = Object({"coverage": Text(values=["recorded_subtotal_only"]), "recorded_usd": some, "recorded_attempts": some, "unknown_attempts": some})
    window = Object({
        "key": Text(values=["24h", "7d", "pilot"]), "label": Text(40), "from": at, "until": at, "hours": some, "criteria": Maybe(Object({"scenario": scenario, "week": week})), "summary": Object({**{n: some for n in MEASURES}, **{n: spread for n in DISTRIBUTIONS}, "cost": cost}),
        "heads": Items(Object({"batch_id": batch, **{n: Maybe(some) for n in HEAD_MEASURES}}), most=500), "heads_truncated": flag,
    })
    return Object({
        "schema": Text(values=[schema]), "coverage": Text(values=["observed"]), "observed_at": at, "scope": Object({"repositories": Items(Text(values=repositories), most=SAFE)}), "windows": Items(window, most=3),
        "baseline": Object({n: Maybe(some) for n in BASELINE}), "limits": Items(Text(), most=10),
    })
