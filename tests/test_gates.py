"""Every reason of the gates has a payload that gets it, and no other."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from chronotally.operators import gates as G

U, H = "01234567-89ab-cdef-0123-456789abcdef", "a" * 40
PROGRESS = {"schema": "p/v1", "session": U, "sequence": 3, "observed_at": "2026-10-04T01:00:00Z", "phase": "build", "completed_modules": 5, "failed_modules": None, "last_module": "Lib.Algebra", "last_progress_at": None, "active_compilers": 2, "cpu_seconds": 1.5, "source_revision": H, "completed_tasks": 3, "total_tasks": 4, "tasks_per_minute": 0.5}
META = {
    "schema": "q/v1", "coverage": "observed", "observed_at": "2026-10-04T01:00:00Z", "status_observed_at": None, "source_revision": "r1", "canonical_sha": H, "truncated": False, "event_history_truncated": False, "claim_history_truncated": True, "scope": {"repositories": ["o/a"]},
    "dispatch_config": {"repository": "o/a", "revision": H, "namespace_build_cap": 4, "pr_order": ["github"], "staging_order": ["a", "b"]}, "service": {"revision": "x", "started_at": "", "mode": "shadow", "controller": "running", "publication_enabled": None},
    "collection_counts": {c: 1 for c in G.COLLECTIONS}, "collection_complete": {c: True for c in G.COLLECTIONS}, "retained_batch_ids": ["1", "22"], "active_batch_ids": [], "conditions": [{"kind": "stall", "since": None, "batch_id": "4", "seconds": 2.5}], "outbox": [{"kind": "k", "state": "s", "count": 0}],
    "settings": {"open_batch_limit": 3, "pre_rebase_enabled": True, "sealed_successor_min_members": 2}, "claims": [{"batch_id": "1", "task_id": None, "operation": "op", "worker": "queue-worker-0123456789ab", "created_at": None, "expires_at": "2026-10-04T01:00:00Z"}],
    "workers": [{"id": "worker-1", "coverage": "unavailable", "observed_at": None}, {"id": "queue-worker-0123456789ab", "coverage": "observed", "observed_at": None, "state": "busy", "started_at": None, "tasks": 1, "errors": None}],
}
EVENT = G.Object({"id": G.Text(pattern=G.IDENTITY), "at": G.Stamp(), "kind": G.Text(), "batch_id": G.Text(pattern=G.IDENTITY)})
FRAME = {"schema": "f/v1", "snapshot": U, "base": None, "source": {"id": U, "epoch": 1, "sequence": 2}, "parts": 2, "part": 0, "changes": [{"collection": "events", "id": "7", "value": {"id": "7", "at": None, "kind": "x", "batch_id": "1"}}, {"collection": "tasks", "id": "8", "value": None}]}


def changed(base, path, value):
    """base with the value at a path of keys; ... takes the key away."""
    out = copy.deepcopy(base)
    at = out
    for p in path[:-1]:
        at = at[p]
    if value is ...:
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return out


def reasons(spark, gate, payloads):
    df = spark.createDataFrame([(i, p if isinstance(p, str) or p is None else json.dumps(p)) for i, p in enumerate(payloads)], "i int, p string")
    return [r["reason"] for r in G.gated(df, "p", gate).orderBy("i").collect()]


def check(spark, gate, base, cases):
    got = reasons(spark, gate, [base] + [changed(base, p, v) for p, v, _ in cases])
    assert got[0] is None
    wrong = [(p, v, want, g) for (p, v, want), g in zip(cases, got[1:], strict=True) if g != want]
    assert not wrong, wrong


def test_progress_reports(spark):
    cases = [
        (["schema"], "p/v2", "enum:schema"), (["session"], "x", "pattern:session"), (["sequence"], 0, "range:sequence"), (["sequence"], 1.5, "type:sequence"), (["sequence"], "1", "type:sequence"), (["sequence"], 2**60, "type:sequence"), (["sequence"], 2.0, None), (["observed_at"], "soon", "time:observed_at"), (["observed_at"], "x" * 41, "length:observed_at"), (["observed_at"], 5, "type:observed_at"),
        (["phase"], "rest", "enum:phase"), (["completed_modules"], 10_000_001, "range:completed_modules"), (["failed_modules"], -1, "range:failed_modules"), (["active_compilers"], ..., "missing:active_compilers"), (["cpu_seconds"], 1e13, "range:cpu_seconds"), (["cpu_seconds"], "1", "type:cpu_seconds"), (["cpu_seconds"], None, None), (["last_module"], "Other.Thing", "pattern:last_module"), (["last_module"], None, None),
        (["source_revision"], "abc", "pattern:source_revision"), (["source_revision"], "", None), (["source_revision"], None, "null:source_revision"), (["completed_tasks"], 5, "task-counter:"), (["total_tasks"], None, "task-counter:"), (["total_tasks"], ..., "task-counter:"), (["completed_tasks"], ..., None), (["tasks_per_minute"], -1, "range:tasks_per_minute"), (["tasks_per_minute"], ..., None), (["extra"], 1, "unknown:extra"),
    ]
    check(spark, G.progress_gate("p/v1", r"^Lib(\.[A-Za-z0-9_']+){0,30}$"), PROGRESS, cases)
    assert reasons(spark, G.progress_gate("p/v1", "^Lib"), ["nope", None, "[1]", '"x"', "null", '{"schema":1,"schema":2}']) == ["not-json", "not-json", "not-an-object:", "not-an-object:", "null:", "not-json"]


METADATA = [
    (["schema"], "x", "enum:schema"), (["coverage"], "some", "enum:coverage"), (["observed_at"], "?", "time:observed_at"), (["source_revision"], "x" * 41, "length:source_revision"), (["source_revision"], "a\u0001", "control:source_revision"), (["canonical_sha"], "b", "pattern:canonical_sha"), (["truncated"], 1, "type:truncated"), (["scope"], [], "not-an-object:scope"),
    (["scope", "repositories"], ["o/b"], "enum:scope.repositories[0]"), (["scope", "repositories"], ["o/a"] * 51, "count:scope.repositories"), (["scope", "more"], 1, "unknown:scope.more"), (["scope", "repositories"], [], "config-scope:"), (["dispatch_config"], None, None), (["dispatch_config"], ..., None), (["dispatch_config", "revision"], "b" * 40, "config-revision:"), (["canonical_sha"], None, "config-revision:"),
    (["dispatch_config", "namespace_build_cap"], 10_001, "range:dispatch_config.namespace_build_cap"), (["dispatch_config", "pr_order"], [], "count:dispatch_config.pr_order"), (["dispatch_config", "pr_order"], ["a", "a"], "repeated:dispatch_config.pr_order"), (["dispatch_config", "staging_order"], ["A"], "pattern:dispatch_config.staging_order[0]"), (["service", "mode"], "live", "enum:service.mode"), (["service", "controller"], ..., "missing:service.controller"),
    (["service", "publication_enabled"], "yes", "type:service.publication_enabled"), (["collection_counts", "tasks"], 20_001, "range:collection_counts.tasks"), (["collection_complete", "events"], None, "null:collection_complete.events"), (["retained_batch_ids"], ["1", "x"], "pattern:retained_batch_ids[1]"), (["active_batch_ids"], ["1"] * 129, "count:active_batch_ids"), (["conditions", 0, "seconds"], -1, "range:conditions[0].seconds"), (["conditions", 0, "seconds"], None, None),
    (["conditions", 0, "batch_id"], None, "null:conditions[0].batch_id"), (["outbox"], None, None), (["outbox", 0, "count"], -1, "range:outbox[0].count"), (["outbox", 0, "other"], 1, "unknown:outbox[0].other"), (["settings", "open_batch_limit"], False, None), (["settings", "open_batch_limit"], "3", "type:settings.open_batch_limit"), (["settings", "sealed_successor_min_members"], True, "type:settings.sealed_successor_min_members"), (["claims", 0, "worker"], "me", "pattern:claims[0].worker"),
    (["claims", 0, "task_id"], "x", "pattern:claims[0].task_id"), (["workers", 0, "id"], "w", "pattern:workers[0].id"), (["workers", 1, "coverage"], "seen", "enum:workers[1].coverage"), (["workers", 1, "state"], ..., "missing:workers[1].state"), (["workers", 1, "tasks"], -1, "range:workers[1].tasks"), (["workers", 0, "tasks"], -1, None), (["history"], {}, "not-enabled:history"),
]


def test_metadata(spark):
    check(spark, G.metadata_gate("q/v1", ["o/a", "o/c"]), META, METADATA)


def test_frames(spark):
    gate = G.frame_gate("f/v1", G.metadata_gate("q/v1", ["o/a"]), {"events": EVENT})
    cases = [
        (["schema"], "x", "enum:schema"), (["snapshot"], "x", "pattern:snapshot"), (["base"], {"epoch": 1, "sequence": 1}, None), (["base"], {"epoch": 0, "sequence": 1}, "range:base.epoch"), (["base"], ..., "missing:base"), (["source", "id"], "x", "pattern:source.id"), (["source", "sequence"], 0, "range:source.sequence"), (["parts"], 2001, "range:parts"), (["part"], 5, "part:"), (["part"], -1, "range:part"),
        (["changes"], [None] * 501, "count:changes"), (["changes", 0, "collection"], "x", "enum:changes[0].collection"), (["changes", 1, "id"], "x", "pattern:changes[1].id"), (["changes", 0, "value", "id"], "9", "identity:changes[0]"), (["changes", 0, "value", "kind"], 1, "type:changes[0].value.kind"), (["changes", 0, "value", "more"], 1, "unknown:changes[0].value.more"), (["changes", 0, "value"], None, None), (["metadata"], META, "not-enabled:metadata"), (["part"], 1, "missing:metadata"),
    ]
    check(spark, gate, FRAME, cases)
    last = changed(changed(FRAME, ["part"], 1), ["metadata"], META)
    check(spark, gate, last, [(["metadata", "coverage"], "x", "enum:metadata.coverage"), (["metadata", "workers", 1, "tasks"], -1, "range:metadata.workers[1].tasks")])


def test_telemetry(spark):
    base = {"phases": [{"phase": "build", "seconds": 5}, {"phase": "x", "seconds": None, "more": 1}], "failure": "lean-error", "other": {}}
    cases = [
        (["phases", 1, "phase"], 5, "type:phases[1].phase"), (["phases", 0, "phase"], "x" * 81, "length:phases[0].phase"), (["phases", 0, "seconds"], -1, "range:phases[0].seconds"), (["phases", 0, "seconds"], 604_801, "range:phases[0].seconds"), (["phases", 0, "seconds"], ..., "missing:phases[0].seconds"),
        (["phases"], [{"phase": "a", "seconds": 1}] * 101, "count:phases"), (["phases"], {}, "type:phases"), (["phases"], None, None), (["phases"], ..., None), (["failure"], "Bad", "pattern:failure"), (["failure"], None, None), (["failure"], ..., None),
    ]
    check(spark, G.telemetry_gate(), base, cases)


def test_events(spark):
    at = "2026-10-04T01:00:00Z"
    base = {"repo": "o/a", "delivery": "d1", "run": {"id": 5, "created_at": at}, "jobs": [{"id": "7", "created_at": at}, {"job_id": 8, "created_at": at}], "telemetry": {"phases": []}, "else": 1}
    old = {"until": 5, "weight": 0.5}
    cases = [
        (["repo"], "o/b", "repository:"), (["repo"], "o/old", "repository:"), (["repo"], ..., "repository:"), (["delivery"], ..., "missing:delivery"), (["delivery"], "x" * 301, "length:delivery"), (["run", "id"], "x5", "run-id:"), (["run", "id"], None, None), (["run"], None, None), (["run", "created_at"], "soon", "time:run.created_at"), (["run", "created_at"], None, "null:run.created_at"),
        (["run", "archive_sampling"], old, "sampling:"), (["jobs"], {}, "type:jobs"), (["jobs"], [{"id": 1, "created_at": at}] * 101, "count:jobs"), (["jobs", 0, "id"], "a", "job-id:jobs[0]"), (["jobs", 1, "job_id"], ..., "job-id:jobs[1]"), (["jobs", 1, "created_at"], ..., "missing:jobs[1].created_at"), (["telemetry", "phases"], [{}], "missing:telemetry.phases[0].phase"), (["telemetry"], None, None), (["jobs"], ..., None),
    ]
    check(spark, G.event_gate(["o/a"], ["o/old"]), base, cases)
    late = changed(changed(changed(base, ["repo"], "o/old"), ["historical"], True), ["run", "archive_sampling"], old)
    check(spark, G.event_gate(["o/a"], ["o/old"]), late, [(["historical"], False, "repository:"), (["run", "archive_sampling", "weight"], -1, "sampling:"), (["run", "archive_sampling", "until"], ..., "sampling:"), (["run", "archive_sampling"], None, None)])
    no_run = {"repo": "o/a", "delivery": "d", "jobs": [{"id": 1, "run_id": "r", "created_at": at}]}
    check(spark, G.event_gate(["o/a"]), changed(no_run, ["jobs", 0, "run_id"], "3"), [(["jobs", 0, "run_id"], "r", "run-id:"), (["run_id"], "9", None), (["run_id"], "q", "run-id:")])


HOST = {
    "machine_id": "a" * 32, "alias": "h1", "observed_at": None, "transport_at": "2026-10-04T01:00:00Z", "connected": True, "coverage": "observed", "source_revision": "", "controller_error": False, "ci_enabled": None, "workers_enabled": True, "ci_max_jobs": 4, "worker_limit": None, "resources": {"cpus": 8, "memory_total": 1, "memory_available": None},
    "cpu_idle_fraction": 0.5, "memory_pressure": False, "compiler": {"observed_at": None, "waiting_guests": 0, "guests": 1, "healthy": True}, "slots_truncated": False, "workers_truncated": False, "workers": [{"id": "w", "state": "idle", "alive": True, "observed_at": None}],
    "slots": [{"slot": 1, "instance_id": "0" * 16, "runner_id": "12", "runner_name": "r", "phase": "busy", "busy": True, "started_at": None, "vcpus": 4, "memory_gib": 16, "compiler": {"observed_at": None, "waiting_now": 0, "running_now": 1, "completed": 2, "oldest_wait": None, "wait_seconds": 0, "run_seconds": 1, "lost": 0}}],
    "admission": {"ci_kinds": ["pr", "staging"], "staging_slots": 1, "memory_budget_gib": None, "reservation_error": False}, "activity": {"observed_at": None, "window_hours": 24, "finished_rounds": 1, "failed_rounds": 0, "unknown_rounds": None}, "worker_memory": {"high": 5}, "worker_admission": {"state": "paused", "reason": "unknown"},
    "ci_cooldown": {"until": None}, "capacity_context": {"observed_at": None, "scope": "organization_all_workflow_jobs", "coverage": "observed", "observer_error": False, "running_jobs": {"github": 3, "self-hosted": None}},
}
PLAIN = {k: v for k, v in copy.deepcopy(HOST).items() if k not in ("admission", "activity", "worker_memory", "worker_admission", "ci_cooldown", "capacity_context")} | {"machine_id": "b" * 32, "alias": "h2"}
HOSTS = {"schema": "h/v1", "source": {"id": U, "epoch": 1, "sequence": 2}, "observed_at": None, "hosts": [HOST, PLAIN]}


def test_hosts(spark):
    of = lambda *path: ["hosts", 0, *path]
    cases = [
        (["schema"], "x", "enum:schema"), (["source", "epoch"], 0, "range:source.epoch"), (["observed_at"], "soon", "time:observed_at"), (["hosts"], {}, "type:hosts"), (["hosts"], [HOST], "registry-coverage:"), (["hosts"], [HOST, HOST], "repeated-host:"), (["hosts"], [], "registry-coverage:"), (["hosts"], [HOST] * 129, "count:hosts"),
        (of("alias"), "h2", "not-public:hosts[0]"), (of("machine_id"), ..., "missing:hosts[0].machine_id"), (of("more"), 1, "unknown:hosts[0].more"), (of("transport_at"), 5, "type:hosts[0].transport_at"), (of("source_revision"), "abc", "pattern:hosts[0].source_revision"), (of("source_revision"), "a" * 64, None), (of("coverage"), "some", "enum:hosts[0].coverage"),
        (of("connected"), None, "null:hosts[0].connected"), (of("memory_pressure"), None, None), (of("memory_pressure"), 1, "type:hosts[0].memory_pressure"), (of("worker_memory", "swap"), -1, "range:hosts[0].worker_memory.swap"), (of("worker_memory", "x"), 1, "unknown:hosts[0].worker_memory.x"), (of("worker_memory"), None, "null:hosts[0].worker_memory"), (of("worker_memory"), ..., None),
        (of("worker_admission", "state"), "on", "enum:hosts[0].worker_admission.state"), (of("worker_admission", "reason"), ..., "missing:hosts[0].worker_admission.reason"), (of("ci_cooldown"), None, None), (of("ci_cooldown", "until"), "?", "time:hosts[0].ci_cooldown.until"), (of("capacity_context", "scope"), "x", "enum:hosts[0].capacity_context.scope"),
        (of("capacity_context", "running_jobs", "github"), 1.5, "type:hosts[0].capacity_context.running_jobs.github"), (of("capacity_context", "observer_error"), None, "null:hosts[0].capacity_context.observer_error"), (of("admission", "ci_kinds"), ["staging", "pr"], "enum:hosts[0].admission.ci_kinds"), (of("admission", "ci_kinds"), None, None),
        (of("admission", "staging_slots"), -1, "range:hosts[0].admission.staging_slots"), (of("activity", "window_hours"), 12, "range:hosts[0].activity.window_hours"), (of("activity", "failed_rounds"), "1", "type:hosts[0].activity.failed_rounds"), (of("ci_max_jobs"), 2e18, "range:hosts[0].ci_max_jobs"), (of("resources", "cpus"), ..., "missing:hosts[0].resources.cpus"),
        (of("compiler", "healthy"), None, "null:hosts[0].compiler.healthy"), (of("slots"), None, "null:hosts[0].slots"), (of("slots", 0, "instance_id"), "x", "pattern:hosts[0].slots[0].instance_id"), (of("slots", 0, "runner_id"), 12, "type:hosts[0].slots[0].runner_id"), (of("slots", 0, "runner_id"), None, None), (of("slots", 0, "compiler"), None, None),
        (of("slots", 0, "compiler", "lost"), ..., "missing:hosts[0].slots[0].compiler.lost"), (of("slots", 0, "runner_name"), "x" * 101, "length:hosts[0].slots[0].runner_name"), (of("workers"), [PLAIN["workers"][0]] * 129, "count:hosts[0].workers"), (of("workers", 0, "alive"), "yes", "type:hosts[0].workers[0].alive"), (["hosts", 1, "slots", 0, "busy"], None, "null:hosts[1].slots[0].busy"),
    ]
    check(spark, G.hosts_gate("h/v1", [("a" * 32, "h1"), ("b" * 32, "h2")]), HOSTS, cases)


@pytest.mark.parametrize("rows", [[("A" * 32, "h")], [("a" * 32, "h h")], [("a" * 32, "")], [("a" * 32, "h"), ("a" * 32, "i")], [("a" * 32, "h"), ("b" * 32, "h")], [(f"{k:032x}", f"h{k}") for k in range(101)]])
def test_registry_is_checked(rows):
    with pytest.raises(ValueError):
        G.registry_of(rows)


def test_history(spark):
    at = "2026-10-04T01:00:00Z"
    spread = {"count": 1, "min": None, "p95": 2.5}
    summary = {n: 1 for n in G.MEASURES} | {n: dict(spread) for n in G.DISTRIBUTIONS} | {"cost": {"coverage": "recorded_subtotal_only", "recorded_usd": 1.5, "recorded_attempts": 2, "unknown_attempts": None}}
    criteria = {"scenario": {"status": "not_observed", "eligible_count": 0, "qualifying_count": None, "qualifying_batches": ["1"]}, "week": {"status": "not_yet_observable", "observed_days": 2, "rate_above_baseline": False}}
    window = {"key": "24h", "label": "day", "from": at, "until": at, "hours": 24, "criteria": criteria, "summary": summary, "heads": [{"batch_id": "5", "size": 3, "ci_rounds": None}], "heads_truncated": False}
    base = {"schema": "y/v1", "coverage": "observed", "observed_at": at, "scope": {"repositories": ["o/a"]}, "windows": [window], "baseline": {"hours": 5, "landed_prs": None}, "limits": ["one"]}
    of = lambda *path: ["windows", 0, *path]
    cases = [
        (["schema"], "x", "enum:schema"), (["coverage"], "partial", "enum:coverage"), (["observed_at"], None, "null:observed_at"), (["scope", "repositories"], ["o/b"], "enum:scope.repositories[0]"), (["scope", "repositories"], None, "null:scope.repositories"), (["windows"], [window] * 4, "count:windows"), (["windows"], [], None), (of("key"), "1h", "enum:windows[0].key"),
        (of("label"), "x" * 41, "length:windows[0].label"), (of("from"), "then", "time:windows[0].from"), (of("until"), ..., "missing:windows[0].until"), (of("hours"), -1, "range:windows[0].hours"), (of("hours"), None, None), (of("criteria"), ..., None), (of("criteria"), None, "null:windows[0].criteria"), (of("criteria", "scenario", "status"), "met", "enum:windows[0].criteria.scenario.status"),
        (of("criteria", "scenario", "qualifying_batches"), ["x"], "pattern:windows[0].criteria.scenario.qualifying_batches[0]"), (of("criteria", "scenario", "qualifying_batches"), ["1"] * 101, "count:windows[0].criteria.scenario.qualifying_batches"), (of("criteria", "week", "rate_above_baseline"), None, "null:windows[0].criteria.week.rate_above_baseline"),
        (of("summary", "opt_outs"), ..., "missing:windows[0].summary.opt_outs"), (of("summary", "opt_outs"), "1", "type:windows[0].summary.opt_outs"), (of("summary", "head_seal_minutes", "max"), -1, "range:windows[0].summary.head_seal_minutes.max"), (of("summary", "head_seal_minutes", "mean"), 1, "unknown:windows[0].summary.head_seal_minutes.mean"),
        (of("summary", "cost", "coverage"), "all", "enum:windows[0].summary.cost.coverage"), (of("summary", "cost", "recorded_usd"), ..., "missing:windows[0].summary.cost.recorded_usd"), (of("heads"), [{"batch_id": "1"}] * 501, "count:windows[0].heads"), (of("heads", 0, "batch_id"), 5, "type:windows[0].heads[0].batch_id"), (of("heads", 0, "size"), -1, "range:windows[0].heads[0].size"),
        (of("heads_truncated"), 0, "type:windows[0].heads_truncated"), (["baseline", "hours"], -1, "range:baseline.hours"), (["baseline", "more"], 1, "unknown:baseline.more"), (["limits"], ["x"] * 11, "count:limits"), (["limits"], ["x" * 301], "length:limits[0]"), (["limits"], [1], "type:limits[0]"),
    ]
    check(spark, G.history_gate("y/v1", ["o/a"]), base, cases)


def test_canonical_text_sorts_keys_at_every_depth(spark):
    rows = [('{"b":{"z":1,"a":[2,{"y":null,"x":"é"}]},"a":true}', '{"a":true,"b":{"a":[2,{"x":"é","y":null}],"z":1}}'), ('{ "a" : true , "b":{"a":[2,{"x":"é","y":null}],"z":1}}', '{"a":true,"b":{"a":[2,{"x":"é","y":null}],"z":1}}'), ("[1, 2]", "[1,2]"), ("x", None), (None, None)]
    got = spark.createDataFrame(rows, "p string, want string").withColumn("got", G.canonical(F.col("p"))).collect()
    assert [r["got"] for r in got] == [w for _, w in rows]


def test_an_item_behind_the_first_bad_one_is_not_judged_and_types_are_not_derived_for_every_row(spark):
    """Paths are constants and counters, so that a reason's expression grows with its gate and not with the powers of its depth."""
    deep = G.Object({"a": G.Text()})
    sizes = []
    for _ in range(5):
        deep = G.Object({"a": G.Items(deep), "b": G.whole()})
        df = G.gated(spark.range(1).selectExpr("'{}' as p"), "p", deep)
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert "filter(" not in text
        sizes.append(len(text))
    assert sizes[4] - sizes[3] < 1.5 * (sizes[2] - sizes[1])
    bad = {"a": [{"a": [{"a": [], "b": "x"}, {"a": [], "b": -1}], "b": 1}], "b": "y"}
    assert reasons(spark, G.Object({"a": G.Items(G.Object({"a": G.Items(G.Object({"a": G.Items(), "b": G.whole()})), "b": G.whole()})), "b": G.whole()}), [bad]) == ["type:a[0].a[0].b"]
