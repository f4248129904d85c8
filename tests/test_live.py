"""Normalised runs and jobs, and what a job contributes, against golden rows and a plain version."""

import collections
import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from chronotally.functions import columns as C
from chronotally.operators import live as L

T = int(datetime.datetime(2026, 10, 18, 12, tzinfo=datetime.timezone.utc).timestamp())
WORK = """id long, trigger string, workflow string, run_status string, run_updated double, sampling struct<until:double,weight:double>, phases array<struct<phase:string,seconds:double>>, run_failure string,
    name string, kind string, conclusion string, created double, started double, completed double, assigned boolean, estimated boolean, weight double, failure string, steps array<struct<name:string,started:double,completed:double,conclusion:string>>"""
FIELDS = [f.strip().split(" ")[0] for f in WORK.replace("until:double,weight", "until;weight").replace("phase:string,seconds", "phase;seconds").replace("name:string,started:double,completed:double,conclusion", "x").replace("\n", " ").split(",")]


def job(i=1, **other):
    base = dict(id=i, trigger="pr", workflow=L.Names.workflow, run_status="completed", run_updated=T + 300.0, sampling=None, phases=None, run_failure=None, name="sandboxed-build", kind="self-hosted", conclusion="success",
                created=float(T), started=T + 60.0, completed=T + 300.0, assigned=True, estimated=False, weight=1.0, failure=None, steps=None)
    return base | other


def table(spark, jobs):
    return spark.createDataFrame([tuple(j[f] for f in FIELDS) for j in jobs], WORK)


def summed(rows):
    out = collections.defaultdict(float)
    for r in rows:
        out[r["metric"], r["bucket"], r["value"]] += r["amount"]
    return out


def test_golden_pair_of_jobs(spark):
    """A pull request's job and a staging job on an own machine."""
    got = summed(L.job_contributions(table(spark, [job(1), job(2, trigger="bors_staging")]), T + 600).collect())
    for metric, value, amount in (("merge/success", 0, 1), ("duration/merge", 4, 1), ("wait/merge", 1, 1), ("duration/self-hosted", 4, 1), ("pr-total", 0, 1), ("picker/self-hosted", 0, 1), ("minutes/self-hosted", 0, 8)):
        assert got[metric, 0, value] == pytest.approx(amount), metric
    assert got["fleet/600/running/self-hosted", T, 0] == pytest.approx(0.8) and got["fleet/600/wait/build", T, 1] == 2
    peaks = L.queue_peaks(L.job_contributions(table(spark, [job(1), job(2, trigger="bors_staging")]), T + 600)).collect()
    assert {(r["bucket"], r["peak"]) for r in peaks if "/600/" in r["metric"]} == {(T, 2.0)}


def test_sampling_cut_over(spark):
    jobs = [job(i, started=float(T), completed=T + 1200.0, sampling=(T + 600.0, w)) for i, w in ((1, 3.0), (2, 0.0))]
    got = summed(L.job_contributions(table(spark, jobs), T + 1200).collect())
    assert got["fleet/600/running/self-hosted", T, 0] == 3 and got["fleet/600/running/self-hosted", T + 600, 0] == 2


def test_touching_waits_do_not_overlap(spark):
    jobs = [job(1, created=float(T), started=T + 60.0), job(2, created=T + 60.0, started=T + 90.0)]
    peaks = L.queue_peaks(L.job_contributions(table(spark, jobs), T + 600))
    assert {r["peak"] for r in peaks.collect()} == {1.0}


def plain(j, until, reported=True):
    """What one job contributes, as a dictionary (metric, bucket, value) -> amount, instant by instant."""
    out = collections.defaultdict(float)
    builds = j["name"] in L.Names.builds
    began = j["started"] if j["started"] and j["assigned"] else None
    done = j["completed"] if j["completed"] is not None else j["run_updated"] if j["run_status"] == "completed" else until
    done, since = min(done, until), max(j["created"], until - 30 * 86400)
    weigh = lambda t: j["weight"] if j["sampling"] is None else j["sampling"][1] if t < j["sampling"][0] else 1
    own = {"self-hosted": "self-hosted", "github": "gh-other" if not builds else "gh-build-pr" if j["trigger"] in ("pr", "workflow_dispatch") else "gh-build-other"}
    series = own.get(j["kind"], "ns-mq" if j["trigger"] in ("merge_queue", "bors_staging") else "ns-pr" if j["trigger"] == "pr" else "ns-other")
    for step in (600, 7200) if j["kind"] in L.Names.runners else ():
        for what, a, b in (("running", max(since, began) if began else 0, done if began else 0), ("queued", since, min(began or done, done) if not j["estimated"] else 0)):
            cuts = sorted({a, b, *(k for k in range(math.floor(a / step) * step, math.ceil(b) + step, step) if a < k < b), *([j["sampling"][0]] if j["sampling"] and a < j["sampling"][0] < b else [])}) if a < b else []
            for lo, hi in zip(cuts, cuts[1:]):
                w, bucket = weigh(lo), math.floor(lo / step) * step
                if what == "running":
                    out[f"fleet/{step}/running/{series}", bucket, 0] += w * (hi - lo) / step
                else:
                    out[f"fleet/{step}/queued/{j['kind']}", bucket, lo] += w
                    out[f"fleet/{step}/queued/{j['kind']}", bucket, hi] -= w
        if began and not j["estimated"] and began >= until - 30 * 86400:
            for end in range(math.ceil(began / step) * step, math.ceil(began + max(step, 1800)), step):
                if began <= end < began + max(step, 1800) and weigh(max(began, end - 1e-6)) > 0:
                    out[f"fleet/{step}/wait/{'build' if builds else 'other'}", end - step, max(0, began - j["created"]) / 60] += 1
        if (j["kind"], j["trigger"], j["name"]) == ("namespace", "pr", "sandboxed-build"):
            out[f"fleet/{step}/picked", math.floor(j["created"] / step) * step, j["created"]] += 1
    wait, ran = (max(0, began - j["created"]) / 60, max(0, j["completed"] - began) / 60 if j["completed"] is not None else None) if began else (None, None)
    if not j["estimated"] and j["name"] not in L.Names.plain and j["kind"] == "github" and began and weigh(began) > 0:
        out["wait/other", 0, wait] += 1
    bad = j["conclusion"] in ("failure", "timed_out")
    if reported and j["workflow"] == L.Names.workflow and j["name"] == "sandboxed-build" and j["kind"] in L.Names.runners and j["trigger"] in ("pr", "merge_queue", "bors_staging"):
        where = j["kind"] if j["trigger"] == "pr" else "merge"
        if ran is not None and j["conclusion"] == "success":
            out[f"duration/{where}", 0, ran] += 1
        if wait is not None:
            out[f"wait/{where}", 0, wait] += 1
        if where == "merge":
            if j["conclusion"]:
                out[f"merge/{j['conclusion'] if j['conclusion'] in ('success', 'failure', 'cancelled') else 'other'}", 0, 0] += 1
        else:
            out[f"picker/{where}", 0, 0] += 1
            out["pr-total", 0, 0] += bad or j["conclusion"] == "success"
            if bad:
                out["failure/" + ("timeout" if j["conclusion"] == "timed_out" else j["failure"] or j["run_failure"] or "pending"), 0, 0] += 1
            if j["conclusion"] == "success":
                known = [(C.TELEMETRY_GROUPS[p], s) for p, s in j["phases"] or [] if p in C.TELEMETRY_GROUPS and s is not None and s >= 0]
                total, sampled = sum(s for _, s in known), any(s > 0 for _, s in known)
                out["phase-count", 0, 0] += 1
                out["phase-sample-count", 0, 0] += sampled
                for name, a, b, _ in j["steps"] or []:
                    if a is None or b is None:
                        continue
                    secs = max(0, b - a)
                    parts = [("setup and checks" if "Install" in name else "reporting", secs)]
                    if "Build exact candidate" in name:
                        parts = [(g, s * min(1, secs / total)) for g, s in known] + [("sandbox, unattributed", max(0, secs - total))] if total else [("build, audits, lints", secs)]
                    for phase, s in parts:
                        out[f"phase/{phase}", 0, 0] += s / 60
                        if sampled:
                            out[f"sample-phase/{phase}", 0, 0] += s / 60
    if reported and builds and ran is not None:
        out[f"minutes/{j['kind']}", 0, 0] += ran
        if j["trigger"] == "pr" and j["conclusion"] == "cancelled":
            out["minutes/cancelled", 0, 0] += ran
    return {k: v for k, v in out.items() if abs(v) > 1e-9}


def test_contributions_match_a_plain_version(spark):
    rng, jobs = random.Random(23), []
    for i in range(250):
        created = T - rng.choice([0, 3600, 40 * 86400, 29 * 86400]) + rng.randrange(0, 20_000)
        started = rng.choice([None, float(created + rng.randrange(-30, 5000)), float(math.ceil(created / 600) * 600)])
        phases = rng.choice([None, [("build", 50.0), ("lint-env", None), ("other", 9.0), ("audit-axioms", 10.0)], [("build", 0.0)]])
        steps = rng.choice([None, [("Install tools", created + 1.0, created + 31.0, "success"), ("Build exact candidate", created + 31.0, created + 71.0, None), ("Report", None, created + 90.0, None), ("Post x", created + 90.0, created + 80.0, None)]])
        jobs.append(job(i, trigger=rng.choice(["pr", "merge_queue", "bors_staging", "push", "workflow_dispatch"]), workflow=rng.choice([L.Names.workflow, "other.yml"]), run_status=rng.choice(["completed", "in_progress"]), run_updated=float(created + 9000),
                        sampling=rng.choice([None, None, (float(created + 700), rng.choice([0.0, 3.0]))]), phases=phases, run_failure=rng.choice([None, "infra"]), name=rng.choice(["sandboxed-build", "sandboxed-build", "verify", "lint"]),
                        kind=rng.choice(["github", "namespace", "self-hosted", "unknown"]), conclusion=rng.choice([None, "success", "success", "failure", "timed_out", "cancelled", "skipped"]), created=float(created), started=started,
                        completed=rng.choice([None, float(created + rng.randrange(0, 9000))]), assigned=rng.random() < 0.8, estimated=rng.random() < 0.2, weight=rng.choice([1.0, 2.0, 0.0]), failure=rng.choice([None, "", "lean-error"]), steps=steps))
    got = collections.defaultdict(lambda: collections.defaultdict(float))
    for r in L.job_contributions(table(spark, jobs), T + 10_000, reported=F.col("id") % 5 != 0, keep=["id"]).collect():
        got[r["id"]][r["metric"], r["bucket"], r["value"]] += r["amount"]
    for j in jobs:
        want = plain(j, T + 10_000, j["id"] % 5 != 0)
        mine = {k: v for k, v in got[j["id"]].items() if abs(v) > 1e-9}
        near = lambda d: {(m, b, round(v, 6)): round(a, 6) for (m, b, v), a in d.items()}
        assert near(mine) == near(want), j


def test_runs_and_jobs_are_normalised(spark):
    title = f"bors branch=main batch=7 head={'a' * 40} base={'b' * 40}"
    raw = "repo string, id long, run_attempt int, path string, event string, trigger string, status string, conclusion string, created_at string, run_started_at string, updated_at string, head_sha string, head_branch string, display_title string, tested struct<head_sha:string,batch_id:long,batch_members:array<struct<pr:string>>>, archive_sampling struct<until:double,weight:double>"
    at = "2026-10-18T12:00:00Z"
    rows = [("r", 1, None, L.Names.workflow, "repository_dispatch", None, None, "success", at, None, "2026-10-18T14:00:00+02:00", None, None, title, None, None), ("r", 2, 3, "x", "push", "", "", None, None, None, None, "h", "b", None, ("t", 9, [("5",), ("5",), ("-1",), ("4",), (None,)]), (1.0, 2.0))]
    a, b = L.normalize_runs(spark.createDataFrame(rows, raw)).orderBy("run").collect()
    assert (a["attempt"], a["trigger"], a["status"], a["created"], a["started"], a["updated"], a["tested_head"], a["batch"], a["members"]) == (1, "bors_staging", "completed", T, T, T, "a" * 40, 7, None)
    assert (b["attempt"], b["trigger"], b["status"], b["conclusion"], b["created"], b["tested_head"], b["batch"], b["members"]) == (3, "push", "queued", None, 0, "t", 9, [5, 4])
    raw = "id long, run_id long, run_attempt int, name string, status string, conclusion string, created_at string, started_at string, completed_at string, runner_kind string, labels array<string>, runner_name string, runner_id long, assigned boolean, steps array<struct<name:string,started_at:string,completed_at:string,conclusion:string>>, failure_class string, failure_excerpt array<string>, weight double, estimated boolean"
    rows = [(1, 9, None, "pr-build / lint", None, "failure", at, None, at, None, ["ubuntu-24.04"], None, None, None, [("Install x", None, None, "failure")], None, ["axiom"], None, None), (2, 9, 2, None, "queued", None, None, None, None, "own", None, "", None, False, None, "policy", None, 0.0, True), (3, 9, 1, "n", "queued", None, at, None, None, None, None, None, None, None, [("s", at, None, None)], None, None, 1.0, None)]
    a, b, c = L.normalize_jobs(spark.createDataFrame(rows, raw)).orderBy("id").collect()
    assert (a["name"], a["status"], a["kind"], a["assigned"], a["failure"], a["weight"], a["estimated"], a["updated"]) == ("lint", "completed", "github", False, "infra-setup", 1, False, T)
    assert (b["attempt"], b["name"], b["kind"], b["assigned"], b["failure"], b["weight"], b["estimated"], b["created"]) == (2, "", "own", False, "policy", 0, True, 0)
    assert (c["assigned"], c["kind"], c["failure"], c["steps"][0]["started"]) == (True, "unknown", None, T)


def test_steps_come_from_plain_explodes_and_measures_make_no_fleet(spark):
    """Rows of steps are no nested lambdas, which Spark interprets; without the fleet's, all other rows stay as they are."""
    jobs = table(spark, [job(i, trigger=t, sampling=s, phases=p) for i, (t, s, p) in enumerate([("pr", None, [("build", 50.0)]), ("bors_staging", (T + 100.0, 3.0), None), ("push", None, None)])])
    both, daily = L.job_contributions(jobs, T + 600), L.job_contributions(jobs, T + 600, with_fleet=False)
    assert summed(daily.collect()) == {k: v for k, v in summed(both.collect()).items() if not k[0].startswith("fleet/")}
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(sequence(" in plan and plan.count("lambda ") <= daily._jdf.queryExecution().optimizedPlan().toString().count("lambda ")


def test_the_array_of_items_is_a_column_before_it_is_exploded(spark):
    """An explode that makes its array itself is interpreted for every job, as the phases' items have lambdas."""
    plan = L.job_contributions(table(spark, [job()]), T + 600)._jdf.queryExecution().optimizedPlan().toString()
    exploded = [line for line in plan.splitlines() if "Generate explode(" in line and "explode(sequence(" not in line]
    assert len(exploded) == 1 and "explode(_items#" in exploded[0] and "lambda " not in exploded[0]
