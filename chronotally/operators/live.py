"""Runs and jobs as they are delivered, normalised, and the reversible metric rows that each job contributes.

Times are seconds since the epoch. Everything a job contributes comes from its own row, joined with its run: one pass, no
shuffle. Rows have the key of ``metrics`` (day, bucket, metric, value) and can be added and taken back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronotally.functions import columns as C
from chronotally.operators import folds

DAY = 86_400
KEPT_DAYS = 30
STEPS = (600, 7200)
#: A wait shows in the steps that end within so many seconds of the start, or within the step itself if it is longer.
TRAILING = 1800
SUBSECOND = 0.000001


@dataclass(frozen=True)
class Names:
    """What the caller's installation calls its jobs, workflow and runners."""

    build: str = "sandboxed-build"
    builds: Sequence[str] = ("sandboxed-build", "verify", "build", "performance-gate")
    plain: Sequence[str] = ("sandboxed-build", "verify", "build")
    workflow: str = ".github/workflows/pr-build.yml"
    runners: Sequence[str] = ("github", "namespace", "self-hosted")
    staging: Sequence[str] = field(default=("merge_queue", "bors_staging"))


def seconds_of(text: Column) -> Column:
    """Seconds of an instant with an offset; null if it is none, or has none, whatever the session's time zone."""
    at = F.when(text.rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})$"), F.try_to_timestamp(text))
    return F.unix_micros(at) / F.lit(1_000_000.0)


def _some(text: Column) -> Column:
    """The text, null if it is empty."""
    return F.nullif(text, F.lit(""))


def normalize_runs(raw: DataFrame, staging: str = Names.workflow) -> DataFrame:
    """Runs from deliveries: repo, id, run_attempt, path, event, trigger, status, conclusion, created_at, run_started_at,
    updated_at, head_sha, head_branch, display_title, tested (head_sha, batch_id, batch_members of pr) and archive_sampling.

    A missing status follows from the conclusion; times that are missing follow from the creation; head, batch and members
    of a staging run come from what was tested, else from its title. Members are distinct positive numbers, in order."""
    title = F.coalesce("display_title", F.lit(""))
    part = lambda i: _some(F.regexp_extract(title, r"^bors branch=(\S+) batch=(\d+) head=([0-9a-f]{40}) base=([0-9a-f]{40})$", i))
    created = F.coalesce(seconds_of(F.col("created_at")), F.lit(0.0))
    members = F.array_distinct(F.filter(F.transform("tested.batch_members", lambda m: m["pr"].cast("long")), lambda n: n > 0))
    return raw.select(
        "repo", F.col("id").cast("string").alias("run"), F.coalesce(F.nullif(F.col("run_attempt").cast("int"), F.lit(0)), F.lit(1)).alias("attempt"), F.coalesce("path", F.lit("")).alias("workflow"),
        F.coalesce("event", F.lit("")).alias("event"), C.derive_trigger(F.col("event"), title, F.col("path"), F.col("trigger"), staging).alias("trigger"),
        F.coalesce(_some(F.col("status")), F.when(_some(F.col("conclusion")).isNotNull(), "completed").otherwise("queued")).alias("status"), _some(F.col("conclusion")).alias("conclusion"),
        created.alias("created"), F.coalesce(seconds_of(F.coalesce("run_started_at", "created_at")), F.lit(0.0)).alias("started"), F.coalesce(seconds_of(F.coalesce("updated_at", "created_at")), F.lit(0.0)).alias("updated"),
        F.coalesce("head_sha", F.lit("")).alias("head"), F.coalesce("head_branch", F.lit("")).alias("branch"), F.coalesce(_some(F.col("tested.head_sha")), part(3)).alias("tested_head"),
        F.coalesce(F.nullif(F.col("tested.batch_id").cast("long"), F.lit(0)), part(2).cast("long")).alias("batch"), members.alias("members"), F.col("archive_sampling").alias("sampling"),
    )


@dataclass(frozen=True)
class Hosts:
    """Reported names of machines: by their identifier (at least 12 characters) and by a name in a label."""

    machines: Mapping[str, str] = field(default_factory=dict)
    names: Mapping[str, str] = field(default_factory=dict)


def host_of(labels: Column, runner_name: Column, hosts: Hosts) -> Column:
    """The one machine that a job's labels (fleet-<identifier>, fleet-host-<name>) and runner name (fleet-<12 characters of
    the identifier>-<16 hex digits>) name; null if they name none or several."""
    if not hosts.machines and not hosts.names:
        return F.lit(None).cast("string")
    lookup = lambda known, key: F.try_element_at(F.create_map(*[F.lit(x) for pair in known.items() for x in pair]), key) if known else F.lit(None).cast("string")
    after = lambda x, head: F.when(x.startswith(head), F.substring(x, F.lit(len(head) + 1), F.length(x)))
    of_label = lambda x: F.coalesce(lookup(hosts.machines, after(x, "fleet-")), lookup(hosts.names, after(x, "fleet-host-")))
    short = {ident[:12]: alias for ident, alias in hosts.machines.items()}
    of_name = lookup(short, F.regexp_extract(F.coalesce(runner_name, F.lit("")), "^fleet-(.{12})-[a-f0-9]{16}$", 1))
    named = F.array_distinct(F.array_compact(F.concat(F.transform(F.coalesce(labels, F.array().cast("array<string>")), of_label), F.array(of_name))))
    return F.when(F.size(named) == 1, F.get(named, F.lit(0)))


def normalize_jobs(raw: DataFrame, prefix: str = "pr-build / ", hosts: Hosts = Hosts()) -> DataFrame:  # noqa: B008
    """Jobs from deliveries: id, run_id, run_attempt, name, status, conclusion, created_at, started_at, completed_at,
    runner_kind, labels, runner_name, runner_id, assigned, steps (name, started_at, completed_at, conclusion), failure_class,
    failure_excerpt (lines), weight and estimated.

    A job is assigned if anything proves it: a runner's id or name, its status, the flag, or a step that started. The name
    loses the calling workflow's prefix. A failure without a class is classed by its excerpt, if there is one. A job on an own
    machine that is known is of that machine's kind. ``check_run`` comes from check_run_url, if there is such a column."""
    at = lambda c: F.nullif(seconds_of(c), F.lit(0.0))
    steps = F.coalesce(F.transform("steps", lambda s: F.struct(s["name"].alias("name"), at(s["started_at"]).alias("started"), at(s["completed_at"]).alias("completed"), _some(s["conclusion"]).alias("conclusion"))), F.array())
    rows = raw.withColumn("_steps", steps)
    failed = F.coalesce(F.get(F.filter("_steps", lambda s: s["conclusion"] == "failure"), F.lit(0))["name"], F.lit(""))
    proofs = [_some(F.col("runner_id").cast("string")).isNotNull(), _some(F.col("runner_name")).isNotNull(), F.col("status") == "in_progress", F.col("assigned"), F.exists("_steps", lambda s: s["started"].isNotNull())]
    assigned = F.greatest(*[F.coalesce(p.cast("int"), F.lit(0)) for p in proofs]) > 0
    latest = F.coalesce(at(F.col("completed_at")), at(F.col("started_at")), at(F.col("created_at")), F.lit(0.0))
    host, kind = host_of(F.col("labels"), F.col("runner_name"), hosts), F.coalesce(_some(F.col("runner_kind")), C.runner_kind(F.col("labels")))
    check = _some(F.regexp_extract(F.coalesce("check_run_url", F.lit("")), r"/check-runs/(\d+)$", 1)) if "check_run_url" in raw.columns else F.lit(None).cast("string")
    return rows.select(
        F.col("id").cast("string").alias("id"), F.col("run_id").cast("string").alias("run"), F.coalesce(F.nullif(F.col("run_attempt").cast("int"), F.lit(0)), F.lit(1)).alias("attempt"),
        F.when(F.col("name").startswith(prefix), F.substring("name", F.lit(len(prefix) + 1), F.length("name"))).otherwise(F.coalesce("name", F.lit(""))).alias("name"),
        F.coalesce(_some(F.col("status")), F.when(_some(F.col("conclusion")).isNotNull(), "completed").otherwise("queued")).alias("status"), _some(F.col("conclusion")).alias("conclusion"),
        F.coalesce(seconds_of(F.col("created_at")), F.lit(0.0)).alias("created"), at(F.col("started_at")).alias("started"), at(F.col("completed_at")).alias("completed"),
        F.when((kind == "self-hosted") & host.isNotNull(), host).otherwise(kind).alias("kind"), F.coalesce("labels", F.array().cast("array<string>")).alias("labels"), F.coalesce("runner_name", F.lit("")).alias("runner_name"),
        assigned.alias("assigned"), F.col("_steps").alias("steps"),
        F.coalesce(_some(F.col("failure_class")), F.when(F.col("failure_excerpt").isNotNull(), C.failure_class(F.col("conclusion"), failed, F.col("failure_excerpt")))).alias("failure"),
        F.coalesce(F.col("weight").cast("double"), F.lit(1.0)).alias("weight"), F.coalesce("estimated", F.lit(False)).alias("estimated"), latest.alias("updated"),
        host.alias("host"), _some(F.col("runner_id").cast("string")).alias("runner_id"), check.alias("check_run"),
    )


#: A row by itself, a row of the day (not of a step), and rows of the steps from the first to the last: the interval's share of the
#: step, the queue's change where the part within the step begins and ends, and a wait that ends in the steps.
ONE, DAILY, RUNNING, JOINED, LEFT, WAITED = range(6)


def _day(at: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(at / DAY).cast("int"))


def _item(metric: Column, *, at: Column, value: Column, amount: Column, form: int = ONE, step: int = 1, first: Column | None = None, last: Column | None = None, a: Column | None = None, b: Column | None = None) -> Column:
    """What makes one metric row, or one for each step from ``first`` to ``last``; forms differ in a step's row."""
    number = lambda x: (F.lit(0.0) if x is None else x).cast("double")
    place = lambda x: (F.lit(0) if x is None else x).cast("long")
    return F.struct(
        metric.alias("metric"), F.lit(form).alias("form"), F.lit(step).alias("step"), place(first).alias("first"), place(last).alias("last"), number(a).alias("a"), number(b).alias("b"),
        at.cast("double").alias("at"), value.cast("double").alias("value"), amount.cast("double").alias("amount"),
    )


def job_contributions(work: DataFrame, until: float, *, reported: Column | None = None, names: Names = Names(), keep: Sequence[str] = (), with_fleet: bool = True) -> DataFrame:  # noqa: B008
    """Metric rows of jobs joined with their runs, as of ``until``; without the fleet's, if only measures of days are wanted.

    work: trigger, workflow, run_status, run_updated, sampling (until, weight; may be null), phases (phase, seconds),
    run_failure, and of the job name, kind, conclusion, created, started, completed, assigned, estimated, weight, failure,
    steps. Where there is a column job_failures (job, failure), the telemetry's class of the job ``id`` stands before that of its run.
    ``reported`` tells the runs whose repository has daily measures. Per step of 600 and 7,200 seconds:
    running/<series> as the weighted share of the step, queued/<kind> as +weight and -weight at the ends (so that peaks can be
    taken back), wait/<build|other> in the steps that end behind the start, picked. Per day: outcomes, waits, durations,
    pickers, failure classes, phases, minutes.

    A completed run ends its open jobs; intervals reach 30 days back; before a sampling's cut-over its weight stands, behind it
    every job counts once. Days are days of the bucket, else of the creation, for minutes of the start."""
    end_ = F.least(F.coalesce("completed", F.when(F.col("run_status") == "completed", F.col("run_updated")), F.lit(float(until))), F.lit(float(until)))
    rows = work.withColumns({
        "_end": end_, "_from": F.greatest(F.col("created"), F.lit(float(until - KEPT_DAYS * DAY))), "_began": F.when(F.col("assigned") & (F.col("started") > 0), F.col("started")),
        "_is_build": F.col("name").isin(*names.builds), "_cut": F.col("sampling.until"), "_reported": F.coalesce(reported, F.lit(False)) if reported is not None else F.lit(True),
    })
    by_job = F.get(F.filter("job_failures", lambda f: f["job"] == F.col("id").cast("string")), F.lit(0))["failure"] if "job_failures" in work.columns else F.lit(None).cast("string")
    began, estimated, kind, trigger, created = F.col("_began"), F.coalesce(F.col("estimated"), F.lit(False)), F.col("kind"), F.col("trigger"), F.col("created")
    conclusion, is_build, zero, one = F.col("conclusion"), F.col("_is_build"), F.lit(0.0), F.lit(1.0)
    weight_at = lambda at: F.when(F.col("sampling").isNull(), F.col("weight")).when(at < F.col("_cut"), F.col("sampling.weight")).otherwise(one)
    series = C.series_key(kind, trigger, is_build)
    listed = kind.isin(*names.runners)
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    parts = []

    def spans(a: Column, b: Column) -> list[tuple[Column, Column, Column, Column]]:
        """Parts (condition, a, b, weight) of [a, b) on either side of the sampling's cut-over."""
        cut = F.coalesce((F.col("_cut") > a) & (F.col("_cut") < b), F.lit(False))
        first = F.when(cut, F.col("_cut")).otherwise(b)
        return [((first > a) & (weight_at(a) != 0), a, first, weight_at(a)), (cut & (weight_at(F.col("_cut")) != 0), F.col("_cut"), b, weight_at(F.col("_cut")))]

    def stepped(form: int, step: int, metric: Column, when: Column, a: Column, b: Column) -> list[Column]:
        return [
            F.when(when & there, _item(metric, at=zero, value=zero, amount=w, form=form, step=step, first=F.floor(x / step), last=F.ceil(y / step) - 1, a=x, b=y)) for there, x, y, w in spans(a, b)
        ]

    def fleet(step: int) -> list[Column]:
        """Items of one step width."""
        until_start = F.least(F.coalesce(began, F.col("_end")), F.col("_end"))
        queued = text(f"fleet/{step}/queued/", kind)
        wait = _item(
            text(f"fleet/{step}/wait/", F.when(is_build, "build").otherwise("other")), at=zero, value=F.greatest(zero, began - created) / 60, amount=one, form=WAITED, step=step,
            first=F.ceil(began / step), last=F.floor((began + max(step, TRAILING)) / step), a=began, b=began + max(step, TRAILING),
        )
        return [
            *stepped(RUNNING, step, text(f"fleet/{step}/running/", series), listed & began.isNotNull(), F.greatest("_from", "_began"), F.col("_end")),
            *stepped(JOINED, step, queued, listed & ~estimated, F.col("_from"), until_start), *stepped(LEFT, step, queued, listed & ~estimated, F.col("_from"), until_start),
            F.when(listed & ~estimated & (began >= until - KEPT_DAYS * DAY), wait),
            F.when(listed & (kind == "namespace") & (trigger == "pr") & (F.col("name") == names.build), _item(F.lit(f"fleet/{step}/picked"), at=F.floor(created / step) * step, value=created, amount=one)),
        ]

    for step in STEPS if with_fleet else ():
        parts += fleet(step)
    seconds, waited = F.when(began.isNotNull(), F.greatest(zero, F.col("completed") - began)), F.greatest(zero, began - created)
    waited = F.when(began.isNotNull(), waited)
    daily = lambda when, metric, value=zero, amount=one, at=created: parts.append(F.when(when, _item(metric if isinstance(metric, Column) else F.lit(metric), at=at, value=value, amount=amount, form=DAILY)))
    daily(~estimated & ~F.col("name").isin(*names.plain) & (kind == "github") & waited.isNotNull() & (weight_at(began) > 0), "wait/other", waited / 60)
    built = F.col("_reported") & (F.col("workflow") == names.workflow) & (F.col("name") == names.build) & listed
    pr, merge, failed = built & (trigger == "pr"), built & trigger.isin(*names.staging), conclusion.isin("failure", "timed_out")
    success = conclusion == "success"
    daily(pr & success & seconds.isNotNull(), text("duration/", kind), seconds / 60)
    daily(pr & waited.isNotNull(), text("wait/", kind), waited / 60)
    daily(pr & (failed | success), "pr-total")
    daily(pr, text("picker/", kind))
    daily(pr & failed, text("failure/", F.when(conclusion == "timed_out", "timeout").otherwise(F.coalesce(_some(F.col("failure")), _some(by_job), _some(F.col("run_failure")), F.lit("pending")))))
    daily(merge & success & seconds.isNotNull(), "duration/merge", seconds / 60)
    daily(merge & waited.isNotNull(), "wait/merge", waited / 60)
    daily(merge & _some(conclusion).isNotNull(), text("merge/", F.when(conclusion.isin("success", "failure", "cancelled"), conclusion).otherwise("other")))
    timed = F.filter("phases", lambda p: (p["seconds"] >= 0) & C.telemetry_group(p["phase"]).isNotNull())
    sampled = F.coalesce(F.exists(timed, lambda p: p["seconds"] > 0), F.lit(False))
    daily(pr & success, "phase-count")
    daily(pr & success & sampled, "phase-sample-count")
    phases = F.when(pr & success, _phase_items(created, timed, sampled))
    minutes = F.col("_reported") & is_build & seconds.isNotNull()
    daily(minutes, text("minutes/", kind), zero, seconds / 60, began)
    daily(minutes & (trigger == "pr") & (conclusion == "cancelled"), "minutes/cancelled", zero, seconds / 60, began)
    finite = lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))
    # Two explodes and plain columns instead of one array by nested lambdas, which Spark would interpret for every row.
    items = F.array(*parts)
    items = F.when(phases.isNull(), items).otherwise(F.concat(items, phases))
    carried = ["weight", "sampling", "_cut"]
    taken = {c: f"_w{i}" for i, c in enumerate(carried)}  # so that ``keep`` may name them too
    # The array is a column before it is exploded: what is exploded at once is interpreted as a whole if there is one lambda in it.
    each = rows.select(*keep, *[F.col(c).alias(t) for c, t in taken.items()], items.alias("_items")).select(*keep, *taken.values(), F.explode("_items").alias("m")).where("m is not null")
    each = each.select(*keep, *taken.values(), "m.*").select(*keep, *taken.values(), "metric", "form", "step", "a", "b", "at", "value", "amount", F.explode(F.sequence("first", "last", F.lit(1).cast("long"))).alias("_k"))
    form, lo = F.col("form"), (F.col("_k") * F.col("step")).cast("double")
    begins, ends, before = F.greatest("a", lo), F.least("b", lo + F.col("step")), lo - F.col("step")
    late = F.greatest(F.col("a"), lo - SUBSECOND)
    sampling, cut, weight = F.col(taken["sampling"]), F.col(taken["_cut"]), F.col(taken["weight"])
    weight_then = F.when(sampling.isNull(), weight).when(late < cut, sampling["weight"]).otherwise(one)
    counts = (form != WAITED) | ((lo < F.col("b")) & (weight_then > 0))
    at = F.when(form <= DAILY, F.col("at")).when(form == WAITED, before).otherwise(lo)
    value = F.when(form == JOINED, begins).when(form == LEFT, ends).otherwise(F.col("value"))
    amount = F.when(form == RUNNING, F.col("amount") * (ends - begins) / F.col("step")).when(form == LEFT, -F.col("amount")).otherwise(F.col("amount"))
    out = each.where(counts).select(*keep, _day(at).alias("day"), F.when(form == DAILY, F.lit(0)).otherwise(at).cast("long").alias("bucket"), "metric", value.alias("value"), amount.alias("amount"))
    return out.where((F.col("amount") != 0) & finite(F.col("amount")) & finite(F.col("value")))


#: How a job's record follows its predecessor.
JOB_MERGE = folds.Merge(
    fill={"failure": None, "steps": None, "kind": "unknown", "runner_name": None, "runner_id": None, "check_run": None, "labels": None}, learn=("host", "kind", ("unknown", "self-hosted"), ("labels", "runner_name"))
)


def signed_contributions(changes: DataFrame, until: float, *, reported: Column | None = None, names: Names = Names(), keep: Sequence[str] = ()) -> DataFrame:  # noqa: B008
    """What changes of jobs' records (``folds.state_changes``, with the columns of their runs) do to the metrics: the rows that
    each new record contributes less those of the one before, summed by ``keep`` and the metrics' key, zero ones left out. Summed
    over all changes they are the contributions of the final records."""
    return record_contributions(folds.signed_records(changes), until, reported=reported, names=names, keep=keep)


def record_contributions(signed: DataFrame, until: float, *, reported: Column | None = None, names: Names = Names(), keep: Sequence[str] = ()) -> DataFrame:  # noqa: B008
    """What signed records (``folds.signed_records``, ``folds.net_records``) add to and take from the metrics, summed likewise. A record
    costs a row for every step that it lasts, so those that cancel had better be left out before."""
    run = [c for c in signed.columns if c not in ("record", "sign") and c not in signed.schema["record"].dataType.names]
    rows = job_contributions(signed.select(*run, "record.*", "sign"), until, reported=reported, names=names, keep=[*keep, "sign"])
    rows = rows.groupBy(*keep, "day", "bucket", "metric", "value").agg(F.sum(F.col("amount") * F.col("sign")).alias("amount"))
    return rows.where(F.abs("amount") >= 1e-9)


def _phase_items(created: Column, timed: Column, sampled: Column) -> Column:
    """phase/<name> rows in minutes of the steps that have both ends, and sample-phase/<name> ones of a sampled run. The
    building step is split by its run's telemetry, scaled down to fit; what is left of it is unattributed."""
    total = F.aggregate(timed, F.lit(0.0), lambda a, p: a + p["seconds"])
    ended = F.filter("steps", lambda s: s["started"].isNotNull() & s["completed"].isNotNull())
    pair = lambda name, secs: F.struct(name.alias("name"), secs.cast("double").alias("s"))

    def split(s: Column) -> Column:
        secs = F.greatest(F.lit(0.0), s["completed"] - s["started"])
        own = F.transform(timed, lambda p: pair(C.telemetry_group(p["phase"]), p["seconds"] * F.least(F.lit(1.0), F.try_divide(secs, total))))
        rest = F.array(pair(F.lit("sandbox, unattributed"), F.greatest(F.lit(0.0), secs - total)))
        return F.when((C.step_phase(s["name"]) == "build, audits, lints") & (total > 0), F.concat(own, rest)).otherwise(F.array(pair(C.step_phase(s["name"]), secs)))

    found = F.flatten(F.transform(ended, split))
    named = lambda head: F.transform(found, lambda p: _item(F.concat(F.lit(head), p["name"]), at=created, value=F.lit(0.0), amount=p["s"] / 60, form=DAILY))
    return F.when(sampled, F.concat(named("phase/"), named("sample-phase/"))).otherwise(named("phase/"))


def queue_peaks(rows: DataFrame, keys: Sequence[str] = ("bucket", "metric")) -> DataFrame:
    """Largest number queued per bucket and metric, from the +weight and -weight rows, however often rows were added and
    taken back; changes at one instant count together, so that touching intervals do not overlap."""
    queued = rows.where(F.col("metric").rlike("^fleet/[0-9]+/queued/")).groupBy(*keys, "value").agg(F.sum("amount").alias("change"))
    level = F.sum("change").over(Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    return queued.withColumn("level", level).groupBy(*keys).agg(F.greatest(F.max("level"), F.lit(0.0)).alias("peak"))
