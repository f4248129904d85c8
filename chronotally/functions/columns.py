"""Column functions: every one is a Catalyst expression over its arguments."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Z95 = 1.96


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone; does not depend on the session's zone."""
    name = ts if isinstance(ts, str) else None
    if name is None:
        raise TypeError("give the column's name")
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")


def iso_time(us: Column) -> Column:
    """ISO text (whole seconds, Z) of epoch microseconds."""
    seconds = F.floor(us / 1_000_000)
    return F.date_format(F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc_day(us: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(us / 86_400_000_000).cast("int"))


def iso_micros(text: Column) -> Column:
    """Epoch microseconds of an ISO text ending in Z; 0 where it cannot be parsed."""
    plain = F.regexp_replace(text, "Z$", "")
    return F.coalesce(F.unix_micros(F.try_to_timestamp(F.concat(plain, F.lit("+00:00")), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))), F.lit(0))


def wilson(k: Column, n: Column, z: float = Z95) -> tuple[Column, Column, Column]:
    """(rate, low, high) of k out of n; null where n is 0."""
    k, n = k.cast("double"), F.when(n > 0, n.cast("double"))
    p = k / n
    base = 1 + z * z / n
    centre = (p + z * z / (2 * n)) / base
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / base
    return p, F.when(n.isNotNull(), F.greatest(F.lit(0.0), centre - half)), F.when(n.isNotNull(), F.least(F.lit(1.0), centre + half))


def labelled_ranges(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the half-open range [edge, next edge) that holds x; the last label is open-ended, null stays null."""
    out = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges[1:], labels[:-1], strict=True))):
        out = F.when(x < edge, label).otherwise(out)
    return F.when(x.isNotNull(), out)


def size_bucket(x: Column) -> Column:
    return labelled_ranges(x, [0, 50, 200, 500], ["<50", "50-199", "200-499", "500+"])


def moved_bucket(x: Column, first: str = "1-10") -> Column:
    """Distance bucket with closed upper edges; 0 and negative distances fall in the first."""
    return F.when(x <= 10, first).when(x <= 50, "11-50").when(x <= 200, "51-200").when(x.isNotNull(), ">200")


def hash_draw(key: Column) -> Column:
    """Deterministic number in [0, 1) from the first 8 bytes of the key's SHA-256."""
    return F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(float(2**64))


def modulo_sample(id_: Column, one_in: int) -> Column:
    return id_ % one_in == 0


def finite_counter(x: Column) -> Column:
    """x if it is a finite number of at least 0, else null."""
    x = x.cast("double")
    return F.when((x >= 0) & ~F.isnan(x) & (x < float("inf")), x)


def first_match(value: Column, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """Label of the first pattern that the text matches."""
    if not rules:
        return F.lit(default)
    out = F.when(value.rlike(rules[0][0]), rules[0][1])
    for pattern, label in rules[1:]:
        out = out.when(value.rlike(pattern), label)
    return out.otherwise(F.lit(default))


# Ordered patterns of step names and their phases.
STEP_PHASES = [
    ("Report|Summarise CI telemetry|Upload CI telemetry|Post |Complete job", "reporting"),
    ("Mathlib's compressed|Fetch Mathlib|Require a complete Mathlib", "Mathlib cache"),
    ("Lake artifact cache|own oleans|Lake archive", "Lake cache"),
    ("Build exact candidate", "build, audits, lints"),
    ("watchdog toolchain|environment-lint|Dot-notation", "lint preparation"),
]
# Telemetry phases and their groups.
TELEMETRY_GROUPS = {
    "stage-cache": "build",
    "build": "build",
    "audit-duplicates": "audits",
    "audit-axioms": "audits",
    "audit-module-system": "audits",
    "lint-env": "lints",
    "lint-style": "lints",
}


def step_phase(name: Column) -> Column:
    return first_match(name, STEP_PHASES, "setup and checks")


def telemetry_group(phase: Column) -> Column:
    """Group of a telemetry phase; null for one that is not known."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in TELEMETRY_GROUPS.items() for x in pair]), phase)


def runner_kind(labels: Column) -> Column:
    """Kind of runner from its labels, by ordered rules; other labels mean an own machine, no label is unknown."""
    has = lambda pattern: F.exists(labels, lambda x: x.rlike(pattern))
    return F.when(has("^nscloud-"), "namespace").when(has("^self-hosted$"), "self-hosted").when(has("^(ubuntu|windows|macos)-"), "github").when(F.size(labels) > 0, "self-hosted").otherwise("unknown")


def series_key(kind: Column, trigger: Column, is_build: Column) -> Column:
    """Chart series: hosted builds by who asked for them, named own machines by themselves, the rest by queue."""
    hosted = F.when(~is_build, "gh-other").when(trigger.isin("pr", "workflow_dispatch"), "gh-build-pr").otherwise("gh-build-other")
    rest = F.when(trigger.isin("merge_queue", "bors_staging"), "ns-mq").when(trigger == "pr", "ns-pr").otherwise("ns-other")
    return F.when(kind == "github", hosted).when(kind.isin("namespace", "unknown"), rest).otherwise(kind)


def job_class(is_build: Column, trigger: Column, control: Column, maintenance: Column) -> Column:
    """Class of a job by ordered rules; what counts as build, control and maintenance is the caller's list of names."""
    build = F.when(trigger == "pr", "pr_build").when(trigger.isin("bors_staging", "merge_queue"), "staging_build").otherwise("other_build")
    return F.when(is_build, build).when(control, "control").when(maintenance, "maintenance").otherwise("other")


def derive_trigger(event: Column, title: Column, workflow: Column, given: Column, staging: str) -> Column:
    """Trigger of a run: a given one stands. A repository dispatch of the ``staging`` workflow is staging if its title names
    branch, batch, head and base and the branch is main, else it is an unknown one; other events stand for themselves,
    dispatches of other workflows too."""
    branch = F.regexp_extract(F.coalesce(title, F.lit("")), r"^bors branch=(\S+) batch=(\d+) head=([0-9a-f]{40}) base=([0-9a-f]{40})$", 1)
    event = F.coalesce(event, F.lit(""))
    return (
        F.when(F.coalesce(given, F.lit("")) != "", given).when((event == "repository_dispatch") & F.coalesce(workflow == staging, F.lit(False)), F.when(branch == "main", "bors_staging").otherwise("bors_unknown"))
        .when(event.isin("pull_request", "pull_request_target"), "pr").when(event == "merge_group", "merge_queue").otherwise(event)
    )


def change_cohort(paths: Column, truncated: Column, dependency_files: Sequence[str]) -> Column:
    """dependency-bump, ordinary or unknown from a change's paths; a truncated or missing list is unknown."""
    known = paths.isNotNull() & ~F.coalesce(truncated, F.lit(False))
    return F.when(~known, "unknown").when(F.arrays_overlap(paths, F.array(*[F.lit(f) for f in dependency_files])), "dependency-bump").otherwise("ordinary")


# Steps that build, ordered rules over their log lines, lines that prove nothing, and rules over other steps' names.
BUILD_STEP = "Build exact candidate|lake build|^Build$"
LOG_RULES = [
    (r"(?:^|\s)Killed(?:\s+timeout\b|\s*$)|\bLean exited with code 137\b", "process-killed"),
    (r"\btimed out\b|\bexceeded .* (?:deadline|wall-clock limit)\b", "timeout"),
    (r"failed to download artifact|Transferred a partial file", "infra-cache"),
    (r"LINT-ENV: FAIL", "lint-env"),
    (r"[Aa]xiom", "audit-axioms"),
    (r"[Dd]uplicate declaration", "audit-duplicates"),
    (r"module system|isModule", "audit-module-system"),
    (r"ERR_[A-Z]+|style lint|lint-style", "lint-style"),
    (r"\.lean:\d+:\d+: error|^error: .*\.lean", "lean-error"),
]
NOISE = r"^(?:✔(?:\s|$)|\+\+?\s)"
STEP_RULES = [
    ("^Report|^Post ", "infra-report"),
    ("guard|Scope|shim|Attest|Validate the Lake-pin|Normalise|bump|Reject option", "policy"),
    ("Dot-notation", "dot-notation"),
    ("Build the trusted environment-lint driver|watchdog toolchain", "toolchain-incompat"),
    ("Mathlib|Lake cache|oleans|Lake artifact|cache", "infra-cache"),
    ("Install|Raise vm|Checkout|Set up|Resolve PR head", "infra-setup"),
]


def failure_class(conclusion: Column, step: Column, lines: Column) -> Column:
    """Class of a failed job: by its conclusion, then for a building step by its log lines, else by the step's name.

    A building step without any log (null) is build-unknown; with a log that tells nothing it is lean-error."""
    told = F.filter(lines, lambda x: ~x.rlike(NOISE))
    by_log = F.lit(None).cast("string")
    for pattern, label in reversed(LOG_RULES):
        by_log = F.when(_any(told, pattern), label).otherwise(by_log)
    built = F.coalesce(by_log, F.when(lines.isNull(), "build-unknown").otherwise("lean-error"))
    nothing = conclusion.isNull() | conclusion.isin("", "success", "skipped", "neutral")
    return (
        F.when(nothing, None).when(conclusion == "cancelled", "cancelled").when(conclusion == "timed_out", "timeout")
        .when(step.rlike(BUILD_STEP), built).otherwise(first_match(step, STEP_RULES, "other"))
    )


def _any(lines: Column, pattern: str) -> Column:
    return F.coalesce(F.exists(lines, lambda x: x.rlike(pattern)), F.lit(False))


def public_text(text: Column, longest: int = 300) -> Column:
    """Text for a public page: control characters are spaces, and it is cut to a length."""
    return F.left(F.regexp_replace(text, r"[\x00-\x1f\x7f]", " "), F.lit(longest))


def public_steps(steps: Column, most: int = 12) -> Column:
    """The steps of a job that a public page shows: those that run, then the last ``most`` - 1 of all others, ``most`` in all.
    A step has name, started, completed and conclusion."""
    runs = lambda s: s["started"].isNotNull() & s["completed"].isNull()
    rest = F.filter(steps, lambda s: ~runs(s))
    size = F.least(F.size(rest), F.lit(most - 1))
    last = F.slice(rest, F.size(rest) - size + 1, size)
    shown = F.slice(F.concat(F.filter(steps, runs), last), 1, most)
    text = lambda s, name, longest: public_text(s[name], longest)
    ended = lambda s: F.when(s["conclusion"] != "", text(s, "conclusion", 40))
    return F.transform(shown, lambda s: F.struct(text(s, "name", 300).alias("name"), s["started"].alias("started"), s["completed"].alias("completed"), ended(s).alias("conclusion")))
