"""Queries on scalar functions, normalisation, sources and quality gates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronotally.functions import columns as C
from chronotally.operators import gates as G
from chronotally.operators import joins as J
from chronotally.operators import live as L
from chronotally.operators import quality as V
from chronotally.operators import sequence as S
from chronotally.plans.registry import jobs, query, read, runs, snapshots, steps
from chronotally.sources import records

DAY, HOUR = 86_400_000_000, 3_600_000_000
CLOCK = 1_706_000_000_000_000


@query("""with m as (select doc_id, split_part(text, chr(10), 1) || ' (#' || doc_id * 7 || ')' as subject from documents where doc_id % 3 <> 0 union all select doc_id, 'no item ' || doc_id from documents where doc_id % 3 = 0)
    select doc_id, cast(nullif(regexp_extract(subject, '^.*\\(#([0-9]+)\\)', 1), '') as bigint) as pr from m""")
def pr_from_subject(spark, d):
    docs = read(spark, d, "documents")
    subject = F.when(F.col("doc_id") % 3 != 0, F.concat(F.split("text", "\n")[0], F.lit(" (#"), F.col("doc_id") * 7, F.lit(")\nbody (#1)"))).otherwise(F.concat(F.lit("no item "), "doc_id"))
    return docs.select("doc_id", records.pr_from_subject(subject).alias("pr"))


@query("select run, (row_number() over (order by created, run) - 1) // 1000 as page, ceil(count(*) over () / 1000.0)::bigint as pages from runs")
def paged_export(spark, d):
    rows = S.ordered_index(runs(spark, d), [F.col("created"), F.col("run")], "ix")
    return records.paged(rows, "ix", 1000).select("run", "page", "pages")


@query("""select id, case when id % 10 = 0 then 'corrupt-result' else 'ok' end as status, case when id % 10 <> 0 then cast(props ->> '$.k' as bigint) end as k from jobs""")
def tolerant_json(spark, d):
    cut = F.when(F.col("id") % 10 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    rows = records.tolerant_json(jobs(spark, d).withColumn("payload", cut), "payload", "k long")
    return rows.select("id", "status", "parsed.k")


@query("""select r.run, r.repo, r.workflow, count(s.run) as jobs, coalesce(string_agg(s.n::varchar || s.kind, ',' order by s.n, s.kind), '') as detail from runs r left join steps s on s.run = r.run group by all""")
def history_to_events(spark, d):
    events = records.history_to_events(runs(spark, d), steps(spark, d).select("run", "n", "kind"), "run")
    detail = F.array_join(F.transform(F.array_sort("jobs"), lambda j: F.concat(j["n"], j["kind"])), ",")
    return events.select("run.run", "run.repo", "run.workflow", F.size("jobs").cast("long").alias("jobs"), detail.alias("detail"))


@query("""with m as (select run, list_distinct(list_filter(list(module), lambda x: x % 3 <> 0)) as p from steps group by run)
    select r.run::varchar as run, case when r.head % 3 = 0 then 'waiting' when conclusion = 'cancelled' then 'queued' else 'completed' end as status, case when r.head % 2 = 0 then created // 1000000 else created // 1000000 + 60 end::double as started,
      case when r.head % 5 = 1 then 'bors_staging' when r.head % 5 = 2 then 'bors_unknown' else 'merge_queue' end as trigger, case when r.head % 5 in (1, 2) then r.run end as batch, case when r.head % 7 = 0 then 't' || r.run when r.head % 5 in (1, 2) then sha1(r.run::varchar) end as tested_head, coalesce(len(m.p), 0)::bigint as members
    from runs r left join m using (run)""")
def normalize_runs(spark, d):
    """Deliveries of staging runs: what was tested comes from the delivery or the title, members are distinct positive numbers."""
    r = runs(spark, d).join(steps(spark, d).groupBy("run").agg(F.collect_list("module").alias("tested_items")), "run", "left")
    i, h, text = F.col("run"), F.col("head"), F.lit(None).cast("string")
    iso, hash_ = (lambda c: F.date_format(F.timestamp_micros(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")), F.sha1(i.cast("string").cast("binary"))
    title = lambda branch: F.concat(F.lit(f"bors branch={branch} batch="), i.cast("string"), F.lit(" head="), hash_, F.lit(" base="), hash_)
    members = F.transform("tested_items", lambda m: F.struct(F.when(m % 3 == 0, -m).otherwise(m).cast("string").alias("pr")))
    raw = r.select(
        F.lit("r").alias("repo"), i.alias("id"), F.lit(1).alias("run_attempt"), F.lit(L.Names.workflow).alias("path"), F.when(h % 5 < 1, "merge_group").when(h % 5 < 3, "repository_dispatch").otherwise("merge_group").alias("event"), text.alias("trigger"),
        F.when(h % 3 == 0, "waiting").alias("status"), F.when(F.col("conclusion") != "cancelled", F.col("conclusion")).alias("conclusion"), iso(F.col("created")).alias("created_at"), F.when(h % 2 != 0, iso(F.col("created") + 60_000_000)).alias("run_started_at"), text.alias("updated_at"), text.alias("head_sha"), text.alias("head_branch"),
        F.when(h % 5 == 1, title("main")).when(h % 5 == 2, title("dev")).alias("display_title"), F.struct(F.when(h % 7 == 0, F.concat(F.lit("t"), i.cast("string"))).alias("head_sha"), F.lit(None).cast("long").alias("batch_id"), members.alias("batch_members")).alias("tested"), F.lit(None).cast("struct<until:double,weight:double>").alias("archive_sampling"),
    )
    out = L.normalize_runs(raw)
    return out.select("run", "status", "started", "trigger", "batch", "tested_head", F.coalesce(F.size("members"), F.lit(0)).cast("long").alias("members")).withColumn("members", F.greatest("members", F.lit(0).cast("long")))


@query("""select run || '-' || n as id, n::varchar as name, wait_s > 25 or kind = 'R' as assigned, (run * 10 + n)::varchar as check_run,
    case when kind = 'A' then 'github' when run % 4 = 0 then 'north' when run % 4 = 1 then 'south' when run % 4 = 2 and kind = 'R' then 'north' else 'self-hosted' end as kind from steps""")
def normalize_jobs(spark, d):
    """Deliveries of jobs on known and unknown machines, named by a label or only by the runner; two names in one job name none."""
    s, text, i = steps(spark, d), F.lit(None).cast("string"), F.col("run")
    labels = F.when(F.col("kind") == "A", F.array(F.lit("ubuntu-24.04"))).when(i % 4 == 0, F.array(F.lit("self-hosted"), F.lit("fleet-0123456789abcdef"))).when(i % 4 == 1, F.array(F.lit("self-hosted"), F.lit("fleet-host-s1"))).when(i % 4 == 3, F.array(F.lit("self-hosted"), F.lit("fleet-host-s1"), F.lit("fleet-0123456789abcdef"))).otherwise(F.array(F.lit("self-hosted")))
    runner = F.when(F.col("kind") == "R", F.concat(F.lit("fleet-0123456789ab-"), F.substring(F.sha1(i.cast("string").cast("binary")), 1, 16)))
    runner = F.when((i % 4 == 1) & (F.col("kind") == "R"), "own-1").otherwise(runner)
    raw = s.select(
        F.concat_ws("-", "run", "n").alias("id"), i.alias("run_id"), F.lit(1).alias("run_attempt"), F.concat(F.lit("pr-build / "), F.col("n").cast("string")).alias("name"), text.alias("status"), text.alias("conclusion"), F.lit("2024-01-01T00:00:00Z").alias("created_at"), text.alias("started_at"), text.alias("completed_at"), text.alias("runner_kind"),
        labels.alias("labels"), runner.alias("runner_name"), F.lit(None).cast("long").alias("runner_id"), (F.col("wait_s") > 25).alias("assigned"), F.lit(None).cast("array<struct<name:string,started_at:string,completed_at:string,conclusion:string>>").alias("steps"), text.alias("failure_class"), F.lit(None).cast("array<string>").alias("failure_excerpt"),
        F.lit(None).cast("double").alias("weight"), F.lit(None).cast("boolean").alias("estimated"), F.concat(F.lit("https://x/check-runs/"), i * 10 + F.col("n")).alias("check_run_url"),
    )
    out = L.normalize_jobs(raw, hosts=L.Hosts({"0123456789abcdef": "north"}, {"s1": "south"}))
    return out.select("id", "name", "assigned", "check_run", "kind")


_TITLE = "case when id % 2 = 0 then 'bors branch=main batch=' || id || ' head=' || sha1(id::varchar) || ' base=' || sha1('b' || id) else 'manual ' || id end"
_EVENT = "case kind when 'click' then 'pull_request' when 'view' then 'push' when 'purchase' then 'merge_group' when 'error' then 'repository_dispatch' else 'schedule' end"


def titled(spark, d):
    title = F.when(F.col("id") % 2 == 0, F.concat(F.lit("bors branch=main batch="), "id", F.lit(" head="), F.sha1(F.col("id").cast("string").cast("binary")), F.lit(" base="), F.sha1(F.concat(F.lit("b"), "id").cast("binary")))).otherwise(F.concat(F.lit("manual "), "id"))
    event = F.when(F.col("kind") == "click", "pull_request").when(F.col("kind") == "view", "push").when(F.col("kind") == "purchase", "merge_group").when(F.col("kind") == "error", "repository_dispatch").otherwise("schedule")
    return jobs(spark, d).select("id", "kind", title.alias("title"), event.alias("event"))


@query(f"select id, case when id % 10 = 3 then 'manual' else case {_EVENT} when 'pull_request' then 'pr' when 'push' then 'push' when 'merge_group' then 'merge_queue' when 'repository_dispatch' then case when id % 3 = 0 then 'repository_dispatch' when id % 2 = 0 then 'bors_staging' else 'bors_unknown' end else 'schedule' end end as trigger from jobs")
def derive_trigger(spark, d):
    """Some runs have a trigger of their own, and a third of all belong to a workflow that is not the staging one."""
    workflow, given = F.when(F.col("id") % 3 == 0, "nightly.yml").otherwise("staging.yml"), F.when(F.col("id") % 10 == 3, "manual")
    return titled(spark, d).select("id", C.derive_trigger(F.col("event"), F.col("title"), workflow, given, "staging.yml").alias("trigger"))


@query(f"select id, case when kind = 'error' and id % 2 = 0 then sha1(id::varchar) end as head, case when kind = 'error' and id % 2 = 0 then id end as batch from jobs")
def batch_identity(spark, d):
    ok = (F.col("event") == "repository_dispatch") & F.col("title").rlike("head=[0-9a-f]{40}( |$)")
    return titled(spark, d).select("id", F.when(ok, F.regexp_extract("title", "head=([0-9a-f]{40})", 1)).alias("head"), F.when(ok, F.regexp_extract("title", "batch=([0-9]+)", 1).cast("long")).alias("batch"))


@query("select id, case id % 5 when 0 then 'unknown' when 1 then 'self-hosted' when 2 then 'namespace' when 3 then 'github' else 'self-hosted' end as kind from jobs")
def runner_kind(spark, d):
    labels = F.when(F.col("id") % 5 == 1, F.array(F.lit("linux"), F.lit("self-hosted"))).when(F.col("id") % 5 == 2, F.array(F.lit("nscloud-16x32"))).when(F.col("id") % 5 == 3, F.array(F.lit("ubuntu-24.04"))).when(F.col("id") % 5 == 4, F.array(F.lit("custom")))
    return jobs(spark, d).select("id", C.runner_kind(labels).alias("kind"))


@query("with l as (select id, unnest([run % 30, id % 30]) as label from jobs), a as (select id, min(n_regionkey) as alias from l join nation on n_nationkey = label group by id having count(distinct n_regionkey) = 1) select jobs.id, alias from jobs left join a using (id)")
def host_alias(spark, d):
    dim = read(spark, d, "nation").select(F.col("n_nationkey").alias("label"), F.col("n_regionkey").alias("alias"))
    rows = jobs(spark, d).select("id", F.array(F.col("run") % 30, F.col("id") % 30).alias("labels"))
    return J.unique_lookup(rows, "id", "labels", dim, "label", "alias").select("id", "alias")


@query("select id, case when id % 4 = 0 then case run % 3 when 0 then 'pr_build' when 1 then 'staging_build' else 'other_build' end when id % 4 = 1 then 'control' when id % 4 = 2 then 'maintenance' else 'other' end as class from jobs")
def job_class(spark, d):
    trigger = F.when(F.col("run") % 3 == 0, "pr").when(F.col("run") % 3 == 1, "bors_staging").otherwise("push")
    k = F.col("id") % 4
    return jobs(spark, d).select("id", C.job_class(k == 0, trigger, k == 1, k == 2).alias("class"))


@query("select doc_id, left(regexp_replace(text, '[\\x00-\\x1f]', ' ', 'g'), 80) as title from documents")
def public_projection(spark, d):
    return read(spark, d, "documents").select("doc_id", F.left(F.regexp_replace("text", r"[\x00-\x1f]", " "), F.lit(80)).alias("title"))


@query("""with x as (select run, kind || chr(32) || module as name, wait_s > 45 as live, row_number() over (partition by run order by n, wait_s, kind, module) as i, conclusion from steps), r as (select *, row_number() over (partition by run, live order by i) as up, row_number() over (partition by run, live order by i desc) as down from x),
    shown as (select *, row_number() over (partition by run order by live desc, i) as p from r where live or down <= 2)
    select run, string_agg(name || case when live then '*' else '' end, ',' order by p) as shown, count(*) as n from shown where p <= 3 group by run""")
def public_steps(spark, d):
    """Three steps of a run that a page shows: those that run, then the last two of all others."""
    one = F.struct(F.concat("kind", F.lit("\t"), F.col("module").cast("string")).alias("name"), F.lit(1).alias("started"), F.when(F.col("wait_s") <= 45, 2).alias("completed"), "conclusion")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("n", "wait_s", "kind", "module", one.alias("s")))), lambda x: x["s"])
    rows = steps(spark, d).groupBy("run").agg(C.public_steps(ordered, 3).alias("p"))
    label = lambda s: F.concat(s["name"], F.when(s["completed"].isNull(), "*").otherwise(""))
    return rows.select("run", F.array_join(F.transform("p", label), ",").alias("shown"), F.size("p").cast("long").alias("n"))


@query("select run, n, case n when 1 then 'setup and checks' when 2 then 'Mathlib cache' when 3 then 'Lake cache' when 4 then 'lint preparation' when 5 then 'build, audits, lints' when 6 then 'reporting' else 'setup and checks' end as phase, case n when 1 then 'build' when 2 then 'audits' when 3 then 'lints' end as telemetry from steps")
def step_phase(spark, d):
    names = F.create_map(*[F.lit(x) for kv in {1: "Checkout", 2: "Fetch Mathlib", 3: "Restore Lake archive", 4: "Dot-notation lint", 5: "Build exact candidate", 6: "Post cache"}.items() for x in kv])
    phases = F.create_map(*[F.lit(x) for kv in {1: "stage-cache", 2: "audit-axioms", 3: "lint-env", 4: "other"}.items() for x in kv])
    return steps(spark, d).select("run", "n", C.step_phase(F.coalesce(F.try_element_at(names, F.col("n")), F.lit("Lint"))).alias("phase"), C.telemetry_group(F.try_element_at(phases, F.col("n"))).alias("telemetry"))


@query("""select id, case when id % 5 = 1 then case when id % 4 <> 0 then 'gh-other' when run % 3 = 0 then 'gh-build-pr' else 'gh-build-other' end when id % 5 = 2 then 'self-hosted' when id % 5 = 3 then 'rack-' || run % 2
    when run % 3 = 1 then 'ns-mq' when run % 3 = 0 then 'ns-pr' else 'ns-other' end as series from jobs""")
def series_key(spark, d):
    trigger = F.when(F.col("run") % 3 == 0, "pr").when(F.col("run") % 3 == 1, "bors_staging").otherwise("push")
    k = F.col("id") % 5
    kind = F.when(k == 1, "github").when(k == 2, "self-hosted").when(k == 3, F.concat(F.lit("rack-"), F.col("run") % 2)).when(k == 4, "namespace").otherwise("unknown")
    return jobs(spark, d).select("id", C.series_key(kind, trigger, F.col("id") % 4 == 0).alias("series"))


_TAILS = {0: " error: Lean exited with code 137", 1: " operation timed out", 2: " LINT-ENV: FAIL", 3: " uses Axiom x", 4: " ERR_LIN"}
_STEPS = {0: "Build exact candidate", 1: "Build", 2: "Report", 3: "Checkout", 4: "Restore cache", 5: "Reject option overrides"}
_ENDS = {0: "success", 1: "cancelled", 2: "timed_out", 3: "neutral"}


def _case(of, labels, rest):
    out = F.lit(rest)
    for k, label in labels.items():
        out = F.when(of == k, label).otherwise(out)
    return out


def _sql_case(of: str, labels: dict, rest: str) -> str:
    return f"case {of} " + " ".join(f"when {k} then '{v}'" for k, v in labels.items()) + f" else '{rest}' end"


def logs(spark, d):
    """Documents as logs: each line gets a telling end, every seventh log is missing, every ninth only has noise."""
    i = F.col("doc_id")
    body = F.transform(F.split("text", "\n"), lambda x: F.concat(F.when(i % 9 == 0, "+ ").otherwise("> "), x, _case(i % 6, _TAILS, "")))
    return read(spark, d, "documents").select("doc_id", F.when(i % 7 != 0, body).alias("lines"), _case(i % 8, _STEPS, "Lint").alias("step"), _case(i % 11, _ENDS, "failure").alias("conclusion"))


_FAILURE = f"""f as (select doc_id, case when doc_id % 7 <> 0 then list_filter(list_transform(string_split(text, chr(10)), lambda x: case when doc_id % 9 = 0 then '+ ' else '> ' end || x || {_sql_case('doc_id % 6', _TAILS, '')}), lambda x: not regexp_matches(x, '^(?:✔(?:\\s|$)|\\+\\+?\\s)')) end as told,
      {_sql_case('doc_id % 8', _STEPS, 'Lint')} as step, {_sql_case('doc_id % 11', _ENDS, 'failure')} as conclusion from documents),
    c as (select doc_id, case when conclusion in ('success', 'neutral') then null when conclusion = 'cancelled' then 'cancelled' when conclusion = 'timed_out' then 'timeout'
      when step in ('Build exact candidate', 'Build') then case when doc_id % 7 = 0 then 'build-unknown'
        {" ".join(f"when len(list_filter(told, lambda x: regexp_matches(x, '{p}'))) > 0 then '{label}'" for p, label in C.LOG_RULES)} else 'lean-error' end
      when step = 'Report' then 'infra-report' when step = 'Checkout' then 'infra-setup' when step = 'Restore cache' then 'infra-cache' when step = 'Reject option overrides' then 'policy' else 'other' end as class from f)"""


@query(f"with {_FAILURE} select doc_id, class from c")
def failure_class(spark, d):
    return logs(spark, d).select("doc_id", C.failure_class(F.col("conclusion"), F.col("step"), F.col("lines")).alias("class"))


@query(f"with {_FAILURE} select doc_id, case when doc_id % 7 <> 0 then class else 'kept-' || doc_id % 3 end as class from c")
def reclassify(spark, d):
    rows = logs(spark, d)
    fresh = C.failure_class(F.col("conclusion"), F.col("step"), F.col("lines"))
    return rows.select("doc_id", F.when(F.col("lines").isNotNull(), fresh).otherwise(F.concat(F.lit("kept-"), F.col("doc_id") % 3)).alias("class"))


@query("""with l as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos from documents),
    e as (select *, row_number() over (partition by doc_id order by pos) as k from l where regexp_matches(line, '(?i)error|er[a-z]*on'))
    select doc_id, string_agg(line, chr(10) order by pos) as excerpt, count(*) as lines from e where k <= 30 group by doc_id""")
def log_excerpt(spark, d):
    return records.log_excerpt(read(spark, d, "documents"), "doc_id", "text", "(?i)error|er[a-z]*on", 30)


@query("select run, case when run % 10 = 0 then 'unknown' when bool_or(module % 40 = 0) then 'dependency-bump' else 'ordinary' end as cohort from steps group by run")
def change_cohort(spark, d):
    paths = F.collect_set(F.concat(F.lit("f"), F.col("module") % 40))
    rows = steps(spark, d).groupBy("run").agg(paths.alias("paths"))
    return rows.select("run", C.change_cohort(F.col("paths"), F.col("run") % 10 == 0, ["f0"]).alias("cohort"))


@query("select run, case when head < 50 then '<50' when head < 200 then '50-199' when head < 500 then '200-499' else '500+' end as bucket from runs")
def size_bucket(spark, d):
    return runs(spark, d).select("run", C.size_bucket(F.col("head")).alias("bucket"))


@query("select run, case when head - 5 <= 10 then '1-10' when head - 5 <= 50 then '11-50' when head - 5 <= 200 then '51-200' else '>200' end as bucket from runs")
def moved_bucket(spark, d):
    return runs(spark, d).select("run", C.moved_bucket(F.col("head") - 5).alias("bucket"))


@query("select id, ('0x' || substr(sha256(id::varchar), 1, 16))::ubigint::double / 18446744073709551616.0::double as u from jobs")
def hash_draw(spark, d):
    return jobs(spark, d).select("id", C.hash_draw(F.col("id").cast("string")).alias("u"))


@query("select id, id % 20 = 0 as kept, id % 4 = 0 as kept_aux from jobs")
def modulo_sample(spark, d):
    return jobs(spark, d).select("id", C.modulo_sample(F.col("id"), 20).alias("kept"), C.modulo_sample(F.col("id"), 4).alias("kept_aux"))


@query("select id, case when isfinite(x) and x >= 0 then x end as value from (select id, case id % 5 when 0 then 'nan'::double when 1 then -value when 2 then 'inf'::double else value end as x from jobs)")
def finite_counter(spark, d):
    raw = F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).when(F.col("id") % 5 == 1, -F.col("value")).when(F.col("id") % 5 == 2, F.lit(float("inf"))).otherwise(F.col("value"))
    return jobs(spark, d).select("id", C.finite_counter(raw).alias("value"))


@query("select run, string_agg(n || ':' || wait_s, ',' order by n, wait_s) as steps from steps group by run")
def struct_prune(spark, d):
    nested = steps(spark, d).groupBy("run").agg(F.collect_list(F.struct("n", "wait_s", "run_s", "kind", "size")).alias("steps"))
    pruned = nested.select("run", F.array_sort(F.transform("steps", lambda s: F.struct(s["n"].alias("n"), s["wait_s"].alias("wait_s")))).alias("steps"))
    return pruned.select("run", F.array_join(F.transform("steps", lambda s: F.concat(s["n"], F.lit(":"), s["wait_s"])), ",").alias("steps"))


@query("""select id, sha256('{"a":' || a || ',"id":' || id || ',"in":[{"k":"' || kind || '","r":' || run || '},null],"kind":"' || kind || '"}') as fingerprint from jobs""")
def canonical_fingerprint(spark, d):
    """Documents whose keys come in two orders, at both depths."""
    text = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    c = {n: F.col(n).cast("string") for n in ("id", "a", "run", "kind")}
    one = text('{"kind":"', c["kind"], '", "in":[{"r":', c["run"], ',"k":"', c["kind"], '"}, null],"id":', c["id"], ',"a":', c["a"], "}")
    other = text('{"id":', c["id"], ',"in":[{"k":"', c["kind"], '","r":', c["run"], '},null],"a":', c["a"], ',"kind":"', c["kind"], '"}')
    return jobs(spark, d).select("id", F.sha2(G.canonical(F.when(F.col("id") % 2 == 0, one).otherwise(other)), 256).alias("fingerprint"))


@query("""with h as (select sha256(id || ':' || kind) as h from jobs), s as (select sum(('0x' || substr(h, 1, 15))::bigint) as a, sum(('0x' || substr(h, 16, 15))::bigint) as b, sum(('0x' || substr(h, 31, 15))::bigint) as c, sum(('0x' || substr(h, 46, 15))::bigint) as d, count(*) as n from h)
    select sha256(concat_ws(':', a, b, c, d, n)) as fingerprint, n from s""")
def table_fingerprint(spark, d):
    return records.table_fingerprint(jobs(spark, d).select(F.sha2(F.concat_ws(":", "id", "kind"), 256).alias("h")), "h")


@query("select id, strftime(make_timestamp(a - a % 1000000), '%Y-%m-%dT%H:%M:%SZ') as iso, make_date(1970, 1, 1) + cast(a // 86400000000 as integer) as day, case when id % 4 = 0 then 0 else a - a % 1000000 end as back from jobs")
def iso_time(spark, d):
    rows = jobs(spark, d).withColumn("iso", C.iso_time(F.col("a")))
    return rows.select("id", "iso", C.utc_day(F.col("a")).alias("day"), C.iso_micros(F.when(F.col("id") % 4 == 0, "not a time").otherwise(F.col("iso"))).alias("back"))


# Quality gates


def payloads(spark, d):
    j = jobs(spark, d)
    body = F.to_json(F.struct(F.col("id").alias("id"), F.when(F.col("id") % 7 != 0, F.col("kind")).alias("kind"), F.when(F.col("id") % 11 == 0, -F.col("value")).otherwise(F.col("value")).alias("value"), F.when(F.col("id") % 13 == 0, F.lit("x")).alias("extra")))
    return j.select("id", F.when(F.col("id") % 17 == 0, F.lit("[1]")).otherwise(body).alias("payload"))


SPEC = {"id": V.Field("integer", low=0), "kind": V.Field("string", values=("click", "view", "purchase", "signup")), "value": V.Field("number", low=0, high=400)}


@query("""select id, case when id % 17 = 0 then 'not-an-object' when id % 13 = 0 then 'unknown:extra' when id % 7 = 0 then 'missing:kind' when kind = 'error' then 'enum:kind' when id % 11 = 0 and value > 0 then 'range:value' when value > 400 then 'range:value' end as reason from jobs
    where id % 17 = 0 or id % 13 = 0 or id % 7 = 0 or kind = 'error' or (id % 11 = 0 and value > 0) or value > 400""")
def validate_strict(spark, d):
    return V.validate_strict(payloads(spark, d), "payload", SPEC)[1].select("id", "reason")


@query("select run, n, case when not (run_s >= wait_s) then 'order' when not (size = 'O' or kind <> 'N') then 'pairing' when n > 6 then 'count' end as reason from steps")
def validate_cross_field(spark, d):
    tests = [("order", F.col("run_s") >= F.col("wait_s")), ("pairing", (F.col("size") == "O") | (F.col("kind") != "N")), ("count", F.col("n") <= 6)]
    return V.check_rows(steps(spark, d), tests).select("run", "n", "reason")


_UUID, _HASH = "01234567-89ab-cdef-0123-456789abcdef", "a" * 40


def _json(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@query("""select tm, case when len(items) > 20 then 'range:collection_counts.tasks' when len(list_filter(items, lambda x: x % 37 = 0)) > 0 then 'pattern:active_batch_ids[' || (list_position(items, list_filter(items, lambda x: x % 37 = 0)[1]) - 1) || ']'
    when tm // 600000000 % 5 = 0 then 'enum:conditions[0].since' when tm // 600000000 % 3 <> 0 and items[1] < 5 then 'range:workers[0].tasks' when tm // 600000000 % 7 = 0 then 'config-revision:' end as reason from snaps""".replace("enum:conditions[0].since", "time:conditions[0].since"))
def validate_metadata(spark, d):
    """What closes a snapshot, per snapshot of the queue."""
    k, n, first = F.floor(F.col("tm") / 600_000_000), F.size("items"), F.col("items")[0]
    ids = F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: F.concat(F.lit('"'), F.when(x % 37 == 0, "x").otherwise(x.cast("string")), F.lit('"'))), ","), F.lit("]"))
    flags = ",".join(f'"{c}":true' for c in G.COLLECTIONS)
    counts = ",".join(f'"{c}":0' for c in G.COLLECTIONS if c != "tasks")
    payload = _json(
        '{"schema":"q","coverage":"observed","observed_at":"2024-01-01T00:00:00Z","status_observed_at":null,"source_revision":"r","canonical_sha":"' + _HASH + '","truncated":false,"event_history_truncated":false,"claim_history_truncated":false,"scope":{"repositories":["o/a"]},',
        '"dispatch_config":{"repository":"o/a","revision":"', F.when(k % 7 == 0, "b" * 40).otherwise(_HASH), '","namespace_build_cap":1,"pr_order":["x"],"staging_order":["y","z"]},"service":{"revision":"x","started_at":"","mode":"shadow","controller":"running","publication_enabled":null},"collection_counts":{', counts, ',"tasks":', n * 1000,
        '},"collection_complete":{' + flags + '},"retained_batch_ids":[],"active_batch_ids":', ids, ',"conditions":[{"kind":"c","since":"', F.when(k % 5 == 0, "soon").otherwise("2024-01-01T00:00:00Z"), '"}],"outbox":null,"settings":{},"claims":[],"workers":[{"id":"worker-1","coverage":"', F.when(k % 3 == 0, "unavailable").otherwise("observed"),
        '","observed_at":null,"state":"s","started_at":null,"tasks":', first - 5, ',"errors":null}]}',
    )
    return G.gated(snapshots(spark, d).select("tm", payload.alias("p")), "p", G.metadata_gate("q", ["o/a"])).select("tm", "reason")


@query("""with x as (select run, row_number() over (partition by run order by n, wait_s, kind, module) - 1 as i, case when kind = 'N' and wait_s % 13 = 0 then 'pattern:changes[' || (row_number() over (partition by run order by n, wait_s, kind, module) - 1) || '].value.batch_id'
      when kind = 'N' and wait_s % 17 = 0 then 'identity:changes[' || (row_number() over (partition by run order by n, wait_s, kind, module) - 1) || ']' end as why from steps)
    select run, coalesce(case when run % 19 = 0 then 'pattern:snapshot' end, case when count(*) > 6 then 'range:part' end, arg_min(why, i) filter (where why is not null), case when run % 3 = 0 then 'missing:metadata' when run % 3 = 1 then 'part:' end) as reason from x group by run""")
def validate_frame(spark, d):
    """A run as a frame, its steps as changes: broken identities, values and parts, and last parts without metadata."""
    rows = steps(spark, d).groupBy("run").agg(F.array_sort(F.collect_list(F.struct("n", "wait_s", "kind", "module"))).alias("c"))
    event = lambda x: _json('{"id":"', F.when(x["wait_s"] % 17 == 0, "0").otherwise(x["n"].cast("string")), '","at":null,"kind":"k","batch_id":"', F.when(x["wait_s"] % 13 == 0, "b").otherwise(x["module"].cast("string")), '"}')
    change = lambda x: _json('{"collection":"', F.when(x["kind"] == "N", "events").otherwise("tasks"), '","id":"', x["n"], '","value":', F.when(x["kind"] == "N", event(x)).otherwise("null"), "}")
    part = F.when(F.size("c") > 6, -1).when(F.col("run") % 3 == 0, 2).when(F.col("run") % 3 == 1, 3).otherwise(0)
    payload = _json('{"schema":"f","snapshot":"', F.when(F.col("run") % 19 == 0, "x").otherwise(_UUID), '","base":null,"source":{"id":"' + _UUID + '","epoch":1,"sequence":1},"parts":3,"part":', part, ',"changes":[', F.array_join(F.transform("c", change), ","), "]}")
    event_gate = G.Object({"id": G.Text(pattern=G.IDENTITY), "at": G.Stamp(), "kind": G.Text(), "batch_id": G.Text(pattern=G.IDENTITY)})
    return G.gated(rows.select("run", payload.alias("p")), "p", G.frame_gate("f", G.metadata_gate("q", ["o/a"]), {"events": event_gate})).select("run", "reason")


@query("""select id, case when id % 23 = 0 then 'not-json' when id % 19 = 0 then 'unknown:more' when id % 7 = 0 then 'range:sequence' when kind = 'error' then 'enum:phase' when id % 11 = 3 then 'range:failed_modules' when id % 13 = 5 then 'type:cpu_seconds'
    when id % 17 = 2 then 'pattern:source_revision' when id % 90 > id % 100 then 'task-counter:' end as reason from jobs""")
def validate_progress(spark, d):
    i = F.col("id")
    payload = _json(
        '{"schema":"p","session":"' + _UUID + '","sequence":', i % 7, ',"observed_at":null,"phase":"', F.when(F.col("kind") == "error", "rest").otherwise("build"), '","completed_modules":', F.col("run"), ',"failed_modules":', F.when(i % 11 == 3, -1).otherwise(0), ',"last_module":null,"last_progress_at":null,"active_compilers":null,"cpu_seconds":',
        F.when(i % 13 == 5, '"x"').otherwise(F.col("value").cast("string")), ',"source_revision":"', F.when(i % 17 == 2, "abc").otherwise(""), '","completed_tasks":', i % 90, ',"total_tasks":', i % 100, F.when(i % 19 == 0, ',"more":1').otherwise(""), F.when(i % 23 == 0, "").otherwise("}"),
    )
    return G.gated(jobs(spark, d).select("id", payload.alias("p")), "p", G.progress_gate("p", "^Lib")).select("id", "reason")


_LISTED = "row_number() over (partition by run order by n, wait_s, kind, module) - 1"


@query(f"""with x as (select run, n, {_LISTED} as i, case when module % 29 = 0 then 'pattern:hosts[' || ({_LISTED}) || '].source_revision' when wait_s = 50 then 'range:hosts[' || ({_LISTED}) || '].resources.cpus'
      when module % 31 = 0 then 'pattern:hosts[' || ({_LISTED}) || '].slots[0].runner_id' when n > 4 then 'not-public:hosts[' || ({_LISTED}) || ']' end as why from steps)
    select run, coalesce(case when run % 37 = 0 then 'time:observed_at' end, arg_min(why, i) filter (where why is not null), case when count(distinct n) < count(*) then 'repeated-host:' when count(*) <> 4 then 'registry-coverage:' end) as reason from x group by run""")
def validate_hosts(spark, d):
    """A run as a sample of hosts, its steps as hosts, of which four are public."""
    rows = steps(spark, d).groupBy("run").agg(F.array_sort(F.collect_list(F.struct("n", "wait_s", "kind", "module"))).alias("h"))
    slot = lambda x: _json('{"slot":1,"instance_id":null,"runner_id":"', F.when(x["module"] % 31 == 0, "r").otherwise(x["module"].cast("string")), '","runner_name":"r","phase":"p","busy":true,"started_at":null,"vcpus":1,"memory_gib":2}')
    host = lambda x: _json(
        '{"machine_id":"', F.lpad(x["n"].cast("string"), 32, "0"), '","alias":"h', x["n"], '","observed_at":null,"transport_at":null,"connected":true,"coverage":"observed","source_revision":"', F.when(x["module"] % 29 == 0, "r").otherwise(""), '","controller_error":false,"ci_enabled":null,"workers_enabled":null,"memory_pressure":null,',
        '"slots_truncated":false,"workers_truncated":false,"ci_max_jobs":1,"worker_limit":1,"cpu_idle_fraction":0.5,"resources":{"cpus":', F.when(x["wait_s"] == 50, -1).otherwise(x["wait_s"]), ',"memory_total":1,"memory_available":1},"compiler":{"observed_at":null,"waiting_guests":0,"guests":0,"healthy":true},"slots":[', slot(x), '],"workers":[]}',
    )
    payload = _json('{"schema":"h","source":{"id":"' + _UUID + '","epoch":1,"sequence":1},"observed_at":"', F.when(F.col("run") % 37 == 0, "soon").otherwise("2024-01-01T00:00:00Z"), '","hosts":[', F.array_join(F.transform("h", host), ","), "]}")
    return G.gated(rows.select("run", payload.alias("p")), "p", G.hosts_gate("h", [(f"{k:032d}", f"h{k}") for k in range(1, 5)])).select("run", "reason")


@query(f"""with x as (select run, {_LISTED} as i, case when wait_s = 1 then 'range:windows[' || ({_LISTED}) || '].hours' when module % 23 = 0 then 'enum:windows[' || ({_LISTED}) || '].summary.cost.coverage' when wait_s = 50 then 'pattern:windows[' || ({_LISTED}) || '].heads[0].batch_id' end as why from steps),
    g as (select run, count(*) as n, arg_min(why, i) filter (where why is not null and i < 3) as why from x group by run)
    select run, case when run % 29 = 0 then 'enum:coverage' when n > 6 then 'count:windows' when why is not null then why when run % 37 = 0 then 'range:baseline.hours' when run % 31 = 0 then 'count:limits' end as reason from g""")
def validate_history(spark, d):
    """A run as a history, its first steps as windows; runs of seven steps have too many."""
    rows = steps(spark, d).groupBy("run").agg(F.array_sort(F.collect_list(F.struct("n", "wait_s", "kind", "module"))).alias("w"))
    measures = ",".join([f'"{n}":1' for n in G.MEASURES] + [f'"{n}":{{"count":1,"max":2}}' for n in G.DISTRIBUTIONS])
    window = lambda x: _json(
        '{"key":"24h","label":"l","from":"2024-01-01T00:00:00Z","until":"2024-01-02T00:00:00Z","hours":', x["wait_s"] - 2, ',"summary":{' + measures + ',"cost":{"coverage":"', F.when(x["module"] % 23 == 0, "all").otherwise("recorded_subtotal_only"), '","recorded_usd":null,"recorded_attempts":1,"unknown_attempts":0}},"heads":[{"batch_id":"',
        F.when(x["wait_s"] == 50, "b").otherwise(x["n"].cast("string")), '","size":', x["wait_s"], '}],"heads_truncated":false}',
    )
    windows = F.when(F.size("w") > 6, F.col("w")).otherwise(F.slice("w", 1, 3))
    payload = _json(
        '{"schema":"y","coverage":"', F.when(F.col("run") % 29 == 0, "partial").otherwise("observed"), '","observed_at":"2024-01-01T00:00:00Z","scope":{"repositories":["o/a"]},"windows":[', F.array_join(F.transform(windows, window), ","), '],"baseline":{"hours":', F.when(F.col("run") % 37 == 0, -1).otherwise(1),
        '},"limits":[', F.when(F.col("run") % 31 == 0, ",".join(['"x"'] * 11)).otherwise('"x"'), "]}",
    )
    return G.gated(rows.select("run", payload.alias("p")), "p", G.history_gate("y", ["o/a"])).select("run", "reason")


@query("""with x as (select run, row_number() over (partition by run order by n, wait_s, kind, module) - 1 as i, case when module % 29 = 0 then 'length' when wait_s = 50 then 'range' end as why, module from steps),
    w as (select run, min(i) filter (where why is not null) as i from x group by run)
    select w.run, case when x.why = 'length' then 'length:phases[' || w.i || '].phase' when x.why = 'range' then 'range:phases[' || w.i || '].seconds' when w.run % 31 = 0 then 'pattern:failure' end as reason from w left join x on x.run = w.run and x.i = w.i""")
def validate_telemetry(spark, d):
    """Phases of a run: names that are too long, times of over a week, failures that are no class."""
    rows = steps(spark, d).groupBy("run").agg(F.array_sort(F.collect_list(F.struct("n", "wait_s", "kind", "module"))).alias("p"))
    phase = lambda p: _json('{"phase":"', F.when(p["module"] % 29 == 0, "x" * 81).otherwise(p["kind"]), '","seconds":', F.when(p["wait_s"] == 50, 604_801).otherwise(p["wait_s"]), "}")
    payload = _json('{"phases":[', F.array_join(F.transform("p", phase), ","), '],"failure":', F.when(F.col("run") % 31 == 0, '"Not a class"').otherwise("null"), ',"coverage":"x"}')
    return G.gated(rows.select("run", payload.alias("p")), "p", G.telemetry_gate()).select("run", "reason")


@query("""with x as (select run, row_number() over (partition by run order by n, wait_s, kind, module) - 1 as i, module, wait_s from steps), w as (select run, min(i) filter (where module % 37 = 0 or wait_s = 49) as i from x group by run)
    select r.run, case when x.wait_s = 49 then 'time:jobs[' || w.i || '].created_at' when x.module % 37 = 0 then 'job-id:jobs[' || w.i || ']' when repo = 'repo4' and not (r.run % 2 = 0) or repo = 'repo3' then 'repository:' when r.run % 41 = 0 then 'run-id:' when r.run % 43 = 0 and r.run % 2 = 1 then 'sampling:' end as reason
    from runs r left join w using (run) left join x on x.run = w.run and x.i = w.i""")
def validate_event(spark, d):
    """Deliveries of runs with their jobs: repositories that are listed, were once, or never; numbers, times and samplings."""
    at = "2024-01-01T00:00:00Z"
    content = steps(spark, d).groupBy("run").agg(F.array_sort(F.collect_list(F.struct("n", "wait_s", "kind", "module"))).alias("j"))
    job = lambda x: _json('{"id":"', F.when(x["module"] % 37 == 0, "m").otherwise(x["module"].cast("string")), '","created_at":"', F.when(x["wait_s"] == 49, "then").otherwise(at), '"}')
    i = F.col("run")
    payload = _json(
        '{"delivery":"d","repo":"', F.col("repo"), '","historical":', F.when(i % 2 == 0, "true").otherwise("false"), ',"run":{"id":', F.when(i % 41 == 0, '"r"').otherwise(i.cast("string")), ',"created_at":"' + at + '"', F.when(i % 43 == 0, ',"archive_sampling":{"until":1,"weight":2}').otherwise(""),
        '},"jobs":[', F.coalesce(F.array_join(F.transform("j", job), ","), F.lit("")), "]}",
    )
    rows = runs(spark, d).join(content, "run", "left").select("run", payload.alias("p"))
    return G.gated(rows, "p", G.event_gate(["repo0", "repo1", "repo2"], ["repo4"])).select("run", "reason")


@query("select id, case when id % 10 = 0 then 'missing' when id % 9 = 0 then 'expired' when id % 8 = 0 then 'unavailable' when kind = 'error' then 'unverified-producer' when value <= 50 then 'invalid-or-unavailable' else 'present' end as coverage from jobs")
def observation_coverage(spark, d):
    artifact, producer = F.when(F.col("id") % 10 != 0, F.col("id")), F.when(F.col("id") % 8 != 0, F.col("kind"))
    coverage = V.observation_coverage(artifact, F.col("id") % 9 == 0, producer, ["click", "view", "purchase", "signup"], F.col("value") > 50)
    return jobs(spark, d).select("id", coverage.alias("coverage"))


@query("select page_id, len(html) as size, lower(regexp_extract(url, '^[a-z]+://([^/]+)', 1)) as host, row_number() over (partition by lower(regexp_extract(url, '^[a-z]+://([^/]+)', 1)) order by len(html) desc, page_id) as rank from pages")
def ranked_payloads(spark, d):
    host = F.lower(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1))
    rows = read(spark, d, "pages").select("page_id", F.length("html").cast("long").alias("size"), host.alias("host"))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("host").orderBy(F.desc("size"), "page_id")).cast("long"))
