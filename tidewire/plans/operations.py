"""Registered queries over tasks, workers, proxies, queues and configurations; each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F


from ..operators import dedup, folds, joins, ops
from ..sources import tables
from ..sources.tables import NOW, one_of, table, task_metrics
from .queries import TASKS, query

AT = f"timestamp '{NOW}'"


def _now():
    return F.lit(NOW).cast("timestamp")


RUNS = "runs as (select event_id as task_id, user_id % 16 as worker_id, ts, event_type, value, (value * 100)::bigint as seconds, case when event_type = 'error' then 'failed' else 'completed' end as status, event_id % 1500 as memory, event_id % 101 as cpu from events)"


def _runs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("task_id"), (F.col("user_id") % 16).alias("worker_id"), F.col("ts").cast("timestamp").alias("ts"), "event_type", F.round(F.col("value") * 100).cast("long").alias("seconds"),
        F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"), (F.col("event_id") % 1500).alias("memory"), (F.col("event_id") % 101).alias("cpu"),
    )


@query(f"with {RUNS}, a as (select task_id, unnest(list_filter([case when seconds > 3600 then 'task_timeout' end, case when status = 'failed' then 'task_failed' end, case when memory > 1024 then 'high_memory_usage' end, case when cpu > 90 then 'high_cpu_usage' end], lambda x: x is not null)) as kind from runs) select task_id, kind, case kind when 'task_timeout' then 'high' when 'queue_overflow' then 'high' when 'task_failed' then 'medium' when 'high_memory_usage' then 'medium' else 'low' end as severity from a")
def g9_task_alerts(spark, sf_dir):
    return ops.task_alerts(_runs(spark, sf_dir))


STEPS = "case task_id // 4000 % 4 when 0 then 'submitted' when 1 then 'started' when 2 then case when event_type = 'view' then 'completed' else 'failed' end else case when event_type = 'error' then 'failed' else 'started' end end"


@query(f"""with {RUNS}, e as (select task_id % 4000 as task_id, ts as happened, {STEPS} as event, case when task_id % 2 = 0 then 1 end as own from runs),
o as (select *, lag(event) over (partition by task_id order by happened, coalesce(list_position(['started', 'failed', 'completed'], event), 0)) as prior, bool_or(event = 'completed') over (partition by task_id order by happened, coalesce(list_position(['started', 'failed', 'completed'], event), 0)) as won from e),
g as (select task_id, count(*) filter (not won and event = 'failed' and prior = 'started') as fails, bool_or(won) as done, max(happened) filter (not won and event = 'failed' and prior = 'started') as failed_at, max(happened) filter (not won and event = 'started') as started_at, min(happened) as first_at, coalesce(max(own), 3) as most from o group by task_id),
s as (select *, case when done then 'completed' when fails > most then 'failed' when started_at is not null and coalesce(started_at > failed_at, true) then 'processing' else 'pending' end as status from g),
d as (select *, case when status = 'pending' then coalesce(failed_at, first_at) + to_seconds(case when fails > 0 then 60 * (1 << fails::int) else 0 end) end as due from s)
select task_id, least(fails, most) as retries, status, due, coalesce(due <= timestamp '2024-01-20 00:00:00', false) as eligible from d""")
def g4_task_states(spark, sf_dir):
    step, kind = F.floor(F.col("task_id") / 4000) % 4, F.col("event_type")
    event = F.when(step == 0, "submitted").when(step == 1, "started").when(step == 2, F.when(kind == "view", "completed").otherwise("failed")).otherwise(F.when(kind == "error", "failed").otherwise("started"))
    e = _runs(spark, sf_dir).select((F.col("task_id") % 4000).alias("task_id"), event.alias("event"), F.col("ts").alias("at"), F.when(F.col("task_id") % 2 == 0, 1).alias("max_retries"))
    out = ops.task_states(e, F.lit("2024-01-20 00:00:00").cast("timestamp"))
    return out.withColumn("due", F.col("due").cast("timestamp_ntz"))


PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "normal", "4-NOT SPECIFIED": "low"}
QUEUE = f"queue as (select o_orderkey as task_id, map([{', '.join(f'{chr(39)}{k}{chr(39)}' for k in PRIORITIES)}], [{', '.join(f'{chr(39)}{v}{chr(39)}' for v in PRIORITIES.values())}])[o_orderpriority] as priority, o_orderkey as seq, case when o_orderkey % 3 = 0 then o_orderdate end as scheduled_at, o_orderstatus as status, o_custkey % 8 as site from orders)"


def _queue(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    names = F.create_map(*[F.lit(x) for p in PRIORITIES.items() for x in p])
    return o.select(F.col("o_orderkey").alias("task_id"), names[F.col("o_orderpriority")].alias("priority"), F.col("o_orderkey").alias("seq"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate").cast("timestamp")).alias("scheduled_at"), F.col("o_orderstatus").alias("status"), (F.col("o_custkey") % 8).alias("site"))


@query(f"with {QUEUE} select task_id, priority from queue where priority is not null and (scheduled_at is null or scheduled_at <= timestamp '1995-01-01 00:00:00') order by case priority when 'urgent' then 0 when 'high' then 1 when 'normal' then 2 else 3 end, seq limit 50")
def s8_next_tasks(spark, sf_dir):
    return ops.next_tasks(_queue(spark, sf_dir), 50, F.lit("1995-01-01 00:00:00").cast("timestamp")).select("task_id", "priority")


@query("select user_id as key, next_ts from (select user_id, max(ts) + interval 900 seconds as next_ts from events group by 1) where next_ts <= timestamp '2024-01-30 12:00:00' order by next_ts, user_id limit 5")
def s9_t6_due_refresh(spark, sf_dir):
    last = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("key")).agg((F.max(F.col("ts").cast("timestamp")) + F.make_interval(secs=F.lit(900))).alias("next_ts"))
    return ops.due_refresh(last, F.lit("2024-01-30 12:00:00").cast("timestamp"), 5).select("key", F.col("next_ts").cast("timestamp_ntz").alias("next_ts"))


@query(f"with {QUEUE} select status, priority, count(*) as n from queue group by cube (status, priority)")
def a19_queue_stats(spark, sf_dir):
    return ops.queue_stats(_queue(spark, sf_dir))


WORKERS = "workers as (select s_suppkey as worker_id, ([s_suppkey % 8, s_suppkey % 5, s_suppkey % 8])[1 : 1 + (s_suppkey % 3)::int] as sites, s_suppkey % 97 as cpu, s_suppkey % 89 as memory, (['active', 'busy', 'offline', 'active'])[1 + (s_suppkey % 4)::int] as status from supplier)"


def _workers(spark, sf_dir):
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        k.alias("worker_id"), F.slice(F.array(k % 8, k % 5, k % 8), F.lit(1), (k % 3 + 1).cast("int")).alias("sites"), (k % 97).alias("cpu"), (k % 89).alias("memory"), one_of("s_suppkey", ("active", "busy", "offline", "active")).alias("status"),
    )


@query(f"with {WORKERS} select count(*) as total, count(*) filter (status = 'active') as active, count(*) filter (status = 'busy') as busy, count(*) filter (status = 'offline') as offline, (1000 * sum(cpu) // count(*))::bigint as cpu_milli, (1000 * sum(memory) // count(*))::bigint as memory_milli from workers")
def a18_load_stats(spark, sf_dir):
    return ops.load_stats(_workers(spark, sf_dir))


@query(f"with {WORKERS} select site, count(*) as n from (select unnest(sites) as site from workers) group by site")
def a18_site_distribution(spark, sf_dir):
    return ops.site_distribution(_workers(spark, sf_dir))


@query(f"with {WORKERS}, {QUEUE}, w as (select distinct worker_id, unnest(sites) as site from workers) select task_id, worker_id from queue join w using (site) where task_id % 10 = 0 or priority = 'urgent'")
def j9_capable_workers(spark, sf_dir):
    asked = _queue(spark, sf_dir).where((F.col("task_id") % 10 == 0) | (F.col("priority") == "urgent"))
    return ops.capable_workers(_workers(spark, sf_dir), asked)


@query("""with w as (select s_suppkey as worker_id, ((s_suppkey % 12) * 10000000 + (s_suppkey % 97) * 500000 + (s_suppkey % 89) * 300000 + coalesce(100000000 * (s_suppkey % 5) // nullif(s_suppkey % 5 + s_suppkey % 11, 0), 0) + (case when s_suppkey % 2 = 0 then 0 else 1 end) * 50000000)::bigint as score
from supplier where s_suppkey % 12 < 10 and s_suppkey % 97 <= 90 and s_suppkey % 89 <= 90 and s_suppkey % 400 <= 300) select * from w order by score, worker_id limit 1""")
def o1_best_worker(spark, sf_dir):
    from .queries import g2_worker_scores

    return ops.best_worker(g2_worker_scores(spark, sf_dir))


PROXIES = """proxies as (select c_custkey as proxy_id, c_nationkey as country, c_mktsegment as type, c_custkey % 6 as fails, c_custkey % 101 as rate, c_custkey * 37 % 12000 as ms, c_custkey % 5 > 0 as valid, c_custkey % 40 as total, (c_custkey % 40) * (c_custkey % 7) // 7 as good,
  (['elite', 'anonymous', 'transparent', 'unknown'])[1 + (c_custkey % 4)::int] as anonymity from customer)"""


def _proxies(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("proxy_id"), F.col("c_nationkey").alias("country"), F.col("c_mktsegment").alias("type"), (k % 6).alias("fails"), (k % 101).alias("rate"), (k * 37 % 12000).alias("ms"), (k % 5 > 0).alias("valid"),
        (k % 40).alias("total"), F.expr("(c_custkey % 40) * (c_custkey % 7) div 7").alias("good"), one_of("c_custkey", ("elite", "anonymous", "transparent", "unknown")).alias("anonymity"),
    )


@query(f"with {PROXIES} select count(*) as total, count(*) filter (fails < 3 and rate > 30) as available, (select count(distinct proxy_id) from proxies where fails >= 5) as blacklisted, 1000000 * count(*) filter (fails < 3 and rate > 30) // greatest(count(*), 1) as available_ppm from proxies")
def a20_proxy_pool(spark, sf_dir):
    p = _proxies(spark, sf_dir)
    return ops.proxy_pool_stats(p, p.where("fails >= 5"))


@query(f"with {PROXIES} select count(*) as total, count(*) filter (valid) as valid, 1000000 * count(*) filter (valid) // count(*) as success_ppm, (sum(ms) filter (valid) // count(*) filter (valid))::bigint as mean_ms, count(*) filter (valid and anonymity = 'elite') as elite, count(*) filter (valid and anonymity = 'anonymous') as anonymous, count(*) filter (valid and anonymity = 'transparent') as transparent, count(*) filter (valid and anonymity = 'unknown') as unknown from proxies")
def a21_proxy_validation(spark, sf_dir):
    return ops.proxy_validation_stats(_proxies(spark, sf_dir))


@query(f"with {PROXIES}, n as (select proxy_id, ms, total + 1 as total, good + (case when valid then 1 else 0 end) as good, case when valid then 0 else fails + 1 end as fails, case when proxy_id % 3 > 0 then (ms + 500) / 2 else ms end as after from proxies) select proxy_id, total, good, fails, after::double as ms, fails >= 5 or good * 5 < total as removed from n")
def g5_proxy_after(spark, sf_dir):
    p, c = _proxies(spark, sf_dir), F.col
    after = ops.proxy_after(c("total"), c("good"), c("fails"), c("ms"), c("valid"), F.when(c("proxy_id") % 3 > 0, 500).otherwise(0))
    return p.select("proxy_id", after.alias("a")).select("proxy_id", "a.total", "a.good", "a.fails", F.col("a.ms").cast("double").alias("ms"), "a.removed")


ADVANCED = f"{PROXIES}, scored as (select *, greatest(0, least(1000, 500 + (case when total > 0 then floor(good * 300 / total) else 0 end) + (case when ms > 0 then greatest(0, floor((5000 - ms) * 200 / 5000)) else 0 end) - least(fails * 100, 500)))::bigint as score from proxies)"


def _advanced(spark, sf_dir):
    c = F.col
    return _proxies(spark, sf_dir).withColumn("score", ops.advanced_score(F.lit(500), c("total"), c("good"), c("ms"), c("fails")))


@query(f"with {ADVANCED} select proxy_id, score from scored where score >= 400 and country = 3")
def g6_advanced_scores(spark, sf_dir):
    return _advanced(spark, sf_dir).where((F.col("score") >= 400) & (F.col("country") == 3)).select("proxy_id", "score")


@query(f"with {ADVANCED} select type, count(*) as n, (sum(score) * 1000)::bigint // count(*) as score_milli, count(distinct country) as countries from scored group by type")
def a27_proxy_types(spark, sf_dir):
    return ops.proxy_type_stats(_advanced(spark, sf_dir))


@query(f"with {PROXIES}, b as (select * from proxies order by rate desc, proxy_id limit (select greatest(1, count(*) // 5) from proxies)) select count(*) as n, true as among_best from (select 1)")
def o2_proxy_pick(spark, sf_dir):
    """The pick is random; what is compared is that it is one of the best fifth."""
    p = _proxies(spark, sf_dir)
    n = p.count()
    best = p.orderBy(F.desc("rate"), "proxy_id").limit(max(1, n // 5)).select(F.col("proxy_id").alias("__p"))
    picked = ops.pick_proxies(p, n, 7).join(best, F.col("proxy_id") == F.col("__p"), "left")
    return picked.agg(F.count(F.lit(1)).alias("n"), F.min(F.col("__p").isNotNull()).alias("among_best"))


@query(f"with {PROXIES} select proxy_id from proxies where proxy_id not in (select proxy_id from proxies where fails >= 5) and proxy_id not in (select c_custkey from customer where c_acctbal < 0)")
def j6_not_excluded(spark, sf_dir):
    p, c = _proxies(spark, sf_dir).select("proxy_id", "fails"), table(spark, sf_dir, "customer")
    out = p.where("fails >= 5").select("proxy_id").union(c.where("c_acctbal < 0").select("c_custkey"))
    return joins.unseen(p.select("proxy_id"), out, "proxy_id")


@query("select count(*) as requests, count(*) filter (status < 400) as good, count(*) filter (status >= 400) as bad, (sum(ms * 1000) // count(*))::bigint as latency_milli from (select case when event_type = 'error' then 500 else 200 end as status, event_id % 900 as ms from events)")
def a22_crawl_counters(spark, sf_dir):
    r = table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"), (F.col("event_id") % 900).alias("latency"))
    return ops.crawl_counters(r)


@query("select time_bucket(interval 300 seconds, ts) as start, event_type as spider, count(*) as n, 1000000 * count(*) // 300 as per_second_ppm from events group by all")
def a25_rates(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("spider"))
    return ops.rates(e, "ts", "spider", 300).withColumn("start", F.col("start").cast("timestamp_ntz"))


def _quantile_sql() -> str:
    out, lower, below = "", "0", "0"
    for b in ops.LATENCY_BOUNDS:
        out += f" when le_{b} >= n * 0.95 then {lower} + ({b} - {lower}) * (n * 0.95 - {below}) / (le_{b} - {below})"
        lower, below = str(b), f"le_{b}"
    return f"round((case{out} else {ops.LATENCY_BOUNDS[-1]} end)::double, 6)"


@query(f"with {TASKS}, h as (select spider, site, count(*) as n, {', '.join(f'count(*) filter (duration * 10 <= {b}) as le_{b}' for b in ops.LATENCY_BOUNDS)} from tasks group by all) select spider, site, n, {_quantile_sql()} as quantile from h")
def a25_p95(spark, sf_dir):
    return ops.bucket_quantile(ops.request_histogram(task_metrics(spark, sf_dir), ("spider", "site"))).select("spider", "site", "n", "quantile")


@query(f"with {TASKS} select worker_id, count(*) as total, (sum(items) * 1000)::bigint // count(*) as items_milli, 1000000 * count(*) filter (status = 'failed') // count(*) as detected_ppm from tasks group by worker_id")
def a26_detection_rate(spark, sf_dir):
    t = task_metrics(spark, sf_dir).groupBy("worker_id").agg(F.count(F.lit(1)).alias("total"), F.sum("items").alias("items"), F.count_if(F.col("status") == "failed").alias("bad"))
    return t.select("worker_id", "total", F.expr("items * 1000 div total").alias("items_milli"), F.expr("1000000 * bad div total").alias("detected_ppm"))


@query("with a as (select event_id, ts from events where event_type = 'error') select event_id, ts from a where ts >= timestamp '2024-01-30 12:00:00' - interval 6 hours")
def o3_recent_alerts(spark, sf_dir):
    a = table(spark, sf_dir, "events").where("event_type = 'error'").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return ops.recent(a, F.lit("2024-01-30 12:00:00").cast("timestamp"), 6).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("select event_id, ts from events where event_type in ('error', 'view') and ts > timestamp '2024-01-30 00:00:00' - interval 7 days")
def k5_u1_alert_history(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    old, new = (e.where(F.col("event_type") == x).select("event_id", "ts") for x in ("error", "view"))
    return ops.kept_history(old, new, F.lit("2024-01-30 00:00:00").cast("timestamp"), 7).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(f"with {QUEUE} select task_id from queue where task_id in (select event_id from events) or task_id in (select user_id from events)")
def j12_known_tasks(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return ops.known_tasks(_queue(spark, sf_dir).select("task_id"), e.select(F.col("event_id").alias("task_id")), e.select(F.col("user_id").alias("task_id")))


@query("""with recursive c as (select user_id, event_id, epoch_us(ts) as t from events), o as (select *, row_number() over (partition by user_id order by t, event_id) as n from c),
r as (select user_id, event_id, t, n, t as kept, true as ok from o where n = 1 union all select o.user_id, o.event_id, o.t, o.n, case when o.t - r.kept >= 86400000000 then o.t else r.kept end, o.t - r.kept >= 86400000000 from r join o on o.user_id = r.user_id and o.n = r.n + 1)
select user_id, event_id from r where ok""")
def w10_debounced(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    return folds.debounced(e, "user_id", "ts", 86400).select("user_id", "event_id")


@query("""with recursive o as (select user_id, event_id, epoch_us(ts) as t, row_number() over (partition by user_id order by ts, event_id) as i from events),
r as (select user_id, event_id, t, i, 1 as streak, false as closes from o where i = 1 union all
select o.user_id, o.event_id, o.t, o.i, case when r.closes then 1 when r.streak > 1 and o.t - r.t > 172800000000 then 1 else r.streak + 1 end, not r.closes and not (r.streak > 1 and o.t - r.t > 172800000000) and r.streak + 1 > 3 from r join o on o.user_id = r.user_id and o.i = r.i + 1)
select user_id, event_id, streak::int as streak, closes from r""")
def w9_idle_streaks(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    return folds.idle_streaks(e, "user_id", "ts", 172800, 3).select("user_id", "event_id", "streak", "closes")


SITES = (("example.org", "org", 1), ("spam-farm.example.org", "spam", 2), ("example.org", "later", 3), ("le.com", "odd", 4), ("example.com", "com", 5))


@query(f"""with h as (select page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) as host from pages), s as (select domain, arg_max(site, n) as site from (values {", ".join(map(str, SITES))}) t(domain, site, n) group by domain)
select page_id, host, (select site from s where domain = host) as exact, (select site from s where ends_with(host, domain) order by length(domain) desc limit 1) as suffix, contains(host, 'example') or contains(host, 'spam') as some from h""")
def j1_j3_sites(spark, sf_dir):
    sites = joins.last_loaded(spark.createDataFrame(SITES, "domain string, site string, n int"), "n")
    p = table(spark, sf_dir, "pages").select("page_id", F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"))
    exact = p.join(F.broadcast(sites.select(F.col("domain").alias("__d"), F.col("site").alias("exact"))), F.col("host") == F.col("__d"), "left").drop("__d")
    found = joins.site_of_host(exact, sites, aligned=False).withColumnRenamed("site", "suffix")
    return found.select("page_id", "host", "exact", "suffix", joins.any_pattern(F.col("host"), ("example", "spam")).alias("some"))


PAGE_RULES = (("a", None, "title", "h1"), ("a", "detail", "title", "h2"), ("a", None, "date", ".d"), ("b", "list", "rows", "li"), ("b", None, "title", "h3"))


@query(f"""with r as (select * from (values {", ".join("(" + ", ".join("null" if x is None else f"'{x}'" for x in row) + ")" for row in PAGE_RULES)}) t(site, page_type, field, rule)), p as (select page_id, (['a', 'b', 'c'])[1 + (page_id % 3)::int] as site, (['detail', 'list'])[1 + (page_id % 2)::int] as page_type from pages),
f as (select distinct site, field from r) select p.page_id, p.site, p.page_type, f.field, coalesce(t.rule, g.rule) as rule from p join f on p.site = f.site left join r t on t.site = p.site and t.page_type = p.page_type and t.field = f.field left join r g on g.site = p.site and g.page_type is null and g.field = f.field where coalesce(t.rule, g.rule) is not null""")
def j11_rules_of_page(spark, sf_dir):
    r = spark.createDataFrame(PAGE_RULES, "site string, page_type string, field string, rule string")
    p = table(spark, sf_dir, "pages").select("page_id", one_of("page_id", ("a", "b", "c")).alias("site"), one_of("page_id", ("detail", "list")).alias("page_type"))
    return joins.rules_of_page(p, r).select("page_id", "site", "page_type", "field", "rule")


@query("""with a as (select distinct o_custkey % 50 as site, o_orderpriority as f from orders where o_orderkey % 2 = 0), b as (select distinct o_custkey % 50 as site, o_orderpriority as f from orders where o_orderkey % 7 = 0),
k as (select site from a union select site from b), x as (select k.site, (select list_sort(list(f)) from a where a.site = k.site) as x, (select list_sort(list(f)) from b where b.site = k.site) as y from k)
select site, array_to_string(list_filter(coalesce(x, []), lambda v: list_contains(coalesce(y, []), v)), ',') as common, array_to_string(list_filter(coalesce(x, []), lambda v: not list_contains(coalesce(y, []), v)), ',') as only_one, array_to_string(list_filter(coalesce(y, []), lambda v: not list_contains(coalesce(x, []), v)), ',') as only_two from x""")
def j13_u3_config_diff(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 50).alias("site"), F.col("o_orderpriority").alias("f"))
    d = joins.config_diff(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 7 = 0"), "site", "f")
    return d.select("site", *[F.array_join(c, ",").alias(c) for c in ("common", "only_one", "only_two")])


@query("select distinct c_mktsegment || ':' || c_nationkey as key, min(c_custkey) over (partition by c_mktsegment, c_nationkey) as first from customer")
def u2_ordered_distinct(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.concat("c_mktsegment", F.lit(":"), F.col("c_nationkey").cast("string")).alias("key"), F.col("c_custkey").alias("first"))
    return dedup.keep_first(c, ["key"], "first")


@query("""with m as (select doc_id, case doc_id % 4 when 0 then 'http://x/' || doc_id when 1 then '{"url": "http://y/' || doc_id || '", "site": "s"}' when 2 then '{"u": "http://z/' || doc_id || '", "callback": "c"}' else ' ' end as v from documents)
select case when v[1] = '{' then coalesce(json_extract_string(v, '$.url'), json_extract_string(v, '$.u')) else v end as url, case when v[1] = '{' then json_extract_string(v, '$.site') end as site, case when v[1] = '{' then json_extract_string(v, '$.callback') end as callback from m where doc_id % 4 < 3""")
def s7_t1_seeds(spark, sf_dir):
    k = F.col("doc_id")
    n = k.cast("string")
    v = (
        F.when(k % 4 == 0, F.concat(F.lit("http://x/"), n)).when(k % 4 == 1, F.concat(F.lit('{"url": "http://y/'), n, F.lit('", "site": "s"}')))
        .when(k % 4 == 2, F.concat(F.lit('{"u": "http://z/'), n, F.lit('", "callback": "c"}'))).otherwise(" ")
    )
    return tables.seeds(table(spark, sf_dir, "documents").select(v.alias("value")))


@query("""with d as (select doc_id, unnest([1, 2]) as i, lang, source from documents where doc_id % 5 > 0) select doc_id, i::int as index, case when i = 1 then lang else source end as title, i || '-' || doc_id as id, 'http://h/' || i || '-' || doc_id || '?t=' || case when i = 1 then lang else source end as url from d""")
def s11_list_api(spark, sf_dir):
    k = F.col("doc_id").cast("string")
    row = lambda i, t: F.struct(F.concat(F.lit(f"{i}-"), k).alias("id"), F.struct(F.col(t).alias("name")).alias("meta"))
    body = F.to_json(F.struct(F.struct(F.array(row(1, "lang"), row(2, "source")).alias("rows")).alias("data")))
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 5 == 0, "<html>").otherwise(body).alias("body"))
    return tables.list_api(d, ["doc_id"], "data.rows", {"title": "meta.name", "id": "id"}, "http://h/{id}?t={title}")


@query("""with c as (select c_custkey, c_custkey % 250 || '.1.2.' || c_nationkey as ip, 1 + c_custkey % 70000 as port from customer)
select distinct ip, port::int as port, case when c_custkey % 3 = 0 then 'socks5' else 'http' end as protocol from c where c_custkey % 4 < 3 and port <= 65535""")
def s12_proxies(spark, sf_dir):
    k = F.col("c_custkey")
    ip, port = F.concat((k % 250).cast("string"), F.lit(".1.2."), F.col("c_nationkey").cast("string")), (k % 70000 + 1).cast("string")
    v = F.when(k % 4 == 3, "no proxy").when(k % 3 == 0, F.concat(F.lit('[{"ip": "'), ip, F.lit('", "port": "'), port, F.lit('", "protocol": "socks5"}]'))).otherwise(F.concat(ip, F.lit(":"), port, F.lit(" # seen")))
    return tables.proxies_of(table(spark, sf_dir, "customer").select(v.alias("value")))


@query("select user_id % 50 as log, arg_max(event_id, event_id) filter (event_type = 'view') as items, arg_max(event_id * 2, event_id) filter (event_type = 'click') as responses, count(*) filter (event_type = 'error') as errors from events group by 1")
def s13_log_counters(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    n = F.col("event_id").cast("string")
    v = (
        F.when(F.col("event_type") == "view", F.concat(F.lit(" 'item_scraped_count': "), n, F.lit(","))).when(F.col("event_type") == "click", F.concat(F.lit("response_received_count: "), (F.col("event_id") * 2).cast("string")))
        .when(F.col("event_type") == "error", F.concat(F.lit("[x] ERROR: "), n)).otherwise("INFO")
    )
    return tables.log_counters(e.select((F.col("user_id") % 50).alias("log"), F.col("event_id").alias("at"), v.alias("value")), "log", "at")


@query("select n_name as site, unnest(['http://' || lower(n_name), 'http://b.' || lower(n_name)]) as url from nation where n_nationkey % 3 = 0 union all select n_name, 'http://c' from nation where n_nationkey % 3 = 1")
def s16_seed_tasks(spark, sf_dir):
    k, low = F.col("n_nationkey"), F.lower("n_name")
    urls = F.when(k % 3 == 0, F.array(F.concat(F.lit("http://"), low), F.concat(F.lit("http://b."), low))).when(k % 3 == 1, F.array(F.lit("http://c"), F.lit("")))
    return tables.seed_tasks(table(spark, sf_dir, "nation").select(F.col("n_name").alias("site"), urls.alias("start_urls")))


@query("""with d as (select doc_id, lang from documents) select 'http://a/' || doc_id as url, 'adaptive' as spider, case when doc_id % 2 = 0 then 'high' else 'normal' end as priority, lang as site, 3::int as max_retries from d where doc_id % 3 > 0
union all select 'http://b/' || doc_id, 'adaptive', 'normal', '', 3 from d where doc_id % 3 = 0""")
def s6_batch_tasks(spark, sf_dir):
    k = F.col("doc_id")
    n = k.cast("string")
    js = F.concat(F.lit('[{"url": "http://a/'), n, F.lit('", "site": "'), F.col("lang"), F.lit('"'), F.when(k % 2 == 0, ', "priority": "high"').otherwise(""), F.lit("}, {}]"))
    v = F.when(k % 3 > 0, js).otherwise(F.concat(F.lit("# list\n\n http://b/"), n))
    return tables.batch_tasks(table(spark, sf_dir, "documents").select(v.alias("value")))


@query(f"with {TASKS}, {WORKERS}, {QUEUE} select (select count(*) from tasks) as tasks, (select count(*) filter (status = 'busy') from workers) as busy, (select count(*) from queue) as queued")
def s17_system_status(spark, sf_dir):
    queued = _queue(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))
    s = tables.system_status(monitor=ops.task_performance(task_metrics(spark, sf_dir)), balancer=ops.load_stats(_workers(spark, sf_dir)), scheduler=queued)
    return s.select(F.col("monitor.total").alias("tasks"), F.col("balancer.busy").alias("busy"), F.col("scheduler.n").alias("queued"))


@query("""select '{"n": ' || count(*) || ',"largest": ' || max(doc_id) || '}' as report from documents""")
def k4_report(spark, sf_dir):
    s = table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("largest"))
    return tables.as_report(s).select(F.regexp_replace(F.regexp_replace("report", r"\s*\n\s*", ""), r'" : ', '": ').alias("report"))


@query("select event_id, event_type from (select event_id, event_type, row_number() over (partition by event_type order by event_id) as n from events) where n <= 50")
def o4_first_of_each(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    return dedup.latest(e.withColumn("__o", -F.col("event_id")), "event_type", "__o", 50).select("event_id", "event_type")


