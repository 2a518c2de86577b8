"""Task, worker, proxy and request metrics, and routing scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Histogram bounds in thousandths of a second.
LATENCY_BOUNDS = (50, 100, 200, 500, 1000, 2000, 5000, 10000)


def _task_aggregates() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "completed").alias("completed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.sum("duration").alias("duration"),
        F.sum("items").alias("items"),
        F.sum("pages").alias("pages"),
    ]


def task_performance(tasks: DataFrame, *by: str) -> DataFrame:
    """Counts, sums and mean duration of tasks, overall or per group; the success rate in whole millionths."""
    rate = F.expr("try_divide(1000000 * completed, total)").cast("long")
    return tasks.groupBy(*by).agg(*_task_aggregates()).withColumns({"success_ppm": rate, "avg_duration": F.try_divide(F.col("duration").cast("double"), "total")})


def hourly_stats(tasks: DataFrame, first: str, hours: int) -> DataFrame:
    """Counts, sums and ``workers`` (tasks by worker) for each of ``hours`` hours from ``first`` on; hours without tasks are zero."""
    start = F.lit(first).cast("timestamp")
    inside = tasks.where((F.col("start_time") >= start) & (F.col("start_time") < start + F.make_interval(hours=F.lit(hours))))
    by_worker = inside.groupBy(F.date_trunc("hour", "start_time").alias("h"), "worker_id").agg(*_task_aggregates())
    sums = [F.sum(c).alias(c) for c in ("total", "completed", "failed", "duration", "items")]
    workers = F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("worker_id").isNotNull(), F.struct("worker_id", "total"))))).alias("workers")
    by_hour = by_worker.groupBy("h").agg(*sums, workers)
    frame = tasks.sparkSession.range(hours).select((start + F.make_interval(hours=F.col("id").cast("int"))).alias("hour"))
    zero = F.lit(0)
    found = frame.join(by_hour, F.col("hour") == F.col("h"), "left")
    duration = F.coalesce("duration", zero.cast(found.schema["duration"].dataType)).alias("duration")
    return found.select(F.date_format("hour", "yyyy-MM-dd HH:mm").alias("hour"), *[F.coalesce(c, zero).cast("long").alias(c) for c in ("total", "completed", "failed", "items")], duration, F.coalesce("workers", F.create_map().cast(found.schema["workers"].dataType)).alias("workers"))


def request_histogram(tasks: DataFrame, by: Sequence[str] = ("spider", "site", "status")) -> DataFrame:
    """Requests and cumulative latency buckets by label set; ``duration`` is in hundredths of a second."""
    ms = F.col("duration") * 10
    return tasks.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(ms <= b).alias(f"le_{b}") for b in LATENCY_BOUNDS])


def failing_groups(tasks: DataFrame, percent: int = 85) -> DataFrame:
    """Groups whose success rate is under the target."""
    c = tasks.groupBy("spider", "site").agg(*_task_aggregates())
    return c.where(F.col("completed") * 100 < F.col("total") * percent).select("spider", "site", "total", "completed")


def sustained(samples: DataFrame, key: str, time: str, value: str, least: Column, minutes: int, tie: str | None = None) -> DataFrame:
    """Runs of samples at or over ``least`` that last at least ``minutes`` (gaps and islands). Equal times go by ``tie``."""
    w = Window.partitionBy(key).orderBy(time, *([tie] if tie else []))
    hot = samples.withColumn("__hot", F.col(value) >= least)
    new = hot.withColumn("__new", (F.lag("__hot").over(w).isNull() | ~F.lag("__hot").over(w)).cast("int")).withColumn("__i", F.sum("__new").over(w)).where("__hot")
    runs = new.groupBy(key, "__i").agg(F.min(time).alias("first"), F.max(time).alias("last"), F.count(F.lit(1)).alias("n"))
    return runs.where(F.col("last") - F.col("first") >= F.expr(f"interval {minutes} minutes")).drop("__i")


def worker_scores(workers: DataFrame, needed: Column) -> DataFrame:
    """Routing score, low wins: load, CPU, memory, failures and missing features. In millionths, so that the failure rate is exact to that."""
    w = workers.where((F.col("active") < 10) & (F.col("cpu") <= 90) & (F.col("memory") <= 90) & (F.col("heartbeat_age") <= 300))
    missing = F.size(F.array_except(needed, F.col("features")))
    fails = F.expr("case when completed + failed > 0 then cast(100000000 * failed as bigint) div (completed + failed) else 0 end")
    return w.withColumn("score", F.col("active") * 10_000_000 + F.col("cpu") * 500_000 + F.col("memory") * 300_000 + fails + missing * 50_000_000)


def best_worker(scored: DataFrame) -> DataFrame:
    """The worker with the lowest score; of equal ones the first by id."""
    return scored.orderBy("score", "worker_id").limit(1)


def proxy_score(ms: Column, anonymity: Column, rate_percent: Column, fails: Column, valid: Column | None = None) -> Column:
    """0 to 1000 tenths from response time, anonymity, success rate and stability; 0 for an invalid proxy."""
    speed = F.when(ms < 2000, 400).when(ms < 5000, 300).when(ms < 10000, 200).otherwise(100)
    hidden = F.when(anonymity == "elite", 300).when(anonymity == "anonymous", 250).when(anonymity == "transparent", 150).when(anonymity == "unknown", 50).otherwise(0)
    stable = F.when(fails == 0, 100).when(fails < 3, 50).otherwise(0)
    total = F.least(F.lit(1000), F.greatest(F.lit(0), speed + hidden + rate_percent * 2 + stable))
    return total if valid is None else F.when(F.coalesce(valid, F.lit(False)), total).otherwise(0)


def severity(kind: Column) -> Column:
    return F.when(kind.isin("task_timeout", "queue_overflow"), "high").when(kind.isin("task_failed", "high_memory_usage"), "medium").otherwise("low")


def task_alerts(tasks: DataFrame, timeout: int = 3600, memory: int = 1024, cpu: int = 90) -> DataFrame:
    """(task_id, kind, severity): a row for each threshold that a task run passes, and for its failure."""
    checks = ((F.col("seconds") > timeout, "task_timeout"), (F.col("status") == "failed", "task_failed"), (F.col("memory") > memory, "high_memory_usage"), (F.col("cpu") > cpu, "high_cpu_usage"))
    kinds = F.array_compact(F.array(*[F.when(c, k) for c, k in checks]))
    return tasks.select("task_id", F.explode(kinds).alias("kind")).withColumn("severity", severity(F.col("kind")))


#: Order of events of one time.
EVENT_ORDER = ("started", "failed", "completed")


def task_states(events: DataFrame, now: Column, most: int = 3) -> DataFrame:
    """Where each task stands after its events (task_id, event: submitted, started, failed or completed, at).

    (task_id, retries, status, due, eligible): processing after a start; pending after a failure that may
    be tried again, due 60 s times two to the power of its retries after that failure; failed after
    more failures than retries are allowed (its own ``max_retries``, if there is such a column, else
    ``most``); completed for good once an attempt succeeded. A failure counts only where the event
    before it is a start, so neither one without an attempt nor one after a success does. A task
    that was never started is pending and due at once. Null tasks, times and unknown events are left out.
    """
    rank = F.array_position(F.array(*map(F.lit, EVENT_ORDER)), F.col("event"))
    by_time = Window.partitionBy("task_id").orderBy("at", rank)
    own = F.col("max_retries") if "max_retries" in events.columns else F.lit(None).cast("int")
    e = events.where(F.col("task_id").isNotNull() & F.col("at").isNotNull() & F.col("event").isin("submitted", *EVENT_ORDER)).select("task_id", "event", "at", own.alias("own"))
    e = e.withColumns({"before": F.lag("event").over(by_time), "won": F.max(F.col("event") == "completed").over(by_time)})
    counts = ~F.col("won") & (F.col("event") == "failed") & (F.col("before") == "started")
    t = e.groupBy("task_id").agg(
        F.count_if(counts).alias("fails"), F.max("won").alias("done"), F.max(F.when(counts, F.col("at"))).alias("failed_at"), F.max(F.when((F.col("event") == "started") & ~F.col("won"), F.col("at"))).alias("started_at"),
        F.min("at").alias("first"), F.coalesce(F.max("own"), F.lit(most)).alias("most"),
    )
    running = F.col("started_at").isNotNull() & F.coalesce(F.col("started_at") > F.col("failed_at"), F.lit(True))
    status = F.when(F.col("done"), "completed").when(F.col("fails") > F.col("most"), "failed").when(running, "processing").otherwise("pending")
    # beyond some retries the wait is longer than any task lives; the power stays within a whole number
    wait = F.when(F.col("fails") > 0, F.call_function("shiftleft", F.lit(60).cast("long"), F.least(F.col("fails"), F.lit(30)).cast("int"))).otherwise(0)
    due = F.when(F.col("status") == "pending", F.timestamp_micros(F.unix_micros(F.coalesce("failed_at", "first")) + wait * 1_000_000))
    t = t.select("task_id", F.least("fails", "most").alias("retries"), status.alias("status"), "fails", "failed_at", "first")
    return t.select("task_id", "retries", "status", due.alias("due"), F.coalesce(due <= now, F.lit(False)).alias("eligible"))


def next_tasks(tasks: DataFrame, k: int, now: Column | None = None) -> DataFrame:
    """The ``k`` tasks that are consumed next: urgent, high, normal, low; first come first served within; only those that are due."""
    rank = F.when(F.col("priority") == "urgent", 0).when(F.col("priority") == "high", 1).when(F.col("priority") == "normal", 2).when(F.col("priority") == "low", 3)
    due = tasks if now is None else tasks.where(F.col("scheduled_at").isNull() | (F.col("scheduled_at") <= now))
    return due.where(rank.isNotNull()).orderBy(rank, "seq").limit(k)


def due_refresh(queue: DataFrame, now: Column, k: int = 1) -> DataFrame:
    """The earliest entries whose time has come."""
    return queue.where(F.col("next_ts") <= now).orderBy("next_ts", "key").limit(k)


def _packed(values: DataFrame, key: str, name: str, by: list[str], blocks: int, size: int) -> DataFrame:
    """(key, name): the values of each key in arrays of ``size``. Blocks by hash and sorted arrays, so a lost task makes the same arrays again."""
    block = F.pmod(F.xxhash64(*by), F.lit(blocks)).alias("__block")
    # structs, as a list of bare values would drop nulls
    listed = values.select(key, block, F.struct(by[0]).alias(name)).groupBy(key, "__block").agg(F.sort_array(F.collect_list(name)).alias(name))
    return listed.select(key, F.explode(F.expr(f"transform(sequence(1, size({name}), {size}), i -> slice({name}, i, {size}))")).alias(name))


def capable_workers(workers: DataFrame, tasks: DataFrame, rows: int = 1 << 24) -> DataFrame:
    """(task_id, worker_id): workers that list the task's site.

    The result grows with the product of the two, so its rows come in an order that Parquet packs well: 256 tasks for each worker in turn.
    It is made by as many Spark tasks as give about ``rows`` rows each, for which both are counted first.
    """
    each = workers.select("worker_id", F.explode("sites").alias("__site")).where(F.col("__site").isNotNull()).distinct()
    asked = tasks.where(F.col("site").isNotNull()).groupBy("site", "task_id").agg(F.count(F.lit(1)).alias("__n"))
    n, m = F.coalesce("__n", F.lit(0)), F.coalesce("__m", F.lit(0))
    by_site = asked.groupBy("site").agg(F.sum("__n").alias("__n")).join(each.groupBy("__site").agg(F.count(F.lit(1)).alias("__m")), F.col("site") == F.col("__site"), "full")
    n_tasks, n_workers, pairs = (int(x or 0) for x in by_site.agg(F.sum(n), F.sum(m), F.sum(n.cast("double") * m)).first())
    asked = asked.select("site", "task_id", F.explode(F.sequence(F.lit(1).cast("long"), "__n")).alias("__copy"))
    some = _packed(asked, "site", "__tasks", ["task_id", "__copy"], 1 + n_tasks // 32768, 256).repartition(1 + pairs // rows)
    # 64 workers for each key of a broadcast row. The sort ends a pipeline that would else hold all rows of a task list's workers at once
    able = _packed(each, "__site", "__workers", ["worker_id"], 1 + n_workers // 32768, 64)
    met = some.join(F.broadcast(able), F.col("site") == F.col("__site")).sortWithinPartitions("site")
    return met.select("__tasks", F.inline("__workers")).select(F.inline("__tasks"), "worker_id")


def load_stats(workers: DataFrame) -> DataFrame:
    """One row: how many workers there are of each status, and mean CPU and memory in thousandths (0 without workers)."""
    mean = lambda c: F.coalesce(F.expr(f"try_divide(cast(sum({c}) * 1000 as bigint), count(*))").cast("long"), F.lit(0))
    return workers.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("status") == x).alias(x) for x in ("active", "busy", "offline")], mean("cpu").alias("cpu_milli"), mean("memory").alias("memory_milli"))


def site_distribution(workers: DataFrame) -> DataFrame:
    return workers.select(F.explode("sites").alias("site")).groupBy("site").agg(F.count(F.lit(1)).alias("n"))


def queue_stats(tasks: DataFrame) -> DataFrame:
    """(status, priority, n) with sums over either and over both as nulls."""
    return tasks.cube("status", "priority").agg(F.count(F.lit(1)).alias("n"))


def usable(fails: Column, rate_percent: Column) -> Column:
    return (fails < 3) & (rate_percent > 30)


def proxy_pool_stats(proxies: DataFrame, blacklist: DataFrame) -> DataFrame:
    """One row: total, available, blacklisted, availability in millionths."""
    t = proxies.agg(F.count(F.lit(1)).alias("total"), F.count_if(usable(F.col("fails"), F.col("rate"))).alias("available"))
    b = blacklist.agg(F.count_distinct("proxy_id").alias("blacklisted"))
    return t.join(F.broadcast(b)).withColumn("available_ppm", F.expr("1000000 * available div greatest(total, 1)"))


def proxy_validation_stats(results: DataFrame) -> DataFrame:
    """One row: counts, success in millionths, mean response time and the number of each anonymity over valid ones only."""
    valid = F.col("valid")
    return results.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(valid).alias("valid"), F.expr("coalesce(try_divide(1000000 * count_if(valid), count(*)), 0)").cast("long").alias("success_ppm"),
        F.expr("coalesce(try_divide(sum(case when valid then ms end), count_if(valid)), 0)").cast("long").alias("mean_ms"),
        *[F.count_if(valid & (F.col("anonymity") == a)).alias(a) for a in ("elite", "anonymous", "transparent", "unknown")],
    )


def proxy_after(total: Column, good: Column, fails: Column, ms: Column, success: Column, took: Column) -> Column:
    """A proxy's counters after one more request: total, good, fails in a row, mean of old and new time, and whether it is removed."""
    total, good, fails = total + 1, good + F.when(success, 1).otherwise(0), F.when(success, 0).otherwise(fails + 1)
    return F.struct(total.alias("total"), good.alias("good"), fails.alias("fails"), F.when(took > 0, (ms + took) / 2).otherwise(ms).alias("ms"), ((fails >= 5) | (good * 5 < total)).alias("removed"))


def advanced_score(base_milli: Column, total: Column, good: Column, mean_ms: Column, fails: Column) -> Column:
    """Thousandths, 0 to 1000: base, success rate times 0.3, speed under 5 s times 0.2, less 0.1 for each failure in a row up to 0.5."""
    rate = F.when(total > 0, F.floor(good * 300 / total)).otherwise(0)
    speed = F.when(mean_ms > 0, F.greatest(F.lit(0), F.floor((5000 - mean_ms) * 200 / 5000))).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(1000), base_milli + rate + speed - F.least(fails * 100, F.lit(500)))).cast("long")


def pick_proxies(proxies: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """A random one of the best fifth (at least one) of ``n`` proxies by success rate."""
    best = proxies.orderBy(F.desc("rate"), "proxy_id").limit(max(1, n // 5))
    return best.orderBy(F.xxhash64("proxy_id", F.lit(seed)), "proxy_id").limit(1)


def proxy_type_stats(proxies: DataFrame) -> DataFrame:
    """(type, n, mean score in thousandths, distinct countries)."""
    return proxies.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.expr("cast(sum(score) * 1000 as bigint) div count(*)").alias("score_milli"), F.count_distinct("country").alias("countries"))


def crawl_counters(requests: DataFrame) -> DataFrame:
    """One row: requests, success (status under 400), failures, mean latency in thousandths (0 without requests)."""
    ok = F.col("status") < 400
    return requests.agg(F.count(F.lit(1)).alias("requests"), F.count_if(ok).alias("good"), F.count_if(~ok).alias("bad"), F.expr("coalesce(cast(try_divide(sum(latency) * 1000, count(*)) as bigint), 0)").alias("latency_milli"))


def rates(events: DataFrame, ts: str, by: str, seconds: int) -> DataFrame:
    """(start, ``by``, n, per_second in millionths) for windows of ``seconds``."""
    w = events.groupBy(F.window(ts, f"{seconds} seconds").alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("w.start").alias("start"), by, "n", F.expr(f"1000000 * n div {seconds}").alias("per_second_ppm"))


def bucket_quantile(histogram: DataFrame, thousandths: int = 950) -> DataFrame:
    """The quantile of cumulative buckets, interpolated within its bucket; beyond the last bound, that bound. In thousandths of a second, null without samples."""
    rank = F.col("n") * thousandths / 1000
    out, lower, below = F.lit(None).cast("double"), F.lit(0), F.lit(0)
    steps = []
    for b in LATENCY_BOUNDS:
        c = F.col(f"le_{b}")
        steps.append((c >= rank, lower + (b - lower) * F.try_divide(rank - below, c - below)))
        lower, below = F.lit(b), c
    out = F.lit(LATENCY_BOUNDS[-1]).cast("double")
    for holds, value in reversed(steps):
        out = F.when(holds, value).otherwise(out)
    return histogram.withColumn("quantile", F.round(F.when(F.col("n") > 0, out), 6))


def recent(alerts: DataFrame, now: Column, hours: int) -> DataFrame:
    """Alerts of the last hours, latest first."""
    return alerts.where(F.col("ts") >= now - F.make_interval(hours=F.lit(hours))).orderBy(F.desc("ts"))


def kept_history(old: DataFrame, new: DataFrame, now: Column, days: int) -> DataFrame:
    """Old and new alerts less those older than ``days``."""
    return old.unionByName(new).where(F.col("ts") > now - F.make_interval(days=F.lit(days)))


def known_tasks(tasks: DataFrame, *lists: DataFrame) -> DataFrame:
    """Tasks whose id stands in one of the lists (processing, completed, failed)."""
    ids = lists[0].select("task_id")
    for other in lists[1:]:
        ids = ids.union(other.select("task_id"))
    return tasks.join(ids, "task_id", "left_semi")

