"""Queries over events, which stand for capture and access logs: user_id for the address, event_type for its version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketeer.operators import captures, quota
from docketeer.plans.registry import Tables, query

_K = "json_extract_string(props, '$.k')::INTEGER"


def _k():
    return F.get_json_object("props", "$.k").cast("int")


@query("SELECT DISTINCT event_type FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 14 DAY FROM events) AND event_id NOT IN (SELECT doc_id FROM labels)")
def recent_unparsed(t: Tables) -> DataFrame:
    """Kinds among the events of the last 14 days that no label names."""
    newest = t.events.agg(F.max("ts").alias("__max"))
    recent = t.events.join(F.broadcast(newest), F.col("ts") >= F.col("__max") - F.expr("INTERVAL 14 DAYS"))
    return recent.join(t.labels.select(F.col("doc_id").alias("event_id")), "event_id", "left_anti").select("event_type").distinct()


@query("""SELECT d.doc_id, coalesce(e.event_type, 'archive://' || d.lang || '/' || d.doc_id) AS url FROM documents d
LEFT JOIN (SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id) e ON d.doc_id = e.user_id""")
def source_with_capture(t: Tables) -> DataFrame:
    """Each source with its last log line, or its own address."""
    last = t.events.groupBy(F.col("user_id").alias("doc_id")).agg(F.max_by("event_type", "event_id").alias("event_type"))
    own = F.concat(F.lit("archive://"), "lang", F.lit("/"), F.col("doc_id").cast("string"))
    return t.documents.select("doc_id", "lang").join(last, "doc_id", "left").select("doc_id", F.coalesce("event_type", own).alias("url"))


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM events WHERE event_type <> 'click') WHERE n = 1")
def latest_capture_per_url(t: Tables) -> DataFrame:
    return captures.latest(t.events.where("event_type <> 'click'").select("user_id", "ts", "event_id"), "user_id", "ts", "event_id").select("user_id", "event_id")


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_page_capture_last_wins(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", F.to_date("ts").alias("day"), "event_id")
    return captures.latest(rows, "user_id", "day", "event_id", "last").select("user_id", "event_id")


@query("""SELECT user_id, event_type, min(ord) AS ord FROM (SELECT user_id, event_type, event_id AS ord FROM events WHERE value > 50
  UNION ALL SELECT user_id, event_type, event_id + 1000000000 FROM events) GROUP BY ALL""")
def first_seen_refs(t: Tables) -> DataFrame:
    """The union of two discoveries, the first of each reference."""
    rows = t.events.select("user_id", "event_type", "event_id", "value")
    both = rows.where("value > 50").select("user_id", "event_type", F.col("event_id").alias("ord")).union(rows.select("user_id", "event_type", F.col("event_id") + 1_000_000_000))
    return both.groupBy("user_id", "event_type").agg(F.min("ord").alias("ord"))


@query("SELECT user_id, count(DISTINCT event_type)::BIGINT AS versions FROM events GROUP BY 1 HAVING count(DISTINCT event_type) > 1")
def url_ever_replaced(t: Tables) -> DataFrame:
    return captures.ever_replaced(t.events, "user_id", "event_type")


@query("""WITH m AS (SELECT max(ts) AS now FROM events),
u AS (SELECT user_id % 50 AS g, user_id, count(DISTINCT value > 5) AS c, min(ts) AS oldest FROM events GROUP BY ALL)
SELECT g, bool_and(c = 1) AND min(oldest) <= any_value(now) - INTERVAL 14 DAY AS final FROM u, m GROUP BY g""")
def pages_final(t: Tables) -> DataFrame:
    """Groups of addresses; a version is whether the value is over 5, so that some groups have seen no change."""
    rows = t.events.select((F.col("user_id") % 50).alias("g"), "user_id", (F.col("value") > 5).alias("version"), "ts")
    return captures.pages_final(rows, "g", "user_id", "version", "ts")


@query("""SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before,
 row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE n = 1 OR before IS DISTINCT FROM event_type""")
def change_log(t: Tables) -> DataFrame:
    return captures.changes(t.events.select("event_id", "user_id", "event_type", "ts"), "user_id", "event_type", "ts", "event_id").drop("ts")


@query(f"""SELECT decision, count(*)::BIGINT AS n FROM (SELECT CASE WHEN {_K} % 10 = 0 THEN 'skip_gone' WHEN event_type = 'view' AND value > 50 THEN 'skip_final'
 WHEN {_K} % 7 = 3 THEN 'skip_index' WHEN {_K} % 3 = 0 THEN 'conditional' WHEN value > 50 THEN 'seed' ELSE 'fetch' END AS decision FROM events) GROUP BY 1""")
def fetch_decision(t: Tables) -> DataFrame:
    k = _k()
    decided = captures.fetch_decision(k % 10 == 0, F.col("event_type") == "view", k % 3 == 0, F.col("value") > 50, k % 7 == 3)
    return t.events.groupBy(F.coalesce(decided).alias("decision")).agg(F.count("*").alias("n"))


_STATE = f"""(SELECT user_id AS url, {_K} % 10 = 0 AS gone, {_K} % 4 = 1 AS final, {_K} % 5 <> 0 AS has_sha, event_type <> 'view' AS has_etag
 FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events WHERE value > 30) WHERE n = 1)"""


@query(f"""WITH refs AS (SELECT user_id AS url, user_id % 40 AS county, bool_or({_K} % 11 = 0) AS wayback FROM events GROUP BY ALL),
caps AS (SELECT user_id % 40 AS county, user_id AS url, count(DISTINCT value > 4) AS n FROM events WHERE event_type = 'view' GROUP BY ALL),
settled AS (SELECT county, bool_and(n = 1) AS ok FROM caps GROUP BY county)
SELECT r.url, r.county, CASE WHEN coalesce(s.gone, false) THEN 'skip_gone'
  WHEN NOT wayback AND c.url IS NOT NULL AND (coalesce(s.final, false) OR coalesce(ok, false)) THEN 'skip_final'
  WHEN NOT wayback AND c.url IS NOT NULL AND s.url IS NULL THEN 'seed'
  WHEN NOT wayback AND coalesce(has_sha AND has_etag, false) THEN 'conditional' ELSE 'fetch' END AS decision
FROM refs r LEFT JOIN caps c ON r.county = c.county AND r.url = c.url LEFT JOIN {_STATE} s ON r.url = s.url LEFT JOIN settled t ON r.county = t.county""")
def fetch_plan(t: Tables) -> DataFrame:
    """What to do with every reference, from its last state and the captures of its county."""
    k, county = _k(), (F.col("user_id") % 40).alias("county")
    refs = t.events.groupBy(F.col("user_id").alias("url"), county).agg(F.bool_or(k % 11 == 0).alias("wayback"))
    held = F.struct((k % 10 == 0).alias("gone"), (k % 4 == 1).alias("final"), F.when(k % 5 != 0, "s").alias("sha256"), F.when(F.col("event_type") != "view", "e").alias("etag"), F.lit(None).cast("string").alias("last_modified"))
    state = t.events.where("value > 30").groupBy(F.col("user_id").alias("url")).agg(F.max_by(held, "event_id").alias("s")).select("url", "s.*")
    seen = t.events.where("event_type = 'view'").select(county, F.col("user_id").alias("url"), (F.col("value") > 4).alias("version"), "ts")
    return captures.fetch_plan(refs, state, seen).select("url", "county", "decision")


@query("""SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id % 20 ORDER BY event_id) AS n FROM events e
 WHERE NOT EXISTS (SELECT 1 FROM events k WHERE k.value > 80 AND k.user_id = e.user_id AND k.event_type = e.event_type)) WHERE n <= 5""")
def known_skip_then_limit(t: Tables) -> DataFrame:
    refs = t.events.select("user_id", "event_type", "event_id", (F.col("user_id") % 20).alias("g"))
    known = t.events.where("value > 80").select("user_id", "event_type")
    return captures.known_skipped_then_limited(refs, known, ["user_id", "event_type"], "g", "event_id", 5).select("user_id", "event_id")


@query(f"""WITH m AS (SELECT max(ts) AS now FROM events),
u AS (SELECT user_id % 100 AS county, count_if(value > 95) AS failures, bool_and({_K} % 2 = 0) AS all_gone, count_if(value > 99) > 0 AS productive, max(ts) FILTER (value > 60) AS last FROM events GROUP BY 1)
SELECT county, CASE WHEN failures > 0 AND NOT all_gone THEN 'failures' WHEN NOT productive AND coalesce(last >= now - INTERVAL 14 DAY, false) THEN 'empty' END AS reason FROM u, m""")
def harvest_recheck(t: Tables) -> DataFrame:
    newest = t.events.agg(F.max("ts").alias("now"))  # one row
    per = t.events.groupBy((F.col("user_id") % 100).alias("county")).agg(
        F.count_if(F.col("value") > 95).alias("failures"), F.bool_and(_k() % 2 == 0).alias("all_gone"), (F.count_if(F.col("value") > 99) > 0).alias("productive"), F.max(F.when(F.col("value") > 60, F.col("ts"))).alias("last"))
    return per.join(F.broadcast(newest)).select("county", captures.recheck_reason(F.col("failures"), F.col("all_gone"), F.col("productive"), F.col("last"), F.col("now")).alias("reason"))


@query("""SELECT user_id % 100 AS county, count(*)::BIGINT AS refs, count_if(event_type = 'view')::BIGINT AS pages, count_if(value < 10)::BIGINT AS skipped, count_if(value < 10) * 2 > count(*) AS mostly_skipped FROM events GROUP BY 1""")
def run_counters(t: Tables) -> DataFrame:
    skipped = F.count_if(F.col("value") < 10)
    return t.events.groupBy((F.col("user_id") % 100).alias("county")).agg(F.count("*").alias("refs"), F.count_if(F.col("event_type") == "view").alias("pages"), skipped.alias("skipped"), (skipped * 2 > F.count("*")).alias("mostly_skipped"))


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)::BIGINT AS n FROM events")
def trailing_hour_events(t: Tables) -> DataFrame:
    return quota.trailing_count(t.events, "user_id", "ts", 3600).select("event_id", "n")


@query("""SELECT user_id, day, sum(n) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)::BIGINT AS n_week
FROM (SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL)""")
def rolling_week(t: Tables) -> DataFrame:
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return quota.rolling_days(daily, "user_id", "day", "n").select("user_id", "day", "n_week")


@query("""WITH d AS (SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL),
s AS (SELECT d.user_id, d.day, k.k, coalesce(sum(e.n), 0) AS rest FROM d CROSS JOIN range(1, 8) k(k) LEFT JOIN d e ON e.user_id = d.user_id AND e.day <= d.day AND e.day > d.day + (k.k - 7)::INTEGER GROUP BY ALL)
SELECT user_id, day, min(k)::INTEGER AS days_to_wait FROM s WHERE rest < 2 GROUP BY ALL""")
def weekly_retry_after(t: Tables) -> DataFrame:
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return quota.retry_after_days(daily, "user_id", "day", "n", 2)


@query(f"""SELECT event_id, row_number() OVER (PARTITION BY user_id, ts::DATE, {_K} % 5 ORDER BY ts, event_id) = 1 AS charged FROM events""")
def quota_first_open_per_day(t: Tables) -> DataFrame:
    return quota.first_opens(t.events, "user_id", _k() % 5, "ts", "event_id").select("event_id", "charged")


@query(f"""SELECT user_id, day, count(DISTINCT doc)::BIGINT AS opened FROM (SELECT user_id, ts::DATE AS day, {_K} AS doc FROM events) GROUP BY ALL HAVING count(DISTINCT doc) > 1""")
def quota_daily_exceeded(t: Tables) -> DataFrame:
    opens = quota.first_opens(t.events, "user_id", _k(), "ts", "event_id")
    return opens.where("charged").groupBy("user_id", "day").agg(F.count("*").alias("opened")).where("opened > 1")


@query("SELECT user_id % 50 AS address, epoch_us(date_trunc('hour', ts))::BIGINT AS hour_us, count(*)::BIGINT AS n FROM events GROUP BY ALL HAVING count(*) > 1")
def hourly_sessions(t: Tables) -> DataFrame:
    rows = t.events.select((F.col("user_id") % 50).alias("address"), (F.floor(quota.micros("ts") / 3_600_000_000) * 3_600_000_000).alias("hour_us"))
    return rows.groupBy("address", "hour_us").agg(F.count("*").alias("n")).where("n > 1")


@query("SELECT user_id % 50 AS address, epoch_us(time_bucket(INTERVAL 60 SECOND, ts))::BIGINT AS window_us, count(*)::BIGINT AS n FROM events GROUP BY ALL HAVING count(*) > 1")
def flood_guard(t: Tables) -> DataFrame:
    found = quota.tumbling_over(t.events.select((F.col("user_id") % 50).alias("address"), "ts"), "address", "ts", "60 seconds", 1)
    return found.select("address", quota.micros("window_start").alias("window_us"), "n")


@query("SELECT event_id, user_id FROM (SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id % 200 ORDER BY epoch_us(ts) RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW) AS n FROM events WHERE value > 60) WHERE n >= 3")
def trips_24h(t: Tables) -> DataFrame:
    trips = t.events.where("value > 60").withColumn("address", F.col("user_id") % 200)
    return quota.trailing_count(trips, "address", "ts", 86400).where(F.col("n") >= quota.TRIPS).select("event_id", "user_id")


@query("""SELECT event_type, (count(*) * 2)::BIGINT AS n FROM events GROUP BY 1""")
def log_merge(t: Tables) -> DataFrame:
    """A log merged with two that each repeat it: repeated lines stay, the same line on both sides counts once."""
    from docketeer.sources.logs import merge_logs

    base = t.events.select("event_id", "event_type")
    twice = base.union(base)
    return merge_logs(base, twice, twice).groupBy("event_type").agg(F.count("*").alias("n"))


@query("""SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) AS n FROM events) WHERE n = 1""")
def best_match_per_case(t: Tables) -> DataFrame:
    """The row of the highest score of each case; of equal ones the later."""
    from docketeer.operators.blocks import best_match

    return best_match(t.events.select("user_id", "value", "event_id"), ["user_id"], "value", "event_id").select("user_id", "event_id")


@query("""SELECT any_value(n)::BIGINT AS days, any_value(s)::BIGINT AS seconds_left FROM (SELECT count(DISTINCT ts::DATE) AS n, sum(86400 - (epoch_us(ts) % 86400000000) // 1000000) AS s FROM events)""")
def midnight_clock(t: Tables) -> DataFrame:
    """Days seen, and the seconds to midnight summed over events."""
    left = F.lit(86400) - F.floor(quota.micros("ts") % 86_400_000_000 / 1_000_000)
    return t.events.agg(F.countDistinct(F.to_date("ts")).alias("days"), F.sum(left).cast("long").alias("seconds_left"))


@query("""SELECT user_id, sum(CASE WHEN value IS NULL THEN 0 ELSE 1 END)::BIGINT AS n, max(d)::INTEGER AS longest FROM (
 SELECT user_id, value, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts) AS d FROM events) GROUP BY user_id""")
def day_sequence(t: Tables) -> DataFrame:
    """Events of each address, and the most in one day."""
    place = Window.partitionBy("user_id", F.to_date("ts")).orderBy("ts")
    return t.events.withColumn("d", F.row_number().over(place)).groupBy("user_id").agg(F.count("value").alias("n"), F.max("d").alias("longest"))
