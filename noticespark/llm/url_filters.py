"""URL filters by a temporal list join, in DataFrame functions only.

List events ``(kind, key, category, action, day)`` say that an entry was added to or removed from a list on a day.  They
become validity intervals [added, next event).  Every capture is evaluated against the entries active on the day it was
fetched: its URL gives the keys it can match (its host, each parent domain, each path prefix), an equi-join on
(kind, key) with the interval condition finds the active entries, and the most specific one decides: longest path
prefix, then exact host, then longest domain; of equally specific ones ``allow`` before the block categories, then the
category and the later start.

An entry has at most one event a day after the first aggregation, so its window is bounded by days, not by rows.
Captures are reduced to distinct (url, day) before the join; a hot host is the probe side of a join whose other side
has a few intervals per key.

Defined cases: of an add and a remove on one day the remove holds; an add while active continues the entry; null urls and
urls without ``scheme://host`` match nothing (verdict ``none``); a null day matches nothing; events with any null are
ignored; repeated captures each get a row; an empty list gives ``none`` everywhere; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

URL_HOST = "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"
URL_PATH = "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, URL_HOST, 1)), "^.*@", "")
    return F.regexp_replace(F.regexp_replace(host, ":[0-9]*$", ""), "[.]$", "")


def intervals(events: DataFrame) -> DataFrame:
    """``kind, key, category, valid_from, valid_to``; ``valid_to`` is null while the entry is still active."""
    whole = events.where("kind is not null and key is not null and category is not null and day is not null and action in ('add', 'remove')")
    daily = whole.groupBy("kind", "key", "category", "day").agg(F.max("action").alias("action"))  # 'remove' > 'add'
    order = W.partitionBy("kind", "key", "category").orderBy("day")
    spans = daily.withColumn("valid_to", F.lead("day").over(order)).where("action = 'add'")
    return spans.select("kind", "key", "category", F.col("day").alias("valid_from"), "valid_to")


def _keys() -> Column:
    """``(kind, key, depth)`` of every entry that the columns ``host`` and ``path`` can match; deeper is more specific."""
    return F.expr("""
        concat(
          array(struct('host' as kind, host as key, 1000 as depth)),
          transform(sequence(0, greatest(size(split(host, '[.]')) - 2, 0)),
                    i -> struct('domain' as kind, array_join(slice(split(host, '[.]'), i + 1, 1000), '.') as key, size(split(host, '[.]')) - i as depth)),
          if(size(filter(split(path, '/'), s -> s <> '')) = 0, array(),
             transform(sequence(1, greatest(size(filter(split(path, '/'), s -> s <> '')), 1)),
                       i -> struct('prefix' as kind, concat(host, '/', array_join(slice(filter(split(path, '/'), s -> s <> ''), 1, i), '/')) as key, 2000 + i as depth))))
    """)


def verdicts(captures: DataFrame, events: DataFrame) -> DataFrame:
    """``page_id, fetch_day, host, verdict, kind, key, category, active_since, n_active`` for every row of ``captures(page_id, url, fetch_day)``."""
    distinct = captures.select("url", "fetch_day").where("url is not null and fetch_day is not null").distinct()
    parsed = distinct.select("url", "fetch_day", host_of(F.col("url")).alias("host"), F.regexp_extract("url", URL_PATH, 1).alias("path")).where("host <> ''")
    probes = parsed.select("url", "fetch_day", F.inline(_keys()))
    spans = intervals(events)
    active = probes.join(spans, ["kind", "key"]).where("valid_from <= fetch_day and (valid_to is null or fetch_day < valid_to)")
    best = F.max_by(F.struct("kind", "key", "category", "valid_from"), F.struct("depth", F.col("category") == "allow", "category", "valid_from"))
    found = active.groupBy("url", "fetch_day").agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
    out = captures.select("page_id", "url", "fetch_day").join(found, ["url", "fetch_day"], "left")
    return out.select(
        "page_id",
        "fetch_day",
        host_of(F.coalesce("url", F.lit(""))).alias("host"),
        F.when(F.col("best").isNull(), "none").when(F.col("best.category") == "allow", "allow").otherwise("block").alias("verdict"),
        "best.kind",
        "best.key",
        "best.category",
        F.col("best.valid_from").alias("active_since"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_active"),
    )


# --- the query's captures and list, derived from ``pages`` ---

FIRST_DAY = "2024-01-01"


def _digit(text: str, i: int) -> str:
    return f"(instr('0123456789abcdef', substr({text}, {i}, 1)) - 1)"


def captures_of(pages: DataFrame) -> DataFrame:
    day = F.expr(f"date_add(date'{FIRST_DAY}', cast((page_id * 131 + 7) % 366 as int))")
    return pages.select("page_id", "url", day.alias("fetch_day"))


def events_of(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts, domains and path prefixes of the pages: about a third of them, some added twice."""
    parts = pages.where("url is not null").select(host_of(F.col("url")).alias("host"), F.regexp_extract("url", URL_PATH, 1).alias("path")).where("host <> ''")
    keys = parts.select(F.expr("""inline(array(
        struct('host' as kind, host as key),
        struct('domain' as kind, array_join(slice(split(host, '[.]'), -3, 3), '.') as key),
        struct('prefix' as kind, concat(host, '/', split(path, '/')[1]) as key)))""")).where("key is not null").distinct()
    d = {i: _digit("h", i) for i in range(1, 9)}
    dated = keys.withColumn("h", F.md5(F.concat_ws(":", "kind", "key"))).where(f"{d[1]} < case kind when 'host' then 6 when 'domain' then 4 else 3 end")
    dated = dated.selectExpr("kind", "key", f"case when {d[8]} < 4 then 'allow' when {d[8]} < 8 then 'adult' when {d[8]} < 12 then 'gambling' else 'spam' end as category",
                             f"{d[2]} * 16 + {d[3]} as a", f"10 + {d[4]} * 16 + {d[5]} as l", f"{d[6]} as again", f"{d[7]} as gap")
    days = F.expr("""inline(filter(array(
        struct('add' as action, a as n), struct('remove' as action, a + l as n),
        if(again < 8, struct('add' as action, a + l + 5 + gap as n), null)), e -> e is not null))""")
    return dated.select("kind", "key", "category", days).selectExpr("kind", "key", "category", "action", f"date_add(date'{FIRST_DAY}', cast(n as int)) as day")


_H = "(strpos('0123456789abcdef', substr(h, {}, 1)) - 1)"
ORACLE = f"""
with cap as (
  select page_id, url, date '{FIRST_DAY}' + cast((page_id * 131 + 7) % 366 as int) as fetch_day,
         regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(coalesce(url, ''), '{URL_HOST}', 1)), '^.*@', ''), ':[0-9]*$', ''), '[.]$', '') as host,
         regexp_extract(coalesce(url, ''), '{URL_PATH}', 1) as path
  from pages),
keys as (
  select 'host' as kind, host as key from cap where host <> '' union
  select 'domain', array_to_string(list_slice(string_split(host, '.'), -3, -1), '.') from cap where host <> '' union
  select 'prefix', host || '/' || string_split(path, '/')[2] from cap where host <> '' and len(string_split(path, '/')) > 1),
hashed as (select *, md5(kind || ':' || key) as h from keys),
dated as (
  select kind, key,
         case when {_H.format(8)} < 4 then 'allow' when {_H.format(8)} < 8 then 'adult' when {_H.format(8)} < 12 then 'gambling' else 'spam' end as category,
         {_H.format(2)} * 16 + {_H.format(3)} as a, 10 + {_H.format(4)} * 16 + {_H.format(5)} as l, {_H.format(6)} as again, {_H.format(7)} as gap
  from hashed where {_H.format(1)} < case kind when 'host' then 6 when 'domain' then 4 else 3 end),
spans as (
  select kind, key, category, a as f, a + l as t from dated union all
  select kind, key, category, a + l + 5 + gap, null from dated where again < 8),
labels as (select distinct url, fetch_day, host, path, string_split(host, '.') as ls, list_filter(string_split(path, '/'), lambda s: s <> '') as ps from cap where host <> ''),
probes as (
  select url, fetch_day, 'host' as kind, host as key, 1000 as depth from labels union all
  select url, fetch_day, 'domain', array_to_string(list_slice(ls, i + 1, len(ls)), '.'), len(ls) - i
    from (select *, unnest(generate_series(0, greatest(len(ls) - 2, 0))) as i from labels) union all
  select url, fetch_day, 'prefix', host || '/' || array_to_string(list_slice(ps, 1, i), '/'), 2000 + i
    from (select *, unnest(generate_series(1, len(ps))) as i from labels)),
active as (
  select p.url, p.fetch_day, p.depth, s.kind, s.key, s.category, date '{FIRST_DAY}' + cast(s.f as int) as active_since
  from probes p join spans s on p.kind = s.kind and p.key = s.key
  where date '{FIRST_DAY}' + cast(s.f as int) <= p.fetch_day and (s.t is null or p.fetch_day < date '{FIRST_DAY}' + cast(s.t as int))),
best as (
  select *, count(*) over (partition by url, fetch_day) as n,
         row_number() over (partition by url, fetch_day order by depth desc, (category = 'allow') desc, category desc, active_since desc) as r
  from active)
select c.page_id, c.fetch_day, c.host,
       case when b.category is null then 'none' when b.category = 'allow' then 'allow' else 'block' end as verdict,
       b.kind, b.key, b.category, b.active_since, coalesce(b.n, 0) as n_active
from cap c left join best b on c.url = b.url and c.fetch_day = b.fetch_day and b.r = 1
"""
