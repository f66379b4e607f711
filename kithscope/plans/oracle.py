"""Independent SQL for the same inputs, used to check every query on a second engine.

Written as ANSI SQL over the given tables. ``oracle(sql)`` puts in front only the views a query names.
"""

from __future__ import annotations

import re

from kithscope.plans.workspace import AS_OF

VIEWS: dict[str, str] = {}

VIEWS["user_stats"] = """
select cast(c.c_custkey as varchar(25)) as twitter_id,
  case when c.c_custkey%20=3 then c.c_custkey%120
       when c.c_custkey%25=4 then cast(floor((c.c_acctbal+1000)*200) as bigint)
       else cast(floor((c.c_acctbal+1000)*(1+c.c_custkey%17)/10) as bigint) end as followers,
  case when c.c_custkey%20=3 then 4000+(c.c_custkey*7919)%7001
       when c.c_custkey%25=4 then c.c_custkey%300 else (c.c_custkey*7919)%7001 end as following,
  case when c.c_custkey%20=3 then coalesce(a.n_lines,0)*20000
       else coalesce(a.n_lines,0)*((c.c_custkey*31)%400) end as statuses,
  case when c.c_custkey%20=3 then 0 else coalesce(a.q,0)*(c.c_custkey%5) end as favorites,
  c.c_custkey%120 as listed, coalesce(a.n_lines,0)*(c.c_custkey%7) as media,
  c.c_custkey%6=0 as blue_verified, c.c_custkey%11=0 or c.c_custkey%20=3 as default_profile,
  c.c_custkey%22=0 or c.c_custkey%40=3 as default_image, c.c_custkey%13=0 as sensitive,
  case when c.c_custkey%8=5 then a.last_at else a.created_at end as created_at
from customer c left join (
  select o.o_custkey as k, min(o.o_orderdate) as created_at, max(o.o_orderdate) as last_at,
         count(*) as n_lines, cast(sum(l.l_quantity) as bigint) as q
  from orders o join lineitem l on l.l_orderkey=o.o_orderkey group by o.o_custkey) a on a.k=c.c_custkey
"""

VIEWS["user_profiles"] = """
select cast(c.c_custkey as varchar(25)) as twitter_id, lower(replace(c.c_name,'#','_')) as handle, c.c_name as name,
  doc.text as bio, n.n_name as location, c.c_mktsegment as category,
  case when c.c_custkey%10=0 then 'bluesky' else 'twitter' end as platform, c.c_custkey%2=0 as can_dm
from customer c left join documents doc on doc.doc_id=c.c_custkey left join nation n on n.n_nationkey=c.c_nationkey
"""

VIEWS["user_keywords"] = """
select cast(o.o_custkey as varchar(25)) as twitter_id, p.p_brand as keyword, min(o.o_orderdate) as added_at
from orders o join lineitem l on l.l_orderkey=o.o_orderkey join part p on p.p_partkey=l.l_partkey
group by o.o_custkey, p.p_brand
union all select cast(c_custkey as varchar(25)), '@customers', timestamp '1995-01-01 00:00:00'
from customer where c_custkey%50=7
"""

VIEWS["profile_scores"] = """
select twitter_id, scored_by, label, reason, scored_at from (
  select cast(o.o_custkey as varchar(25)) as twitter_id,
    case l.l_linenumber%3 when 0 then 'model-a' when 1 then 'model-b' else 'model-c' end as scored_by,
    case l.l_returnflag when 'A' then true when 'R' then false else cast(null as boolean) end as label,
    o.o_orderpriority as reason, l.l_shipdate as scored_at,
    row_number() over (partition by o.o_custkey, l.l_linenumber%3
      order by l.l_shipdate desc, l.l_orderkey desc, l.l_linenumber desc, l.l_partkey desc) as rn
  from orders o join lineitem l on l.l_orderkey=o.o_orderkey where o.o_custkey%3<>0) t where rn=1
"""

VIEWS["searches"] = """
with e as (select event_type as keyword, user_id, event_id, ts, date_trunc('day',ts) as d,
    row_number() over (partition by user_id order by ts, event_id) as seen from events),
  s as (select keyword, d, count(*) as items, sum(case when seen=1 then 1 else 0 end) as new_profiles,
    min(ts) as query_at from e group by keyword, d),
  r as (select s.*, row_number() over (partition by keyword order by d)-1 as page,
    row_number() over (partition by keyword order by d desc) as back from s),
  b as (select twitter_id, keyword, added_at,
      row_number() over (partition by twitter_id order by added_at, keyword) as seen
    from user_keywords where keyword<>'@customers'),
  bp as (select keyword, date_trunc('year', added_at) as d, count(*) as items,
    sum(case when seen=1 then 1 else 0 end) as new_profiles, min(added_at) as query_at
    from b group by keyword, date_trunc('year', added_at)),
  br as (select bp.*, row_number() over (partition by keyword order by d)-1 as page,
    row_number() over (partition by keyword order by d desc) as back from bp)
select keyword, items, cast(page as bigint) as page,
  case when back=1 and keyword in ('error','view') then cast(null as varchar(64))
       else concat('c', cast(page as varchar(10))) end as next_page,
  cast(new_profiles as bigint) as new_profiles, query_at
from r
union all
select keyword, items, cast(page as bigint),
  case when back=1 and keyword like '%3' then cast(null as varchar(64))
       else concat('c', cast(page as varchar(10))) end, cast(new_profiles as bigint), query_at
from br
"""


def scoring_sql(source: str, overrides: dict[str, float] | None = None) -> str:
    """The heuristic over any relation with the account counters; ``overrides`` replaces numbers by name."""
    n = {
        "custom": 0.1, "engaged": 0.1, "age": 0.1, "safe": 0.05, "balanced": 0.12, "normal": 0.12,
        "established": 0.08, "moderate": 0.08, "volume": 0.08, "bot": 0.65, "entity": 0.55, "creator": 0.55,
        "human": 0.55, "zero_statuses": 0.4, "default_profile": 0.75, "few_followers": 50,
    }
    n.update(overrides or {})
    sig = lambda x: f"(1e0/(1e0+exp(-({x}))))"
    bell = lambda x, p, w: f"exp(-(({x}-{p})/{w})*(({x}-{p})/{w}))"
    return f"""
select *, case when cls is null then null
   else floor(least(1e0, greatest(0e0, raw*penalty))*10000+0.5e0)/10000e0 end as score4 from (
 select *, case cls when 'Bot' then 1e0-bot when 'Entity' then 1e0-entity when 'Creator' then creator
   when 'Human' then person when 'Other' then 0.5e0 end as raw from (
  select *, case when age_d is null then null
    when bot > {n['bot']}e0 then 'Bot'
    when entity > {n['entity']}e0 and bot < 0.5e0 then 'Entity'
    when creator > {n['creator']}e0 and entity < 0.5e0 and bot < 0.5e0 then 'Creator'
    when person > {n['human']}e0 then 'Human'
    when person >= creator and person >= entity and person >= bot then 'Human'
    when creator >= entity and creator >= bot then 'Creator'
    else 'Other' end as cls from (
   select *, least(1e0, base + ver*0.08e0*{sig("10e0*(base-0.7e0)")}) as person from (
    select *,
      {n['custom']}e0*cust + {n['engaged']}e0*least(1e0, sqrt(eng*2e0)) + {n['age']}e0*(1e0-exp(-age_d/500e0))
      + {n['safe']}e0*saf + {n['balanced']}e0*{bell("rn", "0.4e0", "0.25e0")}
      + {n['normal']}e0*(case when act < 0.1e0 then 0.5e0
          when act < 0.5e0 then 0.5e0+(0.4e0*(act-0.1e0))/(0.5e0-0.1e0)
          when act <= 2 then 0.9e0+0.1e0*{bell("act", "1e0", "0.5e0")}
          when act <= 4 then 0.75e0 when act <= 8 then 0.45e0 else 0.2e0 end)
      + {n['established']}e0*least(1e0, log10(followers+1e0)/3e0)
      + {n['moderate']}e0*(case when following <= 500 then 1e0
          when following <= 1500 then 1e0-(0.15e0*(following-500))/1000e0
          when following <= 3000 then 0.85e0-(0.25e0*(following-1500))/1500e0
          else greatest(0.3e0, 0.6e0-(0.1e0*(following-3000))/2000e0) end)
      + {n['volume']}e0*(case when statuses <= 5000 then 1e0
          when statuses <= 10000 then 1e0-(0.2e0*(statuses-5000))/5000e0
          when statuses <= 20000 then 0.8e0-(0.3e0*(statuses-10000))/10000e0
          else greatest(0.3e0, 0.5e0-(0.1e0*(statuses-20000))/10000e0) end) as base,
      {sig(f"-3e0 + 3e0*{sig('0.1e0*(act-50e0)')} + 2e0*(1e0-{sig('5e0*(eng-0.1e0)')})"
           f" + 1.5e0*(1e0-{sig('5e0*(rat+1.5e0)')}) + 1.5e0*(1e0-cust) + (1e0-{sig('10e0*(agec-0.1e0)')})")} as bot,
      {sig(f"-2.5e0 + 1.5e0*{sig('rat-1e0')} + 1.2e0*med + 0.8e0*lis + 0.5e0*ver"
           f" + 0.8e0*{sig('0.0003e0*(followers-10000e0)')}")} as creator,
      {sig(f"-2.5e0 + 1.2e0*{sig('rat-1.7e0')} + 0.8e0*(1e0-eng) + 0.6e0*med + 0.5e0*ver"
           f" + 0.8e0*{bell('act', '3e0', '5e0')}")} as entity,
      (case when followers < 10 then 0.6e0 when followers < {n['few_followers']} then 0.8e0 else 1e0 end)
      *(case when statuses = 0 then {n['zero_statuses']}e0 when statuses < 10 then 0.7e0 else 1e0 end)
      *(case when age_d < 30 then 0.6e0 when age_d < 90 then 0.85e0 else 1e0 end)
      *(case when following > 5000 and followers < 100 then 0.5e0 else 1e0 end)
      *(case when act > 20 then 0.65e0 when act > 10 then 0.85e0 else 1e0 end)
      *(case when statuses > 30000 and followers < statuses/10e0 then 0.7e0 else 1e0 end)
      *(case when cust < 0.5e0 then {n['default_profile']}e0 else 1e0 end)
      *(case when eng < 0.1e0 and act > 5 then 0.7e0 else 1e0 end) as penalty from (
     select *, (rat+2e0)/5e0 as rn, 1e0-exp(-age_d/365e0) as agec, statuses/(age_d+1e0) as act from (
      select *,
        least(3e0, greatest(-2e0, log10((followers+1e0)/(following+1e0)))) as rat,
        least(1e0, favorites/(statuses+1e0)) as eng, tanh(listed/50e0) as lis,
        least(1e0, media/(statuses+1e0)) as med,
        ((case when default_profile then 0 else 1 end)+(case when default_image then 0 else 1 end))/2e0 as cust,
        1e0-0.3e0*(case when sensitive then 1 else 0 end) as saf,
        case when blue_verified then 1e0 else 0e0 end as ver,
        case when created_at is null then null else
          greatest(0e0, (epoch_us(timestamp '{AS_OF}')-epoch_us(created_at))/86400000000e0) end as age_d
      from {source}) s1) s2) s3) s4) s5) s6
"""


VIEWS["detail"] = scoring_sql("user_stats")
VIEWS["scores"] = "select twitter_id, score4 as human_score, cls as likely_is from detail"
VIEWS["profiles"] = "select p.*, s.human_score, s.likely_is from user_profiles p join scores s using (twitter_id)"
VIEWS["queue"] = """
select d.twitter_id, p.handle, d.created_at as added_at from detail d join user_profiles p using (twitter_id)
where d.score4 > 0.65
"""
VIEWS["numbered_labels"] = """
select s.*, case when label then 1e0 when not label then 0e0 else 0.5e0 end as llm from profile_scores s
"""
VIEWS["label_means"] = """
select twitter_id, avg(llm) as avg_llm, count(*) as llm_count, string_agg(distinct scored_by, ';' order by scored_by) as models
from numbered_labels group by twitter_id
"""
VIEWS["keyword_sets"] = """
select twitter_id, string_agg(distinct keyword, '; ' order by keyword) as keywords, bool_or(keyword='@customers') as is_curated
from user_keywords group by twitter_id
"""
VIEWS["finals"] = """
select p.twitter_id, p.handle, p.name, p.bio, p.human_score, p.likely_is, p.platform, p.can_dm,
  coalesce(m.avg_llm, 0e0) as avg_llm, coalesce(m.llm_count, 0) as llm_count, m.models,
  coalesce(k.keywords, '') as keywords, coalesce(k.is_curated, false) as is_curated,
  coalesce(m.llm_count, 0) > 0 as has_llm,
  case when m.llm_count > 0 then 0.2e0*p.human_score+0.8e0*m.avg_llm else p.human_score end as final_score
from profiles p left join label_means m using (twitter_id) left join keyword_sets k using (twitter_id)
"""
VIEWS["latest_pages"] = """
select keyword, page, next_page, query_at, next_page is not null as has_more from (
  select *, row_number() over (partition by keyword order by page desc) as rn from searches) t where rn=1
"""


def oracle(sql: str, **extra: str) -> str:
    """``sql`` with the named views it needs as common table expressions, in dependency order."""
    known = {**VIEWS, **extra}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                body = known[name]
                # Mark first so that a view mentioning its own name cannot recurse.
                needed.append(name)
                visit(body)
                needed.remove(name)
                needed.append(name)

    visit(sql)
    head = ",\n".join(f"{name} as materialized ({known[name]})" for name in needed)
    if not needed:
        return sql
    body = f"select * from ({sql}) wrapped" if sql.lstrip().startswith("with ") else sql
    return f"with {head}\n{body}"
