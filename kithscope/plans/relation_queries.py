"""Queries for joins, keyword statistics and work lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithscope.functions.numbers import r6, row_count
from kithscope.operators import keywords, lookups
from kithscope.plans.catalog import Catalog
from kithscope.plans.workspace import CURATED, Workspace

catalog = Catalog()



@catalog.query(
    "j1_inner_joins",
    """select k.keyword, count(*) as pairs, count(q.twitter_id) as queued from user_keywords k
    join profiles p using (twitter_id) left join queue q using (twitter_id) group by 1""",
)
def _(w):
    queued = w.queue.select("twitter_id", F.lit(1).alias("q"))
    hits = w.user_keywords.select("twitter_id", "keyword").join(w.user_profiles.select("twitter_id"), "twitter_id")
    return hits.join(queued, "twitter_id", "left").groupBy("keyword").agg(row_count().alias("pairs"), F.count("q").alias("queued"))


@catalog.query(
    "j2_left_join_stats",
    """select p.twitter_id, p.handle, coalesce(s.followers, 0) as followers from user_profiles p
    left join (select * from user_stats where followers > 5000) s using (twitter_id)""",
)
def _(w):
    some = w.user_stats.filter(F.col("followers") > 5000)
    return lookups.with_followers(w.user_profiles.select("twitter_id", "handle"), some)


@catalog.query(
    "j3_not_labelled",
    """select twitter_id from user_profiles p where not exists (select 1 from profile_scores s
    where s.twitter_id=p.twitter_id and s.scored_by='model-b')""",
)
def _(w):
    return lookups.not_labelled_by(w.user_profiles.select("twitter_id"), w.profile_scores, "model-b")


@catalog.query(
    "j4_exclude_curated",
    "select twitter_id from user_profiles where twitter_id not in (select twitter_id from user_keywords where keyword='@customers')",
)
def _(w):
    return lookups.without_keyword(w.user_profiles.select("twitter_id"), w.user_keywords, CURATED)


@catalog.query(
    "j5_semi_joins",
    """select keyword, count(*) as n, count(*) filter (where twitter_id in (select twitter_id from profile_scores)) as labelled
    from user_keywords where twitter_id in (select twitter_id from profile_scores where scored_by='model-a') group by 1""",
)
def _(w):
    of_model = lookups.keywords_of_model(w.user_keywords, w.profile_scores, "model-a")
    all_rows = of_model.groupBy("keyword").agg(row_count().alias("n"))
    labelled = lookups.labelled_at_all(of_model, w.profile_scores).groupBy("keyword").agg(row_count().alias("labelled"))
    return all_rows.join(labelled, "keyword")


@catalog.query(
    "j6_new_or_known",
    """select twitter_id, twitter_id not in (select twitter_id from profile_scores) as is_new
    from user_profiles""",
)
def _(w):
    return lookups.split_known(w.user_profiles.select("twitter_id"), w.profile_scores)


def mixed_case_handles(w: Workspace) -> DataFrame:
    """Handle list with its order: some spelled in capitals, some unknown."""
    k = F.col("c_custkey")
    handle = F.lower(F.replace("c_name", F.lit("#"), F.lit("_")))
    spelled = F.when(k % 3 == 0, F.upper(handle)).when(k % 13 == 1, F.concat(F.lit("no_"), handle)).otherwise(handle)
    return w.raw("customer").select(k.alias("ord"), spelled.alias("handle"))


WANTED = """select c_custkey as ord, case when c_custkey%3=0 then upper(h) when c_custkey%13=1 then 'no_' || h else h end as handle
from (select c_custkey, lower(replace(c_name,'#','_')) as h from customer) t"""


@catalog.query(
    "j7_handle_ignoring_case",
    """select w.handle as wanted_handle, p.twitter_id, p.handle from wanted w
    left join user_profiles p on lower(p.handle)=lower(w.handle)""",
    wanted=WANTED,
)
def _(w):
    wanted = mixed_case_handles(w).select("handle")
    return lookups.by_handle(wanted, w.user_profiles.select("twitter_id", "handle"))


@catalog.query(
    "j8_exact_handle",
    "select w.handle as wanted_handle, p.twitter_id, p.handle from wanted w left join user_profiles p on p.handle=w.handle",
    wanted=WANTED,
)
def _(w):
    wanted = mixed_case_handles(w).select("handle")
    return lookups.by_handle(wanted, w.user_profiles.select("twitter_id", "handle"), ignore_case=False)


@catalog.query(
    "j10_list_order",
    """select w.ord, w.handle as wanted_handle, p.twitter_id, p.twitter_id is not null as found from wanted w
    left join user_profiles p on lower(p.handle)=lower(w.handle)""",
    wanted=WANTED,
)
def _(w):
    found = lookups.in_list_order(mixed_case_handles(w), w.user_profiles.select("twitter_id", "handle"))
    return found.select("ord", "wanted_handle", "twitter_id", "found")


@catalog.query(
    "j11_disagreements",
    """select a.twitter_id, a.scored_by as model_a, b.scored_by as model_b, a.llm as llm_a, b.llm as llm_b,
    abs(a.llm-b.llm) as disagreement from numbered_labels a join numbered_labels b using (twitter_id)
    where a.scored_by like 'model-a%' and b.scored_by like 'model-c%' and abs(a.llm-b.llm) > 0.3""",
)
def _(w):
    return lookups.disagreements(w.profile_scores, "model-a", "model-c")


STATUS_SQL = """select keyword, case when page%2=0 then 'twitter' else 'bluesky' end as platform,
  bool_or(next_page is not null) as still_valid, max(page) as pages_searched from searches group by 1, 2"""


@catalog.query(
    "j12_pool_by_platform",
    "select keyword from (select distinct keyword from searches) s join status t using (keyword) where platform='bluesky' and still_valid",
    status=STATUS_SQL,
)
def _(w):
    platform = F.when(F.col("page") % 2 == 0, "twitter").otherwise("bluesky")
    status = w.searches.groupBy("keyword", platform.alias("platform")).agg(
        F.bool_or(F.col("next_page").isNotNull()).alias("still_valid"), F.max("page").alias("pages_searched")
    )
    return keywords.pool_for_platform(keywords.searched_keywords(w.searches), status, "bluesky")


@catalog.query(
    "j13_not_yet_batched",
    """select ord, handle from wanted where lower(handle) not in
    (select lower(handle) from user_profiles join user_stats using (twitter_id) where followers % 4 = 0)""",
    wanted=WANTED,
)
def _(w):
    done = w.user_profiles.join(w.user_stats.filter(F.col("followers") % 4 == 0).select("twitter_id"), "twitter_id")
    return lookups.without_batched(mixed_case_handles(w), done).select("ord", "handle")


# --- keyword statistics ------------------------------------------------------------------------------

STATS_SQL = """select s.keyword, coalesce(f.n, 0) as profiles_found, round(coalesce(f.mean, 0e0) + 1e-9, 6) as avg_human_score,
  round(case when l.rated > 0 then l.liked*1e0/l.rated else 0e0 end + 1e-9, 6) as label_rate, p.has_more as still_valid,
  s.pages_searched, s.pages_count, coalesce(f.high, 0) as high_quality_count, coalesce(f.low, 0) as low_quality_count,
  s.first_search_at, s.last_search_at from
  (select keyword, max(page) as pages_searched, count(*) as pages_count, min(query_at) as first_search_at,
   max(query_at) as last_search_at from searches group by 1) s
  left join (select keyword, count(*) as n, avg(human_score) as mean, count(*) filter (where human_score > 0.7) as high,
    count(*) filter (where human_score < 0.4) as low from user_keywords join scores using (twitter_id) group by 1) f using (keyword)
  left join (select keyword, count(label) as rated, count(*) filter (where label) as liked
    from user_keywords join profile_scores using (twitter_id) group by 1) l using (keyword)
  left join latest_pages p using (keyword)"""


def stats_of(w: Workspace) -> DataFrame:
    return keywords.keyword_stats(w.searches, w.keyword_table, w.scores, w.profile_scores)


@catalog.query("a1_keyword_stats", STATS_SQL)
def _(w):
    rounded = {c: r6(F.col(c)) for c in ("avg_human_score", "label_rate")}
    return stats_of(w).withColumns(rounded).drop("semantic_tags")


@catalog.query("a2_latest_pages", "select keyword, page, next_page, query_at, has_more from latest_pages")
def _(w):
    return keywords.latest_pages(w.searches)


@catalog.query(
    "a3_distinct_names",
    "select distinct 'keyword' as kind, keyword as name from searches union all select distinct 'model', scored_by from profile_scores",
)
def _(w):
    words = keywords.searched_keywords(w.searches).select(F.lit("keyword").alias("kind"), F.col("keyword").alias("name"))
    models = w.profile_scores.select(F.lit("model").alias("kind"), F.col("scored_by").alias("name")).distinct()
    return words.unionByName(models).orderBy("kind", "name")


@catalog.query(
    "a4_work_counts",
    """select 'accounts' as kind, keyword as name, count(*) as n from user_keywords group by 2 union all
    select 'unscored', keyword, count(*) from user_keywords where twitter_id not in
    (select twitter_id from profile_scores where scored_by='model-a') group by 2 union all
    select 'pending', 'queue', count(*) from queue""",
)
def _(w):
    shaped = lambda df, kind, name, n: df.select(F.lit(kind).alias("kind"), name.alias("name"), F.col(n).alias("n"))
    accounts = shaped(keywords.count_accounts(w.user_keywords), "accounts", F.col("keyword"), "accounts")
    open_rows = keywords.count_unscored(w.user_profiles, w.user_keywords, w.profile_scores, "model-a")
    unscored = shaped(open_rows, "unscored", F.col("keyword"), "unscored")
    pending = shaped(w.queue.agg(row_count().alias("pending")), "pending", F.lit("queue"), "pending")
    return accounts.unionByName(unscored).unionByName(pending)


@catalog.query(
    "a9_usage_totals",
    "select count(*) as searches, cast(sum(items) as bigint) as items, cast(sum(new_profiles) as bigint) as new_profiles from searches",
)
def _(w):
    return keywords.usage_totals(w.searches)


@catalog.query(
    "a9_usage_by_keyword",
    """select keyword, count(*) as searches, cast(sum(items) as bigint) as items, cast(sum(new_profiles) as bigint) as new_profiles
    from searches group by 1 order by new_profiles desc, keyword limit 20""",
)
def _(w):
    return keywords.usage_by_keyword(w.searches)


@catalog.query(
    "a10_effectiveness",
    """select keyword, count(*) as searches, cast(sum(new_profiles) as bigint) as total_new,
    round(avg(new_profiles) + 1e-9, 6) as avg_per_search from searches group by 1""",
)
def _(w):
    return keywords.effectiveness(w.searches).withColumn("avg_per_search", r6(F.col("avg_per_search")))


@catalog.query(
    "a10_recent_effectiveness",
    """select keyword, count(*) as searches, cast(sum(new_profiles) as bigint) as total_new,
    round(avg(new_profiles) + 1e-9, 6) as avg_per_search from searches
    where query_at > timestamp '2024-01-20 00:00:00' - interval 7 days group by 1""",
)
def _(w):
    recent = keywords.effectiveness(w.searches, "2024-01-20 00:00:00")
    return recent.withColumn("avg_per_search", r6(F.col("avg_per_search")))


ROLLUP = """select keyword, platform, likely_is, cast(grouping(keyword)*4+grouping(platform)*2+grouping(likely_is) as bigint) as grain,
 count(*) as accounts, round(avg(human_score) + 1e-9, 6) as mean_score from user_keywords join profiles using (twitter_id)
 group by rollup (keyword, platform, likely_is)"""


@catalog.query("a24_rollup", ROLLUP)
def _(w):
    return keywords.rollup_counts(w.user_keywords, w.profiles).withColumn("mean_score", r6(F.col("mean_score")))


PLATFORM = "case when length(keyword)%2=0 then 'bluesky' else 'twitter' end as platform"


def with_platform(searches: DataFrame) -> DataFrame:
    return searches.withColumn("platform", F.when(F.length("keyword") % 2 == 0, "bluesky").otherwise("twitter"))


@catalog.query(
    "a25_platform_quota",
    f"""select platform, count(*) as searches from (select *, {PLATFORM} from searches) s
    where query_at > timestamp '2024-01-25 00:00:00' - interval 30 days group by 1""",
)
def _(w):
    return keywords.quota_by_platform(with_platform(w.searches), "2024-01-25 00:00:00")


@catalog.query(
    "a25_new_by_platform",
    f"select keyword, platform, round(avg(new_profiles) + 1e-9, 6) as mean_new from (select *, {PLATFORM} from searches) s group by 1, 2",
)
def _(w):
    return keywords.new_by_platform(with_platform(w.searches)).withColumn("mean_new", r6(F.col("mean_new")))


@catalog.query(
    "k5_pick_keywords",
    """select keyword, profiles_found from (select keyword, count(*) as profiles_found from user_keywords
    where keyword<>'@customers' group by 1) s left join latest_pages p using (keyword)
    where coalesce(p.has_more, true) order by md5(keyword || '|day-1'), keyword limit 5""",
)
def _(w):
    stats = w.user_keywords.filter(F.col("keyword") != CURATED).groupBy("keyword").agg(row_count().alias("profiles_found"))
    return keywords.pick_keywords(stats.withColumn("still_valid", F.lit(True)), w.searches, "day-1")


@catalog.query(
    "k5_pick_valid_keywords",
    """select keyword, profiles_found from (select keyword, count(*) as profiles_found from user_keywords
    where keyword<>'@customers' group by 1) s left join latest_pages p using (keyword)
    where coalesce(p.has_more, true) and length(keyword)=8 order by md5(keyword || '|day-1'), keyword limit 5""",
)
def _(w):
    stats = w.user_keywords.filter(F.col("keyword") != CURATED).groupBy("keyword").agg(row_count().alias("profiles_found"))
    return keywords.pick_keywords(stats.withColumn("still_valid", F.length("keyword") == 8), w.searches, "day-1")


@catalog.query(
    "u9_resume_points",
    """select k.keyword, coalesce(p.page+1, 0) as page, p.next_page as cursor,
    case when p.page is not null and not p.has_more then 'fully_paged' else 'ready' end as status
    from (select distinct keyword from user_keywords) k left join latest_pages p using (keyword)""",
)
def _(w):
    return keywords.resume_points(w.searches, w.user_keywords.select("keyword").distinct())


PLATFORM_PAGES = """select keyword, 'twitter' as platform, page, next_page from searches union all
 select keyword, 'bluesky', page, case when page < 1 then next_page end from searches where page < 2"""


@catalog.query(
    "u9_resume_by_platform",
    """with p as (select *, row_number() over (partition by keyword, platform order by page desc) as rn from platform_pages)
    select k.keyword, k.platform, coalesce(p.page+1, 0) as page, p.next_page as cursor, case when p.page is not null and p.next_page is null then 'fully_paged' else 'ready' end as status
    from (select distinct keyword, unnest(['twitter', 'bluesky', 'other']) as platform from user_keywords) k left join p on p.keyword=k.keyword and p.platform=k.platform and p.rn=1""",
    platform_pages=PLATFORM_PAGES,
)
def _(w):
    """A second platform whose second page is its last, and one never searched."""
    first = w.searches.withColumn("platform", F.lit("twitter"))
    second = w.searches.filter("page < 2").withColumns({"platform": F.lit("bluesky"), "next_page": F.when(F.col("page") < 1, F.col("next_page"))})
    wanted = w.user_keywords.select("keyword").distinct().withColumn("platform", F.explode(F.array(*[F.lit(p) for p in ("twitter", "bluesky", "other")])))
    return keywords.resume_points(first.unionByName(second), wanted, ("keyword", "platform"))


@catalog.query("q5_fully_paged", "select keyword, page from latest_pages where not has_more")
def _(w):
    return keywords.fully_paged(w.searches)


@catalog.query(
    "w6_first_seen",
    """select keyword, d, count(*) as new_profiles from (select event_type as keyword, date_trunc('day', ts) as d,
    row_number() over (partition by user_id order by ts, event_id) as seen from events) t where seen=1 group by 1, 2""",
)
def _(w):
    hits = w.raw("events").select(
        "user_id", "ts", "event_id", F.col("event_type").alias("keyword"), F.date_trunc("day", "ts").alias("d")
    )
    seen = keywords.first_seen(hits, [F.col("ts"), F.col("event_id")], ["keyword", "d"], key="user_id")
    counted = keywords.page_new_counts(seen, ["keyword", "d"])
    return counted.withColumn("d", F.col("d").cast("timestamp_ntz"))


@catalog.query(
    "m7_keyword_health",
    f"""select s.keyword, s.pages_count, s.profiles_found, round(coalesce(e.a, 0e0) + 1e-9, 6) as avg_per_search,
    coalesce(e.a, 0e0) < 2 as exhausted from ({STATS_SQL}) s left join (select keyword, avg(new_profiles) as a from searches
    where query_at > timestamp '2024-01-20 00:00:00' - interval 7 days group by 1) e using (keyword)""",
)
def _(w):
    recent = keywords.effectiveness(w.searches, "2024-01-20 00:00:00")
    return keywords.health(stats_of(w), recent).withColumn("avg_per_search", r6(F.col("avg_per_search")))


# --- work lists --------------------------------------------------------------------------------------

WORK = """select p.twitter_id, p.handle, p.name, p.bio, p.category, coalesce(s.followers, 0) as followers, q.added_at
 from queue q join profiles p using (twitter_id) left join user_stats s using (twitter_id)
 where p.human_score > 0.55 and p.bio<>'' and p.name<>''
 and not exists (select 1 from profile_scores x where x.twitter_id=p.twitter_id and x.scored_by='model-a')"""


@catalog.query(
    "l1_label_work_list",
    "select twitter_id, handle, name, bio, category, followers from work order by md5(twitter_id || '|7'), twitter_id limit 25",
    work=WORK,
)
def _(w):
    return lookups.label_work_list(w.profiles, w.user_stats, w.queue, w.profile_scores, "model-a", seed="7")


@catalog.query(
    "l1_oldest_first",
    "select twitter_id, handle, name, bio, category, followers from work order by added_at, twitter_id limit 25",
    work=WORK,
)
def _(w):
    return lookups.label_work_list(
        w.profiles, w.user_stats, w.queue, w.profile_scores, "model-a", oldest_first=True
    )


BY_KEYWORD = """select p.twitter_id, p.handle, coalesce(p.name, '') as name, p.bio, p.category, coalesce(s.followers, 0) as followers
 from user_keywords k join user_profiles p using (twitter_id) left join user_stats s using (twitter_id)
 where k.keyword='Brand#1' and p.bio<>''"""


@catalog.query(
    "l2_keyword_unlabelled",
    f"""{BY_KEYWORD} and twitter_id not in (select twitter_id from profile_scores where scored_by='model-a')
    order by md5(twitter_id || '|7'), twitter_id limit 100""",
)
def _(w):
    return lookups.keyword_work_list(
        w.user_profiles, w.user_stats, w.user_keywords, w.profile_scores, "Brand#1", "model-a", seed="7"
    )


@catalog.query("l2_keyword_all", BY_KEYWORD)
def _(w):
    return lookups.keyword_work_list(
        w.user_profiles, w.user_stats, w.user_keywords, w.profile_scores, "Brand#1", limit=None
    )


@catalog.query(
    "l10_labels_for_handles",
    """select ord, wanted_handle, twitter_id, scored_by, label, reason from (
      select w.ord, w.handle as wanted_handle, p.twitter_id, s.scored_by, s.label, s.reason,
      row_number() over (partition by w.ord order by s.scored_by) as rn
      from wanted w join user_profiles p on lower(p.handle)=lower(w.handle) join profile_scores s using (twitter_id)
      where s.scored_by like '%del-%') t where rn=1""",
    wanted=WANTED,
)
def _(w):
    found = lookups.labels_for_handles(mixed_case_handles(w), w.user_profiles, w.profile_scores, "%del-%")
    return found.select("ord", "wanted_handle", "twitter_id", "scored_by", "label", "reason")
