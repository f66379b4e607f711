"""Queries for final scores, ranks, label statistics and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithscope.functions.bands import label_to_number
from kithscope.functions.numbers import r6, seeded_order
from kithscope.functions.text import preview
from kithscope.operators import evaluation, label_stats, ranking, sketches
from kithscope.operators.lookups import keywords_of_model, with_followers
from kithscope.operators.ordering import first_per_key
from kithscope.plans.account_queries import AUDIENCE_SQL, labels_with_some_audience
from kithscope.plans.catalog import Catalog
from kithscope.plans.workspace import CURATED, Workspace
from kithscope.session import scratch_path
from kithscope.sources import exports

catalog = Catalog()


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(F.col(c)) for c in columns})


def finals(w: Workspace) -> DataFrame:
    return ranking.final_scores(w.profiles, w.profile_scores, w.user_keywords)


def marked(w: Workspace) -> DataFrame:
    return ranking.curated_finals(w.profiles, w.profile_scores, w.user_keywords, CURATED)


def ranked(w: Workspace) -> DataFrame:
    """Final scores of all accounts, narrow and computed once: ranks look at them two or three times."""
    return w.once(marked(w).select("twitter_id", "handle", "final_score", "has_llm", "is_curated"), "finals")


def numbered(w: Workspace) -> DataFrame:
    return label_stats.numbered_labels(w.profile_scores, w.profiles)


NUM = "select l.*, s.human_score as has from numbered_labels l join scores s using (twitter_id)"
CORR = "covar_pop({0},{1})/nullif(stddev_pop({0})*stddev_pop({1}),0)"

# --- final scores and ranks --------------------------------------------------------------------------


@catalog.query("a5_label_means", "select twitter_id, avg_llm, llm_count, models from label_means")
def _(w):
    return ranking.label_means(w.profile_scores).withColumn("models", F.array_join("models", ";"))


@catalog.query("a6_keyword_sets", "select twitter_id, keywords, is_curated from keyword_sets")
def _(w):
    return ranking.keyword_sets(w.user_keywords, CURATED).withColumn("keywords", F.array_join("keywords", "; "))


@catalog.query(
    "a7_final_scores",
    """select twitter_id, handle, human_score, likely_is, avg_llm, llm_count, keywords, is_curated, has_llm,
    round(final_score + 1e-9, 6) as final_score from finals""",
)
def _(w):
    out = rounded(finals(w), "final_score").withColumn("keywords", F.array_join("keywords", "; "))
    return out.select("twitter_id", "handle", "human_score", "likely_is", "avg_llm", "llm_count", "keywords",
                      "is_curated", "has_llm", "final_score")


@catalog.query(
    "a8_ranked_list",
    """select twitter_id, handle, name, human_score, round(avg_llm, 3) as avg_llm, round(final_score, 3) as final_score
    from finals where has_llm and final_score >= 0.6 order by finals.final_score desc, twitter_id limit 100""",
)
def _(w):
    top = ranking.ranked_list(w.profiles, w.profile_scores)
    return top.select("twitter_id", "handle", "name", "human_score", F.round("avg_llm", 3).alias("avg_llm"),
                      F.round("final_score", 3).alias("final_score"))


EXPORT = """select f.*, coalesce(s.followers, 0) as followers, substring(replace(coalesce(f.bio, ''), chr(10), ' '), 1, 500) as cell
 from finals f left join user_stats s using (twitter_id)"""


@catalog.query(
    "s7_high_score_export",
    """select handle, cell as bio, followers, format('{:.4f}', final_score) as score, coalesce(likely_is, 'Unknown') as is_likely,
    keywords as tags from export where has_llm and final_score >= 0.6""",
    export=EXPORT,
)
def _(w):
    return exports.high_score_rows(with_followers(finals(w), w.user_stats))


@catalog.query(
    "s7_high_score_file",
    """select handle, cell as bio, followers, format('{:.4f}', final_score) as score, coalesce(likely_is, 'Unknown') as is_likely,
    keywords as tags from export where has_llm and final_score >= 0.6""",
    export=EXPORT,
)
def _(w):
    path = scratch_path(w.spark, "high-scores")
    exports.write_ranked(exports.high_score_rows(with_followers(finals(w), w.user_stats)), path, exports.HIGH_HEADER, "score")
    names = ["handle", "bio", "followers", "score", "is_likely", "tags"]
    rows = exports.read_ranked(w.spark, path, exports.HIGH_HEADER).toDF(*names)
    return rows.withColumn("followers", F.col("followers").cast("bigint"))


@catalog.query(
    "s8_low_score_export",
    """select handle, cell as bio, followers, format('{:.4f}', final_score) as final_score, format('{:.4f}', human_score) as has_score,
    case when has_llm then format('{:.4f}', avg_llm) else '' end as avg_llm, case when has_llm then 'true' else 'false' end as has_llm,
    coalesce(likely_is, 'Unknown') as is_likely, keywords as tags from export where final_score < 0.5""",
    export=EXPORT,
)
def _(w):
    return exports.low_score_rows(with_followers(finals(w), w.user_stats))


@catalog.query(
    "s8_low_score_file",
    """select handle, cell as bio, followers, format('{:.4f}', final_score) as final_score, format('{:.4f}', human_score) as has_score,
    case when has_llm then format('{:.4f}', avg_llm) else '' end as avg_llm, case when has_llm then 'true' else 'false' end as has_llm,
    coalesce(likely_is, 'Unknown') as is_likely, keywords as tags from export where final_score < 0.5""",
    export=EXPORT,
)
def _(w):
    path = scratch_path(w.spark, "low-scores")
    exports.write_ranked(exports.low_score_rows(with_followers(finals(w), w.user_stats)), path, exports.LOW_HEADER, "final_score")
    names = ["handle", "bio", "followers", "final_score", "has_score", "avg_llm", "has_llm", "is_likely", "tags"]
    rows = exports.read_ranked(w.spark, path, exports.LOW_HEADER).toDF(*names)
    return rows.withColumn("followers", F.col("followers").cast("bigint"))


@catalog.query(
    "s9_label_files",
    """select k.keyword || '/' || s.scored_by as file, p.handle, coalesce(p.bio, '') as bio, s.label, s.reason
    from user_keywords k join user_profiles p using (twitter_id) join profile_scores s using (twitter_id) where k.keyword in ('Brand#1', '@customers')""",
)
def _(w):
    """Both kinds of keywords, all models, accounts without a bio as well."""
    hits = w.user_keywords.filter(F.col("keyword").isin("Brand#1", CURATED)).select("twitter_id", "keyword")
    joined = w.user_profiles.join(hits, "twitter_id").join(w.profile_scores, "twitter_id")
    path = scratch_path(w.spark, "label-csv")
    exports.write_labels(exports.label_rows(joined.withColumn("file", F.concat_ws("/", "keyword", "scored_by")), "file"), path, "file")
    return exports.read_labels(w.spark, path, "file")


@catalog.query(
    "s9_label_export",
    """select p.handle, p.bio, case when s.label is null then 'null' when s.label then 'true' else 'false' end as label, s.reason
    from user_keywords k join user_profiles p using (twitter_id) join profile_scores s using (twitter_id)
    where k.keyword='Brand#1' and s.scored_by='model-a' and p.bio<>''""",
)
def _(w):
    hits = w.user_keywords.filter(F.col("keyword") == "Brand#1").select("twitter_id")
    own = w.profile_scores.filter(F.col("scored_by") == "model-a")
    joined = w.user_profiles.filter(F.col("bio") != "").join(hits, "twitter_id").join(own, "twitter_id")
    return exports.label_rows(joined)


@catalog.query(
    "w1_rolling_mean",
    """select scored_by, twitter_id, scored_at, round(avg(llm) over (partition by scored_by order by scored_at, twitter_id
    rows between 49 preceding and current row) + 1e-9, 6) as rolling_mean from numbered_labels""",
)
def _(w):
    labels = w.profile_scores.select("scored_by", "twitter_id", "scored_at", label_to_number(F.col("label")).alias("llm"))
    return rounded(label_stats.label_trend(labels), "rolling_mean").drop("llm")


@catalog.query(
    "w2_first_label",
    """select twitter_id, scored_by, label from (select *, row_number() over (partition by twitter_id
    order by md5(twitter_id || '|' || scored_by || '|42'), scored_by) as rn from profile_scores) t where rn=1""",
)
def _(w):
    order = [seeded_order("42", F.col("twitter_id"), F.col("scored_by")), F.col("scored_by")]
    return first_per_key(w.profile_scores, ["twitter_id"], order).select("twitter_id", "scored_by", "label")


@catalog.query(
    "w3_top_share",
    """select twitter_id, round(final_score + 1e-9, 6) as final_score, round(share + 1e-9, 6) as top_share from (
    select *, cume_dist() over (order by final_score desc) * 100 as share from finals where has_llm) t where is_curated""",
)
def _(w):
    return rounded(ranking.curated_top_share(ranked(w)), "final_score", "top_share").drop("handle")


@catalog.query(
    "w4_seed_ranks",
    """select count(*) filter (where rk<=50) as in_top_50, count(*) filter (where rk<=100) as in_top_100,
    round(avg(rk) + 1e-9, 6) as mean_rank from (select twitter_id, rank() over (order by 0.3e0*has+0.7e0*llm desc) as rk from num
    where scored_by='model-a') t where twitter_id in (select twitter_id from user_keywords where keyword='@customers')""",
    num=NUM,
)
def _(w):
    scored = numbered(w).filter(F.col("scored_by") == "model-a")
    scored = scored.withColumn("blend", ranking.blend(F.col("has"), F.col("llm"), 0.3))
    seeds = w.user_keywords.filter(F.col("keyword") == CURATED).select("twitter_id")
    ranks = ranking.competition_rank(scored, "blend")
    own = scored.join(seeds, "twitter_id", "left_semi").join(ranks, "blend")
    return own.agg(
        F.count(F.when(F.col("rank") <= 50, 1)).alias("in_top_50"),
        F.count(F.when(F.col("rank") <= 100, 1)).alias("in_top_100"), r6(F.avg("rank")).alias("mean_rank"),
    )


@catalog.query(
    "w5_empirical_cdf",
    """select distinct is_curated, round(final_score + 1e-9, 6) as final_score, round(cume_dist() over (partition by is_curated
    order by final_score) + 1e-9, 6) as cdf from finals where has_llm""",
)
def _(w):
    scored = ranked(w).filter(F.col("has_llm"))
    return rounded(ranking.empirical_cdf(scored, "is_curated", "final_score"), "final_score", "cdf").drop("n")


@catalog.query(
    "k1_top_accounts",
    """select 'top' as kind, handle as name, human_score as value from (select * from profiles where human_score is not null
      order by human_score desc, twitter_id limit 10) a
    union all select 'bottom', handle, human_score from (select * from profiles where human_score is not null
      order by human_score, twitter_id limit 5) b
    union all select 'newest', keyword || '/' || page, cast(items as double) from (select * from searches
      order by query_at desc, keyword, page limit 10) c""",
)
def _(w):
    known = w.profiles.filter(F.col("human_score").isNotNull())
    shape = lambda df, kind, name, value: df.select(F.lit(kind).alias("kind"), name.alias("name"), value.alias("value"))
    top = known.orderBy(F.col("human_score").desc(), "twitter_id").limit(10)
    bottom = known.orderBy("human_score", "twitter_id").limit(5)
    newest = w.searches.orderBy(F.col("query_at").desc(), "keyword", "page").limit(10)
    page = F.concat_ws("/", "keyword", F.col("page").cast("string"))
    parts = shape(top, "top", F.col("handle"), F.col("human_score"))
    parts = parts.unionByName(shape(bottom, "bottom", F.col("handle"), F.col("human_score")))
    return parts.unionByName(shape(newest, "newest", page, F.col("items").cast("double")))


@catalog.query(
    "k2_largest_gaps",
    """select twitter_id, scored_by, has as human_score, llm, round(abs(has-llm) + 1e-9, 6) as gap from num
    order by abs(has-llm) desc, twitter_id, scored_by limit 10""",
    num=NUM,
)
def _(w):
    gaps = ranking.largest_gaps(w.profiles.filter(F.col("human_score").isNotNull()), w.profile_scores)
    return rounded(gaps.select("twitter_id", "scored_by", "human_score", "llm", "gap"), "gap")


# --- statistics --------------------------------------------------------------------------------------

@catalog.query(
    "a11_overview",
    """select 'profiles' as name, cast(count(*) as double) as value from profiles union all
    select 'mean_human_score', round(avg(human_score) + 1e-9, 6) from profiles union all
    select 'pending', cast(count(*) as double) from queue union all
    select 'with_stats', cast(count(*) as double) from user_stats union all
    select 'mean_followers', round(avg(followers) + 1e-9, 6) from user_stats union all
    select 'mean_following', round(avg(following) + 1e-9, 6) from user_stats union all
    select 'mean_statuses', round(avg(statuses) + 1e-9, 6) from user_stats""",
)
def _(w):
    return rounded(label_stats.overview(w.profiles, w.queue, w.user_stats), "value")


FIVE = """quantile_cont({0}, 0e0) as minimum, quantile_cont({0}, 0.25) as q1, quantile_cont({0}, 0.5) as median,
 quantile_cont({0}, 0.75) as q3, quantile_cont({0}, 1e0) as maximum"""
FIVE6 = """round(minimum + 1e-9, 6) as minimum, round(q1 + 1e-9, 6) as q1, round(median + 1e-9, 6) as median, round(q3 + 1e-9, 6) as q3, round(maximum + 1e-9, 6) as maximum"""


@catalog.query(
    "a12_describe",
    f"""select "count", round(mean + 1e-9, 6) as mean, round(std + 1e-9, 6) as std, {FIVE6} from (select count(human_score) as "count",
    avg(human_score) as mean, stddev_samp(human_score) as std, {FIVE.format('human_score')} from scores) t""",
)
def _(w):
    return rounded(label_stats.describe(w.scores), "mean", "std", "minimum", "q1", "median", "q3", "maximum")


@catalog.query(
    "a13_model_stats",
    f"""select scored_by, count(*) as n, round(avg(llm) + 1e-9, 6) as mean, median(llm) as median, round(stddev_samp(llm) + 1e-9, 6) as std,
    min(llm) as minimum, max(llm) as maximum, round(avg(has) + 1e-9, 6) as mean_has, count(*) filter (where llm>=0.7) as high,
    count(*) filter (where llm>=0.4 and llm<0.7) as medium, count(*) filter (where llm<0.4) as low,
    round({CORR.format('llm', 'has')} + 1e-9, 6) as correlation from num group by 1""",
    num=NUM,
)
def _(w):
    return rounded(label_stats.by_model(numbered(w)), "mean", "std", "mean_has", "correlation")


PAIRS = """select a.scored_by as model_a, b.scored_by as model_b, a.llm as llm_a, b.llm as llm_b from numbered_labels a
 join numbered_labels b using (twitter_id) where a.scored_by < b.scored_by"""


@catalog.query(
    "a14_model_agreement",
    f"""select model_a, model_b, count(*) as overlap, round({CORR.format('llm_a', 'llm_b')} + 1e-9, 6) as correlation,
    round(avg(abs(llm_a-llm_b)) + 1e-9, 6) as mean_difference from pairs group by 1, 2""",
    pairs=PAIRS,
)
def _(w):
    return rounded(label_stats.agreement(w.profile_scores), "correlation", "mean_difference")


@catalog.query(
    "a14_correlation_matrix",
    f"""with c as (select model_a, model_b, round({CORR.format('llm_a', 'llm_b')} + 1e-9, 6) as correlation from pairs group by 1, 2)
    select * from c union all select model_b, model_a, correlation from c
    union all select distinct scored_by, scored_by, 1e0 from numbered_labels""",
    pairs=PAIRS,
)
def _(w):
    return rounded(label_stats.correlation_matrix(w.profile_scores), "correlation")


@catalog.query(
    "a15_pivot_models",
    """select twitter_id, max(llm) filter (where scored_by='model-a') as model_a, max(llm) filter (where scored_by='model-b') as model_b,
    max(llm) filter (where scored_by='model-c') as model_c from numbered_labels group by 1""",
)
def _(w):
    wide = label_stats.pivot_models(w.profile_scores, ["model-a", "model-b", "model-c"])
    return wide.toDF("twitter_id", "model_a", "model_b", "model_c")


@catalog.query(
    "a16_keyword_frequency",
    """select keyword, count(*) as n from user_keywords where twitter_id in
    (select twitter_id from profile_scores where scored_by='model-a') group by 1 order by n desc, keyword limit 15""",
)
def _(w):
    return label_stats.keyword_frequency(keywords_of_model(w.user_keywords, w.profile_scores, "model-a"))


@catalog.query("a16_unique_keywords", "select count(distinct keyword) as unique_keywords from user_keywords")
def _(w):
    return label_stats.unique_keywords(w.user_keywords)


BOUGHT = """select p_brand as keyword, cast(o_orderdate as date) as day, o_custkey, l_extendedprice as price from orders join lineitem on l_orderkey=o_orderkey
 join part on p_partkey=l_partkey"""


@catalog.query(
    "a16_sketched_keywords",
    """select keyword, count(*) as n, count(distinct o_custkey) as accounts, true as accounts_close, true as median_close from bought
    where day between date '1993-01-01' and date '1996-12-31' group by 1""",
    bought=BOUGHT,
)
def _(w):
    """Sketches per keyword and day are stored, those of four years united, and held against exact counts."""
    lines = w.raw("lineitem").select("l_orderkey", "l_partkey", F.col("l_extendedprice").alias("price"))
    orders = w.raw("orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("twitter_id"), F.col("o_orderdate").cast("date").alias("day"))
    brands = w.raw("part").select("p_partkey", F.col("p_brand").alias("keyword"))
    rows = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).join(brands, F.col("l_partkey") == F.col("p_partkey"))
    stored = w.once(sketches.daily_sketches(rows, ["keyword"], "day", "twitter_id", "price"), "sketches")
    years = F.col("day").between(F.lit("1993-01-01").cast("date"), F.lit("1996-12-31").cast("date"))
    united = sketches.united(stored.filter(years), ["keyword"]).select("keyword", F.col("accounts").alias("estimate"), F.col("quantile").alias("median"))
    united = w.once(united, "united")
    ranked = rows.filter(years).join(united, "keyword").groupBy("keyword").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("twitter_id").alias("accounts"), F.max("estimate").alias("estimate"),
        F.count(F.when(F.col("price") < F.col("median"), 1)).alias("below"), F.count(F.when(F.col("price") <= F.col("median"), 1)).alias("up_to"),
    )
    return ranked.select(
        "keyword", "n", "accounts", sketches.close_count(F.col("estimate"), F.col("accounts")).alias("accounts_close"),
        sketches.close_rank(F.col("below"), F.col("up_to"), F.col("n")).alias("median_close"),
    )


@catalog.query(
    "e1_sketched_report",
    """select is_curated, count(*) as n, true as accounts_close, true as median_close from finals where has_llm group by 1""",
)
def _(w):
    """Median of the curated and of the general accounts from sketches of each platform."""
    scored = w.once(marked(w).filter("has_llm").select("twitter_id", "platform", "is_curated", "final_score"), "scored")
    stored = w.once(sketches.daily_sketches(scored, ["is_curated"], "platform", "twitter_id", "final_score"), "sketches")
    united = w.once(sketches.united(stored, ["is_curated"]).select("is_curated", F.col("accounts").alias("estimate"), F.col("quantile").alias("median")), "united")
    ranked = scored.join(united, "is_curated").groupBy("is_curated").agg(
        F.count(F.lit(1)).alias("n"), F.max("estimate").alias("estimate"), F.count(F.when(F.col("final_score") < F.col("median"), 1)).alias("below"),
        F.count(F.when(F.col("final_score") <= F.col("median"), 1)).alias("up_to"),
    )
    return ranked.select(
        "is_curated", "n", sketches.close_count(F.col("estimate"), F.col("n")).alias("accounts_close"),
        sketches.close_rank(F.col("below"), F.col("up_to"), F.col("n")).alias("median_close"),
    )


@catalog.query(
    "a17_keyword_means",
    """with m as (select keyword, avg(llm) as mean, count(*) as n from user_keywords join numbered_labels using (twitter_id)
      where scored_by='model-a' group by 1 having count(*) >= 5)
    select 'best' as side, keyword, round(mean + 1e-9, 6) as mean, n from (select * from m order by mean desc, keyword limit 5) a
    union all select 'worst', keyword, round(mean + 1e-9, 6), n from (select * from m order by mean, keyword limit 5) b""",
)
def _(w):
    own = w.profile_scores.filter(F.col("scored_by") == "model-a").withColumn("llm", label_to_number(F.col("label")))
    return rounded(label_stats.best_and_worst(label_stats.keyword_means(w.user_keywords, own)), "mean")


@catalog.query(
    "a18_histogram",
    """select cast(least(floor(human_score*20)+1, 20) as bigint) as bin, count(*) as n from scores
    where human_score is not null group by 1""",
)
def _(w):
    return label_stats.histogram(w.scores.filter(F.col("human_score").isNotNull()), "human_score", 20)


@catalog.query(
    "a19_label_differences",
    f"""select scored_by, {FIVE6} from (select scored_by, {FIVE.format('round(llm-has, 6)')} from num group by 1) t""",
    num=NUM,
)
def _(w):
    return rounded(label_stats.differences(numbered(w)), "minimum", "q1", "median", "q3", "maximum")


@catalog.query("a20_audience_counts", "select audience, count(*) as n from tagged group by 1", tagged=AUDIENCE_SQL)
def _(w):
    return label_stats.by_audience(labels_with_some_audience(w))


@catalog.query(
    "a21_global_stats",
    """select count(*) as total, round(avg(llm), 3) as mean, round(min(llm), 3) as minimum, round(max(llm), 3) as maximum,
    round(stddev_samp(llm), 3) as std from num""",
    num=NUM,
)
def _(w):
    return label_stats.global_stats(numbered(w))


@catalog.query(
    "a21_global_bands",
    """select case when llm>=0.9 then '0.90-1.00' when llm>=0.8 then '0.80-0.89' when llm>=0.7 then '0.70-0.79'
    when llm>=0.6 then '0.60-0.69' when llm>=0.5 then '0.50-0.59' else '0.00-0.49' end as bucket, count(*) as n
    from numbered_labels group by 1""",
)
def _(w):
    return label_stats.global_bands(w.profile_scores.withColumn("llm", label_to_number(F.col("label"))))


@catalog.query(
    "a22_global_correlation",
    f"""select round(c + 1e-9, 6) as correlation, case when c>0.7 then 'strong' when c>0.4 then 'moderate' when c is not null then 'weak' end
    as strength from (select {CORR.format('has', 'llm')} as c from num) t""",
    num=NUM,
)
def _(w):
    return rounded(label_stats.global_correlation(numbered(w)), "correlation")


@catalog.query(
    "a23_label_mix",
    """select case when label is null then 'null' when label then 'true' else 'false' end as label, count(*) as n,
    round(100e0*count(*)/(select count(*) from profile_scores) + 1e-9, 6) as percent from profile_scores group by 1""",
)
def _(w):
    return rounded(label_stats.label_mix(w.profile_scores), "percent")


# --- evaluation --------------------------------------------------------------------------------------

REPORT = """select is_curated, count(*) as n, avg(final_score) as mean, median(final_score) as median,
 stddev_samp(final_score) as std, min(final_score) as minimum, max(final_score) as maximum,
 count(*) filter (where final_score>=0.7) as above_high, count(*) filter (where final_score>=0.6) as above_medium,
 count(*) filter (where final_score<0.6) as below_medium,
 1-count(*) filter (where final_score>=0.7)*1e0/count(*) as fnr_high,
 1-count(*) filter (where final_score>=0.6)*1e0/count(*) as fnr_medium from finals where has_llm group by 1"""
RANKS = """select count(*) as n, avg(share) as mean_top_share, median(share) as median_top_share,
 count(*) filter (where share<=10) as in_top_10, count(*) filter (where share<=25) as in_top_25,
 count(*) filter (where share<=50) as in_top_50 from (select *, cume_dist() over (order by final_score desc)*100 as share
 from finals where has_llm) t where is_curated"""


@catalog.query(
    "e1_curated_report",
    """select is_curated, n, round(mean + 1e-9, 6) as mean, round(median + 1e-9, 6) as median, round(std + 1e-9, 6) as std,
    round(minimum + 1e-9, 6) as minimum, round(maximum + 1e-9, 6) as maximum, above_high, above_medium, below_medium,
    round(fnr_high + 1e-9, 6) as fnr_high, round(fnr_medium + 1e-9, 6) as fnr_medium from report""",
    report=REPORT,
)
def _(w):
    report = evaluation.curated_report(marked(w))
    return rounded(report, "mean", "median", "std", "minimum", "maximum", "fnr_high", "fnr_medium")


@catalog.query(
    "e1_dataset_counts",
    """select count(*) as total_profiles, count(*) filter (where is_curated) as total_curated,
    count(*) filter (where has_llm) as total_scored, count(*) filter (where is_curated and has_llm) as curated_scored,
    count(*) filter (where is_curated and not has_llm) as curated_unscored from finals""",
)
def _(w):
    return evaluation.dataset_counts(marked(w))


@catalog.query(
    "e2_rank_report",
    """select n, round(mean_top_share + 1e-9, 6) as mean_top_share, round(median_top_share + 1e-9, 6) as median_top_share, in_top_10, in_top_25,
    in_top_50 from ranks""",
    ranks=RANKS,
)
def _(w):
    return rounded(evaluation.rank_report(ranked(w)), "mean_top_share", "median_top_share")


@catalog.query(
    "e3_false_negatives",
    """select twitter_id, handle, round(final_score + 1e-9, 6) as final_score, human_score, avg_llm,
    replace(substring(case when bio is null or bio='' then 'No bio' else bio end, 1, 50), chr(10), ' ') as bio_preview
    from finals where is_curated and has_llm and final_score < 0.6""",
)
def _(w):
    rows = rounded(evaluation.false_negatives(marked(w)), "final_score")
    return rows.select("twitter_id", "handle", "final_score", "human_score", "avg_llm",
                       preview(F.col("bio"), 50).alias("bio_preview"))


@catalog.query(
    "e3_top_performers",
    """select twitter_id, handle, round(final_score + 1e-9, 6) as final_score from (select * from finals where is_curated and has_llm
    order by final_score desc, twitter_id limit 10) t""",
)
def _(w):
    return rounded(evaluation.top_performers(marked(w)), "final_score").select("twitter_id", "handle", "final_score")


@catalog.query(
    "e4_ratings",
    """select case when fnr_high<=0.1 then 'excellent' when fnr_high<=0.2 then 'good' else 'needs_improvement' end as fnr_high_rating,
    case when fnr_medium<=0.05 then 'excellent' when fnr_medium<=0.1 then 'good' else 'needs_improvement' end as fnr_medium_rating,
    case when mean_top_share<=15 then 'excellent' when mean_top_share<=30 then 'good' else 'needs_improvement' end as rank_rating,
    case when fnr_medium<=0.1 and mean_top_share<=25 then 'performs_well' else 'needs_tuning' end as overall
    from report, ranks where is_curated""",
    report=REPORT, ranks=RANKS,
)
def _(w):
    final = marked(w)
    return evaluation.ratings(evaluation.curated_report(final), evaluation.rank_report(final))


@catalog.query(
    "e5_validate_model",
    f"""select count(*) as seeds, round(avg(x) + 1e-9, 6) as mean, min(x) as minimum, round({CORR.format('x', 'y')} + 1e-9, 6) as correlation,
    avg(x)>0.75 and min(x)>0.5 as scores_pass, coalesce({CORR.format('x', 'y')}>0.85, false) as correlation_pass from (
    select a.llm as x, case when a.llm is not null then b.llm end as y from
    (select * from numbered_labels where scored_by='model-a') a
    left join (select * from numbered_labels where scored_by='model-b') b using (twitter_id)
    where twitter_id in (select twitter_id from user_keywords where keyword='Brand#1')) t""",
)
def _(w):
    seeds = w.user_keywords.filter(F.col("keyword") == "Brand#1")
    return rounded(evaluation.validate_model(w.profile_scores, seeds, "model-a", "model-b"), "mean", "correlation")


HISTORY = """select cast(o.o_custkey as varchar(25)) as twitter_id, l.l_linenumber%3 as scored_by,
 case l.l_returnflag when 'A' then true when 'R' then false else cast(null as boolean) end as label, l.l_shipdate as scored_at,
 l.l_orderkey*100+l.l_linenumber as seq, l.l_partkey,
 case when l.l_shipdate < timestamp '1998-01-01' then 'v0' else 'v1' end as audience
 from orders o join lineitem l on l.l_orderkey=o.o_orderkey"""


def label_history(w: Workspace) -> DataFrame:
    """Append-only label log: every line is one label. A sequence number breaks ties in time."""
    orders = w.raw("orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("twitter_id"))
    lines = w.raw("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_partkey")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select(
        "twitter_id",
        (F.col("l_linenumber") % 3).alias("scored_by"),
        F.when(F.col("l_returnflag") == "A", F.lit(True)).when(F.col("l_returnflag") == "R", F.lit(False)).alias("label"),
        F.struct(
            "l_shipdate", (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("seq"), "l_partkey"
        ).alias("scored_at"),
        F.when(F.col("l_shipdate") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"), "v0").otherwise("v1").alias("audience"),
    )


@catalog.query(
    "e6_audience_mix",
    """select audience, count(*) as n, count(*) filter (where label) as n_true, count(*) filter (where not label) as n_false,
    count(*) filter (where label is null) as n_null from history group by 1""",
    history=HISTORY,
)
def _(w):
    return evaluation.audience_mix(label_history(w))


@catalog.query(
    "e6_audience_flips",
    """with last as (select *, row_number() over (partition by twitter_id, scored_by, audience
      order by scored_at desc, seq desc, l_partkey desc) as rn from history)
    select case when a.label is null then 'null' when a.label then 'true' else 'false' end as old_label,
    case when b.label is null then 'null' when b.label then 'true' else 'false' end as new_label, count(*) as n
    from last a join last b on a.twitter_id=b.twitter_id and a.scored_by=b.scored_by
    where a.audience='v0' and b.audience='v1' and a.rn=1 and b.rn=1 group by 1, 2""",
    history=HISTORY,
)
def _(w):
    return evaluation.audience_flips(label_history(w), "v0", "v1")
