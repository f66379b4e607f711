"""Queries over account records: reading, cleaning, scoring, re-scoring."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithscope.functions import bands, text
from kithscope.functions.authenticity import FEATURES, SCORES, score_accounts, sweep_configs
from kithscope.functions.numbers import count_if, r6
from kithscope.functions.scoring_config import DEFAULT_CONFIG, config_from_json, merge_config
from kithscope.functions.times import age_in_days, parse_created_at, platform_text
from kithscope.operators import accounts, rescore
from kithscope.plans.catalog import Catalog
from kithscope.plans.oracle import AS_OF, scoring_sql
from kithscope.plans.workspace import Workspace
from kithscope.schemas import RAW_USER_DDL
from kithscope.session import scratch_path
from kithscope.sources import search_pages, tables

catalog = Catalog()

# Same cleaning as functions.text, spelled for the second engine.
EDGE = r"[\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+"


def trim_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{EDGE}|{EDGE}$', '', 'g')"


def cell_sql(x: str) -> str:
    t = trim_sql(f"regexp_replace({x}, '[\\n\\r]+', ' ', 'g')")
    return f"""case when regexp_matches({t}, '[,"\\t]') then '"' || replace({t}, '"', '""') || '"' else {t} end"""


def clean_sql(x: str) -> str:
    return trim_sql(f"""regexp_replace({x}, '[\\\\"'',\\x00-\\x1F\\x7F]', '', 'g')""")


def cleaned_sql(x: str) -> str:
    return f"case when {x} is not null and {x}<>'' then {clean_sql(x)} end"


def raw_users(w: Workspace) -> DataFrame:
    """Nested account records with the page each one came on: 20 consecutive ids form a page.

    Bios are joined last and by page, within which ids are compared: they move once, to where a page is put together.
    """
    k = F.col("twitter_id").cast("bigint")
    accounts = w.accounts.join(w.user_stats, "twitter_id").withColumns({"k": k, "page": F.floor(k / 20)})
    bios = w.bios.withColumn("bio_page", F.floor(F.col("doc_id") / 20))
    # As two bounds the ids are no join key beside the page, by which alone the rows are dealt.
    own = (F.col("page") == F.col("bio_page")) & F.col("k").between(F.col("doc_id"), F.col("doc_id"))
    return accounts.join(bios, own, "left").select("k", "page", search_pages.nest_user().alias("user"))


def raw_pages(w: Workspace) -> DataFrame:
    """JSON search responses. A page holds at most 20 records, so collecting one is bounded."""
    rows = F.array_sort(F.collect_list(F.struct("k", "user")))
    pages = raw_users(w).groupBy("page").agg(rows.alias("rows"))
    body = F.struct(
        F.transform("rows", lambda r: r["user"]).alias("data"),
        F.concat(F.lit("c"), F.col("page").cast("string")).alias("cursor"),
    )
    return pages.select("page", F.to_json(body).alias("value"))


def parsed_pages(w: Workspace) -> DataFrame:
    ddl = f"data array<{RAW_USER_DDL}>, cursor string"
    return raw_pages(w).select("page", F.from_json("value", ddl).alias("p")).select("page", "p.data", "p.cursor")


# --- sources -----------------------------------------------------------------------------------------

@catalog.query(
    "s1_search_pages",
    "select twitter_id, handle, followers, following, statuses from user_stats join user_profiles using (twitter_id)",
)
def _(w):
    path = scratch_path(w.spark, "pages")
    raw_pages(w).select("value").write.text(path)
    users = search_pages.explode_users(search_pages.read_search_pages(w.spark, path))
    legacy = F.col("user.legacy")
    return users.select(
        F.col("user.rest_id").alias("twitter_id"), legacy["screen_name"].alias("handle"),
        legacy["followers_count"].alias("followers"), legacy["friends_count"].alias("following"),
        legacy["statuses_count"].alias("statuses"),
    )


@catalog.query("s2_read_tables", "select twitter_id, keyword, added_at from user_keywords")
def _(w):
    root = scratch_path(w.spark, "tables")
    stored = w.user_keywords.select("twitter_id", "keyword", F.lit(None).cast("string").alias("search_id"), "added_at")
    stored.write.parquet(f"{root}/user_keywords")
    return tables.read_table(w.spark, root, "user_keywords").select("twitter_id", "keyword", "added_at")


@catalog.query(
    "s12_table_cells",
    f"""select doc_id, case when regexp_matches(t, '[,"\\t]') then '"' || replace(t, '"', '""') || '"' else t end as cell
    from (select doc_id, {trim_sql("regexp_replace(text, '[" + chr(92) + "n" + chr(92) + "r]+', ' ', 'g')")} as t
    from documents) x""",
)
def _(w):
    return w.raw("documents").select("doc_id", text.table_cell(F.col("text")).alias("cell"))


# --- cleaning ----------------------------------------------------------------------------------------

@catalog.query(
    "p1_flatten_profiles",
    f"""select p.twitter_id, p.handle, p.name, {cleaned_sql('p.bio')} as bio, {cleaned_sql('p.location')} as location,
    {cleaned_sql('p.category')} as category, s.followers as follower_count, p.can_dm
    from user_profiles p join user_stats s using (twitter_id)""",
)
def _(w):
    users = parsed_pages(w).select(F.explode("data").alias("user"))
    return users.select(*accounts.flatten_profile(F.col("user"))).drop("created_at")


@catalog.query(
    "p2_flatten_stats",
    """select twitter_id, followers, following, statuses, favorites, listed, media, false as verified,
    blue_verified, default_profile, default_image, sensitive, can_dm, created_at
    from user_stats join user_profiles using (twitter_id)""",
)
def _(w):
    users = parsed_pages(w).select(F.explode("data").alias("user"))
    return users.select(*accounts.scoring_input(F.col("user")))


@catalog.query("p3_normalize_text", f"select doc_id, {clean_sql('text')} as clean from documents")
def _(w):
    return w.raw("documents").select("doc_id", text.normalize_text(F.col("text")).alias("clean"))


@catalog.query("p4_first_category", "select twitter_id, category from user_profiles")
def _(w):
    users = parsed_pages(w).select(F.explode("data").alias("user"))
    return users.select(
        F.col("user.rest_id").alias("twitter_id"), text.first_category(F.col("user.professional")).alias("category")
    )


@catalog.query(
    "p5_account_age",
    f"""select twitter_id, round(case when created_at is not null then greatest(0e0,
    (epoch_us(timestamp '{AS_OF}')-epoch_us(created_at))/86400000000e0) end + 1e-9, 6) as account_days from user_stats""",
)
def _(w):
    spelled = F.when(
        F.col("twitter_id").cast("bigint") % 2 == 0, platform_text(F.col("created_at"))
    ).otherwise(F.col("created_at").cast("string"))
    texts = w.user_stats.select("twitter_id", spelled.alias("created_at"))
    days = age_in_days(parse_created_at(F.col("created_at")), w.as_of)
    return texts.select("twitter_id", r6(days).alias("account_days"))


@catalog.query("p6_label_numbers", "select twitter_id, scored_by, llm from numbered_labels")
def _(w):
    return w.profile_scores.select("twitter_id", "scored_by", bands.label_to_number(F.col("label")).alias("llm"))


@catalog.query(
    "p7_score_labels",
    """select case when human_score>=0.7 then true when human_score<0.4 then false end as label, count(*) as n
    from scores group by 1""",
)
def _(w):
    return w.scores.groupBy(bands.number_to_label(F.col("human_score")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


AUDIENCE_SQL = """select twitter_id, scored_by, scored_at,
  case when reason='1-URGENT' then 'seed' end as audience from profile_scores"""


def labels_with_some_audience(w: Workspace) -> DataFrame:
    return w.profile_scores.withColumn("audience", F.when(F.col("reason") == "1-URGENT", "seed"))


@catalog.query(
    "p8_backfill_audience",
    """select coalesce(audience, case when scored_at < timestamp '1999-01-01' then 'panel.v0' else 'panel.v1' end)
    as audience, count(*) as n from tagged group by 1""",
    tagged=AUDIENCE_SQL,
)
def _(w):
    cutoff = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    done = accounts.backfill_audience(labels_with_some_audience(w), cutoff, "panel.v0", "panel.v1")
    return done.groupBy("audience").agg(F.count(F.lit(1)).alias("n"))


@catalog.query(
    "p8_backfill_preview",
    """select count(*) filter (where scored_at < timestamp '1999-01-01') as before_cutoff,
    count(*) filter (where scored_at >= timestamp '1999-01-01') as after_cutoff, count(audience) as already_set
    from tagged""",
    tagged=AUDIENCE_SQL,
)
def _(w):
    return accounts.backfill_preview(labels_with_some_audience(w), F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"))


BRAND_TAGS = [(("#academia", "#research"), ("Brand#1", "Brand#2", "Brand#13")), (("#industry",), ("Brand#5", "Brand#7"))]


@catalog.query(
    "p9_assign_tags",
    """select keyword, case when keyword in ('Brand#1','Brand#2','Brand#13') then '#academia,#research'
    when keyword in ('Brand#5','Brand#7') then '#industry' else '' end as tags,
    keyword not in ('Brand#1','Brand#2','Brand#13','Brand#5','Brand#7') as untagged
    from (select distinct keyword from user_keywords) k""",
)
def _(w):
    pool = w.user_keywords.select("keyword").distinct()
    pool = pool.withColumn("semantic_tags", F.array().cast("array<string>"))
    tagged = accounts.assign_tags(pool, accounts.tag_table(w.spark, BRAND_TAGS))
    return tagged.select(
        "keyword", F.array_join("semantic_tags", ",").alias("tags"), (F.size("semantic_tags") == 0).alias("untagged")
    )


@catalog.query(
    "p10_page_fingerprint",
    """select cast(floor(k/20) as bigint) as page, substring(md5(string_agg(handle, ',' order by k)), 1, 16) as ids_hash,
    count(*) as items from (select cast(twitter_id as bigint) as k, handle from user_profiles) t group by 1""",
)
def _(w):
    handles = F.transform("data", lambda u: u["legacy"]["screen_name"])
    return parsed_pages(w).select(
        "page", accounts.page_fingerprint(handles).alias("ids_hash"), F.size("data").cast("bigint").alias("items")
    )


@catalog.query(
    "p11_split_tags",
    """select p_partkey, array_to_string(list_filter(list_transform(string_split(tags, ','), lambda t: trim(t)), lambda t: t<>''), '|')
    as tags from (select p_partkey, ' ' || replace(p_name, ' ', ' , ') || ',, ' || p_brand as tags from part) x""",
)
def _(w):
    joined = F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit(" , ")), F.lit(",, "), F.col("p_brand"))
    return w.raw("part").select("p_partkey", F.array_join(text.split_tags(joined), "|").alias("tags"))


@catalog.query(
    "p12_file_stems",
    r"""select distinct keyword, lower(regexp_replace(regexp_replace(regexp_replace(keyword, '^@', ''),
    '[^a-zA-Z0-9_-]', '_', 'g'), '_+', '_', 'g')) as export_stem,
    regexp_replace(keyword, '[^a-zA-Z0-9_-]', '_', 'g') as label_stem
    from (select keyword from user_keywords union all select p_type || ' / ' || p_name from part) k""",
)
def _(w):
    part = w.raw("part").select(F.concat_ws(" / ", "p_type", "p_name").alias("keyword"))
    pool = w.user_keywords.select("keyword").unionByName(part).distinct()
    return pool.select(
        "keyword", text.export_file_stem(F.col("keyword")).alias("export_stem"),
        text.label_file_stem(F.col("keyword")).alias("label_stem"),
    )


HOLES_SQL = """select twitter_id, created_at,
  case when k%7=0 then null else followers end as followers, case when k%7=1 then null else following end as following,
  case when k%7=2 then null else statuses end as statuses, case when k%7=3 then null else favorites end as favorites,
  case when k%7=4 then null else listed end as listed, case when k%7=5 then null else media end as media,
  case when k%5=0 then null else blue_verified end as blue_verified,
  case when k%5=1 then null else default_profile end as default_profile,
  case when k%5=2 then null else default_image end as default_image,
  case when k%5=3 then null else sensitive end as sensitive
  from (select *, cast(twitter_id as bigint) as k from user_stats) t"""
FILLED_SQL = """select twitter_id, created_at, coalesce(followers,0) as followers, coalesce(following,0) as following,
  coalesce(statuses,0) as statuses, coalesce(favorites,0) as favorites, coalesce(listed,0) as listed,
  coalesce(media,0) as media, coalesce(blue_verified,false) as blue_verified,
  coalesce(default_profile,true) as default_profile, coalesce(default_image,true) as default_image,
  coalesce(sensitive,false) as sensitive from holes"""


def stats_with_holes(w: Workspace) -> DataFrame:
    k = F.col("twitter_id").cast("bigint")
    counts = ["followers", "following", "statuses", "favorites", "listed", "media"]
    flags = ["blue_verified", "default_profile", "default_image", "sensitive"]
    holes = {c: F.when(k % 7 != i, F.col(c)) for i, c in enumerate(counts)}
    holes |= {c: F.when(k % 5 != i, F.col(c)) for i, c in enumerate(flags)}
    return w.user_stats.withColumns(holes)


@catalog.query(
    "p13_missing_stats",
    "select twitter_id, score4 as human_score, cls as likely_is from rescored",
    holes=HOLES_SQL, filled=FILLED_SQL, rescored=scoring_sql("filled"),
)
def _(w):
    filled = accounts.fill_missing_stats(stats_with_holes(w))
    return score_accounts(filled, w.as_of).select("twitter_id", "human_score", "likely_is")


@catalog.query(
    "p14_labelable",
    "select twitter_id, handle from user_profiles where bio is not null and bio<>'' and name is not null and name<>''",
)
def _(w):
    return accounts.labelable(w.user_profiles).select("twitter_id", "handle")


@catalog.query(
    "p15_score_gates",
    """select count(*) filter (where human_score>0.65) as queued, count(*) filter (where human_score>0.55) as labelled,
    count(*) filter (where human_score>0.6) as bulk from scores""",
)
def _(w):
    s = F.col("human_score")
    return w.scores.agg(
        count_if(s > bands.QUEUE_GATE).alias("queued"), count_if(s > bands.LABEL_GATE).alias("labelled"),
        count_if(s > bands.BULK_LABEL_GATE).alias("bulk"),
    )


@catalog.query(
    "p16_score_buckets",
    """select case when human_score>=0.9 then '0.9-1.0' when human_score>=0.8 then '0.8-0.9'
    when human_score>=0.7 then '0.7-0.8' when human_score>=0.6 then '0.6-0.7' when human_score>=0.5 then '0.5-0.6'
    else '<0.5' end as bucket, count(*) as n from scores where human_score is not null group by 1""",
)
def _(w):
    scored = w.scores.filter(F.col("human_score").isNotNull())
    return scored.groupBy(bands.score_bucket(F.col("human_score")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@catalog.query(
    "p17_levels",
    """select case when human_score>=0.7 then 'high' when human_score>=0.4 then 'medium' when human_score is not null then 'low' end as level,
    case when human_score>=0.7 then 'high' when human_score>=0.6 then 'marginal' when human_score is not null then 'miss' end as curated_level,
    count(*) as n from scores group by 1, 2""",
)
def _(w):
    s = F.col("human_score")
    return w.scores.groupBy(bands.level(s).alias("level"), bands.curated_level(s).alias("curated_level")).agg(
        F.count(F.lit(1)).alias("n")
    )


@catalog.query(
    "p18_model_names",
    """select case scored_by when 'model-a' then 'vendor/model-a-2024' when 'model-b' then 'vendor/model-b-2025'
    else scored_by end as scored_by, count(*) as n from profile_scores group by 1""",
)
def _(w):
    names = accounts.model_table(w.spark, [("model-a", "vendor/model-a-2024"), ("model-b", "vendor/model-b-2025")])
    return accounts.canonical_model(w.profile_scores, names).groupBy("scored_by").agg(F.count(F.lit(1)).alias("n"))


@catalog.query(
    "p19_follow_ratio",
    """select twitter_id, round(following/(followers+1e0) + 1e-9, 6) as follow_ratio from user_stats
    where followers>0 and following/(followers+1e0) < 10""",
)
def _(w):
    return accounts.follow_ratio(w.user_stats).select("twitter_id", r6(F.col("follow_ratio")).alias("follow_ratio"))


@catalog.query(
    "p20_bio_preview",
    """select twitter_id, replace(substring(case when bio is null or bio='' then 'No bio' else bio end, 1, 50), chr(10), ' ')
    as preview from user_profiles""",
)
def _(w):
    return w.user_profiles.select("twitter_id", text.preview(F.col("bio"), 50).alias("preview"))


@catalog.query(
    "p21_action_bands",
    """select twitter_id, case when human_score is null then null when human_score>=0.85 then 'priority'
    when human_score>=0.65 then 'include' when human_score>=0.45 then 'caution' when human_score>=0.2 then 'review'
    else 'discard' end as authenticity_action, case when final_score is null then null when final_score>=0.8 then 'priority'
    when final_score>=0.7 then 'target' when final_score>=0.6 then 'include' else 'exclude' end as final_action
    from finals""",
)
def _(w):
    from kithscope.operators.ranking import final_scores

    final = final_scores(w.profiles, w.profile_scores)
    return final.select(
        "twitter_id", bands.authenticity_action(F.col("human_score")).alias("authenticity_action"),
        bands.final_action(F.col("final_score")).alias("final_action"),
    )


# --- scoring -----------------------------------------------------------------------------------------

def detail(w: Workspace) -> DataFrame:
    return score_accounts(w.user_stats, w.as_of, detail=True)


@catalog.query(
    "h1_features",
    """select twitter_id, round(age_d + 1e-9, 6) as account_days, round(rat + 1e-9, 6) as ratio, round(rn + 1e-9, 6) as ratio_norm,
    round(eng + 1e-9, 6) as engagement, round(lis + 1e-9, 6) as list_presence, round(med + 1e-9, 6) as media_share, round(agec + 1e-9, 6) as age_curve,
    round(act + 1e-9, 6) as activity, round(cust + 1e-9, 6) as customised, round(saf + 1e-9, 6) as safety, round(ver + 1e-9, 6) as verified from detail""",
)
def _(w):
    return detail(w).select("twitter_id", r6(F.col("account_days")).alias("account_days"),
                            *[r6(F.col(f)).alias(f) for f in FEATURES])


def _one_score(name: str, sql_name: str) -> None:
    @catalog.query(f"{name}", f"select twitter_id, round({sql_name} + 1e-9, 6) as score from detail")
    def _(w):
        return detail(w).select("twitter_id", r6(F.col(name.split("_", 1)[1])).alias("score"))


_one_score("h2_bot_score", "bot")
_one_score("h3_creator_score", "creator")
_one_score("h4_entity_score", "entity")
_one_score("h5_person_score", "person")
_one_score("h6_penalty", "penalty")


@catalog.query("h7_authenticity", "select twitter_id, human_score, likely_is from scores")
def _(w):
    return w.scores


@catalog.query(
    "h8_detailed_scores",
    """select twitter_id, round(bot + 1e-9, 6) as bot_score, round(creator + 1e-9, 6) as creator_score, round(entity + 1e-9, 6) as entity_score,
    round(person + 1e-9, 6) as person_score, round(penalty + 1e-9, 6) as penalty, round(act + 1e-9, 6) as activity, score4 as human_score,
    cls as likely_is from detail""",
)
def _(w):
    return detail(w).select("twitter_id", *[r6(F.col(s)).alias(s) for s in [*SCORES, "activity"]], "human_score", "likely_is")


STRICT = {"classificationThresholds": {"human": 0.7, "bot": 0.5}, "penalties": {"zeroStatuses": 0.1, "defaultProfile": 0.5},
          "personWeights": {"engaged": 0.2}}
STRICT_SQL = {"human": 0.7, "bot": 0.5, "zero_statuses": 0.1, "default_profile": 0.5, "engaged": 0.2}


@catalog.query(
    "h9_custom_config",
    "select twitter_id, score4 as human_score, cls as likely_is from strict",
    strict=scoring_sql("user_stats", STRICT_SQL),
)
def _(w):
    return score_accounts(w.user_stats, w.as_of, merge_config(STRICT)).select("twitter_id", "human_score", "likely_is")


def changes(w: Workspace) -> DataFrame:
    stored = w.user_stats.join(w.profiles.select("twitter_id", "handle", "human_score", "likely_is"), "twitter_id")
    return rescore.rescore(stored, w.as_of, merge_config(STRICT))


CHANGES_SQL = """select s.twitter_id, p.handle, o.human_score as old_score, o.likely_is as old_class, s.score4 as new_score,
  s.cls as new_class, s.score4-o.human_score as diff from strict s join scores o using (twitter_id)
  join user_profiles p using (twitter_id) where o.human_score is not null"""
STRICT_VIEWS = {"strict": scoring_sql("user_stats", STRICT_SQL), "changed": CHANGES_SQL}


@catalog.query(
    "h10_change_summary",
    """select count(*) filter (where abs(diff)>=0.001 and diff>0) as upgrades,
    count(*) filter (where abs(diff)>=0.001 and diff<=0) as downgrades,
    count(*) filter (where abs(diff)<0.001) as unchanged,
    count(*) filter (where old_class<>new_class) as class_changes from changed""",
    **STRICT_VIEWS,
)
def _(w):
    return rescore.change_summary(changes(w))


BUCKET = """case when {0}>=0.9 then '0.9-1.0' when {0}>=0.8 then '0.8-0.9' when {0}>=0.7 then '0.7-0.8'
 when {0}>=0.6 then '0.6-0.7' when {0}>=0.5 then '0.5-0.6' else '<0.5' end"""


@catalog.query(
    "h10_distributions",
    f"""select kind, name, cast(sum(o) as bigint) as old_count, cast(sum(w) as bigint) as new_count,
    cast(sum(w)-sum(o) as bigint) as change from (
      select 'bucket' as kind, {BUCKET.format('old_score')} as name, 1 as o, 0 as w from changed union all
      select 'bucket', {BUCKET.format('new_score')}, 0, 1 from changed union all
      select 'class', old_class, 1, 0 from changed union all
      select 'class', new_class, 0, 1 from changed) t group by kind, name""",
    **STRICT_VIEWS,
)
def _(w):
    return rescore.distributions(changes(w))


@catalog.query(
    "h10_biggest_downgrades",
    """select handle, old_score, new_score, round(diff + 1e-9, 6) as diff, old_class, new_class from changed
    where abs(diff)>=0.001 and diff<=0 order by diff, handle limit 20""",
    **STRICT_VIEWS,
)
def _(w):
    top = rescore.biggest_downgrades(changes(w))
    return top.select("handle", "old_score", "new_score", r6(F.col("diff")).alias("diff"), "old_class", "new_class")


@catalog.query(
    "h11_config_sweep",
    """select config_name, cls as likely_is, count(*) as n, round(avg(score4) + 1e-9, 6) as mean_score from (
      select 'default' as config_name, cls, score4 from detail union all
      select 'strict', cls, score4 from strict) t group by 1, 2""",
    strict=scoring_sql("user_stats", STRICT_SQL),
)
def _(w):
    swept = sweep_configs(w.user_stats, w.as_of, {"default": DEFAULT_CONFIG, "strict": merge_config(STRICT)})
    return swept.groupBy("config_name", "likely_is").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("human_score")).alias("mean_score")
    )


@catalog.query(
    "x2_config_plugin",
    "select twitter_id, score4 as human_score, cls as likely_is from strict",
    strict=scoring_sql("user_stats", STRICT_SQL),
)
def _(w):
    """The strict config as the JSON text a caller would bring."""
    config = config_from_json(json.dumps(STRICT))
    return score_accounts(w.user_stats, w.as_of, config).select("twitter_id", "human_score", "likely_is")
