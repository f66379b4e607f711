"""Queries for label batches and for the worth model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithscope.functions.numbers import r6, row_count
from kithscope.functions.text import latin_share, strip_code_fence
from kithscope.operators import label_batches, lookups, sampling, worth
from kithscope.plans.account_queries import cell_sql, trim_sql
from kithscope.plans.catalog import Catalog
from kithscope.plans.evaluation_queries import marked
from kithscope.plans.workspace import CURATED, Workspace
from kithscope.session import scratch_path
from kithscope.sources.delimited import read_audience

catalog = Catalog()

# --- label batches -----------------------------------------------------------------------------------


def audience(w: Workspace) -> DataFrame:
    """One audience per market segment, with the brands its accounts bought as signals."""
    brands = w.raw("part").groupBy(F.col("p_type").alias("targetProfile")).agg(
        F.array_sort(F.collect_set("p_brand")).alias("highSignals")
    )
    return brands.select(
        "targetProfile", F.lit("industry").alias("sector"), "highSignals",
        F.array(F.lit("brand account"), F.lit("no bio")).alias("lowSignals"), F.lit("People who buy parts.").alias("domainContext"),
    )


def _prompt_sql() -> str:
    """The template with its places replaced; given texts hold no place themselves."""
    template = "'" + label_batches.SYSTEM_TEMPLATE.replace("'", "''") + "'"
    low = "'- brand account' || chr(10) || '- no bio'"
    for place, value in {"{target}": "p_type", "{sector}": "'INDUSTRY'", "{context}": "'People who buy parts.'", "{high}": "brands", "{low}": low, "{{": "'{'", "}}": "'}'"}.items():
        template = f"replace({template}, '{place}', {value})"
    return f"""select p_type as "targetProfile", {template} as system_prompt from (select p_type,
      string_agg('- ' || p_brand, chr(10) order by p_brand) as brands from (select distinct p_type, p_brand from part) t group by 1) u"""


@catalog.query("l3_system_prompts", _prompt_sql())
def _(w):
    return label_batches.system_prompt(audience(w)).select("targetProfile", "system_prompt")


def work(w: Workspace) -> DataFrame:
    return lookups.label_work_list(w.profiles, w.user_stats, w.queue, w.profile_scores, "rules", limit=None)


PROMPT_ROWS = f"""select q.twitter_id, '  ' || {cell_sql("p.handle")} || ',' || {cell_sql("p.name")} || ',' || {cell_sql("p.bio")} || ',' || coalesce({cell_sql("p.category")}, 'null') || ',' ||
 coalesce(followers, 0) as line from queue q join user_profiles p using (twitter_id) left join user_stats using (twitter_id) where p.bio<>'' and p.name<>''"""


@catalog.query(
    "l4_user_prompts",
    """select shard, batch_no, count(*) as size, 'Accounts to judge: ' || count(*) || chr(10) || chr(10) || '```toon' || chr(10) || '[' || count(*) || ']{handle,name,bio,category,followers}:' || chr(10)
    || string_agg(line, chr(10) order by twitter_id) || chr(10) || '```' as user_prompt from (select *, (row_number() over (partition by shard order by twitter_id) - 1) // 25 as batch_no
    from (select *, cast('0x' || substring(md5(twitter_id), 1, 8) as bigint) % (select greatest(1, (count(*) + 99) // 100) from prompt_rows) as shard from prompt_rows) t) u group by 1, 2""",
    prompt_rows=PROMPT_ROWS,
)
def _(w):
    rows = work(w)
    return label_batches.user_prompts(rows, 25, sampling.shard_count(rows, 100))


@catalog.query(
    "l5_code_fences",
    f"""select doc_id, {trim_sql("regexp_replace(regexp_replace(" + trim_sql("t") + ", '^```(json)?', ''), '```$', '')")} as clean from (
    select doc_id, case doc_id%4 when 0 then '```json' || chr(10) || text || chr(10) || '```' when 1 then ' ```' || text || '``` '
    when 2 then text || '```' else text end as t from documents) x""",
)
def _(w):
    k, text = F.col("doc_id") % 4, F.col("text")
    fenced = (
        F.when(k == 0, F.concat(F.lit("```json\n"), text, F.lit("\n```")))
        .when(k == 1, F.concat(F.lit(" ```"), text, F.lit("``` ")))
        .when(k == 2, F.concat(text, F.lit("```")))
        .otherwise(text)
    )
    return w.raw("documents").select("doc_id", strip_code_fence(fenced).alias("clean"))


def responses(w: Workspace, *models: str) -> DataFrame:
    """Answers of the models for batches of 25 ids, every seventh broken in one of seven ways."""
    own = w.profile_scores.filter(F.col("scored_by").isin(*models or ["model-a"]))
    rows = own.join(w.user_profiles.select("twitter_id", "handle"), "twitter_id")
    batch = F.floor(F.col("twitter_id").cast("bigint") / 25)
    way = F.when(F.col("batch") % 7 == 0, F.floor(F.col("batch") / 7) % 7).otherwise(-1)
    reason = F.when(F.col("way") == 6, F.repeat(F.lit("x"), 600)).otherwise(F.col("reason"))
    item = F.struct(F.upper("handle").alias("handle"), "label", reason.alias("reason"))
    # At most 25 items form an answer.
    packed = rows.withColumn("batch", batch).withColumn("way", way).groupBy("batch", "way", "scored_by").agg(F.collect_list(item).alias("items"))
    stranger = F.array(F.struct(F.lit("nobody").alias("handle"), F.lit(True).alias("label"), F.lit("?").alias("reason")))
    items = F.when(F.col("way") == 4, F.concat("items", stranger)).when(F.col("way") == 5, F.concat("items", "items")).otherwise(F.col("items"))
    body = F.to_json(items, {"ignoreNullFields": "false"})
    text = (
        F.when(F.col("way") == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(F.col("way") == 1, F.substring(body, F.lit(1), F.length(body) - 2))
        .when(F.col("way") == 2, F.replace(body, F.lit('"label":'), F.lit('"label":"yes","was":')))
        .when(F.col("way") == 3, F.replace(body, F.lit('"reason":'), F.lit('"why":')))
        .otherwise(body)
    )
    return packed.select("batch", "scored_by", text.alias("response"))


PARSED = """select twitter_id, handle, label, case when way=6 then repeat('x', 500) else reason end as reason, unnest(range(case when way=5 then 2 else 1 end)) as copy
 from (select *, case when b%7=0 then (b//7)%7 else -1 end as way from (select s.*, upper(p.handle) as handle, cast(s.twitter_id as bigint)//25 as b
 from profile_scores s join user_profiles p using (twitter_id) where scored_by='model-a') t) u where way not in (1, 2, 3)"""


@catalog.query("l6_checked_responses", "select twitter_id, handle, label, reason from parsed", parsed=PARSED)
def _(w):
    items = label_batches.parse_responses(responses(w), ["batch"])
    own = w.user_profiles.select(F.floor(F.col("twitter_id").cast("bigint") / 25).alias("batch"), "twitter_id", "handle")
    return label_batches.match_labels(items, own, ["batch"]).select("twitter_id", "handle", "label", "reason")


@catalog.query(
    "l6_response_errors",
    """select count(*) as batches, 0 as failed, count(*) filter (where way in (1, 2, 3)) as refused from (select distinct b,
    case when b%7=0 then (b//7)%7 else -1 end as way from (select cast(twitter_id as bigint)//25 as b from profile_scores
    where scored_by='model-a') t) u""",
)
def _(w):
    return label_batches.response_errors(responses(w))


MODELS = ["model-a", "model-b", "model-c"]
ALL_PARSED = PARSED.replace(" where scored_by='model-a'", "").replace("select twitter_id, handle,", "select twitter_id, scored_by, handle,")


@catalog.query("l6_all_responses", "select twitter_id, scored_by, handle, label, reason from parsed", parsed=ALL_PARSED)
def _(w):
    keys = ["batch", "scored_by"]
    items = label_batches.parse_responses(responses(w, *MODELS), keys)
    batch = F.floor(F.col("twitter_id").cast("bigint") / 25).alias("batch")
    own = w.user_profiles.select(batch, F.explode(F.array(*[F.lit(m) for m in MODELS])).alias("scored_by"), "twitter_id", "handle")
    return label_batches.match_labels(items, own, keys).select("twitter_id", "scored_by", "handle", "label", "reason")


@catalog.query(
    "l6_all_response_errors",
    """select count(*) as batches, 0 as failed, count(*) filter (where way in (1, 2, 3)) as refused from (select distinct b, scored_by,
    case when b%7=0 then (b//7)%7 else -1 end as way from (select scored_by, cast(twitter_id as bigint)//25 as b from profile_scores) t) u""",
)
def _(w):
    return label_batches.response_errors(responses(w, *MODELS))


SIGNALS = {"highSignals": ["the ", "und "], "lowSignals": ["que ", "http"]}
RULES = """select p.twitter_id, p.handle, case when (contains(lower(bio), 'the ') or contains(lower(bio), 'und '))
  and (contains(lower(bio), 'que ') or contains(lower(bio), 'http')) then null
  else contains(lower(bio), 'the ') or contains(lower(bio), 'und ') end as label
 from queue q join user_profiles p using (twitter_id) where p.bio<>'' and p.name<>''"""


@catalog.query("l7_run_labeler", "select twitter_id, handle, label from rules", rules=RULES)
def _(w):
    labels, _answers = label_batches.label_accounts(
        work(w), label_batches.signal_labeler, "rules", SIGNALS, shards=8, parallel=8
    )
    return labels.select("twitter_id", "handle", "label")


@catalog.query(
    "l7_signal_columns",
    """select twitter_id, handle, label, case when label is null then 'mixed signals' when label then 'has a positive signal' else 'no positive signal' end as reason from rules""",
    rules=RULES,
)
def _(w):
    return label_batches.signal_labels(work(w), "rules", SIGNALS).drop("scored_by")


@catalog.query(
    "l8_save_labels",
    """select count(*) filter (where twitter_id not in (select twitter_id from stored)) as labeled,
    count(*) filter (where twitter_id in (select twitter_id from stored)) as skipped, 0 as errors from rules""",
    rules=RULES,
    stored="select twitter_id from profile_scores where scored_by='model-a'",
)
def _(w):
    labels, answers = label_batches.label_accounts(
        work(w), label_batches.signal_labeler, "model-a", SIGNALS, shards=8, parallel=8
    )
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    fresh = label_batches.as_stored(labels, "panel.v1", now)
    stored = w.profile_scores.withColumn("audience", F.lit("panel.v0"))
    return label_batches.save_new(stored, fresh, answers)[1]


@catalog.query(
    "l9_relabel_keyword",
    """select count(*) filter (where twitter_id not in (select twitter_id from stored)) as inserted,
    count(*) filter (where twitter_id in (select twitter_id from stored)) as updated
    from user_keywords join user_profiles using (twitter_id) where keyword='Brand#1' and bio<>''""",
    stored="select twitter_id from profile_scores where scored_by='model-a'",
)
def _(w):
    todo = lookups.keyword_work_list(
        w.user_profiles, w.user_stats, w.user_keywords, w.profile_scores, "Brand#1", limit=None
    )
    labels, _answers = label_batches.label_accounts(
        todo, label_batches.signal_labeler, "model-a", SIGNALS, size=30, shards=8, parallel=8
    )
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    stored = w.profile_scores.withColumn("audience", F.lit("panel.v0"))
    return label_batches.save_again(stored, label_batches.as_stored(labels, "panel.v1", now))[1]


def hand_labels(w: Workspace) -> DataFrame:
    """Hand labels: the quality column, uncertain where the text was also marked toxic."""
    marks = w.raw("labels").select(F.col("doc_id").cast("string").alias("twitter_id"), "quality", "toxic")
    label = F.when(F.col("toxic") == 0, F.col("quality") == 1)
    return w.user_profiles.join(marks, "twitter_id").select("twitter_id", "handle", label.alias("label"))


REVIEW = """select p.handle, s.label, h.twitter_id is not null as reviewed, h.label as human_label from profile_scores s join user_profiles p using (twitter_id)
 left join (select cast(doc_id as varchar) as twitter_id, case when toxic=0 then quality=1 end as label from labels
   where doc_id in (select c_custkey from customer)) h using (twitter_id) where s.scored_by='model-a'"""


def reviewed(w: Workspace) -> DataFrame:
    own = w.profile_scores.filter(F.col("scored_by") == "model-a").select("twitter_id", "label")
    model = own.join(w.user_profiles.select("twitter_id", "handle"), "twitter_id")
    return label_batches.review_set(model, hand_labels(w))


@catalog.query(
    "l11_review_totals",
    """select count(*) as total, count(*) filter (where reviewed) as labeled, count(*) filter (where reviewed and human_label) as n_true,
    count(*) filter (where reviewed and not human_label) as n_false, count(*) filter (where reviewed and human_label is null) as n_null,
    count(*) filter (where reviewed and human_label is not distinct from label) as agree from review""",
    review=REVIEW,
)
def _(w):
    return label_batches.review_totals(reviewed(w))


@catalog.query("l11_review_queue", "select handle from review where not reviewed", review=REVIEW)
def _(w):
    return label_batches.review_queue(reviewed(w)).select("handle")


ALL_REVIEW = REVIEW.replace(" where s.scored_by='model-a'", "").replace("select p.handle, s.label,", "select s.scored_by, p.handle, s.label,")


def all_reviewed(w: Workspace) -> DataFrame:
    model = w.profile_scores.select("twitter_id", "scored_by", "label").join(w.user_profiles.select("twitter_id", "handle"), "twitter_id")
    return label_batches.review_set(model, hand_labels(w))


@catalog.query(
    "l11_all_totals",
    """select count(*) as total, count(*) filter (where reviewed) as labeled, count(*) filter (where reviewed and human_label) as n_true,
    count(*) filter (where reviewed and not human_label) as n_false, count(*) filter (where reviewed and human_label is null) as n_null,
    count(*) filter (where reviewed and human_label is not distinct from label) as agree from review""",
    review=ALL_REVIEW,
)
def _(w):
    return label_batches.review_totals(all_reviewed(w))


@catalog.query("l11_all_queue", "select scored_by, handle from review where not reviewed", review=ALL_REVIEW)
def _(w):
    return label_batches.review_queue(all_reviewed(w)).select("scored_by", "handle")


@catalog.query(
    "s15_audience_config",
    """select p_type as "targetProfile", 'industry' as sector, string_agg(p_brand, ';' order by p_brand) as signals, 'People who buy parts.' as "domainContext"
    from (select distinct p_type, p_brand from part) t group by 1""",
)
def _(w):
    """All audiences written as one document each and loaded again."""
    path = scratch_path(w.spark, "audiences")
    rows = audience(w)
    texts = rows.select(F.md5("targetProfile").alias("name"), F.to_json(F.struct(*rows.columns)).alias("value"))
    texts.write.partitionBy("name").text(path)
    loaded = read_audience(w.spark, path)
    return loaded.select("targetProfile", "sector", F.array_join("highSignals", ";").alias("signals"), "domainContext")


@catalog.query(
    "l12_training_lines",
    """select 'handle: ' || handle as handle_line, scored_by, case when label then '1.00' when not label then '0.00' else '0.50' end as score, reason
    from profile_scores join user_profiles using (twitter_id)""",
)
def _(w):
    full = w.user_profiles.join(w.user_stats.select("twitter_id", "followers", "created_at"), "twitter_id")
    path = scratch_path(w.spark, "training")
    label_batches.jsonl(label_batches.instruction_rows(w.profile_scores, full, ["model-a", "model-b", "model-c"])).write.text(path)
    lines = w.spark.read.schema("instruction string, output string").json(path)
    answer = F.from_json("output", "handle string, score string, reason string")
    return lines.select(
        F.regexp_extract("instruction", "\n(handle: [^\n]*)", 1).alias("handle_line"),
        F.regexp_extract("instruction", r"\(Scored by model: ([^)]*)\)$", 1).alias("scored_by"), answer["score"].alias("score"), answer["reason"].alias("reason"),
    )


@catalog.query(
    "l12_instruction_rows",
    """select twitter_id, scored_by, 'handle: ' || handle as handle_line, length(coalesce(bio, '')) as bio_length,
    case when label then '1.00' when not label then '0.00' else '0.50' end as score, reason
    from profile_scores join user_profiles using (twitter_id) where scored_by in ('model-a', 'model-c')""",
)
def _(w):
    full = w.user_profiles.join(w.user_stats.select("twitter_id", "followers", "created_at"), "twitter_id")
    rows = label_batches.instruction_rows(w.profile_scores, full, ["model-a", "model-c"])
    line = F.from_json(F.to_json(F.struct("instruction", "output")), "instruction string, output string")
    parsed = rows.select("twitter_id", "scored_by", line.alias("l"))
    answer = F.from_json("l.output", "handle string, score string, reason string")
    bio = F.regexp_extract("l.instruction", r"(?s)\nbio: (.*)\ncreated_at: [^\n]*\nfollowerCount: ", 1)
    return parsed.select(
        "twitter_id", "scored_by", F.regexp_extract("l.instruction", "\n(handle: [^\n]*)", 1).alias("handle_line"),
        F.length(bio).cast("bigint").alias("bio_length"), answer["score"].alias("score"), answer["reason"].alias("reason"),
    )


def picky_labeler(profiles: list[dict], model: str, audience: dict) -> str:
    """Plug-in that refuses batches holding a very long bio, to show what a failing service costs."""
    if any(len(p["bio"]) > audience["limit"] for p in profiles):
        raise RuntimeError("bio too long")
    return label_batches.signal_labeler(profiles, model, audience)


@catalog.query("x1_labeler_plugin")
def _(w):
    audience = {**SIGNALS, "limit": 20_000}
    _labels, answers = label_batches.label_accounts(work(w), picky_labeler, "picky", audience, shards=8, parallel=8)
    return label_batches.response_errors(answers)


# --- worth model -------------------------------------------------------------------------------------

DIMENSIONS = 64


def similarities(w: Workspace) -> DataFrame:
    vectors = w.raw("embeddings")
    centre = worth.centroid(vectors.filter(F.col("label") == 0), "embedding", DIMENSIONS)
    return worth.similarity(vectors, "embedding", centre)


SIM = """select e.vec_id, e.label, list_cosine_similarity(cast(e.embedding as double[]), c.centre) as cos_sim from embeddings e,
 (select list(m order by i) as centre from (select i, avg(x) as m from (select unnest(cast(embedding as double[])) as x,
 unnest(range(64)) as i from embeddings where label=0) t group by i) u) c"""


@catalog.query("m1_audience_similarity", "select vec_id, round(cos_sim, 5) as cos_sim from sim", sim=SIM)
def _(w):
    return similarities(w).select("vec_id", F.round("cos_sim", 5).alias("cos_sim"))


INTERCEPT = -2.5
WORTH = """select *, 1e0/(1e0+exp(-(-2.5e0+6.09e0*cos_sim+2.98e0*activity+0.17e0*bio_quality))) as probability from (
 select p.twitter_id, p.handle, p.platform, s.cos_sim, p.human_score as activity, s.label as audience_label,
 case when p.bio<>'' then length(regexp_replace(p.bio, '[^A-Za-z]', '', 'g'))*1e0/length(p.bio) else 0e0 end as bio_quality
 from profiles p join sim s on cast(s.vec_id as varchar)=p.twitter_id where p.human_score is not null) t"""
WORTH_VIEWS = {"sim": SIM, "worthy": WORTH}


def worth_rows(w: Workspace) -> DataFrame:
    known = w.profiles.filter(F.col("human_score").isNotNull())
    sims = similarities(w).select(F.col("vec_id").cast("string").alias("twitter_id"), "cos_sim", F.col("label").alias("audience_label"))
    rows = known.join(sims, "twitter_id").select(
        "twitter_id", "handle", "platform", "cos_sim", F.col("human_score").alias("activity"), "audience_label",
        latin_share(F.col("bio")).alias("bio_quality"),
    )
    scored = rows.withColumn("probability", worth.worth_probability(INTERCEPT))
    return scored.withColumn("worth", F.col("probability") >= worth.CUTOFF)


@catalog.query(
    "m2_fixed_weights",
    "select twitter_id, round(probability, 4) as probability from worthy",
    **WORTH_VIEWS,
)
def _(w):
    return worth_rows(w).select("twitter_id", F.round("probability", 4).alias("probability"))


@catalog.query("m2_fitted_model")
def _(w):
    rows = worth_rows(w).withColumn("label", (F.col("audience_label") == 0).cast("int"))
    # Read by the counts, the fit and the scores.
    rows = w.once(rows.select("twitter_id", "cos_sim", "activity", "bio_quality", "label"), "worth-rows")
    _model, scored = worth.fit_worth(rows)
    return worth.best_cutoff(worth.threshold_scores(scored))


LABELLED = "select twitter_id, cast(audience_label = 0 as int) as label from worthy"


@catalog.query(
    "m10_folds",
    """select cast(floor((cast(('0x' || substring(md5(twitter_id || '|' || label || '|fold'), 1, 8)) as bigint) / 4294967296e0) * 5) as int) as fold, label, count(*) as n
    from labelled group by 1, 2""",
    labelled=LABELLED,
    **WORTH_VIEWS,
)
def _(w):
    rows = worth_rows(w).select("twitter_id", (F.col("audience_label") == 0).cast("int").alias("label"))
    return sampling.with_folds(rows, "twitter_id", "label", 5, "fold").groupBy("fold", "label").agg(row_count().alias("n"))


@catalog.query("m2_out_of_fold")
def _(w):
    """Cut-off of each fold and (fold -1) of all rows, from scores of models that have not seen the row."""
    rows = worth_rows(w).withColumn("label", (F.col("audience_label") == 0).cast("int"))
    _models, scored = worth.out_of_fold(rows.select("twitter_id", "cos_sim", "activity", "bio_quality", "label"), "twitter_id")
    return worth.fold_thresholds(scored)


@catalog.query(
    "m3_latin_share",
    "select doc_id, round(case when text<>'' then length(regexp_replace(text, '[^A-Za-z]', '', 'g'))*1e0/length(text) else 0e0 end + 1e-9, 6) as latin from documents",
)
def _(w):
    return w.raw("documents").select("doc_id", r6(latin_share(F.col("text"))).alias("latin"))


@catalog.query(
    "m4_priority_queue",
    """select twitter_id, case when probability>=0.7 then 'high' when probability>=0.5 then 'medium' else 'low' end as tier
    from worthy where probability>=0.33 order by probability desc, twitter_id limit 200""",
    **WORTH_VIEWS,
)
def _(w):
    return worth.priority_queue(worth_rows(w), 200).select("twitter_id", "tier")


@catalog.query(
    "m5_feedback_rows",
    """select handle, round(activity + 1e-9, 6) as activity, round(bio_quality + 1e-9, 6) as bio_quality, round(cos_sim, 5) as cos_sim, scored_by, label
    from worthy join profile_scores using (twitter_id) where probability>=0.33 and label is not null""",
    **WORTH_VIEWS,
)
def _(w):
    rows = worth.feedback_rows(worth_rows(w), w.profile_scores)
    return rows.select("handle", r6(F.col("activity")).alias("activity"), r6(F.col("bio_quality")).alias("bio_quality"),
                       F.round("cos_sim", 5).alias("cos_sim"), "scored_by", "label")


@catalog.query("m6_queue_depth", "select count(*) as queue_depth from queue where twitter_id not in (select twitter_id from profile_scores)")
def _(w):
    return worth.queue_depth(w.queue, w.profile_scores)


@catalog.query("m6_labels_per_hour", "select date_trunc('hour', scored_at) as hour, count(*) as labels from profile_scores group by 1")
def _(w):
    return worth.labels_per_hour(w.profile_scores)


@catalog.query(
    "m6_worth_rate",
    """select day, round(sum(w) over r / sum(n) over r + 1e-9, 6) as worth_rate from (select cast(created_at as date) as day, count(*) as n,
    count(*) filter (where score4 > 0.65) as w from detail where created_at is not null group by 1) t
    window r as (order by day range between interval 6 days preceding and current row)""",
)
def _(w):
    rows = w.scores.join(w.user_stats.select("twitter_id", "created_at"), "twitter_id").filter(F.col("created_at").isNotNull())
    scored = rows.withColumn("worth", F.coalesce(F.col("human_score") > 0.65, F.lit(False)))
    return worth.rolling_worth_rate(scored, "created_at").withColumn("worth_rate", r6(F.col("worth_rate")))


@catalog.query(
    "m8_recall_report",
    """with f as (select *, final_score >= 0.6 as worth, twitter_id in (select cast(doc_id as varchar) from labels where quality=1) as hand_picked
      from finals where final_score is not null),
    g as (select 'curated' as group_name, worth from f where is_curated union all select 'hand_picked', worth from f where hand_picked
      union all select 'platform:' || platform, worth from f union all select 'all', worth from f)
    select group_name, count(*) as n, count(*) filter (where worth) as found, round(count(*) filter (where worth)*1e0/count(*) + 1e-9, 6) as rate
    from g group by 1""",
)
def _(w):
    good = w.raw("labels").filter(F.col("quality") == 1).select(F.col("doc_id").cast("string").alias("twitter_id"), F.lit(True).alias("h"))
    rows = marked(w).filter(F.col("final_score").isNotNull()).join(good, "twitter_id", "left")
    rows = rows.withColumns({"worth": F.col("final_score") >= 0.6, "hand_picked": F.coalesce("h", F.lit(False))})
    return worth.recall_report(rows).withColumn("rate", r6(F.col("rate")))


CENTRES = """select label as centre, list(m order by i) as centroid from (select label, i, avg(x) as m from (select label, unnest(cast(embedding as double[])) as x,
 unnest(range(64)) as i from embeddings) t group by label, i) u group by label"""


@catalog.query(
    "m9_label_centroids",
    """select vec_id, centre, round(cos_sim, 5) as cos_sim from (select *, row_number() over (partition by vec_id order by round(cos_sim, 9) desc, centre) as rn from (
    select e.vec_id, c.centre, list_cosine_similarity(cast(e.embedding as double[]), c.centroid) as cos_sim from embeddings e, centres c) t) u where rn=1""",
    centres=CENTRES,
)
def _(w):
    """The mean vector of each label as a stored model, and every vector's nearest."""
    means = [F.avg(F.element_at("embedding", i + 1).cast("double")) for i in range(DIMENSIONS)]
    table = w.once(w.raw("embeddings").groupBy(F.col("label").alias("centre")).agg(F.array(*means).alias("centroid")), "centroids")
    near = worth.nearest_centroid(w.raw("embeddings").select("vec_id", "embedding"), "embedding", table)
    return near.select("vec_id", "centre", F.round("cos_sim", 5).alias("cos_sim"))


@catalog.query("m9_stored_centroids")
def _(w):
    """Three k-means centres of the audience, fitted once, stored, and joined to by the scoring."""
    vectors = w.raw("embeddings")
    fitted = worth.centroid_table(w.spark, worth.fit_centroids(vectors.filter(F.col("label") == 0), "embedding", 3))
    return worth.nearest_centroid(vectors.select("vec_id", "embedding"), "embedding", w.once(fitted, "k-means")).drop("embedding")


@catalog.query("m9_nearest_centroid")
def _(w):
    vectors = w.raw("embeddings")
    centres = worth.fit_centroids(vectors.filter(F.col("label") == 0), "embedding", 3)
    return worth.nearest_similarity(vectors, "embedding", centres).select("vec_id", "cos_sim")


@catalog.query(
    "m6_label_worth_rate",
    """select day, round(sum(w) over r / sum(n) over r + 1e-9, 6) as worth_rate from (select cast(scored_at as date) as day, count(*) as n,
    count(*) filter (where probability >= 0.33) as w from worthy join profile_scores using (twitter_id) group by 1) t
    window r as (order by day range between interval 6 days preceding and current row)""",
    **WORTH_VIEWS,
)
def _(w):
    """Share of the accounts labelled in the last seven days that the worth model had found worth it."""
    rows = worth_rows(w).select("twitter_id", "worth").join(w.profile_scores.select("twitter_id", "scored_at"), "twitter_id")
    return worth.rolling_worth_rate(rows, "scored_at").withColumn("worth_rate", r6(F.col("worth_rate")))


@catalog.query(
    "m8_worth_recall",
    """with f as (select y.platform, y.probability >= 0.33 as worth, k.is_curated, y.twitter_id in (select cast(doc_id as varchar) from labels where quality=1) as hand_picked
      from worthy y left join keyword_sets k using (twitter_id)),
    g as (select 'curated' as group_name, worth from f where is_curated union all select 'hand_picked', worth from f where hand_picked
      union all select 'platform:' || platform, worth from f union all select 'all', worth from f)
    select group_name, count(*) as n, count(*) filter (where worth) as found, round(count(*) filter (where worth)*1e0/count(*) + 1e-9, 6) as rate
    from g group by 1""",
    **WORTH_VIEWS,
)
def _(w):
    """Recall of the worth model itself."""
    good = w.raw("labels").filter(F.col("quality") == 1).select(F.col("doc_id").cast("string").alias("twitter_id"), F.lit(True).alias("h"))
    curated = w.user_keywords.filter(F.col("keyword") == CURATED).select("twitter_id", F.lit(True).alias("c"))
    rows = worth_rows(w).join(good, "twitter_id", "left").join(curated, "twitter_id", "left")
    rows = rows.withColumns({"is_curated": F.coalesce("c", F.lit(False)), "hand_picked": F.coalesce("h", F.lit(False))})
    return worth.recall_report(rows).withColumn("rate", r6(F.col("rate")))


@catalog.query(
    "m10_all_models",
    """select label, part, count(*) as n from (select label, case when (cast(('0x' || substring(md5(twitter_id || '/' || scored_by || '|split'), 1, 8)) as bigint) / 4294967296e0) < 0.8 then 'train' else 'test' end as part
    from profile_scores where label is not null) t group by 1, 2""",
)
def _(w):
    rows = w.profile_scores.filter(F.col("label").isNotNull()).withColumn("key", F.concat_ws("/", "twitter_id", "scored_by"))
    return sampling.split_by_class(rows, "key", "split").groupBy("label", "part").agg(row_count().alias("n"))


UNIT = "(cast(('0x' || substring(md5({0}), 1, 8)) as bigint) / 4294967296e0)"


@catalog.query(
    "m10_split",
    f"""select label, case when {UNIT.format("twitter_id || '|split'")} < 0.8 then 'train' else 'test' end as part, count(*) as n
    from profile_scores where label is not null and scored_by='model-a' group by 1, 2""",
)
def _(w):
    rows = w.profile_scores.filter(F.col("label").isNotNull() & (F.col("scored_by") == "model-a"))
    return sampling.split_by_class(rows, "twitter_id", "split").groupBy("label", "part").agg(row_count().alias("n"))


@catalog.query(
    "m10_balanced",
    f"""with r as (select * from profile_scores where label is not null and scored_by='model-a'),
    c as (select count(*) filter (where label)*1e0 as t, count(*) filter (where not label)*1e0 as f from r)
    select twitter_id, label from r, c where {UNIT.format("twitter_id || '|balance'")} <
    case when label then least(1e0, f/(t*(0.7e0/0.3e0))) else least(1e0, t*(0.7e0/0.3e0)/f) end""",
)
def _(w):
    rows = w.profile_scores.filter(F.col("label").isNotNull() & (F.col("scored_by") == "model-a"))
    return sampling.balance_classes(rows, "twitter_id", "label", "balance").select("twitter_id", "label")


@catalog.query(
    "m11_other_blends",
    """select twitter_id, round(human_score*avg_llm + 1e-9, 6) as product, round(case when human_score>=0.55 then avg_llm else human_score*avg_llm end + 1e-9, 6) as gated
    from finals where has_llm""",
)
def _(w):
    rows = marked(w).filter(F.col("has_llm"))
    h, a = F.col("human_score"), F.col("avg_llm")
    return rows.select("twitter_id", r6(worth.product_blend(h, a)).alias("product"), r6(worth.gated_blend(h, a)).alias("gated"))


@catalog.query(
    "m12_platforms",
    """select 'twitter' as platform, cast(c_custkey as varchar) as account_id, c_name as name, c_mktsegment as category from customer
    union all select 'bluesky', 'did:' || s_suppkey, s_name, null from supplier""",
)
def _(w):
    return worth.normalise_platforms(
        {
            "twitter": (w.raw("customer"), {"account_id": "cast(c_custkey as string)", "name": "c_name", "category": "c_mktsegment"}),
            "bluesky": (w.raw("supplier"), {"account_id": "concat('did:', s_suppkey)", "name": "s_name"}),
        }
    )


@catalog.query(
    "m13_negatives",
    """select twitter_id, handle, false as label from user_profiles where category in ('MACHINERY', 'HOUSEHOLD') and not can_dm
    order by md5(twitter_id || '|neg'), twitter_id limit 500""",
)
def _(w):
    """Accounts are found by their segment, those open to messages also by their location."""
    words = F.array(F.col("category"), F.when(F.col("can_dm"), F.col("location")))
    found = w.user_profiles.select("twitter_id", F.explode(F.filter(words, lambda k: k.isNotNull())).alias("keyword"))
    picked = sampling.out_of_domain(found, w.user_profiles, ["MACHINERY", "HOUSEHOLD"], 500, "neg")
    return picked.select("twitter_id", "handle", "label")
