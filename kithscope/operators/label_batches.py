"""Labelling as Spark jobs: prompts, labeler plug-ins, answers checked before anything is stored."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithscope.functions.numbers import count_if, row_count
from kithscope.functions.text import strip_code_fence
from kithscope.operators.lookups import WORK_COLUMNS
from kithscope.operators.merges import insert_absent, insert_counts, upsert_counts, upsert_latest
from kithscope.operators.sampling import shard_count, sharded_batches
from kithscope.session import scratch_path
from kithscope.sources.batch_files import header_line, profile_line

BATCH_KEY = ["shard", "batch_no"]
REASON_LENGTH = 500

# A labeler gets the profiles of one batch, the model name and the audience, and answers with text.
Labeler = Callable[[list[dict], str, dict], str]

SYSTEM_TEMPLATE = """You decide which accounts belong to one person who is a {target} working in {sector}.

Background: {context}

Signs in favour:
{high}

Signs against:
{low}

First rule out organisations, brands and automated accounts, then weigh the signs. Prefer null over a guess.
true: clearly a {target}. false: not a person, nothing to go by, or clearly someone else. null: unclear.

Answer with a bare JSON array and nothing else, one object per account:
[{{"handle": string, "label": true | false | null, "reason": string of at most 15 words}}]"""


def system_prompt(audience: DataFrame, template: str = SYSTEM_TEMPLATE) -> DataFrame:
    """Prompt per audience row. ``template`` may be any text with the five named places."""
    bullets = lambda name: F.array_join(F.transform(name, lambda s: F.concat(F.lit("- "), s)), "\n")
    places = {
        "{target}": F.col("targetProfile"), "{sector}": F.upper("sector"), "{context}": F.col("domainContext"),
        "{high}": bullets("highSignals"), "{low}": bullets("lowSignals"), "{{": F.lit("{"), "}}": F.lit("}"),
    }
    # Cut once, then joined: a value that looks like a place stays as it is.
    cuts = re.split("(" + "|".join(map(re.escape, places)) + ")", template)
    text = F.concat(*(places.get(c, F.lit(c)) for c in cuts if c))
    return audience.select("*", text.alias("system_prompt"))


def pack_batches(work: DataFrame, size: int, shards: int | None = None) -> DataFrame:
    """One row per batch with its profiles; a batch never holds more than ``size``."""
    placed = sharded_batches(work, "twitter_id", size, shards)
    profile = F.struct("position", *WORK_COLUMNS)
    return placed.groupBy(*BATCH_KEY).agg(F.array_sort(F.collect_list(profile)).alias("profiles"))


def user_prompts(work: DataFrame, size: int, shards: int | None = None, opening: str = "Accounts to judge: %d\n\n") -> DataFrame:
    """Prompt text per batch: ``opening`` with the count, and a flat table of its profiles."""
    placed = sharded_batches(work, "twitter_id", size, shards)
    rows = F.array_sort(F.collect_list(F.struct("position", profile_line().alias("line"))))
    packed = placed.groupBy(*BATCH_KEY).agg(rows.alias("rows"))
    n = F.size("rows")
    table = F.concat_ws("\n", header_line(n), F.transform("rows", lambda r: r["line"]))
    prompt = F.concat(F.format_string(opening, n), F.lit("```toon\n"), table, F.lit("\n```"))
    return packed.select(*BATCH_KEY, n.cast("bigint").alias("size"), prompt.alias("user_prompt"))


def signal_labeler(profiles: list[dict], model: str, audience: dict) -> str:
    """Built-in labeler without any service: looks for signal words in the bio."""
    answers = []
    for profile in profiles:
        bio = profile["bio"].lower()
        good = any(word in bio for word in audience["highSignals"])
        bad = any(word in bio for word in audience["lowSignals"])
        label = None if good and bad else good
        reason = {True: "has a positive signal", False: "no positive signal", None: "mixed signals"}[label]
        answers.append({"handle": profile["handle"], "label": label, "reason": reason})
    return json.dumps(answers, ensure_ascii=False)


def signal_labels(work: DataFrame, model: str, audience: dict) -> DataFrame:
    """The labels of :func:`signal_labeler` as one projection, for work lists that need no plug-in."""
    bio = F.lower("bio")
    any_of = lambda words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(bio, w))
    good, bad = any_of(audience["highSignals"]), any_of(audience["lowSignals"])
    label = F.when(~(good & bad), good)
    reason = F.when(label.isNull(), "mixed signals").when(label, "has a positive signal").otherwise("no positive signal")
    return work.select("twitter_id", "handle", label.alias("label"), reason.alias("reason"), F.lit(model).alias("scored_by"))


def run_labeler(
    packed: DataFrame, labeler: Labeler, model: str, audience: dict, parallel: int = 32, per_second: float | None = None
) -> DataFrame:
    """Ask the labeler for every batch: the text it answered, or the error it raised.

    ``parallel`` tasks call at the same time; a total rate is shared between them. A failed batch gives
    an error row and no labels; a retried task repeats whole batches, so results are keyed by account
    and model when stored.
    """
    pause = parallel / per_second if per_second else 0.0

    def ask(frame: pd.DataFrame) -> pd.DataFrame:
        answers = []
        for shard, batch_no, profiles in zip(frame["shard"], frame["batch_no"], frame["profiles"]):
            try:
                answers.append((shard, batch_no, labeler([dict(p) for p in profiles], model, audience), None))
            except Exception as error:  # the batch is lost, the job goes on
                answers.append((shard, batch_no, None, f"{type(error).__name__}: {error}"))
            if pause:
                time.sleep(pause)
        return pd.DataFrame(answers, columns=["shard", "batch_no", "response", "error"])

    spread = packed.repartition(parallel, *BATCH_KEY)
    # One batch at a time enters Python: frames of many rows would hold the texts of thousands of batches.
    return spread.groupBy(*BATCH_KEY).applyInPandas(ask, "shard bigint, batch_no bigint, response string, error string")


def parse_responses(responses: DataFrame, keys: list[str]) -> DataFrame:
    """Items of every valid answer. One bad item rejects the whole answer.

    The raw JSON types are checked first, because a plain cast would turn a wrongly typed label into
    null, which here means "uncertain". ``pos`` keeps the place of an item in its answer.
    """
    parsed = responses.withColumn("_items", _items(F.col("response")))
    valid = parsed.filter(_all_valid(F.col("_items")))
    rows = valid.select(*keys, F.posexplode("_items").alias("pos", "item"))
    return rows.select(
        *keys, "pos", F.try_variant_get("item", "$.handle", "string").alias("handle"),
        F.try_variant_get("item", "$.label", "boolean").alias("label"),
        F.substring(F.try_variant_get("item", "$.reason", "string"), 1, REASON_LENGTH).alias("reason"),
    )


def _items(response: Column) -> Column:
    return F.try_variant_get(F.try_parse_json(strip_code_fence(response)), "$", "array<variant>")


def _all_valid(items: Column) -> Column:
    """True only when the answer is an array whose items all have the three keys with the right types."""

    def valid(item: Column) -> Column:
        kind = lambda key: F.schema_of_variant(F.try_variant_get(item, f"$.{key}", "variant"))
        return (kind("handle") == "STRING") & (kind("reason") == "STRING") & kind("label").isin("BOOLEAN", "VOID")

    return F.coalesce(F.forall(items, valid), F.lit(False))


def response_errors(responses: DataFrame) -> DataFrame:
    """Batches that failed, batches whose answer was refused, and all batches."""
    failed = F.col("response").isNull()
    refused = ~failed & ~_all_valid(_items(F.col("response")))
    return responses.agg(row_count().alias("batches"), count_if(failed).alias("failed"), count_if(refused).alias("refused"))


def match_labels(items: DataFrame, batch_profiles: DataFrame, keys: list[str]) -> DataFrame:
    """Answers to accounts by handle in any case, inside their own batch; unknown handles drop out."""
    left = items.withColumn("_key", F.lower("handle"))
    right = batch_profiles.select(*keys, "twitter_id", F.lower("handle").alias("_key"))
    return left.join(right, [*keys, "_key"]).select(*keys, "twitter_id", "handle", "label", "reason", "pos")


def label_accounts(
    work: DataFrame, labeler: Labeler, model: str, audience: dict, size: int = 25, shards: int | None = None, **run: object
) -> tuple[DataFrame, DataFrame]:
    """Labels and answers for a whole work list. Both are written once to the shared folder: a labeler may
    answer differently when asked again, so nothing after this may ask it a second time."""
    spark = work.sparkSession
    work_path, answer_path = scratch_path(spark, "work"), scratch_path(spark, "answers")
    work.write.parquet(work_path)
    stored_work = spark.read.parquet(work_path)
    shards = shards or shard_count(stored_work)
    run_labeler(pack_batches(stored_work, size, shards), labeler, model, audience, **run).write.parquet(answer_path)
    answers = spark.read.parquet(answer_path)
    placed = sharded_batches(stored_work, "twitter_id", size, shards)
    matched = match_labels(parse_responses(answers, BATCH_KEY), placed, BATCH_KEY)
    return matched.withColumn("scored_by", F.lit(model)), answers


def as_stored(labels: DataFrame, audience_name: str, scored_at: Column) -> DataFrame:
    return labels.select(
        "twitter_id", "scored_by", "label", "reason", scored_at.alias("scored_at"), F.lit(audience_name).alias("audience")
    )


def save_new(stored: DataFrame, fresh: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First label wins: the new table and one row of counters."""
    keys = ["twitter_id", "scored_by"]
    counts = insert_counts(stored, fresh, keys).withColumn("k", F.lit(1))
    errors = response_errors(answers).select((F.col("failed") + F.col("refused")).alias("errors"), F.lit(1).alias("k"))
    return insert_absent(stored, fresh, keys, F.col("scored_at")), counts.join(errors, "k").drop("k")


def save_again(stored: DataFrame, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Latest label wins: the new table and the counts of inserted and updated labels."""
    keys = ["twitter_id", "scored_by"]
    return upsert_latest(stored, fresh, keys, "scored_at"), upsert_counts(stored, fresh, keys)


def review_set(model_labels: DataFrame, human_labels: DataFrame) -> DataFrame:
    """Model labels with the stored hand label, joined by handle in any case. ``reviewed`` tells an
    uncertain hand label from a missing one."""
    hand = human_labels.select(
        F.lower("handle").alias("_key"), F.col("label").alias("human_label"), F.lit(True).alias("_seen")
    )
    joined = model_labels.withColumn("_key", F.lower("handle")).join(hand, "_key", "left")
    return joined.withColumn("reviewed", F.coalesce("_seen", F.lit(False))).drop("_key", "_seen")


def review_queue(reviewed: DataFrame) -> DataFrame:
    return reviewed.filter(~F.col("reviewed"))


def review_totals(reviewed: DataFrame) -> DataFrame:
    done, label = F.col("reviewed"), F.col("human_label")
    return reviewed.agg(
        row_count().alias("total"), count_if(done).alias("labeled"), count_if(done & label).alias("n_true"),
        count_if(done & ~label).alias("n_false"), count_if(done & label.isNull()).alias("n_null"),
        count_if(done & label.eqNullSafe(F.col("label"))).alias("agree"),
    )


# Fixed format of one training instruction; the places are filled per account.
INSTRUCTION = (
    "Score this profile. Given the following profile attributes, return a JSON object with: 'handle', 'score'"
    " (0.00-1.00 likelihood of being a real person who is an academic researcher), 'reason'.\n\n"
    "PROFILE ATTRIBUTES:\nhandle: %s\ndisplayName: %s\nbio: %s\ncreated_at: %s\nfollowerCount: %s\nlocation: %s\n"
    "(Scored by model: %s)"
)


def instruction_rows(labels: DataFrame, profiles: DataFrame, models: list[str]) -> DataFrame:
    """Instruction and expected answer per label of the chosen models, newest first."""
    chosen = labels.filter(F.col("scored_by").isin(models)).join(profiles, "twitter_id")
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    instruction = F.format_string(
        INSTRUCTION, blank("handle"), blank("name"), blank("bio"), blank("created_at"), blank("followers"),
        blank("location"), F.col("scored_by"),
    )
    score = F.when(F.col("label"), "1.00").when(~F.col("label"), "0.00").otherwise("0.50")
    answer = F.to_json(F.struct("handle", score.alias("score"), F.coalesce("reason", F.lit("")).alias("reason")))
    rows = chosen.select("twitter_id", "scored_by", "scored_at", instruction.alias("instruction"), answer.alias("output"))
    return rows.orderBy(F.col("scored_at").desc(), "twitter_id", "scored_by")


def jsonl(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct("instruction", "output")).alias("value"))
