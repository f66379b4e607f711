"""The scorer against a plain Python calculation on a grid of threshold values."""

import math

from pyspark.sql import functions as F

from kithscope.functions.authenticity import score_accounts, sweep_configs
from kithscope.functions.scoring_config import DEFAULT_CONFIG, merge_config

AS_OF = "2020-01-01 00:00:00"


def sig(x):
    return 1 / (1 + math.exp(-x))


def expected(row, cfg=DEFAULT_CONFIG):
    """Independent scalar version; returns (score, class)."""
    w, act_t, pt, pen, ct = (cfg[g] for g in ("personWeights", "activityThresholds", "penaltyThresholds", "penalties", "classificationThresholds"))
    days = max(0.0, row["age"])
    fol, fing, st = row["followers"], row["following"], row["statuses"]
    ratio = min(3, max(-2, math.log10((fol + 1) / (fing + 1))))
    eng, media = min(1, row["favorites"] / (st + 1)), min(1, row["media"] / (st + 1))
    act = st / (days + 1)
    custom = ((not row["dp"]) + (not row["di"])) / 2
    ver = 1.0 if row["bv"] else 0.0
    bell = lambda x, p, width: math.exp(-(((x - p) / width) ** 2))
    bot = sig(-3 + 3 * sig(0.1 * (act - 50)) + 2 * (1 - sig(5 * (eng - 0.1))) + 1.5 * (1 - sig(5 * (ratio + 1.5)))
              + 1.5 * (1 - custom) + (1 - sig(10 * ((1 - math.exp(-days / 365)) - 0.1))))
    creator = sig(-2.5 + 1.5 * sig(ratio - 1) + 1.2 * media + 0.8 * math.tanh(row["listed"] / 50) + 0.5 * ver + 0.8 * sig(0.0003 * (fol - 10000)))
    entity = sig(-2.5 + 1.2 * sig(ratio - 1.7) + 0.8 * (1 - eng) + 0.6 * media + 0.5 * ver + 0.8 * bell(act, 3, 5))
    if act < act_t["veryLow"]:
        normal = 0.5
    elif act < act_t["low"]:
        normal = 0.5 + 0.4 * (act - act_t["veryLow"]) / (act_t["low"] - act_t["veryLow"])
    elif act <= act_t["optimalMax"]:
        normal = 0.9 + 0.1 * bell(act, 1, 0.5)
    else:
        normal = 0.75 if act <= act_t["highMax"] else 0.45 if act <= act_t["veryHighMax"] else 0.2
    moderate = (1 if fing <= 500 else 1 - 0.15 * (fing - 500) / 1000 if fing <= 1500 else 0.85 - 0.25 * (fing - 1500) / 1500
                if fing <= 3000 else max(0.3, 0.6 - 0.1 * (fing - 3000) / 2000))
    volume = (1 if st <= 5000 else 1 - 0.2 * (st - 5000) / 5000 if st <= 10000 else 0.8 - 0.3 * (st - 10000) / 10000
              if st <= 20000 else max(0.3, 0.5 - 0.1 * (st - 20000) / 10000))
    base = (w["custom"] * custom + w["engaged"] * min(1, math.sqrt(2 * eng)) + w["age"] * (1 - math.exp(-days / 500))
            + w["safe"] * (1 - 0.3 * row["sens"]) + w["balanced"] * bell((ratio + 2) / 5, 0.4, 0.25) + w["normalActivity"] * normal
            + w["established"] * min(1, math.log10(fol + 1) / 3) + w["moderateFollowing"] * moderate + w["reasonableVolume"] * volume)
    person = min(1, base + ver * 0.08 * sig(10 * (base - 0.7)))
    factor = pen["veryFewFollowers"] if fol < pt["veryFewFollowers"] else pen["fewFollowers"] if fol < pt["fewFollowers"] else 1
    factor *= pen["zeroStatuses"] if st == 0 else pen["veryFewStatuses"] if st < pt["veryFewStatuses"] else 1
    factor *= pen["veryNewAccount"] if days < pt["veryNewDays"] else pen["newAccount"] if days < pt["newDays"] else 1
    factor *= pen["spamPattern"] if fing > pt["massFollowing"] and fol < 100 else 1
    factor *= pen["hyperactive"] if act > pt["hyperactiveTweets"] else pen["highActivity"] if act > pt["highActivityTweets"] else 1
    factor *= pen["highVolumeNoFollowers"] if st > pt["hugeStatuses"] and fol < st / 10 else 1
    factor *= pen["defaultProfile"] if custom < 0.5 else 1
    factor *= pen["lowEngagementHighActivity"] if eng < pt["lowEngagementRate"] and act > pt["highActivityForLowEngagement"] else 1
    if bot > ct["bot"]:
        kind, raw = "Bot", 1 - bot
    elif entity > ct["entity"] and bot < 0.5:
        kind, raw = "Entity", 1 - entity
    elif creator > ct["creator"] and entity < 0.5 and bot < 0.5:
        kind, raw = "Creator", creator
    elif person > ct["human"]:
        kind, raw = "Human", person
    else:
        best = max([(person, 3, "Human"), (creator, 2, "Creator"), (entity, 1, "Entity"), (bot, 0, "Bot")])
        kind, raw = (best[2], best[0]) if best[2] in ("Human", "Creator") else ("Other", 0.5)
    return math.floor(min(1, max(0, raw * factor)) * 10000 + 0.5) / 10000, kind


def grid():
    base = {"followers": 300, "following": 200, "statuses": 1500, "favorites": 900, "listed": 3, "media": 100, "bv": False,
            "dp": False, "di": False, "sens": False, "age": 1000.0}
    axes = {
        "followers": [0, 9, 10, 49, 50, 99, 100, 5000, 20000, 2_000_000],
        "following": [0, 499, 500, 501, 1499, 1500, 1501, 3000, 3001, 5000, 5001, 50000],
        "statuses": [0, 1, 9, 10, 101, 500, 501, 2002, 4004, 5000, 5001, 8008, 10000, 10010, 20000, 20020, 30000, 30001, 60000],
        "favorites": [0, 100, 149, 150, 151, 10000],
        "age": [-5.0, 0.0, 29.9, 30.0, 89.9, 90.0, 365.0, 4000.0],
        "listed": [0, 50, 5000], "media": [0, 1500, 9000], "bv": [True], "dp": [True], "di": [True], "sens": [True],
    }
    rows = [dict(base)]
    for name, values in axes.items():
        rows += [{**base, name: v} for v in values]
        rows += [{**base, name: v, "dp": True, "di": True, "favorites": 0} for v in values]
        rows += [{**base, name: v, "statuses": 20, "age": 15.0, "followers": 60000, "bv": True} for v in values]
    return rows


def frame(spark, rows):
    data = [(i, r["followers"], r["following"], r["statuses"], r["favorites"], r["listed"], r["media"], r["bv"], r["dp"], r["di"],
             r["sens"], int(round(r["age"] * 86_400_000_000))) for i, r in enumerate(rows)]
    df = spark.createDataFrame(
        data, "i int, followers bigint, following bigint, statuses bigint, favorites bigint, listed bigint, media bigint,"
        " blue_verified boolean, default_profile boolean, default_image boolean, sensitive boolean, age_us bigint",
    )
    as_of = F.unix_micros(F.lit(AS_OF).cast("timestamp"))
    return df.withColumn("created_at", F.timestamp_micros(as_of - F.col("age_us")).cast("timestamp_ntz")).drop("age_us")


def test_grid(spark):
    rows = grid()
    strict = merge_config({"classificationThresholds": {"bot": 0.4}, "penalties": {"newAccount": 0.5}})
    for cfg in (DEFAULT_CONFIG, strict):
        got = {r.i: (r.human_score, r.likely_is) for r in score_accounts(frame(spark, rows), AS_OF, cfg).collect()}
        for i, row in enumerate(rows):
            assert got[i] == expected(row, cfg), (row, got[i], expected(row, cfg))
        assert all(0 <= s <= 1 for s, _ in got.values())
    assert {k for _, k in got.values()} >= {"Human", "Bot", "Creator"}


def test_penalty_never_raises_a_score(spark):
    detail = score_accounts(frame(spark, grid()), AS_OF, detail=True)
    assert detail.filter((F.col("penalty") > 1) | (F.col("penalty") <= 0)).count() == 0


def test_bad_date_gives_no_class(spark):
    df = frame(spark, grid()[:3]).withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
    assert {(r.human_score, r.likely_is) for r in score_accounts(df, AS_OF).collect()} == {(None, None)}


def test_sweep_equals_single_runs(spark):
    configs = {"a": DEFAULT_CONFIG, "b": merge_config({"personWeights": {"age": 0.3}})}
    df = frame(spark, grid())
    swept = {(r.config_name, r.i): (r.human_score, r.likely_is) for r in sweep_configs(df, AS_OF, configs).collect()}
    for name, cfg in configs.items():
        for r in score_accounts(df, AS_OF, cfg).collect():
            assert swept[(name, r.i)] == (r.human_score, r.likely_is)


def test_filter_stays_above_the_scorer(spark):
    plan = score_accounts(frame(spark, grid()), AS_OF).filter("human_score > 0.65")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert len(text) < 40_000
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
