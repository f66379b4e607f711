"""Authenticity score and account class as staged SQL expressions.

Every stage is one projection that only reads the stage before it, so no logarithm or exponential is
computed twice, and everything runs inside generated code without any Python worker. The formulas are
written as expression text: one parse per column costs the driver far less than one call per operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithscope.functions.scoring_config import DEFAULT_CONFIG, Config, config_column
from kithscope.functions.times import age_in_days

Lookup = Callable[[str, str], str]

COUNTS = ["followers", "following", "statuses", "favorites", "listed", "media"]
FLAGS = ["blue_verified", "default_profile", "default_image", "sensitive"]
INPUTS = [*COUNTS, *FLAGS, "created_at"]

FEATURES = [
    "ratio", "ratio_norm", "engagement", "list_presence", "media_share", "age_curve", "activity",
    "customised", "safety", "verified",
]
SCORES = ["bot_score", "creator_score", "entity_score", "person_score", "penalty"]


def number(value: float) -> str:
    """A double literal; a bare 0.1 would be a decimal."""
    return f"{float(value)!r}D"


def sigmoid(x: str) -> str:
    return f"(1D / (1D + exp(-({x}))))"


def rising(x: str, midpoint: float, steepness: float) -> str:
    """Logistic step from 0 to 1 around the midpoint."""
    return sigmoid(f"({x} - {number(midpoint)}) * {number(steepness)}")


def falling(x: str, midpoint: float, steepness: float) -> str:
    return f"(1D - {rising(x, midpoint, steepness)})"


def bell(x: str, peak: float, width: float) -> str:
    z = f"(({x} - {number(peak)}) / {number(width)})"
    return f"exp(-({z} * {z}))"


def ladder(steps: list[tuple[str, str]], rest: str) -> str:
    return f"(case {' '.join(f'when {test} then {value}' for test, value in steps)} else {rest} end)"


def declining(x: str, knots: list[tuple[float, float]], tail: float, floor: float) -> str:
    """Piecewise linear curve through (x, y) knots: flat before the first, falling by a tenth per
    ``tail`` after the last and never below ``floor``."""
    steps = [(f"{x} <= {number(knots[0][0])}", number(knots[0][1]))]
    for (x0, y0), (x1, y1) in zip(knots, knots[1:]):
        slope = f"({number(round(y0 - y1, 10))} * ({x} - {number(x0)})) / {number(x1 - x0)}"
        steps.append((f"{x} <= {number(x1)}", f"{number(y0)} - {slope}"))
    x0, y0 = knots[-1]
    rest = f"greatest({number(floor)}, {number(y0)} - (0.1D * ({x} - {number(x0)})) / {number(tail)})"
    return ladder(steps, rest)


def _stage(df: DataFrame, **columns: str) -> DataFrame:
    return df.selectExpr("*", *[f"{text} as {name}" for name, text in columns.items()])


def _from_dict(config: Config) -> Lookup:
    return lambda group, name: number(config[group][name])


def _from_struct(column: str) -> Lookup:
    return lambda group, name: f"{column}.{group}.{name}"


def _sealed(df: DataFrame, results: list[str]) -> DataFrame:
    """Hand out computed columns through ``inline``, which works as a seam in the plan.

    Filters on the results do not cross it: a later ``human_score > x`` would otherwise be pushed below
    every stage, each alias replaced by its definition, and grow to many thousand nodes. It also ends the
    code-generation span, which keeps each generated method short enough for the JIT compiler (a single
    span over all stages runs about ten times slower, interpreted). Filters on other columns pass through.
    """
    kept = [name for name in df.columns if name not in results]
    row = f"inline(array(struct({', '.join(results)}))) as ({', '.join(results)})"
    return df.selectExpr(*kept, row)


def add_features(df: DataFrame, as_of) -> DataFrame:
    """The derived inputs of all class scores, one row in, one row out (no shuffle)."""
    df = df.withColumn("account_days", age_in_days(F.col("created_at"), as_of))
    df = _stage(
        df,
        ratio="greatest(-2D, least(3D, log10((followers + 1) / (following + 1))))",
        engagement="least(1D, favorites / (statuses + 1))",
        list_presence="tanh(listed / 50D)",
        media_share="least(1D, media / (statuses + 1))",
        age_curve="1D - exp(-account_days / 365D)",
        activity="statuses / (account_days + 1)",
        customised="(2D - cast(default_profile as double) - cast(default_image as double)) / 2D",
        safety="1D - 0.3D * cast(sensitive as double)",
        verified="cast(blue_verified as double)",
    )
    return _stage(df, ratio_norm="(ratio + 2D) / 5D")


def add_rule_scores(df: DataFrame) -> DataFrame:
    """Bot, creator and entity likelihood; their coefficients are fixed, not configurable."""
    bot = [
        "-3D", f"3D * {rising('activity', 50, 0.1)}", f"2D * {falling('engagement', 0.1, 5)}",
        f"1.5D * {falling('ratio', -1.5, 5)}", "1.5D * (1D - customised)", falling("age_curve", 0.1, 10),
    ]
    creator = [
        "-2.5D", f"1.5D * {rising('ratio', 1, 1)}", "1.2D * media_share", "0.8D * list_presence", "0.5D * verified",
        f"0.8D * {rising('followers', 10000, 0.0003)}",
    ]
    entity = [
        "-2.5D", f"1.2D * {rising('ratio', 1.7, 1)}", "0.8D * (1D - engagement)", "0.6D * media_share",
        "0.5D * verified", f"0.8D * {bell('activity', 3, 5)}",
    ]
    sums = {"bot_score": bot, "creator_score": creator, "entity_score": entity}
    return _stage(df, **{name: sigmoid(" + ".join(terms)) for name, terms in sums.items()})


def _activity_signal(p: Lookup) -> str:
    low, start = p("activityThresholds", "low"), p("activityThresholds", "veryLow")
    upto = lambda name: f"activity <= {p('activityThresholds', name)}"
    return ladder(
        [
            (f"activity < {start}", "0.5D"),
            (f"activity < {low}", f"0.5D + (0.4D * (activity - {start})) / ({low} - {start})"),
            (upto("optimalMax"), f"0.9D + 0.1D * {bell('activity', 1, 0.5)}"),
            (upto("highMax"), "0.75D"),
            (upto("veryHighMax"), "0.45D"),
        ],
        "0.2D",
    )


def add_person_score(df: DataFrame, p: Lookup) -> DataFrame:
    """Weighted sum of nine signals plus a bonus for verified accounts, at most 1."""
    signals = {
        "custom": "customised",
        "engaged": "least(1D, sqrt(engagement * 2D))",
        "age": "1D - exp(-account_days / 500D)",
        "safe": "safety",
        "balanced": bell("ratio_norm", 0.4, 0.25),
        "normalActivity": _activity_signal(p),
        "established": "least(1D, log10(followers + 1D) / 3D)",
        "moderateFollowing": declining("following", [(500, 1.0), (1500, 0.85), (3000, 0.6)], 2000, 0.3),
        "reasonableVolume": declining("statuses", [(5000, 1.0), (10000, 0.8), (20000, 0.5)], 10000, 0.3),
    }
    df = _stage(df, _base=" + ".join(f"{p('personWeights', weight)} * ({text})" for weight, text in signals.items()))
    return _stage(df, person_score=f"least(1D, _base + verified * 0.08D * {rising('_base', 0.7, 10)})")


def penalty_factor(p: Lookup) -> str:
    """Product of eight independent warning signs; inside one sign only the stronger case counts."""

    def sign(*cases: tuple[str, str]) -> str:
        return ladder([(test, p("penalties", factor)) for test, factor in cases], "1D")

    t = lambda name: p("penaltyThresholds", name)
    signs = [
        sign((f"followers < {t('veryFewFollowers')}", "veryFewFollowers"), (f"followers < {t('fewFollowers')}", "fewFollowers")),
        sign(("statuses = 0", "zeroStatuses"), (f"statuses < {t('veryFewStatuses')}", "veryFewStatuses")),
        sign((f"account_days < {t('veryNewDays')}", "veryNewAccount"), (f"account_days < {t('newDays')}", "newAccount")),
        sign((f"following > {t('massFollowing')} and followers < 100", "spamPattern")),
        sign((f"activity > {t('hyperactiveTweets')}", "hyperactive"), (f"activity > {t('highActivityTweets')}", "highActivity")),
        sign((f"statuses > {t('hugeStatuses')} and followers < statuses / 10", "highVolumeNoFollowers")),
        sign(("customised < 0.5D", "defaultProfile")),
        sign(
            (
                f"engagement < {t('lowEngagementRate')} and activity > {t('highActivityForLowEngagement')}",
                "lowEngagementHighActivity",
            )
        ),
    ]
    return " * ".join(signs)


def add_class(df: DataFrame, p: Lookup) -> DataFrame:
    """Class by strict priority, then the strongest class; a bad date gives null instead of a class."""
    cut = lambda name: p("classificationThresholds", name)
    choice = ladder(
        [
            ("account_days is null", "null"),
            (f"bot_score > {cut('bot')}", "'Bot'"),
            (f"entity_score > {cut('entity')} and bot_score < 0.5D", "'Entity'"),
            (f"creator_score > {cut('creator')} and entity_score < 0.5D and bot_score < 0.5D", "'Creator'"),
            (f"person_score > {cut('human')}", "'Human'"),
            ("person_score >= greatest(creator_score, entity_score, bot_score)", "'Human'"),
            ("creator_score >= greatest(entity_score, bot_score)", "'Creator'"),
        ],
        "'Other'",
    )
    df = _stage(df, likely_is=choice, penalty=penalty_factor(p))
    raw = (
        "case likely_is when 'Bot' then 1D - bot_score when 'Entity' then 1D - entity_score when 'Creator' then creator_score"
        " when 'Human' then person_score when 'Other' then 0.5D end"
    )
    df = _stage(df, _raw=raw)
    # Half up to four decimals, the stored precision of a score.
    score = "floor(greatest(0D, least(1D, _raw * penalty)) * 10000D + 0.5D) / 10000D"
    return _stage(df, human_score=f"case when _raw is not null then {score} end")


def _scored(df: DataFrame, p: Lookup) -> DataFrame:
    """Person score, class and final score on top of rule scores."""
    df = _sealed(add_person_score(df, p), ["_base", "person_score"])
    return _sealed(add_class(df, p), ["human_score", "likely_is"])


def _based(df: DataFrame, as_of) -> DataFrame:
    """Everything that does not depend on the config."""
    df = _sealed(add_features(df.drop("human_score", "likely_is"), as_of), ["account_days", *FEATURES])
    return _sealed(add_rule_scores(df), ["bot_score", "creator_score", "entity_score"])


def score_accounts(df: DataFrame, as_of, config: Config = DEFAULT_CONFIG, detail: bool = False) -> DataFrame:
    """Add ``human_score`` (0..1, four decimals) and ``likely_is`` to account rows.

    ``detail=True`` also keeps every feature, the four class scores and the penalty.
    """
    kept = [name for name in df.columns if name not in ("human_score", "likely_is")]
    extra = ["account_days", *FEATURES, *SCORES] if detail else []
    return _scored(_based(df, as_of), _from_dict(config)).select(*kept, *extra, "human_score", "likely_is")


def sweep_configs(df: DataFrame, as_of, configs: dict[str, Config]) -> DataFrame:
    """Score every account under several configs in one scan.

    Features and rule scores do not depend on the config: they are computed once per account, and only
    then is the row repeated for each config of the (fixed, literal) list.
    """
    kept = [name for name in df.columns if name not in ("human_score", "likely_is")]
    entries = [F.struct(F.lit(name).alias("name"), config_column(cfg).alias("cfg")) for name, cfg in configs.items()]
    repeated = _based(df, as_of).withColumn("_entry", F.explode(F.array(*entries)))
    repeated = repeated.selectExpr("*", "_entry.name as config_name", "_entry.cfg as _cfg")
    return _scored(repeated, _from_struct("_cfg")).select(*kept, "config_name", "human_score", "likely_is")
