"""Personal data by information-theoretic sanitisation, in DataFrame and SQL functions only.

Addresses, numbers and the like are found by pattern; they are the protected entities. Terms of the same documents can still
reveal an entity after it is gone. How strongly is estimated from the whole corpus: with co documents that hold the term and the entity,
wherever they stand, PMI = ln(co N / (df(entity) df(term))), against the entity's information content IC = ln(N / df(entity)). A term
with PMI of at least ``generalise_at`` x IC for some entity is generalised (letters become x, digits 0), of at least ``remove_at`` x IC
removed, wherever it occurs in any document; it takes ``min_support`` documents to tell, so an entity of fewer judges no terms. Terms are
words outside the entities' own spans.

Since co is at most df(entity), only terms of df(term) <= df(entity) (N / df(entity))^(1 - ``generalise_at``) can be judged; others are
left out before entities and terms of a document meet, and no judgement is lost.

Patterns run only over texts that hold their telling characters, and never backtrack into what they have read, so long
texts take linear time. Entities and terms are counted with map-side combining; a group is never gathered, only the spans of one document.

Cases: a null or empty text has no spans; matches that fail their check (number range, checksum, number of digits) are dropped
without a retry; repeated rows get the same spans; of the judgements of a term for several entities the strongest counts; an
empty table gives an empty table; extra columns are ignored; texts are searched whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithscope.llm.frames import stored

LOWEST = -(1 << 63)
KINDS = ["email", "ip", "card", "phone"]
TERM = "term"
# The patterns, with possessive repeats; \G admits a start right behind the last match.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WORTH = {"email": r"@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){12}", "phone": r"\+[0-9]"}
TERM_PATTERN = r"[\p{L}\p{N}]{3,}+"
_CHUNK = 256
FILTER_BITS = 24


def _seam(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """New columns computed once, however often later expressions name them."""
    return df.select(*keep, F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        return value.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")
    if kind == "phone":
        return n.between(9, 15)
    if kind == "card":
        # From the right, every second digit doubled, less 9 if above 9.
        each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((2 * d.cast("int")) % 10 + F.floor(d.cast("int") / 5).cast("int")))
        return F.when(n.between(13, 19), F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0).otherwise(F.lit(False))
    return F.lit(True)


def _sums_before(steps: str) -> Column:
    """For each element of the array column the sum of those before it, by chunks, so that long arrays stay cheap."""
    return F.expr(f"""
        flatten(zip_with(
            transform(sequence(0, (size({steps}) - 1) div {_CHUNK}), c -> slice({steps}, c * {_CHUNK} + 1, {_CHUNK})),
            aggregate(
                transform(sequence(0, (size({steps}) - 1) div {_CHUNK}), c -> aggregate(slice({steps}, c * {_CHUNK} + 1, {_CHUNK}), 0L, (a, x) -> a + x)),
                array(0L), (a, x) -> array_append(a, element_at(a, -1) + x)),
            (part, base) -> slice(aggregate(coalesce(part, array()), array(base), (a, x) -> array_append(a, element_at(a, -1) + x)), 1, coalesce(size(part), 0))
        ))""")


def _spans(kind: str, found: str, starts: str) -> Column:
    """Spans of ``found`` matches that pass their check."""
    whole = F.transform(F.col(found), lambda v, i: F.struct(F.get(starts, i).alias("start"), (F.get(starts, i) + F.length(v)).alias("end"), v.alias("value")))
    return F.filter(whole, lambda s: _valid(kind, s.getField("value")))


def _starts(df: DataFrame, keep: list[str], names: list[str]) -> DataFrame:
    """``keep``, found_NAME and before_NAME per name: where the matches in found_NAME start, gaps_NAME being the lengths between them."""
    keep = [*keep, *(f"found_{k}" for k in names)]
    gaps = [f"gaps_{k}" for k in names]
    steps = {f"steps_{k}": F.zip_with(f"found_{k}", F.slice(f"gaps_{k}", 1, F.greatest(F.size(f"found_{k}"), F.lit(0))), lambda v, g: g + F.length(v)) for k in names}
    df = _seam(df, [*keep, *gaps], **steps)
    before = {
        f"before_{k}": F.when(F.size(f"found_{k}") > 0, F.zip_with(_sums_before(f"steps_{k}"), F.slice(f"gaps_{k}", 1, F.size(f"found_{k}")), lambda b, g: b + g)).otherwise(
            F.array().cast("array<bigint>")
        )
        for k in names
    }
    return _seam(df, keep, **before)


def _gaps(text: str, pattern: str) -> Column:
    return F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))


def base_spans(texts: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and, per kind, an array of (start, end, value); ``texts`` has a column text, not null."""
    found, gaps = {}, {}
    for k in KINDS:
        worth = F.col("text").rlike(WORTH[k])
        found[f"found_{k}"] = F.when(worth, F.regexp_extract_all("text", F.lit(PATTERNS[k]), 0)).otherwise(F.array().cast("array<string>"))
        gaps[f"gaps_{k}"] = F.when(worth, _gaps("text", PATTERNS[k])).otherwise(F.array().cast("array<bigint>"))
    df = _starts(_seam(texts, keep, **found, **gaps), keep, KINDS)
    return _seam(df, keep, **{k: _spans(k, f"found_{k}", f"before_{k}") for k in KINDS})


def with_rest(based: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``rest``: the text with blanks in place of its entities, so that places stay the same."""
    all_ = F.sort_array(F.concat(*(F.transform(k, lambda s: F.struct(s.getField("start").alias("start"), s.getField("end").alias("end"))) for k in KINDS)))
    df = _seam(based, [*dict.fromkeys([*keep, "text"])], marks=all_)
    cut = lambda a, b: F.substring("text", (a + 1).cast("int"), (b - a).cast("int"))

    def step(acc: Column, s: Column) -> Column:
        at, end = acc.getField("at"), s.getField("end")
        start = F.greatest(at, s.getField("start"))
        more = F.struct(end.alias("at"), F.concat(acc.getField("out"), F.array(cut(at, start), F.repeat(F.lit(" "), (end - start).cast("int")))).alias("out"))
        return F.when(end > at, more).otherwise(acc)

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate("marks", zero, step, lambda acc: F.concat(F.array_join(acc.getField("out"), ""), F.substring("text", (acc.getField("at") + 1).cast("int"), F.length("text"))))
    return _seam(df, keep, rest=F.when(F.size("marks") > 0, done).otherwise(F.col("text")))


def held_terms(texts: DataFrame) -> DataFrame:
    """(id_key, text_key, entities, terms) per document, distinct ones."""
    keep = ["id_key", "text_key"]
    entities = F.array_distinct(F.concat(*(F.transform(k, lambda s, k=k: F.concat(F.lit(f"{k}:"), F.lower(s.getField("value")))) for k in KINDS)))
    named = _seam(base_spans(texts, [*keep, "text"]), [*keep, "text", *KINDS], entities=entities)
    rest = with_rest(named, [*keep, "entities"])
    words = F.transform(F.regexp_extract_all("rest", F.lit(TERM_PATTERN), 0), F.lower)
    return rest.select(*keep, "entities", F.array_distinct(words).alias("terms"))


def placed_terms(texts: DataFrame) -> DataFrame:
    """(id_key, text_key, term, start, end): one row per term outside entities."""
    keep = ["id_key", "text_key"]
    rest = with_rest(base_spans(texts, [*keep, "text"]), keep)
    df = _starts(_seam(rest, keep, found_terms=F.regexp_extract_all("rest", F.lit(TERM_PATTERN), 0), gaps_terms=_gaps("rest", TERM_PATTERN)), keep, ["terms"])
    start = lambda i: F.get("before_terms", i)
    places = F.transform("found_terms", lambda v, i: F.struct(F.lower(v).alias("term"), start(i).alias("start"), (start(i) + F.length(v)).alias("end")))
    return df.select(*keep, F.inline(places))


def maybe_in(placed: DataFrame, judged: DataFrame) -> DataFrame:
    """``placed`` without most of the terms that are not in ``judged``, by a bit per hash in a table of fixed size."""
    hash_ = F.pmod(F.xxhash64("term"), F.lit(1 << FILTER_BITS))
    bits = judged.select(hash_.alias("h")).groupBy(F.shiftright("h", 6).alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits"))
    met = placed.withColumn("h", hash_).withColumn("slot", F.shiftright("h", 6)).join(stored(bits, "judged-bits"), "slot")
    return met.filter(F.expr("getbit(bits, cast(h & 63 as int)) = 1")).drop("h", "slot", "bits")


def judged_terms(held: DataFrame, min_support: int, generalise_at: float, remove_at: float) -> DataFrame:
    """(term, action) of the terms that disclose too much, with the strongest action. ``held`` has all documents."""
    keys = ["id_key", "text_key"]
    n = float(max(held.count(), 1))
    # Repeated rows hold an entity once.
    entities = stored(held.select(*keys, F.explode("entities").alias("entity")).distinct(), "entities")
    known = entities.groupBy("entity").agg(F.count("*").alias("df_entity")).filter(F.col("df_entity") >= min_support)
    limit = F.col("df_entity") * F.pow(F.lit(n) / F.col("df_entity"), F.lit(1 - generalise_at)) * (1 + 1e-9)
    known = stored(entities.join(known.withColumn("most", limit), "entity"), "known-entities")
    most = known.agg(F.max("most")).first()[0]
    if most is None:
        return known.select(F.col("entity").alias("term"), F.lit("").alias("action"))
    counts = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df_term")).filter(F.col("df_term").between(min_support, most))
    with_known = held.select(*keys, "terms").join(known.select(*keys).distinct(), keys, "left_semi")
    terms = with_known.select(*keys, F.explode("terms").alias("term")).distinct().join(counts, "term")
    pairs = known.join(terms, keys).filter("df_term <= most").groupBy("entity", "df_entity", "term", "df_term").agg(F.count("*").alias("co")).filter(F.col("co") >= min_support)
    information = F.log(F.lit(n) / F.col("df_entity"))
    pmi = F.log(F.col("co") * n / (F.col("df_entity") * F.col("df_term")))
    both = pairs.withColumn("share", F.when(information > 0, pmi / information).otherwise(0.0))
    action = F.when(F.col("share") >= remove_at, "remove").otherwise("generalise")
    # 'remove' sorts behind 'generalise': the larger action is the stronger.
    return both.filter(F.col("share") >= generalise_at).groupBy("term").agg(F.max(action).alias("action"))


def find_disclosures(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    min_support: int = 2,
    generalise_at: float = 0.75,
    remove_at: float = 0.9,
) -> DataFrame:
    """(doc_id, text_key, text, email, ip, card, phone, terms): spans of each kind, in order; ``terms`` with their action."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = texts.select("doc_id", F.coalesce("doc_id", F.lit(LOWEST)).alias("id_key"), F.xxhash64("text").alias("text_key"), "text")
    held = stored(held_terms(texts), "held-terms")
    judged = stored(judged_terms(held, min_support, generalise_at, remove_at), "judged-terms")
    keys = ["id_key", "text_key"]
    placed = placed_terms(texts)
    # Only terms that may be judged are dealt out, to meet the judgements themselves.
    flagged = maybe_in(placed, judged).join(judged, "term")
    terms = flagged.groupBy(*keys).agg(F.sort_array(F.collect_set(F.struct("start", "end", "action"))).alias("terms"))
    based = base_spans(texts, ["doc_id", *keys, "text"])
    plain = lambda k: F.transform(k, lambda s: F.struct(s.getField("start").alias("start"), s.getField("end").alias("end"))).alias(k)
    joined = based.select("doc_id", *keys, "text", *map(plain, KINDS)).join(terms, keys, "left")
    return joined.select("doc_id", "text_key", "text", *KINDS, F.coalesce("terms", F.array().cast("array<struct<start:bigint,end:bigint,action:string>>")).alias("terms"))


def written(found: list[str]) -> Column:
    """Spans of the given kinds as kind:start:end, comma-joined."""

    def of(kind: str) -> Column:
        return F.transform(f"{TERM}s" if kind == TERM else kind, lambda s: F.concat_ws(":", F.lit(kind), s.getField("start"), s.getField("end")))

    return F.array_join(F.concat(*map(of, found)), ",")


def sanitised(found: DataFrame) -> DataFrame:
    """(doc_id, text) with entities named by kind and disclosing terms generalised or removed; of overlapping spans the first counts."""

    def named(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s.getField("start").alias("start"), s.getField("end").alias("end"), F.lit(f"<{kind.upper()}>").alias("put")))

    value = lambda s: F.substring("text", (s.getField("start") + 1).cast("int"), (s.getField("end") - s.getField("start")).cast("int"))
    general = lambda s: F.regexp_replace(F.regexp_replace(value(s), r"\p{L}", "x"), r"\p{N}", "0")
    terms = F.transform("terms", lambda s: F.struct(s.getField("start").alias("start"), s.getField("end").alias("end"), F.when(s.getField("action") == "remove", F.lit("")).otherwise(general(s)).alias("put")))
    df = _seam(found, ["doc_id", "text"], marks=F.sort_array(F.concat(*map(named, KINDS), terms)))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    cut = lambda a, b: F.substring("text", (a + 1).cast("int"), (b - a).cast("int"))
    step = lambda acc, s: F.when(
        s.getField("start") >= acc.getField("at"),
        F.struct(s.getField("end").alias("at"), F.concat(acc.getField("out"), F.array(cut(acc.getField("at"), s.getField("start")), s.getField("put"))).alias("out")),
    ).otherwise(acc)
    done = F.aggregate("marks", start, step, lambda acc: F.concat(F.array_join(acc.getField("out"), ""), F.substring("text", (acc.getField("at") + 1).cast("int"), F.length("text"))))
    return df.select("doc_id", F.when(F.size("marks") > 0, done).otherwise(F.col("text")).alias("text"))
