"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation finds how far each can be trusted,
and the posterior probability of good quality decides.

Cases: a null or empty text has no words and fails the base rules; repeated rows and ties are judged alike, row by
row; an empty table gives an empty table; extra columns are ignored by ``quality_votes`` and carried by
``keep_good``, whatever their names; very long texts are worked off whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kithscope.llm.arrays import BLANK, HASH, code_points, covered, find_lines, find_words, mix, per_document, separators, slices, windows
from kithscope.llm.frames import carried, carried_schema

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_upper", "n_stops", "n_marks", "n_bars",
]
_SYMBOLS = separators(b"#*$%&|<>")


def _distinct_per_document(key: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    _, index = np.unique(mix(key + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    return np.bincount(doc[index], minlength=n)


def measure(texts) -> dict[str, np.ndarray]:
    """Every count of ``MEASURES`` for the documents of one slice."""
    buf, offs = texts
    n = len(offs) - 1
    words = find_words(texts, BLANK)
    doc = words.doc()
    points = code_points(buf)
    n_words = np.diff(words.first)
    hashes = HASH.of_bytes(buf, words.start, words.end)

    at = windows(words, 3)
    triples = HASH.ranges(HASH.prefix(hashes), at, at + 3)
    _, inverse, counts = np.unique(mix(triples + doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    repeated = covered(at[counts[inverse] > 1], 3, len(hashes)) if len(at) else np.zeros(len(hashes), dtype=bool)

    lines = find_lines(texts)
    worded = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    line_doc = lines.doc()
    full = np.flatnonzero(worded)
    line_hashes = HASH.of_bytes(buf, lines.start[full], lines.end[full])
    n_lines = np.bincount(line_doc[full], minlength=n)

    def count(flags: np.ndarray) -> np.ndarray:
        return per_document(flags, offs)

    upper, lower = (buf >= 65) & (buf <= 90), (buf >= 97) & (buf <= 122)
    last = buf[words.end - 1]
    return {
        "n_words": n_words,
        "word_chars": per_document(points[words.end] - points[words.start], words.first),
        "n_symbols": count(_SYMBOLS[buf]),
        "n_dup_lines": n_lines - _distinct_per_document(line_hashes, line_doc[full], n),
        "n_repeat_words": per_document(repeated, words.first),
        "n_lines": n_lines,
        "n_letters": count(upper | lower),
        "n_upper": count(upper),
        "n_stops": per_document((last == 46) | (last == 63), words.first),
        "n_marks": count(buf == 33),
        "n_bars": count(buf == 124),
    }


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """(row, doc_id, counts of ``MEASURES``) per document; ``row`` holds the input columns if ``carry``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in slices(batch.column("text")):
                found = measure(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(lo, hi - lo), batch.column("doc_id").slice(lo, hi - lo), *(pa.array(found[m].astype(np.int64)) for m in MEASURES)],
                    names=["row", "doc_id", *MEASURES],
                )

    schema = carried_schema(docs, carry, ("doc_id", T.LongType()), *((m, T.LongType()) for m in MEASURES))
    return carried(docs, id_col, text_col, carry).mapInArrow(run, schema)


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def rules() -> dict[str, Column]:
    """Each rule as a column: -1 bad, 1 good, 0 abstains (also where it has nothing to look at)."""
    words = F.col("n_words")
    share = lambda name, per="n_words": F.col(name) / F.when(F.col(per) > 0, F.col(per))
    length = share("word_chars")
    return {
        "repeats": _vote(share("n_repeat_words") > 0.4, share("n_repeat_words") < 0.1),
        "symbols": _vote(share("n_symbols") > 0.2, share("n_symbols") < 0.02),
        "capitals": _vote(share("n_upper", "n_letters") > 0.25, share("n_upper", "n_letters") < 0.1),
        "marks": _vote(share("n_marks") > 0.15, share("n_marks") < 0.03),
        "bars": _vote(share("n_bars") > 0.1, share("n_bars") < 0.01),
        "lines": _vote((share("n_dup_lines", "n_lines") > 0.5) & (F.col("n_lines") >= 8), (share("n_dup_lines", "n_lines") < 0.05) & (F.col("n_lines") >= 3)),
        "word_length": _vote((length < 2.5) | (length > 12), (length > 3) & (length < 9)),
        "sentences": _vote((share("n_stops") < 0.01) & (words >= 60), share("n_stops") > 0.03),
    }


class VoteModel(NamedTuple):
    """Per kind of junk: its log-odds against good quality before any vote, and what a rule's good or bad vote adds."""

    prior: dict[str, float]
    weights: dict[str, dict[str, tuple[float, float]]]

    def quality(self) -> Column:
        """Posterior probability of good quality, from the rules' columns."""
        junk = F.lit(0.0)
        for kind, start in self.prior.items():
            total = F.lit(start)
            for rule, (good, bad) in self.weights[kind].items():
                total = total + F.col(rule) * ((good - bad) / 2) + F.abs(rule) * ((good + bad) / 2)
            junk = junk + F.exp(total)
        return 1 / (1 + junk)


def fit_votes(votes: np.ndarray, counts: np.ndarray, names: list[str], rounds: int = 50, pseudo: float = 10.0) -> VoteModel:
    """Expectation-maximisation over distinct vote patterns.

    ``votes`` has one row per pattern, ``counts`` how many documents show it. Junk comes in kinds that share little
    (one is loud, another repeats itself), so the hidden state is good quality or one kind per rule. Each rule
    has a rate of bad votes, among its votes, in each state: that is its accuracy. Starts with documents nobody
    complains of as good, others shared among the kinds of the complaining rules. ``pseudo`` votes smooth every rate
    (1 % bad votes on good documents, 90 % by a rule on its own kind, 10 % by others).
    """
    m = len(names)
    spoken, bad = (votes != 0).astype(float), (votes == -1).astype(float)
    weight = counts.astype(float)
    belief = np.where((bad.sum(1) == 0)[:, None], np.eye(m + 1)[0], np.hstack([np.zeros((len(votes), 1)), bad / np.maximum(bad.sum(1), 1)[:, None]]))
    expected = np.vstack([np.full(m, 0.01), np.where(np.eye(m) > 0, 0.9, 0.1)])
    log_share, log_bad, log_good = np.zeros(m + 1), np.log(expected), np.log(1 - expected)
    for _ in range(rounds if len(votes) else 0):
        mass = belief * weight[:, None]
        rate = (mass.T @ bad + pseudo * expected) / (mass.T @ spoken + pseudo)
        log_bad, log_good = np.log(rate), np.log(1 - rate)
        log_share = np.log((mass.sum(0) + 1) / (weight.sum() + m + 1))
        score = log_share + bad @ log_bad.T + (spoken - bad) @ log_good.T
        belief = np.exp(score - score.max(1, keepdims=True))
        belief /= belief.sum(1, keepdims=True)
    weights = {kind: {rule: (float(log_good[k + 1, j] - log_good[0, j]), float(log_bad[k + 1, j] - log_bad[0, j])) for j, rule in enumerate(names)} for k, kind in enumerate(names)}
    return VoteModel({kind: float(log_share[k + 1] - log_share[0]) for k, kind in enumerate(names)}, weights)


def learn(counts: DataFrame) -> VoteModel:
    """Model of the whole corpus. Spark counts vote patterns (at most 3 to the number of rules); only those reach the driver."""
    named = rules()
    names = list(named)
    table = counts.select(*(c.cast("tinyint").alias(n) for n, c in named.items())).groupBy(*names).count().collect()
    votes = np.array([[r[n] for n in names] for r in table], dtype=np.int8).reshape(-1, len(names))
    return fit_votes(votes, np.array([r["count"] for r in table], dtype=np.int64), names)


def judged(counts: DataFrame, model: VoteModel, min_words: int, max_repeat_percent: int, threshold: float) -> DataFrame:
    """``counts`` with votes, ``base_failed``, posterior ``quality`` and ``kept``."""
    # The seam (inline of one struct) keeps the rules from being written out anew in every place that looks at a vote.
    counts = counts.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in rules().items())))))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    counts = counts.withColumn("quality", model.quality()).withColumn("base_failed", failed)
    return counts.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def quality_votes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_words: int = 50, max_repeat_percent: int = 50, threshold: float = 0.5, carry: bool = False
) -> DataFrame:
    """Counts, votes, posterior and verdict of each document. The texts are read twice: for the model, then for the verdicts."""
    model = learn(measured(docs, id_col, text_col))
    return judged(measured(docs, id_col, text_col, carry), model, min_words, max_repeat_percent, threshold)


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose verdict is to keep them."""
    return quality_votes(docs, carry=True, **options).filter("kept").select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
