"""Benchmark decontamination with a generalised suffix automaton.

The items' normalised words go into one automaton (per block of items); training documents stream through it, the
length of the longest match ending at each word is tracked, and spans are removed that hold a whole window of
``window`` words (or a whole shorter item). Documents that are mostly benchmark go as a whole.

Cases: a null or empty text has no words and is never hit; items without words are ignored; an empty benchmark hits
nothing; repeated items all count, repeated rows are judged alike; extra columns are carried whatever their names;
long texts are worked off whole.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kithscope.llm.arrays import LOWER, NOT_ALNUM
from kithscope.llm.frames import carried, carried_schema, with_text

#: Bytes to lower-case letters, and everything that is no part of a word to a space.
_CLEAN = bytes(32 if NOT_ALNUM[LOWER[b]] else int(LOWER[b]) for b in range(256))
_WORD = re.compile(rb"[^ ]+")
MAX_BLOCK_WORDS = 2_000_000


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_CLEAN).split() if text else []


class Automaton:
    """Generalised suffix automaton of the items' word sequences, with the longest match while streaming words."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.shortest = window
        numbered = []
        for item, words in items:
            if words:
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                numbered.append((item, ids))
                self.shortest = min(self.shortest, len(ids))
                last = 0
                for w in ids:
                    last = self._extend(last, w)
        self._mark(numbered)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        known = nxt[last].get(w)
        if known is not None:
            return known if length[known] == length[last] + 1 else self._clone(last, w, known)
        state = self._state({}, length[last] + 1)
        while last != -1 and w not in nxt[last]:
            nxt[last][w] = state
            last = link[last]
        if last == -1:
            link[state] = 0
        else:
            other = nxt[last][w]
            link[state] = other if length[other] == length[last] + 1 else self._clone(last, w, other)
        return state

    def _state(self, edges: dict[int, int], length: int) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, last: int, w: int, other: int) -> int:
        copy = self._state(dict(self.next[other]), self.length[last] + 1)
        self.link[copy] = self.link[other]
        self.link[other] = copy
        while last != -1 and self.next[last].get(w) == other:
            self.next[last][w] = copy
            last = self.link[last]
        return copy

    def _mark(self, numbered: list[tuple[int, list[int]]]) -> None:
        """Items by the state of each of their windows, and by the state of the whole of a short item."""
        self.owners: dict[int, set[int]] = {}
        self.whole: dict[int, tuple[int, set[int]]] = {}
        for item, ids in numbered:
            state, matched = 0, 0
            for w in ids:
                state, matched = self.step(state, matched, w)
                if matched >= self.window:
                    self.owners.setdefault(self.floor(state), set()).add(item)
            if len(ids) < self.window:
                self.whole.setdefault(state, (len(ids), set()))[1].add(item)

    def step(self, state: int, matched: int, w: int) -> tuple[int, int]:
        while state and w not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        to = self.next[state].get(w)
        return (0, 0) if to is None else (to, matched + 1)

    def floor(self, state: int) -> int:
        """The state on the suffix path that holds the last ``window`` words."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def stream(self, ids: list[int | None], hit: bytearray, found: set[int], offset: int) -> int:
        """Marks hit words from ``offset`` on, adds items to ``found``, returns the longest match."""
        state = matched = longest = 0
        window = self.window
        for i, w in enumerate(ids, offset):
            state, matched = self.step(state, matched, w)
            longest = max(longest, matched)
            if matched >= window:
                hit[i - window + 1 : i + 1] = b"\x01" * window
                found |= self.owners[self.floor(state)]
            if self.whole:
                at = state
                while at:
                    short = self.whole.get(at)
                    if short and short[0] <= matched:
                        hit[i - short[0] + 1 : i + 1] = b"\x01" * short[0]
                        found |= short[1]
                    at = self.link[at]
        return longest

    def scan(self, words: list[bytes], hit: bytearray, found: set[int]) -> int:
        """Streams every run of known words that is long enough for a match; others cannot hold one."""
        known = bytes(map(self.vocabulary.__contains__, words))
        least, longest, at = b"\x01" * self.shortest, 0, 0
        while (at := known.find(least, at)) >= 0:
            stop = known.find(b"\x00", at)
            stop = len(words) if stop < 0 else stop
            longest = max(longest, self.stream([self.vocabulary[w] for w in words[at:stop]], hit, found, at))
            at = stop
        return longest


def _blocks(items: list[tuple[int, list[bytes]]], most: int) -> list[list[tuple[int, list[bytes]]]]:
    """Items in blocks of at most ``most`` words (a longer item is a block of its own)."""
    out: list[list] = [[]]
    size = 0
    for item in items:
        if out[-1] and size + len(item[1]) > most:
            out.append([])
            size = 0
        out[-1].append(item)
        size += len(item[1])
    return out


def _spans(text: str, hit: bytearray) -> list[dict[str, int]]:
    """Hit runs of words as code point ranges, with their first word and number of words."""
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw.translate(_CLEAN))]
    points = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80, out=points[1:])
    out, i = [], 0
    while (i := hit.find(1, i)) >= 0:
        stop = hit.find(0, i)
        stop = len(hit) if stop < 0 else stop
        out.append({"start": int(points[at[i][0]]), "end": int(points[at[stop - 1][1]]), "first_word": i, "words": stop - i})
        i = stop
    return out


_BUILT: dict[str, list[Automaton]] = {}


def _automata(token: str, blocks: list, window: int) -> list[Automaton]:
    """The automata of one call, built once in each Python worker."""
    if token not in _BUILT:
        _BUILT.clear()
        _BUILT[token] = [Automaton(b.value, window) for b in blocks]
    return _BUILT[token]


SPAN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "end", "first_word", "words")])


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    *,
    window: int = 10,
    max_block_words: int = MAX_BLOCK_WORDS,
    carry: bool = False,
) -> DataFrame:
    """(row, doc_id, text, n_words, n_hit, longest, items, spans) per document; ``items`` sorted as strings.

    The benchmark is the stated query set: it is read on the driver, cut into blocks of ``max_block_words`` words, and
    each block is an automaton of its own (one broadcast of bounded size); every document runs against all blocks.
    """
    spark = docs.sparkSession
    rows = benchmark.select(F.col(item_col), F.col(item_text_col).cast("string").alias("text")).filter("text is not null").toLocalIterator()
    items = [(r[0], words_of(r[1])) for r in rows]
    blocks = [spark.sparkContext.broadcast(b) for b in _blocks(items, max_block_words)]
    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = _automata(token, blocks, window)
        for batch in batches:
            n_words, n_hit, longest, names, spans = [], [], [], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                words = words_of(text)
                hit, found, most = bytearray(len(words)), set(), 0
                for a in automata:
                    most = max(most, a.scan(words, hit, found))
                n_words.append(len(words))
                n_hit.append(hit.count(1))
                longest.append(most)
                names.append(sorted(map(str, found)))
                spans.append(_spans(text, hit) if found else [])
            done = [pa.array(x, pa.int64()) for x in (n_words, n_hit, longest)]
            span = pa.list_(pa.struct([(f.name, pa.int64()) for f in SPAN]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("text"), *done, pa.array(names, pa.list_(pa.string())), pa.array(spans, span)],
                names=["row", "doc_id", "text", "n_words", "n_hit", "longest", "items", "spans"],
            )

    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("n_words", T.LongType()), ("n_hit", T.LongType()), ("longest", T.LongType())]
    schema = carried_schema(docs, carry, *fields, ("items", T.ArrayType(T.StringType())), ("spans", T.ArrayType(SPAN)))
    return carried(docs, id_col, text_col, carry).mapInArrow(run, schema)


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` less the given code point ranges."""
    gaps = F.transform(spans, lambda s, i: F.substring(text, F.when(i == 0, F.lit(0)).otherwise(F.element_at(spans, i.cast("int")).getField("end")).cast("int") + 1, (s.getField("start") - F.when(i == 0, F.lit(0)).otherwise(F.element_at(spans, i.cast("int")).getField("end"))).cast("int")))
    rest = F.substring(text, (F.element_at(spans, -1).getField("end") + 1).cast("int"), F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(gaps, ""), rest))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", *, max_coverage: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` with benchmark spans cut out; those with more than ``max_coverage`` of their words hit go."""
    found = find_benchmark(docs, benchmark, text_col=text_col, carry=True, **options)
    kept = found.filter(F.col("n_hit") <= max_coverage * F.col("n_words"))
    clean = F.when(F.size("spans") > 0, without_spans(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    return kept.select(*with_text(clean, docs.columns, text_col))
