"""Near-duplicate classes by improved consistent weighted sampling.

A document is the weighted set of its five-word shingles; a shingle weighs its count in the document times its inverse document
frequency, which is counted over all distinct word sequences in a table of hashed shingles of fixed size (so it can be handed to
every task). Copies count once, and no weight is more than ``SPREAD`` times another, so that shingles of a large group of near copies
are not outweighed by the few that an edit changes. Samples are drawn so that two documents agree
in one with the probability of their weighted Jaccard similarity; four samples make a band. Documents that agree in
a band are compared exactly, and those whose weighted or plain similarity is ``threshold`` or more are linked: weights add
links to those of plain shingle counts and take none away. Classes are the components of links.

Copies of one word sequence are one node throughout. Documents that share a long passage fall into one bucket without being
similar; a bucket of more than ``LARGE`` nodes is therefore split by prefix: with shingles in one order, rarest first, two documents can
only reach the threshold if they share one of the first shingles, up to where the rest weighs less than ``threshold`` of the
whole. That loses no pair. What comes from a shared shingle on also bounds how large a partner can be, its reach: of two similar documents
the smaller one reaches its own size where they first meet (it is at home there), and each reaches the other. Members that reach
no home of their bucket, or only homes of their own class, leave it. A large bucket is never expanded into all pairs either: first one
of its homes, the one of the commonest shingles and so the nearest to the middle of a group, is the hub that meets
all members and leaves. What then still holds several classes is settled in a second and last step. Buckets that are still large are
compared in blocks, which give back at most one link per node; members of one large class lie in blocks of their own, which do not meet
each other, and blocks without homes do not either. In the others, of ``LARGE`` members at most, all pairs of different classes within
reach are compared, each pair once for all buckets it shares.
A pair of one bucket is thus compared, or excluded by its prefixes, or already in one class: no link between
classes is lost, nothing is capped, and the number of steps does not hang on the data.

Cases: documents of fewer than five words have one shingle, all their words; null or empty texts and texts of
blanks are classes of their own; ties take the smallest id; a null id is the smallest; repeated rows share a
class; an empty table gives an empty table; extra columns are carried whatever their names; long texts are worked off whole.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kithscope.llm.arrays import BLANK, HASH, LOWER, Texts, Words, find_words, mix, signed, slices, windows
from kithscope.llm.components import merge_labels
from kithscope.llm.frames import carried, stored

LOWEST = -(1 << 63)
FREQUENCY_BITS = 16
VARIATES_BITS = 16
LARGE = 32
BLOCK = 512
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Largest weight over smallest. A pair of plain similarity 0.8 then has a weighted one of 0.76 at least.
SPREAD = 1.25
MEMBER = "bucket long, node long, common long, size double, weight double, reach double, weight_reach double"
MEASURES = ["size", "weight", "reach", "weight_reach"]


def shingles(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, count) of each document's distinct shingles in order of documents, and a hash of each document's words."""
    texts = Texts(LOWER[texts.buf], texts.offs)
    words = find_words(texts, BLANK)
    hashes = HASH.of_bytes(texts.buf, words.start, words.end)
    sums = HASH.prefix(hashes)
    content = HASH.ranges(sums, words.first[:-1], words.first[1:])
    at = windows(words, size)
    doc = words.doc()[at]
    all_ = HASH.ranges(sums, at, at + size)
    n_words = np.diff(words.first)
    few = np.flatnonzero((n_words > 0) & (n_words < size))
    doc, all_ = np.concatenate([doc, few]), np.concatenate([all_, content[few]])
    order = np.lexsort((all_, doc))
    doc, all_ = doc[order], all_[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (all_[1:] != all_[:-1])
    first = np.flatnonzero(new)
    return doc[first], all_[first], np.diff(np.append(first, len(doc))), content


def _bucket(shingle: np.ndarray) -> np.ndarray:
    return (shingle >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)


def document_frequencies(texts: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many distinct word sequences each bucket of shingles occurs, and their number. A table of fixed size."""
    n_buckets = 1 << FREQUENCY_BITS

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, part in slices(batch.column("text")):
                doc, shingle, _, content = shingles(part, size)
                key = np.unique((doc << FREQUENCY_BITS) | _bucket(shingle))
                has, first = np.unique(key >> FREQUENCY_BITS, return_index=True)
                buckets = (key & (n_buckets - 1)).astype("<u2").tobytes()
                ends = 2 * np.append(first, len(key))
                # Copies within a slice go at once, others where they meet.
                _, once = np.unique(content[has], return_index=True)
                packed = [buckets[ends[i] : ends[i + 1]] for i in once]
                yield pa.RecordBatch.from_arrays([signed(content[has][once]), pa.array(packed, pa.binary())], names=["node", "buckets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, docs = np.zeros(n_buckets, dtype=np.int64), 0
        for batch in batches:
            for packed in batch.column("buckets"):
                seen[np.frombuffer(packed.as_buffer(), dtype="<u2")] += 1
            docs += batch.num_rows
        full = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(full, -1)), pa.array(np.append(seen[full], docs))], names=["bucket", "n"])

    once = texts.select("text").mapInArrow(held, "node long, buckets binary").dropDuplicates(["node"]).select("buckets")
    counted = once.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(n_buckets, dtype=np.int64)
    known = counted[counted["bucket"] >= 0]
    table[known["bucket"].to_numpy(dtype=np.int64)] = known["n"].to_numpy(dtype=np.int64)
    return table, int(counted.loc[counted["bucket"] < 0, "n"].sum())


def shingle_weights(table: np.ndarray, n_docs: int) -> np.ndarray:
    """Inverse document frequency by bucket, as single precision, none less than the largest in use by more than ``SPREAD``."""
    weights = np.log1p((1 + n_docs) / (1 + table))
    top = weights[table > 0].max(initial=0.0) or 1.0
    return np.clip(weights, top / SPREAD, top).astype(np.float32)


class WeightedSampler:
    """Consistent weighted samples: for sample k and a shingle of weight w, t = floor(ln w / r + b) and
    ln a = ln c - r (t - b + 1) with r, c from Gamma(2, 1) and b uniform; the shingle of least a, with its t, is the sample.

    The variates of (sample, shingle) are picked by hash from one table of fixed values.
    """

    def __init__(self, samples: int) -> None:
        rng = np.random.Generator(np.random.PCG64(20240229))
        n = 1 << VARIATES_BITS
        self.r = rng.gamma(2.0, 1.0, n).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, n)).astype(np.float32)
        self.b = rng.random(n, dtype=np.float32)
        self.inverse_r = (1 / self.r).astype(np.float32)
        self.factors = mix(np.arange(1, samples + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)

    def samples(self, shingle: np.ndarray, log_weight: np.ndarray, first: np.ndarray) -> np.ndarray:
        """One row per document (of shingles first[i]:first[i + 1], not empty), one 64-bit value per sample."""
        out = np.empty((len(first) - 1, len(self.factors)), dtype=np.uint64)
        starts, sizes = first[:-1], np.diff(first)
        for k, factor in enumerate(self.factors):
            at = ((shingle * factor) >> np.uint64(64 - VARIATES_BITS)).astype(np.int64)
            t = np.floor(log_weight * self.inverse_r[at] + self.b[at])
            log_a = self.log_c[at] - self.r[at] * (t - self.b[at] + 1)
            least = np.minimum.reduceat(log_a, starts)
            # Of equal values (rounding) the smallest shingle wins, in whatever order they stand.
            best = np.flatnonzero(log_a == np.repeat(least, sizes))
            owner = np.searchsorted(first, best, side="right") - 1
            lead = np.ones(len(owner), dtype=bool)
            lead[1:] = owner[1:] != owner[:-1]
            best = best[lead]
            out[:, k] = mix(shingle[best] + t[best].astype(np.int64).view(np.uint64) * GOLDEN)
        return out


def signatures(keyed: DataFrame, weights: np.ndarray, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, id_key, text_key, node, bands) per document; node and bands are null for documents without words."""
    shared = keyed.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = WeightedSampler(bands * rows)
        for batch in batches:
            for lo, hi, texts in slices(batch.column("text")):
                doc, shingle, count, content = shingles(texts, size)
                first = np.append(np.flatnonzero(np.diff(doc, prepend=-1)), len(doc))
                has = doc[first[:-1]]
                log_weight = np.log(count.astype(np.float32) * shared.value[_bucket(shingle)])
                drawn = sampler.samples(shingle, log_weight, first) if len(has) else np.zeros((0, bands * rows), dtype=np.uint64)
                keys = np.zeros((len(has), bands), dtype=np.uint64)
                for b in range(bands):
                    for r in range(rows):
                        keys[:, b] = mix(keys[:, b] * GOLDEN + drawn[:, b * rows + r] + np.uint64(b))
                place = np.full(hi - lo, -1)
                place[has] = np.arange(len(has))
                index = pa.array(place, mask=place < 0)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), signed(keys.ravel()))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id_key"), part.column("text_key"), signed(content[has]).take(index), lists.take(index)], names=["id_key", "text_key", "node", "bands"]
                )

    return keyed.select("id_key", "text_key", "text").mapInArrow(run, "id_key long, text_key long, node long, bands array<long>")


def weighted_jaccard(weights: np.ndarray, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Similarity of two documents as (distinct shingles, counts): the larger of the weighted and the plain one."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)

    def similarity(wa: np.ndarray, wb: np.ndarray) -> float:
        both = np.minimum(wa[ia], wb[ib]).sum()
        return float(both / (wa.sum() + wb.sum() - both))

    return max(similarity(*(x[1] * weights[_bucket(x[0])].astype(float) for x in (a, b))), similarity(a[1], b[1]))


def tokens_of(shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A shingle that occurs n times as n tokens that differ in the low bits: then minima of counts are plain intersections."""
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    top = np.uint64(64 - FREQUENCY_BITS)
    whole = np.repeat(shingle, count)
    return np.where(nth == 0, whole, ((whole >> top) << top) | (mix(whole + nth.astype(np.uint64) * GOLDEN) >> np.uint64(FREQUENCY_BITS)))


def token_sets(texts: DataFrame, size: int) -> DataFrame:
    """(node, large, tokens): the sorted tokens of each text, as 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, part in slices(batch.column("text")):
                doc, shingle, count, _ = shingles(part, size)
                first = np.searchsorted(doc, np.arange(hi - lo + 1))
                packed = [np.sort(tokens_of(shingle[a:b], count[a:b])).tobytes() for a, b in itertools.pairwise(first)]
                rows = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([rows.column("node"), rows.column("large"), pa.array(packed, pa.binary())], names=["node", "large", "tokens"])

    return texts.select("node", "large", "text").mapInArrow(run, "node long, large boolean, tokens binary")


def verified(pairs: DataFrame, sets: DataFrame, weights: np.ndarray, threshold: float) -> DataFrame:
    """The (a, b) of ``pairs`` of nodes whose token sets have a similarity of ``threshold`` or more."""
    shared = pairs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (a, b) in enumerate(zip(batch.column("set_a"), batch.column("set_b"), strict=True)):
                a, b = (np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in (a, b))
                both = np.intersect1d(a, b, assume_unique=True)
                wa, wb, wo = (shared.value[_bucket(x)].sum(dtype=np.float64) for x in (a, b, both))
                keep[i] = wo >= threshold * (wa + wb - wo) or len(both) >= threshold * (len(a) + len(b) - len(both))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])

    sided = pairs.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("set_b")), "b").join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("set_a")), "a")
    return sided.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def similar_in_blocks(live: DataFrame, sets: DataFrame, weights: np.ndarray, threshold: float) -> DataFrame:
    """Links (a, b) that join up all similar nodes of each bucket of ``live`` (bucket, node, label, home), whatever its size.

    A bucket's nodes are dealt into blocks of about ``BLOCK``, those of a class of that size or more into blocks of their own; each two
    blocks, but for two of one class or without homes, meet in one small group, which compares all its nodes at once (a product of matrices) and
    gives back no more links than it has nodes.
    """
    shared = live.sparkSession.sparkContext.broadcast(weights)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(x, dtype=np.uint64) for x in group["tokens"]]
        n, nodes = len(lists), group["node"].to_numpy()
        owner = np.repeat(np.arange(n), [len(x) for x in lists])
        names, token, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        weight = shared.value[_bucket(names)].astype(np.float64)
        whole, sizes = np.bincount(owner, weights=weight[token], minlength=n), np.bincount(owner, minlength=n)
        both, shared_tokens = np.zeros((n, n)), np.zeros((n, n), dtype=np.float32)
        common = np.flatnonzero(count > 1)
        column = np.full(len(names), -1)
        for lo in range(0, len(common), 4096):
            part = common[lo : lo + 4096]
            column[:] = -1
            column[part] = np.arange(len(part))
            here = column[token] >= 0
            x = np.zeros((n, len(part)))
            x[owner[here], column[token[here]]] = 1
            # Counts are exact in single precision.
            single = x.astype(np.float32)
            shared_tokens += single @ single.T
            both += (x * weight[part]) @ x.T
        near = both >= (threshold - 1e-9) * (whole[:, None] + whole[None, :] - both)
        near |= shared_tokens >= (threshold - 1e-9) * (sizes[:, None] + sizes[None, :] - shared_tokens)
        # A spanning forest says as much as all links.
        label, out = np.arange(n), []
        for i in range(n):
            for j in np.flatnonzero(near[i, :i] & (label[:i] != label[i])):
                if label[i] != label[j]:
                    out.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
                    label[label == label[i]] = label[j]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    sized = live.withColumn("of_label", F.count("*").over(Window.partitionBy("bucket", "label")))
    pure = F.when(F.col("of_label") >= BLOCK, F.col("label"))
    sized = sized.withColumn("pure", pure).withColumn("of_block", F.count("*").over(Window.partitionBy("bucket", "pure", "home")))
    slot = F.pmod(F.xxhash64("node"), F.ceil(F.col("of_block") / BLOCK))
    placed = sized.select("bucket", "node", F.struct(F.coalesce("pure", F.lit(LOWEST)).alias("class"), "home", slot.alias("slot")).alias("block"))
    # One entry for about BLOCK nodes. A block of one class needs no other block of that class, one without homes needs one with.
    blocks = placed.groupBy("bucket").agg(F.collect_set("block").alias("blocks"))
    me = F.col("block")
    apart = lambda b: ((b["class"] != me["class"]) | ((b["class"] == LOWEST) & (b != me))) & (b["home"] | me["home"])
    dealt = placed.join(blocks, "bucket").withColumn("others", F.filter("blocks", apart))
    alone = F.when((F.size("others") == 0) & (me["class"] == LOWEST) & me["home"], F.array("block")).otherwise(F.col("others"))
    dealt = dealt.select("bucket", "node", "block", F.explode(alone).alias("other"))
    dealt = dealt.select("bucket", "node", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    # Two blocks that meet are compared within themselves too.
    return dealt.join(sets.select("node", "tokens"), "node").groupBy("bucket", "i", "j").applyInPandas(compare, "a long, b long")


def prefixes(sets: DataFrame, table: np.ndarray, weights: np.ndarray, threshold: float) -> DataFrame:
    """``MEMBER`` rows: the first tokens of each set, rarest first, without which it cannot be similar to another, weighted or plain.

    ``size`` is the set's, ``reach`` the largest that a similar set can have if this token is the first they share:
    they share at most what follows, and have to share threshold / (1 + threshold) of both sizes together.
    """
    shared = sets.sparkSession.sparkContext.broadcast((table, weights))
    times = (1 + threshold) / threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, weights = shared.value
        for batch in batches:
            for node, packed in zip(batch.column("node"), batch.column("tokens"), strict=True):
                token = np.frombuffer(packed.as_buffer(), dtype=np.uint64)
                seen = frequency[_bucket(token)]
                order = np.lexsort((token, seen))
                weight = weights[_bucket(token[order])].astype(np.float64)
                rest, left = np.cumsum(weight[::-1])[::-1], np.arange(len(token), 0, -1).astype(np.float64)  # from this token on
                first = (rest >= (threshold - 1e-6) * rest[0]) | (left >= (threshold - 1e-6) * left[0])
                keep, n = token[order][first], int(first.sum())
                same = [pa.array(np.full(n, x)) for x in (node.as_py(), int(seen.mean()), left[0], rest[0])]
                reach, weight_reach = ((x[first] * times - x[0]) * (1 + 1e-6) + 1e-6 * x[0] for x in (left, rest))
                yield pa.RecordBatch.from_arrays([signed(keep), *same, pa.array(reach), pa.array(weight_reach)], names=["bucket", "node", "common", "size", "weight", "reach", "weight_reach"])

    return sets.select("node", "tokens").mapInArrow(run, MEMBER)


def at_home() -> Column:
    return (F.col("reach") >= F.col("size")) | (F.col("weight_reach") >= F.col("weight"))


def within_reach(x: str, y: str) -> Column:
    """Whether two members (structs of ``MEASURES``) can be similar by their sizes or by their weights."""
    return F.expr(" or ".join(f"({x}.{reach} >= {y}.{size} and {y}.{reach} >= {x}.{size})" for size, reach in (("size", "reach"), ("weight", "weight_reach"))))


def in_question(live: DataFrame, threshold: float) -> DataFrame:
    """The rows of ``live`` (``MEMBER`` and label) that reach a home of their bucket and may find one of another class there."""
    home = at_home()
    sides = (("size", "reach"), ("weight", "weight_reach"))
    ends = [f(F.when(F.col(reach) >= F.col(size), F.col(size))).alias(f"{name}_{size}") for size, reach in sides for name, f in (("lo", F.min), ("hi", F.max))]
    of_home = [f(F.when(home, F.col("label"))).alias(f"{name}_home") for name, f in (("lo", F.min), ("hi", F.max))]
    of_all = [F.min("label").alias("lo"), F.max("label").alias("hi")]
    of_bucket = live.groupBy("bucket").agg(*ends, *of_home, *of_all).filter("lo < hi and lo_home is not null")
    reached = F.lit(False)
    for size, reach in sides:
        fits = (F.col(reach) >= F.col(f"lo_{size}")) & (F.col(size) * (threshold - 1e-6) <= F.col(f"hi_{size}"))
        reached = reached | F.coalesce(fits, F.lit(False))
    others = (F.col("label") != F.col("lo_home")) | (F.col("label") != F.col("hi_home")) | home
    return live.join(of_bucket, "bucket").filter(reached & others).select(live.columns)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    threshold: float = 0.8,
    shingle_words: int = 5,
    bands: int = 14,
    rows: int = 4,
    carry: bool = False,
) -> DataFrame:
    """(row, doc_id, id_key, text_key, class_id, is_first) per document; ``class_id`` is the smallest id of its class."""
    keys = {"id_key": F.coalesce("doc_id", F.lit(LOWEST)), "text_key": F.xxhash64(F.coalesce("text", F.lit("")))}
    keyed = carried(docs, id_col, text_col, carry).withColumns(keys)
    table, n_docs = document_frequencies(keyed, shingle_words)
    weights = shingle_weights(table, n_docs)
    signed_docs = stored(signatures(keyed, weights, shingle_words, bands, rows), "signatures")
    with_words = signed_docs.filter("node is not null")
    least = F.min(F.struct("id_key", "text_key"))
    nodes = with_words.groupBy("node").agg(least.alias("least"), F.min_by("bands", F.struct("id_key", "text_key")).alias("bands"))
    nodes = stored(nodes.select("node", "least.id_key", "least.text_key", "bands"), "nodes")

    members = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(members.join(sizes, "bucket").select("bucket", "node", (F.col("n") > LARGE).alias("large")), "members")
    by_node = members.groupBy("node").agg(F.max("large").alias("large"))
    # Token sets of all nodes that share a bucket are made once, not in every round.
    wanted = nodes.select("node", "id_key", "text_key").join(by_node, "node")
    texts = keyed.select("id_key", "text_key", "text").join(wanted, ["id_key", "text_key"]).select("node", "large", "text")
    sets = stored(token_sets(texts, shingle_words).dropDuplicates(["node"]), "token-sets")
    split = prefixes(sets.filter("large"), table, weights, threshold)
    shared = split.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    # Whoever is in a small bucket is at home there and reaches all.
    small = members.filter("not large").selectExpr("bucket", "node", "0L common", "0D size", "0D weight", "1D reach", "1D weight_reach")
    members = stored(small.unionByName(split.join(shared, "bucket")), "members")
    labels = sets.select("node", F.col("node").alias("label"))

    def unsettled(members: DataFrame) -> DataFrame:
        """Rows of ``members`` (``MEMBER`` and label) in buckets that may still link two classes, with the number n of a bucket's and its hub."""
        live = in_question(in_question(members, threshold), threshold)
        most_common = F.min(F.when(at_home(), F.struct((-F.col("common")).alias("order"), "node", *MEASURES)))
        of_bucket = live.groupBy("bucket").agg(F.count("*").alias("n"), most_common.alias("hub"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        return stored(live.join(of_bucket.filter("lo < hi").drop("lo", "hi"), "bucket"), "live")

    def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
        ends = [labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}")) for x in ("a", "b")]
        between = links.join(ends[0], "a").join(ends[1], "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
        return merge_labels(labels, between.filter("a <> b"))

    def linked(pairs: DataFrame) -> DataFrame:
        """The similar ones of ``pairs`` of members (x, y) within reach of each other, each looked at once."""
        ends = [f(F.col("x.node"), F.col("y.node")).alias(name) for f, name in ((F.least, "a"), (F.greatest, "b"))]
        return verified(stored(pairs.filter(within_reach("x", "y")).select(*ends).distinct(), "pairs"), sets, weights, threshold)

    me = F.struct("node", "label", *MEASURES)
    live = unsettled(members.withColumn("label", F.col("node")))
    rest = live.filter("node <> hub.node")
    labels = merged(labels, stored(linked(rest.select(me.alias("x"), F.col("hub").alias("y"))), "links"))
    live = unsettled(rest.select(members.columns).join(labels, "node"))
    in_blocks = similar_in_blocks(live.filter(F.col("n") > LARGE).withColumn("home", at_home()), sets, weights, threshold)
    x, y = (live.filter(F.col("n") <= LARGE).select("bucket", me.alias(end)) for end in ("x", "y"))
    in_pairs = linked(x.join(y, "bucket").filter("x.node < y.node and x.label <> y.label"))
    labels = merged(labels, stored(in_blocks.unionByName(in_pairs), "links"))

    placed = nodes.select("node", "id_key", "text_key").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    leaders = placed.groupBy("label").agg(least.alias("leader"))
    classes = placed.select("node", "label").join(leaders, "label").select("node", "leader")
    of_docs = signed_docs.select("id_key", "text_key", "node").distinct().join(classes, "node", "left").select("id_key", "text_key", "leader")
    me = F.struct("id_key", "text_key")
    done = keyed.join(of_docs, ["id_key", "text_key"]).withColumn("leader", F.coalesce("leader", me))
    return done.select("row", "doc_id", "id_key", "text_key", F.nullif(F.col("leader.id_key"), F.lit(LOWEST)).alias("class_id"), (F.col("leader") == me).alias("is_first"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One row of each class of ``docs``: that of the smallest id; of its repeated rows, one."""
    done = near_duplicates(docs, carry=True, **options).filter("is_first").dropDuplicates(["id_key", "text_key"])
    return done.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
