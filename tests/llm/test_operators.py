import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kithscope.llm import op3_disclosure as disclosure
from kithscope.llm import components, op7_near_duplicates, op8_line_dedup
from kithscope.llm.arrays import BLANK, HASH, find_lines, find_words, slices
from kithscope.llm.components import merge_labels
from kithscope.llm.op1_sharding import shard_documents, shard_rows
from kithscope.llm.op2_packing import ByteTokenizer, Packer, pack
from kithscope.llm.op4_url_trust import judge_urls
from kithscope.llm.op5_toxicity_chain import toxicity_chain
from kithscope.llm.op6_decontaminate import decontaminate, find_benchmark
from kithscope.llm.op7_near_duplicates import document_frequencies, keep_first, near_duplicates, shingle_weights, shingles, weighted_jaccard
from kithscope.llm.op8_line_dedup import PerfectHash, dedup_lines, drop_repeated_lines
from kithscope.llm.op9_quality_votes import fit_votes, keep_good, quality_votes
from kithscope.llm.op10_substring_dedup import dedup_substrings
from tests.conftest import MEDIUM
from tests.llm.fixtures import ALNUM, WORD, frame, linked, lower, prose, sample, sha

tokens = pytest.importorskip("public_tokenizers")
TOKENS = tokens.path("byte_bpe_50k.json")
RANKS = {"ranks_path": tokens.path("byte_bpe_50k.tiktoken"), "pattern": tokens.PATTERN}


def by_row(rows, key="doc_id"):
    return collections.Counter((r[key], *(v for k, v in r.asDict().items() if k != key)) for r in rows)


def test_words_lines_and_hashes_follow_plain_python():
    texts = [t for _, t, *_ in sample()]
    column = pa.array(texts)
    for chunk in (16, 1 << 20):
        words, lines, prints = [], [], []
        for _, _, part in slices(column, chunk):
            raw = part.buf.tobytes()
            for found, out in ((find_words(part, BLANK), words), (find_lines(part), lines)):
                for i in range(len(part.offs) - 1):
                    at = slice(found.first[i], found.first[i + 1])
                    out.append([raw[a:b].decode() for a, b in zip(found.start[at], found.end[at], strict=True)])
            w = find_words(part, BLANK)
            prints += HASH.of_bytes(part.buf, w.start, w.end).tolist()
        assert words == [WORD.findall(t or "") for t in texts]
        assert lines == [(t or "").split("\n") for t in texts]
        seen = dict(zip((w for d in words for w in d), prints, strict=True))
        assert prints == [seen[w] for d in words for w in d] and len(set(seen.values())) == len(seen)


def test_sharding_splits_only_what_is_too_large(spark):
    docs = frame(spark)
    rows = shard_documents(docs, max_bytes=2000).collect()
    assert len(rows) == docs.count()
    sizes = collections.Counter()
    for r in rows:
        sizes[r["shard"]] += r["n_bytes"]
    shards = {r["shard"]: r for r in rows}
    for name, r in shards.items():
        assert r["shard_bytes"] == sizes[name] and len(name) == r["depth"]
        assert sizes[name] <= 2000 or r["shard_rows"] == 1
        parent = sum(n for s, n in sizes.items() if s.startswith(name[:-1]))
        assert not name or parent > 2000
    assert not any(a != b and b.startswith(a) for a in shards for b in shards)
    assert shard_documents(frame(spark, []), max_bytes=10).count() == 0


def test_a_hot_key_and_repeated_rows_are_split_too(spark):
    df = spark.createDataFrame([("hot", "same")] * 300 + [("hot", f"t{i}") for i in range(300)] + [("cold", "x")], "source string, text string")
    rows = shard_rows(df, [F.col("source")], F.lit(10), [F.col("text")], 200).collect()
    assert len(rows) == 601 and max(r["shard_bytes"] for r in rows) <= 200
    assert max(r["depth"] for r in rows) > 120


@pytest.mark.parametrize("options", [{}, RANKS])
def test_packing_is_a_gapless_round_trip(spark, options):
    docs = frame(spark)
    rows = pack(docs, TOKENS, capacity=64, **options).collect()
    plain = ByteTokenizer(TOKENS)
    expected = collections.Counter()
    for i, t, *_ in [tuple(r) for r in docs.collect()]:
        expected[i, plain.ids(t or "") + bytes(4)] += 1
    whole = collections.Counter()
    pieces = collections.defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] <= 256
        pieces[r["doc_id"]].append(r)
    for i, own in pieces.items():
        copies = sum(r["piece"] == 0 for r in own)
        for k in range(copies):
            parts = sorted((r for r in own), key=lambda r: (r["piece"], r["sequence_id"], r["offset"]))[k::copies]
            assert [p["start"] for p in parts] == [0, *np.cumsum([p["length"] for p in parts])[:-1]]
            assert all(p["length"] == 64 for p in parts[1:])
            whole[i, b"".join(p["ids"] for p in parts)] += 1
    assert whole == expected
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert pack(frame(spark, []), TOKENS).count() == 0


def test_the_fast_encoder_gives_the_same_ids():
    plain, fast = ByteTokenizer(TOKENS), ByteTokenizer(TOKENS, **RANKS)
    odd = ["", " ", "  a b  c\n d", "it's I'LL", "<|endoftext|>", "½ ² 12a", "\x85\xa0 x", "中 文", *(f"x{chr(i)} {chr(i)}y1" for i in range(256))]
    assert [fast.ids(t) for t in odd] == [plain.ids(t) for t in odd]


def test_ids_are_those_of_the_plain_tokenizer_file():
    from tokenizers import Tokenizer

    file = Tokenizer.from_file(TOKENS)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>é", "中 <|endoftext|> 文", "<|endoftext", "a b <|ENDOFTEXT|>"]
    expected = [file.encode(t, add_special_tokens=False).ids for t in texts]
    assert expected[0] == [64, 220, 50256, 275]
    for options in ({}, RANKS):
        encoder = ByteTokenizer(TOKENS, **options)
        assert [np.frombuffer(encoder.ids(t), dtype="<u4").tolist() for t in texts] == expected
        assert (encoder.fast is not None) == bool(options)


@pytest.mark.parametrize("tasks", [1, 8, 64])
def test_the_number_of_sequences_hangs_little_on_the_tasks(spark, tasks):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").repartition(tasks)
    lengths = collections.Counter()
    for r in pack(docs, TOKENS, **RANKS).select("sequence_id", "length").collect():
        lengths[r["sequence_id"]] += r["length"]
    assert max(lengths.values()) <= 2048
    assert len(lengths) <= -(-sum(lengths.values()) // 2048) + 2


def test_pieces_go_where_a_plain_best_fit_puts_them():
    rng = np.random.default_rng(4)
    packer, room = Packer(100, 50, 0), {}
    for n in rng.integers(1, 101, 2000).tolist():
        fitting = sorted((free, b) for b, free in room.items() if free >= n)
        bin_, offset = packer.place(n)
        if fitting:
            assert room[bin_] == fitting[0][0] == 100 - offset
        else:
            assert bin_ not in room and offset == 0
        room[bin_] = room.get(bin_, 100) - n
        if not room[bin_]:
            del room[bin_]
        elif len(room) > 50:
            fullest = min(room.values())
            gone = [b for b in packer.closed if room.get(b) == fullest]
            assert len(gone) == 1
            del room[gone[0]]
        packer.closed.clear()


def test_the_packer_takes_the_tightest_bin_and_closes_the_fullest():
    packer = Packer(10, 2, 0)
    assert [packer.place(n) for n in (6, 7, 3)] == [(0, 0), (1, 0), (1, 7)]
    assert packer.place(5) == (2, 0)  # open: bin 0 with 4 left, bin 2 with 5
    assert packer.place(9) == (3, 0)  # third open bin: the fullest, itself, closes
    assert packer.place(4) == (0, 6) and packer.place(1) == (2, 5)


LUHN = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
ENTITY = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    import re

    def holds(kind, value):
        digits = [int(c) for c in value if c.isdigit()]
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and sum(LUHN[d] if i % 2 else d for i, d in enumerate(reversed(digits))) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in ENTITY.items() for m in re.finditer(p, text or "") if holds(k, m.group()))


def test_entities_are_those_of_the_plain_patterns(spark):
    odd = [
        "a@b.c_d@e.f x", "%a@b.c%x@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.255", "4111 1111 1111 1111 4111-1111-1111-1111",
        "+49 (0)30 123456-78 +1", "++49 30 1234567", "a@b. a..@b.c.d- @@a@b.cc@d.e", "1" * 50 + " 4242424242424242", "😀 x@y.zz +1234567890 ß 12.12.12.12",
        "a@b.co,c@d.eu;" * 400, "+1 (2) 3 . - 4 5 6 7 8 9 (", "7" * 30_000, "a" * 30_000,
    ]
    rows = [*sample(), *((100 + i, t, None, None, None, None, None) for i, t in enumerate(odd))]
    found = disclosure.find_disclosures(frame(spark, rows)).select("doc_id", disclosure.written(disclosure.KINDS).alias("spans"))
    assert by_row(found.collect()) == collections.Counter((r[0], base_spans(r[1])) for r in rows)
    assert disclosure.find_disclosures(frame(spark, [])).count() == 0


def test_terms_that_give_an_entity_away_go(spark):
    texts = [f"the zanzibar desk writes to boss@corp.example.com about the item {prose(i, 12)}" for i in range(5)]
    texts += [f"the item is on the desk of {prose(100 + i, 12)}" for i in range(60)]
    found = disclosure.find_disclosures(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    clean = {r["doc_id"]: r["text"] for r in disclosure.sanitised(found).collect()}
    assert all("zanzibar" not in clean[i] and "<EMAIL>" in clean[i] and "the" in clean[i] for i in range(5))
    assert all(clean[i] == texts[i] for i in range(5, 65))


def test_terms_are_counted_and_flagged_over_whole_documents(spark):
    import itertools
    import re

    far = " and so on the the " * 10
    texts = [f"Agent Zanzibar{'' if i else ' zanzibar'} {prose(700 + i, 8)} {far} boss@corp.example.com and corp" for i in range(4)]
    texts += ["the zanzibar stands alone and the mail is gone", "single sally writes to one@only.example.com", None, "the corp"]
    texts += [f"the and so on {prose(800 + i, 15)}" for i in range(60)]
    docs = [(i, t) for i, t in enumerate(texts)]
    terms, entities = [], []
    for text in texts:
        mails = [m.span() for m in re.finditer(ENTITY["email"], text or "")]
        rest = "".join(" " if any(a <= i < b for a, b in mails) else c for i, c in enumerate(text or ""))
        terms.append([(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[^\W_]{3,}", rest)])
        entities.append({text[a:b].lower() for a, b in mails})
    n, df, dfe, co = len(texts), collections.Counter(), collections.Counter(), collections.Counter()
    for t, e in zip(terms, entities, strict=True):
        df.update({x for x, *_ in t})
        dfe.update(e)
        co.update(itertools.product(e, {x for x, *_ in t}))
    action = {}
    for (e, t), c in co.items():
        share = math.log(c * n / (dfe[e] * df[t])) / math.log(n / dfe[e])
        if c >= 2 and share >= 0.75:
            action[t] = max(action.get(t, ""), "remove" if share >= 0.9 else "generalise")
    found = disclosure.find_disclosures(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = {r["doc_id"]: [tuple(s) for s in r["terms"]] for r in found}
    assert got == {i: [(a, b, action[x]) for x, a, b in t if x in action] for i, t in enumerate(terms)}
    assert {"zanzibar", "agent"} <= set(action) and "sally" not in action
    assert [s[:2] for s in got[0]][:3] == [(0, 5), (6, 14), (15, 23)] and got[4] == [(4, 12, action["zanzibar"])]


def test_distrust_flows_back_along_links_and_trust_forward(spark):
    link = lambda *hosts: "".join(f"<a href='https://{h}/x'>" for h in hosts)
    pages = [
        (1, "http://good.com/a", link("friend.org", "GOOD.com")),
        (2, "http://friend.org/", link("friend2.org")),
        (3, "http://farm.org/", link("spam.net", "spam.net", "friend.org")),
        (4, "http://spam.net/es/1", None),
        (5, "http://Sub.Spam.net/es/1?x", ""),
        (6, None, None),
        (7, "no scheme", link("spam.net")),
        (8, "http://friend2.org", "<a href='/local'>"),
        (8, "http://friend2.org", "<a href='/local'>"),
        (9, "http://spam.net/en/1", None),
        (10, "http://spam.net/fr/1", None),
    ]
    rules = [("allow", "com", "/"), ("block", "net", "/es/"), ("block", "net", "/fr/"), ("allow", "sub.spam.net", "/es/")]
    rows = judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), rules).collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}
    assert len(rows) == 11
    assert got[1] == ("good.com", "/a", "com/", "allow") and got[2] == ("friend.org", "/", None, "allow")
    assert got[3][3] == "block" and got[4] == ("spam.net", "/es/1", "net/es/", "block")
    assert got[5] == ("sub.spam.net", "/es/1", "sub.spam.net/es/", "allow")
    assert got[6] == ("", "", None, "allow") == got[7] and got[8] == ("friend2.org", "", None, "allow")
    trust = {r["host"]: r for r in rows}
    assert trust["friend2.org"]["trust"] == pytest.approx(0.5 * 0.15 * 0.85**2) and trust["farm.org"]["trust"] == 0


def test_distrust_reaches_the_far_end_of_a_chain_and_ranks_settle(spark):
    link = lambda *hosts: "".join(f"<a href='https://{h}/x'>" for h in hosts)
    # c0 -> c1 -> ... -> c13 -> spam.net, and a ring x <-> y that both seeds feed, where mass goes round for long.
    out = {f"c{i}.org": [f"c{i + 1}.org"] if i < 13 else ["spam.net"] for i in range(14)}
    out |= {"good.com": ["x.org"], "x.org": ["y.org"], "y.org": ["x.org", "x.org", "x.org", "spam.net"], "spam.net": []}
    pages = [(k, f"http://{h}/es/1", link(*to)) for k, (h, to) in enumerate(out.items())]
    rows = judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), [("allow", "com", "/"), ("block", "net", "/es/")]).collect()
    got = {r["host"]: r for r in rows}
    assert all(got[f"c{i}.org"]["verdict"] == "block" and got[f"c{i}.org"]["trust"] == 0 for i in range(14))

    def settled(links, seed):
        rank = dict.fromkeys(out, 0.0)
        for _ in range(1000):
            new = {h: 0.15 * (h == seed) for h in out}
            for src, to in links.items():
                for dst in to:
                    new[dst] += 0.85 * rank[src] / len(to)
            rank = new
        return rank

    back = {h: [src for src, to in out.items() for dst in to if dst == h] for h in out}
    for kind, expected in (("trust", settled(out, "good.com")), ("distrust", settled(back, "spam.net"))):
        assert {h: r[kind] for h, r in got.items()} == pytest.approx(expected, rel=1e-7, abs=0)


def test_the_chain_learns_on_held_out_documents(spark):
    def text(i):
        return prose(1000 + i, 40) + (" vilest" if i % 3 == 0 else "") + (" junkyard junkyard" if i % 5 == 0 else "")

    docs = spark.createDataFrame([(i, text(i)) for i in range(600)] + [(None, None), (1, text(1))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0), int(i % 3 == 0)) for i in range(300)] + [(5, None, 1), (9999, 1, 1)], "doc_id long, junk int, toxic int")
    rows = toxicity_chain(docs, labels, ["junk", "toxic"]).collect()
    assert len(rows) == 602
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["p_toxic"] > 0.5) == (r["doc_id"] % 3 == 0) and (r["p_junk"] > 0.5) == (r["doc_id"] % 5 == 0)
    assert {r["p_toxic"] for r in toxicity_chain(docs, labels.limit(0), ["junk", "toxic"]).collect()} == {None}


def test_benchmark_windows_are_all_found(spark):
    docs = sample()
    shared = prose(1, 30)
    items = [(1, shared), (2, "Tie TIE"), (3, None), (4, "..."), (5, " ".join(shared.split(" ")[5:18])), (5, "changed")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t or ""))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(i)

    def expected(row):
        w = ALNUM.findall(lower(row[1] or ""))
        hit, own = [0] * len(w), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if found := windows.get(tuple(w[k : k + size])):
                    hit[k : k + size] = [1] * size
                    own |= found
        return row[0], len(w), sum(hit), ",".join(sorted(map(str, own)))

    for most in (2_000_000, 20):
        found = find_benchmark(frame(spark), bench, max_block_words=most)
        got = found.select("doc_id", "n_words", "n_hit", F.array_join("items", ",").alias("items"))
        assert by_row(got.collect()) == collections.Counter(map(expected, docs))
    clean = decontaminate(frame(spark), bench)
    assert clean.columns == frame(spark).columns
    assert find_benchmark(clean, bench).filter("n_hit >= 10").count() == 0
    assert find_benchmark(frame(spark, []), bench).count() == 0 and find_benchmark(frame(spark), bench.limit(0)).filter("n_hit > 0").count() == 0


def test_near_duplicate_classes_are_those_of_all_pairs(spark):
    rows = [*sample(), *((200 + i, t, None, None, None, None, None) for i, t in linked())]
    docs = frame(spark, rows)
    got = near_duplicates(docs).select("doc_id", "class_id").collect()
    weights = shingle_weights(*document_frequencies(docs.select("text"), 5))
    sets = []
    for r in rows:
        ((_, _, part),) = slices(pa.array([r[1]], pa.string()))
        sets.append(shingles(part, 5)[1:3])
    order = [-math.inf if r[0] is None else r[0] for r in rows]
    label = list(order)
    changed = True
    near = [(a, b) for a in range(len(rows)) for b in range(a) if weighted_jaccard(weights, sets[a], sets[b]) >= 0.8]
    near += [(a, b) for a in range(len(rows)) for b in range(a) if rows[a][:2] == rows[b][:2]]
    while changed:
        changed = False
        for a, b in near:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    assert by_row(got) == collections.Counter((r[0], None if x == -math.inf else x) for r, x in zip(rows, label, strict=True))
    kept = keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len({(x, r[1] if x == r[0] and not (r[1] or "").strip() else 0) for r, x in zip(rows, label, strict=True)})
    assert near_duplicates(frame(spark, [])).count() == 0


def test_a_hot_group_of_copies_and_edits_links_as_by_plain_shingles(spark):
    base = prose(30, 104).split(" ")
    edits = [" ".join("changed" + str(k) if j == 10 * k + 5 else w for j, w in enumerate(base)) for k in range(10)]
    # 300 copies of the base and its edits (95 of 105 shingles are the same), edits without their base, and many other texts.
    other = prose(31, 104).split(" ")
    pairs = [" ".join(f"new{k}" if j == 20 * k + 30 else w for j, w in enumerate(other)) for k in range(3)]
    texts = [" ".join(base)] * 300 + edits * 30 + pairs + [prose(1000 + i, 60) for i in range(300)]
    seen = sorted(set(texts))
    plain = {t: {tuple(t.split(" ")[k : k + 5]) for k in range(len(t.split(" ")) - 4)} for t in seen}
    label = {t: t for t in seen}
    for a in seen:
        for b in seen:
            if label[a] != label[b] and len(plain[a] & plain[b]) >= 0.8 * len(plain[a] | plain[b]):
                label = {t: label[a] if x == label[b] else x for t, x in label.items()}
    least = {}
    for i, t in enumerate(texts):
        least.setdefault(label[t], i)
    got = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "class_id").collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: least[label[t]] for i, t in enumerate(texts)}
    assert len(least) == 302
    once = document_frequencies(spark.createDataFrame([(t,) for t in seen], "text string"), 5)
    many = document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5), 5)
    assert once[1] == many[1] == len(seen) and (once[0] == many[0]).all()


@pytest.mark.parametrize("cut", [0, 12])
def test_a_large_group_around_the_threshold_links_as_by_all_pairs(spark, monkeypatch, cut):
    """Near copies whose similarities to each other lie on both sides of 0.8, in several blocks, of one length or of many."""
    monkeypatch.setattr(op7_near_duplicates, "BLOCK", 60)
    rng = random.Random(9)
    base = prose(40, 60).split(" ")
    texts = []
    for i in range(240):
        words = list(base)
        for k in range(rng.randint(1, 2)):
            words[rng.randrange(60)] = f"edit{i}x{k}"
        texts.append(" ".join(words[: 60 - rng.randint(0, cut)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    weights = shingle_weights(*document_frequencies(docs.select("text"), 5))
    sets = []
    for t in texts:
        ((_, _, part),) = slices(pa.array([t]))
        sets.append(shingles(part, 5)[1])
    names, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    common = np.flatnonzero(count > 1)
    column = np.full(len(names), -1)
    column[common] = np.arange(len(common))
    x = np.zeros((len(sets), len(common)))
    here = column[place] >= 0
    x[owner[here], column[place[here]]] = 1
    near = np.zeros((len(sets), len(sets)), dtype=bool)
    for w in (np.ones(len(names)), weights[(names >> np.uint64(48)).astype(int)].astype(float)):
        both, whole = (x * w[common]) @ x.T, np.bincount(owner, weights=w[place], minlength=len(sets))
        near |= both >= 0.8 * (whole[:, None] + whole[None, :] - both)
    np.fill_diagonal(near, True)
    assert 0.02 < near.mean() < 0.8
    label = np.arange(len(sets))
    while True:
        least = np.where(near, label[None, :], len(sets)).min(axis=1)
        if (least == label).all():
            break
        label = np.minimum(label, least)
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(docs).select("doc_id", "class_id").collect()}
    assert [got[i] for i in range(len(texts))] == label.tolist()


def test_linked_labels_become_one_also_along_paths(spark):
    links = [(i, i + 1) for i in range(0, 99)] + [(150, n) for n in range(100, 150)] + [(199, 198)]
    labels = spark.createDataFrame([(n, n) for n in range(200)], "node long, label long")
    got = {r["node"]: r["label"] for r in merge_labels(labels, spark.createDataFrame(links, "a long, b long")).collect()}
    parts = collections.defaultdict(set)
    for node, label in got.items():
        parts[label].add(node)
    assert sorted(map(min, parts.values())) == [0, 100, *range(151, 198), 198] and len(got) == 200
    assert set(range(100)) in parts.values() and set(range(100, 151)) in parts.values() and all(k in v for k, v in parts.items())


def recorded(monkeypatch, *modules) -> list[str]:
    """Names of the tables that ``modules`` write from now on."""
    written = []
    for module in modules:
        monkeypatch.setattr(module, "stored", lambda df, label, f=module.stored: written.append(label) or f(df, label))
    return written


def test_steps_of_near_duplicates_do_not_hang_on_the_data(spark, monkeypatch):
    """Chains of texts, each similar to the next only: of 56 shingles one edit changes 5 (51 of 61 are shared), two change 10 (46 of 66)."""
    texts = []
    for k in range(20):
        words = prose(500 + k, 60).split(" ")
        for i in range(10):
            words = [f"edit{k}x{i}" if j == 6 * i + 3 else w for j, w in enumerate(words)]
            texts.append(" ".join(words))
    written = recorded(monkeypatch, op7_near_duplicates, components)
    got = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "class_id").collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: i - i % 10 for i in range(200)}
    assert len(written) <= 17


def test_few_links_take_one_step(spark, monkeypatch):
    links = spark.createDataFrame([(i, i + 1) for i in range(400) if i % 50 != 49] + [(7, 3), (3, 3)], "a long, b long")
    labels = spark.createDataFrame([(n, n) for n in range(500)], "node long, label long")
    for few, most in ((components.FEW, 3), (10, 100), (0, 100)):
        written = recorded(monkeypatch, components)
        parts = collections.defaultdict(set)
        for r in merge_labels(labels, links, few=few).collect():
            parts[r["label"]].add(r["node"])
        assert sorted(map(sorted, parts.values())) == [list(range(i, i + 50)) for i in range(0, 400, 50)] + [[n] for n in range(400, 500)]
        assert len(written) <= most
        monkeypatch.undo()


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.Generator(np.random.PCG64(1)).integers(0, 1 << 63, 20_000, dtype=np.uint64))
    table = PerfectHash.build(keys)
    assert sorted(table.find(keys).tolist()) == list(range(len(keys)))
    assert PerfectHash.build(keys[:0]).find(keys[:3]).tolist() == [-1, -1, -1]


def test_repeated_lines_stay_once(spark, monkeypatch):
    rows = sample()
    held = collections.defaultdict(list)
    blank = " \t\n\x0b\x0c\r"
    for r in rows:
        for key in {lower(x.strip(blank)) for x in (r[1] or "").split("\n")}:
            held[key].append(-math.inf if r[0] is None else r[0])
    keeper = {k: max(v) for k, v in held.items() if len(k) >= 20 and len(v) >= 3}

    def expected(r):
        lines = (r[1] or "").split("\n")
        stay = [x for x in lines if keeper.get(lower(x.strip(blank)), r[0]) == r[0]]
        return r[0], len(lines), len(lines) - len(stay), "\n".join(stay)

    docs = frame(spark)
    got = dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    assert by_row(got) == collections.Counter(map(expected, rows))
    cut = drop_repeated_lines(docs)
    assert cut.columns == docs.columns and cut.filter("text is null").count() == 1
    assert dedup_lines(frame(spark, [])).count() == 0
    # Many shards, some of them replicated.
    monkeypatch.setattr(op8_line_dedup, "SHARD_LINES", 5)
    monkeypatch.setattr(op8_line_dedup, "REPLICA_PROBES", 4)
    got = dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    assert by_row(got) == collections.Counter(map(expected, rows))


def test_votes_find_the_rule_that_is_wrong():
    # Rule b complains of junk that c also sees; a complains of nothing that any other rule sees, and rarely.
    votes = np.array([[1, 1, 1], [1, -1, -1], [1, -1, 1], [0, 0, 0]])
    model = fit_votes(votes, np.array([900, 60, 5, 10]), ["a", "b", "c"])
    assert set(model.prior) == {"a", "b", "c"} and model.prior["b"] < 0
    assert model.weights["b"]["b"][1] > 0 > model.weights["b"]["b"][0]
    assert fit_votes(np.zeros((0, 3), dtype=np.int8), np.zeros(0, dtype=np.int64), ["a", "b", "c"]).prior["a"] == 0


def test_base_counts_and_verdicts(spark):
    rows = [*sample(), *((300 + i, prose(400 + i, 90) + ".", None, None, None, None, None) for i in range(60))]
    rows += [(400 + i, " ".join(w.upper() + "!!" for w in prose(500 + i, 90).split(" ")), None, None, None, None, None) for i in range(8)]
    rows += [(500, "a b c " * 40 + "\n\nx y\nx y\n \n ", None, None, None, None, None)]

    def expected(r):
        text = r[1] or ""
        w = WORD.findall(text)
        triples = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        again = {k + j for k in range(len(w) - 2) for j in range(3) if triples[tuple(w[k : k + 3])] > 1}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        return r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed

    docs = frame(spark, rows)
    got = quality_votes(docs)
    base = got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert by_row(base) == collections.Counter(map(expected, rows))
    kept = {r["doc_id"] for r in got.filter("kept").collect()}
    assert kept >= set(range(300, 360)) and not kept & {*range(400, 408), 500, 0, 1, 2}
    out = keep_good(docs)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == kept
    assert quality_votes(frame(spark, [])).count() == 0


@pytest.mark.parametrize("options", [{}, {"length": 40, "first": 10}, {"length": 8, "first": 4}])
def test_substrings_are_those_of_all_windows(spark, options):
    size = options.get("length", 20)
    rows = sample()
    first: dict = {}
    order = [-math.inf if r[0] is None else r[0] for r in rows]
    for i, r in sorted(zip(order, rows, strict=True), key=lambda p: p[0]):
        w = WORD.findall(r[1] or "")
        for k in range(len(w) - size + 1):
            first.setdefault(tuple(w[k : k + size]), (i, k))

    def expected(i, r):
        w = WORD.findall(r[1] or "")
        gone = {k + j for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] < (i, k) for j in range(size)}
        return r[0], len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)

    got = dedup_substrings(frame(spark), **options).collect()
    assert by_row(got) == collections.Counter(expected(i, r) for i, r in zip(order, rows, strict=True))
    assert dedup_substrings(frame(spark, []), **options).count() == 0


def test_crc_of_ids(spark):
    rows = pack(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), TOKENS).select(F.crc32("ids").alias("c"), "ids").collect()
    assert rows[0]["c"] == zlib.crc32(rows[0]["ids"]) and sha("") == sha("")
