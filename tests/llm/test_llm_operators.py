"""Every operator against brute force on small fixtures: nulls, empty and long texts, ties, repeats, extra columns."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import (ann, bpe, exact_dedup, html_text, jaccard, language, line_dedup, mixing, queries, sharding,
                           substring_dedup)
from riskweave.llm.components import components

SCHEMA = "doc_id bigint, text string, lang string, source string, key string, cls string, size string, _key string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus():
    rng = random.Random(4)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage = prose(30)
    texts = [prose(60) for _ in range(12)]
    for base in texts[:4]:
        for edits in (1, 2, 3, 5, 9):
            w = base.split()
            for _ in range(edits):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join(w))
    texts += [prose(15) + " " + passage + " " + prose(8) for _ in range(5)] + [texts[0], texts[0], "A b", "a B", "x"]
    texts += [None, "", "   \n\t ", "same same " * 40, "same same " * 35, prose(6000), passage + "\n" + passage,
              "é ü ñ 漢字 \U0001f600", "JUNK!! " * 25]
    return [(i, t, "en", "s%d" % (i % 3)) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", None, "z") for r in rows], SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# -- exact copies --------------------------------------------------------------------------------


def weak(text):
    return F.substring(F.unhex(F.md5(text)), 1, 1)


@pytest.mark.parametrize("hashed", [exact_dedup.content_hash, weak])
def test_exact_dedup_compares_bytes(docs, rows, hashed):
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256)
           for r in exact_dedup.exact_dedup(docs, hashed=hashed).collect()}
    assert got == {i: (max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest())
                   for t, g in groups.items() for i in g}


def test_exact_dedup_nulls_repeats_and_plan(spark, none):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (3, "b"), (3, "b"), (None, "b"), (1, None), (2, "")],
                               "doc_id bigint, text string")
    got = sorted(map(str, (tuple(r)[:4] for r in exact_dedup.exact_dedup(df).collect())))
    assert got == sorted(map(str, [(None, None, 2, True)] * 2 + [(3, 3, 3, True)] * 2 + [
        (None, 3, 3, False), (1, 2, 2, False), (2, 2, 2, True)]))
    assert exact_dedup.exact_dedup(none).count() == 0
    plan = exact_dedup.exact_dedup(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns and kept.count() == 5


# -- near copies ---------------------------------------------------------------------------------


def near_by_hand(rows, k, p, q=100):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t, *_ in rows:
        w = words_of((t or "").translate(fold))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    label = {i: i for i in sets}
    links = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and sets[b] and q * len(sets[a] & sets[b]) >= p * len(sets[a] | sets[b])]
    for _ in range(len(sets)):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return {i: (len(s), label[i]) for i, s in sets.items()}


@pytest.mark.parametrize("k,p", [(3, 90), (5, 80), (3, 70), (2, 50)])
def test_jaccard_components(spark, docs, rows, k, p):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark, docs, k=k, p=p).collect()}
    assert got == near_by_hand(rows, k, p)


def test_jaccard_large_bucket_of_unlinked_members(spark):
    """Copies that share segments but mostly do not link are compared by blocks of sketches."""
    rng = random.Random(1)
    base = ["w%d" % i for i in range(150)]
    rows = []
    for i in range(130):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 6])):
            w[rng.randrange(150)] = "e%d" % rng.randrange(10**6)
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark, df).collect()}
    assert got == near_by_hand(rows, 3, 90)


def links_by_hand(rows, k, p, q=100):
    """Per row the number of other distinct sets that its set links with."""
    sets = {}
    for i, t, *_ in rows:
        w = words_of((t or "").lower())
        sets[i] = frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    kinds = set(sets.values())
    return {i: sum(1 for o in kinds if s and o and s != o and q * len(s & o) >= p * len(s | o)) for i, s in sets.items()}


@pytest.mark.parametrize("block,shingles", [(1024, 1 << 20), (5, 1 << 20), (1024, 500)])
def test_jaccard_counts_every_link(spark, monkeypatch, block, shingles):
    """Copies most of whose pairs link, a chain where only neighbours do, a pair, equal sets and loners."""
    monkeypatch.setattr(jaccard, "LINK_BLOCK", block)
    monkeypatch.setattr(jaccard, "LINK_SHINGLES", shingles)
    rng, texts = random.Random(4), []
    base = ["w%d" % i for i in range(80)]
    for _ in range(24):  # copies of one component with up to four words changed: not all pairs link
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            w[rng.randrange(80)] = "e%d" % rng.randrange(10**6)
        texts.append(" ".join(w))
    texts += [" ".join("c%d" % j for j in range(5 * i, 5 * i + 60)) for i in range(12)]  # a chain
    texts += ["p " * 3 + " ".join("p%d" % j for j in range(n)) for n in (40, 41)]  # a pair
    texts += [texts[3], texts[3] + " tail", texts[30], None, "", "alone in the world", "two words"]
    rows = list(enumerate(texts))
    got = {r.doc_id: r.n_links for r in jaccard.near_duplicates(
        spark, spark.createDataFrame(rows, "doc_id bigint, text string"), k=2, p=80).collect()}
    want = links_by_hand(rows, 2, 80)
    assert max(want.values()) > 12 and {0, 1, 2} <= set(want.values())
    assert got == want


def test_linked_counts_both_sides():
    rng = np.random.default_rng(3)
    pool = np.unique(rng.integers(1, 2**63, 40).astype(np.uint64))
    sets = [np.sort(rng.choice(pool, rng.integers(1, 40), replace=False)) for _ in range(60)]
    one, two = sets[:25], sets[25:]
    fit = np.array([[100 * len(np.intersect1d(a, b)) >= 50 * len(np.union1d(a, b)) for b in two] for a in one])
    left, right = jaccard.linked(one, two, 50, 100)
    assert fit.any() and left.tolist() == fit.sum(1).tolist() and right.tolist() == fit.sum(0).tolist()
    assert [x.tolist() for x in jaccard.linked([], two[:2], 50, 100)] == [[], [0, 0]]


def test_component_rounds_write_few_files(spark):
    """Few links are one task's work in every round, also where shuffles have many partitions that are not coalesced."""
    links = spark.createDataFrame([(i, i + 3) for i in range(40)] + [(7, 7), (3, 0), (90, 91), (90, 91)], "a bigint, b bigint")
    held = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        labels = components(spark, links)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(labels.inputFiles()) == 1
    assert sorted(map(tuple, labels.collect())) == [(i, i % 3) for i in range(43)] + [(90, 90), (91, 90)]
    assert components(spark, links.where("a < 0")).collect() == []


def test_sketch_bounds_the_difference():
    rng = np.random.default_rng(5)
    for n, gone in ((40, 3), (400, 30), (3, 1)):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[gone:], rng.integers(0, 2**63, gone).astype(np.uint64))))
        x, y = jaccard.sketch(a), jaccard.sketch(b[:len(b) // 3 * 3])
        for size in (64, 32):
            apart = np.bitwise_count(jaccard.folded(x, size) ^ jaccard.folded(y, size)).sum()
            assert apart <= len(np.setxor1d(a, b[:len(b) // 3 * 3]))


@pytest.mark.parametrize("p", [90, 80, 50])
def test_linked_sets_share_a_segment(p):
    """Any two sets of the threshold's similarity have a key in common, small sets included."""
    rng, bands = np.random.default_rng(p), jaccard.Bands(p, 100)
    for _ in range(400):
        n = int(rng.choice([1, 2, 5, 9, 10, 12, 19, 40, 90, 300]))
        a = np.unique(rng.integers(1, 2**63, n).astype(np.uint64))
        drop, add = rng.integers(0, n // 2 + 1), rng.integers(0, n // 2 + 1)
        b = np.unique(np.concatenate((a[drop:], rng.integers(1, 2**63, add).astype(np.uint64))))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= p * (len(a) + len(b) - both):
            assert np.intersect1d(jaccard.segment_keys(a, bands), jaccard.segment_keys(b, bands)).size


def test_jaccard_nulls_and_empty(spark, none):
    df = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (9, None), (None, "q w e")],
                               "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark, df).collect()),
                 key=str)
    assert got == sorted([(None, 2, 4), (4, 2, 4), (4, 2, 4), (9, 0, 9), (None, 1, None)], key=str)
    assert jaccard.near_duplicates(spark, none).count() == 0


# -- repeated passages and lines -----------------------------------------------------------------


def repeats_by_hand(rows, length):
    seen, out = set(), {}
    for i, t, *_ in sorted(rows):
        w = words_of(t)
        keep = [True] * len(w)
        for p in range(len(w) - length + 1):
            if (g := tuple(w[p:p + length])) in seen:
                keep[p:p + length] = [False] * length
            seen.add(g)
        left = " ".join(x for x, k in zip(w, keep) if k)
        out[i] = (len(w), keep.count(False), hashlib.sha256(left.encode()).hexdigest())
    return out


@pytest.mark.parametrize("length", [20, 5, 2])
def test_repeated_passages(spark, docs, rows, length):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in substring_dedup.remove_repeats(spark, docs, length=length).collect()}
    assert got == repeats_by_hand(rows, length)


def test_equal_windows_have_equal_symbols():
    import pyarrow as pa
    from riskweave.llm import words
    rng = random.Random(2)
    core = [rng.choice("abc") for _ in range(26)]
    texts = [" ".join([rng.choice("abcd") for _ in range(rng.randint(0, 9))] + core + [rng.choice("abcd") for _ in range(4)])
             for _ in range(50)]
    w = words.Words(pa.array(texts))
    _, own, symbol = substring_dedup.window_symbols(w, 20)
    table = collections.defaultdict(set)
    for a, b in zip(own.tolist(), symbol.tolist()):
        table[a].add(b)
    assert all(len(v) == 1 for v in table.values())


def test_repeats_nulls_and_empty(spark, none):
    t = " ".join("abcdefghijklmnopqrstuvwxy")
    df = spark.createDataFrame([(None, t), (2, t), (2, t), (5, None), (1, "z " + t)], "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(spark, df).collect()), key=str)
    assert got == sorted([(None, 25, 25), (2, 25, 25), (2, 25, 25), (5, 0, 0), (1, 26, 0)], key=str)
    assert substring_dedup.remove_repeats(spark, none).count() == 0


def test_repeated_lines(spark, none):
    rng = random.Random(3)
    run = [f"boiler {i}" for i in range(5)]
    rows = [(i, "\n".join([rng.choice("abc") for _ in range(rng.randint(0, 6))] + run[rng.randint(0, 2):] + [str(i)] * 4))
            for i in range(40)] + [(50, None), (51, ""), (52, "\n\n\n\n\n"), (53, "one"), (54, "x\n" * 300)]
    long, short = " ".join(f"w{i}" for i in range(50)), " ".join(f"v{i}" for i in range(49))
    rows += [(60, long), (61, long), (62, f"{long}\nz"), (63, short), (64, short), (65, f"{short}\nend"), (66, f"y\n{short}\nend"),
             (67, f"{long}\n{long}")]
    seen, want = set(), {}
    for i, t in rows:
        lines = t.split("\n") if t else []
        gone = set()
        for p in range(len(lines)):
            for n in (1, 2, 3):
                g = tuple(lines[p:p + n])
                if len(g) < n or (n < 3 and sum(len(x.split()) for x in g) < 50):
                    continue
                if g in seen:
                    gone |= set(range(p, p + n))
                seen.add(g)
        want[i] = (len(lines), len(gone), "\n".join(x for j, x in enumerate(lines) if j not in gone))
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, print int").repartition(4)
    out = line_dedup.repeated_lines(df)
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in out.collect()} == want
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert line_dedup.repeated_lines(none).count() == 0


# -- shards and mixes ----------------------------------------------------------------------------


def test_differencing_halves_and_is_tight():
    assert sorted(np.bincount(sharding.differencing([8, 7, 6, 5, 4], 2), weights=[8, 7, 6, 5, 4])) == [14, 16]
    sizes = np.random.default_rng(0).integers(1, 9000, 4000)
    sums = np.bincount(sharding.differencing(sizes, 24), weights=sizes)
    assert sums.max() - sums.min() <= 3


@pytest.mark.parametrize("block,finest", [(20_000, 1024), (7, 2)])
def test_shards(spark, docs, rows, block, finest):
    if block == 7:
        sized = docs.select(F.coalesce(F.md5("text"), F.lit("")).alias("item"), (F.coalesce(
            F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size")).groupBy("item").agg(F.sum("size").alias("size"))
        placed = sharding.group_shards(spark, sized, 4, block, finest).collect()
        assert len(placed) == len({r.item for r in placed}) == sized.count() and {r.shard for r in placed} == {0, 1, 2, 3}
        return
    got = sharding.assign_shards(spark, docs, shards=4).collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
    text = {r[0]: r[1] for r in rows}
    assert all(r.size == len((text[r.doc_id] or "").encode()) + 8 and r.law == "bytes" and r.grown_shard is None for r in got)
    by = collections.defaultdict(set)
    for r in got:
        by[text[r.doc_id] or ""].add(r.shard)
    assert all(len(v) == 1 for v in by.values())
    for s in range(4):
        own = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))


def test_shards_of_nothing_and_null_keys(spark, none):
    assert sharding.assign_shards(spark, none).count() == 0
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, None)], "doc_id bigint, text string")
    assert sorted(r.size for r in sharding.assign_shards(spark, df, shards=2).collect()) == [8, 9, 9]


def test_sainte_lague_is_the_highest_quotients():
    rng = np.random.default_rng(8)
    for _ in range(40):
        votes, seats = rng.integers(0, 90, 6).astype(float), int(rng.integers(0, 60))
        caps = rng.integers(0, 30, 6)
        quotients = sorted(((-v / (2 * s + 1), i) for i, v in enumerate(votes) if v for s in range(caps[i])))[:seats]
        assert mixing.sainte_lague(votes, seats, caps).tolist() == np.bincount(
            [i for _, i in quotients], minlength=6).tolist()


def test_mix(spark, docs, rows, none):
    got = {r.doc_id: r for r in mixing.mix_sources(spark, docs).collect()}
    again = {r.doc_id: r for r in mixing.mix_sources(spark, docs.repartition(3)).collect()}
    assert got == again and len(got) == len(rows)
    size = {i: len(words_of(t)) for i, t, *_ in rows}
    total = {s: sum(size[i] for i, _, _, x in rows if x == s) for s in ("s0", "s1", "s2")}
    assert all(r.size == size[i] and 0 <= r.taken <= 3 * r.size and r.source_size == total["s%d" % (i % 3)]
               for i, r in got.items())
    assert sum({r.source_size: r.target for r in got.values()}.values()) == pytest.approx(sum(total.values()))
    for s in range(3):
        own = [r for i, r in got.items() if i % 3 == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 3 * mixing.BLOCK
    assert mixing.mix_sources(spark, none).count() == 0
    assert mixing.mixed_documents(spark, docs).columns == docs.columns


def test_mix_caps_targets_and_null_source(spark):
    rows = [(1, "a b c", "a"), (2, "w " * 1000, "b"), (3, "", "c"), (4, "x y", None), (None, "z z", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: (r.size, r.source_size, r.target) for r in mixing.mix_sources(spark, df).collect()}
    # weights a 1, b 2, c 3, null 1: a, c and null stop at three times their own
    assert got == {1: (3, 3, 9.0), 2: (1000, 1000, 986.0), 3: (0, 0, 0.0), 4: (2, 4, 12.0), None: (2, 4, 12.0)}


def test_mix_takes_the_target_of_small_sources(spark):
    rows = [(1, "a b c", "a"), (2, "w " * 1000, "b"), (3, "", "c"), (4, "x y", None), (None, "z z", None), (5, "v", "d")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: r for r in mixing.mix_sources(spark, df).collect()}
    assert [got[i].taken for i in (1, 3, 4, None, 5)] == [9, 0, 6, 6, 3]
    assert got[2].taken == round(got[2].target)
    # targets 1.67, 3.33 and 3.0, of less than half a block
    small = spark.createDataFrame([(1, "a b c d e", "a"), (2, "w w", "b"), (3, "v", "c")], df.schema)
    assert {(r.source_size, r.taken) for r in mixing.mix_sources(spark, small).collect()} == {(5, 2), (2, 3), (1, 3)}


def test_whole_documents_meet_every_target(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 8000)  # the hot source is dealt to several shards
    rng = random.Random(11)
    rows = []
    for source, words in (("a", 60_000), ("b", 20_000), ("c", 20_000)):
        while words > 0:
            n = min(words, rng.randint(40, 400))
            rows.append((len(rows), "w " * n, source))
            words -= n
    rows += [(len(rows), "w " * 4000, "a"), (len(rows) + 1, "", "a"), (len(rows) + 2, None, "b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    source = {i: s for i, _, s in rows}
    goal = {source[r.doc_id]: r.target for r in mixing.mix_sources(spark, df).collect()}
    kept, times = collections.Counter(), collections.Counter()
    for r in mixing.mixed_documents(spark, df).collect():
        kept[r.source] += len(words_of(r.text))
        times[r.doc_id] += 1
    assert goal["a"] < 0.3 * 64_000  # taken whole by the nearest number, no document of it would stay
    assert all(abs(kept[s] - goal[s]) < 0.03 * goal[s] for s in "abc"), (kept, goal)
    assert {times[i] for i, t, s in rows if t and s == "a"} == {0, 1}
    assert {times[i] for i, t, s in rows if t and s == "b"} == {1, 2} and max(times.values()) == 3


# -- tokens, pages, languages, neighbours ----------------------------------------------------------


@pytest.mark.parametrize("most", [bpe.COMMON_WORDS, 3])
def test_bpe_equals_the_library(spark, docs, rows, none, most):
    import tiktoken
    tokens, pattern = queries.tokenizer()
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={b: i for i, b in tokens.items()}, special_tokens={})
    hard = ["<|endoftext|> don't  stop now\u0085\x1c x", "ﬁ́ \U0001e900 ࡰ\U00031350 Ɤ", "a" * 700,
            "\r\n\r\n  \t", "12٣½Ⅷ", "!!!???...", "​­﻿"]
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(hard)] + [(None, "null key")],
                                  "doc_id bigint, text string")
    df = docs.select("doc_id", "text").union(extra).union(extra)
    want = {r[0]: r[1] for r in rows} | {1000 + i: t for i, t in enumerate(hard)} | {None: "null key"}
    got = bpe.encode(spark, df, tokens, pattern, most=most).collect()
    assert len(got) == len(rows) + 2 * len(hard) + 2
    for r in got:
        assert list(r.ids) == enc.encode_ordinary(want[r.doc_id] or ""), want[r.doc_id]
        assert bytes(r.decoded) == (want[r.doc_id] or "").encode()
    assert bpe.encode(spark, none, tokens, pattern).count() == 0


def test_chunks_split_like_the_whole_text():
    import pyarrow as pa
    import regex
    split, rng = regex.compile(queries.tokenizer()[1]).findall, random.Random(7)
    texts = ["".join(rng.choice(" a'sB1½é\u3000\n\t\x1c\xa0\0.!  ") for _ in range(rng.randint(0, 14))) for _ in range(9000)]
    texts += ["a b\n", "\nx y", " lead", "trail ", "a's b 's", "x\u2019s y\u2009z", "", None]
    chunks, stops = bpe.chunked(pa.array(texts))
    found, begin, count = bpe.split_chunks(chunks, split)
    for i, text in enumerate(texts):
        own = [w for c in range(stops[i], stops[i + 1]) for w in found[begin[c]:begin[c] + count[c]]]
        assert own == split(text or ""), repr(text)


PAGE = """<!DOCTYPE html><html lang=en><head><title>T &amp; t</title><style>p{}</style><script>var a="<p>no</p>";</script>
</head><body><header><h1>Site</h1></header><nav><ul><li><a href=/a>Menu</a></ul></nav><div class="cookie-notice">We use
cookies</div><aside>Side</aside><main><article><h1>Head &eacute;&#33;</h1><p>One   <b>two</b>
three<p>Four &lt;five&gt;<form><input value=x>Sign up</form><div class="ad">Buy</div><p>Six</article>
<section id="comments"><p>First!</p></section></main><footer>&copy; us</footer>"""


def test_pages(spark):
    long = "<article>" + "<p>" + "word " * 30000 + "</p></article>"
    plain = "<body><div class=menu>a b c</div><p>" + "Some long sentence of content. " * 5 + "</p><p>" + "More of it. " * 9
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "<nav>x</nav>"), (5, "u", long), (6, "u", plain),
            (7, "u", "just text"), (7, "u", "just text"), (8, "u", "<p>a<script>")]
    got = html_text.extract_main_text(spark.createDataFrame([(*r, "t") for r in rows], "page_id int, url string, html string, text string"))
    by = {r.page_id: (r.url, r.text, r.n_chars) for r in got.collect()}
    assert got.count() == 9 and by[1][1] == "Head é!\nOne two three\nFour <five>\nSix" and by[1][2] == 37
    assert by[2] == (None, "", 0) and by[3] == ("u", "", 0) and by[None][1] == ""
    assert by[5][1] == ("word " * 30000).strip() and by[7][1] == "just text" and by[8][1] == "a"
    assert by[6][1] == ("Some long sentence of content. " * 5).strip() + "\n" + ("More of it. " * 9).strip()


@pytest.mark.parametrize("lengths", [
    (30, 400, 350, 2500, 300, 420), (30, 300, 300, 300, 20000, 300, 300, 300), (30, 400, 350, 500, 300, 420, 60)])
@pytest.mark.parametrize("block", ["<p>%s</p>", "<div>%s</div>", "<div><div>%s</div></div>", "<section><h2>Part</h2><p>%s</p></section>"])
def test_one_long_block_cuts_no_others(lengths, block):
    texts = [("%d " % i + "word " * n)[:n].strip() for i, n in enumerate(lengths)]
    menu = "<ul><li><a href=/a>Home</a><li><a href=/b>About us</a><li><a href=/c>Contact</a></ul>"
    page = f"<body><nav>Site</nav>{menu}<div>" + "".join(block % t for t in texts) + f"</div>{menu}<footer>us</footer>"
    assert [t for t in html_text.main_text(page).split("\n") if t != "Part"] == texts
    bare = "<body><nav>Site</nav>" + menu + "".join(block % t for t in texts) + "<footer>us</footer>"
    assert [t for t in html_text.main_text(bare).split("\n") if t != "Part"] == texts


def test_language_held_out(spark, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(spark, docs.where("doc_id % 2 = 0"))
    got = language.identify(spark, model, docs.where("doc_id % 2 = 1").select("doc_id", "text"), "doc_id", "text")
    both = got.join(docs.select("doc_id", F.col("lang").alias("truth")), "doc_id")
    assert both.where("lang = truth").count() >= 0.99 * both.count()
    assert language.identify(spark, model, none, "doc_id", "text", declared="lang", host="source").count() == 0
    assert language.fit(spark, none).languages == []
    odd = spark.createDataFrame([(1, None, None, None), (2, "", "xx", ""), (None, "!!! 123", "en", "s"), (4, "the and of", None, "s"),
                                 (4, "the and of", None, "s")], "doc_id bigint, text string, lang string, source string")
    out = language.identify(spark, model, odd, "doc_id", "text", declared="lang", host="source").collect()
    assert sorted(((r.doc_id, r.accepted) for r in out), key=str) == sorted(
        [(1, False), (2, False), (None, False), (4, True), (4, True)], key=str)
    kept = language.accepted_documents(spark, docs)
    assert kept.columns == docs.columns and kept.count() >= 999


def test_address_parts(spark):
    df = spark.createDataFrame([("https://User:p@M.Shop.example.DE:8080/fr/x",), ("no url",), (None,)], "url string")
    got = [tuple(r) for r in df.select(*language.address(F.col("url"))).collect()]
    assert got == [("m.shop.example.de", "example.de", "de"), ("", "", ""), (None, None, None)]


def test_neighbours_exact_when_all_are_visited(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, rng.standard_normal(8).astype(float).tolist()) for i in range(300)]
    vectors += [(i, vectors[40][1]) for i in range(300, 340)]  # ties
    odd = [(400, None), (401, [0.0] * 8), (402, [math.nan] * 8), (403, [1.0, None] * 4), (404, [math.inf] * 8), (405, []),
           (420, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 0, "x") for r in vectors + odd], "vec_id bigint, embedding array<double>, label int, part string")
    is_query = F.col("key") % 20 == 0
    got = collections.defaultdict(list)
    for r in ann.search(spark, df, is_query, recall=1.0, block=64).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, round(r.score, 9)))
    x = dict(vectors)
    for q in [i for i in x if i % 20 == 0]:
        best = sorted((-round(float(np.dot(x[q], x[i])), 9), i) for i in x if i != q)[:20]
        assert got[q] == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert len(got) == 17


def test_neighbours_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = ann.search(spark, df, F.col("key") % 20 == 0).toPandas()
    table = df.toPandas().sort_values("vec_id")
    x, ids, hit = np.stack(table.embedding.to_numpy()).astype(float), table.vec_id.to_numpy(), 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -9
        hit += len(set(got[got.query_id == ids[q]].vec_id) & set(ids[np.argsort(-s, kind="stable")[:20]]))
    assert hit >= 0.9 * len(got)


def test_neighbours_of_the_most_frequent_length(spark):
    rows = [(i, [1.0, float(i)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    first = df.orderBy(F.xxhash64(F.col("vec_id"))).first().vec_id  # the first of the sample is the odd one out
    odd = df.withColumn("embedding", F.when(F.col("vec_id") == first, F.array(F.lit(1.0).cast("float"))).otherwise(F.col("embedding")))
    got = ann.search(spark, odd, F.lit(True), k=3, sample=200, parts=2, recall=1.0).collect()
    assert len(got) == 59 * 3 and first not in {r.query_id for r in got} | {r.vec_id for r in got}


def test_neighbours_few_or_none(spark):
    kind = "vec_id bigint, embedding array<float>"
    one = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], kind)
    assert [tuple(r) for r in ann.search(spark, one, F.col("key") % 20 == 0).collect()] == [(0, 1, 1, 0.5)]
    assert ann.search(spark, spark.createDataFrame([], kind), F.col("key") % 20 == 0).count() == 0


def by_brute_force(rows, asked, k):
    """{query: keys} of the largest inner products among vectors of the same length; ties to the smaller key."""
    out = {}
    for q, v in rows:
        if q in asked:
            scores = [(-float(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v)]
            out[q] = [i for _, i in sorted(scores)[:k]]
    return out


def test_neighbours_of_every_length(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal((6, 6, 6, 4, 4, 3)[i % 6]).tolist()) for i in range(240)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = collections.defaultdict(list)
    for r in ann.search(spark, df, F.col("key") % 5 == 0, k=4, lengths=2, recall=1.0, block=16).orderBy("rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got == by_brute_force(rows, set(range(0, 240, 5)), 4)


def test_neighbours_recall_with_uneven_norms(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((3000, 16)) * np.exp(0.7 * rng.standard_normal(3000))[:, None]
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann.search(spark, df, F.col("key") % 20 == 0).toPandas().groupby("query_id").vec_id.agg(set)
    want = by_brute_force(rows, set(range(0, 3000, 20)), 20)
    assert all(len(got[q]) == 20 for q in want)
    assert sum(len(got[q] & set(w)) for q, w in want.items()) >= 0.9 * 20 * len(want)


def test_known_words_are_taken_out_of_their_table():
    import pyarrow as pa
    from riskweave.llm import bpe

    held = [pa.table({"word": pa.array(["b", "a", "c"]), "ids": pa.array([[1], [2, 3], [4]], pa.list_(pa.int32()))})]
    known = bpe.Known(held)
    assert held == []
    at = known.find(["a", "zz", "b", "c"])
    assert [known.ids[known.begins[i]:known.begins[i] + known.sizes[i]].tolist() for i in at] == [[2, 3], [-1], [1], [4]]


def test_two_bytes_are_looked_up_by_their_values(spark):
    tokens = {i: bytes([i]) for i in range(256)} | {256: b"ab", 257: "é".encode(), 258: b"abab"}
    ranks = bpe.RankMap(tokens)
    pair = lambda a, b: F.get(ranks.pairs, F.lit(a * 256 + b))
    assert tuple(spark.range(1).select(pair(97, 98), pair(0xC3, 0xA9), pair(98, 97)).first()) == (256, 257, None)
    words = spark.createDataFrame([("ababé",), ("z",)], "word string")
    assert [r[0] for r in words.select(bpe.merged_ids(F.col("word"), ranks)).collect()] == [[258, 257], [122]]


def test_rank_map_is_sent_in_short_texts(spark, monkeypatch):
    sent, lit = [], F.lit
    monkeypatch.setattr(bpe.F, "lit", lambda x: sent.append(x) or lit(x))
    bpe.RankMap({i: bytes([i]) for i in range(256)} | {256: b"ab"})
    assert max(len(x) for x in sent if isinstance(x, str)) < 1 << 19


def test_known_gives_back_what_arrow_keeps(monkeypatch):
    import pyarrow as pa

    calls = []
    monkeypatch.setattr(bpe, "release", lambda: calls.append(1))
    table = pa.table({"word": pa.array(["a", "b"]), "ids": pa.array([[1], [2, 3]], pa.list_(pa.int32()))})
    known = bpe.Known([table])
    assert calls and known.sizes[known.find(["a", "c", "b"])].tolist() == [1, 1, 2]


def small_tokens():
    return {i: bytes([i]) for i in range(256)} | {256: b"ab", 257: "é".encode(), 258: b"abab", 259: b" ab", 260: b"ba", 261: b"aba"}


def test_words_fold_in_blocks_like_one_by_one(monkeypatch):
    import pyarrow as pa
    rng, tokens = random.Random(3), small_tokens()
    ranks = {token: rank for rank, token in tokens.items()}

    def plain(word):
        parts = [bytes([x]) for x in word.encode()]
        while True:
            low, at = min(((ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1 << 30, 0))
            if low == 1 << 30:
                return [ranks[x] for x in parts]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    words = ["".join(rng.choice(" aabbé") for _ in range(rng.randint(1, 12))) for _ in range(400)] + ["ab" * 90, "", "a", "漢\0"]
    rng.shuffle(words)
    merges = bpe.Merges(tokens)
    for cells in (1, 50, bpe.CELLS):
        monkeypatch.setattr(bpe, "CELLS", cells)
        ids, sizes = merges.fold(pa.array(["left out"] + words).slice(1))
        stops = np.concatenate(([0], np.cumsum(sizes)))
        assert [ids[a:b].tolist() for a, b in zip(stops, stops[1:])] == [plain(w) for w in words]
    assert [len(x) for x in merges.fold(pa.array([], pa.string()))] == [0, 0]


def test_encode_puts_no_map_into_its_plans(spark, monkeypatch):
    def no_literal(values):
        raise AssertionError("a map went into a plan")

    monkeypatch.setattr(bpe, "_numbers", no_literal)
    texts = ["abab é", "abab ab", None, "", "once"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.ids, bytes(r.decoded)) for r in bpe.encode(spark, df, small_tokens(), r" ?\w+|\s+", most=1).collect()}
    assert {i: d.decode() for i, (_, d) in got.items()} == {i: t or "" for i, t in enumerate(texts)}
    assert [got[i][0] for i in range(4)] == [[258, 32, 257], [258, 259], [], []] and got[4][0] == list(b"once")
