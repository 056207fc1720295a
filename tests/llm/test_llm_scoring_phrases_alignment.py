"""Language model scores, phrases and tokenizer alignment against brute force: nulls, empty and long texts, ties, repeats."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riskweave.llm import alignment, gru, language_model, phrases

SCHEMA = "doc_id bigint, text string, lang string, key string, row string, n string, word string, k string"
FIRST, SECOND = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def corpus():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(120)]
    follow = {w: [rng.choice(vocab) for _ in range(3)] for w in vocab}

    def prose(n):
        w, out = rng.choice(vocab), []
        for _ in range(n):
            out.append(w + rng.choice(["", "", "", "", ",", ". "]))
            w = rng.choice(follow[w])
        return " ".join(out)

    texts = [prose(rng.randint(1, 120)) for _ in range(120)] + ["x y x y " * 30, "one two three four five. " * 20, prose(9000)]
    texts += [texts[0], texts[0], None, "", " ", "\n\t", " a", "a  b ", "A Ä É\x0bZ\x0c.", "a▁b", "<|endoftext|> <s> <0x41>",
              "漢字 \U0001f600 ﬁ ½ é", "\0 x", "zzunseen zzunseen"]
    rows = [(i, t, rng.choice(["en", "de", None])) for i, t in enumerate(texts)]
    return rows + [(None, "one two three four five", "en"), (3, texts[3], "en"), (3, texts[3], "en")]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", None, "z", "q") for r in rows], SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# -- language model ------------------------------------------------------------------------------


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", low(text)) + [None]


def held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


@pytest.mark.parametrize("known", [1 << 17, 20, 0])
def test_scores_against_counts_by_hand(spark, docs, rows, known):
    count = collections.Counter()
    for key, text, _ in rows:
        if not held(key):
            count.update(tokens_of(text))
    total, kinds, want = sum(count.values()), len(count), []
    for key, text, _ in rows:
        t = tokens_of(text)
        want.append((str(key), held(key), len(t), sum(count[w] > 0 for w in t), total,
                     round(sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in t), 6)))
    got = language_model.score_texts(spark, docs, head=min(512, known), known=known).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    assert all(r.score < 0 for r in got)
    if known > 1000:  # words follow each other, so the network beats the shares of counts on texts it has not seen
        out = [r for r in got if r.held_out]
        assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_probabilities_of_all_next_tokens_sum_to_one(spark, docs):
    counted = spark.createDataFrame([("a", 9), ("b", 5), ("c", 5), ("d", 2), ("e", 1), ("f", 1)], "word string, n bigint")
    counts = language_model.Counts(counted, 4, 2, 100)
    shape = gru.Shape(counts.shape_bands, counts.head, 2, 4, 3)
    flat = shape.initial(np.ones(shape.classes), counts.n[:2])
    flat += np.random.default_rng(1).normal(0, 0.3, len(flat)).astype(np.float32)
    n = np.array([-1, 9, 5, 5, 2, 1, 1, 0])  # the end, six words, the unknown word
    unit = np.array([0, *range(1 + counts.shape_bands, 3 + counts.shape_bands), *language_model.units_of(-1 - n[3:], counts.shape_bands, False)])
    state = np.random.default_rng(2).normal(size=(1, 4)).astype(np.float32)
    logp = gru.outputs(shape.views(flat), shape, np.repeat(state, len(unit), axis=0), unit)
    inside = np.where(np.arange(len(n)) < 3, 0.0, counts.bands.inside(np.maximum(n, 0)))
    assert abs(np.exp(logp + inside).sum() - 1) < 1e-5


def test_gradients_are_those_of_the_likelihood(monkeypatch):
    monkeypatch.setattr(gru, "F32", np.float64)
    shape, rng = gru.Shape(3, 10, 4, 5, 6), np.random.default_rng(0)
    flat = shape.initial(np.ones(shape.classes), np.arange(10, 0, -1)) + rng.normal(0, 0.2, shape.length())
    x, y, h = rng.integers(0, shape.units, (6, 4)), rng.integers(0, shape.units, (6, 4)), rng.normal(size=(4, 5))
    value = lambda f: gru.window_gradient(shape.views(f), shape, x, y, h)
    grads = value(flat)[1]
    grad = np.concatenate([grads[n].reshape(-1) for n in shape.sizes])
    for i in rng.choice(shape.length(), 40, replace=False):
        step = np.zeros(shape.length())
        step[i] = 1e-5
        assert abs((value(flat - step)[0] - value(flat + step)[0]) / 2e-5 / x.size - grad[i]) < 1e-7


def test_state_is_carried_over_windows_and_lanes():
    shape, rng = gru.Shape(2, 12, 4, 6, 5), np.random.default_rng(3)
    flat = shape.initial(np.ones(shape.classes), np.ones(12)) + rng.normal(0, 0.5, shape.length()).astype(np.float32)
    texts = [np.append(rng.integers(1, shape.units, n), gru.END) for n in (0, 1, 7, 200, 33, 64, 65)]
    alone = [gru.score(flat, shape, [t], window=1000)[0] for t in texts]
    assert np.allclose(gru.score(flat, shape, texts, window=8, most=3), alone, rtol=1e-4)


# -- phrases -------------------------------------------------------------------------------------


def phrases_by_hand(rows, longest, least, share, top):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\f\r]", low(text)):
            w = [v for v in re.split("[ \t]+", piece) if v]
            n[lang] += len(w)
            for i in range(len(w)):
                for m in range(1, min(longest, len(w) - i) + 1):
                    f[lang][tuple(w[i:i + m])] += 1
    want = []
    for lang, c in f.items():
        candidates = {p: a for p, a in c.items() if a >= least and len(p) > 1}
        inside = collections.Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside[p[i:i + m]], a)
        found = []
        for p, a in candidates.items():
            if 100 * inside[p] >= share * a and inside[p]:
                continue
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        want += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return want


@pytest.mark.parametrize("longest,common", [(3, phrases.COMMON), (3, 25), (3, 0), (2, 50), (5, 100)])
def test_phrases_by_hand(spark, docs, rows, longest, common):
    got = [tuple(r) for r in phrases.collocations(spark, docs, longest=longest, least=4, top=60, common=common).collect()]
    assert sorted(got) == sorted(phrases_by_hand(rows, longest, 4, 50, 60)) and got


def test_paths_hold_every_edge_once_and_join_unary_nodes(spark):
    edges = [("a b c", 7), ("b c d", 9), ("c d e", 5), ("x y x", 4), ("y x y", 4), ("q r s", 3), ("q r t", 3)]
    frame = spark.createDataFrame([("en", p, f) for p, f in edges], "lang string, phrase string, f bigint")
    made = phrases.paths(spark, frame, 3).collect()
    assert sorted((" ".join(r.words), tuple(r.counts)) for r in made) == [
        ("a b c d e", (7, 9, 5)), ("q r s", (3,)), ("q r t", (3,)), ("x y x", (4,)), ("y x y", (4,))]


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 3 * 10**12 + 7, 10**13 + 1, 10**13 + 3
    got = spark.createDataFrame([(a, l, r)], "a bigint, l bigint, r bigint").select(phrases.exact_score("a", "l", "r")).first()[0]
    assert got == 1000000 * a * a // (l * r)


# -- alignment -----------------------------------------------------------------------------------


def aligned_by_hand(rows):
    first, second = Tokenizer.from_file(FIRST), sentencepiece.SentencePieceProcessor(model_file=SECOND)
    first.encode_special_tokens = True
    alphabet, found, count = alignment.byte_alphabet(), [], collections.Counter()
    for key, text, _ in rows:
        text = text or ""
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        made = [[bytes(alphabet[c] for c in first.id_to_token(i)) for i in a], [
            bytes([int(second.id_to_piece(i)[1:-1], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]]
        if not text or any(b"".join(m) != (" " + text).encode() for m in made):
            found.append((key, None))
            continue
        ends = [np.cumsum([len(x) for x in m]).tolist() for m in made]
        spans = [list(zip([0] + e[:-1], e)) for e in ends]
        links, j = [], 0
        for i, (s, e) in zip(a, spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < e:
                links.append((i, b[k]))
                k += 1
        groups, at = [], [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            part = []
            for side, ids in enumerate((a, b)):
                stop = ends[side].index(cut, at[side]) + 1
                part.append(",".join(map(str, ids[at[side]:stop])))
                at[side] = stop
            groups.append("|".join(part))
        count.update(set(links))
        found.append((key, (len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    most = collections.Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return [(key, 0, 0, 0, 0, 0, 0, "") if x is None else (
        key, *x[:3], len(x[3]), sum(count[p] == most[p[0]] for p in x[3]), sum(count[p] for p in x[3]), x[4]) for key, x in found]


@pytest.mark.parametrize("common", [alignment.COMMON_PAIRS, 40, 0])
def test_alignment_by_hand(spark, docs, rows, common):
    got = alignment.align(spark, docs, lambda: alignment.ByteLevel(FIRST), lambda: alignment.Pieces(SECOND), common=common)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, aligned_by_hand(rows)))


def test_groups_of_any_intervals():
    rng = np.random.default_rng(4)
    for _ in range(50):
        cut = lambda: np.diff(np.unique(np.concatenate(([0, 40], rng.integers(1, 40, rng.integers(0, 15))))))
        a, b = cut(), cut()
        met = alignment.Overlaps(a, b)
        ends = [np.cumsum(a), np.cumsum(b)]
        assert met.groups == len(set(ends[0]) & set(ends[1]))
        assert list(zip(met.a, met.b)) == [(i, j) for i in range(len(a)) for j in range(len(b))
                                           if ends[0][i] - a[i] < ends[1][j] and ends[1][j] - b[j] < ends[0][i]]
        assert all(met.group_a[i] == met.group_b[j] for i, j in zip(met.a, met.b))


def test_empty_tables(spark, none):
    assert language_model.score_texts(spark, none).count() == 0
    assert phrases.collocations(spark, none).count() == 0
    assert alignment.align(spark, none, lambda: alignment.ByteLevel(FIRST), lambda: alignment.Pieces(SECOND)).count() == 0


def test_texts_of_short_batches_are_scored_together():
    rng, shape = np.random.default_rng(5), gru.Shape(4, 40, 8, 16, 16)
    flat = shape.initial(np.ones(shape.classes), np.arange(40, 0, -1))
    flat += rng.normal(0, 0.1, len(flat)).astype(np.float32)
    texts = [rng.integers(1, shape.units, n).tolist() for n in (0, 3, 700, 5, 1, 90, 2, 0, 60)]
    batch = lambda ids: pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([texts[i] for i in ids], pa.list_(pa.int32()))], names=["k", "units"])
    dealt = [batch([0, 1]), batch([]), batch([2]), batch([3, 4, 5]), batch([6]).slice(0, 0), batch([6, 7, 8])]
    whole = list(language_model.chunks_of(iter(dealt), 1 << 20))
    assert [b.column("k").to_pylist() for b in whole] == [list(range(9))]
    parts = list(language_model.chunks_of(iter(dealt), 100))
    assert [b.column("k").to_pylist() for b in parts] == [[0, 1, 2], [3, 4, 5, 6, 7, 8]]
    assert list(language_model.chunks_of(iter([batch([])]), 100)) == []
    score = lambda b: gru.score(flat, shape, [np.array([*u, gru.END]) for u in b.column("units").to_pylist()])
    np.testing.assert_allclose(np.concatenate([score(b) for b in parts]), score(whole[0]), rtol=1e-5)


@pytest.mark.parametrize("size", [1 << 16, (1 << 16) + 1])
def test_token_ids_are_stored_as_one_value_for_each_text(spark, size):
    kind, rows = alignment.width(size), [[0, 7, size - 1], [], [5]]
    ids, stops = alignment.flat(rows)
    column = alignment.packed(ids, stops, kind)
    assert alignment.unpacked(column, kind)[0].tolist() == [0, 7, size - 1, 5]
    found, counts = alignment.unpacked(column.slice(1, 2), kind)
    assert found.tolist() == [5] and counts.tolist() == [0, 1]
    docs = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id long, text string")
    made = alignment.tokenized(docs, lambda: alignment.ByteLevel(FIRST), lambda: alignment.Pieces(SECOND), "doc_id", "text")
    assert [made.schema[c].dataType.simpleString() for c in ("a", "b")] == ["binary", "binary"]


def test_streams_of_units_are_small_and_held_once():
    held = [pa.record_batch({"units": pa.array([[3, -5, 0], []], pa.list_(pa.int32()))})] * 2
    batch = language_model.together(held)
    assert held == [] and batch.num_rows == 4
    stream, stops = language_model.texts_of(batch, 4, loo=True)
    assert stream.dtype == np.int32 and stream.tolist() == [7, 2, 1, 0, 0] * 2 and stops.tolist() == [4, 5, 9, 10]
    parts = [stream, stream[:1]]
    assert language_model.joined(parts).tolist() == [*stream.tolist(), 7] and parts == []
    assert language_model.JUDGED < language_model.CHUNK
