"""Repeated passages: recompression names runs and pairs of words; shared high-level symbols point to repeats."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskweave.llm import tables, words

ROUNDS = 5
_U = np.uint64
_LAST = (1 << 63) - 1


def _runs(sym, row, size):
    """Name maximal runs of one symbol: (symbols, rows, sizes, old position -> new position)."""
    fresh = np.ones(len(sym), dtype=bool)
    fresh[1:] = (sym[1:] != sym[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(fresh)
    times = np.diff(np.append(at, len(sym)))
    named = np.where(times > 1, words.mix(sym[at] + words.mix(times.astype(np.uint64))), sym[at])
    return named, row[at], np.add.reduceat(size, at), np.cumsum(fresh, dtype=np.int32) - np.int32(1)


def _pairs(sym, row, size, turn):
    """Name every pair of neighbours whose coins say left and right; a coin hangs on its symbol alone."""
    right = (words.mix(sym + _U(0x9E37 + turn)) >> _U(40)) & _U(1) == 1
    fresh = np.ones(len(sym), dtype=bool)
    fresh[1:] = ~(right[1:] & ~right[:-1] & (row[1:] == row[:-1]))
    at = np.flatnonzero(fresh)
    joined = np.diff(np.append(at, len(sym))) == 2
    named = sym[at].copy()
    named[joined] = words.mix(words.mix(named[joined] + _U(turn + 1)) + sym[at[joined] + 1])
    return (named, row[at], np.add.reduceat(size, at), np.cumsum(fresh, dtype=np.int32) - np.int32(1)), right


def window_symbols(w, length, rounds=ROUNDS):
    """(start, window hash, symbol) of every window of `length` words of one row.

    The symbol is one of the highest level whose naming is settled by the words of the window alone, so equal
    windows, wherever they stand, have equal symbols. Names are hashes of what they stand for and need no
    table. Level by level the settled part of a window loses at most one symbol at each end: after naming
    runs always, after naming pairs if the end's coin points outward. A window with nothing settled
    at the first level (one long run) has its own hash for a symbol.
    """
    start, own = w.grams(length)
    if not len(start):
        return start, own, own
    sym, row = w.hash, np.repeat(np.arange(w.rows, dtype=np.int32), w.counts())
    size = np.ones(len(w.hash), dtype=np.int32)
    symbol = own.copy()
    sym, row, size, to = _runs(sym, row, size)
    live = np.arange(len(start), dtype=np.int32)
    first, last = to[start] + np.int32(1), to[start + length - 1] - np.int32(1)
    for turn in range(rounds):
        some = first <= last
        if not some.all():
            live, first, last = live[some], first[some], last[some]
        above, right = _pairs(sym, row, size, turn)
        to = above[3]
        up_first, up_last = to[first] + right[first], to[last] - ~right[last]
        settled = (up_first > up_last) | (turn + 1 == rounds)
        # long symbols first, then the least hash, so that neighbouring windows tend to the same one
        rank_of = lambda x, n: (words.mix(x + _U(99)) >> _U(12)) // n.astype(np.uint64) ** _U(2)
        whole = rank_of(sym, size) if settled.sum() > len(sym) else None
        rank = (lambda i: whole[i]) if whole is not None else (lambda i: rank_of(sym[i], size[i]))
        at, end = first[settled], last[settled]
        best, low = at.copy(), rank(at)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            at[open_] += 1
            value = rank(at[open_])
            better = value < low[open_]
            best[open_[better]], low[open_[better]] = at[open_[better]], value[better]
            open_ = open_[at[open_] < end[open_]]
        symbol[live[settled]] = words.mix(sym[best] + words.mix(np.full(1, turn + 77, dtype=np.uint64)))
        live, first, last = live[~settled], up_first[~settled], up_last[~settled]
        sym, row, size = above[:3]
    return start, own, symbol


def _rows(w, start):
    """First window of every row, as positions in `start`."""
    return np.searchsorted(start, w.ptr)


def _again(own):
    """Windows of one row that repeat an earlier one of the row."""
    again = np.zeros(len(own), dtype=bool)
    ranked = np.sort(own)
    if (ranked[1:] == ranked[:-1]).any():
        again[:] = True
        again[np.unique(own, return_index=True)[1]] = False
    return again


def _repeated(w, own, cut):
    """`_again` for all rows of a slice; only rows with equal windows are looked at one by one."""
    gone = np.zeros(len(own), dtype=bool)
    row = np.repeat(np.arange(w.rows), np.diff(cut))
    keyed = own ^ words.mix(row.astype(np.uint64) + _U(5))
    ranked = np.sort(keyed)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if len(twice):
        for i in np.unique(row[_among(keyed, np.unique(twice))]):
            gone[cut[i]:cut[i + 1]] = _again(own[cut[i]:cut[i + 1]])
    return gone


def _among(values, ranked):
    """Which values are in a sorted array."""
    if not len(ranked):
        return np.zeros(len(values), dtype=bool)
    return ranked[np.minimum(np.searchsorted(ranked, values), len(ranked) - 1)] == values


def _distinct(symbols):
    """Distinct symbols of one row; neighbouring windows mostly share theirs."""
    fresh = np.ones(len(symbols), dtype=bool)
    fresh[1:] = symbols[1:] != symbols[:-1]
    return np.unique(symbols[fresh])


def _kept(w, starts, length):
    """(removed words, SHA-256 of the kept words) per row when the windows at `starts` are taken out."""
    edge = np.zeros(len(w.hash) + 1, dtype=np.int64)
    edge[starts] += 1
    edge[starts + length] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    left = np.concatenate(([0], np.cumsum(keep)))[w.ptr]
    return w.counts() - np.diff(left), [hashlib.sha256(t).hexdigest() for t in w.joined(keep)]


def _class_names(w):
    """64-bit name of every row's word sequence."""
    with np.errstate(over="ignore"):
        at = np.arange(len(w.hash)) - np.repeat(w.ptr[:-1], w.counts())
        terms = np.append(words.mix(w.hash + words.mix(at.astype(np.uint64))), _U(0))
        sums = np.concatenate(([_U(0)], np.cumsum(terms, dtype=np.uint64)))
        return words.mix((sums[w.ptr[1:]] - sums[w.ptr[:-1]]) + w.counts().astype(np.uint64))


def _described(df, length):
    """(key, cls, n, removed, kept): each row judged by itself; `kept` is the text left."""
    kind = df.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, 1):
                w = words.Words(part.column(1))
                start, own = w.grams(length)
                removed, sha = _kept(w, start[_repeated(w, own, _rows(w, start))], length)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words.signed(_class_names(w))), pa.array(w.counts(), pa.int64()),
                     pa.array(removed, pa.int64()), pa.array(sha)], names=["key", "cls", "n", "removed", "sha"])

    return df.mapInArrow(run, f"key {kind}, cls bigint, n bigint, removed bigint, sha string")


def _symbols(df, length):
    """(symbol, cls): the symbols of every text's windows, each once per text and slice."""

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, 1):
                w = words.Words(part.column(1))
                start, _, symbol = window_symbols(w, length)
                cut, names, seen = _rows(w, start), _class_names(w), set()
                found, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
                for i in range(w.rows):
                    if cut[i] < cut[i + 1] and names[i] not in seen:
                        seen.add(names[i])
                        found.append(_distinct(symbol[cut[i]:cut[i + 1]]))
                        owner.append(np.full(len(found[-1]), names[i]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.signed(np.concatenate(found))), pa.array(words.signed(np.concatenate(owner)))],
                    names=["symbol", "cls"])

    return df.mapInArrow(run, "symbol bigint, cls bigint")


def _bodies(df, length):
    """(cls, body): compressed text of every class with a window, once per slice."""

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, 1):
                w = words.Words(part.column(1))
                names, counts, seen, out = words.signed(_class_names(w)).tolist(), w.counts(), set(), []
                for i, text in enumerate(part.column(1).to_pylist()):
                    if counts[i] >= length and names[i] not in seen:
                        seen.add(names[i])
                        out.append((names[i], zlib.compress(text.encode(), 1)))
                cols = list(zip(*out)) or [[], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary())], names=["cls", "body"])

    return df.mapInArrow(run, "cls bigint, body binary")


def _opened(part, column):
    return words.Words(pa.array([zlib.decompress(x).decode() for x in part.column(column).to_pylist()], pa.string()))


def _candidates(texts, length):
    """(window, at): window hashes around shared symbols, each once per text; at is the text's place in the order."""

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 128):
                part = batch.slice(first, 128)
                w = _opened(part, 1)
                start, own, symbol = window_symbols(w, length)
                cut, shared = _rows(w, start), part.column(2)
                found, owner = [np.zeros(0, np.uint64)], []
                for i in range(w.rows):
                    mine = np.sort(words.unsigned(shared[i].values.to_numpy()))
                    lo, hi = cut[i], cut[i + 1]
                    found.append(np.unique(own[lo:hi][_among(symbol[lo:hi], mine)]))
                    owner.append(len(found[-1]))
                at = np.repeat(part.column(0).to_numpy(), owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.signed(np.concatenate(found))), pa.array(at, pa.int64())], names=["window", "at"])

    return texts.select("at", "body", "symbols").mapInArrow(run, "window bigint, at bigint")


def _cleaned(texts, length):
    """(cls, removed, sha) of texts with the hashes of their windows that start earlier elsewhere."""

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 128):
                part = batch.slice(first, 128)
                w = _opened(part, 1)
                start, own = w.grams(length)
                cut, hit = _rows(w, start), part.column(2)
                gone = _repeated(w, own, cut)
                for i in range(w.rows):
                    lo, hi = cut[i], cut[i + 1]
                    gone[lo:hi] |= _among(own[lo:hi], np.sort(words.unsigned(hit[i].values.to_numpy())))
                removed, sha = _kept(w, start[gone], length)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(removed, pa.int64()), pa.array(sha)], names=["cls", "removed", "sha"])

    return texts.select("cls", "body", "windows").mapInArrow(run, "cls bigint, removed bigint, sha string")


def remove_repeats(spark, df, key="doc_id", text="text", length=20):
    """Per row: key, n_words, n_removed, kept_sha256, after removing every word of a window that starts earlier.

    A window is `length` words (runs of non-white bytes) of one text; it starts earlier in the text of a smaller key,
    or further ahead in its own. Texts of one word sequence are one class, ordered by its least key.

    1. Each task names runs and pairs level by level and emits, per text, the settled symbols of its windows.
    2. Symbols of two texts or more are shared; only windows with a shared symbol can repeat, so only these are
       hashed and grouped to find the first text of each.
    3. Texts with repeats are opened once more and cut. Repeats inside one text are found in its own task.

    Everything is grouped with partial sums or joined by equality, so a passage of a third of all texts costs
    one row per task and text. A null text or one shorter than a window is left whole. Null keys count as the
    largest; texts of one key, and of null keys, are not earlier than one another. Repeated rows get equal
    results. Other columns are not read. An empty table gives no rows.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    described = tables.store(spark, _described(rows, length), "described")
    order = described.groupBy("cls").agg(F.min("key").alias("least"))
    symbols = _symbols(rows, length)
    shared = symbols.groupBy("symbol").agg(F.count("*").alias("c")).where("c > 1").select("symbol")
    per_text = symbols.join(shared, "symbol").groupBy("cls").agg(F.collect_set("symbol").alias("symbols"))
    bodies = _bodies(rows, length).groupBy("cls").agg(F.min("body").alias("body"))
    texts = tables.store(spark, bodies.join(per_text, "cls").join(order, "cls").select(
        "cls", F.coalesce("least", F.lit(_LAST)).cast("bigint").alias("at"), "body", "symbols"), "texts")
    windows = tables.store(spark, _candidates(texts, length), "windows")
    first = windows.groupBy("window").agg(F.min("at").alias("low"), F.max("at").alias("high")).where("low < high")
    later = windows.join(first.select("window", "low"), "window").where("at > low").groupBy("at").agg(
        F.collect_set("window").alias("windows"))
    cut = tables.store(spark, _cleaned(texts.select("cls", "at", "body").join(later, "at"), length), "cut")
    found = described.join(order, "cls").join(
        cut.select("cls", F.col("removed").alias("r"), F.col("sha").alias("s")), "cls", "left")
    copy = (F.col("n") >= length) & F.col("least").isNotNull() & ~F.col("key").eqNullSafe(F.col("least"))
    return found.select(
        F.col("key").alias(key), F.col("n").alias("n_words"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("r", "removed")).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("s", "sha")).alias("kept_sha256"))
