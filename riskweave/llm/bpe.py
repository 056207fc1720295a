"""Byte-level BPE: ranked merges folded over distinct words, ids applied to whole texts."""

import array
import base64
import itertools
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm import tables, words

COMMON_WORDS = 1 << 20
COMMON_BYTES = 48
SLOTS = 1 << 19
NONE = 1 << 40
NEVER = (1 << 31) - 1
CELLS = 1 << 16  # bytes of words that are folded together, about
_FIRST, _SECOND = (40503, 1), (2654435, 7919)


def read_ranks(path):
    """Token bytes by rank from a rank file, read where the job is planned."""
    with open(path, "rb") as lines:
        return {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}


def _numbers(values):
    return F.from_json(F.lit(json.dumps(values, separators=(",", ":"))), "array<bigint>")


class Merges:
    """Ranks of neighbouring tokens in arrays of a fixed size, and the fold of ranked merges over a batch of words.

    The rank of a token is also its id, so for ids (a, b) the arrays have the id of their joined bytes: every way to
    cut a token in two tokens is an entry. `slots` has an entry (a, b, id) in one of two places given by hashes of
    (a, b). Two single bytes, which every word begins with, are looked up in `pairs` by their values, `bytes` has
    the ids of single bytes.
    """

    def __init__(self, tokens):
        ids = {token: rank for rank, token in tokens.items()}
        self.edge = max(tokens) + 1  # stands at both ends of a word and joins with nothing
        self.size = max(tokens) + 2
        slots = array.array("q", [-1]) * SLOTS  # numbers and no tuples, for the driver's memory
        for token, rank in ids.items():
            for cut in range(1, len(token)):
                a, b = ids.get(token[:cut]), ids.get(token[cut:])
                if a is not None and b is not None:
                    self._place(slots, a, b, rank)
        self.slots = np.frombuffer(slots, dtype=np.int64)
        self.bytes = np.array([ids[bytes([i])] for i in range(256)], dtype=np.int32)
        self.pairs = np.array([ids.get(bytes([a, b]), NEVER) for a in range(256) for b in range(256)], dtype=np.int32)

    def _packed(self, a, b, rank):
        return (a * self.size + b) << 20 | rank

    def _place(self, slots, a, b, rank):
        entry, (x, y) = self._packed(a, b, rank), _FIRST
        for _ in range(500):
            a, b = divmod(entry >> 20, self.size)
            at = (a * x + b * y) % SLOTS
            entry, slots[at] = slots[at], entry
            if entry < 0:
                return
            a, b = divmod(entry >> 20, self.size)
            x, y = _SECOND if (a * _FIRST[0] + b * _FIRST[1]) % SLOTS == at else _FIRST
        raise ValueError("the rank map needs more slots")

    def rank(self, a, b):
        """Rank of each a joined with its b, NEVER where they do not join."""
        key = a * np.int64(self.size) + b
        out = np.full(len(key), NEVER, dtype=np.int32)
        for x, y in (_FIRST, _SECOND):
            entry = self.slots[(a * np.int64(x) + b * np.int64(y)) & (SLOTS - 1)]
            np.copyto(out, entry & ((1 << 20) - 1), where=(entry >> 20) == key, casting="unsafe")
        return out

    def fold(self, column):
        """(ids one after the other, how many each word has) of an array of words without nulls.

        Words of about the same length are folded together in blocks of CELLS bytes, a longer word alone.
        """
        column = column.cast(pa.large_string())
        count = len(column)
        bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + count + 1] if count else np.zeros(1, np.int64)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
        length = np.diff(bounds)
        order = np.argsort(length, kind="stable")
        found, sizes, first = [np.zeros(0, dtype=np.int32)], np.zeros(count, dtype=np.int64), 0
        while first < count:
            # the block's first word is its shortest: as many as fit at that length, then as many as fit at the longest of these
            last = first + max(1, CELLS // (int(length[order[first]]) + 2))
            last = first + max(1, CELLS // (int(length[order[min(last, count) - 1]]) + 2))
            block = order[first:last]
            ids, sizes[block] = self._fold_block(data, bounds[block], length[block])
            found.append(ids)
            first += len(block)
        begin = np.empty(count, dtype=np.int64)
        begin[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate(found)[expanded(begin, sizes)[0]], sizes

    def _fold_block(self, data, begins, lengths):
        """Each step merges the lowest-ranked, leftmost pair of every word that has one. A token stands at the place of
        its first byte and knows the places of its neighbours; only the two ranks beside a merge change."""
        count, stride = len(lengths), int(lengths.max()) + 2
        start = np.arange(count, dtype=np.int64) * stride
        at, _ = expanded(start + 1, lengths)
        of = data[expanded(begins, lengths)[0]]
        ids = np.full(count * stride, self.edge, dtype=np.int32)
        ids[at] = self.bytes[of]
        ranks = np.full(count * stride, NEVER, dtype=np.int32)
        two = np.flatnonzero(np.diff(at) == 1)
        ranks[at[two]] = self.pairs[of[two].astype(np.int32) * 256 + of[two + 1]]
        after = np.arange(1, count * stride + 1, dtype=np.int64)
        before = after - 2
        table, live = ranks.reshape(count, stride), np.arange(count)
        while True:
            p = start[live] + (table if len(live) == count else table[live]).argmin(axis=1)
            low = ranks[p]
            some = low != NEVER
            if not some.all():
                live, p, low = live[some], p[some], low[some]
            if not len(live):
                break
            gone, left = after[p], before[p]
            right = after[gone]
            ids[p], ids[gone], ranks[gone] = low, -1, NEVER
            after[p], before[right] = right, p
            ranks[p], ranks[left] = self.rank(low, ids[right]), self.rank(ids[left], low)
        kept = (ids >= 0) & (ids != self.edge)
        return ids[kept], kept.reshape(count, stride).sum(axis=1)


class RankMap:
    """The tables of `Merges` as literals of Spark expressions.

    They come from JSON constants that the optimizer folds once and ships with the task, which costs the driver
    many times their size: for a column of words without Python; `encode` folds by `Merges` itself.
    """

    def __init__(self, tokens):
        merges = Merges(tokens)
        self.edge, self.size = merges.edge, merges.size
        # in short texts, so that neither half of the driver holds a long one
        self.slots = F.concat(*[_numbers(merges.slots[i:i + (1 << 14)].tolist()) for i in range(0, SLOTS, 1 << 14)])
        self.bytes = _numbers(merges.bytes.tolist())
        self.pairs = _numbers([None if x == NEVER else x for x in merges.pairs.tolist()])

    def rank(self, slots, a, b):
        key = a * self.size + b
        place = lambda m: F.get(slots, (a * m[0] + b * m[1]).bitwiseAND(F.lit(SLOTS - 1)))
        first, second = place(_FIRST), place(_SECOND)
        value = lambda e: e.bitwiseAND(F.lit((1 << 20) - 1))
        return F.when(F.shiftright(first, 20) == key, value(first)).when(
            F.shiftright(second, 20) == key, value(second)).otherwise(F.lit(NONE))


def _let(value, body):
    return F.get(F.transform(F.array(value), body), 0)


def merged_ids(word, ranks):
    """Token ids of a word: a fold over its bytes that merges the lowest-ranked, leftmost pair at each step.

    State: `p`, the ids with an edge at both ends, and `r`, the rank of each id joined with the next. Only
    the two ranks beside a merge change. Once no pair has a rank, the remaining steps keep the state.
    """
    return _let(ranks.slots, lambda slots: _fold(word, ranks, slots))


def _fold(word, ranks, slots):
    rank = lambda a, b: ranks.rank(slots, a, b)
    latin = F.decode(F.encode(word, "utf-8"), "ISO-8859-1")
    first = F.transform(F.split(latin, ""), F.ascii)
    edge, none = F.lit(ranks.edge).cast("bigint"), F.lit(NONE)
    start = _let(first, lambda b: F.struct(
        F.concat(F.array(edge), F.transform(b, lambda x: F.get(ranks.bytes, x)), F.array(edge)).alias("p"),
        F.concat(F.array(none), F.zip_with(b, F.slice(b, 2, F.size(b)),
            lambda x, y: F.coalesce(F.get(ranks.pairs, x * 256 + y), none))).alias("r")))

    def merge(s, low, at):
        p, r = s["p"], s["r"]
        return F.struct(
            F.concat(F.slice(p, 1, at - 1), F.array(low), F.slice(p, at + 2, F.size(p))).alias("p"),
            F.concat(F.slice(r, 1, at - 2), F.array(rank(F.get(p, at - 2), low), rank(low, F.get(p, at + 1))),
                     F.slice(r, at + 2, F.size(r))).alias("r"))

    def step(s, _):
        return _let(F.array_min(s["r"]), lambda low: F.when(low == NONE, s).otherwise(
            _let(F.array_position(s["r"], low).cast("int"), lambda at: merge(s, low, at))))

    steps = F.sequence(F.lit(1), F.greatest(F.octet_length(word) - 1, F.lit(1)))
    return F.aggregate(steps, start, step, lambda s: F.slice(s["p"], 2, F.size(s["p"]) - 2)).cast(
        "array<int>")


FIRST = "\0"
_ASCII_WHITE = np.zeros(256, dtype=bool)
_ASCII_WHITE[[*range(9, 14), *range(28, 33)]] = True


def odd_rows(column):
    """Rows of a string array in which a space meets another white character, or that have a white character
    beyond ASCII or a null byte."""
    column = column.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[bounds[0]:bounds[-1]] if raw is not None else np.zeros(0, dtype=np.uint8)
    if len(data) < 3:
        return np.ones(len(column), dtype=bool)
    space, white = data == 32, _ASCII_WHITE[data]
    odd = data == 0
    odd[1:] |= (space[1:] & white[:-1]) | (white[1:] & space[:-1])
    odd[1:] |= (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
    a, b, c = data[:-2], data[1:-1], data[2:]
    lead = np.flatnonzero((a == 0xE1) | (a == 0xE2) | (a == 0xE3))
    b, c = b[lead], c[lead]
    wide = ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)) | (
        (b == 0x9A) & (c == 0x80))
    odd[lead[wide]] = True
    hits = np.concatenate(([0], np.cumsum(odd)))[bounds - bounds[0]]
    return np.diff(hits) > 0


def chunked(column):
    """(chunks, stops): texts cut before every space that stands alone, the space left out, first chunks marked.

    No match of the split pattern goes over a space between two characters that are not white, so chunks can be
    split apart from each other, or joined by spaces in any order. A text in which white characters meet
    a space is one chunk.
    """
    chunks, stops = [], [0]
    for text, odd in zip(column.to_pylist(), odd_rows(column).tolist()):
        parts = [text or ""] if odd else (text or "").split(" ")
        parts[0] = FIRST + parts[0]
        chunks += parts
        stops.append(len(chunks))
    return chunks, stops


def split_chunks(chunks, split):
    """(words, begins, counts) of distinct chunks: plain ones in one go, joined by spaces, of which each starts a chunk."""
    plain = np.array([c != "" and c[0] != FIRST for c in chunks], dtype=bool)
    found = split(" " + " ".join(itertools.compress(chunks, plain.tolist()))) if plain.any() else []
    begins = pa.compute.starts_with(pa.array(found, pa.string()), " ").to_numpy(zero_copy_only=False)
    count = np.zeros(len(chunks), dtype=np.int64)
    count[plain] = np.diff(np.append(np.flatnonzero(begins), len(found)))
    special = [split(chunks[i][1:] if chunks[i] else " ") for i in np.flatnonzero(~plain)]
    count[~plain] = [len(x) for x in special]
    # plain chunks first, then the others: where each chunk's words begin
    order = np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain)))
    begin = np.empty(len(chunks), dtype=np.int64)
    begin[order] = np.cumsum(count[order]) - count[order]
    return found + list(itertools.chain.from_iterable(special)), begin, count


def expanded(begin, size, code=None):
    """(positions, stops): the ranges begin..begin+size one after the other, those of `code` if given."""
    if code is not None:
        begin, size = begin[code], size[code]
    stop = np.concatenate(([0], np.cumsum(size)))
    return np.repeat(begin - stop[:-1], size) + np.arange(stop[-1]), stop


def _lists(stops, values):
    return pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(values, pa.int32()))


def release():
    """Give back what Arrow keeps of arrays that are gone: beside the JVM's memory it counts in a driver's."""
    pa.default_memory_pool().release_unused()


class Known:
    """Words with known ids, as shipped to tasks: arrays in the order of the words' hashes, found by bisection.

    The entry after the last has the one id -1 and stands for a word that is not known.
    """

    def __init__(self, table):
        """`table` is a list of one table, which is taken out of it: what is put in order is held once, and let go column by column."""
        table = table.pop()
        made = table.num_rows > 0
        names = table.column("word").combine_chunks() if made else pa.array([], pa.string())
        lists = table.column("ids").combine_chunks() if made else pa.array([], pa.list_(pa.int32()))
        del table
        release()
        hashes = words.string_hashes(names)
        order = np.argsort(hashes, kind="stable")
        self.hashes, order = hashes[order], pa.array(order)
        del hashes
        self.words = names.take(order)
        del names
        release()
        lists = lists.take(order)
        del order
        release()
        self.ids = np.append(lists.flatten().to_numpy(), np.int32(-1)).astype(np.int32, copy=False)
        sizes = np.asarray(pa.compute.list_value_length(lists), dtype=np.int32)
        del lists
        release()
        self.sizes = np.append(sizes, np.int32(1)).astype(np.int32, copy=False)
        self.begins = np.cumsum(self.sizes, dtype=np.int32) - self.sizes

    def find(self, found):
        """Place of every word of a list."""
        n = len(self.hashes)
        if not n or not found:
            return np.full(len(found), n, dtype=np.int64)
        column = pa.array(found, pa.string())
        hashes = words.string_hashes(column)
        at = np.minimum(np.searchsorted(self.hashes, hashes), n - 1)
        same = self.hashes[at] == hashes
        same &= pa.compute.equal(column, self.words.take(pa.array(at))).to_numpy(zero_copy_only=False)
        return np.where(same, at, n)


def word_counts(df, text, pattern):
    """How often each word occurs in all texts, words of one occurrence left out."""
    parts = df.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), 0)).alias("word"))
    return parts.groupBy("word").agg(F.count("*").alias("n")).where("n > 1")


def common_words(spark, df, text, pattern, most, longest):
    """At most `most` of the most frequent words of at most `longest` bytes: the bound of what is broadcast."""
    counts = tables.store(spark, word_counts(df, text, pattern).where(F.octet_length("word") <= longest), "words")
    levels = sorted(((r.n, r.k) for r in counts.groupBy("n").agg(F.count("*").alias("k")).collect()), reverse=True)
    least, total = levels[0][0] + 1 if levels else 1, 0
    for n, k in levels:
        total += k
        if total > most:
            break
        least = n
    return counts.where(F.col("n") >= least)


def encode(spark, df, tokens, pattern, key="doc_id", text="text", most=COMMON_WORDS, longest=COMMON_BYTES):
    """(key, ids, decoded) of every row: token ids of the whole text and the bytes they stand for.

    The words of all texts are counted; the most frequent ones (at most `most`, of at most `longest`
    bytes, so the broadcast has a fixed bound) are encoded once each by the fold and shipped to the tasks.
    Texts are split by `pattern`; a word that was not shipped is encoded by the same fold, once in about a megabyte of
    texts. The ids are then put in order and decoded by joining the bytes of each. Nothing but word counts is shuffled.

    A null text counts as empty and has no ids. Null and repeated keys pass through; other columns are not
    read. An empty table gives no rows. A very long word costs time by its square, never memory beyond it.
    """
    tables.short_batches(spark)
    tables.short_plans(spark)
    merges = spark.sparkContext.broadcast(Merges(tokens))
    small = common_words(spark, df.select(F.col(text).alias("text")), "text", pattern, most, longest)

    def fold(batches):
        for batch in batches:
            ids, sizes = merges.value.fold(batch.column(0))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(np.concatenate(([0], np.cumsum(sizes))), ids)], names=["word", "ids"])

    known = spark.sparkContext.broadcast(Known([small.select("word").mapInArrow(fold, "word string, ids array<int>").toArrow()]))
    pieces = spark.sparkContext.broadcast(pa.array([tokens.get(i, b"") for i in range(max(tokens) + 1)], pa.binary()))
    release()  # a driver has other stages to run
    picked = df.select(F.col(key).alias("_k"), F.col(text).alias("_t"))
    kind = picked.schema["_k"].dataType
    out = T.StructType([
        T.StructField(key, kind), T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.BinaryType())])

    def lookup(batches):
        """Ids of the words of a slice at once, worked out per distinct chunk: shipped words are found, each other word is
        folded once."""
        import regex

        split, token = regex.compile(pattern).findall, pieces.value
        find, ids, begins, sizes = known.value.find, known.value.ids, known.value.begins, known.value.sizes
        for batch in batches:
            for part in words.slices(batch, 1, 1 << 20):
                chunks, row_at = chunked(part.column(1))
                coded = pa.array(chunks, pa.string()).dictionary_encode()
                code = coded.indices.to_numpy()
                found, first, count = split_chunks(coded.dictionary.to_pylist(), split)
                at = find(found)
                rare = np.flatnonzero(at == len(sizes) - 1)
                rare_words = pa.array([found[i] for i in rare.tolist()], pa.string()).dictionary_encode()
                folded, folded_sizes = merges.value.fold(rare_words.dictionary)
                of = rare_words.indices.to_numpy()
                begin, size = begins[at].astype(np.int64), sizes[at].astype(np.int64)
                begin[rare], size[rare] = (len(ids) + np.cumsum(folded_sizes) - folded_sizes)[of], folded_sizes[of]
                place, stops = expanded(begin, size)  # in the shipped ids, or beyond them in the folded ones
                flat, beyond = ids.take(place, mode="clip"), place >= len(ids)
                flat[beyond] = folded[place[beyond] - len(ids)]
                token_at, token_ends = expanded(stops[first], stops[first + count] - stops[first], code)
                flat, offsets = flat[token_at], token_ends[row_at]
                joined = token.take(pa.array(flat))
                ends = np.frombuffer(joined.buffers()[1], dtype=np.int32)[joined.offset:joined.offset + len(joined) + 1] if len(
                    joined) else np.zeros(1, dtype=np.int32)
                decoded = pa.Array.from_buffers(pa.binary(), len(part), [
                    None, pa.py_buffer(ends[offsets].astype(np.int32).tobytes()), joined.buffers()[2]])
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(offsets, flat), decoded], names=[key, "ids", "decoded"])

    return picked.mapInArrow(lookup, out)
