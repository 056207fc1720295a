"""Alignment of two tokenizers over the same texts: token intervals coalesced where both end together."""

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm import bpe, tables, words

CACHED = 1 << 18  # stretches of text whose ids a task keeps
LONE = re.compile(r"(?<=\S) (?=\S)")
COMMON_PAIRS = 1 << 20
SHIFT = 1 << 21  # a pair of ids as one number: a * SHIFT + b
PAIR_BITS = 42


def byte_alphabet():
    """Character that stands for each byte in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE vocabulary file; it encodes a space and the text.

    `apart`: a stretch of text after a lone space has the ids it has by itself, as no match of the split pattern of
    such vocabularies goes over a space between two characters that are not white.
    """

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model, self.apart = Tokenizer.from_file(path), True
        self.model.encode_special_tokens = True

    def encode(self, texts):
        return [e.ids for e in self.model.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def bytes(self):
        made, alphabet = [b""] * self.model.get_vocab_size(), byte_alphabet()
        for token, i in self.model.get_vocab().items():
            known = [alphabet.get(c) for c in token]
            made[i] = token.encode() if None in known else bytes(known)
        return made


class Pieces:
    """A sentence piece model with byte fallback; it puts a space before the text by itself.

    `apart` where no piece holds a space after another character: then no merge goes over a lone space.
    """

    def __init__(self, path):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.apart = not any("▁" in piece.lstrip("▁") for piece in pieces)

    def encode(self, texts):
        return self.model.encode(texts, num_threads=1)

    def bytes(self):
        model = self.model
        return [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
                else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())]


def stretches(column):
    """(stretches, stops): texts cut at every space between two characters that are not white, the space left out."""
    made, stops = [], [0]
    for text, odd in zip(column.to_pylist(), bpe.odd_rows(column).tolist()):
        if text:
            made += LONE.split(text) if odd or text[0] == " " or text[-1] == " " else text.split(" ")
        stops.append(len(made))
    return made, np.array(stops)


TOGETHER = 2000  # stretches encoded as one text


def encoded(make, sizes, made):
    """(ids, stops) of stretches. Those without white space at their ends are joined by lone spaces and encoded together.

    Every stretch ends where a token ends, so the bytes of the tokens show which are whose. Where the bytes are not those
    of the text, each of its stretches is encoded by itself.
    """
    ids, counts = [], np.zeros(len(made), dtype=np.int64)
    whole = [i for i, c in enumerate(made) if c and not c[0].isspace() and not c[-1].isspace()]
    inside, alone = set(whole), []
    alone += [i for i in range(len(made)) if i not in inside]
    parts = [whole[a:a + TOGETHER] for a in range(0, len(whole), TOGETHER)]
    texts = [" ".join([made[i] for i in part]) for part in parts]
    order = []
    for part, text, found in zip(parts, texts, make.encode(texts) if texts else []):
        found, raw = np.array(found, dtype=np.int32), text.encode()
        ends = np.cumsum(sizes.size[found])
        if sizes.joined(found).tobytes() != b" " + raw:
            alone += part
            continue
        stops = np.searchsorted(ends, np.cumsum([len(made[i].encode()) + 1 for i in part])) + 1
        counts[part] = np.diff(stops, prepend=0)
        ids.append(found)
        order += part
    for i, found in zip(alone, make.encode([made[i] for i in alone]) if alone else []):
        counts[i] = len(found)
        ids.append(np.array(found, dtype=np.int32))
    order = np.array(order + alone, dtype=np.int64)
    joined = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
    begins = np.empty(len(made), dtype=np.int64)
    begins[order] = np.cumsum(counts[order]) - counts[order]
    places, stops = bpe.expanded(begins, counts)
    return joined[places], stops


class Cached:
    """Ids of stretches; the first ones, CACHED at most, are kept and not encoded again."""

    def __init__(self, make, sizes):
        self.make, self.sizes, self.place = make, sizes, {}
        self.ids, self.stops = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def lists(self, distinct):
        """(ids, begins, sizes) of a list of distinct stretches; those that come when the place is full are not kept."""
        at = np.fromiter((self.place.get(c, -1) for c in distinct), dtype=np.int64, count=len(distinct))
        missing = np.flatnonzero(at < 0)
        new = [distinct[i] for i in missing.tolist()]
        ids, stops = encoded(self.make, self.sizes, new)
        all_ids, all_stops = np.concatenate((self.ids, ids)), np.concatenate((self.stops, stops[1:] + self.stops[-1]))
        at[missing] = len(self.stops) - 1 + np.arange(len(new))
        if len(self.place) + len(new) <= CACHED:
            self.place.update(zip(new, at[missing].tolist()))
            self.ids, self.stops = all_ids, all_stops
        return all_ids, all_stops[at], all_stops[at + 1] - all_stops[at]

    def encode(self, coded, stops):
        """(ids, stops) of texts given as codes of distinct stretches."""
        ids, begins, sizes = self.lists(coded.dictionary.to_pylist())
        places, ends = bpe.expanded(begins, sizes, coded.indices.to_numpy())
        return ids[places], ends[stops]


class Sizes:
    """Bytes of every token of a vocabulary, and the bytes that a list of ids stands for."""

    def __init__(self, made):
        self.pieces = pa.array(made, pa.large_binary())
        self.size = np.array([len(x) for x in made], dtype=np.int64)

    def joined(self, ids):
        return np.frombuffer(self.pieces.take(pa.array(ids)).buffers()[2] or b"", dtype=np.uint8)[:int(self.size[ids].sum())]


def flat(lists):
    """(all ids, stops) of lists of ids."""
    stops = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64)))
    return np.fromiter((i for x in lists for i in x), dtype=np.int32, count=int(stops[-1])), stops


def same_bytes(vocabulary, ids, stops, texts):
    """Whether the bytes of each row's ids are a space and its text."""
    total = np.concatenate(([0], np.cumsum(vocabulary.size[ids])))
    lengths = total[stops[1:]] - total[stops[:-1]]
    data, at, right = vocabulary.joined(ids).tobytes(), 0, []
    for text, length in zip(texts, lengths.tolist()):
        right.append(length == len(text) + 1 and data[at:at + length] == b" " + text)
        at += length
    return right


class Overlaps:
    """Coalesced intervals of the tokens of many texts laid one after the other.

    All A and B tokens are sorted by start, ends are accumulated to their running maximum, and a group begins where a
    start reaches it. `a` and `b` are the token positions of every overlapping pair, which is always inside a group.
    """

    def __init__(self, size_a, size_b):
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        start_a, start_b = end_a - size_a, end_b - size_b
        start, end = np.concatenate((start_a, start_b)), np.concatenate((end_a, end_b))
        order = np.lexsort((start,))  # two sorted runs, which are merged
        start, end = start[order], end[order]
        reach = np.maximum.accumulate(end)
        begins = np.ones(len(start), dtype=bool)
        begins[1:] = start[1:] >= reach[:-1]
        group = np.empty(len(start), dtype=np.int64)
        group[order] = np.cumsum(begins) - 1
        self.group_a, self.group_b = group[:len(size_a)], group[len(size_a):]
        self.groups = int(begins.sum())
        # the tokens of B are in order and without gaps, so those that meet a token of A are a range
        first = np.searchsorted(end_b, start_a, side="right")
        count = np.searchsorted(start_b, end_a, side="left") - first
        self.a = np.repeat(np.arange(len(size_a)), count)
        stop = np.cumsum(count)
        self.b = np.arange(int(stop[-1]) if len(stop) else 0) - np.repeat(stop - count, count) + np.repeat(first, count)


class Written:
    """Groups as text `a1,a2|b1;a3|b2,b3`: ids are taken from ready strings with what follows them."""

    def __init__(self, size_a, size_b):
        self.a, self.b = size_a, size_b
        ends = [(size_a, ","), (size_a, "|"), (size_b, ","), (size_b, ";"), (size_b, "")]
        self.strings = pa.array([f"{i}{end}" for n, end in ends for i in range(n)], pa.large_string())

    def digests(self, ids_a, ids_b, row_a, row_b, met, rows):
        n = len(ids_a) + len(ids_b)
        before_b = np.concatenate(([0], np.cumsum(np.bincount(met.group_b, minlength=met.groups))))
        before_a = np.concatenate(([0], np.cumsum(np.bincount(met.group_a, minlength=met.groups))))
        at_a = np.arange(len(ids_a)) + before_b[met.group_a]
        at_b = np.arange(len(ids_b)) + before_a[met.group_b + 1]
        last = lambda group: np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, dtype=bool)
        code = np.empty(n, dtype=np.int64)
        code[at_a] = ids_a + np.where(last(met.group_a), self.a, 0)
        code[at_b] = 2 * self.a + ids_b + np.where(last(row_b), 2 * self.b, np.where(last(met.group_b), self.b, 0))
        text = self.strings.take(pa.array(code))
        stops = np.frombuffer(text.buffers()[1], dtype=np.int64)[:n + 1]
        data = memoryview(text.buffers()[2] or b"")
        per_row = np.bincount(row_a, minlength=rows) + np.bincount(row_b, minlength=rows)
        ends = np.concatenate(([0], np.cumsum(per_row)))
        return ["" if a == b else hashlib.sha256(data[stops[a]:stops[b]]).hexdigest()
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def width(size):
    """Type of the ids of a vocabulary of that size where they are stored."""
    return np.dtype(np.uint16 if size <= 1 << 16 else np.int32)


def packed(ids, stops, kind):
    """Lists of ids as an array of binary values, which Spark moves whole and not number by number."""
    ends, data = stops * kind.itemsize, np.ascontiguousarray(ids, dtype=kind)
    return pa.Array.from_buffers(pa.large_binary(), len(stops) - 1, [
        None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def unpacked(column, kind):
    """(all ids, number of each list) of `packed` lists."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[ends[0]:ends[-1]] if raw is not None else np.zeros(0, dtype=np.uint8)
    return data.view(kind).astype(np.int64), np.diff(ends) // kind.itemsize


def tokenized(df, first, second, key, text):
    """(key, a, b): ids of every whole text by both tokenizers, packed; none where their bytes are not a space and the text."""
    kind = df.select(F.col(key).alias("k")).schema["k"].dataType
    out = T.StructType([T.StructField("k", kind), T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])

    def encode(batches):
        make = (first(), second())
        known = [Sizes(m.bytes()) for m in make]
        cached = [Cached(m, sizes) for m, sizes in zip(make, known)]
        for batch in batches:
            for part in words.slices(batch, 1):
                texts = [t or "" for t in part.column(1).to_pylist()]
                raw = [t.encode() for t in texts]
                cut, ends = stretches(part.column(1))
                coded = pa.array(cut, pa.large_string()).dictionary_encode()
                right, found = np.array([len(t) > 0 for t in raw], dtype=bool), []
                for m, vocabulary, cache in zip(make, known, cached):
                    ids, stops = cache.encode(coded, ends) if m.apart else flat(m.encode(texts))
                    right &= np.array(same_bytes(vocabulary, ids, stops, raw), dtype=bool)
                    found.append((ids, stops))
                cols = []
                for (ids, stops), vocabulary in zip(found, known):
                    if not right.all():
                        sizes = np.diff(stops)
                        ids, sizes = ids[np.repeat(right, sizes)], np.where(right, sizes, 0)
                        stops = np.concatenate(([0], np.cumsum(sizes)))
                    cols.append(packed(ids, stops, width(len(vocabulary.size))))
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], names=["k", "a", "b"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(encode, out)


def parts_of(batch, kind, limit=1 << 17):
    """Row slices of a batch of id lists with about `limit` tokens of A, which are of type `kind`, one row at least."""
    sizes = pc.binary_length(batch.column("a")).to_numpy(zero_copy_only=False) // kind.itemsize
    total, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


class Linked:
    """Id lists of a slice with their overlaps."""

    def __init__(self, part, size_a, size_b):
        self.rows = part.num_rows
        (self.a, count_a), (self.b, count_b) = (
            unpacked(part.column(c), width(len(size))) for c, size in (("a", size_a), ("b", size_b)))
        self.counts = [count_a, count_b]
        self.row_a, self.row_b = (np.repeat(np.arange(self.rows), n) for n in self.counts)
        self.met = Overlaps(size_a[self.a], size_b[self.b])
        self.row = self.row_a[self.met.a]
        self.pair = self.a[self.met.a] * SHIFT + self.b[self.met.b]

    def distinct(self):
        """(row, pair, times) of the distinct pairs of every row."""
        keys = np.sort((self.row << PAIR_BITS) | self.pair)  # a slice has fewer than 2^20 rows
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
        return keys[at] >> PAIR_BITS, keys[at] & ((1 << PAIR_BITS) - 1), np.diff(np.append(at, len(keys)))


def pair_counts(spark, tokens, size_a, size_b):
    """(pair, n, best): in how many rows a pair of ids is linked, and whether no pair of its A id is in more."""

    def count(batches):
        for batch in batches:
            for part in parts_of(batch, width(len(size_a.value))):
                pair, n = np.unique(Linked(part, size_a.value, size_b.value).distinct()[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    counted = tables.store(spark, tokens.select("a", "b").mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(
        F.sum("n").alias("n")), "pairs")
    first = F.expr(f"pair div {SHIFT}")
    highest = counted.groupBy(first.alias("first")).agg(F.max("n").alias("most"))  # one row for each A id
    return tables.store(spark, counted.withColumn("first", first).join(highest, "first").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def frequent_pairs(counted, most):
    """At most `most` of the pairs in the most rows, sorted by pair: what is shipped. Returns them and the least count."""
    from riskweave.llm import lexicon

    least = lexicon.least_count(counted, most)
    chosen = counted.where(F.col("n") >= int(least)) if least is not None else counted.limit(0)
    table = chosen.select("pair", "n", "best").toArrow().combine_chunks()
    cols = [table.column(c).to_numpy() if table.num_rows else np.zeros(0, np.int64) for c in ("pair", "n", "best")]
    order = np.argsort(cols[0], kind="stable")
    return [c[order] for c in cols], least


def align(spark, df, first, second, key="doc_id", text="text", common=COMMON_PAIRS):
    """Groups and links of the tokens of two tokenizers over every whole text.

    `first` and `second` make the tokenizers A and B inside a task: `encode(texts)` and `bytes()`, the bytes of each id.
    Returns key, n_a, n_b, n_groups (stretches between byte offsets where a token of A and one of B end), n_links (pairs
    of tokens whose bytes overlap), n_best (links whose pair of ids is linked in no fewer rows than any other of
    its A id), count_sum (rows that hold a link's pair, summed over links), groups_sha256.

    Texts are encoded once and their ids written to the shared folder. Pairs of ids are counted in their tasks before
    they are shuffled; the `common` most frequent are shipped (a bounded broadcast) and looked up where their links
    are; those left over meet their counts in a join by pair and go back to their row as one sum. No text is shuffled.

    Texts that are null, empty, or of which a tokenizer gives other bytes than a space and the text, have no tokens:
    zeros and an empty groups_sha256. Null and repeated keys pass through, each row counts as a document of its own. Ties
    for the highest count are all best. An empty table gives no rows; other columns are not read. A very long text
    costs memory in proportion to its length, in one task.
    """
    tables.short_batches(spark)
    tokens = tables.store(spark, tokenized(df, first, second, key, text).withColumn(
        "row", F.monotonically_increasing_id()), "tokens")
    made = [np.array([len(x) for x in m().bytes()], dtype=np.int64) for m in (first, second)]
    size_a, size_b = (spark.sparkContext.broadcast(x) for x in made)
    counted = pair_counts(spark, tokens, size_a, size_b)
    chosen, least = frequent_pairs(counted, common)
    known = spark.sparkContext.broadcast(chosen)
    kind = tokens.schema["k"].dataType
    names = ["row", "k", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "rest"]
    rest = T.ArrayType(T.StructType([T.StructField("pair", T.LongType()), T.StructField("times", T.LongType())]))
    out = T.StructType([T.StructField("row", T.LongType()), T.StructField("k", kind),
                        *[T.StructField(n, T.LongType()) for n in names[2:8]],
                        T.StructField("groups_sha256", T.StringType()), T.StructField("rest", rest)])

    def look(batches):
        pairs, n, best = known.value
        writer = Written(len(size_a.value), len(size_b.value))
        for batch in batches:
            for part in parts_of(batch, width(len(size_a.value))):
                x = Linked(part, size_a.value, size_b.value)
                row, pair, times = x.distinct()
                at = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
                hit = pairs[at] == pair if len(pairs) else np.zeros(len(pair), dtype=bool)
                at = at[hit]
                total = lambda r, w: np.bincount(r, weights=w, minlength=x.rows).astype(np.int64)
                sums = np.concatenate(([0], np.cumsum(n[at] * times[hit], dtype=np.int64)))  # rows are in order
                exact = np.diff(sums[np.searchsorted(row[hit], np.arange(x.rows + 1))])
                groups = np.zeros(x.rows, dtype=np.int64)
                if len(x.row_a):
                    new = np.append(True, x.met.group_a[1:] != x.met.group_a[:-1])
                    groups = np.bincount(x.row_a[new], minlength=x.rows)
                left = ~hit
                stops = np.concatenate(([0], np.cumsum(np.bincount(row[left], minlength=x.rows))))
                others = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(pair[left]), pa.array(times[left].astype(np.int64))], names=["pair", "times"]))
                yield pa.RecordBatch.from_arrays([
                    part.column("row"), part.column("k"), pa.array(x.counts[0]), pa.array(x.counts[1]), pa.array(groups),
                    pa.array(np.bincount(x.row, minlength=x.rows)), pa.array(total(row[hit], best[at] * times[hit])),
                    pa.array(exact), pa.array(writer.digests(x.a, x.b, x.row_a, x.row_b, x.met, x.rows)), others],
                    names=names)

    found = tables.store(spark, tokens.select("row", "k", "a", "b").mapInArrow(look, out), "aligned")
    others = counted.where(F.col("n") < int(least)) if least is not None else counted
    more = found.select("row", F.inline("rest")).join(others, "pair").groupBy("row").agg(
        F.sum(F.col("n") * F.col("times")).alias("_sum"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"))
    done = found.drop("rest").join(more, "row", "left")
    plus = lambda c, d: (F.col(c) + F.coalesce(F.col(d), F.lit(0))).alias(c)
    return done.select(F.col("k").alias(key), "n_a", "n_b", "n_groups", "n_links", plus("n_best", "_best"),
                       plus("count_sum", "_sum"), "groups_sha256")
