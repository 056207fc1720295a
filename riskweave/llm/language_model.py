"""Log-likelihood of whole texts under a gated recurrent language model trained on the corpus by averaged passes.

The network predicts classes: the end of a text, the most frequent words in classes of their own, and bands of rarer
words by how often they occur. Inside a band the counts of the whole corpus share out the probability, so the
vocabulary has no bound and every known word, and the unknown one, has a probability.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import session
from riskweave.llm import gru, lexicon, tables, words

HEAD, SIDE, HIDDEN, WIDTH = 1024, 32, 16, 16
KNOWN = 1 << 17  # words whose counts are shipped
ROUNDS = 7  # passes between which parameters are averaged; the last has half of the texts, each before it half of the next
CHUNK = 1 << 21  # tokens that a task trains on at once
JUDGED = 1 << 20  # tokens that a task scores at once, about
BLOCK, FAN = 1 << 14, 256
LOG10 = np.log(10.0)


def held_out(key):
    """Texts that are scored and not learnt from; a null key is learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 7 == 2, F.lit(False))


def band(n):
    """Band of a count: 0 up to one, else the whole part of its binary logarithm."""
    return np.frexp(np.maximum(n, 1).astype(np.float64))[1] - 1


class Bands:
    """Natural logarithm of a word's probability inside its band.

    `words[b]` and `sums[b]` are the words of band b and their occurrences. Band 0 holds words seen once and the
    unknown word. Of what falls there the unknown word gets the share of once-seen words among those that would be in
    band 0 if one of their occurrences were left out.
    """

    def __init__(self, known, sums, once, twice):
        self.known, self.sums = np.asarray(known, dtype=np.float64), np.asarray(sums, dtype=np.float64)
        self.unknown = (once + 1) / (once + 2 * twice + 2) if self.known[0] else 1.0

    def inside(self, n):
        b = np.minimum(band(n), len(self.sums) - 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            out = np.log(n / self.sums[b])
            rare = np.where(n == 0, np.log(self.unknown), np.log((1 - self.unknown) / self.known[0]))
        return np.where(b == 0, rare, out)


class Counts:
    """What the corpus says: words with counts on the driver as far as they are shipped, bands of the others, totals."""

    def __init__(self, counted, docs, head, known):
        shipped = lexicon.frequent(counted, known)
        self.names, self.n = shipped.column("word").combine_chunks(), shipped.column("n").to_numpy().astype(np.int64)
        self.least = int(self.n.min()) if len(self.n) else None
        self.head = min(head, len(self.n))
        exponent = F.floor(F.log2(F.col("n")) + 1e-9).cast("int")
        rows = counted.groupBy(exponent.alias("b")).agg(F.count("*").alias("k"), F.sum("n").alias("s"),
                                                        F.count_if(F.col("n") == 2).alias("two")).collect()
        size = max([r.b for r in rows], default=0) + 1
        kinds, sums, twice = np.zeros(size), np.zeros(size), 0
        for r in rows:
            kinds[r.b], sums[r.b], twice = r.k, r.s, twice + r.two
        self.total, self.distinct = int(sums.sum()) + docs, int(kinds.sum()) + (docs > 0)
        self.docs = docs
        first = self.n[:self.head]
        kinds -= np.bincount(band(first), minlength=size)
        sums -= np.bincount(band(first), weights=first, minlength=size)
        used = int(np.flatnonzero(kinds > 0).max(initial=0)) + 1
        self.bands = Bands(kinds[:used], sums[:used], kinds[0], twice)
        self.shape_bands = used

    def base(self, n):
        """Decimal logarithm of a token's share of all training tokens, one added to each count."""
        return np.log10((n + 1.0) / (self.total + self.distinct + 1.0))


def counted_tokens(spark, docs, counts, key, text):
    """(row, key, held, units, rest_at, rest): tokens as units of the most frequent words or as minus count less one.

    Words whose counts are not shipped leave a zero and come by name with their place. Without the end of the text.
    """
    kind = docs.select(F.col(key).alias("k")).schema["k"].dataType
    out = T.StructType([T.StructField("k", kind), T.StructField("held", T.BooleanType()),
                        T.StructField("units", T.ArrayType(T.IntegerType())),
                        T.StructField("rest_at", T.ArrayType(T.IntegerType())),
                        T.StructField("rest", T.ArrayType(T.StringType()))])
    shipped = spark.sparkContext.broadcast((counts.names, counts.n, counts.head))

    def code(batches):
        names, n, head = shipped.value
        known, small = lexicon.Lexicon(names), np.minimum(n, (1 << 31) - 2)
        for batch in batches:
            for part in words.slices(batch, 2, 1 << 20):
                found = lexicon.Tokens(part.column(2))
                vocabulary, at = lexicon.distinct(found.words) if found.n else (found.words, np.zeros(0, dtype=np.int64))
                place = known.find(vocabulary)
                unit = np.where(place < 0, 0, np.where(place < head, place + 1, -1 - np.append(small, 0)[place]))[at]
                left = np.flatnonzero(place[at] < 0)
                begin = np.cumsum(found.counts) - found.counts
                stops = lambda counts: pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
                rest = stops(np.bincount(found.row[left], minlength=found.rows))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1),
                    pa.ListArray.from_arrays(stops(found.counts), pa.array(unit, pa.int32())),
                    pa.ListArray.from_arrays(rest, pa.array(left - begin[found.row[left]], pa.int32())),
                    pa.ListArray.from_arrays(rest, vocabulary.take(pa.array(at[left])).cast(pa.string()))],
                    names=["k", "held", "units", "rest_at", "rest"])

    rows = docs.select(F.col(key).alias("k"), held_out(key).alias("held"), F.col(text).alias("t"))
    made = tables.store(spark, rows.mapInArrow(code, out).withColumn("row", F.monotonically_increasing_id()), "tokens")
    shipped.destroy()
    return made


def resolved(spark, coded, counted, counts):
    """(row, k, held, units, inside, base, n_known, round): every token's unit, with what does not depend on the network.

    Words not shipped meet their counts in a join by word and come back to their text as one list. Units below one stand
    for a band: minus count less one. `inside` is the logarithm of all shares inside bands, `base` of all shares of counts.
    """
    others = counted.where(F.col("n") < counts.least) if counts.least is not None else counted
    asked = coded.select("row", F.inline(F.arrays_zip("rest_at", "rest")))
    met = asked.join(others.withColumnRenamed("word", "rest"), "rest", "left").groupBy("row").agg(
        F.collect_list(F.struct("rest_at", F.coalesce("n", F.lit(0)).alias("n"))).alias("found"))
    both = coded.drop("rest_at", "rest").join(met, "row", "left")
    kind = coded.schema["k"].dataType
    out = T.StructType([T.StructField("row", T.LongType()), T.StructField("k", kind), T.StructField("held", T.BooleanType()),
                        T.StructField("units", T.ArrayType(T.IntegerType())), T.StructField("inside", T.DoubleType()),
                        T.StructField("base", T.DoubleType()), T.StructField("n_known", T.LongType())])
    shares, first, base, docs = counts.bands, counts.n[:counts.head], counts.base, counts.docs

    def fill(batches):
        for batch in batches:
            units, found = batch.column("units"), batch.column("found")
            sizes = pc.list_value_length(units).to_numpy(zero_copy_only=False).astype(np.int64)
            flat, begin = units.flatten().to_numpy(zero_copy_only=False).copy(), np.cumsum(sizes) - sizes
            pairs, row = found.flatten(), np.repeat(np.arange(batch.num_rows), pc.fill_null(
                pc.list_value_length(found), 0).to_numpy(zero_copy_only=False))
            n_rest = np.minimum(pairs.field("n").to_numpy(zero_copy_only=False), (1 << 31) - 2)
            flat[begin[row] + pairs.field("rest_at").to_numpy(zero_copy_only=False)] = -1 - n_rest
            n = np.append(first, 0)[np.where(flat > 0, flat - 1, 0)]
            n = np.where(flat > 0, n, -1 - flat.astype(np.int64))
            of = np.repeat(np.arange(batch.num_rows), sizes)
            total = lambda w: np.bincount(of, weights=w, minlength=batch.num_rows)
            inside = np.where(flat > 0, 0.0, shares.inside(n))
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("k"), batch.column("held"),
                pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(flat, pa.int32())),
                pa.array(total(inside)), pa.array(total(base(n)) + base(np.float64(docs))),
                pa.array(total(n > 0).astype(np.int64) + (docs > 0))],
                names=["row", "k", "held", "units", "inside", "base", "n_known"])

    rows = both.select("row", "k", "held", "units", "found").mapInArrow(fill, out)
    # a text's pass is the place of the first bit of its hash that is set: half of all texts, a quarter, ...
    turn = F.least(F.bit_count(F.bitwise_not(F.xxhash64("row")).bitwiseAND(F.xxhash64("row") - 1)), F.lit(ROUNDS - 1))
    path = session.scratch_path(spark, "sequences")
    made = rows.withColumn("round", F.when(F.col("held"), F.lit(-1)).otherwise(F.lit(ROUNDS - 1) - turn).cast("int"))
    made.write.partitionBy("round").parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def units_of(flat, bands, loo):
    """Units of the network: 0 the end, then bands, then words. `loo`: a word's own occurrence is left out of its count."""
    units = np.asarray(flat).astype(np.int32)
    units += np.int32(bands)
    rare = np.flatnonzero(flat <= 0)
    n = -1 - flat[rare].astype(np.int64) - (1 if loo else 0)
    units[rare] = 1 + np.minimum(band(np.maximum(n, 0)), bands - 1)
    return units


def texts_of(batch, bands, loo):
    """Units of each text of a batch with its end, one after the other, and the stops."""
    units = batch.column("units")
    sizes = pc.list_value_length(units).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = units_of(units.flatten().to_numpy(zero_copy_only=False), bands, loo)
    stops = np.cumsum(sizes)
    return np.insert(flat, stops, gru.END), stops + np.arange(1, len(sizes) + 1)


def together(held):
    """The batches of a list as one, which are taken out of it."""
    table = pa.Table.from_batches(held)
    held.clear()
    return table.combine_chunks().to_batches()[0]


def chunks_of(batches, tokens):
    """Batches put together until they hold `tokens` tokens or more: a long text then keeps its lane busy once for many others."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += len(batch.column("units").flatten()) + batch.num_rows
        if size >= tokens:
            yield together(held)
            size = 0
    if held:
        yield together(held)


def joined(parts):
    """The arrays of a list as one, which are taken out of it: they are not held beside what they make."""
    whole = np.concatenate(parts)
    parts.clear()
    return whole


def averaged(spark, sequences, turn, flat, shape, rate):
    """Parameters after the texts of one pass: each task trains from `flat`, results are averaged by tokens.

    Parameters travel in blocks and are summed by block, first in groups of FAN tasks, so that neither a task nor the
    driver receives more than a few megabytes for each thousand tasks.
    """
    start, bands = spark.sparkContext.broadcast(flat), shape.bands

    def learn(batches):
        params, chunk, held, seen = start.value, [], 0, 0
        for batch in batches:
            if batch.num_rows:
                chunk.append(texts_of(batch, bands, loo=True)[0])
                held += len(chunk[-1])
            if held >= CHUNK:
                params, held, seen = gru.train(params, shape, joined(chunk), rate), 0, seen + held
        if held:
            params, seen = gru.train(params, shape, joined(chunk), rate), seen + held
        if seen:
            task, blocks = TaskContext.get().partitionId(), range(0, len(params), BLOCK)
            move = params - start.value
            yield pa.RecordBatch.from_arrays([
                pa.array(list(range(len(blocks))), pa.int32()), pa.array([task // FAN] * len(blocks), pa.int32()),
                pa.array([task] * len(blocks), pa.int32()), pa.array([seen] * len(blocks), pa.int64()),
                pa.array([move[b:b + BLOCK].astype(np.float64).tobytes() for b in blocks], pa.binary())],
                names=["block", "fan", "task", "seen", "part"])

    def summed(weighted):
        def add(rows):
            rows = rows.sort_values(["fan", "task"])  # the same order gives the same sum
            total = 0.0
            for part, seen in zip(rows["part"], rows["seen"]):
                total = total + np.frombuffer(part) * (seen if weighted else 1)
            return pd.DataFrame({"block": rows["block"].iloc[:1], "fan": rows["fan"].iloc[:1], "task": rows["task"].iloc[:1],
                                 "seen": [rows["seen"].sum()], "part": [np.asarray(total).tobytes()]})
        return add

    kind = "block int, fan int, task int, seen bigint, part binary"
    parts = sequences.where(F.col("round") == turn).select("units").mapInArrow(learn, kind)
    near = parts.groupBy("block", "fan").applyInPandas(summed(True), kind)
    rows = near.groupBy("block").applyInPandas(summed(False), kind).collect()
    start.destroy()
    if not rows:
        return flat
    move = np.concatenate([np.frombuffer(r.part) / r.seen for r in sorted(rows, key=lambda r: r.block)])
    return (flat + move).astype(np.float32)


def fit(spark, sequences, counts, hidden=HIDDEN, side=SIDE, width=WIDTH, rates=(0.01, 0.01, 0.01, 0.01, 0.008, 0.006, 0.004)):
    """(parameters, shape) after every training text has been learnt from once."""
    shape = gru.Shape(counts.shape_bands, counts.head, side, hidden, width)
    first = counts.n[:counts.head]
    groups = np.add.reduceat(first, np.arange(0, counts.head, side)) if counts.head else np.zeros(0)
    flat = shape.initial(np.concatenate(([counts.docs], counts.bands.sums, groups)), first)
    for turn in range(ROUNDS):
        flat = averaged(spark, sequences, turn, flat, shape, rates[turn])
    return flat, shape


def score_texts(spark, docs, key="doc_id", text="text", head=HEAD, known=KNOWN):
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every whole text.

    Texts whose crc32 of the key, written as text, leaves 2 when divided by 7 are held out; the others are learnt from.
    A-Z are lower-cased; tokens are words `[^\\x20\\x09-\\x0D]+` and one end. `base_score` sums decimal logarithms of the
    tokens' shares of all training tokens with one added to each count; `score` is the network's probability of the whole
    text. Counts are over all training texts, and each is learnt from once: in every pass tasks train apart from the same
    parameters, which are then averaged. A text's state is carried from window to window to its end.

    The counts of the `known` most frequent words are shipped (a bounded broadcast); other words meet theirs in a join.
    What the driver holds is these words, one number for each binary order of counts, and the parameters.

    A null text counts as empty: one token, its end. A null key is learnt from; null and repeated keys pass through and
    each row counts. Very long texts are scored whole, in one lane. If nothing is learnt from, no token is known, base_score
    is 0 and score that of the untrained network. An empty table gives no rows; other columns are not read.
    """
    tables.short_batches(spark)
    learnt = docs.where(~held_out(key))
    counted = tables.store(spark, lexicon.counts(learnt, text), "words")
    counts = Counts(counted, learnt.count(), head, known)
    sequences = resolved(spark, counted_tokens(spark, docs, counts, key, text), counted, counts)
    flat, shape = fit(spark, sequences, counts)
    model = spark.sparkContext.broadcast(flat)
    total, kind = counts.total, sequences.schema["k"].dataType
    out = T.StructType([T.StructField(key, kind), T.StructField("held_out", T.BooleanType()), *[
        T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")], *[
        T.StructField(n, T.DoubleType()) for n in ("base_score", "score")]])

    def judge(batches):
        for batch in chunks_of(batches, JUDGED):
            stream, stops = texts_of(batch, shape.bands, loo=False)
            found = gru.score(model.value, shape, np.split(stream, stops[:-1]))
            sizes = np.diff(np.concatenate(([0], stops)))
            yield pa.RecordBatch.from_arrays([
                batch.column("k"), batch.column("held"), pa.array(sizes), batch.column("n_known"),
                pa.array(np.full(batch.num_rows, total), pa.int64()), batch.column("base"),
                pa.array((found + batch.column("inside").to_numpy()) / LOG10)], names=out.names)

    return sequences.select("k", "held", "units", "n_known", "base", "inside").mapInArrow(judge, out)
