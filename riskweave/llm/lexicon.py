"""Words of text columns as Arrow arrays, their counts over a corpus, and a bounded table of the most frequent ones."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from riskweave.llm import tables, words

WHITE = bytes([9, 10, 11, 12, 13, 32])
BINS = 8  # bins of word counts per power of two


class Tokens:
    """Words of a slice of texts, A-Z lower-cased: `words` one after the other, `row` and `piece` of each.

    A word is a run of bytes outside `blanks` and `breaks`; a new piece begins after a byte of `breaks` and with
    every row.
    """

    def __init__(self, column, blanks=WHITE, breaks=b""):
        column = pc.fill_null(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, "").cast(
            pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
        data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        inside = np.ones(256, dtype=bool)
        inside[list(blanks + breaks)] = False
        inside = inside[data]
        first, last = inside.copy(), inside.copy()
        if len(data):
            edge = np.zeros(len(data) + 1, dtype=bool)
            edge[offsets] = True
            first[1:] &= ~inside[:-1] | edge[1:-1]
            last[:-1] &= ~inside[1:] | edge[1:-1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.rows, self.n = len(column), len(start)
        self.counts = np.diff(np.searchsorted(start, offsets))
        self.row = np.repeat(np.arange(self.rows), self.counts)
        if breaks:
            cut = np.zeros(256, dtype=bool)
            cut[list(breaks)] = True
            self.piece = np.cumsum(cut[data])[start] + self.row if len(data) else np.zeros(0, dtype=np.int64)
        else:
            self.piece = self.row
        kept = data[inside]
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        stops = np.concatenate(([0], np.cumsum(end - start)))
        self.words = pa.Array.from_buffers(pa.large_string(), self.n, [
            None, pa.py_buffer(stops.astype(np.int64)), pa.py_buffer(lower[kept])])


def counted(column, blanks=WHITE, breaks=b""):
    """Distinct words of a slice and how often they occur, as a record batch (word, n)."""
    found = pc.value_counts(Tokens(column, blanks, breaks).words)
    return pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], names=["word", "n"])


def counts(df, text, blanks=WHITE, breaks=b""):
    """(word, n) of all texts: slices are counted in their task, then summed."""

    def count(batches):
        for batch in batches:
            for part in words.slices(batch, 0, 1 << 21):
                yield counted(part.column(0), blanks, breaks)

    return df.select(F.col(text).alias("text")).mapInArrow(count, "word string, n bigint").groupBy("word").agg(
        F.sum("n").alias("n"))


def least_count(counted_words, most):
    """The least count so that at most `most` words have it or a larger one, to an eighth of a power of two.

    What reaches the driver is one row for each bin of counts, a few hundred whatever the corpus.
    """
    bin_of = F.floor(F.log2("n") * BINS)
    bins = counted_words.groupBy(bin_of.alias("b")).agg(F.count("*").alias("k"), F.min("n").alias("n")).collect()
    total, least = 0, None
    for r in sorted(bins, key=lambda r: -r.b):
        total += r.k
        if total > most:
            break
        least = r.n
    return least


def frequent(counted_words, most):
    """At most `most` of the most frequent words, most frequent first, as an Arrow table (word, n) on the driver."""
    least = least_count(counted_words, most)
    if least is None:
        return pa.table({"word": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
    found = counted_words.where(F.col("n") >= int(least)).toArrow().combine_chunks()
    found = found.select(["word", "n"])
    return found.take(pc.sort_indices(found, sort_keys=[("n", "descending"), ("word", "ascending")]))


class Lexicon:
    """Place of words in a list of known words, found by bisection of their hashes and checked; -1 where not known."""

    def __init__(self, names):
        names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
        hashes = words.string_hashes(names) if len(names) else np.zeros(0, dtype=np.uint64)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes, self.names = hashes[self.order], names.cast(pa.large_string())

    def find(self, found):
        if not len(self.hashes) or not len(found):
            return np.full(len(found), -1, dtype=np.int64)
        hashes = words.string_hashes(found)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        place = self.order[at]
        same = self.hashes[at] == hashes
        same &= pc.equal(found, self.names.take(pa.array(place))).to_numpy(zero_copy_only=False)
        return np.where(same, place, -1)


def distinct(array):
    """(distinct values, code of each element)."""
    coded = array.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()
