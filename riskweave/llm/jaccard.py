"""Near-duplicate join on word shingles: parity sketches, pigeonhole segments per size band, verification."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskweave.llm import tables, words
from riskweave.llm.components import components

SKETCH_BITS = 512
SMALL_BUCKET = 48
SKETCH_BLOCK = 2048
LINK_BLOCK = 1024
LINK_SHINGLES = 1 << 20
_U = np.uint64
_TOP = 1 << 40


class Bands:
    """Size bands for a similarity of at least p/q, such that linked sets lie in one band or in neighbours.

    Two sets of at most M shingles that link differ in at most D = (q-p)*2M // (q+p) shingles, so of D+1
    segments of their parity sketches at least one agrees.
    """

    def __init__(self, p, q):
        self.p, self.q, low = p, q, [1, 2]
        while low[-1] < _TOP:
            last = low[-1]
            low.append(max(-(-last * q * q // (p * p)), q * (last - 1) // p + 1, last + 1))
        self.low = np.array(low, dtype=np.int64)

    def of(self, n):
        """(band, segments) under which a set of n shingles is filed: its own, and the next if a partner fits there."""
        own = int(np.searchsorted(self.low, n, side="right")) - 1
        bands = [own] + [own + 1] * (self.p * int(self.low[own + 1]) <= self.q * n)
        return [(b, (self.q - self.p) * 2 * (int(self.low[b + 1]) - 1) // (self.q + self.p) + 1) for b in bands]


def shingle_sets(column, k):
    """Sorted distinct shingle hashes per row; fewer than k words give one shingle, none an empty set."""
    w = words.Words(column, lower=True)
    at, grams = w.grams(k)
    cut = np.searchsorted(at, w.ptr)
    out = []
    for i in range(w.rows):
        a, b = w.ptr[i], w.ptr[i + 1]
        if b - a >= k:
            out.append(np.unique(grams[cut[i]:cut[i + 1]]))
        else:
            out.append(np.array([w.sequence(a, b)] if b > a else [], dtype=np.uint64))
    return out


def digest(s):
    """64 bits that name a set."""
    with np.errstate(over="ignore"):
        return words.mix(np.add.reduce(words.mix(s)) ^ _U(len(s) * 0x9E3779B1))


def sketch(s):
    """Parity sketch of about as many bits as the set has shingles: bit i is the parity of the shingles hashed to i.

    Its Hamming distance to another sketch is at most the symmetric difference of the sets, also when the longer one
    is folded, since lengths are powers of two.
    """
    bits = max(SKETCH_BITS, 1 << len(s).bit_length())
    parity = np.bincount((words.mix(s) >> _U(17)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def folded(sketch_, size):
    """A sketch folded to `size` bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch_, dtype=np.uint8).reshape(-1, size), axis=0)


def segment_keys(s, bands):
    """Keys of the parity sketch's segments.

    The sketch of a segment has one bit per possible hash and is written as the XOR of its set bits' codes.
    An empty segment says little. Some segment of a linked pair agrees and has at most one difference in
    the segment after it (the segments stand in a ring), so an empty one is filed with every value that the
    next one can have under one difference: as it is, or without one of its shingles.
    """
    z = words.mix(s ^ _U(0xA5A5A5A5A5A5A5A5))
    code = words.mix(z)
    keys = []
    for band, m in bands.of(len(s)):
        seg = ((z >> _U(20)) % _U(m)).astype(np.int64)
        order = np.argsort(seg, kind="stable")
        count = np.bincount(seg, minlength=m)
        start = np.concatenate(([0], np.cumsum(count)))[:-1]
        full = count > 0
        value = np.zeros(m, dtype=np.uint64)
        value[full] = np.bitwise_xor.reduceat(code[order], start[full])
        name = words.mix(np.arange(m, dtype=np.uint64) + _U(band << 40))
        keys.append(words.mix(value[full] ^ name[full]))
        weak = np.flatnonzero(~full)
        if len(weak):
            after = (weak + 1) % m
            owner = np.repeat(np.arange(len(weak)), count[after])
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(count[after]) - count[after], count[after])
            without = value[after][owner] ^ code[order][start[after][owner] + inside]
            tag = words.mix(name[weak] + _U(1))
            keys += [words.mix(value[after] ^ tag), words.mix(without ^ tag[owner])]
    return np.concatenate(keys)


def _described(df, key, text, k):
    """(key, n, cls): size and class, the digest of the set; one row per row."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, 1):
                sets = shingle_sets(part.column(1), k)
                names = np.array([digest(s) for s in sets], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(words.signed(names))],
                    names=["key", "n", "cls"])

    return df.select(key, text).mapInArrow(run, f"key {kind}, n bigint, cls bigint")


def _filed(df, text, k, bands):
    """(seg, cls): the segment keys of every set, each once per slice of rows."""

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, 0):
                seen, keys, owners = set(), [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
                for s in shingle_sets(part.column(0), k):
                    name = digest(s)
                    if len(s) and name not in seen:
                        seen.add(name)
                        keys.append(np.unique(segment_keys(s, bands)))
                        owners.append(np.full(len(keys[-1]), name, dtype=np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.signed(np.concatenate(keys))), pa.array(words.signed(np.concatenate(owners)))],
                    names=["seg", "cls"])

    return df.select(text).mapInArrow(run, "seg bigint, cls bigint")


def _packed(df, text, k):
    """(cls, n, sketch, body): one compressed text per set and slice, from which its set can be built again."""

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, 0):
                sets, seen, out = shingle_sets(part.column(0), k), set(), []
                for s, value in zip(sets, part.column(0).to_pylist()):
                    name = digest(s)
                    if len(s) and name not in seen:
                        seen.add(name)
                        out.append((int(name.view(np.int64)), len(s), sketch(s), zlib.compress(value.encode(), 6)))
                cols = list(zip(*out)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                     pa.array(cols[3], pa.binary())], names=["cls", "n", "sketch", "body"])

    return df.select(text).mapInArrow(run, "cls bigint, n bigint, sketch binary, body binary")


def _verified(pairs, k, p, q):
    """Links (a, b) among pairs with both bodies: q * intersection >= p * union, on the sets themselves."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                sides = []
                for c in (2, 3):
                    bodies = [zlib.decompress(x).decode() for x in part.column(c).to_pylist()]
                    sides.append(shingle_sets(pa.array(bodies, pa.string()), k))
                keep = []
                for x, y in zip(*sides):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(q * both >= p * (len(x) + len(y) - both))
                yield part.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "body_a", "body_b").mapInArrow(run, "a bigint, b bigint")


def _pairs(one, two):
    """Distinct pairs of unlike labels that share a bucket."""
    left = one.select("seg", F.col("cls").alias("x"), F.col("label").alias("lx"))
    right = two.select("seg", F.col("cls").alias("y"), F.col("label").alias("ly"))
    return left.join(right, "seg").where("lx <> ly").select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _close(pairs, light, p, q):
    """Pairs whose sizes and sketches allow a link."""
    for side in "ab":
        pairs = pairs.join(light.select(
            F.col("cls").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}")), side)
    pairs = pairs.where(F.least("n_a", "n_b") * q >= F.greatest("n_a", "n_b") * p)

    def run(batches):
        for batch in batches:
            size = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            apart = []
            for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                least = min(len(x), len(y))
                apart.append(int(np.bitwise_count(folded(x, least) ^ folded(y, least)).sum()))
            near = np.array(apart, dtype=np.int64) * (q + p) <= size * (q - p)
            yield batch.select([0, 1]).filter(pa.array(near))

    return pairs.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a bigint, b bigint")


def _close_in_blocks(outside, inside, light, p, q):
    """The same pairs for large buckets: blocks of sketches meet in one task each, and only close pairs leave it."""
    blocks = F.ceil(F.col("c") / SKETCH_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cols = ["seg", "i", "j", "cls", "label", "n", "sketch"]
    left = outside.join(light, "cls").withColumn("blocks", blocks).withColumn("i", own).withColumn("j", every)
    right = inside.join(light, "cls").withColumn("blocks", blocks).withColumn("j", own).withColumn("i", every)

    def bits(sketches, size):
        return np.unpackbits(np.stack([folded(x, size) for x in sketches]), axis=1).astype(np.float32)

    def close(a, b):
        b = b.rename_columns(cols)
        if not a.num_rows or not b.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        one, two = a.column("sketch").to_pylist(), b.column("sketch").to_pylist()
        size = min(SKETCH_BITS // 2, *map(len, one), *map(len, two))
        x, y = bits(one, size), bits(two, size)
        apart = x.sum(1)[:, None] + y.sum(1)[None] - 2 * (x @ y.T)
        n, m = a.column("n").to_numpy()[:, None], b.column("n").to_numpy()[None]
        fit = (apart * (q + p) <= (n + m) * (q - p)) & (np.minimum(n, m) * q >= np.maximum(n, m) * p)
        fit &= a.column("label").to_numpy()[:, None] != b.column("label").to_numpy()[None]
        u, v = np.nonzero(fit)
        u, v = a.column("cls").to_numpy()[u], b.column("cls").to_numpy()[v]
        return pa.table({"a": np.minimum(u, v), "b": np.maximum(u, v)})

    right = right.select(*[F.col(c).alias(f"r_{c}") for c in cols])
    return left.select(cols).groupBy("seg", "i", "j").cogroup(right.groupBy("r_seg", "r_i", "r_j")).applyInArrow(
        close, "a bigint, b bigint").distinct()


def linked(one, two, p, q):
    """Links of every set of `one` among those of `two`, and of every set of `two` among those of `one`.

    A set of `one` is marked among the shingles of `two`, whose sets are read in the order of their sizes, as far as sizes
    allow a link: q * intersection >= p * union.
    """
    left, right = np.zeros(len(one), np.int64), np.zeros(len(two), np.int64)
    if not one or not two:
        return left, right
    order = np.argsort([len(s) for s in two], kind="stable")
    sizes = np.array([len(two[i]) for i in order], dtype=np.int64)
    known, at = np.unique(np.concatenate([two[i] for i in order]), return_inverse=True)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    mark = np.zeros(len(known), dtype=np.int32)
    for i, s in enumerate(one):
        a, b = np.searchsorted(sizes * q, len(s) * p), np.searchsorted(sizes * p, len(s) * q, side="right")
        if a == b:
            continue
        found = np.minimum(np.searchsorted(known, s), len(known) - 1)
        found = found[known[found] == s]
        mark[found] = 1
        both = np.add.reduceat(mark[at[ends[a]:ends[b]]], ends[a:b] - ends[a])
        mark[found] = 0
        fit = q * both >= p * (len(s) + sizes[a:b] - both)
        left[i] = fit.sum()
        right[order[a:b][fit]] += 1
    return left, right


def _link_counts(labels, bodies, k, p, q):
    """(cls, n_links): for every class of a component the number of others it links with, each pair verified on the sets.

    Linked classes lie in one component. One of two classes has one link. Larger components are dealt in blocks of about
    LINK_BLOCK classes and LINK_SHINGLES shingles; two blocks meet in one task, and only counts leave it.
    """
    classes = labels.select(F.col("node").alias("cls"), "label")
    sizes = classes.join(bodies.select("cls", "n"), "cls").groupBy("label").agg(
        F.count("*").alias("m"), F.sum("n").alias("total"))
    blocks = F.ceil(F.greatest(F.col("m") / LINK_BLOCK, F.col("total") / LINK_SHINGLES)).cast("int")
    sized = classes.join(sizes.select("label", "m", blocks.alias("blocks")), "label")
    dealt = sized.where("m > 2").join(bodies.select("cls", "body"), "cls").withColumn(
        "own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    left = dealt.select("label", F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"), "cls", "body")
    right = dealt.select(F.col("label").alias("r_label"), F.explode(F.sequence(F.lit(0), "own")).alias("r_i"),
                         F.col("own").alias("r_j"), F.col("cls").alias("r_cls"), F.col("body").alias("r_body"))

    def sets_of(column):
        texts = pa.array([zlib.decompress(x).decode() for x in column.to_pylist()], pa.string())
        parts = words.slices(pa.RecordBatch.from_arrays([texts], names=["text"]), 0)
        return [s for part in parts for s in shingle_sets(part.column(0), k)]

    def counted(one, two):
        cls = one.column("cls").to_pylist()
        if one.num_rows and one.column("i")[0] == one.column("j")[0]:  # a block with itself: every set links with itself
            sets = sets_of(one.column("body"))
            n = linked(sets, sets, p, q)[0] - 1
        else:
            cls += two.column("r_cls").to_pylist()
            n = np.concatenate(linked(sets_of(one.column("body")), sets_of(two.column("r_body")), p, q))
        return pa.table({"cls": pa.array(cls, pa.int64()), "n": pa.array(n, pa.int64())})

    parts = left.groupBy("label", "i", "j").cogroup(right.groupBy("r_label", "r_i", "r_j")).applyInArrow(
        counted, "cls bigint, n bigint")
    pairs = sized.where("m = 2").select("cls", F.lit(1).cast("bigint").alias("n"))
    return parts.union(pairs).groupBy("cls").agg(F.sum("n").alias("n_links"))


def near_links(spark, df, text="text", k=3, p=90, q=100):
    """Links of every linked set class, as (cls, n_links), and the components.

    First the components. Classes that share a segment key form a bucket. Buckets are not paired off: first the member that shares most
    with others is compared with its bucket. Where classes are then still apart, every class outside the largest
    part of a bucket is compared with those it is apart from: by a join in buckets of up to SMALL_BUCKET
    members, by blocks of sketches in larger ones. Only pairs whose sketches are close enough meet as sets.
    A pair is left out there only if it is connected by then or cannot link, so components are complete. Then all pairs
    inside a component are compared as sets, so the counts hold every link; they are computed only where they are read.
    """
    bands = Bands(p, q)
    filed = _filed(df, text, k, bands)
    shared = filed.groupBy("seg").agg(F.count("*").alias("c")).where("c > 1").select("seg")
    rows = tables.store(spark, filed.join(shared, "seg").distinct(), "segments")
    sizes = rows.groupBy("seg").agg(F.count("*").alias("c")).where("c > 1")
    rows = tables.store(spark, rows.join(sizes, "seg"), "buckets")
    score = tables.store(spark, rows.groupBy("cls").agg(F.sum("c").alias("score")), "scores")
    packed = _packed(df, text, k).groupBy("cls").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("body").alias("body"))
    bodies = tables.store(spark, packed.join(score, "cls", "left_semi"), "bodies")
    light = bodies.select("cls", "n", "sketch")

    def links_of(pairs):
        for side in "ab":
            pairs = pairs.join(bodies.select(F.col("cls").alias(side), F.col("body").alias(f"body_{side}")), side)
        return tables.store(spark, _verified(pairs, k, p, q), "links")

    alone = rows.withColumn("label", F.col("cls"))
    top = rows.join(score, "cls").groupBy("seg").agg(F.max_by("cls", F.struct("score", "cls")).alias("cls")).withColumn(
        "label", F.col("cls"))
    links = links_of(_close(_pairs(top, alone), light, p, q))
    labels = components(spark, links)

    labelled = rows.join(labels.select(F.col("node").alias("cls"), "label"), "cls", "left").withColumn(
        "label", F.coalesce("label", "cls"))
    parts = tables.store(spark, labelled.groupBy("seg", "label").agg(F.count("*").alias("n")), "parts")
    main = parts.groupBy("seg").agg(F.max_by("label", F.struct("n", "label")).alias("main"),
                                    F.count("*").alias("parts")).where("parts > 1")
    apart = tables.store(spark, labelled.join(main, "seg").select(
        "seg", "cls", "c", "label", (F.col("label") != F.col("main")).alias("out")), "apart")
    few, many = F.col("c") <= SMALL_BUCKET, F.col("c") > SMALL_BUCKET
    near = _pairs(apart.where(few & F.col("out")), apart.where(few)).union(
        _close_in_blocks(apart.where(many & F.col("out")), apart.where(many), light, p, q)).distinct()
    labels = components(spark, links.union(links_of(_close(near, light, p, q))))
    return _link_counts(labels, bodies, k, p, q), labels


def near_duplicates(spark, df, key="doc_id", text="text", k=3, p=90, q=100):
    """Per row: key, n_shingles, component_id (smallest key reachable by links), n_links of its set class: the
    number of other classes it links with.

    Words are runs of non-white bytes, A-Z lower-cased; a set is the distinct k-word shingles, the whole word
    sequence if shorter. Sets link when q * intersection >= p * union. Equal sets are one class; links hold
    between classes and each is verified on the sets. Shingles and classes are named by 64-bit hashes.

    A null text or one without words has an empty set and links with nothing, its component is its key. Null
    keys count above all others; a component of null keys only has a null id. Repeated rows are
    returned as often as they occur. Other columns are not read. An empty table gives no rows.
    """
    described = tables.store(spark, _described(df, key, text, k), "sets")
    degree, labels = near_links(spark, df, text, k, p, q)
    classes = described.where("n > 0").groupBy("cls").agg(F.min("key").alias("least")).join(
        labels.select(F.col("node").alias("cls"), "label"), "cls", "left").withColumn(
            "label", F.coalesce("label", "cls"))
    smallest = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    # by label last: rows are then dealt by class anew, and a class of many rows can be split where they meet it
    named = classes.join(degree, "cls", "left").join(smallest, "label").select(
        "cls", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    empty = described.where("n = 0").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("key").alias("component_id"),
        F.lit(0).cast("long").alias("n_links"))
    return described.where("n > 0").join(named, "cls").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id", "n_links").unionByName(empty)
