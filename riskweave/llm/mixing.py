"""Mixing sources to target weights: blocks of equal token counts apportioned by highest quotients (Sainte-Lague)."""

import heapq
import math

import numpy as np
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.llm import tables
from riskweave.llm.words import mix

BLOCK = 8  # words
SHARD_WORDS = 1_000_000  # words of a source that one task orders and selects, about
WORD = r"[^\x20\x09-\x0D]+"


def sainte_lague(votes, seats, caps):
    """Seats by the highest quotients votes / (2s + 1), none above its cap; ties go to the earlier party.

    For any divisor d the parties' first round(votes / d) quotients are the highest of that number, so a
    divisor with somewhat too few seats is found by bisection and only the last seats are given out one by one.
    """
    votes, caps = np.asarray(votes, dtype=np.float64), np.asarray(caps, dtype=np.int64)
    seats = int(min(seats, caps[votes > 0].sum()))
    given = np.zeros(len(votes), dtype=np.int64)
    if seats <= 0:
        return given
    at = lambda d: np.minimum(np.ceil(np.minimum(votes / d, 2.0**60) - 0.5).astype(np.int64).clip(0), caps)
    low, high = votes[votes > 0].min() / (4.0 * (caps.max() + 1)), votes.max() * 4
    for _ in range(200):
        mid = (low * high) ** 0.5
        if at(mid).sum() > seats:
            low = mid
        else:
            high = mid
    given = at(high)
    heap = [(-votes[i] / (2 * given[i] + 1), i) for i in np.flatnonzero((votes > 0) & (given < caps))]
    heapq.heapify(heap)
    for _ in range(seats - int(given.sum())):
        i = heapq.heappop(heap)[1]
        given[i] += 1
        if given[i] < caps[i]:
            heapq.heappush(heap, (-votes[i] / (2 * given[i] + 1), i))
    return given


def targets(spark, sources, most=3, cycle=3):
    """(source, words, weight, target) for (source, words): weights 1, 2, 3, ... by code point, null last.

    Targets share all words by weight and stop at `most` times the own words; the excess is shared again until
    none is above. Each round needs two sums over one row per source.
    """
    order = W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())  # one row per source
    known = tables.store(spark, sources.withColumn("weight", (F.row_number().over(order) - 1) % cycle + 1), "sources")
    total = known.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    per_weight, full = 0.0, None
    while True:
        capped = F.lit(per_weight) * F.col("weight") > F.col("words") * most
        n, taken, weight = known.agg(
            F.count_if(capped), F.coalesce(F.sum(F.when(capped, F.col("words") * most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0))).first()
        if n == full or not weight:
            break
        full, per_weight = n, (total - taken) / weight
    return known.withColumn("target", F.least(F.lit(per_weight) * F.col("weight"),
                                              (F.col("words") * most).cast("double"))).select(
        "source", "words", "weight", "target")


def _quota(frame):
    """Words per shard of one source: its target in whole words, apportioned by the shards' words."""
    frame = frame.sort_values("shard")
    frame["quota"] = sainte_lague(frame["held"], int(round(frame["target"].iloc[0])), 3 * frame["held"].to_numpy())
    return frame[["source_key", "shard", "quota"]]


def _whole(size, taken, low, high, place):
    """Times that every document is taken whole, `low` to `high`, so that all words come near those taken.

    From the longest document to the shortest each is taken as often as brings the words so far nearest to those
    taken of them, so that shorter ones make up what longer ones leave. The longest is rounded by its digest: a
    document without others is taken in the mean as often as its words are.
    """
    order = np.argsort(-size, kind="stable")
    up = (int(place[order[0]]) & ((1 << 64) - 1)) / 2.0**64
    times, missing = np.empty(len(size), dtype=np.int64), 0
    for i, n, words in zip(order.tolist(), size[order].tolist(), taken[order].tolist()):
        t = min(max(math.floor((words + missing) / n + up), low), high)
        times[i], missing, up = t, missing + words - t * n, 0.5
    return times


def _select(frame):
    """Words taken of every document of a shard: its words in seeded order are cut in blocks; all words are taken
    quota // words times and blocks in seeded order once more, of the last one as many words as the quota lacks.
    `times`: the same in whole documents."""
    frame = frame.sort_values(["place", "key_text"])
    size = frame["size"].to_numpy().astype(np.int64)
    stop = np.cumsum(size)
    words = int(stop[-1])
    blocks = -(-words // BLOCK)
    quota = int(frame["quota"].iloc[0])
    low, more = divmod(quota, words)
    seed = np.uint64(int(frame["place"].iloc[0]) & ((1 << 64) - 1))
    order = np.argsort(mix(np.arange(blocks, dtype=np.uint64) + seed), kind="stable")
    length = np.minimum(BLOCK, words - BLOCK * order)  # the last block may be shorter
    again = np.zeros(blocks + 1, dtype=np.int64)  # words of each block that are taken once more
    again[order] = np.minimum(length, (more - (np.cumsum(length) - length)).clip(0))
    before = np.concatenate(([0], np.cumsum(again[:-1])))
    upto = lambda x: low * x + before[x // BLOCK] + np.minimum(again[x // BLOCK], x % BLOCK)
    taken = upto(stop) - upto(stop - size)
    frame["taken"] = taken
    frame["times"] = _whole(size, taken, low, low + (more > 0), frame["place"].to_numpy())
    return frame[["source_key", "key_text", "size", "taken", "times"]]


def mix_sources(spark, df, key="doc_id", text="text", source="source", seed=7):
    """Per row: key, size, source_size, target, taken, and digest (of key and text), which tells rows apart.

    Sizes are counts of words (null text: 0). A source's documents are dealt by hash to shards of about
    SHARD_WORDS words; the target's words are apportioned to the shards by highest quotients; within a
    shard blocks of BLOCK words are selected in seeded order, the last one in part. No word is taken more than 3 times,
    so no document is. A source's words taken are its target, rounded to a whole number.

    Null and empty sources are sources like others. Documents without words are taken 0 times and are not
    dealt, so no shard has more rows than words. Rows that repeat key and text may swap results. Reruns agree.
    Other columns are not read. An empty table gives no rows.
    """
    return _mixed(spark, df, key, text, source, seed).drop("times")


def _mixed(spark, df, key, text, source, seed):
    """The rows of `mix_sources` and times, how often each document is taken whole."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = tables.store(spark, df.select(
        F.col(key).alias("key"), F.col(source).alias("source"),
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(key).cast("string"), body).alias("place")), "sized")
    sources = targets(spark, rows.groupBy("source").agg(F.sum("size").alias("words")))
    sources = tables.store(spark, sources.withColumn("source_key", F.coalesce(
        F.concat(F.lit("="), "source"), F.lit("null"))), "targets")
    keyed = rows.withColumn("source_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))).drop("source")
    dealt = keyed.where("size > 0").join(sources.select("source_key", "words", "target"), "source_key").withColumn(
        "shard", F.pmod(F.col("place"), F.ceil(F.col("words") / SHARD_WORDS))).withColumn(
            "key_text", F.coalesce(F.col("key").cast("string"), F.lit("")))
    held = dealt.groupBy("source_key", "shard").agg(F.sum("size").alias("held"), F.first("target").alias("target"))
    quotas = held.groupBy("source_key").applyInPandas(_quota, "source_key string, shard bigint, quota bigint")
    kind = df.schema[key].dataType.simpleString()

    def select(frame):
        out = _select(frame)
        out["key"], out["place"] = frame.loc[out.index, "key"], frame.loc[out.index, "place"]
        return out[["source_key", "key", "size", "place", "taken", "times"]]

    chosen = dealt.join(quotas, ["source_key", "shard"]).select(
        "source_key", "shard", "key", "key_text", "size", "place", "quota").groupBy("source_key", "shard").applyInPandas(
            select, f"source_key string, key {kind}, size bigint, place bigint, taken bigint, times bigint")
    zero = F.lit(0).cast("long")
    none = keyed.where("size = 0").select("source_key", "key", "size", "place", zero.alias("taken"), zero.alias("times"))
    return chosen.unionByName(none).join(sources, "source_key").select(
        F.col("key").alias(key), "size", F.col("words").alias("source_size"), "target", "taken",
        F.col("place").alias("digest"), "times")


def mixed_documents(spark, df, key="doc_id", text="text", source="source", seed=7):
    """The rows of `df`, each as often as the mix takes it whole, 0 to 3 times: words taken over own words, rounded down
    or up so that the words of a shard, and with them of a source, come near its target. A source misses it by
    about half of a shard's shortest documents, a source of few documents by up to one of them."""
    times = _mixed(spark, df, key, text, source, seed).where("size > 0").select(
        F.col("digest").alias("_digest"), F.col("times").cast("int").alias("_times"))
    times = times.groupBy("_digest").agg(F.max("_times").alias("_times")).where("_times > 0")
    tagged = df.select(F.struct("*").alias("_row"), F.xxhash64(
        F.lit(seed), F.col(key).cast("string"), F.coalesce(F.col(text), F.lit(""))).alias("_digest"))
    copies = tagged.join(times, "_digest").select("_row", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return copies.select("_row.*")
