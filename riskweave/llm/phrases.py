"""Collocations from a weighted de Bruijn graph of words.

Edges are the longest word runs of a piece, a node is a run one word shorter, and an edge leads from the node of its
first words to the node of its last. Runs cut short by the end of their piece are counted as well: they are the
correction that turns the flow out of a node into its own count.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from riskweave.llm import lexicon, tables, words

STRETCH = 4096  # edges of one row of `paths`
NO_LANG = "und"
BLANKS, BREAKS = b" \t", b".,;:!?\n\x0b\f\r"
BITS = 20  # of a word's number; three numbers fit in 64 bits
COMMON = (1 << BITS) - 2  # words that get a number; 0 stands for no word, OTHER for a word without one
OTHER = (1 << BITS) - 1
LITERAL = "\t"  # before a word without a number where words are written out


def joined(parts, by):
    """Strings joined element by element, nulls left out."""
    return pc.binary_join_element_wise(*parts, pa.scalar(by, pa.large_string()), null_handling="skip")


def emitted(docs, text, lang, longest, names, spelled):
    """(lang, key, run) for every word of all texts: the words from it on within its piece, `longest` at most.

    A run of fewer words was cut by the end of its piece. `key` has the run as numbers; if `spelled`, a run that holds a
    word without a number, or longer than three words, comes a second time as words joined by a space in `run`, its key null.
    """

    def emit(batches):
        known = lexicon.Lexicon(names.value)
        for batch in batches:
            for part in words.slices(batch, 0, 1 << 20):
                found = lexicon.Tokens(part.column(0), BLANKS, BREAKS)
                if not found.n:
                    continue
                spoken = pc.fill_null(part.column(1), NO_LANG).cast(pa.string()).take(pa.array(found.row))
                vocabulary, code = lexicon.distinct(found.words)
                place = known.find(vocabulary)
                number = np.where(place >= 0, place + 1, OTHER)[code]
                at = np.arange(found.n)
                after = [np.minimum(at + step, found.n - 1) for step in range(longest)]
                ends = [(at + step >= found.n) | (found.piece[i] != found.piece) for step, i in enumerate(after)]
                if longest <= 3:
                    key = np.zeros(found.n, dtype=np.int64)
                    for i, end in zip(after, ends):
                        key = (key << BITS) | np.where(end, 0, number[i])
                    yield pa.RecordBatch.from_arrays([spoken, pa.array(key), pa.nulls(found.n, pa.string())],
                                                     names=["lang", "key", "run"])
                if not spelled:
                    continue
                other = np.zeros(found.n, dtype=bool) if longest <= 3 else np.ones(found.n, dtype=bool)
                for i, end in zip(after, ends):
                    other |= ~end & (number[i] == OTHER)
                rows = np.flatnonzero(other)
                mark = pa.array(np.where(place >= 0, "", LITERAL), pa.large_string()) if longest <= 3 else pa.scalar(
                    LITERAL, pa.large_string())
                word = joined([mark, vocabulary], "").take(pa.array(code))
                run = joined([word.take(pa.array(i[rows], mask=end[rows])) for i, end in zip(after, ends)], " ")
                yield pa.RecordBatch.from_arrays([spoken.take(pa.array(rows)), pa.nulls(len(rows), pa.int64()),
                                                  run.cast(pa.string())], names=["lang", "key", "run"])

    return docs.select(F.col(text).alias("t"), F.col(lang).alias("l")).mapInArrow(emit, "lang string, key bigint, run string")


def numbered_flows(runs, least, longest, names):
    """(lang, size, phrase, f) of the phrases of numbered words that occur `least` times; size 0: all words of a lang.

    One plan in which every shuffle is read twice and made once.
    """
    level = runs.groupBy("lang", "key").agg(F.count("*").alias("f"))
    found = []
    for m in range(longest, -1, -1):
        here = [F.shiftrightunsigned("key", BITS * i).bitwiseAND(F.lit(OTHER)) for i in range(m)]
        proper = F.lit(True)
        for number in here:
            proper &= (number > 0) & (number < OTHER)
        # the count stands in the condition so that it is not moved below the shuffle, which both readers share
        found.append(level.where(F.when(F.col("f") >= (least if m else 1), proper)).select(
            "lang", F.lit(m).alias("size"), "key", "f"))
        if m:
            level = level.select("lang", F.shiftrightunsigned("key", BITS).alias("key"), "f").groupBy("lang", "key").agg(
                F.sum("f").alias("f"))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)

    def spell(batches):
        for batch in batches:
            key, size = batch.column(2).to_numpy(), batch.column(1).to_numpy()
            parts = []
            for i in range(longest - 1, -1, -1):
                number = (key >> (BITS * i)) & OTHER
                parts.append(names.value.take(pa.array(number - 1, mask=size <= i)).cast(pa.large_string()))
            parts[-1] = pc.fill_null(parts[-1], "")  # a row of nothing but nulls would be left out
            phrase = joined(parts, " ").cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), phrase, batch.column(3)],
                                             names=["lang", "size", "phrase", "f"])

    return out.mapInArrow(spell, "lang string, size int, phrase string, f bigint")


def spelled_flows(runs, least, longest):
    """(lang, size, phrase, f) of the phrases with a marked word that occur `least` times."""
    run = F.col("run")
    size = F.when(run == "", F.lit(0)).otherwise(F.regexp_count(run, F.lit(" ")) + 1)
    level = runs.groupBy("lang", "run").agg(F.count("*").alias("f"))
    found = []
    for m in range(longest, 0, -1):
        found.append(level.where(F.when(F.col("f") >= least, (size == m) & F.contains(run, F.lit(LITERAL)))).select(
            "lang", F.lit(m).alias("size"), F.replace(run, F.lit(LITERAL), F.lit("")).alias("phrase"), "f"))
        shorter = F.when(size == m, F.substring_index(run, " ", m - 1) if m > 1 else F.lit("")).otherwise(run)
        level = level.select("lang", shorter.alias("run"), "f").groupBy("lang", "run").agg(F.sum("f").alias("f"))
    if longest > 3:
        found.append(level.select("lang", F.lit(0).alias("size"), "run", "f"))
    out = found[0]
    for part in found[1:]:
        out = out.union(part)
    return out


def flows(spark, docs, text, lang, longest, least, common):
    """(lang, size, phrase, f) of all phrases of 1 to `longest` words that occur `least` times; size 0: all words of a lang.

    The longest runs are counted once. A shorter phrase has the sum of the edges that leave its node, plus the
    runs that end with it at the end of a piece. Of the words that occur `least` times in all texts at most `common` of
    the most frequent have numbers (the bound of the broadcast). If others are left over, runs that hold one are counted
    spelled out as well; a word that occurs less often is in no phrase asked for.
    """
    counted = tables.store(spark, lexicon.counts(docs, text, BLANKS, BREAKS).where(F.col("n") >= least), "words")
    chosen = lexicon.frequent(counted, min(common, COMMON)).column("word").combine_chunks()
    spelled = longest > 3 or counted.count() > len(chosen)
    names = spark.sparkContext.broadcast(chosen)
    runs = emitted(docs, text, lang, longest, names, spelled)
    parts = []
    if longest <= 3:
        # without spelled runs there is nothing to take apart: each of the two is read by one plan
        parts.append(numbered_flows(runs.where("run IS NULL").select("lang", "key"), least, longest, names))
    if spelled:
        parts.append(spelled_flows(runs.where("run IS NOT NULL").select("lang", "run"), least, longest))
    made = tables.store(spark, parts[0] if len(parts) == 1 else parts[0].union(parts[1]), "flows")
    names.destroy()
    return made


def paths(spark, edges, longest):
    """Edges (lang, phrase, f) compacted: one row (lang, words, counts) for each path through unary nodes.

    A node with one edge in and one edge out joins them. Every edge finds the first edge of its path by doubling
    pointers, each round written to the shared folder. `counts[i]` belongs to the words i to i + longest - 1. Rows
    hold at most STRETCH edges, a longer path is several rows; edges of a closed ring of unary nodes stay apart.
    """
    rows = tables.store(spark, edges.select(
        F.monotonically_increasing_id().alias("id"), "lang", "phrase", "f",
        F.substring_index("phrase", " ", longest - 1).alias("tail"),
        F.substring_index("phrase", " ", 1 - longest).alias("head")), "edges")
    into = rows.groupBy("lang", F.col("head").alias("node")).agg(F.count("*").alias("n"), F.min("id").alias("up")).where("n = 1")
    out = rows.groupBy("lang", F.col("tail").alias("node")).agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1")
    links = into.drop("n").join(out.drop("n"), ["lang", "node"]).select("id", "up")
    state = tables.store(spark, rows.select("id").join(links, "id", "left").select(
        "id", F.coalesce("up", "id").alias("first"), F.when(F.col("up").isNull(), F.lit(0)).otherwise(F.lit(1)).cast(
            "bigint").alias("hops"), F.col("up").isNotNull().alias("open")), "pointers")
    before, left = -1, state.where("open").count()
    while left and left != before:  # a round that closes nothing has only rings before it
        nxt = state.select(F.col("id").alias("first"), F.col("first").alias("_first"), F.col("hops").alias("_hops"),
                           F.col("open").alias("_open"))
        moved = state.where("open").join(nxt, "first").select(
            "id", F.col("_first").alias("first"), (F.col("hops") + F.col("_hops")).alias("hops"), F.col("_open").alias("open"))
        state = tables.store(spark, state.where("NOT open").unionByName(moved), "pointers")
        before, left = left, state.where("open").count()
    placed = state.select("id", F.when(F.col("open"), F.col("id")).otherwise(F.col("first")).alias("first"),
                          F.when(F.col("open"), F.lit(0)).otherwise(F.col("hops")).alias("hops"))
    inside = rows.join(placed, "id").groupBy("lang", "first", F.floor(F.col("hops") / STRETCH).alias("stretch")).agg(
        F.sort_array(F.collect_list(F.struct("hops", "phrase", "f"))).alias("e"))
    last = F.transform(F.slice("e", 2, F.size("e")), lambda x: F.substring_index(x["phrase"], " ", -1))
    return inside.select("lang", F.concat(F.split(F.get("e", F.lit(0))["phrase"], " "), last).alias("words"),
                         F.col("e.f").alias("counts"))


def exact_score(a, l, r):
    """floor(1000000 * a * a / (l * r)) in whole numbers of up to 38 digits."""
    n = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")
    return F.floor(F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * n(a, 16) * n(a, 16), n(l, 19) * n(r, 19)))


def collocations(spark, docs, text="text", lang="lang", longest=3, least=10, share=50, top=2000, common=COMMON):
    """The first `top` phrases of 2 to `longest` words of each lang: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased in A-Z, cut into pieces at `.,;:!?` and line ends and into words at spaces and tabs. `a` is how
    often a phrase occurs (`least` times at least), `l` and `r` how often the parts of its worst cut do, `n` all words of
    the lang, score floor(1000000 a a / (l r)). A phrase inside a longer candidate that has `share` percent of its
    occurrences is dropped. Order: score, a descending, phrase in byte order.

    At most `common` of the most frequent words have numbers in what is shuffled (a bounded broadcast); runs with others
    are counted as strings, with the same result. Counts are sums before they are shuffled, so a frequent phrase is one row per task; candidates meet their parts by
    equality in tables of phrases that occur `least` times. A longer candidate of more than one word more need not be
    looked at: the phrase one word longer inside it occurs at least as often and is a candidate too.

    A null text counts as empty and a null lang as `und`; keys are not read, so repeated rows count each time. Empty
    texts and tables give no rows; very long texts are only rows of words. Other columns are not read.
    """
    tables.short_batches(spark)
    known = flows(spark, docs, text, lang, longest, least, common)
    made = tables.store(spark, paths(spark, known.where(F.col("size") == longest), longest), "paths")
    at = made.select("lang", "words", F.posexplode("counts").alias("i", "a"))
    edges = at.select("lang", F.concat_ws(" ", F.slice("words", F.col("i") + 1, F.lit(longest))).alias("phrase"),
                      F.lit(longest).alias("size"), "a")
    nodes = known.where((F.col("size") > 1) & (F.col("size") < longest)).select("lang", "phrase", "size", F.col("f").alias("a"))
    candidates = tables.store(spark, edges.unionByName(nodes), "candidates")
    around = candidates.where("size > 2").select("lang", F.explode(F.array(
        F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)"))).alias("phrase"), "a")
    longer = around.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * share))
    cut = kept.select("lang", "phrase", "a", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("rest"))
    part = known.where((F.col("size") > 0) & (F.col("size") < longest))
    scored = cut.join(part.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(
        part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    worst = scored.withColumn("score", exact_score("a", "l", "r")).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("w"))
    total = known.where("size = 0").select("lang", F.col("f").alias("n"))
    flat = worst.select("lang", "phrase", "a", "w.l", "w.r", F.col("w.score").alias("score"))
    ranked = tables.first_of_each(flat, ["lang"], [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
