"""Repeated runs of lines: winnowed fingerprints, runs around them grouped, later runs deleted."""

from pyspark.sql import functions as F

GRAM = 2  # lines in a fingerprint
WINDOW = 2  # neighbouring fingerprints of which the least is kept
RUN = GRAM + WINDOW - 1  # every repeated run of so many lines shares a kept fingerprint
LONG = 50  # words from which fewer lines are a run as well
WORD = r"[^\x20\x09-\x0D]+"


def _lines(df, key, text):
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.when(F.length(F.col(text)) > 0, F.split(F.col(text), "\n", -1)).otherwise(F.array().cast("array<string>"))
    return df.select(F.col(key).alias("_key"), lines.alias("_lines"), F.xxhash64(body).alias("_text"),
                     F.col(key).isNull().alias("_null"))


def _windows(rows):
    """One row per run: its document, start, number of lines, hash, and its winnowed fingerprint.

    A run is RUN lines, or fewer lines that hold LONG words; these are fingerprints of their own.
    """
    hashes = rows.select(
        "_null", "_key", "_text", F.transform("_lines", lambda x: F.xxhash64(x)).alias("h"),
        F.transform("_lines", lambda x: F.regexp_count(x, F.lit(WORD))).alias("c")).distinct()
    at = lambda p, n: F.slice("h", p + 1, n)
    grams = lambda p: F.array_min(F.array(*[F.struct(F.xxhash64(at(p + i, GRAM)).alias("f"), (-(p + i)).alias("q"))
                                            for i in range(WINDOW)]))["f"]
    words = lambda p, n: sum((F.get("c", p + i) for i in range(1, n)), F.get("c", p))
    starts = lambda n: F.when(F.size("h") >= n, F.sequence(F.lit(0), F.size("h") - n)).otherwise(
        F.array().cast("array<int>"))
    each = lambda n, found: F.transform(found, lambda p: F.struct(
        p.alias("start"), F.lit(n).alias("n"), F.xxhash64(F.lit(n), at(p, n)).alias("run"),
        (grams(p) if n == RUN else F.xxhash64(F.lit(n), at(p, n))).alias("print")))
    full = lambda n: F.filter(starts(n), lambda p: words(p, n) >= LONG)
    runs = [each(n, full(n)) for n in range(1, RUN)]
    return hashes.select("_null", "_key", "_text", F.inline(F.concat(each(RUN, starts(RUN)), *runs)))


def repeated_lines(df, key="doc_id", text="text"):
    """Per row: key, n_lines, n_removed, kept (the text left), DataFrame functions only.

    Lines are what newlines separate. A run is RUN lines, or one line or more that hold LONG words `[^\\x20\\x09-\\x0D]+`
    together, in texts of any number of lines. Every line of a run that starts earlier, in the text of a smaller key or
    further ahead in its own, goes; longer repeats are unions of such runs, so a match grows both ways as far as the
    lines agree.

    Fingerprints of GRAM lines are winnowed: of WINDOW neighbours the least stays. Only runs whose fingerprint comes twice
    or more are grouped, by the hash of the run; the first position of each is a grouped minimum (combined before the
    shuffle) and joined back by equality. No pairs of a group are made.

    A null or empty text has no lines and stays. Null keys come last; texts of one key are ordered by their
    hash; rows that repeat key and text count as one and get equal results. Other columns are not read.
    An empty table gives no rows. Runs are compared by 64-bit hashes of line hashes.
    """
    rows = _lines(df, key, text)
    windows = _windows(rows)
    prints = windows.groupBy("print").agg(F.count("*").alias("times")).where("times > 1").select("print")
    near = windows.join(prints, "print")
    place = F.struct("_null", "_key", "_text", "start")
    first = near.groupBy("n", "run").agg(F.min(place).alias("first"), F.count("*").alias("times")).where("times > 1")
    later = near.join(first, ["n", "run"]).where(place > F.col("first"))
    covered = F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1))
    gone = later.groupBy("_null", "_key", "_text").agg(F.collect_set(F.struct("start", "n")).alias("spans")).select(
        "_key", "_text", F.array_distinct(F.flatten(covered)).alias("gone"))
    same = (F.col("r._text") == F.col("g._text")) & F.col("r._key").eqNullSafe(F.col("g._key"))
    joined = rows.alias("r").join(gone.alias("g"), same, "left").select("r._key", "r._lines", "g.gone")
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "gone")
    kept = F.when(F.col("gone").isNull(), F.col("_lines")).otherwise(
        F.transform(stay, lambda i: F.get("_lines", i)))
    return joined.withColumn("left", kept).select(
        F.col("_key").alias(key), F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("left")).cast("long").alias("n_removed"), F.array_join("left", "\n").alias("kept"))
