"""Exact duplicates: 128-bit content hash groups, byte comparison inside groups, one row stays."""

from pyspark.sql import functions as F


def content_hash(text):
    """128 bits of the text."""
    return F.unhex(F.md5(text))


SALTS = 16  # parts of a group where its rows meet a join


def exact_dedup(df, key="doc_id", text="text", hashed=content_hash, largest=True):
    """Duplicate class of every row: `key`, keep_id, group_size, kept, text_sha256.

    Rows are grouped by `hashed(text)`, which combines before the shuffle, so a hot group costs one row
    per task. Only groups of several rows carry their texts on: they meet these groups by (hash, salt), SALTS
    parts a group, and are grouped by (hash, bytes), which leaves one copy of a text per part before it is
    shuffled. A hash that turns out to have two byte strings is a collision; its rows find their class by bytes, all
    others by hash. The verdict meets the rows by (hash, salt) as well; rows alone in their group meet none.

    A null text counts as empty. A null key is below every other; a class of null keys only has a
    null keep_id and stays. Rows that repeat both key and text stay or go together. Other columns,
    whatever their names, are not read. An empty table gives no rows.
    """
    rows = df.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("_hash", hashed(F.col("_text"))).withColumn(
        "_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    salted = lambda side: side.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    best = F.max("_key") if largest else F.min("_key")
    groups = rows.groupBy("_hash").agg(F.count("*").alias("_n"), best.alias("_best")).where("_n > 1")
    variants = rows.join(salted(groups.select("_hash")), ["_hash", "_salt"]).groupBy("_hash", "_text").agg(
        F.count("*").alias("_vn"), best.alias("_vbest"))
    found = F.collect_list(F.struct(F.sha2("_text", 256).alias("_sha"), "_vn", "_vbest")).alias("_found")
    exact = variants.groupBy("_hash").agg(found).where(F.size("_found") > 1).select("_hash", F.inline("_found"))
    classes = groups.join(exact, "_hash", "left").select(
        "_hash", "_sha", F.coalesce("_vn", "_n").alias("_size"),
        F.when(F.col("_vn").isNotNull(), F.col("_vbest")).otherwise(F.col("_best")).alias("_keep"))
    digests = rows.select("_key", "_hash", "_salt", F.sha2("_text", 256).alias("text_sha256")).alias("d")
    same = ((F.col("d._hash") == F.col("c._hash")) & (F.col("d._salt") == F.col("c._salt"))
            & (F.col("c._sha").isNull() | (F.col("c._sha") == F.col("d.text_sha256"))))
    keep = F.when(F.col("_size").isNull(), F.col("_key")).otherwise(F.col("_keep"))
    return digests.join(salted(classes).alias("c"), same, "left").select(
        F.col("_key").alias(key), keep.alias("keep_id"), F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_key").eqNullSafe(keep).alias("kept"), "text_sha256")


def drop_copies(df, key="doc_id", text="text"):
    """The rows of `df` that stay, with all their columns."""
    verdict = exact_dedup(df, key, text).where("kept").select(
        F.col(key).alias("_key"), F.col("text_sha256").alias("_sha")).distinct()
    match = (F.col(f"f.{key}").eqNullSafe(F.col("v._key"))) & (
        F.sha2(F.coalesce(F.col(f"f.{text}"), F.lit("")), 256) == F.col("v._sha"))
    return df.alias("f").join(verdict.alias("v"), match, "left_semi")
