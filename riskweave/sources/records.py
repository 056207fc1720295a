"""Landed payload files read record by record: broken ones are set aside with their text, the others go on."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.sources.feeds import ENVELOPES, SALESFORCE_INCIDENT, as_struct

CORRUPT = "_corrupt"
# what is wrong with a rejected record
DOCUMENT, ENVELOPE, ITEM = "document", "envelope", "item"


def parsed(text, ddl):
    """JSON text as a struct whose `_corrupt` field holds the text where it does not fit; NULL where it is empty."""
    return F.from_json(text, f"struct<{ddl},`{CORRUPT}`:string>", {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def broken(doc):
    return doc.isNull() | doc[CORRUPT].isNotNull()


def as_list(text):
    """A list, or one object as a list of it, as the document {"items": [...]}."""
    some = F.when(F.ltrim(text).startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    return F.concat(F.lit('{"items":'), some, F.lit("}"))


def salesforce_body(text):
    """The list under `data` or `incidents`, else the document itself; NULL where the text is no JSON."""
    doc = F.try_parse_json(text)
    pick = lambda where: F.try_variant_get(doc, where, "variant")
    return F.to_json(F.coalesce(pick("$.data"), pick("$.incidents"), doc))


def read_records(spark, path, feed, multi_line=True):
    """(feed, file, position, item, error, raw): one row per item of the landed files of a feed, broken ones too.

    `error` is NULL where the item fits the feed's schema. Else it says what is broken: the `document` (no JSON, or a
    list that is none), the `envelope` (the list's field is absent or null), or the `item` (null, no object, or a value of
    another type); `raw` holds the text. A broken item leaves the others of its document alone. A broken document is
    one row of position -1 and its items are not read. Lists without items give no rows.

    Each file is a document, or with `multi_line=False` each line that is not blank; the latter splits large files. An empty
    file is a broken document.
    """
    text = spark.read.text(path, wholetext=multi_line).select(
        F.col("_metadata.file_path").alias("file"), "value")
    if not multi_line:
        text = text.filter(F.trim("value") != "")
    field, item = ("items", SALESFORCE_INCIDENT) if feed == "salesforce" else ENVELOPES[feed]
    body = as_list(salesforce_body(F.col("value"))) if feed == "salesforce" else (
        F.col("value") if field else as_list(F.col("value")))
    # items stay text here, so that each is judged by itself
    docs = text.select("file", "value", parsed(body, f"`{field or 'items'}`:array<string>").alias("doc"))
    listed = F.col("doc")[field or "items"]
    wrong = F.when(broken(F.col("doc")), DOCUMENT).when(listed.isNull(), ENVELOPE)
    items = docs.withColumn("wrong", wrong).select(
        "file", "wrong", F.posexplode(F.when(F.col("wrong").isNull(), listed).otherwise(F.array("value"))).alias(
            "position", "raw"))
    fields = as_struct(item).removeprefix("struct<").removesuffix(">")
    judged = items.withColumn("item", F.when(F.col("wrong").isNull(), parsed(F.col("raw"), fields)))
    return judged.select(
        F.lit(feed).alias("feed"), "file", F.when(F.col("wrong").isNull(), F.col("position")).otherwise(-1).alias("position"),
        F.col("item").dropFields(CORRUPT).alias("item"),
        F.coalesce("wrong", F.when(broken(F.col("item")), ITEM)).alias("error"), "raw")


def accepted(records, collected_at=None, keep=()):
    """Items that fit, as columns, with their landed text and the time they were collected, which normalisers carry
    on; `keep` names further columns of `records`, such as `file`."""
    good = records.filter(F.col("error").isNull())
    return good.select("item.*", *keep, F.col("raw").alias("raw_json"),
                       F.lit(collected_at).cast("timestamp_ntz").alias("collected_at"))


def rejected(*records):
    """Records that do not fit, of one or more feeds, with what is wrong and their text."""
    return reduce(DataFrame.unionByName, [
        r.filter(F.col("error").isNotNull()).select("feed", "file", "position", "error", "raw") for r in records])


def record_counts(*records):
    """Records of every feed by what is wrong with them; `accepted` where nothing is."""
    rows = reduce(DataFrame.unionByName, [
        r.select("feed", F.coalesce("error", F.lit("accepted")).alias("error")) for r in records])
    return rows.groupBy("feed", "error").agg(F.count("*").alias("n"))
