"""Schemas and readers of landed feed payloads."""

from pyspark.sql import functions as F

# Nested payload shapes, as the feeds deliver them.
NVD_ITEM = (
    "cve struct<id:string, published:string, lastModified:string,"
    " descriptions:array<struct<lang:string,value:string>>,"
    " metrics:struct<cvssMetricV31:{m}, cvssMetricV30:{m}>,"
    " weaknesses:array<struct<type:string,description:array<struct<lang:string,value:string>>>>,"
    " configurations:array<struct<nodes:array<struct<cpeMatch:array<struct<vulnerable:boolean,criteria:string>>>>>>>"
).format(m="array<struct<type:string,cvssData:struct<baseScore:double,vectorString:string,baseSeverity:string>>>")
KEV_ITEM = "cveID string, vendorProject string, product string, dateAdded string"
GHSA_NODE = (
    "advisory struct<ghsaId:string, severity:string, summary:string, description:string, publishedAt:string,"
    " updatedAt:string, withdrawnAt:string, cvss:struct<score:double,vectorString:string>,"
    " cwes:array<struct<cweId:string>>, identifiers:array<struct<type:string,value:string>>>,"
    " package struct<ecosystem:string,name:string>")
OSV_ITEM = (
    "id string, aliases array<string>, severity array<struct<type:string,score:string>>,"
    " database_specific struct<cvss_score:double,base_score:double,severity:string,cwe_ids:array<string>>,"
    " published string, modified string")
EPSS_ITEM = "cve string, epss string"
STATUSPAGE_INCIDENT = (
    "id string, name string, status string, impact string, created_at string, resolved_at string,"
    " components array<struct<name:string>>, incident_updates array<struct<status:string,body:string>>")
AWS_EVENT = (
    "eventArn string, eventTypeCategory string, statusCode string, startTime string, endTime string,"
    " service string, eventDescription struct<latestDescription:string>")
SALESFORCE_INCIDENT = (
    "id string, message string, messageType string, createdAt string, created_at string, updatedAt string,"
    " updated_at string, resolvedAt string, resolved_at string, instanceKeys array<string>,"
    " affectedInstances array<struct<key:string>>")
GCP_INCIDENT = (
    "id string, severity string, begin string, end string, external_desc string,"
    " affected_products array<string>, updates array<struct<text:string>>")
ATOM_ENTRY = "id string, title string, summary string, published string"
GITHUB_COMMIT = "sha string, author struct<login:string>, commit struct<author:struct<date:string>>"
GITHUB_ISSUE = (
    "number bigint, title string, body string, state string, created_at string, closed_at string,"
    " labels array<struct<name:string>>")

# envelope field that holds the items; None where the file is a plain list or one object per file
ENVELOPES = {
    "nvd": ("vulnerabilities", NVD_ITEM),
    "kev": ("vulnerabilities", KEV_ITEM),
    "ghsa": ("nodes", GHSA_NODE),
    "osv": (None, OSV_ITEM),
    "epss": ("data", EPSS_ITEM),
    "statuspage": ("incidents", STATUSPAGE_INCIDENT),
    "aws": ("events", AWS_EVENT),
    "gcp": (None, GCP_INCIDENT),
    "github_commits": (None, GITHUB_COMMIT),
    "github_issues": (None, GITHUB_ISSUE),
}


def as_struct(ddl):
    """A `name type, ...` column list as one struct type, top-level separators turned to colons."""
    out = []
    for part in split_top(ddl):
        name, kind = part.strip().split(" ", 1)
        out.append(f"`{name}`:{kind.strip()}")
    return f"struct<{','.join(out)}>"


def split_top(ddl):
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(ddl):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(ddl[start:i])
            start = i + 1
    return parts + [ddl[start:]]


def read_feed(spark, path, feed, multi_line=True):
    """Landed payload files of a feed, one row per item."""
    if feed == "salesforce":
        return read_salesforce(spark, path)
    field, item = ENVELOPES[feed]
    reader = spark.read.option("multiLine", str(multi_line).lower())
    if field is None:
        return reader.schema(item).json(path)
    pages = reader.schema(f"`{field}` array<{as_struct(item)}>").json(path)
    return pages.select(F.explode(field).alias("item")).select("item.*")


def read_salesforce(spark, path, whole=True):
    """A list of incidents, or an object with the list under `data` or `incidents`.

    One document per file, or with `whole=False` one per line.
    """
    items = f"array<{as_struct(SALESFORCE_INCIDENT)}>"
    text = spark.read.text(path, wholetext=whole)
    doc = text.select(F.try_parse_json("value").alias("v"))
    pick = lambda where: F.try_variant_get("v", where, "variant")
    body = F.coalesce(pick("$.data"), pick("$.incidents"), F.col("v"))
    return doc.select(F.explode(F.from_json(F.to_json(body), items)).alias("item")).select("item.*")


def read_atom(spark, path, prefix=None):
    """Entries of an Atom feed: without a namespace, with a default one, or with a prefix on every tag.

    Prefixed entries are cut at their end tag, which keeps large files splittable, and lose the
    prefix before they are parsed.
    """
    if prefix is None:
        return spark.read.format("xml").option("rowTag", "entry").schema(ATOM_ENTRY).load(path)
    pieces = spark.read.option("lineSep", f"</{prefix}:entry>").text(path)
    body = F.nullif(F.regexp_extract("value", f"(?s)<{prefix}:entry[^>]*>(.*)$", 1), F.lit(""))
    plain = F.concat(F.lit("<entry>"), F.regexp_replace(body, f"<(/?){prefix}:", "<$1"), F.lit("</entry>"))
    return pieces.select(F.from_xml(plain, ATOM_ENTRY).alias("e")).filter(F.col("e").isNotNull()).select("e.*")
