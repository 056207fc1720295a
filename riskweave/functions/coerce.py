"""Value normalisation: vocabularies, safe numbers, flags, timestamps."""

from itertools import chain

from pyspark.sql import functions as F

from riskweave import constants as C


def as_col(value):
    return F.col(value) if isinstance(value, str) else value


# Characters that a text strip removes, and the line ends of a text.
SPACES = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
          "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def strip(col):
    """Trim every kind of white space on both sides, not only blanks."""
    return F.btrim(as_col(col), F.lit(SPACES))


def filled(col):
    """The value, with empty text read as NULL."""
    return F.nullif(as_col(col), F.lit(""))


def literal_map(pairs):
    """A constant map column from a small dict."""
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in pairs.items()))


def map_severity(col, source):
    """Closed severity vocabulary of a feed; anything else is NONE.

    The advisory feed compares as written, the other two in upper case.
    """
    word = as_col(col)
    if source != "ghsa":
        word = F.upper(word)
    return F.coalesce(F.try_element_at(literal_map(C.SEVERITY_WORDS[source]), word), F.lit("NONE"))


def norm_ecosystem(col):
    """Canonical ecosystem name; unknown names pass unchanged."""
    name = as_col(col)
    return F.coalesce(F.try_element_at(literal_map(C.ECOSYSTEM_NAMES), F.lower(name)), name)


def norm_timestamp(col):
    """First 19 characters of an ISO text as a timestamp; empty or unreadable is NULL."""
    text = F.replace(F.left(as_col(col), F.lit(19)), F.lit("T"), F.lit(" "))
    return F.nullif(text, F.lit("")).try_cast("timestamp_ntz")


def iso_text(col):
    """A timestamp as `yyyy-MM-dd HH:mm:ss`."""
    return F.date_format(as_col(col), "yyyy-MM-dd HH:mm:ss")


def safe_num(col, dtype="double", default=0):
    """Cast, with NULL and unreadable values replaced by the default."""
    return F.coalesce(as_col(col).try_cast(dtype), F.lit(default).cast(dtype))


def bool01(col):
    """true/false/number texts to a 0/1 style number; unreadable is 0."""
    word = F.lower(F.trim(as_col(col).cast("string")))
    return (
        F.when(word == "true", F.lit(1.0))
        .when(word == "false", F.lit(0.0))
        .otherwise(F.coalesce(word.try_cast("double"), F.lit(0.0)))
    )


def enforce(df, schema):
    """Project to a schema: cast what is there, NULL for what is not, drop the rest."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def rename_id(df, new="service_id"):
    return df.withColumnRenamed("id", new)
