"""Language identification by Bayesian fusion of text, declared language, address and host evidence."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskweave.llm import tables, words

BUCKETS = 1 << 14  # of hashed byte trigrams
WEIGHT = 48.0  # trigrams' worth of evidence that a text has at most; trigrams of one text are far from independent
PRIOR = 4.0  # pseudo-count at each level of the host prior
_U = np.uint64


def _trigrams(column):
    """(bucket of every byte trigram inside one row's text, row of it); A-Z folded, other than letters as space."""
    w = words.Words(column, lower=False)
    data = w.data.copy()
    upper = (data >= 65) & (data <= 90)
    data[upper] += 32
    data[((data < 97) | (data > 122)) & (data < 128)] = 32
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a = data.astype(np.uint64)
    code = a[:-2] << _U(16) | a[1:-1] << _U(8) | a[2:]
    row = np.repeat(np.arange(w.rows), np.diff(w.offsets))
    # blank stretches say nothing
    use = (row[2:] == row[:-2]) & ~((data[1:-1] == 32) & ((data[:-2] == 32) | (data[2:] == 32)))
    return (words.mix(code[use]) >> _U(40)).astype(np.int64) % BUCKETS, row[:-2][use]


class Model:
    """log P(trigram bucket | language), languages in order; its size is languages * BUCKETS numbers."""

    def __init__(self, languages, table):
        self.languages, self.table = languages, table

    def evidence(self, column):
        """Per row: tempered log-likelihood of each language, and the number of trigrams."""
        bucket, row = _trigrams(column)
        n = np.bincount(row, minlength=len(column))
        out = np.stack([np.bincount(row, weights=t[bucket], minlength=len(column)) for t in self.table], axis=1)
        return out / np.maximum(n, 1)[:, None] * np.minimum(n, WEIGHT)[:, None], n


def fit(spark, df, text="text", language="lang"):
    """A model from all rows with a text and a language: trigram counts are summed by grouped aggregation."""

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, 0):
                bucket, row = _trigrams(part.column(0))
                names = np.array(part.column(1).to_pylist(), dtype=object)
                langs, buckets, counts = [], [], []
                for name in set(names.tolist()):
                    total = np.bincount(bucket[(names == name)[row]], minlength=BUCKETS)
                    some = np.flatnonzero(total)
                    langs += [name] * len(some)
                    buckets.append(some)
                    counts.append(total[some])
                flat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()), pa.array(flat(buckets), pa.int64()), pa.array(flat(counts), pa.int64())],
                    names=["lang", "bucket", "n"])

    labelled = df.where(F.col(text).isNotNull() & F.col(language).isNotNull()).select(text, language)
    counts = labelled.mapInArrow(run, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique().tolist())
    table = np.full((len(languages), BUCKETS), 0.5)
    table[[languages.index(x) for x in counts["lang"]], counts["bucket"].to_numpy()] += counts["n"].to_numpy()
    return Model(languages, np.log(table / table.sum(axis=1, keepdims=True)))


def address(url):
    """(host, domain, suffix) of an address column: authority without user and port, its last two labels, its last."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return host, F.substring_index(host, ".", -2), F.substring_index(host, ".", -1)


def _smoothed(counts, parent, size):
    """(counts + PRIOR * parent) / (their sum + PRIOR), element by element."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, parent, lambda c, p: (c + F.lit(PRIOR) * p) / (total + F.lit(PRIOR)))


def identify(spark, model, df, key, text, declared=None, url=None, host=None, least=0.5):
    """Per row: key, lang, confidence, n_trigrams, accepted.

    The log posterior adds the tempered text likelihood, the host's prior, and how often the declared language and the
    address's suffix with the language code of its path go with a language. The last three are counts over all rows by
    the language that the text alone says, pre-aggregated, smoothed from the whole table to suffix to domain to host.
    Rows join their host's prior by equality, so a host with a third of all rows is split by adaptive execution.

    `declared`, `url` and `host` are columns or None; `host` is taken as it is where there is no address. A null
    text counts as empty; its language comes from the other evidence, but a text without a letter is not
    accepted, nor one below a confidence of `least`. Nulls and empty strings in declared or address columns
    are values like others. Rows come back once each; other columns are not read. An empty table gives no rows.
    """
    if not model.languages:
        kind = df.schema[key].dataType.simpleString()
        return df.select(key, F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"),
                         F.lit(0).cast("long").alias("n_trigrams"), F.lit(False).alias("accepted"))
    none, count = F.lit(""), len(model.languages)
    place = address(F.col(url)) if url else (F.coalesce(F.col(host), none) if host else none, none, none)
    code = F.regexp_extract(F.coalesce(F.col(url), none), r"^[^:]*://[^/?#]*/([A-Za-z]{2,3})(?:[/?#]|$)", 1) if url else none
    picked = df.select(
        F.col(key).alias("key"), F.coalesce(F.col(declared), none).alias("declared") if declared else none.alias("declared"),
        *[F.coalesce(c, none).alias(n) for c, n in zip(place, ("host", "domain", "suffix"))],
        F.coalesce(code, none).alias("code"), F.col(text).alias("text"),
        F.coalesce(F.rlike(F.col(text), F.lit(r"\p{L}")), F.lit(False)).alias("letters"))
    kind = picked.schema["key"].dataType.simpleString()
    shipped = spark.sparkContext.broadcast(model)

    def run(batches):
        known = shipped.value
        for batch in batches:
            for part in words.slices(batch, 6):
                score, n = known.evidence(part.column(6))
                said = np.where(n > 0, score.argmax(axis=1), -1)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in range(6)], pa.array(list(score), pa.list_(pa.float64())),
                     pa.array(n, pa.int64()), pa.array(said, pa.int32()), part.column(7)],
                    names=["key", "declared", "host", "domain", "suffix", "code", "score", "n", "said", "letters"])

    schema = (f"key {kind}, declared string, host string, domain string, suffix string, code string, "
              "score array<double>, n bigint, said int, letters boolean")
    rows = tables.store(spark, picked.mapInArrow(run, schema), "evidence")
    votes = F.array(*[F.count_if(F.col("said") == i).cast("double") for i in range(count)])
    whole = [c + 1.0 for c in rows.agg(votes).first()[0]]
    base = F.array(*[F.lit(c / sum(whole)) for c in whole])
    add = lambda c: F.array(*[F.sum(F.get(c, i)) for i in range(count)])
    hosts = rows.groupBy("host", "domain", "suffix").agg(votes.alias("c"))
    domains = hosts.groupBy("domain", "suffix").agg(add("c").alias("dc"))
    suffixes = domains.groupBy("suffix").agg(add("dc").alias("sc"))
    prior = hosts.join(domains.join(suffixes, "suffix"), ["domain", "suffix"]).withColumn(
        "p", _smoothed(F.col("sc"), base, count)).withColumn("p", _smoothed(F.col("dc"), F.col("p"), count)).select(
            "host", "domain", "suffix", _smoothed(F.col("c"), F.col("p"), count).alias("prior"))
    # P(value | language) of the declared language and of suffix and path code, one count for unseen values
    given = lambda c: F.zip_with(c, F.array(*[F.lit(x) for x in whole]), lambda a, b: F.log((a + 0.5) / (b + 1.0)))
    stated = rows.groupBy("declared").agg(given(votes).alias("e1"))
    coded = rows.groupBy("suffix", "code").agg(given(votes).alias("e2"))
    joined = rows.join(prior, ["host", "domain", "suffix"]).join(stated, "declared").join(coded, ["suffix", "code"])
    each = F.array(*[F.get("score", i) + F.log(F.get("prior", i)) + F.get("e1", i) + F.get("e2", i)
                     for i in range(count)])
    names = F.array(*[F.lit(x) for x in model.languages])
    done = joined.select("key", "n", "letters", each.alias("z")).withColumn("top", F.array_max("z")).withColumn(
        "sum", F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top"))))
    return done.select(
        F.col("key").alias(key), F.get(names, F.array_position("z", F.col("top")).cast("int") - 1).alias("lang"),
        (1 / F.col("sum")).alias("confidence"), F.col("n").alias("n_trigrams"),
        (F.col("letters") & (1 / F.col("sum") >= least)).alias("accepted"))


def accepted_documents(spark, df, key="doc_id", text="text", language="lang", source="source"):
    """The rows of `df` whose language is identified; the declared language and the source are evidence.

    The model is fitted on the rows themselves. A key of several rows stays if one of them is accepted.
    """
    model = fit(spark, df, text, language)
    found = identify(spark, model, df, key, text, declared=language, host=source).where("accepted").select(
        F.col(key).alias("_key")).distinct()
    return df.alias("f").join(found.alias("v"), F.col(f"f.{key}").eqNullSafe(F.col("v._key")), "left_semi")
