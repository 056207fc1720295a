"""Registered queries of this package and their reference SQL."""

from pyspark.sql import functions as F

from riskweave.llm import (alignment, ann, bpe, exact_dedup, html_text, jaccard, language, language_model,
                           line_dedup, mixing, phrases, sharding, substring_dedup, tables)


def op1_html_extraction(spark, sf):
    return html_text.extract_main_text(tables.read(spark, sf, "pages"))


def op2_exact_dedup(spark, sf):
    return exact_dedup.exact_dedup(tables.read(spark, sf, "documents"))


OP2_SQL = """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
 doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
 FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""


def op3_ngram_jaccard_join(spark, sf):
    return jaccard.near_duplicates(spark, tables.read(spark, sf, "documents"), k=3, p=90, q=100)


def op4_sharding(spark, sf):
    return sharding.assign_shards(spark, tables.read(spark, sf, "documents"), shards=24)


def op5_substring_dedup(spark, sf):
    return substring_dedup.remove_repeats(spark, tables.read(spark, sf, "documents"), length=20)


def op6_language_id(spark, sf):
    """Language of every page; the text model is fitted on the labelled documents."""
    pages = tables.read(spark, sf, "pages")
    model = language.fit(spark, tables.read(spark, sf, "documents"))
    declared = F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z]+)", 1))
    plain = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    found = language.identify(
        spark, model, pages.select("page_id", "url", declared.alias("declared"), plain.alias("text")),
        "page_id", "text", declared="declared", url="url")
    return found.select("page_id", "lang", F.round("confidence", 6).alias("confidence"), "n_trigrams", "accepted")


def tokenizer(path=None):
    """(tokens by id, split pattern) of the rank file at `path`, or of the installed multilingual one."""
    import public_tokenizers

    return bpe.read_ranks(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def op7_byte_bpe(spark, sf):
    tokens, pattern = tokenizer()
    done = bpe.encode(spark, tables.read(spark, sf, "documents"), tokens, pattern)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_source_mixing(spark, sf):
    return mixing.mix_sources(spark, tables.read(spark, sf, "documents")).drop("digest")


def op9_line_dedup(spark, sf):
    return line_dedup.repeated_lines(tables.read(spark, sf, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
 unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents WHERE text <> ''),
r AS (SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w, lead(line, 1) OVER d AS b,
 lead(line, 2) OVER d AS c FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
m AS (SELECT doc_id, pos, 3 AS n, line, b, c FROM r WHERE c IS NOT NULL
 UNION ALL SELECT doc_id, pos, 2, line, b, NULL FROM (SELECT *, w + lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS two FROM r)
 WHERE two >= 50 UNION ALL SELECT doc_id, pos, 1, line, NULL, NULL FROM r WHERE w >= 50),
s AS (SELECT doc_id, pos, n, row_number() OVER (PARTITION BY n, line, b, c ORDER BY doc_id, pos) AS nth FROM m),
g AS (SELECT DISTINCT doc_id, pos + k AS pos FROM s, (SELECT unnest(range(3)) AS k) WHERE nth > 1 AND k < n),
j AS (SELECT l.doc_id, l.pos, l.line, g.pos IS NOT NULL AS gone FROM l LEFT JOIN g USING (doc_id, pos)),
a AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS r,
 coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept FROM j GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_lines, coalesce(r, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN a USING (doc_id)"""


def op10_nearest_neighbours(spark, sf):
    return ann.search(spark, tables.read(spark, sf, "embeddings"), F.pmod(F.col("key"), F.lit(20)) == 0)


def op11_lm_scoring(spark, sf):
    return language_model.score_texts(spark, tables.read(spark, sf, "documents"))


def op12_phrase_collocations(spark, sf):
    return phrases.collocations(spark, tables.read(spark, sf, "documents"), longest=3, least=10, share=50, top=2000)


OP12_SQL = r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
 FROM w, (SELECT unnest([1, 2, 3]) AS m)),
f AS (SELECT lang, m, phrase, count(*)::HUGEINT AS f, string_split(phrase, ' ') AS w FROM g GROUP BY lang, m, phrase),
n AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE m > 1 AND f >= 10),
o AS (SELECT lang, phrase, max(f) AS most FROM (SELECT lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')])
 AS phrase FROM c WHERE m = 3) GROUP BY lang, phrase),
k AS (SELECT c.lang, c.phrase, c.f, c.w, unnest(range(1, m)) AS k FROM c LEFT JOIN o USING (lang, phrase)
 WHERE most IS NULL OR 100 * most < 50 * c.f),
s AS (SELECT k.lang, k.phrase, k.f AS a, k.k, l.f AS l, r.f AS r, (1000000 * k.f * k.f) // (l.f * r.f) AS score FROM k
 JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.w[1:k.k], ' ')
 JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[k.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a,
 l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM b JOIN n USING (lang) QUALIFY rank <= 2000"""


def op13_tokenizer_alignment(spark, sf):
    import public_tokenizers

    first, second = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(spark, tables.read(spark, sf, "documents"), lambda: alignment.ByteLevel(first),
                           lambda: alignment.Pieces(second))


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_exact_dedup, op3_ngram_jaccard_join, op4_sharding, op5_substring_dedup, op6_language_id,
    op7_byte_bpe,
    op8_source_mixing, op9_line_dedup, op10_nearest_neighbours, op11_lm_scoring, op12_phrase_collocations, op13_tokenizer_alignment)}
ORACLES = {"op2_exact_dedup": OP2_SQL, "op9_line_dedup": OP9_SQL, "op12_phrase_collocations": OP12_SQL}
