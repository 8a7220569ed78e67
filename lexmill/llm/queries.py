"""The operators of this subpackage as registered queries over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import chunk_recipes, collocations, decontaminate, language, lexical_search, licenses, media, near_duplicates, packing, quality, suffix_dedup, token_counts, url_filters
from lexmill.llm.tables import documents, keep


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _fold(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed_repeats(documents(spark, sf_dir))


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(packing.token_pieces(docs, _tokenizer("byte_bpe_50k.json"), ranks_path=_tokenizer("byte_bpe_50k.tiktoken")))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit(docs.filter(_fold(5) != 0))
    out = language.predict(docs, model)
    return out.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "languages")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), _tokenizer("piece_bpe_32k.model"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.license_blocks(documents(spark, sf_dir))
    return out.select("doc_id", "line", "license_id", "n_differences")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels.filter(_fold(3) != 1))
    out = quality.score(docs, model)
    return out.select("doc_id", F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


#: Captures: a page's fetch day follows from its id. List: hosts and domains whose hash says so,
#: added and removed on days that their hash says.
_FETCHED = "TIMESTAMP '2024-01-01 00:00:00' + (page_id * 37 % 366) * INTERVAL '1' DAY"


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", "url", F.expr(_FETCHED).alias("fetched"))


def _list(captures: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract("url", url_filters.HOST, 1))
    hosts = keep(captures.select(host.alias("host")).filter("host != ''").distinct())
    digit = lambda k: F.conv(F.substring(F.md5("value"), k, 2), 16, 10).cast("int")
    values = hosts.select(F.lit("host").alias("rule"), F.col("host").alias("value")).union(
        hosts.select(F.lit("domain").alias("rule"), F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1).alias("value")).filter("value != ''").distinct()
    ).union(hosts.select(F.lit("prefix"), F.concat("host", F.lit("/en/"))))
    first = values.filter(digit(1) < 128).withColumn("day", digit(3))
    added = first.select("rule", "value", F.lit("add").alias("action"), "day")
    removed = first.filter(digit(5) < 160).select("rule", "value", F.lit("remove"), F.col("day") + digit(7))
    again = first.filter(digit(9) < 64).select("rule", "value", F.lit("add"), F.col("day") + digit(7) + digit(11))
    rows = added.union(removed).union(again)
    return rows.select("rule", "value", "action", F.expr("TIMESTAMP '2024-01-01 00:00:00' + day * INTERVAL '1' DAY").alias("dated"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = _captures(spark, sf_dir)
    return url_filters.evaluate(captures, _list(captures))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.jaccard_components(documents(spark, sf_dir), words=4, percent=85)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(documents(spark, sf_dir))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chunk_recipes.deduplicate(documents(spark, sf_dir))
    return out.select(F.col("key").alias("doc_id"), F.col("keep").alias("keep_id"), "group_size", "kept", F.col("sha").alias("text_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_best_fit_packing, op3_language_id, op4_token_counts, op5_license_scan, op6_quality, op7_url_filters, op8_jaccard_join, op9_decontamination, op10_media, op11_collocations, op12_lexical_search, op13_exact_dedup, pipeline)}


def queries() -> dict:
    return dict(QUERIES)


def _license_sql() -> str:
    values = ", ".join(f"('{k}', '{' '.join(licenses.words(v))}')" for k, v in licenses.TEMPLATES.items())
    return f"""
WITH templates(license_id, wording) AS (VALUES {values}),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents WHERE text IS NOT NULL),
blocks AS (SELECT doc_id, line_no, ' ' || trim(regexp_replace(lower(line), '[^a-z0-9]+', ' ', 'g')) || ' ' AS wording FROM lines
  WHERE regexp_matches(line, '(?i)licen[cs]e|copyright|all rights reserved|public domain'))
SELECT doc_id, CAST(line_no AS INTEGER) AS line, arg_max(license_id, length(t.wording)) AS license_id, CAST(0 AS INTEGER) AS n_differences
FROM blocks b JOIN templates t ON contains(b.wording, ' ' || t.wording || ' ')
GROUP BY doc_id, line_no"""


def _url_sql() -> str:
    digit = lambda k: f"(16 * (strpos('0123456789abcdef', substr(md5(value), {k}, 1)) - 1) + strpos('0123456789abcdef', substr(md5(value), {k + 1}, 1)) - 1)"
    host, path = url_filters.HOST, url_filters.PATH
    return f"""
WITH captures AS (SELECT page_id, lower(regexp_extract(url, '{host}', 1)) AS host, regexp_extract(url, '{path}', 1) AS path,
  TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(page_id * 37 % 366 AS INTEGER)) AS fetched FROM pages),
hosts AS (SELECT DISTINCT host FROM captures WHERE host != ''),
rules AS (SELECT 'host' AS rule, host AS value FROM hosts
  UNION ALL SELECT DISTINCT 'domain', regexp_extract(host, '([^.]+\\.[^.]+\\.[^.]+)$', 1) FROM hosts WHERE regexp_extract(host, '([^.]+\\.[^.]+\\.[^.]+)$', 1) != ''
  UNION ALL SELECT 'prefix', host || '/en/' FROM hosts),
first AS (SELECT rule, value, {digit(3)} AS day, {digit(5)} AS d5, {digit(7)} AS d7, {digit(9)} AS d9, {digit(11)} AS d11 FROM rules WHERE {digit(1)} < 128),
entries AS (SELECT rule, value, 'add' AS action, day FROM first
  UNION ALL SELECT rule, value, 'remove', day + d7 FROM first WHERE d5 < 160
  UNION ALL SELECT rule, value, 'add', day + d7 + d11 FROM first WHERE d9 < 64),
once AS (SELECT rule, value, day, max(action) AS action FROM entries GROUP BY ALL),
spans AS (SELECT rule, value, action, day, lead(day) OVER (PARTITION BY rule, value ORDER BY day) AS until FROM once),
hits AS (SELECT page_id, s.rule || ':' || s.value AS name, s.day FROM captures c JOIN spans s ON s.action = 'add'
  AND CASE s.rule WHEN 'host' THEN c.host = s.value WHEN 'domain' THEN c.host = s.value OR ends_with(c.host, '.' || s.value)
    ELSE c.host = split_part(s.value, '/', 1) AND starts_with(c.path, substr(s.value, length(split_part(s.value, '/', 1)) + 1)) END
  AND TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(s.day AS INTEGER)) <= c.fetched
  AND (s.until IS NULL OR c.fetched < TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(s.until AS INTEGER))))
SELECT page_id, any_value(host) AS host, count(name) > 0 AS blocked, CAST(count(name) AS INTEGER) AS n_rules, min(name) AS first_rule
FROM captures LEFT JOIN hits USING (page_id) GROUP BY page_id"""


_JACCARD_SQL = """
WITH RECURSIVE split AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x != '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM split),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN edges l ON l.a = r.other)
SELECT doc_id, len(s) AS n_shingles, min(other) AS component_id FROM reach JOIN sets USING (doc_id) GROUP BY doc_id, len(s)"""


_COLLOCATION_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
parts AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x != '') AS w FROM pieces),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM parts, range(1, 4) AS t(k) WHERE len(w) >= k),
counts AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
found AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND a >= 10),
cuts AS (SELECT f.lang, f.k, f.phrase, f.a, f.w, c.cut, array_to_string(f.w[:c.cut], ' ') AS head, array_to_string(f.w[c.cut + 1:], ' ') AS tail FROM found f, range(1, 3) AS c(cut) WHERE c.cut < f.k),
scored AS (SELECT c.lang, c.phrase, c.k, c.a, c.cut, h.a AS l, t.a AS r, 1000000 * c.a * c.a // (h.a * t.a) AS score FROM cuts c
  JOIN counts h ON h.lang = c.lang AND h.phrase = c.head AND h.k = c.cut JOIN counts t ON t.lang = c.lang AND t.phrase = c.tail AND t.k = c.k - c.cut),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM found WHERE k = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM found WHERE k = 3),
held AS (SELECT lang, phrase, max(a) AS longest FROM inside GROUP BY ALL),
stay AS (SELECT w.* FROM worst w LEFT JOIN held h ON h.lang = w.lang AND h.phrase = w.phrase AND w.k = 2 WHERE h.longest IS NULL OR 100 * h.longest < 50 * w.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM stay JOIN totals USING (lang) QUALIFY rank <= 2000"""

_SEARCH_SQL = r"""
WITH terms AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
stats AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, stats WHERE term IN (SELECT term FROM asked) GROUP BY term, docs),
shares AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))) AS share FROM tfs JOIN weights USING (term) JOIN lengths USING (doc_id), stats),
scores AS (SELECT item_id, doc_id, CAST(sum(share) AS BIGINT) AS score FROM asked JOIN shares USING (term) GROUP BY ALL HAVING sum(share) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores QUALIFY rank <= 50"""

_EXACT_SQL = r"""
WITH plain AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM plain"""


def oracle_sql() -> dict[str, str]:
    return {"op11_collocations": _COLLOCATION_SQL, "op12_lexical_search": _SEARCH_SQL, "op13_exact_dedup": _EXACT_SQL, "op8_jaccard_join": _JACCARD_SQL, "op5_license_scan": _license_sql(), "op7_url_filters": _url_sql()}
