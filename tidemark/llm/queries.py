"""The registered queries of the text operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    counts,
    exact,
    interactions,
    language,
    lattice,
    merkle,
    packing,
    pieces,
    pii,
    quality,
    shallot,
    simhash,
    urls,
)
from tidemark.llm.frames import documents, tokenizer_file

QUERIES, SQL = {}, {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


@_query
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.duplicate_groups(documents(spark, folder))


SQL["op9_exact_dedup"] = """
SELECT doc_id,
  max(doc_id) OVER same AS keep_id,
  count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@_query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    found = language.identify(documents(spark, folder))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@_query
def op5_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.clusters(documents(spark, folder), shingle=4, max_bits=4)
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


@_query
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.find(documents(spark, folder)))


@_query
def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), tokenizer_file("word_bpe_49k.json"), capacity=2048)


@_query
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = counts.count_tokens(documents(spark, folder), tokenizer_file("byte_bpe_50k.json"), limit=1024)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def _at(day: Column, minute: Column) -> Column:
    """A time of day in 2024, days counted from its first."""
    midnight = F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")).cast("timestamp_ntz")
    return midnight + F.make_dt_interval(mins=minute.cast("int"))


def _list_entries(pages: DataFrame) -> DataFrame:
    """A dated list about the hosts of ``pages``, their domains and their first path segments:
    each is listed, some are taken off and listed again, at times that its name decides."""
    where, parts = urls.host(F.col("url")), urls.segments(F.col("url"))
    names = pages.select(
        F.explode(
            F.array(
                where,
                F.substring_index(where, ".", -2),
                F.when(F.size(parts) > 0, F.concat(where, F.lit("/"), F.element_at(parts, 1))),
            )
        ).alias("key")
    )
    names = names.filter("key IS NOT NULL").distinct().withColumn("m", F.md5("key"))
    letter = [F.ascii(F.substring("m", i, 1)) for i in range(1, 8)]
    first = (letter[0] * 31 + letter[1]) % 300
    return names.select(
        "key",
        F.explode(
            F.array(
                *[
                    F.struct(_at(day, letter[6] % 24 * 60).alias("since"), verdict.alias("verdict"))
                    for day, verdict in (
                        (first, F.when(letter[2] % 3 == 0, "allow").otherwise("block")),
                        (first + 1 + letter[3] % 60, F.lit("remove")),
                        (first + 1 + letter[3] % 60 + letter[4] % 40, F.when(letter[5] % 2 == 0, "allow").otherwise("block")),
                    )
                ]
            )
        ).alias("entry"),
    ).select("key", "entry.*")


@_query
def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    fetched = _at(F.pmod("page_id", F.lit(366)), F.pmod(F.col("page_id") * 7, F.lit(1440)))
    judged = urls.evaluate(pages.withColumn("fetched_on", fetched), _list_entries(pages))
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("fetched_on", "since", "until")}
    return judged.withColumns(times)


SQL["op1_url_filters"] = """
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_days(CAST(((page_id % 366) + 366) % 366 AS INTEGER))
      + to_minutes(((page_id * 7 % 1440) + 1440) % 1440) AS fetched_on,
    nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '.'), '') AS host,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda s: s <> '') AS parts
  FROM pages),
names AS (
  SELECT DISTINCT key, md5(key) AS m FROM (
    SELECT host AS key FROM captures
    UNION SELECT array_to_string(string_split(host, '.')[-2:], '.') FROM captures
    UNION SELECT host || '/' || parts[1] FROM captures WHERE len(parts) > 0)
  WHERE key IS NOT NULL),
days AS (
  SELECT key, (ascii(m[1]) * 31 + ascii(m[2])) % 300 AS first, 1 + ascii(m[4]) % 60 AS held, ascii(m[5]) % 40 AS off,
    to_hours(ascii(m[7]) % 24) AS hour,
    CASE WHEN ascii(m[3]) % 3 = 0 THEN 'allow' ELSE 'block' END AS one,
    CASE WHEN ascii(m[6]) % 2 = 0 THEN 'allow' ELSE 'block' END AS two
  FROM names),
entries AS (
  SELECT key, TIMESTAMP '2024-01-01' + to_days(CAST(first AS INTEGER)) + hour AS since, one AS verdict FROM days
  UNION ALL SELECT key, TIMESTAMP '2024-01-01' + to_days(CAST(first + held AS INTEGER)) + hour, 'remove' FROM days
  UNION ALL SELECT key, TIMESTAMP '2024-01-01' + to_days(CAST(first + held + off AS INTEGER)) + hour, two FROM days),
daily AS (
  SELECT key, since, max(CASE verdict WHEN 'block' THEN 3 WHEN 'allow' THEN 2 ELSE 1 END) AS o
  FROM entries GROUP BY ALL),
rules AS (
  SELECT key, since, lead(since) OVER (PARTITION BY key ORDER BY since) AS until,
    CASE o WHEN 3 THEN 'block' WHEN 2 THEN 'allow' ELSE 'remove' END AS verdict
  FROM daily),
hits AS (
  SELECT c.page_id, c.url, c.fetched_on, r.*, row_number() OVER (
    PARTITION BY c.page_id, c.url, c.fetched_on ORDER BY contains(r.key, '/') DESC, length(r.key) DESC) AS place
  FROM captures c JOIN rules r
    ON r.verdict <> 'remove' AND c.fetched_on >= r.since AND (r.until IS NULL OR c.fetched_on < r.until)
    AND (r.key = c.host OR ends_with(c.host, '.' || r.key) OR (len(c.parts) > 0 AND r.key = c.host || '/' || c.parts[1])))
SELECT c.page_id, c.url, strftime(c.fetched_on, '%Y-%m-%d %H:%M:%S') AS fetched_on, coalesce(h.verdict, 'none') AS verdict,
  h.key AS matched, strftime(h.since, '%Y-%m-%d %H:%M:%S') AS since, strftime(h.until, '%Y-%m-%d %H:%M:%S') AS until
FROM captures c LEFT JOIN hits h
  ON h.place = 1 AND h.page_id = c.page_id AND h.url = c.url AND h.fetched_on = c.fetched_on
"""


@_query
def op4_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.edited_pairs(documents(spark, folder))


SQL["op4_document_fingerprints"] = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
pairs AS (
  SELECT doc_id, text, length(text) // 2 AS half,
    coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS other
  FROM texts),
edited AS (
  SELECT doc_id, text, other, left(text, length(text) - half) || left(other, half) AS changed FROM pairs),
long AS (
  SELECT doc_id, 1 AS k, text AS t FROM edited UNION ALL SELECT doc_id, 2, changed FROM edited
  UNION ALL SELECT doc_id, 3, other FROM edited),
trees AS (
  SELECT doc_id, k, list_transform(string_split(t, chr(10) || chr(10)), lambda s:
    list_transform(string_split(s, chr(10)), lambda p:
      list_transform(string_split(p, '. '), lambda x: sha256(x)))) AS leaves
  FROM long),
above AS (
  SELECT *, list_transform(leaves, lambda s: list_transform(s, lambda p: sha256(array_to_string(p, ',')))) AS paragraphs
  FROM trees),
higher AS (SELECT *, list_transform(paragraphs, lambda s: sha256(array_to_string(s, ','))) AS sections FROM above),
roots AS (SELECT *, sha256(array_to_string(sections, ',')) AS root FROM higher),
marks AS (
  SELECT doc_id, k, root, list_transform(
    list_concat([root], sections, flatten(paragraphs), flatten(flatten(leaves))), lambda n: left(n, 8)) AS nodes
  FROM roots),
prints AS (SELECT doc_id, k, root || ':' || array_to_string(nodes, '') AS mark, list_distinct(nodes) AS nodes FROM marks)
SELECT e.doc_id, length(e.text) AS n_chars, sha256(e.changed) AS edited_sha256,
  a.mark AS fingerprint, b.mark AS edited_fingerprint,
  CASE WHEN a.mark = b.mark THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(a.nodes, b.nodes)) / (len(a.nodes) + len(b.nodes)) END AS near_edited,
  CASE WHEN a.mark = c.mark THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(a.nodes, c.nodes)) / (len(a.nodes) + len(c.nodes)) END AS near_next
FROM edited e JOIN prints a ON a.doc_id = e.doc_id AND a.k = 1
  JOIN prints b ON b.doc_id = e.doc_id AND b.k = 2 JOIN prints c ON c.doc_id = e.doc_id AND c.k = 3
"""


@_query
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, their digest, and whether decoding gives the text back (a space mark
    in a text is a space)."""
    model = tokenizer_file("piece_bpe_32k.model")
    found = documents(spark, folder).withColumn("found", pieces.round_trip(model))
    plain = F.translate(F.coalesce("text", F.lit("")), pieces.SPACE, " ").cast("binary")
    return found.select(
        "doc_id",
        "found.*",
        (F.col("found.decoded_sha256") == F.sha2(plain, 256)).alias("round_trip"),
    )


@_query
def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Grades 0 to 2: a point for good quality, and one for not being toxic."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rating = F.col("quality") + 1 - F.col("toxic")
    graded = quality.grade(documents(spark, folder), labels, rating)
    return graded.select("doc_id", "expected_grade", "p_top", "selected")


def _embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet")


@_query
def op11_filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return interactions.filter_audit(documents(spark, folder), labels)


SQL["op11_filter_interactions"] = r"""
WITH texts AS (
  SELECT d.doc_id, coalesce(d.lang, '') AS part, coalesce(d.text, '') AS text,
    regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+') AS words,
    coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic
  FROM documents d LEFT JOIN (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) l
    ON l.doc_id = d.doc_id),
judged AS (
  SELECT part, good, toxic,
    CAST(len(words) < 100 AS INTEGER)
    + 2 * CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INTEGER)
    + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS INTEGER)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER)
    + 16 * CAST(coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false) AS INTEGER) AS fails
  FROM texts),
masks AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM judged GROUP BY ALL),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
    [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, step, bits[step] AS bit,
    CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before
  FROM orders, unnest([1, 2, 3, 4, 5]) AS s(step)),
counted AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, bit,
    sum(CASE WHEN fails & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails & before <> 0 AND fails & bit <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""


@_query
def op12_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return shallot.cluster(_embeddings(spark, folder), k=8, rounds=10, dims=64, scale=1024, prefix="3:")


def _clustering_sql(k: int, rounds: int, dims: int) -> str:
    """Every round as a pair of tables: distances to all centroids, then exact floors of means."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT id, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT x.id, x.v, x.rid, m.c, list_sum(list_transform(list_zip(x.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
    FROM whole x, centroids{r} m) GROUP BY id, v, rid)""")
        if r < rounds:
            steps.append(f"""
centroids{r + 1} AS MATERIALIZED (
  SELECT old.c, coalesce(new.v, old.v) AS v FROM centroids{r} old LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
      SELECT c, i, sum(x) AS s, count(*) AS n FROM (
        SELECT c, unnest(v) AS x, unnest(range({dims})) AS i FROM near{r}) GROUP BY c, i) GROUP BY c) new ON new.c = old.c)""")
    return f"""
WITH whole AS MATERIALIZED (
  SELECT vec_id AS id, row_number() OVER () AS rid, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
centroids0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || id) NULLS LAST, v) - 1 AS INTEGER) AS c, v FROM whole
  QUALIFY c < {k}),{",".join(steps)}
SELECT n.id AS vec_id, n.c AS cluster, CAST(n.d AS BIGINT) AS distance,
  CAST(sum(n.d) OVER (PARTITION BY n.c) AS BIGINT) AS cluster_inertia, CAST(sum(n.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM near{rounds} n JOIN centroids{rounds} m ON m.c = n.c
"""


SQL["op12_centroid_clustering"] = _clustering_sql(k=8, rounds=10, dims=64)


@_query
def op13_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_duplicates(_embeddings(spark, folder), cosine=0.95)
