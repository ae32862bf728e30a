"""One query per training-data operator over its whole table, and the SQL that states its result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm import decontamination, hard_negatives, html_text, licenses, mixing, near_dup, quality, sharding, token_counts, topk_search, toxicity, url_filters, whitening
from tracelake.llm.common import table
from tracelake.session import configure, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function by its name."""

    def add(fn):
        QUERIES[fn.__name__] = lambda spark, folder: fn(configure(spark), folder)
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query(
    """
WITH vectors AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
  FROM vectors q JOIN vectors d ON d.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
)
def op2_voronoi_topk(spark, folder):
    """Five best neighbours of every fiftieth vector among all vectors, on components floor(256 x)."""
    whole = topk_search.finite_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding")
    whole = whole.withColumn("v", F.transform("v", lambda x: F.floor(x * 256).cast("double")))
    best = topk_search.voronoi_topk(whole, whole.where(F.col("id") % 50 == 0), k=5)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast("long").alias("score"))


@query(
    r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [hash(w[i:i+4]) FOR i IN range(1, len(w) - 3)] WHEN len(w) > 0 THEN [hash(w)] ELSE [] END) AS s FROM worded
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)
), pairs AS MATERIALIZED (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, b.y FROM reached r JOIN pairs b ON b.x = r.other
), components AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)
"""
)
def op4_chosen_path_groups(spark, folder):
    """Near-duplicate groups of all documents."""
    return near_dup.near_duplicates(table(spark, folder, "documents"))


@query(
    r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM sized GROUP BY source
), filled AS (
  SELECT *, coalesce(sum(2 * source_size) OVER earlier, 0) AS spent, sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS weights_left, sum(source_size) OVER () AS total
  FROM totals WINDOW earlier AS (ORDER BY 2 * source_size / weight::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), clock AS (
  SELECT max((total * 150 - spent * 100) / (100.0::DOUBLE * weights_left)) AS horizon FROM filled WHERE (total * 150 - spent * 100) / (100.0::DOUBLE * weights_left) < 2 * source_size / weight::DOUBLE
), targets AS (
  SELECT source, source_size, CASE WHEN weight::DOUBLE * horizon >= 2 * source_size THEN (2 * source_size)::DOUBLE ELSE weight::DOUBLE * horizon END AS target FROM totals, clock
), queued AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5('mix:' || s.doc_id), s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (least(size, greatest(0, floor(target) - ahead)) + least(size, greatest(0, floor(target) - ahead - source_size)))::BIGINT AS taken FROM queued
"""
)
def op6_fair_mix(spark, folder):
    """All documents mixed at weights 5, 2, 1 into 150 % of their words."""
    return mixing.per_document(mixing.weighted_fair_mix(table(spark, folder, "documents")))


@query()
def op10_token_counts(spark, folder):
    """Token counts of all documents through a cache that starts empty."""
    import public_tokenizers

    cache = scratch_path(spark, "token-cache")
    counts = token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), cache)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


@query()
def op5_toxic_spans(spark, folder):
    """Toxicity of all documents."""
    return toxicity.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op7_additive_quality(spark, folder):
    """Quality of all documents."""
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(
    r"""
WITH searched AS (
  SELECT words, len(words) AS n, min(item_id) AS item_id, count(DISTINCT item_id) AS n_items
  FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM benchmark WHERE item_id IS NOT NULL) WHERE len(words) >= 5 GROUP BY words
), all_seeds AS (
  SELECT item_id, n, m, seed, min(p) AS p FROM (
    SELECT item_id, n, p, unnest([0, 1]) AS m, unnest([
      hash(words[p+1:p+4]), CASE WHEN p + 5 <= n THEN hash([words[p+1], words[p+2], words[p+4], words[p+5]]) END]) AS seed
    FROM (SELECT *, unnest(range(0, n - 3)) AS p FROM searched)
  ) WHERE seed IS NOT NULL GROUP BY ALL
), item_seeds AS (
  SELECT * FROM all_seeds QUALIFY count(*) OVER (PARTITION BY m, seed) <= 32
), texts AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM documents
), doc_seeds AS (
  SELECT doc_id, p, unnest([0, 1]) AS m, unnest([
    hash(words[p+1:p+4]), CASE WHEN p + 5 <= n THEN hash([words[p+1], words[p+2], words[p+4], words[p+5]]) END]) AS seed
  FROM (SELECT *, len(words) AS n, unnest(range(0, len(words) - 3)) AS p FROM texts)
), hits AS (
  SELECT DISTINCT d.doc_id, i.item_id, d.p - i.p AS shift FROM doc_seeds d JOIN item_seeds i USING (m, seed)
), compared AS (
  SELECT h.doc_id, h.item_id, h.shift, i.n, i.n_items, t.p, CASE WHEN i.words[t.p+1] = d.words[h.shift+t.p+1] THEN 1 ELSE -1 END AS s
  FROM hits h JOIN searched i USING (item_id) JOIN texts d USING (doc_id), unnest(range(0, i.n)) AS t(p)
  WHERE h.shift + t.p >= 0 AND h.shift + t.p < len(d.words)
), sums AS (
  SELECT *, sum(s) OVER (PARTITION BY doc_id, item_id, shift ORDER BY p) AS c FROM compared
), runs AS (
  SELECT *, c - least(0, min(c) OVER (PARTITION BY doc_id, item_id, shift ORDER BY p)) AS run FROM sums
), scored AS (
  SELECT doc_id, item_id, shift, n, n_items, max(run) AS score, count(*) FILTER (s > 0) AS matched FROM runs GROUP BY ALL
)
SELECT doc_id, item_id, score::INTEGER AS score, matched::INTEGER AS matched, n::INTEGER AS n_tokens, shift::INTEGER AS doc_token, n_items
FROM scored WHERE score >= CASE WHEN n < 7 THEN n ELSE least(12, greatest(7, ceil(n / 2))) END
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY score DESC, matched DESC, shift) = 1
"""
)
def op9_spaced_seeds(spark, folder):
    """Benchmark items in all documents."""
    return decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query(
    r"""
WITH captures AS (
  SELECT page_id, url, DATE '2023-01-01' + (page_id % 730)::INTEGER AS fetched,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*?)\.?(?::[0-9]*)?(?:[/?#]|$)', 1)) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM pages
), hosts AS (
  SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 6))::INTEGER AS k FROM captures WHERE host <> ''
), entries AS (
  SELECT 'ads' AS list, 'd:' || host AS key, unnest([DATE '2022-06-01' + (k % 500)::INTEGER, DATE '2022-06-01' + (k % 500 + 40 + k % 300)::INTEGER, DATE '2022-06-01' + (k % 500 + 400)::INTEGER]) AS day,
    unnest(['add', 'remove', 'add']) AS action FROM hosts WHERE k % 3 = 0
  UNION ALL
  SELECT 'malware', 'd:' || regexp_extract(host, '[^.]+\.[^.]+\.[^.]+$'), unnest([DATE '2023-03-01' + (k % 400)::INTEGER, DATE '2023-03-01' + (k % 400 + 60)::INTEGER]), unnest(['add', 'remove']) FROM hosts WHERE k % 5 = 1 AND host SIMILAR TO '.*\..*\..*'
  UNION ALL
  SELECT 'mirrors', 'u:' || host || '/en', DATE '2023-01-01' + (k % 600)::INTEGER, 'add' FROM hosts WHERE k % 4 = 1
), spans AS (
  SELECT list, key, day AS first, action, lead(day) OVER (PARTITION BY list, key ORDER BY day) AS until FROM (SELECT list, key, day, min(action) AS action FROM entries GROUP BY ALL)
), labels AS (
  SELECT page_id, fetched, host, string_split(host, '.') AS l, string_split(regexp_replace(path, '^/|/$', '', 'g'), '/') AS f FROM captures WHERE host <> ''
), keys AS (
  SELECT page_id, fetched, 'd:' || array_to_string(l[i:], '.') AS key FROM labels, unnest(range(1, greatest(len(l) - 1, 1) + 1)) AS t(i)
  UNION
  SELECT page_id, fetched, 'u:' || host || '/' || array_to_string(f[1:i], '/') FROM labels, unnest(range(1, len(f) + 1)) AS t(i)
), hits AS (
  SELECT page_id, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM keys JOIN spans USING (key) WHERE action = 'add' AND first <= fetched AND (until IS NULL OR fetched < until) GROUP BY page_id
)
SELECT page_id, lists IS NOT NULL AS blocked, coalesce(lists, '') AS lists FROM captures LEFT JOIN hits USING (page_id)
"""
)
def op1_temporal_lists(spark, folder):
    """All pages judged by dated lists on the day they were fetched. Both are derived from the pages: the day from the id,
    the entries (two or three a host, some for its parent domain or a folder) from a digest of the host."""
    pages = table(spark, folder, "pages")
    start = F.to_date(F.lit("2023-01-01"))
    captures = pages.select("page_id", "url", F.date_add(start, (F.col("page_id") % 730).cast("int")).alias("fetched"))
    hosts = pages.select(url_filters.host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    hosts = hosts.withColumn("k", F.conv(F.substring(F.md5("host"), 1, 6), 16, 10).cast("int"))
    k = F.col("k")

    def dated(name, key, base, *changes):
        day = F.to_date(F.lit(base))
        rows = F.array(*[F.struct(F.date_add(day, shift.cast("int")).alias("day"), F.lit(action).alias("action")) for shift, action in changes])
        return hosts.select(F.lit(name).alias("list"), "k", "host", key.alias("key"), F.explode(rows).alias("e")).select("list", "k", "host", "key", "e.day", "e.action")

    ads = dated("ads", F.concat(F.lit("d:"), "host"), "2022-06-01", (k % 500, "add"), (k % 500 + 40 + k % 300, "remove"), (k % 500 + 400, "add")).where("k % 3 = 0")
    parent = F.concat(F.lit("d:"), F.regexp_extract("host", r"[^.]+\.[^.]+\.[^.]+$", 0))
    malware = dated("malware", parent, "2023-03-01", (k % 400, "add"), (k % 400 + 60, "remove")).where("k % 5 = 1 AND size(split(host, '[.]')) > 2")
    mirrors = dated("mirrors", F.concat(F.lit("u:"), "host", F.lit("/en")), "2023-01-01", (k % 600, "add")).where("k % 4 = 1")
    entries = ads.unionByName(malware).unionByName(mirrors).select("list", "key", "day", "action")
    judged = url_filters.filtered(captures, entries, "page_id")
    return judged.select("page_id", "blocked", F.array_join("lists", ",").alias("lists"))


@query()
def op3_layout_text(spark, folder):
    """Visible text of all pages."""
    return html_text.page_texts(table(spark, folder, "pages"))


def _canonical_sql() -> str:
    plain = r"' ' || trim(regexp_replace(regexp_replace(lower(text), '(?m)^[\x20\x09*#/;-]*(?:copyright\b|©|\(c\))[^\n]*$', ' ', 'g'), '[^\p{L}\p{N}]+', ' ', 'g')) || ' '"
    for word, others in licenses.SPELLINGS.items():
        for other in others:
            plain = f"replace({plain}, ' {other} ', ' {word} ')"
    return plain


@query(
    f"""
WITH canonical AS (SELECT doc_id, {_canonical_sql()} AS plain FROM documents),
known AS (SELECT plain, min(doc_id) AS license_id FROM canonical WHERE doc_id % 20 = 0 AND trim(plain) <> '' GROUP BY plain)
SELECT doc_id, license_id FROM canonical JOIN known USING (plain)
"""
)
def op8_license_digests(spark, folder):
    """All documents looked up among the texts of every twentieth document, which stand for the known licences."""
    docs = table(spark, folder, "documents")
    known = docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("license_id"), "text")
    return licenses.license_matches(docs, known)


@query()
def op11_feistel_shards(spark, folder):
    """All documents dealt to 16 shards by a permutation of their row numbers: counts are at most one apart."""
    placed = sharding.placements(table(spark, folder, "documents"), shards=16)
    grown = F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", grown)


@query()
def op12_bidiagonal_whitening(spark, folder):
    """All vectors whitened along the eight leading directions of their whole numbers floor(1024 c) + 100000."""
    vectors = whitening.integer_vectors(table(spark, folder, "embeddings"))
    return whitening.whitened(vectors, components=8).withColumnRenamed("id", "vec_id")


@query(
    """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM vectors a JOIN vectors r ON r.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
  n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives JOIN scored n USING (anchor_id) WHERE NOT n.same AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
QUALIFY rank <= 3
"""
)
def op13_spanning_tree_negatives(spark, folder):
    """Three hard negatives for each of the five positives of every fiftieth vector; every seventh row has a wrong label."""
    rows = hard_negatives.tagged_vectors(table(spark, folder, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, rows.where(F.col("id") % 50 == 0))
