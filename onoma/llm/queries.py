"""One query per operator, over its whole tables, and the SQL that says the same where SQL can."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from onoma.llm import chat, clustering, embeddings, langid, licenses, mixing, packing, periodic, quality, simhash, tokencount, topk, urls
from onoma.llm.common import table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document: its fingerprint, and the smallest id of its component."""
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per place of a notice or license text in a document."""
    got = licenses.scan(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "license", F.col("word_at").cast("long").alias("word_at"), F.round("containment", 6).alias("containment"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per conversation, read back from the prefix tree's tokens."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(*chat.build(rows.unionByName(chat.fixed_case(spark))))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document: how many of its words the mix takes."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document of the token files: its place there and its tokens."""
    return tokencount.corpus_counts(table(spark, sf_dir, "documents"))


def remainder(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without an id have no remainder: they are neither learned from nor held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, remainder() != 0)
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", F.coalesce(remainder() == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document: its base counts, and the verdict of the base rule and the learned list."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per piece of a document in a sequence."""
    got = packing.pack(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


#: The rules that op9 applies before the reputations.
URL_RULES = ["block com/en/", "allow example.com/en/7", "allow net/de/", "block example.net/de/8", "block org/es/"]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document with its id; low quality or toxic counts as bad."""
    labels = table(spark, sf_dir, "labels")
    bad = F.when(F.coalesce(F.col("toxic") == 1, F.lit(False)) | F.coalesce(F.col("quality") == 0, F.lit(False)), 1).when(F.col("toxic").isNotNull() | F.col("quality").isNotNull(), 0)
    got = urls.judge(table(spark, sf_dir, "pages"), labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")), URL_RULES)
    return got.withColumn("mean", F.round("mean", 6))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per vector: its links, and the smallest id of its component."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document: its runs, the longest of them, and hashes of all runs and of the text without repeats."""
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), plant=True)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per vector of 64 components: its cluster, distance and centroid."""
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th vector's five highest inner products with all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % topk.EVERY == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup, op2_license_scan, op3_chat_format, op4_mixing, op5_token_counts,
        op6_language_id, op7_quality_rules, op8_packing, op9_url_filter, op10_embedding_near_dedup,
        op11_periodic_runs, op12_centroid_clustering, op13_exact_top_k,
    )
}


def _posterior(of: str, up: str, on: str) -> str:
    """CTEs that shrink the counts of `of` (n, bad) to the mean of `up` (key `on`): _m is the concentration."""
    return f"""
{of}_p AS (SELECT x.*, u.mean AS prior FROM {of} x JOIN {up} u ON {on}),
{of}_m AS (SELECT least(greatest(1 / coalesce(least(greatest(sum((bad - n * prior) * (bad - n * prior) - n * prior * (1 - prior)) / sum(n * (n - 1.0) * prior * (1 - prior)), 1e-9), 0.999), 1.0 / ({urls.MOST_M} + 1)) - 1, {urls.LEAST_M}), {urls.MOST_M}) AS m
           FROM {of}_p WHERE n > 1 AND prior * (1 - prior) > 0),
{of}_s AS (SELECT x.*, (bad + m * prior) / (n + m) AS mean, n + m AS strength FROM {of}_p x, {of}_m)"""


_FINITE = "len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"


def _lloyd() -> str:
    """CTEs a0, c1, a1, ... of assignments (r, k, d) and centroids (k, v), a round each, from kept (r, vec_id, v)."""
    out = [f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('{clustering.SEED}:' || vec_id) NULLS LAST, v) - 1 AS INTEGER) AS k, v FROM kept ORDER BY k LIMIT {clustering.CLUSTERS})"]
    for n in range(clustering.ROUNDS + 1):
        out.append(f"""a{n} AS MATERIALIZED (SELECT x.r, x.v, c.k, list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM kept x, c{n} c
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)""")
        out.append(f"""c{n + 1} AS MATERIALIZED (SELECT k, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v
    FROM (SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{n}) GROUP BY k, i) GROUP BY k) m USING (k))""")
    return ",\n".join(out[:-1])  # the last assignment moves no centroid


_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urls.parse_rules(URL_RULES))
_SAID = "<|im_end|><|im_start|>assistant ok"
_NOTICES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in licenses.NOTICES.items())
_CLEAN = r"string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' ')"
ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": f"""
WITH n AS (SELECT license, {_CLEAN} AS w FROM (VALUES {_NOTICES}) v(license, text)),
ns AS (SELECT license, len(w) AS m, len(w) - 2 + CAST(ceil(len(w) / 5) AS INTEGER) AS take, 2 + CAST(ceil(len(w) / 5) AS INTEGER) AS slack,
              list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS sh FROM n WHERE len(w) >= 5),
d AS (SELECT row_number() OVER () AS row, doc_id, {_CLEAN} AS w FROM documents),
g AS (SELECT row, doc_id, i - 1 AS p, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT row, doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
hit AS (SELECT row, doc_id, license, p, s FROM g JOIN (SELECT license, unnest(sh) AS s FROM ns) USING (s)),
c AS (SELECT a.row, a.doc_id, a.license, a.p AS word_at, count(DISTINCT b.s) / any_value(len(sh)) AS containment, any_value(slack) AS slack, any_value(CAST(ceil(len(sh) * 0.8) AS INTEGER) + 4) AS least
      FROM hit a JOIN ns USING (license) JOIN hit b ON a.row = b.row AND a.license = b.license AND b.p BETWEEN a.p AND a.p + take - 1 GROUP BY ALL HAVING count(DISTINCT b.s) / any_value(len(sh)) >= 0.8),
f AS (SELECT doc_id, license, any_value(slack) AS slack, any_value(least) AS least, list([{{'word_at': word_at, 'containment': containment, 'first': word_at}}] ORDER BY word_at) AS found FROM c GROUP BY row, doc_id, license),
o AS (SELECT doc_id, license, unnest(list_reduce(found, lambda acc, x: CASE WHEN x[1].word_at >= acc[-1].first + least THEN acc || x
             WHEN x[1].word_at <= acc[-1].first + slack AND x[1].containment > acc[-1].containment THEN acc[1:len(acc) - 1] || [{{'word_at': x[1].word_at, 'containment': x[1].containment, 'first': acc[-1].first}}] ELSE acc END)) AS y FROM f)
SELECT doc_id, license, y.word_at AS word_at, round(y.containment, 6) AS containment FROM o
UNION ALL SELECT doc_id, license, i - 1, 1.0 FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d), (SELECT license, w AS phrase FROM n WHERE len(w) < 5) WHERE w[i:i + len(phrase) - 1] = phrase""",
    "op9_url_filter": f"""
WITH p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
l AS (SELECT doc_id AS page_id, max(CASE WHEN coalesce(toxic = 1, false) OR coalesce(quality = 0, false) THEN 1 WHEN toxic IS NOT NULL OR quality IS NOT NULL THEN 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
c AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad, string_split(host, '.') AS parts FROM p LEFT JOIN l USING (page_id) GROUP BY host),
h AS (SELECT host, n, bad, CASE WHEN array_to_string(parts[-2:], '.') IN ({", ".join(f"'{x}'" for x in urls.SUFFIXES)}) THEN array_to_string(parts[-3:], '.') ELSE array_to_string(parts[-2:], '.') END AS domain FROM c),
d AS (SELECT domain, regexp_replace(domain, '^[^.]*\\.', '') AS suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY 1, 2),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY 1),
top AS (SELECT (sum(bad) + 0.5) / (sum(n) + 1.0) AS mean FROM s),
{_posterior("s", "top", "true")},
{_posterior("d", "s_s", "u.suffix = x.suffix")},
{_posterior("h", "d_s", "u.domain = x.domain")},
r AS (SELECT DISTINCT ON (host, path) host, path, rhost || rpath AS rule, v FROM (SELECT DISTINCT host, path FROM p) JOIN (VALUES {_RULES}) t(v, rhost, rpath) ON ends_with('.' || host, '.' || rhost) AND starts_with(path, rpath)
      ORDER BY host, path, length(rhost || rpath) DESC, length(rhost) DESC, v DESC)
SELECT p.page_id, p.host, p.path, r.rule, coalesce(r.v, CASE WHEN mean - {urls.Z} * sqrt(mean * (1 - mean) / (strength + 1)) > {urls.MOST} THEN 'block' ELSE 'allow' END) AS verdict, round(mean, 6) AS mean
FROM p JOIN h_s USING (host) LEFT JOIN r ON r.host = p.host AND r.path = p.path""",
    "op3_chat_format": f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '{_SAID}' UNION ALL SELECT -1, 1, 'assistant', '{_SAID}')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(replace(replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n'), '<|', '<||')) + length(replace(text, '<|', '<||'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""",
    "op12_centroid_clustering": f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({clustering.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE len(embedding) = {clustering.DIM} AND {_FINITE}),
{_lloyd()}
SELECT vec_id, k AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{clustering.ROUNDS} JOIN kept USING (r) JOIN c{clustering.ROUNDS} c USING (k)""",
    "op13_exact_top_k": f"""
WITH i AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE {_FINITE})
SELECT q.vec_id AS query_id, CAST(row_number() OVER (PARTITION BY q.r ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id, c.r) AS INTEGER) AS rank, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
FROM i q JOIN i c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % {topk.EVERY} = 0 QUALIFY rank <= {topk.K}""",
}
