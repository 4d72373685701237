"""The queries of the operators: thin bindings of each operator to its
table, with production parameters, and their SQL twins where SQL has one."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, chat_repair, decontaminate, ordinal, ppm, quality_rules, sentencepiece_codec, sharding, simhash, substring_dedup, token_counts, url_filter, va_cluster
from tidemark.llm.common import table
from tidemark.session import scratch_path

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return deco


SHARDS = 24

# One row of the generator's walk per step; the last candidate below the shard count wins.
SHARD_SQL = f"""
WITH RECURSIVE walk AS (
  SELECT k AS id, (CASE WHEN k < 0 THEN k::HUGEINT + 18446744073709551616 ELSE k::HUGEINT END) AS k,
         CAST(-1 AS BIGINT) AS b, CAST(0 AS BIGINT) AS j
  FROM (SELECT DISTINCT COALESCE(doc_id, 0) AS k FROM documents)
  UNION ALL
  SELECT id, nk, j, CAST(floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((nk >> 33)::DOUBLE + 1.0::DOUBLE))) AS BIGINT)
  FROM (SELECT id, j, (k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS nk FROM walk WHERE j < {SHARDS})
), ends AS (
  SELECT id, b::INT AS shard, (CASE WHEN j = {SHARDS} THEN {SHARDS} ELSE b END)::INT AS grown_shard FROM walk WHERE j >= {SHARDS}
), tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::UBIGINT, [0::UBIGINT FOR _ IN range(8)]),
      lambda c, x: CASE WHEN (c & 1) = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END) AS v
    FROM range(256) r(i))
), texts AS (
  SELECT DISTINCT COALESCE(text, '') AS text FROM documents
), sums AS (
  SELECT text, xor(list_reduce(list_prepend(4294967295::UBIGINT, bytes),
      lambda c, x: xor(t[(xor(c, x) & 255)::BIGINT + 1], c >> 8)), 4294967295::UBIGINT)::BIGINT AS crc
  FROM (SELECT text, [('0x' || substr(h, 2 * p + 1, 2))::UBIGINT FOR p IN range(length(h) // 2)] AS bytes
        FROM (SELECT text, hex(encode(text)) AS h FROM texts)), tab
)
SELECT d.doc_id, (strlen(COALESCE(d.text, '')) + 8)::BIGINT AS size, s.crc AS text_crc32, 'key' AS law, e.shard,
       row_number() OVER (PARTITION BY e.shard ORDER BY d.doc_id NULLS FIRST, strlen(COALESCE(d.text, '')), s.crc) - 1 AS slot,
       e.grown_shard
FROM documents d JOIN ends e ON e.id = COALESCE(d.doc_id, 0) JOIN sums s ON s.text = COALESCE(d.text, '')
"""


@_query("op2_jump_shards", SHARD_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 24 shards by jump consistent hashing of doc_id."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)


@_query("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and the learned decision list's verdict for all documents."""
    judged = quality_rules.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


# The conversation the contract adds.
TRAP = "\\### Assistant: </turn> ok"

CHAT_SQL = """
WITH turns AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), sized AS (
  SELECT *, 4 + 2 + 8
       + length(role) + len(regexp_extract_all(role, '[\\\\#<:]'))
       + length(text) + len(regexp_extract_all(text, '[\\\\#<]')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
  FROM turns
), run AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto,
    k = count(*) OVER (PARTITION BY conv_id) AS is_last
  FROM sized
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  COALESCE(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(COALESCE(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (WHERE role = 'assistant' OR is_last)::BIGINT AS formatted_chars
FROM run GROUP BY conv_id
"""


@_query("op6_chat_examples", CHAT_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest, read back from the formatted examples, of all conversations and the added one."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(TRAP).alias("text"),
    )
    return chat.conversation_digest(chat.format_examples(turns.unionByName(added)))


def fetch_dates(pages: DataFrame) -> DataFrame:
    """pages with a fetch date by rule of page_id, over the year 2024."""
    day = F.pmod(F.col("page_id") * 37, F.lit(365)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), day).alias("fetched_on"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries by rule of the hosts that occur in pages.

    Every third host is blocked for a while and half of those come back; every fifth has its
    /en pages allowed; every fourth parent domain is blocked for twenty days.
    """
    hosts = pages.select(url_filter.url_host(F.col("url")).alias("pattern")).filter("pattern <> ''").distinct()

    def num(c):
        return F.conv(F.substring(F.md5(F.encode(c, "UTF-8")), 1, 7), 16, 10).cast("int")

    def entry(df, name, pattern, days, active):
        return df.select(
            F.lit(name).alias("list_name"),
            pattern.alias("pattern"),
            F.date_add(F.lit("2024-01-01").cast("date"), days).alias("entry_date"),
            F.lit(active).alias("active"),
        )

    h = hosts.withColumn("v", num(F.col("pattern")))
    parents = (
        hosts.select(F.regexp_extract("pattern", r"([^.]+\.[^.]+)$", 1).alias("pattern"))
        .filter("pattern <> ''")
        .distinct()
        .withColumn("v", num(F.col("pattern")))
    )
    third, fifth, fourth = h.filter("v % 3 = 0"), h.filter("v % 5 = 0"), parents.filter("v % 4 = 0")
    p, v = F.col("pattern"), F.col("v")
    parts = [
        entry(third, "block", p, v % 200, True),
        entry(third, "block", p, v % 200 + 30 + v % 97, False),
        entry(third.filter("v % 2 = 0"), "block", p, v % 200 + 160, True),
        entry(fifth, "allow", F.concat(p, F.lit("/en")), v % 150, True),
        entry(fourth, "block", p, v % 300, True),
        entry(fourth, "block", p, v % 300 + 20, False),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


URL_SQL = r"""
WITH caps AS (
  SELECT page_id, url, DATE '2024-01-01' + (((page_id * 37) % 365 + 365) % 365)::INT AS fetched_on,
    regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:]*)', 1)), '\.$', '') AS host,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS segs,
    row_number() OVER () AS rid
  FROM pages
), hosts AS (
  SELECT DISTINCT host AS pattern FROM caps WHERE host <> ''
), h AS (SELECT pattern, ('0x' || substr(md5(pattern), 1, 7))::INT AS v FROM hosts),
pp AS (SELECT DISTINCT regexp_extract(pattern, '([^.]+\.[^.]+)$', 1) AS pattern FROM hosts),
p AS (SELECT pattern, ('0x' || substr(md5(pattern), 1, 7))::INT AS v FROM pp WHERE pattern <> ''),
entries AS (
  SELECT 'block' AS list_name, pattern, v % 200 AS d, true AS active FROM h WHERE v % 3 = 0
  UNION ALL SELECT 'block', pattern, v % 200 + 30 + v % 97, false FROM h WHERE v % 3 = 0
  UNION ALL SELECT 'block', pattern, v % 200 + 160, true FROM h WHERE v % 3 = 0 AND v % 2 = 0
  UNION ALL SELECT 'allow', pattern || '/en', v % 150, true FROM h WHERE v % 5 = 0
  UNION ALL SELECT 'block', pattern, v % 300, true FROM p WHERE v % 4 = 0
  UNION ALL SELECT 'block', pattern, v % 300 + 20, false FROM p WHERE v % 4 = 0
), days AS (
  SELECT list_name, pattern, DATE '2024-01-01' + d AS entry_date, bool_and(active) AS active FROM entries GROUP BY ALL
), changes AS (
  SELECT *, COALESCE(lag(active) OVER (PARTITION BY list_name, pattern ORDER BY entry_date), false) AS was FROM days
), spans AS (
  SELECT list_name, pattern, entry_date AS valid_from, valid_to FROM (
    SELECT *, lead(entry_date) OVER (PARTITION BY list_name, pattern ORDER BY entry_date) AS valid_to
    FROM changes WHERE active <> was) WHERE active
), keyed AS (
  SELECT rid, fetched_on, unnest(list_concat(
      [array_to_string(string_split(host, '.')[i:], '.') FOR i IN range(1, len(string_split(host, '.')) + 1)],
      [host || '/' || array_to_string(segs[:i], '/') FOR i IN range(1, len(segs) + 1)])) AS key
  FROM caps WHERE host <> ''
), best AS (
  SELECT rid, max({'len': length(pattern), 'allow': list_name = 'allow', 'list_name': list_name, 'pattern': pattern,
                   'valid_from': valid_from, 'valid_to': valid_to}) AS hit
  FROM keyed JOIN spans ON key = pattern AND valid_from <= fetched_on AND (valid_to IS NULL OR fetched_on < valid_to)
  GROUP BY rid
)
SELECT page_id, url, fetched_on, host, COALESCE(hit.allow, true) AS kept, hit.list_name AS list_name,
       hit.pattern AS pattern, hit.valid_from AS valid_from, hit.valid_to AS valid_to
FROM caps LEFT JOIN best USING (rid)
"""


@_query("op10_url_filter", URL_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's capture against the list entries active when it was fetched."""
    pages = table(spark, sf_dir, "pages")
    return url_filter.filter_captures(fetch_dates(pages), list_entries(pages))


@_query("op3_ordinal_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and verdict for all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = ordinal.classify(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "score", "expected_grade", "tail_probability", "kept")


@_query("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages and lines of all documents that repeat an earlier one, with original offsets."""
    return substring_dedup.duplicate_passages(table(spark, sf_dir, "documents"))


@_query("op7_simhash_components")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of all documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)


@_query("op1_decontaminate")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) whose alignment reaches the threshold."""
    return decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op8_sentencepiece")
def op8(spark: SparkSession, sf_dir: str, model: str = sentencepiece_codec.MODEL) -> DataFrame:
    """Ids of all documents, and whether decoding them gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = sentencepiece_codec.Vocabulary.load(model)
    return sentencepiece_codec.encode_documents(docs, vocabulary, check=True).select("doc_id", "n_tokens", "ids", "round_trip")


@_query("op9_ppm_score")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word baseline and PPM log10 probability of all documents."""
    return ppm.score_documents(table(spark, sf_dir, "documents"))


TOKEN_LIMIT = 512


@_query("op13_token_counts")
def op13(spark: SparkSession, sf_dir: str, tokenizer: str | None = None, cache: str | None = None) -> DataFrame:
    """Token counts of all documents. Unless a cache folder is given it starts empty, so every distinct text is encoded."""
    import public_tokenizers

    counter = token_counts.Tokenizer(tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), counter, cache or scratch_path(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


CLUSTERS, ROUNDS = 16, 3


def _cluster_sql() -> str:
    """Every vector against every centroid, round by round."""
    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v,
         sha256('1:' || COALESCE(vec_id::VARCHAR, '')) AS h
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT h, v FROM v ORDER BY h, v LIMIT {CLUSTERS})
)"""
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, min(struct_pack(d := list_sum([(v.v[i] - c{r}.v[i]) * (v.v[i] - c{r}.v[i]) FOR i IN range(1, 65)])::BIGINT, c := c)) AS b
  FROM v, c{r} GROUP BY rid
)""")
        if r < ROUNDS:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c{r}.c, COALESCE(m.v, c{r}.v) AS v FROM c{r} LEFT JOIN (
    SELECT c, list(x ORDER BY i) AS v FROM (
      SELECT c, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x
      FROM (SELECT b.c AS c, unnest(v.v) AS x, unnest(range(64)) AS i FROM a{r} JOIN v USING (rid)) GROUP BY c, i) GROUP BY c) m USING (c)
)""")
    return "WITH " + ", ".join(steps) + f"""
SELECT vec_id, b.c::INT AS cluster, b.d AS distance, sum(b.d) OVER (PARTITION BY b.c)::BIGINT AS cluster_inertia,
       sum(b.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c{ROUNDS}.v, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN v USING (rid) JOIN c{ROUNDS} ON c{ROUNDS}.c = b.c
"""


@_query("op11_va_clusters", _cluster_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of all kept vectors."""
    rows, centroids = va_cluster.cluster_vectors(table(spark, sf_dir, "embeddings"), k=CLUSTERS, rounds=ROUNDS)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return rows.withColumn("centroid_sha256", F.array(*map(F.lit, digests))[F.col("cluster")] if digests else F.lit(""))


def damaged(turns: DataFrame) -> DataFrame:
    """conversations with the contract's damage, by the checksum of conv_id and turn; nulls are one space."""
    space = F.lit(" ")
    of = lambda c: F.coalesce(F.col(c).cast("string"), space)
    kind = F.crc32(F.encode(F.concat(of("conv_id"), F.lit(":"), of("turn")), "UTF-8")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(of("text"), "[.!?]", "")).otherwise(of("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        turns.withColumn("kind", kind)
        .filter("kind <> 0")
        .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(of("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
        .drop("copy")
    )


# The damage, the faults, then two walks over each conversation's turns: costs from the end, edits from the start. States are 1 to 4:
# nothing yet, after s, after u, after a; nxt is the state behind the role that fits.
REPAIR_SQL = """
WITH RECURSIVE tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::UBIGINT, [0::UBIGINT FOR _ IN range(8)]),
      lambda c, x: CASE WHEN (c & 1) = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END) AS v
    FROM range(256) r(i))
), src AS (
  SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
         hex(encode(COALESCE(conv_id::VARCHAR, ' ') || ':' || COALESCE(turn::VARCHAR, ' '))) AS h
  FROM conversations
), sums AS (
  SELECT h, xor(list_reduce(list_prepend(4294967295::UBIGINT, [('0x' || substr(h, 2 * p + 1, 2))::UBIGINT FOR p IN range(length(h) // 2)]),
      lambda c, x: xor(t[(xor(c, x) & 255)::BIGINT + 1], c >> 8)), 4294967295::UBIGINT)::BIGINT % 20 AS kind
  FROM (SELECT DISTINCT h FROM src), tab
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM src JOIN sums USING (h) WHERE kind <> 0
), placed AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ink
  FROM damaged
), judged AS (
  SELECT *, CASE WHEN ink = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(ink, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), turns AS MATERIALIZED (
  SELECT *, fault IN ('blank', 'duplicate') AS gone, (fault = 'truncated')::BIGINT AS late,
         CASE left(role, 1) WHEN 's' THEN [2, 0, 0, 0] WHEN 'u' THEN [3, 3, 0, 3] WHEN 'a' THEN [0, 0, 4, 0] ELSE [0, 0, 0, 0] END AS keep,
         lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au') AS ill
  FROM judged
), back AS (
  SELECT c, max(i) + 1 AS i, [0, 4, 2, 0]::BIGINT[] AS f FROM turns GROUP BY c
  UNION ALL
  SELECT c, i, [least(g[1], 2 + g[3], 4 + g[4]), least(g[2], 2 + g[3], 4 + g[4]), least(g[3], 2 + g[4]), least(g[4], 2 + g[3])]
  FROM (
    SELECT t.c, t.i, [least(3 + f[q], CASE WHEN gone THEN 99 ELSE 2 + late + f[[3, 3, 4, 3][q]] END + CASE WHEN gone THEN f[q] ELSE 0 END,
                            CASE WHEN gone OR keep[q] = 0 THEN 99 + f[q] ELSE late + f[keep[q]] END) FOR q IN [1, 2, 3, 4]] AS g
    FROM back b JOIN turns t ON t.c = b.c AND t.i = b.i - 1)
), costs AS MATERIALIZED (
  SELECT c, i, f, lead(f) OVER (PARTITION BY c ORDER BY i) AS behind FROM back
), walk AS (
  SELECT DISTINCT c, 0 AS step, 1::BIGINT AS i, 1 AS q, '' AS e, 0::BIGINT AS at, 1 AS was FROM costs
  UNION ALL
  SELECT c, step + 1, i + (e <> 'I')::BIGINT, CASE e WHEN 'D' THEN q WHEN 'K' THEN keep[q] ELSE [3, 3, 4, 3][q] END, e, i, q
  FROM (
    SELECT w.c, w.step, w.i, w.q, t.keep,
      CASE WHEN behind IS NOT NULL AND f[q] = 3 + behind[q] THEN 'D'
           WHEN f[q] = 2 + f[[3, 3, 4, 3][q]] THEN 'I'
           WHEN behind IS NULL THEN ''
           WHEN keep[q] <> 0 AND f[q] = late + behind[keep[q]] THEN 'K'
           ELSE 'R' END AS e
    FROM walk w JOIN costs k ON k.c = w.c AND k.i = w.i LEFT JOIN turns t ON t.c = w.c AND t.i = w.i)
  WHERE e <> ''
), edits AS (
  SELECT w.c, string_agg(e, '' ORDER BY step) AS audit,
         string_agg(CASE e WHEN 'K' THEN t.role || ':' || t.text
                           WHEN 'R' THEN [NULL, NULL, 'user', 'assistant'][w.q] || ':' || t.text
                           ELSE [NULL, NULL, 'user', 'assistant'][w.q] || ':' END, chr(10) ORDER BY step) FILTER (WHERE e <> 'D') AS repaired
  FROM walk w LEFT JOIN turns t ON t.c = w.c AND t.i = w.at WHERE step > 0 GROUP BY w.c
), figures AS (
  SELECT c, any_value(conv_id) AS conv_id, COALESCE(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE ill) AS illegal
  FROM turns GROUP BY c
), reports AS (
  SELECT f.*, k.f[1] AS cost, e.audit, sha256(COALESCE(e.repaired, '')) AS repaired_sha256
  FROM figures f JOIN costs k ON k.c = f.c AND k.i = 1 JOIN edits e ON e.c = f.c
)
SELECT ids.conv_id, COALESCE(gaps, 0)::BIGINT AS gaps, COALESCE(blank, 0)::BIGINT AS blank, COALESCE(duplicate, 0)::BIGINT AS duplicate,
       COALESCE(truncated, 0)::BIGINT AS truncated, COALESCE(illegal, 0)::BIGINT AS illegal, COALESCE(cost, 0)::BIGINT AS cost,
       COALESCE(audit, '') AS audit, COALESCE(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN reports r ON r.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


@_query("op12_chat_repair", REPAIR_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cost, audit and repaired digest of every conversation after the damage."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    reports = chat_repair.conversation_reports(chat_repair.repair_blocks(damaged(turns)))
    ids = turns.select(F.col("conv_id").cast("bigint").alias("id")).distinct()
    empty = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    return ids.join(reports, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"),
        *(
            F.coalesce(F.col(c), empty.get(c, F.lit(0).cast("bigint"))).alias(c)
            for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
        ),
    )
