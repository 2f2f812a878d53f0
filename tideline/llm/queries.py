"""The corpus operators over whole tables, with their SQL form where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    chat,
    exact_dedup,
    fingerprint,
    importance,
    jaccard_join,
    language_id,
    line_dedup,
    mixing,
    packing,
    url_filter,
    vector_codes,
    vptree,
    warc,
)
from tideline.llm.common import table
from tideline.session import materialize, work_dir

#: The vocabulary file of the tokenizer; it is installed on every machine.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

#: The function that the user turns of the conversations call.
RESPOND = {
    "properties": {
        "text": {"type": "string", "minLength": 1, "maxLength": 400},
        "turn": {"type": "integer", "minimum": 0},
    },
    "required": ["text", "turn"],
    "additionalProperties": False,
}

NEIGHBOURS = 5
VPTREE_FACTOR = 0.85

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the listed rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLES["op5_url_filter"] = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), rules(h, p, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page_id)
"""


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's predicted language, learned from labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"))))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the target weights of their sources."""
    laid, drawn = mixing.draws(table(spark, sf_dir, "documents"))
    return mixing.taken_words(laid, drawn).select("doc_id", "size", "source_size", "target", "taken", "draws", "first_shard")


@query
def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every embedding whose id is divisible by 50."""
    vectors = vptree.usable(table(spark, sf_dir, "embeddings"))
    index = vptree.build(vectors, NEIGHBOURS)
    return vptree.search(index, vectors.where(F.col("id") % 50 == 0), NEIGHBOURS, VPTREE_FACTOR)


# Products are added from left to right, as the operator does, so that scores agree to the last digit.
ORACLES["op6_nearest_vectors"] = r"""
WITH v AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), n AS (
  SELECT id, v, sqrt(list_reduce(list_transform(v, lambda x: x * x), lambda a, b: a + b)) AS norm FROM v
), s AS (
  SELECT a.id AS query_id, b.id AS vec_id,
         list_reduce(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]), lambda x, y: x + y) / (a.norm * b.norm) AS score
  FROM n a JOIN n b ON a.id <> b.id AND len(a.v) = len(b.v) WHERE a.id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@query
def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, and the captures of every page's url looked up in the index and read back."""
    pages = table(spark, sf_dir, "pages")
    folder = f"{work_dir(spark)}/tideline/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
    captures = materialize(warc.write(warc.decide(pages), folder), "captures")
    directory = materialize(warc.index(captures, folder), "directory")
    asked = pages.select(warc.capture_key(F.col("url")).alias("key"))
    return warc.look_up(directory, folder, asked, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLES["op4_warc_index"] = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, payload_bytes,
         list_aggregate(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT + 1, 1)),
           'string_agg', '') AS payload_digest
  FROM p
), f AS (SELECT payload_digest, min(page_id) AS first_page FROM d GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM d JOIN f USING (payload_digest)
"""


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


@query
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of the conversations, with calls and results linked, checked and written as canonical JSON."""
    return chat.format_chat(table(spark, sf_dir, "conversations"), {"respond": RESPOND})


ORACLES["op3_chat_formatting"] = r"""
WITH calls AS (
  SELECT conv_id, turn, text, 'call_' || conv_id || '_' || turn AS call_id FROM conversations WHERE role = 'user'
), results AS (
  SELECT conv_id, turn, text, 'call_' || conv_id || '_' || (turn - 1) AS call_id FROM conversations WHERE role = 'assistant'
), c AS (SELECT conv_id, call_id, count(*) AS n, max(turn) AS call_turn FROM calls GROUP BY ALL
), r AS (SELECT conv_id, call_id, count(*) AS n FROM results GROUP BY ALL
)
SELECT calls.conv_id, calls.turn, 'call' AS kind, calls.call_id,
       CASE WHEN c.n > 1 THEN 'repeated' WHEN r.n > 0 THEN 'linked' ELSE 'unanswered' END AS status,
       concat_ws('; ', CASE WHEN text IS NULL THEN 'text: missing' END, CASE WHEN length(text) < 1 THEN 'text: too short' END,
                 CASE WHEN length(text) > 400 THEN 'text: too long' END, CASE WHEN calls.turn < 0 THEN 'turn: too small' END) AS violations,
       calls.turn * 2 AS place,
       '{"role":"user","tool_call":{"arguments":{' || coalesce('"text":' || to_json(text) || ',', '') || '"turn":' || calls.turn
         || '},"id":"' || calls.call_id || '","name":"respond"},"turn":' || calls.turn || '}' AS json
FROM calls JOIN c USING (conv_id, call_id) LEFT JOIN r USING (conv_id, call_id)
UNION ALL
SELECT results.conv_id, results.turn, 'result', results.call_id,
       CASE WHEN call_turn IS NULL THEN 'orphan' WHEN r.n > 1 THEN 'repeated' ELSE 'linked' END,
       NULL, greatest(results.turn, coalesce(call_turn, results.turn)) * 2 + 1,
       '{' || coalesce('"content":' || to_json(text) || ',', '') || '"role":"assistant",'
         || CASE WHEN call_turn IS NULL THEN '' ELSE '"tool_call_id":"' || results.call_id || '",' END
         || '"turn":' || results.turn || '}'
FROM results JOIN r USING (conv_id, call_id) LEFT JOIN c USING (conv_id, call_id)
UNION ALL
SELECT conv_id, turn, 'message', NULL, NULL, NULL, turn * 2,
       '{' || coalesce('"content":' || to_json(text) || ',', '') || coalesce('"role":' || to_json(role) || ',', '') || '"turn":' || turn || '}'
FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
"""


@query
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component by its five-word shingles."""
    return jaccard_join.join(table(spark, sf_dir, "documents"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier line is like."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs).select("doc_id", "n_lines", "n_removed", "text")


ORACLES["op1_ngram_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w
), t AS (
  SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s
), e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 180 * count(*) >= 80 * (any_value(a.n) + any_value(b.n))
), r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id
)
SELECT s.doc_id, len(sh) AS n_shingles, min(c) AS component_id FROM s JOIN r USING (doc_id) GROUP BY s.doc_id, sh
"""

ORACLES["op8_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT *, row_number() OVER (ORDER BY doc_id, line_no) AS r, regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+') AS ws FROM l
), s AS (
  SELECT r, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                 ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))) END AS sh FROM w
), f AS (
  SELECT sh, min(r) AS r, len(sh) AS n FROM s WHERE len(sh) > 0 GROUP BY sh
), t AS (
  SELECT r, n, unnest(sh) AS g FROM f
), later AS (
  SELECT b.r FROM t a JOIN t b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r HAVING 180 * count(*) >= 80 * (any_value(a.n) + any_value(b.n))
), gone AS (
  SELECT s.r FROM s JOIN f USING (sh) WHERE s.r > f.r UNION SELECT r FROM later
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone.r IS NOT NULL) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (gone.r IS NULL), '') AS text
  FROM w LEFT JOIN gone ON w.r = gone.r GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, kept.text AS text
FROM (SELECT doc_id FROM documents) LEFT JOIN kept USING (doc_id)
"""


@query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of equal texts; the row with the largest doc_id stays."""
    return exact_dedup.mark(table(spark, sf_dir, "documents"), keep="largest")


ORACLES["op13_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS c FROM documents
), g AS (
  SELECT c, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY c
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(c) AS text_sha256 FROM t JOIN g USING (c)
"""


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's importance for the benchmark's words, and the rank of the tenth that is drawn."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_importance_resampling"] = r"""
WITH RECURSIVE crc(i, v, k) AS (
  SELECT i, i::UBIGINT, 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END, k + 1 FROM crc WHERE k < 8
), tab AS (
  SELECT list(v ORDER BY i) AS tab FROM crc WHERE k = 8
), texts AS (
  SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark
), words AS (
  SELECT side, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts
), counted AS (
  SELECT side, doc_id, w, count(*) AS n FROM words GROUP BY ALL
), hashed AS (
  SELECT w, xor(4294967295::UBIGINT, list_reduce(
           list_prepend(4294967295::UBIGINT, list_transform(range(0, octet_length(encode(w))),
                                                            lambda i: ('0x' || substr(hex(encode(w)), 2 * i::INT + 1, 2))::UBIGINT)),
           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255)::INT + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM counted), tab
), sums AS (
  SELECT bucket, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM counted JOIN hashed USING (w) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sum(coalesce(s, 0)) OVER () + 10000)::DOUBLE
                                 / ((coalesce(s, 0) + 1)::DOUBLE * (sum(coalesce(t, 0)) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM sums
), d AS (
  SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total
  FROM counted JOIN hashed USING (w) JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id
), w AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features,
         coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
         ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h
  FROM documents LEFT JOIN d USING (doc_id)
), s AS (
  SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM w
), r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM s WHERE n_features >= 20
)
SELECT s.doc_id, n_features, weight, score, rank FROM s LEFT JOIN (SELECT doc_id, rank FROM r WHERE rank <= 10 * n // 100) q ON q.doc_id = s.doc_id
"""


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as eight indexes into codebooks of sixteen entries."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def _codes_sql(parts: int, entries: int, rounds: int) -> str:
    """The rounds written out one after the other; a distance and its index are one number, so that min finds both."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM kept, range({parts}) r(p)
), b0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS y FROM cut
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {entries}
)"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT vec_id, label, p, x, min(list_sum(list_transform(range(1, len(x) + 1), lambda j: (x[j] - y[j]) * (x[j] - y[j])))::BIGINT * {entries} + e) AS m
  FROM cut JOIN b{i} USING (p) GROUP BY ALL
)"""
        )
        if i < rounds:
            steps.append(
                f"""s{i} AS (
  SELECT p, m % {entries} AS e, j, sum(x[j])::BIGINT AS s, count(*) AS n FROM a{i}, range(1, len(x) + 1) r(j) GROUP BY ALL
), c{i} AS (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS y FROM s{i} GROUP BY ALL
), b{i + 1} AS MATERIALIZED (
  SELECT b{i}.p, b{i}.e, coalesce(c{i}.y, b{i}.y) AS y FROM b{i} LEFT JOIN c{i} ON b{i}.p = c{i}.p AND b{i}.e = c{i}.e
)"""
            )
    return f"""WITH {", ".join(steps)}, coded AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', m % {entries}), '' ORDER BY p) AS code, sum(m // {entries})::BIGINT AS error
  FROM a{rounds} GROUP BY vec_id, label
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM coded
"""


ORACLES["op12_vector_codes"] = _codes_sql(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS)
