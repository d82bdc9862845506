"""Queries ``op<N>_<name>`` over the driver's tables, and their SQL where SQL can say it.

Each query is a thin binding of an operator of this folder: it reads whole
tables, calls the operator with production parameters and derives the digest
columns of the contract from the operator's own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, bpe, chat_format, langid, lz_fingerprint, minhash, mixing, packing, repair, token_counts, toxicity, url_filter, vector_codes
from tidemark.llm.common import held_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: A conversation made of control strings; fixed by the contract.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("byte_bpe_50k.tiktoken")
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    chats = chats.unionByName(spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string"))
    return chat_format.digest_chats(chat_format.format_chats(chats, path), path).drop("n_tokens", "n_loss_tokens")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), capacity=4096, end_id=1)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, where=~held_out("doc_id", 3, 1))
    return toxicity.score(docs.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "text"), model, keep=["doc_id", "held_out"])


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = langid.learn(docs, where=~held_out("doc_id", 5, 0))
    return langid.classify(docs.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "text"), prototypes, keep=["doc_id", "held_out"])


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), limit=4096)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))


#: Rules of the contract: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, url_filter.RULES_SCHEMA)
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op9_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.edit_likeness(table(spark, sf_dir, "documents"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair.repair(repair.damage(table(spark, sf_dir, "conversations")))
    text = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return found.select(*[c for c in found.columns if c != "repaired"], F.sha2(F.encode(text, "UTF-8"), 256).alias("repaired_sha256"))


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_best_fit_packing, op3_toxicity, op4_mix_sources, op5_language_id, op6_token_counts, op7_near_duplicates, op8_url_filter, op9_lz_fingerprint, op10_nearest_neighbours, op11_vector_codes, op12_bpe, op13_repair)}

_MARKS = ["<|turn|>", "<|sep|>", "<|end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]


def _escaped_length(column: str) -> str:
    """Length of escaped text: a character more for each backslash, two for each control string."""
    marks = " + ".join(f"2 * ((length({column}) - length(replace({column}, '{m}', ''))) // {len(m)})" for m in _MARKS)
    return f"(length({column}) + length({column}) - length(replace({column}, '\\', '')) + {marks})"


_URLS = """
p AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, lower(coalesce(regexp_extract(rest, '^[^/?#]*', 0), '')) AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
r(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT u.page_id, u.host, u.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM u LEFT JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m
"""

_CHATS = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len("<|turn|><|sep|><|end|>")} + {_escaped_length("role")} + {_escaped_length("text")}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

_NEAR = """
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS ws FROM documents
),
s AS (SELECT DISTINCT doc_id, unnest([array_to_string(ws[i + 1 : i + 5], ' ') FOR i IN range(0, CASE WHEN len(ws) = 0 THEN 0 ELSE greatest(len(ws) - 4, 1) END)]) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT x, y FROM p JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE c >= 0.8 * (a.n + b.n - c)
  UNION SELECT a.doc_id, b.doc_id FROM w a JOIN w b ON a.ws = b.ws AND a.doc_id < b.doc_id
),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x)
SELECT a AS doc_id, min(b) AS class_id FROM r GROUP BY a
"""

_CODES = """
WITH RECURSIVE kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
width AS (SELECT CAST(ceil(max(len(v)) / 16) AS BIGINT) AS w FROM kept),
parts AS (SELECT r, p, [coalesce(v[p * w + i + 1], 0) FOR i IN range(w)] AS x FROM kept, width, range(16) AS t(p)),
books(round, p, e, c) AS (
  SELECT 0, p, r - 1, x FROM parts WHERE r <= 64
  UNION ALL
  SELECT * FROM (
    WITH best AS (
      SELECT parts.r, parts.p, arg_min(books.e, (list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(x, c)]), books.e)) AS e
      FROM parts JOIN books ON parts.p = books.p WHERE books.round < 2 GROUP BY ALL
    ),
    means AS (
      SELECT p, e, list(m ORDER BY i) AS c FROM (
        SELECT best.p, best.e, i, CAST(floor(sum(x[i + 1]) / count(*)) AS BIGINT) AS m FROM best JOIN parts USING (r, p), width, range(w) AS t(i) GROUP BY ALL
      ) GROUP BY ALL
    )
    SELECT books.round + 1, books.p, books.e, coalesce(means.c, books.c) FROM books LEFT JOIN means USING (p, e) WHERE books.round < 2
  )
),
coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM (
    SELECT parts.r, parts.p, min((list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(x, c)]), books.e)) AS best, best[1] AS d, best[2] AS e
    FROM parts JOIN books ON parts.p = books.p AND books.round = 2 GROUP BY ALL
  ) GROUP BY r
),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS d FROM books WHERE round = 2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, d AS codebooks_sha256 FROM kept JOIN coded USING (r), digest
"""

_REPAIR = r"""
WITH RECURSIVE keyed AS (
  SELECT *, string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '') AS letters FROM conversations
),
spaced AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), flatten([[CAST(unicode(a) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1] FOR a IN letters])),
    LAMBDA c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END
  ), 4294967295) % 20 AS kind FROM keyed
),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM spaced, range(CASE kind WHEN 3 THEN 2 ELSE 1 END) WHERE kind <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
),
turns AS (
  SELECT *, left(role, 1) AS initial, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last,
    CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed
),
figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM turns GROUP BY conv_id
),
closing(a, b, k, added) AS (VALUES ('', '', 0, []), ('s', 's', 0, []), ('u', 'u', 0, []), ('a', 'a', 0, []), ('', 'u', 1, ['user:']), ('s', 'u', 1, ['user:']), ('a', 'u', 1, ['user:']), ('u', 'a', 1, ['assistant:']), ('', 'a', 2, ['user:', 'assistant:']), ('s', 'a', 2, ['user:', 'assistant:'])),
moves(b, c) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')),
paths(conv_id, i, state, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '', {'cost': CAST(0 AS BIGINT), 'audit': '', 'out': CAST([] AS VARCHAR[])} FROM figures
  UNION ALL
  SELECT conv_id, i, state, min(way) FROM (
    SELECT p.conv_id, t.i, coalesce(m.c, k.b) AS state, {
      'cost': p.best.cost + 3 * k.k + CASE WHEN e.e = 'D' THEN 4 ELSE CASE WHEN e.e = 'R' THEN 3 ELSE 0 END + CASE WHEN t.fault = 'truncated' THEN 3 ELSE 0 END END,
      'audit': p.best.audit || repeat('I', k.k) || e.e,
      'out': p.best.out || k.added || CASE e.e WHEN 'D' THEN [] WHEN 'K' THEN [t.role || ':' || t.text] ELSE [CASE m.c WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || t.text] END
    } AS way
    FROM paths p JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1 JOIN closing k ON k.a = p.state
    JOIN (VALUES ('K'), ('R'), ('D')) e(e) ON e.e = 'D' OR t.fault NOT IN ('blank', 'duplicate')
    LEFT JOIN moves m ON e.e <> 'D' AND m.b = k.b AND CASE e.e WHEN 'K' THEN m.c = t.initial ELSE m.c <> 's' END
    WHERE e.e = 'D' OR m.c IS NOT NULL
  ) GROUP BY conv_id, i, state
),
ended AS (
  SELECT p.conv_id, min({'cost': p.best.cost + 3 * k.k, 'audit': p.best.audit || repeat('I', k.k), 'out': p.best.out || k.added}) AS best
  FROM paths p JOIN figures f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.i JOIN closing k ON k.a = p.state AND k.b IN ('', 'a') GROUP BY p.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.out, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""

SQL = {
    "op11_vector_codes": _CODES.strip(),
    "op13_repair": _REPAIR.strip(),
    "op7_near_duplicates": _NEAR.strip(),
    "op1_chat_format": _CHATS.strip(),
    "op8_url_filter": "WITH " + _URLS.strip(),
}
