"""The registered queries of the operators, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import binfiles, bpe, chat, codes, importance, langid, mixing, multiindex, passages, quality, simhash, topk, toxicity
from .common import id_crc, table, words

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_language_profiles(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    profiles = langid.learn_profiles(docs.where(id_crc(F.col("doc_id"), 3) != 1))
    found = langid.identify(docs, profiles)
    return found.select("doc_id", (id_crc(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def op2_remove_repeated_passages(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    w = words(F.col("text"))
    return passages.remove_repeats(docs).select(
        "doc_id",
        (F.size(w) + F.col("_removed")).cast("long").alias("n_words"),
        F.col("_removed").alias("n_removed"),
        F.sha2(F.array_join(w, " ").cast("binary"), 256).alias("kept_sha256"),
    )


def op3_format_conversations(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]").alias("text")
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said,
    )
    messages = chat.fold(chat.events_of_turns(c.unionByName(own)))
    return chat.read_back(chat.render(messages))


def op4_line_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    more = ["lines", "lines_failed"]
    return quality.clean_lines(docs).select("doc_id", *(f"_quality.{c}" for c in cols + more))


def op5_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.where(id_crc(F.col("doc_id"), 5) != 0))
    found = toxicity.score(docs, model)
    return found.select("doc_id", (id_crc(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op6_simhash_classes(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op7_bpe_round_trip(spark, sf):
    return bpe.digests(bpe.round_trip(table(spark, sf, "documents"), tokenizer_path()))


def op8_exact_top_k(spark, sf):
    vectors = topk.quantised(table(spark, sf, "embeddings"))
    return topk.top_k(vectors.where("vec_id % 20 = 0"), vectors, 20)


def op9_mix_sources(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "source", "_mix.epoch", "_mix.block", F.col("_mix.order").alias("place"))


def op10_token_shards(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    manifest = binfiles.write_files(docs, bpe.read_model(tokenizer_path()), end_id=2)
    return binfiles.read_files(manifest)


def op11_importance_resampling(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = importance.importance(docs, table(spark, sf, "benchmark"), percent=10, least_words=20)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_vector_codes(spark, sf):
    found, books = codes.compress(table(spark, sf, "embeddings"), parts=8, entries=16, rounds=6)
    digest = F.lit(codes.books_sha256(books)).alias("codebooks_sha256")
    return found.select("vec_id", "code", "error", "label_error", digest)


def op13_embedding_near_duplicates(spark, sf):
    return multiindex.near_duplicates(table(spark, sf, "embeddings"), least=0.95, recall=0.95)


def queries() -> dict:
    """Query name -> callable(spark, sf_dir)."""
    found = {n: f for n, f in globals().items() if n.startswith("op") and n[2].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


# ------------------------------------------------------------------------ SQL

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _rows(extra: str = "") -> str:
    return f"d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text{extra} FROM documents)"


_OP2 = f"""
WITH {_rows(f", {_WORDS} AS ws")},
win AS (
  SELECT r, i, count(*) OVER (PARTITION BY h) AS c
  FROM (SELECT r, i, array_to_string(ws[i:i + 34], ' ') AS h
        FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35))
),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM win WHERE c > 1
),
kept AS (
  SELECT p.r, count(*) AS n, string_agg(p.w, ' ' ORDER BY p.i) AS t
  FROM (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d) p
  LEFT JOIN gone g ON p.r = g.r AND p.i = g.i WHERE g.r IS NULL GROUP BY p.r
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.r = k.r
"""

_OP4 = f"""
WITH {_rows(f", {_WORDS} AS ws, string_split(coalesce(text, ''), chr(10)) AS ls")},
win AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, h) AS c
  FROM (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS h
        FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) >= 8))
),
rep AS (
  SELECT r, sum(least(8, i - coalesce(p, -8))) AS n
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM win WHERE c > 1) GROUP BY r
),
lines AS (
  SELECT r, count(*) AS n, count(*) FILTER (WHERE NOT ok) AS bad, sum(length(l)) AS chars,
         sum(length(l)) FILTER (WHERE ok) AS ok_chars,
         count(*) FILTER (WHERE word) - count(DISTINCT l) FILTER (WHERE word) AS dup
  FROM (
    SELECT r, l, word, NOT word OR (
        (regexp_matches(l, {_sql(quality.ENDS_SENTENCE)})
         OR (length(l) >= {quality.LONG_LINE} AND regexp_matches(l, {_sql(quality.INNER_SENTENCE)})))
        AND NOT regexp_matches(l, {_sql(quality.SHOUTING)})
        AND NOT regexp_matches(l, {_sql(quality.SYMBOL_RUNS)})
        AND NOT regexp_matches(l, {_sql(quality.NAVIGATION)})
        AND NOT (length(l) < {2 * quality.LONG_LINE} AND regexp_matches(l, {_sql(quality.FURNITURE)}))) AS ok
    FROM (SELECT r, l, regexp_matches(l, {_sql(quality.HAS_WORD)}) AS word
          FROM (SELECT r, unnest(ls) AS l FROM d))
  ) GROUP BY r
),
base AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(l.dup AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(l.n AS BIGINT) AS lines, CAST(l.bad AS BIGINT) AS lines_failed,
         CASE WHEN l.chars > 0 THEN coalesce(l.ok_chars, 0) / CAST(l.chars AS DOUBLE) ELSE 0.0 END AS share
  FROM d JOIN lines l ON d.r = l.r LEFT JOIN rep ON d.r = rep.r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
       NOT failed AND share >= {quality.MIN_KEPT} AS kept, lines, lines_failed
FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS failed FROM base)
"""

_OP9 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('s' || source, 'none') AS s, text, CAST(len({_WORDS}) AS BIGINT) AS n,
         CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, {mixing.DIGITS}) AS BIGINT) AS cell
  FROM documents
),
src AS (SELECT s, CAST(sum(n) AS BIGINT) AS t, sum(n) / sum(sum(n)) OVER () AS p FROM d GROUP BY s HAVING sum(n) > 0),
step(i, lo, hi) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT i + 1, CASE WHEN up THEN (lo + hi) / 2 ELSE lo END, CASE WHEN up THEN hi ELSE (lo + hi) / 2 END
  FROM (
    SELECT i, lo, hi, (
      SELECT ln(sum(pow(p, (lo + hi) / 2)))
             - (lo + hi) / 2 * sum(pow(p, (lo + hi) / 2) * ln(p)) / sum(pow(p, (lo + hi) / 2))
             >= 0.95 * ln(CAST(count(*) AS DOUBLE))
          OR pow(min(p), (lo + hi) / 2 - 1) / sum(pow(p, (lo + hi) / 2)) * 0.8 > 4.0
      FROM src) AS up
    FROM step WHERE i < {mixing.STEPS})
),
chosen AS (
  SELECT CASE WHEN (SELECT -sum(p * ln(p)) / sum(p) + ln(sum(p)) >= 0.95 * ln(CAST(count(*) AS DOUBLE))
                           OR 0.8 / sum(p) > 4.0 FROM src)
              THEN 1.0 ELSE lo END AS e
  FROM step WHERE i = {mixing.STEPS}
),
quota AS (
  SELECT s, t, CAST(floor(pow(p, e) / (SELECT sum(pow(p, e)) FROM src) * 0.8 * (SELECT sum(t) FROM src)) AS BIGINT) AS q
  FROM src, chosen
),
plan AS (
  SELECT s, q // t AS f, q % t AS rest,
         CAST(least({mixing.CELLS}, greatest(1, pow(2, ceil(log2(t / CAST({mixing.BLOCK_TOKENS} AS DOUBLE)))))) AS BIGINT) AS b
  FROM quota
),
blocks AS (
  SELECT s, f, rest, cell % b AS block, CAST(sum(n) AS BIGINT) AS t FROM d JOIN plan USING (s) GROUP BY ALL
),
ended AS (
  SELECT s, f, block, t, rest - (CAST(sum(t) OVER (PARTITION BY s
           ORDER BY md5('17:' || s || ':' || (f + 1) || ':' || block), block ROWS UNBOUNDED PRECEDING) AS BIGINT) - t) AS room
  FROM blocks
),
placed AS (
  SELECT d.*, e.f, e.block, e.room, e.room >= e.t AS whole
  FROM d JOIN plan p USING (s) JOIN ended e ON e.s = d.s AND e.block = d.cell % p.b
),
mixed AS (
  SELECT doc_id, source, s, block, unnest(range(1, f + CAST(whole AS BIGINT) + 1)) AS epoch FROM placed
  UNION ALL
  SELECT doc_id, source, s, block, f + 1 FROM (
    SELECT *, sum(n) OVER (PARTITION BY s
      ORDER BY n, md5('17:' || (f + 1) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id
      ROWS UNBOUNDED PRECEDING) AS fin
    FROM placed WHERE room > 0 AND NOT whole)
  WHERE fin <= room
)
SELECT doc_id, source, epoch, block,
       md5('17:' || s || ':' || epoch || ':' || block) || ':'
       || md5('17:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
FROM mixed
"""


_CTL = "(<s>|</s>|\\[ROLE\\]|\\[/ROLE\\]|\\[INST\\]|\\[/INST\\]|<<SYS>>|<</SYS>>|" + (
    "<\\|im_start\\|>|<\\|im_end\\|>|<\\|endoftext\\|>|<\\|startoftext\\|>)"
)

_OP3 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<s>[ROLE]') + length(role) + len(regexp_extract_all(role, {_sql(_CTL)}))
                + length(text) + len(regexp_extract_all(text, {_sql(_CTL)})) + length('_[/ROLE]_</s>_')) AS BIGINT)
         AS formatted_chars
FROM c GROUP BY conv_id
"""

_OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
WHERE r <= 20
"""


#: crc32 of the UTF-8 bytes of the column w, by the table ``t`` of CTE tab.
_CRC = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(range(1, length(hex(encode(w))), 2),
    lambda i: CAST('0x' || substr(hex(encode(w)), i, 2) AS BIGINT))),
  lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])))"""

_OP11 = f"""
WITH tab AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                          lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
),
low AS (
  SELECT r, k, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM (SELECT row_number() OVER () AS r, 'd' AS k, doc_id, text FROM documents
        UNION ALL SELECT NULL, 'b', NULL, text FROM benchmark)
),
f AS (SELECT r, k, unnest(ws) AS w FROM low),
vocabulary AS (SELECT w, CAST({_CRC} % 10000 AS BIGINT) AS bucket FROM (SELECT DISTINCT w FROM f), tab),
counts AS (
  SELECT bucket, count(*) FILTER (WHERE k = 'd') AS s, count(*) FILTER (WHERE k = 'b') AS t
  FROM f JOIN vocabulary USING (w) GROUP BY bucket
),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1) * CAST((SELECT sum(s) FROM counts) + 10000 AS DOUBLE))
                                      / ((s + 1) * CAST((SELECT sum(t) FROM counts) + 10000 AS DOUBLE)))) AS BIGINT) AS g
  FROM counts
),
weights AS (SELECT r, sum(g) AS weight FROM f JOIN vocabulary USING (w) JOIN gain USING (bucket) WHERE k = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(
           sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM low LEFT JOIN weights USING (r) WHERE k = 'd'
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
         count(*) FILTER (WHERE n_features >= 20) OVER () AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= n * 10 // 100 THEN place END AS rank
FROM placed
"""


def _lloyd(rounds: int) -> str:
    """CTEs a0, c1, a1, ... : assignments to the codebooks c0, and the next."""
    out = []
    for i in range(rounds + 1):
        out.append(f"""a{i} AS MATERIALIZED (
  SELECT r, part, min(d * 16 + e) % 16 AS e, min(d * 16 + e) // 16 AS d
  FROM (SELECT r, p.part, e, CAST(sum((x - y) * (x - y)) AS BIGINT) AS d
        FROM p JOIN c{i} USING (part, place) GROUP BY ALL) GROUP BY r, part)""")
        if i < rounds:
            out.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT part, e, place, coalesce(m, y) AS y FROM c{i} LEFT JOIN (
    SELECT part, e, place, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
    FROM a{i} JOIN p USING (r, part) GROUP BY ALL) USING (part, e, place))""")
    return ",\n".join(out)


_OP12 = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
p AS MATERIALIZED (
  SELECT r, i * 8 // w AS part, i % (w // 8) AS place, coalesce(v[i + 1], 0) AS x
  FROM v, (SELECT greatest(1, CAST(ceil(max(len(v)) / 8.0) AS BIGINT)) * 8 AS w FROM v), unnest(range(w)) u(i)
),
c0 AS MATERIALIZED (SELECT part, r - 1 AS e, place, x AS y FROM p WHERE r <= 16),
{_lloyd(6)},
coded AS (
  SELECT r, string_agg(lpad(lower(hex(e)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a6 GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY part, e, place)) FROM c6) AS codebooks_sha256
FROM v JOIN coded USING (r)
"""


#: All pairs; the tables of the comparison are small. The query is held to
#: at least 0.9 of these links and finds all of them there.
_OP13 = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS x,
         embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
         AND len(list_filter(embedding, lambda c: c <> 0)) > 0 AS ok
  FROM embeddings
),
links AS MATERIALIZED (
  SELECT a.r AS p, b.r AS q FROM v a JOIN v b
  ON a.ok AND b.ok AND a.r <> b.r AND list_cosine_similarity(a.x, b.x) >= 0.95
),
reach(p, q) AS (SELECT r, r FROM v UNION SELECT reach.p, links.q FROM reach JOIN links ON reach.q = links.p)
SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v LEFT JOIN (SELECT p, count(*) AS n FROM links GROUP BY p) ON v.r = p
JOIN (SELECT reach.p AS r, min(w.vec_id) AS component_id FROM reach JOIN v w ON reach.q = w.r GROUP BY ALL) USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op13_embedding_near_duplicates": _OP13,
        "op12_vector_codes": _OP12,
        "op11_importance_resampling": _OP11,
        "op3_format_conversations": _OP3,
        "op8_exact_top_k": _OP8,
        "op2_remove_repeated_passages": _OP2,
        "op4_line_quality": _OP4,
        "op9_mix_sources": _OP9,
    }
