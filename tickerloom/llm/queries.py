"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .texts import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return add


_OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
tri AS (SELECT r, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS g
        FROM w, unnest(range(1, len(words) - 1)) AS t(i)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM tri) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM rep, unnest([0, 1, 2]) AS o(k) GROUP BY r),
lines AS (SELECT r, line FROM d, unnest(string_split(text, chr(10))) AS t(line)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r),
m AS (SELECT d.r, doc_id, source, len(words) AS n_words,
             length(text) - length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN cov USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::BIGINT)::BIGINT AS f FROM b WHERE source IS NOT NULL GROUP BY source),
c AS (SELECT sum(n)::DOUBLE AS n, sum(f)::DOUBLE AS f, count(*)::DOUBLE AS h, sum(f::DOUBLE * f / n) AS ff FROM h),
p AS (SELECT f / n AS m, greatest(ff / n - (f / n) * (f / n), 0) AS spread, f / n * (1 - f / n) AS chance,
             f / n * (1 - f / n) * h / n AS noise FROM c),
q AS (SELECT m, CASE WHEN chance > noise THEN greatest((spread - noise) / (chance - noise), 0) ELSE 0 END AS share FROM p),
v AS (SELECT source, CASE WHEN share <= 0 THEN m
                          ELSE (f + (1 - share) / share * m) / (n + (1 - share) / share) END >= 0.8 AS dropped FROM h, q)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(dropped, false) AS kept
FROM b LEFT JOIN v USING (source)
"""


@query("op3_host_rules", _OP3_SQL)
def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .host_rules import apply_rules

    return apply_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .byte_bpe import digests

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digests(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


_OP9_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
                + len(regexp_extract_all(text, '</?s>|\[/?(INST|SYS|ANSWER|ROLE|TEXT)\]')) AS size,
             length(role) + length(role) - length(replace(role, '\', ''))
                + len(regexp_extract_all(role, '</?s>|\[/?(INST|SYS|ANSWER|ROLE|TEXT)\]')) AS role_size FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(7 + size + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 19 WHEN 'system' THEN 13 ELSE 30 + role_size END)::BIGINT
           AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op9_chat", _OP9_SQL)
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .chat import format_conversations, read_back

    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return read_back(format_conversations(turns.unionByName(probe)))


@query("op1_quality_net")
def op1_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .quality_net import score, train

    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = lambda doc_id: F.crc32(doc_id.cast("string").cast("binary")) % 5
    network = train(docs, labels, lambda doc_id: fold(doc_id) != 0)
    scored = score(docs, network)
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .language_id import identify, train

    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = train(docs.filter(~held_out))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query("op8_order_minhash")
def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .order_minhash import compare_neighbours

    return compare_neighbours(documents(spark, sf_dir))


@query("op4_pseudonyms")
def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pseudonyms import pseudonymise

    return pseudonymise(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_replaced", "text")


_OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(words[i : i + 2], chr(10))) AS g
  FROM w, unnest(range(1, greatest(len(words) - 1, 2))) AS t(i) WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n, bit_xor(hash(g)) AS x FROM s GROUP BY doc_id),
c AS (SELECT n, x, min(doc_id) AS rep FROM n GROUP BY n, x),
r AS MATERIALIZED (SELECT rep, c.n, g, row_number() OVER (PARTITION BY rep ORDER BY g) AS k FROM c JOIN s ON s.doc_id = rep),
p AS MATERIALIZED (SELECT DISTINCT a.rep AS a, b.rep AS b FROM r a JOIN r b ON a.g = b.g AND a.rep < b.rep
      WHERE a.k <= a.n - ceil(0.9 * a.n) + 1 AND b.k <= b.n - ceil(0.9 * b.n) + 1 AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n),
o AS (SELECT p.a, p.b, count(*) AS o FROM p JOIN r x ON x.rep = p.a JOIN r y ON y.rep = p.b AND x.g = y.g GROUP BY p.a, p.b),
l AS MATERIALIZED (SELECT o.a, o.b FROM o JOIN c x ON x.rep = o.a JOIN c y ON y.rep = o.b
      WHERE 100 * o >= 90 * (x.n + y.n - o)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
walk(node, reached) AS (SELECT rep, rep FROM c UNION SELECT walk.node, e.b FROM walk JOIN e ON e.a = walk.reached),
f AS (SELECT node, min(reached) AS component FROM walk GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(f.component, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (n, x) LEFT JOIN f ON f.node = c.rep
"""


@query("op10_jaccard_join", _OP10_SQL)
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import link_components

    return link_components(documents(spark, sf_dir))


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .suffix_dedup import remove_repeats

    cut = remove_repeats(documents(spark, sf_dir))
    lengths = F.transform("spans", lambda s: s["end"] - s["begin"])
    removed = F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)
    return cut.select(
        "doc_id",
        (F.octet_length("kept") + removed).alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.col("kept"), 256).alias("kept_sha256"),
    )


_OP11_SQL = """
WITH e AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id, score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id)::INTEGER AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT * FROM n WHERE rank <= 5
"""


@query("op11_hard_negatives", _OP11_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .hard_negatives import mine

    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.select("vec_id", label.alias("label"), F.col("embedding").alias("vector")), "vec_id % 100 = 0")


_OP12_SQL = """
WITH RECURSIVE e AS MATERIALIZED (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
                   WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
walk(a, b) AS (SELECT a, b FROM l UNION SELECT walk.a, l.b FROM walk JOIN l ON l.a = walk.b),
c AS (SELECT a, min(b) AS b FROM walk GROUP BY a),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(coalesce(c.b, vec_id), vec_id) AS component_id,
       coalesce(c.b, vec_id) >= vec_id AS kept
FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN k ON k.a = vec_id
"""


@query("op12_near_vectors", _OP12_SQL)
def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .near_vectors import link_vectors

    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return link_vectors(vectors.select("vec_id", "label", F.col("embedding").alias("vector")))


_OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (
  SELECT d.*, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM d),
m AS (
  SELECT part, (CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
                || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END) AS fails,
         count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM x LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) USING (doc_id)
  GROUP BY part, fails),
f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
      FROM o, range(1, 6) AS t(step)),
r AS (
  SELECT part, filter_order, step, own,
         sum(n) FILTER (translate(fails, before || own, '') = fails) AS kept,
         sum(n) FILTER (contains(fails, own) AND translate(fails, before, '') = fails) AS removed,
         sum(n) FILTER (contains(fails, own) AND translate(fails, before, '') <> fails) AS redundant,
         sum(n) FILTER (fails = own) AS unique_fails,
         sum(good) FILTER (contains(fails, own) AND translate(fails, before, '') = fails) AS good_lost,
         sum(toxic) FILTER (contains(fails, own) AND translate(fails, before, '') = fails) AS toxic_lost
  FROM m, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM r
"""


@query("op13_filter_audit", _OP13_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filter_audit import audit

    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
