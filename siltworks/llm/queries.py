"""The registered queries of the operators, each beside its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    # Python workers import this package from where the driver has it, unless it is installed.
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register(
    "op7_quality_rules",
    r"""
    WITH w AS (
      SELECT doc_id, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
      FROM documents),
    grams AS (
      SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
      FROM w, unnest(range(1, len(words) - 1)) AS r(i)),
    again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n > 1),
    covered AS (
      SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM again, unnest(range(3)) AS r(k) GROUP BY doc_id),
    lines AS (
      SELECT doc_id, line FROM w, unnest(string_split(text, chr(10))) AS r(line)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id),
    m AS (
      SELECT w.doc_id, len(words)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN dups USING (doc_id))
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
                OR word_chars < 2 * n_words OR word_chars > 20 * n_words
                OR 10 * n_symbols > 3 * n_words
                OR (n_dup_lines >= 10 AND 40 * n_dup_lines > n_words)) AS kept
    FROM m
    """,
)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import METRICS, measured

    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured(table(spark, sf_dir)).select(
        "doc_id", *METRICS, base.alias("base_failed"), F.col("rejected_by").isNull().alias("kept")
    )


@register(
    "op9_exact_dedup",
    r"""
    WITH n AS (
      SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1 AS kept, sha256(text) AS text_sha256
    FROM n WINDOW g AS (PARTITION BY text)
    """,
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir))


def tokenizer_file(name: str) -> str:
    """The place of a public vocabulary; the package is installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_token_records")
def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_records import ids_crc32, write_records

    written = write_records(table(spark, sf_dir), tokenizer_file("word_bpe_49k.json"), end_id=2)
    back = written.read(written.index(spark))
    return back.select(
        "doc_id", "start", F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), ids_crc32(F.col("ids")).alias("ids_crc32")
    )


@register("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .byte_bpe import encode

    path = tokenizer_file("byte_bpe_50k.tiktoken")
    return encode(table(spark, sf_dir), path, decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@register("op2_entropy_mix")
def op2_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .entropy_mix import mixed

    return mixed(table(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


@register("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import held_out, scored, train

    docs = table(spark, sf_dir).select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model, "score").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@register("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import KINDS, personal_data, span_texts

    found = personal_data(table(spark, sf_dir))
    base, spans = span_texts(found)
    return found.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS], F.sha2(base, 256).alias("base_sha256"), spans.alias("spans")
    )


@register("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import KINDS, secrets, span_text

    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return secrets(table(spark, sf_dir)).select(
        "doc_id", *map(count, KINDS), F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans")
    )


@register("op6_jaccard_join")
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import similar_documents

    return similar_documents(table(spark, sf_dir), width=4, percent=85).select("doc_id", "n_shingles", "component_id", "n_links")


@register("op5_language_model")
def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_model import scored

    return scored(table(spark, sf_dir))


_BENCHMARK_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


@register(
    "op13_decontamination",
    rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_BENCHMARK_WORDS} AS w FROM documents),
    b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_BENCHMARK_WORDS} AS w FROM benchmark),
    bw AS (
      SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g
      FROM (SELECT *, least(10, len(w)) AS k FROM b WHERE len(w) > 0), unnest(range(1, len(w) - k + 2)) AS u(i)),
    dw AS (
      SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
      FROM d, (SELECT DISTINCT k FROM bw), unnest(range(1, len(w) - k + 2)) AS u(i)),
    found AS (SELECT r, i, k, item FROM dw JOIN bw USING (k, g)),
    hit AS (SELECT r, count(DISTINCT i + j) AS n_hit FROM found, unnest(range(k)) AS u(j) GROUP BY r),
    who AS (
      SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (r) LEFT JOIN who USING (r)
    """,
)
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import contamination

    return contamination(table(spark, sf_dir), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def _codes_sql(rounds: int = 6) -> str:
    """Rounds of assignment and averaging, one after another, over components as rows."""

    def assigned(i: int) -> str:
        return f"""
        a{i} AS MATERIALIZED (
          SELECT r, part, min({{'d': d, 'e': e}}) AS m
          FROM (SELECT r, part, e, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d FROM v JOIN c{i} c USING (part, pos) GROUP BY r, part, e)
          GROUP BY r, part)"""

    steps = []
    for i in range(rounds):
        steps += [
            assigned(i),
            f"""
        c{i + 1} AS MATERIALIZED (
          SELECT c.part, c.e, c.pos, coalesce((s - ((s % n) + n) % n) // n, c.x)::BIGINT AS x
          FROM c{i} c LEFT JOIN (
            SELECT part, a.m.e AS e, pos, sum(x) AS s, count(*) AS n FROM v JOIN a{i} a USING (r, part) GROUP BY ALL) USING (part, e, pos))""",
        ]
    return f"""
    WITH kept AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label, embedding, len(embedding) // 8 AS w FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    v AS MATERIALIZED (
      SELECT r, (i - 1) // w AS part, (i - 1) % w AS pos, floor(4096 * embedding[i]::DOUBLE)::BIGINT AS x
      FROM kept, unnest(range(1, len(embedding) + 1)) AS u(i)),
    c0 AS MATERIALIZED (SELECT part, r AS e, pos, x FROM v WHERE r < 16), {",".join(steps)}, {assigned(rounds)},
    coded AS MATERIALIZED (
      SELECT r, string_agg(printf('%02x', a.m.e), '' ORDER BY part) AS code, sum(a.m.d)::BIGINT AS error FROM a{rounds} a GROUP BY r)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, e, pos)) FROM c{rounds}) AS codebooks_sha256
    FROM coded JOIN kept USING (r)
    """


@register("op11_vector_codes", _codes_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .grid_codes import compress, label_errors

    codes = compress(table(spark, sf_dir, "embeddings"))
    return label_errors(codes.coded).select("vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


@register(
    "op12_conversation_repair",
    r"""
    WITH RECURSIVE source AS (
      SELECT conv_id, turn, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text
      FROM conversations),
    summed AS (  -- the checksum, bit by bit
      SELECT *, xor(4294967295, list_reduce(
               list_concat([4294967295::BIGINT], list_transform(range(1, len(k) + 1), lambda i: ascii(k[i])::BIGINT)),
               lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384)))) % 20 AS kind
      FROM source),
    damaged AS (
      SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM summed, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS c(copy)),
    placed AS MATERIALIZED (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos FROM damaged),
    told AS MATERIALIZED (
      SELECT *, left(role, 1) AS init,
             CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS earlier
      FROM placed),
    inserts(q, p, more, audit, made) AS (VALUES
      (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
      (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']), (3, 2, 2, 'I', ['user:']),
      (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:']), (3, 3, 4, 'II', ['user:', 'assistant:']),
      (2, 2, 4, 'II', ['assistant:', 'user:'])),
    arcs AS MATERIALIZED (
      SELECT conv_id, pos, q, q AS p, 3 AS more, 'D' AS edit, []::VARCHAR[] AS made FROM told, range(4) AS s(q)
      UNION ALL
      SELECT conv_id, pos, q, p, (fault IS NOT DISTINCT FROM 'truncated')::INT, 'K', [role || ':' || text]
      FROM told JOIN (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS k(q, init, p) USING (init)
      WHERE fault IS DISTINCT FROM 'blank' AND fault IS DISTINCT FROM 'duplicate'
      UNION ALL
      SELECT conv_id, pos, q, p, 2 + (fault IS NOT DISTINCT FROM 'truncated')::INT, 'R', [name || ':' || text]
      FROM told, (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')) AS k(q, p, name)
      WHERE fault IS DISTINCT FROM 'blank' AND fault IS DISTINCT FROM 'duplicate'),
    ways AS (
      SELECT DISTINCT conv_id, 0::BIGINT AS pos, 0 AS q, {'cost': 0::BIGINT, 'audit': '', 'made': []::VARCHAR[]} AS way FROM source
      UNION ALL
      SELECT w.conv_id, w.pos + 1, a.p,
             min({'cost': w.way.cost + i.more + a.more, 'audit': w.way.audit || i.audit || a.edit, 'made': list_concat(list_concat(w.way.made, i.made), a.made)})
      FROM ways w JOIN inserts i ON w.q = i.q
        JOIN arcs a ON a.conv_id IS NOT DISTINCT FROM w.conv_id AND a.pos = w.pos + 1 AND a.q = i.p
      GROUP BY w.conv_id, w.pos, a.p),
    counts AS (
      SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (earlier IS NOT NULL AND earlier || init NOT IN ('su', 'ua', 'au')) AS illegal
      FROM told GROUP BY conv_id),
    least AS (
      SELECT w.conv_id, min({'cost': w.way.cost + i.more, 'audit': w.way.audit || i.audit, 'made': list_concat(w.way.made, i.made)}) AS way
      FROM ways w JOIN inserts i ON w.q = i.q LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
      WHERE i.p IN (0, 3) AND w.pos = coalesce(c.n, 0) GROUP BY w.conv_id)
    SELECT l.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, l.way.cost AS cost, l.way.audit AS audit, sha256(array_to_string(l.way.made, chr(10))) AS repaired_sha256
    FROM least l LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM l.conv_id
    """,
)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversation_repair import damaged, reports

    conversations = table(spark, sf_dir, "conversations")
    return reports(damaged(conversations), conversations)
