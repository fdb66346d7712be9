"""Page planning and URL work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions.web import overlay, query_map, redact, url_host, url_problem
from siltworks.operators.paging import distinct_keys, key_batches, page_plan, pages_before_first_empty

from .registry import check, table


@check(
    "q36_distinct_page_keys",
    """SELECT DISTINCT w AS key FROM (SELECT unnest(string_split(text, ' ')) AS w FROM conversations) WHERE w <> ''""",
)
def distinct_page_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Every message is a page whose elements are its words."""
    words = F.transform(F.split("text", " "), lambda w: F.struct(w.alias("uniqueKey")))
    pages = table(spark, sf, "conversations").select(words.alias("results"))
    return distinct_keys(pages, F.col("results"), "uniqueKey")


@check(
    "q37_key_batches",
    """WITH p AS (SELECT p_partkey, (row_number() OVER (ORDER BY p_partkey) - 1) // 50 + 1 AS batch_no FROM part)
       SELECT cast(batch_no AS bigint) AS batch_no, count(*) AS n_keys, min(p_partkey) AS first_key,
              max(p_partkey) AS last_key, string_agg(cast(p_partkey AS varchar), ',' ORDER BY p_partkey) AS keys
       FROM p GROUP BY batch_no""",
)
def batches_of_keys(spark: SparkSession, sf: str) -> DataFrame:
    batches = key_batches(table(spark, sf, "part"), "p_partkey", 50)
    return batches.select(
        "batch_no",
        F.size("keys").cast("bigint").alias("n_keys"),
        F.array_min("keys").alias("first_key"),
        F.array_max("keys").alias("last_key"),
        F.array_join(F.transform("keys", lambda k: k.cast("string")), ",").alias("keys"),
    )


@check(
    "q38_page_plan",
    """WITH c AS (SELECT c_custkey, count(o_orderkey) AS total FROM customer LEFT JOIN orders ON o_custkey = c_custkey
                  GROUP BY c_custkey)
       SELECT c_custkey, total, unnest(range(0, greatest(total, 1), 3)) AS "offset" FROM c""",
)
def plan_of_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Orders are counted per customer before the join, so a busy customer is one row there."""
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    totals = (
        table(spark, sf, "customer")
        .join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select("c_custkey", F.coalesce("n", F.lit(0)).alias("total"))
    )
    return page_plan(totals, "total", 3)


@check(
    "q38b_pages_before_empty",
    """WITH p AS (SELECT l_suppkey, l_orderkey * 10 + l_linenumber AS page_offset,
                         l_quantity AS n_items, l_discount = 0 AS is_empty FROM lineitem)
       SELECT p.* FROM p LEFT JOIN (SELECT l_suppkey, min(page_offset) AS stop FROM p
                                    WHERE is_empty AND page_offset > 0 GROUP BY l_suppkey) s
              ON s.l_suppkey = p.l_suppkey
       WHERE stop IS NULL OR page_offset < stop""",
)
def pages_until_empty(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "lineitem").select(
        "l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("page_offset"),
        F.col("l_quantity").alias("n_items"), (F.col("l_discount") == 0).alias("is_empty"),
    )
    return pages_before_first_empty(pages, "l_suppkey", "page_offset", F.col("is_empty"))


_EXTENDED = """SELECT page_id, url, CASE WHEN contains(url, '#') THEN NULL ELSE
    url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'page=' || page_id || '&q=a%20b+c%26d&blank=&&page=9' END AS long_url
    FROM pages"""


@check(
    "q39_query_map",
    f"""SELECT page_id, coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), ''), 'none') AS page,
               coalesce(nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), ''), 'none') AS ref,
               coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), ''), '0') AS merged_page,
               '100' AS merged_limit,
               CASE WHEN long_url IS NULL THEN 'none' ELSE '9' END AS last_page,
               CASE WHEN long_url IS NULL THEN 'none' ELSE 'a b c&d' END AS decoded,
               CASE WHEN long_url IS NULL THEN 'none' ELSE '' END AS blank
        FROM ({_EXTENDED})""",
)
def query_maps(spark: SparkSession, sf: str) -> DataFrame:
    none, zero = F.lit("none"), F.lit("0")
    pages = table(spark, sf, "pages").select(
        "page_id",
        "url",
        F.when(
            ~F.col("url").contains("#"),
            F.concat(
                "url", F.when(F.col("url").contains("?"), "&").otherwise("?"), F.lit("page="),
                F.col("page_id").cast("string"), F.lit("&q=a%20b+c%26d&blank=&&page=9"),
            ),
        ).alias("long_url"),
    )
    start = F.create_map(F.lit("page"), zero, F.lit("limit"), F.lit("100"))
    m = pages.select(
        "page_id", query_map(F.col("url")).alias("params"), query_map(F.col("long_url")).alias("long")
    ).withColumn("merged", overlay(start, F.col("params")))
    get = lambda c, k, default: F.coalesce(F.try_element_at(c, F.lit(k)), default)
    return m.select(
        "page_id", get("params", "page", none).alias("page"), get("params", "ref", none).alias("ref"),
        get("merged", "page", none).alias("merged_page"), get("merged", "limit", none).alias("merged_limit"),
        get("long", "page", none).alias("last_page"), get("long", "q", none).alias("decoded"),
        get("long", "blank", none).alias("blank"),
    )


@check(
    "q40_redaction",
    """SELECT page_id, '***' AS api_key, '***' AS token, cast(page_id AS varchar) AS page FROM pages""",
)
def redaction(spark: SparkSession, sf: str) -> DataFrame:
    page = F.col("page_id").cast("string")
    url = F.concat(F.lit("https://h.example/x?API_Key=k"), page, F.lit("&page="), page, F.lit("&Token=t"), page)
    hidden = table(spark, sf, "pages").select("page_id", redact(query_map(url)).alias("m"))
    return hidden.select(
        "page_id", F.col("m")["API_Key"].alias("api_key"), F.col("m")["Token"].alias("token"),
        F.col("m")["page"].alias("page"),
    )


_VARIANTS = """SELECT page_id, CASE page_id % 8
        WHEN 1 THEN 'ftp' || url WHEN 2 THEN '' WHEN 3 THEN 'http://LocalHost:8080/' || page_id
        WHEN 4 THEN 'https:///' || page_id WHEN 5 THEN 'http://u:p@[::1]:80/' || page_id
        WHEN 6 THEN 'http://169.254.169.254/' || page_id WHEN 7 THEN NULL ELSE url END AS target FROM pages"""


@check(
    "q41_url_admissibility",
    f"""SELECT page_id, coalesce(CASE page_id % 8 WHEN 1 THEN 'scheme' WHEN 2 THEN 'empty' WHEN 3 THEN 'blocked host'
               WHEN 4 THEN 'no host' WHEN 5 THEN 'blocked host' WHEN 6 THEN 'blocked host' WHEN 7 THEN 'empty' END, 'fine') AS problem,
               CASE page_id % 8 WHEN 2 THEN '' WHEN 3 THEN 'localhost' WHEN 4 THEN '' WHEN 5 THEN '::1'
               WHEN 6 THEN '169.254.169.254' WHEN 7 THEN '' ELSE regexp_extract(target, '://([^/:]*)', 1) END AS host
        FROM ({_VARIANTS})""",
)
def url_admissibility(spark: SparkSession, sf: str) -> DataFrame:
    """All pages; seven of eight URLs are spoilt in one way each."""
    case = F.expr(_VARIANTS[_VARIANTS.index("CASE"):_VARIANTS.index(" AS target")])
    urls = table(spark, sf, "pages").select("page_id", case.alias("target"))
    return urls.select(
        "page_id",
        F.coalesce(url_problem(F.col("target")), F.lit("fine")).alias("problem"),
        F.coalesce(url_host(F.col("target")), F.lit("")).alias("host"),
    )
