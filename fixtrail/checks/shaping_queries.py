"""S1-S20 on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import paths, text
from ..operators import shaping as S
from .registry import register
from .testbed import tables


@register("s1_flatten", """
    SELECT p_partkey AS "item.key", p_brand AS "item.kind.brand", p_type AS "item.kind.type",
           array_to_string(string_split(p_name, ' '), '|') AS "words", p_size AS "p_size" FROM part""")
def s1(spark, sf_dir):
    part = tables(spark, sf_dir)["part"]
    kind = F.struct(F.col("p_brand").alias("brand"), F.col("p_type").alias("type"))
    nested = part.select(
        F.struct(F.col("p_partkey").alias("key"), kind.alias("kind")).alias("item"),
        F.split("p_name", " ").alias("words"), "p_size",
    )
    return S.flatten(nested).withColumn("words", F.array_join("words", "|"))


NAMES = """
    SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'cve.description.description_data'
        WHEN p_size % 4 = 1 THEN 'cve.problemtype.problemtype_data'
        WHEN p_size % 4 = 2 THEN 'impact.baseMetricV' || CAST(p_size % 3 AS STRING) || '.cvssV' ||
                                 CAST(p_size % 3 AS STRING) || '.' || lower(p_type) || 'BaseScore'
        ELSE 'impact.baseMetricV2.obtain' || upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) || 'Privilege'
        END AS path FROM {part}"""


@register("s2_snake_name", f"""
    SELECT p_partkey, replace(replace(replace(lower(regexp_replace(
        replace(array_to_string(string_split(path, '.')[3:], '.'), '.', '_'), '([a-z0-9_])([A-Z])', '\\1_\\2', 'g')),
        'cvss_v', 'cvss'), '_data', '_json'), 'description_json', 'description') AS name
    FROM ({NAMES})""")
def s2(spark, sf_dir):
    paths_ = spark.sql(NAMES, part=tables(spark, sf_dir)["part"])
    return paths_.select("p_partkey", text.snake_column(F.col("path")).alias("name"))


@register("s3_drop_columns", 'SELECT p_partkey AS "cve.CVE_data_meta.ID", p_size AS "severity" FROM part')
def s3(spark, sf_dir):
    part = tables(spark, sf_dir)["part"]
    extras = [F.col("p_brand").alias(name) for name in S.FEED_EXTRAS]
    wide = part.select(F.col("p_partkey").alias("cve.CVE_data_meta.ID"), *extras, F.col("p_size").alias("severity"))
    return S.drop_columns(wide)


@register("s4_align_schema", """
    SELECT o_orderpriority, o_orderkey, '' AS homepage, CAST(NULL AS INTEGER) AS stars_count,
           CAST(o_totalprice AS VARCHAR) AS o_totalprice FROM orders""")
def s4(spark, sf_dir):
    target = "o_orderpriority string, o_orderkey bigint, homepage string, stars_count int, o_totalprice string"
    return S.align_schema(tables(spark, sf_dir)["orders"], target)


@register("s5_rename", """
    SELECT c_custkey AS cve_id, c_name AS "owner.name", c_nationkey AS c_nationkey FROM customer""")
def s5(spark, sf_dir):
    customer = tables(spark, sf_dir)["customer"].select("c_custkey", "c_name", "c_nationkey")
    return S.rename(customer, {"c_custkey": "cve_id", "c_name": "owner.name", "absent": "never"})


@register("s6_drop_empty_refs", """
    SELECT p_partkey FROM part WHERE p_partkey % 10 = 0 OR p_size % 3 <> 0""")
def s6(spark, sf_dir):
    refs = F.when(F.col("p_partkey") % 10 != 0, F.array_repeat("p_name", (F.col("p_size") % 3)))
    part = tables(spark, sf_dir)["part"].select("p_partkey", refs.alias("cve.references.reference_data"))
    return S.drop_empty_refs(part, "cve.references.reference_data").select("p_partkey")


@register("s7_merge_frames", """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
    UNION ALL SELECT p_partkey, p_name, NULL FROM part""")
def s7(spark, sf_dir):
    t = tables(spark, sf_dir)
    return S.merge_frames(
        t["customer"].select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                             F.col("c_mktsegment").alias("segment")),
        t["supplier"].select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")),
        t["part"].select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")),
    )


def _decoded(column: str) -> str:
    return f"TRY_CAST(nullif(nullif(nullif({column}, 'nan'), 'None'), '') AS DOUBLE)"


@register("s8_decode_markers", f"""
    SELECT hash, {_decoded('dmm_unit_size')} AS dmm_unit_size,
           {_decoded('dmm_unit_complexity')} AS dmm_unit_complexity FROM {{commits}}""")
def s8(spark, sf_dir):
    commits = tables(spark, sf_dir)["commits"].select("hash", "dmm_unit_size", "dmm_unit_complexity")
    return S.decode_markers(commits, ["dmm_unit_size", "dmm_unit_complexity"])


@register("s8_to_text", f"""
    SELECT hash, COALESCE(CAST({_decoded('dmm_unit_size')} AS VARCHAR), 'None') AS dmm_unit_size FROM {{commits}}""")
def s8_text(spark, sf_dir):
    commits = tables(spark, sf_dir)["commits"].select("hash", "dmm_unit_size")
    return S.to_text(S.decode_markers(commits, ["dmm_unit_size"]), ["dmm_unit_size"])


@register("s9_path_parts", """
    SELECT page_id, list_extract(string_split(url, '/'), -1) AS last_part,
           list_extract(string_split(url, '/'), -2) AS owner FROM pages""")
def s9(spark, sf_dir):
    url = F.col("url")
    return tables(spark, sf_dir)["pages"].select(
        "page_id", paths.last_segment(url).alias("last_part"), paths.owner_of(url).alias("owner"))


ADDRESSES = """
    SELECT page_id, url || CASE WHEN page_id % 3 = 0 THEN '.github.io.git' WHEN page_id % 3 = 1 THEN '.git' ELSE '' END
        AS url FROM {pages}"""


@register("s10_canonical_repo", f"""
    SELECT page_id, regexp_replace(url, '\\.git$', '') AS repo_url, string_split(url, '.git')[1] AS first_mark,
           CASE WHEN contains(url, 'github') THEN url || '.git' ELSE url END AS clone_url
    FROM ({ADDRESSES})""")
def s10(spark, sf_dir):
    url = F.col("url")
    return spark.sql(ADDRESSES, pages=tables(spark, sf_dir)["pages"]).select(
        "page_id", paths.canonical_repo(url).alias("repo_url"),
        paths.canonical_repo(url, first_mark=True).alias("first_mark"), paths.with_git_suffix(url).alias("clone_url"))


@register("s11_commit_url", """
    SELECT repo_url || CASE WHEN repo_url LIKE '%gitlab.%' THEN '/-/commit/' ELSE '/commit/' END || 'abc' AS url
    FROM {hosted}""")
def s11(spark, sf_dir):
    hosted = tables(spark, sf_dir)["hosted"]
    return hosted.select(paths.commit_url(F.col("repo_url"), F.lit("abc")).alias("url"))


@register("s12_clean_signature", """
    SELECT method_change_id, replace(trim(chr(9) || ' ' || signature || '  ' || chr(10), ' ' || chr(9) || chr(10)),
                                     ' ', '') AS signature FROM {method_change}""")
def s12(spark, sf_dir):
    padded = F.concat(F.lit("\t "), F.col("signature"), F.lit("  \n"))
    return tables(spark, sf_dir)["method_change"].select(
        "method_change_id", text.clean_signature(padded).alias("signature"))


@register("s13_parse_list", """
    SELECT p_partkey, p_brand || '|' || p_type AS weaknesses FROM part""")
def s13(spark, sf_dir):
    quote = F.when(F.col("p_size") % 2 == 0, F.lit("'")).otherwise(F.lit('"'))
    literal = F.concat(F.lit("["), quote, F.lit(" "), F.col("p_brand"), quote, F.lit(", "), quote, F.col("p_type"),
                       F.lit("  "), quote, F.lit("]"))
    part = tables(spark, sf_dir)["part"].select("p_partkey", literal.alias("literal"))
    return part.select("p_partkey", F.array_join(text.parse_list(F.col("literal")), "|").alias("weaknesses"))


@register("s14_replace_all_strings", """
    SELECT doc_id, replace(replace(replace(replace(text, '_', '-'), '"', ''), '''', ''), ',', '') AS text,
           replace(source, '_', '-') AS source, n_chars FROM documents""")
def s14(spark, sf_dir):
    documents = tables(spark, sf_dir)["documents"].select("doc_id", "text", "source", "n_chars")
    return S.replace_all_strings(documents, {"_": "-", '"': "", "'": "", ",": ""})


@register("s15_fill_null", """
    SELECT c_custkey, CAST(COALESCE(n, 0) AS BIGINT) AS n, COALESCE(total, 0.0) AS total
    FROM customer LEFT JOIN (
        SELECT o_custkey, count(*) AS n, max(o_totalprice) AS total FROM orders WHERE o_totalprice > 250000
        GROUP BY o_custkey) o ON c_custkey = o_custkey""")
def s15(spark, sf_dir):
    t = tables(spark, sf_dir)
    per_customer = t["orders"].where("o_totalprice > 250000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n"), F.max("o_totalprice").alias("total"))
    joined = t["customer"].select("c_custkey").join(per_customer, "c_custkey", "left")
    return S.fill_null(joined, ["n"])


AMOUNTS = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice WHEN o_orderkey % 4 = 1 THEN o_totalprice / 1000
        WHEN o_orderkey % 4 = 2 THEN o_totalprice * 10000 ELSE floor(o_totalprice / 1000) * 1000 END AS amount
    FROM {orders}"""


def _short_sql(divisor: str, unit: str) -> str:
    return (f"regexp_replace(CAST(CAST(round_even(amount / {divisor}, 1) AS DECIMAL(38, 1)) AS VARCHAR), '\\.0$', '')"
            f" || '{unit}'")


@register("s16_short_number", f"""
    SELECT o_orderkey, CASE WHEN amount >= 1e9 THEN {_short_sql('1e9', 'B')} WHEN amount >= 1e6 THEN {_short_sql('1e6', 'M')}
        WHEN amount >= 1e3 THEN {_short_sql('1e3', 'K')} ELSE {_short_sql('1.0', '')} END AS short
    FROM ({AMOUNTS.replace('{orders}', 'orders')})""")
def s16(spark, sf_dir):
    # The plain double keeps Spark's CASE from widening to decimals.
    amounts = spark.sql(AMOUNTS, orders=tables(spark, sf_dir)["orders"])
    return amounts.select("o_orderkey", text.short_number(F.col("amount").cast("double")).alias("short"))


@register("s17_hms", """
    SELECT event_id, CAST(floor(s / 3600) AS BIGINT) AS hours, CAST(floor((s % 3600) / 60) AS BIGINT) AS minutes,
           CAST(round_even((s % 3600) % 60, 0) AS BIGINT) AS seconds
    FROM (SELECT event_id, value * 128 AS s FROM events)""")
def s17(spark, sf_dir):
    events = tables(spark, sf_dir)["events"]
    return events.select("event_id", text.hms(F.col("value") * 128).alias("t")).select("event_id", "t.*")


@register("s18_days_between", """
    SELECT l_orderkey, l_linenumber, CAST(abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS INT)
        AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def s18(spark, sf_dir):
    t = tables(spark, sf_dir)
    dates = t["lineitem"].select("l_orderkey", "l_linenumber", "l_shipdate").join(
        t["orders"].select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return dates.select("l_orderkey", "l_linenumber",
                        text.days_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("days"))


@register("s19_round_all", """
    SELECT l_orderkey, l_linenumber, round(l_extendedprice / 7, 6) AS a, round(l_discount * l_tax, 6) AS b
    FROM lineitem""")
def s19(spark, sf_dir):
    prices = tables(spark, sf_dir)["lineitem"].select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 7).alias("a"),
        (F.col("l_discount") * F.col("l_tax")).alias("b"))
    return S.round_all(prices, 6)


@register("s20_distinct", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def s20(spark, sf_dir):
    return tables(spark, sf_dir)["lineitem"].select("l_partkey", "l_returnflag").distinct()


@register("s20_distinct_on", """
    SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
    WHERE rn = 1""")
def s20_on(spark, sf_dir):
    orders = tables(spark, sf_dir)["orders"].select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return S.distinct_on(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")
