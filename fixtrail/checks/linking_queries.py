"""L1-L10 on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.paths import owner_of
from ..operators import linking as L
from .registry import register
from .testbed import tables

LINK = r"((https?://(bitbucket|github|gitlab)\.(org|com)/[^/]+/[^/]*)/commits?/(\w+)#?)+"


@register("l1_extract_fix_links", f"""
    SELECT DISTINCT cve_id, regexp_extract(url, '{LINK}', 5) AS hash,
           replace(regexp_extract(url, '{LINK}', 2), 'http:', 'https:') AS repo_url
    FROM {{link_urls}} WHERE regexp_extract(url, '{LINK}', 5) <> ''""")
def l1(spark, sf_dir):
    urls = tables(spark, sf_dir)["link_urls"]
    return L.extract_fix_links(urls.select("cve_id", F.array(F.struct("url")).alias("reference_json")))


@register("l2_classify", """
    SELECT DISTINCT CAST(p_partkey AS STRING) AS cve_id,
           replace(unnest(CASE WHEN p_size % 5 = 0 THEN ['unknown'] WHEN p_size > 25 THEN [p_brand, p_type]
                          ELSE [p_brand] END), 'unknown', 'NVD-CWE-noinfo') AS cwe_id
    FROM part""")
def l2(spark, sf_dir):
    part = tables(spark, sf_dir)["part"]
    entry = lambda name: F.struct(F.lit("en").alias("lang"), F.col(name).alias("value"))
    weaknesses = (
        F.when(F.col("p_size") % 5 == 0, F.array().cast("array<struct<lang:string,value:string>>"))
        .when(F.col("p_size") > 25, F.array(entry("p_brand"), entry("p_type")))
        .otherwise(F.array(entry("p_brand")))
    )
    problem_types = F.array(F.struct(weaknesses.alias("description")))
    return L.classify(part.select(F.col("p_partkey").cast("string").alias("cve_id"),
                                  problem_types.alias("problemtype_json")))


WEAKNESS_DIM = """
    SELECT cwe_id, cwe_name, description, extended_description, url, is_category FROM (
        SELECT *, row_number() OVER (PARTITION BY cwe_id ORDER BY rank, cwe_name) AS rn FROM (
            SELECT 'CWE-' || CAST(id AS STRING) AS cwe_id, name AS cwe_name, description, extended_description,
                   CASE WHEN id > 0 THEN 'https://cwe.mitre.org/data/definitions/' || CAST(id AS STRING) || '.html' END
                       AS url,
                   is_category, CASE WHEN is_category THEN 1 ELSE 0 END AS rank
            FROM {nodes}
            UNION ALL %s)) WHERE rn = 1""" % " UNION ALL ".join(
    "SELECT " + ", ".join(f"'{value}'" for value in row[:5]) + f", {str(row[5]).lower()}, 2"
    for row in L.EXTRA_WEAKNESSES
)


@register("l3_build_weakness_dim", WEAKNESS_DIM)
def l3(spark, sf_dir):
    return L.build_weakness_dim(tables(spark, sf_dir)["nodes"])


@register("l4_missing_references", """
    SELECT cve_id FROM {cwe_classification} EXCEPT SELECT cve_id FROM {fixes}""")
def l4(spark, sf_dir):
    t = tables(spark, sf_dir)
    return L.missing_references(t["cwe_classification"], t["fixes"], "cve_id")


@register("l5_drop_unavailable", """
    WITH last AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY url ORDER BY probed_at DESC, status DESC, location DESC) AS rn
        FROM {probe_log} WHERE status <> 429) WHERE rn = 1)
    SELECT cve_id, hash, repo_url FROM {fixes} WHERE repo_url NOT IN (
        SELECT url FROM last WHERE status >= 400
            OR (status IN (301, 302, 303, 307, 308) AND location = 'https://gitlab.com/users/sign_in'))""")
def l5(spark, sf_dir):
    t = tables(spark, sf_dir)
    return L.drop_unavailable(t["fixes"], t["probe_log"])


EXCLUDED = ["https://host.example/cust/p_1", "https://host.example/cust/p_5"]


@register("l6_sample_fixes", """
    SELECT cve_id, hash, repo_url FROM {fixes}
    WHERE repo_url NOT IN ('https://host.example/cust/p_1', 'https://host.example/cust/p_5')
    ORDER BY cve_id, repo_url, hash LIMIT 25""")
def l6(spark, sf_dir):
    return L.sample_fixes(tables(spark, sf_dir)["fixes"], 25, EXCLUDED)


@register("l7_pending_fixes", """
    SELECT cve_id, hash, repo_url FROM {fixes} fx
    WHERE NOT EXISTS (SELECT 1 FROM {commits} c WHERE c.hash = fx.hash AND c.dmm_unit_size <> 'None')""")
def l7(spark, sf_dir):
    t = tables(spark, sf_dir)
    return L.pending_fixes(t["fixes"], t["commits"].where("dmm_unit_size <> 'None'"))


@register("l8_work_units", """
    WITH ha AS (SELECT DISTINCT repo_url, hash FROM {fixes}),
    si AS (SELECT repo_url, count(*) AS hash_count FROM ha GROUP BY repo_url),
    un AS (SELECT ha.repo_url, hash, hash_count,
                  CAST('0x' || substr(md5(hash), 1, 8) AS BIGINT) % CAST(ceil(hash_count / 10.0) AS BIGINT) AS unit
           FROM ha JOIN si ON ha.repo_url = si.repo_url)
    SELECT repo_url, repo_url AS clone_url, unit, hash_count, hash_count = 1 AS single_hash,
           string_agg(hash, ' ' ORDER BY hash) AS hashes
    FROM un GROUP BY repo_url, unit, hash_count""")
def l8(spark, sf_dir):
    units = L.work_units(tables(spark, sf_dir)["fixes"], batch=10)
    return units.withColumn("hashes", F.array_join("hashes", " "))


def _resolved(condition: str) -> str:
    return f"""
    WITH ca AS (SELECT DISTINCT repo_url, hash FROM {{short_commits}} c
                WHERE NOT EXISTS (SELECT 1 FROM {{short_fixes}} f WHERE f.hash = c.hash)),
    op AS (SELECT DISTINCT repo_url, hash FROM {{short_fixes}} f
           WHERE NOT EXISTS (SELECT 1 FROM {{short_commits}} c WHERE f.hash = c.hash)),
    ch AS (SELECT op.repo_url, op.hash, min(ca.hash) AS full_hash FROM op JOIN ca
           ON op.repo_url = ca.repo_url AND substr(op.hash, 1, 4) = substr(ca.hash, 1, 4) {condition} GROUP BY ALL)
    SELECT f.cve_id, COALESCE(ch.full_hash, f.hash) AS hash, f.repo_url
    FROM {{short_fixes}} f LEFT JOIN ch ON f.repo_url = ch.repo_url AND f.hash = ch.hash"""


@register("l9_resolve_short_hashes", _resolved(""))
def l9(spark, sf_dir):
    t = tables(spark, sf_dir)
    return L.resolve_short_hashes(t["short_fixes"], t["short_commits"])


@register("l9_resolve_short_hashes_strict", _resolved("AND starts_with(ca.hash, op.hash)"))
def l9_strict(spark, sf_dir):
    t = tables(spark, sf_dir)
    return L.resolve_short_hashes(t["short_fixes"], t["short_commits"], strict=True)


@register("l10_attach_repo_meta", """
    SELECT h.repo_url, m.repo_name, m.stars_count,
           list_extract(string_split(h.repo_url, '/'), -2) AS owner
    FROM (SELECT DISTINCT repo_url FROM {hosted} WHERE repo_url LIKE '%github.%') h
    LEFT JOIN {meta} m ON h.repo_url = m.repo_url""")
def l10(spark, sf_dir):
    t = tables(spark, sf_dir)
    return L.attach_repo_meta(t["hosted"], t["meta"]).withColumn("owner", owner_of(F.col("repo_url")))
