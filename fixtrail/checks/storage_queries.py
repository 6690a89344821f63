"""I1-I10 on the driver tables: files are written to the shared folder and read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions.code import surrogate_id
from ..operators import shaping
from ..plans import analytics
from ..schemas import TABLES
from ..session import scratch_path
from ..sources import feed, tables as store, weaknesses
from ..streaming.incremental import incremental_ingest
from .registry import register
from .testbed import tables


def _feed(parts):
    """Feed documents with one advisory each, as an exporter writes JSON lines."""
    text = lambda value: F.array(F.struct(F.lit("en").alias("lang"), value.alias("value")))
    url = F.concat(F.lit("https://github.com/o/p/commit/"), F.md5(F.col("p_partkey").cast("string")))
    reference = F.struct(url.alias("url"), F.col("p_name").alias("name"))
    cve = F.struct(
        F.lit("CVE").alias("data_type"),
        F.struct(F.concat(F.lit("CVE-"), F.col("p_partkey").cast("string")).alias("ID"), F.lit("x").alias("ASSIGNER"))
        .alias("CVE_data_meta"),
        F.struct(F.array(F.struct(text(F.col("p_brand")).alias("description"))).alias("problemtype_data"))
        .alias("problemtype"),
        F.struct(F.when(F.col("p_size") % 10 == 0, F.array().cast(f"array<{_type(parts, reference)}>"))
                 .otherwise(F.array(reference)).alias("reference_data")).alias("references"),
        F.struct(text(F.col("p_name")).alias("description_data")).alias("description"),
    )
    impact = F.struct(
        F.when(F.col("p_size") % 7 != 0, F.struct(
            F.struct(F.lit("3.0").alias("version"), F.lit("LOW").alias("attackComplexity"),
                     (F.col("p_size") / 10).alias("baseScore")).alias("cvssV3"),
            F.lit(2.5).alias("exploitabilityScore"), (F.col("p_size") / 20).alias("impactScore"))).alias("baseMetricV3"),
        F.struct(F.struct((F.col("p_size") / 5).alias("baseScore")).alias("cvssV2"), F.col("p_type").alias("severity"),
                 (F.col("p_size") % 2 == 0).alias("userInteractionRequired")).alias("baseMetricV2"),
    )
    day = F.date_format(F.date_add(F.lit(date(1999, 1, 1)), F.col("p_size") * 100), "yyyy-MM-dd'T'09:59'Z'")
    item = F.struct(cve.alias("cve"), impact.alias("impact"), day.alias("publishedDate"), day.alias("lastModifiedDate"))
    return parts.select(F.lit("2024-05-06T07:00Z").alias("CVE_data_timestamp"), F.array(item).alias("CVE_Items"))


def _type(df, column) -> str:
    return df.select(column.alias("c")).schema["c"].dataType.simpleString()


@register("i1_read_advisory_feed", """
    SELECT 'CVE-' || CAST(p_partkey AS STRING) AS cve_id,
           strftime(DATE '1999-01-01' + p_size * 100, '%Y-%m-%d 09:59') AS published, p_type AS severity,
           p_size % 2 = 0 AS user_interaction_required, p_size / 5 AS cvss2_base_score,
           CASE WHEN p_size % 7 <> 0 THEN p_size / 10 END AS cvss3_base_score,
           CASE WHEN p_size % 7 <> 0 THEN 'LOW' END AS cvss3_attack_complexity,
           CASE WHEN p_size % 7 <> 0 THEN 2.5::DOUBLE END AS exploitability_score,
           CASE WHEN p_size % 7 <> 0 THEN p_size / 20 END AS impact_score,
           'https://github.com/o/p/commit/' || md5(CAST(p_partkey AS STRING)) AS url, p_brand AS weakness,
           p_name AS description
    FROM part WHERE p_size % 10 <> 0""")
def i1(spark, sf_dir):
    folder = scratch_path(spark, "feed")
    _feed(tables(spark, sf_dir)["part"]).write.json(folder)
    cve = feed.advisories(feed.read_advisory_feed(spark, folder, lines=True))
    published = F.to_utc_timestamp("published_date", F.current_timezone())  # whatever the session's zone
    return cve.select(
        "cve_id", F.date_format(published, "yyyy-MM-dd HH:mm").alias("published"), "severity",
        "user_interaction_required", "cvss2_base_score", "cvss3_base_score", "cvss3_attack_complexity",
        "exploitability_score", "impact_score", F.col("reference_json")[0]["url"].alias("url"),
        F.col("problemtype_json")[0]["description"][0]["value"].alias("weakness"),
        F.col("description")[0]["value"].alias("description"))


@register("i2_read_weakness_catalog", """
    SELECT p_partkey AS id, p_brand AS name, p_name AS description, p_type || ' & more' AS extended_description,
           false AS is_category FROM part
    UNION ALL SELECT s_suppkey, s_name, 'sum <of> ' || s_name, '', true FROM supplier""")
def i2(spark, sf_dir):
    t = tables(spark, sf_dir)
    folder = scratch_path(spark, "catalog")
    # Markup inside a text is part of the extended description only; there it is dropped.
    t["part"].select(
        F.col("p_partkey").alias("_ID"), F.col("p_brand").alias("_Name"), F.col("p_name").alias("Description"),
        F.concat("p_type", F.lit(" & <b>more</b>")).alias("Extended_Description"),
    ).write.format("xml").option("rootTag", "Weaknesses").option("rowTag", "Weakness").save(f"{folder}/weaknesses")
    t["supplier"].select(
        F.col("s_suppkey").alias("_ID"), F.col("s_name").alias("_Name"),
        F.concat(F.lit("sum <of> "), "s_name").alias("Summary"),
    ).write.format("xml").option("rootTag", "Categories").option("rowTag", "Category").save(f"{folder}/categories")
    return weaknesses.read_weakness_catalog(spark, f"{folder}/*")


@register("i3_year_window", """
    SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1997""")
def i3(spark, sf_dir):
    orders = tables(spark, sf_dir)["orders"].select("o_orderkey", "o_orderdate")
    return feed.year_window(orders, "o_orderdate", first=1996, last=1997)


@register("i3_year_window_sample", """
    SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1998""")
def i3_sample(spark, sf_dir):
    orders = tables(spark, sf_dir)["orders"].select("o_orderkey", "o_orderdate")
    return feed.year_window(orders, "o_orderdate", sample=True, today=date(1998, 6, 1))


@register("i4_incremental_ingest", """
    SELECT event_id, user_id, event_type, value FROM events WHERE event_id % 50 <> 0""")
def i4(spark, sf_dir):
    events = tables(spark, sf_dir)["events"].select("event_id", "user_id", "event_type", "value")
    known = events.where("event_id % 50 = 0")
    inbox, target, checkpoint = (scratch_path(spark, name) for name in ("inbox", "advisories", "progress"))
    # Two deliveries that overlap, then one idle start.
    for delivery in ("event_id % 3 <> 0", "event_id % 3 <> 1", None):
        if delivery:
            events.where(delivery).write.mode("append").json(inbox)
        incremental_ingest(spark, inbox, events.schema, target, checkpoint, "event_id", known).awaitTermination()
    return spark.read.schema(events.schema).parquet(target)


def _stored_tables(t):
    """The eight views in stored types."""
    identity = {"file_change_id": surrogate_id("file_change_id")}
    dmm = ["dmm_unit_size", "dmm_unit_complexity", "dmm_unit_interfacing"]
    typed = {
        "cve": shaping.decode_markers(t["cve"], analytics.SCORES),
        "commits": shaping.decode_markers(t["commits"], dmm),
        "file_change": t["file_change"].withColumns(identity),
        "method_change": t["method_change"].withColumns(
            {**identity, "method_change_id": surrogate_id("method_change_id"), "parameters": F.array("parameters")}),
    }
    return {name: shaping.align_schema(typed.get(name, t[name]), schema) for name, schema in TABLES.items()}


# Columns of the stored tables.
WIDTHS = {"cve": 34, "fixes": 3, "commits": 16, "file_change": 16, "method_change": 13, "cwe": 6,
          "cwe_classification": 2, "repository": 10}


@register("i5_load_tables", " UNION ALL ".join(
    f"SELECT '{name}' AS name, count(*) AS row_count, {width} AS column_count FROM {{{name}}}"
    for name, width in WIDTHS.items()))
def i5(spark, sf_dir):
    root = scratch_path(spark, "tables")
    store.write_tables(_stored_tables(tables(spark, sf_dir)), root)
    rows = None
    for name, table in store.load_tables(spark, root).items():
        counted = table.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("name"), "row_count", F.lit(len(table.columns)).alias("column_count"))
        rows = counted if rows is None else rows.unionAll(counted)
    return rows


@register("i6_write_table", """
    SELECT o_orderkey, o_orderstatus, true AS existed FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT o_orderkey, o_orderstatus, true FROM orders WHERE o_orderstatus = 'F'""")
def i6(spark, sf_dir):
    orders = tables(spark, sf_dir)["orders"].select("o_orderkey", "o_orderstatus")
    target = scratch_path(spark, "orders")
    before = store.table_exists(spark, target)
    store.write_table(orders, target)
    store.write_table(orders.where("o_orderstatus <> 'F'"), target)  # replaces
    store.write_table(orders.where("o_orderstatus = 'F'"), target, mode="append")
    existed = not before and store.table_exists(spark, target)
    return spark.read.parquet(target).withColumn("existed", F.lit(existed))


@register("i7_insert_if_absent", """
    SELECT repo_url, repo_name FROM {repository}
    UNION ALL
    SELECT repo_url, min(hash) FROM {commits} c
    WHERE NOT EXISTS (SELECT 1 FROM {repository} r WHERE r.repo_url = c.repo_url) GROUP BY repo_url""")
def i7(spark, sf_dir):
    t = tables(spark, sf_dir)
    target = scratch_path(spark, "repository")
    store.insert_if_absent(t["repository"].select("repo_url", "repo_name"), target, "repo_url", ["repo_name"])
    found = t["commits"].select("repo_url", F.col("hash").alias("repo_name"))
    for _ in range(2):  # the second time nothing is new
        store.insert_if_absent(found, target, "repo_url", ["repo_name"])
    return spark.read.parquet(target)


@register("i8_export_jsonl", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def i8(spark, sf_dir):
    customer = tables(spark, sf_dir)["customer"].select("c_custkey", "c_name", "c_acctbal")
    folder = store.export_jsonl(customer, scratch_path(spark, "export"), "2024-05-06")
    return spark.read.schema(customer.schema).json(folder)


@register("i9_feed_timestamp", "SELECT max(CAST(ts AS DATE)) AS feed_date FROM events")
def i9(spark, sf_dir):
    stamped = tables(spark, sf_dir)["events"].select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm'Z'").alias("stamp"))
    return feed.feed_timestamp(stamped, "stamp")


@register("i10_write_report", """
    SELECT fx.repo_url AS commit_project, count(fx.hash) AS commit_count
    FROM {commits} c, {fixes} fx WHERE fx.hash = c.hash GROUP BY fx.repo_url ORDER BY 2 DESC, 1 LIMIT 10""")
def i10(spark, sf_dir):
    counts = analytics.commit_count(tables(spark, sf_dir))
    path = scratch_path(spark, "report")
    store.write_report(counts, path, [F.desc("commit_count"), "commit_project"])
    return spark.read.schema(counts.schema).option("header", True).csv(path)
