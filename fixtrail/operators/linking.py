"""Links between advisories, commits, weaknesses and repositories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import with_git_suffix
from .key_filter import key_cascade
from .shaping import distinct_on

# Fixed value: address of a commit on one of three hosts. Of several addresses in a
# row the last one counts; it is group 1.
COMMIT_LINK = r"(?:(https?://(?:bitbucket|github|gitlab)\.(?:org|com)/[^/]+/[^/]*/commits?/\w+)#?)+"

NO_INFO = "NVD-CWE-noinfo"

# Weakness rows that the catalogue lacks. The texts are stored data.
EXTRA_WEAKNESSES = (
    (
        "NVD-CWE-noinfo",
        "Insufficient Information",
        "There is insufficient information about the issue to classify it; details are unkown or unspecified.",
        "Insufficient Information",
        "https://nvd.nist.gov/vuln/categories",
        False,
    ),
    (
        "NVD-CWE-Other",
        "Other",
        "NVD is only using a subset of CWE for mapping instead of the entire CWE, "
        "and the weakness type is not covered by that subset.",
        "Insufficient Information",
        "https://nvd.nist.gov/vuln/categories",
        False,
    ),
)

# Fixed value: where the host sends visitors of a repository that is gone.
LOGIN_PAGE = "https://gitlab.com/users/sign_in"
REDIRECTS = (301, 302, 303, 307, 308)
TOO_MANY_REQUESTS = 429

# Projects left out of a sample because of their size.
LARGE_PROJECTS = (
    "https://github.com/FFmpeg/FFmpeg",
    "https://github.com/ImageMagick/ImageMagick",
    "https://github.com/phpmyadmin/phpmyadmin",
    "https://github.com/the-tcpdump-group/tcpdump",
    "https://github.com/torvalds/linux",
)


def extract_fix_links(cve: DataFrame, references: str = "reference_json") -> DataFrame:
    """L1: distinct (cve_id, hash, repo_url) from the reference addresses of each advisory."""
    urls = cve.select("cve_id", F.explode(f"{references}.url").alias("url"))
    # Every match holds this text, and a plain search is cheaper than the pattern.
    links = urls.where(F.contains("url", F.lit("/commit"))).select(
        "cve_id", F.regexp_extract("url", COMMIT_LINK, 1).alias("link")
    )
    # Scheme, host, owner and project are the first five parts of an address.
    repo = F.replace(F.substring_index("link", "/", 5), F.lit("http:"), F.lit("https:"))
    return (
        links.where("link <> ''")
        .select("cve_id", F.substring_index("link", "/", -1).alias("hash"), repo.alias("repo_url"))
        .distinct()
    )


def classify(cve: DataFrame, problem_types: str = "problemtype_json") -> DataFrame:
    """L2: distinct (cve_id, cwe_id); an entry without weakness counts as unknown."""
    entries = cve.select("cve_id", F.explode_outer(problem_types).alias("entry"))
    values = entries.select("cve_id", F.explode_outer("entry.description").alias("weakness"))
    named = F.coalesce("weakness.value", F.lit("unknown"))
    return values.select("cve_id", F.replace(named, F.lit("unknown"), F.lit(NO_INFO)).alias("cwe_id")).distinct()


def build_weakness_dim(nodes: DataFrame) -> DataFrame:
    """L3: the weakness table from catalogue nodes (id, name, description, extended_description, is_category)."""
    catalogue = nodes.select(
        F.concat(F.lit("CWE-"), F.col("id").cast("string")).alias("cwe_id"),
        F.col("name").alias("cwe_name"),
        "description",
        "extended_description",
        F.when(
            F.col("id") > 0,
            F.concat(F.lit("https://cwe.mitre.org/data/definitions/"), F.col("id").cast("string"), F.lit(".html")),
        ).alias("url"),
        "is_category",
        F.col("is_category").cast("int").alias("_rank"),
    )
    columns = ["cwe_id", "cwe_name", "description", "extended_description", "url", "is_category"]
    extra = nodes.sparkSession.createDataFrame(list(EXTRA_WEAKNESSES), columns).withColumn("_rank", F.lit(2))
    return distinct_on(catalogue.unionByName(extra), ["cwe_id"], ["_rank", "cwe_name"]).select(*columns)


def missing_references(link: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """L4: keys used by ``link`` that ``dim`` does not know."""
    return link.select(key).distinct().join(dim.select(key).distinct(), key, "left_anti")


def unavailable_urls(probe_log: DataFrame) -> DataFrame:
    """Addresses whose latest answer is an error or a redirect to the login page.

    Answers that only ask to slow down say nothing and are passed over.
    """
    latest = (
        probe_log.where(F.col("status") != TOO_MANY_REQUESTS)
        .groupBy("url")
        .agg(F.max(F.struct("probed_at", "status", "location")).alias("last"))
    )
    gone = F.col("last.status").isin(*REDIRECTS) & (F.col("last.location") == LOGIN_PAGE)
    return latest.where((F.col("last.status") >= 400) | F.coalesce(gone, F.lit(False))).select("url")


def drop_unavailable(fixes: DataFrame, probe_log: DataFrame) -> DataFrame:
    """Fixes without those of unavailable repositories."""
    gone = unavailable_urls(probe_log).withColumnRenamed("url", "repo_url")
    return fixes.join(gone, "repo_url", "left_anti").select(*fixes.columns)


def sample_fixes(fixes: DataFrame, limit: int, excluded: Sequence[str] = LARGE_PROJECTS) -> DataFrame:
    """The first ``limit`` fixes outside the excluded projects."""
    return fixes.where(~F.col("repo_url").isin(*excluded)).orderBy("cve_id", "repo_url", "hash").limit(limit)


def pending_fixes(fixes: DataFrame, commits: DataFrame) -> DataFrame:
    """Fixes whose commit is not loaded yet."""
    return fixes.join(commits.select("hash").distinct(), "hash", "left_anti").select(*fixes.columns)


def pending_rows(rows: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """L7 for wide rows: those whose ``key`` is not among the loaded ones, decided in the row, without moving it.

    Keys meet keys first. What of them is loaded then goes to all tasks as a cascade of bit filters that is exact on the
    keys of ``rows``. Where more keys are loaded than the filters may hold, rows are shuffled.
    """
    keys = rows.select(key).where(F.col(key).isNotNull()).distinct()
    known = keys.join(loaded.select(key).distinct(), key, "left_semi")
    cascade = key_cascade(known, keys.join(known, key, "left_anti"), key)
    if cascade is None:
        return rows.join(loaded.select(key).distinct(), key, "left_anti").select(*rows.columns)
    return rows.where(~cascade(F.col(key)))


def work_units(fixes: DataFrame, batch: int = 500) -> DataFrame:
    """Per repository the distinct hashes to load, in sorted lists.

    ``hash_count`` is that of the repository; ``single_hash`` is set where it is 1.
    A repository with many hashes is cut by hash value into units of about
    ``batch``, so that no list grows with the largest repository.
    """
    hashes = fixes.select("repo_url", "hash").distinct()
    sizes = hashes.groupBy("repo_url").agg(F.count("*").alias("hash_count"))
    spread = F.conv(F.substring(F.md5("hash"), 1, 8), 16, 10).cast("bigint")
    return (
        hashes.join(sizes, "repo_url")
        .withColumn("unit", F.pmod(spread, F.ceil(F.col("hash_count") / batch)))
        .groupBy("repo_url", "unit", "hash_count")
        .agg(F.array_sort(F.collect_list("hash")).alias("hashes"))
        .select(
            "repo_url",
            with_git_suffix(F.col("repo_url")).alias("clone_url"),
            "unit",
            "hash_count",
            (F.col("hash_count") == 1).alias("single_hash"),
            "hashes",
        )
    )


def resolve_short_hashes(fixes: DataFrame, commits: DataFrame, strict: bool = False) -> DataFrame:
    """Replace a hash that no commit has by that of a commit of the same repository.

    A candidate is a commit no fix names, with the same first four characters;
    of several the least is taken. ``strict`` also asks that the candidate starts
    with the whole short hash. Resolved hashes never change.
    """
    lead = F.substring(F.trim("hash"), 1, 4)
    candidates = (
        commits.select("repo_url", "hash").distinct()
        .join(fixes.select("hash").distinct(), "hash", "left_anti")
        .select("repo_url", lead.alias("_lead"), F.col("hash").alias("_full"))
    )
    # One row per hash: whether a commit has it. Hot hashes are folded before the join.
    open_hashes = (
        fixes.select("repo_url", "hash").distinct()
        .join(commits.select("hash").distinct(), "hash", "left_anti")
        .withColumn("_lead", lead)
    )
    if strict:
        chosen = _nearest_candidate(open_hashes, candidates)
    else:
        least = candidates.groupBy("repo_url", "_lead").agg(F.min("_full").alias("_full"))
        chosen = open_hashes.join(least, ["repo_url", "_lead"]).select("repo_url", "hash", "_full")
    return (
        fixes.join(chosen, ["repo_url", "hash"], "left")
        .withColumn("hash", F.coalesce("_full", "hash"))
        .select(*fixes.columns)
    )


def _nearest_candidate(open_hashes: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per short hash the least candidate that starts with it.

    If any candidate starts with the short hash, the least one not below it does.
    One sort finds it, where a join would pair all hashes with the same lead.
    """
    both = candidates.select("repo_url", "_lead", F.col("_full").alias("_text"), "_full").unionByName(
        open_hashes.select("repo_url", "_lead", F.trim("hash").alias("_text"), "hash"), allowMissingColumns=True
    )
    above = (
        Window.partitionBy("repo_url", "_lead")
        .orderBy(F.desc("_text"), F.desc_nulls_last("_full"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        both.withColumn("_full", F.last("_full", ignorenulls=True).over(above))
        .where(F.col("hash").isNotNull() & F.startswith("_full", F.col("_text")))
        .select("repo_url", "hash", "_full")
    )


def attach_repo_meta(repos: DataFrame, meta: DataFrame) -> DataFrame:
    """Fetched metadata of each GitHub repository; NULL where none was fetched."""
    hosted = repos.select("repo_url").distinct().where(F.contains("repo_url", F.lit("github.")))
    return hosted.join(meta, "repo_url", "left")
