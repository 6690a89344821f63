"""From feeds, catalogue and repository snapshots to the eight tables.

Run it as a job: ``python -m fixtrail.plans.dataset --help``.
A custom list of advisories is the same job with another feed path.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators import changes, integrity, linking
from ..operators.shaping import align_schema
from ..schemas import PROBE_LOG, REPOSITORY, SNAPSHOT, TABLES
from ..session import build_session, drop_scratch, materialise
from ..sources import feed, tables, weaknesses


def collect(items: DataFrame, catalog: DataFrame, snapshots: DataFrame, probe_log: DataFrame | None = None,
            repo_meta: DataFrame | None = None, sample_limit: int | None = None,
            language_model: DataFrame | None = None, loaded: DataFrame | None = None,
            years: tuple[int | None, int | None] | None = None, sample_year: bool = False) -> dict[str, DataFrame]:
    """The eight tables before pruning.

    ``items`` are feed items, ``catalog`` catalogue nodes, ``snapshots`` commits
    with their files; ``loaded`` are commits of an earlier run, which are skipped.
    ``years`` are the first and last year of advisories, ``sample_year`` keeps those of this year; without both every
    advisory stays, also one without a date.
    """
    cve = feed.advisories(items)
    first, last = years or (None, None)
    if first is not None or last is not None or sample_year:
        cve = feed.year_window(cve, first=first, last=last, sample=sample_year)
    fixes = linking.extract_fix_links(cve)
    if probe_log is not None:
        fixes = linking.drop_unavailable(fixes, probe_log)
    if sample_limit:
        fixes = linking.sample_fixes(fixes, sample_limit)
    if loaded is not None:
        snapshots = linking.pending_rows(snapshots, loaded, "hash")

    files = changes.changed_files(snapshots)
    # Labelled where the text is read; a join would move whole sources.
    language = changes.language_of(language_model) if language_model is not None else None
    file_change = changes.file_rows(snapshots, language)
    # Maintainability compares whole files, so it also needs the methods a change left alone; their numbers will do.
    dmm = changes.nested_maintainability(files)
    repos = linking.attach_repo_meta(fixes, repo_meta) if repo_meta is not None else fixes.select("repo_url").limit(0)
    return {
        "cve": cve,
        "fixes": fixes,
        "commits": changes.commit_rows(snapshots, dmm),
        "file_change": file_change,
        "method_change": changes.method_rows(files),
        "cwe": linking.build_weakness_dim(catalog),
        "cwe_classification": linking.classify(cve),
        "repository": align_schema(repos, REPOSITORY, missing=None),
    }


# Keys by which rows of a new run replace those of an earlier one.
NARROW_KEYS = {
    "cve": ["cve_id"], "fixes": ["cve_id", "hash", "repo_url"], "cwe": ["cwe_id"],
    "cwe_classification": ["cve_id", "cwe_id"], "repository": ["repo_url"],
}


def extend(old: dict[str, DataFrame], new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What a new run writes: the narrow tables of an earlier run merged with its own by key.

    Commits, files and methods of the new run are of commits that were not loaded, so the earlier ones stay where they are.
    """
    merged = dict(new)
    for name, keys in NARROW_KEYS.items():
        before = old[name].join(new[name].select(*keys).distinct(), keys, "left_anti").select(*old[name].columns)
        merged[name] = new[name].unionByName(before)
    return merged


def build_dataset(root: str, previous: str | None = None, **sources) -> dict[str, DataFrame]:
    """Collect, prune and write the eight tables below the new folder ``root``; returns them as read back.

    With ``previous``, the folder of an earlier run, its commits are not collected again. Its commits, files and methods are not
    written again either: the manifest of ``root`` names their folders beside the new ones, so a run costs what it adds;
    the narrow tables are merged and written whole. The folder of the earlier run must stay, or be copied together with the
    new one by :func:`compact`. The tables are written beside ``root`` and checked there; a broken key or count rule raises
    ``ValueError``, and ``root`` comes into being only when all is well, at once.
    """
    spark = sources["items"].sparkSession
    if tables.table_exists(spark, f"{root}/cve"):
        raise FileExistsError(root)
    # The catalogue check comes before the costly part.
    integrity.verify_catalog(linking.build_weakness_dim(sources["catalog"]))
    # Advisories and snapshots feed several tables each; they are parsed once, later reads take the columns they need.
    sources["items"] = materialise(sources["items"])
    sources["snapshots"] = materialise(sources["snapshots"])
    print("Dates that could not be read, by column:")
    feed.malformed_dates(sources["items"]).show()
    earlier: dict[str, list[str]] = {}
    if previous:
        old = tables.load_tables(spark, previous)
        earlier = {name: folders for name, folders in tables.live_folders(spark, previous).items()
                   if name not in NARROW_KEYS}
        merged = extend(old, collect(**sources, loaded=old["commits"]))
        pruned = integrity.prune(merged, materialise_links=True, stored=old["commits"])
        pruned["fixes"] = pruned["fixes"].distinct()
    else:
        pruned = integrity.prune(collect(**sources), materialise_links=True)
    staged = f"{root.rstrip('/')}-staged-{uuid.uuid4().hex}"
    tables.write_tables({name: pruned[name] for name in TABLES}, staged)
    if earlier:
        tables.write_manifest(spark, staged, earlier)
    integrity.verify(tables.load_tables(spark, staged))
    tables.publish(spark, staged, root)
    return tables.load_tables(spark, root)


def compact(spark: SparkSession, root: str, target: str) -> dict[str, DataFrame]:
    """Write all tables of ``root``, those of earlier runs among them, below the new folder ``target``."""
    if tables.table_exists(spark, f"{target}/cve"):
        raise FileExistsError(target)
    staged = f"{target.rstrip('/')}-staged-{uuid.uuid4().hex}"
    tables.write_tables(tables.load_tables(spark, root), staged)
    tables.publish(spark, staged, target)
    return tables.load_tables(spark, target)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build the eight tables.")
    parser.add_argument("--feed", nargs="+", required=True, help="advisory feed files, or any JSON file of that form")
    parser.add_argument("--feed-lines", action="store_true", help="the feed is JSON lines")
    parser.add_argument("--catalog", required=True, help="weakness catalogue, XML")
    parser.add_argument("--snapshots", required=True, help="commits with their files, JSON lines")
    parser.add_argument("--probe-log", help="answers of repository hosts, JSON lines")
    parser.add_argument("--repo-meta", help="repository metadata, JSON lines")
    parser.add_argument("--language-samples", help="labelled texts (text, lang) for language labels, JSON lines")
    parser.add_argument("--languages", nargs="+", default=[], help="the labels to tell apart")
    parser.add_argument("--sample-limit", type=int, help="number of fixes of a sample")
    parser.add_argument("--first-year", type=int, help="advisories from this year on, else of all years")
    parser.add_argument("--last-year", type=int, help="advisories up to this year; with --first-year alone, up to now")
    parser.add_argument("--sample-year", action="store_true", help="advisories of this year only")
    parser.add_argument("--previous", help="folder of an earlier run to extend; the new one refers to its files")
    parser.add_argument("--output", required=True, help="new folder for the tables")
    given = parser.parse_args(arguments)

    spark = build_session("fixtrail-dataset")
    read = spark.read
    model = None
    if given.language_samples:
        samples = read.schema("text string, lang string").json(given.language_samples)
        model = changes.train_language(samples, given.languages)
    written = build_dataset(
        given.output,
        previous=given.previous,
        items=feed.read_advisory_feed(spark, given.feed, lines=given.feed_lines),
        catalog=weaknesses.read_weakness_catalog(spark, given.catalog),
        snapshots=read.schema(SNAPSHOT).json(given.snapshots),
        probe_log=read.schema(PROBE_LOG).json(given.probe_log) if given.probe_log else None,
        repo_meta=read.schema(REPOSITORY).json(given.repo_meta) if given.repo_meta else None,
        sample_limit=given.sample_limit,
        language_model=model,
        years=(given.first_year, given.last_year),
        sample_year=given.sample_year,
    )
    integrity.table_counts(written).show()
    drop_scratch(spark)


if __name__ == "__main__":
    main()
