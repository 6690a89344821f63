"""Repository addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_segment(url: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(url, "/", -1)


def owner_of(url: Column) -> Column:
    """Second-last path part; NULL without a slash."""
    return F.when(F.contains(url, F.lit("/")), F.substring_index(F.substring_index(url, "/", -2), "/", 1))


def canonical_repo(url: Column, first_mark: bool = False) -> Column:
    """Address without ``.git`` at the end; ``first_mark`` cuts at the first ``.git`` instead (Q4)."""
    if first_mark:
        return F.substring_index(url, ".git", 1)
    return F.regexp_replace(url, r"\.git$", "")


def with_git_suffix(url: Column) -> Column:
    """Clone address, which ends in ``.git`` for GitHub hosts."""
    return F.when(F.contains(url, F.lit("github")), F.concat(url, F.lit(".git"))).otherwise(url)


def commit_url(repo: Column, commit: Column) -> Column:
    """Web address of a commit."""
    middle = F.when(F.contains(repo, F.lit("gitlab.")), F.lit("/-/commit/")).otherwise(F.lit("/commit/"))
    return F.concat(repo, middle, commit)
