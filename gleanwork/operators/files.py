"""Two-stage file screening, evidence coverage and per-repository audit counts.

``entries``: ``repository, revision, path, sha, size, mode``; ``contents``: one ``content`` per
``sha``. The name filter runs on the narrow entries; only blobs it keeps are read and matched,
each blob once however many files share it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions import paths, terms
from gleanwork.functions.terms import Term
from gleanwork.functions.text import strip
from gleanwork.operators.skew import attach
from gleanwork.session import materialize

FILE_KEY = ["name", "lastCommitSHA", "markdown_path"]
REPOSITORY_KEY = ["name", "lastCommitSHA"]


def markdown_entries(entries: DataFrame) -> DataFrame:
    """Regular Markdown files; symbolic links are dropped."""
    return entries.where(paths.is_regular("mode") & paths.is_markdown("path"))


def named_entries(entries: DataFrame, filename_terms: Sequence[Term] = terms.FILENAME_TERMS) -> DataFrame:
    """Markdown entries whose base name carries at least one term."""
    base = paths.basename("path")
    return (
        markdown_entries(entries)
        .where(terms.any_term(base, filename_terms))
        .withColumn("matched_filename_terms", terms.matched_terms(base, filename_terms))
    )


def screen_files(
    entries: DataFrame,
    contents: DataFrame,
    filename_terms: Sequence[Term] = terms.FILENAME_TERMS,
    content_terms: Sequence[Term] = terms.CONTENT_TERMS,
) -> DataFrame:
    """Name matches annotated with body terms (possibly none), hash and pinned URL.

    Bodies are hashed and matched where they are read; only hashes and terms reach the join.
    """
    named = named_entries(entries, filename_terms)
    matched = contents.select(
        "sha",
        paths.content_sha256("content").alias("content_sha256"),
        terms.matched_terms("content", content_terms).alias("matched_content_terms"),
    )
    return attach(named, matched, ["sha"], how="inner").select(
        F.col("repository").alias("name"),
        F.col("revision").alias("lastCommitSHA"),
        F.col("path").alias("markdown_path"),
        F.col("sha").alias("blob_sha"),
        "content_sha256",
        F.col("size").alias("size_bytes"),
        paths.file_url("repository", "revision", "path").alias("markdown_url"),
        "matched_filename_terms",
        "matched_content_terms",
    )


def candidate_files(screened: DataFrame, evidence: DataFrame) -> DataFrame:
    """Files passing both stages, flagged when they are known evidence."""
    passing = screened.where(F.size("matched_content_terms") > 0)
    known = evidence.select(*FILE_KEY).distinct().withColumn("__known", F.lit(True))
    return (
        passing.join(known, FILE_KEY, "left")
        .withColumn("agent_evidence", F.col("__known").isNotNull())
        .drop("__known")
    )


def merged_evidence(*sources: DataFrame) -> DataFrame:
    """Evidence paths of all sources, trimmed and without repeats, one row per path."""
    parts = [
        source.select(
            strip("name").alias("name"),
            strip("lastCommitSHA").alias("lastCommitSHA"),
            strip("guideline_path").alias("markdown_path"),
        )
        for source in sources
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.distinct()


def evidence_coverage(evidence: DataFrame, screened: DataFrame, repositories: DataFrame) -> DataFrame:
    """Whether each evidence path passes each stage; null when its repository was not evaluated."""
    matches = screened.select(
        *FILE_KEY, "matched_filename_terms", "matched_content_terms", F.lit(True).alias("__match")
    )
    states = repositories.select(*REPOSITORY_KEY, (F.col("status") == "completed").alias("__done"))
    # Stored: attach reads it for the heavy keys and for the join.
    known = materialize(evidence.select(*FILE_KEY).distinct().join(matches, FILE_KEY, "left"))
    joined = attach(known, states, REPOSITORY_KEY)
    found = F.col("__match").isNotNull()
    nothing = F.array().cast("array<string>")
    return joined.where(F.col("__done").isNotNull()).select(
        *FILE_KEY,
        paths.is_markdown("markdown_path").alias("is_markdown"),
        F.when(F.col("__done"), found).alias("filename_match"),
        F.when(F.col("__done") & found, F.col("matched_filename_terms")).otherwise(nothing).alias(
            "matched_filename_terms"
        ),
        F.when(F.col("__done") & found, F.size("matched_content_terms") > 0).alias("content_match"),
        F.when(F.col("__done") & found, F.col("matched_content_terms")).otherwise(nothing).alias(
            "matched_content_terms"
        ),
    )


def repository_audit(repositories: DataFrame, screened: DataFrame, coverage: DataFrame) -> DataFrame:
    """Six counts per repository; repositories without files or evidence show zeros."""
    completed = repositories.where(F.col("status") == "completed").select(*REPOSITORY_KEY)
    files = (
        screened.groupBy(*REPOSITORY_KEY)
        .agg(
            F.count("*").alias("markdown_filename_file_count"),
            F.count_if(F.size("matched_content_terms") > 0).alias("markdown_filename_and_content_file_count"),
        )
        .join(completed, REPOSITORY_KEY, "left_semi")
    )
    evidence = coverage.groupBy(*REPOSITORY_KEY).agg(
        F.count("*").alias("agent_evidence_file_count"),
        F.count_if("is_markdown").alias("agent_evidence_markdown_file_count"),
        F.count_if(F.coalesce("filename_match", F.lit(False))).alias("agent_evidence_filename_match_count"),
        F.count_if(F.coalesce("content_match", F.lit(False))).alias(
            "agent_evidence_filename_and_content_match_count"
        ),
        F.count_if(F.col("filename_match").isNull()).alias("agent_evidence_not_evaluated_count"),
    )
    counts = [c for part in (files, evidence) for c in part.columns if c not in REPOSITORY_KEY]
    return (
        repositories.select(*REPOSITORY_KEY, "status", "error")
        .join(files, REPOSITORY_KEY, "left")
        .join(evidence, REPOSITORY_KEY, "left")
        .fillna(0, counts)
    )


def skipped_repositories(repositories: DataFrame) -> DataFrame:
    """Repositories left out before screening, with the reason."""
    return repositories.where(F.col("status").isin("explicitly_excluded", "snapshot_incomplete")).select(
        F.col("name").alias("repository"),
        F.col("lastCommitSHA").alias("snapshot_sha"),
        "status",
        F.col("error").alias("reason"),
    )


def keyword_files(
    entries: DataFrame, contents: DataFrame, keywords: Sequence[Term] = terms.KEYWORD_TERMS
) -> DataFrame:
    """Single-stage body scan: Markdown files with at least one keyword, whatever their name.

    Bodies are matched where they are read; only terms of matching ones reach the join.
    """
    files = markdown_entries(entries)
    matched = contents.select("sha", terms.matched_terms("content", keywords).alias("matched_keywords")).where(
        F.size("matched_keywords") > 0
    )
    return attach(files, matched, ["sha"], how="inner").select(
        F.col("repository").alias("name"),
        F.col("revision").alias("lastCommitSHA"),
        F.col("path").alias("markdown_path"),
        paths.file_url("repository", "revision", "path").alias("markdown_url"),
        "matched_keywords",
    )


def with_sizes(candidates: DataFrame, entries: DataFrame) -> DataFrame:
    """Attach each candidate's size from the file tree; an absent file leaves ``size_bytes`` null."""
    sizes = entries.select(
        F.col("repository").alias("name"),
        F.col("revision").alias("lastCommitSHA"),
        F.col("path").alias("markdown_path"),
        F.col("size").alias("size_bytes"),
    )
    return candidates.join(sizes, FILE_KEY, "left")


def candidate_contents(candidates: DataFrame, contents: DataFrame, max_input_bytes: int = 200_000) -> DataFrame:
    """Attach bodies to candidates; oversize or absent bodies become error rows without content.

    Candidates known to be oversize never reach the content join.
    """
    large = F.col("size_bytes") > max_input_bytes

    def too_large(size: Column) -> Column:
        return F.concat(
            F.lit("input_too_large: size_bytes="), size.cast("string"), F.lit(f" max_input_bytes={max_input_bytes}")
        )

    nothing = F.lit(None).cast("string")
    oversize = candidates.where(large).select(
        "*",
        nothing.alias("content"),
        F.lit("input_too_large").alias("error_status"),
        too_large(F.col("size_bytes")).alias("error"),
    )
    bodies = contents.select(F.col("sha").alias("blob_sha"), F.col("content").alias("__content"))
    joined = attach(candidates.where(~F.coalesce(large, F.lit(False))), bodies, ["blob_sha"], salts=64)
    actual = F.octet_length("__content")
    fits = actual <= max_input_bytes
    fetched = joined.select(
        *candidates.columns,
        F.when(fits, F.col("__content")).alias("content"),
        F.when(actual.isNull(), "retrieval_error").when(~fits, "input_too_large").alias("error_status"),
        F.when(actual.isNull(), F.concat(F.lit("cached blob is absent: "), "blob_sha"))
        .when(~fits, too_large(actual))
        .alias("error"),
    )
    return fetched.unionByName(oversize)
