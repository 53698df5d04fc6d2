"""Paths, file URLs, local names and content identities as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Relevance of a document path by its stem, name and folders.
STRONG_STEMS = (
    "code-style", "code_style", "coding-style", "coding_style", "contributing",
    "contributing-guidelines", "contributing_guidelines", "development", "developer-guide",
    "developer_guide", "developing", "guidelines", "hacking", "style-guide", "style_guide", "styleguide",
)
STEM_KEYWORDS = ("coding", "contribut", "develop", "guideline", "style")
DEVELOPER_FOLDERS = ("contributing", "development", "developer")
DOCUMENT_EXTENSIONS = ("", ".adoc", ".md", ".rst", ".txt")
EXCLUDED_SEGMENTS = (
    ".git", "fixtures", "generated", "node_modules", "snapshots", "testdata", "third_party", "vendor",
)
EXCLUDED_NAMES = (
    "agents.md", "changelog.md", "claude.md", "code_of_conduct.md", "copilot-instructions.md",
    "release.md", "security.md",
)
MAX_DOCUMENT_BYTES = 200_000
STRONG_SCORE, KEYWORD_SCORE, README_SCORE, ROOT_BONUS, FOLDER_BONUS = 350, 250, 100, 50, 20


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def basename(path: Column | str) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


# Base name as (stem, suffix); dots that lead a name do not start a suffix.
_STEM_AND_SUFFIX = r"(?:^|/)(\.*[^./][^/]*?|\.*)(\.[^./]*)?\z"


def suffix(path: Column | str) -> Column:
    """File extension with its dot; a name that only starts with a dot has none."""
    return F.regexp_extract(_c(path), _STEM_AND_SUFFIX, 2)


def stem(path: Column | str) -> Column:
    """Base name without its suffix."""
    return F.regexp_extract(_c(path), _STEM_AND_SUFFIX, 1)


def is_markdown(path: Column | str) -> Column:
    return F.lower(suffix(path)) == ".md"


def is_regular(mode: Column | str) -> Column:
    """Not a symbolic link."""
    return _c(mode) != "120000"


def lower_parts(path: Column | str) -> Column:
    return F.split(F.lower(_c(path)), "/")


def relevance(path: Column | str) -> Column:
    """Path relevance score; zero means the file is not a candidate document."""
    low_stem = F.lower(stem(path))
    low_name = F.lower(basename(path))
    keyword = F.lit(False)
    for word in STEM_KEYWORDS:
        keyword = keyword | low_stem.contains(word)
    base = (
        F.when(low_stem.isin(*STRONG_STEMS), STRONG_SCORE)
        .when(low_name.startswith("readme"), README_SCORE)
        .when(keyword, KEYWORD_SCORE)
        .otherwise(0)
    )
    parts = lower_parts(path)
    bonus = F.when(F.size(parts) == 1, ROOT_BONUS).otherwise(0) + F.when(
        F.arrays_overlap(parts, F.array(*map(F.lit, DEVELOPER_FOLDERS))), FOLDER_BONUS
    ).otherwise(0)
    return F.when(base == 0, F.lit(0)).otherwise(base + bonus)


def is_candidate_document(path: Column | str, size: Column | str, max_bytes: int = MAX_DOCUMENT_BYTES) -> Column:
    """Size, folder, extension and name rules for candidate documents."""
    return (
        (_c(size) <= max_bytes)
        & ~F.arrays_overlap(lower_parts(path), F.array(*map(F.lit, EXCLUDED_SEGMENTS)))
        & F.lower(suffix(path)).isin(*DOCUMENT_EXTENSIONS)
        & ~F.lower(basename(path)).isin(*EXCLUDED_NAMES)
        & (relevance(path) > 0)
    )


def content_sha256(text: Column | str) -> Column:
    return F.sha2(_c(text), 256)


def content_identity(sha256: Column | str, blob_sha: Column | str) -> Column:
    """``sha256:…``, else ``git_blob:…``, else null."""
    return F.coalesce(
        F.concat(F.lit("sha256:"), F.nullif(_c(sha256), F.lit(""))),
        F.concat(F.lit("git_blob:"), F.nullif(_c(blob_sha), F.lit(""))),
    )


def stable_id(*parts: Column | str) -> Column:
    """Request id: hash of the immutable key tuple written as a compact JSON array."""
    return F.concat(F.lit("candidate-"), F.sha2(F.to_json(F.array(*map(_c, parts))), 256))


def percent_encode(path: Column | str) -> Column:
    """Percent-encode everything but unreserved characters and ``/``."""
    value = F.url_encode(_c(path))
    for found, wanted in (("*", "%2A"), ("+", "%20"), ("%2F", "/"), ("%7E", "~")):
        value = F.replace(value, F.lit(found), F.lit(wanted))
    return value


def file_url(repository: Column | str, revision: Column | str, path: Column | str) -> Column:
    """Revision-pinned URL of a file."""
    return F.concat(
        F.lit("https://github.com/"), _c(repository), F.lit("/blob/"), _c(revision), F.lit("/"), percent_encode(path)
    )


def url_revision(url: Column | str, repository: Column | str, host: str = "github.com") -> Column:
    """Revision in a pinned file URL, or null when the URL does not identify ``repository``."""
    value = _c(url)
    parts = F.filter(F.split(F.coalesce(F.try_parse_url(value, F.lit("PATH")), F.lit("")), "/"), lambda p: p != "")
    valid = (
        (F.try_parse_url(value, F.lit("PROTOCOL")) == "https")
        & (F.lower(F.try_parse_url(value, F.lit("AUTHORITY"))) == host)
        & (F.size(parts) >= 5)
        & (F.get(parts, F.lit(2)) == "blob")
        & (F.lower(F.concat_ws("/", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))) == F.lower(_c(repository)))
    )
    return F.when(valid, F.get(parts, F.lit(3)))


def local_filename(repository: Column | str, path: Column | str, per_character: bool = False) -> Column:
    """Flatten repository and path into ``owner--name/folder__file``, unsafe characters as ``_``.

    ``per_character`` keeps any letter or digit and replaces one for one; otherwise a run of
    characters outside ASCII letters, digits and ``._-`` becomes one underscore.
    """
    unsafe = r"[^\p{L}\p{N}._-]" if per_character else r"[^A-Za-z0-9._-]+"
    folder = F.regexp_replace(F.replace(_c(repository), F.lit("/"), F.lit("--")), unsafe, "_")
    name = F.regexp_replace(F.replace(_c(path), F.lit("/"), F.lit("__")), unsafe, "_")
    return F.concat(folder, F.lit("/"), name)


def is_safe_path(path: Column | str) -> Column:
    """Relative and free of empty, ``.`` and ``..`` parts."""
    return (_c(path) != "") & ~F.exists(F.split(_c(path), "/"), lambda part: part.isin("", ".", ".."))


def normalized_path(path: Column | str) -> Column:
    """Resolve ``.`` and ``..``; null when the path is absolute or leaves its root."""
    empty = F.array().cast("array<string>")
    folded = F.aggregate(
        F.split(_c(path), "/"),
        empty,
        lambda kept, part: F.when(kept.isNull(), kept)
        .when(part.isin("", "."), kept)
        .when((part == "..") & (F.size(kept) == 0), F.lit(None).cast("array<string>"))
        .when(part == "..", F.slice(kept, F.lit(1), F.size(kept) - 1))
        .otherwise(F.concat(kept, F.array(part))),
    )
    return F.when(~_c(path).startswith("/"), F.array_join(folded, "/"))


def owner(repository: Column | str) -> Column:
    return F.lower(F.substring_index(_c(repository), "/", 1))


def project(repository: Column | str) -> Column:
    """Everything after the first slash, lower-cased."""
    value = _c(repository)
    at = F.locate("/", value)
    return F.when(at == 0, F.lit("")).otherwise(F.lower(F.substring(value, at + 1, F.length(value))))
