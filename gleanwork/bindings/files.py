"""Sources, text predicates, paths, screening, deduplication and evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanwork.bindings.registry import query
from gleanwork.bindings.tables import CANDIDATES_SQL, FILES_SQL, PROSE_TERMS, Tables, terms_sql, word_sql
from gleanwork.functions import labels, paths, terms
from gleanwork.operators import dedup, evidence, files, gates, ordering
from gleanwork.session import materialize
from gleanwork.sources import readers, sinks

# ---------------------------------------------------------------- scans


@query(
    "s1_population_index",
    """SELECT p_partkey, p_brand, row_number() OVER (ORDER BY p_brand, p_partkey) - 1 AS input_index FROM part""",
)
def s1(t: Tables):
    return readers.index_population(t.part.select("p_partkey", "p_brand"), ["p_brand", "p_partkey"])


@query("s2_required_columns", "SELECT c_custkey, c_name FROM customer")
def s2(t: Tables):
    return readers.require_columns(t.customer, ["c_custkey", "c_name"]).select("c_custkey", "c_name")


@query(
    "s3_exclusion_union",
    """SELECT DISTINCT name FROM (SELECT trim(n_name) AS name FROM nation UNION ALL SELECT trim(r_name) FROM region
       UNION ALL SELECT source FROM documents) WHERE name <> ''""",
)
def s3(t: Tables):
    return readers.exclusion_names(
        t.nation.select(F.col("n_name").alias("name")),
        t.region.select(F.concat(F.lit(" "), "r_name", F.lit(" ")).alias("repository")),
        t.documents.select(F.col("source").alias("repository")),
    )


@query(
    "s4_merged_evidence",
    f"""WITH {FILES_SQL} SELECT DISTINCT repository AS name, revision AS lastCommitSHA, path AS markdown_path
       FROM files JOIN labels USING (doc_id)""",
)
def s4(t: Tables):
    rows = t.files.join(t.labels, "doc_id").select(
        F.col("repository").alias("name"), F.col("revision").alias("lastCommitSHA"), F.col("path").alias("guideline_path")
    )
    return files.merged_evidence(rows, rows)


@query(
    "s6_blob_entries",
    f"WITH {FILES_SQL} SELECT repository, revision, path, sha, size FROM files WHERE mode <> '120000'",
)
def s6(t: Tables):
    return readers.blob_entries(t.files).select("repository", "revision", "path", "sha", "size")


@query(
    "s7_candidate_contents",
    f"""WITH {CANDIDATES_SQL}, bodies AS (SELECT DISTINCT sha, content FROM files WHERE lang <> 'es')
       SELECT name, markdown_path, CASE WHEN c.size_bytes > 3000 THEN 'input_too_large'
         WHEN b.sha IS NULL THEN 'retrieval_error' END AS error_status,
         CASE WHEN c.size_bytes > 3000 THEN 'input_too_large: size_bytes=' || c.size_bytes || ' max_input_bytes=3000'
         WHEN b.sha IS NULL THEN 'cached blob is absent: ' || c.blob_sha END AS error,
         CASE WHEN c.size_bytes <= 3000 THEN sha256(b.content) END AS body_sha
       FROM candidates c LEFT JOIN bodies b ON b.sha = c.blob_sha""",
)
def s7(t: Tables):
    known = t.files.where("lang <> 'es'").groupBy("sha").agg(F.any_value("content").alias("content"))
    out = files.candidate_contents(t.candidates, known, 3000)
    return out.select("name", "markdown_path", "error_status", "error", F.sha2("content", 256).alias("body_sha"))


@query(
    "s8_load_candidates",
    f"""WITH {CANDIDATES_SQL}, doubled AS (SELECT * FROM candidates UNION ALL
         SELECT name || ' ', lastCommitSHA, markdown_path, blob_sha, content_sha256, size_bytes, input_index + 1000000000 FROM candidates)
       SELECT trim(name) AS name, lastCommitSHA, markdown_path, min(blob_sha) AS blob_sha, min(input_index) AS input_index
       FROM doubled GROUP BY 1, 2, 3""",
)
def s8(t: Tables):
    again = t.candidates.withColumn("name", F.concat("name", F.lit(" "))).withColumn(
        "input_index", F.col("input_index") + 1_000_000_000
    )
    rows = readers.load_candidates(t.candidates.unionByName(again))
    return rows.select("name", "lastCommitSHA", "markdown_path", "blob_sha", "input_index")


@query("s13_license_allowlist", "SELECT DISTINCT trim(source) AS license_name FROM documents WHERE source <> ''")
def s13(t: Tables):
    from gleanwork.operators.quota import allowlist_names

    rows = t.documents.select(F.concat(F.lit(" "), "source").alias("license_name"))
    noise = t.region.select(F.when(F.col("r_regionkey") == 0, " Other ").otherwise("  ").alias("license_name"))
    return allowlist_names(rows.unionByName(noise))


# ---------------------------------------------------------------- predicates


@query("p5_markdown_files", f"WITH {FILES_SQL} SELECT repository, path FROM files WHERE mode <> '120000' AND lower(path) LIKE '%.md'")
def p5(t: Tables):
    return files.markdown_entries(t.files).select("repository", "path")


FILENAME_CASES = " , ".join(
    f"CASE WHEN contains(lower(b), '{t.stem}') THEN '{t.name}' END"
    if t.name != "guide"
    else "CASE WHEN regexp_matches(replace(lower(b), 'guideline', '#'), 'guide') THEN 'guide' END"
    for t in terms.FILENAME_TERMS
)


@query(
    "p6_filename_terms",
    f"""WITH {FILES_SQL}, based AS (SELECT repository, path, list_last(string_split(path, '/')) AS b FROM files)
       SELECT repository, path, concat_ws('|', {FILENAME_CASES}) AS matched FROM based""",
)
def p6(t: Tables):
    matched = terms.matched_terms(paths.basename("path"), terms.FILENAME_TERMS)
    return t.files.select("repository", "path", terms.join_terms(matched).alias("matched"))


@query("p7_content_terms", f"SELECT doc_id, {terms_sql('text')} AS matched FROM documents")
def p7(t: Tables):
    return t.documents.select("doc_id", terms.join_terms(terms.matched_terms("text", PROSE_TERMS)).alias("matched"))


@query(
    "p7_default_content_terms",
    "SELECT doc_id, concat_ws('|', "
    + ", ".join(
        f"CASE WHEN {word_sql('text', t.stem + t.tail)} THEN '{t.name}' END" for t in terms.CONTENT_TERMS
    )
    + ") AS matched FROM documents",
)
def p7_default(t: Tables):
    return t.documents.select("doc_id", terms.join_terms(terms.matched_terms("text", terms.CONTENT_TERMS)).alias("matched"))


@query(
    "p8_keyword_files",
    f"""WITH {FILES_SQL}, hit AS (SELECT *, {terms_sql('content')} AS matched FROM files
         WHERE mode <> '120000' AND lower(path) LIKE '%.md')
       SELECT repository AS name, path AS markdown_path, matched FROM hit WHERE matched <> ''""",
)
def p8(t: Tables):
    return files.keyword_files(t.entries, t.contents, PROSE_TERMS).select(
        "name", "markdown_path", terms.join_terms("matched_keywords").alias("matched")
    )


NAMED_SQL = f"""{FILES_SQL}, based AS (SELECT *, list_last(string_split(path, '/')) AS b FROM files
    WHERE mode <> '120000' AND lower(path) LIKE '%.md'),
  named AS (SELECT *, concat_ws('|', {FILENAME_CASES}) AS name_terms FROM based),
  screened AS (SELECT repository AS name, revision AS lastCommitSHA, path AS markdown_path, sha AS blob_sha,
    sha256(content) AS content_sha256, size AS size_bytes, name_terms, {terms_sql('content')} AS body_terms, doc_id
    FROM named WHERE name_terms <> '')"""


def screened(t: Tables):
    return files.screen_files(t.entries, t.contents, content_terms=PROSE_TERMS)


@query(
    "p9_two_stage_filter",
    f"""WITH {NAMED_SQL} SELECT name, lastCommitSHA, markdown_path, blob_sha, content_sha256, size_bytes,
       name_terms, body_terms FROM screened""",
)
def p9(t: Tables):
    return screened(t).select(
        "name", "lastCommitSHA", "markdown_path", "blob_sha", "content_sha256", "size_bytes",
        terms.join_terms("matched_filename_terms").alias("name_terms"),
        terms.join_terms("matched_content_terms").alias("body_terms"),
    )


SCORE_SQL = """CASE WHEN regexp_matches(lower(list_last(string_split(path, '/'))), '^coding-style\\.') THEN 350
      WHEN starts_with(lower(list_last(string_split(path, '/'))), 'readme') THEN 100
      WHEN regexp_matches(regexp_replace(lower(list_last(string_split(path, '/'))), '\\.[^.]*$', ''),
        'coding|contribut|develop|guideline|style') THEN 250 ELSE 0 END"""
RELEVANCE_SQL = f"""CASE WHEN {SCORE_SQL} = 0 THEN 0 ELSE {SCORE_SQL}
      + CASE WHEN contains(path, '/') THEN 0 ELSE 50 END
      + CASE WHEN list_has_any(string_split(lower(path), '/'), ['contributing','development','developer']) THEN 20 ELSE 0 END END"""


@query("p10_path_relevance", f"WITH {FILES_SQL} SELECT repository, path, {RELEVANCE_SQL} AS score FROM files")
def p10(t: Tables):
    return t.files.select("repository", "path", paths.relevance("path").alias("score"))


CANDIDATE_DOC_SQL = f"""size <= 200000 AND NOT list_has_any(string_split(lower(path), '/'), ['vendor','fixtures','.git'])
    AND regexp_matches(lower(path), '\\.(md|txt|rst|adoc)$') AND {RELEVANCE_SQL} > 0"""


@query("p11_candidate_documents", f"WITH {FILES_SQL} SELECT repository, path, size FROM files WHERE {CANDIDATE_DOC_SQL}")
def p11(t: Tables):
    return t.files.where(paths.is_candidate_document("path", "size")).select("repository", "path", "size")


@query("p12_size_guard", "SELECT doc_id, strlen(text) > 2000 AS too_large FROM documents")
def p12(t: Tables):
    return t.documents.select("doc_id", (F.octet_length("text") > 2000).alias("too_large"))


@query("p17_without_prior_labels", "SELECT doc_id, source FROM documents JOIN labels USING (doc_id)")
def p17(t: Tables):
    from gleanwork.operators.sampling import without_prior_labels

    rows = t.documents.join(t.labels, "doc_id").select(
        "doc_id", "source", F.col("quality").alias("guideline_status"), F.col("lang").alias("license_status")
    )
    return without_prior_labels(rows)


# ---------------------------------------------------------------- scalar functions


@query("f1_content_sha256", "SELECT doc_id, sha256(text) AS digest FROM documents")
def f1(t: Tables):
    return t.documents.select("doc_id", paths.content_sha256("text").alias("digest"))


@query(
    "f2_content_identity",
    """SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN 'sha256:' || sha256(text)
         WHEN doc_id % 2 = 0 THEN 'git_blob:' || substr(sha256(text), 1, 40) END AS identity FROM documents""",
)
def f2(t: Tables):
    sha = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.sha2("text", 256))
    blob = F.when(F.col("doc_id") % 2 == 0, F.substring(F.sha2("text", 256), 1, 40)).otherwise("")
    return t.documents.select("doc_id", paths.content_identity(sha, blob).alias("identity"))


@query(
    "f3_stable_id",
    f"""WITH {FILES_SQL} SELECT doc_id, 'candidate-' || sha256('["' || repository || '","' || revision || '","' || path
       || '","' || sha || '"]') AS custom_id FROM files""",
)
def f3(t: Tables):
    return t.files.select("doc_id", paths.stable_id("repository", "revision", "path", "sha").alias("custom_id"))


@query(
    "f4_file_url",
    f"""WITH {FILES_SQL} SELECT doc_id, 'https://github.com/' || repository || '/blob/' || revision || '/' ||
       replace(path, ' ', '%20') AS url FROM files""",
)
def f4(t: Tables):
    return t.files.select("doc_id", paths.file_url("repository", "revision", "path").alias("url"))


@query(
    "f5_url_revision",
    f"""WITH {FILES_SQL} SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN revision END AS pinned FROM files""",
)
def f5(t: Tables):
    url = paths.file_url("repository", "revision", "path")
    broken = F.when(F.col("doc_id") % 8 == 0, F.replace(url, F.lit("/blob/"), F.lit("/tree/"))).otherwise(
        F.replace(url, F.lit("https:"), F.lit("http:"))
    )
    value = F.when(F.col("doc_id") % 4 == 0, broken).otherwise(url)
    return t.files.select("doc_id", paths.url_revision(value, F.upper("repository")).alias("pinned"))


@query(
    "f6_local_filename",
    """SELECT page_id, regexp_replace('web--pages', '[^A-Za-z0-9._-]+', '_', 'g') || '/' ||
         regexp_replace(replace(url, '/', '__'), '[^A-Za-z0-9._-]+', '_', 'g') AS file,
         'web--pages/' || regexp_replace(replace(url, '/', '__'), '[^\\p{L}\\p{N}._-]', '_', 'g') AS exact_file FROM pages""",
)
def f6(t: Tables):
    return t.pages.select(
        "page_id",
        paths.local_filename(F.lit("web/pages"), "url").alias("file"),
        paths.local_filename(F.lit("web/pages"), "url", per_character=True).alias("exact_file"),
    )


@query(
    "f7_term_lists",
    f"""SELECT doc_id, len(list_filter(string_split({terms_sql('text')}, '|'), lambda x: x <> '')) AS n,
       {terms_sql('text')} AS joined FROM documents""",
)
def f7(t: Tables):
    text = t.documents.select("doc_id", terms.join_terms(terms.matched_terms("text", PROSE_TERMS)).alias("joined"))
    split = terms.split_terms("joined")
    return text.select("doc_id", F.size(split).cast("bigint").alias("n"), terms.join_terms(split).alias("joined"))


@query(
    "f8_excerpt",
    """SELECT doc_id, sha256(CASE WHEN length(text) <= 300 THEN text ELSE substr(text, 1, 174) || chr(10) ||
       '...[middle truncated by evaluator]...' || chr(10) || right(text, 87) END) AS digest FROM documents""",
)
def f8(t: Tables):
    return t.documents.select("doc_id", F.sha2(labels.excerpt("text", 300), 256).alias("digest"))


@query(
    "f11_quote_lines",
    """WITH q AS (SELECT doc_id, text, substr(text, 20, 60) AS quote FROM documents),
       p AS (SELECT *, instr(text, quote) AS pos FROM q),
       l AS (SELECT doc_id, quote, 1 + length(substr(text, 1, pos - 1)) - length(replace(substr(text, 1, pos - 1), chr(10), '')) AS first_line,
         length(quote) - length(replace(quote, chr(10), '')) AS more FROM p)
       SELECT doc_id, CASE WHEN quote = '' THEN 'L1' ELSE 'L' || first_line || CASE WHEN more > 0 THEN '-L' || (first_line + more) ELSE '' END END AS lines FROM l""",
)
def f11(t: Tables):
    quoted = t.documents.withColumn("quote", F.substring("text", 20, 60))
    return quoted.select("doc_id", labels.line_range("text", "quote").alias("lines"))


@query(
    "f17_owner_project",
    f"""WITH {FILES_SQL} SELECT doc_id, split_part(lower(repository), '/', 1) AS owner,
       split_part(lower(repository), '/', 2) AS project FROM files""",
)
def f17(t: Tables):
    return t.files.select("doc_id", paths.owner("repository").alias("owner"), paths.project("repository").alias("project"))


@query(
    "f22_safe_path",
    """WITH p AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN '/' || url WHEN 1 THEN '../' || page_id || '.md'
         WHEN 2 THEN 'docs/' || page_id || '.md' ELSE 'a/./' || page_id END AS path FROM pages)
       SELECT page_id, page_id % 4 = 2 AS safe FROM p""",
)
def f22(t: Tables):
    key = F.col("page_id") % 4
    path = (
        F.when(key == 0, F.concat(F.lit("/"), "url"))
        .when(key == 1, F.concat(F.lit("../"), "page_id", F.lit(".md")))
        .when(key == 2, F.concat(F.lit("docs/"), "page_id", F.lit(".md")))
        .otherwise(F.concat(F.lit("a/./"), "page_id"))
    )
    return t.pages.select("page_id", paths.is_safe_path(path).alias("safe"))


@query(
    "f25_normalized_path",
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'X' || page_id || '.md' WHEN 1 THEN NULL
         WHEN 2 THEN 'a/c' || page_id ELSE NULL END AS path FROM pages""",
)
def f25(t: Tables):
    key = F.col("page_id") % 4
    path = (
        F.when(key == 0, F.concat(F.lit("docs/../X"), "page_id", F.lit(".md")))
        .when(key == 1, F.concat(F.lit("a/../../"), "page_id"))
        .when(key == 2, F.concat(F.lit("./a/b/..//c"), "page_id"))
        .otherwise(F.concat(F.lit("/a"), "page_id"))
    )
    return t.pages.select("page_id", paths.normalized_path(path).alias("path"))


# ---------------------------------------------------------------- deduplication


@query(
    "u1_dedup_by_source",
    f"""WITH hit AS (SELECT *, sha256(text) AS h FROM documents WHERE {terms_sql('text')} <> ''),
       ranked AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY lower(source), doc_id) AS rn FROM hit)
       SELECT source, count(*) AS files, count(*) FILTER (rn = 1) AS canonical_files,
         count(*) FILTER (rn > 1) AS redundant_files FROM ranked GROUP BY source""",
)
def u1_flagship(t: Tables):
    from gleanwork.plans.screening import dedup_by_source

    return dedup_by_source(t.documents, PROSE_TERMS)


GROUPS_SQL = f"""{CANDIDATES_SQL}, labelled AS (SELECT c.*, CASE WHEN quality = 1 THEN 'pass' WHEN quality = 0 THEN 'not_found'
      WHEN name LIKE '%/src1%' THEN 'review' ELSE '' END AS status FROM candidates c LEFT JOIN labels l ON l.doc_id = c.input_index),
  ranked AS (SELECT *, 'sha256:' || content_sha256 AS exact_group_id,
    row_number() OVER (PARTITION BY content_sha256 ORDER BY lower(name), lastCommitSHA, lower(markdown_path), markdown_path) AS rn,
    count(*) OVER (PARTITION BY content_sha256) AS group_size FROM labelled),
  grouped AS (SELECT exact_group_id, count(*) AS n, count(DISTINCT nullif(status, '')) AS statuses FROM ranked GROUP BY 1)"""


def labelled_candidates(t: Tables):
    status = (
        F.when(F.col("quality") == 1, "pass")
        .when(F.col("quality") == 0, "not_found")
        .when(F.col("name").like("%/src1%"), "review")
        .otherwise("")
    )
    return t.candidates.join(t.labels.withColumnRenamed("doc_id", "input_index"), "input_index", "left").withColumn(
        "status", status
    )


@query(
    "u1_dedup_summary",
    f"""WITH {GROUPS_SQL} SELECT CAST(sum(n) AS BIGINT) AS input_files, count(*) AS unique_contents,
       count(*) FILTER (n > 1) AS duplicate_groups, CAST(sum(n - 1) AS BIGINT) AS redundant_files,
       count(*) FILTER (statuses > 1) AS decision_conflict_groups FROM grouped""",
)
def u1_summary(t: Tables):
    return dedup.dedup_summary(labelled_candidates(t))


@query(
    "u2_conflicting_groups",
    f"WITH {GROUPS_SQL} SELECT exact_group_id, n AS group_size, statuses AS distinct_statuses FROM grouped WHERE statuses > 1",
)
def u2(t: Tables):
    return dedup.conflicting_groups(labelled_candidates(t)).drop("representative")


@query(
    "u3_first_per_key",
    "SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id",
)
def u3(t: Tables):
    return ordering.first_rows(t.events, ["user_id"], ["event_id"], ["event_id", "event_type"])


@query(
    "w7_canonical_files",
    f"WITH {GROUPS_SQL} SELECT exact_group_id, name, lastCommitSHA, markdown_path, size_bytes FROM ranked WHERE rn = 1",
)
def w7(t: Tables):
    return dedup.canonical_rows(t.candidates).select(
        "exact_group_id", "name", "lastCommitSHA", "markdown_path", "size_bytes"
    )


@query(
    "w8_occurrences",
    f"WITH {GROUPS_SQL} SELECT exact_group_id, name, markdown_path, rn = 1 AS is_canonical, group_size FROM ranked",
)
def w8(t: Tables):
    return dedup.occurrences(materialize(t.candidates)).select(
        "exact_group_id", "name", "markdown_path", "is_canonical", "group_size"
    )


# ---------------------------------------------------------------- evidence


def evidence_paths(t: Tables):
    return files.merged_evidence(
        t.files.join(t.labels, "doc_id").select(
            F.col("repository").alias("name"),
            F.col("revision").alias("lastCommitSHA"),
            F.col("path").alias("guideline_path"),
        )
    )


def repositories(t: Tables):
    failed = F.col("lang") == "es"
    return t.files.groupBy("repository", "revision", "lang").agg(F.count("*").alias("n")).select(
        F.col("repository").alias("name"),
        F.col("revision").alias("lastCommitSHA"),
        F.when(failed, "retrieval_error").otherwise("completed").alias("status"),
        F.when(failed, "timeout").otherwise("").alias("error"),
    )


REPOSITORIES_SQL = """repositories AS (SELECT DISTINCT repository AS name, revision AS lastCommitSHA,
    CASE WHEN lang = 'es' THEN 'retrieval_error' ELSE 'completed' END AS status,
    CASE WHEN lang = 'es' THEN 'timeout' ELSE '' END AS error FROM files)"""
COVERAGE_SQL = f"""{NAMED_SQL}, {REPOSITORIES_SQL}, wanted AS (SELECT DISTINCT repository AS name, revision AS lastCommitSHA,
    path AS markdown_path FROM files JOIN labels USING (doc_id)),
  coverage AS (SELECT w.name, w.lastCommitSHA, w.markdown_path, lower(w.markdown_path) LIKE '%.md' AS is_markdown,
    CASE WHEN r.status = 'completed' THEN s.name IS NOT NULL END AS filename_match,
    CASE WHEN r.status = 'completed' AND s.name IS NOT NULL THEN s.name_terms ELSE '' END AS name_terms,
    CASE WHEN r.status = 'completed' AND s.name IS NOT NULL THEN s.body_terms <> '' END AS content_match
    FROM wanted w JOIN repositories r USING (name, lastCommitSHA)
    LEFT JOIN screened s USING (name, lastCommitSHA, markdown_path))"""


@query("j1_evidence_coverage", f"WITH {COVERAGE_SQL} SELECT * FROM coverage")
def j1(t: Tables):
    return files.evidence_coverage(evidence_paths(t), screened(t), repositories(t)).select(
        "name", "lastCommitSHA", "markdown_path", "is_markdown", "filename_match",
        terms.join_terms("matched_filename_terms").alias("name_terms"), "content_match",
    )


@query(
    "j2_candidate_evidence_flag",
    f"""WITH {COVERAGE_SQL} SELECT s.name, s.markdown_path, w.name IS NOT NULL AS agent_evidence FROM screened s
       LEFT JOIN wanted w USING (name, lastCommitSHA, markdown_path) WHERE body_terms <> ''""",
)
def j2(t: Tables):
    return files.candidate_files(screened(t), evidence_paths(t)).select("name", "markdown_path", "agent_evidence")


@query(
    "a2_repository_audit",
    f"""WITH {COVERAGE_SQL}, f AS (SELECT name, count(*) AS a, count(*) FILTER (body_terms <> '') AS b FROM screened GROUP BY 1),
       e AS (SELECT name, count(*) AS c, count(*) FILTER (is_markdown) AS d, count(*) FILTER (filename_match) AS g,
         count(*) FILTER (content_match) AS h, count(*) FILTER (filename_match IS NULL) AS i FROM coverage GROUP BY 1)
       SELECT r.name, r.lastCommitSHA, r.status, r.error,
         CASE WHEN r.status = 'completed' THEN coalesce(a, 0) ELSE 0 END AS markdown_filename_file_count,
         CASE WHEN r.status = 'completed' THEN coalesce(b, 0) ELSE 0 END AS markdown_filename_and_content_file_count,
         coalesce(c, 0) AS agent_evidence_file_count, coalesce(d, 0) AS agent_evidence_markdown_file_count,
         coalesce(g, 0) AS agent_evidence_filename_match_count,
         coalesce(h, 0) AS agent_evidence_filename_and_content_match_count,
         coalesce(i, 0) AS agent_evidence_not_evaluated_count
       FROM repositories r LEFT JOIN f USING (name) LEFT JOIN e USING (name)""",
)
def a2(t: Tables):
    # Screening writes its file table once; coverage and counts read that.
    found = materialize(screened(t))
    states = repositories(t)
    return files.repository_audit(states, found, files.evidence_coverage(evidence_paths(t), found, states))


@query(
    "p14_skipped_repositories",
    """SELECT n_name AS repository, sha256(n_name) AS snapshot_sha, 'snapshot_incomplete' AS status, 'missing_blob' AS reason
       FROM nation WHERE n_regionkey = 1""",
)
def p14(t: Tables):
    broken = F.col("n_regionkey") == 1
    rows = t.nation.select(
        F.col("n_name").alias("name"),
        F.sha2("n_name", 256).alias("lastCommitSHA"),
        F.when(broken, "snapshot_incomplete").otherwise("completed").alias("status"),
        F.when(broken, "missing_blob").otherwise("").alias("error"),
    )
    return files.skipped_repositories(rows)


def listed_files(t: Tables):
    return t.files.select("repository", "revision", "path", "sha")


def quoted_items(t: Tables, kinds: tuple[int, ...] = (1, 2, 3, 4, 5, 6)):
    """Two claims per labelled file: its own words, and a benchmark passage; plus a repeat and a stray path."""
    own = t.files.join(t.labels, "doc_id").select(
        "repository", "revision", "path", F.substring("content", 5, 40).alias("quote"), "doc_id"
    )
    passages = t.benchmark.select(F.col("item_id").alias("__item"), F.col("text").alias("quote"))
    items = t.benchmark.agg(F.count("*")).scalar()
    other = (
        t.files.join(t.labels, "doc_id")
        .select("repository", "revision", "path", "doc_id", (F.col("doc_id") % items).alias("__item"))
        .join(passages, "__item")
    )

    def shaped(rows, path, kind):
        return rows.select(
            "repository", "revision", (F.col("doc_id") * 10 + kind).alias("item_index"), path.alias("path"), "quote"
        )

    path = F.col("path")
    claims = {
        1: (other, path),
        2: (own, F.concat(F.lit("./"), path)),
        3: (own, path),
        4: (own, F.concat(F.lit("../"), path)),
        5: (own, F.concat(path, F.lit(".bak"))),
        6: (own.withColumn("quote", F.lit("")), path),
    }
    return gates.union_all(*(shaped(*claims[kind], kind) for kind in kinds))


@query(
    "j15_verified_evidence",
    f"""WITH {FILES_SQL}, own AS (SELECT repository, revision, path, content, substr(content, 5, 40) AS quote, doc_id
         FROM files JOIN labels USING (doc_id)),
       other AS (SELECT repository, revision, path, content, b.text AS quote, doc_id FROM files JOIN labels USING (doc_id)
         JOIN benchmark b ON b.item_id = doc_id % (SELECT count(*) FROM benchmark)),
       items AS (
         SELECT repository, revision, doc_id * 10 + 1 AS item_index, path, path AS target, quote, contains(content, quote) AS sound FROM other
         UNION ALL SELECT repository, revision, doc_id * 10 + 2, './' || path, path, quote, quote <> '' FROM own
         UNION ALL SELECT repository, revision, doc_id * 10 + 3, path, path, quote, quote <> '' FROM own
         UNION ALL SELECT repository, revision, doc_id * 10 + 4, '../' || path, NULL, quote, false FROM own
         UNION ALL SELECT repository, revision, doc_id * 10 + 5, path || '.bak', path || '.bak', quote, false FROM own
         UNION ALL SELECT repository, revision, doc_id * 10 + 6, path, path, '', false FROM own),
       firsts AS (SELECT repository, target, min(item_index) AS first_index FROM items WHERE sound GROUP BY 1, 2)
       SELECT i.repository, i.item_index, i.path, CASE WHEN quote = '' THEN 'quote is empty'
         WHEN i.target IS NULL THEN 'path resolves outside repository'
         WHEN item_index > first_index THEN 'path duplicates another verified evidence item'
         WHEN i.target LIKE '%.bak' THEN 'path is not a file'
         WHEN NOT sound THEN 'quote is not an exact substring of the file' END AS reason
       FROM items i LEFT JOIN firsts f ON f.repository = i.repository AND f.target = i.target""",
)
def j15(t: Tables):
    return evidence.verify_evidence(quoted_items(t), listed_files(t), t.content_store).select("repository", "item_index", "path", "reason")


@query(
    "w12_first_evidence_per_path",
    f"""WITH {FILES_SQL} SELECT repository, path, min(doc_id * 10 + 2) AS item_index FROM files JOIN labels USING (doc_id)
       WHERE substr(content, 5, 40) <> '' GROUP BY 1, 2""",
)
def w12(t: Tables):
    own = quoted_items(t, (2, 3, 4, 5, 6))
    verified = evidence.verify_evidence(own, listed_files(t), t.content_store).where(F.col("reason").isNull())
    return verified.select("repository", F.col("normalized_path").alias("path"), "item_index")


@query(
    "p19_evidence_items",
    f"""WITH {FILES_SQL} SELECT repository, CAST(1 AS INTEGER) AS item_index, path, substr(content, 1, 10) AS quote FROM files
       UNION ALL SELECT repository, 2, path || '#', '' FROM files""",
)
def p19(t: Tables):
    nested = t.files.select(
        "repository",
        "revision",
        F.to_json(
            F.array(
                F.struct(F.col("path").alias("path"), F.substring("content", 1, 10).alias("quote")),
                F.struct(F.concat("path", F.lit("#")).alias("path"), F.lit(None).cast("string").alias("quote")),
            )
        ).alias("evidence_json"),
    )
    return evidence.evidence_items(nested).drop("revision")


@query(
    "j15_repository_verdict",
    f"""WITH {FILES_SQL}, own AS (SELECT repository, count(*) AS good FROM files JOIN labels USING (doc_id)
         WHERE substr(content, 5, 40) <> '' GROUP BY 1),
       wrong AS (SELECT repository, count(*) AS bad FROM files JOIN labels USING (doc_id) WHERE lang <> 'en'
         OR substr(content, 5, 40) = '' GROUP BY 1),
       wrong_en AS (SELECT repository, bad FROM wrong)
       SELECT r.repository, CASE WHEN lang = 'fr' AND coalesce(good, 0) + coalesce(bad, 0) = 0 THEN 'not_found'
         WHEN lang = 'fr' OR coalesce(good, 0) = 0 OR coalesce(bad, 0) > 0 THEN 'review' ELSE 'pass' END AS status,
         coalesce(good, 0) AS verified_items, coalesce(bad, 0) AS unverified_items
       FROM (SELECT DISTINCT repository, lang FROM files) r LEFT JOIN own USING (repository) LEFT JOIN wrong_en USING (repository)""",
)
def j15_verdict(t: Tables):
    stray = quoted_items(t, (4,)).where(~F.col("repository").startswith("en-"))
    picked = quoted_items(t, (3,)).unionByName(stray)
    responses = t.files.select(
        "repository", "revision", F.when(F.col("lang") == "fr", "not_found").otherwise("pass").alias("status")
    ).distinct()
    return evidence.evidence_verdict(responses, evidence.verify_evidence(picked, listed_files(t), t.content_store)).drop("revision", "reason")


@query(
    "o2_top_documents",
    f"""WITH {FILES_SQL}, scored AS (SELECT repository, path, {RELEVANCE_SQL} AS score FROM files WHERE {CANDIDATE_DOC_SQL}),
       ranked AS (SELECT *, row_number() OVER (PARTITION BY repository ORDER BY score DESC, lower(path), path) AS rank FROM scored)
       SELECT repository, path, score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 12""",
)
def o2(t: Tables):
    return evidence.top_documents(t.files.drop("content")).select("repository", "path", "score", "rank")


PAYLOAD_SQL = f"""{FILES_SQL}, ranked AS (SELECT repository, path, content,
      row_number() OVER (PARTITION BY repository ORDER BY path) AS rank FROM files WHERE content IS NOT NULL),
    used AS (SELECT *, least(length(content), 900) AS capped, CAST(sum(least(length(content), 900)) OVER
      (PARTITION BY repository ORDER BY rank) AS BIGINT) AS used,
      count(*) FILTER (content = '') OVER (PARTITION BY repository ORDER BY rank) AS stops FROM ranked),
    cut AS (SELECT *, least(900, 5000 - (used - capped)) AS lim FROM used WHERE stops = 0 AND 5000 - (used - capped) > 0),
    room AS (SELECT *, lim - 39 AS room, CAST(floor((lim - 39) * 2 / 3.0) AS BIGINT) AS head FROM cut),
    kept AS (SELECT repository, path, rank, CASE WHEN length(content) <= lim THEN content
      WHEN room > 0 THEN substr(content, 1, head) || chr(10) || '...[middle truncated by evaluator]...' || chr(10) || right(content, room - head)
      ELSE (CASE WHEN head = 0 THEN '' ELSE substr(content, 1, greatest(length(content) + head, 0)) END) || chr(10) ||
        '...[middle truncated by evaluator]...' || chr(10) || substr(content, 1 - (room - head)) END AS body FROM room)"""


def budgeted(t: Tables):
    rows = t.files.where("content is not null").drop("content")
    ranked = ordering.running(rows, ["repository", "revision"], ["path"], rank="rank")
    return evidence.budgeted_payload(ranked, t.content_store, 900, 5000)


@query(
    "w13_budgeted_payload",
    f"WITH {PAYLOAD_SQL} SELECT repository, path, length(body) AS n, sha256(body) AS digest FROM kept",
)
def w13(t: Tables):
    return budgeted(t).select(
        "repository", "path", F.length("content").cast("bigint").alias("n"), F.sha2("content", 256).alias("digest")
    )


@query("k7_blind_payload", f"WITH {PAYLOAD_SQL} SELECT repository, rank, path, sha256(body) AS digest FROM kept")
def k7(t: Tables):
    from gleanwork.bindings.attempts import log_folder

    folder = log_folder(t, "payload")
    sinks.write_payloads(evidence.payload_documents(budgeted(t)), folder)
    back = t.spark.read.schema("repository string, rank bigint, document string").json(folder)
    read = back.withColumn("document", F.from_json("document", "path string, content string"))
    return read.select("repository", "rank", "document.path", F.sha2("document.content", 256).alias("digest"))


@query(
    "j13_candidate_sizes",
    f"""WITH {CANDIDATES_SQL} SELECT name, markdown_path, CASE WHEN name LIKE 'es-%' THEN NULL ELSE size_bytes END AS size_bytes
       FROM candidates""",
)
def j13(t: Tables):
    known = t.files.where("lang <> 'es'")
    return files.with_sizes(t.candidates.drop("size_bytes"), known).select("name", "markdown_path", "size_bytes")
