"""Review checklists: names, merging, packing, outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanwork.bindings.registry import query
from gleanwork.bindings.tables import CANDIDATES_SQL, FILES_SQL, Tables
from gleanwork.functions import labels
from gleanwork.operators import gates, review
from gleanwork.sources import readers

CHECK_SQL = """checks AS (SELECT 'Conv' || conv_id % 40 AS repository, 'c' || conv_id || '/' || turn || '.md' AS file,
    'u/' || conv_id || '/' || turn AS github_url, conv_id * 100 + turn AS position, 'added_round_' || (1 + turn % 3) AS review_origin,
    CASE WHEN role = 'assistant' THEN 'not_found' ELSE 'pass' END AS human_decision,
    CASE WHEN role = 'user' AND turn >= 4 THEN 'c' || conv_id || '/' || (turn - 4) || '.md' ELSE '' END AS duplicate_of, conv_id, turn, text
    FROM conversations)"""


def checks(t: Tables):
    """One checklist row per conversation turn; late user turns repeat an earlier turn."""
    at = F.concat(F.lit("c"), "conv_id", F.lit("/"))
    late = (F.col("role") == "user") & (F.col("turn") >= 4)
    return t.conversations.select(
        F.concat(F.lit("Conv"), F.col("conv_id") % 40).alias("repository"),
        F.concat(at, "turn", F.lit(".md")).alias("file"),
        F.concat(F.lit("u/"), "conv_id", F.lit("/"), "turn").alias("github_url"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("position"),
        F.concat(F.lit("added_round_"), 1 + F.col("turn") % 3).alias("review_origin"),
        F.when(F.col("role") == "assistant", "not_found").otherwise("pass").alias("human_decision"),
        F.when(late, F.concat(at, F.col("turn") - 4, F.lit(".md"))).otherwise("").alias("duplicate_of"),
        "conv_id",
        "turn",
        "text",
    )


@query("s12_upgraded_checklist", f"WITH {CHECK_SQL} SELECT file, human_decision, '' AS duplicate_of FROM checks")
def s12(t: Tables):
    return readers.upgrade_checklist(checks(t).drop("duplicate_of")).select("file", "human_decision", "duplicate_of")


V6_SQL = f"""{CHECK_SQL}, broken AS (SELECT file, CASE WHEN conv_id % 9 = 0 AND turn = 1 THEN '' ELSE human_decision END AS human_decision,
    CASE WHEN conv_id % 7 = 0 AND turn = 2 THEN 'nowhere.md' ELSE duplicate_of END AS duplicate_of FROM checks),
  targets AS (SELECT file, bool_or(human_decision = 'pass' AND duplicate_of = '') AS sound FROM broken GROUP BY 1),
  pointing AS (SELECT b.*, t.sound FROM broken b LEFT JOIN targets t ON t.file = b.duplicate_of WHERE duplicate_of <> '')"""


def broken_checks(t: Tables):
    c = checks(t)
    return c.withColumn(
        "human_decision",
        F.when((F.col("conv_id") % 9 == 0) & (F.col("turn") == 1), "").otherwise(F.col("human_decision")),
    ).withColumn(
        "duplicate_of",
        F.when((F.col("conv_id") % 7 == 0) & (F.col("turn") == 2), "nowhere.md").otherwise(F.col("duplicate_of")),
    )


@query(
    "v6_checklist_integrity",
    f"""WITH {V6_SQL} SELECT 'human_decision' AS rule, file AS key, human_decision AS detail FROM broken WHERE human_decision = ''
       UNION ALL SELECT 'duplicate_target_absent', file, duplicate_of FROM pointing WHERE sound IS NULL
       UNION ALL SELECT 'duplicate_not_pass', file, human_decision FROM pointing WHERE human_decision <> 'pass'
       UNION ALL SELECT 'duplicate_target_not_pass', file, duplicate_of FROM pointing WHERE NOT sound""",
)
def v6(t: Tables):
    return gates.checklist_integrity(broken_checks(t))


@query(
    "j16_duplicate_targets",
    f"WITH {V6_SQL} SELECT file AS key, duplicate_of AS detail FROM pointing WHERE NOT coalesce(sound, false)",
)
def j16(t: Tables):
    found = gates.checklist_integrity(broken_checks(t))
    return found.where(F.col("rule").startswith("duplicate_target")).select("key", "detail")


@query(
    "a14_repository_outcomes",
    f"""WITH {CHECK_SQL} SELECT repository, CASE WHEN count(*) FILTER (human_decision = 'pass' AND duplicate_of = '') > 0 THEN 'accepted'
         ELSE 'rejected' END AS status, count(*) FILTER (human_decision = 'pass' AND duplicate_of = '') AS accepted_file_count,
         count(*) FILTER (duplicate_of <> '') AS duplicate_file_count, count(*) FILTER (human_decision = 'not_found') AS not_found_file_count
       FROM checks GROUP BY 1""",
)
def a14(t: Tables):
    return review.repository_outcomes(checks(t))


@query(
    "a15_review_totals",
    f"""WITH {CHECK_SQL}, r AS (SELECT repository, count(*) FILTER (human_decision = 'pass' AND duplicate_of = '') > 0 AS ok FROM checks GROUP BY 1)
       SELECT count(*) AS input_files, count(*) FILTER (human_decision = 'pass' AND duplicate_of = '') AS accepted_files,
         count(*) FILTER (duplicate_of <> '') AS duplicate_files, count(*) FILTER (human_decision = 'not_found') AS not_found_files,
         (SELECT count(*) FROM r) AS reviewed_repositories, (SELECT count(*) FILTER (ok) FROM r) AS accepted_repositories,
         (SELECT count(*) FILTER (NOT ok) FROM r) AS rejected_repositories FROM checks""",
)
def a15(t: Tables):
    return review.review_totals(checks(t))


@query(
    "f20_next_round",
    "SELECT 'added_round_' || (max(1 + turn % 3) + 1) AS review_origin FROM conversations",
)
def f20(t: Tables):
    noise = t.region.select(F.col("r_name").alias("review_origin"))
    return review.next_round(checks(t).select("review_origin").unionByName(noise), True)


@query(
    "f21_final_origin",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'baseline' WHEN 'O' THEN 'new' END AS origin FROM orders""",
)
def f21(t: Tables):
    raw = F.when(F.col("o_orderstatus") == "F", " baseline").when(
        F.col("o_orderstatus") == "O", F.when(F.col("o_orderkey") % 2 == 0, "new_confirmed").otherwise("new_pending ")
    ).otherwise("other")
    return t.orders.select("o_orderkey", labels.final_origin(raw).alias("origin"))


MERGE_SQL = f"""{CHECK_SQL}, old AS (SELECT *, CASE WHEN conv_id % 3 = 0 THEN '' ELSE human_decision END AS old_decision FROM checks WHERE turn < 3),
  new AS (SELECT * FROM checks WHERE turn > 0 AND conv_id % 5 <> 0),
  annotated AS (SELECT DISTINCT lower(repository) AS r FROM old WHERE old_decision <> ''),
  merged AS (SELECT coalesce(n.github_url, o.github_url) AS github_url, CASE WHEN o.file IS NULL THEN 'new-' || n.file ELSE o.file END AS file,
    CASE WHEN n.file IS NULL THEN 'old' ELSE 'review' END AS llm_decision, coalesce(o.old_decision, '') AS human_decision,
    CASE WHEN o.file IS NULL THEN 'added_round_9' ELSE o.review_origin END AS review_origin, o.file IS NULL AS appended,
    n.file IS NOT NULL OR lower(o.repository) IN (SELECT r FROM annotated) AS keep
    FROM old o FULL JOIN new n ON n.github_url = o.github_url)"""


def merged(t: Tables):
    c = checks(t)
    base = c.withColumns({"codex_decision": F.lit(""), "codex_reason": F.lit(""), "note": F.lit("")})
    old = base.where("turn < 3").withColumns(
        {
            "llm_decision": F.lit("old"),
            "duplicate_of": F.lit(""),
            "human_decision": F.when(F.col("conv_id") % 3 == 0, "").otherwise(F.col("human_decision")),
        }
    ).drop("conv_id", "turn", "text")
    new = c.where("turn > 0 and conv_id % 5 <> 0").select(
        "repository", F.concat(F.lit("new-"), "file").alias("file"), "github_url", F.lit("review").alias("llm_decision"), "position"
    )
    return review.merge_checklist(old, new, "added_round_9")


@query(
    "j17_merged_checklist",
    f"WITH {MERGE_SQL} SELECT github_url, file, llm_decision, human_decision, review_origin, appended FROM merged WHERE keep",
)
def j17(t: Tables):
    return merged(t).select(
        "github_url", "file", "llm_decision", "human_decision", "review_origin", F.col("position.appended").alias("appended")
    )


@query(
    "j18_full_checklist",
    f"""WITH {CHECK_SQL}, docs AS (SELECT *, repository || '/x' AS repo, 'a b/' || file AS path FROM checks),
       old AS (SELECT github_url, human_decision FROM checks WHERE turn = 0)
       SELECT d.github_url, CASE WHEN o.github_url IS NOT NULL THEN d.file ELSE replace(repo, '/', '--') || '/' || replace(replace(path, ' ', '_'), '/', '__') END AS file,
         CASE WHEN o.github_url IS NOT NULL THEN 'existing_166' ELSE 'codex_added_561' END AS review_origin,
         CASE WHEN o.github_url IS NOT NULL THEN o.human_decision WHEN turn % 2 = 0 THEN 'pass' ELSE 'not_found' END AS human_decision,
         CASE WHEN o.github_url IS NOT NULL THEN 'kept' WHEN turn % 2 = 0 THEN 'Evidence (L1): ' || substr(text, 1, 5) || ' 理由：why' ELSE '理由：why' END AS codex_reason
       FROM docs d LEFT JOIN old o USING (github_url)""",
)
def j18(t: Tables):
    c = checks(t)
    documents = c.select(
        F.col("github_url").alias("custom_id"),
        F.concat("repository", F.lit("/x")).alias("repository"),
        F.concat(F.lit("a b/"), "file").alias("path"),
        F.col("github_url").alias("url"),
        F.col("text").alias("content"),
        F.lit("pass").alias("llm_decision"),
    )
    existing = c.where("turn = 0").select(
        "repository", "file", "github_url", "human_decision", "duplicate_of", F.lit("pass").alias("codex_decision"),
        F.lit("kept").alias("codex_reason"), F.lit("").alias("note"),
    )
    passed = F.col("turn") % 2 == 0
    reviews = c.where("turn > 0").select(
        F.col("github_url").alias("custom_id"),
        F.when(passed, "pass").otherwise("not_found").alias("decision"),
        F.when(passed, F.substring("text", 1, 5)).otherwise("").alias("quote"),
        F.lit("why").alias("reason"),
    )
    return review.full_checklist(documents, existing, reviews).select(
        "github_url", "file", "review_origin", "human_decision", "codex_reason"
    )


@query(
    "w9_numbered_filenames",
    """WITH named AS (SELECT doc_id, 'Org--' || source || '/' || CASE doc_id % 6 WHEN 0 THEN 'README.md' WHEN 1 THEN 'readme.MD' WHEN 2 THEN 'docs__a_b.md'
         WHEN 3 THEN 'Makefile' ELSE 'docs__' || doc_id || '.md' END AS file FROM documents),
       ranked AS (SELECT *, row_number() OVER (PARTITION BY lower(file) ORDER BY doc_id) AS n FROM named)
       SELECT doc_id, CASE WHEN n = 1 THEN file WHEN file LIKE '%Makefile' THEN file || '__' || n
         ELSE substr(file, 1, length(file) - 3) || '__' || n || right(file, 3) END AS file FROM ranked""",
)
def w9(t: Tables):
    return review.numbered_filenames(colliding(t), ["doc_id"]).select("doc_id", "file")


def colliding(t: Tables):
    """Files of one repository per source whose flattened names collide."""
    key = F.col("doc_id") % 6
    path = (
        F.when(key == 0, "README.md").when(key == 1, "readme.MD")
        .when(key == 2, F.when(F.col("doc_id") % 4 == 0, "docs/a b.md").otherwise("docs/a::b.md"))
        .when(key == 3, "Makefile").otherwise(F.concat(F.lit("docs/"), "doc_id", F.lit(".md")))
    )
    return t.documents.select("doc_id", F.concat(F.lit("Org/"), "source").alias("name"), path.alias("markdown_path"))


@query(
    "w9_unused_filenames",
    """WITH named AS (SELECT doc_id, 'Org--' || source || '/' || CASE doc_id % 6 WHEN 0 THEN 'README.md' WHEN 1 THEN 'readme.MD' WHEN 2 THEN 'docs__a_b.md'
         WHEN 3 THEN 'Makefile' ELSE 'docs__' || doc_id || '.md' END AS file FROM documents),
       used AS (SELECT DISTINCT lower('Org--' || source) || '/' || u AS base, n FROM documents, (VALUES ('readme.md', 1), ('readme.md', 3), ('readme.md', 4), ('makefile', 2)) v(u, n)),
       ranked AS (SELECT *, lower(file) AS base, row_number() OVER (PARTITION BY lower(file) ORDER BY doc_id) AS place FROM named),
       slots AS (SELECT base, n, row_number() OVER (PARTITION BY base ORDER BY n) AS place FROM
         (SELECT base, unnest(generate_series(1, count(*) + 4)) AS n FROM ranked GROUP BY base) WHERE (base, n) NOT IN (SELECT base, n FROM used))
       SELECT doc_id, CASE WHEN n = 1 THEN file WHEN file LIKE '%Makefile' THEN file || '__' || n
         ELSE substr(file, 1, length(file) - 3) || '__' || n || right(file, 3) END AS file FROM ranked JOIN slots USING (base, place)""",
)
def w9_unused(t: Tables):
    names = t.documents.select("source").distinct().select(
        F.explode(F.array(*map(F.lit, ("README.md", "readme__3.md", "Readme__4.MD", "Makefile__2")))).alias("__name"), "source"
    )
    used = names.select(F.concat(F.lit("Org--"), "source", F.lit("/"), "__name").alias("file"))
    return review.unused_filenames(colliding(t), used, ["doc_id"], ["doc_id"]).select("doc_id", "file")


PACK_SQL = """ordered AS (SELECT source AS repository, doc_id, length(text) AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS pos FROM documents),
  fold AS (SELECT repository, doc_id, pos, n AS chars, CAST(1 AS BIGINT) AS docs, pos AS batch_start FROM ordered WHERE pos = 1
    UNION ALL SELECT o.repository, o.doc_id, o.pos, CASE WHEN f.docs >= 12 OR f.chars + o.n > 6000 THEN o.n ELSE f.chars + o.n END,
      CASE WHEN f.docs >= 12 OR f.chars + o.n > 6000 THEN 1 ELSE f.docs + 1 END,
      CASE WHEN f.docs >= 12 OR f.chars + o.n > 6000 THEN o.pos ELSE f.batch_start END
    FROM fold f JOIN ordered o ON o.repository = f.repository AND o.pos = f.pos + 1)"""


def packed(t: Tables, segment_rows: int):
    rows = t.documents.select(
        F.col("source").alias("repository"), F.col("doc_id").alias("position_key"), "doc_id",
        F.col("doc_id").cast("string").alias("custom_id"), F.length("text").alias("characters"),
    )
    return review.pack_batches(rows, 12, 6000, segment_rows)


@query("w11_packed_batches", f"WITH RECURSIVE {PACK_SQL} SELECT repository, doc_id, batch_start FROM fold")
def w11(t: Tables):
    return packed(t, review.SEGMENT_ROWS).select("repository", "doc_id", "batch_start")


@query("w11_packed_batches_split", f"WITH RECURSIVE {PACK_SQL} SELECT repository, doc_id, batch_start FROM fold")
def w11_split(t: Tables):
    """The same packing with every repository cut into short segments, as a large one would be."""
    return packed(t, 40).select("repository", "doc_id", "batch_start")


@query(
    "f16_batch_inputs",
    f"""WITH RECURSIVE {PACK_SQL} SELECT repository, batch_start, CAST(pos - batch_start AS INTEGER) AS place, CAST(doc_id AS VARCHAR) AS custom_id,
       repository || '.md' AS path, sha256(text) AS digest FROM fold JOIN documents USING (doc_id)""",
)
def f16(t: Tables):
    bodies = t.documents.select(
        F.col("doc_id").cast("string").alias("custom_id"), F.concat("source", F.lit(".md")).alias("path"), F.col("text").alias("content")
    )
    batches = review.batch_inputs(packed(t, review.SEGMENT_ROWS), bodies)
    parts = batches.select("repository", "batch_start", F.posexplode(F.split("input", review.DOCUMENT_SEPARATOR)).alias("place", "part"))
    document = F.from_json("part", "custom_id string, path string, content string")
    return parts.withColumn("document", document).select(
        "repository", "batch_start", "place", "document.custom_id", "document.path", F.sha2("document.content", 256).alias("digest")
    )


@query(
    "k5_review_files",
    f"""WITH {CANDIDATES_SQL} SELECT 'x--' || replace(name, '/', '--') AS folder, content_sha256 AS digest FROM candidates""",
)
def k5(t: Tables):
    from gleanwork.bindings.attempts import log_folder
    from gleanwork.sources import sinks

    named = review.numbered_filenames(t.candidates, ["markdown_path"])
    folder = log_folder(t, "review")
    sinks.write_review_files(review.export_files(named, t.contents), folder)
    back = t.spark.read.schema("file string, content string, folder string").parquet(folder)
    return back.select(F.concat(F.lit("x--"), "folder").alias("folder"), F.sha2("content", 256).alias("digest"))


@query(
    "v12_review_answers",
    f"""WITH {FILES_SQL}, a AS (SELECT doc_id, content, CASE doc_id % 4 WHEN 0 THEN 'pass' WHEN 1 THEN 'not_found' WHEN 2 THEN 'maybe' ELSE 'pass' END AS decision,
         CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE 'ok' END AS reason, CASE WHEN doc_id % 5 < 2 THEN substr(content, 3, 20) WHEN doc_id % 5 = 2 THEN 'zzzqqq' ELSE '' END AS quote FROM files)
       SELECT 'invalid_decision' AS rule, CAST(doc_id AS VARCHAR) AS key, decision AS detail FROM a WHERE decision = 'maybe'
       UNION ALL SELECT 'empty_reason', CAST(doc_id AS VARCHAR), reason FROM a WHERE trim(reason) = ''
       UNION ALL SELECT 'not_found_with_quote', CAST(doc_id AS VARCHAR), CAST(length(quote) AS VARCHAR) FROM a WHERE decision = 'not_found' AND quote <> ''
       UNION ALL SELECT 'quote_not_found', CAST(doc_id AS VARCHAR), CAST(length(quote) AS VARCHAR) FROM a WHERE decision = 'pass' AND (quote = '' OR NOT contains(content, quote))""",
)
def v12(t: Tables):
    d, k = F.col("doc_id") % 4, F.col("doc_id") % 5
    rows = t.files.select(
        F.col("doc_id").cast("string").alias("custom_id"),
        F.when(d == 1, "not_found").when(d == 2, "maybe").otherwise("pass").alias("decision"),
        F.when(F.col("doc_id") % 3 == 0, " ").otherwise("ok").alias("reason"),
        F.when(k < 2, F.substring("content", 3, 20)).when(k == 2, "zzzqqq").otherwise("").alias("quote"),
    )
    return gates.invalid_reviews(rows, t.files.select(F.col("doc_id").cast("string").alias("custom_id"), "content"))
