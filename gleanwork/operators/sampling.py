"""Reproducible stratified sampling and scheduling.

A draw orders the units of a stratum by ``sha256(seed:unit)``. It is seeded, independent of input
order and without replacement; the drawn rows differ from a Mersenne-Twister shuffle, whose
sequential state has no distributed form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanwork.functions import labels, paths
from gleanwork.functions.text import strip
from gleanwork.operators.ordering import HASH_DIGITS, dense_index, draw_hash, first_k, first_rows
from gleanwork.session import materialize, wide_partitions

SIZE_STRATA = 5
MANIFEST_FIELDS = (
    "sample_order", "sampling_language", "language_population", "language_sample_size",
    "inclusion_probability", "name", "lastCommitSHA", "source_file", "source_input_index",
)
SCHEDULE_FIELDS = (
    "sample_order", "round_number", "sampling_language", "language_population",
    "name", "lastCommitSHA", "source_file", "source_input_index",
)


def strata(spark, languages: Sequence[str]) -> DataFrame:
    """The declared strata in order: ``sampling_language, stratum_index``."""
    rows = [(language, index) for index, language in enumerate(languages, start=1)]
    return spark.createDataFrame(rows, "sampling_language string, stratum_index bigint")


def eligible(population: DataFrame, excluded: DataFrame | None, languages: Sequence[str]) -> DataFrame:
    """Units of the declared strata that are not excluded by name, ignoring case."""
    units = population.where(F.col("mainLanguage").isin(*languages)).withColumn("__unit", F.lower("name"))
    if excluded is not None:
        units = units.join(excluded.select(F.lower(strip("name")).alias("__unit")).distinct(), "__unit", "left_anti")
    return units.withColumnRenamed("mainLanguage", "sampling_language")


def stratum_quotas(dimension: DataFrame, sample_size: int, seed: int) -> DataFrame:
    """Near-equal quotas; the remainder goes to the strata drawn first.

    ``dimension`` has one row per stratum, so its un-partitioned windows hold a handful of rows.
    """
    count = F.count("*").over(Window.partitionBy())
    place = F.row_number().over(Window.orderBy(draw_hash(seed, "sampling_language"), "sampling_language"))
    size = F.lit(sample_size)
    return dimension.select(
        *dimension.columns,
        (
            F.floor(size / count) + F.when(place <= size - F.floor(size / count) * count, 1).otherwise(0)
        ).cast("bigint").alias("language_sample_size"),
    )


def schedule(
    population: DataFrame, languages: Sequence[str], seed: int, excluded: DataFrame | None = None
) -> DataFrame:
    """Round-robin draw order: round r holds the r-th drawn unit of every stratum.

    Stops at the smallest stratum; an empty declared stratum leaves no rounds. Units of larger
    strata that fall beyond the last round are dropped bucket by bucket before any sort.
    """
    spark = population.sparkSession
    units = eligible(population, excluded, languages)
    sizes = units.groupBy("sampling_language").agg(F.count("*").alias("language_population"))
    # One row per declared stratum.
    dimension = strata(spark, languages).join(sizes, "sampling_language", "left")
    rounds = dimension.agg(F.min(F.coalesce("language_population", F.lit(0)))).scalar()
    drawn = first_k(
        units.withColumn("__draw", draw_hash(seed, "__unit")),
        ["sampling_language"],
        F.substring("__draw", 1, HASH_DIGITS),
        ["__draw", "__unit"],
        rounds,
        "round_number",
    )
    return (
        drawn.join(F.broadcast(dimension), "sampling_language")
        .withColumn("sample_order", (F.col("round_number") - 1) * len(languages) + F.col("stratum_index"))
        .drop("__unit", "__draw", "stratum_index")
    )


def stratified_sample(
    population: DataFrame,
    languages: Sequence[str],
    sample_size: int,
    seed: int,
    excluded: DataFrame | None = None,
) -> DataFrame:
    """Draw near-equal quotas per stratum and number the sample stratum by stratum."""
    spark = population.sparkSession
    if sample_size < len(languages):
        raise ValueError("sample_size must be at least the number of strata")
    units = eligible(population, excluded, languages)
    quotas = stratum_quotas(strata(spark, languages), sample_size, seed)
    before = Window.orderBy("stratum_index").rowsBetween(Window.unboundedPreceding, -1)
    quotas = quotas.withColumn("__offset", F.coalesce(F.sum("language_sample_size").over(before), F.lit(0)))
    sizes = units.groupBy("sampling_language").agg(F.count("*").alias("language_population"))
    keyed = units.join(F.broadcast(quotas), "sampling_language").withColumn("__draw", draw_hash(seed, "__unit"))
    drawn = first_k(
        keyed,
        ["sampling_language"],
        F.substring("__draw", 1, HASH_DIGITS),
        ["__draw", "__unit"],
        "language_sample_size",
        "__rank",
    )
    return (
        drawn.join(F.broadcast(sizes), "sampling_language")
        .withColumn("sample_order", F.col("__offset") + F.col("__rank"))
        .withColumn("inclusion_probability", labels.ratio("language_sample_size", "language_population"))
        .drop("__unit", "__draw", "__offset", "__rank", "stratum_index")
    )


def sampling_report(
    population: DataFrame,
    languages: Sequence[str],
    sample_size: int,
    excluded: DataFrame,
    seed: int,
) -> DataFrame:
    """Per stratum: population, excluded, eligible and sampled counts."""
    spark = population.sparkSession
    names = excluded.select(F.lower(strip("name")).alias("__unit")).distinct().withColumn("__out", F.lit(True))
    counts = (
        population.withColumn("__unit", F.lower("name"))
        .join(names, "__unit", "left")
        .groupBy(F.col("mainLanguage").alias("sampling_language"))
        .agg(F.count("*").alias("population"), F.count_if(F.col("__out").isNotNull()).alias("excluded"))
    )
    quotas = stratum_quotas(strata(spark, languages), sample_size, seed)
    # Both sides hold one row per stratum.
    return quotas.join(counts, "sampling_language", "left").select(
        "sampling_language",
        F.coalesce("population", F.lit(0)).alias("population"),
        F.coalesce("excluded", F.lit(0)).alias("excluded"),
        F.coalesce(F.col("population") - F.col("excluded"), F.lit(0)).alias("eligible"),
        F.least("language_sample_size", F.coalesce(F.col("population") - F.col("excluded"), F.lit(0))).alias("sampled"),
    )


def size_strata(files: DataFrame, strata_count: int = SIZE_STRATA) -> DataFrame:
    """Assign size strata cut at ``floor(n * i / strata_count)`` of the size order."""
    ranked = dense_index(files, ["size_bytes", "name", "lastCommitSHA", "markdown_path"], "__rank")
    n = ranked.agg(F.count("*")).scalar()
    stratum = F.floor((F.lit(strata_count) * (F.col("__rank") + 1) - 1) / n) + 1
    return ranked.withColumn("stratum", stratum.cast("int")).drop("__rank")


def sequential_ids(files: DataFrame, order: Sequence[str], name: str = "custom_id") -> DataFrame:
    """``candidate-0001`` style ids in ``order``."""
    numbered = dense_index(files, list(order), "__number", start=1)
    return numbered.withColumn(name, F.format_string("candidate-%04d", "__number")).drop("__number")


def size_sample(files: DataFrame, sample_size: int, seed: int, strata_count: int = SIZE_STRATA) -> DataFrame:
    """Equal counts from every size stratum, numbered by stratum and identity."""
    if sample_size < strata_count or sample_size % strata_count:
        raise ValueError("sample_size must be a positive multiple of the number of strata")
    stratified = size_strata(files, strata_count)
    sizes = stratified.groupBy("stratum").agg(F.count("*").alias("stratum_population"))
    key = F.concat_ws("/", "name", "lastCommitSHA", "markdown_path")
    drawn = first_k(
        stratified.withColumn("__draw", draw_hash(seed, key)),
        ["stratum"],
        F.substring("__draw", 1, HASH_DIGITS),
        ["__draw", "name", "lastCommitSHA", "markdown_path"],
        F.lit(sample_size // strata_count),
        "__rank",
    ).drop("__draw", "__rank")
    # One row per stratum.
    sampled = drawn.join(F.broadcast(sizes), "stratum")
    return sequential_ids(sampled, ["stratum", "name", "lastCommitSHA", "markdown_path"])


def select_all(files: DataFrame) -> DataFrame:
    """Every file as one stratum numbered zero."""
    numbered = sequential_ids(files, ["name", "lastCommitSHA", "markdown_path"])
    return numbered.withColumns(
        {"stratum": F.lit(0), "stratum_population": F.lit(numbered.agg(F.count("*")).scalar())}
    )


# The boundary-case strata, in selection order.
HARD_STRATA = (
    ("subtle_confirmed", "pass", False, "lowest-density prior confirmed rule"),
    ("dense_unconfirmed", "review", True, "highest-density prior unconfirmed candidate"),
    ("weak_unconfirmed", "review", False, "lowest-density prior unconfirmed candidate"),
)
PRIOR_LABEL_COLUMNS = (
    "repository_url", "license_spdx_id", "license_status", "license_reason", "guideline_status",
    "guideline_reason", "guideline_path", "guideline_url", "guideline_evidence", "candidate_count",
    "candidate_documents_json", "tree_truncated",
)


def hard_cases(
    classified: DataFrame,
    languages: Sequence[str],
    quotas: Sequence[int] = (1, 2, 2),
    excluded: DataFrame | None = None,
) -> DataFrame:
    """Boundary cases per language and stratum, no owner or project twice overall; one row per case.

    The picks are those of a loop over languages, strata and quotas that takes the best row whose
    owner and project are free. They are found in rounds of a greedy matching: rows that no better
    row shares an owner or project with are picked at once, see ``_matched``. Rows without a name
    are no cases; of several rows of a picked name the one that was ranked counts, ties go to the
    smallest row.
    """
    rows = classified.where(F.col("name").isNotNull())
    if excluded is not None:
        rows = rows.join(excluded.select(F.col("repository").alias("name")).distinct(), "name", "left_anti")
    difficulty = labels.difficulty(
        "candidate_documents_json", "candidate_count", "guideline_status", "guideline_path"
    ).alias("difficulty_score")
    whole = F.lower(F.coalesce("tree_truncated", F.lit("false"))) != "true"
    slots = [
        (language, status, group * len(HARD_STRATA) + k, -1 if descending else 1, quota, stratum, reason)
        for group, language in enumerate(languages)
        for k, ((stratum, status, descending, reason), quota) in enumerate(zip(HARD_STRATA, quotas, strict=True))
    ]
    # One row per language and stratum.
    slot = F.broadcast(
        classified.sparkSession.createDataFrame(
            slots,
            "mainLanguage string, guideline_status string, slot int, sign int, quota int, sampling_stratum string, "
            "difficulty_reason string",
        )
    )
    scored = (
        rows.where(whole)
        .select("name", "mainLanguage", "guideline_status", difficulty)
        .join(slot, ["mainLanguage", "guideline_status"])
        .select(
            "slot", "quota", "name", "mainLanguage", "guideline_status", "difficulty_score", "sampling_stratum", "difficulty_reason",
            paths.owner("name").alias("owner"),
            paths.project("name").alias("project"),
            F.struct("slot", (F.col("difficulty_score") * F.col("sign")).alias("score"), F.lower("name").alias("lower"), "name").alias("place"),
        )
    )
    wanted_cases = sum(quotas) * len(languages)
    picks, count = _matched(scored, wanted_cases)
    if count < wanted_cases:
        counts = picks.groupBy("slot").agg(F.count("*").alias("n"))
        short = slot.join(counts, "slot", "left").where(F.coalesce("n", F.lit(0)) < F.col("quota")).orderBy("slot").first()
        raise ValueError(f"not enough diverse hard candidates for {short['mainLanguage']}/{short['sampling_stratum']}")
    # One row per requested case.
    found = (
        rows.where(whole)
        .withColumn("difficulty_score", difficulty)
        .join(
            F.broadcast(picks.drop("slot", "owner", "project")),
            ["name", "mainLanguage", "guideline_status", "difficulty_score"],
        )
    )
    wanted = [*classified.columns, "sampling_stratum", "difficulty_score", "difficulty_reason"]
    return first_rows(found, ["name"], [F.to_json(F.struct(*classified.columns))], wanted).select(*wanted)


def _matched(scored: DataFrame, total: int) -> tuple[DataFrame, int]:
    """The greedy matching of owners and projects in order of ``place``, ``quota`` rows of a slot at most; and its size.

    A row is sure of its pick when every open row of its slot up to it is the best open row of its
    own owner and of its own project, over all slots; each round picks all of these. The first
    open row always is, so there are at most ``total`` rounds.

    A round looks at a pool that holds every row the matching could pick. Of one slot and owner
    the ``total`` best projects are enough, as other picks block fewer; so are the ``total`` best
    owners of a project, and of a slot the rows that so many picks can block. The size of the
    pool depends on languages and quotas only, never on the table.
    """

    def best(rows: DataFrame, by: list, count: int) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*by).orderBy("place"))
        return rows.withColumn("__n", place).where(F.col("__n") <= count).drop("__n")

    spark = scored.sparkSession
    fields = ["slot", "quota", "name", "mainLanguage", "guideline_status", "difficulty_score", "sampling_stratum", "difficulty_reason"]
    pairs = scored.groupBy("slot", "owner", "project").agg(F.min_by(F.struct(*fields[1:], "place"), "place").alias("best"))
    pool = pairs.select("slot", "owner", "project", "best.*")
    # Spark limits small ranks before it moves rows; the rank in a slot may be too large for that, so it is salted first.
    pool = best(best(pool, ["slot", "owner"], total), ["slot", "project"], total)
    salt = F.pmod(F.xxhash64("name"), F.lit(wide_partitions(spark)))
    reach = 2 * total * total + 1
    pool = best(best(pool.withColumn("__salt", salt), ["slot", "__salt"], reach), ["slot"], reach).drop("__salt")
    # Of bounded size, so that one partition serves all windows of a round.
    pool = materialize(pool.repartition(1)).coalesce(1)
    picks = materialize(pool.limit(0).select(*fields, "owner", "project"))
    done = 0
    for _ in range(total):
        filled = picks.groupBy("slot").agg(F.count("*").alias("__picked"))
        # One row per case and per slot.
        left = (
            pool.join(F.broadcast(picks.select("owner")), "owner", "left_anti")
            .join(F.broadcast(picks.select("project")), "project", "left_anti")
            .join(F.broadcast(filled), "slot", "left")
            .withColumn("__left", F.col("quota") - F.coalesce("__picked", F.lit(0)))
            .where("__left > 0")
        )
        sure = (F.col("place") == F.min("place").over(Window.partitionBy("owner"))) & (
            F.col("place") == F.min("place").over(Window.partitionBy("project"))
        )
        run = Window.partitionBy("slot").orderBy("place")
        found = materialize(
            left.withColumn("__unsure", (~sure).cast("int"))
            .withColumn("__before", F.sum("__unsure").over(run))
            .withColumn("__n", F.row_number().over(run))
            .where("__before = 0 and __n <= __left")
            .select(*picks.columns)
        )
        count = found.count()
        picks = picks.unionByName(found)
        done += count
        if count == 0 or done == total:
            break
    return picks, done


def without_prior_labels(rows: DataFrame) -> DataFrame:
    """Drop every column that would reveal the earlier label."""
    return rows.drop(*PRIOR_LABEL_COLUMNS)
