"""Secret scan: wide candidates, and a random forest that removes false positives.

A candidate is a private-key block, any value assigned to a name such as
``password`` (quoted, or up to white space), a token of dotted parts, or a run of
at least twelve letters, digits and ``+/_-`` with a digit in it. The forest sees its length, character transitions, dictionary coverage,
path and neighbouring words. All steps are DataFrame operations and Spark ML on
the JVM.

The labelled findings it learns from are a parameter. ``seed_findings`` makes
them from the candidates themselves: a candidate in a provider's format, or
assigned to a name such as ``password``, is a secret; digits alone, file paths,
UUIDs and words are not; other candidates get no label.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm.common import id_and_text, load, query, stored
from barograph.session import scratch_path

CONTEXT = 48  # characters kept on either side
#: Labelled findings used for fitting, about; chosen by a hash.
SAMPLE_FINDINGS = 20_000
THRESHOLD = 0.5
MASK = "[SECRET]"
#: Fixed word lists: names that secrets are assigned to, words beside harmless values, and a small dictionary.
SECRET_NAMES = "password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential|private[_-]?key"
#: What stands between a name and its value, of bounded length.
ASSIGN = r"[\"']?\s{0,3}[=:]{1,2}\s{0,3}[\"']?"
PRIVATE_KEY = r"-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----"
_ASSIGNED = rf"(?<=[=:\s\"'])(?<=[=:]\s{{0,3}}[\"']?)(?<=(?i:{SECRET_NAMES}){ASSIGN})"
CANDIDATE = "|".join((
    PRIVATE_KEY,
    _ASSIGNED + r"(?:(?<=\")[^\"\r\n]*[\p{L}\p{N}][^\"\r\n]*(?=\")|(?<=')[^'\r\n]*[\p{L}\p{N}][^'\r\n]*(?=')|"
    r"(?=\S*[\p{L}\p{N}])[^\s\"'=](?:\S*[^\s.,;:)\]}\"'<>])?)",
    r"(?<![A-Za-z0-9+/_\-.])(?:eyJ[A-Za-z0-9_\-]{5,}\.[A-Za-z0-9_\-]{5,}(?:\.[A-Za-z0-9_\-]+){0,3}|"
    r"(?=[A-Za-z_\-.]*[0-9])[A-Za-z0-9_\-]{2,}(?:\.[A-Za-z0-9_\-]{6,}){2,4})(?![A-Za-z0-9+/_\-])",
    r"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{12,}={0,2}"))
HARMLESS_NAMES = "example|sample|dummy|placeholder|commit|checksum|sha1|sha256|md5|uuid|order|invoice|card|phone|isbn|page|id"
DICTIONARY = ("about|account|after|again|also|and|apple|are|article|because|been|book|build|but|can|change|city|class|"
              "code|come|company|config|content|data|date|day|default|do|document|error|even|event|example|file|find|"
              "first|for|from|get|give|go|good|group|have|he|her|home|html|http|image|index|info|into|is|it|item|just|"
              "key|know|language|like|line|list|local|long|look|main|make|many|message|more|name|new|no|not|number|of|"
              "on|one|only|open|option|or|order|other|out|page|part|people|place|point|post|product|program|public|"
              "read|report|right|sample|say|search|see|service|set|she|site|so|some|source|start|state|string|system|"
              "table|take|test|text|than|that|the|their|them|then|there|they|thing|think|this|time|title|to|type|up|"
              "url|use|user|value|version|very|view|want|was|way|we|web|week|well|what|when|which|who|will|with|word|"
              "work|world|would|www|year|you|your")
FORMATS = (r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abprs]-[A-Za-z0-9\-]{10,}$|"
           r"^sk[-_](live[-_]|test[-_])?[A-Za-z0-9]{16,}$|^AIza[A-Za-z0-9_\-]{35}$|^glpat-[A-Za-z0-9_\-]{20}$|"
           r"^eyJ[A-Za-z0-9_\-]{5,}\.[A-Za-z0-9_\-]{5,}(\.[A-Za-z0-9_\-]+){0,3}$|^-----BEGIN [A-Z ]*PRIVATE KEY-----")
#: Strict rule for secrets; a bare word after a colon may be prose and stays undecided.
SEED_SECRET = "provider = 1 OR (named = 1 AND assigned = 1 AND numeric = 0 AND bare_word = 0)"
UUID = r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"
FEATURES = ("length", "distinct", "letter_digit", "digit_letter", "case_changes", "vowel_pairs", "digits", "capitals",
            "hex", "numeric", "separators", "coverage", "in_path", "has_extension", "provider", "named", "assigned",
            "quoted", "harmless", "sentence_after")


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, number, candidate, before, after``: one row per candidate of a text.

    ``number`` counts the candidates of a text from 0; ``text_key`` tells rows
    with equal ids and different texts apart. Null and empty texts have none.
    """
    split = docs.where("text IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("text_key"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"),
        F.split("text", CANDIDATE, -1).alias("between")).where("size(found) > 0")
    beside = F.transform("found", lambda c, i: F.struct(
        c.alias("candidate"),
        # The candidate before may hold the name that this one is assigned to.
        F.right(F.concat(F.coalesce(F.get("found", i - 1), F.lit("")), F.get("between", i)), F.lit(CONTEXT)).alias("before"),
        F.left(F.get("between", i + 1), F.lit(CONTEXT)).alias("after")))
    return split.select("doc_id", "text_key", F.posexplode(beside).alias("number", "c")).select(
        "doc_id", "text_key", "number", "c.candidate", "c.before", "c.after")


def _matches(column, pattern):
    return F.coalesce(F.regexp_like(column, F.lit(pattern)), F.lit(False)).cast("double")


def with_features(found: DataFrame) -> DataFrame:
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    length = F.length(c)
    count = lambda pattern: F.regexp_count(c, F.lit(pattern)) / length
    covered = length - F.length(F.regexp_replace(F.lower(c), f"({DICTIONARY})", ""))
    return found.withColumns({
        "length": length.cast("double"),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / length,
        "letter_digit": count("(?<=[A-Za-z])[0-9]"), "digit_letter": count("(?<=[0-9])[A-Za-z]"),
        "case_changes": count("(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]"),
        "vowel_pairs": count("(?i)(?<=[aeiou])[bcdfghjklmnpqrstvwxyz]|(?<=[bcdfghjklmnpqrstvwxyz])[aeiou]"),
        "digits": count("[0-9]"), "capitals": count("[A-Z]"),
        "hex": _matches(c, "^[0-9a-fA-F]+$"), "numeric": _matches(c, "^[0-9]+$"),
        "separators": count("[/_\\-+]"), "coverage": covered / length,
        "in_path": _matches(before, r"(://|/)[^\s]*$"),
        "has_extension": _matches(after, r"^\.[A-Za-z]{2,4}\b"),
        "provider": _matches(c, FORMATS),
        "named": _matches(before, f"(?i)({SECRET_NAMES})[^A-Za-z0-9]{{0,10}}$"),
        "assigned": _matches(before, "[=:]\\s*[\"']?$"),
        "bare_word": _matches(c, "^[A-Za-z]+$") * _matches(before, ":\\s+$"),
        "quoted": _matches(F.concat(F.right(before, F.lit(1)), F.left(after, F.lit(1))), "^(\"\"|'')$"),
        "harmless": _matches(before, f"(?i)\\b({HARMLESS_NAMES})[^A-Za-z0-9]{{0,6}}$"),
        "sentence_after": _matches(after, r"^[.,;]?\s"),
    })


def seed_findings(described: DataFrame) -> DataFrame:
    """Labelled findings from the candidates that strict rules decide."""
    harmless = f"numeric = 1 OR in_path = 1 OR coverage >= 0.6 OR harmless = 1 OR regexp_like(candidate, '{UUID}')"
    return described.withColumn("label", F.expr(
        f"CASE WHEN {SEED_SECRET} THEN 1.0D WHEN {harmless} THEN 0.0D END")).where("label IS NOT NULL")


def fit_forest(findings: DataFrame, rows: int = SAMPLE_FINDINGS):
    """Forest over about ``rows`` labelled findings; None unless both labels occur."""
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="vector")
    total = findings.count()
    share = int(min(1.0, rows / max(1, total)) * (1 << 20))
    key = F.pmod(F.xxhash64("candidate", "before", "after"), F.lit(1 << 20))
    sample = stored(findings.where(key < share).select(*FEATURES, "label"), "labelled-findings")
    if sample.select("label").distinct().count() < 2:
        return assembler, None
    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=20, maxDepth=5, seed=11,
                                    subsamplingRate=0.7, featureSubsetStrategy="onethird", maxMemoryInMB=64)
    # A fitted forest holds its session, which cannot be sent to tasks; one read back does not.
    path = scratch_path(sample.sparkSession, "forest")
    forest.fit(assembler.transform(sample).coalesce(4)).write().save(path)
    return assembler, RandomForestClassificationModel.load(path)


def scan(docs: DataFrame, findings: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, text_key, number, candidate, length, score, secret`` of every candidate.

    ``findings`` are labelled candidates with ``candidate, before, after, label``;
    without them the seeds are used. If all labels are equal the seed rules
    decide. Repeated rows are scanned one by one; an empty table has no findings.
    """
    described = stored(with_features(candidates(docs)), "secret-candidates")
    labelled = seed_findings(described) if findings is None else with_features(findings)
    assembler, forest = fit_forest(labelled)
    if forest is None:
        chance = F.expr(f"CASE WHEN {SEED_SECRET} THEN 1.0D ELSE 0.0D END")
        scored = described.withColumn("score", chance)
    else:
        scored = forest.transform(assembler.transform(described)).withColumn(
            "score", vector_to_array("probability")[1])
    return scored.select("doc_id", "text_key", "number", "candidate", F.col("length").cast("int").alias("length"),
                         "score", (F.col("score") >= threshold).alias("secret"))


def mask_secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every confirmed secret in ``text`` replaced by a mask; all rows and columns stay."""
    secrets = stored(scan(id_and_text(docs), threshold=threshold).where("secret").groupBy("doc_id", "text_key").agg(
        F.collect_set("number").alias("secret_numbers")).withColumnsRenamed(
            {"doc_id": "secret_doc_id", "text_key": "secret_text_key"}), "secrets")
    found = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    between = F.split("text", CANDIDATE, -1)
    shown = F.transform(found, lambda c, i: F.when(F.array_contains("secret_numbers", i), MASK).otherwise(c))
    masked = F.array_join(F.flatten(F.zip_with(
        between, F.concat(shown, F.array(F.lit(""))), lambda a, b: F.array(a, b))), "")
    same = F.col("doc_id").eqNullSafe(F.col("secret_doc_id")) & (F.xxhash64("text") == F.col("secret_text_key"))
    return docs.join(secrets, same, "left").withColumn(
        "text", F.when(F.col("secret_numbers").isNull(), F.col("text")).otherwise(masked)).select(*docs.columns)


@query()
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(id_and_text(load(spark, sf_dir, "documents")))
    return found.select("doc_id", "number", "length", F.sha2("candidate", 256).alias("candidate_sha256"),
                        "score", "secret")
