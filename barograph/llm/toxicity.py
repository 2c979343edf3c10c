"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Fitting takes a bounded sample of the labelled rows in three disjoint parts: one
gives the lexicon (words and word beginnings that toxic texts have and others
lack), one the trees, one the calibration. Scoring reads every whole text.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm.common import id_and_text, load, per_batch, query, row_key, stored

#: Labelled rows used for fitting, about; chosen by a hash of their id.
SAMPLE_ROWS = 30_000
#: Entries of the lexicon and the evidence each one needs (a G statistic).
LEXICON_SIZE = 5_000
LEAST_EVIDENCE = 20.0
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
NEAR = 5  # words between a second-person word and an entry of the lexicon
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu toi te ton ta vous votre "
                          "tú ti usted ustedes vosotros".split())
#: Look-alike characters, as fixed values.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i",
                            "*": "", ".": "", "-": "", "_": ""})
FEATURES = ("words", "hits", "strongest", "top_three", "density", "strong_density", "near_second_person",
            "second_person", "capitals", "capital_words", "punctuation", "exclamations", "questions", "symbols",
            "digits", "obfuscated", "obfuscated_hits", "spaced_letters", "long_runs", "distinct")
_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"[^\W\d_]+(?:[0-9@$!*.\-_]+[^\W\d_]+)+")
_SPACED = re.compile(r"(?:\b[^\W\d_][ .\-*]){3,}[^\W\d_]\b")
_CAPITAL = re.compile("[A-ZÀ-ÖØ-Þ]")
_CAPITAL_WORD = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b")


def tokens_of(word: str) -> list[str]:
    """A word and its beginnings, the latter marked by a final hyphen."""
    return [word, *[word[:n] + "-" for n in PREFIXES if len(word) > n]]


class Weights(dict):
    """Weight of a word: the largest of its own and its beginnings' in the lexicon."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        if len(self) >= 500_000:
            self.clear()
        weight = max(self.lexicon.get(token, 0.0) for token in tokens_of(word))
        self[word] = weight
        return weight


def describe(text: str | None, weights: Weights) -> list[float]:
    """The dense features of one whole text; all zero for a null or empty one."""
    if not text:
        return [0.0] * len(FEATURES)
    lowered = text.lower()
    words = _WORD.findall(lowered)
    n, size = max(1, len(words)), len(text)
    found = np.fromiter(map(weights.__getitem__, words), np.float64, len(words))
    at = np.flatnonzero(found)
    top = np.sort(found[at])[::-1]
    people = [i for i, word in enumerate(words) if word in SECOND_PERSON]
    near = 0
    if people and len(at):
        gap = np.searchsorted(at, people)
        for i, k in zip(people, gap.tolist()):
            near += any(0 <= j < len(at) and abs(int(at[j]) - i) <= NEAR for j in (k - 1, k))
    letters = sum(map(len, words))
    tokens = lowered.split()
    # Most tokens are plain words; the patterns look at the others only.
    odd = (token.strip(".,;:!?'\"()#%&") for token in set(tokens) if not token.isalpha())
    mixed = [token for token in odd if not token.isalpha() and _MIXED.fullmatch(token)]
    single = sum(1 for token in tokens if len(token) == 1)
    plain = sum(1 for word in mixed if weights[word.translate(LOOKALIKES)] > 0)
    marks = {c: text.count(c) for c in ".,;:!?'\"()"}
    symbols = sum(text.count(c) for c in "#$%&*@^~+=<>|\\")
    digits = sum(text.count(c) for c in "0123456789")
    return [
        math.log1p(len(words)), math.log1p(len(at)), float(top[0]) if len(top) else 0.0, float(top[:3].sum()),
        float(found.sum()) / n, float((found >= 3).sum()) / n, near / n, len(people) / n,
        len(_CAPITAL.findall(text)) / max(1, letters),
        len(_CAPITAL_WORD.findall(text)) / n, sum(marks.values()) / size, marks["!"] / size, marks["?"] / size,
        symbols / size, digits / size, len(mixed) / n, float(plain), len(_SPACED.findall(lowered)) / n if single >= 4 else 0.0,
        _long_runs(text) / n, len(set(words)) / n]


def _long_runs(text: str) -> int:
    """Places where one character stands four times in a row, white space aside."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    same = (codes[1:] == codes[:-1]) & (codes[1:] > 32)
    return int((same[2:] & same[1:-1] & same[:-2]).sum())


def learn_lexicon(texts: DataFrame) -> dict[str, float]:
    """Log odds of the tokens with most evidence for toxicity; ``texts`` has ``text, toxic``."""
    def count(batch):
        seen: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = {token for word in set(_WORD.findall((text or "").lower())) for token in tokens_of(word)}
            for token in own:
                seen.setdefault(token, [0, 0])[toxic] += 1
        return {"token": list(seen), "clean": [n for n, _ in seen.values()], "toxic": [n for _, n in seen.values()]}

    counted = per_batch(texts.select("text", "toxic"), count, "token string, clean bigint, toxic bigint").groupBy(
        "token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sizes = dict(texts.groupBy("toxic").count().collect())
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        return {}
    share = toxic / (clean + toxic)
    n = F.col("clean") + F.col("toxic")
    part = lambda k, p: F.when(F.col(k) > 0, F.col(k) * F.log(F.col(k) / (n * p))).otherwise(0.0)
    rows = (counted.withColumn("g", 2 * (part("toxic", share) + part("clean", 1 - share)))
            .where((F.col("toxic") > n * share) & (F.col("toxic") >= 4) & (F.col("g") >= LEAST_EVIDENCE))
            .orderBy(F.desc("g"), "token").limit(LEXICON_SIZE).collect())
    return {r.token: max(0.0, math.log((r.toxic + 0.5) / (toxic + 1)) - math.log((r.clean + 0.5) / (clean + 1)))
            for r in rows}


def feature_table(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``doc_id, features`` of every row, and its ``_row_key`` where ``docs`` has one."""
    key = [name for name in docs.columns if name == "_row_key"]
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    memory: list[Weights] = []

    def run(batch):
        if not memory:
            memory.append(Weights(shared.value))
        return {"doc_id": batch.column(0), **{name: batch.column(2) for name in key},
                "features": [describe(text, memory[0]) for text in batch.column(1).to_pylist()]}

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", "text", *key), run, ", ".join(
        [f"doc_id {id_type}", *[f"{name} string" for name in key], "features array<double>"]))


def labelled_sample(labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``rows`` labels, chosen by a hash of the id, with the part each is used for.

    Rows with a null id or label are left out; of an id labelled both ways the
    toxic label counts.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    share = int(min(1.0, rows / max(1, known.count())) * (1 << 20))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    return known.where(F.pmod(place, F.lit(1 << 20)) < share).withColumn(
        "part", F.pmod(F.shiftright(place, 20), F.lit(5)))


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, score`` of every row; ``labels`` has ``doc_id, toxic`` of the rows to learn from.

    A ``_row_key`` in ``docs`` comes along.

    Where labels of one class only, or none, are left for fitting, the score is
    0. Rows with equal ids are scored one by one. Null and empty texts get the
    score of a text without any hit. Texts of any length are scored whole. Only
    ``doc_id`` and ``text`` of ``docs`` are read, whatever its other columns,
    and an empty table gives no rows.
    """
    key = [name for name in docs.columns if name == "_row_key"]
    # At most about SAMPLE_ROWS rows of three numbers: under a megabyte.
    sample = F.broadcast(stored(labelled_sample(labels, sample_rows), "labelled"))
    texts = stored(docs.join(sample, "doc_id").select("text", "toxic", "part"), "labelled-texts")
    lexicon = learn_lexicon(texts.where("part < 3"))
    table = stored(feature_table(docs, lexicon), "toxicity-features")
    vectors = table.withColumn("vector", array_to_vector("features"))
    fitted = stored(table.join(sample, "doc_id").where("part >= 3").select("features", "toxic", "part"), "fit-features")
    rows = fitted.withColumn("vector", array_to_vector("features")).withColumn("label", F.col("toxic").cast("double"))
    classes = {(r.part, r.toxic) for r in rows.select("part", "toxic").distinct().collect()}
    if not {(p, t) for p in (3, 4) for t in (0, 1)} <= classes:
        return docs.select("doc_id", *key, F.lit(0.0).alias("score"))
    trees = GBTClassifier(featuresCol="vector", labelCol="label", predictionCol="side", maxIter=20, maxDepth=3, stepSize=0.2, seed=7, maxMemoryInMB=64)
    model = trees.fit(rows.where("part = 3").coalesce(4))
    chance = vector_to_array("probability")[1]
    held = model.transform(rows.where("part = 4")).select("label", chance.alias("chance"))
    steps = IsotonicRegression(featuresCol="chance", labelCol="label", predictionCol="score").fit(held)
    scored = model.transform(vectors).select("doc_id", *key, chance.alias("chance"))
    return steps.transform(scored).select(
        "doc_id", *key, F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0)).alias("score"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` scored below ``threshold``; all columns stay.

    Each row is decided by its own text, also where ids are null or repeated or
    the text is null, empty or very long. An empty table stays empty.
    """
    keyed = docs.select("doc_id", "text", row_key(docs).alias("_row_key"))
    scores = stored(toxicity_scores(keyed, labels), "toxicity-scores")
    toxic = scores.where(F.col("score") >= threshold).select("_row_key").distinct()
    return docs.join(toxic, row_key(docs) == F.col("_row_key"), "left_anti")


def remainder(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = load(spark, sf_dir, "labels").where(remainder(F.col("doc_id")) != 1)
    scores = toxicity_scores(id_and_text(load(spark, sf_dir, "documents")), labels)
    return scores.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
