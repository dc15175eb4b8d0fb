"""Licence families of documents, by a paragraph classifier and template comparison.

Paragraphs are separated by lines without letters and digits, so that comment
marks count as blank; wrapped notices are whole in them. Their lines are looked
at alone too, for notices inside other text. Features are the word n-grams (one
to three words) that occur in licence notices; a sparse multinomial logistic regression, fitted
on notices, on texts that only talk about licences, and on ordinary lines,
gives each family and the unknown class a score, whose sharpness is calibrated
on notices that were held out of a first fit.

A paragraph can hold several notices, so each family likelier than the unknown
class is a prediction. It stands only if the paragraph holds most word pairs of
one of its notices and most of those that few families have, all its numbers
with the words before them, and half of what tells the notice from each similar
one of another family: Apache 1.1 is not 2.0, and a GPL is neither an AGPL nor
an LGPL. Where a grant is denied ("is not licensed under"), the sentences of the
paragraph are judged alone, and those that deny grant nothing.

Only paragraphs with one of a few words of the notices are scored. The words are
chosen so that what holds none of them cannot hold enough word pairs of any
notice: this saves work and loses nothing.

Everything that touches rows is built-in Spark functions. Paragraphs are scored
once per distinct text, as the same notice stands in very many documents; the
tables joined by broadcast come from the fixed notices.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm.licence_templates import CUES, DENIALS, GRANTS, TEMPLATES, UNKNOWN
from candlemill.session import stage

UNKNOWN_CLASS = "unknown"
# Documents whose ordinary lines teach the unknown class, chosen by hash of the key.
TRAIN_DOCUMENTS = 300
LEAST_PROBABILITY = 0.5
LEAST_SHARED = 0.6
_WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
# From the end of a line over lines without letters and digits.
_BREAK = r"\n[^\p{L}\p{N}]*\n"
# Marks of comments that look like words.
_MARKS = r"(?m)^[ \t]*(?:@?REM|@?rem|dnl|C)[ \t]"
# Ends of sentences; dots inside numbers are none.
_SENTENCE = r"[.!?](?=\s|$)"
# Each notice of this many is held out of the fit that calibration uses.
_FOLDS = 3
_TEMPERATURES = (0.125, 0.25, 0.5, 1.0, 2.0)


def _table(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A small table of text and numbers, as a local relation of the plan."""

    def cell(value: str | float) -> str:
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"{float(value)!r}D"

    values = ", ".join("(" + ", ".join(map(cell, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def words(text: str | Column) -> Column:
    """Lower-case words; dots and hyphens inside a word belong to it."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(column), F.lit(_WORD), F.lit(0))


def ngrams(words_: Column, least: int = 1, most: int = 3) -> Column:
    """Distinct runs of ``least`` to ``most`` words, joined by spaces."""
    n = F.size(words_)

    def of(k: int) -> Column:
        starts = F.when(n >= k, F.sequence(F.lit(1), n - k + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(words_, i, k), " "))

    return F.array_distinct(F.flatten(F.array(*[of(k) for k in range(least, most + 1)])))


def has_cue(text: str | Column, cues: Sequence[str] = CUES) -> Column:
    """Whether ``text`` holds one of ``cues``; it is lower-cased once."""

    def any_of(low: Column) -> Column:
        found = F.lit(False)
        for cue in cues:
            found = found | F.contains(low, F.lit(cue))
        return found

    return F.coalesce(F.exists(F.array(F.lower(text)), any_of), F.lit(False))


def pairs_of(notice: str) -> set[tuple[str, str]]:
    """Word pairs of a notice, as ``words`` and ``ngrams`` make them."""
    found = re.findall(_WORD, notice.lower())
    return set(zip(found, found[1:], strict=False))


def covering_words(cues: Sequence[str] = CUES) -> tuple[str, ...]:
    """``cues`` and more words, so that no text without any of them can be confirmed.

    A confirmed text holds at least ``LEAST_SHARED`` of the pairs of a notice.
    As long as so many pairs of a notice hold none of the words, another word
    of those pairs is added: one with a digit and two more
    characters, or else a long one, as they are rare.
    """
    chosen = list(cues)
    for notice in (t for _, texts in sorted(TEMPLATES.items()) for t in texts):
        pairs = pairs_of(notice)
        while True:
            free = [p for p in pairs if not any(c in w for c in chosen for w in p)]
            if len(free) < LEAST_SHARED * len(pairs):
                break
            rarest = lambda w: (len(w) > 2 and any(x.isdigit() for x in w), len(w), w)
            chosen.append(max({w for p in free for w in p}, key=rarest))
    return tuple(chosen)


COVER = covering_words()


def named(paragraphs: DataFrame) -> DataFrame:
    """Add ``id``, a hash of ``words`` that goes through joins instead of them."""
    return paragraphs.withColumn("id", F.md5(F.array_join("words", " ").cast("binary")))


@dataclass(frozen=True)
class Model:
    """Classes, their scores without features and by n-gram, and the temperature."""

    classes: tuple[str, ...]
    intercepts: tuple[float, ...]
    weights: dict[str, tuple[float, ...]]
    temperature: float


def _with_probabilities(scored: DataFrame, temperature: Column) -> DataFrame:
    """Add ``p``, the probabilities of the classes, to rows with ``scores``."""
    top = F.array_max("scores")
    powers = F.transform("scores", lambda s: F.exp((s - top) / temperature))
    whole = F.aggregate("powers", F.lit(0.0), lambda a, x: a + x)
    return (
        scored.withColumn("powers", powers)
        .withColumn("whole", whole)
        .withColumn("p", F.transform("powers", lambda x: x / F.col("whole")))
        .drop("powers", "whole", "scores")
    )


def _scored(paragraphs: DataFrame, model: Model) -> DataFrame:
    """Add ``scores``, one per class, to rows with distinct ``id``; drops ``words``."""
    k = len(model.classes)
    names = [f"s{i}" for i in range(k)]
    if not model.weights:
        return paragraphs.drop("words").withColumn(
            "scores", F.array(*map(F.lit, model.intercepts))
        )
    rows = [(g, *w) for g, w in sorted(model.weights.items())]
    table = _table(paragraphs.sparkSession, rows, ["gram", *names])
    found = (
        paragraphs.select("id", F.explode(ngrams(F.col("words"))).alias("gram"))
        .join(F.broadcast(table), "gram")
        .groupBy("id")
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    sums = [F.coalesce(n, F.lit(0.0)) + b for n, b in zip(names, model.intercepts)]
    return (
        paragraphs.drop("words")
        .join(found, "id", "left")
        .withColumn("scores", F.array(*sums))
        .drop(*names)
    )


def fit(
    df: DataFrame, key: str = "doc_id", text: str = "text", limit: int = TRAIN_DOCUMENTS
) -> Model:
    """Train on the notices, and on lines without cues of at most ``limit`` documents.

    An empty table or one without text leaves the fixed texts alone to learn
    from.
    """
    spark = df.sparkSession
    classes = (UNKNOWN_CLASS, *sorted(TEMPLATES))
    notices = [(t, float(classes.index(f))) for f, texts in TEMPLATES.items() for t in texts]
    notices += [(t, 0.0) for t in UNKNOWN]
    texts = df.where(F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text")
    )
    # Keys alone are ordered; at most ``limit`` of them go to the scan of the texts.
    chosen = texts.select("key").orderBy(F.xxhash64("key"), "key").limit(limit).distinct()
    sample = (
        texts.join(F.broadcast(chosen), "key")
        .select(F.explode(F.split("text", "\n")).alias("line"))
        .where(~has_cue(F.col("line")))
        .distinct()
        .select("line", F.lit(0.0).alias("label"))
    )
    training = stage(
        sample.select("label", ngrams(words("line")).alias("grams")), "licence-lines"
    )
    model = _fitted(notices, training, classes)
    taught = [x for i, x in enumerate(notices) if i % _FOLDS]
    held = [x for i, x in enumerate(notices) if not i % _FOLDS]
    return replace(model, temperature=_calibrated(spark, held, _fitted(taught, training, classes)))


def _notice_grams(notices: Sequence[tuple[str, float]]) -> tuple[str, ...]:
    """The n-grams of the notices that are of a family, in order."""
    found = set()
    for notice in (n for n, label in notices if label):
        own = re.findall(_WORD, notice.lower())
        found.update(" ".join(own[i : i + k]) for k in (1, 2, 3) for i in range(len(own) - k + 1))
    return tuple(sorted(found))


def _fitted(
    notices: Sequence[tuple[str, float]], sample: DataFrame, classes: Sequence[str]
) -> Model:
    """A model from ``notices`` and ``sample``, the n-grams of ordinary lines."""
    spark = sample.sparkSession
    vocabulary = _notice_grams(notices)
    # A line that is long or has other words around the notice still counts.
    framed = [(f.format(t), label) for t, label in notices for f in ("this project is {} thank you", "{}")]
    examples = _table(spark, framed, ["line", "label"]).select(
        "label", ngrams(words("line")).alias("grams")
    )
    known = F.split(F.lit("\n".join(vocabulary)), "\n")
    # Rows that agree in all features are one, with their number as weight.
    rows = (
        examples.union(sample.select("label", "grams"))
        .select("label", F.sort_array(F.array_intersect("grams", known)).alias("grams"))
        .groupBy("label", "grams")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    train = stage(rows, "licence-train")
    counter = CountVectorizerModel.from_vocabulary(list(vocabulary), "grams", "features", binary=True)
    fitted = LogisticRegression(
        family="multinomial", weightCol="weight", regParam=0.002, elasticNetParam=0.5, maxIter=60
    ).fit(counter.transform(train).select("label", "features", "weight"))
    coefficients = fitted.coefficientMatrix.toArray()
    weights = {
        gram: tuple(float(x) for x in coefficients[:, i])
        for i, gram in enumerate(vocabulary)
        if any(abs(x) > 1e-9 for x in coefficients[:, i])
    }
    return Model(tuple(classes), tuple(float(x) for x in fitted.interceptVector), weights, 1.0)


def _calibrated(spark: SparkSession, held: Sequence[tuple[str, float]], model: Model) -> float:
    """The temperature with the least log loss on notices that ``model`` has not seen."""
    fixed = _table(spark, held, ["line", "label"])
    scored = _scored(named(fixed.select(words("line").alias("words"), "label")), model)
    tried = scored.withColumn("t", F.explode(F.array(*map(F.lit, _TEMPERATURES))))
    own = F.get("p", F.col("label").cast("int"))
    losses = (
        _with_probabilities(tried, F.col("t"))
        .groupBy("t")
        .agg(F.avg(-F.log(F.greatest(own, F.lit(1e-12)))).alias("loss"))
    )
    return losses.orderBy("loss", "t").first()["t"]


@dataclass(frozen=True)
class Demand:
    """Word pairs of a notice of which a text has to hold ``least`` or more."""

    pairs: frozenset[tuple[str, str]]
    least: int


def _has_digit(word: str) -> bool:
    return any(c.isdigit() for c in word)


def demands(templates: Mapping[str, Sequence[str]] = TEMPLATES) -> dict[tuple[str, str], list[Demand]]:
    """What confirms each (family, notice): first most of its pairs, then what is its own.

    That is more than half of the pairs that most families lack, all numbers,
    and half of what a similar notice of another family lacks.
    """
    pairs = {(f, n): frozenset(pairs_of(n)) for f, texts in templates.items() for n in texts}
    holders: dict[tuple[str, str], set[str]] = {}
    for (family, _), own in pairs.items():
        for pair in own:
            holders.setdefault(pair, set()).add(family)
    found = {}
    for (family, notice), own in pairs.items():
        wanted = [Demand(own, math.ceil(LEAST_SHARED * len(own)))]
        named_by = frozenset(p for p in own if 2 * len(holders[p]) <= len(templates))
        wanted.append(Demand(named_by, len(named_by) // 2 + 1))
        numbers = frozenset(p for p in own if _has_digit(p[1]))
        if numbers:
            wanted.append(Demand(numbers, len(numbers)))
        ours = {other for (f, _), other in pairs.items() if f == family}
        alike = {
            other
            for other in set(pairs.values()) - ours
            if len(own & other) >= LEAST_SHARED * max(len(own), len(other))
        }
        apart = {frozenset(p for p in own - other if not any(map(_has_digit, p))) for other in alike}
        wanted += [Demand(d, -(-len(d) // 2)) for d in sorted(apart, key=sorted) if d]
        found[family, notice] = wanted
    return found


def _demand_table(spark: SparkSession) -> DataFrame:
    """``demands`` with a row per pair: guess, notice, n_demands, demand (0: most pairs), size,
    least, gram."""
    rows = [
        (family, float(i), float(len(wanted)), float(d), float(len(demand.pairs)), float(demand.least),
         " ".join(pair))
        for i, ((family, _), wanted) in enumerate(sorted(demands().items()))
        for d, demand in enumerate(wanted)
        for pair in sorted(demand.pairs)
    ]
    return _table(spark, rows, ["guess", "notice", "n_demands", "demand", "size", "least", "gram"])


def classify(paragraphs: DataFrame, model: Model) -> DataFrame:
    """``id``, family, probability and shared (with the family's closest notice).

    ``paragraphs`` has ``words`` and their distinct ``id``. One row per family
    that is likely enough and confirmed by a notice; ``probability`` is that of
    the family if it is either that or the unknown class.
    """
    scored = _scored(paragraphs.select("id", "words"), model)
    names = F.array(*[F.lit(c) for c in model.classes])
    unknown = F.get("scores", F.lit(0))

    def chance(score: Column, place: Column) -> Column:
        odds = F.exp((unknown - score) / F.lit(model.temperature))
        return F.struct(F.get(names, place).alias("guess"), (1 / (1 + odds)).alias("probability"))

    likely = F.filter(
        F.transform("scores", chance),
        lambda c: (c["guess"] != UNKNOWN_CLASS) & (c["probability"] >= LEAST_PROBABILITY),
    )
    guessed = scored.select("id", likely.alias("guesses")).where(F.size("guesses") > 0)
    held = (
        guessed.join(paragraphs.select("id", "words"), "id")
        .select("id", "guesses", F.explode(ngrams(F.col("words"), 2, 2)).alias("gram"))
        .join(F.broadcast(_demand_table(paragraphs.sparkSession)), "gram")
        .withColumn("own", F.filter("guesses", lambda c: c["guess"] == F.col("guess")))
        .where(F.size("own") > 0)
        .groupBy("id", "guess", "notice", "n_demands", "demand", "size", "least")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.get("own", F.lit(0))["probability"]).alias("probability"))
        .where(F.col("n") >= F.col("least"))
        .groupBy("id", "guess", "notice", "n_demands")
        .agg(
            F.count(F.lit(1)).alias("met"),
            F.max(F.when(F.col("demand") == 0, F.col("n") / F.col("size"))).alias("shared"),
            F.max("probability").alias("probability"),
        )
        .where(F.col("met") == F.col("n_demands"))
    )
    return held.groupBy("id", F.col("guess").alias("family")).agg(
        F.max("probability").alias("probability"), F.max("shared").alias("shared")
    )


def denies(words_: Column) -> Column:
    """Whether a word that denies stands right before a verb of granting."""
    denials = F.array(*[F.lit(f"{d} {g}") for d in DENIALS for g in GRANTS])
    some = F.arrays_overlap(words_, F.array(*map(F.lit, DENIALS)))
    return some & F.arrays_overlap(ngrams(words_, 2, 2), denials)


def scan(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Paragraphs that may hold a notice, and their lines: key, row, paragraph (from 0),
    line, cue, family, probability, shared.

    ``line`` is a whole paragraph or, in one of several lines, a line of it, or
    a sentence of one that denies a grant; each family found in it has a row.
    ``row`` tells rows with equal keys apart; ``cue`` says whether the line has
    one of ``CUES``. Null and empty texts have no paragraphs; a paragraph of any
    length is read whole. An empty table gives an empty result.
    """
    body = F.regexp_replace(F.col(f"`{text}`"), r"\r\n?", "\n")
    lines = F.split("body", "\n")
    both = F.concat(F.array("body"), F.filter(lines, lambda x: has_cue(x, COVER)))
    units = (
        df.where(has_cue(F.col(f"`{text}`"), COVER))
        .select(
            F.col(f"`{key}`").alias("key"),
            F.monotonically_increasing_id().alias("row"),
            F.posexplode(F.split(body, _BREAK)).alias("at", "body"),
        )
        .where(has_cue("body", COVER))
        .select(
            "key",
            "row",
            "at",
            F.explode(F.when(F.size(lines) > 1, both).otherwise(F.array("body"))).alias("line"),
        )
    )
    found = _words_of(units).withColumn("denied", denies(F.col("words")))
    # What denies grants nothing as a whole, but its sentences may.
    sentences = F.concat(F.array("line"), F.split("line", _SENTENCE))
    units = (
        found.withColumn("line", F.explode(F.when(F.col("denied"), sentences).otherwise(F.array("line"))))
        .transform(lambda rows: _words_of(rows.drop("words", "denied")))
        .withColumn("words", F.when(denies(F.col("words")), F.array()).otherwise(F.col("words")))
        .select("*", has_cue("line").alias("cue"))
    )
    units = stage(named(units), "licence-units")
    # Distinct texts are few; each is scored once.
    families = stage(
        classify(units.select("id", "words").dropDuplicates(["id"]), model), "licence-families"
    )
    none = F.lit(0.0)
    return units.join(families, "id", "left").select(
        F.col("key").alias(key),
        "row",
        F.col("at").alias("paragraph"),
        "line",
        "cue",
        F.coalesce("family", F.lit(UNKNOWN_CLASS)).alias("family"),
        F.coalesce("probability", none).alias("probability"),
        F.coalesce("shared", none).alias("shared"),
    )


def _words_of(units: DataFrame) -> DataFrame:
    """Add ``words`` of ``line`` without marks of comments."""
    return units.withColumn("words", words(F.regexp_replace("line", _MARKS, " ")))


def licences(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per key: n_cues, n_unknown, licences (sorted, comma-joined), probability.

    ``n_cues`` counts paragraphs with a cue or a known family, ``n_unknown``
    those of no known family; ``probability`` is the highest of a confirmed
    paragraph or line, 0 without one. Null keys are one key.
    """
    known = F.col("family") != UNKNOWN_CLASS
    paragraphs = (
        scan(df, model, key, text)
        .groupBy(F.col(key).alias("_key"), "row", "paragraph")
        .agg(
            F.max("cue").alias("cue"),
            F.array_join(F.sort_array(F.collect_set(F.when(known, F.col("family")))), ",").alias("l"),
            F.max(F.when(known, F.col("probability"))).alias("probability"),
        )
        .where(F.col("cue") | (F.col("l") != ""))
    )
    names = F.split(F.array_join(F.collect_set(F.when(F.col("l") != "", F.col("l"))), ","), ",")
    found = paragraphs.groupBy("_key").agg(
        F.count(F.lit(1)).alias("n_cues"),
        F.count_if(F.col("l") == "").alias("n_unknown"),
        F.array_join(F.sort_array(F.array_distinct(names)), ",").alias("l"),
        F.max("probability").alias("probability"),
    )
    return (
        df.select(F.col(f"`{key}`").alias(key))
        .distinct()
        .join(found, F.col(key).eqNullSafe(F.col("_key")), "left")
        .select(
            key,
            F.coalesce("n_cues", F.lit(0)).alias("n_cues"),
            F.coalesce("n_unknown", F.lit(0)).alias("n_unknown"),
            F.coalesce("l", F.lit("")).alias("licences"),
            F.coalesce("probability", F.lit(0.0)).alias("probability"),
        )
    )
