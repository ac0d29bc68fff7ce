"""Learned quality scores: pluggable scorers, exact calibration of thresholds, score statistics, domain prediction.

The published model weights are not part of this repository. Scorers are trained here on labelled rows or given as weights; their
scores differ from those of other models, and everything around them is the same.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


class QualityScorer(Protocol):
    """Adds `_quality_score` (float, 0 to 1) to rows."""

    def score(self, df: DataFrame, text: Column) -> DataFrame: ...


class HashedLogisticScorer:
    """Hashed words and word pairs with a logistic regression, trained on labelled rows: all of Spark ML, in the JVM."""

    def __init__(self, features: int = 1 << 16, most_chars: int | None = None) -> None:
        """`most_chars`: what of a text is read; all, if None."""
        self.features, self.most_chars, self.model = features, most_chars, None

    def _stages(self) -> list:
        return [
            RegexTokenizer(inputCol="_text", outputCol="_words", pattern="[^\\p{L}\\p{N}]+", toLowercase=True),
            NGram(n=2, inputCol="_words", outputCol="_pairs"),
            HashingTF(inputCol="_all", outputCol="features", numFeatures=self.features, binary=True),
        ]

    def _features(self, df: DataFrame, text: Column) -> DataFrame:
        words, pairs, hashed = self._stages()
        x = pairs.transform(words.transform(df.withColumn("_text", F.coalesce(X.one_line(text, self.most_chars), F.lit("")))))
        return hashed.transform(x.withColumn("_all", F.concat("_words", "_pairs"))).drop("_text", "_words", "_pairs", "_all")

    def fit(self, labelled: DataFrame, text: Column, label: str) -> HashedLogisticScorer:
        x = self._features(labelled.filter(F.col(label).isNotNull() & (F.length(X.strip(text)) >= 1)), text)
        self.model = LogisticRegression(featuresCol="features", labelCol=label, regParam=0.01, maxIter=25, family="binomial").fit(x.withColumn(label, F.col(label).cast("double")))
        return self

    def score(self, df: DataFrame, text: Column) -> DataFrame:
        """Empty texts score 0."""
        x = self.model.transform(self._features(df, text)) if self.model else None
        if x is None:
            raise ValueError("fit() comes first")
        p = vector_to_array(F.col("probability"))[1].cast("float")
        return x.withColumn("_quality_score", F.when(X.blank(text), F.lit(0.0).cast("float")).otherwise(F.least(p, F.lit(1.0).cast("float")))).drop("features", "rawPrediction", "probability", "prediction")


def mlp_head(vector: Column, hidden: list[list[float]], hidden_bias: list[float], out: list[float], out_bias: float) -> Column:
    """Sigmoid of a two-layer head over a pooled embedding, as one array expression: no Python worker."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    v = F.transform(vector, lambda x: x.cast("double"))
    rows = F.array(*[F.struct(F.array(*[F.lit(float(w)) for w in r]).alias("w"), F.lit(float(b)).alias("b")) for r, b in zip(hidden, hidden_bias, strict=True)])
    layer = F.transform(rows, lambda r: F.greatest(F.lit(0.0), dot(v, r["w"]) + r["b"]))
    z = dot(layer, F.array(*[F.lit(float(w)) for w in out])) + F.lit(float(out_bias))
    return 1.0 / (1.0 + F.exp(-z))


def mean_pool(vectors: Column, mask: Column) -> Column:
    """Mean of the token vectors whose mask is 1; zeros if there are none."""
    kept = F.transform(F.filter(F.arrays_zip(vectors.alias("v"), mask.alias("m")), lambda t: t["m"] == 1), lambda t: t["v"])
    width = F.size(F.get(vectors, F.lit(0)))
    zero = F.array_repeat(F.lit(0.0), width)
    total = F.aggregate(kept, zero, lambda a, x: F.zip_with(a, x, lambda p, q: p + q.cast("double")))
    return F.transform(total, lambda x: x / F.greatest(F.size(kept), F.lit(1)))


def calibrate(scored: DataFrame, threshold: float, most_dropped: float, score: str = "_quality_score") -> float:
    """The threshold, lowered where it would drop more than a part of all rows; never raised. One exact aggregate."""
    r = scored.agg(F.avg((F.col(score) < threshold).cast("double")).alias("part"), F.percentile(score, most_dropped).alias("p")).first()
    return threshold if r["part"] is None or r["part"] <= most_dropped else min(threshold, float(r["p"]))


def apply_threshold(scored: DataFrame, threshold: float, score: str = "_quality_score") -> DataFrame:
    """Adds `_quality_label` HIGH or LOW and `_keep`; a threshold of 0 keeps all."""
    ok = F.col(score) >= F.lit(threshold).cast(scored.schema[score].dataType) if threshold > 0 else F.lit(True)
    return scored.withColumn("_quality_label", F.when(ok, "HIGH").otherwise("LOW")).withColumn("_keep", F.coalesce(ok, F.lit(False)))


def score_stats(scored: DataFrame, *by: str, score: str = "_quality_score") -> DataFrame:
    """Exact minimum, quartiles and tails, mean and maximum, to four places."""
    s = F.col(score).cast("double")
    at = F.percentile(s, F.array(*[F.lit(q) for q in (0.1, 0.25, 0.5, 0.75)]))
    x = scored.groupBy(*by).agg(F.count(s).alias("n"), F.min(s).alias("min"), at.alias("p"), F.avg(s).alias("mean"), F.max(s).alias("max"))
    r = lambda c: F.round(c, 4)
    return x.select(*by, "n", r(F.col("min")).alias("min"), *[r(F.get("p", F.lit(i))).alias(f"p{q}") for i, q in enumerate((10, 25, 50, 75))], r(F.col("mean")).alias("mean"), r(F.col("max")).alias("max"))


# Function words that tell languages apart.
FUNCTION_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "as", "was", "on", "are", "be", "this"],
    "de": ["der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "im", "für", "nicht", "ein", "eine", "dem", "sich"],
    "fr": ["le", "la", "les", "et", "des", "en", "un", "une", "du", "que", "est", "pour", "dans", "qui", "par", "au"],
    "es": ["el", "la", "los", "de", "y", "que", "en", "un", "una", "del", "las", "por", "con", "para", "se", "no"],
    "it": ["il", "di", "che", "la", "un", "per", "una", "non", "con", "del", "della", "sono", "le", "dei", "nel", "alla"],
}


def language_profile(text: Column) -> Column:
    """struct(language, confidence, english): each language's part of the function words found, by plain counts; the best (null if nothing speaks for any), its part, and that of English. CJK text is 'zh'.

    The words are made once, those that no language counts go next, and each language counts what is left.
    """
    every = sorted({w for ws in FUNCTION_WORDS.values() for w in ws})
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}]+")
    once = lambda c, body: F.transform(F.array(c), body)[0]

    def told(n: Column) -> Column:
        total = F.aggregate(n, F.lit(0), lambda a, x: a + x)
        parts = [F.when(total == 0, 0.0).otherwise(F.get(n, F.lit(i)) / total) for i in range(len(FUNCTION_WORDS))]
        best = F.array_max(F.array(*[F.struct(p.alias("score"), F.lit(k).alias("language")) for k, p in zip(FUNCTION_WORDS, parts)]))  # noqa: B905
        return once(best, lambda b: F.struct(F.when(b["score"] > 0, b["language"]).alias("language"), b["score"].alias("confidence"), parts[list(FUNCTION_WORDS).index("en")].alias("english")))

    counted = once(F.filter(words, lambda t: t.isin(every)), lambda w: F.array(*[_hits(w, k) for k in FUNCTION_WORDS]))
    zh = F.struct(F.lit("zh").alias("language"), F.lit(1.0).alias("confidence"), F.lit(0.0).alias("english"))
    return F.when(X.cjk_ratio(text) > 0.2, zh).otherwise(once(counted, told))


def _hits(words: Column, language: str) -> Column:
    return F.size(F.filter(words, lambda t: t.isin(FUNCTION_WORDS[language])))


def english_score(text: Column) -> Column:
    return language_profile(text)["english"]


def language_confidence(text: Column) -> Column:
    return language_profile(text)["confidence"]


def detected_language(text: Column) -> Column:
    """The best language; null if nothing speaks for any."""
    return language_profile(text)["language"]


def cjk_language(text: Column) -> Column:
    """zh above a fifth of CJK characters, en_zh_mixed above none, else en."""
    r = X.cjk_ratio(text)
    return F.when(r > 0.2, "zh").when(r > 0, "en_zh_mixed").otherwise("en")


def keyword_domain(text: Column, words: dict[str, list[str]], margin: int = 1, default: str = "general") -> Column:
    """The domain with most keywords in the text, if it leads by `margin`."""
    low = F.lower(F.coalesce(text, F.lit("")))
    scores = [F.struct(sum((F.contains(low, F.lit(w)).cast("int") for w in ws), F.lit(0)).alias("n"), F.lit(-i).alias("order"), F.lit(d).alias("domain")) for i, (d, ws) in enumerate(words.items())]
    return F.transform(F.array(F.sort_array(F.array(*scores), asc=False)), lambda s: F.when((s[0]["n"] > 0) & (s[0]["n"] - F.coalesce(F.get(s, F.lit(1))["n"], F.lit(0)) >= margin), s[0]["domain"]).otherwise(default))[0]


class DomainClassifier:
    """Domains by hashed words and a multinomial regression, trained on a balanced sample of at most `most` rows a domain (a documented bound)."""

    def __init__(self, features: int = 1 << 15, most: int = 500_000, seed: int = 42, most_chars: int | None = None) -> None:
        """`most_chars`: what of a text is read; all, if None."""
        self.features, self.most, self.seed, self.most_chars = features, most, seed, most_chars
        self.model: PipelineModel | None = None
        self.labels: list[str] = []

    def _features(self, df: DataFrame, text: Column) -> DataFrame:
        x = RegexTokenizer(inputCol="_text", outputCol="_words", pattern="[^\\p{L}\\p{N}]+").transform(df.withColumn("_text", F.coalesce(X.one_line(text, self.most_chars), F.lit(""))))
        return HashingTF(inputCol="_words", outputCol="features", numFeatures=self.features).transform(x).drop("_text", "_words")

    def fit(self, rows: DataFrame, text: Column, domain: str, key: str) -> DomainClassifier:
        from .sampling import capped

        x = capped(rows.filter((F.length(X.strip(text)) >= 10) & F.col(domain).isNotNull()), [domain], key, self.most, self.seed)
        self.labels = sorted(r[0] for r in x.select(domain).distinct().collect())
        index = F.array_position(F.array(*[F.lit(v) for v in self.labels]), F.col(domain)) - 1
        self.model = LogisticRegression(featuresCol="features", labelCol="_label", maxIter=20, regParam=0.01, family="multinomial").fit(self._features(x, text).withColumn("_label", index.cast("double")))
        return self

    def predict(self, rows: DataFrame, text: Column, domain: str = "domain", language: str | None = None) -> DataFrame:
        """predicted_domain and confidence of rows without a domain; English rows take the best of the top three that is not 'multilingual'."""
        x = self.model.transform(self._features(rows.filter(X.blank(domain)), text))
        scored = F.sort_array(F.transform(vector_to_array(F.col("probability")), lambda p, i: F.struct(p.alias("p"), F.get(F.array(*[F.lit(v) for v in self.labels]), i).alias("d"))), asc=False)
        top = F.slice(scored, 1, 3)
        fits = F.filter(top, lambda s: (s["d"] != "multilingual") | (F.lit(False) if language is None else F.coalesce(F.col(language) != "en", F.lit(False))))
        best = F.coalesce(F.get(fits, F.lit(0)), F.get(top, F.lit(0)))
        return x.withColumn("_b", best).withColumns({"predicted_domain": F.col("_b.d"), "confidence": F.round(F.col("_b.p"), 4)}).drop("_b", "features", "rawPrediction", "probability", "prediction")
