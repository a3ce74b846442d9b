"""Toxicity by a classifier chain over words and word beginnings.

Categories, the columns of the labels table, are predicted one after the other.  Each is
a logistic regression over the words of a document (a vocabulary chosen by how differently
the documents of each category use a word or a beginning) and the probabilities of the
categories before it.  For training, those
probabilities are out of fold: every labelled document gets them from models that have
not seen it, so later models learn how far earlier ones can be trusted.  For scoring,
each category's model trained on the whole sample supplies them.

The models are fitted on a bounded sample of labelled documents (MAX_LABELLED, in order
of a digest of the id); all documents are scored.

Defined results: null and empty texts have no words and get the models' intercepts;
repeated rows get equal scores; an id labelled more than once counts with its largest
label; documents without a category's label do not train it; a category with only one class in the sample gets its rate as a constant
probability; empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import materialize, prepare, table

MAX_LABELLED = 20_000
VOCABULARY = 1000  # words of a category
MIN_DOCS = 5  # labelled documents that a word of the vocabulary stands in
FOLDS = 3
PASSES = 20
REGULARIZATION = 0.01
THRESHOLD = 0.5

CATEGORIES = ["quality", "toxic"]  # in the order of the chain
PREFIXES = range(4, 8)  # characters of a word's beginnings that are features like words


def words(text):
    """A text's distinct words, and the beginnings of each of them marked ^ (so a beginning counts the words that have it)."""
    own = F.filter(F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")), lambda w: w != "")

    def starts(k):
        return F.transform(F.filter(own, lambda w: F.length(w) > k), lambda w: F.concat(F.lit("^"), F.substring(w, 1, k)))

    return F.concat(own, *map(starts, PREFIXES))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, categories=CATEGORIES, most: int = MAX_LABELLED) -> DataFrame:
    """Rows (id, fold, words, a label per category or null) of at most about ``most`` documents labelled with the last category."""
    own = [F.max(c if c in labels.columns else F.lit(None).cast("int")).alias(c) for c in categories]
    ids = (
        labels.where(F.col(categories[-1]).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(*own)
        .where("id is not null").orderBy(F.xxhash64("id"), "id").limit(most)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
    return texts.select(
        "id", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(FOLDS)).alias("fold"), words(F.col("text")).alias("words"),
        *[(F.col(c) == 1).cast("double").alias(c) for c in categories],
    )


def vocabulary(sample: DataFrame, label: str = "toxic", size: int = VOCABULARY) -> list[str]:
    """The words whose share of labelled documents differs most between the classes, by its z-score."""
    sample = sample.where(F.col(label).isNotNull())
    whole = sample.agg(F.sum(label).alias("n1"), F.count("*").alias("n")).first()
    n1, n = whole["n1"] or 0.0, whole["n"]
    counts = sample.select(label, F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.sum(label).alias("c1"), F.count("*").alias("c"))
    p = F.col("c") / max(n, 1)
    p1, p0 = F.col("c1") / max(n1, 1.0), (F.col("c") - F.col("c1")) / max(n - n1, 1.0)
    z = F.abs(p1 - p0) / F.sqrt(p * (1.0000001 - p) * (1 / max(n1, 1.0) + 1 / max(n - n1, 1.0)))
    top = counts.where(F.col("c") >= MIN_DOCS).select("word", z.alias("z")).orderBy(F.desc("z"), "word").limit(size)
    return [r["word"] for r in top.collect()]


class Constant:
    """Stands in for a model where the sample has only one class."""

    def __init__(self, rate: float):
        self.rate = rate

    def transform(self, df: DataFrame) -> DataFrame:
        return df


def _fit(df: DataFrame, label: str, features: str):
    df = df.where(F.col(label).isNotNull())
    known = df.agg(F.avg(label).alias("rate")).first()["rate"]
    if known is None or known in (0.0, 1.0):
        return Constant(known or 0.0)
    model = LogisticRegression(featuresCol=features, labelCol=label, maxIter=PASSES, regParam=REGULARIZATION)
    return model.setProbabilityCol(f"pr_{label}").setRawPredictionCol(f"raw_{label}").setPredictionCol(f"is_{label}").fit(df)


def _apply(model, df: DataFrame, label: str) -> DataFrame:
    """Adds p_<label>, the model's probability."""
    if isinstance(model, Constant):
        return df.withColumn(f"p_{label}", F.lit(float(model.rate)))
    out = model.transform(df)
    return out.withColumn(f"p_{label}", vector_to_array(f"pr_{label}")[1]).drop(f"pr_{label}", f"raw_{label}", f"is_{label}")


class Chain:
    """The fitted categories in order, with the vocabulary they share."""

    def __init__(self, words_: list[str], categories: list[str]):
        # The vectorizer needs a word; this one is never split off.
        self.bag = CountVectorizerModel.from_vocabulary(words_ or ["\x00"], inputCol="words", outputCol="bag")
        self.categories = categories
        self.models: dict = {}

    def features(self, df: DataFrame, k: int) -> DataFrame:
        """Adds the k-th category's features: the bag of words and the probabilities before it."""
        before = [f"p_{c}" for c in self.categories[:k]]
        return VectorAssembler(inputCols=["bag", *before], outputCol=f"x{k}").transform(df)

    def fit(self, sample: DataFrame) -> Chain:
        held = self.bag.transform(sample).select("id", "fold", "bag", *self.categories)
        held = materialize(held.coalesce(8), "toxicity-sample")
        for k, label in enumerate(self.categories):
            held = self.features(held, k)
            self.models[label] = _fit(held, label, f"x{k}")
            if k + 1 < len(self.categories):
                folds = [
                    _apply(_fit(held.where(F.col("fold") != f), label, f"x{k}"), held.where(F.col("fold") == f), label) for f in range(FOLDS)
                ]
                held = materialize(reduce(DataFrame.unionByName, folds).drop(f"x{k}").coalesce(8), "toxicity-out-of-fold")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds p_<category> for every category to a frame with ``words``."""
        out = self.bag.transform(df).drop("words")
        for k, label in enumerate(self.categories):
            out = _apply(self.models[label], self.features(out, k), label).drop(f"x{k}")
        return out.drop("bag")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Chain:
    prepare(docs.sparkSession)
    sample = materialize(labelled_sample(docs, labels, id_col, text_col), "toxicity-labelled")
    told = {w: None for c in CATEGORIES for w in vocabulary(sample, c)}
    return Chain(list(told), CATEGORIES).fit(sample)


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, p_<category>...), one per row of ``docs``."""
    return chain.transform(docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("words")))


def op6_toxicity_chain(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        F.col("id").alias("doc_id"),
        *[F.round(f"p_{c}", 6).alias(f"p_{c}") for c in CATEGORIES],
        (F.col("p_toxic") >= THRESHOLD).alias("toxic"),
    )
