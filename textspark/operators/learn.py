"""Text classifiers as pyspark.ml pipelines: clean -> tokens -> TF-IDF -> linear model."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.feature import (
    CountVectorizer,
    CountVectorizerModel,
    ElementwiseProduct,
    IndexToString,
    Normalizer,
    StringIndexer,
    StringIndexerModel,
    Word2Vec,
    Word2VecModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.operators import linear
from textspark.operators.linear import BIAS, TableModel
from textspark.operators.sampling import stratified_sample
from textspark.operators.sparse import bag_of_words, normalize
from textspark.plans.ranking import top_k_per_group
from textspark.plans.skew import heavy_keys, lookup_join
from textspark.plans.stages import SmoothIdf, TokenStage
from textspark.plans.union import union_rows

# No term that min_df and max_df leave is cut; what bounds a model is the number of rows it is fitted on.
ALL_TERMS = (1 << 31) - 1


def label_indexer(label: str = "label", output: str = "label_index") -> StringIndexer:
    """Class numbers in alphabetical order of the labels."""
    return StringIndexer(inputCol=label, outputCol=output, stringOrderType="alphabetAsc")


def fit_rows(train: DataFrame, label: str, key: str, per_class: int | None = None, seed: str | int = 0) -> DataFrame:
    """The rows to fit on: all labelled ones, or at most `per_class` of each label, chosen by a seeded hash.

    A linear model keeps its vocabulary on the driver, and the rows it is fitted on bound that vocabulary.
    """
    labelled = train.filter(F.col(label).isNotNull())
    return labelled if per_class is None else stratified_sample(labelled, label, key, per_class, seed)


def tfidf_stages(tokens: TokenStage, min_df: float = 1.0, max_df: float = 1.0) -> list:
    """Token arrays to unit TF-IDF vectors in `features`. A max_df of 1.0 keeps every term."""
    counts = CountVectorizer(
        inputCol=tokens.getOutputCol(), outputCol="counts", minDF=float(min_df), vocabSize=ALL_TERMS
    )
    if max_df != 1.0:
        counts = counts.setMaxDF(float(max_df))
    return [
        tokens,
        counts,
        SmoothIdf(inputCol="counts", outputCol="weights"),
        Normalizer(p=2.0, inputCol="weights", outputCol="features"),
    ]


def logistic_regression(n_rows: int, max_iter: int = 100) -> LogisticRegression:
    """L2-penalised with weight 1/N, which is C = 1 on the summed loss; features are not rescaled."""
    return LogisticRegression(
        featuresCol="features",
        labelCol="label_index",
        family="auto",
        regParam=1.0 / n_rows,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
    )


def linear_svm(n_rows: int, max_iter: int = 50) -> OneVsRest:
    machine = LinearSVC(regParam=1.0 / n_rows, standardization=False, maxIter=max_iter)
    return OneVsRest(classifier=machine, featuresCol="features", labelCol="label_index")


def text_classifier(
    train: DataFrame, cleaning: Sequence, features: Sequence, classifier, label: str = "label", key: str | None = None
) -> PipelineModel | TableModel:
    """Fits cleaning, features, label index and classifier in one pipeline; predicts raw text afterwards.

    Stages are fitted in order. Once the text has become count vectors these are kept, so the later
    estimators and every pass of the optimiser start from them and not from the text. A pass shuffles a vector over the
    vocabulary and classes for each partition, so from there on there are no more partitions than cores.

    The ML estimators gather the vocabulary and several vectors over it on the driver. With the `key` of the rows,
    TF-IDF features of a vocabulary of any size are fitted as tables, to the same objective.
    """
    if key is not None:
        return _table_classifier(train, cleaning, features, classifier, label, key)
    fitted, current, kept = [], train, None
    for stage in [*cleaning, *features, label_indexer(label), classifier]:
        model = stage.fit(_by_core(current) if kept is not None else current) if isinstance(stage, Estimator) else stage
        fitted.append(model)
        if model is not classifier:
            current = model.transform(current)
        if isinstance(model, (CountVectorizerModel, Word2VecModel)):
            kept = current = current.select(label, model.getOutputCol()).persist(StorageLevel.MEMORY_AND_DISK)
            kept.count()  # filled by the partitions of the text, which are smaller than those of the passes
    if kept is not None:
        kept.unpersist()
    return PipelineModel(fitted)


def _by_core(df: DataFrame) -> DataFrame:
    """The same rows in at most as many partitions as there are cores, put together without a shuffle."""
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism)


def _table_classifier(train: DataFrame, cleaning: Sequence, features: Sequence, classifier, label: str, key: str) -> TableModel:
    """What the stages and the estimator ask for, by `linear.fit`."""
    tokens, counts = features[:2]
    machine = classifier.getClassifier() if isinstance(classifier, OneVsRest) else classifier
    return linear.fit(
        train, [*cleaning, tokens], key, label,
        kind="hinge" if isinstance(machine, LinearSVC) else "log",
        min_df=counts.getMinDF(), max_df=counts.getMaxDF(),
        reg=machine.getRegParam(), max_iter=machine.getMaxIter(), tol=machine.getTol(),
    )


def embedding_partitions(n_rows: int, rows_per_task: int = 20_000, most: int | None = None) -> int:
    """Tasks for training word vectors. Each trains on its share and their vectors are averaged after every pass.

    Every task hands in the vectors of all words it met, so what is shuffled is tasks times vocabulary. `most`, the
    cores of the cluster, keeps that from growing with the rows; a task streams its share, however long.
    """
    tasks = max(1, -(-n_rows // rows_per_task))
    return tasks if most is None else min(tasks, max(1, most))


def embedding_stages(token_col: str, size: int, min_count: int, partitions: int, seed: int = 0) -> list:
    """Mean of word vectors trained on the text itself, as `features`.

    The vectors are broadcast whole in every pass: vocabulary times 2 * size * 4 bytes, which min_count and the
    rows fitted on bound.
    """
    return [
        Word2Vec(inputCol=token_col, outputCol="features", vectorSize=size, minCount=min_count, seed=seed,
                 numPartitions=partitions)
    ]


def _stage(model: PipelineModel, kind):
    return next(s for s in model.stages if isinstance(s, kind))


def predict(model: PipelineModel | TableModel, df: DataFrame) -> DataFrame:
    """Adds `predicted` (the label) and, where the model gives one, `probability` as an array."""
    if isinstance(model, TableModel):
        return model.predict(df)
    for stage in model.stages[:-2]:
        df = stage.transform(df)
    scored = model.stages[-1].transform(df)
    names = IndexToString(
        inputCol="prediction", outputCol="predicted", labels=_stage(model, StringIndexerModel).labels
    )
    out = names.transform(scored)
    if "probability" in out.columns:
        out = out.withColumn("probability", vector_to_array("probability"))
    return out


def coefficients(model: PipelineModel | TableModel, df: DataFrame) -> DataFrame:
    """(label, term, weight) of a fitted logistic model, intercepts as <BIAS>.

    A two-class model keeps one weight vector for its second class; the first class gets the negatives.
    """
    spark = df.sparkSession
    if isinstance(model, TableModel):
        cells = F.arrays_zip(F.array(*map(F.lit, model.labels)).alias("label"), F.col("w").alias("weight"))
        bias = spark.createDataFrame([*zip(model.labels, [BIAS] * len(model.labels), model.bias)], "label string, term string, weight double")
        rows = model.weights.select("term", F.inline(cells).alias("label", "weight")).select("label", "term", "weight")
        return union_rows(rows, bias)
    terms = _stage(model, CountVectorizerModel).vocabulary
    labels = _stage(model, StringIndexerModel).labels
    classifier = model.stages[-1]
    matrix, bias = classifier.coefficientMatrix.toArray(), classifier.interceptVector.toArray()
    if len(labels) == 2 and len(matrix) == 1:
        matrix, bias = [-matrix[0], matrix[0]], [-bias[0], bias[0]]
    parts = [
        pd.DataFrame({"label": name, "term": [*terms, BIAS], "weight": [*row, b]})
        for name, row, b in zip(labels, matrix, bias)
    ]
    return spark.createDataFrame(pd.concat(parts), "label string, term string, weight double")


def top_features(weights: DataFrame, k: int = 10) -> DataFrame:
    """(label, term, weight, rank): the largest weights of each class."""
    return top_k_per_group(weights, ["label"], [F.desc("weight"), F.col("term")], k)


def fitted_idf(model: PipelineModel | TableModel, df: DataFrame) -> DataFrame:
    """(term, idf) held by a fitted pipeline."""
    if isinstance(model, TableModel):
        return model.weights.select("term", "idf")
    terms = _stage(model, CountVectorizerModel).vocabulary
    scale = _stage(model, ElementwiseProduct).getScalingVec().toArray()
    return df.sparkSession.createDataFrame(pd.DataFrame({"term": terms, "idf": scale}), "term string, idf double")


def class_scores(model: PipelineModel | TableModel, df: DataFrame, key: str) -> DataFrame:
    """(key, label, score): the raw score of every class, as the classifier itself computes it."""
    if isinstance(model, TableModel):
        labels = F.array(*map(F.lit, model.labels))
        return model.scores(df).select(key, F.inline(F.arrays_zip(labels.alias("label"), F.col("scores").alias("score"))).alias("label", "score"))
    for stage in model.stages[:-2]:
        df = stage.transform(df)
    scored = model.stages[-1].transform(df)
    labels = F.array(*map(F.lit, _stage(model, StringIndexerModel).labels))
    pairs = F.arrays_zip(labels.alias("label"), vector_to_array("rawPrediction").alias("score"))
    return scored.select(key, F.inline(pairs).alias("label", "score"))


def explain_linear(
    model: PipelineModel | TableModel, df: DataFrame, key: str, tokens: Column | None, top_classes: int = 3
) -> DataFrame:
    """(key, label, term, contribution) for each document's best classes: weight * feature value per term.

    The best classes come from the raw scores first, so a term only ever meets those. Contributions and the
    <BIAS> row add up to the raw score of the class. A table model needs no `tokens` to explain its own.
    """
    if isinstance(model, TableModel):
        return model.explained(df, tokens, top_classes)
    best = top_k_per_group(class_scores(model, df, key), [key], [F.desc("score"), F.col("label")], top_classes)
    best = best.groupBy(key).agg(F.collect_list("label").alias("_best"))
    idf = fitted_idf(model, df)
    bow = bag_of_words(df, key, tokens)
    weights = coefficients(model, df)
    # Both lookup tables come from the model on the driver, so their size is known to be small.
    heavy = heavy_keys(bow.groupBy("term").agg(F.count("*").alias("_n")), ["term"], "_n")
    labels = _stage(model, StringIndexerModel).labels
    by_term = (
        weights.filter(F.col("term") != BIAS)
        .groupBy("term")
        .agg(F.collect_list(F.struct("label", "weight")).alias("w"))
    )
    limit = 64 << 20
    cells = lookup_join(bow, idf, ["term"], heavy, max_bytes=limit).withColumn("value", F.col("n") * F.col("idf"))
    values = normalize(cells.select(key, "term", "value"), key, "l2").join(best, key)
    width = 64 + 32 * len(labels)
    parts = lookup_join(values, by_term, ["term"], heavy, row_bytes=width, max_bytes=limit).select(
        key, "term", "value", F.inline(F.filter("w", lambda x: F.array_contains("_best", x["label"])))
    )
    terms = parts.select(key, "label", "term", (F.col("value") * F.col("weight")).alias("contribution"))
    biases = weights.filter(F.col("term") == BIAS).select("label", "term", "weight")
    per_class = biases.agg(F.collect_list(F.struct("label", "term", F.col("weight").alias("contribution")))).scalar()
    bias = df.join(best, key).withColumn("_b", per_class).select(
        key, F.inline(F.filter("_b", lambda x: F.array_contains("_best", x["label"])))
    )
    return union_rows(terms, bias)
