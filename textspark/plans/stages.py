"""pyspark.ml stages over the column functions, so cleaning, tokenising and weighting fit into a Pipeline."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import IDF, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.functions import clean, tokens

# Cleaning steps a saved stage may name, with the arguments given as JSON values.
STEPS: dict[str, Callable[..., Column]] = {
    "keywords": clean.replace_keywords,
    "patterns": clean.replace_patterns,
    "stopwords": clean.remove_stopwords,
    "stop_patterns": clean.remove_stop_patterns,
    "punctuation": clean.strip_punctuation,
    "lowercase": clean.lowercase,
    "whitespace": clean.squeeze_whitespace,
    "tidy": clean.tidy_body,
    "mask_urls": clean.mask_urls,
}


class CleanerStage(Transformer, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Named cleaning steps, applied in order to each input column. Saves and loads with the pipeline."""

    steps = Param(Params._dummy(), "steps", "list of [step name, arguments]")

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, steps=None):
        super().__init__()
        self._setDefault(steps=[])
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cleaner = reduce(
            lambda c, step: lambda text: STEPS[step[0]](c(text), **step[1]),
            self.getOrDefault(self.steps),
            lambda text: text,
        )
        pairs = zip(self.getInputCols(), self.getOutputCols())
        return dataset.withColumns({out: cleaner(F.col(src)) for src, out in pairs})


class ColumnStage(Transformer, HasInputCols, HasOutputCols):
    """Any Column -> Column function as a stage, for cleaners and tokenisers written by the caller."""

    def __init__(self, fn: Callable[[Column], Column], input_cols: Sequence[str], output_cols: Sequence[str] | None = None):
        super().__init__()
        self.fn = fn
        self._set(inputCols=list(input_cols), outputCols=list(output_cols or input_cols))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        pairs = zip(self.getInputCols(), self.getOutputCols())
        return dataset.withColumns({out: self.fn(F.col(src)) for src, out in pairs})


class TokenStage(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Text -> array<string>. `analyzer` is word, symbol, raw, alnum, char or char_wb."""

    analyzer = Param(Params._dummy(), "analyzer", "kind of token", TypeConverters.toString)
    low = Param(Params._dummy(), "low", "smallest n-gram", TypeConverters.toInt)
    high = Param(Params._dummy(), "high", "largest n-gram", TypeConverters.toInt)
    stopWords = Param(Params._dummy(), "stopWords", "dropped before n-grams", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, analyzer="word", low=1, high=1, stopWords=None):
        super().__init__()
        self._setDefault(analyzer="word", low=1, high=1, stopWords=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def column(self, text: Column) -> Column:
        kind, low, high = (self.getOrDefault(p) for p in (self.analyzer, self.low, self.high))
        if kind in ("char", "char_wb"):
            return {"char": tokens.char_ngrams, "char_wb": tokens.char_wb_ngrams}[kind](text, low, high)
        words = {
            "word": tokens.word_tokens,
            "symbol": tokens.symbol_tokens,
            "raw": tokens.raw_tokens,
            "alnum": lambda c: tokens.alnum_tokens(c, lowercase=True),
        }[kind](text)
        stop = self.getOrDefault(self.stopWords)
        if stop:
            words = F.filter(words, lambda t: ~t.isin(stop))
        return words if low == high == 1 else tokens.word_ngrams(words, low, high)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), self.column(F.col(self.getInputCol())))


class SmoothIdf(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Scales term counts by ln((1+N)/(1+df)) + 1. ML's own IDF lacks the added one."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ElementwiseProduct:
        source, target = self.getInputCol(), self.getOutputCol()
        fitted = IDF(inputCol=source, outputCol=target).fit(dataset)
        return ElementwiseProduct(
            scalingVec=Vectors.dense(fitted.idf.toArray() + 1.0), inputCol=source, outputCol=target
        )
