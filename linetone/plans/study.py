"""The whole study: catalogue, texts and labelled phrases to a score per title."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from linetone.functions import title_file_key, title_text_path, words
from linetone.functions.keys import TEXT_SUFFIX
from linetone.operators import (
    VOCAB_SIZE,
    bag_of_words,
    combined_corpus,
    coverage_counts,
    fit_classifier,
    term_frequencies,
    title_report,
    titles_with_text,
    titles_without_text,
)
from linetone.operators.report import NEUTRAL
from linetone.plans.training import vectorise
from linetone.session import stage
from linetone.sources import (
    list_text_files,
    model_path,
    read_catalogue,
    read_labelled_phrases,
    read_subtitles,
    save_classifier,
)


@dataclass
class SentimentStudy:
    """Reads on first use, then :meth:`perform_count_vec`, :meth:`classification`.

    ``scope`` "title" compares phrases within their title instead of over all titles.
    Tables that several jobs start from are staged once, so that all jobs see the
    same rows and none reads the inputs again.
    """

    spark: SparkSession
    csv_path: str
    srt_dir: str
    tsv_path: str
    limit_movies: int | None = None
    limit_training_set: int | None = None
    scope: str = "corpus"
    drop_empty: bool = False
    vocabulary_from: str = "both"
    vocab_size: int = VOCAB_SIZE
    neutral: float = NEUTRAL
    keep_all_titles: bool = False
    suffix: str = TEXT_SUFFIX

    vectoriser: CountVectorizerModel | None = field(default=None, init=False)
    classifier: LogisticRegressionModel | None = field(default=None, init=False)

    def __post_init__(self) -> None:
        if self.scope not in ("corpus", "title"):
            raise ValueError(f"scope must be 'corpus' or 'title', not {self.scope!r}")

    # Titles

    @cached_property
    def _catalogue(self) -> tuple[DataFrame, DataFrame]:
        return read_catalogue(self.spark, self.csv_path, self.limit_movies)

    @cached_property
    def _titles(self) -> DataFrame:
        title = F.col("title")
        return stage(
            self._catalogue[0]
            .withColumn("file_key", title_file_key(title, self.suffix))
            .withColumn("srt_path", title_text_path(self.srt_dir, title, self.suffix)),
            "titles",
        )

    @cached_property
    def _files(self) -> DataFrame:
        return stage(list_text_files(self.spark, self.srt_dir, self.suffix), "files")

    @property
    def rejected_movies(self) -> DataFrame:
        """Catalogue rows without a usable id."""
        return self._catalogue[1]

    @cached_property
    def df_movies(self) -> DataFrame:
        """Titles with a text: ``movieId``, ``title``, ``genres``, ``srt_path``."""
        return titles_with_text(self._titles, self._files, "file_key").drop("file_key")

    @cached_property
    def df_movies_without_subs(self) -> DataFrame:
        """Titles without one."""
        return titles_without_text(self._titles, self._files, "file_key").drop("file_key")

    @cached_property
    def _counts(self) -> tuple[int, int]:
        row = coverage_counts(self._titles, self._files, "file_key").first()
        return row["found"], row["missing"]

    @property
    def n_movies(self) -> int:
        """Number of titles with a text."""
        return self._counts[0]

    @property
    def n_movies_without_subs(self) -> int:
        return self._counts[1]

    # Phrases

    @cached_property
    def _labelled(self) -> tuple[DataFrame, DataFrame]:
        return read_labelled_phrases(self.spark, self.tsv_path, self.limit_training_set)

    @property
    def rejected_phrases(self) -> DataFrame:
        """Labelled phrases without a usable id, text or label."""
        return self._labelled[1]

    @cached_property
    def df_train(self) -> DataFrame:
        """Unique labelled phrases with ``words_regex`` and ``filtered``."""
        unique = bag_of_words(
            self._labelled[0],
            order=["PhraseId"],
            keep=["SentenceId", "Phrase", "Sentiment"],
            drop_empty=self.drop_empty,
        )
        return _with_words(stage(unique.drop("phrase_key"), "train"))

    @cached_property
    def df_test(self) -> DataFrame:
        """Unique lines of the titles with ``words_regex`` and ``filtered``."""
        names = None
        if self.limit_movies is not None:  # the limit bounds the list
            found = self.df_movies.select(title_file_key(F.col("title"), self.suffix).alias("name"))
            names = [row["name"] for row in found.distinct().collect()]
        lines = read_subtitles(
            self.spark, self.srt_dir, self.df_movies, self.suffix, names=names
        )
        unique = bag_of_words(
            lines,
            order=["movieId", "Phrase"],
            scope=["movieId"] if self.scope == "title" else [],
            drop_empty=self.drop_empty,
        )
        return _with_words(stage(unique.drop("phrase_key"), "test"))

    # Model

    @property
    def terms_left_out(self) -> int:
        """Number of terms beyond ``vocab_size``, which have no feature."""
        parts = [self.df_train, self.df_test] if self.vocabulary_from == "both" else [self.df_train]
        terms = term_frequencies(combined_corpus(*parts)).count()
        return max(0, terms - self.vocab_size)

    def perform_count_vec(self) -> CountVectorizerModel:
        """Add ``features`` to both sets; ``terms_left_out`` tells what the size cuts off."""
        self.vectoriser, self.df_train, self.df_test = vectorise(
            self.df_train.drop("features"),
            self.df_test.drop("features", *_PREDICTION_COLUMNS),
            self.vocab_size,
            self.vocabulary_from,
        )
        self.classifier = None
        return self.vectoriser

    def classification(self, **options) -> LogisticRegressionModel:
        """Fit on ``df_train`` and add the prediction columns to ``df_test``."""
        if self.vectoriser is None:
            self.perform_count_vec()
        self.classifier = fit_classifier(self.df_train, **options)
        # Output columns of an earlier fit would clash with the new ones.
        self.df_test = self.classifier.transform(self.df_test.drop(*_PREDICTION_COLUMNS))
        return self.classifier

    @property
    def df_results(self) -> DataFrame:
        """``movieId``, ``title``, ``score``, ``score_without_neutral``."""
        if self.classifier is None:
            raise RuntimeError("call classification() first")
        return title_report(
            self.df_movies,
            self.df_test,
            neutral=self.neutral,
            keep_all_titles=self.keep_all_titles,
        )

    def save_model(self, folder: str) -> str:
        """Write the classifier below ``folder`` under a name with the run's sizes."""
        if self.classifier is None:
            raise RuntimeError("call classification() first")
        path = model_path(folder, self.limit_movies, self.df_train.count())
        return save_classifier(self.classifier, path)


_PREDICTION_COLUMNS = ("rawPrediction", "probability", "Sentiment_Predicted")


def _with_words(staged: DataFrame) -> DataFrame:
    # Recomputed where it is looked at rather than written and read by every job.
    return staged.withColumn("words_regex", words(F.col("Phrase")))
