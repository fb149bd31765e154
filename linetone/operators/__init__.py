from linetone.operators.bag_of_words import add_words, bag_of_words, null_phrases, unique_phrases
from linetone.operators.classifier import check_labels, fit_classifier
from linetone.operators.coverage import coverage_counts, titles_with_text, titles_without_text
from linetone.operators.ordered import running_totals
from linetone.operators.report import (
    genre_report,
    mean_score,
    mean_score_without_neutral,
    title_report,
)
from linetone.operators.sampling import row_hash, sample_per_label
from linetone.operators.scoring import (
    class_probabilities,
    margins,
    predicted_class,
    score_phrases,
    weight_table,
)
from linetone.operators.vocabulary import (
    VOCAB_SIZE,
    combined_corpus,
    explode_terms,
    fit_vectoriser,
    ranked_vocabulary,
    term_counts,
    term_frequencies,
    word_runs,
)
from linetone.operators.word_table import content_words_by_table, drop_listed_words
from linetone.operators.words import title_text, word_counts, word_stream

__all__ = [
    "VOCAB_SIZE",
    "add_words",
    "bag_of_words",
    "check_labels",
    "class_probabilities",
    "combined_corpus",
    "content_words_by_table",
    "coverage_counts",
    "drop_listed_words",
    "explode_terms",
    "fit_classifier",
    "fit_vectoriser",
    "genre_report",
    "margins",
    "mean_score",
    "mean_score_without_neutral",
    "null_phrases",
    "predicted_class",
    "ranked_vocabulary",
    "row_hash",
    "running_totals",
    "sample_per_label",
    "score_phrases",
    "term_counts",
    "term_frequencies",
    "title_report",
    "title_text",
    "titles_with_text",
    "titles_without_text",
    "unique_phrases",
    "weight_table",
    "word_counts",
    "word_runs",
    "word_stream",
]
