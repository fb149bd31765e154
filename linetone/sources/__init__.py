from linetone.sources.blocks import read_blocks
from linetone.sources.catalogue import read_catalogue, title_names
from linetone.sources.lines import (
    cues_of_blocks,
    list_text_files,
    read_cues,
    read_line_files,
    read_subtitles,
    split_cues,
    split_lines,
)
from linetone.sources.models import (
    load_classifier,
    model_path,
    read_terms,
    read_weights,
    save_classifier,
    save_vectoriser,
    term_weights,
)
from linetone.sources.phrases import read_labelled_phrases
from linetone.sources.types import as_types, inferred_types, read_inferred

__all__ = [
    "as_types",
    "cues_of_blocks",
    "inferred_types",
    "list_text_files",
    "load_classifier",
    "model_path",
    "read_blocks",
    "read_catalogue",
    "read_cues",
    "read_inferred",
    "read_labelled_phrases",
    "read_line_files",
    "read_subtitles",
    "read_terms",
    "read_weights",
    "save_classifier",
    "save_vectoriser",
    "split_cues",
    "split_lines",
    "term_weights",
    "title_names",
]
