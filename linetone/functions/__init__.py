from linetone.functions.keys import path_file_key, scanned_file_key, title_file_key, title_text_path
from linetone.functions.stopwords import ENGLISH
from linetone.functions.text import (
    blank_separated,
    content_words,
    key_words,
    letters_only,
    phrase_key,
    words,
)

__all__ = [
    "ENGLISH",
    "blank_separated",
    "content_words",
    "key_words",
    "letters_only",
    "path_file_key",
    "phrase_key",
    "scanned_file_key",
    "title_file_key",
    "title_text_path",
    "words",
]
