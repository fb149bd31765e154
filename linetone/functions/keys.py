"""How a title is matched with the file that holds its text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the ending of an English text file.
TEXT_SUFFIX = ".en.srt"


def title_file_key(title: Column, suffix: str = TEXT_SUFFIX) -> Column:
    """Name of the text file of a title. A file name cannot hold a slash, so it goes."""
    return F.concat(F.replace(title, F.lit("/"), F.lit("")), F.lit(suffix))


def title_text_path(folder: str, title: Column, suffix: str = TEXT_SUFFIX) -> Column:
    """Full path of the text file of a title."""
    return F.concat(F.lit(folder.rstrip("/") + "/"), title_file_key(title, suffix))


def scanned_file_key(file_name: Column) -> Column:
    """File name as it is on disk, from the percent-encoded name a scan reports.

    ``url_decode`` would read a plain ``+`` as a blank, so it is escaped first.
    """
    return F.url_decode(F.replace(file_name, F.lit("+"), F.lit("%2B")))


def path_file_key(path: Column) -> Column:
    """File name at the end of an unencoded path."""
    return F.element_at(F.split(path, "/"), -1)
