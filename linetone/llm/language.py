"""Language ID by compression: the dictionary that shortens a text most names its language."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from linetone.llm.names import numbered, restored
from linetone.session import stage

# The sample a dictionary is made of, joined and cut at DICTIONARY bytes: up to SAMPLE texts of a
# language, of between SHORTEST and LONGEST bytes. If there are fewer, up to as many excerpts of
# longer texts follow, then up to SHORT_SAMPLE shorter texts.
SAMPLE, SHORT_SAMPLE = 160, 4_000
SHORTEST, LONGEST = 200, 8_000
DICTIONARY = 96 << 10

# Texts are compressed in pieces of this size, each from the dictionary alone: else a long
# text would become its own dictionary and the languages' sizes draw level.
PIECE = 4096
LEVEL = 6

# Bytes of the language that stand before a piece and are not in the dictionary. Their size
# alone is taken off again. A text of a few words has no gain of its own to show, but makes
# what it joins longer by less in its own language. A small sample gives a quarter of itself.
LEAD = 1000

# A shorter dictionary is none: too little for a compressor to refer to.
LEAST = 8

# Share of the second-best size by which the best must be smaller.
MARGIN = 0.01
# Margin at which the score is 1 - 1/e.
SCALE = 0.05

UNKNOWN = "und"

_NO_LETTERS = re.compile(r"[\W\d_]+")

PREDICTION = "lang_pred string, score double, margin double"


def letters(text: str) -> bytes:
    """Lower-cased runs of letters with one space between: what is compressed."""
    return _NO_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "surrogatepass")


def _kind() -> Column:
    """0 for texts of suitable length, 1 for longer ones, 2 for shorter ones."""
    size = F.octet_length("text")
    return F.when(size > LONGEST, 1).when(size < SHORTEST, 2).otherwise(0)


def _excerpt() -> Column:
    """A text, or of a long one as many characters from a place that its hash gives."""
    room = F.greatest(F.length("text") - LONGEST, F.lit(0)) + 1
    place = F.pmod(F.conv(F.substring("key", 9, 8), 16, 10).cast("long"), room)
    return F.substring(F.col("text"), (place + 1).cast("int"), F.lit(LONGEST))


def sample_texts(labelled: DataFrame) -> dict[str, list[str]]:
    """For each ``lang``, the sample of its distinct texts that come first by kind and hash.

    Only ids and hashes are ranked, and of these only a share that has the first ones all but
    surely, so that no task ranks a whole language. The chosen texts are then read: of each
    language at most ``SAMPLE`` of ``LONGEST`` bytes, and where these are not so many as much
    again and ``SHORT_SAMPLE`` of ``SHORTEST``. ``labelled``: ``doc_id``, ``text``, ``lang``.
    """
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    usable = usable.select("doc_id", "lang", "text", _kind().alias("kind"), F.md5("text").alias("key"))
    thin = usable.groupBy("lang", "kind", "key").agg(F.min("doc_id").alias("doc_id"))
    thin = stage(thin, "hashes")
    most = F.when(F.col("kind") == 2, SHORT_SAMPLE).otherwise(SAMPLE)
    totals = thin.groupBy("lang", "kind").agg(F.count("*").alias("texts")).withColumn(
        "suitable", F.max(F.when(F.col("kind") == 0, F.col("texts"))).over(Window.partitionBy("lang"))
    )
    totals = totals.where((F.col("kind") == 0) | (F.coalesce("suitable", F.lit(0)) < SAMPLE))
    totals = stage(totals.drop("suitable"), "totals")
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / (1 << 32)
    thin = thin.join(totals, ["lang", "kind"]).where(place * F.col("texts") < 4 * most)
    first = Window.partitionBy("lang", "kind").orderBy("key")
    thin = thin.withColumn("n", F.row_number().over(first)).where(F.col("n") <= most)
    chosen = stage(thin.select("doc_id", "lang", "key"), "sample")
    chosen = chosen.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.col("key").alias("_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("lang") == F.col("_lang")) & (F.col("key") == F.col("_key"))
    texts = usable.join(chosen, same).select("lang", "kind", "key", _excerpt().alias("text"))
    found: dict[str, dict[tuple[int, str], str]] = {}
    for row in texts.distinct().collect():
        found.setdefault(row["lang"], {})[row["kind"], row["key"]] = row["text"]
    return {lang: [t for _, t in sorted(by_key.items())] for lang, by_key in sorted(found.items())}


def learn(labelled: DataFrame) -> dict[str, bytes]:
    """A raw-content dictionary for each language of ``labelled`` (``doc_id``, ``text``, ``lang``).

    A language whose sample has no letters is not learned.
    """
    joined = {
        lang: b" ".join(filter(None, map(letters, texts)))[:DICTIONARY]
        for lang, texts in sample_texts(labelled).items()
    }
    return {lang: content for lang, content in joined.items() if content}


class Classifier:
    """Compressors with the dictionaries built in, made once in each Python worker."""

    def __init__(self, dictionaries: Mapping[str, bytes]):
        options = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_checksum=0, write_content_size=0
        )
        self.by_language = {}
        for lang, content in sorted(dictionaries.items()):
            cut = len(content) - min(LEAD, len(content) // 4)
            content, lead = content[:cut], content[cut:] + b" "
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known = {"dict_data": raw} if len(content) >= LEAST else {}
            compressor = zstandard.ZstdCompressor(compression_params=options, **known)
            self.by_language[lang] = compressor, lead, len(compressor.compress(lead))

    def sizes(self, content: bytes) -> dict[str, int]:
        pieces = [content[at : at + PIECE] for at in range(0, len(content), PIECE)]
        return {
            lang: sum(len(c.compress(lead + piece)) - alone for piece in pieces)
            for lang, (c, lead, alone) in self.by_language.items()
        }

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin; the first of equal languages by name."""
        if not self.by_language or not any(map(str.isalpha, text or "")):
            return UNKNOWN, 0.0, 0.0
        content = letters(text)
        ranked = sorted((size, lang) for lang, size in self.sizes(content).items())
        if len(ranked) == 1:
            return ranked[0][1], 1.0, 1.0
        margin = (ranked[1][0] - ranked[0][0]) / max(1, ranked[1][0])
        return ranked[0][1], 1 - math.exp(-margin / SCALE), margin


def prediction(dictionaries: Mapping[str, bytes], text: str = "text") -> Column:
    """``lang_pred``, ``score`` and ``margin`` of ``text`` as a struct."""

    @F.pandas_udf(PREDICTION)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classifier = Classifier(dictionaries)
        for texts in batches:
            rows = [classifier.predict(t) for t in texts]
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "margin"])

    return predict(text)


def held_out(doc_id: str = "doc_id") -> Column:
    """A quarter of the ids, by CRC-32; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(documents: DataFrame, labelled: DataFrame) -> DataFrame:
    """``documents`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    Dictionaries come from a bounded sample of ``labelled`` (``doc_id``, ``text``, ``lang``);
    every whole text of ``documents`` is then classified from its letters alone. ``und``
    with score 0 stands for a null text or one without letters, and for all texts if no
    language could be learned. Texts of any length teach, those of suitable length first. ``rejected`` are these and the texts with a narrow margin.
    Columns of these names are replaced; other columns, nulls and repeated rows pass
    through. An empty table gives no rows.
    """
    guessed, names = _guessed(documents, labelled)
    return guessed.select(
        *restored(names, ("lang_pred", "score", "rejected")),
        "_guess.lang_pred",
        "_guess.score",
        _rejected().alias("rejected"),
    )


def clear(documents: DataFrame, labelled: DataFrame) -> DataFrame:
    """The documents that are not rejected, in the input's columns."""
    guessed, names = _guessed(documents, labelled)
    return guessed.where(~_rejected()).select(*restored(names))


def _guessed(documents: DataFrame, labelled: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    guess = prediction(learn(labelled), "_text")
    rows, names = numbered(documents)
    rows = rows.withColumn("_text", F.col(names["text"]))
    return rows.select(*names.values(), guess.alias("_guess")), names


def _rejected() -> Column:
    return (F.col("_guess.lang_pred") == UNKNOWN) | (F.col("_guess.margin") < MARGIN)
