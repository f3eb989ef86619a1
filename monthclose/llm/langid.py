"""Language identification by compression.

Each language has a raw-content zstandard dictionary of training text. A text is cut into pieces that are compressed with
every dictionary, each piece on its own so that a long text cannot stand in for the dictionary; the language with the
fewest bytes over all pieces wins. A narrow margin is reported as a rejection.

Defined results: NULL or letterless text gives ``und`` with score 0; so does every text if nothing could be learned. With a
single learned language all texts with letters get it, with score 1. Equal sizes go to the language with the
larger dictionary, then to the first by name. Repeated rows
are scored each by itself. Rows without a language, or with a text without letters, teach nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthclose.llm.common import small_batches

#: Bounds of the training sample: rows of a language, and characters taken from one row at a hashed place.
ROWS_PER_LANGUAGE, CHARS_PER_ROW = 400, 1000
#: Parts in which the rows of a language are ranked first.
PARTS = 8
#: Bytes of one dictionary, characters of one compressed piece, and the compression level.
DICTIONARY_BYTES, PIECE_CHARS, LEVEL = 200_000, 1200, 3
#: Below this relative margin between the two smallest sizes the choice counts as rejected.
NARROW = 0.01

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters_only(text: str | None) -> str:
    """Lower-case letters with single spaces between runs of them; empty if there is no letter."""
    cleaned = _NOT_LETTERS.sub(" ", text or "").strip().lower()
    return cleaned if any(map(str.isalpha, cleaned)) else ""


def training_sample(
    docs: DataFrame, train: Column, id_col: str, text_col: str, lang_col: str,
    rows: int = ROWS_PER_LANGUAGE, chars: int = CHARS_PER_ROW,
) -> DataFrame:
    """At most ``rows`` rows of each language in hash order, each with ``chars`` characters from a hashed place.

    The choice is made on ids, in parts of a language first; only the slices of chosen rows go on. Of rows that share an id and
    a language, that with the smallest checksum of its slice is taken.
    """
    key = F.xxhash64(F.col(id_col))
    labelled = docs.where(train & F.col(lang_col).isNotNull())
    ids = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), key.alias("key")).distinct()
    for part in (["lang", F.pmod(F.col("key"), F.lit(PARTS))], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*part).orderBy("key", "id"))
        ids = ids.withColumn("rank", rank).where(F.col("rank") <= rows)
    ids = ids.select("id", "lang")
    start = F.pmod(key, F.greatest(F.length(text_col) - chars, F.lit(0)) + 1) + 1
    slices = labelled.select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"),
        F.col(text_col).substr(start.cast("int"), F.lit(chars)).alias("slice"),
    )
    chosen = slices.where(F.col("slice").isNotNull()).join(ids, ["id", "lang"], "left_semi")
    first = F.row_number().over(Window.partitionBy("id", "lang").orderBy(F.xxhash64("slice"), "slice"))
    return chosen.withColumn("row", first).where("row = 1").drop("row")


def learn(sample: DataFrame, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """A dictionary per language from the bounded sample. The order of the rows is fixed."""
    text: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", F.xxhash64("id"), "slice").toLocalIterator():
        if cleaned := letters_only(row["slice"]):
            text.setdefault(row["lang"], []).append(cleaned)
    joined = {lang: " ".join(parts).encode()[:dictionary_bytes] for lang, parts in text.items()}
    return dict(sorted(joined.items(), key=lambda item: (-len(item[1]), item[0])))


class Sizes:
    """Compressed sizes of texts under each dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        self.languages = list(dictionaries)
        self._compressors = []
        for lang in self.languages:
            raw = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=level)
            self._compressors.append(zstandard.ZstdCompressor(
                level=level, dict_data=raw, write_content_size=False, write_dict_id=False))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected). The score is the margin to the second smallest size, relative to that size."""
        cleaned = letters_only(text)
        if not cleaned or not self.languages:
            return "und", 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        pieces = [cleaned[k : k + PIECE_CHARS].encode() for k in range(0, len(cleaned), PIECE_CHARS)]
        totals = [sum(len(c.compress(p)) for p in pieces) for c in self._compressors]
        order = sorted(range(len(totals)), key=lambda k: (totals[k], k))
        best, second = totals[order[0]], totals[order[1]]
        score = (second - best) / second
        return self.languages[order[0]], score, score < NARROW


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, lang_pred, score, rejected) of every row, from its whole text alone."""
    small_batches(docs.sparkSession)
    schema = docs.select(id_col).schema.simpleString()[7:-1] + ", lang_pred string, score double, rejected boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(dictionaries)
        for batch in batches:
            found = [sizes.predict(t.as_py()) for t in batch.column(1)]
            columns = [pa.array(c, t) for c, t in zip(
                zip(*found, strict=True) if found else ([], [], []),
                (pa.string(), pa.float64(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=[id_col, "lang_pred", "score", "rejected"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)
