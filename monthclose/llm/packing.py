"""Packing tokenized documents into sequences, best two fit.

Documents become tokens once; the small table of pieces (no texts) is written to the shared folder. Pieces of one length are
interchangeable, so the packing is planned on the number of pieces of each length, at most as many numbers as a sequence has places,
however many documents there are. A plan is a list of patterns, each used many times: a sequence is filled greedily with the
longest pieces that fit; then its smallest piece gives way to two other pieces if they fill the gap more tightly. Pieces then take
their places by rank within their length: ranks are dealt in salted groups, so that a length that a third of the rows share is
not one task.

Defined results: a NULL or empty text is one piece with the end token alone; rows that share an id are packed each by itself.
An empty table gives no pieces.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthclose.llm.common import small_batches, stored

#: Tokens of a sequence, and the token that ends a document.
SEQUENCE, END_ID = 2048, 0
#: Words whose ids a worker remembers, and rows that one salted group of ranks aims at.
REMEMBERED, GROUP_ROWS = 500_000, 500


# Letters of English and western European words, digits and signs, without what the tokenizer treats in its own way (an
# apostrophe may begin an ending, "<" a special token). Such a stretch is normalised by lower case alone, and is split
# into runs of letters, single digits, and runs of signs.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-;=-@\[-`{-~]+")
_PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> dict[int, str]:
    """The character that byte-level vocabularies use for each byte: itself if it is printable, else one from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class Tokens:
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    The tokenizer never joins characters across plain white space, so it is asked once per different stretch between
    white space; for plain words only its merges are asked. Both memories are bounded.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._merges = self._tokenizer.model
        self._letters = [_byte_letters()[b] for b in range(256)]
        self._stretches: dict[str, bytes] = {}
        self._words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        if len(self._words) > REMEMBERED:
            self._words.clear()
        text = word if word.isascii() else "".join([self._letters[b] for b in word.encode()])
        ids = self._words[word] = np.array([t.id for t in self._merges.tokenize(text)], "<u4").tobytes()
        return ids

    def _stretch(self, stretch: str) -> bytes:
        if len(self._stretches) > REMEMBERED:
            self._stretches.clear()
        if _PLAIN.fullmatch(stretch):
            ids = b"".join([self._words.get(w) or self._word(w) for w in _PARTS.findall(stretch.lower())])
        else:
            ids = np.array(self._tokenizer.encode(stretch, add_special_tokens=False).ids, "<u4").tobytes()
        self._stretches[stretch] = ids
        return ids

    def ids(self, text: str | None) -> bytes:
        words = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        known = self._stretches
        return b"".join([known[w] if w in known else self._stretch(w) for w in words if w])


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE,
    end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document, cut at ``size`` tokens; ``ids`` too if asked for."""
    small_batches(docs.sparkSession)
    names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = (docs.select(id_col).schema.simpleString()[7:-1] + ", piece int, start long, length long, ids_crc32 long"
              + ", ids array<long>" * with_ids)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize = tokens(tokenizer).ids
        for batch in batches:
            rows, ids = [], []
            for k, text in enumerate(batch.column(1)):
                encoded = tokenize(text.as_py()) + end
                for piece, at in enumerate(range(0, len(encoded), 4 * size)):
                    part = encoded[at : at + 4 * size]
                    rows.append((k, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int64))
            found = np.array(rows, np.int64).reshape(-1, 5)
            columns = [batch.column(0).take(pa.array(found[:, 0])), pa.array(found[:, 1].astype(np.int32)),
                       *(pa.array(found[:, k]) for k in (2, 3, 4))]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def plan(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, list[tuple[int, int]]]]:
    """(uses, [(length, pieces of it in one sequence), ...]) patterns that place all pieces."""
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left)
    patterns: list[tuple[int, list[tuple[int, int]]]] = []

    def largest(most: int, used: dict[int, int]) -> int | None:
        """The longest piece up to ``most`` that is still unpacked when ``used`` are taken."""
        k = bisect.bisect_right(lengths, most)
        while k:
            k -= 1
            if left[lengths[k]] > used.get(lengths[k], 0):
                return lengths[k]
        return None

    while lengths:
        used: dict[int, int] = {}
        gap = size
        while gap and (n := largest(gap, used)) is not None:
            take = min(gap // n, left[n] - used.get(n, 0))
            used[n] = used.get(n, 0) + take
            gap -= take * n
        if gap and sum(used.values()) > 1:
            small = min(used)
            room, best = gap + small, (small, None)
            rest = used | {small: used[small] - 1}
            k = bisect.bisect_right(lengths, room)
            while k and best[0] < room:
                k -= 1
                a = lengths[k]
                if 2 * a < best[0]:
                    break  # the longer of two pieces is at least half of what they fill
                if left[a] > rest.get(a, 0):
                    b = largest(min(a, room - a), rest | {a: rest.get(a, 0) + 1})
                    if b is not None and a + b > best[0]:
                        best = (a + b, (a, b))
            if best[1]:
                used = {n: c for n, c in rest.items() if c}
                for n in best[1]:
                    used[n] = used.get(n, 0) + 1
        uses = min(left[n] // c for n, c in used.items())
        patterns.append((uses, sorted(used.items(), reverse=True)))
        for n, c in used.items():
            left[n] -= uses * c
        lengths = [n for n in lengths if left[n]]
    return patterns


def places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """Per length the rows (first rank, pieces in a sequence, first sequence, offset), by first rank."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for uses, parts in patterns:
        offset = 0
        for length, count in parts:
            rows.setdefault(length, []).append((ranks.get(length, 0), count, sequence, offset))
            ranks[length] = ranks.get(length, 0) + uses * count
            offset += length * count
        sequence += uses
    return {n: np.array(r, np.int64) for n, r in rows.items()}


def ranked(parts: DataFrame, order: list[str]) -> DataFrame:
    """``rank`` from 0 within each length. The rows of a length are dealt to as many salted groups as they fill."""
    groups = parts.groupBy("length").agg(F.ceil(F.count("*") / GROUP_ROWS).alias("groups"))  # a row for each length
    salted = parts.join(F.broadcast(groups), "length").withColumn("salt", F.pmod(F.xxhash64(*order), F.col("groups")))
    # A row for each group: a small part of the pieces.
    before = salted.groupBy("length", "salt").count().withColumn(
        "before",
        F.sum("count").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)),
    ).select("length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy(*order)) - 1
    return (salted.withColumn("within", within).join(before, ["length", "salt"])
            .withColumn("rank", F.col("within") + F.col("before")).drop("groups", "salt", "within", "before"))


def packed(parts: DataFrame, id_col: str = "doc_id", size: int = SEQUENCE) -> DataFrame:
    """``parts`` with sequence_id and offset. ``parts`` must be a stored table: it is read twice and must not change."""
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}  # at most ``size`` rows
    table = places(plan(counts, size))
    order = [id_col, "piece", "start", "ids_crc32"]
    names = [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = ranked(parts, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length):
                at, own = np.flatnonzero(length == n), table[int(n)]
                row = own[np.searchsorted(own[:, 0], rank[at], "right") - 1]
                use, place = np.divmod(rank[at] - row[:, 0], row[:, 1])
                sequence[at], offset[at] = row[:, 2] + use, row[:, 3] + place * n
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names[:5]), pa.array(sequence), pa.array(offset)], names=names)

    schema = parts.select(*names[:5]).schema.simpleString()[7:-1] + ", sequence_id long, offset long"
    return rows.select(*names[:5], "rank").mapInArrow(run, schema)


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packed(stored(pieces(docs, tokenizer, id_col, text_col, size, end_id), "pieces"), id_col, size)


def sequences(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
              size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """(sequence_id, ids): the sequences themselves. A sequence is one small group."""
    parts = stored(pieces(docs, tokenizer, id_col, text_col, size, end_id, with_ids=True), "pieces")
    keys = [id_col, "piece", "start", "length", "ids_crc32"]
    where = packed(parts.select(*keys), id_col, size).dropDuplicates(["sequence_id", "offset"])
    ids = parts.select(*keys, "ids", F.row_number().over(Window.partitionBy(*keys).orderBy("ids")).alias("copy"))
    place = where.withColumn("copy", F.row_number().over(Window.partitionBy(*keys).orderBy("sequence_id", "offset")))
    joined = place.join(ids, [place[k].eqNullSafe(ids[k]) for k in [*keys, "copy"]]).select("sequence_id", "offset", "ids")
    return joined.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda r: r["ids"])).alias("ids"))
