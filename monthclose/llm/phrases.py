"""Phrases of two to four words that stand together more often than their parts stand alone.

Texts become bytes with one space between words, and prefix polynomials over these bytes (modulo two primes) give the
Rabin-Karp fingerprint of any stretch of words by one subtraction. Three readings of the texts:

1. fingerprints of all words and pairs of words are counted, first within a block of text, then by a shuffle;
2. so are those of three and four words, but only where every pair in them is frequent (a longer phrase is never more frequent
   than its parts). What is frequent reaches the tasks as a Bloom filter of bounded size, so its false positives only cost time;
3. stretches whose fingerprint may be frequent are grouped by fingerprint in their block, each group with a pointer to its
   first occurrence. All others are compared with the text there, byte by byte, so that collisions come apart, and only then are
   phrases made of them, whose counts are added up exactly, by their text, along with the first document that has them.

All that follows (cuts, scores, longer phrases, the best of each language) is on the frequent phrases alone.

Defined results: A NULL text has no words; a NULL language is ``und``. Texts of any length are read whole, in blocks that
overlap by three words where a piece is cut; a block is at least as long as its longest word. Repeated rows count each for itself.
An empty table gives no rows. Columns that are not named take no part.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthclose.llm.common import stored

#: Contract of the query: longest phrase, least count, share of a that a longer phrase must reach, rows of a language.
LONGEST, LEAST, SHARE, TOP = 4, 30, 80, 2000
#: Bytes of text that are hashed at once.
BLOCK = 2 << 20
#: Two primes below 2 ** 31 and a base for each.
MODULI = ((2_147_483_647, 1_000_003), (2_147_483_629, 911_382_323))
#: Bits of a Bloom filter per key, at most so many bits altogether (32 MB).
KEY_BITS, MOST_BITS = 16, 1 << 28
#: Scores (0 to a million) are counted by ranges of this size.
BAND = 1000
#: Parts in which a language's candidates are ranked before the best of them meet.
SALTS = 32

_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?\n\v\f\r"]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAKS, _GAPS, _WORDS = re.compile(rb"[.,;:!?\x0A-\x0D]"), re.compile(rb"[.,;:!?\x09-\x0D\x20]"), re.compile(rb"[^\x09\x20]+")

_powers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(modulus: int, base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** k and base ** -k modulo ``modulus`` for k up to ``size``."""
    known = _powers.get((modulus, base))
    if known is None or len(known[0]) <= size:
        size = max(size + 1, BLOCK + BLOCK // 4)

        def table(b: int) -> np.ndarray:
            out = np.ones(1, np.uint32)
            while len(out) <= size:
                more = out * np.uint64(pow(b, len(out), modulus)) % np.uint64(modulus)
                out = np.concatenate([out, more.astype(np.uint32)])
            return out[: size + 1].copy()

        known = _powers[modulus, base] = table(base), table(pow(base, -1, modulus))
    return known


def long_text_blocks(text: bytes, block: int) -> Iterator[tuple[bytes, int]]:
    """(block, words in front that were in the block before) of a long text; a piece is cut between words only."""
    at, carry = 0, 0
    while at + block < len(text):
        end = max((m.end() for m in _BREAKS.finditer(text, at, at + block)), default=at)
        again = 0
        if end == at:  # one piece so far: cut at its end, or at a blank after enough words
            end = at + block
            while gap := _GAPS.search(text, end):
                end = gap.end()
                if text[gap.start()] not in b"\t ":
                    break
                starts = [m.start() for m in _WORDS.finditer(text, at, end)]
                if len(starts) > 2 * LONGEST:
                    again = LONGEST - 1
                    break
            else:
                break
        yield text[at:end], carry
        at, carry = starts[-again] if again else end, again
    yield text[at:], carry


class Block:
    """Words of some texts, and the fingerprint of any stretch of them.

    ``rows`` are the texts' numbers in their batch, ``carry`` the words in front that only lead into the first new one.
    """

    def __init__(self, texts: list[bytes], rows: list[int], salts: np.ndarray, carry: int = 0, moduli=MODULI):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        kind = _KIND[raw]
        inside = kind == _WORD
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        lengths = ends - starts
        self.carry = carry
        self.piece = np.cumsum(kind == _BREAK, dtype=np.int32)[starts]
        first = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        place = np.searchsorted(first, starts, "right") - 1
        self.row = np.asarray(rows, np.int64)[place]
        keep = inside.copy()
        keep[ends] = True
        self.bytes = np.where(inside, _LOWER[raw], np.uint8(32))[keep]
        self.end = np.cumsum(lengths + 1) - 1
        self.start = self.end - lengths
        self.salt = salts[self.row]
        self._prefix = []
        for modulus, base in moduli:
            power, inverse = _power_tables(modulus, base, len(self.bytes))
            terms = (self.bytes.astype(np.uint64) + np.uint64(1)) * power[: len(self.bytes)] % np.uint64(modulus)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
            self._prefix.append((np.uint64(modulus), sums[self.start], sums[self.end], inverse[self.start].astype(np.uint64)))

    def stretches(self, n: int, also: np.ndarray | None = None) -> np.ndarray:
        """First words of the stretches of ``n`` words that lie within a piece and are new in this block."""
        count = max(len(self.start) - n + 1, 0)
        fits = self.piece[:count] == self.piece[n - 1 :]
        fits[: max(self.carry - n + 1, 0)] = False
        return np.flatnonzero(fits if also is None else fits & also[:count])

    def prints(self, at: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the stretches of ``n`` words that begin ``at``; the group's salt is part of them."""
        out = np.zeros(len(at), np.uint64)
        for modulus, left, right, inverse in self._prefix:
            value = (right[at + n - 1] - left[at]) % modulus * inverse[at] % modulus
            out = (out << np.uint64(31)) ^ value
        return (out ^ self.salt[at]).view(np.int64)


def _positions(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each key in a filter of ``bits`` bits, a power of two."""
    mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mask = np.uint64(bits - 1)
    return (mixed >> np.uint64(32)) & mask, mixed & mask


class Bloom:
    """Keys that may be in a set."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def holds(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for place in _positions(keys, 64 * len(self.words)):
            found &= (self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def bloom(keys: DataFrame) -> Bloom:
    """Bit words are merged by a shuffle; the driver gets at most 4 million of them, whatever the number of keys."""
    bits = 1 << 12
    while bits < KEY_BITS * keys.count() and bits < MOST_BITS:
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.concatenate(_positions(batch.column(0).to_numpy(), bits))
            yield pa.RecordBatch.from_arrays(
                [pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (place & np.uint64(63))).view(np.int64))],
                names=["word", "bits"])

    merged = keys.select("key").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[merged.column("word").to_numpy()] = merged.column("bits").to_numpy().view(np.uint64)
    return Bloom(words)


def _texts(batch: pa.RecordBatch) -> Iterator[bytes | None]:
    """The texts of a batch, a few at a time."""
    for at in range(0, len(batch), 256):
        yield from batch.column(1).slice(at, 256).cast(pa.binary()).to_pylist()


def _stretches(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The stretches of ``data`` from ``start`` to ``end`` as texts."""
    length = end - start
    offsets = np.concatenate([[0], np.cumsum(length)])
    place = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)
    return pa.Array.from_buffers(
        pa.string(), len(start), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[place])])


def _blocks(batch: pa.RecordBatch, langs: list[str], moduli, block: int) -> Iterator[Block]:
    """Blocks of a batch (lang, text, ...)."""
    salts = np.array([zlib.crc32(x.encode()) * 0x9E3779B97F4A7C15 & 0x3FFFFFFFFFFFFFFF for x in langs], np.uint64)
    held, rows, size = [], [], 0
    for k, text in enumerate(_texts(batch)):
        if not text:
            continue
        if len(text) > block:
            for part, carry in long_text_blocks(text, block):
                yield Block([part], [k], salts, carry, moduli)
            continue
        held.append(text)
        rows.append(k)
        size += len(text) + 1
        if size >= block:
            yield Block(held, rows, salts, 0, moduli)
            held, rows, size = [], [], 0
    if held:
        yield Block(held, rows, salts, 0, moduli)


def _counts(texts: DataFrame, chosen, least: int, moduli, block: int) -> DataFrame:
    """(key) of the fingerprints that ``chosen(block)`` yields ``least`` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in _blocks(batch, batch.column(0).to_pylist(), moduli, block):
                key, n = np.unique(np.concatenate([*chosen(found)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    counted = texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return stored(counted.where(F.col("n") >= least).select("key"), "frequent")


def _equal(block: Block, length: np.ndarray, start: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether the bytes from ``start`` are those from ``other``; both are ``length`` bytes long."""
    padded = np.concatenate([block.bytes, np.zeros(8, np.uint8)]).astype(np.uint64)
    eight = np.zeros(len(block.bytes) + 1, np.uint64)
    for k in range(8):
        eight |= padded[k : k + len(eight)] << np.uint64(8 * k)
    same, active, at = np.ones(len(start), bool), np.arange(len(start)), 0
    while len(active):
        rest = np.minimum(length[active] - at, 8).astype(np.uint64)
        mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * rest)
        fine = ((eight[start[active] + at] ^ eight[other[active] + at]) & mask) == 0
        same[active[~fine]] = False
        at += 8
        active = active[fine & (length[active] > at)]
    return same


def _phrases(block: Block, at: np.ndarray, n: int, lang: np.ndarray, ids: np.ndarray):
    """(first word, count, smallest id) of each different phrase among the stretches: groups by fingerprint, verified against the text."""
    if not len(at):
        return
    key = block.prints(at, n)
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    while len(at):
        fresh = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        pointer = at[np.repeat(fresh, np.diff(np.append(fresh, len(at))))]
        start, other = block.start[at], block.start[pointer]
        length = block.end[at + n - 1] - start
        same = (length == block.end[pointer + n - 1] - other) & (lang[block.row[at]] == lang[block.row[pointer]])
        same[same] = _equal(block, length[same], start[same], other[same])
        kept = at[same]  # those that a collision mixed in go round again
        group = np.flatnonzero(np.concatenate([[True], key[same][1:] != key[same][:-1]]))
        yield kept[group], np.diff(np.append(group, len(kept))), np.minimum.reduceat(ids[block.row[kept]], group)
        at, key = at[~same], key[~same]


def frequent_phrases(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
    moduli=MODULI, block: int = BLOCK,
) -> DataFrame:
    """(lang, n, phrase, f, id): all phrases of one to four words that occur ``least`` times; ``id`` is the first document that has them.

    A row of no words per language has the number of all its words. ``moduli`` and ``block`` have no influence on the result.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"),
        F.col(id_col).cast("long").alias("id"))
    pairs = _counts(texts, lambda b: (b.prints(b.stretches(n), n) for n in (1, 2)), least, moduli, block)
    sc = docs.sparkSession.sparkContext
    short = sc.broadcast(bloom(pairs))

    def strong(b: Block, known: Bloom) -> np.ndarray:
        """Words that may begin a frequent pair."""
        strong = np.zeros(len(b.start), bool)
        carry, b.carry = b.carry, 0
        at = b.stretches(2)
        b.carry = carry
        strong[at] = known.holds(b.prints(at, 2))
        return strong

    def longer(b: Block) -> Iterator[np.ndarray]:
        all_strong = strong(b, short.value)
        for n in range(3, LONGEST + 1):
            all_strong = all_strong[:-1] & all_strong[1:]  # the stretches of n - 1 words from here and from the next word
            yield b.prints(b.stretches(n, all_strong), n)

    longs = _counts(texts, longer, least, moduli, block)
    long = sc.broadcast(bloom(longs))
    names = ["lang", "n", "phrase", "f", "id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            lang = np.unique(langs, return_inverse=True)[1]
            ids = batch.column(2).fill_null(np.iinfo(np.int64).max).to_numpy()
            names_of = pa.array(langs, pa.string())
            some = dict(zip(lang.tolist(), range(len(lang)), strict=True))
            for b in _blocks(batch, langs, moduli, block):
                words = np.bincount(lang[b.row[b.carry :]])
                seen = np.flatnonzero(words)
                empty = pa.nulls(len(seen), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [names_of.take(pa.array([some[code] for code in seen.tolist()], pa.int64())), pa.array(np.zeros(len(seen), np.int32)),
                     pa.array([""] * len(seen), pa.string()), pa.array(words[seen]), empty], names=names)
                for n in range(1, LONGEST + 1):
                    at = b.stretches(n)
                    at = at[(short if n < 3 else long).value.holds(b.prints(at, n))]
                    for first, count, owner in _phrases(b, at, n, lang, ids):
                        yield pa.RecordBatch.from_arrays(
                            [names_of.take(pa.array(b.row[first])), pa.array(np.full(len(first), n, np.int32)),
                             _stretches(b.bytes, b.start[first], b.end[first + n - 1]), pa.array(count), pa.array(owner)], names=names)

    found = texts.mapInArrow(run, "lang string, n int, phrase string, f long, id long")
    summed = found.groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f"), F.min("id").alias("id"))
    known = F.col("id") != np.iinfo(np.int64).max
    return stored(summed.where((F.col("f") >= least) | (F.col("n") == 0)).select(
        "lang", "n", "phrase", "f", F.when(known, F.col("id")).alias("id")), "phrases")


def _exact(column: str):
    return F.col(column).cast("decimal(20,0)")


def collocations(frequent: DataFrame, least: int = LEAST, share: int = SHARE) -> DataFrame:
    """(lang, phrase, a, l, r, score, id) of the candidates that no longer candidate covers, at their lowest-scoring cut.

    ``frequent`` is the stored table of frequent phrases. Keys that many candidates share (a common first word) are split by Spark's
    skew handling, as the table has one row of each.
    """
    table = frequent.where("n > 0").select("lang", "phrase", "f")
    candidates = frequent.where(f"n > 1 AND f >= {least}").withColumn("words", F.split("phrase", " "))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
    part = lambda begin, length: F.concat_ws(" ", F.slice("words", begin, length))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "id", "k", part(F.lit(1), F.col("k")).alias("head"),
                       part(F.col("k") + 1, F.col("n") - F.col("k")).alias("tail"))
    cuts = cuts.join(table.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(table.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    score = F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * _exact("a"), _exact("l") + _exact("r"))
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "id").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inside = candidates.where("n > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("n") - 1))).withColumn(
        "from", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("m") + 1)))
    covered = inside.select("lang", part(F.col("from"), F.col("m")).alias("phrase"), "f").groupBy("lang", "phrase").agg(
        F.max("f").alias("longer"))
    covers = F.lit(100).cast("decimal(3,0)") * _exact("longer") >= F.lit(share).cast("decimal(3,0)") * _exact("a")
    return lowest.join(covered, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~covers).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"), "id")


def best(found: DataFrame, frequent: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` of each language, ranked, with n, the number of its words.

    Scores below those of the best ``top`` are found from counts by ranges of scores; the rest is ranked in parts, and then at once.
    """
    found = stored(found.withColumn("band", F.floor(F.col("score") / BAND)), "collocations")
    bands = found.groupBy("lang", "band").count()  # at most 1001 rows for a language
    above = F.sum("count").over(Window.partitionBy("lang").orderBy(F.col("band").desc()).rowsBetween(Window.unboundedPreceding, -1))
    needed = bands.withColumn("above", F.coalesce(above, F.lit(0))).where(F.col("above") < top).select("lang", "band")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = found.join(needed, ["lang", "band"], "left_semi").withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    parts = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    ranked = parts.where(F.col("rank") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    words = frequent.where("n = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "id")


def mine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, id): the best phrases of each language, and the first document that has each."""
    frequent = frequent_phrases(docs, id_col, text_col, lang_col)
    return best(collocations(frequent), frequent)


def sql(least: int = LEAST, share: int = SHARE, top: int = TOP) -> str:
    grams = " UNION ALL ".join(
        f"SELECT lang, {n} AS n, unnest(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS phrase "
        "FROM pieces" for n in range(1, LONGEST + 1))
    cuts = " UNION ALL ".join(
        f"SELECT lang, phrase, f, {k} AS k, array_to_string(w[1:{k}], ' ') AS head, array_to_string(w[{k + 1}:], ' ') AS tail "
        f"FROM candidates WHERE n > {k}" for k in range(1, LONGEST))
    inside = " UNION ALL ".join(
        f"SELECT lang, array_to_string(w[{s}:{s + m - 1}], ' ') AS phrase, f FROM candidates WHERE n > {m} AND n >= {s + m - 1}"
        for m in range(2, LONGEST) for s in range(1, LONGEST - m + 2))
    return f"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w
    FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM texts)),
words AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS ({grams}),
counts AS (SELECT lang, n, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {least}),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE n > 1),
cuts AS ({cuts}),
scored AS (SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r,
    CAST((CAST(2000000 AS HUGEINT) * c.f) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covered AS (SELECT lang, phrase, max(f) AS longer FROM ({inside}) GROUP BY ALL),
kept AS (SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
    FROM lowest s LEFT JOIN covered v ON v.lang = s.lang AND v.phrase = s.phrase
    WHERE v.longer IS NULL OR CAST(100 AS HUGEINT) * v.longer < CAST({share} AS HUGEINT) * a)
SELECT k.lang, rank, phrase, a, l, r, n, score FROM kept k JOIN words w ON w.lang = k.lang WHERE rank <= {top}
"""
