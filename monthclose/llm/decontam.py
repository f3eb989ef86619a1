"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

A seed is a window of words of which a fixed mask ignores some places; its hash survives a substitution at an ignored place. Seeds
of the benchmark and of the documents are joined on their hashes. Around each hit the benchmark item is laid over the document, and
the words that agree at their places are counted: an overlap counts if some run of ``RUN`` item words (the whole item, if it has
fewer) agrees in at least ``AGREE`` of its places. The masks are chosen by the length of the item: by enumeration, every way in which
that many places can disagree leaves some mask of its set somewhere in the run without a disagreement. A mask begins and ends with
a place that is hashed, so that this also holds where an item hangs over an end of a document.

The seeds of a small benchmark are broadcast. Those of a larger one are broadcast as bits only, ``BITS`` for each in words of 64: a
document's seed that finds all its bits set is shuffled to the seeds of the items, the others (nearly all) end in their task. Texts
are read again for the documents that share a seed with an item, and laid under the items there.

Words are runs of letters and digits, lower case. Defined results: NULL or wordless texts and items match nothing; an item of up to
three words must occur word for word; repeated documents each match; repeated items are one; a NULL id stays NULL. An
empty benchmark or table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthclose.llm.common import stored, without

#: Item words of a run, and the share of them that must agree.
RUN, AGREE = 12, 0.75
#: Masks by the number of item words in a run. 1 is a place that is hashed, 0 one that is ignored.
MASKS_OF = {
    12: ("111011", "110100011", "11001011", "110111"),
    11: ("1101011", "1110011"),
    10: ("111011", "11010011", "11111"),
    9: ("111011", "1001111", "11010011", "111101"),
    8: ("11011", "1111", "1100011"),
    7: ("11111", "111011", "110111"),
    6: ("1111", "11011"),
    5: ("111", "1101"),
    4: ("111", "1101", "1011"),
    3: ("111",),
    2: ("11",),
    1: ("1",),
}
#: Rows of benchmark seeds, and of found ids, that are broadcast at most; beyond them both sides are shuffled.
BROADCAST_ROWS = 200_000
#: Bits for each seed of a benchmark that is not broadcast, and the largest number of 64-bit words: with more seeds each has fewer
#: bits, more seeds of documents pass and are shuffled, and the result is the same.
BITS, MOST_WORDS = 16, 1 << 21


def words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def _seeds(masks: tuple[str, ...], n: Column, position: Column, column: str) -> Column:
    """Hashes of all masks at a position; NULL where the mask does not fit."""
    hashes = []
    for mask in masks:
        kept = [F.get(F.col(column), position + k) for k, bit in enumerate(mask) if bit == "1"]
        hashes.append(F.when(position + len(mask) <= n, F.xxhash64(F.lit(mask), *kept)))
    return F.array(*hashes)


def _exploded(df: DataFrame, keep: list[str], column: str, masks: tuple[str, ...]) -> DataFrame:
    """A row for each position and mask that fits: ``keep``, ``n``, ``at``, ``seed``."""
    n = F.size(column)
    least = min(map(len, masks))
    at = df.where(n >= least).select(*keep, n.alias("n"), F.explode(F.sequence(F.lit(0), n - least)).alias("at"))
    seeds = at.select(*keep, "n", "at", F.explode(_seeds(masks, F.col("n"), F.col("at"), column)).alias("seed"))
    return seeds.where(F.col("seed").isNotNull())


def _agreement(doc: str = "words", item: str = "item_words", offset: str = "offset") -> Column:
    """The largest number of agreeing places in a run of the item, laid over the document from ``offset`` on."""
    return F.expr(f"""
        array_max(transform(
          array(transform(sequence(0, size({item}) - 1),
                          k -> IF({offset} + k >= 0 AND {item}[k] <=> get({doc}, {offset} + k), 1, 0))),
          same -> array_max(transform(
            sequence(0, size(same) - least(size(same), {RUN})),
            s -> aggregate(slice(same, s + 1, {RUN}), 0, (a, b) -> a + b)))))""")


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item id, agreeing): every document with every item that it contains, and the places that agree at best."""
    items = benchmark.select(F.col(item_col).alias("item"), words(F.col(item_text)).alias("item_words")).distinct()
    items = items.where(F.array_max(F.transform("item_words", F.length)) > 0)
    sizes = items.groupBy(F.least(F.size("item_words"), F.lit(RUN)).alias("n"), F.size("item_words").alias("words")).agg(
        F.count("*").alias("c")).collect()  # bounded by lengths
    seeds = sum(r["c"] * sum(r["words"] - len(m) + 1 for m in MASKS_OF[r["n"]]) for r in sizes)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    lengths = sorted({r["n"] for r in sizes}) or [RUN]
    laid = _laid_small(own, items, lengths) if seeds <= BROADCAST_ROWS else _laid_large(own, items, lengths, seeds)
    needed = F.ceil(F.least(F.size("item_words"), F.lit(RUN)) * AGREE)
    found = laid.select("id", "item", _agreement().alias("agreeing"), needed.alias("needed")).where("agreeing >= needed")
    return found.groupBy(F.col("id").alias(id_col), F.col("item").alias(item_col)).agg(F.max("agreeing").alias("agreeing"))


def _index(items: DataFrame, lengths: list[int]) -> DataFrame:
    """(seed, item, item_size, item_at) of the items; ``lengths`` are the words of their runs."""
    index = None
    for n in lengths:
        some = items.where(F.least(F.size("item_words"), F.lit(RUN)) == n)
        part = _exploded(some, ["item", "item_words"], "item_words", MASKS_OF[n]).select(
            "seed", "item", F.col("n").alias("item_size"), F.col("at").alias("item_at"))
        index = part if index is None else index.unionByName(part)
    return index


def _masks(lengths: list[int]) -> tuple[str, ...]:
    return tuple(sorted({m for n in lengths for m in MASKS_OF[n]}))


def _under(size: str) -> list[Column]:
    """(words, offset) with the words of the document that lie under an item of that size alone, so that no row holds a whole text."""
    offset = F.col("offset")
    return [F.slice("words", F.greatest(offset, F.lit(0)) + 1, F.col(size)).alias("words"), F.least(offset, F.lit(0)).alias("offset")]


def _laid_small(own: DataFrame, items: DataFrame, lengths: list[int]) -> DataFrame:
    """(id, words, item, item_words, offset) of the shared seeds. The index fits every executor, and no text leaves its task."""
    split = own.select("id", words(F.col("text")).alias("words"))
    hits = _exploded(split, ["id", "words"], "words", _masks(lengths)).join(F.broadcast(_index(items, lengths)), "seed")
    hits = hits.withColumn("offset", F.col("at") - F.col("item_at")).select("id", "item", *_under("item_size"))
    return hits.join(F.broadcast(items), "item")


def _laid_large(own: DataFrame, items: DataFrame, lengths: list[int], seeds: int) -> DataFrame:
    """The same for an index that is not broadcast."""
    items = stored(items, "items")
    index = stored(_index(items, lengths), "seeds")
    keyed = own.where("text is not null").withColumn("row", F.xxhash64("id", "text"))
    split = keyed.select("row", words(F.col("text")).alias("words"))
    likely = _likely(_exploded(split, ["row", "words"], "words", _masks(lengths)), index, seeds)
    offset = (F.col("at") - F.col("item_at")).alias("offset")
    hits = stored(likely.join(index, "seed").select("row", "item", offset).distinct(), "hits")
    rows = stored(hits.select("row").distinct(), "rows")
    few = F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows
    texts = keyed.join(few, "row", "left_semi").select("row", "id", words(F.col("text")).alias("words"))
    # A merge join: the words are made before the exchange, once for each document.
    laid = hits.join(items, "item").hint("merge").join(texts, "row").withColumn("item_size", F.size("item_words"))
    return laid.select("id", "item", "item_words", *_under("item_size"))


def _likely(rows: DataFrame, index: DataFrame, seeds: int) -> DataFrame:
    """(row, seed, at) of the rows whose seed has all its bits set by seeds of the index: those that are there, and a few others."""
    count = min(MOST_WORDS, 1 << max(0, (seeds * BITS // 64).bit_length()))
    place = F.col("seed").bitwiseAND(F.lit(count - 1))
    own = F.expr(" | ".join(f"shiftleft(1L, cast(shiftright(seed, {k}) & 63 AS int))" for k in (24, 30, 36, 42)))
    bits = index.select(place.alias("place"), own.alias("bits")).groupBy("place").agg(F.bit_or("bits").alias("bits"))
    return rows.join(F.broadcast(bits), (place == F.col("place")) & (F.col("bits").bitwiseAND(own) == own)).select("row", "seed", "at")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of documents without any overlap that counts, all columns. Rows that share an id go together."""
    found = stored(overlaps(docs, benchmark, id_col, text_col).select(id_col).distinct(), "contaminated")
    return without(docs, F.broadcast(found) if found.count() <= BROADCAST_ROWS else found, id_col)


def sql() -> str:
    """The same rows in SQL over the tables documents and benchmark, without seeds: an item that agrees in that many places shares at
    least one word with the document at each offset that counts, so all offsets of shared words are laid over."""
    def split(text: str) -> str:
        return f"string_split(trim(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"

    def places(name: str, key: str) -> str:
        return f"SELECT {key} AS id, len(w) AS size, unnest(w) AS word, unnest(range(0, len(w))) AS p FROM {name}"

    return f"""
        WITH d AS (SELECT doc_id, {split('text')} AS w FROM documents WHERE text IS NOT NULL),
        i AS (SELECT row_number() OVER () AS k, item_id, w FROM (SELECT DISTINCT item_id, {split('text')} AS w FROM benchmark
              WHERE text IS NOT NULL)),
        dw AS (SELECT row_number() OVER () AS k, doc_id, w FROM d),
        agree AS MATERIALIZED (SELECT x.id AS d, y.id AS i, y.size, x.p - y.p AS o, list(y.p) AS hit
                  FROM ({places('dw', 'k')}) x JOIN ({places('i', 'k')}) y ON x.word = y.word WHERE x.word <> ''
                  GROUP BY ALL HAVING count(*) >= ceil(least(y.size, {RUN}) * {AGREE})),
        runs AS (SELECT d, i, size, list_max(list_transform(range(0, size - least(size, {RUN}) + 1),
                   lambda s: len(list_filter(hit, lambda p: p >= s AND p < s + {RUN})))) AS agreeing FROM agree)
        SELECT doc_id, item_id, CAST(max(agreeing) AS INTEGER) AS agreeing FROM runs JOIN dw ON dw.k = d JOIN i ON i.k = runs.i
        WHERE agreeing >= ceil(least(size, {RUN}) * {AGREE}) GROUP BY doc_id, item_id"""
