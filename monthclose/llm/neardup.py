"""Near-duplicate documents by fast similarity sketching, banding, and exact verification.

A document is the set of its five-word shingles. The sketch throws every shingle into one of as many bins as it has coordinates in a round, each bin
keeps its smallest value; empty bins get their chance in further rounds with new hashes, and after as many rounds as there are
bins each round serves one bin with all shingles, so every coordinate fills. Two sketches agree at a coordinate with the
Jaccard similarity of the sets as probability, and concentrate like independent samples.

Documents with equal sets are one class. Bands of coordinates are bucketed; each bucket is tied to its smallest class only, and the
ties give coarse groups, which hold every pair that shares a bucket. Within the groups all pairs are compared on their full
sets, as products of incidence matrices of blocks; a block passes on a spanning forest of its links, never its pairs. Large groups are cut
into blocks by set size (sets that differ too much in size cannot be linked) and by hash, so that no task holds a whole group.
Blocks of one large group of different sets still meet in pairs: that work grows with the square of the group, spread over its blocks.

The threshold is a parameter, in percent; the number of bands and the size steps follow from it. A pair at the threshold is missed
with a probability of 3 in a million at most, and less above: 40 bands of 8 at 85 percent, 70 at 80.

Defined results: NULL or wordless text has an empty set, is linked with nothing, and is its own component. Rows with equal text are one
class whatever their ids. Ids may repeat, and may be NULL: such rows take part by their text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose.llm.common import small_batches, spread_join, stored, without
from monthclose.llm.components import components

#: Words of a shingle; the threshold in percent, unless another is given; coordinates of a band; the share of pairs at the threshold
#: that no band may find.
WORDS, PERCENT, ROWS, MISSED = 5, 85, 8, 3e-6
#: Documents and shingles of one block; bytes that are hashed at once; ids that are broadcast at most.
BLOCK_DOCS, BLOCK_SHINGLES, SEGMENT, BROADCAST_ROWS = 256, 1_000_000, 1 << 20, 500_000

_BASE = 0x9E3779B97F4A7C15
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stream(seed: int, n: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed))


_LETTER = _stream(1, 256)
_PLACE_IN_SHINGLE = _stream(2, WORDS) | np.uint64(1)
_IN_WORD = np.ones(256, bool)
_IN_WORD[[32, 9, 10, 11, 12, 13]] = False


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    base, inverse = _BASE | 1, pow(_BASE | 1, -1, 1 << 64)
    ones = lambda b: np.concatenate([[np.uint64(1)], np.full(SEGMENT, b, np.uint64)]).cumprod(dtype=np.uint64)
    return ones(base), ones(inverse)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each word of lower-case bytes: differences of prefix sums of a polynomial."""
    inside = np.concatenate([[False], _IN_WORD[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    hashes = np.empty(len(starts), np.uint64)
    power, inverse = _powers()
    at = 0
    while at < len(starts):
        origin = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, origin + SEGMENT, "right")))
        s, e = starts[at:upto] - origin, ends[at:upto] - origin
        size = int(e[-1])
        if size <= SEGMENT:
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(_LETTER[data[origin : origin + size]] * power[:size], out=sums[1:])
            hashes[at:upto] = _mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        else:  # a single word that is longer than a segment
            import hashlib

            whole = hashlib.blake2b(data[origin : origin + size].tobytes(), digest_size=8).digest()
            hashes[at:upto] = np.frombuffer(whole, "<u8")
        at = upto
    return hashes, starts


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted different shingles of each text as 64-bit hashes."""
    found: list[np.ndarray] = []
    group: list[bytes] = []
    size = 0
    for text in texts:
        group.append((text or "").encode().lower())  # bytes: A-Z alone change
        size += len(group[-1]) + 1
        if size >= SEGMENT:
            found += _sets(group)
            group, size = [], 0
    return found + _sets(group)


def _sets(group: list[bytes]) -> list[np.ndarray]:
    if not group:
        return []
    data = np.frombuffer(b"\n".join(group), np.uint8)
    begins = np.cumsum([0, *(len(g) + 1 for g in group[:-1])])
    words, starts = _word_hashes(data)
    first = np.searchsorted(starts, np.append(begins, len(data) + 1))
    full = max(len(words) - WORDS + 1, 0)
    shingles = np.zeros(full, np.uint64)
    for k in range(WORDS):
        shingles += words[k : k + full] * _PLACE_IN_SHINGLE[k]
    shingles = _mix(shingles)
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        n = b - a
        if n >= WORDS:
            sets.append(np.unique(shingles[a : b - WORDS + 1]))
        elif n:
            whole = (words[a:b] * _PLACE_IN_SHINGLE[:n]).sum(dtype=np.uint64) + np.uint64(n)
            sets.append(_mix(np.array([whole])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def vertex_of(shingles: np.ndarray) -> int | None:
    """A fingerprint of the set; None if it is empty."""
    if not len(shingles):
        return None
    total = _mix(shingles ^ np.uint64(_BASE)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(_mix(np.array([total])).view(np.int64)[0])


def bands_for(percent: int) -> int:
    """Bands that miss a pair at the threshold with a probability of ``MISSED`` at most."""
    if not 0 < percent < 100:
        raise ValueError(f"no threshold between 0 and 100 percent: {percent}")
    return math.ceil(math.log(MISSED) / math.log1p(-((percent / 100) ** ROWS)))


def sketches(sets: list[np.ndarray], places: int) -> np.ndarray:
    """A row of ``places`` coordinates for each set that is not empty; rows of empty sets stay empty."""
    out = np.full((len(sets), places), _EMPTY)
    flat = out.reshape(-1)
    elements = np.concatenate([np.zeros(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    open_sets = np.array([len(s) > 0 for s in sets], bool)
    for turn in range(2 * places):
        if not len(elements):
            break
        hashed = _mix(elements + np.uint64((turn + 1) * _BASE % (1 << 64)))
        if turn < places:
            bins = ((hashed >> np.uint64(32)) * np.uint64(places) >> np.uint64(32)).astype(np.int64)
        else:
            bins = np.full(len(elements), turn - places)
        at = owner * places + bins
        free = flat[at] >> np.uint64(32) >= np.uint64(turn)  # filled in this round at the earliest
        np.minimum.at(flat, at[free], (hashed[free] & np.uint64(0xFFFFFFFF)) | np.uint64(turn << 32))
        still = open_sets & (out == _EMPTY).any(axis=1)
        if still.sum() < open_sets.sum():
            open_sets = still
            keep = open_sets[owner]
            elements, owner = elements[keep], owner[keep]
    return out


def band_keys(sketch: np.ndarray, bands: int) -> np.ndarray:
    parts = sketch.reshape(len(sketch), bands, -1)
    keys = np.broadcast_to(_stream(3, bands), (len(sketch), bands)).copy()
    for k in range(parts.shape[2]):
        keys = _mix(keys ^ parts[:, :, k])
    return keys.view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, vertex, bands) of every row; vertex and bands are NULL for empty sets."""
    small_batches(docs.sparkSession)
    count = bands_for(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist())
            vertices = [vertex_of(s) for s in sets]
            keys = band_keys(sketches(sets, count * ROWS), count) if sets else np.zeros((0, count), np.int64)
            bands = pa.ListArray.from_arrays(
                pa.array(np.arange(0, keys.size + 1, count, dtype=np.int32)), pa.array(keys.reshape(-1)),
                mask=pa.array([v is None for v in vertices], pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(vertices, pa.int64()), bands],
                names=["id", "n_shingles", "vertex", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(
        run, "id long, n_shingles long, vertex long, bands array<long>")


def candidates(classes: DataFrame) -> DataFrame:
    """(a, b): each class with the smallest class of each of its buckets. Bucket minima are combined before the shuffle."""
    keys = classes.select("vertex", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("vertex").alias("hub"), F.max("vertex").alias("top")).where("hub < top")
    return keys.join(shared.select("key", "hub"), "key").where("vertex <> hub").select(
        F.col("vertex").alias("a"), F.col("hub").alias("b")).distinct()


def blocks(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(id, root, left, right, side) from (id, root, n, vertex): the block pairs in which each member is compared.

    A small group is one block. In a large one a block is a step of set size and a part of the members there; a pair of blocks is
    formed within a step and between neighbouring steps, since linked sets differ by one step at most.
    """
    step = F.floor(F.log(F.col("n")) / -F.log(F.lit(percent / 100)))
    totals = stored(members.groupBy("root").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles")), "totals")
    small = (F.col("docs") <= BLOCK_DOCS) & (F.col("shingles") <= BLOCK_SHINGLES)
    marked = totals.select("root", "docs", small.alias("small"))
    sized = stored(spread_join(members, marked, ["root"], "docs").withColumn("step", step), "sized")
    one = sized.where("small").select("id", "root", F.lit("").alias("left"), F.lit("").alias("right"), F.lit(0).alias("side"))
    large = sized.where("not small")
    parts = large.groupBy("root", "step").agg(F.count("*").alias("docs"), F.greatest(
        F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("own"))
    beside = parts
    for d, name in ((1, "above"), (-1, "below")):
        beside = beside.join(
            parts.select("root", (F.col("step") - d).alias("step"), F.col("own").alias(name)), ["root", "step"], "left")
    placed = spread_join(large, stored(beside, "parts"), ["root", "step"], "docs")
    part = F.pmod(F.xxhash64("vertex"), F.col("own"))
    none = F.array().cast("array<struct<l:string,r:string,s:int>>")

    def name(step_col, part_col):
        return F.concat_ws(".", step_col.cast("string"), part_col.cast("string"))

    def pairs(count: str, make) -> F.Column:
        counted = F.coalesce(F.col(count), F.lit(0))
        return F.when(counted > 0, F.transform(F.sequence(F.lit(0), counted.cast("int") - 1), make)).otherwise(none)

    own, at = F.col("part"), F.col("step")
    within = pairs("own", lambda q: F.struct(
        name(at, F.least(own, q.cast("long"))).alias("l"), name(at, F.greatest(own, q.cast("long"))).alias("r"),
        F.when(own > q, 1).otherwise(0).alias("s")))
    up = pairs("above", lambda q: F.struct(name(at, own).alias("l"), name(at + 1, q).alias("r"), F.lit(0).alias("s")))
    down = pairs("below", lambda q: F.struct(name(at - 1, q).alias("l"), name(at, own).alias("r"), F.lit(1).alias("s")))
    many = placed.withColumn("part", part).select("id", "root", F.explode(F.concat(within, up, down)).alias("p")).select(
        "id", "root", F.col("p.l").alias("left"), F.col("p.r").alias("right"), F.col("p.s").alias("side"))
    return one.unionByName(many)


def linked(sets: list[np.ndarray], side: np.ndarray, whole: bool, percent: int = PERCENT) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets (``whole``) or between the two sides, as pairs of places."""
    sizes = np.array([len(s) for s in sets])
    values, places = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    common = np.bincount(places, minlength=len(values)) > 1
    keep = common[places]
    column, owner = (np.cumsum(common) - 1)[places[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    shared = np.zeros((len(sets), len(sets)), np.float64)
    total = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, total, 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        incidence = np.zeros((len(sets), min(4096, total - low)), np.float32)
        incidence[owner[a:b], column[a:b] - low] = 1
        shared += incidence @ incidence.T
    near = 100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)
    if not whole:
        near &= side[:, None] != side[None, :]
    np.fill_diagonal(near, True)
    label = np.arange(len(sets))
    while True:
        least = np.where(near, label[None, :], len(sets)).min(axis=1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    return [(k, int(v)) for k, v in enumerate(label) if k != v]


def _verify(table: pa.Table, percent: int) -> pa.Table:
    """Links between the classes of one block or pair of blocks, on their full sets."""
    sets, sides, vertices = [], [], []
    known: set[int] = set()
    for s, side in zip(shingle_sets(table.column("text").to_pylist()), table.column("side").to_pylist(), strict=True):
        vertex = vertex_of(s)
        if vertex is not None and vertex not in known:
            known.add(vertex)
            sets.append(s)
            sides.append(side)
            vertices.append(vertex)
    whole = table.num_rows == 0 or table.column("left")[0].as_py() == table.column("right")[0].as_py()
    links = linked(sets, np.array(sides), whole, percent) if len(sets) > 1 else []
    return pa.table({"a": pa.array([vertices[i] for i, _ in links], pa.int64()),
                     "b": pa.array([vertices[j] for _, j in links], pa.int64())})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row; sets with a similarity of ``percent`` or more are linked."""
    signed = stored(signatures(docs, id_col, text_col, percent), "signatures")
    classes = signed.where("vertex is not null").groupBy("vertex").agg(
        F.min("id").alias("rep"), F.max("n_shingles").alias("n"), F.count("*").alias("rows"), F.first("bands").alias("bands"))
    coarse = components(candidates(classes))
    members = stored(
        coarse.join(classes.select("vertex", "rep", "n"), "vertex").select(
            F.col("rep").alias("id"), "root", "n", "vertex"), "members")
    placed = blocks(members, percent)
    side = F.broadcast(placed) if placed.count() <= BROADCAST_ROWS else placed
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text"))
    together = texts.join(side, F.col("_id").eqNullSafe(F.col("id"))).select("root", "left", "right", "side", "text")
    links = together.groupBy("root", "left", "right").applyInArrow(
        lambda table: _verify(table, percent), "a long, b long")
    roots = components(links)
    named = classes.select("vertex", "rep", "rows")
    groups = stored(roots.join(named.drop("rows"), "vertex"), "groups")
    least = stored(groups.groupBy("root").agg(F.min("rep").alias("component"), F.count("*").alias("classes")), "least")
    of_linked = spread_join(groups, least, ["root"], "classes").select("vertex", "component")
    of_class = stored(named.join(of_linked, "vertex", "left").select(
        "vertex", "rows", F.coalesce("component", "rep").alias("component")), "classes")
    full, empty = signed.where("vertex is not null"), signed.where("vertex is null")
    found = spread_join(full.select("id", "n_shingles", "vertex"), of_class, ["vertex"], "rows").unionByName(
        empty.select("id", "n_shingles", "vertex", F.col("id").alias("component")))
    return found.select(
        F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One document of each group, all columns: that of the smallest id. Rows that share an id are one document, and stay if one
    of them does."""
    found = near_duplicates(docs.select(id_col, text_col), id_col, text_col, percent).select(F.col(id_col).alias("id"), "kept")
    gone = stored(found.groupBy("id").agg(F.max("kept").alias("kept")).where("not kept").select("id"), "duplicates")
    return without(docs, F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, id_col)


def sql() -> str:
    """The same rows in SQL over the table documents."""
    return rf"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS MATERIALIZED (
          SELECT DISTINCT doc_id, CASE WHEN len(w) < {WORDS} THEN array_to_string(w, ' ')
            ELSE array_to_string(w[p + 1 : p + {WORDS}], ' ') END AS shingle
          FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - {WORDS} + 1, 1))) AS p FROM w WHERE len(w) > 0)),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle
                  AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS MATERIALIZED (
          SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * c >= {PERCENT} * (na.n + nb.n - c)),
        reach AS (SELECT doc_id, doc_id AS other FROM n UNION
                  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(r.m, d.doc_id) AS component_id,
          coalesce(r.m, d.doc_id) = d.doc_id AS kept
        FROM documents d LEFT JOIN n USING (doc_id)
        LEFT JOIN (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id) r USING (doc_id)"""
