"""A Merkle manifest of a dataset: leaf coordinates by rank in bitmaps, levels reduced in keyed slot arrays.

Every row is a leaf, a digest of its fields. Rows fall into groups (languages), and in each group leaves ascend by id. Nothing
sorts them: each task merges the ids it sees into 64-bit words of a bitmap per group, words are merged across tasks, and empty
words are not kept. Counts of set bits are added up in a directory of several levels, so that no group of ids, and no directory,
is ever in one task. A leaf's coordinate is what the directory says of its word, and the number of set bits below its own.

Slot arrays then hold 512 consecutive nodes, keyed by group and coordinate, and take three levels of runs of 8 at once; what is
left are 512 times fewer nodes, and so on. On the way down each array hands its path (the siblings to the left and right at
each level) to the arrays below, so that paths are never shuffled with the leaves.

Defined results: NULL fields, also a NULL id or group, are written as ``-``; rows without an id come first in their group. Rows that
share an id stand in the order of their digests; equal rows are leaves of their own. An empty table gives no rows. Columns
that are not named take no part, whatever they are called.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthclose.llm.common import stored

#: The fields of a leaf, in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes in a run, levels that one slot array reduces, and the nodes it holds.
RUN, LEVELS = 8, 3
SLOTS = RUN**LEVELS
#: Children of a directory entry (a power of two), and the entries that its top level may have.
FAN_BITS, TOP = 12, 4096
#: Rows that share an id are ranked in buckets by so many letters of their digests; copies are made in blocks.
BUCKET_LETTERS, COPY_BLOCK = 3, 4096
#: The word of rows without an id: before that of any 64-bit id.
NO_ID = -(2**57) - 1

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: tuple[str, ...] = FIELDS, instead: dict[str, Column] | None = None) -> Column:
    """The digest of a row; ``instead`` replaces some of its fields."""
    return digest(*(field((instead or {}).get(name, F.col(name))) for name in fields))


def lowered(text: Column) -> Column:
    """A to Z become a to z, nothing else changes."""
    return F.translate(text, _UPPER, _LOWER)


def group_key(column: str) -> Column:
    """A group as text that is never NULL; its byte order is that of the groups, NULL first."""
    return F.when(F.col(column).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(column)))


def leaves(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", claimed: Column | None = None
) -> DataFrame:
    """(id, g, leaf, claimed): ``claimed`` is the digest that is to be verified in place of the leaf, NULL where it is the leaf."""
    return docs.select(
        F.col(id_col).cast("long").alias("id"), group_key(group_col).alias("g"), leaf(fields).alias("leaf"),
        (F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"))


def _word() -> Column:
    return F.coalesce(F.shiftright("id", 6), F.lit(NO_ID))


def _bit() -> Column:
    return F.coalesce(F.col("id").bitwiseAND(F.lit(63)), F.lit(0)).cast("int")


def bitmaps(rows: DataFrame) -> DataFrame:
    """(g, word, bits, size, more): the ids' words, the rows in each, and for ids of several rows (bit, rows besides the first)."""
    placed = rows.select("g", "id", _word().alias("word"), _bit().alias("bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    words = stored(placed.groupBy("g", "word").agg(F.bit_or(one).alias("bits"), F.count("*").alias("size")), "words")
    crowded = words.where(F.col("size") > F.bit_count("bits")).select("g", "word")
    more = (placed.join(crowded, ["g", "word"], "left_semi").groupBy("g", "word", "bit").count().where("count > 1")
            .groupBy("g", "word").agg(F.collect_list(F.struct("bit", (F.col("count") - 1).alias("n"))).alias("more")))
    return words.join(more, ["g", "word"], "left")


def directory(words: DataFrame) -> DataFrame:
    """``words`` with ``base``, the rows of the group in earlier words, and ``total``, those of the whole group.

    Sums go up by 4096 words a level until few are left, and bases come down again.
    """
    levels = [words.select("g", F.col("word").alias("key"), "size")]
    while len(levels) < 6:
        above = stored(
            levels[-1].groupBy("g", F.shiftright("key", FAN_BITS).alias("key")).agg(F.sum("size").alias("size")), "directory")
        levels.append(above)
        if above.count() <= TOP:
            break
    ordered = Window.partitionBy("g").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    above = levels.pop().select(  # as many rows as there are groups, or a few thousand
        "g", F.col("key").alias("parent"), F.coalesce(F.sum("size").over(ordered), F.lit(0)).alias("before"),
        F.sum("size").over(Window.partitionBy("g")).alias("total"))
    while levels:
        level = levels.pop().withColumn("parent", F.shiftright("key", FAN_BITS))
        within = Window.partitionBy("g", "parent").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
        own = level.withColumn("own", F.coalesce(F.sum("size").over(within), F.lit(0)))
        above = own.join(above, ["g", "parent"]).select(
            "g", F.col("key").alias("parent"), (F.col("before") + F.col("own")).alias("before"), "total")
    return words.join(above.select("g", F.col("parent").alias("word"), F.col("before").alias("base"), "total"), ["g", "word"])


def places(rows: DataFrame) -> DataFrame:
    """``rows`` (a stored table of leaves) with ``place``, their coordinate in the group, and the group's ``total``."""
    words = stored(directory(bitmaps(rows)), "bitmaps")
    found = rows.withColumn("word", _word()).withColumn("bit", _bit()).join(words, ["g", "word"])
    below = F.col("bits").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), F.col("bit"))))
    more = F.coalesce(
        F.aggregate(F.filter("more", lambda m: m["bit"] < F.col("bit")), F.lit(0).cast("long"), lambda s, m: s + m["n"]), F.lit(0))
    found = found.select(
        *rows.columns, "total", (F.col("base") + F.bit_count(below) + more).alias("place"),
        F.coalesce(F.exists("more", lambda m: m["bit"] == F.col("bit")), F.lit(False)).alias("shared"))
    found = stored(found, "places")
    return found.where("NOT shared").drop("shared").unionByName(_shared(found.where("shared").drop("shared")))


def _shared(rows: DataFrame) -> DataFrame:
    """Rows that share an id, one after the other by digest. Equal rows are counted first, and the others ranked in buckets."""
    key = ["g", "id", "total", "place"]
    counted = rows.groupBy(*key, "leaf", "claimed").agg(F.count("*").alias("copies")).withColumn(
        "bucket", F.substring("leaf", 1, BUCKET_LETTERS))
    ahead = (Window.unboundedPreceding, -1)
    buckets = counted.groupBy(*key, "bucket").agg(F.sum("copies").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.partitionBy(*key).orderBy("bucket").rowsBetween(*ahead)), F.lit(0)))
    own = counted.withColumn("own", F.coalesce(
        F.sum("copies").over(Window.partitionBy(*key, "bucket").orderBy("leaf").rowsBetween(*ahead)), F.lit(0)))
    same = reduce(lambda x, y: x & y, [own[k].eqNullSafe(buckets[k]) for k in [*key, "bucket"]])
    ranked = own.join(buckets, same).select(*(own[c] for c in [*key, "leaf", "claimed", "copies", "own"]), "before")
    blocks = ranked.withColumn("block", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPY_BLOCK})")))
    copies = blocks.withColumn("copy", F.explode(F.expr(
        f"sequence(block * {COPY_BLOCK}, least(copies, (block + 1) * {COPY_BLOCK}) - 1)")))
    return copies.select("id", "g", "leaf", "claimed", "total", (F.col("place") + F.col("before") + F.col("own") + F.col("copy")).alias("place"))


def _levels(total: Column) -> Column:
    """How often the nodes of a group are reduced until one is left."""
    return reduce(lambda x, y: x + y, [(total > RUN**k).cast("int") for k in range(21)])


def _runs(nodes: Column) -> Column:
    last = F.expr("0") + F.floor((F.size(nodes) - 1) / RUN).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda j: F.sha2(F.concat_ws("", F.slice(nodes, j * RUN + 1, F.lit(RUN))).cast("binary"), 256))


def slot_arrays(nodes: DataFrame, *payload: str) -> DataFrame:
    """Nodes (g, place, digest, left) in arrays of 512: (g, slot_array, left, steps, rows, level0 .. level3).

    ``left`` are the reductions that the group still needs, ``steps`` those that are made here; the last level then has one node.
    """
    arrays = nodes.groupBy("g", F.floor(F.col("place") / SLOTS).alias("slot_array"), "left").agg(
        F.array_sort(F.collect_list(F.struct((F.col("place") % SLOTS).cast("int").alias("slot"), "digest", *payload))).alias("rows"))
    arrays = arrays.withColumn("steps", F.least("left", F.lit(LEVELS))).withColumn("level0", F.col("rows.digest"))
    for k in range(LEVELS):
        arrays = arrays.withColumn(
            f"level{k + 1}", F.when(F.col("steps") > k, _runs(F.col(f"level{k}"))).otherwise(F.col(f"level{k}")))
    return arrays


def _path(slot: Column) -> Column:
    """The siblings of a slot at each level of its array: (texts to the left, texts to the right) from the leaves up."""
    parts = []
    for k in range(LEVELS):
        nodes, at = F.col(f"level{k}"), F.shiftright(slot, 3 * k)
        offset = at % RUN
        left = F.concat_ws("", F.slice(nodes, at - offset + 1, offset))
        right = F.concat_ws("", F.slice(nodes, at + 2, F.lit(RUN - 1) - offset))
        parts.append(F.struct(left.alias("left"), right.alias("right")))
    return F.slice(F.array(*parts), F.lit(1), F.col("steps"))


def climb(nodes: DataFrame, *payload: str) -> tuple[list[DataFrame], DataFrame]:
    """All rounds of slot arrays over (g, place, digest, left), and (g, digest) of what remains of each group."""
    rounds = []
    while True:
        arrays = stored(slot_arrays(nodes, *(() if rounds else payload)), "slots")
        rounds.append(arrays)
        nodes = arrays.select(
            "g", F.col("slot_array").alias("place"), F.col(f"level{LEVELS}")[0].alias("digest"),
            (F.col("left") - F.col("steps")).alias("left"))
        if not (arrays.agg(F.max(F.col("left") - F.col("steps"))).first()[0] or 0):
            return rounds, nodes.select("g", "digest")


def descend(rounds: list[DataFrame], top: DataFrame, *keep: str) -> DataFrame:
    """The leaves' rows with ``path``: what ``top`` has for each group (path, and columns to keep) goes down through all rounds."""
    info = top.withColumn("slot_array", F.lit(0).cast("long"))
    for arrays in reversed(rounds):
        joined = arrays.join(info, ["g", "slot_array"]).withColumn("row", F.explode("rows"))
        path = F.concat(_path(F.col("row.slot")), F.col("path"))
        info = joined.select(
            "g", (F.col("slot_array") * SLOTS + F.col("row.slot")).alias("slot_array"), "row", path.alias("path"), *keep)
    return info


def _numbered(groups: DataFrame) -> DataFrame:
    """(g, digest) with ``place`` by g and ``total``: counted by ranges, so that no task holds all groups."""
    dealt = stored(groups.repartitionByRange("g").withColumn("part", F.spark_partition_id()), "groups")
    sizes = dealt.groupBy("part").count()  # a row for each range
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("count").over(ahead), F.lit(0))).withColumn(
        "total", F.sum("count").over(Window.partitionBy()))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("g")) - 1
    return dealt.withColumn("own", rank).join(F.broadcast(sizes), "part").select(
        "g", "digest", (F.col("before") + F.col("own")).alias("place"), "total")


def manifest(rows: DataFrame) -> DataFrame:
    """(id, leaf, subroot, root, path, claimed) of every leaf (id, g, leaf, claimed).

    ``path`` are the siblings from the leaf to the root as (left, right); ``claimed`` is the leaf where none was given.
    """
    placed = places(stored(rows, "leaves"))
    nodes = placed.select("g", "place", F.col("leaf").alias("digest"), _levels(F.col("total")).alias("left"), "id", "claimed")
    rounds, subroots = climb(nodes, "id", "claimed")
    numbered = stored(_numbered(subroots), "subroots")
    upper, roots = climb(numbered.select(
        F.lit("").alias("g"), "place", "digest", _levels(F.col("total")).alias("left"), F.col("g").alias("group")), "group")
    top = roots.select("g", F.col("digest").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    groups = descend(upper, top, "root").select(
        F.col("row.group").alias("g"), F.col("row.digest").alias("subroot"), "root", "path")
    return descend(rounds, groups, "subroot", "root").select(
        F.col("row.id").alias("id"), F.col("row.digest").alias("leaf"), "subroot", "root", "path",
        F.coalesce("row.claimed", "row.digest").alias("claimed"))


def proof(path: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))).cast("binary"), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, start, lambda x, s: F.sha2(F.concat(s["left"], x, s["right"]).cast("binary"), 256))


def verified(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The manifest with the root that each claimed leaf gives, and whether it is the root of the dataset."""
    folded = found.withColumn("folded_root", fold(F.col("claimed"), F.col("path")))
    return folded.select(
        F.col("id").alias(id_col), "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bits = ("list_reduce(list_concat([xor({c}, {b})], range(8)), lambda r, i: "
            "CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)")
    step = bits.format(c="c", b="b")
    codes = f"list_transform(string_split({text}, ''), lambda d: CAST(ascii(d) AS BIGINT))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda c, b: {step}), 4294967295)"


def sql(levels: int = 7) -> str:
    """SQL for the query over ``documents``: as many levels of runs as 8 ** levels leaves of a group need."""
    def column(name: str, value: str | None = None) -> str:
        value = value or name
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"

    original = " || ".join(column(f) for f in FIELDS)
    changed = " || ".join(column(f, f"translate(text, '{_UPPER}', '{_LOWER}')" if f == "text" else None) for f in FIELDS)
    steps, top = [], []
    for k in range(levels):
        steps.append(f"""
n{k + 1} AS (SELECT g, i // {RUN} AS i, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h,
    (any_value(n) + {RUN - 1}) // {RUN} AS n FROM n{k} GROUP BY g, i // {RUN}),
s{k} AS (SELECT a.g, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r, any_value(a.n) > 1 AS used
    FROM n{k} a JOIN n{k} b ON a.g = b.g AND a.i // {RUN} = b.i // {RUN} GROUP BY a.g, a.i)""")
    for k in range(levels):
        top.append(f"""
m{k + 1} AS (SELECT i // {RUN} AS i, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h,
    (any_value(n) + {RUN - 1}) // {RUN} AS n FROM m{k} GROUP BY i // {RUN}),
t{k} AS (SELECT a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r, any_value(a.n) > 1 AS used
    FROM m{k} a JOIN m{k} b ON a.i // {RUN} = b.i // {RUN} GROUP BY a.i)""")
    joins = " ".join(f"JOIN s{k} ON s{k}.g = x.g AND s{k}.i = x.i // {RUN**k}" for k in range(levels))
    joins += " ".join([""] + [f"JOIN t{k} ON t{k}.i = m0.i // {RUN**k}" for k in range(levels)])
    names = [f"s{k}" for k in range(levels)] + [f"t{k}" for k in range(levels)]
    siblings = " || ".join(f"CASE WHEN {s}.used THEN {s}.l || {s}.r ELSE '' END" for s in names)
    path = ", ".join(f"{{'l': {s}.l, 'r': {s}.r, 'x': '', 'u': {s}.used}}" for s in names)
    return f"""
WITH leaf AS (
    SELECT doc_id, lang, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS g, sha256({original}) AS h,
        CASE WHEN doc_id IS NOT NULL AND {_sql_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN sha256({changed}) ELSE sha256({original}) END AS c
    FROM documents),
x AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaf),
n0 AS (SELECT g, i, h, n FROM x),{",".join(steps)},
m0 AS (SELECT g, row_number() OVER (ORDER BY g) - 1 AS i, h, count(*) OVER () AS n FROM n{levels}),{",".join(top)},
p AS (SELECT x.doc_id, x.h AS leaf, m0.h AS subroot, (SELECT h FROM m{levels}) AS root, sha256({siblings}) AS proof_sha256,
    list_reduce(list_concat([{{'l': '', 'r': '', 'x': x.c, 'u': true}}], [{path}]),
        lambda a, b: CASE WHEN b.u THEN {{'l': '', 'r': '', 'x': sha256(b.l || a.x || b.r), 'u': true}} ELSE a END).x AS folded_root
    FROM x JOIN m0 ON m0.g = x.g {joins})
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM p
"""
