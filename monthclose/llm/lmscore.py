"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every token is predicted from the ``SIDE`` tokens before and after it, itself masked; the sum of the log-probabilities scores the
document. A token is a lower-case stretch between white space.

Counts of all tokens of the corpus are a table that grows with it. The ``OWN`` most frequent tokens are leaves of a Huffman tree, and all
others share ``RARE`` leaves by hash. The network predicts the leaf as a row of two-way decisions from the root down. Each decision has a
bias and direct connections from the nearest token on either side (hashed to ``1 << SLOT_BITS`` weights); the ``TOP`` heaviest decisions also
see a tanh layer over embeddings of the window. A token of a shared leaf has its share of the leaf's count, looked up in the
table by a join: P(token | context) = P(leaf | context) * count(token) / count(leaf). A token that the corpus lacks counts once,
and each shared leaf has room for one.

Training reads all documents once. They are dealt by a hash of id and text to shards of about ``SHARD_TOKENS`` tokens, and each
shard trains a copy in numpy, in the order of that hash; so the result does not hang on the partitions of the table. Of the copies a
weighted mean is taken, in which each weight counts by the squared gradients that shaped it. Nothing but counts and weights leaves a task.
Rows that are equal in id and text are in one shard: many of them make one task long, not large.

Defined results: NULL and blank texts have no tokens, log-probability 0 and mean 0. Beyond the ends of a document stands a padding token.
Equal texts have equal scores. Without any token in the corpus the untrained network is used. Rows with repeated or NULL ids
are scored singly; other columns are not looked at. Different tokens with one 64-bit hash would count as one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose.llm.common import small_batches, stored

#: Tokens with a leaf of their own, leaves that the others share, and the padding beyond the ends of a document.
OWN, RARE = 60_000, 4096
PAD = OWN + RARE
#: Places on each side, hidden units, rows of embeddings by place, decisions that see the hidden layer, bits of a direct weight's number.
SIDE, HIDDEN, EMBEDDED, TOP, SLOT_BITS = 2, 8, 1024, 64, 21
#: Tasks that train; beyond as many shards a task trains several, one after the other.
MOST_TASKS = 10_000
#: Tokens of a shard, of a gradient step and of a step of scoring, and the step size.
SHARD_TOKENS, STEP_TOKENS, AT_ONCE, RATE = 1 << 23, 2048, 2048, 0.05

_LEFT, _RIGHT = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end of each text in tokens, number of each token's word, the different words as bytes)."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    flat = lists.flatten().dictionary_encode()
    which, known = flat.indices.to_numpy(zero_copy_only=False), flat.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
    empty = pc.index(flat.dictionary, "").as_py()
    if empty >= 0:  # beside white space at either end
        real = which != empty
        ends = np.concatenate([[0], np.cumsum(real)])[ends]
        which = which[real]
    return ends, which, known


def hashes(known: Iterable[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in known], np.uint64).view(np.int64)


def shared_leaf(hashed: np.ndarray) -> np.ndarray:
    return OWN + (hashed % RARE)


def _change(gradient: np.ndarray, old: np.ndarray, least: float) -> np.ndarray:
    """What a gradient adds to pairs of (weight, summed squared gradients)."""
    change = np.empty(old.shape, np.complex64)
    squared = gradient * gradient
    change.real = gradient * (-RATE / np.sqrt(old.imag + squared + np.float32(least)))
    change.imag = squared
    return change


@dataclass
class Network:
    """Hashes of the tokens with a leaf of their own (sorted) and their leaves, counts of the leaves, and the weights as one vector."""

    own: np.ndarray
    leaf: np.ndarray
    counts: np.ndarray
    weights: np.ndarray

    @classmethod
    def new(cls, own: np.ndarray, own_counts: np.ndarray, rare_counts: np.ndarray) -> Network:
        """``own`` and its counts by descending count; ``rare_counts`` by shared leaf."""
        counts = np.zeros(PAD)
        counts[: len(own)], counts[OWN:] = own_counts, rare_counts + 1
        order = np.argsort(own)
        network = cls(own[order], order.astype(np.int64), counts, np.zeros(0, np.float32))
        parts = [np.zeros(s) for s in cls.shapes()]
        parts[0] = np.random.default_rng(7).normal(0, 0.1, parts[0].shape)
        left, right = network.tree[2]
        parts[4][: len(left)] = np.log(left / right)
        network.weights = np.concatenate([p.reshape(-1) for p in parts]).astype(np.float32)
        return network

    @staticmethod
    def shapes() -> list[tuple[int, ...]]:
        """Embeddings, hidden bias, hidden to decisions, direct weights, biases of decisions."""
        return [(2 * SIDE * EMBEDDED, HIDDEN), (HIDDEN,), (HIDDEN, TOP), (1 << SLOT_BITS,), (PAD,)]

    @classmethod
    def parts(cls, vector: np.ndarray) -> list[np.ndarray]:
        out, at = [], 0
        for shape in cls.shapes():
            size = int(np.prod(shape))
            out.append(vector[at : at + size].reshape(shape))
            at += size
        return out

    @cached_property
    def tree(self) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """(where each leaf's path begins; decision, side and cell of each step of all paths; masses of both sides of each decision).

        A step is one number: the cell, one bit for the side, and 16 bits for the decision, from high to low.

        Decisions are numbered by falling mass, so that 0 is the root. Four levels of the tree make a block: a decision's cell is 16 times
        the number of its block's first decision, plus its place in the block. Only leaves that can occur are in the tree.
        """
        present = np.flatnonzero(self.counts)
        heap = [(float(self.counts[k]), int(k)) for k in present]
        heapq.heapify(heap)
        children: list[tuple[int, int, float, float]] = []
        while len(heap) > 1:
            (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (a + b, PAD + len(children)))
            children.append((x, y, a, b))
        n = len(children)
        cells = np.zeros(n, np.uint32)
        paths: dict[int, tuple[tuple[int, ...], tuple[int, ...]]] = {PAD + n - 1 if n else int(present[0]): ((), ())}
        for k in range(n - 1, -1, -1):
            nodes, sides = paths.pop(PAD + k)
            number = n - 1 - k
            if not cells[number]:
                cells[number] = number * 16 + 1
            for side, child in ((1, children[k][0]), (0, children[k][1])):
                paths[child] = ((*nodes, number), (*sides, side))
                place = int(cells[number]) % 16 * 2 + side
                if child >= PAD and place < 16:
                    cells[PAD + n - 1 - child] = int(cells[number]) // 16 * 16 + place
        sizes = np.zeros(PAD + 1, np.int64)
        sizes[present] = [len(paths[k][0]) for k in present]
        nodes = np.fromiter((x for k in present for x in paths[k][0]), np.int64)
        sides = np.fromiter((x for k in present for x in paths[k][1]), np.int64)
        path_steps = cells[nodes].astype(np.int64) << 17 | sides << 16 | nodes
        masses = np.array([c[2:] for c in reversed(children)]).reshape(-1, 2).T
        return np.concatenate([[0], np.cumsum(sizes)]), path_steps, (masses[0], masses[1])

    def leaves(self, known: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, hash) of each word."""
        hashed = hashes(known)
        if not len(self.own) or not len(hashed):
            return shared_leaf(hashed), hashed
        at = np.minimum(np.searchsorted(self.own, hashed), len(self.own) - 1)
        return np.where(self.own[at] == hashed, self.leaf[at], shared_leaf(hashed)), hashed

    def decisions(self, row: np.ndarray, weights: np.ndarray, kind: type = np.float32) -> tuple:
        """The decisions for all real tokens of a padded row of leaves, and what led to their logits.

        With ``kind`` float64 the matrix product, whose last digits depend on a token's place in the row, is exact enough for
        logits that do not.
        """
        places = np.flatnonzero(row[SIDE : len(row) - SIDE] != PAD) + SIDE
        starts, path_steps, _ = self.tree
        target = row.take(places)
        begin = starts.take(target)
        sizes = starts.take(target + 1) - begin
        token = np.repeat(np.arange(len(places)), sizes)
        step = path_steps.take(np.arange(len(token)) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes))
        node, side, cell = step & 0xFFFF, (step >> 16 & 1).astype(np.float32), (step >> 17).astype(np.uint32)

        embed, hidden_bias, out, direct, bias = self.parts(weights)
        short = row % EMBEDDED
        around = np.stack([short.take(places + k) + (k + SIDE - (k > 0)) * EMBEDDED for k in range(-SIDE, SIDE + 1) if k])
        rows = embed.take(around.reshape(-1), axis=0).reshape(2 * SIDE, len(places), HIDDEN)
        hidden = np.tanh(rows.real.sum(axis=0) + hidden_bias.real)
        by_block, in_block = (cell >> np.uint32(4)) * np.uint32(0xC2B2AE35), cell & np.uint32(15)
        slots = []
        for place, factor in ((places - 1, _LEFT), (places + 1, _RIGHT)):
            mixed = ((row.take(place).astype(np.uint32) + np.uint32(1)) * factor).take(token) ^ by_block
            mixed ^= mixed >> np.uint32(15)
            mixed = (mixed * np.uint32(0x27D4EB2F)) >> np.uint32(36 - SLOT_BITS)
            slots.append((mixed << np.uint32(4) | in_block).astype(np.int64))  # a block's weights for one token lie together
        used = bias.take(node), direct.take(slots[0]), direct.take(slots[1])
        logits = used[0].real + used[1].real + used[2].real
        top = np.flatnonzero(node < TOP)
        in_top = token.take(top) * TOP + node.take(top)
        by_layer = (hidden.astype(kind, copy=False) @ out.real.astype(kind)).astype(np.float32, copy=False)
        logits[top] += by_layer.reshape(-1).take(in_top)
        return places, token, node, side, logits, around, rows, hidden, slots, used, top, in_top

    def train(self, row: np.ndarray, pairs: np.ndarray) -> None:
        """One step on a padded row of leaves, in place.

        ``pairs`` holds the weights as real parts and their summed squared gradients as imaginary ones, so that one access
        changes both. The step of a weight shrinks with that sum.
        """
        _, _, node, side, logits, around, rows, hidden, slots, used, top, in_top = self.decisions(row, pairs)
        if not len(node):
            return
        delta = 1 / (1 + np.exp(-logits)) - side
        embed, hidden_bias, out, direct, bias = self.parts(pairs)
        dense = np.zeros((len(hidden), TOP), np.float32)
        dense.reshape(-1)[in_top] = delta.take(top)
        back = (dense @ out.real.T) * (1 - hidden * hidden)
        for values, index, old in ((bias, node, used[0]), (direct, slots[0], used[1]), (direct, slots[1], used[2])):
            np.add.at(values, index, _change(delta, old, 0.2))
        out += _change(hidden.T @ dense, out, 1e-6)
        hidden_bias += _change(back.sum(axis=0), hidden_bias, 1e-6)
        index = np.add.outer(around.reshape(-1) * HIDDEN, np.arange(HIDDEN)).reshape(-1)
        np.add.at(embed.reshape(-1), index, _change(back, rows, 1e-3).reshape(-1))

    def log_probs(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the real tokens in a padded row of leaves, log-probability of the leaf there)."""
        places, token, _, side, logits, *_ = self.decisions(row, self.weights, np.float64)
        log_p = -np.log(1 + np.exp(np.minimum(logits * (1 - 2 * side), 80)))  # 80 keeps it finite
        return places, np.bincount(token, log_p, len(places))


def steps(texts: Iterator[np.ndarray], size: int) -> Iterator[np.ndarray]:
    """Padded rows of leaves, with about ``size`` tokens each; what one row has as its end is context of the next."""
    gap = np.full(SIDE, PAD, np.int64)
    waiting, n = [gap], 0
    for leaves in texts:
        waiting += [leaves, gap]
        n += len(leaves) + SIDE
        if n >= size:
            row = np.concatenate(waiting)
            at = 0
            while len(row) - at - 2 * SIDE >= size:
                yield row[at : at + size + 2 * SIDE]
                at += size
            waiting, n = [row[at:]], len(row) - at - SIDE
    if n:
        yield np.concatenate(waiting)


def count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(hash, n) of every different token, stored."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, which, known = words(batch.column(0))
            n = np.bincount(which, minlength=len(known))
            there = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes(known[there])), pa.array(n[there])], names=["hash", "n"])

    counted = docs.select(F.col(f"`{text_col}`")).mapInArrow(run, "hash long, n long")
    return stored(counted.groupBy("hash").agg(F.sum("n").alias("n")), "token-counts")


def start(counts: DataFrame) -> Network:
    """The untrained network: leaves, tree and biases from the counts."""
    order = [F.desc("n"), F.asc("hash")]
    own = counts.orderBy(*order).limit(OWN).toArrow()  # bounded
    hashed, n = (own.column(k).to_numpy().astype(np.int64) for k in (0, 1))
    rare = np.zeros(RARE)
    if len(hashed) == OWN:
        others = counts.where((F.col("n") < int(n[-1])) | (F.col("n") == int(n[-1])) & (F.col("hash") > int(hashed[-1])))
        for row in others.groupBy(F.pmod("hash", F.lit(RARE)).alias("k")).agg(F.sum("n").alias("n")).collect():
            rare[row["k"]] = row["n"]  # at most RARE rows
    return Network.new(hashed, n, rare)


def encoded(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, hash of id and text, id, leaves as bytes, hashes of the tokens that share leaves) of every row, stored."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network)
    own_id = docs.select(F.col(f"`{id_col}`").alias("id"))
    schema = f"row long, key long, {own_id.schema.simpleString()[7:-1]}, leaves binary, shared array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, which, known = words(batch.column(3))
            leaf, hashed = shared.value.leaves(known)
            leaves, parts = leaf[which].astype(np.uint16), np.split(np.arange(len(which)), ends[:-1])
            rare = [part[leaves[part] >= OWN] for part in parts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(3)), pa.array([leaves[p].tobytes() for p in parts], pa.binary()),
                 pa.array([hashed[which[p]] for p in rare], pa.list_(pa.int64()))], names=["row", "key", "id", "leaves", "shared"])

    own = docs.select(F.monotonically_increasing_id().alias("row"), F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("key"),
                      F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return stored(own.mapInArrow(run, schema), "leaves")


def trained(network: Network, rows: DataFrame, shard_tokens: int = SHARD_TOKENS) -> Network:
    """The network after one pass over all encoded rows."""
    spark = rows.sparkSession
    tokens = rows.agg(F.sum(F.octet_length("leaves"))).first()[0] or 0
    if not tokens:
        return network
    shards = -(-tokens // 2 // shard_tokens)
    shared = spark.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        total, weight = np.zeros(len(network.weights)), np.zeros(len(network.weights))
        runs = ((s, np.frombuffer(x, np.uint16).astype(np.int64)) for b in batches
                for s, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        ahead = next(runs, None)

        def one_shard(number: int) -> Iterator[np.ndarray]:
            nonlocal ahead
            while ahead is not None and ahead[0] == number:
                yield ahead[1]
                ahead = next(runs, None)

        while ahead is not None:
            pairs = network.weights.astype(np.complex64)
            for row in steps(one_shard(ahead[0]), STEP_TOKENS):
                network.train(row, pairs)
            total += pairs.imag.astype(float) * (pairs.real - network.weights)
            weight += pairs.imag
        there = np.flatnonzero(weight)
        for at in range(0, len(there), 1 << 16):
            k = there[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(k.astype(np.int32)), pa.array(total[k]), pa.array(weight[k])], names=["k", "w", "s"])

    dealt = rows.select(F.pmod("key", F.lit(shards)).alias("shard"), "leaves", "key").repartition(min(shards, MOST_TASKS), "shard")
    copies = dealt.sortWithinPartitions("shard", "key").select("shard", "leaves").mapInArrow(run, "k int, w double, s double")
    found = copies.groupBy("k").agg((F.sum("w") / F.sum("s")).cast("float").alias("w")).toArrow()  # one row a weight
    weights = network.weights.copy()
    weights[found.column(0).to_numpy()] += found.column(1).to_numpy()
    return Network(network.own, network.leaf, network.counts, np.round(weights * (1 << 16)) / np.float32(1 << 16))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Network, DataFrame, DataFrame]:
    """(network, counts of all tokens, encoded documents), from all documents."""
    counts = count(docs, text_col)
    network = start(counts)
    rows = encoded(docs, network, id_col, text_col)
    return trained(network, rows), counts, rows


def score(rows: DataFrame, network: Network, counts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, log_prob, mean_log_prob) of every encoded row, over its whole text.

    The tokens that share leaves meet the table of counts in a join; none of them is frequent, so that no key of it is hot.
    """
    shared = rows.sparkSession.sparkContext.broadcast(network)
    schema = f"row long, {rows.select('id').schema.simpleString()[7:-1]}, n_tokens long, by_network double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in batches:
            found = [np.frombuffer(x, np.uint16).astype(np.int64) for x in batch.column(2).to_pylist()]
            n = np.array([len(f) for f in found], np.int64)
            of = np.repeat(np.arange(len(found)), n)
            sums, at = np.zeros(len(found)), 0
            for row in steps(iter(found), AT_ONCE):
                places, log_p = network.log_probs(row)
                sums += np.bincount(of[at : at + len(places)], log_p, len(found))
                at += len(places)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n), pa.array(sums)], names=["row", "id", "n_tokens", "by_network"])

    leaf_counts = rows.sparkSession.createDataFrame(
        [(k, float(np.log(network.counts[OWN + k]))) for k in range(RARE)], "k long, log_leaf double")
    shares = (
        rows.select("row", F.explode("shared").alias("hash")).join(counts, "hash", "left")
        .withColumn("k", F.pmod("hash", F.lit(RARE))).join(F.broadcast(leaf_counts), "k")
        .groupBy("row").agg(F.sum(F.log(F.coalesce("n", F.lit(1)).cast("double")) - F.col("log_leaf")).alias("by_share")))
    total = F.round(F.col("by_network") + F.coalesce("by_share", F.lit(0.0)), 4)
    sums = rows.select("row", "id", "leaves").mapInArrow(run, schema).join(shares, "row", "left")
    return sums.select(
        F.col("id").alias(id_col), "n_tokens", total.alias("log_prob"),
        F.when(F.col("n_tokens") > 0, F.round(total / F.col("n_tokens"), 6)).otherwise(0.0).alias("mean_log_prob"))
