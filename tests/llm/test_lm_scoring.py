"""Masked pseudo-likelihood: against a plain computation, on held-out text, and over layouts of the table."""

import math

import numpy as np
import pyarrow as pa
import pytest

from monthclose.llm import lmscore


def frame(spark, *rows, schema="doc_id long, text string"):
    return spark.createDataFrame(list(rows), schema)


def chain(seed, n, shuffled=False):
    """Words of which each narrows down the next."""
    rng = np.random.default_rng(seed)
    at, out = 0, []
    for _ in range(n):
        at = (at * 7 + int(rng.integers(0, 3)) + 1) % 50
        out.append(f"w{at}")
    if shuffled:
        rng.shuffle(out)
    return " ".join(out)


def scored(spark, docs, **kw):
    network, counts, rows = lmscore.learn(docs, **kw)
    return network, lmscore.score(rows, network, counts, **{k: v for k, v in kw.items() if k == "id_col"})


def mean(network, text):
    _, which, known = lmscore.words(pa.array([text]))
    rows = lmscore.steps(iter([network.leaves(known)[0][which]]), lmscore.AT_ONCE)
    found = np.concatenate([network.log_probs(r)[1] for r in rows])
    return found.mean()


def plain(network, leaves, place):
    """The log-probability of one leaf, decision by decision."""
    embed, hidden_bias, out, direct, bias = network.parts(network.weights)
    row = [lmscore.PAD] * 2 + list(leaves) + [lmscore.PAD] * 2
    at = place + 2
    hidden = np.array(hidden_bias, float)
    for k, other in enumerate((at - 2, at - 1, at + 1, at + 2)):
        hidden += embed[row[other] % lmscore.EMBEDDED + k * lmscore.EMBEDDED]
    hidden = np.tanh(hidden)
    starts, path_steps, _ = network.tree
    total = 0.0
    for step in path_steps[starts[row[at]] : starts[row[at] + 1]]:
        node, side, cell = int(step) & 0xFFFF, int(step) >> 16 & 1, int(step) >> 17
        logit = float(bias[node])
        for other, factor in ((at - 1, 0x9E3779B1), (at + 1, 0x85EBCA6B)):
            mixed = (row[other] + 1) * factor % 2**32 ^ (cell >> 4) * 0xC2B2AE35 % 2**32
            mixed ^= mixed >> 15
            mixed = mixed * 0x27D4EB2F % 2**32 >> 36 - lmscore.SLOT_BITS
            logit += float(direct[mixed * 16 + cell % 16])
        if node < lmscore.TOP:
            logit += float(hidden @ out[:, node])
        total -= math.log1p(math.exp(-logit if side else logit))
    return total


def test_scores_equal_a_plain_computation_and_probabilities_add_up(spark):
    texts = ["a b c d a b", "B a", "c c c a \t d"] * 4
    network, got = scored(spark, frame(spark, *enumerate(texts)))
    for row in got.collect():
        tokens = texts[row.doc_id].lower().split()
        leaves = network.leaves([t.encode() for t in tokens])[0]
        want = sum(plain(network, leaves, k) for k in range(len(tokens)))
        assert row.n_tokens == len(tokens) and row.log_prob == pytest.approx(want, abs=2e-3)
    present = np.flatnonzero(network.counts)
    assert sum(math.exp(plain(network, [3, k, 1], 1)) for k in present) == pytest.approx(1, abs=1e-4)


def test_order_counts_on_held_out_text(spark):
    network, _, _ = lmscore.learn(frame(spark, *((k, chain(k, 600)) for k in range(200))))
    by_counts = lmscore.start(lmscore.count(frame(spark, *((k, chain(k, 600)) for k in range(200)))))
    held_out, shuffled = chain(1000, 3000), chain(1000, 3000, shuffled=True)
    assert mean(network, held_out) > mean(by_counts, held_out) + 0.3
    assert mean(network, shuffled) < mean(network, held_out) - 0.3


def test_layout_does_not_count(spark, monkeypatch):
    rows = [(k, chain(k, 50 + 20 * (k % 7))) for k in range(80)] + [(None, None), (5, ""), (5, chain(5, 90))]
    first = None
    for shard_tokens in (1 << 23, 3000):
        found = []
        for parts in (2, 7):
            docs = frame(spark, *rows).repartition(parts)
            counts = lmscore.count(docs)
            start = lmscore.start(counts)
            encoded = lmscore.encoded(docs, start)
            network = lmscore.trained(start, encoded, shard_tokens)
            found.append(sorted((str(r.doc_id), r.n_tokens, r.log_prob) for r in lmscore.score(encoded, network, counts).collect()))
        for a, b in zip(*found, strict=True):
            assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=2e-3)
        assert first is None or first != found[0]
        first = found[0]


def test_tokens_that_share_leaves_have_their_share(spark, monkeypatch):
    """With five leaves of their own, the other tokens split the count of their leaf."""
    monkeypatch.setattr(lmscore, "RATE", 0.0)  # the counts alone
    texts = ["a a a a b b b b c c c c d d d d e e e e", "x1 x1 x2", "x3 a"]
    docs = frame(spark, *enumerate(texts))
    counts = lmscore.count(docs).orderBy("n", ascending=False).toArrow().to_pydict()
    order = np.argsort(-np.array(counts["n"]), kind="stable")
    hashed, n = np.array(counts["hash"])[order], np.array(counts["n"])[order]
    rare = np.bincount(lmscore.shared_leaf(hashed[5:]) - lmscore.OWN, n[5:], lmscore.RARE)
    network = lmscore.Network.new(hashed[:5], n[:5], rare)
    got = lmscore.score(lmscore.encoded(docs, network), network, lmscore.count(docs)).orderBy("doc_id").collect()
    mass = network.counts.sum()
    of = dict(zip(hashed.tolist(), n.tolist(), strict=True))

    def token(word):
        leaf, own = network.leaves([word.encode()])
        share = 1 if leaf[0] < lmscore.OWN else of[int(own[0])] / network.counts[leaf[0]]
        return math.log(network.counts[leaf[0]] / mass * share)

    for row in got:
        assert row.log_prob == pytest.approx(sum(token(w) for w in texts[row.doc_id].split()), abs=5e-3)


def test_defined_results(spark):
    schema = "row long, id string, key string, hash int, n int, text string"
    long = chain(3, 60_000)
    rows = [(1, "p", "k", 0, 1, None), (2, "p", "k", 0, 1, " \n\u00a0 "), (3, "q", None, None, None, long), (3, "q", None, None, None, long),
            (None, "r", "", 1, 1, "one"), (4, "r", "", 1, 1, "x" * 100_000)]
    _, got = scored(spark, frame(spark, *rows, schema=schema), id_col="row")
    got = got.collect()
    assert got[0].__fields__ == ["row", "n_tokens", "log_prob", "mean_log_prob"] and len(got) == 6
    by_id = {}
    for row in got:
        by_id.setdefault(row.row, []).append(row)
    for k in (1, 2):
        assert by_id[k][0].n_tokens == by_id[k][0].log_prob == by_id[k][0].mean_log_prob == 0
    assert by_id[3][0] == by_id[3][1] and by_id[3][0].n_tokens == 60_000
    assert by_id[None][0].n_tokens == by_id[4][0].n_tokens == 1
    _, nothing = scored(spark, frame(spark, schema="doc_id long, text string"))
    assert nothing.collect() == []
    _, blank = scored(spark, frame(spark, (1, None), (2, "")))
    assert [r.log_prob for r in blank.collect()] == [0, 0]
