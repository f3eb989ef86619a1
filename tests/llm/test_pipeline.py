"""The stages in a row against plain Python over the smallest tables."""

import os
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from monthclose.llm.queries import toxic_lexicon

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def contaminated(text, items):
    """Whether some item agrees with the text in nine of twelve places in a row (three quarters, if it is shorter), at any offset."""
    split = lambda t: re.sub(r"[\W_]+", " ", t.lower()).split()
    w = split(text)
    for item in items:
        i = split(item)
        run = min(len(i), 12)
        offsets = {a - b for b, x in enumerate(i) for a, y in enumerate(w) if x == y}
        for o in offsets:
            same = [0 <= o + k < len(w) and w[o + k] == x for k, x in enumerate(i)]
            if any(sum(same[s : s + run]) >= 0.75 * run for s in range(len(i) - run + 1)):
                return True
    return False


def masked(text):
    found = [m.span() for m in re.finditer(
        r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 6]
    found += [m.span() for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [m.span() for m in re.finditer(r"[0-9a-f]{24,}", text)]
    marks, out, at = sorted(found), [], 0
    while marks:
        s, e = marks.pop(0)
        while marks and marks[0][0] < e:
            e = max(e, marks.pop(0)[1])
        out += [text[at:s], "[REDACTED]"]
        at = e
    return "".join([*out, text[at:]])


def test_pipeline(spark):
    con = duckdb.connect()
    docs = dict(con.execute(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
    lexicon = toxic_lexicon(spark, SF, spark.read.parquet(f"{SF}/documents.parquet"))
    docs = {k: t for k, t in docs.items() if lexicon.score(t) < 0.5}

    sets, root = {k: shingles(t) for k, t in docs.items()}, {k: k for k in docs}
    for a in docs:
        for b in docs:
            both = len(sets[a] & sets[b])
            if b < a and sets[a] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {k: new if r == old else r for k, r in root.items()}
    docs = {k: t for k, t in docs.items() if root[k] == k}

    items = [r[0] for r in con.execute(f"select distinct text from '{SF}/benchmark.parquet' where text is not null").fetchall()]
    docs = {k: masked(t) for k, t in docs.items() if not contaminated(t, items)}

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {k: tokenizer.encode(t, add_special_tokens=False).ids + [0] for k, t in docs.items()}
    expected = sorted((k, n, zlib.crc32(np.array(x[2048 * n : 2048 * (n + 1)], "<u4").tobytes()))
                      for k, x in ids.items() for n in range(-(-len(x) // 2048)))
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows) == expected
    sequences = defaultdict(int)
    for r in rows:
        sequences[r.sequence_id] += r.length
    assert max(sequences.values()) <= 2048 and len(sequences) <= -(-sum(map(len, ids.values())) // 2048) + 1


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near-duplicate removal", "benchmark decontamination", "secret scans", "best-fit packing"]
    assert corpus_pipeline.STAGES[3][1](spark, docs, SF).columns == docs.columns
