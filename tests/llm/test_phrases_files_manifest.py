"""Collocations, token files and the manifest against plain Python, with nulls, repeats, long texts, collisions and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from monthclose.llm import decontam, langid, merkle, neardup, phrases, rangecoder, toxicity

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, word string, g string, key long, n int, part int, place long"


def docs(spark, rows):
    """Rows (doc_id, lang, text); the other columns have names that the operators use inside."""
    return spark.createDataFrame(
        [(i, "s", x, None if t is None else len(t), t, "w", "g", 1, 2, 3, 4) for i, x, t in rows], COLUMNS)


def sentences(seed, n):
    r = random.Random(seed)
    common = [f"w{k}" for k in range(12)]
    return "".join(r.choice(common) + r.choice(["  ", " ", "\t", " ", ", ", "\n", " "]) for _ in range(n))


# -- phrases -----------------------------------------------------------------------------------


def brute_phrases(rows, least, share=80, top=2000):
    f, words = defaultdict(Counter), Counter()
    for _, lang, text in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for n in range(1, 5):
                f[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= share * a for b in longer):
                kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -s))
    return sorted(out)


CASES = [(k, x, sentences(k, 150)) for k, x in enumerate(["en", "fr", None, "und"] * 4)] + [
    (1, "en", "One two. one TWO,one two; three"), (1, "en", "One two. one TWO,one two; three"), (None, "en", "É é É é, e\x0bE one two"),
    (7, None, None), (8, "en", ""), (9, "de", " \t \n ..."), (10, "fr", "w1 w2 w3 w4 w5 " * 60), (11, "en", "x" * 3000 + " one two " + "y" * 900)]


@pytest.mark.parametrize("moduli, block", [
    (phrases.MODULI, phrases.BLOCK), (phrases.MODULI, 64), (((13, 2), (7, 3)), 300), (((2, 1), (3, 1)), 1 << 20)])
def test_phrases_against_brute_force(spark, moduli, block):
    """Few moduli make nearly all fingerprints collide, small blocks cut the texts: neither changes the result."""
    frequent = phrases.frequent_phrases(docs(spark, CASES).repartition(3), least=5, moduli=moduli, block=block)
    found = phrases.best(phrases.collocations(frequent, least=5), frequent)
    rows = sorted(tuple(r) for r in found.drop("id").collect())
    assert rows == brute_phrases(CASES, 5) and rows
    first = {(r.lang, r.phrase): r.id for r in frequent.where("n > 0").collect()}
    assert first["en", "one two"] == 1 and first["und", "w1"] == 2


def test_phrases_rank_by_bands_and_ties(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BAND", 100_000)
    frequent = phrases.frequent_phrases(docs(spark, CASES), least=3)
    found = phrases.best(phrases.collocations(frequent, least=3), frequent, top=7)
    assert sorted(tuple(r) for r in found.drop("id").collect()) == brute_phrases(CASES, 3, top=7)


def test_long_texts_are_cut_between_words():
    r = random.Random(3)
    for _ in range(200):
        text = "".join(r.choice(["a", "bb", "c" * 40, " ", "  ", ".", "\t"]) for _ in range(r.randrange(1, 120))).encode()
        expected = Counter()
        for piece in re.split(rb"[.]", text):
            w = re.findall(rb"[^ \t]+", piece)
            for n in range(1, 5):
                expected.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
        found = Counter()
        for part, carry in phrases.long_text_blocks(text, 16):
            b = phrases.Block([part], [0], np.zeros(1, np.uint64), carry)
            for n in range(1, 5):
                for i in b.stretches(n):
                    found[tuple(b.bytes[b.start[i] : b.end[i + n - 1]].tobytes().split(b" "))] += 1
        assert found == expected


def test_phrases_of_nothing(spark):
    assert phrases.mine(docs(spark, []).limit(0)).collect() == []
    assert phrases.mine(docs(spark, [(1, "en", None), (2, None, "  . ")])).collect() == []


# -- token files -------------------------------------------------------------------------------

BYTES = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    (3, "en", "It's  we'll\n\n foo  "), (1, "en", "<|endoftext|> x<|endoftext|>y"), (2, "en", "  a\x1cb \x85 c\xa0 d　e"),
    (5, "en", None), (4, "en", ""), (None, "en", "no id"), (3, "en", "again"), (3, "en", "again"), (6, "en", "日本語 テスト " * 40),
    (-7, "en", "word " * 9000), (8, "en", "x" * 5000 + " \t\n")]


def brute_tokens(rows):
    tokenizer, at, out = Tokenizer.from_file(BYTES), 0, Counter()
    for _, _, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out[len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        at += len(ids)
    return out, at


@pytest.mark.parametrize("block, lanes", [(rangecoder.BLOCK, rangecoder.LANES), (64, 4), (7, 3)])
def test_token_files_round_trip(spark, tmp_path, block, lanes):
    """With small blocks and segments, documents lie in many segments."""
    path = str(tmp_path / "t")
    rangecoder.write(docs(spark, TEXTS).repartition(4), path, BYTES, 2, block=block, lanes=lanes)
    rows = sorted(rangecoder.read(spark, path).collect(), key=lambda r: r.start)
    counted, size = brute_tokens(TEXTS)
    assert Counter((r.n_tokens, r.ids_crc32) for r in rows) == counted
    at = 0
    for r in rows:  # without gaps, by ascending id
        assert r.start == at
        at += r.n_tokens
    assert at == size and [r.doc_id for r in rows] == [None, -7, 1, 2, 3, 3, 3, 4, 5, 6, 8]
    ids = {}
    for r in sorted(rangecoder.read(spark, path, with_ids=True).collect(), key=lambda r: (r.start, r.ids_before)):
        ids.setdefault(r.start, []).extend(r.ids)
    assert all(zlib.crc32(np.array(ids[r.start], "<u4").tobytes()) == r.ids_crc32 for r in rows)


def test_token_files_of_nothing(spark, tmp_path):
    rangecoder.write(docs(spark, []), str(tmp_path / "t"), BYTES, 2)
    assert rangecoder.read(spark, str(tmp_path / "t")).collect() == []


@pytest.mark.parametrize("kind", ["one", "few", "many", "all", "jumps"])
def test_blocks_round_trip(kind):
    r = np.random.default_rng(4)
    ids = {"one": np.full(5000, 65535), "few": r.integers(0, 3, 20_000), "many": r.zipf(1.3, 30_000) % 65536,
           "all": r.permutation(65536), "jumps": np.repeat(r.integers(0, 65536, 400), r.integers(1, 90, 400))}[kind].astype(np.uint16)
    for block in (1, 100, 2048):
        some = ids[: 500 * block]
        data = rangecoder.image(some, [(None, 5), (9, len(some) - 5)], 12, 34, False, block)
        back, index, before, crc, complete = rangecoder.parse(data)
        assert np.array_equal(back, some) and index == [(None, 5), (9, len(some) - 5)] and (before, crc, complete) == (12, 34, False)


def test_repeated_ids_cost_little():
    ids = np.tile(np.arange(50, dtype=np.uint16), 400)
    assert len(rangecoder.image(ids, [(1, len(ids))], 0, 0, True)) < len(ids) // 6


def test_broken_files_are_found():
    ids = (np.random.default_rng(1).zipf(1.4, 9000) % 50_000).astype(np.uint16)
    data = rangecoder.image(ids, [(1, 9000)], 0, 0, True)
    for at in (0, 3, 30, 60, len(data) // 2, len(data) - 200):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises((ValueError, zlib.error)):
            rangecoder.parse(bytes(broken))
    with pytest.raises(ValueError):
        rangecoder.parse(data[:-50])


# -- manifest ----------------------------------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(nodes):
    """(root, path of each node): the siblings left and right at each level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, a in enumerate(at):
            b = a // 8 * 8
            paths[k].append((nodes[b:a], nodes[a + 1 : b + 8]))
        nodes = [h(*nodes[b : b + 8]) for b in range(0, len(nodes), 8)]
        at = [a // 8 for a in at]
    return nodes[0], paths


def brute_manifest(rows):
    def leaf(i, lang, text):
        values = (i, "s", lang, None if text is None else len(text0), text)
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    groups = defaultdict(list)
    for i, lang, text in rows:
        text0 = text
        own, other = leaf(i, lang, text), None
        if i is not None and text is not None and zlib.crc32(str(i).encode()) % 3 == 0:
            other = leaf(i, lang, re.sub("[A-Z]", lambda m: m[0].lower(), text))
        groups[lang].append((i is not None, i or 0, own, other or own, i))
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        groups[lang].sort()
        trees[lang] = brute_tree([x[2] for x in groups[lang]])
    root, tops = brute_tree([trees[lang][0] for lang in order])
    out = []
    for lang, top in zip(order, tops, strict=True):
        for (_, _, own, claimed, i), path in zip(groups[lang], trees[lang][1], strict=True):
            path = path + top
            folded = claimed
            for left, right in path:
                folded = h(*left, folded, *right)
            siblings = [x for left, right in path for x in left + right]
            out.append((i, own, trees[lang][0], root, h(*siblings), folded, folded == root))
    return sorted(out, key=str)


def manifest_rows(spark, rows):
    claimed = F.when(F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0),
                     merkle.leaf(instead={"text": merkle.lowered(F.col("text"))}))
    found = merkle.verified(merkle.manifest(merkle.leaves(docs(spark, rows).repartition(3), claimed=claimed)))
    return sorted((tuple(r) for r in found.collect()), key=str)


def many(seed, sizes, ids):
    r = random.Random(seed)
    return [(ids(r), lang, r.choice(["Ab", "éÉ", "", None, "low"]) ) for lang, n in sizes.items() for _ in range(n)]


@pytest.mark.parametrize("rows", [
    [(5, "en", "Text")],
    [(k, "en", f"Text {k}") for k in range(8)] + [(9, "fr", "x")],
    [(k, "en", f"Text {k}") for k in range(9)],
    many(1, {"en": 700, "fr": 65, None: 9, "": 1}, lambda r: r.randrange(-400, 400)),  # repeated and negative ids
    many(2, {f"l{k}": 1 + 3 * k for k in range(12)}, lambda r: r.choice([None, r.randrange(-(2**63), 2**63), 2**63 - 1, -(2**63)])),
    [(4, "en", "Same")] * 30 + [(4, "en", f"T{k}") for k in range(20)] + [(None, "en", "N")] * 10 + [(3, "en", "A"), (5, "en", "B")],
], ids=["one", "full run", "run of one", "several levels", "many groups, far ids", "one id"])
def test_manifest_against_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(merkle, "TOP", 3)  # so that the directory has several levels
    monkeypatch.setattr(merkle, "COPY_BLOCK", 4)
    assert manifest_rows(spark, rows) == brute_manifest(rows)


def test_manifest_of_nothing(spark):
    assert manifest_rows(spark, []) == []


# -- names and bounds of the other operators ---------------------------------------------------


def test_stages_take_any_column_names(spark):
    frame = spark.createDataFrame(
        [(1, "one two three four five six", "a", "b", "c"), (2, "one two three four five six", "a", "b", "c"),
         (3, "alpha beta gamma delta eps zeta eta", "a", "b", "c")], "doc_id long, text string, _gone string, _found string, id string")
    items = spark.createDataFrame([(1, "alpha beta gamma delta eps zeta eta")], "item_id long, text string")
    assert sorted(r.doc_id for r in neardup.without_duplicates(frame).collect()) == [1, 3]
    assert sorted(r.doc_id for r in decontam.clean(frame, items).collect()) == [1, 2]
    assert decontam.clean(frame, items).columns == frame.columns


def test_samples_are_bounded_by_rows(spark):
    same = spark.range(9000).select(F.lit(1).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"))
    assert langid.training_sample(same, F.lit(True), "doc_id", "text", "lang").count() == 1
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"), F.lit("en").alias("lang"))
    assert langid.training_sample(many.unionAll(many), F.lit(True), "doc_id", "text", "lang").count() == langid.ROWS_PER_LANGUAGE
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.training_sample(same, labels, lambda c: F.lit(True)).count() == 1


def test_pieces_of_texts_have_the_ids_of_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, own, r = Tokenizer.from_file(path), rangecoder.Tokens(path), random.Random(12)
    parts = [" ", "  ", "   ", "\n", "\t", " \n", "\r\n", "\0", "\x0b", "\x1f", "\xa0", "　", "﻿", "a", "don't", "'s", "é", "ß", "ñan", "日本",
             "е", "ا", "́", "😀", "1", "12", ".", ",", "Ab", "!!", "_", "x" * 50, "<|endoftext|>"]
    for _ in range(4000):
        texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(3)]
        assert [np.frombuffer(x, "<u2").tolist() for x in own.ids(texts)] == [
            e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    own._held = rangecoder.REMEMBERED + 1
    assert own.ids([""]) == [b""] and not own._known


def test_new_words_reach_the_merging_model_many_at_once():
    path, r = public_tokenizers.path("byte_bpe_50k.json"), random.Random(5)
    own, calls = rangecoder.Tokens(path), []
    model = own._model

    class Counted:
        def tokenize(self, letters):
            calls.append(letters)
            return model.tokenize(letters)

    own._model = Counted()
    words = {"".join(r.choice("abcdeéñ") for _ in range(r.randint(3, 12))) for _ in range(3000)}
    texts = [" ".join(words), "\n".join(words), ", ".join(words), "x" * 500]
    whole = Tokenizer.from_file(path)
    for _ in range(2):
        assert [np.frombuffer(x, "<u2").tolist() for x in own.ids(texts)] == [
            e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert 0 < len(calls) <= 2 * len(words) // rangecoder.TOGETHER + 2 and "x" * 500 not in "".join(calls)
    assert all(len(x) <= rangecoder.LONGEST for x in own._known)


def test_carries_run_back_over_words():
    """Ids whose code lies at the upper end of each range: every step adds as much as it can."""
    r = np.random.default_rng(8)
    for n in (1, 5, 300):
        frequency = np.zeros(9, np.int64)
        frequency[[0, 8]] = 1, 65535
        ids = np.where(r.random((400, n)) < 0.97, 8, 0).astype(np.uint16)
        lengths = np.full(n, 400)
        assert np.array_equal(rangecoder.decode(rangecoder.encode(ids, lengths, frequency), lengths, frequency), ids)


def test_pieces_are_cut_where_the_tokenizer_begins_anew():
    """Signs, digits, contractions, blanks and letters of several alphabets side by side; long pieces and a failed call leave no trace."""
    path, r = public_tokenizers.path("byte_bpe_50k.json"), random.Random(3)
    whole, own = Tokenizer.from_file(path), rangecoder.Tokens(path)
    parts = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\0", "\x0b", "a", "Zoo", "don't", "'s", "'", "\"", "é", "Éa", "×", "÷", "²", "½", "日本", "ا",
             "́", "12", "٣", "a1", ".", ",", "-", "!!", "_", "x" * 70, "’s", "“", "<|endoftext|>", "<|", "foo"]

    def check(texts):
        assert [np.frombuffer(x, "<u2").tolist() for x in own.ids(texts)] == [
            e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]

    for _ in range(20):
        check(["".join(r.choice(parts) for _ in range(r.randint(0, 9))) for _ in range(500)])
    tokenizer, own._tokenizer = own._tokenizer, None
    with pytest.raises(AttributeError):
        own.ids(["some unseen words", "½½½unseen"])
    own._tokenizer = tokenizer
    check(["foo", "some unseen words", "½½½unseen", "y" * 90, "foo"])
    assert not list(rangecoder._together(docs_batch([])))
    assert [len(x) for x in rangecoder._together(docs_batch(["z" * (rangecoder.TEXTS // 2)] * 5))] == [1, 2, 2]


def docs_batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["id", "text"])
