"""Token ids in compressed files: a range coder driven by mixed predictions of order 0 to 2.

Documents are dealt by ranges of their id and sorted, become token ids, and each task cuts its stream of ids into segments of at most
4096 blocks of 2048 ids. A block is coded on its own, with a model that starts afresh, and has a checksum of its ids, so that it can
be read alone (with the segment's header) and a broken one is found. The blocks of a segment are coded side by side: each numpy
operation does one step of all of them.

A step predicts the next id from the one before (order 1) and the two before (order 2), each with a confidence that grows when it
was right. What is coded is whether the order-2 id comes, or the order-1 id, or neither; the chances are mixed from three
adaptive distributions (order 0: the block alone; order 1 and 2: by their confidence), with weights that follow what each gave to
the outcomes before. If neither comes, the id is coded by its order-0 frequency in the segment, which the header holds. All
arithmetic is on integers, so that every machine decodes the same.

Segments are rows of a Parquet table, in order: part, segment, number of ids, and the image, a byte string with its own header,
block directory and index of documents. A document may lie in several segments; each knows how many ids, and which checksum, the
document has before it.

Defined results: a NULL or empty text is its end id alone; rows without an id come first; rows that share an id stand in the order
of a checksum of their texts, then of the texts, each a document of its own. An empty table makes no segments and no rows. Ids of 65 536
and more are refused.
"""

from __future__ import annotations

import itertools
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Ids of a block, and blocks of a segment.
BLOCK, LANES = 2048, 4096
#: Places of a block's order-1 and order-2 tables (a power of two), and the highest confidence.
PLACES_BITS, SURE = 11, 3
#: Outcomes: the order-2 id (0), the order-1 id (1), another one (2).
OTHER = 2
#: One distribution adds up to 2 ** 12, a mixture of weight 8 to 2 ** 15; order-0 frequencies of ids to 2 ** 16.
UNIT_BITS, WEIGHT_BITS, ID_BITS = 12, 3, 16
TOTAL_BITS = UNIT_BITS + WEIGHT_BITS
UNIT = 1 << UNIT_BITS
#: Shifts of adaptation: order 0, orders 1 and 2, and the scores of the weights, which are set every fourth step.
SLOW, FAST, SCORE, EVERY = 5, 4, 4, 4
#: Bytes of the pieces of text whose ids a worker remembers, and of the longest of them.
REMEMBERED, LONGEST = 10_000_000, 64
#: Bytes of texts that are tokenized together, and words that the merging model is given at once.
TEXTS, TOGETHER = 8 << 20, 64

_HALF, _16 = np.uint32(0xFFFF), np.uint32(16)
#: One step of confidence, and the highest.
_ONE, _MOST = np.uint32(1 << 16), np.uint32(SURE << 16)
#: A distribution is two bounds in one 32-bit number: below the first lies outcome 0, between them 1, from the second on 2.
_EVEN = np.uint32(UNIT // 3 | 2 * UNIT // 3 << 16)


def _steps(shift: int) -> tuple[np.uint32, np.uint32, list[np.uint32]]:
    """Shift, mask and addends of ``bounds - (bounds >> shift) + addend``, which leaves each outcome some room: the addend of outcome 0,
    and what outcome 1 adds to that and outcome 2 to both, modulo 2 ** 32."""
    top = UNIT >> shift
    addends = [top - 2 | top - 1 << 16, 1 | top - 1 << 16, 1 | 2 << 16]
    return (np.uint32(shift), np.uint32((0xFFFF >> shift) * 0x10001),
            [np.uint32((a - b) % (1 << 32)) for a, b in zip(addends, [0, *addends], strict=False)])


_SLOWLY, _FASTER = _steps(SLOW), _steps(FAST)
_HEAD = struct.Struct("<4sBIIQIQIBI")
_MAGIC, _VERSION = b"MCRC", 2

_U16, _U48, _LEAST = np.uint64(16), np.uint64(48), np.uint64(1 << 48)
_BITS = np.uint64(TOTAL_BITS + ID_BITS)


class _Model:
    """Predictions of all lanes; lanes that have ended are cut off at the end.

    Rows 0 and 1 of the arrays of two rows belong to orders 1 and 2. Conditions are numbers 0 and 1 of 32 bits: choices are
    products and sums, which numpy does many lanes at a time.
    """

    def __init__(self, lanes: int):
        self.lanes = lanes
        self.table = np.zeros(2 * lanes << PLACES_BITS, np.uint32)
        self.order0 = np.full(lanes, _EVEN)
        self.orders = np.full(lanes * 3 * (SURE + 1), _EVEN)
        self.scores = np.full((3, lanes), UNIT // 3, np.int32)
        self.before = np.zeros((2, lanes), np.uint32)
        self.time = 0
        self.shrink(lanes)

    def shrink(self, lanes: int) -> None:
        self.order0, self.scores, self.before = self.order0[:lanes].copy(), self.scores[:, :lanes].copy(), self.before[:, :lanes].copy()
        lane = np.arange(lanes, dtype=np.uint32)
        self.places = np.stack([lane, lane + np.uint32(self.lanes)]) << np.uint32(PLACES_BITS)
        self.rows = lane * np.uint32(3 * (SURE + 1)) + np.array([[1], [2 * (SURE + 1)]], np.uint32)
        self._weigh()

    def _weigh(self) -> None:
        total = self.scores.sum(axis=0, dtype=np.int32)
        one, two = ((self.scores[k] << WEIGHT_BITS) // total for k in (1, 2))
        self.weights = [w.astype(np.uint32) for w in ((1 << WEIGHT_BITS) - one - two, one, two)]

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """The two bounds of the mixture, lane by lane."""
        place = self.before * _HASH
        place[1] += place[0]
        place >>= np.uint32(32 - PLACES_BITS)
        place += self.places
        self.place = place.ravel().astype(np.intp)
        self.entry = self.table.take(self.place).reshape(place.shape)
        self.known = self.entry & _HALF
        at = self.entry >> _16
        at[0] += at[0]
        at[0] -= np.minimum(self.known[0] ^ self.known[1], 1)
        at += self.rows
        self.at = at.ravel().astype(np.intp)
        self.bounds = self.orders.take(self.at).reshape(at.shape)
        mixed = self.order0 * self.weights[0]
        mixed += self.bounds[0] * self.weights[1]
        mixed += self.bounds[1] * self.weights[2]
        return mixed & _HALF, mixed >> _16

    def missed(self, ids: np.ndarray) -> np.ndarray:
        """By order, 1 where it predicts another id."""
        return np.minimum(self.known ^ ids, 1)

    def learn(self, ids: np.ndarray, missed: np.ndarray, other: np.ndarray) -> None:
        """``other``: 1 where neither order has the id."""
        self.time += 1
        if self.time % EVERY == 0:
            for k, bounds in enumerate((self.order0, *self.bounds)):
                _, width = _range(bounds & _HALF, bounds >> _16, missed[1], other, np.uint32(UNIT))
                self.scores[k] += (width.view(np.int32) - self.scores[k]) >> SCORE
            np.maximum(self.scores, 1, out=self.scores)
            self._weigh()
        shift, mask, addend = _SLOWLY
        self.order0 += addend[0] + missed[1] * addend[1] + other * addend[2] - (self.order0 >> shift & mask)
        shift, mask, addend = _FASTER
        self.bounds += addend[0] + missed[1] * addend[1] + other * addend[2] - (self.bounds >> shift & mask)
        self.orders[self.at] = self.bounds.ravel()
        # Right: one surer, up to the most. Wrong: one less sure, or else the new id.
        entry = self.entry
        right = np.minimum(entry + _ONE, self.known + _MOST)
        wrong = np.minimum(entry >> _16, 1) * (entry - _ONE - ids) + ids
        wrong -= right
        wrong *= missed
        wrong += right
        self.table[self.place] = wrong.ravel()
        self.before[1] = self.before[0]
        self.before[0] = ids


_HASH = np.array([[0x9E3779B1], [0x85EBCA6B]], np.uint32)


def _range(low: np.ndarray, high: np.ndarray, second: np.ndarray, other: np.ndarray, total: np.uint32) -> tuple[np.ndarray, np.ndarray]:
    """Where an outcome begins between 0 and ``total``, and its width; ``second`` is 1 from outcome 1 on, ``other`` for outcome 2."""
    middle = high - low
    return second * low + other * middle, low + second * (middle - low) + other * (total - high - middle)


def _phases(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """(lanes, steps up to) for lengths in descending order."""
    for n in np.unique(lengths):
        if n:
            yield int(np.searchsorted(-lengths, -n, "right")), int(n)


def _shares(frequency: np.ndarray) -> np.ndarray:
    """The ids below each id, shifted by 16, and its own frequency less 1."""
    below = np.cumsum(frequency) - frequency
    return ((below << 16) + np.maximum(frequency - 1, 0)).astype(np.uint32)


def frequencies(ids: np.ndarray) -> np.ndarray:
    """How often each id occurs, scaled to 2 ** 16 altogether; ids that occur have at least 1."""
    counts = np.bincount(ids, minlength=1)
    scaled = np.where(counts > 0, np.maximum((counts << ID_BITS) // max(len(ids), 1), 1), 0)
    surplus = int(scaled.sum()) - (1 << ID_BITS)
    for k in np.argsort(-scaled, kind="stable"):
        if not surplus:
            break
        change = min(surplus, int(scaled[k]) - 1)  # a negative surplus goes to the most frequent id
        scaled[k] -= change
        surplus -= change
    return scaled


def encode(ids: np.ndarray, lengths: np.ndarray, frequency: np.ndarray) -> list[bytes]:
    """The code of each block; ``ids`` are (step, block), blocks by descending length."""
    lanes = len(lengths)
    shares = _shares(frequency)
    words = np.zeros((2 * len(ids) + 16, lanes), np.uint16)  # a lane's next word lies beside those of other lanes
    flat, position = words.ravel(), np.arange(lanes)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
    model, step, total = _Model(lanes), 0, np.uint32(1 << TOTAL_BITS)
    for alive, until in _phases(lengths):
        if alive < len(model.order0):
            model.shrink(alive)
        own_low, own_span, own_position = low[:alive], span[:alive], position[:alive]
        for step in range(step, until):
            token = ids[step, :alive].astype(np.uint32)
            bounds = model.predict()
            missed = model.missed(token)
            other = missed[0] * missed[1]
            start, width = _range(*bounds, missed[1], other, total)
            share = (shares.take(token) - _HALF) * other + _HALF  # all of the width, if the id was predicted
            own_span >>= _BITS
            added = own_span * ((start << _16) + width * (share >> _16))
            own_low += added
            own_span *= width * ((share & _HALF) + np.uint32(1))
            carried = own_position[own_low < added]
            while len(carried):  # into the words before
                carried -= lanes
                flat[carried] += np.uint16(1)
                carried = carried[flat[carried] == 0]
            model.learn(token, missed, other)
            small = own_span < _LEAST
            flat[own_position] = (own_low >> _U48).astype(np.uint16)
            own_position += small * lanes
            shift = small * _U16
            own_low <<= shift
            own_span <<= shift
            at = np.flatnonzero(own_span < _LEAST)
            if len(at):  # once more: a step takes 31 bits at most
                flat[own_position[at]] = own_low[at] >> _U48
                own_position[at] += lanes
                own_low[at] <<= _U16
                own_span[at] <<= _U16
        step = until
    for _ in range(4):
        flat[position] = low >> _U48
        position += lanes
        low <<= _U16
    counts = position // lanes
    words = np.ascontiguousarray(words[: counts.max(initial=0)].T, "<u2")
    return [words[k, :n].tobytes() for k, n in enumerate(counts.tolist())]


def decode(blocks: list[bytes], lengths: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """(step, block) of the ids, blocks by descending length."""
    lanes = len(lengths)
    by_slot = np.repeat(np.arange(len(frequency), dtype=np.uint16), frequency)
    shares = _shares(frequency)
    words = np.zeros((lanes, max((len(b) for b in blocks), default=0) // 2 + 8), np.uint16)
    for k, block in enumerate(blocks):
        words[k, : len(block) // 2] = np.frombuffer(block, "<u2")
    words = np.ascontiguousarray(words.T)  # a lane's next word lies beside those of other lanes
    flat, position = words.ravel(), np.arange(lanes) + 4 * lanes
    span, code = np.full(lanes, np.iinfo(np.uint64).max, np.uint64), np.zeros(lanes, np.uint64)
    for k in range(4):
        code = code << _U16 | words[k]
    out = np.zeros((int(lengths.max(initial=0)), lanes), np.uint16)
    model, step, total = _Model(lanes), 0, np.uint32(1 << TOTAL_BITS)
    most = np.uint64((1 << TOTAL_BITS + ID_BITS) - 1)
    for alive, until in _phases(lengths):
        if alive < len(model.order0):
            model.shrink(alive)
        own_span, own_code, own_position = span[:alive], code[:alive], position[:alive]
        for step in range(step, until):
            bounds = model.predict()
            own_span >>= _BITS
            value = np.minimum(own_code // own_span, most).astype(np.uint32)
            place = value >> _16
            second, other = ((b <= place).astype(np.uint32) for b in bounds)
            start, width = _range(*bounds, second, other, total)
            start <<= _16
            found = by_slot.take((value - start) // width)
            first, token = model.known
            token = token + second * (first - token)
            token += other * (found - token)
            share = (shares.take(found) - _HALF) * other + _HALF
            own_code -= own_span * (start + width * (share >> _16))
            own_span *= width * ((share & _HALF) + np.uint32(1))
            out[step, :alive] = token
            model.learn(token, model.missed(token), other)
            small = own_span < _LEAST
            shift = small * _U16
            own_span <<= shift
            own_code <<= shift
            own_code |= flat.take(own_position, mode="clip") * small  # a broken block does not read beyond all
            own_position += small * lanes
            at = np.flatnonzero(own_span < _LEAST)
            if len(at):
                own_span[at] <<= _U16
                own_code[at] = own_code[at] << _U16 | flat.take(own_position[at], mode="clip")
                own_position[at] += lanes
        step = until
    return out


def image(ids: np.ndarray, docs: list[tuple[int | None, int]], before: int, crc: int, complete: bool, block: int = BLOCK) -> bytes:
    """A segment: ``docs`` are (id, ids here); the first has ``before`` ids with checksum ``crc`` ahead of them; ``complete`` if the last
    ends here."""
    count = -(-len(ids) // block)
    lengths = np.full(count, block)
    lengths[-1] = len(ids) - block * (count - 1)
    padded = np.zeros(count * block, np.uint16)
    padded[: len(ids)] = ids
    frequency = frequencies(ids)
    table = zlib.compress(frequency.astype("<u4").tobytes())
    codes = encode(np.ascontiguousarray(padded.reshape(count, block).T), lengths, frequency)
    sums = [zlib.crc32(ids[k * block : (k + 1) * block].astype("<u2").tobytes()) for k in range(count)]
    head = _HEAD.pack(_MAGIC, _VERSION, block, count, len(ids), len(docs), before, crc, complete, len(table))
    body = b"".join([
        np.array([len(c) for c in codes], "<u4").tobytes(), np.array(sums, "<u4").tobytes(),
        np.array([d is not None for d, _ in docs], "<u1").tobytes(), np.array([d or 0 for d, _ in docs], "<i8").tobytes(),
        np.array([n for _, n in docs], "<u4").tobytes(), table])
    return b"".join([head, body, struct.pack("<I", zlib.crc32(head + body)), *codes])


def parse(data: bytes) -> tuple[np.ndarray, list[tuple[int | None, int]], int, int, bool]:
    """What ``image`` was given; a ValueError if anything in it is broken."""
    if len(data) < _HEAD.size:
        raise ValueError("not a segment")
    magic, version, block, count, size, n_docs, before, crc, complete, tabled = _HEAD.unpack_from(data)
    at = _HEAD.size + 8 * count + 13 * n_docs + tabled
    if magic != _MAGIC or version != _VERSION or len(data) < at + 4 or zlib.crc32(data[:at]) != struct.unpack_from("<I", data, at)[0]:
        raise ValueError("not a segment, or its header is broken")
    codes = np.frombuffer(data, "<u4", count, _HEAD.size)
    sums = np.frombuffer(data, "<u4", count, _HEAD.size + 4 * count)
    place = _HEAD.size + 8 * count
    known = np.frombuffer(data, "<u1", n_docs, place)
    names = np.frombuffer(data, "<i8", n_docs, place + n_docs).tolist()
    counts = np.frombuffer(data, "<u4", n_docs, place + 9 * n_docs).tolist()
    ends = np.cumsum(codes, dtype=np.int64) + at + 4
    if count and ends[-1] != len(data):
        raise ValueError("a segment is cut short")
    lengths = np.full(count, block)
    lengths[-1] = size - block * (count - 1)
    frequency = np.frombuffer(zlib.decompress(data[at - tabled : at]), "<u4").astype(np.int64)
    blocks = [data[e - n : e] for e, n in zip(ends.tolist(), codes.tolist(), strict=True)]
    ids = decode(blocks, lengths, frequency).T.reshape(-1)[:size]
    for k in range(count):
        if zlib.crc32(ids[k * block : (k + 1) * block].astype("<u2").tobytes()) != sums[k]:
            raise ValueError(f"block {k} of a segment is broken")
    return ids, [(d if k else None, n) for k, d, n in zip(known, names, counts, strict=True)], before, crc, bool(complete)


# Where the tokenizer always begins anew, whatever stands around: at a blank behind a character that is none; at the space that ends
# several blanks, if a character follows; behind a single blank that is no space; between a letter of these and an ASCII sign; and between
# an ASCII sign, other than the apostrophe of contractions, and an ASCII letter. Texts that hold a character that some call white space and
# others do not, or one of the tokenizer's added tokens, are given to it whole.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = rf"^ ?[{_LETTERS}]+\z"
_DOUBTFUL = "[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]"
#: What a byte is, as bits: an ASCII letter, a blank, the space, an ASCII sign, one that is no apostrophe, the end of a letter.
_LETTER, _BLANK, _SPACE, _SIGN, _APART, _ENDS = 1, 2, 4, 8, 16, 32
_BYTES = bytes(
    _LETTER | _ENDS if chr(k).isalpha() else _BLANK | _SPACE * (k == 32) if chr(k) in " \t\n\r\f\v" else _SIGN | _APART * (k != 39)
    for k in range(128)) + bytes(128)


def _alphabet() -> np.ndarray:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be seen, else the next one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = np.zeros(256, "<u2")
    letters[seen] = seen
    letters[letters == 0] = np.arange(256, 512 - len(seen))
    return letters


def _begins(data: bytes, starts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Where pieces begin in texts behind one another: at ``starts`` (the end of all included), and inside those that are not ``whole``."""
    kind = np.frombuffer(bytearray(data.translate(_BYTES)), np.uint8)
    plain = np.frombuffer(data, np.uint8)
    second = np.flatnonzero(plain[:-1] == 0xC3) + 1  # of À to ÿ, but for two signs
    kind[second[(plain[second] != 0x97) & (plain[second] != 0xB7)]] = _ENDS
    cut = np.zeros(len(data) + 1, bool)
    blank, space = (kind & _BLANK).astype(bool), (kind & _SPACE).astype(bool)
    # The space that ends blanks; not at the end of a text, which may be that of all.
    cut[1 : len(data) - 1] = space[1:-1] & blank[:-2] & ~blank[2:]
    cut[starts[1:] - 1] = False
    cut[1:-1] |= blank[1:] & ~blank[:-1]
    cut[2:-1] |= blank[1:-1] & ~(space[1:-1] | blank[2:] | blank[:-2])
    cut[1:-1] |= ((kind[:-1] >> 2 & kind[1:] & _SIGN) | (kind[:-1] >> 4 & kind[1:] & _LETTER)).astype(bool)
    for k in np.flatnonzero(whole):
        cut[starts[k] : starts[k + 1]] = False
    cut[starts] = True
    return np.flatnonzero(cut)


def _buffers(values: pa.BinaryArray | pa.StringArray) -> tuple[bytes, np.ndarray]:
    """The bytes of all values behind one another, and where each begins (and the last one ends)."""
    if not len(values):
        return b"", np.zeros(1, np.int64)
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    size = int(offsets[-1] - offsets[0])
    return values.buffers()[2].slice(int(offsets[0]), size).to_pybytes() if size else b"", offsets - offsets[0]


def _values(values: pa.BinaryArray) -> list[bytes]:
    data, offsets = _buffers(values)
    return [data[a:b] for a, b in itertools.pairwise(offsets.tolist())]


class Tokens:
    """Token ids of texts as little-endian unsigned 16-bit numbers, by the library; different pieces are tokenized once.

    Texts are cut into pieces and the different ones found by Arrow, many texts at a time. New pieces that are one word for the tokenizer
    go to the library's merging model, in the alphabet of bytes and many at once, each before a separator that it merges with none
    of their letters; any others go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        model = self._model = self._tokenizer.model
        self._alphabet = _alphabet()
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        newline, *letters = (chr(c) for c in self._alphabet[[10, 32, 0xC3, *range(0x80, 0xC0), *range(65, 91), *range(97, 123)]])
        self._separator = self._tokenizer.token_to_id(newline)
        mixed = re.compile(f"(?=.*[^{newline}])[{newline}{''.join(letters)}]+")
        self._separates = self._separator is not None and not (
            model.ignore_merges or model.continuing_subword_prefix or model.end_of_word_suffix
            or any(newline in t and mixed.fullmatch(t) for t in self._tokenizer.get_vocab()))
        self._forget()

    def _forget(self) -> None:
        """The ids of known pieces stand behind one another, where each begins (and the last one ends) in an array."""
        self._known: dict[bytes, int] = {}
        self._held = 0
        self._ids, self._bounds = np.zeros(0, "<u2"), np.zeros(1, np.int64)

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        if ids.max(initial=0) > 65535:
            raise ValueError("ids of 65536 and more have no place in these files")
        self._ids = np.concatenate([self._ids, ids.astype("<u2")])
        self._bounds = np.concatenate([self._bounds, self._bounds[-1] + np.cumsum(sizes, dtype=np.int64)])

    def _add_words(self, words: pa.BinaryArray) -> None:
        """Words of letters, each with a space ahead or not."""
        data, offsets = _buffers(words)
        offsets = offsets + np.arange(len(offsets))
        letters = self._alphabet.take(np.insert(np.frombuffer(data, np.uint8), offsets[1:] - np.arange(1, len(offsets)), 10))
        letters, bounds = letters.tobytes().decode("utf-16-le"), [*offsets[:-1:TOGETHER].tolist(), int(offsets[-1])]
        found = (self._model.tokenize(letters[a:b]) for a, b in itertools.pairwise(bounds))
        ids = np.fromiter(map(attrgetter("id"), itertools.chain.from_iterable(found)), np.int64)
        ends = np.flatnonzero(ids == self._separator)
        self._add(np.delete(ids, ends), np.diff(ends, prepend=-1) - 1)

    def _add_others(self, pieces: list[bytes]) -> None:
        found = [e.ids for e in self._tokenizer.encode_batch_fast([x.decode() for x in pieces], add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self._add(np.fromiter(itertools.chain.from_iterable(found), np.int64, int(sizes.sum())), sizes)

    def _learn(self, pieces: pa.BinaryArray) -> np.ndarray:
        """The numbers of new pieces; long ones have theirs until the next call."""
        n = len(self._known)
        self._bounds = self._bounds[: n + 1]
        self._ids = self._ids[: self._bounds[-1]]
        size = pc.binary_length(pieces).to_numpy(zero_copy_only=False)
        word = pc.match_substring_regex(pieces.view(pa.string()), _PLAIN).to_numpy(zero_copy_only=False) & self._separates & (size <= LONGEST)
        order = np.argsort(np.where(word, 0, np.where(size <= LONGEST, 1, 2)), kind="stable")
        words, short = int(word.sum()), int((size <= LONGEST).sum())
        pieces = pieces.take(pa.array(order))
        if words:
            self._add_words(pieces[:words])
        every = _values(pieces)
        self._add_others(every[words:])
        self._known.update(zip(every[:short], range(n, n + short), strict=True))
        self._held += sum(map(len, every[:short]))
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(n, n + len(order))
        return number

    def stream(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts behind one another, and where those of each text begin (and the last ones end)."""
        if self._held > REMEMBERED:
            self._forget()
        texts = texts.cast(pa.string())
        data, starts = _buffers(texts)
        if not data:
            return np.zeros(0, "<u2"), np.zeros(len(texts) + 1, np.int64)
        whole = pc.match_substring_regex(texts, _DOUBTFUL)
        for token in self._added:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        begins = _begins(data, starts, whole.to_numpy(zero_copy_only=False))
        pieces = pa.Array.from_buffers(
            pa.binary(), len(begins) - 1, [None, pa.py_buffer(begins.astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
        different, which = pieces.dictionary, pieces.indices.to_numpy()
        number = np.fromiter(map(self._known.get, _values(different), itertools.repeat(-1)), np.int64, len(different))
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            number[fresh] = self._learn(different.take(pa.array(fresh)))
        first, sizes = self._bounds[number], np.diff(self._bounds)[number].take(which)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        place = np.repeat(first.take(which) - ends[:-1], sizes)
        place += np.arange(len(place))
        return self._ids.take(place), ends[np.searchsorted(begins, starts)]

    def ids(self, texts: list[str]) -> list[bytes]:
        ids, bounds = self.stream(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in itertools.pairwise(bounds.tolist())]


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def _together(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows whose texts have ``TEXTS`` bytes, the last one's excess aside."""
    part = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64) // TEXTS
    bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)] if len(batch) else []
    for a, b in itertools.pairwise(bounds):
        yield batch.slice(a, b - a)


def write(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    block: int = BLOCK, lanes: int = LANES,
) -> None:
    """Write the segments of all documents, by ascending id, to a new folder that all executors reach."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("sum", F.xxhash64("text"))
    ordered = texts.repartitionByRange("id", "sum").sortWithinPartitions("id", "sum", "text").select("id", "text")
    most = block * lanes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        segment, size = 0, 0
        held: list[np.ndarray] = []
        index: list[tuple[int | None, int]] = []
        before, crc = 0, 0  # of the first document's ids in earlier segments

        def row(data: bytes, count: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([count], pa.int64()),
                 pa.array([data], pa.binary())], names=["part", "segment", "n_ids", "image"])

        for batch in batches:
            for some in _together(batch):
                found, bounds = tokens(tokenizer).stream(some.column(1))
                found = np.insert(found, bounds[1:], end_id)
                bounds += np.arange(len(bounds))
                for name, ids in zip(some.column(0).to_pylist(), np.split(found, bounds[1:-1]), strict=True):
                    done = 0
                    while done < len(ids):
                        take = min(len(ids) - done, most - size)
                        held.append(ids[done : done + take])
                        index.append((name, take))
                        done, size = done + take, size + take
                        if size == most:
                            yield row(image(np.concatenate(held), index, before, crc, done == len(ids), block), size)
                            if done < len(ids):
                                earlier = done - take if len(index) == 1 else 0
                                crc = zlib.crc32(ids[earlier:done].astype("<u4").tobytes(), crc if earlier or len(index) == 1 else 0)
                                before = done
                            else:
                                before, crc = 0, 0
                            held, index, size, segment = [], [], 0, segment + 1
        if size:
            yield row(image(np.concatenate(held), index, before, crc, True, block), size)

    ordered.mapInArrow(run, "part int, segment int, n_ids long, image binary").write.option("compression", "none").parquet(path)


def starts(segments: DataFrame) -> DataFrame:
    """(part, segment, start): the ids in all segments before. There is one row for each writing task in the first sum."""
    sizes = segments.select("part", "segment", "n_ids")
    ahead = (Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn(
        "ahead", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*ahead)), F.lit(0)))
    within = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("segment").rowsBetween(*ahead)), F.lit(0))
    return sizes.withColumn("within", within).join(parts, "part").select(
        "part", "segment", (F.col("ahead") + F.col("within")).alias("first"))


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the segments; ``ids`` too if asked for.

    With ids, a document that lies in several segments has a row for each, with ``ids_before``.
    """
    segments = spark.read.parquet(path)
    names = ["part", "segment", "doc_id", "at", "n_tokens", "ids_crc32"] + ["ids_before", "ids"] * with_ids
    schema = "part int, segment int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids_before long, ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                ids, docs, before, crc, complete = parse(batch.column("image")[k].as_py())
                wide, rows, at = ids.astype("<u4"), [], 0
                for n, (name, count) in enumerate(docs):
                    crc = zlib.crc32(wide[at : at + count], crc if n == 0 else 0)
                    ahead = before if n == 0 else 0
                    if complete or n < len(docs) - 1 or with_ids:
                        rows.append((name, at - ahead, ahead + count, crc) + ((ahead, wide[at : at + count].astype(np.int32)),) * with_ids)
                    at += count
                own = [batch.column(c)[k].as_py() for c in ("part", "segment")]
                columns = [pa.array([v] * len(rows), pa.int32()) for v in own]
                columns += [pa.array([r[c] for r in rows], pa.int64()) for c in range(4)]
                if with_ids:
                    columns.append(pa.array([r[4][0] for r in rows], pa.int64()))
                    columns.append(pa.array([r[4][1] for r in rows], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    found = segments.select("part", "segment", "image").mapInArrow(run, schema)
    return found.join(starts(segments), ["part", "segment"]).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), *names[4:])
