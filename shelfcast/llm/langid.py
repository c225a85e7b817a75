"""Language identification by unigrams over pieces, summed over all segmentations.

Each language gives every piece of a fixed public vocabulary a probability. A word's
probability is the sum over all ways to cut it into pieces (forward algorithm); a text's
is the product over its words. The probabilities come from one round of expectation and
maximisation over all texts to learn from: with probabilities that only follow the
pieces' order in the vocabulary, forward and backward sums give every piece's expected
count in each language; Spark adds these up.

Words are runs of ASCII letters, folded to small ones, and of bytes beyond ASCII, of any
length. Sums over long ones are taken in logarithms, as their probabilities are too small for
numbers. Each distinct word of a shard is looked at once, in groups of bounded size; a longer
word stands alone. What reaches the driver is bounded by pieces times languages.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is
every text if there is nothing to learn from. Of equally likely languages the first by
name is taken. Rows may repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfcast.llm.textscan import (
    LETTERS,
    LOWER,
    Words,
    byte_class,
    mix,
    shards,
    spread,
    utf8,
    weights,
)

UNKNOWN = "und"
#: Probabilities of words up to this many bytes, each at least 1e-7 a byte, fit into numbers.
SHORT_BYTES = 32
SHARD_BYTES = 4 * 1024**2
PENDING_WORDS = 300_000
KEPT_WORDS = 400_000
LATTICE_PLACES = 800_000  # looked at together; this bounds the memory
UNIFORM = 1e-3  # share of the probability that all pieces get alike

#: The logarithm of what no language can write; such words tell nothing.
IMPOSSIBLE = -1e6

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = weights(256, 53)
_MARK = "▁"
_ASCII_LETTER = byte_class(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)


@dataclass
class Vocabulary:
    """Pieces and their prefixes by hash. A piece has one number, or none in that place."""

    size: int
    space: int  # the piece that is a word start and nothing else
    hash: np.ndarray  # ascending
    inner: np.ndarray  # number of the piece as such, or -1
    opening: np.ndarray  # number of the piece after a word start, or -1
    longest: int


def _roll(hashes: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return (hashes ^ _BYTE[byte]) * _BASE


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    inner: dict[bytes, int] = {}
    opening: dict[bytes, int] = {}
    for number in range(model.get_piece_size()):
        if model.is_control(number) or model.is_unknown(number):
            continue
        piece = model.id_to_piece(number)
        if model.is_byte(number):
            inner.setdefault(bytes([int(piece[3:5], 16)]), number)
        elif piece.startswith(_MARK):
            opening[piece[1:].encode()] = number
        else:
            inner[piece.encode()] = number
    space = opening.pop(b"")
    known = inner.keys() | opening.keys()
    prefixes = sorted({piece[:size] for piece in known for size in range(1, len(piece) + 1)})
    hashes = np.zeros(len(prefixes), np.uint64)
    for place in range(max(map(len, prefixes))):
        longer = [i for i, one in enumerate(prefixes) if len(one) > place]
        byte = np.array([prefixes[i][place] for i in longer], np.uint8)
        hashes[longer] = _roll(hashes[longer], byte)
    order = np.argsort(mix(hashes))
    return Vocabulary(
        size=model.get_piece_size(),
        space=space,
        hash=mix(hashes)[order],
        inner=np.array([inner.get(prefixes[i], -1) for i in order]),
        opening=np.array([opening.get(prefixes[i], -1) for i in order]),
        longest=max(map(len, known)),
    )


class Lattice:
    """All pieces in some words: edges from place to place, in order of their start.

    Places of word ``w`` are ``first[w] .. first[w + 1] - 1``, one more than it has bytes.
    """

    def __init__(self, words: Words, which: np.ndarray, table: Vocabulary):
        lengths = words.lengths[which]
        self.first = np.concatenate([[0], np.cumsum(lengths + 1)])
        at, offset = spread(words.starts[which], lengths)
        word = np.repeat(np.arange(len(which)), lengths)
        left = np.repeat(lengths, lengths) - offset
        place = self.first[word] + offset
        hashes = np.zeros(len(at), np.uint64)
        found = []
        for size in range(1, table.longest + 1):
            fits = left >= size
            at, offset, left, place = at[fits], offset[fits], left[fits], place[fits]
            hashes = _roll(hashes[fits], words.data[at + size - 1])
            key = mix(hashes)
            slot = np.searchsorted(table.hash, key)
            slot[slot == len(table.hash)] = 0
            known = table.hash[slot] == key
            at, offset, left, place = at[known], offset[known], left[known], place[known]
            hashes, slot = hashes[known], slot[known]
            if not len(at):
                break
            inner, opening = table.inner[slot], np.where(offset == 0, table.opening[slot], -1)
            used = (inner >= 0) | (opening >= 0)
            found.append((offset[used], place[used], inner[used], opening[used], size))
        offset = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
        size = np.repeat([f[4] for f in found], [len(f[0]) for f in found]).astype(np.int64)
        joined = [np.concatenate([f[i] for f in found]) for i in (1, 2, 3)] if found else []
        self.source, self.inner, self.opening = joined or [np.zeros(0, np.int64)] * 3
        self.target = self.source + size
        self.begins = offset == 0
        self.offset, self.size = offset, size

    def edge_probabilities(self, p: np.ndarray, space: int) -> np.ndarray:
        """``p`` has a row per piece, and one of zeros at its end for "no piece"."""
        inside = p[self.inner]
        return np.where(self.begins[:, None], p[self.opening] + p[space] * inside, inside)

    def _sums(self, edges: np.ndarray, long: bool, back: bool) -> np.ndarray:
        """Logarithms of the sums over all ways to a place, or from it (``back``).

        Of words that are not ``long`` the sums themselves fit into numbers.
        """
        begin = self.first[1:] - 1 if back else self.first[:-1]
        source, target = (self.target, self.source) if back else (self.source, self.target)
        # a place in a word is reached when all those before it (behind it) are
        step = -self.offset if back else self.offset + self.size
        order = np.lexsort((target, step))
        source, target, step, edges = source[order], target[order], step[order], edges[order]
        fresh = np.flatnonzero(np.append(True, target[1:] != target[:-1]))[: len(order)]
        turns = np.append(np.flatnonzero(np.diff(step[fresh])) + 1, len(fresh))
        sums = np.full((self.first[-1], edges.shape[1]), -np.inf if long else 0.0)
        sums[begin] = 0.0 if long else 1.0
        ends, low, first = np.append(fresh, len(order)), 0, 0
        with np.errstate(divide="ignore"):
            weights = np.log(edges) if long else edges
            for turn in turns if len(order) else ():
                high = ends[turn]
                groups, come = fresh[first:turn] - low, sums[source[low:high]]
                if long:
                    ways = np.logaddexp.reduceat(come + weights[low:high], groups, axis=0)
                else:
                    ways = np.add.reduceat(come * weights[low:high], groups, axis=0)
                sums[target[fresh[first:turn]]] = ways
                low, first = high, turn
            return sums if long else np.log(sums)

    def forward(self, edges: np.ndarray, long: bool = False) -> np.ndarray:
        return self._sums(edges, long, False)

    def backward(self, edges: np.ndarray, long: bool = False) -> np.ndarray:
        return self._sums(edges, long, True)


def _words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(LOWER[data], offsets, LETTERS)


def _groups(lengths: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    """Words to look at together, short and long ones apart, like ones side by side."""
    order = np.argsort(lengths, kind="stable")
    short = int(np.searchsorted(lengths[order], SHORT_BYTES, side="right"))
    for part, long in ((order[:short], False), (order[short:], True)):
        places = np.concatenate([[0], np.cumsum(lengths[part] + 1)])
        for low, high in shards(places, LATTICE_PLACES):
            yield part[low:high], long


def _prior(size: int) -> np.ndarray:
    """Probabilities by place in the vocabulary, and 0 for "no piece"."""
    p = 1 / (np.arange(size) + 300.0)
    return np.append(p / p.sum(), 0.0)[:, None]


class _Tally:
    """Words and how often each language has them; expected piece counts once in a while.

    Shards add their distinct words, so a word of several shards is cut up only once.
    """

    def __init__(self, table: Vocabulary):
        self.table, self.languages = table, []
        self.found = np.zeros((table.size + 1, 0))
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.texts, self.sizes, self.counts, self.pending = [], [], [], [], 0

    def column(self, name: str) -> int:
        if name not in self.languages:
            self.languages.append(name)
            self.found = np.pad(self.found, ((0, 0), (0, 1)))
        return self.languages.index(name)

    def add(self, words: Words, group: np.ndarray) -> None:
        """``group`` is the language's column of each word."""
        if not len(words):
            return
        hashes, sample, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
        groups = len(self.languages)
        count = np.bincount(number * groups + group, minlength=len(sample) * groups)
        sizes = words.lengths[sample]
        at, _ = spread(words.starts[sample], sizes)
        self.hashes.append(hashes)
        self.texts.append(words.data[at])
        self.sizes.append(sizes)
        self.counts.append(count.reshape(len(sample), groups))
        self.pending += len(sample)
        if self.pending > PENDING_WORDS:
            self.flush()

    def flush(self) -> None:
        if not self.pending:
            return
        groups = len(self.languages)
        ends = np.cumsum(np.concatenate(self.sizes))
        sizes, text = np.concatenate(self.sizes), np.concatenate(self.texts)
        counts = [np.pad(one, ((0, 0), (0, groups - one.shape[1]))) for one in self.counts]
        hashes = np.concatenate(self.hashes)
        _, sample, number = np.unique(hashes, return_index=True, return_inverse=True)
        count = np.zeros((len(sample), groups))
        np.add.at(count, number, np.concatenate(counts))
        words = Words.at(text, np.array([0, len(text)]), ends - sizes, ends)
        for part, long in _groups(words.lengths[sample]):
            self.found += _expected(words, sample[part], count[part], self.table, long)
        self._clear()


def _expected(
    words: Words, sample: np.ndarray, count: np.ndarray, table: Vocabulary, long: bool
) -> np.ndarray:
    """Expected counts of all pieces, by language, of some words counted by language."""
    p, pieces = _prior(table.size), table.size + 1
    lattice = Lattice(words, sample, table)
    edges = lattice.edge_probabilities(p, table.space)
    ahead, behind = (sums(edges, long)[:, 0] for sums in (lattice.forward, lattice.backward))
    word = np.searchsorted(lattice.first, lattice.source, side="right") - 1
    total = ahead[lattice.first[1:] - 1]
    # a word that cannot be cut up has no pieces
    whole = np.where(np.isfinite(total), total, np.inf)[word]
    scale = np.exp(ahead[lattice.source] + behind[lattice.target] - whole)
    p = p[:, 0]
    inside = scale * p[lattice.inner] * np.where(lattice.begins, p[table.space], 1.0)
    opening = scale * p[lattice.opening] * lattice.begins
    found = np.zeros((pieces, count.shape[1]))
    for one in range(count.shape[1]):
        times = count[word, one]
        # a missing piece is -1, which falls on the row for it
        found[:, one] += np.bincount(lattice.inner % pieces, inside * times, pieces)
        found[:, one] += np.bincount(lattice.opening % pieces, opening * times, pieces)
        found[table.space, one] += (inside * times)[lattice.begins].sum()
    return found


def counts(docs: DataFrame, pieces: str, text: str, lang: str) -> DataFrame:
    """``lang, piece, n``: expected counts over all texts with a language."""

    def expect(batches):
        tally = _Tally(vocabulary(pieces))
        for batch in batches:
            names = batch.column("lang").dictionary_encode()
            columns = [tally.column(name) for name in names.dictionary.to_pylist()]
            group = np.array(columns, np.int64)[names.indices.to_numpy()]
            data, offsets = utf8(batch.column("text"))
            for low, high in shards(offsets, SHARD_BYTES):
                part, inner = data[offsets[low] : offsets[high]], offsets[low : high + 1]
                words = _words(part, inner - offsets[low])
                tally.add(words, group[low:high][words.rows()])
        tally.flush()
        for name, found in zip(tally.languages, tally.found[:-1].T):
            piece = np.flatnonzero(found)
            columns = [pa.array([name] * len(piece)), pa.array(piece), pa.array(found[piece])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "piece", "n"])

    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    known = known.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    each = known.mapInArrow(expect, "lang string, piece long, n double")
    return each.groupBy("lang", "piece").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    languages: list[str]
    p: np.ndarray  # pieces and a last row of zeros, by language


def learn(docs: DataFrame, pieces: str, text: str = "text", lang: str = "lang") -> Model:
    """Piece probabilities of each language in ``docs``."""
    rows = counts(docs, pieces, text, lang).collect()
    languages = sorted({row.lang for row in rows})
    found = np.zeros((vocabulary(pieces).size + 1, len(languages)))
    number = {name: place for place, name in enumerate(languages)}
    for row in rows:
        found[row.piece, number[row.lang]] = row.n
    shares = found / np.maximum(found.sum(axis=0), 1e-300)
    shares[:-1] = (1 - UNIFORM) * shares[:-1] + UNIFORM / (len(found) - 1)
    return Model(languages, shares)


class _Scores:
    """Log-probabilities of words in each language; remembers up to ``KEPT_WORDS`` of them."""

    def __init__(self, model: Model, table: Vocabulary):
        self.model, self.table = model, table
        self.hash = np.zeros(0, np.uint64)
        self.logs = np.zeros((0, len(model.languages)))

    def _learn(self, words: Words, hashes: np.ndarray, sample: np.ndarray) -> None:
        logs = np.zeros((len(sample), len(self.model.languages)))
        for part, long in _groups(words.lengths[sample]):
            lattice = Lattice(words, sample[part], self.table)
            edges = lattice.edge_probabilities(self.model.p, self.table.space)
            sums = lattice.forward(edges, long)[lattice.first[1:] - 1]
            logs[part] = np.maximum(sums, IMPOSSIBLE)
        joined = np.concatenate([self.hash, hashes])
        order = np.argsort(joined, kind="stable")
        self.hash, self.logs = joined[order], np.concatenate([self.logs, logs])[order]

    def texts(self, words: Words) -> np.ndarray:
        """Log-probability of each text in each language."""
        texts = len(words.counts)
        if not len(words):
            return np.zeros((texts, len(self.model.languages)))
        hashes, sample, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if len(self.hash) > KEPT_WORDS:
            self.__init__(self.model, self.table)
        fresh = np.isin(hashes, self.hash, assume_unique=True, invert=True)
        if fresh.any():
            self._learn(words, hashes[fresh], sample[fresh])
        logs, rows = self.logs[np.searchsorted(self.hash, hashes)], words.rows()
        sums = [np.bincount(rows, column[number], texts) for column in logs.T]
        return np.stack(sums, axis=1)


def _lettered(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts have a letter; ASCII letters answer most of them at once."""
    ascii_before = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    found = np.diff(ascii_before[offsets]) > 0
    for row in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        text = data[offsets[row] : offsets[row + 1]].tobytes().decode("utf-8", "replace")
        found[row] = any(map(str.isalpha, text))
    return found


def predict(docs: DataFrame, model: Model, pieces: str, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share of that language."""
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        model, table = broadcast.value, vocabulary(pieces)
        names = pa.array([*model.languages, UNKNOWN], pa.string())
        scores = _Scores(model, table)
        for batch in batches:
            data, offsets = utf8(batch.column(text))
            for low, high in shards(offsets, SHARD_BYTES):
                part = data[offsets[low] : offsets[high]]
                inner = offsets[low : high + 1] - offsets[low]
                known = _lettered(part, inner) if model.languages else np.zeros(high - low, bool)
                best = np.full(high - low, len(model.languages))
                share = np.zeros(high - low)
                if model.languages:
                    logs = scores.texts(_words(part, inner))
                    best = np.where(known, np.argmax(logs, axis=1), best)
                    rest = np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                    share = np.where(known, 1 / rest, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(low, high - low).columns,
                        names.take(pa.array(best)),
                        pa.array(share),
                    ],
                    [*batch.schema.names, "lang_pred", "score"],
                )

    out = docs.drop("lang_pred", "score")
    added = StructType.fromDDL("lang_pred string, score double")
    return out.mapInArrow(score, StructType([*out.schema, *added]))


def held_out(doc_id: str = "doc_id") -> Column:
    """A third of the ids, by their checksum; a null id is neither held out nor learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
