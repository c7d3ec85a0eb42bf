"""Operator 6: harmonic packing of tokenised documents.

A document is cut into pieces whose lengths are reciprocals of the capacity:
class k holds pieces of exactly ``capacity // k`` tokens, and a sequence of
class k holds exactly k of them. Each task fills the sequences of its own
partition, so nothing is shuffled and no task waits for another. What is
shorter than the smallest class, and the pieces of sequences that stay
incomplete, are laid end to end into full sequences; the last of them is cut
into powers of two, which need no padding.
"""

from __future__ import annotations

import json
import os
import re
import string
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from glyphmill.llm.columns import id_and_text, slices

if TYPE_CHECKING:
    from tokenizers import Tokenizer

CAPACITY = 4096
CLASSES = 64
# Word forms whose ids a worker remembers, and as many older ones.
REMEMBERED = 120_000
# Chunks of words tokenised at a time: of each token more than its id is held until then.
_CHUNKS = 16
# Tokens per batch of pieces sent back to Spark.
_BATCH_TOKENS = 1 << 20

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


# Latin letters only: such a word is one token run, and its last id marks its end.
_LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
# Kinds of bytes: 1 an ASCII letter or digit, 2 punctuation, 3 white space.
_KINDS = np.zeros(256, np.uint8)
for _kind, _bytes in ((1, string.ascii_letters + string.digits), (2, string.punctuation), (3, string.whitespace)):
    _KINDS[list(_bytes.encode())] = _kind
_END_OF_WORD = "</w>"
# Steps of a tokenizer before its model that leave words of ``_LETTERS`` whole, lower-cased and else as they are.
_KEEPING_STEPS = {"NFC", "Replace", "Lowercase"}, {"Split", "ByteLevel"}


class WordTokenizer:
    """Ids of a text as the tokenizer gives them, as little-endian unsigned 32-bit bytes.

    The tokenizer treats white space as a border and drops it, so a text's ids
    are its words' ids in a row, and words that come again are looked up. A word
    that ends in punctuation after an ASCII letter or digit is its two parts in a
    row; they are set apart in the text before it is cut into words, so that a
    word is learned and kept once, whatever follows it. Words not seen before are tokenised many together: those of letters
    are told apart by the ids that end a word, others by a sentinel.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.sentinel = self._encode(["\x01"])[0]
        self.letters = self._of_letters()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(_END_OF_WORD)]] = True

    def _of_letters(self) -> Tokenizer:
        """A tokenizer around the same model for words of ``_LETTERS`` between blanks.

        Most words to learn are such, and the patterns that find words in any
        text cost more than the model. Where the steps are others than known,
        or give other ids, it is the tokenizer itself.
        """
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        plain = Tokenizer(self.tokenizer.model)
        plain.normalizer = normalizers.Lowercase()
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), byte_level])
        steps = (self.tokenizer.normalizer, "normalizers"), (self.tokenizer.pre_tokenizer, "pretokenizers")
        for (step, name), keeping in zip(steps, _KEEPING_STEPS, strict=True):
            own = json.loads(step.__getstate__()) if step else {}
            if not {part["type"] for part in own.get(name, [own])} <= keeping:
                return self.tokenizer
        samples = ["the Word of Élan grüßt ÀÖØÞ ñandú s t re ve m ll d xqzvkjw"]
        same = plain.encode_batch_fast(samples, add_special_tokens=False)[0].ids == self._encode(samples)[0]
        return plain if same else self.tokenizer

    def _encode(self, texts: list[str], tokenizer: Tokenizer | None = None) -> list[list[int]]:
        return [e.ids for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        """Enter the ids of different words that are not known."""
        known, older = self.known, self.older
        again = [word for word in words if word in older]
        if again:
            known.update(zip(again, map(older.__getitem__, again), strict=True))
            words = [word for word in words if word not in older]
        letters, others, single = [], [], []
        for word in words:
            if word.isalpha() or _LETTERS.fullmatch(word):
                letters.append(word)
            elif len(self.sentinel) == 1 and b"\x01" not in word and len(word) < 200:
                others.append(word)
            else:
                single.append(word)
        for group, joint, marked in ((letters, b" ", False), (others, b" \x01 ", True), (single, b"", False)):
            size = 1 if group is single else 400
            chunks = [group[i : i + size] for i in range(0, len(group), size)]
            tokenizer = self.letters if group is letters else None
            encoded = (
                ids
                for i in range(0, len(chunks), _CHUNKS)
                for ids in self._encode([joint.join(c).decode("utf-8", "replace") for c in chunks[i : i + _CHUNKS]], tokenizer)
            )
            for chunk, ids in zip(chunks, encoded, strict=True):
                array = np.array(ids, "<u4")
                if size == 1:
                    cuts, after = np.array([len(array)]), 0
                elif marked:
                    cuts, after = np.append(np.flatnonzero(array == self.sentinel[0]), len(array)), 1
                else:
                    cuts, after = np.flatnonzero(self.ends[array]) + 1, 0
                cuts = (4 * cuts).tolist()
                places = map(slice, [0, *(cut + 4 * after for cut in cuts[:-1])], cuts)
                known.update(zip(chunk, map(array.tobytes().__getitem__, places), strict=True))

    def batch(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        if len(self.known) > REMEMBERED:  # keep the words of late, which hold the common ones
            self.older, self.known = self.known, {}
        split = self._split(texts)
        # each different word is looked up once, so a text's words are then all there
        missing = [word for word in set().union(*split) if word not in self.known]
        if missing:
            self._learn(missing)
        ids = self.known.__getitem__
        return [b"".join(map(ids, words)) for words in split]

    @staticmethod
    def _split(texts: list[bytes]) -> list[list[bytes]]:
        """The words of each text, lower-cased, punctuation that ends a word after a letter or digit apart."""
        # A-Z are lower-cased by the tokenizer as well; doing it first merges word forms. Not where a
        # special token could appear by it, or a combining mark (U+0300 to U+037F) be joined to the letter.
        plain = [i for i, t in enumerate(texts) if not (b"<|" in t or b"\xcc" in t or b"\xcd" in t or b"\0" in t)]
        joined = b"\n" + b"\n\0\n".join([texts[i] for i in plain]).lower() + b"\n"
        codes = np.frombuffer(joined, np.uint8)
        kinds = _KINDS[codes]
        marks = kinds == 2
        edges = np.flatnonzero(marks[1:] != marks[:-1])
        before, last = edges[::2], edges[1::2]  # of each run of punctuation
        at = before[(kinds[before] == 1) & (kinds[last + 1] == 3)] + 1
        apart = np.insert(codes, at, ord(" ")).tobytes().split(b"\0")
        out = [text.split() for text in texts] if len(plain) < len(texts) else [[]] * len(texts)
        for i, text in zip(plain, apart):
            out[i] = text.split()
        return out


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


class HarmonicPacker:
    """Places the pieces of one partition; ``rows`` collects them."""

    def __init__(self, capacity: int, classes: int, worker: int):
        if classes < 1 or classes > capacity:
            raise ValueError(f"classes must be within 1 and {capacity}, got {classes}")
        self.capacity, self.classes = capacity, classes
        self.smallest = capacity // classes
        self.next_id = worker << 40
        self.open: dict[int, list[tuple]] = {}
        self.tail: list[tuple] = []
        self.tail_tokens = 0
        self.rows: list[tuple] = []

    def _sequence(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def _emit(self, pieces: list[tuple]) -> None:
        """One sequence of pieces (doc_id, start, ids, doc_tokens), end to end."""
        sequence, offset = self._sequence(), 0
        for doc_id, start, ids, total in pieces:
            length = len(ids) // 4
            self.rows.append((doc_id, start, length, ids, total, sequence, offset))
            offset += length

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total = len(ids) // 4
        start, rest = 0, total
        while rest:
            if rest < self.smallest:
                self._lay((doc_id, start, ids[4 * start :], total))
                return
            k = -(-self.capacity // min(rest, self.capacity))
            length = self.capacity // k
            members = self.open.setdefault(k, [])
            members.append((doc_id, start, ids[4 * start : 4 * (start + length)], total))
            if len(members) == k:
                self._emit(self.open.pop(k))
            start += length
            rest -= length

    def _lay(self, piece: tuple) -> None:
        """Add to the sequence that is filled end to end, cutting the piece where it is full."""
        doc_id, start, ids, total = piece
        while ids:
            taken = ids[: 4 * (self.capacity - self.tail_tokens)]
            self.tail.append((doc_id, start, taken, total))
            self.tail_tokens += len(taken) // 4
            start += len(taken) // 4
            ids = ids[len(taken) :]
            if self.tail_tokens == self.capacity:
                self._emit(self.tail)
                self.tail, self.tail_tokens = [], 0

    def close(self) -> None:
        """Place what is left: only the very last sequences are short, and powers of two."""
        for k in sorted(self.open):
            for piece in self.open[k]:
                self._lay(piece)
        self.open = {}
        left, tokens = self.tail, self.tail_tokens
        self.tail, self.tail_tokens = [], 0
        while tokens:
            room = 1 << (tokens.bit_length() - 1)
            tokens -= room
            part: list[tuple] = []
            while room:
                doc_id, start, ids, total = left.pop(0)
                taken = ids[: 4 * room]
                part.append((doc_id, start, taken, total))
                room -= len(taken) // 4
                if len(taken) < len(ids):
                    left.insert(0, (doc_id, start + len(taken) // 4, ids[len(taken) :], total))
            self._emit(part)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    capacity: int = CAPACITY,
    classes: int = CLASSES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Tokenise and pack; one row per piece with its ids (little-endian unsigned 32-bit).

    Each document gets ``end_id`` at its end, so an empty or null text is one
    token. Repeated rows are packed as often as they come, a null id stays null.
    Sequence ids are unique: the partition's number in the upper bits. An empty
    table gives no rows. Columns other than id and text are ignored.
    """
    end = np.array([end_id], "<u4").tobytes()
    kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        packer = HarmonicPacker(capacity, classes, TaskContext.get().partitionId())

        def flush(least: int) -> Iterator[pa.RecordBatch]:
            if packer.rows and sum(r[2] for r in packer.rows) >= least:
                columns = zip(*packer.rows, strict=True)
                packer.rows = []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names
                )

        for batch in batches:
            for part in slices(batch):
                ids = tokenizer.batch(part["text"].to_pylist())
                for doc_id, own in zip(part["doc_id"].to_pylist(), ids, strict=True):
                    packer.add(doc_id, own + end)
                yield from flush(_BATCH_TOKENS)
        packer.close()
        yield from flush(1)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, PIECES)
