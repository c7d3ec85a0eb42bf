"""Packing: pieces cover each document exactly, sequences are full."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from glyphmill.llm import packing

from samples import edge_texts, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, pairs, capacity=packing.CAPACITY, classes=packing.CLASSES):
    tokenizer = Tokenizer.from_file(PATH)
    wanted = sorted((repr(i), ids_of(tokenizer, t)) for i, t in pairs)
    # pieces of equal documents may be told apart by place only, so compare their ids as bags of documents
    spare = {}
    for row in rows:
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert len(ids) == row["length"] and 0 < row["length"] <= capacity
        spare.setdefault((repr(row["doc_id"]), row["doc_tokens"]), []).append((row["start"], ids))
    for name, ids in wanted:
        pieces, at = spare[name, len(ids)], 0
        while at < len(ids):
            piece = next(p for p in pieces if p[0] == at and p[1] == ids[at : at + len(p[1])])
            pieces.remove(piece)
            at += len(piece[1])
    assert not any(spare.values())
    used = {}
    for row in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert row["offset"] == used.get(row["sequence_id"], 0)
        used[row["sequence_id"]] = row["offset"] + row["length"]
    padding = sum(capacity - u for u in used.values() if u & (u - 1))
    assert max(used.values()) <= capacity
    assert padding <= sum(used.values()) * (classes - 1) / (capacity - classes + 1)


def test_edge_documents(edge_docs):
    check(packing.pack(edge_docs, PATH).collect(), edge_texts())


@pytest.mark.parametrize("capacity,classes", [(4096, 64), (100, 7), (64, 64), (50, 1), (1, 1)])
def test_capacities(frame_of, capacity, classes):
    pairs = [(i, prose(i, 1 + i * 7 % 200)) for i in range(80)]
    check(packing.pack(frame_of(pairs), PATH, capacity=capacity, classes=classes).collect(), pairs, capacity, classes)


def test_no_documents(no_docs):
    assert packing.pack(no_docs, PATH).count() == 0


def test_words_are_tokenised_as_in_the_text(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    tokenizer, own = Tokenizer.from_file(PATH), packing.WordTokenizer(PATH)
    texts = [t or "" for _, t in edge_texts()] + [
        "Don't!!! it's, I'LL... 's 'x",
        "ábc, İstanbul. ŉ x\x01y <|endoftext|> <|ENDOFTEXT|>, foo<|endoftext|>.",
        "x²,3½. ① 你好，世界 ạ́ b　c d",
        "İ Ǩ É, ſ,K. ǆ? …,e….",
        "a" * 300 + "!!",
        "",
    ]
    for _ in range(2):
        for text, ids in zip(texts, own.batch([t.encode() for t in texts]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, text)[:-1]


def test_classes_hold_a_fixed_count():
    packer = packing.HarmonicPacker(100, 10, worker=3)
    for i in range(50):
        packer.add(i, np.arange(33 + 5, dtype="<u4").tobytes())
    full = {}
    for row in packer.rows:
        full.setdefault(row[5], []).append(row[2])
    assert {tuple(v) for v in full.values() if v[0] == 33} == {(33, 33, 33)}
    assert all(s >> 40 == 3 for s in full)


def test_a_different_word_is_searched_once():
    searched = []

    class Counted(dict):
        def get(self, word, *default):
            searched.append(word)
            return super().get(word, *default)

        def __contains__(self, word):
            searched.append(word)
            return super().__contains__(word)

    tokenizer, own = Tokenizer.from_file(PATH), packing.WordTokenizer(PATH)
    own.known, own.older = Counted(), {b"again": np.array(ids_of(tokenizer, "again")[:-1], "<u4").tobytes()}
    texts = ["once again, once more; again more. ábc! once!!!"] * 200
    for _ in range(2):
        searched.clear()
        for ids in own.batch([t.encode() for t in texts]):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, texts[0])[:-1]
        assert len(searched) <= 2 * len(set(texts[0].split()))


def test_a_word_is_kept_once_whatever_punctuation_follows():
    tokenizer, own = Tokenizer.from_file(PATH), packing.WordTokenizer(PATH)
    texts = ["Word. word, word!!! (word) word\n", "word; x\0y, word.", "WORD?", "", "word... ,word <|word, word's word'"]
    for text, ids in zip(texts, own.batch([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, text)[:-1]
    own.known = {}
    own.batch([t.encode() for t in texts if "\0" not in t and "<|" not in t])
    assert not {b"word.", b"word,", b"word!!!", b"word?"} & set(own.known) and b"word" in own.known


def test_words_of_letters_need_no_patterns():
    tokenizer, own = Tokenizer.from_file(PATH), packing.WordTokenizer(PATH)
    assert own.letters is not own.tokenizer
    words = "".join(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)) + " " + prose(7, 3000) + " Æon éÉ s t ll"
    assert own._encode([words], own.letters) == [tokenizer.encode(words, add_special_tokens=False).ids]
