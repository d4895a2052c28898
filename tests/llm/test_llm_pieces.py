"""The token store's pieces: cut by byte classes, looked up once per slice, the library's ids."""

import random

import numpy as np
import pyarrow as pa
import pyspark
import pytest

from shardfold.llm import queries, token_counts, token_store

BYTE = queries.tokenizer_file("byte_bpe_50k.json")
ATOMS = [" ", " ", "  ", "\n", "\n", "\n\n", "\t", "\r", "\x1c", "\x85", "\xa0", " ", " ", "᠎", "　", "﻿", "\0", "a", "Word", "the", "42", "3.14",
         "'s", "'ll", "'", '"', ".", ",", "|", "-", "_", "(", "é", "à", "×", "÷", "ÿ", "Ā", "ж", "日本", "。", "😀", "́", "…", "’", "»", "½", "ª", "<|endoftext|>", "<|", "|>"]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE)
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


class Counting(dict):
    asked = 0

    def get(self, *args):
        self.asked += 1
        return super().get(*args)


def test_a_slice_looks_up_its_different_pieces_only(monkeypatch, reference):
    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 0

    lib = token_counts.Library(BYTE, True)
    lib.known = Counting()
    monkeypatch.setattr(pyspark, "TaskContext", Context)
    monkeypatch.setattr(token_store, "library", lambda *_: lib)
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta.", "one,", "two\n"]
    texts = [" ".join(rnd.choice(words) for _ in range(400)) for _ in range(100)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(100), pa.int64()), pa.array(texts)], ["id", "text"])
    out = list(token_store._segments(iter([batch]), BYTE, None))
    raw = b"".join(token_store.unpack(s["n_ids"], s["plane_ends"], s["payload"]).tobytes() for b in out for s in b.to_pylist())
    assert raw == b"".join(map(reference, texts))
    assert lib.known.asked < 1000  # of 40,000 words


@pytest.mark.parametrize("block", [1, 7, 1 << 18])
def test_ids_of_odd_texts_equal_the_library(monkeypatch, reference, block):
    monkeypatch.setattr(token_counts, "BLOCK_BYTES", block)
    rnd = random.Random(block)
    texts = [None, "", *("".join(rnd.choice(ATOMS) for _ in range(rnd.randrange(14))) for _ in range(3000)), "x" * 5000, ""]
    lib = token_counts.Library(BYTE, True)
    assert lib.ids(pa.array(["cut off", *texts], pa.string()).slice(1)) == list(map(reference, texts))
    assert lib.ids(pa.array([], pa.string())) == [] and lib.ids(pa.array([None, ""], pa.string())) == [b"", b""]


def test_both_generations_of_pieces_give_the_same_ids(monkeypatch, reference):
    monkeypatch.setattr(token_counts, "REMEMBERED", 40)
    lib = token_counts.Library(BYTE, True)
    rnd = random.Random(3)
    for _ in range(30):
        texts = [" ".join(f"w{rnd.randrange(60)}" for _ in range(20)) for _ in range(5)]
        assert lib.ids(pa.array(texts)) == list(map(reference, texts))
        assert len(lib.known) + len(lib.older) <= 300
