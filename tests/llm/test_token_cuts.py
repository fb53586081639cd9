"""Texts are cut at marks and line feeds too, so that a word is one piece whatever follows it."""

import random

import pyarrow as pa
from tokenizers import Tokenizer

from lectern.llm import tokens


def test_marks_and_feeds_make_no_new_pieces():
    enc = tokens.PieceEncoder(tokens.default_path())
    enc.encode(["one two three one. two, (three) one.\nTwo three;\none two: \"one\" two-three |three|"])
    words = {p.strip() for p in enc.known if any(c.isalpha() for c in p)}
    assert words == {"one", "two", "three", "Two"}


def test_ids_of_cut_texts():
    whole, enc, r = Tokenizer.from_file(tokens.default_path()), tokens.PieceEncoder(tokens.default_path()), random.Random(4)
    bits = ["a", "I'm", "'s", "'", "'ll", "x1", "12", ".", ",", "-", "_", "(", "...", "\n", "\n\n", " ", "  ", "\t", "\r\n", "é", "ñ", " ", " ", "́", "“", "中", "\x00", "\x7f", "\x85", "😀", "<|endoftext|>", "<|", "|>", "endoftext"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(20_000)] + [None, "", "\n", "a\n", "\na", "<|endoftext|>"]
    ids, bounds = enc.encode_column(pa.array(texts, pa.string()))
    for t, a, b in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        assert ids[a:b].tolist() == whole.encode(t or "", add_special_tokens=False).ids, repr(t)
