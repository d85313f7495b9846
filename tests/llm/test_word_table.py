"""The word table of the token files against the library: odd words, and turning generations."""

import random

import pytest

from ledgerline.llm import token_files


def test_long_words_turn_the_generation(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "TABLE_BYTES", 1000)
    table = token_files.WordTable(tokenizer)
    for k in range(20):
        text = f"w{k}" * 400 + " and " + "é" * 900
        assert table.ids(text).tolist() == table.tok.encode(text, add_special_tokens=False).ids
    assert len(table.table) + len(table.old) < 12


@pytest.fixture(scope="module")
def tokenizer():
    return token_files.read_tokenizer()


def odd_texts(n: int) -> list[str]:
    pick = random.Random(11)
    bits = ["a", "Th", "ing", "É", "É", "é", "é", "İ", "ı", "ß", "ẞ", "Σ", "ς", "'s", "'", "’", ".", "!!", "$$$", "<", "<|", "≠",
            "̸", "1", "²", "Ⅷ", "ª", "\u0085", "\t", "\x0b", "\n", " ", " ", " ", " ", "中", "가", "ᄀ", "ᅡ", "😀", "ﬁ", "Ǆ", "ǅ",
            "Å", "Å", "_", "`", "ŉ", "ÿ", "Ÿ", "ɐ", "Ⱥ", "don't", "--", "…", "×", "﻿", "‍", "<|endoftext|>"]
    return ["", " ", "<|endoftext|>"] + ["".join(pick.choices(bits, k=pick.randint(1, 14))) for _ in range(n)]


def test_ids_are_the_library_s(tokenizer):
    table = token_files.WordTable(tokenizer)
    texts = odd_texts(8000) + [f"Ab{chr(c)}.!" for c in range(0x20, 0x2500)] + ["lang" * 20000, "word, " * 30000]
    for text, got in zip(texts, table.tok.encode_batch_fast(texts, add_special_tokens=False)):
        assert table.ids(text).tolist() == got.ids, text[:40]
        assert table.ids(text.encode()).tolist() == got.ids, text[:40]


def test_generations_turn_without_a_change(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "TABLE_WORDS", 40)
    table = token_files.WordTable(tokenizer)
    texts = odd_texts(1500)
    for text, got in zip(texts, table.tok.encode_batch_fast(texts, add_special_tokens=False)):
        assert table.ids(text).tolist() == got.ids, text[:40]
    assert table.old and len(table.old) < 200 and len(table.table) < 200


def test_many_texts_together(tokenizer, monkeypatch):
    """Texts encoded together have the library's ids; a word before a comma or full stop is known by itself, and looked up once."""
    texts = ["", " ", "one, two. one, one", "", "a.", ".", ",a", "  b,  c.\td.\n", "x's, it's.", "é, éa. —, ...,", "A1, 2, b2. zz!, zz..",
             "<|endoftext|> one, two", "Ábc, Ö.", "ΣΣ, aΣ. b", "m@n.org, m.n.", "x , y, z.", ",", "end."]
    table = token_files.WordTable(tokenizer)
    expected = [e.ids for e in table.tok.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(token_files, "_WORDS_AT_ONCE", 3)
    asked, look_up = [], table._look_up
    monkeypatch.setattr(table, "_look_up", lambda words: asked.append(words) or look_up(words))
    for _ in range(2):
        assert [x.tolist() for x in table.ids_of([t.encode() for t in texts])] == expected
    for i in range(len(texts)):
        assert [x.tolist() for x in table.ids_of([t.encode() for t in texts[i:]])] == expected[i:]
    assert b"one" in table.table and not {b"one,", b"two.", b"end."} & set(table.table)
    together = max(asked, key=len)
    assert len(together) == len(set(together))
