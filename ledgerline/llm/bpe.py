"""Byte-level BPE encoding by backtracking over longest matches, and decoding by an offset table (operator 13).

A sequence of tokens is what the merges give exactly if every two neighbours are compatible: merging their joined bytes
gives just the two.  So a word is encoded from the left with the longest token that fits (an Aho-Corasick pass over the word
finds the longest token at every position), stepping to the token's next shorter prefix, or back over the last token, when
a pair isn't compatible.  Positions found to lead nowhere are marked and not tried again, so the work is linear in the word.
No merge is ever carried out.  Decoding gathers the tokens' bytes from one buffer by offsets.

Tokens are numbered by rank: the 256 bytes, then the merges in their order.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, give_back

TABLE_WORDS = 600_000
TABLE_PAIRS = 2_000_000
LONG_WORD = 256
# The words of a text, as the library's byte-level splitter finds them.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters long in Unicode, on whose classes all its versions agree; other texts are split by the library itself.
SETTLED = r"[\x00-\u052F\u2000-\u2064\u20A0-\u20BF\u2190-\u2BFF\u3000-\u30FF\u4E00-\u9FA5\uAC00-\uD7A3]*+"


def alphabet() -> list[str]:
    """The character that stands for each byte: itself where it is visible, else the next from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Ranks, ids and bytes of a byte-level BPE tokenizer file.  Raises ValueError for a file of another make."""

    def __init__(self, tokenizer: str):
        make = json.loads(tokenizer)
        model, split = make["model"], make["pre_tokenizer"] or {}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        ids, letters, self.added = model["vocab"], alphabet(), make["added_tokens"]
        names = letters + [a + b for a, b in merges]
        if (model.get("type", "BPE") != "BPE" or any(model.get(k) for k in (
                "dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
                or make["normalizer"] is not None or split.get("type") != "ByteLevel" or split["add_prefix_space"]
                or not split.get("use_regex", True) or (make["decoder"] or {}).get("type") != "ByteLevel"
                or len(set(names)) != len(names) or not ids.keys() >= set(names)
                or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in self.added)):
            raise ValueError("not a plain byte-level BPE tokenizer")
        rank = {name: r for r, name in enumerate(names)}
        byte = {c: b for b, c in enumerate(letters)}
        self.ids = np.array([ids[name] for name in names], np.int32)
        self.tokens = [bytes([byte[c] for c in name]) for name in names]
        self.halves = [(r, r) for r in range(256)] + [(rank[a], rank[b]) for a, b in merges]
        surface = {int(i): bytes([byte[c] for c in name]) if byte.keys() >= set(name) else name.encode()
                   for name, i in ids.items()} | {t["id"]: t["content"].encode() for t in self.added}
        self.surface = [surface.get(i, b"") for i in range(max(surface) + 1)]


class PairTable:
    """Which tokens may stand side by side; answers are kept.

    ``halves`` are the two tokens that each was merged from (a basic one: anything); the first ``basic`` ranks are basic.
    """

    def __init__(self, halves: list[tuple[int, int]], basic: int):
        self.basic = basic
        self.left = [a for a, _ in halves]
        self.right = [b for _, b in halves]
        self.merged = {a << 32 | b: r for r, (a, b) in enumerate(halves) if r >= basic}
        self.known: dict[int, bool] = {}

    def survives(self, x: int, y: int, before: int) -> bool:
        """Whether no merge of rank below ``before`` joins x's symbols with y's when both are merged together.

        Goes back in time, undoing whichever of the two tokens at the border was made later.  At each moment the border pair
        would merge if its rank comes before the merges that took its left (``a``) and right (``b``) token away; of equal
        ranks the one further left comes first.
        """
        a = b = before
        while True:
            c = self.merged.get(x << 32 | y)
            if c is not None and c < a and c <= b:
                return c == before
            if x > y and x >= self.basic:
                a, x = x, self.right[x]
            elif y >= self.basic:
                b, y = y, self.left[y]
            else:
                return True

    def fits(self, x: int, y: int) -> bool:
        key = x << 32 | y
        known = self.known.get(key)
        if known is None:
            known = self.survives(x, y, 1 << 31)
            if len(self.known) >= TABLE_PAIRS:
                self.known.clear()
            self.known[key] = known
        return known


class Merger:
    """``ranks(word)``: the tokens that the merges give a word, found by backtracking over its longest tokens.

    ``tokens`` are strings of symbols, one character a symbol, by rank: the ``basic`` ones, then each merge's.
    """

    def __init__(self, tokens: list[str], halves: list[tuple[int, int]], basic: int):
        import ahocorasick

        self.pairs = PairTable(halves, basic)
        # tokens that their own symbols aren't merged into can't come out
        made = [True] * basic
        for r in range(basic, len(tokens)):
            a, b = halves[r]
            made.append(made[a] and made[b] and self.pairs.survives(a, b, r))
        rank = {t: r for r, t in enumerate(tokens) if made[r]}
        self.length = [len(t) for t in tokens]
        self.shorter = [next((rank[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in rank), -1) for t in tokens]
        self.find = ahocorasick.Automaton()
        for t, r in rank.items():
            self.find.add_word(t, r)
        self.find.make_automaton()

    def ranks(self, word: str) -> list[int]:
        length, shorter, fits = self.length, self.shorter, self.pairs.fits
        longest = [0] * len(word)
        for end, r in self.find.iter(word):  # of one start, the longer match ends later
            longest[end - length[r] + 1] = r
        lost = bytearray(len(word) + 1)
        out: list[int] = []
        at = 0
        while at < len(word):
            r = longest[at]
            while True:
                if not lost[at + length[r]] and (not out or fits(out[-1], r)):
                    out.append(r)
                    at += length[r]
                    break
                r = shorter[r]
                while r < 0:  # nothing fits here: take the last token back and go on with its shorter prefixes
                    lost[at] = 1
                    r = out.pop()
                    at -= length[r]
                    r = shorter[r]
        return out


class BacktrackingEncoder:
    """``ids(text)``: the library's ids of a text, as int32."""

    def __init__(self, tokenizer: str):
        import regex
        from tokenizers import Tokenizer

        v = Vocabulary(tokenizer)
        self.merger = Merger([t.decode("latin-1") for t in v.tokens], v.halves, 256)
        self.out = [i.tobytes() for i in v.ids]
        self.words = regex.compile(WORDS)
        self.settled = regex.compile(SETTLED)
        self.split = Tokenizer.from_str(tokenizer).pre_tokenizer.pre_tokenize_str
        self.byte = {ord(c): b for b, c in enumerate(alphabet())}
        self.special = {t["content"]: np.array([t["id"]], np.int32).tobytes() for t in v.added}
        self.apart = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or "(?!)")
        self.table: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        return b"".join([self.out[r] for r in self.merger.ranks(word.encode().decode("latin-1"))])

    def _part(self, text: str) -> bytes:
        if self.settled.fullmatch(text):
            words = self.words.findall(text)
        else:
            words = [bytes(w.translate(self.byte).encode("latin-1")).decode() for w, _ in self.split(text)]
        table = self.table
        got = list(map(table.get, words))
        if None in got:
            if len(table) > TABLE_WORDS:
                table.clear()
            for i, x in enumerate(got):
                if x is None:
                    w = words[i]
                    x = table.get(w)
                    if x is None:
                        x = self._word(w)
                        if len(w) <= LONG_WORD:
                            table[w] = x
                    got[i] = x
        return b"".join(got)

    def raw(self, text: str) -> bytes:
        """The ids' bytes.  Special tokens' strings are cut out first, as the library does."""
        out, at = [], 0
        for m in self.apart.finditer(text):
            out += [self._part(text[at:m.start()]), self.special[m.group()]]
            at = m.end()
        return b"".join([*out, self._part(text[at:])]) if out else self._part(text)

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.raw(text), np.int32)


class OffsetDecoder:
    """``text(ids)``: the library's text of ids; ids that the vocabulary lacks give nothing."""

    def __init__(self, tokenizer: str):
        surface = Vocabulary(tokenizer).surface
        self.size = len(surface)
        self.bytes = np.frombuffer(b"".join(surface), np.uint8)
        self.start = np.cumsum([0, *map(len, surface)])

    def text(self, ids: np.ndarray) -> str:
        ids = ids[(ids >= 0) & (ids < self.size)]
        start = self.start[ids]
        n = self.start[ids + 1] - start
        end = np.cumsum(n)
        at = np.repeat(start - end + n, n)
        at += np.arange(len(at))
        return self.bytes[at].tobytes().decode("utf-8", "replace")


def _held(kind, tokenizer: str):
    """This worker process's encoder or decoder; its later tasks find it made."""
    import tokenizers

    held = tokenizers.__dict__.setdefault("_ledgerline_bpe", {})
    key = (kind.__name__, tokenizer)
    if key not in held:
        for old in [k for k in held if k[0] == kind.__name__]:
            del held[old]
        held[key] = kind(tokenizer)
    return held[key]


def _encoder(tokenizer: str):
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = _held(BacktrackingEncoder, tokenizer)
        for column in parts:
            flat, off = bytearray(), np.zeros(len(column) + 1, np.int32)
            for i, text in enumerate(column):
                flat += enc.raw(text.as_py() or "")
                off[i + 1] = len(flat) // 4
            ids = pa.Array.from_buffers(pa.int32(), int(off[-1]), [None, pa.py_buffer(flat)])
            yield pa.ListArray.from_arrays(pa.array(off), ids)
        give_back()
    return F.arrow_udf(encode, "array<int>").asNondeterministic()


def _decoder(tokenizer: str):
    def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        dec = _held(OffsetDecoder, tokenizer)
        for column in parts:
            yield pa.array([dec.text(np.array([i for i in x.values.to_pylist() if i is not None], np.int32)
                                     if x.is_valid and x.values.null_count else
                                     x.values.to_numpy() if x.is_valid else np.zeros(0, np.int32)) for x in column], pa.string())
        give_back()
    return F.arrow_udf(decode, "string").asNondeterministic()


def read_tokenizer(path: str | None = None) -> str:
    """The tokenizer file's text (sent to the tasks: under two megabytes); by default the installed public one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_bpe(docs: DataFrame, tokenizer: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text in ``out`` (array<int>), as the library gives them without special tokens added.

    Strings of special tokens in a text become these tokens.  Null and empty texts have no ids; a text without any break is
    one word and takes time and memory in proportion to its length.  Rows, repeated ones too, and other columns stay; a
    column ``out`` is replaced.
    """
    Vocabulary(tokenizer)  # another make fails here, not in the tasks
    bounded_batches(docs.sparkSession)
    return docs.withColumn(out, _encoder(tokenizer)(F.col(text_col)))


def decode_bpe(docs: DataFrame, tokenizer: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of each id list in ``out``, as the library gives it with special tokens kept.

    Null or empty lists give '', null or unknown ids nothing; bytes that aren't UTF-8 become U+FFFD.
    """
    Vocabulary(tokenizer)
    bounded_batches(docs.sparkSession)
    return docs.withColumn(out, _decoder(tokenizer)(F.col(ids_col)))
