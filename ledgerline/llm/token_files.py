"""Token-id files with an adaptive context-mixing range coder (operator 10).

Documents are range-partitioned and sorted by id, tokenized, and cut into blocks of whole documents (about ``BLOCK_IDS``
ids).  A block is coded on its own: models start afresh, and a checksum of the decoded ids is verified on reading.  The blocks
are written as a Parquet dataset of one binary column, so that Spark's commit protocol covers lost tasks and executors.

Block layout (little endian): magic ``TIDB``, version u16, lanes u16, documents u32, ids u32, vocabulary u32, crc32 of the ids
(as u32), first id's position in its part u64; then per document flag u8 (1: id given), id i64, length u32; then per lane its
number of 16-bit words u32; then the lanes' words.

Coding.  A block's ids are split into ``lanes`` equal runs, coded in lockstep (one numpy operation handles a step of all
lanes), each with its own range coder and all sharing the block's models, which learn from every step:
  order 2: last id seen after the hash of the two previous ids, with a confidence 0-3;
  order 1: last id seen after the previous id, with a confidence 0-3;
  order 0: id frequencies, refreshed at growing numbers of steps; every id of the vocabulary keeps a share.
The confidences and the agreement of orders 2 and 1 select adaptive counts of "order 2 right / order 1 right / neither",
which mix the predictions into one three-way decision; "neither" is followed by the id under the order-0 frequencies.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions

BLOCK_IDS = 1 << 20
MAX_LANES = 4096
_LANE_IDS = 256  # at least so many ids a lane
_HASH_BITS = 18
_MIX_BITS = 16
_ID_BITS = 19
_MAGIC = b"TIDB"
_HEAD = "<4sHHIIIIQ"
_SAME = np.uint64(1 << 48)  # the top 16 bits of low and low + range agree below this
_BOT = np.uint64(1 << 32)
_16, _48 = np.uint64(16), np.uint64(48)
TABLE_WORDS = 700_000  # of a generation of the word table
TABLE_BYTES = 32 << 20  # of its words
_TEXT_BYTES = 8 << 20  # of texts whose words are looked up together
_WORDS_AT_ONCE = 1 << 20  # whose ids are laid out together


class _Models:
    """The adaptive predictions of one block; coder and decoder drive it alike."""

    def __init__(self, ids: int, lanes: int, slots: bool = False):
        """``slots``: keep the id at each place of the order-0 frequencies, too, for a decoder."""
        self.ids, self.slots = ids, slots
        self.names = np.arange(ids, dtype=np.uint16 if ids <= 1 << 16 else np.int32)
        self.after2 = np.zeros(1 << _HASH_BITS, np.int32)  # 4 * id + confidence
        self.after1 = np.zeros(ids, np.int32)
        self.hits = np.full(96, 8, np.int64)
        self.hits[2::3] = 16
        self.counts = np.zeros(ids, np.int64)
        self.news: list[np.ndarray] = []
        self.step, self.refresh = 0, 1
        self.a = np.zeros(lanes, np.intp)
        self.b = np.zeros(lanes, np.intp)
        self._order0()
        self._mix()

    def _order0(self):
        """Frequencies that add up to 2^_ID_BITS, every id at least 1."""
        left = (1 << _ID_BITS) - self.ids
        f = 1 + self.counts * left // max(1, int(self.counts.sum()))
        f[int(f.argmax())] += (1 << _ID_BITS) - int(f.sum())
        self.span = ((np.cumsum(f) - f) << 32 | f).astype(np.uint64)
        if self.slots:
            self.slot = np.repeat(self.names, f)

    def order0(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and frequency of each id."""
        span = self.span.take(ids)
        return span >> np.uint64(32), span & np.uint64(0xFFFFFFFF)

    def _mix(self):
        hits = self.hits.reshape(32, 3)
        f = 1 + hits * ((1 << _MIX_BITS) - 3) // hits.sum(axis=1, keepdims=True)
        f[:, 2] += (1 << _MIX_BITS) - f.sum(axis=1)
        f = f.astype(np.uint64)
        self.mfreq, self.mstart = f.ravel(), (np.cumsum(f, axis=1) - f).ravel()

    def predict(self, n: int):
        """Of the first n lanes: order-2 and order-1 ids, and three times the mixing context."""
        a, b = self.a[:n], self.b[:n]
        self.h = ((a * 0x9E3779B1 ^ b * 0x85EBCA6B) & 0xFFFFFFFF) >> (32 - _HASH_BITS)
        self.e2, self.e1 = self.after2.take(self.h), self.after1.take(b)
        i2, i1 = self.e2 >> 2, self.e1 >> 2
        ctx = ((self.e2 & 3) << 2) + (self.e1 & 3)
        ctx += (i1 == i2) * np.int32(16)
        return i2, i1, ctx.astype(np.intp) * 3

    def learn(self, ids: np.ndarray, right2: np.ndarray, right1: np.ndarray, cell: np.ndarray):
        """``cell``: three times the context plus what happened."""
        n = len(ids)
        b = self.b[:n].copy()
        self.hits += np.bincount(cell, minlength=96)
        fresh = ids << 2
        for table, at, e, right in ((self.after2, self.h, self.e2, right2), (self.after1, b, self.e1, right1)):
            c = e & 3
            # right: one more confidence, up to 3; wrong: one less, or the new id at none
            table[at] = np.where(right, e + (c < 3), np.where(c > 0, e - 1, fresh))
        self.a[:n] = b
        self.b[:n] = ids
        self.news.append(ids)
        self.step += 1
        if self.step == self.refresh:
            self.counts += np.bincount(np.concatenate(self.news), minlength=self.ids)
            self.news = []
            self.refresh += min(max(1, self.step), 48)
            self._order0()
        if self.step < 16 or self.step % 8 == 0:
            self._mix()


def _shape(n: int) -> tuple[int, int]:
    """Lanes and steps of a block of n ids; the first lanes hold one id more than the others."""
    lanes = int(min(MAX_LANES, max(1, n // _LANE_IDS)))
    return lanes, -(-n // lanes)


def _grid(n: int, lanes: int) -> np.ndarray:
    """Each lane's first position."""
    size = np.full(lanes, n // lanes)
    size[:n % lanes] += 1
    return np.cumsum(size) - size


class _Coder:
    """Carry-less range coders, one a lane: 64-bit low and range, 16 bits out at a time."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, (1 << 64) - 1, np.uint64)

    def narrow(self, at, start, freq, bits: int) -> None:
        """Narrow the lanes ``at`` (or the first so many, given a number) and move out every settled 16 bits."""
        first = not isinstance(at, np.ndarray)
        low, rng = (self.low[:at], self.range[:at]) if first else (self.low.take(at), self.range.take(at))
        rng = rng >> np.uint64(bits)
        low = low + rng * start
        rng = rng * freq
        while True:
            same = (low ^ (low + rng)) < _SAME
            go = (same | (rng < _BOT)).nonzero()[0]
            if first:
                self.low[:at], self.range[:at] = low, rng
                first, at = False, np.arange(at)
            else:
                self.low[at], self.range[at] = low, rng
            if not len(go):
                return
            at, low, rng, thin = at.take(go), low.take(go), rng.take(go), ~same.take(go)
            if thin.any():  # straddles a border with little range left: give up the part beyond it
                rng[thin] = (np.uint64(0) - low[thin]) & (_BOT - np.uint64(1))
            self.move(at, low >> _48)
            low, rng = low << _16, rng << _16


class _Writer(_Coder):
    def __init__(self, lanes: int, steps: int):
        super().__init__(lanes)
        self.out = np.zeros((lanes, 3 * steps + 16), np.uint16)
        self.used = np.zeros(lanes, np.int64)
        self.moves = 0

    def move(self, at, words) -> None:
        self.moves += 1
        if self.moves >= self.out.shape[1] - 4 and int(self.used.max()) + 4 > self.out.shape[1]:
            self.out = np.concatenate([self.out, np.zeros_like(self.out)], axis=1)
        used = self.used.take(at)
        self.out.reshape(-1)[at * self.out.shape[1] + used] = words.astype(np.uint16)
        self.used[at] = used + 1

    def close(self) -> list[bytes]:
        """Two more words settle a value within the range, which is at least 2^32."""
        at = np.arange(len(self.low))
        value = (self.low + (_BOT - np.uint64(1))) & ~(_BOT - np.uint64(1))
        self.move(at, value >> _48)
        self.move(at, (value >> np.uint64(32)) & np.uint64(0xFFFF))
        words = self.out[np.arange(self.out.shape[1]) < self.used[:, None]].astype("<u2").tobytes()
        ends = 2 * np.cumsum(np.append(0, self.used))
        return [words[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


class _Reader(_Coder):
    def __init__(self, streams: list[bytes]):
        super().__init__(len(streams))
        n = np.array([len(s) // 2 for s in streams])
        self.words = np.zeros((len(streams), int(n.max()) + 8), np.uint16)
        self.words[np.arange(self.words.shape[1]) < n[:, None]] = np.frombuffer(b"".join(streams), "<u2")
        self.code = np.zeros(len(streams), np.uint64)
        self.used = np.full(len(streams), 4)
        for k in range(4):
            self.code = (self.code << _16) | self.words[:, k].astype(np.uint64)

    def move(self, at, _) -> None:
        used = self.used.take(at)
        word = self.words.take(at * self.words.shape[1] + np.minimum(used, self.words.shape[1] - 1))
        self.code[at] = (self.code.take(at) << _16) | word
        self.used[at] = used + 1

    def value(self, at, bits: int) -> np.ndarray:
        if isinstance(at, np.ndarray):
            code, low, rng = self.code.take(at), self.low.take(at), self.range.take(at)
        else:
            code, low, rng = self.code[:at], self.low[:at], self.range[:at]
        return np.minimum((code - low) // (rng >> np.uint64(bits)), np.uint64((1 << bits) - 1))


def encode_ids(ids: np.ndarray, vocabulary: int) -> list[bytes]:
    """Each lane's bytes."""
    n = len(ids)
    if not n:
        return []
    lanes, steps = _shape(n)
    first = _grid(n, lanes)
    model, coder = _Models(vocabulary, lanes), _Writer(lanes, steps)
    ids = ids.astype(np.int32)
    grid = ids.take(np.minimum(first + np.arange(steps)[:, None], n - 1))
    for s in range(steps):
        now = lanes if s < n // lanes else n % lanes
        own = grid[s, :now]
        i2, i1, ctx = model.predict(now)
        right2, right1 = own == i2, own == i1
        cell = ctx + np.where(right2, 0, np.where(right1, 1, 2))
        coder.narrow(now, model.mstart.take(cell), model.mfreq.take(cell), _MIX_BITS)
        rest = (~(right2 | right1)).nonzero()[0]
        if len(rest):
            miss = own.take(rest).astype(np.intp)
            coder.narrow(rest, *model.order0(miss), _ID_BITS)
        model.learn(own, right2, right1, cell)
    return coder.close()


def decode_ids(streams: list[bytes], n: int, vocabulary: int) -> np.ndarray:
    """The ids that ``encode_ids`` coded; n is their number."""
    if not n:
        return np.zeros(0, np.int32)
    lanes, steps = _shape(n)
    if lanes != len(streams):
        raise ValueError("lanes don't fit the number of ids")
    model, coder = _Models(vocabulary, lanes, slots=True), _Reader(streams)
    grid = np.zeros((steps, lanes), np.int32)
    for s in range(steps):
        now = lanes if s < n // lanes else n % lanes
        i2, i1, ctx = model.predict(now)
        v = coder.value(now, _MIX_BITS)
        kind = (v >= model.mstart.take(ctx + 1)).astype(np.intp) + (v >= model.mstart.take(ctx + 2))
        cell = ctx + kind
        coder.narrow(now, model.mstart.take(cell), model.mfreq.take(cell), _MIX_BITS)
        own = np.where(kind == 0, i2, i1)
        rest = (kind == 2).nonzero()[0]
        if len(rest):
            miss = model.slot.take(coder.value(rest, _ID_BITS).view(np.int64)).astype(np.intp)
            own[rest] = miss
            coder.narrow(rest, *model.order0(miss), _ID_BITS)
        model.learn(own, own == i2, own == i1, cell)
        grid[s, :now] = own
    if n % lanes == 0:
        return grid.T.ravel()
    full = np.arange(lanes) < n % lanes
    return grid.T[np.stack([np.ones(lanes, bool)] * (steps - 1) + [full], axis=1)]


def pack_block(doc_ids: list, lengths: list[int], ids: np.ndarray, position: int, vocabulary: int) -> bytes:
    streams = encode_ids(ids, vocabulary)
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    docs = b"".join(struct.pack("<BqI", d is not None, d or 0, n) for d, n in zip(doc_ids, lengths))
    return b"".join([struct.pack(_HEAD, _MAGIC, 1, len(streams), len(doc_ids), len(ids), vocabulary, crc, position), docs,
                     np.array([len(x) // 2 for x in streams], "<u4").tobytes(), *streams])


def unpack_block(block: bytes) -> tuple[list, list[int], np.ndarray, int]:
    """(document ids, lengths, all ids, position); raises ValueError for a damaged block."""
    magic, version, lanes, docs, n, vocabulary, crc, position = struct.unpack_from(_HEAD, block)
    if magic != _MAGIC or version != 1:
        raise ValueError("not a token block")
    at, doc_ids, lengths = struct.calcsize(_HEAD), [], []
    for given, doc, length in struct.iter_unpack("<BqI", block[at:at + 13 * docs]):
        doc_ids.append(doc if given else None)
        lengths.append(length)
    at += 13 * docs
    sizes = np.frombuffer(block, "<u4", lanes, at).astype(np.int64) * 2
    ends = at + 4 * lanes + np.cumsum(np.append(0, sizes))
    ids = decode_ids([block[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], n, vocabulary)
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc or sum(lengths) != n:
        raise ValueError("checksum mismatch in a token block")
    return doc_ids, lengths, ids, position


_SPACES = bytes.maketrans(b"\t\n\r", b"   ")
_LOWER = bytes.maketrans(b"\t\n\rABCDEFGHIJKLMNOPQRSTUVWXYZ", b"   abcdefghijklmnopqrstuvwxyz")
_CAPITAL_WITH_MARK = re.compile(rb"[A-Z][\xcc\xcd]")
_PUNCTUATION = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())


def _small(word: bytes) -> bytes | None:
    """A word of letters alone in small letters; None for others, and where lower-casing or composing may not be plain."""
    if word.isascii():
        return word.lower() if word.isalpha() else None
    text = word.decode()
    if not text.isalpha():
        return None
    if max(text) < "\u0250":  # below, all letters but one have one small letter and none composes
        return None if "\u0130" in text else text.lower().encode()
    return word if text == text.lower() and is_normalized("NFC", text) else None


def _cut_words(texts: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all words, a space after each; each word's end; each text's number of words) of texts in small letters.

    ``sizes`` are the texts' numbers of words between spaces.  A full stop or comma between an ASCII letter and white space is a
    unit of its own, so it is cut off here and the word before it is known with and without.
    """
    text = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    ends = np.flatnonzero(text == 32)
    mark, letter = text.take(ends - 1, mode="wrap"), text.take(ends - 2, mode="wrap")
    cut = ((mark == 44) | (mark == 46)) & (letter >= 97) & (letter <= 122)
    text = np.insert(text, ends[cut] - 1, 32)
    return text, np.flatnonzero(text == 32) + 1, sizes + np.add.reduceat(cut, np.cumsum(sizes) - sizes, dtype=np.int64)


class WordTable:
    """Ids of whole texts by a table of distinct words.

    A tokenizer that composes characters, lower-cases, drops white space and splits at it gives a text the ids of its runs
    between spaces, tabs and line ends, in order.  Plain new words (letters only, composed) are encoded together, in small
    letters, by a copy of the tokenizer that has nothing left to do but split at spaces and merge; each gives one unit that
    ends in a word-end token.  A word with ASCII punctuation after its letters is these two units.  All others, and texts
    that may hold special tokens, go through the tokenizer itself, as does every text of a tokenizer of another make.

    A full table becomes the old generation, from which words still in use are carried over; the one before it goes.
    """

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer, models

        self.tok = Tokenizer.from_str(tokenizer)
        vocabulary = self.tok.get_vocab(True)
        self.size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.last = np.zeros(self.size, bool)  # tokens that end a unit
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        make = json.loads(tokenizer)
        norm = [x["type"] for x in (make["normalizer"] or {}).get("normalizers", ())]
        split = [x["type"] for x in (make["pre_tokenizer"] or {}).get("pretokenizers", ())]
        self.by_word = norm == ["NFC", "Replace", "Lowercase"] and split == ["Split", "ByteLevel"] and \
            make["pre_tokenizer"]["pretokenizers"][0]["invert"] and make["post_processor"] is None
        if self.by_word:
            make["normalizer"] = None
            make["pre_tokenizer"]["pretokenizers"][0] = {"type": "CharDelimiterSplit", "delimiter": " "}
            added, make["added_tokens"] = make["added_tokens"], []
            self.merge = Tokenizer.from_str(json.dumps(make))
            make["added_tokens"] = added
            if make["model"]["type"] == "BPE":  # a word comes once, so the library's own cache of words would only cost
                fields = {k: v for k, v in make["model"].items() if k not in ("type", "merges") and v is not None}
                merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in make["model"]["merges"]]
                self.merge.model = models.BPE(merges=merges, cache_capacity=0, **fields)
        self.special = tuple(x["content"].encode() for x in make["added_tokens"])
        self.table: dict[bytes, bytes] = {b"": b""}
        self.old: dict[bytes, bytes] = {}
        self.held = 0

    def _encode(self, text: str, tok=None) -> np.ndarray:
        return np.array((tok or self.tok).encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _known(self, word: bytes) -> bool:
        got = self.old.get(word)
        if got is not None:
            self.table[word] = got
        return got is not None or word in self.table

    def _add(self, words: Iterable[bytes]) -> None:
        """Add new words; carry over those that the old generation has."""
        table, old = self.table, self.old.get
        plain, parts, rest = {}, [], {}
        for w in words:
            got = old(w)
            if got is not None:
                table[w] = got
                continue
            if w.isalpha() and w.islower():  # ASCII letters
                plain[w] = None
                continue
            letters = w.rstrip(_PUNCTUATION)
            core = _small(letters) if letters else None
            if core is None:
                rest[w] = None
                continue
            if core == w:
                plain[w] = None
                continue
            if not self._known(core):
                plain[core] = None
            tail = w[len(letters):]
            if tail and not self._known(tail):
                rest[tail] = None
            parts.append((w, core, tail))
        if plain:
            ids = self._encode(b" ".join(plain).decode(), self.merge)
            cut = np.flatnonzero(self.last[ids]) + 1
            if len(cut) == len(plain) and cut[-1] == len(ids):
                raw, n, at = ids.tobytes(), ids.itemsize, 0
                for w, e in zip(plain, cut.tolist()):
                    table[w] = raw[at * n:e * n]
                    at = e
            else:
                rest |= plain
        if rest:
            for w, got in zip(rest, self.tok.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)):
                table[w] = np.array(got.ids, self.dtype).tobytes()
        for w, core, tail in parts:
            table[w] = table[core] + table[tail]

    def ids(self, text: str | bytes) -> np.ndarray:
        """The ids of a text, given as such or in UTF-8."""
        raw = text.encode() if isinstance(text, str) else text
        if not self.by_word or any(x in raw for x in self.special) or b"<|" in raw:
            return self._encode(raw.decode())
        # a capital before a combining mark may compose otherwise than its small letter
        marked = (b"\xcc" in raw or b"\xcd" in raw) and _CAPITAL_WITH_MARK.search(raw)
        words = raw.translate(_SPACES if marked else _LOWER).split(b" ")
        return np.frombuffer(b"".join(self._look_up(words)), self.dtype)

    def _look_up(self, words: list[bytes]) -> list[bytes]:
        """Each word's ids; new words are added."""
        table = self.table
        got = list(map(table.get, words))
        new = [i for i, x in enumerate(got) if x is None]
        if new:
            if len(table) > TABLE_WORDS or self.held > TABLE_BYTES:
                self.old, self.table, self.held = table, {b"": b""}, 0
                table = self.table
            distinct = dict.fromkeys([words[i] for i in new])
            self.held += sum(map(len, distinct))
            self._add(distinct)
            for i in new:
                got[i] = table[words[i]]
        return got

    def ids_of(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text, given in UTF-8; a word that the texts hold often is looked up once."""
        out: list = [None] * len(texts)
        plain, at, sizes = [], [], []
        for i, raw in enumerate(texts):
            if not self.by_word or b"<|" in raw or b"\xcc" in raw or b"\xcd" in raw or any(x in raw for x in self.special):
                out[i] = self.ids(raw)
                continue
            low = raw.translate(_LOWER)
            plain.append(low)
            at.append(i)
            sizes.append(low.count(b" ") + 1)
        if not plain:
            return out
        joined, ends, sizes = _cut_words(plain, np.array(sizes))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.append(0, ends)),
                                                                                pa.py_buffer(joined)])
        coded = words.dictionary_encode()
        got = self._look_up(coded.dictionary.buffers()[2].to_pybytes().split(b" ")[:len(coded.dictionary)])
        flat = np.frombuffer(b"".join(got), self.dtype)
        size = np.fromiter(map(len, got), np.int32, len(got)) // self.dtype.itemsize
        start = np.cumsum(size, dtype=np.int32) - size
        which = np.asarray(coded.indices)
        pieces = []
        for k in range(0, len(which), _WORDS_AT_ONCE):
            w = which[k:k + _WORDS_AT_ONCE]
            n = size.take(w)
            place = np.repeat(start.take(w) - np.cumsum(n, dtype=np.int32) + n, n)
            place += np.arange(len(place), dtype=np.int32)
            pieces.append(flat.take(place))
        ids = np.concatenate(pieces)
        counts = np.add.reduceat(size.take(which), np.cumsum(sizes) - sizes, dtype=np.int64)
        for i, own in zip(at, np.split(ids, np.cumsum(counts)[:-1])):
            out[i] = own
        return out


def _word_table(tokenizer: str) -> WordTable:
    """This worker process's table; its later tasks find it filled."""
    import tokenizers

    held = tokenizers.__dict__.setdefault("_ledgerline_tables", {})
    if tokenizer not in held:
        held.clear()
        held[tokenizer] = WordTable(tokenizer)
    return held[tokenizer]


def _texts_encoded(table: WordTable, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Each row's document id and the ids of its text, in order; texts are encoded by the few megabytes."""
    for batch in batches:
        docs, raws, held = [], [], 0
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = text.as_buffer()
            docs.append(doc)
            raws.append(raw.to_pybytes() if raw is not None else b"")
            held += len(raws[-1])
            if held >= _TEXT_BYTES:
                yield from zip(docs, table.ids_of(raws))
                docs, raws, held = [], [], 0
        yield from zip(docs, table.ids_of(raws))


def _writer(tokenizer: str, end_id: int):
    def run(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        table = _word_table(tokenizer)
        vocabulary = max(table.size, end_id + 1)
        part = TaskContext.get().partitionId()
        docs, lengths, ids, held, position = [], [], [], 0, 0

        def block():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([position], pa.int64()), pa.array([held], pa.int64()),
                 pa.array([pack_block(docs, lengths, np.concatenate(ids), position, vocabulary)], pa.binary())],
                names=["part", "position", "n", "block"])
        for doc, got in _texts_encoded(table, batches):
            own = np.append(got, end_id).astype(np.int32)
            docs.append(doc)
            lengths.append(len(own))
            ids.append(own)
            held += len(own)
            if held >= BLOCK_IDS:
                yield block()
                position += held
                docs, lengths, ids, held = [], [], [], 0
        if docs:
            yield block()
    return run


def read_tokenizer(path: str | None = None) -> str:
    """The tokenizer file's text (sent to the tasks: under two megabytes); by default the installed public one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    """Write every document's ids, ``end_id`` appended, as blocks in ascending id order (null ids first).

    Null and empty texts have the end id only.  Repeated rows are written repeatedly; rows of one id are in no given order
    among themselves.  An empty table writes an empty dataset.
    """
    spark = docs.sparkSession
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id"))
    rows.mapInArrow(_writer(tokenizer, end_id), "part int, position long, n long, block binary").write.parquet(path)


def read_token_files(spark, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, ids (array<int>).

    Without ``with_ids`` the ids are decoded and verified all the same, but not handed on.

    Blocks are decoded where they are read; parts are put in order by their numbers of ids, one row a part.
    """
    blocks = spark.read.schema("part int, position long, n long, block binary").parquet(path)
    sizes = [(r.part, r.n) for r in blocks.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()]
    before, at = {}, 0
    for part, n in sizes:  # as many as the writer had tasks
        before[part] = at
        at += n

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                docs, lengths, ids, position = unpack_block(block.as_py())
                ends = np.cumsum([0, *lengths])
                raw = memoryview(ids.astype("<u4").tobytes())
                crcs = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                step = 2048
                for k in range(0, len(docs), step):
                    e = ends[k:k + step + 1]
                    columns = [pa.array(docs[k:k + step], pa.int64()), pa.array(e[:-1] + position + before[part]),
                               pa.array(lengths[k:k + step], pa.int64()), pa.array(crcs[k:k + step], pa.int64())]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array((e - e[0]).astype(np.int32)),
                                                                pa.array(ids[e[0]:e[-1]])))
                    yield pa.RecordBatch.from_arrays(columns, names=names)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    names = [column.split()[0] for column in schema.split(", ")]
    return blocks.select("part", "block").mapInArrow(decode, schema)
