"""SentencePiece encoding and decoding with a distinct-chunk table (operator 8).

A marked word is a run of whitespace markers and what follows up to the next marker.  Where no piece of the model crosses
into a marker from the left (checked when the model is opened), no merge does either, so a text's pieces are its marked words'
pieces in order.  Each distinct marked word is segmented once by the library and kept in a table (cleared at ``TABLE_WORDS``
entries); texts look their words up and join the ids by position.  Models whose pieces cross markers, and texts in which the
library would not see the words apart, go through the library whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, give_back

TABLE_WORDS = 150_000
LONG_WORD = 256
_MARK = "▁"
_MARKED = re.compile(" +[^ ]*")


class ChunkTable:
    """Segments texts by their distinct marked words.  ``add(text)`` gives the text's ids."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.sp.get_piece_size()
        pieces = [self.sp.id_to_piece(i) for i in range(n)]
        #: marked words are independent: no piece has a marker after anything else, and white space is kept as it is
        self.apart = (not any(_MARK in p.lstrip(_MARK) for p in pieces) and self.sp.encode("a  b \t") ==
                      self.sp.encode("a") + self._tail("  b \t"))
        self.table: dict[str, bytes] = {}  # a marked word's ids, as int32

    def _tail(self, text: str) -> list[int]:
        """Ids of a text that begins with a space, as they are within a longer text."""
        return [i for w in _MARKED.findall(text) for i in self._segment(w[1:])]

    def _segment(self, word: str) -> list[int]:
        """Ids of the marker and ``word`` (which may begin with more spaces); the library puts the first marker itself."""
        return self.sp.encode(word) if word else [self.sp.piece_to_id(_MARK)]

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.raw(text), np.int32)

    def raw(self, text: str) -> bytes:
        """The ids' bytes."""
        if not text:
            return b""
        if not self.apart:
            return np.array(self.sp.encode(text), np.int32).tobytes()
        if _MARK in text:
            text = text.replace(_MARK, " ")
        words = text.split(" ")
        if "" in words:  # runs of spaces, or one at an end
            words = [w[1:] for w in _MARKED.findall(" " + text)]
        table = self.table
        try:
            return b"".join([table[w] for w in words])
        except KeyError:
            pass
        own = {}
        for w in words:
            if w not in table and w not in own:
                own[w] = np.array(self._segment(w), np.int32).tobytes()
        out = b"".join([table[w] if w in table else own[w] for w in words])
        if len(table) + len(own) > TABLE_WORDS:
            table.clear()
        table.update((w, x) for w, x in own.items() if len(w) <= LONG_WORD)
        return out


def _encoder(model: bytes):
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = ChunkTable(model)
        for column in parts:
            flat, off = bytearray(), np.zeros(len(column) + 1, np.int32)
            for i, text in enumerate(column):  # one text at a time in memory besides the batch
                flat += table.raw(text.as_py() or "")
                off[i + 1] = len(flat) // 4
            yield pa.ListArray.from_arrays(pa.array(off), pa.Array.from_buffers(pa.int32(), int(off[-1]), [None, pa.py_buffer(flat)]))
        table.table.clear()
        give_back()
    return F.arrow_udf(encode, "array<int>").asNondeterministic()


def _decoder(model: bytes):
    def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        plain = np.array([not (sp.is_control(i) or sp.is_unknown(i)) for i in range(n)])
        surface = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
                   else sp.id_to_piece(i).replace(_MARK, " ").encode() for i in range(n)]
        marked = np.array([s.startswith(b" ") for s in surface])
        for column in parts:
            flat = column.flatten().to_numpy()
            import pyarrow.compute as pc

            ends = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy()))
            out = []
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                ids = flat[a:b]
                text = None
                # the library drops the marker that it put before the text, and replaces bytes that aren't UTF-8
                if len(ids) and ids.min() >= 0 and ids.max() < n and plain[ids].all() and marked[ids[0]]:
                    try:
                        text = b"".join([surface[i] for i in ids.tolist()])[1:].decode()
                    except UnicodeDecodeError:
                        text = None
                out.append(sp.decode(ids.tolist()) if text is None else text)
            yield pa.array(out, pa.string())
        give_back()
    return F.arrow_udf(decode, "string").asNondeterministic()


def read_model(path: str | None = None) -> bytes:
    """The model file's bytes (sent to the tasks: half a megabyte); by default the installed public one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


def encode_pieces(docs: DataFrame, model: bytes, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text in ``out`` (array<int>), as the library's ``encode`` gives them.

    Null and empty texts have no ids.  Rows, repeated ones too, and other columns stay; a column ``out`` is replaced.
    """
    bounded_batches(docs.sparkSession)
    return docs.withColumn(out, _encoder(model)(F.col(text_col)))


def decode_pieces(docs: DataFrame, model: bytes, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of each id list in ``out``, as the library's ``decode`` gives it; null or no ids give ''."""
    bounded_batches(docs.sparkSession)
    return docs.withColumn(out, _decoder(model)(F.col(ids_col)))
