"""Secret scan with multipart credential linking (operator 3).

Base kinds (always reported): ``assign``, ``access``, ``hex``.  Weak candidates (``id``, ``blob``, ``endpoint``) are reported
only when complementary parts co-occur: candidates of a text are interval-joined by role over the whole of a paragraph (up to
a blank line), or up to a given reach of characters in it.  An identifier needs a secret, a blob needs an identifier, an endpoint needs both.  Base matches take
part in the join (``access`` as an identifier, ``assign`` and ``hex`` as secrets) but never depend on it.

The scan runs on whole texts in Arrow batches; one RE2 pass per batch picks the texts that hold any candidate at all.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, spare

KINDS = ("assign", "access", "hex", "id", "blob", "endpoint")
REACH = math.inf  # characters between linked parts: no bound but the paragraph
RESULT = "array<struct<kind:string,start:bigint,end:bigint>>"

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ID = re.compile(r"""(?i:client|account|access|user|key)[_-]?(?i:id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{4,}"""
                 r"""|(?<![A-Za-z0-9+/_-])(?=[A-Z0-9]*[0-9])(?=[A-Z0-9]*[A-Z])[A-Z0-9]{16,32}(?![A-Za-z0-9+/_=-])""", re.A)
_BLOB = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/_=-])", re.A)
_ENDPOINT = re.compile(r"""(?i:https?)://[^\s"'<>]+|(?i:endpoint|hostname|host|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::[0-9]{2,5})?""",
                       re.A)
#: A text without any of these has no base match, and weak candidates need an identifier and a secret.
_ANY = (r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}|[A-Za-z0-9+/_-]{32}")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Leftmost non-overlapping matches per base kind, as (start, end, kind); failing matches are dropped."""
    out = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return out


def _weak_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "id") for m in _ID.finditer(text)]
    for m in _BLOB.finditer(text):
        s = m[0]
        if re.search("[a-z]", s) and re.search("[A-Z]", s) and re.search("[0-9]", s):
            out.append((m.start(), m.end(), "blob"))
    return out + [(m.start(), m.end(), "endpoint") for m in _ENDPOINT.finditer(text)]


class _Intervals:
    """Spans of one role, for "is any within reach in the same paragraph"."""

    def __init__(self, spans, reach):
        self.reach = reach
        self.spans = sorted(spans)
        self.starts = [s for s, _, _ in self.spans]
        self.longest = max((e - s for s, e, _ in self.spans), default=0)

    def near(self, span, paragraph) -> bool:
        s, e, _ = span
        lo, hi = max(s - self.reach, paragraph[0]), min(e + self.reach, paragraph[1])
        k = bisect_left(self.starts, hi)
        while k and self.starts[k - 1] >= lo - self.longest:
            k -= 1
            a, b, _ = self.spans[k]
            if b > lo and a < hi and not (a < e and s < b):  # within reach, and not the same characters
                return True
        return False


def link_parts(text: str, base: list[tuple[int, int, str]], reach: float = REACH) -> list[tuple[int, int, str]]:
    """All spans to report, by start, then kind."""
    weak = _weak_spans(text)
    taken = sorted((s, e) for s, e, _ in base)
    weak = [w for w, hit in zip(weak, _overlaps(weak, taken)) if not hit]
    found = list(base)
    if weak:
        ids = _Intervals([x for x in base if x[2] == "access"] + [x for x in weak if x[2] == "id"], reach)
        keys = _Intervals([x for x in base if x[2] != "access"] + [x for x in weak if x[2] == "blob"], reach)
        breaks = [0, *(m.end() for m in re.finditer(r"\n[ \t\r]*\n", text)), len(text) + 1]
        for x in weak:
            k = bisect_left(breaks, x[0] + 1)
            paragraph = (breaks[k - 1], breaks[k])
            if (x[2] == "id" or ids.near(x, paragraph)) and (x[2] == "blob" or keys.near(x, paragraph)):
                found.append(x)
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def _overlaps(weak, taken):
    ends, most = [], 0
    for _, e in taken:
        most = max(most, e)
        ends.append(most)
    starts = [s for s, _ in taken]
    for s, e, _ in weak:
        k = bisect_left(starts, e)
        yield k > 0 and ends[k - 1] > s


def _scan(reach: float):
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for column in parts:
            some = pc.fill_null(pc.match_substring_regex(column, _ANY), False)
            out = [[]] * len(column)
            for i in pc.indices_nonzero(some).to_pylist():
                text = column[i].as_py()
                out[i] = [{"kind": k, "start": s, "end": e} for s, e, k in link_parts(text, base_spans(text), reach)]
            yield pa.array(out, kind)
    return run


def find_secrets(docs: DataFrame, text_col: str = "text", out: str = "secrets", reach: float = REACH) -> DataFrame:
    """``docs`` with an array column ``out`` of spans (kind, start, end), in code points of the whole text, end exclusive.

    By start, then kind in the order of ``KINDS``.  Weak parts link within their paragraph, at most ``reach`` characters apart
    (by default any number).  Null and empty texts have no spans; a very long text takes time and memory in proportion to its length
    and its candidates; every row is kept, repeated ones too; other columns stay as
    they are (an existing column ``out`` is replaced).
    """
    bounded_batches(docs.sparkSession)
    scan = F.arrow_udf(_scan(reach), RESULT).asNondeterministic()
    return docs.withColumn(out, scan(F.col(text_col)))


def joined(spans):
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _redact(by: str):
    def run(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in parts:
            out = []
            for text, own in zip(texts.to_pylist(), spans.to_pylist()):
                done, at = [], 0
                for s in own or ():
                    if s["end"] > at:  # spans may overlap; their union is replaced
                        if s["start"] >= at:
                            done += [text[at:s["start"]], by]
                        at = s["end"]
                out.append(text if not done else "".join(done) + text[at:])
            yield pa.array(out, pa.string())
    return run


def redact_secrets(docs: DataFrame, by: str = "[secret]", text_col: str = "text") -> DataFrame:
    """``docs`` (same columns) with every reported span of the text replaced by ``by``; overlapping spans by one."""
    spans = spare(docs, "secrets")
    found = find_secrets(docs, text_col, spans)
    clean = F.arrow_udf(_redact(by), "string").asNondeterministic()
    return found.withColumn(text_col, clean(F.col(text_col), F.col(spans))).drop(spans)
