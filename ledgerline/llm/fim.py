"""Fill-in-middle transformation by one repeated-capture match a text (operator 11).

A text is cut into units, each a word with the white space before it (white space at the end is a unit of its own).  One
``fullmatch`` of ``(unit)*`` keeps the end of every repetition: their number is n, and both cuts are looked up in them.  What
decides (form, cuts) comes from a digest of the row's id, so a rerun, a retried task or another partitioning gives the same
output.  Digest, form and the assembly of the output are built-in functions; only the match runs in Python, one text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, give_back, spare

# The markers before prefix, suffix and middle, and the unit.  White space is never given back within a unit and
# units are never given back within a text, so the match keeps nothing to return to.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNITS = r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+"

_REST = 2**31 - 1


def _cut(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    import regex

    units = regex.compile(UNITS)
    for texts, first, second in parts:
        n, starts, ends = [], [], []
        for text, h1, h2 in zip(texts, first.to_pylist(), second.to_pylist()):
            at = units.fullmatch(text.as_py() or "").ends(1)
            k = len(at)
            a, b = h1 % (k + 1), h2 % (k + 1)
            a, b = min(a, b), max(a, b)
            n.append(k)
            starts.append(at[a - 1] if a else 0)
            ends.append(at[b - 1] if b else 0)
        yield pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (n, starts, ends)], names=["n", "a", "b"])
    give_back()


def _draws(id_col: str, seed: int) -> list[Column]:
    """The first four 8-digit groups of the digest of seed and id, as numbers.  A null id counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80, id_col: str = "doc_id",
                   text_col: str = "text", out: str = "fim") -> DataFrame:
    """``docs`` with a struct ``out``: n (units), form, prefix_chars, middle_chars (code points) and output.

    ``rate`` percent of the rows are rearranged, ``spm`` percent of these with the suffix first (form ``spm``), the others
    with the prefix first (``psm``).  Null and empty texts, and texts that hold a marker, stay as they are (``plain``, null
    lengths; a null text's output is empty).  A cut may leave any of the three parts empty.  Rows of one id draw alike;
    repeated rows and other columns stay, a column ``out`` is replaced.  A long text takes memory in proportion to its units.
    """
    bounded_batches(docs.sparkSession)
    text, h1, h2, form, cut = (spare(docs, x) for x in ("text", "h1", "h2", "form", "cut"))
    draws = _draws(id_col, seed)
    whole = F.coalesce(F.col(text_col), F.lit(""))
    plain = (whole == "") | F.contains(whole, F.lit(PREFIX)) | F.contains(whole, F.lit(SUFFIX)) \
        | F.contains(whole, F.lit(MIDDLE)) | (draws[2] % 100 >= rate)
    rows = docs.select("*", whole.alias(text), draws[0].alias(h1), draws[1].alias(h2),
                       F.when(plain, "plain").when(draws[3] % 100 < spm, "spm").otherwise("psm").alias(form))
    udf = F.arrow_udf(_cut, "n long, a long, b long").asNondeterministic()
    rows = rows.withColumn(cut, udf(text, h1, h2))
    a, b = F.col(f"{cut}.a").cast("int"), F.col(f"{cut}.b").cast("int")
    prefix, middle = F.substring(F.col(text), F.lit(1), a), F.substring(F.col(text), a + 1, b - a)
    suffix = F.substring(F.col(text), b + 1, F.lit(_REST))
    output = (F.when(F.col(form) == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
              .when(F.col(form) == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
              .otherwise(F.col(text)))
    cutting = F.col(form) != "plain"
    return rows.withColumn(out, F.struct(
        F.col(f"{cut}.n").alias("n"), F.col(form).alias("form"), F.when(cutting, F.col(f"{cut}.a")).alias("prefix_chars"),
        F.when(cutting, F.col(f"{cut}.b") - F.col(f"{cut}.a")).alias("middle_chars"), output.alias("output"),
    )).select(*[c for c in docs.columns if c.lower() != out.lower()], out)


def restore_text(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of.  No part holds a marker and no marker begins inside one, so the first is meant."""
    def between(start, end):
        return F.substring(output, start, end - start)
    p, s, m = (F.instr(output, F.lit(x)) for x in (PREFIX, SUFFIX, MIDDLE))
    middle = F.substring(output, m + 3, F.lit(_REST))
    return (F.when(form == "psm", F.concat(between(p + 3, s), middle, between(s + 3, m)))
            .when(form == "spm", F.concat(between(p + 3, m), middle, between(s + 3, p))).otherwise(output))
