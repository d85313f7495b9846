"""HTML main-text extraction by consensus host paths (operator 5).

Pass 1 scores each page's containers and gives its best one a vote under a generalised path: the tags from the root, each with
its classes, digits generalised.  Votes are summed per host in Spark.  Pass 2 re-extracts every page with the host's
winning path: the first of the host's ``PATHS`` best that holds ``NEARLY`` all of the page's score, and with the page's own
container where none of them does or where that is a marked article.

A container's score is the text of the blocks in it, less its link text.  A page's own container is the outermost ``article``
or ``main`` that holds at least ``MOST`` of the page's score, or else the deepest container that holds all of it.  Menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments, by tag, role or class words, are no
part of a block, unless an element is so only by its words and wraps the article (see ``page_blocks``).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import spare, store

PATHS = 5
MOST = 0.7
NEARLY = 0.95
ROUNDS = 8

# HTML element names by role.
_RAW = "script style textarea title iframe noscript noembed noframes xmp template svg math select canvas object audio video"
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
                    "pre search section summary table tbody td tfoot th thead tr ul").split())
_CONTAINER = frozenset("article blockquote body center div main section td".split())
_DROPPED = frozenset("aside button datalist dialog footer form head header input label menu nav search".split())
_CLOSES_P = _BLOCK - {"body", "head", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "optgroup", "option"}
_SIBLINGS = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
             "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
_SIBLINGS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in _SIBLINGS.items()}
# Words of class, id and role values that mark what isn't the article.
_BOILER = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|"
                     r"newsletter|subscri\w+|signup|login|sidebar|side|aside|rail|menu|nav|navbar|navigation|breadcrumbs?|topbar|toolbar|"
                     r"footer|masthead|site-header|page-header|header|comments?|commentlist|respond|replies|disqus|share|sharing|social|"
                     r"related|recommend\w*|widgets?|pagination|pager|tags|byline-links|skip|search\w*|contentinfo|complementary|"
                     r"copyright|legal)(?=$|[\s_-])", re.I)
# Words of layout states ("has-sidebar", "comments-open"), which say nothing of the element itself.
_STATE = re.compile(r"(?:has|no|with|without)[_-].*|.*[_-](?:open|closed|enabled|disabled)", re.I | re.S)
_READERS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|respond|replies|disqus)(?=$|[\s_-])", re.I)
_ATTRS = r"""(?:[^>"']|"[^"]*"|'[^']*')*+>"""
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({'|'.join(_RAW.split())})\b(?:{_ATTRS}|[^>]*>).*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
                    rf"|<(/?)([a-z][a-z0-9:-]*)({_ATTRS}|[^>]*>)", re.S | re.I)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)


def _named(attrs: str) -> tuple[tuple[str, ...], bool, bool, bool]:
    """(generalised classes, boilerplate by class, id or role, readers' comments by those, hidden)."""
    classes, words, hidden = (), [], False
    for name, a, b, c in _ATTR.findall(attrs.rstrip("/>")):
        value = html.unescape(a or b or c)
        name = name.lower()
        if name == "class":
            classes = tuple(sorted({re.sub(r"\d+", "#", x.lower()) for x in value.split()}))
        if name in ("class", "id", "role"):
            words += value.split()
        elif name == "hidden" or value.lower() == "true":
            hidden = True
    words = [w for w in words if _BOILER.search(w) and not _STATE.fullmatch(w)]
    return classes, bool(words), any(_READERS.search(w) for w in words), hidden


def page_blocks(page: str) -> list[tuple[str, int, int, tuple[str, ...]]]:
    """The page's blocks outside boilerplate, in page order: (text, link characters, characters, containers' paths).

    An element named as boilerplate is taken for a wrapper, and kept, when the page's article is in it: more marked article text
    than outside, or more text than all the rest (readers' comments apart).  The largest first.  Where ``ROUNDS`` of them lie
    around each other, and where a page would stay empty, the names say nothing: the page is read without them.
    """
    kept: set[int] = set()
    for _ in range(ROUNDS):
        blocks, marked, named = _read(page, kept)
        rest = sum(max(0, size - 2 * linked) for _, linked, size, _ in blocks)
        wrappers = [(inner, size, at) for at, (size, inner, readers, within) in named.items()
                    if inner > 0 and inner >= marked or
                    size > rest and (not blocks or not readers and (within or not marked))]
        if not wrappers:
            break
        kept.add(max(wrappers)[2])
    else:
        return _read(page, None)[0]
    return blocks or (_read(page, None)[0] if named else blocks)


def _read(page: str, kept: set[int] | None):
    """(blocks, marked article text in them, elements dropped by name).

    ``kept`` has the places of elements whose names don't count (None: of all).  The dropped ones, outermost only, come by
    place: [text less link text, of it in marked articles, readers' comments, within a marked article].
    """
    named: dict[int, list] = {}
    marked = 0
    out: list[tuple[str, int, int, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = 0
    # open elements: (tag, path so far, containers' paths, dropped, within a link, within an article, place of the element
    # dropped by name, within an article in that one)
    stack: list[tuple] = [("", "", ("",), False, False, False, None, False)]

    def flush():
        nonlocal linked, marked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                if stack[-1][5]:
                    marked += max(0, len(text) - 2 * linked)
                out.append((text, min(linked, len(text)), len(text), stack[-1][2]))
            parts.clear()
        linked = 0

    def close(depth: int):
        if any(x[0] in _BLOCK for x in stack[depth:]):
            flush()
        del stack[depth:]

    def text(raw: str):
        nonlocal linked
        if raw and not stack[-1][3]:
            parts.append(raw)
            if stack[-1][4]:
                linked += len(raw)
        elif raw and stack[-1][6] is not None:
            size = len(" ".join(raw.split()))
            size = -size if stack[-1][4] else size
            dropped = named[stack[-1][6]]
            dropped[0] += size
            dropped[1] += size if stack[-1][7] else 0

    at = 0
    last = page.rfind(">") + 1  # no tag ends beyond it: looking for one there would read the rest again at every "<"
    open_ended = False
    for m in _TOKEN.finditer(page, 0, last):
        text(page[at:m.start()])
        at = m.end()
        open_ended = at == last and (m[1] is not None and re.search(rf"</{m[1]}\s*>\Z", m[0], re.I) is None
                                     or m[0].startswith("<!--") and not m[0].endswith("-->"))
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if m[2]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
                if tag not in _BLOCK and stack[depth][0] in _BLOCK:
                    break  # an inline end tag doesn't close a block
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag in ("br", "wbr", "img"):
                text(" " if tag != "wbr" else "")
            continue
        if tag in _CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    close(depth)
                    break
                if stack[depth][0] in _BLOCK:
                    break
        if tag in _SIBLINGS:
            same, stop = _SIBLINGS[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in stop:
                    break
                if stack[depth][0] in same:
                    close(depth)
                    break
        if tag in _BLOCK:
            flush()
        top = stack[-1]
        classes, boiler, readers, hidden = _named(m[4])
        article = top[5] or tag in ("article", "main")
        hard = hidden or (tag in _DROPPED and not (tag == "header" and top[5]))
        place, inner = top[6], top[7] or (top[6] is not None and tag in ("article", "main") and not boiler)
        if hard:
            place = None
        elif boiler and not top[3] and kept is not None and m.start() not in kept and \
                tag not in ("html", "body", "article", "main") and not (tag == "header" and top[5]):
            place = m.start()
            named[place] = [0, 0, readers, top[5]]
        dropped = top[3] or hard or place is not None
        path = top[1] + "/" + ".".join((tag, *classes)) if tag in _BLOCK else top[1]
        holders = top[2] + (path,) if tag in _CONTAINER else top[2]
        stack.append((tag, path, holders, dropped, top[4] or tag == "a", article, place, inner))
    if not open_ended:  # else the rest belongs to a comment or script that nothing closes
        text(page[at:].partition("<!--")[0])
    flush()
    return out, marked, named


def _scores(blocks) -> dict[str, int]:
    """Score of each container; of the text alone on a page of links."""
    score: dict[str, int] = {}
    for links in (2, 0):
        for _, linked, size, holders in blocks:
            worth = max(0, size - links * linked)
            for h in dict.fromkeys(holders):
                score[h] = score.get(h, 0) + worth
        if any(score.values()):
            break
    return score


def _own(score: dict[str, int]) -> str:
    """The outermost article or main with ``MOST`` of the page's score, or else the deepest container with all of it."""
    whole = max(score.values())
    marked = [h for h, s in score.items() if s >= MOST * whole and _tag(h) in ("article", "main")]
    if marked:
        return min(marked, key=lambda h: (h.count("/"), -score[h], h))
    return max((h for h, s in score.items() if s == whole), key=lambda h: (h.count("/"), h))


def _tag(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0]


def best_container(blocks) -> tuple[str, int] | None:
    """(path, score) of the page's own container, chosen without its host."""
    score = _scores(blocks)
    if not score:
        return None
    best = _own(score)
    return best, score[best]


def _chosen(blocks, host_paths) -> str | None:
    """The page's marked article, or else the first of the host's paths with ``NEARLY`` all of the score, or else its own."""
    score = _scores(blocks)
    if not score:
        return None
    own = _own(score)
    if _tag(own) in ("article", "main"):
        return own
    return next((p for p in host_paths or () if score.get(p, -1) >= NEARLY * score[own]), own)


def host_of(url):
    """The host in lower case; '' for none or a null url."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url) if isinstance(url, str) else url, r"^[A-Za-z][\w+.-]*://([^/?#]*)", 1)), F.lit(""))


def _vote(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in parts:
        best = [best_container(page_blocks(p)) if p else None for p in column.to_pylist()]
        yield pa.StructArray.from_arrays([pa.array([b and b[0] for b in best], pa.string()),
                                          pa.array([b[1] if b else 0 for b in best], pa.int64())], names=["path", "score"])


def _extract(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for column, paths in parts:
        out = []
        for page, host_paths in zip(column.to_pylist(), paths.to_pylist()):
            blocks = page_blocks(page) if page else []
            path = _chosen(blocks, host_paths)
            out.append("\n".join(b[0] for b in blocks if path in b[3]))
        yield pa.array(out, pa.string())


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host`` and its ``PATHS`` most voted container paths, best first.  A page's vote is its score's logarithm."""
    vote = F.arrow_udf(_vote, "struct<path:string,score:bigint>").asNondeterministic()
    votes = (pages.select(host_of(url_col).alias("host"), vote(F.col(html_col)).alias("v"))
             .where("v.path is not null and v.score > 0")
             .groupBy("host", F.col("v.path").alias("path")).agg(F.sum(F.log1p("v.score")).alias("votes")))
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))
    top = votes.withColumn("r", rank).where(F.col("r") <= PATHS)
    listed = top.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("r", "path"))).alias("p"))  # PATHS entries at most
    return listed.select("host", F.col("p.path").alias("paths"))


def extract_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each in ``out``.

    Blocks in page order, joined by one line end; white space within a block is one space; character references are decoded.
    Null and empty pages, and pages without text outside what is boilerplate by tag, give ''.  A null url is the host ''.  Rows, repeated
    ones too, and other columns stay; an existing column ``out`` is replaced.
    """
    winners = store(host_paths(pages, url_col, html_col), "ex-paths")
    host, paths = spare(pages, "host"), spare(pages, "paths")
    winners = winners.select(F.col("host").alias(host), F.col("paths").alias(paths))
    both = pages.withColumn(host, host_of(url_col)).join(winners, host, "left")
    extract = F.arrow_udf(_extract, "string").asNondeterministic()
    return both.withColumn(out, extract(F.col(html_col), F.col(paths))).drop(host, paths)
