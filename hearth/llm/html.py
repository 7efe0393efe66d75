"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides a block from where it stands
(menus, headers, footers, sidebars, forms, adverts, notices and comments are out), its link
density, its length and its density of stop words. Text that is not in Latin letters, or of a page with next to no known stop
words, is decided by length and link density alone. Short blocks and others in doubt stay open. In
the second pass an open block takes the label of the nearest decided block of its own region (the
earlier one at equal distance); a region is the innermost article or main element, or else the
rest of the page. A page with text in an article or main element has its text there only.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: elements whose content is never text of the page
_SILENT = "script|style|noscript|template|textarea|select|option|svg|iframe|object|canvas|audio|video|title"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_SILENT})\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>|([^<]+)|<", re.S | re.I)
_OUTSIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "head", "fieldset"}
_REGION = {"article", "main"}
_HOLDERS = _OUTSIDE | _REGION | {"div", "section", "ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "li", "details", "figure", "center", "body"}
_BLOCKS = _HOLDERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "dt", "dd", "hr", "address", "figcaption", "summary", "caption", "html", "legend"}
#: words of class, id and role that mark a part as not being the article
_STRONG = frozenset("""ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos promotion cookie cookies consent gdpr newsletter
subscribe signup login share sharing sidebar comment comments replies disqus related recommended breadcrumb breadcrumbs pagination pager""".split())
#: those that parts of an article bear too: in an article or main their blocks are decided like others
_WEAK = frozenset("""banner widget widgets menu nav navbar navigation header masthead footer notice notification notifications alert popup modal overlay search social respond discussion
toolbar copyright complementary contentinfo""".split())
#: words beside a mark that leave it one; any other word makes the whole no mark ("entry-header", "with-sidebar")
_BESIDE = frozenset("""site page main global top bottom left right side bar list item items box block container wrapper wrap inner outer area section button buttons link links post posts
form slot unit primary secondary mobile desktop sticky fixed row col content text icon icons media body""".split())
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WRAPPED = re.compile(r"<(?:article|main)[\s>]", re.I)
_LETTERS = re.compile(r"[^\W\d_]+")
#: common words of English, German, French and Spanish
STOP_WORDS = frozenset("""
the of and to in a is that it for on was with as be by this are or an from at which have not they his were
der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei
de la le et les des en un du une que est pour qui dans par au sur pas plus ne se avec ce il
el los y del las por con para su al lo como más pero sus entre cuando muy sin sobre ser este son
""".split())
SHORT, LONG = 70, 200
#: share of stop words below which a page is taken to be in none of these languages
FEW = 0.08
_LATIN = re.compile(r"[A-Za-z\u00aa\u00ba\u00c0-\u024f\u1e00-\u1eff]")
#: Han, kana, Hangul and full-width letters
_WIDE = re.compile(r"[\u2e80-\u9fff\ua960-\ua97f\uac00-\ud7ff\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff]")


#: how a mark puts a part out: in an article or main not at all, or everywhere; or it is not shown
_NONE, _DOUBT, _OUT, _NEVER = range(4)


class _Block:
    __slots__ = ("text", "linked", "out", "region", "doubt")

    def __init__(self, text, linked, mark, region):
        self.text, self.linked, self.region = text, linked, region
        self.out = mark >= _OUT or mark == _DOUBT and not region
        self.doubt = mark == _DOUBT


def _mark_of(name: str) -> int:
    """The mark of a class, an id or a label, whose words all have to be marks or go with them."""
    words = [w for w in re.split(r"[\s_-]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if w]
    if not all(w in _STRONG or w in _WEAK or w in _BESIDE for w in words):
        return _NONE
    return _OUT if any(w in _STRONG for w in words) else _DOUBT if any(w in _WEAK for w in words) else _NONE


def _marked(tag: str, attributes: str) -> int:
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return _NONE
    if _HIDDEN.search(attributes):
        return _NEVER
    mark = _NONE
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        # the id of a heading names its section
        if name == "id" and len(tag) == 2 and tag[0] == "h":
            continue
        for x in value.split() if name in ("class", "role") else [value]:
            mark = max(mark, _mark_of(x))
    return mark


def blocks_of(html: str, lift: int = _DOUBT) -> list[_Block]:
    """Blocks in page order, with white space made single spaces and references decoded.

    Marks up to ``lift`` do not hold for an article or main inside the marked part.
    """
    out: list[_Block] = []
    # open holders: (tag, the strongest mark on it or around it, its region)
    stack: list[tuple[str, int, int]] = [("", _NONE, 0)]
    parts: list[str] = []
    state = {"linked": 0, "mark": _NONE, "breaks": 0}
    links = regions = 0

    def close():
        nonlocal parts
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append(_Block(text, state["linked"], max(stack[-1][1], state["mark"]), stack[-1][2]))
            parts = []
        state["linked"], state["breaks"], state["mark"] = 0, 0, _NONE

    for m in _TOKEN.finditer(html):
        text = m.group(5)
        if text is not None:
            parts.append(text)
            if links:
                state["linked"] += len(text.strip())
            if not text.isspace():
                state["breaks"] = 0
            continue
        tag = m.group(3)
        if tag is None:
            if m.group(0) == "<":
                parts.append("<")
            continue
        tag, ending, attributes = tag.lower(), m.group(2), m.group(4)
        if tag == "a":
            links = 0 if ending else 1
            continue
        if tag == "br":
            state["breaks"] += 1
            parts.append(" ")
            if state["breaks"] > 1:
                close()
            continue
        if tag not in _BLOCKS:
            continue
        close()
        links = 0
        if tag not in _HOLDERS:
            state["mark"] = _NONE if ending else _marked(tag, attributes)
            continue
        if ending:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if attributes.endswith("/"):
            continue
        if tag in ("li", "tr", "td", "th") and stack[-1][0] == tag:
            stack.pop()
        _, around, region = stack[-1]
        # a heading group inside an article belongs to the article
        if tag in _OUTSIDE and not (tag == "header" and region):
            around = _NEVER
        mark = _NONE if tag in ("body", "main") else _marked(tag, attributes)
        if tag == "article" and mark < _NEVER and not re.search("comment", attributes, re.I):
            mark = _NONE
        if tag in _REGION and around <= lift:
            around = _NONE
        if tag in _REGION and around < _OUT:
            regions += 1
            region = regions
        stack.append((tag, max(around, mark), region))
    close()
    return out


def _length(text: str) -> int:
    """Characters; those of scripts that write a syllable or a word in one count twice."""
    return len(text) + len(_WIDE.findall(text))


def _density(text: str) -> float:
    words = _LETTERS.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def _unknown(blocks: list[_Block]) -> bool:
    """Whether the page's text has next to no stop words of the known languages."""
    text = [b.text for b in blocks if not b.out and b.linked <= 0.5 * len(b.text) and _length(b.text) >= SHORT]
    return _density(" ".join(text)) < FEW


def _first_pass(b: _Block, unknown: bool) -> bool | None:
    """True for main text, False for the rest, None while open."""
    if b.out:
        return False
    size = len(b.text)
    if b.linked > 0.5 * size:
        return None if b.region and not b.doubt else False
    if _length(b.text) < SHORT:
        return None
    dense = _density(b.text)
    if dense >= 0.2 or dense >= 0.1 and size >= LONG:
        return True
    if unknown or 2 * len(_LATIN.findall(b.text)) < len("".join(_LETTERS.findall(b.text))):
        return True if b.linked <= 0.3 * size else None
    return None if b.region else False


def main_text(html: str) -> str:
    """The article's blocks joined by newlines; empty if there is none."""
    blocks = blocks_of(html)
    inside = any(b.region and not b.out for b in blocks)
    if not inside and _WRAPPED.search(html):
        # the only article may stand in a part with a mark
        lifted = blocks_of(html, _OUT)
        if any(b.region and not b.out for b in lifted):
            blocks, inside = lifted, True
    unknown = _unknown(blocks)
    labels = [False if inside and not b.region else _first_pass(b, unknown) for b in blocks]
    n = len(blocks)
    # nearest decided neighbours in the block's region, from the left and from the right
    left: list[tuple[int, bool] | None] = [None] * n
    right: list[tuple[int, bool] | None] = [None] * n
    for order, near in ((range(n), left), (range(n - 1, -1, -1), right)):
        last: dict[int, tuple[int, bool]] = {}
        for i in order:
            if blocks[i].out:
                continue
            near[i] = last.get(blocks[i].region)
            if labels[i] is not None:
                last[blocks[i].region] = (i, labels[i])
    kept = []
    for i, b in enumerate(blocks):
        label = labels[i]
        if label is None:
            a, z = left[i], right[i]
            if a and (not z or i - a[0] <= z[0] - i):
                label = a[1]
            elif z:
                label = z[1]
            else:
                label = bool(b.region)  # nothing decided: an article's text, or a page's edge
        if label:
            kept.append(b.text)
    return "\n".join(kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text`` for every row: the main text of the whole page, empty if it has none.

    Null and empty pages have none, broken markup is read as far as it goes, pages of any length
    are read whole, repeated rows are extracted one by one. Other columns are not used.
    """
    def work(batches):
        for batch in batches:
            text = [main_text(h or "") for h in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(text, pa.string())], names=["id", "url", "text"])

    kinds = pages.schema
    schema = T.StructType([T.StructField("id", kinds[id_col].dataType), T.StructField("url", kinds[url_col].dataType), T.StructField("text", T.StringType())])
    return pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("h")).mapInArrow(work, schema)
