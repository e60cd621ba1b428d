"""The one tokenizer of notice pages: numbered h3 headings and what follows them, in Arrow batches.

Python's scanner needs about a tenth of the CPU time that the same patterns take as column expressions.
"""

from __future__ import annotations

import html
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_H3 = re.compile(r"<h3\b[^>]*>", re.I)
_NUMBER = re.compile(r"(?<![\d.])(\d+\.\d+(?:\.\d+)?)\.?\)")
_STARTS = re.compile(r"(?:\s|&nbsp;|<[^>]*>)*(\d+(?:\.\d+)+)\.?\)")
_CLOSE = re.compile(r"</h3\s*>", re.I)
_STOP = re.compile(r"<h2\b|</body\b|</html\b", re.I)
_SPAN = re.compile(r"<span\b[^>]*\bclass\s*=\s*[\"']?[^\"'>]*\bnormal\b[^>]*>(.*?)(?:</span\s*>|\Z)", re.I | re.S)
_TAG = re.compile(r"<[^>]*(?:>|\Z)")
_P = re.compile(r"<p\b[^>]*>(.*?)(?=</p\s*>|<(?:p|h[1-6]|div|table|ul|ol)\b|\Z)", re.I | re.S)
_BREAK = re.compile(r"(?:\s|<br\b[^>]*>)*([^<]*)", re.I)

HEADING = "struct<number:string,span:string,inline:string,paragraphs:array<string>,block:string>"
_ARROW = pa.list_(pa.struct([("number", pa.string()), ("span", pa.string()), ("inline", pa.string()), ("paragraphs", pa.list_(pa.string())), ("block", pa.string())]))


def text_of(markup: str) -> str:
    """Text of a fragment: tags out, references decoded, blanks squeezed."""
    s = _TAG.sub(" ", markup)
    return " ".join((html.unescape(s) if "&" in s else s).split())


def headings(body: str | None, numbers: frozenset[str] | None = None, anywhere: bool = False, full: bool = True) -> list[dict] | None:
    """The numbered headings of a page in order; None for None.

    A heading's number is what it starts with, or with ``anywhere`` the first number of two or three levels before a ``)`` in its text. Only ``numbers`` if given.
    ``span``, ``inline`` and ``paragraphs`` are the value candidates: the span of class normal in the heading, the text right after it,
    the paragraphs up to the next heading; ``block`` (``full``) is all text up to the next numbered heading, a line for each element.
    """
    if body is None:
        return None
    if "<!--" in body:
        body = _COMMENT.sub("", body)
    out: list[dict] = []
    for chunk in _H3.split(body)[1:]:
        if anywhere:
            end = _CLOSE.search(chunk)
            m = _NUMBER.search(text_of(chunk[: end.start()] if end else chunk))
        else:
            m = _STARTS.match(chunk)
        close = _CLOSE.search(chunk) if m is None or numbers is None or m[1] in numbers else None
        if m is None:
            if full and out and close:  # a heading without a number belongs to the block before it
                stop = _STOP.search(chunk)
                more = [t for t in (text_of(x) for x in re.split(r"</?(?:p|h3|br|li|div)\b[^>]*>", chunk[: stop.start() if stop else len(chunk)])) if t]
                out[-1]["block"] = "\n".join(x for x in (out[-1]["block"], *more) if x) or None
            continue
        if numbers is not None and m[1] not in numbers:
            continue
        head, after = (chunk[: close.start()], chunk[close.end() :]) if close else (chunk, "")
        stop = _STOP.search(after)
        if stop:
            after = after[: stop.start()]
        span = _SPAN.search(head)
        inline = text_of(_BREAK.match(after)[1])
        ps = [t for t in map(text_of, _P.findall(after)) if t] if "<" in after else []
        block = "\n".join(x for x in (inline, *ps) if x) if full else ""
        out.append({"number": m[1], "span": (span and text_of(span[1])) or None, "inline": inline or None, "paragraphs": ps, "block": block or None})
    return out


def heading_column(body: Column | str, numbers: Sequence[str] | None = None, anywhere: bool = False, full: bool = True) -> Column:
    """``headings`` of a column, as array<struct<number, span, inline, paragraphs, block>>."""
    only = None if numbers is None else frozenset(numbers)

    @F.arrow_udf(f"array<{HEADING}>")
    def tokenize(bodies: pa.Array) -> pa.Array:
        return pa.array([headings(b, only, anywhere, full) for b in bodies.to_pylist()], _ARROW)

    return tokenize(F.col(body) if isinstance(body, str) else body)


def first_value(h: Column) -> Column:
    """Value of a heading for keys: its span, else the text right after it, else its first paragraph, else ''."""
    return F.coalesce(h["span"], h["inline"], F.get(h["paragraphs"], F.lit(0)), F.lit(""))


def section_text(h: Column) -> Column:
    """Value of a heading for sections: its span, else the text after it with its paragraphs below, else the paragraphs in one line, else null."""
    return F.coalesce(h["span"], F.when(h["inline"].isNotNull(), F.array_join(F.concat(F.array(h["inline"]), h["paragraphs"]), "\n")), F.nullif(F.array_join(h["paragraphs"], " "), F.lit("")))
