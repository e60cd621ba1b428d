"""Text of whole pages, by Python's scanner in Arrow batches."""

from __future__ import annotations

import html
import re

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_HIDDEN = re.compile(r"<(head|script|style)\b[^>]*>.*?</\1\s*>", re.I | re.S)
_TAG = re.compile(r"<[^>]*(?:>|\Z)")
_BROKEN = re.compile(r"&#?[0-9A-Za-z]{0,8}\s*\Z")
_CLOSED = re.compile(r"</html\s*>", re.I)


def page_text(body: str) -> str:
    """Text of a page's body: comments, head, scripts, styles and tags out, references decoded, blanks squeezed. A broken tag or reference at the end goes too."""
    if "<!--" in body:
        body = _COMMENT.sub(" ", body)
    s = _TAG.sub(" ", _HIDDEN.sub(" ", body))
    if "&" in s:
        s = html.unescape(_BROKEN.sub("", s))
    return " ".join(s.split())


def closed(body: str) -> bool:
    """True if a page has a closing html tag outside of comments."""
    return bool(_CLOSED.search(_COMMENT.sub("", body) if "<!--" in body else body))
