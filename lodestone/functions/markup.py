"""The reader of markup that trees and markdown share: the standard one, with a short way for pages of plain markup."""

from __future__ import annotations

import re
from html.parser import HTMLParser

_TAG, _SPACE = "[a-zA-Z][a-zA-Z0-9-]*", r"[ \t\n\r\f]"
_ATTRIBUTE = rf'{_SPACE}+([a-zA-Z][a-zA-Z0-9-]*)="([^"<>&]*)"'
_ATTRIBUTES = re.compile(_ATTRIBUTE)
_ATTRIBUTES_TEXT = _ATTRIBUTE.replace("([a-zA-Z]", "(?:[a-zA-Z]", 1).replace('"([^', '"(?:[^', 1)
#: Names that change how the text after them is read, in this or a later version of the standard reader.
_RAW = "(?i:script|style|textarea|title|plaintext|xmp|iframe|noembed|noframes|noscript)"
_UNREAD = lambda tag: rf"|<((?i:{tag}))((?:{_ATTRIBUTES_TEXT})*+){_SPACE}*+>((?:[^<]|<(?![/!]))*+)(</(?i:{tag})>)"
_TOKEN = re.compile(
    rf"([^<&]++)"
    rf"|<(?!{_RAW}[ \t\n\r\f>])({_TAG})((?:{_ATTRIBUTES_TEXT})*+){_SPACE}*+>"
    rf"|</(?!{_RAW}>)({_TAG})>{_UNREAD('script')}{_UNREAD('style')}"
)
_PLAIN = re.compile(rf"(?:{re.sub(r'(?<!\\)\((?!\?)', '(?:', _TOKEN.pattern)})*+")


class Markup(HTMLParser):
    """HTMLParser of one whole page, character references converted. Where a page is plain (quoted attributes, no
    references, comments or odd ends), its tokens are found by one expression and the same handlers get the same calls."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self._at: tuple[int, int] | None = None
        self._starts: list[int] | None = None

    def read(self, page: str) -> None:
        """Feed the page and close."""
        if not _PLAIN.fullmatch(page):
            self._starts = [0, *(m.end() for m in re.finditer("\n", page))]
            self.feed(page)
            self.close()
            return
        start, end, data = self.handle_starttag, self.handle_endtag, self.handle_data
        for m in _TOKEN.finditer(page):
            self._at = m.span()
            kind = m.lastindex
            if kind == 1:
                data(m[1])
            elif kind == 3:
                start(m[2].lower(), [(k.lower(), v) for k, v in _ATTRIBUTES.findall(m[3])] if m[3] else [])
            elif kind == 4:
                end(m[4].lower())
            else:  # a script or style: its start tag, its text, its end tag
                self._at = m.start(), m.start(kind - 1)
                start(m[kind - 3].lower(), [(k.lower(), v) for k, v in _ATTRIBUTES.findall(m[kind - 2])])
                self._at = m.span(kind - 1)
                if m[kind - 1]:
                    data(m[kind - 1])
                self._at = m.span(kind)
                end(m[kind][2:-1].lower())

    def place(self) -> int:
        """Where the present token starts in the page."""
        if self._at is not None:
            return self._at[0]
        line, column = self.getpos()
        return self._starts[line - 1] + column

    def tag_end(self) -> int:
        """Where the present start tag ends in the page."""
        return self._at[1] if self._at is not None else self.place() + len(self.get_starttag_text() or "")
