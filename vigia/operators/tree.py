"""Tree rules over the standard library's HTML event parser, shared by the tasks that read markup.

Fixed values: elements of the public tree builder that close at once, those whose text is not part
of an enclosing element's, and those that keep white space as it is.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link",
        "menuitem", "meta", "param", "source", "track", "wbr", "basefont", "bgsound",
        "command", "frame", "image", "isindex", "nextid", "spacer"}
SPECIAL = {"script", "style", "template"}
KEEP_WS = {"pre", "textarea"}
ASCII_WS = " \n\t\x0c\r"
#: Elements whose text, white space or end the event parser or the rules below treat in a way of their own.
NOT_PLAIN = SPECIAL | KEEP_WS | {"title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}

# Plain markup: tags of the simplest form, which read the same alone as inside a page.
_TAGS = re.compile(r"(<[^<>]*>)")
_END = re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)>\Z")
_START = re.compile(r"""<([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n]+[a-zA-Z][a-zA-Z0-9_-]*=(?:"[^"]*"|'[^']*'))*)[ \t\n]*>\Z""")
_ATTR = re.compile(r"""([a-zA-Z][a-zA-Z0-9_-]*)=(?:"([^"]*)"|'([^']*)')""")
_KNOWN: dict[str, tuple[bool, str, dict[str, str], bool] | None] = {}


def _read_tag(raw: str) -> tuple[bool, str, dict[str, str], bool] | None:
    """(is a start tag, name, attributes, stays open) of a plain tag; None of any other."""
    if m := _END.match(raw):
        found = (False, m[1].lower(), {}, False)
    elif m := _START.match(raw):
        tag = m[1].lower()
        attrs = {name.lower(): unescape(a or b) for name, a, b in _ATTR.findall(m[2])}
        found = (True, tag, attrs, tag not in VOID)
    else:
        return None
    return None if found[1] in NOT_PLAIN else found


def plain_tokens(html: str) -> list | None:
    """Text, tag, text, ... of a page of plain markup, tags as :func:`_read_tag` has them; None of any
    other page, which the event parser reads."""
    pieces = _TAGS.split(html)
    if "<" in "".join(pieces[::2]):
        return None
    known = _KNOWN
    for i in range(1, len(pieces), 2):
        raw = pieces[i]
        tag = known.get(raw)
        if tag is None:
            tag = _read_tag(raw)
            if tag is None:
                return None
            if len(known) >= 10_000:  # pages may hold any number of different tags
                known.clear()
            known[raw] = tag
        pieces[i] = tag
    return pieces


class TreeParser(HTMLParser):
    """Calls ``element(nid, tag, attrs, stays_open)`` and ``text(parent, data, cdata_id)`` in document
    order; ``cut(depth)`` when open elements from ``depth`` on have closed. ``seq`` numbers both."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[int, str]] = []  # open elements: (id, tag)
        self.next_id = 0
        self.seq = 1
        self.pending: list[str] = []  # pieces of the text run being read

    def element(self, nid: int, tag: str, attrs: dict[str, str], stays_open: bool) -> None:
        raise NotImplementedError

    def text(self, parent: int | None, data: str, cdata_id: int | None) -> None:
        raise NotImplementedError

    def cut(self, depth: int) -> None:
        raise NotImplementedError

    def read(self, html: str) -> None:
        tokens = plain_tokens(html)
        if tokens is not None:
            self._read_plain(tokens)
            return
        self.feed(html)
        self.close()
        self.end_text()

    def _read_plain(self, tokens: list) -> None:
        """The same calls as the event parser's for a page of plain markup."""
        stack = self.stack
        is_text = True
        for token in tokens:
            if is_text:
                is_text = False
                if token:
                    data = unescape(token) if "&" in token else token
                    if data:
                        if not data.strip(ASCII_WS):
                            data = "\n" if "\n" in data else " "
                        self.text(stack[-1][0] if stack else None, data, None)
                        self.seq += 1
                continue
            is_text = True
            start, tag, attrs, stays_open = token
            if start:
                nid = self.next_id
                self.next_id = nid + 1
                self.element(nid, tag, attrs, stays_open)
                self.seq += 1
                if stays_open:
                    stack.append((nid, tag))
            elif stack and stack[-1][1] == tag:
                stack.pop()
                self.cut(len(stack))
            else:
                self.handle_endtag(tag)

    def _element(self, tag: str, attrs: list, stays_open: bool) -> None:
        nid = self.next_id
        self.next_id += 1
        self.element(nid, tag, {k: "" if v is None else v for k, v in attrs}, stays_open)
        self.seq += 1
        if stays_open:
            self.stack.append((nid, tag))

    def handle_starttag(self, tag, attrs):
        self.end_text()
        self._element(tag, attrs, tag not in VOID)

    def handle_startendtag(self, tag, attrs):
        self.end_text()
        self._element(tag, attrs, False)

    def handle_comment(self, data):
        self.end_text()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_endtag(self, tag):
        self.end_text()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][1] == tag:
                del self.stack[i:]
                self.cut(i)
                return

    def handle_data(self, data):
        self.pending.append(data)

    def end_text(self) -> None:
        data = "".join(self.pending)
        self.pending.clear()
        if not data:
            return
        if data.strip(ASCII_WS) == "" and not any(t in KEEP_WS for _, t in self.stack):
            data = "\n" if "\n" in data else " "
        cdata_id = next((nid for nid, t in reversed(self.stack) if t in SPECIAL), None)
        self.text(self.stack[-1][0] if self.stack else None, data, cdata_id)
        self.seq += 1
