"""Tokens of the dialect, found by one regular expression with named alternatives."""

from __future__ import annotations

import re
from typing import NamedTuple

from ..errors import QuerySyntaxError

_TOKEN = re.compile(
    r"""(?P<space>\s+)
    |'(?P<string>(?:[^']|'')*)'
    |\[(?P<bracketed>[^\]]*)\]
    |"(?P<quoted>(?:[^"]|"")*)"
    |(?P<number>-?(?:\d+\.\d*|\.\d+|\d+)(?:[eE][+-]?\d+)?)
    |(?P<name>[^\W\d][\w\#@]*|[\#@_][\w\#@]*)
    |(?P<mark><=|>=|<>|[=<>(),*?;])""",
    re.VERBOSE,
)


class Token(NamedTuple):
    kind: str
    text: str
    at: int

    def is_word(self, word: str) -> bool:
        """Quoted names are never keywords."""
        return self.kind == "name" and self.text.upper() == word


END = "end"


def tokenize(sql: str) -> list[Token]:
    tokens, at = [], 0
    while at < len(sql):
        m = _TOKEN.match(sql, at)
        if m is None:
            raise QuerySyntaxError(f"unexpected character {sql[at]!r} at position {at}")
        kind = m.lastgroup
        text = m.group(kind)
        if kind == "string":
            text = text.replace("''", "'")
        elif kind == "quoted":
            text = text.replace('""', '"')
        if kind != "space":
            tokens.append(Token(kind, text, at))
        at = m.end()
    tokens.append(Token(END, "", at))
    return tokens
