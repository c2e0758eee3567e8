"""Texts of code as tokens with paired brackets."""

from __future__ import annotations

import functools
import re

from ..functions.languages import UNMATCHABLE

# Comment and string syntax by kind of language.
_COMMENTS = {
    "hash": r"\#[^\n]*",
    "slash": r"//[^\n]*|/\*(?:[^*]|\*(?!/))*\*/",
    "dash": r"--[^\n]*|/\*(?:[^*]|\*(?!/))*\*/",
    "markup": r"<!--(?:[^-]|-(?!->))*-->",
    "data": r"(?!)",
}
_DOUBLE = r'"(?:\\.|[^"\\\n])*"'
_SINGLE = r"'(?:\\.|[^'\\\n])*'"
_STRINGS = {
    "hash": rf'"""(?:[^"]|"(?!""))*"""|\'\'\'(?:[^\']|\'(?!\'\'))*\'\'\'|{_DOUBLE}|{_SINGLE}',
    "slash": rf"{_DOUBLE}|{_SINGLE}|`(?:\\.|[^`\\])*`",
    "dash": rf"{_DOUBLE}|{_SINGLE}",
    "markup": r"""(?<==)"[^"]*"|(?<==)'[^']*'""",
    "data": _DOUBLE,
}
_KIND = {
    **dict.fromkeys(["python", "ruby", "shell", "r", "elixir", "yaml", "toml"], "hash"),
    **dict.fromkeys(["sql", "lua"], "dash"),
    **dict.fromkeys(["html", "xml", "vue", "svelte", "dtd"], "markup"),
    "json": "data",
}
_OPERATORS = r"->|=>|::|:=|\.\.\.|===|!==|[=!<>]=|&&|\|\||<<|>>|[-+*/%&|^]=|\*\*|\S"
CLOSER = {"(": ")", "[": "]", "{": "}"}
LINKS = {".", "::", "->", "?."}


def is_supported(language: str) -> bool:
    """Whether files of a language have a token structure to match."""
    return language not in UNMATCHABLE


@functools.cache
def lexer(language: str) -> re.Pattern[str]:
    kind = _KIND.get(language, "slash")
    strings = _STRINGS[kind]
    if language in ("rust", "pascal"):
        # A quote may open a lifetime, which has no closing one.
        strings = strings.replace(_SINGLE, r"'(?:\\[^\n']+|[^'\\\n])'")
    return re.compile(
        r"\s*(?:(?P<word>[^\W\d]\w*)|(?P<number>\d[\w.]*)"
        rf"|(?P<comment>{_COMMENTS[kind]})|(?P<string>{strings})"
        rf"|(?P<open>[(\[{{])|(?P<close>[)\]}}])|(?P<operator>{_OPERATORS}))"
    )


class Tokens:
    """The tokens of a text, with the partner of every paired bracket."""

    def __init__(self, text: str, language: str) -> None:
        self.text: list[str] = []
        self.start: list[int] = []
        self.kind: list[str] = []
        self.partner: dict[int, int] = {}
        opened: dict[str, list[int]] = {")": [], "]": [], "}": []}
        for found in lexer(language).finditer(text):
            kind = found.lastgroup
            if kind == "comment":
                continue
            token = found[kind]
            if kind == "open":
                opened[CLOSER[token]].append(len(self.text))
            elif kind == "close" and opened[token]:
                # Brackets left open inside a closed pair stay without partner.
                start = opened[token].pop()
                self.partner[start] = len(self.text)
                self.partner[len(self.text)] = start
                for others in opened.values():
                    while others and others[-1] > start:
                        others.pop()
            self.text.append(token)
            self.start.append(found.start(kind))
            self.kind.append(kind)

    def end(self, i: int) -> int:
        return self.start[i] + len(self.text[i])

    def closes(self, i: int) -> bool:
        """Whether no sibling follows at ``i``: the end or a paired closing bracket."""
        return i >= len(self.text) or self.partner.get(i, i) < i

    def after(self, i: int) -> int:
        """Where the sibling after the one at ``i`` starts."""
        return self.partner.get(i, i) + 1

    def is_node(self, i: int) -> bool:
        """Whether a node can start at ``i``."""
        if self.closes(i) or self.kind[i] in ("operator", "close"):
            return False
        return self.kind[i] != "open" or i in self.partner

    def attached(self, at: int) -> int | None:
        """Where a node that may end at ``at`` ends with what is attached to it there."""
        if self.closes(at):
            return None
        if self.text[at] in LINKS and not self.closes(at + 1):
            return at + 2 if self.kind[at + 1] in ("word", "number") else None
        return self.after(at) if self.text[at] in "([" and at in self.partner else None

    def node_ends(self, i: int) -> list[int]:
        """Ends of the nodes that start at ``i``, longest first."""
        if not self.is_node(i):
            return []
        ends, end = [], self.after(i)
        while end is not None:
            ends.append(end)
            end = self.attached(end)
        return ends[::-1]
