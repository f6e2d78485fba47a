"""A small parsing-expression-grammar engine: ordered choice, greedy repetition, recursion by name, semantic checks; no backtracking out of a match."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import Any

Node = tuple[str, Any, int, int]
Parser = Callable[[str, int], "tuple[int, list[Node]] | None"]


def tok(name: str, pattern: str) -> Parser:
    """A terminal; its node is (name, match, start, end). An empty name leaves no node."""
    match = re.compile(pattern, re.I).match

    def parse(text: str, at: int):
        m = match(text, at)
        if m is None:
            return None
        return m.end(), [(name, m, at, m.end())] if name else []

    return parse


def seq(*parts: Parser) -> Parser:
    def parse(text: str, at: int):
        nodes: list[Node] = []
        for p in parts:
            got = p(text, at)
            if got is None:
                return None
            at = got[0]
            nodes += got[1]
        return at, nodes

    return parse


def choice(*options: Parser) -> Parser:
    def parse(text: str, at: int):
        for p in options:
            got = p(text, at)
            if got is not None:
                return got
        return None

    return parse


def star(part: Parser) -> Parser:
    def parse(text: str, at: int):
        nodes: list[Node] = []
        while True:
            got = part(text, at)
            if got is None or got[0] == at:
                return at, nodes
            at = got[0]
            nodes += got[1]

    return parse


def opt(part: Parser) -> Parser:
    def parse(text: str, at: int):
        return part(text, at) or (at, [])

    return parse


def node(name: str, part: Parser) -> Parser:
    """Wrap what a rule matched in one named node."""

    def parse(text: str, at: int):
        got = part(text, at)
        if got is None:
            return None
        return got[0], [(name, got[1], at, got[0])]

    return parse


def lazy(rule: Callable[[], Parser], deepest: int = 64) -> Parser:
    """A rule looked up when it is used, so that rules can call themselves; nesting beyond ``deepest`` does not match."""
    depth = 0

    def parse(text: str, at: int):
        nonlocal depth
        if depth >= deepest:
            return None
        depth += 1
        try:
            return rule()(text, at)
        finally:
            depth -= 1

    return parse


def check(part: Parser, test: Callable[[str, int, int], bool]) -> Parser:
    """What the rule matches, if the test of (text, start, end) holds."""

    def parse(text: str, at: int):
        got = part(text, at)
        return got if got is not None and test(text, at, got[0]) else None

    return parse
