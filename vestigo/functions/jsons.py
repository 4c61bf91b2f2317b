"""Strict JSON reading for worker functions.

``read_json`` accepts exactly the texts that are one JSON value as a whole:
NaN and Infinity, trailing text and cut-off texts are refused. Of a repeated
key the last value counts. Nesting may be of any depth.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable
from json.decoder import scanstring

REFUSED = ...
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?")
_BLANK = re.compile(r"[ \t\n\r]*")
_LITERALS = {"t": ("true", True), "f": ("false", False), "n": ("null", None)}


def _refuse(name: str) -> None:
    raise ValueError(name)


def _read_deep(text: str) -> object:
    """A reader with its own stack, for nesting beyond the interpreter's."""
    stack: list[tuple[object, object]] = []
    i, blank = 0, _BLANK.match
    top: object = None
    key: object = None

    def number(at: int) -> tuple[object, int]:
        m = _NUMBER.match(text, at)
        if not m:
            raise ValueError("no value")
        return (float(m[0]) if m[1] or m[2] else int(m[0])), m.end()

    while True:
        i = blank(text, i).end()
        c = text[i : i + 1]
        if c in ("{", "["):
            new: object = {} if c == "{" else []
            stack.append((top, key))
            top, key, i = new, None, blank(text, i + 1).end()
            if text[i : i + 1] == ("}" if c == "{" else "]"):
                value, i = top, i + 1
                top, key = stack.pop()
            else:
                if c == "{":
                    if text[i : i + 1] != '"':
                        raise ValueError("no key")
                    key, i = scanstring(text, i + 1, True)
                    i = blank(text, i).end()
                    if text[i : i + 1] != ":":
                        raise ValueError("no colon")
                    i += 1
                continue
        elif c == '"':
            value, i = scanstring(text, i + 1, True)
        elif c in _LITERALS and text.startswith(_LITERALS[c][0], i):
            value, i = _LITERALS[c][1], i + len(_LITERALS[c][0])
        else:
            value, i = number(i)
        while top is not None:
            if isinstance(top, dict):
                top[key] = value
            else:
                top.append(value)
            i = blank(text, i).end()
            c = text[i : i + 1]
            if c == ",":
                i = blank(text, i + 1).end()
                if isinstance(top, dict):
                    if text[i : i + 1] != '"':
                        raise ValueError("no key")
                    key, i = scanstring(text, i + 1, True)
                    i = blank(text, i).end()
                    if text[i : i + 1] != ":":
                        raise ValueError("no colon")
                    i += 1
                break
            if c != ("}" if isinstance(top, dict) else "]"):
                raise ValueError("no end")
            value, i = top, i + 1
            top, key = stack.pop()
        else:
            if blank(text, i).end() != len(text):
                raise ValueError("trailing text")
            return value


def json_reader() -> Callable[[str | None], object]:
    """A function that gives the value of a JSON text, or ``REFUSED``; made in the worker."""
    sys.set_int_max_str_digits(0)
    decode = json.JSONDecoder(parse_constant=_refuse).decode

    def read(text: str | None) -> object:
        if text is None:
            return REFUSED
        try:
            return decode(text)
        except RecursionError:
            try:
                return _read_deep(text)
            except ValueError:
                return REFUSED
        except ValueError:
            return REFUSED

    return read
