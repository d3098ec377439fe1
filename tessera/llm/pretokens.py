"""Splitting text as a tokenizer file of the ``tokenizers`` library splits it.

The library stays the authority.  Up to U+024F the character classes of the
split pattern are read off the library's own pre-tokenizer, character by
character, when a task starts; a compiled standard ``re`` pattern over those
classes then splits the text.  The strings of added tokens are cut out first, as
the library does; what lies between them and has any other character is split
by the library's own pre-tokenizer.  So every text comes as pre-tokens, whose
tokens can be counted or looked up one by one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from tokenizers import Tokenizer

#: Characters below this code point are looked up in the library beforehand.
KNOWN = 0x250


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = [""] * 256
    for b in plain:
        out[b] = chr(b)
    for k, b in enumerate(b for b in range(256) if not out[b]):
        out[b] = chr(0x100 + k)
    return out


def classes(tok: Tokenizer) -> dict[str, str]:
    """Each known character's class: L letter, N number, S white space, O other."""
    to_byte = byte_characters()
    shown = lambda s: "".join(to_byte[b] for b in s.encode())
    split = lambda s: [p for p, _ in tok.pre_tokenizer.pre_tokenize_str(s)]
    out = {}
    for c in map(chr, range(KNOWN)):
        if split(f"a{c}") == [shown(f"a{c}")]:
            out[c] = "L"
        elif split(f"!{c}{c}!") == [shown(f"!{c}{c}!")]:
            out[c] = "O"
        else:
            out[c] = "N" if c.isnumeric() else "S"
    return out


def of_class(found: dict[str, str], kind: str) -> str:
    """The characters of a class, as the inside of a ``re`` character set."""
    return "".join(re.escape(c) for c in found if found[c] == kind)


def added_tokens(spec: str) -> list[str]:
    return [t["content"] for t in json.loads(spec).get("added_tokens", [])]


def needs_library(unsafe: str = "") -> re.Pattern:
    """Finds what only the library may split: unknown characters, those in ``unsafe``."""
    known = "".join(re.escape(chr(c)) for c in range(KNOWN) if chr(c) not in unsafe)
    return re.compile(f"[^{known}]")


def cut_added(spec: str) -> Callable[[str], list[str]]:
    """``cut(text)``: what lies between added tokens (even places) and their
    strings (odd places).  Added tokens that also take spaces around them, or
    whole words only, are refused."""
    added = json.loads(spec).get("added_tokens", [])
    if odd := [t["content"] for t in added if t.get("single_word") or t.get("lstrip") or t.get("rstrip")]:
        raise ValueError(f"added tokens that depend on what is around them: {odd}")
    if not added:
        return lambda text: [text]
    longest_first = sorted(added_tokens(spec), key=len, reverse=True)
    return re.compile(f"({'|'.join(map(re.escape, longest_first))})").split


def library_split(tok: Tokenizer, text: str) -> list[str]:
    """The pre-tokens of a text without added tokens, normalised."""
    if tok.normalizer is not None:
        text = tok.normalizer.normalize_str(text)
    return [text[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(text)]
