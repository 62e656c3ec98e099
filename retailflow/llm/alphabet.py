"""Splitting texts into pre-tokens as the ``tokenizers`` library does.

The fast split covers texts whose characters all lie below ``LIMIT`` (Latin
letters, digits, ASCII and Latin-1 punctuation); there this Python's
character classes are known to equal the library's (a test compares every
code point). Any other text, and any text that holds one of the special
strings, is encoded as a whole by the library itself.
"""

from __future__ import annotations

import re
import unicodedata

LIMIT = 0x180


def _class(keep) -> str:
    return "".join(re.escape(chr(c)) for c in range(LIMIT) if keep(chr(c)))


_SPACE = _class(lambda c: c in "\t\n\x0b\x0c\r \x85\xa0")
_LETTER = _class(lambda c: unicodedata.category(c).startswith("L"))
_NUMBER = _class(lambda c: unicodedata.category(c).startswith("N"))
# The contractions that both vocabularies split off.
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"

#: Byte-level vocabulary: a space stays with the word after it.
BYTE_LEVEL = re.compile(
    f"{_CONTRACTIONS}| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
#: Word vocabulary: white space is dropped, digits stand alone.
WORD_LEVEL = re.compile(f"{_CONTRACTIONS}|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")

#: A contraction with a letter after it: split here, though it may be the middle of a word.
CONTRACTED_LETTER = f"(?:{_CONTRACTIONS})[{_LETTER}]"

#: Outside the fast split; U+0130 is there because lower-casing it gives two characters.
_OUTSIDE = re.compile(f"[^\x00-{chr(LIMIT - 1)}]|İ")


def plain(text: str, special: tuple[str, ...]) -> bool:
    """True if the fast split gives what the library gives."""
    return (text.isascii() or not _OUTSIDE.search(text)) and not any(s in text for s in special)
