"""Words of ASCII letters, digits and all characters beyond ASCII, from texts of any length."""

from __future__ import annotations

from collections.abc import Iterator

# A byte of UTF-8 as words see it: A-Z in lower case, a-z, 0-9 and bytes beyond ASCII as they are, all else a space.
# Every byte keeps its place, so places in what comes out are places in the text.
_SEEN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SLICE = 1 << 20


def normalized(text: bytes) -> bytes:
    """The text with its words in lower case and a space for every byte between them."""
    return text.translate(_SEEN)


def slices(text: bytes, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """(first, end) of stretches of a normalized text, about ``size`` bytes each, that cut no word."""
    first = 0
    while first < len(text):
        end = first + size
        if end >= len(text):
            end = len(text)
        else:
            space = text.rfind(b" ", first, end)
            if space < 0:
                space = text.find(b" ", end)  # a word longer than a slice
            end = len(text) if space < 0 else space + 1
        yield first, end
        first = end
