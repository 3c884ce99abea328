"""Words of whole texts, in pieces of bounded size."""

import re
from collections.abc import Iterator

BLOCK = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(data: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text, in lists from about ``size`` bytes each.
    A text of any length is split without a list of all its words. (``bytes.split`` cuts
    at exactly these six characters.)"""
    if len(data) <= size:
        yield data.split()
        return
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + size)
        end = gap.start() if gap else len(data)
        yield data[at:end].split()
        at = end


def shingles(data: bytes, n: int) -> Iterator[list[bytes]]:
    """The n-word shingles of a text joined by one space, repeats included, in lists. A text of
    fewer words has its whole sequence as the only one; a text without words has none."""
    last: list[bytes] = []
    some = False
    for words in word_blocks(data):
        words = last + words
        found = list(map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False)))
        if found:
            some = True
            yield found
        last = words[-(n - 1):] if n > 1 else []
    if last and not some:
        yield [b" ".join(last)]
