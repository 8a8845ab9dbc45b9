"""Words of a text as bytes, for operators that run in Python tasks.

The same words as ``common.alnum_words``: runs of ASCII letters and digits and of all characters
beyond ASCII, A-Z in lower case.
"""

from __future__ import annotations

from collections.abc import Iterator

#: Bytes of a text that are split at once; a text of any length takes little more memory than itself.
PIECE_BYTES = 1 << 20

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def word_pieces(text: str | None, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of about ``size`` bytes; none for NULL."""
    data = (text or "").encode().translate(_WORD_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end
