"""Remembers the ids of the chunks between blanks, within bounds."""

from __future__ import annotations

from collections.abc import Callable

ENTRIES = 300_000
CHARS = 48


class ChunkMemo:
    """Encodes texts chunk by chunk, for vocabularies that drop white space.

    The ids of a text are those of its chunks between blanks and line feeds, one after the
    other. ``encode`` gets chunks not met lately and returns their ids as little-endian
    32-bit numbers.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]]) -> None:
        self._encode = encode
        self._known: dict[str, bytes] = {"": b""}

    def ids(self, texts: list[str]) -> list[bytes]:
        known = self._known
        if len(known) > ENTRIES:
            known.clear()
            known[""] = b""
        chunks = [t.replace("\n", " ").split(" ") for t in texts]
        missing: set[str] = set()
        for row in chunks:
            missing |= set(row).difference(known)
        new = list(missing)
        known.update(zip(new, self._encode(new)))
        out = [b"".join(map(known.__getitem__, row)) for row in chunks]
        for chunk in new:
            if len(chunk) > CHARS:
                del known[chunk]
        return out
