"""Token ids as bytes, and batches in parts."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable

ID_BYTES = 4
ID_TYPE = "I"  # unsigned, four bytes


def id_bytes(ids: list[int]) -> bytes:
    return array(ID_TYPE, ids).tobytes()


class MatchIds:
    """Ids of whole texts, four bytes an id, from the ids of their matches. Most matches recur: at most ``most`` are
    kept, and beyond that those of the texts at hand."""

    def __init__(self, find: Callable[[str], list[str]], encode: Callable[[bytes], list[int]], most: int = 500_000) -> None:
        self.find, self.encode, self.most = find, encode, most
        self.known: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        split = [self.find(text) for text in texts]
        used = set().union(*split)
        new = used.difference(self.known)
        if len(self.known) + len(new) > self.most:
            self.known = {match: self.known[match] for match in used if match in self.known}
        for match in new:
            self.known[match] = id_bytes(self.encode(match.encode()))
        known = self.known.__getitem__
        return [b"".join(map(known, matches)) for matches in split]


def slices(n: int, step: int) -> Iterable[tuple[int, int]]:
    return ((at, min(step, n - at)) for at in range(0, n, step))
