"""What a tokenizer made of a piece of text, remembered while the piece keeps coming.

Both tokenizers cut a text where no merge can cross, so a text's ids are the ids of its pieces one
after the other, and a piece is given to the library once as long as it is remembered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

MOST_REMEMBERED = 400_000


class Memory:
    """The value of each piece, made when it is first asked for.

    Two generations of at most ``most`` pieces bound the memory: when the younger is full it becomes
    the older, and what is asked for again moves back.
    """

    def __init__(self, make: Callable[[list], list], most: int = MOST_REMEMBERED) -> None:
        self.make, self.most = make, most
        self.young: dict = {}
        self.older: dict = {}

    def values_of(self, pieces: list) -> Iterator:
        """The values of the pieces of one text; the missing ones are made together."""
        if len(self.young) >= self.most:
            self.older, self.young = self.young, {}
        missing = set(pieces).difference(self.young)
        if missing:
            back = [p for p in missing if p in self.older]
            self.young.update(zip(back, map(self.older.__getitem__, back), strict=True))
            new = list(missing.difference(back))
            self.young.update(zip(new, self.make(new), strict=True))
        return map(self.young.__getitem__, pieces)


class Joined(dict):
    """The bytes of each piece, as :class:`Memory`, by one plain look-up of all pieces of a text;
    ``make`` gives the bytes of one piece."""

    def __init__(self, make: Callable[[str], bytes], most: int = MOST_REMEMBERED) -> None:
        super().__init__()
        self.make, self.most = make, most
        self.older: dict = {}

    def __missing__(self, piece):
        value = self.older.get(piece)
        if value is None:
            value = self.make(piece)
        self[piece] = value
        return value

    def bytes_of(self, pieces: list) -> bytes:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, pieces))
