"""Per-task caches of encoded pre-tokens: a pre-token is encoded once and then looked up.

A cache holds at most ``limit`` entries; beyond that it starts anew, which costs time and changes no result."""

from __future__ import annotations

from collections.abc import Callable


class Encoded(dict):
    """pre-token -> bytes of its ids (little-endian unsigned 32-bit)."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int, always: dict[str, bytes] | None = None):
        super().__init__()
        self.encode, self.limit, self.always = encode, limit, always or {}
        self.update(self.always)

    def ensure(self, tokens) -> None:
        """Encode those of the tokens that are not here yet, together."""
        tokens = dict.fromkeys(tokens)
        new = [t for t in tokens if t not in self]
        if len(self) + len(new) > self.limit + len(self.always):
            self.clear()
            self.update(self.always)
            new = [t for t in tokens if t not in self]
        self.update(zip(new, self.encode(new), strict=True))

    def ids(self, tokens: list[str]) -> bytes:
        """The ids of a sequence of pre-tokens, joined."""
        try:
            return b"".join(map(self.__getitem__, tokens))
        except KeyError:
            self.ensure(tokens)
            return b"".join(map(self.__getitem__, tokens))


class Recent:
    """What was met lately: two halves of at most ``limit`` / 2 entries; when the new half is full it becomes the old one, and entries
    of that which are met again move over."""

    def __init__(self, limit: int):
        self.half, self.new, self.old = limit // 2, {}, {}

    def get_all(self, keys: list) -> list:
        """The values, or None."""
        got, old = list(map(self.new.get, keys)), self.old
        for k, v in enumerate(got):
            if v is None and (v := old.get(keys[k])) is not None:
                got[k] = v
                self.put(keys[k], v)
        return got

    def put(self, key, value) -> None:
        if len(self.new) >= self.half:
            self.old, self.new = self.new, {}
        self.new[key] = value

    def clear(self) -> None:
        self.new, self.old = {}, {}


_held: list = []


def hold(kind: str, *caches: dict) -> None:
    """Called where a task starts: a Python worker lives on from one operator's tasks to those of the next, and the caches
    that the last operator left behind make room."""
    if _held and _held[0] != kind:
        for c in _held[1]:
            c.clear()
        try:
            import ctypes

            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except OSError:
            pass
    _held[:] = [kind, caches]
