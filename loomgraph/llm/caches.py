"""A bounded cache of a function, as a dictionary."""

from __future__ import annotations


class Cache(dict):
    """``cache[key]`` is ``make(key)``. At most ``most`` results are held: when
    the younger half is full it becomes the older half, and what the older
    half held is forgotten unless it was asked for again."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.half, self.older = make, max(1, most // 2), {}

    def __missing__(self, key):
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        got = self.older.get(key, self)
        if got is self:
            got = self.make(key)
        self[key] = got
        return got
