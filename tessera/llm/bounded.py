"""A table of results that stays bounded and keeps what is used."""

from __future__ import annotations


class BoundedCache:
    """Two generations of at most ``size`` entries: a full young generation
    becomes the old one, and an entry found in the old one moves over."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def __contains__(self, key) -> bool:
        return key in self.young or key in self.old

    def get(self, key):
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def get_many(self, keys) -> tuple[dict, list]:
        """The entries that are there, and the keys of the others."""
        young, old, found, moved, missing = self.young, self.old, {}, {}, []
        for k in keys:
            value = young.get(k)
            if value is None:
                value = old.get(k)
                if value is None:
                    missing.append(k)
                    continue
                moved[k] = value
            found[k] = value
        self.put_many(moved)
        return found, missing

    def put_many(self, entries: dict) -> None:
        """Adds entries that are few beside ``size``."""
        if len(self.young) + len(entries) > self.size:
            self.old, self.young = self.young, {}
        self.young.update(entries)

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value
