"""Results of a Python worker by key, bounded by bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

#: What an entry weighs beside three bytes a character, for the key and what was made of it: two objects and their place.
ENTRY = 140


class Memory:
    """Two generations of results. What is asked for moves to the young one; when that is full it becomes the old one, and what
    was in the old one and not asked for since is forgotten. So what comes once goes, and what comes often stays."""

    def __init__(self, room: int):
        self.room, self.weight = room, 0
        self.young: dict = {}
        self.old: dict = {}

    def learn(self, keys: Iterable[str], ask: Callable[[list], Iterable]) -> dict:
        """A table with all of `keys`, the unknown ones asked for at once. It holds until the next call, and then is bounded."""
        if self.weight > self.room // 2:
            self.old, self.young, self.weight = self.young, {}, 0
        young, old = self.young, self.old
        new = set(keys).difference(young)
        if new:
            again = [k for k in new if k in old]
            new.difference_update(again)
            found = dict(zip(again, map(old.pop, again), strict=True))
            if new:
                unknown = list(new)
                found.update(zip(unknown, ask(unknown), strict=True))
            young.update(found)
            self.weight += 3 * sum(map(len, found)) + ENTRY * len(found)
        return young


def slices(sizes: list[int], together: int) -> Iterator[slice]:
    """Runs of rows whose sizes add up to `together` at most, or one larger row."""
    begin = held = 0
    for i, size in enumerate(sizes):
        if i > begin and held + size > together:
            yield slice(begin, i)
            begin, held = i, 0
        held += size
    if sizes:
        yield slice(begin, len(sizes))
