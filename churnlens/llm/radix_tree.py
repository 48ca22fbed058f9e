"""An adaptive radix tree over byte strings, for the conversation prefix trie.

A node keeps its bytes up to the next branch (path compression) and its children in the
smallest of four layouts: two sorted by arrival with up to 4 and 16 keys, one with a
256-byte index into up to 48 slots, one with 256 slots. A layout that is full is replaced
by the next.
"""

from __future__ import annotations

from collections.abc import Iterator


class Listed:
    """Up to ``room`` children (4, then 16): the keys in one byte string."""

    __slots__ = ("keys", "kids", "room")

    def __init__(self, room: int = 4, keys: bytes = b"", kids: list | None = None):
        self.room, self.keys, self.kids = room, bytearray(keys), kids or []

    def find(self, key: int):
        at = self.keys.find(key)
        return self.kids[at] if at >= 0 else None

    def add(self, key: int, kid):
        """This layout with one more child, or the next one."""
        if len(self.kids) < self.room:
            self.keys.append(key)
            self.kids.append(kid)
            return self
        grown = Listed(16, self.keys, self.kids) if self.room == 4 else Indexed(self.keys, self.kids)
        return grown.add(key, kid)

    def items(self) -> Iterator[tuple[int, object]]:
        return zip(self.keys, self.kids)


class Indexed:
    """Up to 48 children: a byte for each key tells the slot (0: none)."""

    __slots__ = ("index", "kids")

    def __init__(self, keys: bytes, kids: list):
        self.index, self.kids = bytearray(256), kids
        for slot, key in enumerate(keys):
            self.index[key] = slot + 1

    def find(self, key: int):
        slot = self.index[key]
        return self.kids[slot - 1] if slot else None

    def add(self, key: int, kid):
        if len(self.kids) < 48:
            self.kids.append(kid)
            self.index[key] = len(self.kids)
            return self
        return Full(self.items()).add(key, kid)

    def items(self) -> Iterator[tuple[int, object]]:
        return ((key, self.kids[slot - 1]) for key, slot in enumerate(self.index) if slot)


class Full:
    """A slot for each of 256 keys."""

    __slots__ = ("kids",)

    def __init__(self, items):
        self.kids = [None] * 256
        for key, kid in items:
            self.kids[key] = kid

    def find(self, key: int):
        return self.kids[key]

    def add(self, key: int, kid):
        self.kids[key] = kid
        return self

    def items(self) -> Iterator[tuple[int, object]]:
        return ((key, kid) for key, kid in enumerate(self.kids) if kid is not None)


class Node:
    __slots__ = ("held", "layout", "path")

    def __init__(self, path: bytes):
        self.path = path  # the bytes after the key that leads here
        self.layout = Listed()
        self.held: list = []  # what was put in by keys that end here

    def split(self, at: int) -> None:
        """End this node's path at ``at``; what was below moves into a child."""
        lower = Node(self.path[at + 1 :])
        lower.layout, lower.held = self.layout, self.held
        self.layout, self.held = Listed().add(self.path[at], lower), []
        self.path = self.path[:at]


def common(a: bytes, b: bytes) -> int:
    """The length of the longest common prefix, by halving."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class RadixTree:
    def __init__(self):
        self.root = Node(b"")

    def put(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while True:
            part = key[at : at + len(node.path)]
            if part != node.path:
                node.split(common(part, node.path))
            at += len(node.path)
            if at == len(key):
                break
            kid = node.layout.find(key[at])
            if kid is None:
                kid = Node(key[at + 1 :])
                node.layout = node.layout.add(key[at], kid)
                node = kid
                break
            node, at = kid, at + 1
        node.held.append(value)

    def walk(self) -> list[tuple[Node, int, bytes]]:
        """Every node after its parent: (node, the parent's place in this list or -1, the
        bytes from the parent's end to the node's)."""
        out = []
        stack = [(self.root, -1, self.root.path)]
        while stack:
            node, above, part = stack.pop()
            out.append((node, above, part))
            here = len(out) - 1
            stack += [(kid, here, bytes([key]) + kid.path) for key, kid in node.layout.items()]
        return out
