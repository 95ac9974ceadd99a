"""An adaptive radix tree over byte strings, with resizable nodes and path compression."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

#: Children a layout holds: sorted bytes (4, 16), an index of bytes (48), one place per byte.
LAYOUTS = (4, 16, 48, 256)


class Node:
    """Bytes that all keys below share, children by their next byte, and the entry of
    the key that ends here (``None`` without one)."""

    __slots__ = ("prefix", "entry", "layout", "at", "kids")

    def __init__(self, prefix: bytes, entry: int | None = None) -> None:
        self.prefix = prefix
        self.entry = entry
        self.layout = 0
        self.at = bytearray()
        self.kids: list[Node | None] = []

    def child(self, byte: int) -> Node | None:
        if self.layout < 2:
            place = self.at.find(byte)
            return self.kids[place] if place >= 0 else None
        if self.layout == 2:
            place = self.at[byte]
            return self.kids[place - 1] if place else None
        return self.kids[byte]

    def put(self, byte: int, node: Node) -> None:
        """Set or replace the child of a byte; a full layout grows into the next one."""
        if self.layout < 2:
            place = self.at.find(byte)
            if place >= 0:
                self.kids[place] = node
                return
            if len(self.kids) < LAYOUTS[self.layout]:
                place = bisect_left(self.at, byte)
                self.at.insert(place, byte)
                self.kids.insert(place, node)
                return
        elif self.layout == 2:
            if self.at[byte]:
                self.kids[self.at[byte] - 1] = node
                return
            if len(self.kids) < LAYOUTS[2]:
                self.kids.append(node)
                self.at[byte] = len(self.kids)
                return
        else:
            self.kids[byte] = node
            return
        self._grow()
        self.put(byte, node)

    def _grow(self) -> None:
        held = list(self.items())
        self.layout += 1
        if self.layout == 2:
            self.at, self.kids = bytearray(256), [n for _, n in held]
            for place, (byte, _) in enumerate(held, 1):
                self.at[byte] = place
        elif self.layout == 3:
            self.at, self.kids = bytearray(), [None] * 256
            for byte, node in held:
                self.kids[byte] = node

    def items(self) -> Iterator[tuple[int, Node]]:
        """Children in the order of their bytes."""
        if self.layout < 2:
            yield from zip(self.at, self.kids, strict=True)
        elif self.layout == 2:
            yield from ((b, self.kids[p - 1]) for b, p in enumerate(self.at) if p)
        else:
            yield from ((b, n) for b, n in enumerate(self.kids) if n is not None)


def _common(left: bytes, right: bytes) -> int:
    """How many leading bytes two strings of one length share."""
    differing = int.from_bytes(left, "big") ^ int.from_bytes(right, "big")
    return len(left) - (differing.bit_length() + 7) // 8


def insert(root: Node | None, key: bytes, entry: int) -> Node:
    """The root after a key that the tree does not hold yet."""
    if root is None:
        return Node(key, entry)
    above: Node | None = None
    node, depth = root, 0
    while True:
        prefix = node.prefix
        size = min(len(prefix), len(key) - depth)
        shared = size
        if not key.startswith(prefix, depth):
            shared = _common(prefix[:size], key[depth : depth + size])
        if shared < len(prefix):
            split = Node(prefix[:shared])
            node.prefix = prefix[shared + 1 :]
            split.put(prefix[shared], node)
            if above is None:
                root = split
            else:
                above.put(key[depth - 1], split)
            node = split
        depth += shared
        if depth == len(key):
            node.entry = entry
            return root
        found = node.child(key[depth])
        if found is None:
            node.put(key[depth], Node(key[depth + 1 :], entry))
            return root
        above, node, depth = node, found, depth + 1
