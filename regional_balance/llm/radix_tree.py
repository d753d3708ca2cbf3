"""An adaptive radix tree over byte keys, in which a key may be the beginning of another.

Inner nodes change layout as they grow: up to 4 and up to 16 children are kept as a sorted byte string with a list beside
it, up to 48 as a 256-byte index into a list, and more as a list of 256. Bytes that all keys below a node share are kept
in the node (path compression), so that a node is only where keys part or end.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import Any

SMALL, INDEXED = 16, 48


class Sorted:
    """Up to 4 or 16 children: their bytes in order, and the children beside them."""

    __slots__ = ("children", "keys", "room")

    def __init__(self, room: int = 4):
        self.room, self.keys, self.children = room, bytearray(), []

    def get(self, byte: int) -> Node | None:
        at = self.keys.find(byte)
        return None if at < 0 else self.children[at]

    def put(self, byte: int, child: Node) -> bool:
        """Set a child; False if there is no room."""
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.children[at] = child
            return True
        if len(self.keys) == self.room:
            return False
        self.keys.insert(at, byte)
        self.children.insert(at, child)
        return True

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.keys, self.children, strict=True)

    def grown(self) -> Sorted | Indexed:
        if self.room < SMALL:
            larger = Sorted(SMALL)
            larger.keys, larger.children = self.keys, self.children
            return larger
        larger = Indexed()
        for byte, child in self.items():
            larger.put(byte, child)
        return larger


class Indexed:
    """Up to 48 children in order of arrival, and the place of each byte's child among them (one more, 0 for none)."""

    __slots__ = ("children", "index")

    def __init__(self):
        self.index, self.children = bytearray(256), []

    def get(self, byte: int) -> Node | None:
        at = self.index[byte]
        return self.children[at - 1] if at else None

    def put(self, byte: int, child: Node) -> bool:
        at = self.index[byte]
        if at:
            self.children[at - 1] = child
            return True
        if len(self.children) == INDEXED:
            return False
        self.children.append(child)
        self.index[byte] = len(self.children)
        return True

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, self.children[at - 1]) for byte, at in enumerate(self.index) if at)

    def grown(self) -> Full:
        larger = Full()
        for byte, child in self.items():
            larger.put(byte, child)
        return larger


class Full:
    """A place for the child of every byte."""

    __slots__ = ("children",)

    def __init__(self):
        self.children: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.children[byte]

    def put(self, byte: int, child: Node) -> bool:
        self.children[byte] = child
        return True

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, child) for byte, child in enumerate(self.children) if child is not None)


class Node:
    """``path`` leads from the byte that the parent branches on (left out) to this node; ``value`` belongs to the key that
    ends here, None if none does; ``layout`` holds the children, None if there are none."""

    __slots__ = ("layout", "path", "value")

    def __init__(self, path: bytes, value: Any = None, layout: Sorted | Indexed | Full | None = None):
        self.path, self.value, self.layout = path, value, layout

    def put(self, byte: int, child: Node) -> None:
        if self.layout is None:
            self.layout = Sorted()
        while not self.layout.put(byte, child):
            self.layout = self.layout.grown()


def shared(a: bytes, b: bytes) -> int:
    """Length of the common beginning: halves are compared whole, not byte by byte."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class RadixTree:
    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, value: Any) -> None:
        """Add a key with a value that is not None; a key already there gets the new value."""
        if self.root is None:
            self.root = Node(key, value)
            return
        node, at, parent, branch = self.root, 0, None, 0
        while True:
            path = node.path
            same = len(path) if key.startswith(path, at) else shared(path, key[at : at + len(path)])
            if same < len(path):
                fork = Node(path[:same])
                node.path = path[same + 1 :]
                fork.put(path[same], node)
                if parent is None:
                    self.root = fork
                else:
                    parent.put(branch, fork)
                node = fork
            at += same
            if at == len(key):
                node.value = value
                return
            child = node.layout.get(key[at]) if node.layout else None
            if child is None:
                node.put(key[at], Node(key[at + 1 :], value))
                return
            parent, branch, node, at = node, key[at], child, at + 1

    def get(self, key: bytes) -> Any:
        """The value of a key, None if it is not there."""
        node, at = self.root, 0
        while node is not None and key.startswith(node.path, at):
            at += len(node.path)
            if at == len(key):
                return node.value
            node, at = node.layout.get(key[at]) if node.layout else None, at + 1
        return None

    def bottom_up(self) -> Iterator[tuple[Node, int, int]]:
        """(node, byte depth above its path, byte depth at its end), children before parents and in byte order."""
        if self.root is None:
            return
        stack = [(self.root, 0, len(self.root.path), self.root.layout.items() if self.root.layout else iter(()))]
        while stack:
            node, top, end, rest = stack[-1]
            step = next(rest, None)
            if step is None:
                stack.pop()
                yield node, top, end
            else:
                child = step[1]
                stack.append((child, end, end + 1 + len(child.path), child.layout.items() if child.layout else iter(())))
