"""Deep-shallow suffix sorting of byte strings.

Strings are first ordered by multikey quicksort over characters of 7 bytes down to
a shallow depth; a character ends in the number of bytes the string still has in
it, so a string that ends sorts before all that go on. Groups that still agree there, which is where long common
prefixes sit, are ordered by a blind trie: an insertion walks the trie looking
only at branching bytes, compares once with the leaf it reaches, and branches
where that comparison ends.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 14  # bytes; a multiple of 7
SMALL = 24  # groups of so many strings go to the blind trie at once


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class BlindTrie:
    """Patricia trie of byte strings; equal strings share a leaf."""

    __slots__ = ("root", "texts")

    def __init__(self, texts):
        self.texts = texts
        self.root = None

    # A leaf is a list of string numbers; an inner node is (depth, {byte: child}),
    # byte -1 standing for the end of a string.
    def _byte(self, text: bytes, depth: int) -> int:
        return text[depth] if depth < len(text) else -1

    def insert(self, number: int) -> None:
        text = self.texts[number]
        if self.root is None:
            self.root = [number]
            return
        node = self.root
        while isinstance(node, tuple):  # blind: only branching bytes are looked at
            depth, children = node
            node = children.get(self._byte(text, depth)) or next(iter(children.values()))
        other = self.texts[node[0]]
        common = common_prefix(text, other)
        if common == len(text) == len(other):
            node.append(number)
            return
        parent, came, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < common:
            parent, came = node, self._byte(text, node[0])
            node = node[1][came]
        if isinstance(node, tuple) and node[0] == common:
            node[1][self._byte(text, common)] = [number]
            return
        fork = (common, {self._byte(other, common): node, self._byte(text, common): [number]})
        if parent is None:
            self.root = fork
        else:
            parent[1][came] = fork

    def ordered(self) -> list[int]:
        out: list[int] = []
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                out.extend(node)
        return out


def deep_shallow_order(texts: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """Numbers of ``texts`` in ascending order (a prefix before what extends it)."""
    n = len(texts)
    chars = shallow // 7
    head = np.zeros((n, chars, 8), "u1")
    head[:, :, :7] = np.frombuffer(b"".join(t[:shallow].ljust(shallow, b"\0") for t in texts), "u1").reshape(n, chars, 7)
    lengths = np.fromiter(map(len, texts), "i8", n)
    head[:, :, 7] = np.clip(lengths[:, None] - 7 * np.arange(chars), 0, 7)
    head = head.view(">u8").reshape(n, chars).astype("u8")
    out: list[int] = []
    todo = [(np.arange(n), 0)]
    while todo:  # multikey quicksort: less, equal (one character deeper), greater
        group, depth = todo.pop()
        if len(group) <= SMALL or depth == chars:
            out.extend(_trie_order(texts, group.tolist()))
            continue
        key = head[group, depth]
        pivot = key[len(key) // 2]
        parts = [(group[key > pivot], depth), (group[key == pivot], depth + 1), (group[key < pivot], depth)]
        todo.extend(p for p in parts if len(p[0]))
    return out


def _trie_order(texts: list[bytes], group: list[int]) -> list[int]:
    if len(group) < 2:
        return group
    trie = BlindTrie(texts)
    for i in group:
        trie.insert(i)
    return trie.ordered()


def neighbour_prefixes(texts: list[bytes], order: list[int]) -> np.ndarray:
    """Common prefix of each string with the one before it in ``order``."""
    out = np.zeros(len(order), "int64")
    for k in range(1, len(order)):
        out[k] = common_prefix(texts[order[k - 1]], texts[order[k]])
    return out
