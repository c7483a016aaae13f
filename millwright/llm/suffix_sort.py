"""Deep-shallow sorting of bounded suffixes, inside one task.

Suffixes are compared on their first ``width`` bytes.  A multikey quicksort whose
characters are eight bytes wide orders them to a shallow depth, four characters.
What is still equal there shares a long prefix, and comparing that again and again
is what makes plain sorting slow; each such group goes into a blind trie, which
branches on single bytes and compares a string in full only once.
"""

from __future__ import annotations

import bisect

import numpy as np

CHARACTER = 8
SHALLOW = 4 * CHARACTER


def characters(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of ``text`` on, as a number that compares as they do."""
    padded = np.concatenate([text, np.zeros(CHARACTER, np.uint8)])
    found = np.zeros(len(text), np.uint64)
    for i in range(CHARACTER):
        found <<= np.uint64(8)
        found |= padded[i : i + len(text)]
    return found


class BlindTrie:
    """Strings of one length; inner nodes know a depth and branch on the byte there."""

    __slots__ = ("root", "width")

    def __init__(self, width: int):
        self.root: list | None = None
        self.width = width

    def insert(self, string: bytes, item: int) -> None:
        """A leaf is [width, string, items]; a node is [depth, bytes in order, children]."""
        if self.root is None:
            self.root = [self.width, string, [item]]
            return
        node = self.root
        while node[0] < self.width:  # blind: only the branching bytes are looked at
            at = bisect.bisect_left(node[1], string[node[0]])
            found = at < len(node[1]) and node[1][at] == string[node[0]]
            node = node[2][at if found else 0]
        common = _common(string, node[1])
        if common == self.width:
            node[2].append(item)
            return
        above, at, node = None, 0, self.root
        while node[0] < common:
            at = bisect.bisect_left(node[1], string[node[0]])
            if at == len(node[1]) or node[1][at] != string[node[0]]:
                break
            above, node = (node, at), node[2][at]
        leaf, byte = [self.width, string, [item]], string[common]
        if node[0] == common:
            at = bisect.bisect_left(node[1], byte)
            node[1].insert(at, byte)
            node[2].insert(at, leaf)
            return
        other = _any_leaf(node, self.width)[1][common]
        pair = ([byte, other], [leaf, node]) if byte < other else ([other, byte], [node, leaf])
        branch = [common, *pair]
        if above is None:
            self.root = branch
        else:
            above[0][2][above[1]] = branch

    def leaves(self) -> list[list[int]]:
        """The items of each distinct string, in the order of the strings."""
        found, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] == self.width:
                found.append(node[2])
            else:
                stack.extend(reversed(node[2]))
        return found


def _any_leaf(node: list, width: int) -> list:
    while node[0] < width:
        node = node[2][0]
    return node


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two strings of one length."""
    if a == b:
        return len(a)
    low, high = 0, len(a)
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low if a[low] != b[low] else high


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def sort_suffixes(text: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes that begin at ``at``, and for each place in it whether a new string begins there.

    Every suffix has ``width`` bytes in ``text``; ``width`` is at least the shallow depth.
    """
    words = characters(text)
    order = np.argsort(words[at], kind="stable")
    new = _starts(words[at[order]])
    for depth in range(CHARACTER, SHALLOW, CHARACTER):
        _refine(order, new, words, at, depth)
    _deep(order, new, words, text, at, width)
    return order, new


def _open(new: np.ndarray) -> np.ndarray:
    """Places that are in a group of two or more."""
    alone = new & np.append(new[1:], True)
    return np.flatnonzero(~alone)


def _refine(order: np.ndarray, new: np.ndarray, words: np.ndarray, at: np.ndarray, depth: int) -> None:
    """Order the groups by the character at ``depth``, in place."""
    places = _open(new)
    if not len(places):
        return
    group = np.cumsum(new[places])
    word = words[at[order[places]] + depth]
    by = np.lexsort((word, group))
    order[places] = order[places][by]
    new[places] = _starts(group, word[by])


def _deep(
    order: np.ndarray, new: np.ndarray, words: np.ndarray, text: np.ndarray, at: np.ndarray, width: int
) -> None:
    """Order the groups that share their first ``SHALLOW`` bytes, in place.

    Groups of one string are done; two different strings only need comparing; the
    others are put into blind tries.
    """
    places = _open(new)
    if not len(places) or width <= SHALLOW:
        return
    items = order[places]
    begin = at[items]
    first = np.flatnonzero(new[places])
    ends = np.append(first[1:], len(places))
    group = np.repeat(np.arange(len(first)), ends - first)
    depths = [*range(SHALLOW, width - CHARACTER + 1, CHARACTER), width - CHARACTER]
    differs = np.zeros(len(places), bool)
    for depth in depths:
        word = words[begin + depth]
        differs |= word != word[first][group]
    mixed = np.zeros(len(first), bool)
    mixed[group[differs]] = True

    pairs = first[mixed & (ends - first == 2)]
    left, right = begin[pairs], begin[pairs + 1]
    swap, undecided = np.zeros(len(pairs), bool), np.ones(len(pairs), bool)
    for depth in depths:
        a, b = words[left + depth], words[right + depth]
        swap |= undecided & (a > b)
        undecided &= a == b
    turned = pairs[swap]
    items[turned], items[turned + 1] = items[turned + 1], items[turned]
    fresh = new[places]
    fresh[pairs + 1] = True

    more = np.flatnonzero(mixed & (ends - first > 2))
    raw = text.tobytes() if len(more) else b""
    for a, b in zip(first[more].tolist(), ends[more].tolist(), strict=True):
        trie = BlindTrie(width - SHALLOW)
        for item, start in zip(items[a:b].tolist(), begin[a:b].tolist(), strict=True):
            trie.insert(raw[start + SHALLOW : start + width], item)
        place = a
        for leaf in trie.leaves():
            items[place : place + len(leaf)] = leaf
            fresh[place : place + len(leaf)] = False
            fresh[place] = True
            place += len(leaf)
    order[places] = items
    new[places] = fresh
