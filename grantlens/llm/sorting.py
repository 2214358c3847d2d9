"""Deep-shallow sorting of byte strings, with the common prefix of each with the one before.

Shallow: a multikey quicksort that takes eight bytes as one character orders the strings to a
fixed depth. Deep: strings still equal there share a long prefix; a blind trie, which looks
only at the bytes where strings part and then compares once with the string it came to,
orders each such group.
"""

from __future__ import annotations

import numpy as np

#: Segments this small are ordered by their words directly.
SMALL = 48


def multikey_quicksort(words: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The order of the rows of ``words``, and the runs (from, to) of equal rows in it."""
    order = np.arange(len(words))
    equal: list[tuple[int, int]] = []
    waiting = [(0, len(words), 0)]
    depth = words.shape[1]
    while waiting:
        low, high, at = waiting.pop()
        if high - low < 2:
            continue
        if at == depth:
            equal.append((low, high))
            continue
        rows = order[low:high]
        if high - low <= SMALL:
            rows = rows[np.lexsort(words[rows][:, :: -1].T)]
            order[low:high] = rows
            ends = np.flatnonzero((words[rows[1:]] != words[rows[:-1]]).any(axis=1)) + 1
            for begin, end in zip([0, *ends.tolist()], [*ends.tolist(), high - low], strict=True):
                if end - begin > 1:
                    equal.append((low + begin, low + end))
            continue
        keys = words[rows, at]
        pivot = np.sort(keys[:: max(1, len(keys) // 9)])[4]
        less, same = keys < pivot, keys == pivot
        more = ~(less | same)
        order[low:high] = np.concatenate((rows[less], rows[same], rows[more]))
        first, second = low + int(less.sum()), low + int(less.sum() + same.sum())
        waiting += [(low, first, at), (first, second, at + 1), (second, high, at)]
    return order, equal


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """The length of the common prefix, of which ``known`` bytes are known."""
    low, high = known, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def blind_trie(strings: list[bytes], known: int) -> tuple[list[int], list[int]]:
    """The order of distinct strings, and each one's common prefix with the one before.

    Inner nodes are [depth, {byte: child}], with -1 for the end of a string; leaves are
    numbers of strings. The strings share their first ``known`` bytes or end within them.
    """

    def byte(string: bytes, depth: int) -> int:
        return string[depth] if depth < len(string) else -1

    root: list | int = 0
    for number in range(1, len(strings)):
        string, node = strings[number], root
        while isinstance(node, list):
            kids = node[1]
            node = kids.get(byte(string, node[0])) if byte(string, node[0]) in kids else next(iter(kids.values()))
        other = strings[node]
        depth = common(string, other, min(known, len(string), len(other)))
        above, node = None, root
        while isinstance(node, list) and node[0] < depth:
            above, node = node, node[1][byte(string, node[0])]
        if isinstance(node, list) and node[0] == depth:
            node[1][byte(string, depth)] = number
            continue
        fork = [depth, {byte(string, depth): number, byte(other, depth): node}]
        if above is None:
            root = fork
        else:
            above[1][byte(string, above[0])] = fork
    order, shared, waiting = [], [], [(root, 0)]
    while waiting:
        node, before = waiting.pop()
        if isinstance(node, list):
            kids = [node[1][key] for key in sorted(node[1])]
            waiting += [(kid, node[0]) for kid in reversed(kids[1:])] + [(kids[0], before)]
        else:
            order.append(node)
            shared.append(before)
    return order, shared


def deep_shallow(groups: np.ndarray, strings: list[bytes], shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings within their groups; common prefixes, -1 where a group begins.

    Equal strings come together, with their whole length in common.
    """
    numbers: dict[tuple[int, bytes], int] = {}
    of = np.fromiter((numbers.setdefault(pair, len(numbers)) for pair in zip(groups.tolist(), strings, strict=True)), np.int64, len(strings))
    own = [string for _, string in numbers]
    group = np.fromiter((g for g, _ in numbers), np.int64, len(own))
    heads = np.frombuffer(b"".join(s[:shallow].ljust(shallow, b"\0") for s in own), np.uint8).reshape(len(own), shallow)
    words = np.empty((len(own), shallow // 8 + 1), np.uint64)
    words[:, 0] = group.view(np.uint64)
    words[:, 1:] = np.ascontiguousarray(heads).view(">u8")
    order, equal = multikey_quicksort(words)
    deep = []
    for low, high in equal:
        members = order[low:high].tolist()
        inner, prefixes = blind_trie([own[k] for k in members], shallow)
        order[low:high] = [members[k] for k in inner]
        deep.append((low + 1, high, prefixes[1:]))
    lengths = np.fromiter(map(len, own), np.int64, len(own))
    shared = np.full(len(own), -1, np.int64)
    if len(own) > 1:
        a, b = order[:-1], order[1:]
        apart = heads[a] != heads[b]
        first = np.where(apart.any(axis=1), apart.argmax(axis=1), shallow)
        shared[1:] = np.where(group[a] == group[b], np.minimum(first, np.minimum(lengths[a], lengths[b])), -1)
    for low, high, prefixes in deep:
        shared[low:high] = prefixes
    place = np.empty(len(own), np.int64)
    place[order] = np.arange(len(own))
    whole = np.argsort(place[of], kind="stable")
    at = place[of][whole]
    repeated = np.concatenate(([False], at[1:] == at[:-1])) if len(at) else np.zeros(0, bool)
    return whole, np.where(repeated, lengths[order[at]], shared[at])
