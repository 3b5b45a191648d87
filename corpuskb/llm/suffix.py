"""Deep-shallow sorting of byte strings: multikey quicksort, then blind tries for groups with a long common prefix."""

from __future__ import annotations

#: Bytes that multikey quicksort compares at a time, and the depth up to which it works.
STEP, SHALLOW = 8, 24


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, of which the first ``start`` bytes are known to agree."""
    most = min(len(a), len(b))
    if a[start:most] == b[start:most]:
        return most
    low, high = start, most
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class _Branch:
    __slots__ = ("below", "depth")

    def __init__(self, depth: int):
        self.depth = depth
        #: by the byte at ``depth``; -1 is the end of the string
        self.below: dict[int, _Branch | list[int]] = {}


def _blind_trie(strings: list[bytes], group: list[int], depth: int, order: list[int], prefix: list[int], before: int) -> None:
    """Append a group in order, with each string's common prefix with the string before it.

    Inner nodes know only the depth at which strings part and the bytes there. A string goes down by those
    bytes alone, is compared once with the leaf it comes to, and is put in where that comparison ends.
    """
    root: _Branch | list[int] = [group[0]]
    for k in group[1:]:
        s, node = strings[k], root
        while type(node) is _Branch:
            node = node.below.get(s[node.depth] if node.depth < len(s) else -1) or next(iter(node.below.values()))
        other = strings[node[0]]
        same = common_prefix(s, other, depth)
        if same == len(s) == len(other):
            node.append(k)
            continue
        above, node = None, root
        while type(node) is _Branch and node.depth < same:
            above, node = node, node.below[s[node.depth]]
        here = s[same] if same < len(s) else -1
        if type(node) is _Branch and node.depth == same:
            node.below[here] = [k]
            continue
        split = _Branch(same)
        split.below[other[same] if same < len(other) else -1] = node
        split.below[here] = [k]
        if above is None:
            root = split
        else:
            above.below[s[above.depth]] = split
    # in order; each leaf's first string parts from the one before it at the deepest node left behind
    stack: list[tuple[_Branch | list[int], int]] = [(root, before)]
    while stack:
        node, parted = stack.pop()
        if type(node) is _Branch:
            children = [node.below[c] for c in sorted(node.below)]
            stack += [(child, node.depth) for child in children[:0:-1]] + [(children[0], parted)]
        else:
            order += node
            prefix += [parted] + [len(strings[node[0]])] * (len(node) - 1)


def deep_shallow_sort(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Places of the strings in order, and each one's common prefix with the one before it (the first has 0)."""
    order: list[int] = []
    prefix: list[int] = []
    # (group, depth, common prefix of its least string with the one before)
    stack: list[tuple[list[int], int, int | None]] = [(list(range(len(strings))), 0, 0)]
    while stack:
        group, depth, before = stack.pop()
        if before is None:
            before = common_prefix(strings[order[-1]], strings[min(group, key=lambda k: strings[k][: depth + STEP])])
        if len(group) == 1:
            order.append(group[0])
            prefix.append(before)
            continue
        # up to three strings are in order after one comparison each, at any depth
        if depth >= SHALLOW or len(group) <= 3:
            _blind_trie(strings, group, depth, order, prefix, before)
            continue
        pivot = strings[group[len(group) // 2]][depth : depth + STEP]
        parts: tuple[list[int], list[int], list[int]] = ([], [], [])
        for k in group:
            piece = strings[k][depth : depth + STEP]
            parts[(piece > pivot) - (piece < pivot) + 1].append(k)
        less, equal, more = parts
        # within a group, what lies before the first part is known; the others look at the string put out last
        todo = [(less, depth), (equal, depth + STEP if len(pivot) == STEP else SHALLOW), (more, depth)]
        todo = [x for x in todo if x[0]]
        stack += [(g, d, None) for g, d in todo[:0:-1]] + [(*todo[0], before)]
    if prefix:
        prefix[0] = 0
    return order, prefix
