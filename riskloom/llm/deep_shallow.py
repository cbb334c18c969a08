"""Deep-shallow sorting of byte strings: multikey quicksort to a shallow depth, then blind tries."""

from __future__ import annotations

#: bytes up to which strings are sorted by multikey quicksort
SHALLOW = 64
#: segments this small are ordered by comparing the strings themselves
FEW = 3


def common_prefix(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix of two strings that agree up to ``at``."""
    most = min(len(a), len(b))
    step = 16
    while at < most:
        if a[at:at + step] == b[at:at + step]:
            at = min(most, at + step)
            step *= 2
        elif step == 1:
            return at
        else:
            step = max(1, step // 4)
    return most


class BlindTrie:
    """Orders strings that agree up to a depth.

    A node knows only where its children branch: [length, children by byte], where a leaf is the number of a
    string. Going down looks at no other byte, so the leaf it ends at is compared once with the new string, and
    the place of their first difference is where the new leaf belongs. Byte -1 stands for the end of a string.
    """

    def __init__(self, strings: list[bytes], depth: int) -> None:
        self.strings, self.depth = strings, depth
        self.root: list | None = None

    @staticmethod
    def _leaf(node) -> int:
        while isinstance(node, list):
            node = next(iter(node[1].values()))
        return node[0]

    def add(self, number: int) -> None:
        text = self.strings[number]
        if self.root is None:
            self.root = (number,)
            return
        node = self.root
        while isinstance(node, list):
            byte = text[node[0]] if node[0] < len(text) else -1
            child = node[1].get(byte)
            if child is None:
                break
            node = child
        other = self.strings[self._leaf(node)]
        shared = common_prefix(text, other, self.depth)
        above, node = None, self.root
        while isinstance(node, list) and node[0] < shared:
            above, node = node, node[1][text[node[0]] if node[0] < len(text) else -1]
        if not isinstance(node, list) and shared == len(text) == len(other):
            branch = (*node, number)  # an equal string joins the leaf
        elif isinstance(node, list) and node[0] == shared:
            byte = text[shared] if shared < len(text) else -1
            node[1][byte] = (*node[1].get(byte, ()), number)  # only strings that end here and are equal meet
            return
        else:
            branch = [shared, {text[shared] if shared < len(text) else -1: (number,),
                               other[shared] if shared < len(other) else -1: node}]
        if above is None:
            self.root = branch
        else:
            above[1][text[above[0]] if above[0] < len(text) else -1] = branch

    def order(self) -> tuple[list[int], list[int]]:
        """Numbers in order, and the common prefix of each with the one before it (-1 for the first)."""
        numbers: list[int] = []
        prefixes: list[int] = []
        todo = [(self.root, -1)]
        while todo:
            node, shared = todo.pop()
            if isinstance(node, list):
                children = sorted(node[1].items(), reverse=True)
                todo.extend((child, node[0]) for _, child in children[:-1])
                todo.append((children[-1][1], shared))
            else:
                numbers.extend(node)
                prefixes.append(shared)
                prefixes.extend([len(self.strings[node[0]])] * (len(node) - 1))
        return numbers, prefixes


def deep_shallow_sort(strings: list[bytes], agreed: int = 0) -> tuple[list[int], list[int]]:
    """The order of ``strings`` and the common prefix of each with the one before it (-1 for the first).

    All of them are known to agree in their first ``agreed`` bytes.

    Multikey quicksort splits by one byte at a time into less, equal and greater, and goes one byte deeper only
    with the equal part. What still agrees at SHALLOW bytes goes into a blind trie, which looks at few bytes
    of a long common prefix again.
    """
    numbers: list[int] = []
    prefixes: list[int] = []
    # (strings, bytes they agree in, common prefix of the first of them with what comes before)
    todo = [(list(range(len(strings))), agreed, -1)] if strings else []
    while todo:
        own, depth, before = todo.pop()
        if len(own) <= FEW:
            own.sort(key=strings.__getitem__)
            for i, number in enumerate(own):
                numbers.append(number)
                prefixes.append(before if i == 0 else common_prefix(strings[own[i - 1]], strings[number], depth))
            continue
        if depth >= SHALLOW:
            trie = BlindTrie(strings, depth)
            for number in own:
                trie.add(number)
            inner, shared = trie.order()
            numbers += inner
            prefixes += [before, *shared[1:]]
            continue
        byte = [strings[n][depth] if len(strings[n]) > depth else -1 for n in own]
        pivot = sorted((byte[0], byte[len(byte) // 2], byte[-1]))[1]
        less = [n for n, b in zip(own, byte) if b < pivot]
        equal = [n for n, b in zip(own, byte) if b == pivot]
        greater = [n for n, b in zip(own, byte) if b > pivot]
        if greater:
            todo.append((greater, depth, depth))
        if pivot < 0:  # the strings that end here are equal, and nothing is less
            numbers += equal
            prefixes += [before, *[depth] * (len(equal) - 1)]
            continue
        todo.append((equal, depth + 1, depth if less else before))
        if less:
            todo.append((less, depth, before))
    return numbers, prefixes
