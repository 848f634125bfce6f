"""Suffix arrays by linear grouping, for sequences of comparable symbols.

Two suffixes are in one group if they begin with the same Lyndon word. Groups are taken in descending order. A suffix's
previous smaller suffix is the nearest one before it that is not yet taken. What a group's suffixes point to begins with the
pointed suffix's word followed by the group's, once for each pointer: these suffixes leave their group for new groups
right behind it, those with more pointers further behind. When all groups are taken, the order within each follows without
renaming: going through the array, the suffix before each entry comes next in its group, and then the chain of its
previous smaller suffixes.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """The starts of all suffixes in ascending order; a suffix that is a prefix of another comes first."""
    n = len(symbols) + 1  # with an end mark that is less than all
    if n == 1:
        return []
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(symbols):
        by_symbol.setdefault(c, []).append(i)
    # a group is a list of its suffixes; the order of groups is a doubly linked list, the end mark's group is 0
    members: list[list[int]] = [[n - 1]]
    group = [0] * n
    for c in sorted(by_symbol):
        for i in by_symbol[c]:
            group[i] = len(members)
        members.append(by_symbol[c])
    before = list(range(-1, len(members) - 1))
    after = [*range(1, len(members)), -1]
    size = [len(m) for m in members]  # members may list suffixes that have left; size does not count them
    previous = [-1] * n
    jump = list(range(-1, n - 1))  # for a taken suffix: one that is not after its nearest suffix not yet taken
    taken = bytearray(n)
    order: list[list[int]] = []
    top = len(members) - 1
    while top >= 0:
        own = [i for i in members[top] if group[i] == top] if len(members[top]) != size[top] else members[top]
        if not own:
            top = before[top]
            continue
        order.append(own)
        for i in own:
            taken[i] = 1
        pointers: dict[int, int] = {}
        for i in own:
            j = i - 1
            if j >= 0 and taken[j]:
                path = []
                while j >= 0 and taken[j]:
                    path.append(j)
                    j = jump[j]
                for k in path:
                    jump[k] = j
            jump[i] = j
            previous[i] = j
            if j >= 0:
                pointers[j] = pointers.get(j, 0) + 1
        split: dict[tuple[int, int], list[int]] = {}
        for j, count in pointers.items():
            split.setdefault((count, group[j]), []).append(j)
        for count, old in sorted(split, key=lambda x: -x[0]) if len(split) > 1 else split:
            moved = split[count, old]
            new = len(members)
            members.append(moved)
            size.append(len(moved))
            size[old] -= len(moved)
            for j in moved:
                group[j] = new
            follower = after[old]
            before.append(old)
            after.append(follower)
            after[old] = new
            if follower >= 0:
                before[follower] = new
        top = before[top]
    # starts of the groups in the array
    place = [0] * len(members)
    start = 0
    for own in reversed(order):
        place[group[own[0]]] = start
        start += len(own)
    array = [-1] * n
    array[0] = n - 1
    done = bytearray(n)
    done[n - 1] = 1
    for at in range(n):
        j = array[at] - 1
        while j >= 0 and not done[j]:
            done[j] = 1
            g = group[j]
            array[place[g]] = j
            place[g] += 1
            j = previous[j]
    return array[1:]
