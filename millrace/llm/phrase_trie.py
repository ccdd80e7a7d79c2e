"""Tries of phrases as two arrays, searched from all positions of a text at once.

A word is a number and takes two steps of the trie, the two digits of that
number in a radix near its square root, so that no node has many children.  A
node is a place in the arrays: the child by digit ``d`` of node ``s`` is
``base[s] + d`` if ``check`` names ``s`` there, and there is none otherwise.
"""

from typing import NamedTuple

import numpy as np

WINDOW = 4096


class Trie(NamedTuple):
    """``phrase`` numbers the phrase that ends at a node, or is -1."""

    radix: int
    words: int
    base: np.ndarray
    check: np.ndarray
    phrase: np.ndarray


def _digits(numbers: np.ndarray, radix: int) -> np.ndarray:
    """(phrases, 2 * words) digits of (phrases, words) numbers."""
    return np.stack(np.divmod(numbers, radix), 2).reshape(len(numbers), -1)


def _rows(keys: np.ndarray):
    """Parent, digit and number of children of every node, level by level.

    Keys are sorted.  Node 0 is the root; the nodes of a level follow those
    above it.  Also returns the node that each key ends at.
    """
    above = np.zeros(len(keys), np.int64)
    new = np.zeros(len(keys), bool)
    parents, digits, count = [np.array([-1])], [np.array([0])], 1
    for step in range(keys.shape[1]):
        new[:1] = True
        new[1:] |= keys[1:, step] != keys[:-1, step]
        parents.append(above[new])
        digits.append(keys[new, step])
        above = count + np.cumsum(new) - 1
        count += int(new.sum())
    return np.concatenate(parents), np.concatenate(digits), above


def _placed(parents, digits, radix):
    """A place for the children of every node, largest families first, so that none overlap."""
    count = len(parents)
    order = np.argsort(parents[1:], kind="stable") + 1
    sizes = np.bincount(parents[1:], minlength=count)
    ends = np.cumsum(sizes)
    taken = np.zeros(2 * count + 2 * radix + 2 * WINDOW, bool)
    taken[0] = True
    base = np.zeros(count, np.int64)
    families = np.flatnonzero(sizes > 1)
    window, size = 0, 0
    for node in families[np.argsort(-sizes[families], kind="stable")]:
        if sizes[node] != size:
            window, size = 0, sizes[node]
        own = digits[order[ends[node] - size : ends[node]]]
        while True:
            if window + 2 * WINDOW + radix > len(taken):
                taken = np.concatenate([taken, np.zeros(len(taken), bool)])
            clash = np.zeros(WINDOW, bool)
            for digit in own.tolist():
                clash |= taken[window + digit : window + digit + WINDOW]
            found = int(clash.argmin())
            if not clash[found]:
                break
            window += WINDOW
        base[node] = window + found
        taken[base[node] + own] = True
    single = np.flatnonzero(sizes == 1)
    if len(single):
        free = np.flatnonzero(~taken[radix:]) + radix
        while len(free) < len(single):
            taken = np.concatenate([taken, np.zeros(len(taken), bool)])
            free = np.flatnonzero(~taken[radix:]) + radix
        base[single] = free[: len(single)] - digits[order[ends[single] - 1]]
    return base


def build(numbers: np.ndarray, words: int) -> Trie:
    """The trie of the phrases in the rows of ``numbers``, all different, words from 0 on."""
    radix = int(np.ceil(np.sqrt(words + 1)))
    keys = _digits(numbers, radix)
    by = np.lexsort(keys.T[::-1])
    parents, digits, ends = _rows(keys[by])
    family = _placed(parents, digits, radix)
    place = np.zeros(len(parents), np.int64)
    place[1:] = family[parents[1:]] + digits[1:]
    size = int(max(place.max(), family.max())) + radix + 1
    base, check, phrase = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    base[place] = family
    check[place[1:]] = place[parents[1:]]
    phrase[place[ends]] = by
    return Trie(radix, numbers.shape[1], base, check, phrase)


def counts(trie: Trie, numbers: np.ndarray, phrases: int) -> np.ndarray:
    """How often each phrase stands in a sequence of numbers; -1 is no word of the trie.

    The states of all places advance together, one digit at a time; a place
    drops out at the first digit that its node has no child for.
    """
    high, low = np.divmod(numbers, trie.radix)
    place = np.flatnonzero(numbers >= 0)
    state = np.zeros(len(place), np.int64)
    for word in range(trie.words):
        inside = place + word < len(numbers)
        place, state = place[inside], state[inside]
        inside = numbers[place + word] >= 0
        place, state = place[inside], state[inside]
        for digits in (high, low):
            onward = trie.base[state] + digits[place + word]
            met = trie.check[onward] == state
            place, state = place[met], onward[met].astype(np.int64)
    return np.bincount(trie.phrase[state], minlength=phrases)
