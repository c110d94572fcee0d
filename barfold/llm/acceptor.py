"""Minimal acceptors of finite vocabularies, and their composition with a one-edit transducer.

An acceptor is held as arrays: states of equal right languages are one state, transitions are listed by
state and label, and each knows how many words come before those behind it, so that a path spells the
rank of its word. The composition acceptor, one edit, acceptor is walked level by level: all its
open paths advance together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Acceptor:
    first: np.ndarray  # state -> its first transition; one more entry closes the last state
    label: np.ndarray
    target: np.ndarray
    before: np.ndarray  # words of the state that sort before those behind the transition
    least: np.ndarray  # length of the shortest word from a state
    most: np.ndarray  # and of the longest
    root: int
    row: np.ndarray  # rank of a word -> its place in the input


def build(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Acceptor:
    """The minimal acceptor of distinct strings: string k is ``flat[starts[k]:][:lengths[k]]``."""
    wide = int(flat.max(initial=0)) + 1
    levels, ends = [np.zeros(1, np.int64)], np.zeros(len(starts), np.int64)
    parents, labels, nodes = [], [], 1
    alive, node, depth = np.arange(len(starts)), np.zeros(len(starts), np.int64), 0
    while len(alive):
        done = lengths[alive] == depth
        ends[alive[done]] = node[done]
        alive, node = alive[~done], node[~done]
        if len(alive):
            made, place = np.unique(node * wide + flat[starts[alive] + depth], return_inverse=True)
            parents.append(made // wide)
            labels.append(made % wide)
            node = nodes + place
            levels.append(np.arange(nodes, nodes + len(made)))
            nodes += len(made)
        depth += 1
    # Transition k of the trie leads to node k + 1; transitions are in the order of node and label.
    parent = np.concatenate([np.zeros(0, np.int64), *parents])
    label = np.concatenate([np.zeros(0, np.int64), *labels])
    first = np.searchsorted(parent, np.arange(nodes + 1))
    final = np.zeros(nodes, np.int64)
    final[ends] = 1
    words, most = final.copy(), np.zeros(nodes, np.int64)
    least = np.where(final == 1, 0, depth + 1)
    for level in reversed(levels[1:]):
        up = parent[level - 1]
        np.add.at(words, up, words[level])
        np.maximum.at(most, up, most[level] + 1)
        np.minimum.at(least, up, least[level] + 1)
    total = np.concatenate(([0], np.cumsum(words[1:])))
    before = total[:-1] - total[first[parent]] + final[parent]
    rank = np.zeros(nodes, np.int64)
    for level in levels[1:]:
        rank[level] = rank[parent[level - 1]] + before[level - 1]
    row = np.zeros(len(starts), np.int64)
    row[rank[ends]] = np.arange(len(starts))
    state, chosen = _merged(first, label, final, most)
    degree = np.diff(first)[chosen]
    edge, _ = _ragged(first[chosen], degree)
    return Acceptor(
        np.concatenate(([0], np.cumsum(degree))), label[edge], state[edge + 1], before[edge],
        least[chosen], most[chosen], int(state[0]), row)


def _merged(first, label, final, most) -> tuple[np.ndarray, np.ndarray]:
    """The minimal state of each trie node, and a node of each state.

    Nodes are taken by height, so their targets' states are known. A node is described by whether it
    is final and by its transitions, folded in one by one; equal descriptions are one state.
    """
    nodes = len(final)
    wide, degree = int(label.max(initial=0)) + 1, np.diff(first)
    state, chosen, states = np.zeros(nodes, np.int64), [], 0
    order = np.argsort(most[1:], kind="stable") + 1
    cuts = np.searchsorted(most[order], np.arange(most[1:].max(initial=-1) + 2))
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        group = order[low:high]
        sign = final[group].copy()
        for k in range(int(degree[group].max(initial=0))):
            on = np.flatnonzero(degree[group] > k)
            edge = first[group[on]] + k
            step = np.unique(label[edge] * (states + 1) + state[edge + 1], return_inverse=True)[1]
            sign[on] = np.unique(sign[on] * (nodes + 1) + step, return_inverse=True)[1]
        _, at, place = np.unique(
            sign * (wide + 1) + degree[group], return_index=True, return_inverse=True)
        state[group] = states + place
        chosen.append(group[at])
        states += len(at)
    state[0] = states
    return state, np.concatenate([*chosen, [0]])


def _ragged(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places ``first[k]`` to ``first[k] + count[k] - 1`` of every k, and the k of each."""
    owner = np.repeat(np.arange(len(count)), count)
    ends = np.cumsum(count)
    return np.arange(len(owner)) - (ends - count)[owner] + first[owner], owner


def one_edit_pairs(words: Acceptor, short: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of input rows whose strings differ by one edit after an equal first label.

    The first label of a string names its block; its other labels number ``short`` or one more
    (given per row, like ``inner``). Pairs of two longer strings are left out, and in ``inner`` blocks those
    where one string is the other and one more label. Each pair comes once, the longer string first: the
    transducer edits at the first difference, so after a deletion the deleted label may not follow in the other string.
    """
    degree = np.diff(words.first)
    wide = int(words.label.max(initial=0)) + 1
    key = np.repeat(np.arange(len(degree)), degree) * wide + words.label
    start = slice(words.first[words.root], words.first[words.root + 1])
    q, i = words.target[start], words.before[start]
    left, inside = short[words.row[i]], inner[words.row[i]].astype(bool)
    none = np.zeros(0, np.int64)
    # Open paths after the edit: two states, two ranks, labels the shorter word has left, whether one
    # label was deleted, and the label that may not come next.
    a = ai = b = bi = rest = cut = ban = none
    found = []
    while len(q) or len(a):
        if len(a):
            edge, o = _ragged(words.first[a], degree[a])
            lab = words.label[edge]
            go = lab != ban[o]
            edge, o, lab = edge[go], o[go], lab[go]
            seek = b[o] * wide + lab
            other = np.minimum(np.searchsorted(key, seek), len(key) - 1)
            to, more = words.target[edge], rest[o] - 1
            go = (key[other] == seek) & (words.least[words.target[other]] == more)
            go &= np.where(cut[o] == 1, words.most[to], words.least[to]) == more
            edge, other, o = edge[go], other[go], o[go]
            a, b, rest, cut = words.target[edge], words.target[other], rest[o] - 1, cut[o]
            ai, bi, ban = ai[o] + words.before[edge], bi[o] + words.before[other], np.full(len(o), -1)
        edge, o = _ragged(words.first[q], degree[q])
        to, ti, lab = words.target[edge], i[o] + words.before[edge], words.label[edge]
        # One label replaced: two transitions of a state.
        usable = np.flatnonzero(words.least[to] == left[o] - 1)
        size = np.bincount(o[usable], minlength=len(q))
        place = np.arange(len(usable)) - (np.cumsum(size) - size)[o[usable]]
        right, k = _ragged(np.arange(len(usable)) + 1, size[o[usable]] - 1 - place)
        one, two = usable[k], usable[right]
        turn = degree[to[one]] > degree[to[two]]
        one, two = np.where(turn, two, one), np.where(turn, one, two)
        # One label deleted from the longer word.
        gone = np.flatnonzero((words.most[to] == left[o]) & (words.least[q[o]] == left[o]) & ~(inside[o] & (left[o] == 0)))
        a, b = np.concatenate([a, to[one], to[gone]]), np.concatenate([b, to[two], q[o[gone]]])
        ai, bi = np.concatenate([ai, ti[one], ti[gone]]), np.concatenate([bi, ti[two], i[o[gone]]])
        rest = np.concatenate([rest, left[o[one]] - 1, left[o[gone]]])
        cut = np.concatenate([cut, np.zeros(len(one), np.int64), np.ones(len(gone), np.int64)])
        ban = np.concatenate([ban, np.full(len(one), -1), lab[gone]])
        done = rest == 0
        found.append((words.row[ai[done]], words.row[bi[done]]))
        a, ai, b, bi, rest, cut, ban = (x[~done] for x in (a, ai, b, bi, rest, cut, ban))
        q, i, left, inside = to, ti, left[o] - 1, inside[o]
    return np.concatenate([none, *(f[0] for f in found)]), np.concatenate([none, *(f[1] for f in found)])
