"""Plain Python versions of pipeline stages."""

from __future__ import annotations

import re
from collections import defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def linked(texts: dict[int, str]) -> dict[int, int]:
    """Smallest id reachable by links of similar shingle sets, of each text."""
    sets = {}
    for i, t in texts.items():
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        common = defaultdict(int)
        for g in s:
            for j in holders[g]:
                if j < i:
                    common[j] += 1
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in texts}


def passages_of(texts: dict[int, str], items: list[str]) -> set[int]:
    """Texts with a window of 20 words of an item (or the whole item), of which four in five are the same."""
    out = set()
    split = [WORD.findall(x.lower()) for x in items]
    starts = defaultdict(set)  # items by pairs of words at a distance, to find alignments
    for n, item in enumerate(split):
        for k in range(len(item) - 1):
            starts[item[k], item[k + 1]].add((n, k))
    for i, text in texts.items():
        words = WORD.findall(text.lower())
        tried = set()
        for k in range(len(words) - 1):
            for n, at in starts.get((words[k], words[k + 1]), ()):
                if (n, k - at) in tried or i in out:
                    continue
                tried.add((n, k - at))
                item, shift = split[n], k - at
                width = min(20, len(item))
                same = [0 <= p + shift < len(words) and words[p + shift] == item[p] for p in range(len(item))]
                for s in range(len(item) - width + 1):
                    inside = 0 <= s + shift and s + width + shift <= len(words)
                    if inside and sum(same[s : s + width]) >= 0.8 * width:
                        out.add(i)
    return out
