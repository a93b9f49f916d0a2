"""Plain Python versions that the operators are compared with."""

import re
from collections import defaultdict


def words(text):
    return (text or "").encode().lower().split()


def shingle_set(text, k=5):
    found = words(text)
    k = min(k, len(found))
    return frozenset(tuple(found[i : i + k]) for i in range(len(found) - k + 1)) if found else frozenset()


def near_duplicates(rows, percent=75):
    """[(doc_id, text)] -> sorted [(doc_id, n_shingles, component_id)], all pairs compared."""
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, one in enumerate(sets):
        for j in range(i):
            both = len(one & sets[j])
            if one and sets[j] and 100 * both >= percent * (len(one) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[find(i)].append(doc_id)
    least = {r: min((d for d in found if d is not None), default=None) for r, found in ids.items()}
    return sorted(
        ((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)), key=lambda r: (str(r[0]), r[1:2])
    )


def count_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
