"""Helpers for brute-force versions."""

import re


def random_texts(random, parts, count, most):
    """Texts of up to ``most`` of the given parts."""
    return ["".join(random.choice(parts) for _ in range(random.randint(0, most))) for _ in range(count)]


def words(text):
    """Words as the operators take them."""
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return [w for w in re.split(r"[\x20\x09-\x0d]+", lower) if w]


def shingle_set(text, length=5):
    own = words(text)
    if not own:
        return frozenset()
    return frozenset(tuple(own[i:i + length]) for i in range(max(1, len(own) - length + 1)))


def smallest_reachable(nodes, links):
    """The smallest node that each reaches."""
    parent = {node: node for node in nodes}

    def root(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {node: root(node) for node in nodes}
