"""Small tables and plain versions of the operators."""

import re
from collections import Counter

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def components(links, nodes):
    """Least node reachable from each node."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
