"""Connected components against a search over all links."""

import random

import pytest

from storeloom.llm.components import components


def brute(links):
    near = {}
    for a, b in links:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out = {}
    for node in sorted(near):
        reached = [] if node in out else [node]
        while reached:
            at = reached.pop()
            if at not in out:
                out[at] = node
                reached += near[at]
    return out


def found(spark, links):
    rows = [(r["node"], r["component"]) for r in components(spark.createDataFrame(links, "a long, b long")).collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def test_random_links_chains_and_stars(spark):
    draw = random.Random(5)
    chain = list(range(1000, 1060))
    draw.shuffle(chain)
    links = [(draw.randrange(150), draw.randrange(150)) for _ in range(90)]
    links += list(zip(chain, chain[1:]))
    links += [(2000 + k, 2001 + k) for k in range(40)]
    links += [(3000, k) for k in range(3001, 3050)] + [(3049, 2500)]
    links += [(7, 7), (None, 1), (2, None), (3000, 3001), (3001, 3000)]
    assert found(spark, links) == brute(links)


@pytest.mark.parametrize("links", [[], [(4, 4)], [(None, None), (None, 3)]])
def test_no_links(spark, links):
    assert found(spark, links) == {}
