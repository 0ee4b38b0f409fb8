import random

import pytest

from tests.llm.helpers import components
from voxloom.llm.components import connected_components


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    r = random.Random(seed)
    links = [(r.randrange(400), r.randrange(400)) for _ in range(250)]
    links += [(k, k + 1) for k in range(1000, 1040)] + [(5000, k) for k in range(5001, 5100)]
    links += links[:20] + [(7, 7)]
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == components([x for x in links if x[0] != x[1]], nodes)


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
