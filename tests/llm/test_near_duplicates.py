from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from tablesmith.llm import jaccard_join as j
from tablesmith.llm.components import components
from tablesmith.llm.shared import written

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


class Sets:
    def __init__(self):
        self.up = {}

    def top(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.top(x), self.top(y)))
        self.up[y] = x


def brute(rows, s):
    sets, holders, groups = {d: shingles(t, s.width) for d, t in rows}, defaultdict(list), Sets()
    for d, found in sets.items():
        shared = defaultdict(int)
        for x in found:
            for other in holders[x]:
                shared[other] += 1
            holders[x].append(d)
        for other, both in shared.items():
            if 100 * both >= s.percent * (len(found) + len(sets[other]) - both):
                groups.join(d, other)
    return {d: (len(sets[d]), groups.top(d)) for d in sets}


def variants(seed):
    """Copies of a few texts with some words changed, in groups from two to eighty, a hot passage, short texts."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randint(1, 4000)}"
    passage = [word() for _ in range(60)]
    rows = []
    for size in (80, 30, 9, 5, 2, 2, 2):
        base = [word() for _ in range(draw.choice([8, 40, 150, 600]))]
        for _ in range(size):
            text = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 40))):
                text[draw.randrange(len(text))] = word()
            rows.append(text)
    rows += [passage + [word() for _ in range(draw.randint(1, 40))] for _ in range(60)]
    rows += [[word() for _ in range(draw.randint(0, 6))] for _ in range(40)] + [["a", "b", "c"], ["A", "b", "C"]]
    draw.shuffle(rows)
    return [(i, " ".join(text)) for i, text in enumerate(rows)]


@pytest.mark.parametrize("seed, settings", [(1, j.Settings(share=1)), (2, j.Settings(5, 80)), (3, j.Settings(4, 85, share=2))])
def test_components_equal_brute_force(spark, seed, settings):
    rows = variants(seed)
    found = j.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), settings).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, settings)


@pytest.mark.parametrize("light", [1, 20, 10_000])
def test_any_boundary_gives_the_same(spark, monkeypatch, light):
    monkeypatch.setattr(j, "_boundary", lambda *a: light)
    rows = [(i, t) for i, t in variants(4) if len(t.split()) < 200]
    found = j.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, j.Settings())


def test_awkward_rows(spark, awkward, nothing):
    found = j.similar_components(awkward)
    rows = {r.doc_id: r for r in found.collect()}
    assert found.count() == awkward.count()
    assert [rows[d].n_shingles for d in (2, 3, 4, 9)] == [0, 0, 0, 1] and rows[8].component_id == 1
    assert all(rows[d].component_id == d for d in (2, 3, 4, 5, 6, 9, 10))
    kept = j.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 9, 10]
    assert j.similar_components(nothing).collect() == [] and j.one_of_each(nothing).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    draw, groups = random.Random(seed), Sets()
    links = [(draw.randint(-50, 50), draw.randint(-50, 50)) for _ in range(60)]
    links += [(k, k + 1) for k in range(1000, 1064)] + [(5000, 5000 - k) for k in range(1, 40)]
    for a, b in links:
        groups.join(a, b)
    found = components(written(spark.createDataFrame(links, "a long, b long"), "test")[0]).collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.root for r in found} == {x: groups.top(x) for a, b in links if a != b for x in (a, b)}


def test_nodes_agree_for_equal_sets_only(spark):
    rows = [(1, "a b c d e"), (2, "A B C D E"), (3, "a b c d f"), (4, "a b c"), (5, "a b c d")]
    found = j.shingle_sets(spark.createDataFrame(rows, "doc_id long, text string"), j.Settings()).collect()
    nodes = {r.doc_id: r.node for r in found}
    assert nodes[1] == nodes[2] and len(set(nodes.values())) == 4


def test_one_document_of_each_group_stays(spark):
    one, near, two, three = ("the same words in each of these copies", "The Same words in each of these copies",
                             "one group that no row has an id for", "another text under an id that was used")
    rows = [(None, two)] * 3 + [(None, two.upper()), (1, one), (1, one), (1, near), (4, one), (None, one)]
    rows += [(1, three), (5, three), (None, three), (None, ""), (None, ""), (7, ""), (7, "")]
    kept = j.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    groups = sorted(((r.doc_id or 0), r.text.lower()) for r in kept)
    assert groups == sorted([(0, two), (1, one), (1, three), (0, ""), (0, ""), (7, "")])
