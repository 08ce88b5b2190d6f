"""Near-duplicates against all pairs in plain Python."""

import random
import re
from collections import Counter

import pytest

from pagemill.llm import near_dedup
from pagemill.llm.components import components


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def all_pairs(pairs, width, percent):
    sets = [shingle_set(t, width) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            same_id = pairs[i][0] is not None and pairs[i][0] == pairs[j][0] and sets[i] and sets[j]
            if pairs[i][0] is None or pairs[j][0] is None or not sets[i] or not sets[j]:
                continue
            if same_id or 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(pairs):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return Counter((i, len(sets[k]), least.get(find(k)), i == least.get(find(k))) for k, (i, _) in enumerate(pairs))


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    pairs = [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one"), (905, "two words"), (906, "TWO\tWORDS"), (907, "words two"), (None, "two words"), (None, None), (903, "one"), (908, "long " * 200_000), (909, "LONG " * 150_000)]
    n = 0
    for _ in range(25):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([8, 40, 150, 600]))]
        for _ in range(draw.choice([1, 2, 3, 12])):
            words = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, len(base) // 60])):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            pairs.append((n, draw.choice([" ", "\n"]).join(words)))
            n += 1
            base = words if draw.random() < 0.5 else base  # chains too
    return pairs


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_components_are_those_of_all_pairs(docs_of, width, percent):
    pairs = corpus(width)
    rows = near_dedup.near_duplicates(docs_of(pairs), width=width, percent=percent).collect()
    assert Counter(map(tuple, rows)) == all_pairs(pairs, width, percent)


def test_a_large_group_makes_few_candidates(docs_of, monkeypatch):
    draw = random.Random(1)
    base = [f"w{draw.randrange(500)}" for _ in range(300)]
    pairs = []
    for n in range(400):
        words = list(base)
        for _ in range(draw.choice([1, 1, 9, 14])):  # some too far from all others
            words[draw.randrange(300)] = f"x{n}"
        pairs.append((n, " ".join(words)))
    tried = []
    plain = near_dedup._Links.confirmed
    monkeypatch.setattr(near_dedup._Links, "confirmed", lambda self, p, sets=None: (tried.append(p.count()), plain(self, p, sets))[1])
    monkeypatch.setattr(near_dedup, "LONG_LIST", 16)
    rows = near_dedup.near_duplicates(docs_of(pairs), width=3, percent=85).collect()
    assert Counter(map(tuple, rows)) == all_pairs(pairs, 3, 85)
    assert sum(tried) < 12 * len(pairs)


def test_rows_that_share_an_id_are_one_node(docs_of):
    """Classes, chains of them and near copies that meet in one doc_id only."""
    text = {x: " ".join(f"{x}{k}" for k in range(60)) for x in "ABCD"}
    near = text["D"].replace("D7 ", "other ")
    pairs = [(3, text["A"]), (5, text["A"]), (5, text["B"]), (9, text["B"]), (9, text["C"]), (2, text["C"]), (20, near), (21, text["D"]), (21, "apart it is"), (30, "apart it is"), (31, None), (31, "")]
    rows = near_dedup.near_duplicates(docs_of(pairs), width=3, percent=85).collect()
    assert Counter(map(tuple, rows)) == all_pairs(pairs, 3, 85)
    assert {r.component_id for r in rows if r.doc_id in (2, 3, 5, 9)} == {2} and {r.component_id for r in rows if r.doc_id in (20, 21, 30)} == {20}


def test_a_long_list_in_blocks_is_compared_whole(docs_of, monkeypatch):
    """One list of classes that are too far from one another for the leader to link, with a few links among them."""
    draw = random.Random(12)
    base = [f"w{draw.randrange(300)}" for _ in range(200)]
    pairs = []
    for n in range(150):
        words = list(base)
        for _ in range(draw.choice([1, 7, 9])):
            words[draw.randrange(200)] = f"x{n}"
        pairs.append((n, " ".join(words)))
        if n % 10 == 0:
            pairs.append((1000 + n, " ".join([*words, "end"])))
    monkeypatch.setattr(near_dedup, "LONG_LIST", 8)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rows = near_dedup.near_duplicates(docs_of(pairs), width=3, percent=85).collect()
    assert Counter(map(tuple, rows)) == all_pairs(pairs, 3, 85)


def test_empty_table(docs_of):
    assert near_dedup.near_duplicates(docs_of([])).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 3), (3, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 40)}}
