import random
from collections import defaultdict

import pytest

from sluicebox.llm import near_duplicates as nd
from sluicebox.llm import substrings as sub
from sluicebox.llm.components import components

VOCABULARY = [f"w{n}" for n in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def altered(rng, text, share):
    return " ".join(rng.choice(VOCABULARY) + "x" if rng.random() < share else w for w in text.split())


def shingles(text, n):
    words = (text or "").encode().lower().split()
    n = min(n, len(words))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x] = parent[parent[x]]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows if i is not None}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    found = roots(sets, links)
    return {i: (len(s), found[i]) for i, s in sets.items()}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.choice([3, 20, 60, 200]))) for i in range(1, 60)]
    base, common = prose(rng, 150), prose(rng, 40)
    # many near copies of one text, some nearer to one another than to it
    rows += [(100 + k, altered(rng, base, rng.choice([0.005, 0.01, 0.02, 0.03, 0.05]))) for k in range(60)]
    rows += [(200 + k, rows[5][1].upper()) for k in range(15)]
    rows += [(300 + k, common + " " + prose(rng, 6 + k)) for k in range(20)]
    drift = prose(rng, 120)
    for k in range(25):
        drift = altered(rng, drift, 0.01)
        rows.append((400 + k, drift))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "a b"), (504, "A  b"), (505, "a b c"), (506, "long " * 30_000), (507, "long " * 20_000)]
    return rows


@pytest.mark.parametrize("n,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(texts, corpus, n, percent):
    extra = [(None, corpus[0][1]), (None, None), (3, corpus[2][1])]
    found = nd.near_duplicates(texts(corpus + extra), words=n, percent=percent).collect()
    expected = brute(corpus, n, percent)
    assert len(found) == len(corpus) + len(extra)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id] and r.kept == (r.component_id == r.doc_id)


def test_no_documents(texts):
    assert nd.near_duplicates(texts([])).collect() == []
    assert sub.remove_repeats(texts([])).collect() == []


def test_long_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(0, 90)] + [(1000, 1000 + k) for k in range(1, 60)] + [(2002, 2001), (2003, 2002), (5, 5)]
    order = list(range(90))
    rng.shuffle(order)
    edges += [(3000 + a, 3000 + b) for a, b in zip(order, order[1:])]
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == roots(nodes, edges)


def test_collisions_of_packed_signatures(spark):
    from pyspark.sql import functions as F

    rng = random.Random(1)
    rows = []
    for _ in range(50):
        a = [rng.getrandbits(63) - (1 << 62) for _ in range(nd.COORDINATES)]
        rows.append((a, [v if rng.random() < 0.5 else rng.getrandbits(63) for v in a]))
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    packed = df.select(F.struct(*nd._packed("a")).alias("x"), F.struct(*nd._packed("b")).alias("y"), "a", "b")
    for r in packed.select(nd._collisions("x", "y").alias("n"), "a", "b").collect():
        assert r.n == sum((p & 255) == (q & 255) for p, q in zip(r.a, r.b))


def test_least_matches():
    assert nd.least_matches(1.0) == nd.COORDINATES
    assert 10 < nd.least_matches(0.8) < nd.least_matches(0.85) < nd.COORDINATES


def test_passages_are_cut_once_kept(texts):
    rng = random.Random(9)
    passage = prose(rng, 60)
    rows = [(1, prose(rng, 30) + " " + passage + " tail\n" + prose(rng, 20)), (2, passage), (3, "Head " + passage.upper() + "\n" + prose(rng, 50)),
            (4, prose(rng, 100)), (5, "short line\n" + prose(rng, 70)), (6, "short line\nshort line\n" + prose(rng, 70)), (7, ""), (8, None),
            (3, "Head " + passage.upper() + "\n" + "x"), (None, passage), (9, "q " * 50_000 + passage), (10, passage.replace(" ", "\t ")), (10, passage.replace(" ", "\t "))]
    rows[8] = rows[2]
    found = sub.remove_repeats(texts(rows), carry="n_tokens").collect()
    assert len(found) == len(rows) and {r.carried for r in found} == {"x"}
    original = defaultdict(set)
    for i, t in rows:
        original[i].add(t)
    by_id = {r.doc_id: r for r in found}
    for r in found:
        if r.text is None:
            assert r.doc_id == 8
            continue
        source = next(iter(original[r.doc_id]))
        edges = [0, *(e for s in r.removed for e in (s.begin, s.end)), len(source)]
        assert r.text == "".join(source[a:b] for a, b in zip(edges[::2], edges[1::2]))
    untouched = [1, 4, 5, 6, 7, None]
    assert all(by_id[i].removed == [] for i in untouched)
    assert [r.text for r in found if r.doc_id in (2, 10)] == ["", "", ""]
    assert all(r.text.startswith("Head ") and passage.upper()[50:80] not in r.text for r in found if r.doc_id == 3)
    assert passage not in by_id[9].text


@pytest.mark.parametrize("seed", range(5))
def test_passages_are_found_wherever_they_stand(texts, seed):
    rng = random.Random(seed)
    passages = [prose(rng, rng.randint(51, 120)) for _ in range(8)]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randint(5, 60)) for _ in range(3)]
        if i % 2:
            parts.insert(rng.randint(0, 3), rng.choice(passages))
        rows.append((i, rng.choice([" ", "\n"]).join(parts)))
    found = {r.doc_id: r for r in sub.remove_repeats(texts(rows)).collect()}
    first = {p: min((i for i, t in rows if p in t), default=None) for p in passages}
    caught = wanted = 0
    for i, t in rows:
        for p in passages:
            if p in t and first[p] != i:
                wanted += 1
                caught += p not in found[i].text and sum(s.end - s.begin for s in found[i].removed) >= 0.95 * len(p)
            elif p in t:
                assert p in found[i].text
        if not i % 2:
            assert found[i].text == t
    assert caught >= 0.95 * wanted
