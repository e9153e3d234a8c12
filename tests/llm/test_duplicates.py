"""Links and components against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayer.llm import embedding_dedup, ngram_join
from assayer.llm.components import components, local_roots
from assayer.llm.embedding_dedup import near_duplicate_vectors, sorted_passes
from assayer.llm.ngram_join import first_of_each, least_matches, near_duplicates, shared_grams, words_of


def _roots(n: int, edges) -> list[int]:
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(55)] + [(i, i + 1) for i in range(100, 130)] + [(5, 5)]
    want = _roots(131, edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: want[x] for e in edges for x in e if e[0] != e[1] or x in got}
    assert local_roots(131, *map(np.array, zip(*edges, strict=True))).tolist() == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# Embeddings


def _vectors(rng: np.random.Generator) -> list[tuple]:
    rows, key = [], 0
    for label in (0, 1):
        for centre in rng.normal(size=(40, 16)):
            for _ in range(int(rng.integers(1, 4))):
                rows.append((key, (centre + rng.normal(scale=0.08, size=16)).tolist(), label))
                key += 1
    centre = rng.normal(size=16)
    rows += [(key + i, (centre + rng.normal(scale=0.05, size=16)).tolist(), 1) for i in range(60)]
    return rows


@pytest.mark.parametrize("block", [8, 512])
def test_vectors_against_brute_force(spark, block):
    rows = _vectors(np.random.default_rng(4))
    odd = [
        (900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [float("nan")] + [1.0] * 15, 0), (904, [None] + [1.0] * 15, 0),
        (905, rows[0][1], None), (906, rows[0][1][:8], 0), (907, [x * 1e300 for x in rows[1][1]], rows[1][2]), (908, rows[1][1], rows[1][2]), (908, rows[1][1], rows[1][2]),
    ]
    table = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>, label int").repartition(3).withColumn("dim", F.lit("x"))
    got = near_duplicate_vectors(table, block=block).collect()
    assert len(got) == len(rows) + len(odd)
    good = [(k, np.array(v) / np.abs(v).max(), label) for k, v, label in [*rows, *odd[7:], (906, rows[0][1][:8], 0)]]
    good = [(k, v / np.linalg.norm(v), label) for k, v, label in good]
    edges = [(a, b) for a in range(len(good)) for b in range(a) if good[a][2] == good[b][2] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= 0.93]
    links, roots = Counter(x for e in edges for x in e), _roots(len(good), edges)
    least = defaultdict(lambda: 10**9)
    for i, root in enumerate(roots):
        least[root] = min(least[root], good[i][0])
    want = {good[i][0]: (links[i], least[roots[i]]) for i in range(len(good))}
    for r in got:
        n, component = want.get(r.vec_id, (0, r.vec_id))
        assert (r.n_links, r.component_id, r.kept) == (n, component, r.vec_id == component)


def _links_of(x: np.ndarray) -> tuple[list[int], list[int]]:
    near = x @ x.T >= 0.93
    np.fill_diagonal(near, False)
    return near.sum(axis=1).tolist(), local_roots(len(x), *np.nonzero(near)).tolist()


@pytest.mark.parametrize("block", [4, 512])
def test_vectors_of_clusters_wider_than_a_window(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "PART", 64)
    rng = np.random.default_rng(6)
    x = np.vstack((rng.normal(size=(500, 16)), rng.normal(size=16) + rng.normal(scale=0.28, size=(300, 16)), np.repeat(rng.normal(size=(1, 16)), 200, axis=0)))
    x /= np.linalg.norm(x, axis=1)[:, None]
    links, roots = _links_of(x)
    # The cluster and the copies are many windows of 4 wide; some of its vectors have few links.
    assert min(links[500:800]) < 150 < 250 < max(links[500:800]) and len(set(roots)) > 400
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>, label int").repartition(3)
    got = {r.vec_id: r for r in near_duplicate_vectors(table, block=block).collect()}
    assert [got[i].component_id for i in range(1000)] == roots
    assert [got[i].n_links for i in range(1000)] == links


def test_vectors_that_share_a_direction(spark):
    rng = np.random.default_rng(9)
    rows, want = [], {}
    # Unrelated vectors, which passes serve, and such with a common direction, which need many more bits.
    for label, shift, noise in ((1, 0.0, 0.34), (2, 2.2, 0.82)):
        x = rng.normal(size=(900, 32)) + shift
        x = np.vstack((x, x + rng.normal(scale=noise, size=x.shape)))
        x /= np.linalg.norm(x, axis=1)[:, None]
        links, roots = _links_of(x)
        assert sum(links) > 1000
        for i, v in enumerate(x):
            rows.append((2000 * label + i, v.tolist(), label))
            want[2000 * label + i] = (links[i], 2000 * label + roots[i])
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicate_vectors(table, block=16).collect()}
    lost = Counter(k // 2000 for k in want if got[k] != want[k])
    assert lost[1] <= 2 and lost[2] <= 2


def test_passes_alone_find_the_links_of_a_label_ruled_by_one_topic(spark):
    rng = np.random.default_rng(12)
    # Most vectors lie near the mean of the label, where planes about the mean may part any two of them.
    topic = rng.normal(size=24)
    x = np.vstack((topic + rng.normal(scale=0.3, size=(260, 24)), rng.normal(size=(140, 24))))
    x = np.vstack((x, x[300:] + rng.normal(scale=0.25, size=(100, 24))))
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = np.triu(x @ x.T >= 0.93, 1)
    rows = [(i, 7, 24, v.tobytes()) for i, v in enumerate(x)]
    named = spark.createDataFrame(rows, "tid bigint, grp bigint, dim int, vector binary").repartition(3)
    clusters = {r.tid: r.cluster for r in sorted_passes(named, 0.93, 1e-4, 16).collect()}
    assert near.sum() > 90
    found = [a in clusters and clusters[a] == clusters.get(b) for a, b in zip(*(v.tolist() for v in np.nonzero(near)), strict=True)]
    assert np.mean(found) > 0.99


def test_vectors_of_nothing(spark):
    assert near_duplicate_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


# N-grams


def _brute(rows: list[tuple]) -> dict:
    grams = {}
    for at, (_, text, *_) in enumerate(rows):
        words = words_of(text)
        width = min(5, len(words))
        grams[at] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()
    near = lambda a, b: grams[a] and len(grams[a] & grams[b]) / len(grams[a] | grams[b]) >= 0.8
    edges = [(a, b) for a in grams for b in range(a) if near(a, b)]
    return {"links": Counter(x for e in edges for x in e), "roots": _roots(len(rows), edges)}


def _check(rows: list[tuple], got: list) -> None:
    want = _brute(rows)
    least = {}
    for i, root in enumerate(want["roots"]):
        ids = [k for k in (least.get(root), rows[i][0]) if k is not None]
        least[root] = min(ids) if ids else None
    expected = Counter((rows[i][0], least[want["roots"][i]], want["links"][i]) for i in range(len(rows)))
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == expected


def test_documents_against_brute_force(spark, odd_docs, odd_rows, no_docs):
    _check(odd_rows, near_duplicates(odd_docs).collect())
    assert near_duplicates(no_docs).count() == 0


def test_large_group_of_near_copies_is_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PART", 8)
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(70):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    _check(rows, near_duplicates(docs).collect())


def test_one_row_of_each_class_is_kept(spark):
    base = [f"w{i}" for i in range(60)]
    near = lambda k: " ".join([*base[:-1], f"x{k}"])
    rows = [(1, near(0)), (None, near(1)), (1, near(2)), (1, near(0)), (None, "a b c d e f"), (None, "a b c d e f"), (None, None), (7, ""), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = near_duplicates(docs).collect()
    _check(rows, got)
    assert Counter((r.doc_id, r.class_id) for r in got if r.kept) == {(1, 1): 1, (None, None): 2, (7, 7): 2}
    stay = Counter((r.doc_id, r.text is not None and len(r.text) > 0) for r in first_of_each(docs).collect())
    assert stay == {(1, True): 1, (None, True): 1, (None, False): 1, (7, False): 1}


def test_first_of_each_keeps_one_row_a_class(spark, odd_docs, odd_rows):
    kept = first_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    roots = _brute(odd_rows)["roots"]
    assert ids == Counter({min(odd_rows[i][0] for i in range(len(odd_rows)) if roots[i] == root and odd_rows[i][0] is not None) if odd_rows[root][0] is not None else None: 1 for root in set(roots)})


def test_pruning_spares_pairs_at_the_threshold():
    needed = least_matches(0.8, 1e-6)
    rng = np.random.default_rng(0)
    draws = rng.random((20_000, 150)) < 0.8
    dropped = np.zeros(20_000, dtype=bool)
    for step, least in enumerate(needed, 1):
        dropped |= draws[:, : 15 * step].sum(axis=1) < least
    assert dropped.mean() < 1e-3
    far = rng.random((2_000, 150)) < 0.3
    assert (far[:, :60].sum(axis=1) < needed[3]).mean() > 0.95


def test_shared_grams():
    sets = [np.array(sorted(s), dtype=np.uint64) for s in ({1, 2, 3}, {2, 3, 4}, {9}, {1, 2, 3})]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    assert shared_grams(sets, at_once=2).tolist() == want
