"""SimHash near-duplicates against comparing every pair."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_fixtures import docs  # noqa: F401
from admetrics.llm import simhash
from admetrics.llm.components import components


def brute_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, bits):
    names = {i: i for i in range(len(rows))}

    def root(i):
        while names[i] != i:
            i = names[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= bits:
                names[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [least.get(root(i)) for i in range(len(rows))]


def test_every_word_has_one_home():
    low, high, _, counts, _, excess = simhash._cosets(0)
    assert counts.tolist() == [1] * 2048 and not excess.any()


@pytest.mark.parametrize("paired", [False, True])
def test_linked_pairs_meet_at_a_home(paired):
    rng = random.Random(3)
    for _ in range(150):
        a = rng.getrandbits(64)
        b = a
        for i in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << i
        cells = [Counter(), Counter()]
        for k, fp in enumerate((a, b)):
            for cell, _, home in simhash.anchors(np.array([fp], np.uint64), 4, paired):
                cells[k].update({c: 1 + h for c, h in zip(cell.tolist(), home.tolist())})
        assert any(cells[0][c] == 2 for c in cells[0].keys() & cells[1].keys())


@pytest.mark.parametrize("paired,tile", [(False, simhash.TILE), (True, simhash.TILE), (False, 7), (True, 3)])
def test_links_equal_all_pairs(spark, paired, tile):
    rng = random.Random(5)
    fps = set()
    for _ in range(60):
        seed = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 12])):
            fps.add(seed)
            for i in rng.sample(range(64), rng.randint(0, 5)):
                seed ^= 1 << i
    fps = sorted(fps)
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    frame = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    found = {r.fp: r.root for r in simhash.classes(frame, 4, paired, tile).collect()}
    groups = [found.get(x, x) for x in signed]
    want = brute_components(list(enumerate(fps)), 4)
    assert len(set(zip(groups, want))) == len(set(groups)) == len(set(want))


def test_query_on_odd_texts(spark, docs):  # noqa: F811
    base = "the cat sat on the mat and looked at a dog that ran over there by the old river bank".split()
    near = [" ".join(base[:i] + ["X"] + base[i + 1 :]) for i in range(len(base))]
    texts = [None, "", " \n\t", "One", "one", "one two three", "ONE two\tthree", "É é", "a " * 5000, "b" * 100_000, *near, " ".join(base), " ".join(base).upper()]
    rows = [(100 - i, t) for i, t in enumerate(texts)] + [(None, "one"), (3, " ".join(base)), (3, " ".join(base)), (None, "quite alone here now then")]
    found = simhash.near_duplicates(docs(*rows)).collect()
    want = [(d, brute_fingerprint(t)) for d, t in rows]
    classes = brute_components(want, 4)
    expected = Counter((d, f"{fp:016x}", c) for (d, fp), c in zip(want, classes))
    assert Counter(map(tuple, found)) == expected
    assert simhash.near_duplicates(docs().limit(0)).count() == 0


def test_keep_one(spark, docs):  # noqa: F811
    rows = [(4, "same words in here"), (2, "same words in here"), (None, "same words in here"), (9, "all other text that stands"), (9, "all other text that stands"), (None, None), (None, "")]
    extra = docs(*rows).selectExpr("doc_id", "text", "'k' AS row", "1 AS key", "2 AS h1", "3 AS fp")
    kept = simhash.keep_one(extra)
    assert kept.columns == extra.columns
    assert sorted((r.doc_id for r in kept.where("text != ''").collect())) == [2, 9]
    assert kept.where("coalesce(text, '') = ''").count() == 1


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.node: r.root for r in components(frame).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
