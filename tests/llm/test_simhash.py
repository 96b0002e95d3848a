import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash as S
from tidemark.llm.common import connected_components

from .conftest import docs_of


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, radius):
    fps = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, f"{fps[i]:016x}", low.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


ROWS = [(4, None), (3, ""), (2, " \t\n"), (1, "one"), (9, "One"), (None, "one"), (None, "alone here now and then"), (5, "a b"),
        (6, "É x y"), (7, "é x y"), (7, "é x y"), (8, "w " * 100_000)]


def test_small_cases_match_brute_force(spark):
    assert got(S.components(docs_of(spark, ROWS))) == plain_components(ROWS, 2)


def test_wide_radius_and_small_tiles_lose_no_link(spark, monkeypatch):
    rows = [(i, f"{'lorem ipsum dolor sit amet' if i % 3 else 'sed do eiusmod'} word{i % 17} tail{i}") for i in range(300)]
    plain = plain_components(rows, 14)
    fps = S.fingerprints(docs_of(spark, rows)).select("fp").distinct()
    for tile in (7, 10_000):
        links = S.tile_links(fps, 14, tile)
        assert all(((a ^ b) & (1 << 64) - 1) >= 0 for a, b in links.collect())
        roots = {r.node: r.root for r in connected_components(links, "a", "b").collect()}
        signed = lambda h: int(h, 16) - (1 << 64) * (int(h, 16) >> 63)
        by_ours, by_plain = {}, {}
        for _, h, c in plain:
            by_ours.setdefault(roots.get(signed(h), signed(h)), set()).add(h)
            by_plain.setdefault(c, set()).add(h)
        assert sorted(map(sorted, by_ours.values())) == sorted(map(sorted, by_plain.values()))
        assert len(by_plain) < 250


def test_documents_match_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(S.components(docs_of(spark, rows))) == plain_components(rows, 2)


def test_deduplicate_keeps_the_smallest_id(spark):
    d = docs_of(spark, ROWS)
    kept = S.deduplicate(d)
    assert kept.columns == d.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    plain = plain_components(ROWS, 2)
    assert ids == sorted((d for d, _, c in plain if d == c), key=repr)


def test_empty_table(spark):
    assert S.components(docs_of(spark, [])).count() == 0 and S.deduplicate(docs_of(spark, [])).count() == 0


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[i] == 100 for i in range(100, 160)) and 200 not in got


@pytest.mark.parametrize("block", [3, 50, 5000])
def test_blocks_connect_what_the_whole_tile_does(block):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 12).astype(np.uint64)
    near = lambda n: np.unique(base[rng.integers(0, 12, n)] ^ (np.uint64(1) << rng.integers(0, 60, n).astype(np.uint64)))
    for left, right in ((near(200), None), (near(90), near(140)), (near(1), near(30)), (near(150)[:0], None)):
        nodes = left.tolist() if right is None else left.tolist() + right.tolist()
        pairs = [(a, b) for k, a in enumerate(nodes) for b in nodes[k + 1:] if (a ^ b).bit_count() <= 2
                 and (right is None or (a in set(left.tolist())) != (b in set(left.tolist())))]

        def parts(links):
            root = {n: n for n in nodes}

            def find(n):
                while root[n] != n:
                    n = root[n]
                return n
            for a, b in links:
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
            return {n: find(n) for n in nodes}

        x, y = S._forest(left, right, 2, block)
        assert len(x) < max(1, len(nodes)) and parts(zip(x.tolist(), y.tolist())) == parts(pairs)


def test_no_stage_of_the_tiles_needs_two_python_workers_a_task(spark, capsys):
    """A worker stays for the stages to come and takes their tables too."""
    S.tile_links(S.fingerprints(docs_of(spark, ROWS)).select("fp").localCheckpoint()).explain()
    stages = re.split("Exchange", capsys.readouterr().out)
    assert max(x.count("MapInArrow") for x in stages) == 1
