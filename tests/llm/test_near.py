"""Near-duplicates against brute force; components; plans of the pigeonhole search."""

import random

import numpy as np
import pyarrow as pa
import xxhash

from cellwise.llm import embedding, graph, shingles, simhash


def closure(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(50)] + [(100, 101 + i) for i in range(30)] + [(300, 301), (301, 300), (400, 400)]
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    pairs = [p for p in pairs if p[0] != p[1]]
    wanted = closure({n for p in pairs for n in p}, pairs)
    assert found == wanted


def test_simhash_matches_brute_force(docs):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abcdefghij") * rng.randrange(1, 5) for _ in range(n))
    rows = [(i, text(rng.randrange(1, 60))) for i in range(80)]
    rows += [(100 + i, (rows[i][1] * 3).replace("a", "A") + (" x" if i % 2 else "")) for i in range(20)]
    rows += [(200 + i, rows[80 + i][1]) for i in range(20)] + [(300, None), (301, ""), (302, "one two"), (302, "one two")]
    found = simhash.near_duplicates(docs(rows)).collect()
    assert len(found) == len(rows)
    prints = {}
    for key, t in rows:
        words = (t or "").lower().split()
        parts = [" ".join(words[p : p + 4]) for p in range(len(words) - 3)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        prints[key] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    keys = sorted(prints)
    pairs = [(a, b) for a in keys for b in keys if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    wanted = closure(keys, pairs)
    for row in found:
        assert row["fp"] % (1 << 64) == prints[row["doc_id"]] and row["component_id"] == wanted[row["doc_id"]]


def test_any_plan_finds_all_pairs_within_the_radius():
    rng = np.random.default_rng(1)
    base = rng.integers(1 << 63, size=300, dtype=np.uint64)
    flips = base.copy()
    for _ in range(4):
        flips ^= np.uint64(1) << rng.integers(64, size=300).astype(np.uint64)
    order = list(range(64))
    for n in (10, 10**6, 10**9, 10**12):
        partitions = simhash.plan(order, base, n)
        meets = np.zeros(300, bool)
        left, right = list(simhash.entries(base, partitions)), list(simhash.entries(flips, partitions))
        for own, other in ((left, right), (right, left)):
            index = {(i, v, f) for i, value, fp, indexed in own if indexed for v, f in zip(value.tolist(), fp.tolist(), strict=True)}
            other_of = dict(zip(*((base.tolist(), range(300)) if other is left else (flips.tolist(), range(300))), strict=True))
            mine = flips if other is left else base
            for i, value, fp, _ in other:
                for v, f in zip(value.tolist(), fp.tolist(), strict=True):
                    k = other_of[f]
                    meets[k] |= (i, v, int(mine[k])) in index
        assert meets.all()


def test_large_groups_are_cut_and_lose_nothing(spark):
    rows = spark.range(50).selectExpr("id as item", "0 as g")
    cells = graph.dealt_in_cells(rows, rows, ["g"], "item", limit=10).collect()
    met = {(a["item"], b["item"]) for a in cells for b in cells if (a["p"], a["q"]) == (b["p"], b["q"]) and (a["p"] == a["q"] or a["side"] != b["side"])}
    assert all((a, b) in met for a in range(50) for b in range(50) if a != b)


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 16))
    x = [(centres[i % 12] + 0.12 * rng.standard_normal(16)).tolist() for i in range(150)]
    x += [x[0], x[0], [2 * v for v in x[1]], None, [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [1.0, 2.0], []]
    rows = [(i, v, None if i == 5 else i % 2) for i, v in enumerate(x)] + [(None, x[3], 1)]
    found = {r["vec_id"]: r for r in embedding.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    good = {i: np.array(v) / np.linalg.norm(v) for i, v, label in rows if i is not None and label is not None and v and len(v) == 16 and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    pairs = [(a, b) for a in good for b in good if a < b and a % 2 == b % 2 and good[a] @ good[b] >= 0.93]
    ids = [i for i, _, _ in rows if i is not None]
    wanted = closure(ids, pairs)
    assert pairs and len(found) == len(rows)
    for i in ids:
        assert found[i]["n_links"] == sum(i in p for p in pairs), i
        assert found[i]["component_id"] == wanted[i] and found[i]["kept"] == (wanted[i] == i)
    assert found[None]["n_links"] == 0


def shingled(text, words=5):
    own = (text or "").lower().split()
    return {tuple(own[p : p + words]) for p in range(len(own) - words + 1)} or ({tuple(own)} if own else set())


def edited_copies(rng, n, copies):
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.choice([3, 8, 40, 100, 300]))]
        rows.append((i * 100, " ".join(own)))
        for c in range(copies):
            other = list(own)
            for _ in range(rng.randrange(1, 2 + len(own) // 40)):
                other[rng.randrange(len(own))] = rng.choice(words)
            rows.append((i * 100 + 1 + c, "\n".join(other).upper()))
    return rows


def test_shingles_match_brute_force(docs):
    rows = edited_copies(random.Random(12), 40, 7)
    rows += [(90_000, None), (90_001, " "), (90_002, "one two"), (90_002, "One two"), (90_003, "one two three four five six")]
    sets = {i: shingled(t) for i, t in rows}
    keys = sorted(sets)
    pairs = [(a, b) for a in keys for b in keys if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    far = [p for p in pairs if sets[p[0]] and len(sets[p[0]] & sets[p[1]]) < 0.9 * len(sets[p[0]] | sets[p[1]])]
    assert len(far) > 50
    wanted = closure(keys, pairs)
    found = shingles.near_duplicates(docs(rows)).collect()
    assert len(found) == len(rows) and all(r["component_id"] == wanted[r["doc_id"]] for r in found)


def test_the_pipeline_drops_near_copies(spark, docs):
    import corpus_pipeline as pipeline

    rng = random.Random(13)
    rows = [(i * 2, " ".join(f"w{rng.randrange(3000)}" for _ in range(100))) for i in range(60)]
    # Ninety-four of a hundred words are left, at one end or the other: a similarity of 0.88.
    rows += [(i + 1, " ".join(["x"] * 6 + t.split()[6:]) if i % 4 else t + " y" * 6) for i, t in rows]
    kept = pipeline.drop_near_duplicates(spark, docs(rows), "").collect()
    assert {r["doc_id"] for r in kept} == {i * 2 for i in range(60)}


def test_the_pipeline_drops_near_copies_of_any_id(spark, docs):
    """Rows that repeat an id, rows that repeat altogether and rows without an id are judged by their texts."""
    import corpus_pipeline as pipeline

    rng = random.Random(16)
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(100)) for _ in range(8)]
    near = [t + " y y" for t in texts]
    rows = [(1, texts[0]), (1, texts[0]), (1, near[0]), (2, near[0]), (2, texts[1]), (3, texts[1])]
    rows += [(None, texts[0]), (None, near[2]), (None, texts[2]), (None, texts[3]), (4, near[3]), (5, texts[4]), (5, texts[4])]
    rows += [(6, texts[5]), (6, texts[6]), (7, None), (7, ""), (8, " "), (9, texts[7])]
    kept = pipeline.drop_near_duplicates(spark, docs(rows), "")
    assert kept.columns == docs(rows).columns
    found = sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id in (2, 4, 5, 6, 9)").collect())
    assert found == sorted([(2, texts[1]), (4, near[3]), (5, texts[4]), (6, texts[5]), (6, texts[6]), (9, texts[7])])
    others = [(r["doc_id"], r["text"]) for r in kept.where("doc_id in (1, 3, 7, 8) or doc_id is null").collect()]
    assert len(others) == 3 and {i for i, _ in others} == {1, 7, None}
    assert dict(others)[1] in (texts[0], near[0]) and dict(others)[7] in (None, "") and dict(others)[None] in (texts[2], near[2])


def test_forests_join_what_all_pairs_join():
    rng = np.random.default_rng(3)
    for n, share in ((1, 0.1), (2, 0.0), (40, 0.05), (90, 0.1), (90, 0.25)):
        base = rng.integers(1 << 60, size=120)
        sets = [np.unique(np.where(rng.random(120) < share * rng.random(), rng.integers(1 << 60, size=120), base)) for _ in range(n)]
        first = np.append(0, np.cumsum([len(s) for s in sets]))
        pairs = [(i, j) for i in range(n) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])) - 1e-9]
        found = shingles.forest(np.concatenate(sets), first, 0.8)
        assert {tuple(sorted(p)) for p in found} <= {tuple(sorted(p)) for p in pairs}
        roots = closure(range(n), pairs)
        assert roots == closure(range(n), found) and len(found) == n - len(set(roots.values()))


def test_a_large_group_below_and_above_the_threshold(docs, monkeypatch):
    """Five hundred variants of one text, most pairs of them at a similarity of 0.5 to 0.8."""
    monkeypatch.setattr(shingles, "CELL_SETS", 60)
    rng = random.Random(14)
    words = [f"w{i}" for i in range(5000)]
    base = [rng.choice(words) for _ in range(200)]
    rows = []
    for i in range(500):
        own = list(base)
        for at in rng.sample(range(200), rng.choice([1, 3, 5, 8, 9, 10])):
            own[at] = rng.choice(words)
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, rows[i][1]) for i in range(200)]
    sets = {i: shingled(t) for i, t in rows}
    likeness = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    assert sum(0.5 <= v < 0.8 for v in likeness.values()) > len(likeness) / 2
    wanted = closure(sorted(sets), [p for p, v in likeness.items() if v >= 0.8 - 1e-9])
    found = {r["doc_id"]: r["component_id"] for r in shingles.near_duplicates(docs(rows)).collect()}
    assert found == wanted and len(set(found.values())) > 20


def test_fingerprints_give_candidates_and_the_sets_decide(docs, monkeypatch):
    """Without a band that two texts share, SimHash still finds what is near; a shared fingerprint alone links nothing."""
    rng = random.Random(15)
    rows = [(i * 2, " ".join(f"w{rng.randrange(3000)}" for _ in range(400))) for i in range(30)]
    rows += [(i + 1, t.upper() + " x") for i, t in rows]
    # Half the shingles and more are one and the same: equal fingerprints, sets far apart.
    rows += [(1000 + i, "a " * 400 + " ".join(f"w{rng.randrange(3000)}" for _ in range(100))) for i in range(2)]
    prints = dict(zip((i for i, _ in rows), simhash.prints_of(pa.array([t for _, t in rows]), 5).view(np.uint64), strict=True))
    near = [i * 2 for i in range(30) if np.bitwise_count(prints[i * 2] ^ prints[i * 2 + 1]) <= simhash.RADIUS]
    assert len(near) > 20 and prints[1000] == prints[1001]

    def apart(sets, first, n):
        return np.random.default_rng().integers(1 << 63, size=(len(first) - 1, n), dtype=np.int64).astype(np.uint64)

    monkeypatch.setattr(shingles, "band_keys", apart)
    found = {r["doc_id"]: r["component_id"] for r in shingles.near_duplicates(docs(rows)).collect()}
    assert all(found[i + 1] == i for i in near) and found[1001] == 1001


def test_empty_tables(spark, docs):
    assert shingles.near_duplicates(docs([])).count() == 0
    assert simhash.near_duplicates(docs([])).count() == 0
    assert embedding.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0
