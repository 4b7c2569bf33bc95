import random

import numpy as np
import pytest

from tracemill.llm.p3_clusters import _cells, _components, _cones, _leaves, component_labels, group_profiles, near_traces, similar_groups, ward
from tracemill.llm.p10_level import _prepared, fit, level_profile, reading_levels, segments, top_level

SCORED = "score_id bigint, trace_id string, status string, scored_at timestamp, embedding array<float>"


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def scored(spark, vectors):
    rows = [(i, f"t{i}", "ok", None, None if v is None else [None if x is None else float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCORED)


def brute(vectors, least=0.95):
    """Groups of planted data: connected rows, all within ``least`` of each other."""
    u = unit(np.array(vectors))
    near = u @ u.T >= least
    out, seen = {}, set()
    for i in range(len(u)):
        if i in seen:
            continue
        own = set(np.flatnonzero(near[i]).tolist())
        assert all(near[a, b] for a in own for b in own)
        seen |= own
        out[i] = own
    return {(i, j) for i, own in out.items() for j in own if j != i}


def planted(rng, groups, singles, noise=0.02):
    vectors = []
    for size in groups:
        c = unit(rng.normal(size=32))
        vectors += [(c + rng.normal(size=32) * noise) * rng.uniform(0.1, 9) for _ in range(size)]
    vectors += list(rng.normal(size=(singles, 32)))
    rng.shuffle(vectors)
    return vectors


def test_groups_against_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = planted(rng, [2] * 60 + [3] * 30 + [9, 40], 3000)
    got = {(r["rep_id"], r["member_id"]) for r in near_traces(scored(spark, vectors)).collect()}
    expected = brute(vectors)
    assert len(got & expected) >= 0.99 * len(expected) and got <= expected


def test_a_hot_group_is_reduced_before_it_moves(spark):
    rng = np.random.default_rng(2)
    vectors = planted(rng, [2500], 3000)
    got = {(r["rep_id"], r["member_id"]) for r in near_traces(scored(spark, vectors).repartition(4)).collect()}
    assert got == brute(vectors)
    hot = unit(np.array(vectors)).astype(np.float32)
    assert len(np.unique(_leaves(hot, np.arange(len(hot)), 0.95))) < 3200


@pytest.mark.parametrize("rows", [20, 10_000])
def test_the_number_of_cells_does_not_matter(spark, monkeypatch, rows):
    """Thousands of cells and a single one find the same groups, just above the cosine too."""
    monkeypatch.setattr("tracemill.llm.p3_clusters.CELL_ROWS", rows)
    rng = np.random.default_rng(3)
    vectors = planted(rng, [2] * 200 + [3] * 100, 4000, 0.02)
    for _ in range(200):
        a = unit(rng.normal(size=32))
        side = rng.normal(size=32)
        side = unit(side - a * (side @ a))
        vectors += [a, np.cos(0.312) * a + np.sin(0.312) * side]
    got = {(r["rep_id"], r["member_id"]) for r in near_traces(scored(spark, vectors).repartition(4)).collect()}
    assert got == brute(vectors)


def test_crowded_cells_are_divided():
    rng = np.random.default_rng(4)
    crowd = unit(np.eye(32)[0] + rng.normal(size=(9000, 32)) * 0.05).astype(np.float32)
    copies = np.repeat(np.eye(32, dtype=np.float32)[:1], 5000, axis=0)
    for rows in (crowd, copies, crowd[:1], crowd[:0]):
        parts = list(_cells(rows, np.arange(len(rows))))
        assert sorted(np.concatenate(parts).tolist()) == list(range(len(rows))) and max(map(len, parts)) <= 2048


def test_odd_vectors_take_no_part(spark):
    v = [1.0] + [0.0] * 31
    vectors = [v, [2.0 * x for x in v], None, [0.0] * 32, v[:31], [None, *v[1:]], [float("nan"), *v[1:]], [float("inf"), *v[1:]], [-x for x in v]]
    rows = similar_groups(scored(spark, vectors)).collect()
    assert sorted((r["rep_id"], r["member_id"], round(r["centrality"], 6)) for r in rows) == [(0, 0, 1.0), (0, 1, 1.0)]


def test_chains_are_parted(spark):
    """Rows in a row, each near the next only: no group holds two that are too far apart."""
    angle = np.arccos(0.95) * 0.8
    vectors = [[np.cos(i * angle), np.sin(i * angle), *[0.0] * 30] for i in range(8)]
    rows = similar_groups(scored(spark, vectors)).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["rep_id"], []).append(vectors[r["member_id"]])
    assert groups and all((np.array(g) @ np.array(g).T).min() >= 0.95 - 1e-6 for g in groups.values())


def test_many_leaves_of_one_component_are_all_compared():
    """More leaves than one block holds: the survivors of different blocks are still the same group."""
    rng = np.random.default_rng(11)
    near = unit(np.eye(32)[0] + rng.normal(size=(3000, 32)) * 0.01)
    assert np.unique(_cones(near, np.ones(3000), np.arccos(0.95))).tolist() == [0]
    two = unit(np.concatenate([near[:1500], np.eye(32)[1] + rng.normal(size=(1500, 32)) * 0.01])[rng.permutation(3000)])
    assert len(np.unique(_cones(two, np.ones(3000), np.arccos(0.95)))) == 2
    turn = np.linspace(0, 2 * np.pi, 2500, endpoint=False)
    ring = np.stack([np.cos(turn), np.sin(turn)], 1)
    group = _cones(ring, np.ones(2500), np.arccos(0.95))
    assert all((ring[group == g] @ ring[group == g].T).min() >= 0.95 - 1e-6 for g in np.unique(group))


def test_large_components_keep_the_cosine(spark):
    """A fan of rows, each near the next: as one component of more than ``EXACT_ROWS`` rows its groups hold the cosine like small ones."""
    rng = np.random.default_rng(12)
    turn = rng.uniform(0, 1.2, 3000)
    fan = np.stack([np.cos(turn), np.sin(turn), *[np.zeros(3000)] * 30], 1)
    c, d = unit(rng.normal(size=(2, 32)))
    wide = [c + rng.normal(size=32) * 0.021 for _ in range(1500)] + [d + rng.normal(size=32) * 0.012 for _ in range(300)]
    vectors = unit(np.concatenate([fan, wide]))
    groups = {}
    for r in similar_groups(scored(spark, vectors)).collect():
        groups.setdefault(r["rep_id"], []).append(r["member_id"])
    members = [i for g in groups.values() for i in g]
    assert len(members) == len(set(members)) and all(k == min(g) for k, g in groups.items())
    assert all((vectors[g] @ vectors[g].T).min() >= 0.95 - 1e-5 for g in groups.values())
    assert len([i for i in members if i < 3000]) >= 2990 and len([g for g in groups.values() if min(g) < 3000]) <= 12
    assert max(len(g) for g in groups.values() if 3000 <= min(g) < 4500) >= 1300 and sum(min(g) >= 4500 for g in groups.values()) == 1


def expected_groups(vectors, least=0.95):
    """Ward over all rows at once: ``{rep: members}``."""
    u = unit(np.array(vectors))
    label = ward(u, np.ones(len(u)), u @ u.T >= least - 1e-6)
    return {int(g): np.flatnonzero(label == g).tolist() for g in np.unique(label) if (label == g).sum() > 1}


def found_groups(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["rep_id"], []).append(r["member_id"])
    return {k: sorted(g) for k, g in groups.items()}


@pytest.mark.parametrize("rows", [900, 1500])
def test_the_size_of_a_component_does_not_matter(spark, rows):
    """A cloud that is no single group: the same rule on both sides of ``EXACT_ROWS``, and nothing is left that could still merge."""
    rng = np.random.default_rng(13)
    vectors = unit(np.eye(32)[0] + rng.normal(size=(rows, 32)) * 0.03).astype(np.float32)
    groups = found_groups(similar_groups(scored(spark, vectors).repartition(3)).collect())
    assert groups == expected_groups(vectors.astype(float))
    near = unit(vectors.astype(float))
    near = near @ near.T >= 0.95
    parts = [*groups.values(), *([i] for i in set(range(rows)) - {i for g in groups.values() for i in g})]
    assert all(near[np.ix_(g, g)].all() for g in parts)
    assert not any(near[np.ix_(g, h)].all() for k, g in enumerate(parts) for h in parts[:k])


def test_large_single_groups_are_settled_alike(spark, monkeypatch):
    """Looked at in blocks first or not: the same groups and centralities."""
    rng = np.random.default_rng(14)
    c, d, e = unit(rng.normal(size=(3, 32)))
    turn = rng.uniform(0, 1.2, 150)
    parts = [c + rng.normal(size=(200, 32)) * 0.02, d + rng.normal(size=(200, 32)) * 0.026, np.repeat(e[None], 100, 0), np.stack([np.cos(turn), np.sin(turn), *[np.zeros(150)] * 30], 1)]
    # a pair in the middle of a single group that is just too far apart
    side = unit(rng.normal(size=32) * 1.0)
    mid = unit(rng.normal(size=32))
    side = unit(side - mid * (side @ mid))
    parts.append(np.stack([np.cos(t) * mid + np.sin(t) * side for t in (0.16, -0.16, *rng.uniform(-0.1, 0.1, 40))]))
    vectors = unit(np.concatenate(parts)).astype(np.float32)
    results = []
    for exact, block in ((100_000, 16384), (20, 30)):
        monkeypatch.setattr("tracemill.llm.p3_clusters.EXACT_ROWS", exact)
        monkeypatch.setattr("tracemill.llm.p3_clusters.BLOCK_ROWS", block)
        rows = similar_groups(scored(spark, vectors)).collect()
        assert found_groups(rows) == expected_groups(vectors.astype(float))
        results.append({r["member_id"]: round(r["centrality"], 9) for r in rows})
    assert results[0] == results[1]


def test_merging_in_rounds_is_merging_one_after_another(monkeypatch):
    """Held or compared once more, in one block or many: the clusters of ``ward``."""
    rng = np.random.default_rng(15)
    angle = np.arccos(0.95)
    for held, numbers in ((8192, 1 << 20), (0, 100), (20, 1)):
        monkeypatch.setattr("tracemill.llm.p3_clusters.HELD_CLUSTERS", held)
        monkeypatch.setattr("tracemill.llm.p3_clusters._HELD", numbers)
        for k in (1, 2, 7, 60, 150):
            x = unit(np.eye(5)[0] + rng.normal(size=(k, 5)) * 0.15)
            n = rng.integers(1, 5, k).astype(float)
            assert _cones(x, n, angle).tolist() == ward(x * n[:, None], n, x @ x.T >= np.cos(angle) - 1e-9).tolist()
        # equal costs everywhere
        copies = np.repeat(unit(np.array([[1, 0.0], [np.cos(0.2), np.sin(0.2)], [np.cos(0.4), np.sin(0.4)]])), 8, 0)
        group = _cones(copies, np.ones(24), angle)
        assert len(np.unique(group)) == 2 and all((copies[group == g] @ copies[group == g].T).min() >= 0.95 - 1e-6 for g in np.unique(group))


def test_profiles(spark):
    c = np.eye(32)[0]
    vectors = [c + np.eye(32)[1] * 0.2, c, c + np.eye(32)[2] * 0.1, np.eye(32)[5]]
    row = group_profiles(scored(spark, vectors), typical=2).first()
    assert (row["rep_id"], row["n"], row["typical"][0]) == (0, 3, 2) or row["typical"][0] == 1


def test_components_and_labels(spark):
    x = unit(np.array([[1, 0], [1, 0.1], [0, 1], [0.1, 1], [1, 1]], float)).astype(np.float32)
    assert _components(x, 0.99).tolist() == [0, 0, 2, 2, 4]
    chain = spark.createDataFrame([(i + 1, i) for i in range(1, 30)] + [(100, 90)], "a bigint, b bigint")
    labels = {r["id"]: r["label"] for r in component_labels(chain).collect()}
    assert labels == {i: 1 for i in range(1, 31)} | {100: 90, 90: 90}


def test_ward_merges_only_allowed_pairs():
    x = np.array([[0.0], [0.1], [0.2], [5.0]])
    allowed = np.abs(x - x.T) <= 0.15
    assert ward(x, np.ones(4), allowed).tolist() in ([0, 0, 2, 3], [0, 1, 1, 3])


# --- reading level ---------------------------------------------------------------------------

WORDS = {lang: {k: [f"{lang}{'abcd'[k]}{'xyzvw'[i]}o" for i in range(5)] + [f"{lang}q{i}" for i in ("u", "r")] for k in range(4)} for lang in ("e", "f")}


def text(rng, lang, level, n=8, other=None):
    out = []
    for i in range(n):
        k = other if other is not None and i < 2 else level
        out.append(" ".join(rng.choice(WORDS[lang][k]) for _ in range(9)) + ".")
    rng.shuffle(out)
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(7)
    docs, truth = [], {}
    for i in range(1200):
        lang, level = rng.choice("ef"), rng.randrange(4)
        docs.append((i, text(rng, lang, level, rng.randrange(3, 12) if rng.random() < 0.7 else 10, rng.choice([None, rng.randrange(4)]) if i % 3 == 0 else None)))
        truth[i] = level + 1
    labels = [(i, truth[i], "r1") for i in range(0, 1200, 12)] + [(0, min(4, truth[0] + 1), "r2"), (5, 9, "r3"), (6, None, "r4"), (None, 2, "r5")]
    extra = [(9001, None), (9002, ""), (9003, "  \n"), (9004, "12 + 3"), (9005, "zzz unknown words only")]
    return spark.createDataFrame(docs + extra, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, level int, rater string"), truth, dict(docs)


def test_levels_on_held_out_documents(corpus):
    docs, labels, truth, texts = corpus
    found = {r["doc_id"] for r in top_level(docs, labels).collect()}
    clear = {i: k for i, k in truth.items() if i % 12 and not (i % 3 == 0 and texts[i].count(".") < 6)}
    wrong = [i for i, k in clear.items() if (k == 4) != (i in found)]
    assert len(wrong) <= 0.01 * len(clear)
    assert not found & {9001, 9002, 9003, 9004, 9005}
    levels = {r["doc_id"]: r["whole"] for r in reading_levels(docs, labels).collect()}
    assert 9001 not in levels and 9003 not in levels
    close = [abs(levels[i] - k) < 0.6 for i, k in clear.items()]
    assert np.mean(close) > 0.95


def test_levels_without_labels(spark, corpus):
    docs, labels, *_ = corpus
    rows = reading_levels(docs, labels.limit(0))
    assert rows.filter("top OR level IS NOT NULL").count() == 0 and rows.count() > 1000


def test_segments():
    words, sizes = segments("One two. Three\n四五六。" + "w " * 120, {})
    assert sizes[:3] == [2, 1, 2] and sum(sizes) == len(words) and max(sizes) <= 50


def test_every_round_raises_the_likelihood(corpus):
    docs, labels, *_ = corpus
    history = []
    own, labelled = _prepared(docs, labels, "doc_id", "text", ["doc_id"])
    fit(own, labelled, 6, history)
    assert 2 <= len(history) <= 5 and all(b >= a for a, b in zip(history, history[1:]))


def test_repeated_rows_count_each_in_the_profile(spark, corpus):
    docs, labels, *_ = corpus
    own = docs.withColumn("source", (docs.doc_id % 3).cast("string"))
    once = {(r["source"], r["reading_level"]): r["n"] for r in level_profile(own, labels).collect()}
    twice = {(r["source"], r["reading_level"]): r["n"] for r in level_profile(own.unionByName(own), labels).collect()}
    assert sum(once.values()) > 1000 and sum(twice.values()) == 2 * sum(once.values())
