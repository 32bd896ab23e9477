"""Similarity joins and components, held against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import components, egojoin, jaccard, queries
from tests.llm.tables import SMALL, collected, tricky_texts


def least_reachable(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k, 0) + 1)} if w else set()


def classes_by_hand(docs, k, percent):
    sets = [shingles(t, k) for _, t in docs]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    shared = {}
    for own in holders.values():
        for x, i in enumerate(own):
            for j in own[x + 1:]:
                shared[i, j] = shared.get((i, j), 0) + 1
    links = [(i, j) for (i, j), n in shared.items() if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n)]
    roots = least_reachable(len(docs), links)
    least = {}
    for (doc, _), r in zip(docs, roots):
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    rows = [(doc, len(s), doc if not s else least.get(r)) for (doc, _), s, r in zip(docs, sets, roots)]
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


@pytest.mark.parametrize("k,percent", [(5, 80), (2, 60), (4, 85)])
def test_classes_of_tricky_texts(tricky, k, percent):
    made = jaccard.similarity_classes(tricky, k, percent, buckets=3).select("id", "n_shingles", "component_id")
    assert collected(made) == classes_by_hand(tricky_texts(), k, percent)


def test_op8_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert collected(queries.op8_ngram_jaccard_join(spark, SMALL)) == classes_by_hand(docs, 4, 85)


def drifting(seed):
    """Families whose members drift away from each other, so that pivots answer, bound and leave open."""
    rng = random.Random(seed)
    docs = []
    for family in range(6):
        text = [f"w{rng.randrange(10_000)}" for _ in range(rng.choice([20, 60, 150]))]
        for _ in range(rng.choice([3, 30, 60])):
            text = list(text) if rng.random() < 0.7 else text[:-1] + [f"t{rng.randrange(99)}"]
            for _ in range(rng.choice([0, 0, 1, 2])):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10_000)}"
            if rng.random() < 0.2:
                text = text + [f"y{rng.randrange(10_000)}" for _ in range(rng.randrange(12))]
            docs.append((len(docs), " ".join(text)))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_drifting_families(spark, monkeypatch, seed):
    docs = drifting(seed)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(jaccard, "CHUNK", 5)
    made = jaccard.similarity_classes(table, 3, 80, buckets=4).select("id", "n_shingles", "component_id")
    assert collected(made) == classes_by_hand(docs, 3, 80)


def test_one_of_each(spark, tricky):
    found = jaccard.similarity_classes(tricky, 5, 80)
    kept = jaccard.one_of_each(tricky, found)
    assert kept.columns == tricky.columns
    want = {r[2] for r in classes_by_hand(tricky_texts(), 5, 80) if r[2] is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want)


def test_no_documents(tricky):
    assert jaccard.similarity_classes(tricky.limit(0)).count() == 0


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)], [(50, i) for i in range(50)],
    [(i, i + 7) for i in range(80)] + [(200, 201), (None, 3)],
])
def test_components(spark, links):
    made = components.components(spark.createDataFrame(links, "a long, b long"))
    groups = {}
    for r in made.collect():
        groups.setdefault(r.root, set()).add(r.id)
    real = [(a, b) for a, b in links if a is not None and a != b]
    roots = least_reachable(300, real)
    want = {}
    for x in {x for link in real for x in link}:
        want.setdefault(roots[x], set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_prefix_and_bounds():
    sizes = np.arange(1, 400)
    for percent in (60, 80, 85):
        length = jaccard.prefix_length(sizes, percent)
        assert (length == [s - -(-s * percent // 100) + 1 for s in sizes.tolist()]).all() and length.min() == 1
    assert jaccard.may_link(10, 0, 10, 0, 100) and not jaccard.may_link(10, 1, 10, 0, 100) and not jaccard.may_link(8, 0, 10, 0, 85)


def vectors_by_hand(rows, least):
    unit = []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    links = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
             if unit[i] is not None and unit[j] is not None and float(unit[i] @ unit[j]) >= least]
    count = [0] * len(rows)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    roots = least_reachable(len(rows), links)
    low = {}
    for (x, _), r in zip(rows, roots):
        if x is not None:
            low[r] = min(low.get(r, x), x)
    out = [(x, n, low.get(r), x is not None and low.get(r) == x) for (x, _), n, r in zip(rows, count, roots)]
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


@pytest.mark.parametrize("block,fan", [(512, 16), (8, 2)])
def test_vectors(spark, monkeypatch, block, fan):
    rng = np.random.default_rng(block)
    base = rng.standard_normal((25, 12))
    rows = [(i, (base[i % 25] + rng.standard_normal(12) * rng.choice([0, 0.1, 0.25, 0.5])).tolist()) for i in range(300)]
    odd = [None, [], [0.0] * 12, [float("nan")] + [1.0] * 11, [float("inf")] + [1.0] * 11, [None] + [1.0] * 11]
    rows += [(400 + i, v) for i, v in enumerate(odd)] + [(None, rows[0][1]), (None, [5.0] + [0.0] * 11), (7, rows[7][1]), (7, rows[9][1])]
    rows += [(500 + i, [1e-200] * 12) for i in range(3)] + [(600 + i, rows[3][1]) for i in range(60)]
    monkeypatch.setattr("pairloom.llm.egojoin.BLOCK", block)
    monkeypatch.setattr("pairloom.llm.egojoin.PART", min(block, 4))
    monkeypatch.setattr("pairloom.llm.egojoin.FAN", fan)
    monkeypatch.setattr("pairloom.llm.egojoin.SHIPPED", fan)
    monkeypatch.setattr("pairloom.llm.egojoin.CHUNK", 10 * block)
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, n long, root string").repartition(4)
    want = vectors_by_hand([(i, [x * 1e200 for x in v] if v and v[0] == 1e-200 else v) for i, v in rows], 0.95)
    assert collected(egojoin.near_duplicates(table, 0.95)) == want


def test_boxes_bound_distances():
    """Norms on the axes that do not lead part vectors which the leading axes cannot, and never two that link."""
    rng = np.random.default_rng(2)
    axes = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    for scale in (1e-9, 0.3, 1, 20):
        weights = np.where(np.arange(40) < egojoin.AXES, 1, scale)
        a, b = (egojoin._unit((rng.standard_normal((5, 40)) * weights + rng.standard_normal(40) * weights * 3) @ axes.T) for _ in range(2))
        (low_a, high_a), (low_b, high_b) = egojoin._box(a, axes), egojoin._box(b, axes)
        gap = np.maximum(np.maximum(low_a - high_b, low_b - high_a), 0)
        assert len(gap) == egojoin.AXES + 1
        assert (gap * gap).sum() <= ((a[:, None] - b[None]) ** 2).sum(axis=2).min() * (1 + 1e-9) + 1e-12


def test_op9_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert collected(queries.op9_embedding_near_dedup(spark, SMALL)) == vectors_by_hand(rows, 0.95)


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert egojoin.near_duplicates(none).count() == 0
    zero = spark.createDataFrame([(2, [0.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in egojoin.near_duplicates(zero).collect()] == [(2, 0, 2, True)]


def test_least_hits_is_a_bound(spark):
    """Sets that link share at least so many shingles of their prefixes, in any order of the shingles."""
    rng = random.Random(3)
    rows = []
    for percent in (60, 80, 85):
        for _ in range(300):
            base = rng.sample(range(10_000), rng.randint(1, 120))
            lost = rng.choice([0, 0.02, 0.05, 0.1])
            a = {x for x in base if rng.random() > lost} or {1}
            b = {x for x in base if rng.random() > lost} | set(rng.sample(range(10_000, 20_000), rng.randint(0, 6)))
            if 100 * len(a & b) >= percent * len(a | b):
                front = [sorted(s)[:int(jaccard.prefix_length(np.array(len(s)), percent))] for s in (a, b)]
                rows.append((percent, len(a), len(b), len(set(front[0]) & set(front[1]))))
    table = spark.createDataFrame(rows, "percent int, a int, b int, hits int")
    for percent in (60, 80, 85):
        some = table.filter(F.col("percent") == percent).withColumn("least", jaccard.least_hits("a", "b", percent))
        assert some.count() > 50 and some.filter("hits < least").count() == 0 and some.filter("least > 1").count() > 0


def test_two_chunks_of_a_family():
    """What two chunks link through the differences connects what the sets themselves link."""
    rng = random.Random(3)
    for trial in range(60):
        base = np.unique(np.array([rng.randrange(1 << 60) for _ in range(40)], np.uint64))

        def variant():
            kept = [x for x in base.tolist() if rng.random() > rng.choice([0.02, 0.1, 0.15])]
            return np.unique(np.array(kept + [rng.randrange(8) for _ in range(rng.choice([0, 2, 5]))], np.uint64))

        members = {n: variant() for n in rng.sample(range(2, 1000), 12)}
        pivot = 1 if trial % 2 else 500_000
        links, families, inside = [], [], [pivot]
        for part in (list(members)[:7], list(members)[7:]):
            family = jaccard._Family(pivot, base, 85)
            for name in sorted(part):
                family.add(name, members[name])
            inside += [family.rows[i][0] for i in family.members]
            links += [(r[0], r[3]) for r in family.answers() if r[3] is not None]
            families.append(family)
        if all(f.members for f in families):
            links += jaccard.cross_links(pivot, families[0].block(), families[1].block(), 85)
        sets = {n: set((base if n == pivot else members[n]).tolist()) for n in inside}
        true = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]

        def groups(edges):
            label = {n: n for n in sets}
            for _ in sets:
                for a, b in edges:
                    if a in label and b in label:
                        label[a] = label[b] = min(label[a], label[b])
            return label

        assert groups(links) == groups(true)
