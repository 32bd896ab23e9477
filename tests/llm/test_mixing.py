"""Mixing, spelling variants and periodic runs, held against plain Python."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.llm import mixing, queries, runs, spelling
from tests.llm.tables import SMALL, collected, tricky_texts, words


# ---- mixing

def levels(totals, weights, repeats):
    """Targets by handing the excess on until nothing is above its limit."""
    limit = {s: repeats * n for s, n in totals.items()}
    cut = set()
    while True:
        rest = sum(w for s, w in weights.items() if s not in cut)
        level = (sum(totals.values()) - sum(limit[s] for s in cut)) / rest if rest else 0
        more = {s for s in totals if s not in cut and limit[s] < level * weights[s]}
        if not more:
            return {s: float(limit[s]) if s in cut else level * weights[s] for s in totals}
        cut |= more


def highest_quotients(votes, limits, seats):
    won = dict.fromkeys(votes, 0)
    heap = [(-v, p) for p, v in votes.items() if v > 0 and limits[p] > 0]
    heapq.heapify(heap)
    while seats and heap:
        _, p = heapq.heappop(heap)
        won[p] += 1
        seats -= 1
        if won[p] < limits[p]:
            heapq.heappush(heap, (-votes[p] / (2 * won[p] + 1), p))
    return won


def key(*parts):
    return hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:16]


def mixed_by_hand(rows, cycle, repeats, seed, block):
    """(id, source, size, source_size, target, taken) of rows (id, source, text)."""
    order = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s))
    sized = [(i, order.index(s), len(words(t))) for i, s, t in rows]
    totals = {n: sum(z for _, m, z in sized if m == n) for n in range(len(order))}
    target = levels(totals, {n: float(cycle[n % len(cycle)]) for n in totals}, repeats) if sum(totals.values()) else dict.fromkeys(totals, 0.0)
    stream = defaultdict(list)
    for (i, n, z), copies in Counter(sized).items():
        for lot in range((copies - 1) // 64 + 1):
            stream[n].append((key(seed, "" if i is None else i, z, lot), str(i), z, lot, min(64, copies - 64 * lot), i))
    blocks = {n: (totals[n] + block - 1) // block for n in totals}
    some = [n for n in totals if totals[n]]
    votes = {n: target[n] * blocks[n] / totals[n] for n in some}
    won = highest_quotients(votes, {n: repeats * blocks[n] for n in some}, int(sum(votes.values()) + 0.5))
    out = []
    for n in totals:
        times = []
        if totals[n]:
            extra = sorted(range(blocks[n]), key=lambda b: key(seed, "block", n, 0, b))[:won[n] % blocks[n]]
            times = [won[n] // blocks[n]] * blocks[n]
            for b in extra:
                times[b] += 1
            times = [times[((w + 1) * blocks[n] - 1) // totals[n]] for w in range(totals[n])]
        at = 0
        for *_, z, _, copies, i in sorted(stream[n]):
            for _ in range(copies):
                out.append((i, order[n], z, totals[n], round(target[n], 6), sum(times[at:at + z])))
                at += z
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


def mixed(df):
    return collected(df.select("doc_id", "source", "size", "source_size", F.round("target", 6), "taken"))


def test_mix_on_awkward_rows(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice(["b", "é", "a", "Z", None, ""]), t) for i, t in tricky_texts()]
    rows += [(500, "tiny", "one two"), (501, "only blanks", "  "), (502, "nothing", None)] + [(600, "copies", "a b c d e")] * 150
    table = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumns(
        {"size": F.lit("x"), "target": F.lit(1), "at": F.lit(2), "id": F.lit(None).cast("int")}).repartition(6)
    for cycle, repeats, seed in (((5, 2, 1), 3, 0), ((1, 40), 2, 7)):
        made = mixing.mix(table, cycle, repeats, seed)
        assert mixed(made) == mixed_by_hand(rows, cycle, repeats, seed, mixing.BLOCK_WORDS)
        for r in made.collect():
            assert r.taken <= repeats * r.size and r.taken == r.times * r.size + sum(e.last - e.first + 1 for e in r.extra)
            assert all(0 <= e.first <= e.last < r.size for e in r.extra)
    again = mixing.mix(table.repartition(2).sortWithinPartitions(F.desc("doc_id")), (1, 40), 2, 7)
    assert mixed(again) == mixed(made)
    named = spark.createDataFrame([("a", 1.0), (None, 3.0)], "source string, weight double")
    found = mixing.mix(table, named, repeats=1000).groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect()
    taken = {r.source: r.n for r in found}
    assert taken["b"] == 0 and abs(taken[None] / taken["a"] - 3) < 0.02
    assert mixing.mix(table.limit(0)).count() == 0
    assert mixing.mix(table.filter("size(split(text, ' ')) < 0")).count() == 0
    assert {r.taken for r in mixing.mix(table.withColumn("text", F.lit(None).cast("string"))).collect()} == {0}


def test_mix_with_many_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    monkeypatch.setattr(mixing, "SHARD_ROWS", 10)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("source", F.expr("CASE WHEN doc_id % 3 = 0 THEN source ELSE 'hot' END"))
    made = mixing.mix(docs, block_words=4)
    rows = made.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("source_size").alias("n")).collect()
    assert all(abs(r.taken - r.target) <= 0.02 * r.target + 12 for r in rows) and max(r.n for r in rows) > 20_000
    assert made.filter("taken > 3 * size").count() == 0 and made.count() == 200


def test_apportionment_by_highest_quotients(spark):
    rng = random.Random(2)
    rows, seats, want = [], [], {}
    for group in range(12):
        parties = {p: rng.choice([1.0, 7.0, rng.random() * 100, 1e6]) for p in range(rng.randint(1, 40))}
        limits = {p: rng.choice([3, 100, 10_000]) for p in parties}
        n = rng.choice([0, 1, 17, 400])
        rows += [(group, p, v, limits[p]) for p, v in parties.items()]
        seats.append((group, n))
        want |= {(group, p): q for p, q in highest_quotients(parties, limits, n).items()}
    made = mixing.apportion(spark.createDataFrame(rows, "g long, p long, votes double, limit long"),
                            spark.createDataFrame(seats, "g long, seats long"), "g", "p", spare=1)
    assert {(r.g, r.p): r.quota for r in made.collect()} == want


# ---- spelling

def slipped_words(docs, least, every):
    count = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            word = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if every and h % every == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= least:
                count[word] += 1
    return count


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_by_hand(count, ratio):
    near = defaultdict(list)
    some = sorted(count)
    for i, a in enumerate(some):
        for b in some[i + 1:]:
            if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in some:
        best = min(near[w], key=lambda x: (-count[x], x), default=None)
        if best is not None and count[best] >= ratio * count[w]:
            form[w] = best
    out = []
    for w in some:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, count[w], len(near[w]), count[form[w]] if w in form else None))
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


def test_op12_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    count = {w: n for w, n in slipped_words(docs, 6, 199).items() if n >= 5}
    made = collected(queries.op12_spelling_variants(spark, SMALL))
    assert made == variants_by_hand(count, 5) and any(r[1] for r in made)


def test_runs_of_letters(spark, tricky):
    texts = tricky_texts() + [(900, "Éa-ÿ×÷Ā" + "x" * 300 + " ABC" * 3), (901, "ç" * 70)]
    more = tricky.unionByName(spark.createDataFrame(texts[-2:], "doc_id long, text string"), allowMissingColumns=True)
    for least, every in ((1, 0), (3, 2), (6, 3)):
        made = {r.word: r.n for r in spelling.count_runs(more, least, every).collect()}
        assert made == slipped_words(texts, least, every)


def test_variants_in_split_lists(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 7)
    rng = random.Random(4)
    count = {}
    for size in (4, 5, 6, 9, 14):
        for _ in range(60):
            w = "".join(rng.choice("abé") for _ in range(size))
            count[w] = rng.choice([1, 2, 5, 30, 30, 200])
            at = rng.randrange(size)
            count[w[:at] + rng.choice("abc") + w[at:]] = rng.choice([1, 6, 30])
    long = "".join(rng.choice("abcdefgh") for _ in range(300))
    count |= {long: 1, long[:200] + "x" + long[200:]: 7, long[:250] + "x" + long[251:]: 9, "z" * 80: 3}
    table = spark.createDataFrame(list(count.items()), "word string, n int").withColumn("key", F.lit(1)).repartition(4)
    for most in (1 << 17, 20):
        made = spelling.spelling_variants(table, 5, least_count=10, most_grams=most)
        assert collected(made) == variants_by_hand(count, 5)
    assert spelling.spelling_variants(table.limit(0)).count() == 0
    for bad in ("abc", None):
        with pytest.raises(Exception, match="too short"):
            spelling.spelling_variants(spark.createDataFrame([(bad, 1)], "word string, n int"))
    with pytest.raises(ValueError):
        spelling.spelling_variants(table, 1)


def every_edit(word, letters):
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in letters)
        if i < len(word):
            yield word[:i] + word[i + 1:]
            yield from (word[:i] + c + word[i + 1:] for c in letters if c != word[i])


def test_every_edit_leaves_a_common_list():
    rng = random.Random(5)
    for trial in range(60):
        letters = ("ab", "abc", "abcdefgh")[trial % 3]
        some = {"".join(rng.choice(letters) for _ in range(rng.randint(4, 14))) for _ in range(40)}
        count = Counter(w[p:p + q] for w in some for q in range(2, 6) for p in range(len(w) - q + 1))
        limit = rng.choice([0, 2, 5, 20])
        parts = spelling.Decomposition({g: n for g, n in count.items() if n > limit})

        def lists(word, group):
            found = parts.indexed(word, min(spelling.LONGEST, group // 2))
            return {("<", a, word[a:b]) for a, b in found} | {(">", len(word) - b, word[a:b]) for a, b in found}

        for word in some:
            for other in every_edit(word, letters):
                if len(other) >= 4:
                    group = min(len(word), len(other))
                    assert lists(word, group) & lists(other, group), (word, other)


def test_edits_of_padded_rows():
    rng = random.Random(6)
    some = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    chars, size = spelling._characters(pa.array(some))
    i, j = np.array([(i, j) for i in range(60) for j in range(60) if size[i] <= size[j]]).T
    want = [one_edit(some[a], some[b]) for a, b in zip(i, j)]
    assert spelling.one_edit(chars[i], chars[j], size[i], size[j]).tolist() == want
    assert [spelling._one_edit_of_long(some[a], some[b]) for a, b in zip(i, j)] == want


# ---- runs

def runs_by_hand(w, least):
    """Every maximal stretch of every distance that has no smaller period."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        at = 0
        while at + q < len(w):
            end = at
            while end + q < len(w) and w[end] == w[end + q]:
                end += 1
            length = end - at + q
            if end > at and length >= max(least, 2 * q):
                own = w[at:at + length]
                if not any(own[p:] == own[:length - p] for p in range(1, q)):
                    out.append((at, length, q))
            at = max(end, at) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(3)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 6)):
            letters, n = rng.choice([1, 2, 3, 5]), rng.randint(0, 60)
            w = [rng.randrange(letters) for _ in range(n)]
            if n and rng.random() < 0.5:
                start, period = rng.randrange(n), rng.randint(1, 8)
                for i in range(start + period, n):
                    w[i] = w[i - period]
            texts.append(w)
        least = rng.choice([2, 3, 6, 12])
        flat, counts = np.array([x for w in texts for x in w], np.int32), np.array([len(w) for w in texts], np.int64)
        assert runs.word_runs(flat, counts, least) == [runs_by_hand(w, least) for w in texts]


def test_long_runs():
    same, week = [0] * 200_000, [i % 7 for i in range(200_000)]
    found = runs.word_runs(np.array(same + week, np.int32), np.array([200_000, 200_000]), 12)
    assert found == [[(0, 200_000, 1)], [(0, 200_000, 7)]]


def test_collapsed_texts(tricky):
    renamed = tricky.withColumn("runs", F.lit(1)).withColumn("a.b", F.lit(2))
    made = runs.collapse_runs(renamed, 6)
    assert made.columns == [c for c in renamed.columns if c not in runs.RESULT] + list(runs.RESULT)
    rows = collected(made.select("doc_id", "n_words", F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "collapsed"))
    want = []
    for i, t in tricky_texts():
        w = words(t)
        found = runs_by_hand(w, 6) if len(w) < 1000 else []
        gone = {x for s, n, p in found for x in range(s + p, s + n)}
        want.append((i, len(w), [f"{s},{n},{p}" for s, n, p in found], " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert rows == sorted(want, key=lambda r: [(x is not None, x) for x in r])
    assert runs.collapse_runs(renamed.limit(0)).count() == 0
    other = runs.collapse_runs(tricky.withColumnRenamed("kept", "old").withColumnRenamed("text", "collapsed"), text_col="collapsed")
    assert other.columns.count("collapsed") == 1 and other.filter("n_words > 0").count() > 0


def test_op13_on_the_table(spark):
    want = []
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        w, h = words(r.text), zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        found = runs_by_hand(w, 12) if len(w) < 1500 else [x for x in runs.word_runs(
            np.unique(np.array(w), return_inverse=True)[1], np.array([len(w)]), 12)[0]]
        gone = {x for s, m, p in found for x in range(s + p, s + m)}
        best = min(((-m, s, p) for s, m, p in found), default=None)
        want.append((r.doc_id, len(found), *((best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4),
                     hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in found).encode()).hexdigest(),
                     hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    made = collected(queries.op13_periodic_runs(spark, SMALL))
    assert made == sorted(want, key=lambda r: [(x is not None, x) for x in r]) and sum(r[1] for r in made) > 10
