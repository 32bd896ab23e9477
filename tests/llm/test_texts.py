"""Operators on whole texts, held against plain Python or the tokenizer libraries."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pairloom.llm import blocks, decontaminate, orctokens, packing, piececache, queries, substrings, tokencount, vocab
from tests.llm.tables import SMALL, collected, tricky_texts, words

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def encoded(path, texts, end_id):
    return [e.ids + [end_id] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_pack_holds_every_id_once(tricky):
    made = packing.pack(tricky, WORD_BPE).collect()
    assert len({r.sequence_id for r in made}) == len(made) and {r.offset for r in made} == {0}
    assert all(r.length == 1 << r.bucket <= 2048 and len(r.ids) == 4 * r.length for r in made)
    texts = tricky_texts()
    want = sorted((str(i), np.array(ids, "<u4").tobytes()) for (i, _), ids in zip(texts, encoded(WORD_BPE, [t or "" for _, t in texts], 1)))
    whole, found = {}, []
    for r in sorted(made, key=lambda r: r.sequence_id):  # pieces of a document are neighbours
        if r.start == 0:
            whole = {"id": r.doc_id, "ids": b"", "n": r.doc_tokens}
        assert r.start * 4 == len(whole["ids"])
        whole["ids"] += r.ids
        if len(whole["ids"]) == 4 * whole["n"]:
            found.append((str(whole["id"]), whole["ids"]))
    assert sorted(found) == want


def test_piece_lengths():
    lengths, pieces = packing.piece_lengths(np.array([0, 1, 2048, 5000, 7]), 2048)
    assert lengths.tolist() == [1, 2048, 2048, 2048, 512, 256, 128, 8, 4, 2, 1] and pieces.tolist() == [0, 1, 1, 6, 3]
    assert lengths[2:8].sum() == 5000
    with pytest.raises(ValueError):
        packing.pack(None, WORD_BPE, longest=100)


def test_orc_round_trip(spark, tricky, tmp_path):
    path = str(tmp_path / "ids")
    orctokens.write_token_ids(tricky, path, BYTE_BPE)
    rows = sorted(orctokens.read_token_ids(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id is not None for r in rows[:2]] == [False, True]
    known = [r.doc_id for r in rows if r.doc_id is not None]
    assert known == sorted(known)
    before = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (before, len(r.ids))
        before += len(r.ids)
    texts = tricky_texts()
    want = sorted((str(i), ids) for (i, _), ids in zip(texts, encoded(BYTE_BPE, [t or "" for _, t in texts], 2)))
    assert sorted((str(r.doc_id), list(r.ids)) for r in rows) == want
    found = orctokens.find_documents(spark, path, [10, 20])
    assert sorted(r.doc_id for r in found.collect()) == [10, 20, 20]
    assert "PushedFilters: [In(doc_id, [10,20])]" in found._jdf.queryExecution().toString()


def test_token_counts(tricky):
    made = collected(tokencount.count_tokens(tricky, PIECES, limit=50).select("doc_id", "n_bytes", "n_tokens", "over_limit"))
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = [(i, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 50) for i, t in tricky_texts()]
    assert made == sorted(want, key=lambda r: [(x is not None, x) for x in r])


def removed_by_hand(texts, width):
    least = {}
    for i, t in texts:
        w = words(t)
        for at in range(len(w) - width + 1):
            if i is not None:
                key = tuple(w[at:at + width])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, t in texts:
        w = words(t)
        gone = set()
        for at in range(len(w) - width + 1):
            if i is not None and least[tuple(w[at:at + width])] < i:
                gone.update(range(at, at + width))
        out.append((i, len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone)))
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


@pytest.mark.parametrize("width", [5, 50])
def test_repeats_are_cut(tricky, width):
    made = substrings.remove_repeats(tricky, width, buckets=7)
    assert made.columns[:3] == ["doc_id", "text", "lang"] and made.columns[-4:] == list(substrings.RESULT)
    rows = made.select("doc_id", "n_words", "n_removed", "kept", "removed").collect()
    assert collected(made.select("doc_id", "n_words", "n_removed", "kept")) == removed_by_hand(tricky_texts(), width)
    for r in rows:
        assert sum(s.last - s.first + 1 for s in r.removed) == r.n_removed
        assert all(a.last + 1 < b.first for a, b in zip(r.removed, r.removed[1:]))
    same = substrings.remove_repeats(tricky, width, keep_unchanged=True).filter("n_removed = 0 AND text IS NOT NULL")
    assert same.filter("kept != text").count() == 0 and same.count() > 0


def test_op6_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in removed_by_hand(docs, 50)]
    assert collected(queries.op6_substring_dedup(spark, SMALL)) == want


ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return ITEM_WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def contamination_by_hand(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = fold(text)
        for at in range(max(len(w) - width, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[at:at + width]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w, hit, found = fold(text), set(), set()
        for size in sizes:
            for at in range(len(w) - size + 1):
                owners = windows.get(tuple(w[at:at + size]))
                if owners is not None:
                    hit.update(range(at, at + size))
                    found |= {str(x) for x in owners if x is not None}
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


def test_op7_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    made = collected(queries.op7_benchmark_decontamination(spark, SMALL))
    assert made == contamination_by_hand(docs, items) and any(r[-1] for r in made)


def test_contamination_in_blocks(spark, tricky):
    texts = tricky_texts()
    base = dict((i, t) for i, t in texts if i is not None)
    items = [(1, None), (2, ""), (3, "..."), (4, "Word, WORD!"), (10, " ".join(base[7].split()[5:30])), (11, base[7]), (11, base[7]),
             (None, "a b"), (9, "end"), (30, base[10].replace(" ", "--"))]
    table = spark.createDataFrame(items, "item_id long, text string")
    want = [r[:4] for r in contamination_by_hand(texts, items)]
    with pytest.raises(ValueError):
        decontaminate.find_contamination(tricky, table, most_bytes=600)
    for size in (None, 600):
        found = decontaminate.find_contamination(tricky, table, block_bytes=size, most_bytes=size or 1 << 20)
        rows = found.select("doc_id", "n_words", F.size("hits").cast("long"), F.size("item_ids").cast("long"))
        assert collected(rows) == want
    for r in found.filter("doc_id = 8").collect():
        assert all(r.text[h.start:h.end].lower() in fold(r.text) for h in r.hits) and len(r.hits) == 70
    empty = decontaminate.find_contamination(tricky, table.limit(0))
    assert empty.filter("size(hits) > 0").count() == 0 and empty.count() == len(texts)


@pytest.mark.parametrize("seed", range(6))
def test_automaton_finds_all_occurrences(seed):
    """Few different words, so that windows overlap, end in one another and fail to each other."""
    rng = random.Random(seed)
    line = lambda n: " ".join(rng.choice("abc" if seed % 2 else "abcdefgh") for _ in range(n))
    items = [(f"i{rng.randrange(20)}", line(rng.choice([1, 2, 3, 4, 9, 30]))) for _ in range(25)] + [("i3", ""), (None, line(12))]
    automaton = decontaminate.Automaton(items, 5)
    windows = {}
    for item, text in items:
        w = text.split()
        for at in range(max(len(w) - 5, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[at:at + 5]), set()).update({item} - {None})
    text = line(700).split()
    numbers = np.array([automaton.numbers.get(w.encode(), 0) for w in text], np.int32)
    made, held = [], set()
    for low, high, state in automaton.occurrences(numbers):
        made += zip(low.tolist(), high.tolist())
        held |= {(a, automaton.items[i]) for a, i in zip(*(x.tolist() for x in automaton.holders(low, state)))}
    want = [(a, a + n) for n in range(1, 6) for a in range(len(text) - n + 1) if tuple(text[a:a + n]) in windows]
    assert sorted(made) == sorted(want) and len(want) > 50
    assert held == {(a, i) for a, b in want for i in windows[tuple(text[a:b])]}


def test_many_items_in_one_automaton(spark):
    """3 MB of items: one automaton of bounded size, one scan of the documents."""
    rng = random.Random(4)
    vocabulary = [f"w{rng.randrange(10 ** 6)}" for _ in range(30_000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(40))) for i in range(11_000)]
    assert sum(len(t) for _, t in items) > 3e6
    automaton = decontaminate.Automaton([(str(i), t) for i, t in items], 10)
    assert automaton.edges.nbytes + automaton.fail.nbytes + automaton.last.nbytes <= 16 * 10 * 40 * len(items)
    docs = [(n, " ".join(rng.choice(vocabulary) for _ in range(200))) for n in range(60)]
    docs += [(100 + n, f"{t} , {items[n * 50][1].upper()} . {t}") for n, t in docs]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = decontaminate.find_contamination(table, spark.createDataFrame(items, "item_id long, text string"))
    assert found._jdf.queryExecution().toString().count("MapInArrow") == 4          # once in each of its four plans
    rows = found.select("doc_id", "n_words", F.size("hits").cast("long"), F.size("item_ids").cast("long"))
    assert collected(rows) == [r[:4] for r in contamination_by_hand(docs, items)]


def test_long_texts_are_scanned_whole(spark):
    """Texts above a slice and above an Arrow batch."""
    line = "one two three four five six seven eight nine ten eleven"
    docs = [(1, ("x " * 1_500_000) + line), (2, line + (" yy" * 6_000_000) + " " + line), (3, "z"), (4, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.find_contamination(table, spark.createDataFrame([("a", line)], "item_id string, text string"))
    rows = {r.doc_id: r for r in found.collect()}
    assert [(rows[n].n_words, len(rows[n].hits)) for n in (1, 2, 3, 4)] == [(1_500_011, 11), (6_000_022, 22), (1, 0), (0, 0)]
    assert all(docs[n - 1][1][h.start:h.end] in line.split() for n in (1, 2) for h in rows[n].hits)


def test_empty_tables(spark, tricky, tmp_path):
    none = tricky.limit(0)
    assert packing.pack(none, WORD_BPE).count() == 0 and tokencount.count_tokens(none, PIECES).count() == 0
    assert substrings.remove_repeats(none).count() == 0
    orctokens.write_token_ids(none, str(tmp_path / "none"), BYTE_BPE)
    assert orctokens.read_token_ids(spark, str(tmp_path / "none")).count() == 0


def test_cache_tells_pieces_of_one_hash_apart(monkeypatch):
    monkeypatch.setattr(piececache, "byte_hashes", lambda data, starts, ends: np.minimum(ends - starts, 2).astype(np.uint64))
    cache = piececache.PieceCache(lambda pieces: (np.array([int(p) for p in pieces], np.uint32), np.arange(len(pieces)),
                                                  np.ones(len(pieces), np.int64)), limit=8)
    for numbers in ([7, 7, 12, 345, 12], [6, 98765, 7, 11], []):
        data = np.frombuffer("".join(map(str, numbers)).encode(), np.uint8)
        size = np.array([len(str(n)) for n in numbers], np.int64)
        begin, _ = cache.find(data, np.cumsum(size) - size, np.cumsum(size))
        assert cache.pool[begin].tolist() == numbers


def test_window_hashes_are_polynomials_modulo_the_prime():
    values = np.random.default_rng(5).integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
    values[300:400] = values[100:200]
    hashes, first = blocks.window_hashes(values, np.array([250, 250]), 20)
    where = dict(zip(first.tolist(), hashes.tolist()))
    want = {i: tuple(values[i:i + 20].tolist()) for i in where}
    assert len(where) == 2 * 231 and len(set(where.values())) == len(set(want.values()))
    assert all(where[i] == where[i + 200] for i in range(100, 181))
    a, b = blocks.times(values % np.uint64(blocks.PRIME), values[0] % np.uint64(blocks.PRIME)), values.tolist()
    assert a.tolist() == [x * b[0] % blocks.PRIME for x in b]


def test_packing_digest(spark):
    rows = queries.op4_power_of_two_packing(spark, SMALL).filter("doc_id = 3 AND start = 0").collect()
    text = spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id = 3").first().text
    ids = encoded(WORD_BPE, [text], 1)[0]
    assert rows[0].ids_crc32 == zlib.crc32(np.array(ids[:rows[0].length], "<u4")) and rows[0].doc_tokens == len(ids)


def test_a_worker_keeps_its_stock_of_words():
    vocab._caches.clear()
    cache, asked = vocab.word_cache(WORD_BPE), []

    def encode(pieces):
        asked.append(len(pieces))
        return np.arange(len(pieces), dtype=np.uint32), np.arange(len(pieces)), np.ones(len(pieces), np.int64)

    cache.encode = encode
    size = np.full(200_000, 7, np.int64)
    for low in (1_000_000, 1_200_000, 1_400_000, 1_000_000):   # the first words come again behind 400,000 others
        data = np.frombuffer("".join(map(str, range(low, low + 200_000))).encode(), np.uint8)
        cache.find(data, np.cumsum(size) - size, np.cumsum(size))
    vocab._caches.clear()
    assert asked == [200_000] * 3
