"""Language of texts by interpolated Kneser-Ney character models.

A word is read as characters after a run of blanks, closed by one blank; the model of a language gives each
character its probability after the characters before it. N-gram counts are taken in Spark from a
bounded sample of each language, the discounted shares of each language are stored in arrays of its own, sorted by hash, and a text
gets the language of the lowest cross-entropy per character. Held-back texts of the sample calibrate the
score and the rejection.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field as made

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pairloom.llm.blocks import byte_hashes, column_bytes, mix, slices, sums, words
from pairloom.llm.piececache import PieceCache
from pairloom.llm.ship import cleared, prepare, tidy
from pairloom.session import scratch, stage

ORDER = 5
#: Distinct characters that the uniform distribution below the single characters shares out.
ALPHABET = 1 << 17
_SALT = [np.uint64(0x9FB21C651E98DF25 * (n + 1) % (1 << 64)) for n in range(ORDER + 1)]

_caches: dict[str, PieceCache] = cleared({})


#: Sorted hashes and a value for each.
Sorted = tuple[np.ndarray, np.ndarray]


@dataclass
class Model:
    """For each language and each order, shares of n-grams and left-over mass of contexts: 12 bytes for each that the language has."""

    languages: list[str]
    shares: list[list[Sorted]] = made(default_factory=list)
    left_over: list[list[Sorted]] = made(default_factory=list)
    limits: np.ndarray | None = None
    sharpness: float = 1.0


def characters(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the lower-cased words, each after ORDER - 1 blanks and before one; their positions; letters?"""
    texts = [p.decode("utf-8").lower() for p in pieces]
    pad = " " * (ORDER - 1)
    points = np.frombuffer("".join([f"{pad}{t} " for t in texts]).encode("utf-32-le"), np.uint32)
    size = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(size + ORDER - 1) - size
    at = np.arange(int(size.sum())) + np.repeat(starts - (np.cumsum(size) - size), size)
    letters = np.array([any(map(str.isalpha, t)) for t in texts], bool)
    return points, at, np.stack([size, letters])


def gram_hashes(points: np.ndarray, at: np.ndarray, first: int, last: int) -> np.ndarray:
    """Hashes of the characters from ``at - first`` to ``at - last``, both included."""
    out = np.full(len(at), _SALT[max(first - last + 1, 0)])
    for back in range(first, last - 1, -1):
        out = mix(out ^ points[at - back].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams of every order in (lang, text): full, without the last, without the first, without both."""
    names = ["lang", "n", "gram", "context", "tail", "middle", "times"]
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        data, offsets = column_bytes(batch.column(1))
        for low, high in slices(offsets):
            begin = offsets[low]
            some, edges = data[begin:offsets[high]], offsets[low:high + 1] - begin
            starts, ends, number = words(some, edges)
            own = np.repeat(langs[low:high], number)
            hashes = byte_hashes(some, starts, ends)
            body = some.tobytes()
            for lang in sorted(set(langs[low:high])):
                mine = np.flatnonzero(own == lang)
                if not len(mine):
                    continue
                _, first, times = np.unique(hashes[mine], return_index=True, return_counts=True)
                pick = mine[first]
                points, at, info = characters([body[a:b] for a, b in zip(starts[pick].tolist(), ends[pick].tolist())])
                weight = np.repeat(times, info[0])
                for n in range(1, ORDER + 1):
                    full = gram_hashes(points, at, n - 1, 0)
                    grams, index, which = np.unique(full, return_index=True, return_inverse=True)
                    sites = at[index]
                    columns = [gram_hashes(points, sites, n - 1, 1), gram_hashes(points, sites, n - 2, 0), gram_hashes(points, sites, n - 2, 1)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(grams)), pa.array(np.full(len(grams), n, np.int32)),
                        *[pa.array(c.view(np.int64)) for c in (grams, *columns)],
                        pa.array(np.bincount(which, weight).astype(np.int64)),
                    ], names=names)


def kneser_ney(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shares of n-grams and left-over mass of contexts, from counted n-grams of every order.

    Below the highest order an n-gram counts the distinct characters before it, not its occurrences.
    """
    highest = grams.filter(F.col("n") == ORDER).select("lang", "n", "gram", "context", F.col("times").alias("a"))
    lower = (
        grams.filter(F.col("n") > 1)
        .groupBy("lang", (F.col("n") - 1).alias("n"), F.col("tail").alias("gram"), F.col("middle").alias("context"))
        .agg(F.count(F.lit(1)).alias("a"))
    )
    adjusted = highest.unionByName(lower)
    discounts = adjusted.groupBy("lang", "n").agg(
        F.sum((F.col("a") == 1).cast("long")).alias("ones"), F.sum((F.col("a") == 2).cast("long")).alias("twos"))
    discounts = discounts.select("lang", "n", F.when(F.col("ones") > 0, F.greatest(
        F.lit(0.1), F.col("ones") / (F.col("ones") + 2 * F.col("twos")))).otherwise(F.lit(0.5)).alias("d"))
    contexts = adjusted.groupBy("lang", "n", "context").agg(F.sum("a").alias("total"), F.count(F.lit(1)).alias("kinds"))
    contexts = contexts.join(discounts, ["lang", "n"])
    d = F.least(F.col("d"), F.lit(0.95))
    left = contexts.select("lang", "n", "context", (d * F.col("kinds") / F.col("total")).alias("left"))
    shares = adjusted.join(contexts, ["lang", "n", "context"]).select(
        "lang", "n", "gram", ((F.col("a") - d) / F.col("total")).alias("share"))
    return shares, left


def sorted_arrays(rows: pa.Table, key: str, value: str, languages: list[str]) -> list[list[Sorted]]:
    """For each language and each order its hashes, sorted, and their values."""
    own = pc.index_in(rows.column("lang"), pa.array(languages, pa.string())).to_numpy().astype(np.int64)
    group = own * ORDER + rows.column("n").to_numpy() - 1
    hashes, values = rows.column(key).to_numpy().view(np.uint64), rows.column(value).to_numpy().astype(np.float32)
    order = np.lexsort((hashes, group))
    cuts = np.searchsorted(group[order], np.arange(len(languages) * ORDER + 1))
    parts = [order[low:high] for low, high in zip(cuts, cuts[1:])]
    tables = [(hashes[part], values[part]) for part in parts]
    return [tables[at:at + ORDER] for at in range(0, len(tables), ORDER)]


def _look_up(table: Sorted, wanted: np.ndarray, default: float) -> np.ndarray:
    keys, values = table
    out = np.full(len(wanted), default)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        found = keys[at] == wanted
        out[found] = values[at[found]]
    return out


def word_scores(model: Model, pieces: list[bytes]) -> np.ndarray:
    """For each word: log probability in each language, characters, and whether it has a letter.

    A character's probability depends on the longest n-gram that ends with it, so each of these is looked up once.
    """
    points, at, info = characters(pieces)
    _, first, which = np.unique(gram_hashes(points, at, ORDER - 1, 0), return_index=True, return_inverse=True)
    sites = at[first]
    wanted = [(gram_hashes(points, sites, n, 0), gram_hashes(points, sites, n, 1)) for n in range(ORDER)]
    out = np.empty((len(pieces), len(model.languages) + 2), np.float32)
    for lang, (shares, left_over) in enumerate(zip(model.shares, model.left_over)):
        p = np.full(len(sites), 1.0 / ALPHABET)
        for n, (gram, context) in enumerate(wanted):
            p = _look_up(shares[n], gram, 0.0) + _look_up(left_over[n], context, 1.0) * p
        out[:, lang] = sums(np.log(p)[which], info[0])
    out[:, -2:] = info.T
    return out


def entropies(model: Model, name: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per character of each text in each language, and whether the text has a letter."""
    if name not in _caches:
        _caches.clear()

        def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            rows = np.concatenate([word_scores(model, pieces[i:i + 50_000]) for i in range(0, len(pieces), 50_000)])
            width = np.full(len(rows), rows.shape[1], np.int64)
            return rows.view(np.uint32).ravel(), np.cumsum(width) - width, width

        _caches[name] = PieceCache(encode, 300_000)
    cache = _caches[name]
    starts, ends, number = words(data, offsets)
    begin, _ = cache.find(data, starts, ends)
    pool = cache.pool.view(np.float32)
    columns = [sums(pool[begin + j].astype(np.float64), number) for j in range(len(model.languages) + 2)]
    size = np.maximum(columns[-2], 1)
    return np.stack([-c / size for c in columns[:-2]], axis=1), columns[-1] > 0


def fit(docs: DataFrame, text: Column, lang: Column, docs_per_language: int = 2000, most_docs: int = 40_000) -> Model:
    """Fit on about ``docs_per_language`` whole texts of each language, chosen by a hash of the text.

    All languages are learned. ``most_docs`` bounds the texts of all languages together: with many of them each has fewer (but
    two, on average, if it has as many). Equal texts of a language count once.

    A fifth of the sample is held back from the counts and calibrates score and rejection.
    Rows with a null language or text are left out. If no labelled text has a word, the model knows no language.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(lang.cast("string").alias("lang"), text.cast("string").alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = stage(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("size")), "languages")
    languages = sorted(r.lang for r in sizes.select("lang").collect())
    if not languages:
        return Model([])
    each = max(2, min(docs_per_language, most_docs // len(languages)))
    unit = lambda salt: F.pmod(F.xxhash64(F.lit(salt), "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.join(F.broadcast(sizes), "lang").filter(unit(23) < each / F.col("size")).drop("size")   # one row per language
    sample = drawn.withColumn("hash", F.xxhash64("text")).dropDuplicates(["lang", "hash"]).drop("hash").withColumn("held", unit(29) < 0.2)
    grams = (
        sample.filter("NOT held").select("lang", "text")
        .mapInArrow(tidy(_counted), "lang string, n int, gram long, context long, tail long, middle long, times long")
        .groupBy("lang", "n", "gram", "context", "tail", "middle").agg(F.sum("times").alias("times"))
    )
    with scratch(spark):
        shares, left = (x.toArrow() for x in kneser_ney(stage(grams, "grams")))
    if not shares.num_rows:
        return Model([])
    model = Model(languages, sorted_arrays(shares, "gram", "share", languages), sorted_arrays(left, "context", "left", languages))
    shared, name = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, letters = entropies(shared.value, name, *column_bytes(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.tolist()), pa.array(letters)], names=["lang", "h", "letters"])

    held = sample.filter("held").select("lang", "text").mapInArrow(tidy(measured), "lang string, h array<double>, letters boolean")
    held = held.filter("letters").toArrow()
    model.limits = np.full(len(languages), np.inf)
    if held.num_rows:
        h = np.array(held.column("h").to_pylist())
        truth = np.array([languages.index(x) for x in held.column("lang").to_pylist()])
        for i in range(len(languages)):
            own = h[truth == i, i]
            if len(own):
                model.limits[i] = np.quantile(own, 0.99) + 3 * own.std()
        trial = [2.0 ** k for k in range(-2, 7)]
        loss = [-np.mean(np.log(np.maximum(_posterior(h, s)[np.arange(len(h)), truth], 1e-9))) for s in trial]
        model.sharpness = trial[int(np.argmin(loss))]
    return model


def _posterior(h: np.ndarray, sharpness: float) -> np.ndarray:
    likelihood = np.exp(-sharpness * (h - h.min(axis=1, keepdims=True)))
    return likelihood / likelihood.sum(axis=1, keepdims=True)


def identify(docs: DataFrame, model: Model, text_col: str = "text", reject: bool = True) -> DataFrame:
    """``docs`` with (lang_pred, score, entropy, rejected).

    ``entropy`` is the cross-entropy per character, in nats, of the best language and ``score`` its calibrated
    probability among the languages. ``rejected`` marks texts whose entropy is beyond what held-back texts of that
    language have; with ``reject`` their language is ``und``. A model without languages finds all texts ``und``. Null, empty and letterless texts are ``und``
    with score 0 and no entropy. Columns of ``docs`` stay, those named like a result are replaced; repeated rows
    stay; an empty table gives no rows. Broadcast is the model, whose size the sample bounds.
    """
    spark = docs.sparkSession
    prepare(spark)
    results = ("lang_pred", "score", "entropy", "rejected")
    docs = docs.drop(*[c for c in results if c != text_col])
    shared, name = spark.sparkContext.broadcast(model), uuid.uuid4().hex
    rows, field = docs.select(F.struct("*").alias("doc")), docs.columns.index(text_col)
    schema = T.StructType([
        T.StructField("doc", rows.schema["doc"].dataType), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("entropy", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
    ])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            if not fitted.languages:
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(["und"] * n, pa.string()), pa.array(np.zeros(n)), pa.nulls(n, pa.float64()),
                    pa.array(np.ones(n, bool))], names=schema.names)
                continue
            data, offsets = column_bytes(batch.column(0).field(field))
            for low, high in slices(offsets):
                begin = offsets[low]
                h, letters = entropies(fitted, name, data[begin:offsets[high]], offsets[low:high + 1] - begin)
                best = h.argmin(axis=1)
                least = h[np.arange(len(h)), best]
                off = ~letters | (least > fitted.limits[best])
                und = off if reject else ~letters
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low),
                    pa.array(np.where(und, "und", np.array(fitted.languages, object)[best]).tolist(), pa.string()),
                    pa.array(np.where(letters, _posterior(h, fitted.sharpness).max(axis=1), 0.0)),
                    pa.array(least, mask=~letters), pa.array(off),
                ], names=schema.names)

    return rows.mapInArrow(tidy(named), schema).select("doc.*", *results)
