"""Scalar rules against Python itself."""

import random
import uuid

import pytest
from pyspark.sql import functions as F, types as T

from pairloom.functions import predicates as P, text
from pairloom.functions.stats import cohens_kappa, confusion, pearson


def one(df):
    return [r[0] for r in df.collect()]


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string").orderBy("i")


SAMPLES = ["  a\tB \n c ", "\x1c x\x1f", "　Été d ", "ÄÖ ß", "", " ", "a\x85b", "no change", "ΑΣ σ", "x​y", "a  b", " q "]


def test_whitespace_is_pythons():
    assert set(text.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip_and_normalize(spark):
    df = texts(spark, SAMPLES)
    assert one(df.select(text.strip("t"))) == [s.strip() for s in SAMPLES]
    assert one(df.select(text.normalized("t"))) == [" ".join(s.lower().split()) for s in SAMPLES]


def test_every_whitespace_character_is_squeezed(spark):
    chars = list(text.WHITESPACE)
    df = texts(spark, [f"a{c}{c}b{c}" for c in chars])
    assert set(one(df.select(text.normalized("t")))) == {"a b"}


def test_uuid5_equals_python(spark):
    names = ["sdf::Été::ß", "sdf::::", "sdf::a::b\n"]
    assert one(texts(spark, names).select(text.uuid5("t"))) == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]


def test_one_decimal_equals_python(spark):
    rng = random.Random(1)
    xs = [i / 100 for i in range(1001)] + [i / 20 for i in range(201)] + [rng.uniform(0, 10) for _ in range(3000)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").orderBy("i")
    assert one(df.select(text.one_decimal("x"))) == [f"{x:.1f}" for x in xs]


def test_canonical_id(spark):
    u = "6BA7B811-9DAD-11D1-80B4-00C04FD430C8"
    ids = [u, u.replace("-", ""), "{" + u + "}", "urn:uuid:" + u, "doc-1", ""]
    assert one(texts(spark, ids).select(text.canonical_id("t"))) == [u.lower()] * 4 + ["doc-1", ""]


def test_timestamps(spark):
    ts = ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05", "2024-01-02T04:04:05+01:00", "2024-01-02", "later"]
    got = one(texts(spark, ts).select(F.date_format(text.iso_timestamp("t"), "yyyy-MM-dd HH:mm:ss")))
    assert got == ["2024-01-02 03:04:05"] * 3 + ["2024-01-02 00:00:00", None]


@pytest.mark.parametrize("a,b,kappa", [("TTFF", "TTFF", 1.0), ("TTTTT", "TTTTT", 1.0), ("TFTF", "TTTF", 0.5), ("TTTT", "FFFF", 0.0)])
def test_kappa(spark, a, b, kappa):
    df = spark.createDataFrame([(x == "T", y == "T") for x, y in zip(a, b)], "a boolean, b boolean")
    counts = df.agg(*[c.alias(k) for k, c in confusion(F.col("a"), F.col("b")).items()])
    got = counts.select(cohens_kappa(*[F.col(k) for k in ("tp", "fp", "tn", "fn")])).first()[0]
    assert got == pytest.approx(kappa)


def test_kappa_below_chance_and_empty(spark):
    df = spark.createDataFrame([(True, False), (False, True)], "a boolean, b boolean")
    for rows, check in ((df, lambda k: k < 0), (df.limit(0), lambda k: k == 0)):
        counts = rows.agg(*[c.alias(k) for k, c in confusion(F.col("a"), F.col("b")).items()])
        assert check(counts.select(cohens_kappa(*[F.col(k) for k in ("tp", "fp", "tn", "fn")])).first()[0])


@pytest.mark.parametrize("xs,ys,r", [([1, 2, 3, 4], [2, 4, 6, 8], 1.0), ([1, 2, 3, 4], [4, 3, 2, 1], -1.0),
                                     ([1, 1, 1], [1, 2, 3], 0.0), ([1, 2, 3, 4], [1, 3, 2, 5], 0.8315218406)])
def test_pearson(spark, xs, ys, r):
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(xs, ys)], "x double, y double")
    assert df.agg(pearson(F.col("x"), F.col("y"))).first()[0] == pytest.approx(r)
    assert df.limit(0).agg(pearson(F.col("x"), F.col("y"))).first()[0] == 0.0


def test_predicate_rules(spark):
    df = spark.createDataFrame([(7, -7, 0, "abcdef", None)], "a int, b int, z int, t string, n string")
    row = df.select(
        P.modulo(F.col("b"), F.lit(3)), P.floor_divide(F.col("b"), F.lit(2)), P.divide(F.col("a"), F.col("z")),
        P.piece(F.col("t"), 1, 3), P.piece(F.col("t"), -2), P.piece(F.col("t"), 0, -1), P.piece(F.col("t"), 4, 99),
        P.not_equal(F.col("n"), "x"), P.equal(F.col("n"), F.lit(None)), P.is_in(F.col("n"), ["x", None]), P.is_in(F.col("n"), ["x"]),
        P.contains(F.col("t"), "cd"), P.truth(F.col("z"), T.IntegerType()), P.power(F.lit(2), F.lit(3)),
    ).first()
    assert tuple(row) == (-7 % 3, -7 // 2, None, "bc", "ef", "abcde", "ef", True, True, True, False, True, False, 8.0)
    with pytest.raises(ValueError):
        P.predicate(df, "a + 1")
