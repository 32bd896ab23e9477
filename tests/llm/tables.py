"""Small inputs with everything that is awkward, and helpers for brute-force twins."""

import random
import re

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tricky_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdeéß日") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base = line(70), line(300)
    texts: list[tuple[int | None, str | None]] = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "a b c"), (6, "a b c"), (None, "null id " + passage), (7, passage),
        (8, line(30) + "\n" + passage + "  " + line(20)), (9, passage + " " + line(40) + " " + passage), (9, line(90) + " " + passage),
        (10, base), (11, base), (12, base + " tail"), (13, " ".join(w if i % 60 else "x" for i, w in enumerate(base.split()))),
        (14, base.upper()), (15, "\x0b".join(base.split())), (16, "word " * 400), (17, "word " * 90), (18, "🙂 " * 60 + "\x00 end"),
        (19, line(20_000)), (20, "A" * 5000), (20, "A" * 5000), (21, "I'll <|endoftext|> ▁▁ x\x1cy z  　w"), (22, "!!! ??? 123 456"),
    ]
    for turn in (0, 1):  # the doubling sequence and its complement: equal polynomials modulo 2**64
        texts.append((23 + turn, " ".join(["".join("ab"[(n.bit_count() + turn) % 2] for n in range(1024))] * 60)))
    for i in range(40):
        source = base.split()
        for _ in range(i // 4):
            source[rng.randrange(len(source))] = rng.choice(vocabulary)
        texts.append((100 + i, " ".join(source)))
    texts += [(200 + i, line(rng.randint(1, 80))) for i in range(40)]
    return texts


def tricky_documents(spark):
    rows = [(i, t, "en", None, 3, t, 0, 1.5, "x", 1) for i, t in tricky_texts()]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words int, score double, id string, key int"
    ).repartition(5)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def collected(df, *key):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is not None, x) for x in r])
