"""Small tables that hold the hard cases: NULLs in every column, empty and very
long texts, ties, repeated rows, columns with names the operators use inside."""

import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, r long, part int, kind string, n int, "
          "found string, score double, block string, node long, language string, spans string, train boolean, path string")
CLASH = (7, 8, 9, "k", 10, "f", 0.5, "b", 11, "l", "s", True, "p")

EN = "the of and to in is that for with was on are as this be by from have not or at".split()
DE = "der die das und ist nicht ein eine mit von zu den auf für im dem auch es an werden".split()


def sentence(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(["", "", "", rng.choice(words)]) for _ in range(n)) + "."


def rows():
    rng = random.Random(4)
    out = []
    for i in range(60):
        lang = "en" if i % 3 else "de"
        text = "\n".join(sentence(rng, EN if i % 3 else DE, rng.randint(6, 30)) for _ in range(rng.randint(1, 6)))
        out.append([i, text, lang, f"src{i % 3}", len(text)])
    base = out[5][1]
    words = base.split(" ")
    out += [[100, base, "en", "src0", None], [101, base, None, None, 5], [101, base, None, None, 5]]  # copies, a repeated row
    out += [[102, " ".join(words[:-1] + ["changed"]), "en", "src1", 3], [103, base.upper(), "en", "src1", 3]]
    out += [[110, None, "en", "src0", None], [111, "", "de", "src0", 0], [112, "   \n\t ", "en", "src0", 5], [113, "12 34 ...", "en", "s", 9]]
    out += [[114, "one", "en", "s", 3], [115, "one two three", "en", "s", 13], [116, "One two  three", "en", "s", 14]]
    out += [[120, "x" * 300_000, "en", "s", 300_000], [121, sentence(rng, EN, 20_000), "en", "s", 0], [122, "ab" * 100 + " é🙂 " + "ab" * 100, "en", "s", 0]]
    out += [[None, base, "en", "src0", 1], [None, None, None, None, None], [None, "a text without an id", None, "s", 1]]
    out += [[130, "Mail a.b@c.de or +49 (30) 123-45678 card 4111 1111 1111 1111 ip 10.0.0.255, bad 10.0.0.256", "en", "s", 1]]
    out += [[131, "Released under the MIT License.\nmore", "en", "src1", 1], [1000, "Licensed under the Apache License, Version 2.0.\n", "en", "src1", 1]]
    out += [[140, out[7][1] + " " + ITEMS[0][1] + " " + out[8][1], "en", "s", 1]]
    return [tuple(r) + CLASH for r in out]


def _items():
    rng = random.Random(9)
    made = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(200)]
    return [(i, " ".join(rng.choice(made) for _ in range(n))) for i, n in enumerate((30, 18, 40, 25))]


ITEMS = _items() + [(9, None), (10, ""), (None, "an item without an id that nothing holds anywhere")]


def write(spark, folder, docs):
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(ITEMS if docs else [], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(d[0], (d[0] or 0) % 2, 0) for d in docs[:60]] + [(None, 1, 0), (5, None, None), (6, 1, 1), (6, 1, 1), (7, 5, 0)]
    spark.createDataFrame(labels if docs else [], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("odd") / "t", rows())


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty") / "t", [])


@pytest.fixture(scope="session")
def docs():
    """(doc_id, text) of the odd table."""
    return [(r[0], r[1]) for r in rows()]
