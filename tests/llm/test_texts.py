"""Divergence audit, fill-in-middle and decontamination against SQL and plain Python, on odd, long, repeated and empty texts."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderflow.llm import decontamination, divergence, infill

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, key string, row long, value long, bucket int, output string"


def texts(rng):
    word = lambda: "".join(rng.choice("abÀéß日😀xY1-.") for _ in range(rng.randint(1, 5)))
    line = lambda n: "".join(word() + rng.choice([" ", "  ", "\n", "\t", "\x0b", " "]) for _ in range(n))
    return [None, "", " ", "a", "😀", "é<S>x", "<P>", "1 2 3", "x" * 70000 + "é" * 70000, line(6000),
            *[line(rng.choice([1, 8, 60])) for _ in range(80)]]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    given = [(i if i % 17 else None, t, (None, "en", "fr")[i % 3], (None, "a", "b", "é", "")[i % 5]) for i, t in enumerate(texts(rng))]
    given += [given[3], given[20], given[20], (500, None, "only", "empty"), (501, "one", "lone", "x"), (502, "", "lone", "y")]
    return [(*r, "k", 1, 2, 3, "o") for r in given]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


ITEMS = [(1, "b a x 1 a b x y 1 x a b"), (2, "a"), (3, None), (4, " .-"), (None, "É é"), (5, "b a x 1 a b x y 1 x"), (5, "q"), (60, "no such words")]


@pytest.fixture(scope="module")
def items(spark, rows):
    rng = random.Random(4)
    taken = [" ".join(r[1].split()[a:a + 25]).upper() for r in rows if r[1] and len(r[1]) > 400 for a in [rng.randrange(20)]]
    long = " ".join(str(i) for i in range(1500))
    return spark.createDataFrame([*ITEMS, *[(100 + i, t) for i, t in enumerate(taken[:8])], (200, taken[0]), (300, long)], "item_id long, text string")


def connect(**tables):
    connection = duckdb.connect()
    for name, df in tables.items():
        rows = df.toPandas()
        for c in ("doc_id", "item_id"):
            if c in rows:
                rows[c] = rows[c].astype("Int64")
        connection.register(name, pa.Table.from_pandas(rows, preserve_index=False))
    return connection


def same(df, connection, query):
    result = connection.execute(query)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    found = [tuple(r[n] for n in names) for r in df.collect()]
    assert Counter(found) == Counter(result.fetchall())
    return found


def test_divergence(spark, docs, tmp_path, monkeypatch):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = same(divergence.op11_source_divergence(spark, str(tmp_path)), connect(documents=docs), divergence.OP11_SQL)
    assert ("only", "empty") not in {r[:2] for r in found} and {r[3] for r in found if r[:3] == ("lone", "x", "pair")} == {"y"}
    monkeypatch.setattr(divergence, "_HELD", 40)  # tasks send what they hold in many parts
    monkeypatch.setattr(divergence, "_BLOCK_ROWS", 30)  # and sources meet in many blocks
    parts = divergence.audited(docs.repartition(5))
    assert Counter(map(tuple, parts.collect())) == Counter(found)
    assert divergence.audited(docs.limit(0)).count() == 0


@pytest.mark.parametrize("least", [1, 2])
def test_divergence_over_fewer_documents(docs, least):
    kept = divergence.audited(docs, least=least)
    query = divergence.OP11_SQL.replace(f">= {divergence.LEAST_DOCUMENTS}", f">= {least}")
    same(kept, connect(documents=docs), query)
    with pytest.raises(ValueError):
        divergence.audited(docs, least=4)


def test_documents_of_a_term_are_told_apart(spark):
    # "a" is in three documents, through chunks that are each in one or two of them.
    rows = [("a.", "x"), ("a,", "x"), ("a.", "y"), ("b. b,", "x"), ("b!", "x"), ("c c. c, c!", "x"), ("c", "y")]
    df = spark.createDataFrame([("en", s, t) for t, s in rows], "lang string, source string, text string")
    found = divergence.audited(df).where("part = 'term'").collect()
    assert {r.item for r in found} <= {"a"}
    assert divergence.audited(df, least=2).where("part = 'pair' and value > 0").count() == 2


def test_large_sums_are_exact(spark):
    # One source has all of a term, the other all of another, so shares are as far apart as they can be.
    rows = [("en", s, w) for s, w in (("x", "p"), ("y", "q")) for _ in range(3)] * 700
    got = {(r.source, r.part, r.item): r.value for r in divergence.audited(spark.createDataFrame(rows, "lang string, source string, text string")).collect()}
    share = lambda c, n: 1 + 10**9 * (c + 1) // (n + 2)
    far = lambda p, q: (p - q) ** 2 // q
    most, none = share(2100, 2100), share(0, 2100)
    assert got["x", "pair", "y"] == far(most, none) + far(none, most) and got["x", "term", "p"] == far(most, share(2100, 4200))


def test_rank_index():
    rng = np.random.default_rng(2)
    for steps in ([], [1], [4] * 10, rng.integers(1, 5, 200_000), np.repeat([1, 4, 1, 3], 70_000), np.repeat([1, 2], [3, 100_000])):
        offsets = np.append(0, np.cumsum(np.array(steps, dtype=np.int64))).astype(np.int64)
        for error in (0, 5, infill.ERROR):
            index = infill.RankIndex(offsets, error)
            assert (index.offsets(np.arange(len(offsets))) == offsets).all()
            assert np.abs(index.residuals.astype(np.int64)).max() <= error
    plain = infill.RankIndex(np.arange(1 << 20))
    assert len(plain.knots) == 17 and not plain.residuals.any()


def test_infill(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = same(infill.op12_learned_rank_infill(spark, str(tmp_path)), connect(documents=docs), infill.OP12_SQL)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}
    made = infill.transformed(docs, suffix_first=60)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    back = made.select("doc_id", "form", infill.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((r.doc_id, r.text or "") for r in docs.collect())
    assert all(r.form == "plain" for r in back if "<S>" in r.text or r.text in ("", "<P>"))
    assert infill.transformed(docs.limit(0)).count() == 0
    own = infill.transformed(docs.select(F.col("text").alias("form"), F.col("key").alias("n")), "n", "form", marks=("[", "|", "]"), plain_from=100)
    assert own.where(~F.col("output").startswith("[") & ~F.col("output").startswith("|") & (F.col("form") != "plain")).count() == 0


def test_marks_that_cuts_could_make(spark):
    rows = [(i, "<P" * 5 + "><S" * 4 + "<" * i) for i in range(60)] + [(i, "a<" * 6 + "P") for i in range(60)]
    made = infill.transformed(spark.createDataFrame(rows, "doc_id long, text string"), plain_from=100, suffix_first=50)
    got = made.select("doc_id", infill.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert Counter(map(tuple, got)) == Counter(rows)


@pytest.mark.parametrize("block_bytes", [decontamination.BLOCK_BYTES, 2000])
def test_decontamination(spark, docs, items, tmp_path, block_bytes, monkeypatch):
    monkeypatch.setattr(decontamination, "_SECTION", 7)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    default = decontamination.contaminated
    monkeypatch.setattr(decontamination, "contaminated", lambda d, i: default(d, i, block_bytes=block_bytes))
    found = same(decontamination.op13_automaton_decontamination(spark, str(tmp_path)), connect(documents=docs, benchmark=items), decontamination.OP13_SQL)
    assert sum(r[-1] for r in found) > 10 and not all(r[-1] for r in found)


def test_decontamination_offsets(spark):
    docs = spark.createDataFrame([(1, "É😀 -- Big, RED  fox\tran. Big red fox"), (2, "big red"), (3, None)], "id long, body string")
    items = spark.createDataFrame([("q", "big red fox"), ("r", "Fox; ran!")], "item_id string, text string")
    got = {r.id: r for r in decontamination.contaminated(docs, items, window=3, key="id", column="body").collect()}
    text = got[1].text
    assert [(s.first, s.last, text[s.start:s.stop]) for s in got[1]["spans"]] == [(1, 5, "Big, RED  fox\tran"), (5, 8, "Big red fox")] or \
        [(s.first, s.last, text[s.start:s.stop]) for s in got[1]["spans"]] == [(1, 8, "Big, RED  fox\tran. Big red fox")]
    assert got[1]["items"] == ["q", "r"] and got[1].n_words == 8
    assert [(got[i].n_words, got[i].spans, got[i]["items"]) for i in (2, 3)] == [(2, [], []), (0, [], [])]


def test_decontamination_of_nothing(spark, docs, items):
    assert decontamination.contaminated(docs, items.limit(0)).where("size(spans) + size(items) > 0").count() == 0
    assert decontamination.contaminated(docs, items.limit(0)).count() == docs.count()
    assert decontamination.contaminated(docs.limit(0), items).count() == 0


def test_automaton_against_every_window():
    rng = random.Random(9)
    word = lambda: rng.choice(["a", "b", "c", "é", "x1"])
    for _ in range(200):
        given = [(" ".join(word() for _ in range(rng.randint(1, 9))), str(i)) for i in range(rng.randint(1, 5))]
        own = decontamination.Automaton(given, 4)
        words = [rng.choice([word(), "zz"]) for _ in range(40)]
        stretches, found = own.read([w.encode() for w in words])
        hit, met = set(), set()
        for text, item in given:
            parts = text.split()
            for at in range(max(1, len(parts) - 3)):
                part = parts[at:at + 4]
                for i in range(len(words) - len(part) + 1):
                    if words[i:i + len(part)] == part:
                        hit.update(range(i, i + len(part)))
                        met.add(item)
        assert {i for a, b in stretches for i in range(a, b)} == hit and found == met
        assert all(a[1] < b[0] for a, b in zip(stretches, stretches[1:]))
