"""The operators against brute force, on small tables with nulls, copies, ties and long texts."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from orderflow.llm import bpe, chat, embeddings, language, lm, mixing, ngram_join, quality, queries, substrings, warc
from orderflow.llm.base import Words
from orderflow.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def texts():
    """Random texts with near copies, exact copies, shared passages, runs, odd and missing texts."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    passage = " ".join(word() for _ in range(40))
    result = [None, "", "  \n ", "a", "A b", "a a a a a a a a a a a a a a a a a a a a", "?!", "日本", "x" * 5000]
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 6, 30, 200]))]
        for _ in range(rng.randint(1, 6)):
            own = list(base)
            for _ in range(rng.randint(0, len(own) // 25)):
                own[rng.randrange(len(own))] = word()
            result.append(" ".join(own) + (f"\n{passage}. " if rng.random() < 0.3 else ""))
    return result + [result[-1], result[-2], result[5]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 11 else None, t, ("en", "fr", None)[i % 3], (None, "a", "b")[i % 3], 1) for i, t in enumerate(texts())]
    rows += [rows[-1], rows[20]]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def sql(docs):
    connection = duckdb.connect()
    connection.register("documents", pa.Table.from_pandas(docs.toPandas().astype({"doc_id": "Int64"}), preserve_index=False))
    yield connection
    connection.close()


def same(df, connection, query):
    result = connection.execute(query)
    names = sorted(d[0] for d in result.description)
    assert names == sorted(df.columns)
    text = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    place = [[d[0] for d in result.description].index(n) for n in names]
    want = sorted(tuple(text(r[p]) for p in place) for r in result.fetchall())
    assert sorted(tuple(text(r[n]) for n in names) for r in df.collect()) == want


def test_words_are_told_apart():
    found = Words(pa.array(["Ab  ab\x0bé\n", None, "", "ab" * 9, "ab" * 9 + "c"]))
    assert [found.of(i).stop - found.of(i).start for i in range(5)] == [3, 0, 0, 1, 1]
    assert len(set(found.hash.tolist())) == 5 and len(set(Words(pa.array(["Ab ab"]), fold=True).hash.tolist())) == 1


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(200, 200), (160, 7)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    assert found == {x: c for x, c in low.items() if any(a != b and x in (a, b) for a, b in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_arc_versions_and_lengths(spark, tmp_path):
    html = ["<p>WARC/1.0\r\n\r\nx</p>" * 80, None, "é" * 600, "é" * 600, "small", "small", ""]
    pages = spark.createDataFrame([(i, f"http://a b/{i}" if i else None, h) for i, h in enumerate(html)], "page_id long, url string, html string")
    pages.coalesce(2).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r for r in warc.op1_arc_to_warc(spark, str(tmp_path)).collect()}
    for i, h in enumerate(html):
        payload = (h or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
    assert {i: r.refers_to for i, r in got.items() if r.record_type == "revisit"} == {2: 3}
    two = b"filedesc://x 0.0.0.0 20010101000000 text/plain 200 - - 0 x 9\n2 0 own\n\n" + b"http://a 1.1.1.1 2001 text/html 200 - - 0 x 3\nabc"
    records = list(warc.arc_records("x", two))
    assert [r[2] for r in records] == [2, 2] and records[1][-1] == b"abc"
    with pytest.raises(ValueError):
        list(warc.arc_records("x", two[:-1]))


@pytest.mark.parametrize("module, name, check", [(quality, "op2_line_first_cleaning", "OP2_SQL"),
                                                 (substrings, "op8_recompression", "OP8_SQL"), (mixing, "op10_systematic_mix", "OP10_SQL")])
def test_against_sql(spark, docs, sql, tmp_path, module, name, check):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    same(getattr(module, name)(spark, str(tmp_path)), sql, getattr(module, check))


def test_similar_groups(spark, docs):
    rows = docs.collect()
    shingles = lambda w: frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    sets = [shingles(WORD.findall((r.text or "").translate(FOLD))) for r in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                group = [group[i] if g == group[j] else g for g in group]
    low = defaultdict(lambda: math.inf)
    for r, g in zip(rows, group):
        low[g] = min(low[g], math.inf if r.doc_id is None else r.doc_id)
    want = Counter((r.doc_id, len(s), None if low[g] == math.inf else low[g]) for r, s, g in zip(rows, sets, group))
    found = ngram_join.groups(ngram_join.numbered(docs))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()) == want


def test_divide_skip_finds_every_set():
    rng = random.Random(2)
    for _ in range(60):
        sets = [np.array(sorted(rng.sample(range(40), rng.randint(1, 30))), dtype=np.uint64) for _ in range(30)]
        query = sets[0]
        least = ngram_join.least_overlap(len(query))
        want = {i: len(set(query) & set(s)) for i, s in enumerate(sets) if len(set(query) & set(s)) >= least}
        assert dict(ngram_join.Index(sets).search(query)) == want


def test_scores(spark, docs):
    rows = [r for r in docs.collect() if r.doc_id is not None]
    tokens = lambda t: [*WORD.findall((t or "").translate(FOLD)), None]
    held = lambda i: crc32(str(i).encode()) % 5 == 1
    counts = Counter(w for r in rows if not held(r.doc_id) for w in tokens(r.text))
    n, v = sum(counts.values()), len(counts)
    given = docs.where("doc_id is not null").select("doc_id", "text")
    train = given.where(language.remainder("doc_id", 5) != 1)
    for words in (lm.MOST_WORDS, 0):
        for r in lm.Model(train, most_words=words).score(given.withColumn("again", F.col("text"))).collect():
            own = tokens(r.again)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
            assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), abs=1e-8)
            assert r.score < 0


def test_filter_beyond_the_broadcast_bound(spark, docs):
    given = docs.where("doc_id is not null").select("doc_id", "text")
    whole, parts = lm.Model(given), lm.Model(given, most_bits=1 << 10)
    assert whole.small and not parts.small and parts.bits == whole.bits > 1 << 10
    found = [sorted(model.score(given.union(given.limit(3))).collect(), key=lambda r: (r.doc_id, r.n_tokens)) for model in (whole, parts)]
    assert len(found[0]) == len(found[1]) > 3
    for a, b in zip(*found, strict=True):
        assert a[:4] == b[:4] and b.base_score == pytest.approx(a.base_score, abs=1e-9) and b.score == pytest.approx(a.score, abs=1e-9)


def test_score_interpolates_quantised_counts(spark, docs, monkeypatch):
    monkeypatch.setattr(lm, "BITS_PER_TOKEN", 1 << 12)  # hardly any false hits
    given = docs.where("doc_id is not null").select("doc_id", "text")
    given = given.union(spark.range(1000, 1003).select("id", F.repeat(F.lit("a "), 400)))  # counts beyond a byte
    tokens = lambda t: [*WORD.findall((t or "").translate(FOLD)), None]
    train = [tokens(r.text) for r in given.collect() if crc32(str(r.doc_id).encode()) % 5 != 1]
    counts = Counter(tuple(t[i:i + k]) for t in train for k in range(1, lm.ORDER + 1) for i in range(len(t) - k + 1))
    n, v = sum(map(len, train)), sum(len(run) == 1 for run in counts)

    def quantised(run):
        low = 1 << counts[run].bit_length() - 1 if counts[run] else 0
        return (low + max(low, 2 * low - 1)) / 2

    def probability(t, i):
        found, rest = 0.0, 1.0
        for k in range(min(lm.ORDER, i + 1), 1, -1):
            if under := quantised(tuple(t[i - k + 1:i])):
                found += rest * lm.WEIGHT * min(1.0, quantised(tuple(t[i - k + 1:i + 1])) / under)
                rest *= 1 - lm.WEIGHT
        return found + rest * (quantised((t[i],)) + 0.5) / (n + 0.5 * (v + 1))

    assert lm.ORDER >= 3 and max(counts.values()) > 255
    for r in lm.Model(given.where(language.remainder("doc_id", 5) != 1), most_words=0).score(given.withColumn("again", F.col("text"))).collect():
        own = tokens(r.again)
        assert r.score == pytest.approx(sum(math.log10(probability(own, i)) for i in range(len(own))), abs=1e-8)


def test_words_in_every_text_go_through_the_segments(spark, data, monkeypatch):
    monkeypatch.setattr(lm.Model, "_broadcast", None)  # the query takes the same way at every size
    rows = lm.op4_log_frequency_bloom(spark, data)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert rows.count() == docs.count() and rows.where("n_known < 1 or score >= 0").count() == 0  # the end is known in all
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 1000).astype(np.uint64))
    assert (lm.spread(lm.squeezed(keys)) == keys).all() and not len(lm.spread(lm.squeezed(keys[:0])))
    short = np.unique(keys & ~np.uint64(0xFFFF))
    assert (lm.spread(lm.squeezed(short, lm.LONG), lm.LONG) == short).all() and len(lm.squeezed(short, lm.LONG)) == lm.LONG * len(short)


def test_filter_keeps_quantised_counts():
    grams, counts = np.arange(1, 2000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.arange(1, 2000)
    table = pa.table({"segment": [0], "words": [grams.tobytes()], "n": [counts.astype(np.uint32).tobytes()], "grams": [b""], "m": [b""], "over": [b""]})
    found = lm.Filter(1 << 19, 1, lm._merged(1 << 19, 1)(table).column("bits")[0].as_py()).levels(grams)
    assert (found >= lm.level_of(counts)).all() and (found == lm.level_of(counts)).mean() > 0.99


def test_snapshots(spark):
    turns = [(1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a"), (2, 1, "bot", "b"), (2, 2, "user", None), (3, 0, "user", "a"),
             (3, 1, "bot", "b"), (3, 2, "user", None), (4, 0, "user", "b"), (None, 0, "user", "a"), (5, None, "user", "z"), (5, 300, "bot", "z")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.render(chat.collapse(df)).collect()}
    assert {k: (r.n_turns, r.n_copies) for k, r in got.items()} == {2: (3, 2), 4: (1, 1), 5: (2, 1)}
    assert got[2].rendered == "<|im_start|>user\na<|im_end|>\n<|im_start|>bot\nb<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    assert chat.render(chat.collapse(df.limit(0))).count() == 0


def test_languages(spark, data):
    rows = language.op6_family_then_svm(spark, data).join(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in rows)


def test_languages_without_letters_or_labels(spark, docs):
    odd = spark.createDataFrame([(None, "en"), ("12 !?", "en"), ("", None)], "text string, lang string")
    assert language.fit(odd.limit(0)) is None
    for model in (None, language.fit(docs)):
        assert {(r.lang_pred, r.score) for r in language.predict(odd, model).collect()} == {("und", 0.0)}


def test_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 8))
    rows = [[float(x) for x in b + 0.12 * rng.normal(size=8)] for b in base for _ in range(6)]
    rows += [rows[0], [2 * x for x in rows[0]], None, [0.0] * 8, [math.nan] * 8, [None] * 8, [], [1.0, 0.0], [1.0, 0.1]]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    unit = [np.array(r) / np.linalg.norm(r) if r and None not in r and np.isfinite(r).all() and any(r) else None for r in rows]
    near = {(i, j) for i, a in enumerate(unit) for j, b in enumerate(unit) if i != j and a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95}
    low = list(range(len(rows)))
    for _ in rows:
        for i, j in near:
            low[i] = min(low[i], low[j])
    links = Counter(i for i, _ in near)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()}
    assert got == {i: (links[i], low[i], low[i] == i) for i in range(len(rows))}
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_tokens(spark, docs):
    path, pattern = bpe.vocabulary()
    ranks = bpe.ranks_of(path)
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    for r in bpe.encoded(docs, path, pattern).collect():
        assert r.ids == other.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    codec = bpe.Codec(ranks, pattern)
    for text in ["\x1c a", "a\x85b", "½ ²x Ⅷ", "𝒳 y", "a_b __ 'll", "  \n\n x  ", "١٢ é", "<|endoftext|>", "ab" * 3000]:
        assert codec.encode(text) == other.encode_ordinary(text)
    assert all(codec.whole.get(k) == v for k, v in ranks.items()) and codec.whole.get(b"zzqqzz") == -1


def test_mixing_of_sources(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), ("a", "b", "c", None)[min(3, i % 9)]) for i in range(400)] + [(999, None, "zero")]
    got = mixing.copies(spark.createDataFrame(rows, "doc_id long, text string, source string"), F.col("doc_id"), pieces=3).collect()
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        size[r.source] += r.mix_size
        taken[r.source] += r.mix_size * r.mix_copies
        target[r.source] = r.mix_target
        assert 0 <= r.mix_copies <= 2
    want, weights = {}, dict(zip(["a", "b", "c", "zero", None], (5, 2, 1, 5, 2)))
    open_ = set(size)
    while True:
        level = (1.5 * sum(size.values()) - sum(want.values())) / max(1, sum(weights[s] for s in open_))
        full = [s for s in open_ if weights[s] * level >= 2 * size[s]]
        if not full:
            break
        for s in full:
            want[s] = 2.0 * size[s]
            open_.remove(s)
    want |= {s: weights[s] * level for s in open_}
    assert target == pytest.approx(want) and all(abs(taken[s] - target[s]) <= 0.05 * target[s] + 50 for s in size)


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")} == set(range(1, 14)) and "pipeline" in queries.QUERIES


def test_pipeline(spark, data):
    import corpus_pipeline

    names = spark.read.parquet(f"{data}/documents.parquet").columns
    docs = spark.read.parquet(f"{data}/documents.parquet")
    told = corpus_pipeline.identify(spark, docs, data)
    kept = corpus_pipeline.keep_one(spark, told, data)
    assert told.columns == kept.columns == names and told.count() >= 0.99 * docs.count()
    groups = ngram_join.groups(ngram_join.numbered(told))
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.component_id for r in groups.collect()}
    assert corpus_pipeline.run(spark, data).where("not round_trip").count() == 0


def test_pipeline_carries_columns_of_any_name(spark, data):
    import corpus_pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet")
    odd = ["row", "bucket", "score", "lang_pred", "mix_size", "mix_copies", "ids", "n_removed", "kept_text", "set", "a.b", "_other_columns"]
    more = docs.select("doc_id", *[F.col("doc_id").alias(c) for c in odd], *docs.columns[1:])
    stages = corpus_pipeline.STAGES[:-1]
    for name, stage in stages:
        plain = stage(spark, docs, data)
        own = stage(spark, more, data)
        assert own.columns == more.columns, name
        quoted = [f"`{c}`" for c in odd]
        assert own.where(" or ".join(f"{c} <> doc_id" for c in quoted)).count() == 0, name
        assert Counter(map(tuple, own.select(docs.columns).collect())) == Counter(map(tuple, plain.collect())), name


def test_a_fit_is_made_of_the_sample_alone(spark, docs):
    model = language.fit(docs)
    rows = [r for r in docs.collect() if r.text is not None and r.lang is not None]
    x, labels = language.features([r.text for r in rows]), np.array([r.lang for r in rows], dtype=object)
    used = sorted((lang, v.tobytes()) for lang, v in zip(labels, x) if v.any())
    other = language.Model(np.frombuffer(b"".join(v for _, v in used), dtype=np.float32).reshape(-1, language.FEATURES),
                           np.array([lang for lang, _ in used], dtype=object))
    assert model.languages == other.languages and np.allclose(model.by_family, other.by_family)
    told = language.predict(docs, model).collect()
    want, scores = other.predict(language.features([r.text for r in told]))
    for r, lang, score in zip(told, want, scores, strict=True):
        if r.text and any(map(str.isalpha, r.text)):
            assert (r.lang_pred, r.score) == (lang, pytest.approx(score))
        else:
            assert (r.lang_pred, r.score) == ("und", 0.0)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_are_stored_once_and_compared_in_blocks(spark, monkeypatch, kind):
    """Vectors that lie evenly visit most cells; what is stored holds each of them once or twice all the same."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(260, 6))
    rows = [*base, *(base[:90] + 0.05 * rng.normal(size=(90, 6)))]
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], f"vec_id long, embedding array<{kind}>")
    x = np.array([r.embedding for r in df.orderBy("vec_id").collect()])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    stored = []
    keep = embeddings.staged
    monkeypatch.setattr(embeddings, "staged", lambda df, name: stored.append(keep(df, name)) or stored[-1])
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    got = {r.vec_id: r for r in embeddings.near_duplicates(df).collect()}
    assert [got[i].n_links for i in range(len(rows))] == near.sum(axis=1).tolist()
    low = np.arange(len(rows))
    for _ in rows:
        low = np.minimum(low, np.where(near, low[None], len(rows)).min(axis=1))
    assert [got[i].component_id for i in range(len(rows))] == low.tolist()
    held = [s.agg(F.sum(F.length(c))).first()[0] for s in stored for c in ("unit", "raw") if c in s.columns]
    assert sum(held) <= 2 * len(rows) * 6 * (4 if kind == "float" else 8)
