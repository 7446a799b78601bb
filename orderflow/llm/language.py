"""Language identification in two steps: the family first, then one language against another within it."""

from __future__ import annotations

import pickle
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.llm.base import extended, give_back, pieces, table

#: Languages of a family by ISO 639-1 code. A language in no list is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky tk".split(),
    "indic": "hi mr ne bn pa gu or".split(),
    "semitic": "ar he am mt".split(),
}
#: Documents that the classifiers are fitted on at most, over all languages; features; steps of the fit.
SAMPLE, FEATURES, STEPS = 3000, 4096, 150
#: Weight of the squared norm in the fit, and steepness of a score by its margin.
RIDGE, STEEP = 1e-4, 4.0
UNKNOWN = "und"

_FAMILY = {language: family for family, languages in FAMILIES.items() for language in languages}


def features(texts: list[str | None]) -> np.ndarray:
    """A row per text: counts of runs of one to three bytes of the lower-cased text by hash, as square roots, of unit length."""
    result = np.zeros((len(texts), FEATURES), dtype=np.float32)
    for row, text in enumerate(texts):
        data = np.frombuffer((text or "").lower().encode(), dtype=np.uint8).astype(np.uint32)
        counts = np.zeros(FEATURES, dtype=np.int64)
        for start in range(0, len(data), 1 << 20):  # a slice and the two bytes after it
            part = data[start:start + (1 << 20) + 2]
            run = part
            for n in range(1, 4):
                if n > 1:
                    run = run[:-1] << 8 | part[n - 1:]
                own = run[:1 << 20]
                counts += np.bincount((own * np.uint32(2654435761) + np.uint32(n * 40503) >> np.uint32(20)) & (FEATURES - 1),
                                      minlength=FEATURES)
        values = np.sqrt(counts)
        result[row] = values / (np.linalg.norm(values) or 1.0)
    return result


def fit_line(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Weights of a linear support vector machine with squared hinge loss, both classes weighing the same; the last is the offset."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    sign = np.where(positive, 1.0, -1.0)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum()))
    w = ahead = np.zeros(x.shape[1])
    for step in range(STEPS):  # Nesterov's accelerated descent; the slope's rate of change is at most 4
        slack = np.maximum(0, 1 - sign * (x @ ahead.astype(x.dtype)))
        new = ahead - 0.25 * (RIDGE * ahead - 2 * x.T @ (share * sign * slack).astype(x.dtype))
        ahead, w = new + step / (step + 3) * (new - w), new
    return w


class Model:
    """One line per family against the rest, and one per pair of languages of a family."""

    def __init__(self, x: np.ndarray, labels: np.ndarray):
        self.languages = sorted(set(labels.tolist()))
        family = np.array([_FAMILY.get(lang, f"own {lang}") for lang in labels.tolist()])
        self.families = sorted(set(family.tolist()))
        self.members = [[lang for lang in self.languages if _FAMILY.get(lang, f"own {lang}") == f] for f in self.families]
        self.by_family = np.array([fit_line(x, family == f) for f in self.families]).reshape(len(self.families), -1)
        self.pairs = [{(a, b): fit_line(x[np.isin(labels, (a, b))], labels[np.isin(labels, (a, b))] == a)
                       for a, b in combinations(langs, 2)} for langs in self.members]

    @classmethod
    def of(cls, parts: dict) -> Model:
        """A model from what ``vars`` gives of one."""
        made = cls.__new__(cls)
        vars(made).update(parts)
        return made

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and scores. Ties go to the first by name."""
        x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
        near = STEEP * (x @ self.by_family.T)
        chance = np.exp(near - near.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        best = near.argmax(axis=1)
        score, names = chance[np.arange(len(x)), best].copy(), np.empty(len(x), dtype=object)
        for f, langs in enumerate(self.members):
            at = np.flatnonzero(best == f)
            votes, margins = np.zeros((len(at), len(langs))), np.zeros((len(at), len(langs)))
            for (a, b), w in self.pairs[f].items():
                margin = x[at] @ w
                for lang, sign in ((a, 1), (b, -1)):
                    place = langs.index(lang)
                    votes[:, place] += (margin >= 0) if sign > 0 else (margin < 0)
                    margins[:, place] += sign * np.tanh(margin)
            total = votes + margins / (4 * max(1, len(langs)))
            names[at] = np.array(langs, dtype=object)[total.argmax(axis=1)]
            if len(langs) > 1:
                grade = np.exp(STEEP * (margins - margins.max(axis=1, keepdims=True)))
                score[at] *= (grade / grade.sum(axis=1, keepdims=True))[np.arange(len(at)), total.argmax(axis=1)]
        return names.tolist(), np.clip(score, 0.0, 1.0)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", order: Column | None = None) -> Model | None:
    """A model from the labelled rows of ``docs``, or None if there are none.

    At most ``SAMPLE`` documents are used, an equal number of each language, those with the lowest hash of ``order``
    (by default the text). Features of whole texts are made where the texts are; one task fits all lines to them, at
    most ``SAMPLE`` * ``FEATURES`` * 4 bytes, and only the lines reach the driver. Rows with a null or letterless text
    or a null label are not used.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"),
                       F.xxhash64(order if order is not None else text).alias("order"))
    rows = rows.where("text is not null and lang is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy("lang").limit(SAMPLE).collect()}
    if not counts:
        return None
    each = max(1, SAMPLE // len(counts))
    share = F.element_at(F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, 1.5 * each / n + 50 / n))]), F.col("lang"))
    place = F.pmod("order", F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.where(place < share).withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("order", "text")))

    def made(batches):
        for batch in pieces(batches):
            x = features(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "x"])

    def fitted(t: pa.Table) -> pa.Table:
        found = sorted((r["lang"], r["x"]) for r in t.to_pylist() if any(r["x"]))
        model = None
        if found:
            x = np.frombuffer(b"".join(x for _, x in found), dtype=np.float32).reshape(-1, FEATURES)
            model = pickle.dumps(vars(Model(x, np.array([lang for lang, _ in found], dtype=object))))
        give_back()
        return pa.table({"model": pa.array([model], pa.binary())})

    sample = chosen.where(F.col("n") <= each).select("text", "lang").mapInArrow(made, "lang string, x binary")
    lines = sample.groupBy(F.lit(0).alias("one")).applyInArrow(fitted, "model binary").collect()
    return Model.of(pickle.loads(lines[0]["model"])) if lines and lines[0]["model"] else None


def predict(docs: DataFrame, model: Model | None, column: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) from the text alone.

    A null text, one without a letter, and every text where there is no model get ``und`` with score 0. Columns of the
    names added are replaced. Texts are read whole, one row at a time; an empty table gives an empty one.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("lang_pred", "score")])
    shared = docs.sparkSession.sparkContext.broadcast(model and vars(model))
    names = docs.columns

    def rows(batches):
        own = shared.value and Model.of(shared.value)
        for batch in pieces(batches):
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = part.column(column).to_pylist()
                found = np.array([own is not None and t is not None and any(map(str.isalpha, t)) for t in texts], dtype=bool)
                langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
                if found.any():
                    at = np.flatnonzero(found)
                    told, scores[at] = own.predict(features([texts[i] for i in at]))
                    for i, lang in zip(at, told, strict=True):
                        langs[i] = lang
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores)], names=[*names, "lang_pred", "score"])

    return docs.mapInArrow(rows, extended(docs.schema, "lang_pred string, score double"))


def remainder(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; the key null counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts


def op6_family_then_svm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit(docs.where(remainder("doc_id", 4) != 2), order=F.col("doc_id"))
    return (predict(docs.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "text"), model)
            .select("doc_id", "held_out", "lang_pred", "score"))
