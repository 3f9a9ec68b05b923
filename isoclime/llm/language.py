"""Language identification in two steps: family first, then languages inside the family.

Texts become hashed byte n-gram profiles (square roots of counts, unit length) of their letters. Linear
support vector machines are trained one against one, first between families (a language without a known
relative is a family of its own), then between the languages of each family. Every language among the labelled
rows is learned. The sample is bounded (``per_language`` rows a language on average, one and a half times that
at most in total) and each pair is trained in a Spark task of its own; the model is one row of weights a pair,
so its size depends on the number of languages alone. Prediction reads every whole text in one pass, without a
shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, partitions, sliced, table

PER_LANGUAGE = 300
ORDERS = ((1, 8), (2, 12), (3, 13))  # n-gram length, bits of its part of the profile
WIDTH = sum(1 << bits for _, bits in ORDERS)
#: The families of common language codes.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "pl": "slavic", "cs": "slavic", "uk": "slavic", "bg": "slavic", "sr": "slavic",
    "fi": "uralic", "et": "uralic", "hu": "uralic", "tr": "turkic", "az": "turkic", "hi": "indic", "bn": "indic",
}
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def profile(text: str) -> np.ndarray:
    """Unit-length profile of the whole text's letters."""
    data = b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()) + b" "
    a = np.frombuffer(data, np.uint8).astype(np.uint32)
    parts, code = [], a
    for n, bits in ORDERS:
        if n > 1:
            code = code[: len(a) - n + 1] * np.uint32(256) + a[n - 1 :]
        spots = code if bits == 8 else (code * np.uint32(2654435761)) >> np.uint32(32 - bits)
        parts.append(np.bincount(spots, minlength=1 << bits))
    x = np.sqrt(np.concatenate(parts)).astype(np.float32)
    return x / max(float(np.sqrt(x @ x)), 1e-12)


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights of a squared-hinge linear SVM by dual coordinate descent; classes weigh alike. y: -1 or 1."""
    share = np.where(y > 0, len(y) / max(2 * (y > 0).sum(), 1), len(y) / max(2 * (y < 0).sum(), 1))
    slack = 1 / (2 * cost * share)
    alpha, w, rng = np.zeros(len(y)), np.zeros(x.shape[1], np.float32), np.random.default_rng(7)
    square = (x * x).sum(axis=1) + slack
    for _ in range(rounds):
        for i in rng.permutation(len(y)):
            step = max(alpha[i] - (y[i] * float(x[i] @ w) - 1 + slack[i] * alpha[i]) / square[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += np.float32(step * y[i]) * x[i]
    return w


@dataclass
class LanguageModel:
    """languages by family, and for each pair (of families, or of languages in a family) a row of weights."""

    families: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray

    def _vote(self, names: list[str], margins: dict[tuple[str, str], float]) -> tuple[str, float]:
        if len(names) == 1:
            return names[0], 1.0
        votes, least = dict.fromkeys(names, 0), dict.fromkeys(names, np.inf)
        for a, b in combinations(names, 2):
            m = margins[a, b]
            votes[a if m > 0 else b] += 1
            least[a], least[b] = min(least[a], m), min(least[b], -m)
        best = max(names, key=lambda n: (votes[n], least[n]))
        return best, 1 / (1 + float(np.exp(-4 * np.clip(least[best], -8, 8))))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        known = [i for i, t in enumerate(texts) if t and self.families and has_letter(t)]
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        for at in range(0, len(known), 256):
            some = known[at : at + 256]
            scores = np.stack([profile(texts[i]) for i in some]) @ self.weights.T
            for i, row in zip(some, scores, strict=True):
                margins = dict(zip(self.pairs, row.tolist(), strict=True))
                family, p = self._vote(list(self.families), {k: margins[f"family {k[0]}", f"family {k[1]}"] for k in combinations(self.families, 2)})
                lang, q = self._vote(self.families[family], margins)
                out[i] = lang, p * q
        return out


def sample(labelled: DataFrame, text: str, lang: str, key: str, per_language: int) -> tuple[list[str], DataFrame | None]:
    """The languages, and (lang, spot, crc, at, x): sparse profiles of the bounded sample, chosen by a hash of key and text."""
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = rows.groupBy(F.col(lang).alias("lang")).count().collect()  # one row a language
    if not counts:
        return [], None
    limits = F.create_map(*(F.lit(v) for r in counts for v in (r["lang"], int(min(1.0, per_language / r["count"]) * (1 << 62)))))
    spot = F.xxhash64(F.lit("sample"), F.col(key), F.col(text))
    rows = rows.filter(F.shiftrightunsigned(spot, 2) <= F.try_element_at(limits, F.col(lang)))
    rows = rows.select(spot.alias("spot"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.orderBy("spot", "lang").limit(int(1.5 * per_language) * len(counts))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            xs = [profile(t) for t in b.column(2).to_pylist()]
            at = [np.flatnonzero(x) for x in xs]
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(0), pa.array([zlib.crc32(x) for x in xs], pa.int64()), pa.array(at, pa.list_(pa.int32())), pa.array([x[i] for x, i in zip(xs, at, strict=True)], pa.list_(pa.float32()))],
                ["lang", "spot", "crc", "at", "x"],
            )

    got = materialize(rows.mapInArrow(sparse, "lang string, spot long, crc long, at array<int>, x array<float>"), "language_sample")
    return sorted(r["lang"] for r in got.select("lang").distinct().collect()), got


def train_pair(rows: pa.Table) -> pa.Table:
    """Weights of one pair from its sample (lang, spot, crc, at, x, pair, sign)."""
    rows = rows.sort_by([("spot", "ascending"), ("lang", "ascending"), ("crc", "ascending")]).combine_chunks()
    at, own = (rows.column(c).chunk(0) for c in ("at", "x"))
    x = np.zeros((rows.num_rows, WIDTH), np.float32)
    x[np.repeat(np.arange(rows.num_rows), at.value_lengths().to_numpy()), at.flatten().to_numpy()] = own.flatten().to_numpy()
    w = fit_svm(x, rows.column("sign").to_numpy())
    return pa.table({"pair": pa.array([rows.column("pair")[0].as_py()], pa.int64()), "w": pa.array([w.tobytes()], pa.binary())})


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    per_language: int = PER_LANGUAGE,
) -> LanguageModel:
    """Train on the rows of ``labelled`` whose language isn't null and whose text has a letter; none: a model that says und."""
    langs, rows = sample(labelled, text, lang, key, per_language)
    families: dict[str, list[str]] = {}
    for one in langs:
        families.setdefault(FAMILIES.get(one, one), []).append(one)
    pairs, sides = [], []  # sides: (language, number of a pair, sign)
    for names, prefix in [(list(families), "family "), *((own, "") for own in families.values())]:
        for ends in combinations(names, 2):
            for name, sign in zip(ends, (1, -1), strict=True):
                sides += [(one, len(pairs), sign) for one in (families[name] if prefix else [name])]
            pairs.append((prefix + ends[0], prefix + ends[1]))
    if not pairs:
        return LanguageModel(families, [], np.zeros((0, WIDTH), np.float32))
    deal = labelled.sparkSession.createDataFrame(sides, "lang string, pair long, sign int")
    dealt = rows.join(F.broadcast(deal), "lang").repartition(partitions(labelled.sparkSession), "pair")
    got = dealt.groupBy("pair").applyInArrow(train_pair, "pair long, w binary").collect()  # one row of weights a pair
    return LanguageModel(families, pairs, np.stack([np.frombuffer(r["w"], np.float32) for r in sorted(got, key=lambda r: r["pair"])]))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``score`` (0 to 1); null texts and texts without a letter are und, 0.

    Columns of these two names in ``docs`` are replaced; name others to keep them. Empty input gives an empty result.
    """
    held = docs.drop(lang_pred, score)
    shared = held.sparkSession.sparkContext.broadcast(model)  # one row of weights a pair of families or of languages in a family

    def guess(texts: pa.Array) -> pa.Array:
        langs, scores = [], []
        for at in range(0, len(texts), 256):  # only texts go to Python, and only slices of them are held there
            for lang, score in shared.value.predict(texts.slice(at, 256).to_pylist()):
                langs.append(lang)
                scores.append(score)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    once = F.arrow_udf(guess, "struct<lang: string, score: double>").asNondeterministic()  # so that no plan runs it twice
    found = "_" * (1 + max(map(len, held.columns))) + "found"
    out = held.withColumn(found, once(F.col(text)))
    return out.select(*held.columns, F.col(f"{found}.lang").alias(lang_pred), F.col(f"{found}.score").alias(score))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    model = fit(docs.filter(~held_out))
    found = identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")
