"""Language identification in two steps: the language family, then the language within it.

Families are told apart by one-versus-rest linear SVMs; the languages of a family by
one linear SVM per pair, which vote. Inputs are hashed byte trigrams of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from chamberlens.llm.common import draw_limit, draw_of, free_names, in_letters, without
from chamberlens.llm.grams import byte_table, gram_counts, linear_svm, packed, platt, root_shares, sigmoid, unpacked

#: Languages by family; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "indic": ("hi", "ur", "bn", "mr", "ne", "gu", "pa"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he", "mt"),
}
UNKNOWN = "und"
ORDER, BITS = 3, 12

_LETTERS = byte_table(lambda b: b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32)


def features(text: str) -> np.ndarray:
    return root_shares(gram_counts(text, _LETTERS, ORDER, BITS))


def family_of(language: str) -> str:
    return next((f for f, members in FAMILIES.items() if language in members), language)


@dataclass
class LanguageModel:
    """One matrix of linear models, the families' first, then the pairs', all calibrated."""

    families: list[str]
    languages: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    links: np.ndarray
    column: dict = field(default_factory=dict)

    def __post_init__(self):
        self.column = {p: len(self.families) + i for i, p in enumerate(self.pairs)}

    @property
    def doubtful(self) -> float:
        """Scores below this are worse than a blind guess among the languages and one more."""
        return 1 / (1 + sum(map(len, self.languages.values())))

    def predict(self, text: str) -> tuple[str, float]:
        """Best family first, then the votes of its pairs; ties go to the larger sum of
        probabilities, then to the first name."""
        x = features(text)
        p = sigmoid((x @ self.weights[:-1] + self.weights[-1]) * self.links[0] + self.links[1])
        share = p[: len(self.families)]
        best = int(np.argmax(share))
        confidence = share[best] / max(share.sum(), 1e-12) if len(self.families) > 1 else 1.0
        members = self.languages[self.families[best]]
        if len(members) == 1:
            return members[0], float(confidence)
        votes, belief = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
        for a, b in combinations(members, 2):
            q = float(p[self.column[(a, b)]])
            votes[a if q >= 0.5 else b] += 1
            belief[a] += q
            belief[b] += 1 - q
        winner = max(members, key=lambda m: (votes[m], belief[m]))
        return winner, float(confidence * belief[winner] / (len(members) - 1))


def fit_languages(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id", per_language: int = 500, most_languages: int = 200
) -> LanguageModel | None:
    """Fit on ``per_language`` rows of each language, or all if there are fewer, chosen by
    a hash of ``key_col`` and text together.

    That and ``most_languages`` (the commonest are learned) bound what reaches the
    driver, however often a key occurs. Equal rows count once. Rows without language or
    letters are not used; None if nothing is left.
    """
    usable = docs.where(F.col(lang_col).isNotNull() & in_letters(F.col(text_col))).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), draw_of(F.col(key_col), F.col(text_col)).alias("draw")
    )
    counted = usable.groupBy("lang").agg(F.count("*").alias("count"), F.approx_count_distinct("draw").alias("different"))
    sizes = counted.orderBy(F.desc("count"), "lang").limit(most_languages).collect()
    if not sizes:
        return None
    chosen = None
    for row in sizes:  # twice as many and more, as the number of different rows is estimated
        drawn = (F.col("lang") == row["lang"]) & (F.col("draw") < draw_limit(2 * per_language + 100, row["different"]))
        chosen = drawn if chosen is None else chosen | drawn

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            langs, texts, draws = (c.to_pylist() for c in batch.columns)
            fresh = [i for i, row in enumerate(zip(langs, draws)) if row not in seen and not seen.add(row)]
            rows = [packed(features(texts[i])) for i in fresh]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([langs[i] for i in fresh], pa.string()),
                    pa.array([draws[i] for i in fresh], pa.int64()),
                    pa.array([r[0] for r in rows], pa.binary()),
                    pa.array([r[1] for r in rows], pa.binary()),
                ],
                names=["lang", "draw", "at", "value"],
            )

    rows = usable.where(chosen).mapInArrow(pack, "lang string, draw long, at binary, value binary")
    smallest = F.dense_rank().over(Window.partitionBy("lang").orderBy("draw"))
    rows = rows.withColumn("rank", smallest).where(F.col("rank") <= per_language).dropDuplicates(["lang", "draw"])
    rows = rows.select("lang", "at", "value").collect()
    if {r["lang"] for r in rows} != {r["lang"] for r in sizes}:
        raise RuntimeError("rows with a language exist, but none was drawn to learn from")
    rows = sorted(rows, key=lambda r: (r["lang"], r["at"], r["value"]))
    return _fitted(unpacked([(r["at"], r["value"]) for r in rows], 1 << BITS), np.array([r["lang"] for r in rows]))


def _fitted(x: np.ndarray, y: np.ndarray) -> LanguageModel | None:
    if not len(y):
        return None
    names = sorted(set(y.tolist()))
    families = sorted({family_of(n) for n in names})
    languages = {f: [n for n in names if family_of(n) == f] for f in families}
    pairs = [pair for f in families for pair in combinations(languages[f], 2)]
    of = np.array([family_of(n) for n in y.tolist()])
    apart = np.zeros(len(y), bool)  # a fifth of each language calibrates, the rest is fitted
    for name in names:
        mine = np.flatnonzero(y == name)
        if len(mine) >= 5:
            apart[mine[::5]] = True
    columns, links = [], []
    rests = [(np.full(len(y), True), of == f) for f in families]
    for i, (use, target) in enumerate(rests + [((y == a) | (y == b), y == a) for a, b in pairs]):
        if i == 1 and len(families) == 2:  # the mirror image of the first
            columns.append(-columns[0])
            links.append((links[0][0], -links[0][1]))
            continue
        side = np.where(target, 1.0, -1.0)
        fit, judge = use & ~apart, use & apart
        w = linear_svm(x[fit], side[fit], rounds=120)
        columns.append(w)
        if len(set(target[judge].tolist())) < 2:  # too few rows to keep some apart
            judge = use
        margins = x[judge] @ w[:-1].astype(np.float32) + w[-1]
        links.append(platt(margins.astype(np.float64), target[judge].astype(int)))
    return LanguageModel(families, languages, pairs, np.array(columns).T.astype(np.float32), np.array(links).T)


def identify_language(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """The documents with ``lang_pred`` and ``score`` (0 to 1), judged by the whole text alone.

    A null text, one without letters, and any text when there is no model (nothing to
    learn from) get ``und`` and score 0. Rows are judged one by one; repeated rows give
    repeated results; input columns with the names of the results are replaced.
    """
    base = without(docs, "lang_pred", "score")
    (lettered,) = free_names(base, "_lettered")
    if model is None:
        return base.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [*base.columns, "lang_pred", "score"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            lettered_here = batch.column(batch.num_columns - 1).to_pylist()
            found = [shared.value.predict(t.as_py()) if ok else (UNKNOWN, 0.0) for t, ok in zip(texts, lettered_here)]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=names,
            )

    schema = T.StructType([*base.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return base.withColumn(lettered, in_letters(F.col(text_col))).mapInArrow(judge, schema)
