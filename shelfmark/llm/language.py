"""Language identification by hierarchical discrimination.

A text is first assigned to a language family, then one-versus-one linear
support vector machines separate the languages within that family. Features are
hashed byte trigrams of the lower-cased letters of the whole text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.frames import append_columns, put_by

#: Families of languages that are easily confused.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is"),
    "romance": ("fr", "es", "it", "pt", "ca", "ro", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "mr", "ne", "bn", "ur"),
}
UNDETERMINED = "und"
DIMENSIONS = 1 << 12
#: Training rows of each language, drawn by a hash of the id: about this many, at most twice on average.
SAMPLE = 800
EPOCHS = 12
PENALTY = 10.0
#: Letters counted at once, so that a very long text needs no long arrays.
STRIDE = 1 << 20
_NO_LETTERS = re.compile(r"[\W\d_]+")


def family_of(language: str) -> str:
    """The family of a language code; an unknown code is in the family ``other``."""
    return next((f for f, members in FAMILIES.items() if language in members), "other")


def counts_of(text: str | None) -> np.ndarray | None:
    """Counts of the hashed byte trigrams of ``text``; null if it has no letter."""
    letters = _NO_LETTERS.sub(" ", text or "").lower().strip()
    if not any(map(str.isalpha, letters)):  # superscripts, fractions and Roman numerals are no letters
        return None
    data = np.frombuffer(f" {letters} ".encode(), np.uint8)
    counts = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, len(data) - 2, STRIDE):
        part = data[at : at + STRIDE + 2].astype(np.uint32)
        mixed = (part[:-2] * np.uint32(0x9E3779B1)) ^ (part[1:-1] * np.uint32(0x85EBCA77)) ^ (
            part[2:] * np.uint32(0xC2B2AE3D))
        mixed *= np.uint32(0x27D4EB2F)
        counts += np.bincount(mixed >> np.uint32(20), minlength=DIMENSIONS)
    return counts


def _unit(counts: np.ndarray) -> np.ndarray:
    """Square roots of the shares: a unit vector."""
    return np.sqrt(counts / counts.sum())


def train_svm(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> np.ndarray:
    """A linear support vector machine by dual coordinate descent; the last weight is the bias.

    A row is the places and values of its entries that aren't zero. Rows of each
    class weigh as much as those of the other together.
    """
    norms = np.array([float(values @ values) for _, values in x]) + 1
    bound = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum()))) * PENALTY
    weights, bias, alpha = np.zeros(DIMENSIONS, np.float32), 0.0, np.zeros(len(x))
    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(x)):
            places, values = x[i]
            gradient = y[i] * (float(values @ weights[places]) + bias) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), bound[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                weights[places] += np.float32(step) * values
                bias += step
                alpha[i] = new
    return np.append(weights, bias).astype(float)


@dataclass
class Model:
    """Weights of each pair of families, and of each pair of languages of a family."""

    families: list[str]
    languages: dict[str, list[str]]
    between: dict[tuple[str, str], np.ndarray]
    within: dict[tuple[str, str], np.ndarray]

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = counts_of(text)
        if counts is None or not self.families:
            return UNDETERMINED, 0.0
        vector = np.append(_unit(counts), 1.0)
        family, sure = _vote(self.families, self.between, vector)
        language, surer = _vote(self.languages[family], self.within, vector)
        return language, float(1 / (1 + np.exp(-4 * min(sure, surer))))


def _vote(names: list[str], machines: dict, vector: np.ndarray) -> tuple[str, float]:
    """The name with the most wins, then the largest sum of margins, and its smallest margin."""
    if len(names) == 1:
        return names[0], np.inf
    wins, total, least = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, np.inf)
    for a, b in combinations(names, 2):
        margin = float(machines[a, b] @ vector)
        for name, m in ((a, margin), (b, -margin)):
            wins[name] += m > 0
            total[name] += m
            least[name] = min(least[name], m)
    best = max(names, key=lambda n: (wins[n], total[n]))
    return best, least[best]


def held_out(id_col: str = "doc_id") -> Column:
    """True for the quarter of ids that no model learns from; a null id isn't held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
          sample: int = SAMPLE) -> Model:
    """Learn from rows with text and language that aren't held out.

    Counting the labels reads two columns. All labels are learned. The sample has
    about ``sample`` rows of each where there are so many, chosen by a hash of the
    id, and twice as many in all at most; its trigram counts are all that reaches
    the driver. Labels without a usable text are not learned; with none at all
    the model answers ``und``.
    """
    known = docs.where(~held_out(id_col) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(id_col)).alias("h")
    )
    sizes = known.groupBy("lang").count().collect()
    if not sizes:
        return Model([], {}, {}, {})
    share = F.create_map(*[F.lit(v) for r in sizes for v in (r["lang"], min(1.0, sample / r["count"]))])
    drawn = known.where(
        (F.shiftrightunsigned("h", 32).cast("double") / float(1 << 32)) < F.element_at(share, F.col("lang"))
    ).limit(2 * sample * len(sizes))

    def start():
        def batch(texts):
            out = []
            for t in texts:
                counts = counts_of(t)
                used = None if counts is None else np.flatnonzero(counts)
                out.append(None if counts is None else np.stack([used, counts[used]]).astype(np.int32).tobytes())
            return [out]
        return batch

    rows = append_columns(drawn, "text", start, "grams binary").select("lang", "h", "grams").collect()
    rows = sorted((r for r in rows if r["grams"]), key=lambda r: (r["h"], r["lang"]))
    x = []
    for r in rows:
        places, counts = np.frombuffer(r["grams"], np.int32).reshape(2, -1)
        x.append((places, np.sqrt(counts / counts.sum()).astype(np.float32)))
    labels = np.array([r["lang"] for r in rows])
    languages: dict[str, list[str]] = {}
    for name in sorted(set(labels)):
        languages.setdefault(family_of(name), []).append(str(name))
    families = np.array([family_of(v) for v in labels])

    def machines(names, of):
        out = {}
        for a, b in combinations(names, 2):
            own = np.flatnonzero((of == a) | (of == b))
            out[a, b] = train_svm([x[i] for i in own], np.where(of[own] == a, 1.0, -1.0))
        return out

    within = {}
    for names in languages.values():
        within |= machines(names, labels)
    return Model(sorted(languages), languages, machines(sorted(languages), families), within)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` of each whole text.

    A text that is null or has no letter is ``und`` with score 0. The score is
    the logistic of the smallest margin on the way to the answer. Columns of
    ``docs`` that bear these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        predict = shared.value.predict

        def batch(texts):
            found = [predict(t) for t in texts]
            return [[f[0] for f in found], [f[1] for f in found]]
        return batch

    return append_columns(docs, text, start, "lang_pred string, score double")


#: Below this score even the machines that won were against the answer.
LEAST_SCORE = 0.5


def keep_identified(docs: DataFrame, text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """Rows of ``docs`` whose language is found with at least score ``least``; all columns as they are.

    The model is learned from the given rows. Texts without a letter go.
    """
    others, aside = put_by(docs, "lang_pred", "score")
    found = identify(others, train(docs, text=text), text)
    kept = found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return kept.drop("lang_pred", "score").withColumnsRenamed(aside).select(*docs.columns)
