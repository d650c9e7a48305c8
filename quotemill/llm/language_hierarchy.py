"""Language identification in two steps: the family, then the language within it.

Method. A text is described by its letter runs of one to three letters. One
linear support vector machine per family tells families apart; within a family
one for each pair of languages decides by votes, ties by the sum of margins. As
machines only compare learned languages, the score is also bounded by an absolute
measure: how like the text is to what was learned of the language.

Training takes a bounded sample of labelled rows per language; prediction
covers every row, reads the whole text, and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.llm.linear import fit, sigmoid
from quotemill.llm.words import mix

# Labelled rows to learn from, in expectation, shared out over the languages.
SAMPLE_ROWS = 4000
DIM = 4096
UNKNOWN = "und"
_PIECE = 1 << 18
# The score of a text that is just as like its language as CUT_SHARE of what all but
# CUT_QUANTILE of the training texts with as many different letter runs are.
CUT_SCORE, CUT_SHARE, CUT_QUANTILE = 0.3, 0.9, 0.005

# Families of languages by ISO 639-1 code. A language not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru pl cs sk uk be bg sr hr bs sl mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "indic": "hi ur bn pa gu mr ne sa",
    "semitic": "ar he mt am",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


@cache
def _letters() -> np.ndarray:
    """For each code point its number among letters, 0 for others."""
    letters = np.zeros(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        if chr(code).isalpha():
            letters[code] = code
    return letters


def profile(text: str) -> np.ndarray | None:
    """Unit vector of hashed letter runs; None if there is no letter.

    Counts enter as square roots. A text is read in pieces, so that memory
    does not grow with its length; runs across a cut are left out.
    """
    counts = np.zeros(DIM)
    for a in range(0, len(text), _PIECE):
        codes = np.frombuffer(text[a : a + _PIECE].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        code = _letters()[codes].astype(np.uint64)
        # One 0 stands for each stretch of other characters, so that runs know where words begin and end.
        keep = (code > 0) | np.append(True, code[:-1] > 0)
        code = np.concatenate([[np.uint64(0)], code[keep], [np.uint64(0)]])
        if not code.any():
            continue
        run = code
        for size in (1, 2, 3):
            if size > 1:
                run = (run[:-1] << np.uint64(21)) | code[size - 1 :]
            solid = run[run > 0] + np.uint64(size << 62 if size < 3 else 0)
            counts += np.bincount((mix(solid) & np.uint64(DIM - 1)).astype(np.int64), minlength=DIM)
    if not counts.any():
        return None
    root = np.sqrt(counts)
    return root / np.linalg.norm(root)


class Languages:
    """Family machines and pair machines."""

    def __init__(self, matrix: np.ndarray, labels: list[str]):
        self.languages = sorted(set(labels))
        known = np.array(labels, dtype=object)
        families = np.array([FAMILY_OF.get(x, x) for x in labels], dtype=object)
        self.families = sorted(set(families))
        self.of = {f: [x for x in self.languages if FAMILY_OF.get(x, x) == f] for f in self.families}
        self.family_models = []
        if len(self.families) > 1:
            self.family_models = [self._fit(matrix, np.where(families == f, 1.0, -1.0)) for f in self.families]
        self.pairs = {}
        for f in self.families:
            for a, b in combinations(self.of[f], 2):
                use = (known == a) | (known == b)
                self.pairs[a, b] = self._fit(matrix[use], np.where(known[use] == a, 1.0, -1.0))

        self._calibrate(matrix, known)

    def _calibrate(self, matrix: np.ndarray, known: np.ndarray) -> None:
        """Mean profiles of languages, and the least likeness by size class of a text."""
        self.means, found = {}, {}
        for a in self.languages:
            own = matrix[known == a].astype(np.float64)
            total = own.sum(axis=0)
            self.means[a] = total / np.linalg.norm(total)
            if len(own) < 2:
                continue
            # A training text is compared with the others of its language.
            dots = own @ total
            others = np.sqrt(np.clip(total @ total - 2 * dots + (own * own).sum(axis=1), 1e-12, None))
            for x, likeness in zip(own, (dots - (own * own).sum(axis=1)) / others, strict=True):
                found.setdefault(self._size(x), []).append(likeness)
        self.cuts, least = {}, np.inf
        for size in range(max(found, default=-1), -1, -1):
            if size in found:
                least = min(least, CUT_SHARE * float(np.quantile(found[size], CUT_QUANTILE)))
            elif size < min(found):
                # Likeness falls with the root of the number of letter runs.
                least /= np.sqrt(2)
            self.cuts[size] = least

    @staticmethod
    def _size(x: np.ndarray) -> int:
        return int(np.log2(np.count_nonzero(x)))

    def _likeness_score(self, x: np.ndarray, language: str) -> float:
        """CUT_SCORE at the cut, below it for texts less like the language; 1 if nothing was calibrated."""
        if not self.cuts:
            return 1.0
        cut = self.cuts[min(self._size(x), max(self.cuts))]
        if cut <= 0:
            return 1.0
        excess = np.clip(float(x @ self.means[language]) / cut - 1, -1, 1)
        return float(sigmoid(np.array(np.log(CUT_SCORE / (1 - CUT_SCORE)) + 30 * excess)))

    @staticmethod
    def _fit(matrix: np.ndarray, y: np.ndarray):
        return fit(matrix, y, DIM, loss="hinge", l2=1e-4, steps=120)

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        if not self.languages:
            return UNKNOWN, 0.0
        family, score = self.families[0], 1.0
        if self.family_models:
            margins = np.array([x @ w + b for w, b in self.family_models])
            at = int(margins.argmax())
            family = self.families[at]
            second = np.delete(margins, at).max()
            score = float(sigmoid(2 * (margins[at] - second)))
        own = self.of[family]
        votes = {a: [0, 0.0] for a in own}
        margin = {}
        for a, b in combinations(own, 2):
            w, c = self.pairs[a, b]
            m = float(x @ w + c)
            margin[a, b] = m
            votes[a if m >= 0 else b][0] += 1
            votes[a][1] += m
            votes[b][1] -= m
        best = max(own, key=lambda a: (votes[a][0], votes[a][1]))
        for (a, b), m in margin.items():
            if best in (a, b):
                score = min(score, float(sigmoid(np.array(4 * (m if a == best else -m)))))
        score = min(score, self._likeness_score(x, best))
        return best, min(1.0, max(0.0, score))


def train_languages(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS
) -> Languages:
    """Learned from a sample of the rows of ``docs`` with a language and a letter.

    Each text of a language is one candidate, however often it is repeated. The share
    taken of a language is that which gives it its part of ``sample_rows``, by a hash
    of the text; rare languages are taken whole. Shares are a literal of one number a
    language, so no text is moved to look them up.
    """
    digest = F.xxhash64(F.col(text_col))
    told = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(text_col, lang_col)
    counts = told.select(lang_col, digest.alias("_h")).distinct().groupBy(lang_col).count().collect()
    n = len(counts)
    if not n:
        return Languages(np.zeros((0, DIM)), [])
    shares = F.create_map(*[F.lit(v) for row in counts for v in (row[lang_col], sample_rows / n / row["count"])])
    draw = F.pmod(digest, F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = told.where(draw < F.element_at(shares, F.col(lang_col)))
    sample = drawn.withColumn("_h", digest).dropDuplicates([lang_col, "_h"])

    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column(0), batch.column(1)
            rows = [(profile(t.as_py()), g.as_py()) for t, g in zip(texts, langs, strict=True)]
            rows = [(p, g) for p, g in rows if p is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p.astype("<f4").tobytes() for p, _ in rows], pa.binary()), pa.array([g for _, g in rows], pa.string())],
                names=["profile", "lang"],
            )

    table = sample.select(text_col, lang_col).mapInArrow(profiles, "profile binary, lang string").toArrow()
    matrix = np.frombuffer(b"".join(table["profile"].to_pylist()), dtype="<f4").reshape(-1, DIM)
    return Languages(matrix, table["lang"].to_pylist())


def identify(docs: DataFrame, model: Languages, *, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1).

    A text that is null, empty or has no letter gets `UNKNOWN` and 0. Columns of
    these names in ``docs`` are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(text_col):
                vector = profile(text.as_py() or "")
                lang, score = (UNKNOWN, 0.0) if vector is None else model.predict(vector)
                langs.append(lang)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return docs.mapInArrow(predict, T.StructType([*docs.schema.fields, *new]))
