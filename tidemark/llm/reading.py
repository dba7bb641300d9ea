"""Reading level of documents.

The prose of a text (code, logs, tables, headings and bare lists taken out) is
graded by five classic formulas: Flesch reading ease, Flesch-Kincaid, Gunning
fog, the automated readability index and Coleman-Liau. They need the length of
sentences, syllables (by hyphenation patterns) and letters. As in Gunning's
rule, independent clauses are counted as sentences of their own, so that long
chains of simple clauses do not pass for difficult prose. A document's value by
a formula is the mean of the middle half of its clauses; it is brought onto the scale of the
ratings by a monotone curve, and the level is the median of the five grades. The
ratings serve for these curves and the limit of the top band only.

Defined cases: null, empty and blank texts and texts without prose have no level
(null); clauses of fewer than four words have no grade unless there are no
others; raters are combined by their median and null ratings ignored; texts in
another language have no level on this scale (``english`` is false); very long
texts are read whole; without ratings every level is 3.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most rated documents that the fit uses; a few numbers of each come to the driver.
MAX_RATED = 20_000
#: Fewest words of a clause that is graded.
LEAST_WORDS = 4
#: Raters' bands from which a document counts as of the top band when the limit is fitted.
TOP_BAND = 4.75

FENCE = re.compile(r"```.*?(?:```|\Z)", re.S)
TAG = re.compile(r"<[^<>\n]+>")
LINK = re.compile(r"https?://\S+")
LOG = re.compile(r"\d{4}-\d\d-\d\d[T ]\d\d:")
BULLET = re.compile(r"(?:[-*•]|\d{1,3}[.)])\s+")
CLOSED = re.compile(r"[.!?][\"”’')\]]*$")
#: Abbreviations whose full stops end no sentence.
SHORT = ("e.g", "i.e", "a.m", "p.m", "approx", "etc", "vs", "cf", "no", "fig", "dr", "mr", "mrs", "ms", "st")
#: Ends of sentences and of independent clauses.
CLAUSE = re.compile(
    r"[.!?]+"
    + "".join(rf"(?<!\b(?i:{re.escape(x)})\.)" for x in SHORT)
    + r"[\"”’')\]]*(?:\s|$)|[;:]\s|,\s+(?:and|but|or|so|yet|nor)\s"
    r"|\s(?:and|so|because|although|while|since|if|when|whenever|unless|whereas)\s(?=(?:the|an?|it|they|we|you)\s)|(?<=[a-z])[.!?]+(?=[A-Z])"
)
VOWELS = re.compile(r"[aeiouy]+")
_QUOTES = "'’"
EDGES = ".,;:!?()[]{}\"“”'’‘*_`~<>"
CJK = re.compile(r"[぀-ヿ一-鿿가-힯]")

# fixed values: frequent function words by language
FUNCTION_WORDS = {
    "en": "the of and to in is that it for not be are by with as this from or which was an on at we you if they has have than can do".split(),
    "de": "der die das und ist nicht ein eine zu den von mit sich auf für dem werden wird im des auch es an als bei oder wenn sind".split(),
    "fr": "le la les et est des un une dans que pour pas sur avec du ce il qui ne par au sont ou plus cette aux si vous".split(),
    "es": "el la los las y es de que un una en por con para no se del al lo su como más o si son cada esta cuando".split(),
}
LANGUAGE_OF: dict[str, tuple[str, ...]] = {}
for _language, _words in FUNCTION_WORDS.items():
    for _word in _words:
        LANGUAGE_OF[_word] = (*LANGUAGE_OF.get(_word, ()), _language)


# fixed values: hyphenation patterns; the greatest digit at a place wins, an odd one allows a break before the next letter
HIATUS = """
i1a i1o i1u u1a u1o e1o i1i y1a y1i a1o i1et i1er i1en fri2en tri2en pi2er ti2er u1el u1en u1id u1it qu2i bu2il gu2i su2it
cre1a de1a. de1al re1al. re1al1i re1a. re1act re1as te1au be1in re1if re1in de1i o1em po1et co1e co1op
ti2o si2o ci2o gi2o xi2o ci2a ti2a si2a gi2a ti2u ci2u gi2u qu2a qu2o qu2e gu2a gu2e lli2o ni2on ri2age vi2ew
sci3en ci2e ti2et ti2en si2en xi2et eo2u ge2o pe2op u2ou y2ou ui2e u2ee
""".split()
# fixed values: the same for single vowels between consonants; an odd digit says that the next letter is silent
SILENT = """
1e. 1es. 1ed. bl2e. cl2e. dl2e. fl2e. gl2e. kl2e. pl2e. sl2e. tl2e. zl2e. bl2es. cl2es. dl2es. fl2es. gl2es. kl2es. pl2es. sl2es. tl2es. zl2es.
s2es. z2es. x2es. c2es. g2es. ch2es. sh2es. t2ed. d2ed. 1ement. 1ements. 1eful 1eless 1ely. l2ement l2ely. ag1ement
""".split()


def _patterns(texts: list[str]) -> dict[str, tuple[int, ...]]:
    """Letters of each pattern with the digits before, between and after them."""
    out = {}
    for text in texts:
        letters, digits = "", [0]
        for c in text:
            if c.isdigit():
                digits[-1] = int(c)
            else:
                letters += c
                digits.append(0)
        out[letters] = tuple(digits)
    return out


_HIATUS, _SILENT = _patterns(HIATUS), _patterns(SILENT)
_LONGEST = max(map(len, [*_HIATUS, *_SILENT]))


def _levels(word: str, patterns: dict[str, tuple[int, ...]]) -> list[int]:
    """Of each letter of ``.word.`` the greatest digit that a pattern puts before it."""
    levels = [0] * (len(word) + 1)
    for a in range(len(word)):
        for b in range(a + 1, min(len(word), a + _LONGEST) + 1):
            for k, digit in enumerate(patterns.get(word[a:b], ())):
                if digit > levels[a + k]:
                    levels[a + k] = digit
    return levels


def syllables(word: str) -> int:
    """Syllables of an English word: its vowel groups, split and silenced by hyphenation patterns."""
    w = f".{word.lower().rstrip(_QUOTES)}."
    breaks, silent = _levels(w, _HIATUS), _levels(w, _SILENT)
    n = 0
    for group in VOWELS.finditer(w):
        a, b = group.span()
        n += 1 + sum(breaks[k] % 2 for k in range(a + 1, b))
        n -= b == a + 1 and silent[a] % 2
    return max(1, n)


def prose_lines(text: str) -> list[str]:
    """The lines of ``text`` that are prose, without bullets, tags and links."""
    out = []
    for line in FENCE.sub("\n", text).splitlines():
        line = line.strip()
        if not line or line[0] in "|#{}[=<$>" and not CLOSED.search(line) or line[0] in "|#{" or LOG.match(line):
            continue
        line = BULLET.sub("", TAG.sub(" ", LINK.sub(" ", line)), count=1).strip()
        # headings, names in lists and notes such as "Owner: team" end without a full stop
        if line and (CLOSED.search(line) or len(line.split()) >= 8 or CJK.search(line)):
            out.append(line)
    return out


def clauses(text: str) -> list[list[str]]:
    """The clauses of the prose as lists of lower-case words; names with a hyphen and identifiers are left out."""
    out = []
    for line in prose_lines(text):
        for part in CLAUSE.split(line):
            words = []
            for word in part.split():
                word = word.strip(EDGES)
                if not word or "_" in word or not word[0].isalpha():
                    continue
                if "-" in word:
                    if word[0].isupper():
                        continue
                    words += [w.lower() for w in word.split("-") if w.isalpha()]
                else:
                    words.append(word.lower())
            if words:
                out.append(words)
    return out


def is_english(text: str, parts: list[list[str]]) -> bool:
    """Whether the function words of the prose are mostly English."""
    seen = dict.fromkeys(FUNCTION_WORDS, 0)
    total = 0
    for words in parts:
        total += len(words)
        for word in words:
            for language in LANGUAGE_OF.get(word, ()):
                seen[language] += 1
    others = max(n for language, n in seen.items() if language != "en")
    cjk = len(CJK.findall(text))
    return total > 0 and seen["en"] > others and seen["en"] * 40 >= total and cjk < 2 * total


_shapes: dict[str, int] = {}


def _shape_of(word: str) -> int:
    """Syllables and letters of a word as one number (65,536 times the first and the second), kept for the next time."""
    if len(_shapes) > 200_000:
        _shapes.clear()
    found = _shapes[word] = (syllables(word) << 16) + min(len(word), 65_535)
    return found


FORMULAS = ("reading_ease", "flesch_kincaid", "fog", "automated", "coleman_liau")


def formulas(parts: list[list[str]]) -> tuple[float, ...]:
    """The mean over the middle half of the clauses by each formula, each rising with difficulty; ``parts`` must hold a word."""
    graded = [p for p in parts if len(p) >= LEAST_WORDS] or parts
    n = np.array([len(p) for p in graded], float)
    known = _shapes.get
    shapes = np.array([known(word) or _shape_of(word) for words in graded for word in words], np.int64)
    first = (np.cumsum(n) - n).astype(np.int64)
    counts = shapes >> 16
    syllable, letter, hard = (np.add.reduceat(x, first) / n for x in (counts, shapes & 65_535, (counts >= 3).astype(np.int64)))
    values = (
        84.6 * syllable + 1.015 * n - 206.835,  # reading ease with its sign turned
        0.39 * n + 11.8 * syllable - 15.59,
        0.4 * (n + 100 * hard),
        4.71 * letter + 0.5 * n - 21.43,
        5.88 * letter - 29.6 / n - 15.8,
    )
    outer = len(n) // 4
    return tuple(float(np.sort(v)[outer : len(n) - outer].mean()) for v in values)


def monotone(x: np.ndarray, y: np.ndarray, knots: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """A rising curve through the means of ``knots`` groups, by pooling neighbours that fall."""
    order = np.argsort(x, kind="stable")
    groups = [g for g in np.array_split(order, min(knots, max(1, len(x) // 5 or 1))) if len(g)]
    blocks: list[list[float]] = []
    for g in groups:
        blocks.append([float(y[g].mean()), len(g), float(x[g].mean())])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            n = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / n, n, (a[2] * a[1] + b[2] * b[1]) / n])
    return np.array([b[2] for b in blocks]), np.array([b[0] for b in blocks])


@dataclass(frozen=True)
class Scale:
    """What a fit keeps: the curve of each formula and the limit of the top band."""

    curves: tuple[tuple[np.ndarray, np.ndarray], ...]
    top: float

    def level(self, values: tuple[float, ...]) -> float:
        return float(np.median([np.interp(v, *c) for v, c in zip(values, self.curves)]))


def rated_texts(documents: DataFrame, labels: DataFrame, limit: int = MAX_RATED) -> DataFrame:
    """``text`` and ``band`` (median of raters) of at most ``limit`` rated documents, chosen by a hash of their id."""
    bands = labels.where("band IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.median("band").alias("band"))
    chosen = bands.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return documents.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "band")


def top_limit(levels: np.ndarray, bands: np.ndarray) -> float:
    """The level from which documents count as of the top band: the limit with the best F1 on the rated ones."""
    top = bands >= TOP_BAND
    if not top.any():
        return 4.5
    limits = np.unique(np.round(np.quantile(levels, np.linspace(0, 1, 1001)), 4))
    scores = [2 * (top & (levels >= x)).sum() / (top.sum() + (levels >= x).sum()) for x in limits]
    best = np.flatnonzero(np.asarray(scores) >= max(scores) - 1e-12)
    return float(limits[best[len(best) // 2]])


def fit_scale(documents: DataFrame, labels: DataFrame, limit: int = MAX_RATED) -> Scale:
    """Fits the curves on a bounded sample of rated documents.

    To the driver come at most ``limit`` rows of formula values, never texts.
    """
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(b, formulas(p)) for t, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if (p := clauses(t)) and is_english(t, p)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(r[0]) for r in rows], pa.float64()), pa.array([list(r[1]) for r in rows], pa.list_(pa.float64()))], names=["band", "values"]
            )

    rows = rated_texts(documents, labels, limit).mapInArrow(measure, "band double, values array<double>").collect()
    if not rows:
        flat = (np.array([0.0]), np.array([3.0]))
        return Scale(tuple(flat for _ in FORMULAS), 4.5)
    bands = np.array([r["band"] for r in rows])
    values = np.array([r["values"] for r in rows])
    scale = Scale(tuple(monotone(values[:, k], bands) for k in range(len(FORMULAS))), 0.0)
    levels = np.array([scale.level(tuple(v)) for v in values])
    return Scale(scale.curves, top_limit(levels, bands))


def reading_levels(documents: DataFrame, scale: Scale, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, english, n_words, level`` and the band (1 to 5) of every row; ``top`` says whether it is of the top band."""
    shared = documents.sparkSession.sparkContext.broadcast(scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        for batch in batches:
            out = []
            for t in batch.column(1).to_pylist():
                parts = clauses(t) if t else []
                english = bool(parts) and is_english(t, parts)
                level = s.level(formulas(parts)) if english else None
                out.append((english, sum(map(len, parts)), level, bool(english and level >= s.top)))
            kinds = (pa.bool_(), pa.int64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]], names=["doc_id", "english", "n_words", "level", "top"]
            )

    graded = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string")).mapInArrow(
        run, "doc_id bigint, english boolean, n_words bigint, level double, top boolean"
    )
    band = F.when(F.col("top"), 5).when(F.col("level").isNotNull(), F.greatest(F.lit(1), F.least(F.lit(4), F.round("level").cast("int"))))
    return graded.select("doc_id", "english", "n_words", "level", band.cast("int").alias("band"), "top")
