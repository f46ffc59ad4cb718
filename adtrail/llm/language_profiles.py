"""Language identification by hyperdimensional profiles (operator 4).

Every letter has a random vector of +1 and -1. An n-gram's vector binds its
letters' vectors, each permuted (rotated) by its place, by multiplication; a
text's vector bundles its n-grams by addition; a language's prototype bundles
all training texts of that language. A text gets the language whose prototype
has the largest cosine with the text's vector.

Letters are lower-cased; everything else is one blank, which is a symbol of
its own. A letter's vector follows from its code point and the seed, so any
alphabet works and nothing is kept per corpus.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
rows without a label, or without a text, train nothing; of equal cosines the
language first in order wins; without any training row every text is ``und``;
an empty table gives no rows; columns other than the named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from adtrail.llm import common as C

DIMENSIONS = 1024
NGRAM = 3
SEED = 20_240_607
UNKNOWN = "und"
MAX_LANGUAGES = 1000  # prototypes are sent to every task: at most 8 MB

MEMO_GRAMS = 32_768   # n-gram vectors a worker keeps (32 MB)


class Profiles:
    """n-gram vectors of one worker."""

    def __init__(self, dimensions: int, n: int, seed: int):
        self.dimensions, self.n, self.seed = dimensions, n, seed
        self.folded = np.full(0x110000, -1, np.int32)  # lower-cased letter, 0 for all else; -1: not met yet
        self.letters: dict[int, np.ndarray] = {}
        self.clear()

    def clear(self) -> None:
        self.codes = np.zeros(0, np.int64)        # n-grams met, sorted
        self.rows = np.zeros(0, np.int64)         # their rows in ``vectors``
        self.vectors = np.zeros((0, self.dimensions), np.int8)

    def symbols(self, text: str) -> np.ndarray:
        """Folded code points, with runs of other characters as one 0, and
        one 0 at both ends."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        got = self.folded[points]
        if (got < 0).any():
            for p in np.unique(points[got < 0]).tolist():
                c = chr(p)
                low = c.lower()
                self.folded[p] = (ord(low) if len(low) == 1 else p) if c.isalpha() else 0
            got = self.folded[points]
        got = np.concatenate([[0], got, [0]])
        return got[np.concatenate([[True], (got[1:] != 0) | (got[:-1] != 0)])]

    def grams(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams of a text as codes (21 bits a symbol) and counts."""
        s = self.symbols(text).astype(np.int64)
        if len(s) < self.n or not s.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        code = s[:len(s) - self.n + 1].copy()
        for k in range(1, self.n):
            code = (code << 21) | s[k:len(s) - self.n + 1 + k]
        return np.unique(code, return_counts=True)

    def letter(self, symbol: int) -> np.ndarray:
        if symbol not in self.letters:
            rng = np.random.Generator(np.random.PCG64([self.seed, symbol]))
            self.letters[symbol] = (rng.integers(0, 2, self.dimensions, dtype=np.int8) * 2 - 1).astype(np.int8)
        return self.letters[symbol]

    def _bind(self, codes: np.ndarray) -> np.ndarray:
        out = np.ones((len(codes), self.dimensions), np.int8)
        for k in range(self.n):
            symbols, where = np.unique((codes >> (21 * (self.n - 1 - k))) & 0x1FFFFF, return_inverse=True)
            placed = np.stack([np.roll(self.letter(int(x)), self.n - 1 - k) for x in symbols])
            out *= placed[where]
        return out

    def gram_vectors(self, codes: np.ndarray) -> np.ndarray:
        """Bound vectors of distinct sorted codes, from the memo where known."""
        at = np.searchsorted(self.codes, codes)
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == codes[known]
        if not known.all():
            new = codes[~known]
            if len(self.codes) + len(new) > MEMO_GRAMS:
                self.clear()
                new = codes
            if len(new) > MEMO_GRAMS:
                return self._bind(codes)
            rows = np.arange(len(self.vectors), len(self.vectors) + len(new))
            self.vectors = np.concatenate([self.vectors, self._bind(new)])
            order = np.argsort(np.concatenate([self.codes, new]), kind="stable")
            self.rows = np.concatenate([self.rows, rows])[order]
            self.codes = np.concatenate([self.codes, new])[order]
            at = np.searchsorted(self.codes, codes)
        return self.vectors[self.rows[at]]

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the n-grams' vectors, in slices of bounded memory."""
        total = np.zeros(self.dimensions, np.float64)
        for a in range(0, len(codes), 4096):
            vectors = self.gram_vectors(codes[a:a + 4096])
            total += counts[a:a + 4096].astype(np.float32) @ vectors.astype(np.float32)
        return total


_PROFILES: dict[tuple[int, int, int], Profiles] = {}


def profiles(dimensions: int, n: int, seed: int) -> Profiles:
    key = (dimensions, n, seed)
    if key not in _PROFILES:
        _PROFILES[key] = Profiles(*key)
    return _PROFILES[key]


def count_grams(batches, n: int, seed: int, dimensions: int) -> Iterator[pa.RecordBatch]:
    """``lang, gram, n`` of a task's training texts, summed per slice."""
    p = profiles(dimensions, n, seed)
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        by_lang: dict[str, list[str]] = {}
        for text, lang in zip(texts, langs):
            by_lang.setdefault(lang, []).append(text)
        for lang, group in by_lang.items():
            for a, b in C.slices([len(t) for t in group]):
                # texts end and begin with a blank, so no n-gram of letters spans two
                codes, counts = p.grams("\n".join(group[a:b]))
                if len(codes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)],
                        ["lang", "gram", "n"])


def bundle_partition(batches, dimensions: int, n: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Partial prototypes of a task's share of the n-gram counts."""
    p = profiles(dimensions, n, seed)
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        codes, counts = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        for lang in set(langs.tolist()):
            mine = langs == lang
            order = np.argsort(codes[mine])
            part = p.bundle(codes[mine][order], counts[mine][order])
            sums[lang] = sums[lang] + part if lang in sums else part
    for lang, total in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * dimensions, pa.string()), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(total)],
            ["lang", "dimension", "value"])


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS,
          n: int = NGRAM, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Prototypes of all labelled rows. n-grams are counted before anything is
    shuffled, and their number per language is bounded by the alphabet; the
    driver gets ``dimensions`` numbers a language."""
    rows = (labelled.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
            .where("text IS NOT NULL AND lang IS NOT NULL"))
    counts = (C.map_batches(rows, count_grams, "lang string, gram long, n long", n=n, seed=seed, dimensions=dimensions)
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    parts = C.map_batches(counts, bundle_partition, "lang string, dimension int, value double",
                          dimensions=dimensions, n=n, seed=seed)
    summed = parts.groupBy("lang", "dimension").agg(F.sum("value").alias("value"))
    per_lang = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("dimension", "value"))).alias("v"))
    got = sorted((r["lang"], [x["value"] for x in r["v"]]) for r in per_lang.limit(MAX_LANGUAGES + 1).collect())
    if len(got) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = [g[0] for g in got]
    matrix = np.array([g[1] for g in got], np.float64).reshape(len(got), dimensions)
    return names, matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)


def classify(batches, names: list[str], prototypes: np.ndarray, n: int, seed: int) -> Iterator[pa.RecordBatch]:
    p = profiles(prototypes.shape[1], n, seed)
    for batch in batches:
        langs, scores = [], []
        for text in batch.column(-1).to_pylist():
            lang, score = UNKNOWN, 0.0
            if text is not None and names:
                codes, counts = p.grams(text)
                if len(codes):
                    v = p.bundle(codes, counts)
                    cosines = prototypes @ v / max(np.linalg.norm(v), 1e-12)
                    best = int(np.argmax(cosines))
                    lang, score = names[best], float(min(1.0, max(0.0, cosines[best])))
            langs.append(lang)
            scores.append(score)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["row", "lang_pred", "score"])


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", n: int = NGRAM,
             seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns to keep, all by default, so that no
    name can clash), ``lang_pred`` and ``score``."""
    names, prototypes = model
    keep = docs.columns if keep is None else keep
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    schema = StructType([packed.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return C.map_batches(packed, classify, schema, names=names, prototypes=prototypes, n=n, seed=seed)


def held_out(id_col: str = "doc_id"):
    """The fold that never trains: crc32 of the id as text, modulo 3, is 1. A
    null id is in no fold and trains."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op4_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out()))
    out = identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model,
                   keep=["doc_id", "held_out"])
    return out.select("row.doc_id", "row.held_out", "lang_pred", "score")
