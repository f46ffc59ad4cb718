"""Exact token counts of every prefix of every text (operator 12).

A prefix's encoding by byte-pair merging ends in exactly one piece ``t`` such
that the encoding of the prefix without ``t`` ends in a piece that stands
unmerged before ``t``. So one pass over a text gives each prefix's count as
the count of a shorter prefix plus one (or the bytes of a character the
vocabulary lacks), and no prefix is encoded by itself. Pieces hold blanks only
at their start and never a line break, so a text falls into words that do not
touch each other; a worker keeps the count steps of words it has met (bounded).

The store holds, for each stretch of ``CHUNK`` characters, the counts before
and after it and the steps from character to character (a step is negative
where a longer prefix merges into fewer pieces). Totals need the counts
columns only; cuts at a budget and counts at given places read the steps, and
nothing is encoded again.

Defined cases: a null text is the empty text (0 bytes, 0 tokens, one stretch
without steps); null and repeated ids are counted row by row; a step outside
-128..127 makes the text's stretches wide (32 bits a step); an empty table gives
an empty store; columns other than id and text are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.llm import common as C
from adtrail.llm import tokens

CHUNK = 1 << 16
LIMIT_TOKENS = 4096
STRETCH = 4096  # characters of a word for which all states are held at once
MEMO_WORDS = 600_000
MEMO_PAIRS = 1_000_000
BLANK = "▁"  # how the vocabulary writes a blank

STORE = ("row long, doc_id long, part int, last boolean, n_bytes long, start long, tokens_before long, "
         "tokens long, wide boolean, steps binary")


class PrefixCounter:
    """Prefix counts under one sentencepiece BPE vocabulary."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, trained = model.normalizer_spec, model.trainer_spec
        kinds = pb.ModelProto.SentencePiece
        if (trained.model_type != pb.TrainerSpec.BPE or not trained.byte_fallback or trained.treat_whitespace_as_suffix
                or spec.precompiled_charsmap or not spec.add_dummy_prefix or not spec.escape_whitespaces
                or spec.remove_extra_whitespaces
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)):
            raise ValueError(f"{path}: not a byte-fallback BPE vocabulary without normalisation")
        self.score = {p.piece.replace(BLANK, " "): p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.touching = {p[i:i + 2] for p in self.score for i in range(len(p) - 1)}
        if any("\n" in t or t[1] == " " and t != "  " for t in self.touching):
            raise ValueError(f"{path}: pieces span words or lines")
        self.longest = max(map(len, self.score))
        self.after: dict[str, Followers] = {}
        self.n_pairs = 0
        self.words = re.compile(r"\n| *[^ \n]+| +").findall
        self.memo = tokens.Memo(self.learn, MEMO_WORDS // 2)

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text: the best pair merges first, the leftmost of equals."""
        parts = list(text)
        while True:
            best = at = None
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def followers(self, piece: str) -> Followers:
        """What is known of pieces after ``piece`` ('': at the start)."""
        known = self.after.get(piece)
        if known is None:
            if self.n_pairs >= MEMO_PAIRS:
                self.after.clear()
                self.n_pairs = 0
            known = self.after[piece] = Followers(self, piece)
        return known

    def steps(self, word: str) -> array:
        """Count of each prefix less that of the one before it."""
        score, after, out = self.score, self.after, array("i")
        lasts, counts = [self.followers("")], [0]  # of prefixes up to the place reached
        while len(out) < len(word):
            lasts, counts = lasts[-self.longest:], counts[-self.longest:]
            base = len(out) + 1 - len(lasts)
            text = word[base:len(out) + STRETCH]
            for end in range(len(lasts), len(text) + 1):
                begin = end - 1
                piece = text[begin]
                size = lasts[begin][piece]
                while not size:
                    begin -= 1  # one piece fits, so this ends
                    piece = text[begin:end]
                    if piece in score:
                        size = lasts[begin][piece]
                size += counts[begin]
                out.append(size - counts[-1])
                counts.append(size)
                lasts.append(after.get(piece) or self.followers(piece))
        return out

    def learn(self, word: str) -> bytes:
        """Steps of a word the memo lacks, 8 bits each. It falls apart wherever
        no piece holds both neighbours, as between a letter and a full stop."""
        cuts = [i for i in range(1, len(word)) if word[i - 1:i + 1] not in self.touching]
        if not cuts:
            return array("b", self.steps(word)).tobytes()
        return b"".join([self.memo[word[a:b]] for a, b in zip([0, *cuts], [*cuts, len(word)])])

    def text_steps(self, text: str) -> np.ndarray:
        """Steps of a whole text, 8 bits each where they fit."""
        words = self.words(text.replace(BLANK, " "))
        if not words:
            return np.zeros(0, np.int8)
        words[0] = " " + words[0]  # the library's own blank, which belongs to the first character
        try:
            steps = np.frombuffer(b"".join(map(self.memo.__getitem__, words)), np.int8)
            lead = int(steps[0]) + int(steps[1])
            if -128 <= lead <= 127:
                return np.concatenate([np.array([lead], np.int8), steps[2:]])
        except OverflowError:
            pass
        steps = np.concatenate([np.frombuffer(self.steps(w), np.int32) for w in words])
        return np.concatenate([steps[:1] + steps[1:2], steps[2:]]).astype(np.int32)


class Followers(dict):
    """Tokens of a piece that stays whole after ``before``: 1, or the bytes of
    a character the vocabulary lacks; 0 when it is no piece or does not stay."""

    def __init__(self, count: PrefixCounter, before: str):
        self.count, self.before = count, before

    def __missing__(self, piece: str) -> int:
        size = 1 if piece in self.count.score else len(piece.encode()) if len(piece) == 1 else 0
        if size:
            pair = [p for p in (self.before, piece) if p]
            if self.count.merged(self.before + piece) != pair:
                size = 0
        self.count.n_pairs += 1
        self[piece] = size
        return size


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter per worker process and vocabulary."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def count_prefixes(batches, path: str, chunk: int) -> Iterator[pa.RecordBatch]:
    count = counter(path)
    types = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("part", pa.int32()), ("last", pa.bool_()),
                       ("n_bytes", pa.int64()), ("start", pa.int64()), ("tokens_before", pa.int64()),
                       ("tokens", pa.int64()), ("wide", pa.bool_()), ("steps", pa.binary())])
    for batch in batches:
        keys, ids, texts = (batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))
        for a, b in C.slices([len(t) for t in texts]):
            rows = []
            for key, doc, text in zip(keys[a:b], ids[a:b], texts[a:b]):
                steps = count.text_steps(text)
                size, before = len(text.encode()), 0
                for part, start in enumerate(range(0, max(len(steps), 1), chunk)):
                    some = steps[start:start + chunk]
                    after = before + int(some.sum(dtype=np.int64))
                    rows.append((key, doc, part, start + chunk >= len(steps), size, start, before, after,
                                 steps.itemsize > 1, some.tobytes()))
                    before = after
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], schema=types)


def prefix_counts(docs: DataFrame, vocabulary: str | None = None, chunk: int = CHUNK,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The store of all documents (see the module text), without a shuffle:
    ``row`` numbers the rows, ``part`` a row's stretches; ``start`` and
    ``tokens_before`` are the characters and tokens before the stretch,
    ``tokens`` the count at its end. Write it once; the functions below read it."""
    path = vocabulary or tokens.vocabulary_path("piece_bpe_32k.model")
    texts = C.id_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return C.map_batches(texts, count_prefixes, STORE, path=path, chunk=chunk)


def token_counts(store: DataFrame) -> DataFrame:
    """``row, doc_id, n_bytes, n_tokens`` of whole texts; reads no steps."""
    return store.where("last").select("row", "doc_id", "n_bytes", F.col("tokens").alias("n_tokens"))


def _running(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Characters before a stretch and the counts after each of its characters."""
    cols = [batch.column(c).to_pylist() for c in ("start", "tokens_before", "wide", "steps")]
    for start, before, wide, data in zip(*cols):
        yield start, before + np.cumsum(np.frombuffer(data, np.int32 if wide else np.int8), dtype=np.int64)


def cut_at_budget(batches, budget: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chars, sizes = [], []
        for start, counts in _running(batch):
            within = np.flatnonzero(counts <= budget)
            chars.append(start + int(within[-1]) + 1 if len(within) else 0)
            sizes.append(int(counts[within[-1]]) if len(within) else 0)
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(chars, pa.int64()),
                                          pa.array(sizes, pa.int64())], ["row", "doc_id", "n_chars", "n_tokens"])


def longest_prefixes(store: DataFrame, budget: int) -> DataFrame:
    """Per row the longest prefix of at most ``budget`` tokens: ``row, doc_id,
    n_chars, n_tokens``. Counts may fall as a prefix grows, so it is the last
    place that fits, not the place before the first that does not."""
    if budget < 0:
        raise ValueError("budget must not be negative")
    cuts = C.map_batches(store.select("row", "doc_id", "start", "tokens_before", "wide", "steps"), cut_at_budget,
                         "row long, doc_id long, n_chars long, n_tokens long", budget=budget)
    return (cuts.groupBy("row").agg(F.max(F.struct("n_chars", "n_tokens", "doc_id")).alias("best"))
            .select("row", "best.doc_id", "best.n_chars", "best.n_tokens"))


def count_at(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = batch.column("n_chars").to_pylist()
        sizes = [int(counts[n - start - 1]) if n > start else 0
                 for n, (start, counts) in zip(places, _running(batch))]
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), batch.column("n_chars"),
                                          pa.array(sizes, pa.int64())], ["row", "doc_id", "n_chars", "n_tokens"])


def tokens_at(store: DataFrame, places: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Counts of the prefixes asked for (``row``, ``n_chars``; lengths beyond
    the text give no row, 0 gives 0): ``row, doc_id, n_chars, n_tokens``."""
    asked = places.select("row", F.col("n_chars").cast("long").alias("n_chars"),
                          F.floor(F.greatest(F.col("n_chars") - 1, F.lit(0)) / chunk).cast("int").alias("part"))
    held = store.select("row", "doc_id", "part", "start", "tokens_before", "wide", "steps")
    size = F.length("steps") / F.when(F.col("wide"), 4).otherwise(1)
    met = held.join(asked, ["row", "part"]).where((F.col("n_chars") >= 0) & (F.col("n_chars") <= F.col("start") + size))
    return C.map_batches(met.drop("part"), count_at, "row long, doc_id long, n_chars long, n_tokens long")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = C.materialize(prefix_counts(C.table(spark, sf_dir, "documents")), "prefix-counts")
    return token_counts(store).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT_TOKENS).alias("over_limit"))
