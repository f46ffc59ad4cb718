"""Document fingerprints as Merkle trees (operator 5).

A text is cut into paragraphs (lines); long paragraphs are cut into sentences
so that an edit touches a small leaf, and what is still long (other scripts,
tables, word lists) at the least hash of a few characters, so no leaf is longer
than ``LEAF_CHARS`` and the cuts after an edit fall where they fell. Consecutive paragraphs form sections,
whose ends follow from the content (a blank line, or a paragraph hash whose
low bits are zero), so an insertion does not move later sections. Leaves are
hashed, paragraphs hash their leaves, sections their paragraphs, the root the
sections. Equal roots mean equal texts; where roots differ, equal branches are
skipped and the differing leaves locate the edit.

A fingerprint is ``root;leaf,leaf/leaf;leaf...``: sections are separated by
``;``, paragraphs by ``/``, leaves by ``,``; a leaf is 10 hexadecimal digits of
its hash and its length.

Defined cases: a null text is the empty text, whose fingerprint is a root
alone; null ids sort after all others; rows with the same id are ordered by
their text; a single document is its own next document; an empty table gives
no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adtrail.llm import common as C

LEAF_CHARS = 160      # paragraphs above this are cut into sentences, sentences above this further
LEAST_CHARS = 32      # of a leaf cut from a sentence, but for its last
GRAM = 4              # characters hashed to find a cut
SECTION_MASK = 3      # a section holds about four paragraphs

_WEIGHTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_SENTENCE = re.compile(r"[^.!?]*[.!?]+\s*|[^.!?]+$")


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def leaves(paragraph: str) -> list[str]:
    """The paragraph's pieces; joined they are the paragraph."""
    if len(paragraph) <= LEAF_CHARS:
        return [paragraph]
    out = []
    for sentence in _SENTENCE.findall(paragraph) or [paragraph]:
        out += _pieces(sentence) if len(sentence) > LEAF_CHARS else [sentence]
    return out


def _pieces(sentence: str) -> list[str]:
    """Leaves of LEAST_CHARS to LEAF_CHARS characters (the last may be
    shorter), each ending after the first gram of least hash in that range."""
    points = np.frombuffer(sentence.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    gram = points[GRAM - 1:]
    for i in range(1, GRAM):
        gram = gram + points[GRAM - 1 - i:-i] * _WEIGHTS[i]
    order = gram * _WEIGHTS[0]
    order ^= order >> np.uint64(32)
    order *= _WEIGHTS[0]  # the gram that ends with character k + GRAM - 1
    out, at = [], 0
    while len(sentence) - at > LEAF_CHARS:
        low = at + LEAST_CHARS
        cut = low + int(order[low - GRAM:at + LEAF_CHARS - GRAM + 1].argmin())
        out.append(sentence[at:cut])
        at = cut
    out.append(sentence[at:])
    return out


def tree(text: str) -> list[list[list[tuple[bytes, int]]]]:
    """Sections of paragraphs of (leaf hash, leaf length)."""
    sections, section = [], []
    for paragraph in text.splitlines(keepends=True) if text else []:
        section.append([(_hash(p.encode("utf-8", "surrogatepass")), len(p)) for p in leaves(paragraph)])
        if paragraph.isspace() or _hash(b"".join(h for h, _ in section[-1]))[0] & SECTION_MASK == 0:
            sections.append(section)
            section = []
    if section:
        sections.append(section)
    return sections


def fingerprint(text: str) -> str:
    sections = tree(text)
    nodes = [_hash(b"s" + b"".join(_hash(b"p" + b"".join(h for h, _ in p)) for p in s)) for s in sections]
    parts = [_hash(b"r" + b"".join(nodes)).hex()]
    parts += ["/".join(",".join(h.hex()[:10] + str(n) for h, n in p) for p in s) for s in sections]
    return ";".join(parts)


def _leaf_weights(fp: str) -> Counter:
    weights: Counter = Counter()
    for leaf in fp.partition(";")[2].replace(";", ",").replace("/", ",").split(","):
        if leaf:
            weights[leaf] += int(leaf[10:])
    return weights


def likeness(a: str, b: str) -> float:
    """Characters in equal leaves, as a share of both texts' characters; 1 for
    equal roots only. Equal sections are skipped without looking inside."""
    if a.partition(";")[0] == b.partition(";")[0]:
        return 1.0
    x, y = _leaf_weights(a), _leaf_weights(b)
    total = sum(x.values()) + sum(y.values())
    return min(2.0 * sum((x & y).values()) / total, 1.0 - 1e-9) if total else 0.0


def differing(a: str, b: str) -> list[tuple[int, int]]:
    """(start, length) of the stretches of ``a`` whose leaves ``b`` lacks;
    sections that ``b`` has as they are are skipped whole."""
    have = set(b.split(";")[1:])
    left = _leaf_weights(b)
    out, at = [], 0
    for section in a.split(";")[1:]:
        for leaf in section.replace("/", ",").split(","):
            n = int(leaf[10:])
            if section not in have and left[leaf] < n:
                if out and sum(out[-1]) == at:
                    out[-1] = (out[-1][0], out[-1][1] + n)
                else:
                    out.append((at, n))
            elif section not in have:
                left[leaf] -= n
            at += n
    return out


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def fingerprint_sorted(batches) -> Iterator[pa.RecordBatch]:
    """Rows come as (bucket, border, doc_id, text) in the order of the
    documents; a bucket ends with a border row, the first document after it."""
    held = None  # the document whose next one has not come yet

    def finish(doc, fp, text, next_text, next_fp):
        n = len(text)
        edited = text[:n - n // 2] + next_text[:n // 2]
        edited_fp = fp if edited == text else fingerprint(edited)
        return (doc, n, hashlib.sha256(edited.encode()).hexdigest(), fp, edited_fp, likeness(fp, edited_fp), likeness(fp, next_fp))

    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        for a, b in C.slices([len(t) for t in cols[3]]):
            rows = []
            for border, doc, text in zip(cols[1][a:b], cols[2][a:b], cols[3][a:b]):
                if border and held is None:
                    continue  # a further copy of the border row
                fp = fingerprint(text)
                if held is not None:
                    rows.append(finish(*held, text, fp))
                held = None if border else (doc, fp, text)
            if rows:
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 [x.split()[0] for x in OUT.split(", ")])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """One row per document, see ``OUT``. The texts are shuffled once: each
    range of ids also gets the first document after it."""
    spark = docs.sparkSession
    base = C.id_text(docs, id_col, text_col)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = base.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.5 / n) if n > 1 else []
    # bucket 0 has the largest ids; null ids come last
    edges = sorted({int(e) for e in edges}, reverse=True)
    bucket = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e > F.col("doc_id"))) if edges else F.lit(0)
    bucket = F.when(F.col("doc_id").isNull(), len(edges) + 1).otherwise(bucket)
    # one number per bucket goes to the driver: its first id
    heads = (base.select("doc_id", bucket.alias("bucket")).groupBy("bucket").agg(F.max("doc_id").alias("head"))
             .orderBy("bucket").collect())
    to = {heads[(i + 1) % len(heads)]["head"]: heads[i]["bucket"] for i in range(len(heads))}
    before = F.lit(None).cast("int")
    if to:
        known = {k: v for k, v in to.items() if k is not None}
        if known:
            before = F.element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), F.col("doc_id"))
        if None in to:
            before = F.when(F.col("doc_id").isNull(), to[None]).otherwise(before)
    places = F.array(F.struct(bucket.cast("int").alias("bucket"), F.lit(False).alias("border")),
                     F.struct(before.cast("int").alias("bucket"), F.lit(True).alias("border")))
    dealt = (base.withColumn("place", F.explode(F.filter(places, lambda p: p["bucket"].isNotNull())))
             .select("place.bucket", "place.border", "doc_id", "text")
             .repartition(F.col("bucket"))
             .sortWithinPartitions("bucket", "border", F.desc_nulls_last("doc_id"), "text"))
    return C.map_batches(dealt, fingerprint_sorted, OUT)


def op5_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(C.table(spark, sf_dir, "documents"))
