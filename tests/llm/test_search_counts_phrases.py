"""Operators 11 to 13 against brute force, and their defined edge cases."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F

from adtrail.llm import common as C
from adtrail.llm import lexical_search, phrase_mining, prefix_counts, tokens

SCHEMA = "doc_id long, text string, lang string, row string, item long, rank string, steps string"  # clashing names
EDGE = [(200, None), (201, ""), (202, " \n\t "), (203, "É é Ñ ñ"), (203, "É é Ñ ñ"), (204, "x" * 9000), (None, "alpha beta"),
        (None, "alpha beta"), (205, "alpha " * 3000), (206, "日本語の文です。" * 40), (207, "a▁b  c   d\r\n\x00e"),
        (208, "alpha, beta. alpha beta; gamma!alpha\tbeta"), (209, "<s> </s> <unk> <0x0A> 😀 ﬁ")]


def sample(seed: int = 5, n: int = 80) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "re-do", "Ünder", "x9"] + ["w%d" % i for i in range(60)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words[:12]) if rng.random() < 0.5 else rng.choice(words) for _ in range(rng.randint(1, 90)))
        rows.append((i, text.replace(" w3 ", ". ").replace(" w5 ", "\n").title() if i % 3 else text))
    return rows + rows[:9]  # repeated rows


def all_rows() -> list[tuple[int | None, str | None]]:
    return sample() + EDGE


def frame(spark, rows, langs=None):
    lang = langs or (lambda i: [None, "en", "und", "de"][(i or 0) % 4])
    return spark.createDataFrame([(i, t, lang(i), "r", 7, "k", "s") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, all_rows()).repartition(3, F.xxhash64("doc_id", "text"))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# operator 11

def ranked(rows, items, top=lexical_search.TOP):
    """Every document scored for every item."""
    def terms(text):
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(lexical_search.TERM, folded)
    bags = [(doc, Counter(terms(t)), len(terms(t))) for doc, t in rows]
    n_docs, n_terms = sum(n > 0 for _, _, n in bags), sum(n for _, _, n in bags)
    df = Counter(term for _, bag, _ in bags for term in bag)
    out = []
    for item, text in items:
        scores = []
        for doc, bag, n in bags:
            m = 100 - 90 + (90 * n * n_docs) // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2.0 * n_docs + 2.0) / (2.0 * df[t] + 1.0)))
                        * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in set(terms(text)) if bag[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scores, key=lambda s: s[:3])[:top], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=str)


ITEMS = [(1, "alpha w17 Gamma"), (2, "w1 w2 w3 w4 w5 w6 w7"), (3, "nothing known here"), (4, None), (5, "É alpha alpha"),
         (6, "x9 re-do ünder DELTA w40 w41")]


@pytest.mark.parametrize("shard_bytes, per_block", [(1 << 30, 1000), (2000, 2), (1, 1)])
def test_search_matches_brute_force(spark, docs, shard_bytes, per_block):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, term string")
    totals = lexical_search.corpus_totals(docs)
    index = C.materialize(lexical_search.build_index(docs, totals, shard_bytes=shard_bytes), "t-index")
    terms = lexical_search.item_terms(items, index, totals[0])
    got = lexical_search.search(index, terms, items_per_block=per_block).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got), key=str) == ranked(all_rows(), ITEMS)


def test_search_cuts_ties_by_id_and_keeps_every_rank(spark):
    rows = [(1000 - i, "same words here") for i in range(300)] + [(5000 + i, "other words %d" % i) for i in range(50)]
    docs = frame(spark, rows).repartition(2, "doc_id")
    items = spark.createDataFrame([(1, "same words"), (2, "absent")], "item_id long, text string")
    totals = lexical_search.corpus_totals(docs)
    index = C.materialize(lexical_search.build_index(docs, totals, shard_bytes=700), "t-index")
    found = lexical_search.search(index, lexical_search.item_terms(items, index, totals[0]), top=7).collect()
    assert sorted((r["rank"], r["doc_id"]) for r in found) == [(k + 1, 701 + k) for k in range(7)]


def test_kept_index_has_a_shard_a_row_group(spark, docs):
    """The reader holds a row group's rows at once, the writer at least a hundred unless told otherwise."""
    index = lexical_search.kept_index(docs.coalesce(1), lexical_search.corpus_totals(docs), shard_bytes=700)
    files = [pq.ParquetFile(f.removeprefix("file:").replace("///", "/")).metadata for f in index.inputFiles()]
    groups = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert index.count() > 20 and groups == [1] * index.count()


def test_treap_holds_every_point():
    rng = np.random.default_rng(1)
    points = np.unique(rng.integers(0, 37 * 21, 300))
    rows, cols = points // 21, points % 21
    impacts = rng.integers(1, 1000, len(points)).astype(np.int64)
    masks, maxima, leaf_rows, leaf_cols = lexical_search.build_treap(rows, cols, impacts, 6)
    assert maxima[0] == impacts.max() and len(leaf_rows) == len(points) == (masks == 0).sum()
    assert sorted(zip(leaf_rows, leaf_cols, maxima[masks == 0])) == sorted(zip(rows, cols, impacts))


def test_search_on_empty_tables(spark, docs, empty):
    items = spark.createDataFrame([], "item_id long, text string")
    for d, i in ((empty, spark.createDataFrame([(1, "alpha")], "item_id long, text string")), (docs, items)):
        totals = lexical_search.corpus_totals(d)
        index = C.materialize(lexical_search.build_index(d, totals), "t-index")
        assert lexical_search.search(index, lexical_search.item_terms(i, index, totals[0])).count() == 0


# operator 12

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokens.vocabulary_path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def store(docs):
    return C.materialize(prefix_counts.prefix_counts(docs, chunk=64), "t-store")


def test_every_prefix_count_equals_the_library(library):
    count = prefix_counts.counter(tokens.vocabulary_path("piece_bpe_32k.model"))
    rng = random.Random(9)
    parts = ["a", "th", "ing", " ", "  ", "\n", "\r\n", "\t", "▁", "é", "日", "😀", "\x00", "1", ";", "();", "=", "<s>", "<unk>",
             "ß", "का", " " * 19, "aaaa", "....", "----", "²."]
    for _ in range(150):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 18)))
        counts = np.cumsum(count.text_steps(text), dtype=np.int64).tolist()
        assert counts == [len(library.encode(text[:i])) for i in range(1, len(text) + 1)], repr(text)


def test_long_words_keep_their_states(library):
    count = prefix_counts.counter(tokens.vocabulary_path("piece_bpe_32k.model"))
    rng = random.Random(2)
    word = "".join(rng.choice("abeinrst") for _ in range(2 * prefix_counts.STRETCH + 77))
    counts = np.cumsum(count.steps(" " + word), dtype=np.int64)
    for n in (prefix_counts.STRETCH - 2, prefix_counts.STRETCH, prefix_counts.STRETCH + 5, len(word)):
        assert counts[n] == len(library.encode(word[:n]))


def test_totals_equal_the_library(store, library):
    got = sorted(map(str, ((r.doc_id, r.n_bytes, r.n_tokens) for r in prefix_counts.token_counts(store).collect())))
    assert got == sorted(str((i, len((t or "").encode()), len(library.encode(t or "")))) for i, t in all_rows())


def test_budget_and_place_questions_read_the_store_only(spark, store, library):
    text_of = {i: t or "" for i, t in all_rows() if i is not None}
    for budget in (0, 1, 17, 400):
        for r in prefix_counts.longest_prefixes(store, budget).where("doc_id is not null").collect():
            text = text_of[r.doc_id]
            fits = [n for n in range(min(len(text), 5 * budget + 400) + 1) if len(library.encode(text[:n])) <= budget]
            if len(text) <= 5 * budget + 400:
                assert r.n_chars == max(fits) and r.n_tokens == len(library.encode(text[:r.n_chars]))
    places = store.where("last and doc_id < 40").select("row", F.explode(F.array(*map(F.lit, (0, 1, 64, 65, 130, 10**6)))).alias("n_chars"))
    got = prefix_counts.tokens_at(store, places, chunk=64).collect()
    assert got and all(r.n_tokens == len(library.encode(text_of[r.doc_id][:r.n_chars])) for r in got)
    asked = Counter(n for i, t in sample() if i < 40 for n in (0, 1, 64, 65, 130) if n <= len(t))
    assert Counter(r.n_chars for r in got) == asked


def test_wide_steps_and_empty_store(empty):
    count = prefix_counts.PrefixCounter(tokens.vocabulary_path("piece_bpe_32k.model"))
    narrow = count.text_steps("the wide way")
    count.memo.clear()
    count.memo.learn = lambda word: (_ for _ in ()).throw(OverflowError)
    wide = count.text_steps("the wide way again"[:12])
    assert wide.dtype == np.int32 and wide.tolist() == narrow.tolist()
    empty_store = prefix_counts.prefix_counts(empty)
    assert prefix_counts.token_counts(empty_store).count() == prefix_counts.longest_prefixes(empty_store, 5).count() == 0


# operator 13

def mined(rows, langs, top, min_count, max_words):
    """All phrases counted, scored and dropped by the definition."""
    f, n = defaultdict(Counter), Counter()
    for (_, text), lang in zip(rows, langs):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            ws = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(ws)
            for k in range(1, max_words + 1):
                f[lang or "und"].update(tuple(ws[s:s + k]) for s in range(len(ws) - k + 1))
    out = []
    for lang, c in f.items():
        kept = []
        for p, a in c.items():
            if len(p) < 2 or a < min_count:
                continue
            if any(100 * b >= 80 * a and any(q[s:s + len(p)] == p for s in range(len(q) - len(p) + 1))
                   for q, b in c.items() if len(q) > len(p) and b >= min_count):
                continue
            score, cut = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), c[p[:cut]], c[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("block_bytes, min_count, top", [(1 << 24, 3, 2000), (500, 2, 9), (1, 5, 2000)])
def test_phrases_match_brute_force(docs, block_bytes, min_count, top):
    got = phrase_mining.mine_phrases(docs, top=top, min_count=min_count, block_bytes=block_bytes).collect()
    langs = [[None, "en", "und", "de"][(i or 0) % 4] for i, _ in all_rows()]
    want = mined(all_rows(), langs, top, min_count, 4)
    assert len(want) > 20 and sorted(map(tuple, got)) == want


def test_phrases_counted_in_many_parts(docs, monkeypatch):
    """Few groups a task: each block's groups, and the answers to it, come from many parts."""
    monkeypatch.setattr(phrase_mining, "PART_GROUPS", 64)
    got = phrase_mining.mine_phrases(docs, min_count=3, block_bytes=1500).collect()
    langs = [[None, "en", "und", "de"][(i or 0) % 4] for i, _ in all_rows()]
    assert sorted(map(tuple, got)) == mined(all_rows(), langs, 2000, 3, 4)


def test_group_counts_and_answers_of_a_part():
    """One row a block and part is sent, not one a group; also for ids too large for one key."""
    blocks = {5: ([3, 3, 9], [1, 4, 0], [2, 1, 5]), 6: ([3, 9, 9], [4, 0, 7], [1, 1, 1]), 7: ([3], [2], [1])}
    for large in (0, 1 << 62):
        sent = [(b, phrase_mining._pack(phrase_mining._gaps(np.array(x) + large), np.array(y) + large // 2, n))
                for b, (x, y, n) in blocks.items()]
        found, answers = (batch.to_pylist() for batch in phrase_mining.count_part(3, 8, sent, 2))
        left, item, ids, a = phrase_mining._unpack(found[0]["frequent"], 4)
        assert list(zip(left - large, item - large // 2, ids, a)) == [(3, 1, 3, 2), (3, 4, 11, 2), (9, 0, 19, 6)]
        told = {r["block"]: (np.unpackbits(np.frombuffer(r["held"], np.uint8)).tolist(), phrase_mining._unpack(r["ids"], 1)[0].tolist())
                for r in answers}
        assert told == {5: ([1, 1, 1] + [0] * 5, [0, 1, 1]), 6: ([1, 1, 0] + [0] * 5, [1, 1]), 7: ([0] * 8, [])}


def test_covered_phrases_go(spark):
    rows = [(i, "uno dos tres. dos tres") for i in range(10)] + [(20 + i, "ab cd ef gh") for i in range(5)] + [(30, "cd ef")]
    got = phrase_mining.mine_phrases(frame(spark, rows, lambda i: "es"), min_count=5).collect()
    want = mined(rows, ["es"] * len(rows), 2000, 5, 4)
    assert sorted(map(tuple, got)) == want and {r[2] for r in want} == {"uno dos tres", "dos tres", "ab cd ef gh"}


def test_scores_are_exact_beyond_64_bits(spark):
    a = 4 * 10**17
    rows = [("en", 1, "x", a + 3), ("en", 1, "y", a + 1), ("en", 2, "x y", a)]
    phrases = spark.createDataFrame(rows, "lang string, k int, phrase string, a long")
    got = phrase_mining.score_phrases(phrases).first()
    assert got.score == 2_000_000 * a // (2 * a + 4) and (got.l, got.r) == (a + 3, a + 1)


def test_phrases_of_empty_tables(spark, empty):
    assert phrase_mining.mine_phrases(empty).count() == 0
    only_blank = frame(spark, [(1, None), (2, " . ; \n")])
    assert phrase_mining.mine_phrases(only_blank, min_count=1).count() == 0
