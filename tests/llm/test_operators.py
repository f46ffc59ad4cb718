"""The operators against brute force, and their defined edge cases."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from adtrail.llm import (benchmark_index, best_fit_packing, language_profiles, license_rules, license_scan,
                         line_dedup, merkle_fingerprints, ngram_join, suffix_dedup, token_files, tokens, url_templates)
from adtrail.llm import common as C
from adtrail.llm.graph import connected_components

SCHEMA = "doc_id long, text string, lang string, rid string, row string"  # rid and row clash with inner names


def texts(seed: int = 1, n: int = 60) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(80)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    out = []
    for i in range(n):
        body = [rng.choice(words) for _ in range(rng.randint(1, 120))]
        text = " ".join(body)
        if i % 4 == 1:
            text = out[-1][1]
        elif i % 4 == 2 and len(body) > 10:
            near = out[-1][1].split(" ")
            near[len(near) // 2] = "edit%d" % i
            text = " ".join(near)
        if i % 5 == 0:
            text += "\n" + passage + "\n" + passage.upper()
        out.append((i, text))
    return out


EDGE = [(100, None), (101, ""), (102, " \n\t "), (103, "é ü Ñ"), (103, "é ü Ñ"), (104, "x" * 5000), (None, "null id here"),
        (105, "ab " * 3000), (106, "one\n\none"), (107, "one\n\none")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if (i or 0) % 2 else "fr", "r", "q") for i, t in texts() + EDGE]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def all_rows():
    return [(i, t or "") for i, t in texts() + EDGE]


def test_suffix_dedup_matches_brute_force(docs, empty):
    for limit in (suffix_dedup.SHARD_SEGMENTS, 1):  # suffix arrays, then hashed windows
        got = suffix_dedup.remove_repeats(docs, length=40, gram=16, shard_segments=limit).collect()
        windows = collections.Counter(t.encode()[i:i + 40] for _, t in all_rows() for i in range(len(t.encode()) - 39))
        want = []
        for doc, t in all_rows():
            b = t.encode()
            gone = np.zeros(len(b) + 1, bool)
            for i in range(len(b) - 39):
                if windows[b[i:i + 40]] > 1:
                    gone[i:i + 40] = True
            kept = bytes(x for x, g in zip(b, gone) if not g)
            spans = int(np.sum(np.diff(gone.astype(int)) < 0))
            want.append((doc, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
        assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_array_common_prefixes_and_merge():
    rng = np.random.default_rng(2)
    parts = [bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in (300, 200, 260)]
    buf = np.frombuffer(b"".join(parts), np.uint8)
    data = buf.tobytes()
    order = suffix_dedup.suffix_array(buf, 64)
    assert [data[i:i + 64] for i in order] == sorted(data[i:i + 64] for i in range(len(data)))
    one = suffix_dedup.Shard(parts, np.array([len(p) - 9 for p in parts]), np.ones(3, int), 10)
    two = [suffix_dedup.Shard([p], np.array([len(p) - 9]), np.ones(1, int), 10) for p in parts]
    for i, a in enumerate(two):
        for b in two[i + 1:]:
            a.merge(b)
    assert [x for s in two for x in s.intervals()] == one.intervals()


def test_packing_is_exact_and_tight(docs, empty):
    tok = Tokenizer.from_file(tokens.vocabulary_path("word_bpe_49k.json"))
    got = best_fit_packing.best_fit_packing(docs, max_tokens=64).collect()
    want = collections.Counter()
    total = 0
    for doc, t in all_rows():
        ids = tok.encode(t, add_special_tokens=False).ids + [0]
        total += len(ids)
        for k in range(0, len(ids), 64):
            part = ids[k:k + 64]
            want[(doc, k // 64, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) <= 1.1 * total / 64 + 2
    assert best_fit_packing.best_fit_packing(empty).count() == 0


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    bins = best_fit_packing.BestFitBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    bins = best_fit_packing.BestFitBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 9, 4)] == [(0, 0), (1, 0), (2, 0), (0, 6)]  # bin 1 closed


def test_chunk_encoder_equals_whole_encoding():
    odd = ["", " ", "a  b", "\n", "a\n\nb", "a \nb", "don't stop.", "foo ,bar.. x", " lead", "trail ", "é,è. ñ.", "x\x00y z",
           "a\x1cb c", "<|endoftext|> a", "3,000. x2,", "Été Ñandú? ŒUVRE. İstanbul ΣΑΣ, ª º ß.", "...,. a.,"]
    for name, spaced in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        enc = tokens.ChunkEncoder(tokens.vocabulary_path(name), spaced)
        for _ in range(2):
            for t, data in zip(odd, enc.encode(odd)):
                assert np.frombuffer(data, "<u4").tolist() == enc.tok.encode(t, add_special_tokens=False).ids


def test_texts_of_added_tokens_are_encoded_as_the_file_says():
    for name, spaced in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        fresh = Tokenizer.from_file(tokens.vocabulary_path(name))
        added = [t.content for t in fresh.get_added_tokens_decoder().values()]
        odd = [f(t) for t in added for f in (str, str.upper, "x {} y".format, "one two{}three four".format, "a\n{}\nb".format,
                                             "\u00c9t\u00e9 {}".format)] + ["plain words", "<|", "\u00c9t\u00e9"]
        got = tokens.ChunkEncoder(tokens.vocabulary_path(name), spaced).encode(odd)
        assert added and [np.frombuffer(x, "<u4").tolist() for x in got] == [fresh.encode(t, add_special_tokens=False).ids for t in odd]


def test_token_files_round_trip(spark, docs, empty):
    path = C.scratch_path(spark, "t")
    token_files.write_token_files(docs, path)
    tok = Tokenizer.from_file(tokens.vocabulary_path("byte_bpe_50k.json"))
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    at = 0
    for r, (doc, t) in zip(got, sorted(all_rows(), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))):
        ids = tok.encode(t, add_special_tokens=False).ids + [0]
        assert (r.doc_id, r.start, r.n_tokens, list(r.ids)) == (doc, at, len(ids), ids)
        at += len(ids)
    assert len(got) == len(all_rows())
    assert token_files.read_token_files(spark, path, ["doc_id"]).where("doc_id = 5").count() == 1
    path = C.scratch_path(spark, "t")
    token_files.write_token_files(empty, path)
    assert token_files.read_token_files(spark, path).count() == 0


def test_language_profiles(spark, docs, empty):
    rng = random.Random(3)
    alphabet = {"aa": "abcde", "bb": "vwxyz"}
    rows = [(i, " ".join("".join(rng.choice(alphabet[lang]) for _ in range(6)) for _ in range(20)), lang)
            for i, lang in enumerate(["aa", "bb"] * 30)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_profiles.train(train.where("doc_id < 30"))
    got = language_profiles.identify(train.where("doc_id >= 30"), model).select("row.lang", "lang_pred", "score").collect()
    assert len(got) == 30 and all(r.lang == r.lang_pred and 0 < r.score <= 1 for r in got)
    odd = {r.doc_id: r.lang_pred for r in language_profiles.identify(docs, model).select("row.doc_id", "lang_pred").collect()}
    assert odd[100] == odd[101] == odd[102] == "und" and odd[103] != "und"
    assert language_profiles.train(empty)[0] == []
    assert {r.lang_pred for r in language_profiles.identify(docs, language_profiles.train(empty)).collect()} == {"und"}


def test_fingerprints(docs, empty):
    got = merkle_fingerprints.fingerprints(docs, buckets=4).collect()
    rows = sorted(all_rows(), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = collections.Counter()
    for (doc, t), (_, follow) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + follow[:half]
        want[(doc, len(t), hashlib.sha256(edited.encode()).hexdigest(), merkle_fingerprints.fingerprint(t),
              merkle_fingerprints.fingerprint(edited))] += 1
    assert collections.Counter(tuple(r)[:5] for r in got) == want
    a = "First line.\nSecond line.\n\nThird line."
    assert merkle_fingerprints.differing(merkle_fingerprints.fingerprint(a),
                                         merkle_fingerprints.fingerprint(a.replace("Second", "2nd"))) == [(12, 13)]
    assert merkle_fingerprints.fingerprints(empty).count() == 0


def test_leaves_of_unpunctuated_texts_are_bounded_and_keep_their_place():
    rng = random.Random(8)
    chinese = "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(6000))
    other = "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(6000))
    log = " ".join("k%d=%d" % (rng.randint(0, 99), rng.randint(0, 9999)) for _ in range(900))
    for text in (chinese, log, "word " * 6000, "x" * 9000, "!" * 500 + chinese, "a" * 159 + chr(0xD800) * 9):
        pieces = merkle_fingerprints.leaves(text)
        assert "".join(pieces) == text and max(map(len, pieces)) <= merkle_fingerprints.LEAF_CHARS
    fp = merkle_fingerprints.fingerprint
    for text in (chinese, log, "word " * 6000):
        half = len(text) // 2
        inserted = text[:half] + "\u4e01#" + text[half:]
        assert merkle_fingerprints.likeness(fp(text), fp(inserted)) > 0.85
        assert 0.4 < merkle_fingerprints.likeness(fp(text), fp(text[:len(text) - half] + other[:half])) < 0.7
        assert sum(n for _, n in merkle_fingerprints.differing(fp(text), fp(inserted))) < 0.15 * len(text)


def test_line_dedup(spark, docs, empty):
    base = "the quick brown fox jumps over the lazy dog near the river bank today " * 3
    rows = [(1, "Alpha beta gamma.\nunique one here\nshort"), (2, "alpha  BETA gamma\nshort\nunique two there 12"),
            (3, base + "end one\n" + base + "end two"), (4, "unique two there 34\n" + base + "end one"), (5, None), (6, "")]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
           .select("row.doc_id", "text", "n_lines", "n_removed").collect()}
    assert got[1].text == rows[0][1] and got[2].text == "short\nunique two there 12"
    assert got[4].text == "" and got[4].n_removed == 2 and got[5].text is None and got[6].text == ""
    out = line_dedup.dedup_lines(docs).select("row.doc_id", "text", "n_lines", "n_removed").collect()
    assert len(out) == len(all_rows()) and line_dedup.dedup_lines(empty).count() == 0
    # exactly repeated lines always go, the first occurrence stays
    seen, expected = set(), 0
    for _, t in sorted({r for r in all_rows() if r[0] is not None}) + [r for r in all_rows() if r[0] is None]:
        for line in t.split("\n"):
            key = line_dedup.normalised(line)
            if len(key.split()) >= line_dedup.MIN_WORDS:
                expected += key in seen
                seen.add(key)
    assert sum(r.n_removed for r in out) >= expected


def test_line_dedup_similarity_is_of_characters(spark):
    pairs = [("seven plain words with one wrong lettar here", "seven plain words with one wrong letter here"),
             ("\u00e9t\u00e9 " * 9 + "fin", "\u00e9t\u00e9 " * 9 + "fim"), ("a b c d e f g h " + "w" * 30, "a b c d e f g h " + "v" * 30)]
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1, 2]), pa.array([5, 6, 7]), *(pa.array(x) for x in zip(*pairs))], list("abpq"))
    parts = spark.createDataFrame([r for x in line_dedup.differing_parts([batch], 0.9) for r in x.to_pylist()])
    assert {r.a for r in parts.where("levenshtein(p, q, int(limit)) >= 0").collect()} == {0, 1}
    # lines of the same words in number, hence of one SimHash: the last word has one wrong letter
    same = "the menu has these words " * 9
    rows = [(1, same + "lettar"), (2, same + "letter")]
    got = {r.row.doc_id: r.n_removed for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 1}
    size = line_dedup.line_table(["\u00e9t\u00e9 \u65e5\u672c x"])[6]
    assert size.tolist() == [8]


def test_simhash_counts_bits_of_long_lines():
    words = np.arange(1, 700, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = line_dedup._bit_counts(words, np.array([0, 300]), np.array([300, 399]))
    bits = np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1).astype(int)
    assert (counts == np.stack([bits[:300].sum(0), bits[300:].sum(0)])).all()


def test_jaccard_components_match_brute_force(docs, empty):
    def shingles(t):
        w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) if x]
        return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])

    rows = [r for r in all_rows() if r[0] is not None]
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect() if r.doc_id is not None}
    assert got == {d: (len(s), find(d)) for d, s in sets.items()}
    assert ngram_join.jaccard_components(empty).count() == 0


def test_list_of_frequent_shingles_comes_as_columns(spark, monkeypatch):
    """The most frequent first, ties by hash; neither row objects nor a sort of all shingles."""
    rng = random.Random(4)
    rows = [(x, n) for n, m in ((9, 5), (4, 20), (2, 4000)) for x in (rng.randrange(-1 << 63, 1 << 63) for _ in range(m))]
    often = spark.createDataFrame(rows, "shingle long, n long")
    monkeypatch.setattr(type(often), "toPandas", lambda df: pytest.fail("row objects"))
    monkeypatch.setattr(type(often), "collect", lambda df: pytest.fail("row objects"))
    for most in (10, 25, 1025, 5000):
        got = ngram_join.most_frequent(often, most).view(np.int64)
        assert len(got) <= most * 1.2 and (np.diff(got.view(np.uint64)) > 0).all()
        counts = collections.Counter(dict(rows)[x] for x in got.tolist())
        assert counts[9] == 5 and counts[4] == (20 if most >= 25 else counts[4])
        if most == 1025:
            assert 800 < counts[2] < 1200
            twos = sorted(x for x, n in rows if n == 2)
            assert sorted(x for x in got.tolist() if dict(rows)[x] == 2) == twos[:counts[2]]
        if most == 5000:
            assert len(got) == len(rows)
    assert len(ngram_join.most_frequent(often.limit(0), 10)) == 0
    found = ngram_join.jaccard_components(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string"))
    assert sorted(r.component_id for r in found.toLocalIterator()) == [1, 1]


def test_near_duplicate_stage_keeps_one_row_of_each_group(spark):
    rng = random.Random(9)
    one, two = (" ".join("v%d" % rng.randint(0, 999) for _ in range(80)) for _ in range(2))
    rows = [(1, one), (1, one), (1, one + " end"), (None, one), (None, two), (None, two), (None, two + " end"), (None, "alone stays here"),
            (7, "also alone"), (7, "this is another one with the id"), (8, ""), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    got = [tuple(r) for r in kept.collect()]
    assert kept.columns == docs.columns
    assert sorted(d if d is not None else 99 for d, _ in got) == [1, 7, 7, 8, 99, 99, 99]
    assert sum(t.startswith(one) for _, t in got) == sum(t.startswith(two) for _, t in got) == 1


def test_connected_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(30, 40), (40, 35), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 30: 30, 35: 30, 40: 30}


def test_decontamination(spark, docs, empty):
    source = dict(texts())
    items = [(1, " ".join(source[0].split()[:12])), (2, "edit2"), (3, None), (4, ""), (2, "edit2"), (5, "no such words anywhere")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = benchmark_index.decontaminate(docs, bench).collect()

    def words(t):
        return [w for w in re.split(benchmark_index.SEPARATOR, re.sub("[A-Z]", lambda m: m[0].lower(), t)) if w]

    want = collections.Counter()
    for doc, t in all_rows():
        ws, hit, ids = words(t), set(), set()
        for item, text in items:
            q = words(text or "")
            n = min(10, len(q))
            for s in range(max(0, len(q) - 10) + 1 if q else 0):
                for i in range(len(ws) - n + 1):
                    if ws[i:i + n] == q[s:s + n]:
                        hit.update(range(i, i + n))
                        ids.add(str(item))
        want[(doc, len(ws), len(hit), len(ids), tuple(sorted(ids)), bool(hit))] += 1
    assert collections.Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r.item_ids), r.contaminated) for r in got) == want
    assert benchmark_index.decontaminate(empty, bench).count() == 0
    assert not any(r.contaminated for r in benchmark_index.decontaminate(docs, bench.where("false")).collect())


def test_decontamination_of_repeated_and_null_ids(spark, tmp_dir):
    leak, other = "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10", "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10"
    rows = [(1, "a " + leak), (1, "a " + leak), (2, leak + " b"), (2, "clean"), (3, "one solo"), (3, "one solo"),
            (None, "c " + leak), (None, "c " + leak), (None, "clean too"), (None, other), (4, "p1 p2 p3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, leak), (2, "solo"), (3, other)], "item_id long, text string")
    got = benchmark_index.decontaminate(docs, bench).collect()
    want = collections.Counter({(1, 10, ("1",)): 2, (2, 10, ("1",)): 1, (2, 0, ()): 1, (3, 1, ("2",)): 2, (None, 10, ("1",)): 2,
                                (None, 0, ()): 1, (None, 10, ("3",)): 1, (4, 0, ()): 1})
    assert collections.Counter((r.doc_id, r.n_hit, tuple(r.item_ids)) for r in got) == want
    bench.write.parquet(tmp_dir + "/benchmark.parquet")
    kept = corpus_pipeline.decontamination_stage(spark, docs, tmp_dir)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(2, "clean"), (None, "clean too"), (4, "p1 p2 p3")], key=str)


def test_license_scan(spark, docs, empty):
    rows = [(1, "Released under the MIT License. MIT\nlicense"), (2, "Licensed under the Apache License, Version 2.0."),
            (3, "GNU General Public License, version 3"), (4, "Licensed under CC BY-NC 4.0."), (5, "nothing"), (6, None)]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].labels) == (2, 3, 5, "mit")
    assert got[2].labels == "apache,apache-2.0" and got[3].labels == "gpl,gpl-3.0"
    assert got[4].base_labels == "cc-by" and got[4].labels == "cc-by,cc-by-nc-4.0"
    assert got[5].labels == got[6].labels == "" and got[6].n_words == 0 and got[5].first_word is None
    assert license_scan.scan_licenses(docs).count() == len(all_rows()) and license_scan.scan_licenses(empty).count() == 0


def test_url_templates(spark):
    rows = [(1, "https://A.Example.org/es/1?x"), (2, "http://example.org/en/12"), (3, "http://x.com/de/9"), (4, "http://x.com/fr/9#a"),
            (5, "http://y.net/a/1"), (6, None), (7, "no scheme"), (8, "http://h.net"), (8, "http://h.net"), (9, "x://y.org")]
    pages = spark.createDataFrame([(i, u, "c") for i, u in rows], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_templates.filter_urls(pages).collect()}
    assert got[1] == ("a.example.org", "/es/1", "example.org/es/", "block") and got[2][2:] == ("example.org/en/1", "block")
    assert got[3][2:] == ("com/de/", "block") and got[4] == ("x.com", "/fr/9", "com/fr/", "allow")
    assert got[6][:3] == got[7][:3] == ("", "", None) and got[9] == ("y.org", "", None, got[9][3])
    assert url_templates.filter_urls(pages).count() == len(rows) and url_templates.filter_urls(pages.where("false")).count() == 0
def _matches(tree) -> list[str]:
    """Texts of each branch of a parsed pattern, repeats at their least and once more."""
    out = [""]
    for op, arg in tree:
        op = str(op)
        if op == "BRANCH":
            some = [x for branch in arg[1] for x in _matches(branch)]
        elif op == "SUBPATTERN":
            some = _matches(arg[3])
        elif op == "MAX_REPEAT":
            some = ["".join(c) for k in {arg[0], min(arg[0] + 1, int(arg[1]))} for c in itertools.product(_matches(arg[2]), repeat=k)]
        elif op == "IN":
            some = [chr(v if str(kind) == "LITERAL" else v[0]) for kind, v in arg]
        else:
            some = ["z" if op == "NOT_LITERAL" else chr(arg)]
        out = [a + b for a in out for b in some]
    return out


def test_license_gates_drop_no_match(spark):
    for rule in license_rules.all_rules():
        pattern = license_rules.compile_pattern(rule.pattern)
        for x in _matches(re._parser.parse(pattern)):
            flat = x.replace("<", " ").replace(">", "")
            assert re.fullmatch(pattern, x) and rule.keyword in flat and license_rules.stem(rule) in flat, (rule, x)
    rows = [(1, "Unauthorized copying of this file is strictly prohibited."), (2, "special exception to link this library")]
    got = {r.doc_id: r.labels for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "proprietary", 2: "gpl-with-linking"}
