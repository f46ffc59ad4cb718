"""Fuzzy line dedup against all pairs of lines."""

import random

from adtrail.llm import line_dedup as L


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def similar(a, b):
    if a == b:
        return True
    longer = max(len(a), len(b))
    limit = int(longer * (1 - L.EDIT_SIMILARITY) + 1e-9)
    return abs(len(a) - len(b)) <= limit and edit_distance(a, b) <= limit


def expected_removed(lines):
    """All lines but the first of each group connected by similar pairs, from all pairs."""
    root = list(range(len(lines)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for j in range(len(lines)):
        for i in range(j):
            if find(i) != find(j) and similar(lines[i], lines[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i for i in range(len(lines)) if find(i) != i}


def removed(spark, lines):
    rows = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(5)
    return {r.row.doc_id for r in L.dedup_lines(rows).where("n_removed = 1").select("row").collect()}


def edited(rng, line):
    letters = list(line)
    k = rng.choice([i for i, c in enumerate(letters) if c != " "])
    kind = rng.choice(["change", "insert", "delete"])
    letters[k:k + 1] = {"change": ["0"], "insert": ["0", letters[k]], "delete": [] if line[max(0, k - 1):k + 2].strip() == line[max(0, k - 1):k + 2] else [letters[k]]}[kind]
    return "".join(letters)


def test_lines_with_few_edits_are_found_as_by_all_pairs(spark):
    rng = random.Random(17)
    vocabulary = ["".join(rng.choices("abcdefgiklmnoprstu", k=rng.randint(2, 9))) for _ in range(400)]
    lines = []
    for n in (3, 4, 5, 7, 9, 10, 12, 16, 17, 25, 60):
        for _ in range(6):
            line = " ".join(rng.choices(vocabulary, k=n))
            lines += [line, edited(rng, line)]
            if n >= L.LONG_WORDS:
                lines.append(edited(rng, edited(rng, line)))
            if 10 < n <= L.SHORT_WORDS:
                words = line.split()
                words.remove(min(words, key=len))
                lines.append(" ".join(words))
    lines = [L.normalised(x) for x in lines]
    want, got = expected_removed(lines), removed(spark, lines)
    assert got <= want and len(got) >= 0.97 * len(want) and len(want) > 100


def test_large_family_of_one_changed_word(spark):
    rng = random.Random(3)
    frame = "this notice stands at the foot of every page of the archive and names the keeper as {} since the year of its foundation"
    lines = [frame.format("".join(rng.choices("abcdefgh", k=5))) for _ in range(400)]
    lines = list(dict.fromkeys(lines))
    # five letters of some 120 may differ, so all lines are similar to each other
    assert removed(spark, lines) == set(range(1, len(lines)))


def test_segment_keys_meet_lines_that_differ_in_one_word():
    def keys(line):
        return set(L.segment_keys([line], L.MIN_WORDS)[0].tolist())
    assert keys("one two three") & keys("one twq three") and not keys("one two three") & keys("two one six")
    assert keys("a b c d") & keys("a b d") and not keys("a b c d") & keys("e f g h")
    long = [f"w{chr(97 + i)}" for i in range(20)]
    two = long.copy()
    two[1], two[17] = "x", "y"
    assert keys(" ".join(long)) & keys(" ".join(two))
    three = two.copy()
    three[10] = "z"
    assert not keys(" ".join(long)) & keys(" ".join(three))
    assert len(L.segment_keys(["", "one two", "\n\n"], L.MIN_WORDS)[0]) == 0
    # where the lines stand among others does not matter
    assert keys("one two three") <= set(L.segment_keys(["zz yy xx ww\n\nfoo bar baz", "one two three"], L.MIN_WORDS)[0].tolist())


def test_lines_surely_near_are_near():
    rng = random.Random(9)
    for _ in range(300):
        p = " ".join("".join(rng.choices("abc", k=rng.randint(1, 6))) for _ in range(rng.randint(2, 8)))
        q = edited(rng, edited(rng, p))
        for edits in range(8):
            if L._surely_near(p, q, edits):
                assert edit_distance(p, q) <= edits


def test_alike_lines_beside_unlike_representatives(spark):
    # all lines differ in their last word alone, so they meet in one key; most are not similar to its two representatives
    rng = random.Random(5)
    lines = []
    for _ in range(60):
        line = "delta kappa " + "".join(rng.choices("abcdefghiklmnoprstu", k=8))
        lines += [line, edited(rng, line)]
    lines = [x for x in dict.fromkeys(lines) if x.startswith("delta kappa ")]
    want = expected_removed(lines)
    assert len(want) > 20 and removed(spark, lines) == want


def test_alike_lines_of_one_simhash_beside_an_unlike_first_line(spark):
    # the same words in another order have one SimHash; a letter that many words outvote does not change it
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in "lmnr"]
    turned = words[40:] + words[:40]
    swapped = turned.copy()
    for i in (0, 20, 40, 60):
        swapped[i], swapped[i + 1] = turned[i + 1], turned[i]
    lines = [" ".join(x) for x in (words, turned, swapped)]
    assert similar(lines[1], lines[2]) and not similar(lines[0], lines[1]) and not similar(lines[0], lines[2])
    assert removed(spark, lines) == {2}


def test_odd_letters_bound_the_edits():
    rng = random.Random(11)
    for _ in range(200):
        p = " ".join("".join(rng.choices("abcé日0", k=rng.randint(1, 6))) for _ in range(rng.randint(1, 8)))
        q = edited(rng, edited(rng, p))
        x, y = (sum(L.line_table([t])[7].tolist()) for t in (p, q))  # 0 of a line without a word
        assert (x ^ y).bit_count() <= 2 * edit_distance(L.normalised(p), L.normalised(q))


def test_family_of_near_copies_makes_no_pairs_of_all_its_lines(spark, monkeypatch):
    # a word of many flips few bits of the SimHash, so most lines have near ones
    rng = random.Random(23)
    vocabulary = ["".join(rng.choices("abcdefgiklmnoprstu", k=6)) for _ in range(300)]
    words = rng.choices(vocabulary, k=200)
    lines = []
    for _ in range(160):
        line = words.copy()
        for i in rng.sample(range(len(line)), 3):  # in three runs, mostly, so no key of runs need be shared
            line[i] = rng.choice(vocabulary)
        lines.append(" ".join(line))
    rows, kept = {}, L.C.materialize

    def materialize(df, tag):
        out = kept(df, tag)
        rows.setdefault(tag, []).append(out.count())
        return out
    monkeypatch.setattr(L.C, "materialize", materialize)
    assert removed(spark, lines) == set(range(1, len(lines)))
    assert rows["near-hashes"][0] + rows["line-pairs"][0] <= 8 * len(lines)
