import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tradewake.llm import spelling

DOCS = "doc_id long, text string"


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_words(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            code = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if code % 31 == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def plain_variants(words):
    rows, form_of = [], {}
    for word, n in words.items():
        near = sorted((w for w in words if is_near(w, word)), key=lambda w: (-words[w], w))
        if near and words[near[0]] >= 10 * n:
            form_of[word] = near[0]
        rows.append((word, len(near)))

    def root(word):
        return root(form_of[word]) if word in form_of else word

    return {(w, form_of.get(w), root(w), words[w], k, words[form_of[w]] if w in form_of else None) for w, k in rows}


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("alphabet", ["ab", "abcé", "abcdefghijklmnop"])
def test_index_finds_every_near_word(alphabet):
    draw = random.Random(len(alphabet))
    for _ in range(60):
        words = sorted({"".join(draw.choices(alphabet, k=draw.randint(2, 9))) for _ in range(draw.randint(1, 60))})
        asked = [*words, words[0] + "z", "zab"]
        index = spelling.Index(words)
        pairs = set()
        for left in (True, False):
            rows = list(zip(*(x.tolist() for x in spelling.search(index, asked, left))))
            assert len(rows) == len(set(rows))
            for query, number in rows:
                word, near, half = asked[query], words[number], len(asked[query]) // 2
                assert near.startswith(word[:half]) if left else near.endswith(word[half:])
                pairs.add((word, near))
        assert pairs == {(a, b) for a in asked for b in words if is_near(a, b)}


def vocabulary_of(draw, n):
    """Words of which many are near each other, with chains of forms."""
    words = {"abcdefg": 100_000, "abcdefgh": 9_000, "abcdefghi": 80, "abcdefghij": 2, "xbcdefg": 100_000}
    while len(words) < n:
        word = list(draw.choice(list(words)))
        at = draw.randrange(len(word))
        word[at : at + draw.randint(0, 1)] = draw.choice(["", "a", "q", "é"])
        if len(word) >= 7:
            words.setdefault("".join(word), draw.choice([2, 3, 30, 400, 5000]))
    return words


@pytest.mark.parametrize("block_chars", [1 << 17, 300])
def test_variants_equal_all_pairs(spark, block_chars):
    """Also where one beginning holds most words and is split into many blocks."""
    words = vocabulary_of(random.Random(11), 400)
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    assert found(spelling.variants(df, block_chars=block_chars)) == plain_variants(words)


def test_ties_go_to_the_smallest_word(spark):
    words = {"aaaaaab": 2, "aaaaaac": 20, "aaaaaad": 20, "aaaaaaé": 20, "bbbbbbb": 19, "bbbbbbc": 2}
    rows = {r[0]: r for r in found(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))}
    assert rows["aaaaaab"][1:] == ("aaaaaac", "aaaaaac", 2, 3, 20)
    assert rows["bbbbbbc"][1:] == (None, "bbbbbbc", 2, 1, None)


def test_whole_documents_equal_a_plain_version(spark):
    """Nulls, empty texts, repeated rows, very long words and texts, and clashing columns."""
    draw = random.Random(4)
    stems = ["international", "spelling", "variants", "Überraschung", "naïvetés", "corrección", "aaaaaaaa"]
    rows = [(i, " ".join(draw.choices(stems, k=60)) + "-" + draw.choice(stems).upper()) for i in range(150)]
    rows += [(None, "spelling variants " * 5), (7, None), (8, ""), (9, "1 2 3"), *rows[:2]]
    long = "Wort" * 500
    rows += [(1000, f"{long} {long}"), (1001, ("variants, " * 150_000)), (1002, f"{long}e " * 20)]
    rows += [(1003 + i, f"{'ab' * k}{end} " * 2) for i, (k, end) in enumerate([(127, "a"), (127, "ab"), (128, "a"), (128, "b"), (129, "")])]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    wanted = plain_variants(plain_words(rows))
    assert any(r[1] for r in wanted) and max(len(r[0]) for r in wanted) > 2000
    assert found(spelling.spelling_variants(df)) == wanted
    extra = df.filter("doc_id < 100").withColumns({name: F.lit(1) for name in ("word", "n", "near", "side", "part", "bin", "root")})
    assert found(spelling.spelling_variants(extra)) == plain_variants(plain_words([r for r in rows if r[0] is not None and r[0] < 100]))


def test_parts_of_a_text_cut_no_word(monkeypatch):
    monkeypatch.setattr(spelling, "_PART", 10)
    for text in ("a" * 95, "ab " * 40, "one, two; seventeen lettersandmore", "", "-" * 50, "Äb" * 5 + "." + "x" * 30):
        assert "".join(spelling._parts(text)) == text
        wanted = Counter(x.encode().lower().decode() for x in re.findall("[A-Za-zÀ-ÿ]+", text))
        assert spelling.words_of(1, text, drop_fold=None) == wanted


def test_nothing(spark):
    assert found(spelling.spelling_variants(spark.createDataFrame([], DOCS))) == set()
    assert found(spelling.spelling_variants(spark.createDataFrame([(1, "one two"), (2, "Once only")], DOCS))) == set()
