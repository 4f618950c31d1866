import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tradewake.llm import packing, pretokens, token_counts

JSON = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(JSON)
ODD = [
    "", " ", "a  b", " lead", "trail ", "x\n y", "x \ny", "\n\n a", "日本語 text ça 123!!", "hi <|endoftext|> you<|endoftext|>",
    "tab\tb c", "a b c", "don't we'll I'm 'S they've 'tis x'sy \n'd 12's it''s", "aaaaaaaaaaaaaaaaaaaaaaa aaa", "😀😀 x",
    "  \n \n  q", "é" * 40, "1234567890 " * 5, "\x85x y\x1cz", "×÷ü 'll", "'", "a'", "'re", "x" * 3000, "\0 nul \0",
]


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abz AZé  \n\n'std.,!7?×"), max_size=40), max_size=5))
def test_any_text_is_encoded_and_counted_as_the_library_does(texts):
    wanted = [ids(t) for t in texts]
    encoded = packing.Encoder(JSON).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoded] == [[*w, 0] for w in wanted]
    assert token_counts.Counter(JSON).count(texts).tolist() == [len(w) for w in wanted]


@pytest.mark.parametrize("limit", [20, 400_000])
@pytest.mark.parametrize("size", [64, 1 << 21])
def test_odd_and_long_texts(monkeypatch, limit, size):
    original = pretokens.grouped
    monkeypatch.setattr(pretokens, "grouped", lambda texts: original(texts, size))
    texts = ODD + ["many words in one long text, and more. " * 200] + ODD[:3]
    wanted = [ids(t) for t in texts]
    encoded = list(packing.Encoder(JSON, limit).encode(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in encoded] == [[*w, 0] for w in wanted]
    assert token_counts.Counter(JSON, limit).count(texts).tolist() == [len(w) for w in wanted]


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096, 8192])
@pytest.mark.parametrize("letters", ["at", "en"])
def test_parts_that_share_a_hash_are_told_apart(n, letters):
    """A polynomial hash modulo 2^64 cannot tell these strings from those with swapped letters."""
    one, other = thue_morse(n, letters), thue_morse(n, letters[::-1])
    lists = [[f"{one} {other}", f"x {other}  {one}"], [one, other], [other], [f"{one}"] * 3]
    encoder, counter = packing.Encoder(JSON), token_counts.Counter(JSON)
    for texts in lists:  # in one text, in two, and over several batches
        wanted = [ids(t) for t in texts]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [[*w, 0] for w in wanted]
        assert counter.count(texts).tolist() == [len(w) for w in wanted]


def test_every_part_is_compared_with_the_one_that_stands_for_it(monkeypatch):
    """With one hash for all parts, numbers still follow the parts."""
    monkeypatch.setattr(pretokens, "_hashes", lambda data, starts: np.zeros(len(starts), dtype=np.uint64))
    texts = [*ODD, "a ab abc abcdefgh abcdefghi abcdefgh  abcdefghj " + "z" * 300 + " " + "z" * 299 + "y"] * 2
    wanted = [ids(t) for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.Encoder(JSON, 30).encode(texts)] == [[*w, 0] for w in wanted]
    assert token_counts.Counter(JSON).count(texts).tolist() == [len(w) for w in wanted]


def test_counts_of_a_frame(spark):
    rows = [(i, t, "clash") for i, t in enumerate([*ODD, None, "word " * 513])] + [(None, "x", "y"), (0, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = token_counts.token_counts(docs).collect()
    assert len(found) == len(rows)
    for row in found:
        text = row.text or ""
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), len(ids(text)), len(ids(text)) > 512)
    assert token_counts.token_counts(docs.filter("false")).isEmpty()


def check_pieces(pieces, texts, window=1024):
    """A row per piece against the token ids of the texts; returns the sequences' fills."""
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_document[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_document) == set(texts)
    for id_, own in by_document.items():
        whole = [*ids(texts[id_] or ""), 0]
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(whole)) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(np.array(whole[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(whole)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
    return [sum(p.length for p in own) for own in by_sequence.values()]


def test_pieces_cover_all_documents_with_no_padding(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for layout in (docs, docs.repartition(7), docs.repartition(60)):
        fills = check_pieces(packing.pack(layout).collect(), texts)
        assert all(packing.is_power_of_two(f) for f in fills)
        assert sum(f == 1024 for f in fills) >= sum(fills) // 1024 - 60


def test_long_documents_are_given_out_as_they_come(spark):
    """Some groups of output before the end of the partition, with ends of documents left over in between."""
    docs = spark.range(60).selectExpr("id as doc_id", "repeat('some words of a long text, ', 20000 + cast(id as int)) as text").coalesce(1)
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_pieces(packing.pack(docs).collect(), {i: texts[i] for i in texts})


def test_pack_odd_rows(spark):
    rows = [(i, t, "s") for i, t in enumerate([None, *ODD, "many words " * 3000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    check_pieces(packing.pack(docs).collect(), {i: t for i, t, _ in rows})
    repeated = packing.pack(docs.filter("doc_id < 2").union(docs.filter("doc_id < 2")).withColumn("doc_id", docs.doc_id * 0)).collect()
    assert sum(p.length for p in repeated) == 4
    assert packing.pack(docs.filter("false")).isEmpty()
    with_ids = packing.pack(docs, with_ids=True).collect()
    assert all(zlib.crc32(np.array(p.token_ids, "<u4").tobytes()) == p.ids_crc32 for p in with_ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=80), st.sampled_from([16, 64]))
def test_every_placement_has_the_smallest_sum_of_squares(lengths, window):
    packer = packing.SumOfSquares(window)
    counted = lambda level: 0 < level < window and not packing.is_power_of_two(level)
    square = lambda n: sum(k * k for level, k in n.items() if counted(level))
    for i, length in enumerate(lengths):
        before = {level: len(w) for level, w in packer._open.items() if w}
        packer.add(i, length)
        after = {level: len(w) for level, w in packer._open.items() if w}
        size = length % window
        if size:
            options = []
            for level in [0, *before]:
                if level + size <= window:
                    n = dict(before)
                    if level:
                        n[level] -= 1
                    if level + size < window:
                        n[level + size] = n.get(level + size, 0) + 1
                    options.append(square(n))
            assert square(after) == min(options)
    packer.finish()
    pieces = sorted((d, s, n) for _, part in packer.closed for d, s, n in part)
    for i, length in enumerate(lengths):
        at = 0
        for _, start, n in (p for p in pieces if p[0] == i):
            assert start == at
            at += n
        assert at == length
    fills = [sum(n for _, _, n in part) for _, part in packer.closed]
    assert all(packing.is_power_of_two(f) and f <= window for f in fills)
