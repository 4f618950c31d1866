from pyspark.sql import functions as F

from tradewake.llm import decontamination as dc

ITEM = "Natalia sold 48 clips to her friends in April and then she sold half as many clips in May."
TANK = "A tank holds 30 liters and 30 liters more are added by the man each day until it is full."


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def result(spark, docs, items, **settings):
    found = dc.matches(*frames(spark, docs, items), **settings).collect()
    return {(r.doc_id, r.item_id): r.exact for r in found}


def test_placeholders():
    templates = dc.Templates()
    code, value, slot = templates.template("He told Anna Lee that 3 kg cost 4.50 dollars. Then Bob left")
    assert slot.tolist() == [False, False, True, False, True, True, False, True, True, False, True, False]
    assert code[4] == code[7] and value[4] != value[7] and code[5] == code[8]
    assert len(templates.template("")[0]) == 0 and len(templates.template(None)[0]) == 0
    # A word is no name at the beginning of a sentence, nor in capitals.
    assert not templates.template("House rules. Every HOUSE\nThe end")[2].any()


def test_other_numbers_and_names_are_found_and_odd_rows_pass(spark):
    docs = [
        (1, "Some words before. " + ITEM + " And some behind."), (2, ITEM.replace("Natalia", "Maria").replace("48", "12")),
        (3, ITEM.upper()), (4, "nothing of the kind is written in here at all"), (5, None), (6, ""), (None, ITEM), (7, ITEM[:50]),
        (8, ITEM + "\n" + ITEM), (1, "Some words before. " + ITEM + " And some behind."), (9, "pad word. " * 20_000 + ITEM),
    ]
    found = result(spark, docs, [(7, ITEM), (8, None), (9, "too short"), (10, TANK), (None, ITEM), (11, "1 2 3 4 5 6 7")])
    # In capitals the name and the months are words, so too few windows agree.
    assert found == {(1, 7): True, (2, 7): False, (8, 7): True, (9, 7): True}


def broadcasts(node):
    """The broadcast parts of a plan, as text."""
    below = [node.children().apply(i) for i in range(node.children().size())]
    return [node.toString()] * ("BroadcastExchange" in node.nodeName()) + [part for x in below for part in broadcasts(x)]


def test_windows_of_documents_are_not_broadcast(spark):
    """However small their file: with one common passage it has a fortieth of the bytes that they take on the driver."""
    found = dc.matches(*frames(spark, [(i, f"Number {i}. " + ITEM) for i in range(40)], [(7, ITEM), (8, TANK)]))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sent = broadcasts(found.select("*")._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sent and not any("loud#" in part for part in sent)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(i, 7) for i in range(40)}


def test_slots_must_be_renamed_one_to_one(spark):
    docs = [(1, TANK.replace("30", "50")), (2, TANK.replace("30", "50", 1)), (3, TANK)]
    assert result(spark, docs, [(1, TANK)]) == {(1, 1): False, (3, 1): True}
    # Two values of the item may not become one.
    two = TANK.replace("30 liters more", "20 liters more")
    assert result(spark, [(1, TANK), (2, two.replace("30", "5").replace("20", "6"))], [(1, two)]) == {(2, 1): False}


def test_items_that_share_windows_and_an_empty_side(spark):
    shared = "the following question is about a row of houses in a street and asks "
    items = [(i, shared + f"how the {w} one of them all came to be painted so late in the year") for i, w in enumerate(
        "red blue green yellow white black brown grey".split())]
    docs = [(i, text) for i, text in items] + [(99, shared)]
    found = result(spark, docs, items, share=1.0)
    assert found == {(i, i): True for i, _ in items}
    docs_, items_ = frames(spark, docs, items)
    assert dc.matches(docs_.filter("false"), items_).isEmpty() and dc.matches(docs_, items_.filter("false")).isEmpty()


def test_a_small_bit_map_changes_nothing(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    one, other = ({(r.doc_id, r.item_id) for r in dc.matches(docs, items, bits=bits).collect()} for bits in (1 << 24, 64))
    assert one == other and one


def test_equals_a_search_through_every_document(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    templates = dc.Templates()
    bench = {r.item_id: templates.windows(r.text)[:2] for r in items.collect()}
    wanted = set()
    for r in docs.collect():
        at, hashes, _, _ = templates.windows(r.text)
        places = {}
        for p, h in zip(at.tolist(), hashes.tolist()):
            places.setdefault(h, []).append(p)
        for item, (item_at, item_hashes) in bench.items():
            shifts = {}
            for p, h in zip(item_at.tolist(), item_hashes.tolist()):
                for q in places.get(h, ()):
                    shifts[q - p] = shifts.get(q - p, 0) + 1
            if shifts and max(shifts.values()) >= 0.8 * len(item_at):
                wanted.add((r.doc_id, item))
    found = {(r.doc_id, r.item_id) for r in dc.matches(docs, items).collect()}
    assert found == wanted and found


def test_filter_keeps_columns_and_clean_rows(spark):
    docs, items = frames(spark, [(1, ITEM), (2, "clean text"), (None, "x"), (3, None)], [(1, ITEM)])
    docs = docs.withColumn("item", F.lit("clash")).withColumn("hash", F.lit(1))
    kept = dc.without_benchmark(docs, items)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.orderBy(F.col("doc_id").asc_nulls_first()).collect()] == [None, 2, 3]


def test_copies_with_words_added_or_dropped(spark):
    words = TANK.split()
    texts = [
        TANK.replace("are added", "are then added"), TANK.replace("are added", "added"),
        "Words before. " + " ".join(words[:10] + ["slowly", "but", "surely"] + words[10:]) + " Words behind.",
        TANK.replace("by the man", "by the very old man").replace("30", "50"), " ".join(words[:10] + ["pad"] * 400 + words[10:]),
        " ".join(words[10:] + words[:10]), " ".join(words[:10]),
    ]
    templates = dc.Templates()
    _, wanted, _, _ = templates.windows(TANK)
    for share in (0.6, 0.8):
        # Counted in whole short documents, without shifts; the one with 400 words between its halves is no passage.
        held = {i for i, t in enumerate(texts) if i != 4 and len(set(wanted) & set(templates.windows(t)[1])) >= share * len(wanted)}
        found = result(spark, list(enumerate(texts)), [(1, TANK)], share=share)
        assert {i for i, _ in found} == held
        assert found.get((3, 1), False) is False
    # An added word takes four windows of more than twenty: at the given share, in a longer item.
    long = ITEM + " " + TANK
    copy = long.replace("half as many", "about half as many")
    assert result(spark, [(1, copy), (2, copy.replace("48", "52")), (3, ITEM)], [(5, long)]) == {(1, 5): True, (2, 5): False}


def test_one_window_of_a_document_stands_for_one_of_the_item(spark):
    line = "round and round the wheels of the old bus go. "
    assert result(spark, [(1, line), (2, line * 6)], [(1, line * 6)]) == {(2, 1): True}


def test_verbatim_copies_of_short_items_and_other_cases(spark):
    items = ["Who wrote the novel Dracula?", "What is the capital city of France?", "Who wrote Dracula?", "Hours of work", "Add 1 2 3 4 5 6 7",
             "WHO WROTE IT AND WHEN", "Who Wrote The Novel Emma In London", "Anna Lee", "", "?!"]
    frames_ = "{}", "Question: {}", 'He asked Bob, "{}" Then Ann left.', "Take 3 {} and Then", "So by John {} Smith said"
    docs = [(100 * i + j, f.format(text)) for i, text in enumerate(items[:8]) for j, f in enumerate(frames_)]
    found = result(spark, docs, list(enumerate(items)))
    assert all(found.get((100 * i + j, i)) for i in range(8) for j in range(len(frames_)))
    assert not [x for x in found if x[1] in (8, 9)]
    other = [(1, ITEM.lower()), (2, ITEM.title()), (3, "Who wrote the book Dracula?"), (4, "Hours of hard work"), (5, "Add 1 2 3 4 6 5 7")]
    assert set(result(spark, other, [(50, ITEM), *enumerate(items)])) == {(1, 50), (2, 50)}


def test_ids_keep_their_type(spark):
    docs, items = frames(spark, [(7, f"before. {ITEM} after"), (8, "nothing of the kind")], [(1, ITEM)])
    named = docs.withColumn("doc_id", F.format_string("%03d", "doc_id")).withColumns({c: F.lit(1) for c in ("_held", "id", "row")})
    tasks = items.withColumn("item_id", F.concat(F.lit("set/"), F.col("item_id").cast("string")))
    assert [(r.doc_id, r.item_id) for r in dc.matches(named, tasks).collect()] == [("007", "set/1")]
    kept = dc.without_benchmark(named, tasks)
    assert kept.columns == named.columns and [r.doc_id for r in kept.collect()] == ["008"]
