import random

import numpy as np

from barledger.llm import flat, templates as tp


def kinds(text):
    body = np.frombuffer(text.encode(), np.uint8)
    s, e, _, _, kind = tp.tokens(body, np.array([0, len(body)]))
    return [(body[a:b].tobytes().decode(), tp._KINDS.get(int(k), "")) for a, b, k in zip(s, e, kind)]


def test_tokens():
    got = kinds('The train left Paris at 10.30, ran 300 km with Élodie. Then 5kg of $20 "goods"; -- 12 dollars\nNew line A km')
    assert got == [
        ("The", ""), ("train", ""), ("left", ""), ("Paris", "name"), ("at", ""), ("10.30", "num"), ("ran", ""), ("300", "num"), ("km", "unit"),
        ("with", ""), ("Élodie", "name"), ("Then", ""), ("5kg", "qty"), ("of", ""), ("20", "num"), ("goods", ""), ("12", "num"),
        ("dollars", "unit"), ("New", ""), ("line", ""), ("A", ""), ("km", ""),
    ]


ITEM = "A train leaves the old station with Anna at 40 km per hour and meets another train after 90 minutes while Anna reads the long paper"


def test_exact_reparameterised_and_inconsistent(spark):
    rng = random.Random(1)
    noise = lambda n: " ".join("".join(rng.choice("abcdefghi") for _ in range(5)) for _ in range(n))
    bench = spark.createDataFrame([(7, ITEM, "x"), (8, "too short", "x"), (9, None, "x"), (None, noise(30), "x")], "item_id bigint, text string, d string")
    changed = ITEM.replace("Anna", "Peter").replace("40", "75")
    mixed = ITEM.replace("with Anna", "with Peter")  # one name, two values
    rows = [
        (1, noise(30) + " " + ITEM + " " + noise(30)), (2, noise(9) + "\n" + changed + "\n" + noise(9)), (3, noise(200)), (4, None), (5, ""),
        (6, " ".join(ITEM.split()[:9]) + " " + noise(30)), (7, ITEM.upper()), (8, mixed), (1, noise(5) + " " + ITEM), (None, ITEM),
    ]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, item_id int").repartition(3)
    got = {(r.doc_id, r.item_id): (r.kind, r.changed_slots) for r in tp.report(docs, bench).collect()}
    assert got[1, 7] == ("exact", 0) and got[None, 7] == ("exact", 0)
    assert got[2, 7] == ("reparameterised", 2)
    assert {d for d, _ in got} == {1, 2, 7, 8, None}  # 7: case does not hide a copy
    windows = {r.doc_id: r.windows for r in tp.report(docs, bench).where("doc_id in (2, 8)").collect()}
    assert windows[8] < windows[2]
    left = sorted((r.doc_id for r in tp.drop_contaminated(docs, bench).collect()), key=repr)
    assert left == [3, 4, 5, 6]
    assert tp.drop_contaminated(docs, bench).columns == docs.columns


def test_consistent_votes():
    m = [{"i": i, "b": ["num:1"], "v": ["num:5"]} for i in range(3)] + [{"i": 9, "b": ["num:1"], "v": ["num:6"]}]
    assert tp.consistent(m) == (3, 1)
    assert tp.consistent([{"i": 1, "b": [], "v": []}]) == (1, 0)


def test_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(20))) for i in range(6)]
    docs = []
    for d in range(60):
        body = [rng.choice(words) for _ in range(30)]
        if d % 2:
            take = items[d % 6][1].split()
            n = rng.randrange(6, 20)
            a = rng.randrange(0, 20 - n)
            body[5:5] = take[a : a + n]
        docs.append((d, " ".join(body)))
    grams = lambda t: {tuple(t.split()[i : i + tp.WINDOW]) for i in range(len(t.split()) - tp.WINDOW + 1)}
    want = {(d, i) for d, t in docs for i, b in items if len(grams(t) & grams(b)) >= min(tp.NEED, tp.SHARE * len(grams(b)))}
    got = tp.report(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    # w0..w59 hold digits after a letter: ordinary words
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, ITEM)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, ITEM)], "item_id bigint, text string")
    assert tp.report(docs.limit(0), bench).collect() == []
    assert tp.report(docs, bench.limit(0)).collect() == []
    assert tp.drop_contaminated(docs, bench.limit(0)).count() == 1


def test_one_value_in_several_slots_and_two_variants(spark):
    rng = random.Random(5)
    noise = lambda n: " ".join("".join(rng.choice("abcdefghi") for _ in range(5)) for _ in range(n))
    item = "If {} boys and {} girls share {} cakes and {} pies equally how many pieces does each child get"
    long = "a tank holds {} litres and the old pump moves {} litres while the new pump moves {} litres so how long does it take until the tank is empty"
    rows = [
        (1, noise(9) + "\n" + item.format(3, 4, 5, 9) + "\n" + noise(9)),  # one benchmark value, four values
        (2, noise(9) + "\n" + long.format(9, 3, 6) + "\n" + noise(30) + "\n" + long.format(8, 4, 5) + "\n" + noise(9)),  # two variants
        (3, noise(9) + "\n" + item.format(3, 4, 5, 9).replace("girls share", "girls do share") + "\n" + noise(9)),  # a word put in
        (4, noise(90)), (5, " ".join(item.format(2, 2, 2, 2).split()[:10]) + " " + noise(30)),
    ]
    bench = spark.createDataFrame([(1, item.format(2, 2, 2, 2)), (2, long.format(7, 2, 5))], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r for r in tp.report(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()}
    assert sorted(got) == [(1, 1), (2, 2), (3, 1)]
    assert got[1, 1].place_windows == got[1, 1].item_windows > got[1, 1].windows
    assert got[2, 2].place_windows == got[2, 2].item_windows > got[2, 2].windows
    assert {r.kind for r in got.values()} == {"reparameterised"}


def test_items_without_a_window(spark):
    sum_ = "What is 12 + 7 * 3 - 45 / 9 + 88"
    bench = [(1, sum_), (2, "Name the capital of Peru"), (3, "5 5 6"), (4, "Add 4 to 4"), (5, "... --"), (6, None)]
    rows = [
        (1, "well then: " + sum_ + " is asked here"), (2, "so. What is 1 + 2 * 3 - 4 / 5 + 6 then"), (3, "please name the capital of Peru today"),
        (4, "see 5, 5, 6 there"), (5, "see 7, 7, 8 there"), (6, "add 9 to 9 now"), (7, "add 9 to 8 now"), (8, "name the capital"), (9, None),
        (10, "now name the capital of Chile"), (11, sum_.replace("88", "")),
    ]
    got = tp.report(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(bench, "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id, r.kind) for r in got.collect()} == {
        (1, 1, "exact"), (2, 1, "reparameterised"), (3, 2, "exact"), (4, 3, "exact"), (6, 4, "reparameterised"), (10, 2, "reparameterised"),
    }
