import random

import pytest

from barledger.llm import divergence as dv


def words_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(text):
    text = text or ""
    w = words_of(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed)


def texts():
    rng = random.Random(4)
    some = lambda n, k=30: " ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) + str(rng.randrange(k)) for _ in range(n))
    out = [None, "", " \n\t", "one", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 500, "é ñ 🙂 # * $ % & | < >\n\n# x\n# x\n  \n  ", "a b c\x1cd"]
    out += [some(n, 3) for n in (30, 60, 200)] + [some(300) + "\n" + some(9) for _ in range(3)]
    p = some(40)
    out += [p + " " + some(100) + " " + p, "\n".join([p, p, some(20), p]), some(4000, 4000) + " " + p + "\x0b" + p]
    return out


def test_counts_equal_brute_force(spark):
    rows = [(i, t, None) for i, t in enumerate(texts())] + [(None, "x", None), (3, "one", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = sorted((tuple(r)[:7] for r in dv.report(df).collect()), key=repr)
    assert got == sorted(((d, *brute(t)) for d, t, _ in rows), key=repr)
    kept = {r.doc_id: (r.kept, r.base_failed) for r in dv.report(df).collect()}
    assert all(k != f for k, f in kept.values())  # no reference: the base rules alone decide
    assert dv.report(df.limit(0)).collect() == []


def english(rng, n):
    return " ".join(rng.choice(dv.COMMON_WORDS["en"]) if rng.random() < 0.4 else "".join(rng.choice("etaoinshr") for _ in range(5)) for _ in range(n)) + "."


def test_distances_reject_odd_texts(spark):
    rng = random.Random(9)
    rows = [(i, english(rng, 150), "en") for i in range(40)]
    rows += [(100, " ".join(w + "%%%" for w in english(rng, 150).split()), "en"), (101, english(rng, 150).upper(), "en")]
    rows += [(102, " ".join("".join(rng.choice("etaoinshr") for _ in range(5)) for _ in range(200)), "en")]
    rows += [(103, rows[100 - 100][1], "xx"), (104, rows[1][1], None), (105, "AAA %%% " * 3 + english(rng, 20), "en")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, text string, lang string, __words int")
    got = {r.doc_id: r for r in dv.report(df).collect()}
    assert all(got[i].kept for i in range(40))
    assert not got[100].kept and not got[101].kept and not got[102].kept
    assert got[103].kept and got[104].kept and got[105].kept  # the last is too short for both tests
    good = dv.keep_good(df)
    assert good.columns == df.columns and {r.doc_id for r in good.collect()} == {i for i, r in got.items() if r.kept}
    plan = dv.judged(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("n", [0, 7, 8, 9])
def test_short_windows(spark, n):
    df = spark.createDataFrame([(1, "w " * n, "en")], "doc_id bigint, text string, lang string")
    assert tuple(dv.report(df).first())[:7] == (1, *brute("w " * n))


def test_languages_without_a_reference_pass(spark):
    rng = random.Random(9)
    russian = "Съешь же ещё этих мягких французских булок, да выпей чаю в тихом саду у старого дома. " * 2 + " ".join(
        "".join(rng.choice("оеаинтсрвлкмдпу") for _ in range(6)) for _ in range(150)
    )
    rows = [(i, english(rng, 150), "en") for i in range(20)] + [(100, russian, "ru"), (101, russian, None), (102, russian, "en")]
    got = {r.doc_id: r for r in dv.report(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert not any(r.base_failed for r in got.values()) and got[100].js_class > dv.Limits().class_distance
    assert got[100].kept and got[101].kept and not got[102].kept
