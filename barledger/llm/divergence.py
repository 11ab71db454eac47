"""Quality rules by distribution divergence, in DataFrame functions only.

Each text gives two histograms: character classes, and counts of the commonest function words
of the reference languages (all other words are one bin).  Both are compared with every
language's reference by Jensen-Shannon distance (base 2, 0 to 1); the nearest language counts.
A text is rejected when the nearest distance is above the limit and the text is long enough
for the test (``min_chars``, ``min_words``); shorter texts pass it, and so do texts of a language
without a reference.  Base rules come first.

References are the mean shares over all texts of a language that pass the base rules and the
length guards; they are made twice, the second time without the texts that the first would
reject.  They are one row for each language of ``COMMON_WORDS``, a fixed number, and so the only values that
reach the driver.  Counts are made once: they are written to the shared folder, and both the
references and the verdicts are read from there.

Defined cases: null or blank text has no words and fails the base rule; a language without
reference texts is left out; with no reference at all only the base rules decide; texts whose
``lang`` is none of the reference languages (or null) skip both tests.  Rows are judged one
by one, so repeated rows get equal verdicts.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barledger.llm.common import staged

# The most frequent function words of each language.
COMMON_WORDS: dict[str, tuple[str, ...]] = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "with", "as"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "nicht"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "une", "est", "que", "pour"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un"),
}
#: Character classes by pattern; what is in no class (mostly lower-case letters) is the last bin.
CLASSES = {
    "upper": r"[A-ZÀ-ÖØ-Þ]",
    "digit": r"[0-9]",
    "point": r"[.,;:!?'\"()\-]",
    "symbol": r"[#*$%&|<>]",
}
#: Two more without a pattern: white space, and UTF-8 bytes beyond the first of each character.
ALL_CLASSES = (*CLASSES, "space", "beyond")
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8


@dataclass(frozen=True)
class Limits:
    """Fixed parameters of the verdict."""

    min_words: int = 20
    repeat_percent: int = 30
    class_distance: float = 0.17
    class_min_chars: int = 200
    word_distance: float = 0.29
    word_min_words: int = 100


_BINS = tuple(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words))
_LETTERS = [chr(c) for c in range(48, 127)]


def _residues() -> tuple[int, list[str]]:
    """A modulus under which the CRC-32 of the bins' words differ, and each residue's letter."""
    if len(_BINS) > len(_LETTERS):
        raise ValueError("Too many common words for one letter each.")
    m = len(_BINS)
    while len({zlib.crc32(w.encode()) % m for w in _BINS}) < len(_BINS):
        m += 1
    letters = [""] * m
    for w, c in zip(_BINS, _LETTERS):
        letters[zlib.crc32(w.encode()) % m] = c
    return m, letters


def _words(text: Column) -> Column:
    body = F.btrim(text, F.lit(SPACES))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"[\x20\x09-\x0D]+"))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__``-prefixed counts, class counts and common-word counts per row."""
    d = docs.withColumn("__text", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    d = d.withColumn("__words", _words(F.col("__text")))
    d = d.withColumn("__n_words", F.size("__words").cast("bigint")).withColumn("__chars", F.char_length("__text").cast("bigint"))
    # one pass cuts the text down to the characters of the classes, a few in a hundred
    none_of = "[^" + "".join(p[1:-1] for p in CLASSES.values()) + "]+"
    d = d.withColumn("__rare", F.regexp_replace("__text", none_of, ""))
    for name, pattern in CLASSES.items():
        d = d.withColumn(f"__{name}", F.regexp_count("__rare", F.lit(pattern)).cast("bigint"))
    d = d.withColumn("__word_chars", F.char_length(F.array_join("__words", "")).cast("bigint"))
    d = d.withColumn("__space", F.col("__chars") - F.col("__word_chars"))
    d = d.withColumn("__beyond", F.octet_length("__text").cast("bigint") - F.col("__chars"))
    # each common word becomes one letter of a short string, whose letters are then counted
    m, letters = _residues()
    plain = F.transform("__words", lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?")))
    common = F.filter(plain, lambda w: w.isin(*_BINS))
    letter = F.array(*[F.lit(x) for x in letters])
    d = d.withColumn("__common", F.array_join(F.transform(common, lambda w: F.get(letter, (F.crc32(w.cast("binary")) % m).cast("int"))), ""))
    left = lambda c: F.octet_length(F.replace("__common", F.lit(c), F.lit("")))
    return d.withColumn("__bins", F.array(*[F.octet_length("__common") - left(c) for c in _LETTERS[: len(_BINS)]]))


def _shares(d: DataFrame) -> DataFrame:
    """Arrays of shares: ``__class`` and ``__word``; the last bin holds the rest."""
    counts = [F.col(f"__{c}").cast("double") for c in ALL_CLASSES]
    rest = F.greatest(F.col("__chars") - sum(counts[1:], counts[0]), F.lit(0.0))
    d = d.withColumn("__class", F.array(*counts, rest))
    words = F.concat("__bins", F.array((F.col("__n_words") - F.octet_length("__common")).cast("int")))
    d = d.withColumn("__word", F.transform(words, lambda c: c.cast("double")))
    for name in ("__class", "__word"):
        total = F.greatest(F.aggregate(name, F.lit(0.0), lambda s, x: s + x), F.lit(1.0))
        d = d.withColumn("__total", total).withColumn(name, F.transform(name, lambda c: c / F.col("__total")))
    return d.drop("__total")


def references(counted: DataFrame, lang: str, limits: Limits) -> dict[str, tuple[list[float], list[float]]]:
    """Mean class and word shares of each reference language, from one aggregate."""
    long_enough = (F.col("__n_words") >= limits.word_min_words) & (F.col("__chars") >= limits.class_min_chars)
    d = counted.where(F.col(f"`{lang}`").isin(*COMMON_WORDS) & long_enough)
    classes = [F.avg(F.col("__class")[i]).alias(f"c{i}") for i in range(len(ALL_CLASSES) + 1)]
    words = [F.avg(F.col("__word")[i]).alias(f"w{i}") for i in range(len(_BINS) + 1)]
    found = {}
    for r in d.groupBy(F.col(f"`{lang}`").alias("lang")).agg(*classes, *words).collect():  # one row a reference language
        found[r["lang"]] = ([r[f"c{i}"] for i in range(len(classes))], [r[f"w{i}"] for i in range(len(words))])
    return dict(sorted(found.items()))


def js_distance(shares: Column, reference: list[float]) -> Column:
    """Square root of the Jensen-Shannon divergence in bits."""

    def term(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    known = F.array(*[F.lit(float(q)) for q in reference])
    terms = F.zip_with(shares, known, lambda p, q: term(p, (p + q) / 2) + term(q, (p + q) / 2))
    total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def repeat_words(words: str) -> Column:
    """Words inside 8-word windows that occur twice or more; ``words`` names an array of word hashes."""
    n = F.size(words) - WINDOW + 1
    at = F.sequence(F.lit(0), n - 1)
    keys = F.transform(at, lambda i: F.xxhash64(*[F.get(F.col(words), i + j) for j in range(WINDOW)]))
    return F.when(n < 2, F.lit(None)).otherwise(keys)


def _covered(keys: Column) -> Column:
    """Words covered by windows whose key is not single."""
    ordered = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    twin = F.filter(
        F.transform(
            F.arrays_zip(
                F.transform(ordered, lambda x: x["i"]).alias("i"),
                F.transform(ordered, lambda x: x["k"]).alias("k"),
                F.concat(F.array(F.lit(None).cast("bigint")), F.transform(ordered, lambda x: x["k"])).alias("before"),
                F.concat(F.slice(F.transform(ordered, lambda x: x["k"]), F.lit(2), F.size(keys)), F.array(F.lit(None).cast("bigint"))).alias("after"),
            ),
            lambda x: F.when((x["k"] == x["before"]) | (x["k"] == x["after"]), x["i"]),
        ),
        lambda i: i.isNotNull(),
    )
    places = F.array_sort(twin)
    state = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))
    step = lambda s, i: F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last"))
    return F.aggregate(places, state, step, lambda s: s["n"])


def counted(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """``docs`` with all ``__`` counts and shares, written once to the shared folder."""
    d = with_counts(docs, text)
    d = d.withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
    d = d.withColumn("__keys", repeat_words("__hashes"))
    d = d.withColumn("__single", F.size(F.array_distinct("__keys")))
    d = d.withColumn(
        "__repeat",
        F.when(F.col("__keys").isNull() | (F.col("__single") == F.size("__keys")), F.lit(0).cast("bigint")).otherwise(_covered(F.col("__keys"))),
    )
    lines = F.filter(F.split("__text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    d = d.withColumn("__lines", lines).withColumn("__dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"))
    failed = (F.col("__n_words") < limits.min_words) | (100 * F.col("__repeat") > limits.repeat_percent * F.col("__n_words"))
    d = _shares(d.withColumn("__failed", failed))
    return d.drop("__text", "__words", "__hashes", "__keys", "__single", "__lines", "__bins", "__common", "__rare")


def _odd(d: DataFrame, known: dict, lang: str, limits: Limits) -> tuple[DataFrame, Column]:
    """Distances to the nearest reference, and whether a text is too far away."""
    none = F.lit(None).cast("double")
    near = lambda name, k: F.least(*[js_distance(F.col(name), v[k]) for v in known.values()], none, none) if known else none
    d = d.withColumn("__js_class", near("__class", 0)).withColumn("__js_word", near("__word", 1))
    odd_class = (F.col("__chars") >= limits.class_min_chars) & (F.col("__js_class") > limits.class_distance)
    odd_word = (F.col("__n_words") >= limits.word_min_words) & (F.col("__js_word") > limits.word_distance)
    judgeable = F.col(f"`{lang}`").isin(*known) if known else F.lit(False)
    return d, F.coalesce(judgeable & (F.coalesce(odd_class, F.lit(False)) | F.coalesce(odd_word, F.lit(False))), F.lit(False))


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits(), drop_text: bool = False) -> DataFrame:
    """``docs`` with ``__`` columns: the base counts, failed, distances and kept."""
    d = counted(docs, text, limits)
    d = staged(d.drop(text) if drop_text else d)
    base = d
    known = references(base.where(~F.col("__failed")), lang, limits)
    for again in (True, False):
        d, odd = _odd(base, known, lang, limits)
        if again:  # texts far from the first references do not shape the second
            known = references(d.where(~F.col("__failed") & ~odd), lang, limits)
    return d.withColumn("__kept", ~(F.col("__failed") | odd))


def report(docs: DataFrame) -> DataFrame:
    """One row per text: counts, base_failed, kept, and the two distances."""
    d = judged(docs.select("doc_id", "text", "lang"), drop_text=True)
    return d.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        F.col("__word_chars").alias("word_chars"),
        F.col("__symbol").alias("n_symbols"),
        F.col("__dup_lines").alias("n_dup_lines"),
        F.col("__repeat").alias("n_repeat_words"),
        F.col("__failed").alias("base_failed"),
        F.col("__kept").alias("kept"),
        F.round("__js_class", 6).alias("js_class"),
        F.round("__js_word", 6).alias("js_word"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, columns unchanged (any names)."""
    columns = docs.columns
    inner = docs.select(*[F.col(f"`{c}`").alias(c if c in ("text", "lang") else f"c{i}") for i, c in enumerate(columns)])
    good = judged(inner).where("__kept")
    return good.select(*[F.col(c if c in ("text", "lang") else f"c{i}").alias(c) for i, c in enumerate(columns)])
